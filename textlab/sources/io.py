"""Sources and sinks: labelled comments, CSV, lexicon and lemma files,
metric/CSV sinks."""

from __future__ import annotations

import codecs
import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.normalize import strip_ws
from ..operators.common import sized_broadcast, spread

LABELLED_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("text", T.StringType(), True),
    T.StructField("label", T.IntegerType(), False),
])

# Python's str.splitlines() also breaks lines on these, Spark's text reader
# only on \n, \r and \r\n.
_EXTRA_LINE_BREAKS = "[\\x{b}\\x{c}\\x{1c}-\\x{1e}\\x{85}\\x{2028}\\x{2029}]"

# A lexicon file in a charset of several bytes a character that is not UTF-8 is
# decoded whole in one task and its lines pass through the driver; this bounds it.
MAX_DECODED_LEXICON_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_labelled(spark: SparkSession, sf_dir: str, label: str = "toxic") -> DataFrame:
    """Labelled comments ``(doc_id, text, label)``: documents joined with
    their labels. Only three columns leave the scans; AQE picks a broadcast
    when the label side turns out small at run time, else a sort-merge join."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(label).cast("int").alias("label"))
    return spread(docs.join(labels, "doc_id", "inner").select("doc_id", "text", "label"), docs)


def read_labelled_csv(spark: SparkSession, path: str, text_col: str = "text",
                      label_col: str = "label", id_col: str | None = None) -> DataFrame:
    """RFC-4180 CSV with a header, quoted multi-line cells and doubled quotes.

    Without an id column the row key is ``monotonically_increasing_id`` of the
    scan (unique; multi-line CSV files are not split, so it is stable per file).
    """
    raw = (spark.read.option("header", True).option("multiLine", True)
           .option("quote", '"').option("escape", '"').option("mode", "FAILFAST")
           .csv(path))
    key = F.col(id_col).cast("long") if id_col else F.monotonically_increasing_id()
    return raw.select(key.alias("doc_id"), F.col(text_col).alias("text"),
                      F.col(label_col).cast("int").alias("label"))


def write_csv(df: DataFrame, path: str, single_file: bool = True) -> None:
    """Header CSV with doubled-quote escaping (error samples, CV tables)."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').csv(path))


def write_json(df: DataFrame, path: str) -> None:
    """Metric tables as JSON lines (one small file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def _high_half(encoding: str) -> str | None:
    """Characters of the bytes 0x80 to 0xFF in a charset of one byte a character
    whose lower half is ASCII; None for any other charset."""
    low, high = bytes(range(0x80)), [bytes([b]) for b in range(0x80, 0x100)]
    if low.decode(encoding, "replace") != low.decode("ascii"):
        return None
    # A lead byte takes the next one with it.
    alone = all((c + b"A").decode(encoding, "replace")[1:] == "A" and len((c + c).decode(encoding, "replace")) == 2
                for c in high)
    return "".join(c.decode(encoding, "replace") for c in high) if alone else None


def _from_bytes(raw: Column, high: str) -> Column:
    latin1 = "".join(map(chr, range(0x80, 0x100)))
    return F.translate(F.decode(raw, "ISO-8859-1"), latin1, high)


def _lexicon_lines(spark: SparkSession, path: str, encoding: str | None) -> DataFrame:
    # A text row holds the line's bytes as they are; the cast does not change them.
    rows = spark.read.text(path).select("value", F.col("value").cast("binary").alias("raw"))
    if encoding is None:
        rows = rows.withColumn("file", F.input_file_name())
        western = _from_bytes(F.col("raw"), _high_half("cp1252"))
        files = rows.groupBy("file").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
                                         F.bool_and(~F.contains(western, F.lit("\ufffd"))).alias("western"))
        line = (F.when(F.col("utf8"), F.col("value")).when(F.col("western"), western)
                .otherwise(F.decode("raw", "ISO-8859-1")))
        return rows.join(sized_broadcast(files), "file").select(line.alias("line"))
    if codecs.lookup(encoding).name in ("utf-8", "utf-8-sig"):
        return rows.select(F.col("value").alias("line"))
    high = _high_half(encoding)
    if high is not None:
        return rows.select(_from_bytes(F.col("raw"), high).alias("line"))
    files = spark.read.format("binaryFile").load(path)
    too_big = files.where(F.col("length") > MAX_DECODED_LEXICON_BYTES).limit(1).count()
    if too_big:
        raise ValueError(f"lexicon file over {MAX_DECODED_LEXICON_BYTES} bytes in {encoding}: {path}")
    # Spark 4 limits decode() to a few charsets unless Java charsets are
    # enabled; switch that on for this read only (the plan is run here).
    key = "spark.sql.legacy.javaCharsets"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        text = F.decode(F.col("content"), encoding)
        rows = files.select(F.explode(F.split(text, "\r\n|\r|\n")).alias("line")).collect()
    finally:
        spark.conf.set(key, old)
    return spark.createDataFrame([(r.line,) for r in rows], "line string")


def read_lexicon(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """One cue per line: strip, lower-case, skip blank and ``#`` lines,
    de-duplicate. A leading byte-order mark is dropped. Returns ``(cue)``.

    Without ``encoding``, a file that is valid UTF-8 is read so, any other as
    cp1252 if that defines all its bytes, else as latin-1. Decoding is native,
    line by line, for UTF-8 and all charsets of one byte a character."""
    lines = _lexicon_lines(spark, path, encoding)
    lines = lines.select(F.explode(F.split(F.regexp_replace("line", "^\ufeff", ""),
                                           _EXTRA_LINE_BREAKS)).alias("line"))
    cue = F.lower(strip_ws("line"))
    return (lines.select(cue.alias("cue"))
            .where((F.col("cue") != "") & ~F.col("cue").startswith("#"))
            .dropDuplicates(["cue"]))


def cues_frame(spark: SparkSession, cues) -> DataFrame:
    """An inline cue list as a lexicon DataFrame (same cleaning as a file)."""
    df = spark.createDataFrame([(c,) for c in cues], "line string")
    cue = F.lower(strip_ws("line"))
    return (df.select(cue.alias("cue")).where((F.col("cue") != "") & ~F.col("cue").startswith("#"))
            .dropDuplicates(["cue"]))


def lemma_frame(spark: SparkSession, pairs) -> DataFrame:
    """``(form, lemma)`` lookup table from pairs."""
    return spark.createDataFrame(list(pairs), "form string, lemma string")


def read_lemma_table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Two-column ``form<sep>lemma`` file."""
    return (spark.read.option("sep", sep).schema("form string, lemma string").csv(path)
            .where(F.col("form").isNotNull() & F.col("lemma").isNotNull())
            .groupBy("form").agg(F.min("lemma").alias("lemma")))
