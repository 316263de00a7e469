"""A training corpus from ``documents``: toxic documents go, site boilerplate
lines go, one document of each near-duplicate group stays, documents that hold
benchmark items go, and the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``docs``; the last adds ids, n_tokens, ids_crc32 and round_trip.
Every stage keeps rows with a null doc_id or text that its rule does not reject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.llm import decontaminate, neardup, pieces, sitelines, toxicity
from textlab.llm.queries import PIECE_MODEL, table, tokenizer_path, toxicity_model
from textlab.llm.shared import written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score as toxic go; the model learns from the labelled rows among
    ``docs`` that are not held out. A null or empty text scores the intercept."""
    return toxicity.drop_toxic(docs, toxicity_model(spark, docs, sf_dir))


def without_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies count as one page of a host: a group of them keeps the lines that only it
    has, and the next stage keeps one of the group. Every other page loses all
    boilerplate lines of its host, however short it becomes."""
    return sitelines.drop_site_lines(docs, fold_copies=True).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, that of the smallest doc_id (of
    several texts of that id, one). A row is judged by its own text, so where an id
    repeats, only the texts that copy others go. Equal rows stay once; rows without
    an id all stay, as do those whose text has no word."""
    near = written(neardup.near_duplicates(docs).where("doc_id is not null and n_shingles > 0"), "near")
    first = near.where("kept").groupBy("component_id").agg(F.min("text_key").alias("first_text"))
    gone = written(near.join(first, "component_id").where("not kept or text_key <> first_text")
                   .select(F.col("doc_id").alias("id"), "text_key").distinct(), "duplicates")
    left = docs.join(gone, (docs["doc_id"] == gone["id"]) & (F.xxhash64(docs["text"]) == gone["text_key"]), "left_anti")
    return left.where("doc_id is null").unionByName(left.where("doc_id is not null").dropDuplicates(["doc_id", "text"]))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds an item of the benchmark, exactly or nearly, go; null and
    empty texts hold none."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its piece ids; a null or empty text has none."""
    return pieces.encode_documents(docs, tokenizer_path(PIECE_MODEL), check=True)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_site_lines),
    ("near duplicates", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("piece encoding", encoded),
]

# A fitted classifier, edit distance and byte-pair encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
