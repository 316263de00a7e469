"""The dictionary baseline on a stream of comments.

Lexicon flagging with a size-checked inline lexicon is a stateless
projection, so the same operator runs unchanged on a streaming DataFrame:
``readStream`` of arriving comment files -> normalise -> flag -> sink, with
no state store and no shuffle. (The join path for very large lexicons would
be a stream-static join and works the same way.)
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, types as T

from ..operators.lexicon import lexicon_flag
from ..session import scratch_dir

COMMENT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType(), True),
    T.StructField("text", T.StringType(), True),
])


def flag_stream(stream: DataFrame, cues: DataFrame, text_col: str = "text") -> DataFrame:
    """Streaming rows plus ``p1`` and ``prediction``."""
    return lexicon_flag(stream, cues, text_col=text_col)


def run_flag_stream(spark: SparkSession, source: str, cues: DataFrame, out: str | None = None,
                    schema: T.StructType = COMMENT_SCHEMA) -> str:
    """Process every comment file present under ``source`` once
    (``availableNow``) into Parquet at ``out``; the checkpoint lives in the
    session's shared checkpoint folder. Returns the output path."""
    out = out or scratch_dir(spark, "flag-stream-out")
    ckpt = scratch_dir(spark, "flag-stream-ckpt")
    reader = spark.readStream.schema(schema)
    if not os.path.isdir(source):
        # one file: watch its folder through a glob that matches only it
        base, name = os.path.split(source)
        reader = reader.option("basePath", base)
        source = os.path.join(base, name[:-1] + f"[{name[-1]}]")
    stream = reader.parquet(source)
    q = (flag_stream(stream, cues).select("doc_id", "p1", "prediction")
         .writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out

