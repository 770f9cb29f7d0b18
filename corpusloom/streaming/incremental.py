"""Incremental stages on Structured Streaming: they stop when the input is used up and go on from their checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import clean_text
from ..operators.overlap import OverlapIndex
from ..operators.tokens import Tokenizer, encode
from ..runtime import path_exists


def jsonl_stream(spark: SparkSession, folder: str, schema: str = "text string", files_per_batch: int = 50) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder).where("text <> ''")


def encode_available(spark: SparkSession, folder: str, out: str, checkpoint: str, make: Callable[[], Tokenizer], eos_id: int | None = None) -> None:
    """Encode all files that have arrived since the last call; offsets and output are committed together.

    Rows: file, ids, n. A call that is killed is repeated from its last committed batch,
    so no line is lost or encoded twice.
    """

    def batch(rows: DataFrame, epoch: int) -> None:
        numbered = rows.select(F.monotonically_increasing_id().alias("ord"), "text")
        encode(numbered, make, eos_id).drop("ord").write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    jsonl_stream(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def distinct_clean(stream: DataFrame, time: str, delay: str = "1 day", min_chars: int = 64) -> DataFrame:
    """Streaming exact removal on the cleaned text, with state bounded by the watermark."""
    rows = stream.withColumn("clean", clean_text("text")).where(F.length("clean") >= min_chars)
    return rows.withColumn("key", F.sha2("clean", 256)).withWatermark(time, delay).dropDuplicatesWithinWatermark(["key"]).drop("key")


def grow_index(spark: SparkSession, folder: str, path: str, checkpoint: str, key: str = "ord", **options) -> OverlapIndex:
    """Add newly arrived documents to the overlap index at ``path``, and open it.

    ``options`` are those of ``OverlapIndex``; an index that is there keeps its own.
    """
    if path_exists(spark, f"{path}/settings.json"):
        index = OverlapIndex.open(spark, path)
    else:
        index = OverlapIndex(**options, path=path)
        index.describe(spark)

    def batch(rows: DataFrame, epoch: int) -> None:
        index.sign(rows, key).write.mode("overwrite").parquet(f"{path}/signed/epoch={epoch}")

    jsonl_stream(spark, folder, f"{key} long, text string").writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return OverlapIndex.open(spark, path)
