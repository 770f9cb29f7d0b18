"""Source catalogue, per-source filters and caps, token budgets and run logs."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..runtime import stash

TOKENS_PER_CHAR = 0.208


@dataclass(frozen=True)
class SourceSpec:
    """Where a source comes from, and how much of it is taken."""

    name: str
    dataset: str
    config: str | None
    split: str
    max_docs: int | None
    min_chars: int = 200
    text_field: str = "text"


# The built-in sources, by the tokens they contribute, and the token target.
SOURCES = [
    SourceSpec("fineweb2", "HuggingFaceFW/fineweb-2", "tel_Telu", "train", 2_000_000),
    SourceSpec("c4", "allenai/c4", "te", "train", 700_000),
    SourceSpec("sangraha", "ai4bharat/sangraha", "verified", "tel", 1_100_000),
    SourceSpec("indiccorp", "ai4bharat/IndicCorpV2", "indiccorp_v2", "tel_Telu", 14_000_000, min_chars=60),
    SourceSpec("wikipedia", "wikimedia/wikipedia", "20231101.te", "train", 100_000),
]
TOKEN_TARGET = 2_770_000_000


def catalogue_frame(spark: SparkSession, specs: list[SourceSpec]) -> DataFrame:
    return spark.createDataFrame([asdict(s) for s in specs], "name string, dataset string, config string, split string, max_docs long, min_chars long, text_field string")


def capped(df: DataFrame, catalogue: DataFrame, key: str = "ord", text: str = "text", source: str = "source", only: list[str] | None = None) -> DataFrame:
    """Rows of catalogued sources with ``min_chars`` characters, the first ``max_docs`` of each by key.

    A cap of 0 or less still lets one row through (the cap is tested after a row is
    written); a null cap lets all through. The rank within a source is a distributed
    prefix count, not a sort of the source in one task.
    """
    spec = catalogue.select(F.col("name").alias(source), "max_docs", "min_chars").where(F.col(source).isNotNull())
    if only:
        spec = spec.where(F.col(source).isin(only))
    rows = df.join(spec, source).where(F.coalesce(F.length(text), F.lit(0)) >= F.coalesce("min_chars", F.lit(0)))
    kept = rows.withColumn("_cap", F.when(F.col("max_docs").isNotNull(), F.greatest(F.col("max_docs"), F.lit(1)))).drop("max_docs", "min_chars")
    return _first_n(kept, source, key, "_cap").drop("_cap")


def _first_n(df: DataFrame, group: str, key: str, cap: str) -> DataFrame:
    """The first ``cap`` rows of each group by key (null cap: all).

    Keys alone are laid out in ranges and ranked inside them, ranges are counted ahead, and
    the last key that each group takes (one row per group) filters the rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.where(F.col(cap).isNotNull()).select(group, key, cap)
    laid = stash(keys.repartitionByRange(parts, group, key).withColumn("_part", F.spark_partition_id()), "first-n")
    base = laid.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = base.select(group, "_part", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_base"))
    ranked = laid.withColumn("_rank", F.row_number().over(Window.partitionBy(group, "_part").orderBy(key))).join(base, [group, "_part"])
    last = stash(ranked.where(F.col("_rank") + F.col("_base") == F.col(cap)).select(group, F.col(key).alias("_last")), "last-n")
    return df.join(last, group, "left").where(F.col("_last").isNull() | (F.col(key) <= F.col("_last"))).drop("_last")


def first_per_group(df: DataFrame, group: str, key: str, n: int, after: bool = False) -> DataFrame:
    """The first ``n`` rows of each group. ``after``: the cap is tested after a row is taken, so at least one comes through."""
    n = max(1, n) if after else n
    if n <= 0:
        return df.where("false")
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(key))).where(F.col("_n") <= n).drop("_n")


def budget(df: DataFrame, text: str = "text", source: str = "source", per_char: float = TOKENS_PER_CHAR) -> DataFrame:
    """(source, docs, chars, est_tokens) over the non-null texts."""
    per = df.where(F.col(text).isNotNull()).groupBy(source).agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length(text).cast("long")).alias("chars"))
    return per.withColumn("est_tokens", (F.col("chars") * F.lit(per_char)).cast("bigint"))


def run_summary(results: DataFrame) -> DataFrame:
    """(source, status, docs, chars, est_tokens, gb, interrupted, error): each source's latest logged run.

    A run logged twice under another id counts once. ``status``: ok, interrupted, skipped
    or failed; errors are cut to 120 characters, reasons to 90.
    """
    latest = results.where("source is not null").withColumn("_n", F.row_number().over(Window.partitionBy("source").orderBy(F.col("finished_at").desc_nulls_last(), F.col("run_id").desc())))
    status = F.when(F.col("error_msg").isNotNull(), "failed").when(F.col("skipped"), "skipped").when(F.col("interrupted").isNotNull(), "interrupted").otherwise("ok")
    return latest.where("_n = 1").select("source", status.alias("status"), "docs", "chars", "est_tokens", "gb", F.substring("interrupted", 1, 90).alias("interrupted"), F.substring("error_msg", 1, 120).alias("error"))


def total_tokens(results: DataFrame) -> DataFrame:
    """One row: tokens of the fetched sources (skipped and failed ones add nothing), and counts by status."""
    s = run_summary(results)
    got = F.col("status").isin("ok", "interrupted")
    return s.agg(
        F.coalesce(F.sum(F.when(got, F.col("est_tokens"))), F.lit(0)).alias("est_tokens"),
        F.count(F.when(got, 1)).alias("fetched"),
        F.count(F.when(F.col("status") == "skipped", 1)).alias("skipped"),
        F.count(F.when(F.col("status") == "failed", 1)).alias("failed"),
    )
