"""Mixing sources to target weights by systematic sampling (problem 7).

Every document of a source is expected ``copies`` times in the mix. Within the source,
documents are laid out in a fixed order (by size, so that the sample follows the
source's sizes; ties by a hash of the key), their expected copies are summed from the
left, and one random offset is added. A document is emitted once for each integer
boundary its stretch crosses: floor or ceil of ``copies`` times, never more than the
allowed repeats, and the source's total is right to within one document.

A source with a limit on its documents is first thinned the same way to exactly that
many (expected copies limit / documents). Prefix sums are distributed: rows are range
partitioned, summed per partition, and the partitions' totals are summed over a frame
of (partition, source) only. No source is sorted or summed in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import stash


def canonical_source(name: str | Column) -> Column:
    """One spelling per source: trimmed, lower case, blanks and hyphens as underscores; null stays null."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")), r"[\s\-]+", "_")


def _boundaries(df: DataFrame, group: str, order: list[str], copies: Column, seed: int, name: str) -> DataFrame:
    """``df`` with ``emitted``: the integer boundaries each row's stretch of expected copies crosses."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartitionByRange(parts, group, *order).withColumn("_part", F.spark_partition_id()).withColumn("_copies", copies)
    laid = stash(laid, name)
    totals = laid.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, "_part").orderBy(*order)
    ranked = laid.withColumn("_rank", F.row_number().over(inside)).join(base, [group, "_part"])
    last = F.col("_rank") + F.col("_base")
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col(group)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # a row's expected copies are the same for all of its source, so the prefix sum is rank x copies, free of rounding drift
    reach = lambda rank: F.floor(F.round(rank * F.col("_copies"), 9) + offset)
    return ranked.withColumn("emitted", (reach(last) - reach(last - 1)).cast("int")).drop("_part", "_copies", "_rank", "_base")


def _plan(documents: DataFrame, targets: DataFrame, catalog: DataFrame, key: str, seed: int, total: float | None) -> tuple[DataFrame, DataFrame]:
    """(kept documents, one row per target source with its size, copies and share)."""
    caps = catalog.select(canonical_source("name").alias("src"), F.when(F.col("max_docs").isNotNull(), F.greatest(F.col("max_docs"), F.lit(0))).alias("max_docs")).groupBy("src").agg(F.min("max_docs").alias("max_docs"))
    goals = targets.select(canonical_source("name").alias("src"), F.col("target_share").alias("share"), F.col("max_repeats").cast("int").alias("repeats")).where("src is not null and share > 0")
    goals = stash(goals.join(caps, "src", "left"), "p7-goals")  # with its real size Spark broadcasts it while it is small
    sized = documents.select(F.col(key).cast("long").alias("id"), canonical_source("source").alias("src"), F.length("text").cast("long").alias("size")).where("id is not null and size > 0")
    sized = sized.join(goals.select("src"), "src", "left_semi").withColumn("tie", F.xxhash64(F.lit(seed), "id"))
    held = sized.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    thin = sized.join(goals.join(held, "src").select("src", F.least(F.coalesce("max_docs", "n"), "n").alias("keep"), "n"), "src")
    kept = _boundaries(thin, "src", ["size", "tie", "id"], F.col("keep") / F.col("n"), seed + 1, "p7-laid").where("emitted > 0")
    kept = stash(kept.select("id", "src", "size", "tie"), "p7-kept")
    have = kept.groupBy("src").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("held"))
    plan = goals.join(have, "src", "left").select("src", "share", "repeats", F.coalesce("docs", F.lit(0)).alias("docs"), F.coalesce("held", F.lit(0)).alias("held"))
    every = Window.partitionBy()
    # the total up to which a source alone could reach its share; the least of them is what all of them reach
    plan = plan.withColumn("reach", F.when(F.col("held") > 0, F.col("repeats") * F.col("held") / F.col("share")))
    goal = F.lit(float(total)) if total is not None else F.min("reach").over(every)
    plan = plan.withColumn("total", goal).withColumn("copies", F.when(F.col("held") > 0, F.least(F.col("repeats").cast("double"), F.col("share") * F.col("total") / F.col("held"))))
    return kept, stash(plan, "p7-plan")


def _drawn(kept: DataFrame, plan: DataFrame, key: str, seed: int) -> DataFrame:
    rows = kept.join(plan.where("copies is not null").select("src", F.col("copies").alias("each")), "src")
    drawn = _boundaries(rows, "src", ["size", "tie", "id"], F.col("each"), seed + 2, "p7-drawn").where("emitted > 0")
    return drawn.select(F.col("id").alias(key), F.col("src").alias("source"), "size", F.col("emitted").alias("copies"))


def mix(documents: DataFrame, targets: DataFrame, catalog: DataFrame, key: str = "doc_id", seed: int = 1337, total: float | None = None) -> DataFrame:
    """(key, source, size, copies): the documents of the mix and how often each stands in it.

    ``total``: code points wanted. By default it is the largest total at which every source
    reaches its share within ``max_repeats`` and ``max_docs``; beyond that, sources that are
    used up fall short and nobody gets their part (``mix_report`` says by how much). Null and
    empty texts, null keys and sources without a target are not used; a target source without
    documents has no rows and does not limit the others. ``max_docs`` null: no limit;
    0 or less: no documents. Empty tables: no rows.
    """
    return _drawn(*_plan(documents, targets, catalog, key, seed, total), key, seed)


def mix_report(documents: DataFrame, targets: DataFrame, catalog: DataFrame, key: str = "doc_id", seed: int = 1337, total: float | None = None) -> DataFrame:
    """One row per target: (source, target_share, docs, copies, size, actual_share, max_copies, wanted, shortfall, reach, limits).

    ``wanted``: the code points of the source's share of the total; ``shortfall``: what is
    missing of them because all its documents stand there ``max_repeats`` times. ``reach``: the
    total up to which this source could hold its share (null without documents), and
    ``limits``: whether no other source ends earlier.
    """
    kept, plan = _plan(documents, targets, catalog, key, seed, total)
    chosen = _drawn(kept, plan, key, seed)
    by = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("copies").alias("copies"), F.sum(F.col("size") * F.col("copies")).alias("size"), F.max("copies").alias("max_copies"))
    least = F.min("reach").over(Window.partitionBy())
    goals = plan.select(F.col("src").alias("source"), F.col("share").alias("target_share"), (F.col("share") * F.col("total")).alias("wanted"), F.when(F.col("held") > 0, F.col("copies") * F.col("held")).otherwise(0.0).alias("_due"), "reach", (F.col("reach") <= least).alias("limits"))
    rows = goals.join(by, "source", "left").fillna(0, ["docs", "copies", "size", "max_copies"])
    rows = rows.withColumn("actual_share", F.coalesce(F.try_divide("size", F.sum("size").over(Window.partitionBy())), F.lit(0.0)))  # one row per target
    return rows.withColumn("shortfall", F.greatest(F.lit(0.0), F.round(F.col("wanted") - F.col("_due"), 3))).select("source", "target_share", "docs", "copies", "size", "actual_share", "max_copies", "wanted", "shortfall", "reach", F.coalesce("limits", F.lit(False)).alias("limits"))
