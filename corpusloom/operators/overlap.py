"""Overlap of one corpus with an indexed other one."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import minhash as M
from ..runtime import path_exists, read_text, stash, temporary_path, write_text


class OverlapIndex:
    """Signatures of a corpus in the folder ``path``; grows by ``add`` and is opened again by path.

    Every candidate is verified, unlike near-duplicate removal, which compares within a
    bucket with the first only.
    """

    def __init__(self, num_perm: int = M.NUM_PERM, num_bands: int = M.NUM_BANDS, seed: int = M.SEED, n: int = M.SHINGLE, kind: str = "blake2b", path: str | None = None):
        """``path``: without it the index lies in the session's shared folder until the application ends."""
        self.num_perm, self.num_bands, self.seed, self.n, self.kind, self.path = num_perm, num_bands, seed, n, kind, path
        self.signed: DataFrame | None = None

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> OverlapIndex:
        """The index at ``path``, with the settings it was made with."""
        settings = read_text(spark, f"{path}/settings.json")
        if settings is None:
            raise FileNotFoundError(f"no index at {path}")
        index = cls(**json.loads(settings), path=path)
        index._read(spark)
        return index

    def _read(self, spark: SparkSession) -> None:
        self.signed = spark.read.schema("id long, sig array<long>").parquet(f"{self.path}/signed") if path_exists(spark, f"{self.path}/signed") else None

    def describe(self, spark: SparkSession) -> None:
        """Note the settings at ``path``, so that the index can be opened."""
        write_text(spark, f"{self.path}/settings.json", json.dumps({k: getattr(self, k) for k in ("num_perm", "num_bands", "seed", "n", "kind")}))

    def sign(self, df: DataFrame, key: str = "ord", text: str = "text") -> DataFrame:
        """(id, sig) of the non-null texts of ``df``."""
        return M.signatures(df, key, text, self.n, self.num_perm, self.seed, self.kind).withColumnRenamed(key, "id")

    def add(self, df: DataFrame, key: str = "ord", text: str = "text") -> OverlapIndex:
        """Index the non-null texts of ``df``."""
        spark = df.sparkSession
        if self.path is None:
            self.path = temporary_path(spark, "overlap-index")
        if self.signed is None:
            self.describe(spark)
        self.sign(df, key, text).write.mode("append").option("compression", "zstd").parquet(f"{self.path}/signed")
        self._read(spark)
        return self

    def _posted(self, signed: DataFrame, name: str) -> DataFrame:
        return M.bands(signed, self.num_bands, self.num_perm).select(F.col("id").alias(name), "band", F.xxhash64("bucket").alias("b"), F.hash("bucket").alias("c"))

    def count(self) -> int:
        """Indexed documents."""
        return 0 if self.signed is None else self.signed.count()

    def buckets(self) -> int:
        """Distinct (band, bucket) keys."""
        return 0 if self.signed is None else self._posted(self.signed, "id").select("band", "b", "c").distinct().count()

    def _verified(self, pairs: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
        scored = pairs.join(signed.select(F.col("id").alias("probe"), F.col("sig").alias("sa")), "probe").join(self.signed.select(F.col("id").alias("indexed"), F.col("sig").alias("sb")), "indexed")
        return scored.select("probe", "indexed", M.similarity("sa", "sb", self.num_perm).alias("sim")).where(F.col("sim") >= threshold)

    def _pairs(self, signed: DataFrame, held: DataFrame, threshold: float) -> DataFrame:
        asked = self._posted(signed, "probe")
        return self._verified(asked.join(self._posted(held, "indexed"), ["band", "b", "c"]).select("probe", "indexed").distinct(), signed, threshold)

    def pairs(self, probes: DataFrame, threshold: float = M.THRESHOLD, key: str = "ord", text: str = "text") -> DataFrame:
        """(probe, indexed, sim): every indexed document similar to a probe."""
        if self.signed is None:
            return probes.sparkSession.createDataFrame([], "probe long, indexed long, sim double")
        return self._pairs(stash(self.sign(probes, key, text), "overlap-probes"), self.signed, threshold)

    def matches(self, probes: DataFrame, threshold: float = M.THRESHOLD, key: str = "ord", text: str = "text") -> DataFrame:
        """The probe rows that have a similar indexed document.

        Existence only, so equal signatures stand for one another on both sides, and every
        signature is compared with each bucket's first document before the others: a bucket
        that many documents share is decided there, and only signatures that no first document
        matches meet all members.
        """
        if self.signed is None:
            return probes.where("false")
        signed = stash(self.sign(probes, key, text).withColumn("h", F.xxhash64("sig")).withColumn("g", F.hash("sig")), "overlap-probes")
        one = stash(signed.groupBy("h", "g").agg(F.min("id").alias("id"), F.first("sig").alias("sig")).select("id", "sig", "h", "g"), "overlap-distinct")
        held = self.signed.groupBy(F.xxhash64("sig").alias("h"), F.hash("sig").alias("g")).agg(F.min("id").alias("id"), F.first("sig").alias("sig")).select("id", "sig")
        held = stash(held, "overlap-held")
        first = self._posted(held, "indexed").groupBy("band", "b", "c").agg(F.min("indexed").alias("indexed"))
        near = self._posted(one, "probe").join(first, ["band", "b", "c"]).select("probe", "indexed").distinct()
        hit = stash(self._verified(near, one, threshold).select(F.col("probe").alias("id")).distinct(), "overlap-hit")
        rest = self._pairs(one.join(hit, "id", "left_anti"), held, threshold).select(F.col("probe").alias("id"))
        found = signed.join(one.join(hit.unionByName(rest).distinct(), "id", "left_semi").select("h", "g"), ["h", "g"], "left_semi")
        return probes.join(found.select(F.col("id").alias(key)).distinct(), key, "left_semi")


def overlap_report(probes: DataFrame, hits: DataFrame, indexed: int, population: int, by: str = "source", key: str = "ord") -> DataFrame:
    """(by, probes, hits, raw_rate, coverage, est_rate) per group.

    ``est_rate`` scales the raw rate by the share of the population that was indexed, at
    most 1; 0 without coverage. ``population`` must be positive.
    """
    if population <= 0:
        raise ValueError("population must be positive")
    coverage = indexed / population
    marked = probes.select(key, by).join(hits.select(key).withColumn("_hit", F.lit(1)), key, "left")
    out = marked.groupBy(by).agg(F.count(F.lit(1)).alias("probes"), F.count("_hit").alias("hits")).withColumn("raw_rate", F.col("hits") / F.col("probes")).withColumn("coverage", F.lit(coverage))
    scaled = F.least(F.lit(1.0), F.col("raw_rate") / F.lit(coverage)) if coverage else F.lit(0.0)
    return out.withColumn("est_rate", scaled)
