"""Exact and near-duplicate removal with the reference semantics, and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import minhash as M
from ..functions import text as T
from ..runtime import stash
from .components import connected_components


def cleaned_groups(df: DataFrame, key: str = "ord", text: str = "text") -> DataFrame:
    """(text, key, n, length): one row per distinct cleaned text, with its smallest key, its rows and its length.

    Null texts are skipped. The length is an aggregate, so that a filter on it isn't moved
    below the cleaning, which would then be done twice.
    """
    cleaned = df.where(F.col(text).isNotNull()).select(key, T.clean_text(text).alias(text))
    return cleaned.groupBy(text).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("n"), F.max(F.length(text)).alias("length"))


def kept_groups(groups: DataFrame, min_chars: int = 64, key: str = "ord", text: str = "text") -> DataFrame:
    """(key, text) of the groups that are long enough."""
    return groups.where(F.col("length") >= min_chars).select(key, text)


def group_stats(groups: DataFrame, min_chars: int = 64, script: tuple[int, int] = T.TELUGU, text: str = "text") -> DataFrame:
    """One row: documents_in, documents_kept, duplicates, too_short, script_docs, characters, script_share."""
    long = F.col("length") >= min_chars
    total = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("documents_in"),
        F.count(F.when(long, 1)).alias("documents_kept"),
        F.coalesce(F.sum(F.when(long, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(~long, F.col("n"))), F.lit(0)).alias("too_short"),
        F.count(F.when(long & T.has_script(text, *script), 1)).alias("script_docs"),
        F.coalesce(F.sum(F.when(long, F.col("length").cast("long"))), F.lit(0)).alias("characters"),
    )
    return total.withColumn("script_share", F.coalesce(F.try_divide("script_docs", "documents_kept"), F.lit(0.0)))


def exact_dedup_clean(df: DataFrame, min_chars: int = 64, key: str = "ord", text: str = "text") -> DataFrame:
    """(key, text): one row per distinct cleaned text of at least ``min_chars``, with the smallest key.

    The cleaned text is what is kept. Null texts are skipped.
    """
    return kept_groups(cleaned_groups(df, key, text), min_chars, key, text)


def clean_stats(df: DataFrame, min_chars: int = 64, script: tuple[int, int] = T.TELUGU, key: str = "ord", text: str = "text") -> DataFrame:
    """The statistics of ``exact_dedup_clean``, as ``group_stats``."""
    return group_stats(cleaned_groups(df, key, text), min_chars, script, text)


def exact_dedup_strip(df: DataFrame, key: str = "ord", text: str = "text") -> DataFrame:
    """(key, text): the first original of each stripped text. Null texts are skipped; blank ones count as one."""
    rows = df.where(F.col(text).isNotNull()).select(key, text, F.sha2(T.strip(text), 256).alias("_h"))
    return rows.groupBy("_h").agg(F.min(key).alias(key), F.min_by(text, key).alias(text)).select(key, text)


def star_edges(signed: DataFrame, threshold: float = M.THRESHOLD, num_bands: int = M.NUM_BANDS, num_perm: int = M.NUM_PERM, key: str = "ord", all_pairs: bool = False) -> DataFrame:
    """(src, dst, sim), src < dst: similar members of a bucket.

    By default each member of a bucket is compared with the bucket's first only, which keeps
    candidates linear in the bucket; ``all_pairs`` compares every two members.
    ``signed``: (key, sig). Signatures join the candidates after these are distinct, so a
    pair met in many bands is compared once.
    """
    posted = M.bands(signed, num_bands, num_perm).select(key, "band", F.xxhash64("bucket").alias("b"), F.hash("bucket").alias("c"))
    if all_pairs:
        left = posted.select(F.col(key).alias("src"), "band", "b", "c")
        pairs = left.join(posted.select(F.col(key).alias("dst"), "band", "b", "c"), ["band", "b", "c"]).where("src < dst").select("src", "dst").distinct()
    else:
        # two steps instead of a window: the minimum combines before the shuffle, so a bucket that a third of all rows share is no task's burden
        first = posted.groupBy("band", "b", "c").agg(F.min(key).alias("src"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        pairs = posted.join(first, ["band", "b", "c"]).where(F.col("src") < F.col(key)).select("src", F.col(key).alias("dst")).distinct()
    sigs = signed.select(F.col(key).alias("src"), F.col("sig").alias("sa"))
    scored = pairs.join(sigs, "src").join(signed.select(F.col(key).alias("dst"), F.col("sig").alias("sb")), "dst")
    return scored.select("src", "dst", M.similarity("sa", "sb", num_perm).alias("sim")).where(F.col("sim") >= threshold)


def unique_signed(df: DataFrame, num_perm: int = M.NUM_PERM, n: int = M.SHINGLE, seed: int = M.SEED, kind: str = "blake2b", key: str = "ord", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The exact pass's survivors (key, text) and their signatures (key, sig), the latter written once."""
    unique = exact_dedup_strip(df, key, text)
    return unique, stash(M.signatures(unique, key, text, n, num_perm, seed, kind), "signed")


def near_dup_clusters(df: DataFrame, threshold: float = M.THRESHOLD, num_perm: int = M.NUM_PERM, num_bands: int = M.NUM_BANDS, n: int = M.SHINGLE, seed: int = M.SEED, kind: str = "blake2b", key: str = "ord", text: str = "text") -> DataFrame:
    """(key, cluster): every exact survivor with the smallest key of its cluster."""
    _, signed = unique_signed(df, num_perm, n, seed, kind, key, text)
    edges = star_edges(signed, threshold, num_bands, num_perm, key)
    labels = connected_components(edges).select(F.col("node").alias(key), F.col("component").alias("cluster"))
    return signed.select(key).join(labels, key, "left").select(key, F.coalesce("cluster", key).alias("cluster"))


def near_dedup(df: DataFrame, threshold: float = M.THRESHOLD, num_perm: int = M.NUM_PERM, num_bands: int = M.NUM_BANDS, n: int = M.SHINGLE, seed: int = M.SEED, kind: str = "blake2b", key: str = "ord", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(kept, stats): exact, then near-duplicates removed; the first of each cluster stays, unmodified.

    ``stats``: documents_in, documents_kept, exact_duplicates, near_duplicates, removed_fraction.
    """
    df = df.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias(key), text)
    clusters = stash(near_dup_clusters(df, threshold, num_perm, num_bands, n, seed, kind, key, text), "clusters")
    kept = df.join(clusters.where(F.col(key) == F.col("cluster")).select(key), key, "left_semi")
    counts = df.agg(F.count(F.lit(1)).alias("documents_in")).crossJoin(clusters.agg(F.count(F.lit(1)).alias("u"), F.count(F.when(F.col(key) == F.col("cluster"), 1)).alias("documents_kept")))  # one row each
    stats = counts.select("documents_in", "documents_kept", (F.col("documents_in") - F.col("u")).alias("exact_duplicates"), (F.col("u") - F.col("documents_kept")).alias("near_duplicates"))
    return kept, stats.withColumn("removed_fraction", F.when(F.col("documents_in") == 0, 0.0).otherwise(1 - F.col("documents_kept") / F.greatest(F.col("documents_in"), F.lit(1))))


def threshold_sweep(df: DataFrame, thresholds: tuple[float, ...] = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95), kind: str = "blake2b", num_bands: int = M.NUM_BANDS, key: str = "ord", text: str = "text") -> DataFrame:
    """(threshold, near_duplicates): sketches and candidates are made once, and one run of components serves all thresholds.

    As in near-duplicate removal, candidates are what shares a band with the bucket's first.
    With the default 16 bands of 8 a pair at similarity s does so with probability
    1 - (1 - s**8)**16: 0.95 at 0.8, but 0.24 at 0.6 and 0.06 at 0.5. ``num_bands`` 32 or 64
    raise these to 0.99 and 0.87 (at 0.6 and 0.5 with 32), at more candidates.
    """
    _, signed = unique_signed(df, kind=kind, key=key, text=text)
    held = F.filter(F.array(*(F.struct(F.lit(i).alias("t"), F.lit(float(t)).alias("at")) for i, t in enumerate(thresholds))), lambda x: F.col("sim") >= x["at"])
    edges = star_edges(signed, min(thresholds), num_bands, key=key).select("src", "dst", F.explode(held).alias("x")).select("src", "dst", "x.t")
    labels = connected_components(edges, by="t")
    counts = labels.groupBy("t").agg(F.count(F.when(F.col("node") != F.col("component"), 1)).alias("near_duplicates"))
    rows = df.sparkSession.createDataFrame([(i, float(t)) for i, t in enumerate(thresholds)], "t int, threshold double")
    return rows.join(counts, "t", "left").select("threshold", F.coalesce("near_duplicates", F.lit(0)).cast("long").alias("near_duplicates"))


def true_jaccard(df: DataFrame, pairs: DataFrame, n: int = M.SHINGLE, key: str = "ord", text: str = "text") -> DataFrame:
    """(src, dst, jaccard) of the given pairs over their sets of shingle hashes."""
    sets = df.where(F.col(text).isNotNull()).select(key, T.shingle_hashes(text, n).alias("h"))
    both = pairs.select("src", "dst").join(sets.select(F.col(key).alias("src"), F.col("h").alias("ha")), "src").join(sets.select(F.col(key).alias("dst"), F.col("h").alias("hb")), "dst")
    return both.select("src", "dst", (F.size(F.array_intersect("ha", "hb")) / F.size(F.array_union("ha", "hb"))).alias("jaccard"))


def format_dedup_stats(row) -> str:
    """A stats row as a line of text."""
    kept = f"kept {row.documents_kept:,} / {row.documents_in:,}"
    return f"{kept}; removed {row.removed_fraction:.1%}, of them exact {row.exact_duplicates:,} and near {row.near_duplicates:,}"


def format_clean_stats(row, script: str = "Telugu") -> str:
    """A cleaning stats row as two lines of text."""
    counts = f"kept {row.documents_kept:,} / {row.documents_in:,}; duplicates {row.duplicates:,}, short {row.too_short:,}"
    return f"{counts}\n{row.characters:,} characters; {script} in {row.script_share:.1%} of the kept"
