"""Same or near-same records across splits by a weighted cosine join (problem 4).

A line is a vector over its distinct runs of three plain words, each with the weight
1/sqrt(runs), so that the dot product of two lines is their cosine. Jaccard >= j implies
cosine >= 2j/(1+j), so the join runs at that cosine and loses nothing.

Pruning (after Bayardo et al. 2007 and Anastasiu & Karypis 2014): the terms of a line are
taken in one global order, frequent ones last. From every position on, what the rest of
the line can still add to a dot product is at most

- the residual norm of the rest, counting only terms that the other side has, and
- the sum of weight times the maximum weight of the term on the other side.

Only terms before the point where that bound falls under the threshold are posted in the
inverted lists. If two lines share no posted term, take the one whose posting ends
earlier in the global order: all common terms lie in its rest, so their cosine is under
the threshold. Term counts and maximum weights come from two sketches (hashed buckets,
counts added and weights maximised), so they are upper bounds and no result depends on
their precision. The held-out side is sketched first; the train side then counts only terms
that the held-out side has. The sketches are sized by the held-out side's characters, to
20 MB at most, which is what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..runtime import stash
from . import textkernel as K
from .near import by_text, classes_of, folded, only, spread, text_ids

#: Bounds of the sketches' sizes, as powers of two; pieces in which they are merged.
LEAST_BITS, COUNT_BITS, WEIGHT_BITS, PIECE = 16, 20, 24, 1 << 14


def _terms(part: pa.RecordBatch, column: str, min_words: int, n: int):
    words, edges = K.plain_words(K.Text.of(part.column(column), lower=True))
    long = np.diff(edges) >= min_words
    keep = np.repeat(long, np.diff(edges))
    words = words[keep]
    edges = np.concatenate([[0], np.cumsum(np.diff(edges)[long])])
    grams, bounds = K.distinct(*K.runs(words, edges, n))
    return long, words, edges, grams, bounds


def _bucket(grams: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Buckets of the terms in a table whose size is a power of two."""
    return (grams >> K.U64(64 - (len(table).bit_length() - 1))).astype(np.int64)


def _sketch(column: str, min_words: int, n: int, bits: tuple[int, int], known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, weights = np.zeros(1 << bits[0], np.uint32), np.zeros(1 << bits[1], np.uint8)
        for batch in batches:
            for part in K.slices(batch, column):
                _, _, _, grams, bounds = _terms(part, column, min_words, n)
                if known is None:  # the held-out side
                    weight = np.ceil(255 / np.sqrt(np.maximum(np.diff(bounds), 1))).astype(np.uint8)  # rounded up: a bound
                    np.maximum.at(weights, _bucket(grams, weights), np.repeat(weight, np.diff(bounds)))
                else:
                    grams = grams[known.value[_bucket(grams, known.value)] > 0]
                counts += np.bincount(_bucket(grams, counts), minlength=len(counts)).astype(np.uint32)
        salt = TaskContext.get().partitionId() % 64
        cut = lambda kind, a, size: [(kind, i, a[i : i + size].tobytes()) for i in range(0, len(a), size) if a[i : i + size].any()]
        if blobs := cut(0, counts, PIECE // 4) + cut(1, weights, PIECE):
            kind, piece, blob = zip(*blobs)
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(piece, pa.int32()), pa.array([salt] * len(kind), pa.int32()), pa.array(blob, pa.binary())], ["kind", "piece", "salt", "blob"])

    return run


def _merge(table: pa.Table) -> pa.Table:
    kind = table.column("kind")[0].as_py()
    blobs = (b.as_buffer() for b in table.column("blob"))
    total = None
    for b in blobs:
        a = np.frombuffer(b, np.uint8 if kind else np.uint32)
        total = a.copy() if total is None else np.maximum(total, a) if kind else np.minimum(total.astype(np.uint64) + a, 0xFFFFFFFF).astype(np.uint32)
    return table.slice(0, 1).set_column(table.schema.get_field_index("blob"), "blob", pa.array([total.tobytes()], pa.binary()))


def sketches(lines: DataFrame, column: str, min_words: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts, on both sides, of the terms of the held-out side, and their maximum weights (x 255) there, by bucket."""
    chars = lines.where("held").agg(F.sum(F.length(column).cast("long"))).first()[0] or 0
    bits = tuple(min(most, max(LEAST_BITS, (chars // 2).bit_length())) for most in (COUNT_BITS, WEIGHT_BITS))
    tables = np.zeros(1 << bits[0], np.uint32), np.zeros(1 << bits[1], np.uint8)
    schema, known = "kind int, piece int, salt int, blob binary", None
    for side in ("held", "not held"):
        made = lines.where(side).select(column).mapInArrow(_sketch(column, min_words, n, bits, known), schema)
        made = made.groupBy("kind", "piece", "salt").applyInArrow(_merge, schema).groupBy("kind", "piece").applyInArrow(_merge, schema)
        for kind, piece, _, blob in made.collect():  # 20 MB at most, whatever the data
            a = np.frombuffer(blob, np.uint8 if kind else np.uint32)
            here = tables[kind][piece : piece + len(a)]
            here[:] = a if kind else np.minimum(here.astype(np.uint64) + a, 0xFFFFFFFF)
        known = lines.sparkSession.sparkContext.broadcast(tables[1])
    return tables


def _poster(column: str, shared, min_words: int, n: int, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, weights = shared.value
        for batch in batches:
            for part in K.slices(batch, column):
                long, words, edges, grams, bounds = _terms(part, column, min_words, n)
                if not len(grams):
                    continue
                sizes = np.diff(bounds)
                row = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((grams, counts[_bucket(grams, counts)], row))
                grams = grams[order]
                rows = pa.array(np.flatnonzero(long))
                held = np.asarray(part.column("held").take(rows))
                # training terms are bounded by the held-out side's maximum weights, held-out terms by 1
                other = np.where(held[row], np.uint8(255), weights[_bucket(grams, weights)]) / 255.0
                weight = 1.0 / np.sqrt(sizes)[row]
                rest = lambda x: (c := np.concatenate([[0.0], np.cumsum(x)]))[bounds[1:]][row] - c[:-1]
                bound = np.minimum(np.sqrt(np.maximum(rest(np.where(other > 0, weight * weight, 0)), 0)), rest(weight * other))
                posted = (bound >= cosine - 1e-6) & (other > 0)
                high, low = K.sequence_keys(words, edges)
                at = np.concatenate([[0], np.cumsum(np.bincount(row[posted], minlength=len(sizes)))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(rows), pa.array(held), part.column("t").take(rows), K.int64s(high), K.int64s(low), pa.array(sizes.astype(np.int32)), K.int_lists(grams[posted], at)],
                    ["id", "held", "t", "k1", "k2", "size", "posted"],
                )

    return run


def _term_sets(column: str, min_words: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, column):
                long, _, _, grams, bounds = _terms(part, column, min_words, n)
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(np.flatnonzero(long))), K.int_lists(grams, bounds)], ["id", "grams"])

    return run


def cross_links(lines: DataFrame, column: str = "text", threshold: float = 0.6, min_words: int = 8, n: int = 3) -> tuple[DataFrame, DataFrame]:
    """``members`` (id, class_id, held, text_id) and ``links`` (a, b, cosine): a in train, b held out.

    ``lines``: (id, held, text), held false in train. Lines with the same plain words on
    the same side form a class, those of them with the same stored text have the same
    ``text_id``; links are between classes and exact. Lines under
    ``min_words`` plain words, and null ids, sides or texts, take no part.
    """
    lines = lines.where(f"id is not null and held is not null and {column} is not null")
    shared = lines.sparkSession.sparkContext.broadcast(sketches(lines, column, min_words, n))
    cosine = 2 * threshold / (1 + threshold)
    hashed = lines.select("id", "held", column, F.xxhash64(column).alias("t"))
    posted = hashed.mapInArrow(_poster(column, shared, min_words, n, cosine), "id long, held boolean, t long, k1 long, k2 long, size int, posted array<long>")
    posted = stash(posted, "p4-posted")
    classes = posted.groupBy("held", "k1", "k2").agg(F.min("id").alias("class_id"), F.first("size").alias("size"), F.first("posted").alias("posted"))
    classes = stash(classes, "p4-classes")
    members = posted.select("id", "held", "k1", "k2", "t").join(classes.select("held", "k1", "k2", "class_id"), ["held", "k1", "k2"]).join(text_ids(posted, ["held", "k1", "k2"]), ["held", "k1", "k2", "t"])
    members = members.groupBy("id", "class_id", "held").agg(F.min("text_id").alias("text_id"))
    lists = classes.where("size(posted) > 0").select("class_id", "held", "size", F.explode("posted").alias("term"))
    train = lists.where("not held").select(F.col("class_id").alias("a"), F.col("size").alias("na"), "term")
    held = lists.where("held").select(F.col("class_id").alias("b"), F.col("size").alias("nb"), "term")
    fits = (F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb") - 1e-9)
    pairs = stash(train.join(held, "term").where(fits).select("a", "b").distinct(), "p4-pairs")
    wanted = stash(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "p4-wanted")
    sets = only(lines.select("id", column), "id", wanted).mapInArrow(_term_sets(column, min_words, n), "id long, grams array<long>")
    sets = stash(sets.dropDuplicates(["id"]), "p4-sets")
    common = F.size(F.array_intersect("ga", "gb"))
    scored = (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
        .select("a", "b", common.alias("common"), F.size("ga").alias("na"), F.size("gb").alias("nb"))
    )
    exact = scored.where(F.col("common") >= F.lit(threshold) * (F.col("na") + F.col("nb") - F.col("common")) - 1e-9)
    links = exact.select("a", "b", (F.col("common") / F.sqrt(F.col("na") * F.col("nb").cast("double"))).alias("cosine"))
    return members, stash(links, "p4-links")


def by_side(df: DataFrame, key: str, split: str = "split", column: str = "text") -> DataFrame:
    """(id, held, text) of the rows with a known split; ``held`` is false for train."""
    return df.where(F.col(split).isin("train", "validation", "test")).select(F.col(key).cast("long").alias("id"), (F.col(split) != "train").alias("held"), F.col(column).alias("text"))


def cross_pairs(df: DataFrame, key: str = "line_id", split: str = "split", column: str = "text") -> DataFrame:
    """(key_a, key_b): a line in train and one held out that (nearly) repeats it, smaller key first.

    Every two stored texts come out; many copies of one are paired through their
    representative (``near.spread``).
    """
    members, links = cross_links(by_side(df, key, split, column))
    members = stash(members, "p4-members")
    train, held = members.where("not held"), members.where("held")
    pairs = spread(by_text(links, train, held), folded(train), folded(held))
    return pairs.select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b"))


def cross_members(df: DataFrame, key: str = "line_id", split: str = "split", column: str = "text", min_words: int = 8) -> DataFrame:
    """(key, held, class_id, copies): each line that ``cross_pairs`` compares, with its class of lines of one side with the same stored text.

    A pair of ``cross_pairs`` between members of two classes stands for every two members of
    them. Null, shorter and split-less lines have no row. Plain words are those of ``cross_pairs``.
    """
    lines = by_side(df, key, split, column).where("id is not null and text is not null")

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                _, edges = K.plain_words(K.Text.of(part.column("text"), lower=True))
                yield part.filter(pa.array(np.diff(edges) >= min_words))

    kept = lines.select("id", "held", "text").mapInArrow(long, "id long, held boolean, text string")
    return classes_of(kept, "id", "text", "held").withColumnRenamed("id", key)


def overlap_counts(df: DataFrame, key: str = "line_id", split: str = "split", source: str = "source", column: str = "text") -> DataFrame:
    """(split, source, lines, overlapping): lines of each split and source, and how many have a counterpart.

    Overlapping: a train line with a held-out counterpart, or the reverse. Null sources
    are a group of their own, lines with another or no split are left out.
    """
    members, links = cross_links(by_side(df, key, split, column))
    hit = links.select(F.lit(False).alias("held"), F.col("a").alias("class_id")).unionByName(links.select(F.lit(True).alias("held"), F.col("b").alias("class_id"))).distinct()
    lines = members.join(hit, ["held", "class_id"], "left_semi").select(F.col("id").alias(key)).distinct().withColumn("hit", F.lit(1))
    every = df.where(F.col(split).isin("train", "validation", "test")).select(F.col(key).cast("long").alias(key), F.col(split).alias("split"), F.col(source).alias("source"))
    return every.join(lines, key, "left").groupBy("split", "source").agg(F.count(F.lit(1)).alias("lines"), F.count("hit").alias("overlapping"))
