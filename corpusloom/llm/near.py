"""Near-duplicate records by deletion-variant signatures (problem 1).

Each record gets a signature of ``positions`` min-wise hashes of its set of word runs;
two records differ at a position with probability 1 - Jaccard. The signature is cut
into ``positions / width`` segments, so few that of two records differing at up to
``2 * segments - 1`` positions one segment differs at most at one. Every segment is
indexed in ``width`` variants, each with one position replaced by a wildcard: segments
with at most one difference share a variant. An equality join on the variants gives
the candidates; their sets of runs are then compared exactly.

The positions are 32-bit symbols, not single bits: at a similarity of 0.7 a segment of
bits would be so short that it selects nothing. At similarity s a pair is missed with
probability (1 - s^w - w s^(w-1) (1-s))^(segments), 2.1e-4 at s = 0.7 with the defaults
and below 1e-5 from 0.78 on.

A variant that more than ``HOT`` texts share (pages around one boilerplate) pairs nothing
by itself. Its texts are refined by their runs, rarest first (``prefix_candidates``), which
loses no pair and meets the boilerplate's runs last, so candidates follow the similar
pairs and not the square of the group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import words
from ..operators.components import connected_components
from ..runtime import stash
from . import textkernel as K

POSITIONS, WIDTH = 32, 4
#: Copies of one stored text up to this number are spelled out as all their pairs; more as pairs with their representative.
SPELLED = 100
#: A variant that more texts than this share is refined by the texts' rarest runs (exact, see ``prefix_candidates``).
HOT = 64


def _signer(column: str, key: str, min_words: int, n: int, positions: int, passed: list[str]):
    factors, offsets = K.constants(positions, 11), K.constants(positions, 13)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, column):
                words, edges = K.stored_words(K.Text.of(part.column(column)))
                long = np.diff(edges) >= max(min_words, n)
                if not long.any():
                    continue
                grams, bounds = K.runs(words, edges, n)
                high, low = K.sequence_keys(words, edges)
                begins = bounds[:-1][long]
                sig = np.empty((len(begins), positions), np.uint32)
                for i in range(positions):
                    mixed = grams * factors[i]
                    mixed += offsets[i]
                    sig[:, i] = np.minimum.reduceat(mixed, begins) >> K.U64(32)
                rows = pa.array(np.flatnonzero(long))
                flat = pa.array(sig.reshape(-1).view(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key).take(rows),
                        *(part.column(c).take(rows) for c in passed),
                        K.int64s(high[long]),
                        K.int64s(low[long]),
                        pa.array(np.diff(bounds)[long].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, positions, dtype=np.int32)), flat),
                    ],
                    ["id", *passed, "k1", "k2", "runs", "sig"],
                )

    return sign


def signatures(df: DataFrame, key: str, column: str, min_words: int = 20, n: int = 5, positions: int = POSITIONS, passed: tuple[str, ...] = ()) -> DataFrame:
    """(id, *passed, k1, k2, runs, sig) of the records with at least ``min_words`` words.

    ``k1, k2`` identify the sequence of words: records that have both in common are copies.
    Null, empty and shorter texts have no row.
    """
    kept = df.select(F.col(key).cast("long").alias(key), *passed, column).where(F.col(column).isNotNull())
    extra = "".join(f"{c} {kept.schema[c].dataType.simpleString()}, " for c in passed)
    return kept.mapInArrow(_signer(column, key, min_words, n, positions, list(passed)), f"id long, {extra}k1 long, k2 long, runs int, sig array<int>")


def variants(sig: str = "sig", positions: int = POSITIONS, width: int = WIDTH):
    """All one-wildcard variants of all segments, as an array of hashes."""
    s = F.col(sig)
    out = []
    for seg in range(positions // width):
        for gap in range(width):
            kept = [s[seg * width + i] for i in range(width) if i != gap]
            out.append(F.xxhash64(F.lit(seg * width + gap), *kept))
    return F.array(*out)


def candidates(classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], threshold: float, hot: int = HOT, id_col: str = "class_id") -> DataFrame:
    """(a, b), a < b: distinct records whose signatures share a variant.

    Variants are counted first, with map-side combination. Those of up to ``hot`` records
    are joined with themselves; the records of the others are compared by ``prefix_candidates``
    over their run sets, which ``sets_of`` (id) gives as (id, grams).
    """
    posted = classes.select(F.col(id_col).alias("id"), F.explode(variants()).alias("v"))
    many = stash(posted.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("v"), "p1-hot")
    crowded = not many.isEmpty()
    few = posted.join(many, "v", "left_anti") if crowded else posted
    found = few.select(F.col("id").alias("a"), "v").join(few.select(F.col("id").alias("b"), "v"), "v").where("a < b").select("a", "b")
    if crowded:
        held = stash(posted.join(many, "v", "left_semi").select("id").distinct(), "p1-crowded")
        found = found.unionByName(prefix_candidates(stash(sets_of(held), "p1-crowded-sets"), threshold))
    return found.distinct()


def prefix_candidates(sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: a superset of the pairs of ``sets`` (id, grams) with this Jaccard similarity.

    Prefix filtering (after Bayardo et al. 2007 and Xiao et al. 2008): with the runs of every
    record in one order, rare ones first, two similar records share one among the first
    n - ceil(t n) + 1 of the longer and the first n - ceil(2t / (1 + t) n) + 1 of the shorter.
    Runs after the first one in common bound what the pair can still share. Counts are exact
    and combined before the shuffle; a record's runs are ranked within the record.
    """
    runs = sets.select("id", F.size("grams").alias("size"), F.explode("grams").alias("g"))
    counts = runs.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("n", "g"))
    ranked = runs.join(counts, "g").withColumn("rank", rank)
    reach = lambda share: F.col("size") - F.ceil(F.lit(share) * F.col("size") - 1e-9) + 1
    longer = stash(ranked.where((F.col("n") > 1) & (F.col("rank") <= reach(threshold))), "prefixes")
    shorter = longer.where(F.col("rank") <= reach(2 * threshold / (1 + threshold)))
    side = lambda df, k: df.select("g", *(F.col(c).alias(f"{c}_{k}") for c in ("id", "size", "rank")))
    both = side(shorter, "x").join(side(longer, "y"), "g").where((F.col("id_x") != F.col("id_y")) & (F.struct("size_x", "id_x") < F.struct("size_y", "id_y")))
    rest = F.least(F.col("size_x") - F.col("rank_x"), F.col("size_y") - F.col("rank_y")) + 1
    fits = (F.col("size_x") >= F.lit(threshold) * F.col("size_y") - 1e-9) & (rest >= F.lit(threshold / (1 + threshold)) * (F.col("size_x") + F.col("size_y")) - 1e-9)
    return both.where(fits).select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()


def _run_sets(column: str, n: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, column):
                grams, bounds = K.runs(*K.stored_words(K.Text.of(part.column(column))), n)
                grams, bounds = K.distinct(grams, bounds)
                yield pa.RecordBatch.from_arrays([part.column("id"), K.int_lists(grams, bounds)], ["id", "grams"])

    return build


def run_sets(df: DataFrame, key: str, column: str, n: int = 5) -> DataFrame:
    """(id, grams): the sorted hashes of each record's distinct runs of ``n`` words."""
    return df.select(F.col(key).cast("long").alias("id"), column).mapInArrow(_run_sets(column, n), "id long, grams array<long>")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, jaccard) of the pairs whose sets reach the threshold; ``sets``: (id, grams)."""
    both = pairs.select("a", "b").join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a").join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
    shared = F.size(F.array_intersect("ga", "gb"))
    both = both.select("a", "b", (F.size("ga") + F.size("gb")).alias("total"), shared.alias("common"))
    return both.select("a", "b", (F.col("common") / (F.col("total") - F.col("common"))).alias("jaccard")).where(F.col("jaccard") >= threshold)


def only(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key is among ``wanted.id`` (broadcast only below Spark's size threshold)."""
    return df.join(wanted.withColumnRenamed("id", key), key, "left_semi")


def text_ids(rows: DataFrame, words: list[str]) -> DataFrame:
    """(*words, t, text_id): the stored texts (hash ``t``) of each class of words, named by the smallest id."""
    return rows.groupBy(*words, "t").agg(F.min("id").alias("text_id"))


def by_text(links: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b): every stored text of one class with every one of the linked class; sides: (id, class_id, text_id)."""
    texts = lambda m, k, t: m.select(F.col("class_id").alias(k), F.col("text_id").alias(t)).distinct()
    both = links.select(F.col("a").alias("ca"), F.col("b").alias("cb")).join(texts(left, "ca", "a"), "ca").join(texts(right, "cb", "b"), "cb")
    return both.select("a", "b")


def folded(members: DataFrame) -> DataFrame:
    """(id, class_id) with each stored text as a class of its own."""
    return members.select("id", F.col("text_id").alias("class_id"))


def near_classes(df: DataFrame, key: str, column: str, threshold: float = 0.7, min_words: int = 20, n: int = 5, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Copies and near-duplicates: ``members`` (id, class_id, text_id) and ``links`` (a, b, jaccard) between classes.

    A class holds the records with the same words; its id is the smallest key, and
    ``text_id`` the smallest key of the class with the same stored text. ``links`` names each pair of different classes once, a < b. Records under ``min_words`` words
    are in neither. Nulls: no row. Repeated rows of one key: one member.
    """
    hashed = df.select(key, column, F.xxhash64(column).alias("t"))
    signed = stash(signatures(hashed, key, column, min_words, n, passed=("t",)), "p1-signed")
    classes = stash(signed.groupBy("k1", "k2").agg(F.min("id").alias("class_id"), F.first("runs").alias("runs"), F.first("sig").alias("sig")), "p1-classes")
    members = signed.select("id", "k1", "k2", "t").join(classes.select("k1", "k2", "class_id"), ["k1", "k2"]).join(text_ids(signed, ["k1", "k2"]), ["k1", "k2", "t"])
    members = members.groupBy("id", "class_id").agg(F.min("text_id").alias("text_id"))
    sets_of = lambda ids: run_sets(only(df.select(F.col(key).cast("long").alias(key), column), key, ids), key, column, n).dropDuplicates(["id"])
    found = stash(candidates(classes, sets_of, threshold, hot), "p1-candidates")
    wanted = stash(found.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "p1-wanted")
    sets = stash(sets_of(wanted), "p1-sets")
    return members, stash(verified(found, sets, threshold), "p1-links")


def spread(links: DataFrame, left: DataFrame, right: DataFrame, spelled: int = SPELLED) -> DataFrame:
    """(x, y): the pairs of records that links (a, b) between classes stand for.

    ``left`` and ``right``: (id, class_id) of either side. Classes whose pairs would be more
    than ``spelled`` squared are not multiplied out: each record of one is paired with
    the other's representative, so no record and no link is lost and rows stay linear.
    """
    sizes = lambda m, k, n: m.groupBy(F.col("class_id").alias(k)).agg(F.count(F.lit(1)).alias(n), F.min("id").alias(f"r{n}"))
    l, r = left.select(F.col("id").alias("x"), F.col("class_id").alias("a")), right.select(F.col("id").alias("y"), F.col("class_id").alias("b"))  # noqa: E741
    sized = links.select("a", "b").join(sizes(left, "a", "m"), "a").join(sizes(right, "b", "n"), "b")
    sized = stash(sized, "sized-links")
    few, many = sized.where(F.col("m") * F.col("n") <= spelled * spelled), sized.where(F.col("m") * F.col("n") > spelled * spelled)
    out = few.select("a", "b").join(l, "a").join(r, "b").select("x", "y")
    stars = many.join(l, "a").select("x", F.col("rn").alias("y")).unionByName(many.join(r, "b").select(F.col("rm").alias("x"), "y"))
    return out.unionByName(stars.distinct())


def expand(members: DataFrame, links: DataFrame, left: str, right: str, spelled: int = SPELLED) -> DataFrame:
    """All pairs of records: of linked classes, and of copies within a class; smaller key first.

    A class of more than ``spelled`` copies is given as pairs with its representative.
    """
    members = stash(members.select("id", "class_id"), "members")
    across = spread(links, members, members, spelled)
    several = members.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = stash(members.join(several, "class_id"), "copies")
    small = copies.where(F.col("n") <= spelled)
    within = small.select(F.col("id").alias("x"), "class_id").join(small.select(F.col("id").alias("y"), "class_id"), "class_id").where("x < y").select("x", "y")
    star = copies.where((F.col("n") > spelled) & (F.col("id") != F.col("class_id"))).select(F.col("class_id").alias("x"), F.col("id").alias("y"))
    return across.unionByName(within).unionByName(star).select(F.least("x", "y").alias(left), F.greatest("x", "y").alias(right))


def near_pairs(df: DataFrame, key: str = "doc_id", column: str = "text", threshold: float = 0.7, min_words: int = 20, n: int = 5) -> DataFrame:
    """(key_a, key_b): every two records whose run sets have at least this Jaccard similarity.

    Every two stored texts come out, whatever the sizes of their classes; only many
    copies of one stored text are given through their representative.
    """
    members, links = near_classes(df, key, column, threshold, min_words, n)
    members = stash(members, "p1-members")
    several = members.where("text_id <> class_id").select(F.col("class_id").alias("a"), F.col("class_id").alias("b")).distinct()
    within = by_text(several, members, members).where("a < b")
    return expand(folded(members), by_text(links, members, members).unionByName(within), f"{key}_a", f"{key}_b")


def near_members(df: DataFrame, key: str = "doc_id", column: str = "text", min_words: int = 20) -> DataFrame:
    """(key, class_id, copies): each record that ``near_pairs`` compares, the smallest key with the same stored text, and how many have it.

    Two members of a class are a pair of ``near_pairs``; two members of different classes are
    one if any pair of it stands between the classes. Classes of up to ``SPELLED`` copies are
    listed pair by pair there anyway. Null and shorter texts have no row.
    """
    return classes_of(df.where(F.size(words(column)) >= min_words), key, column)


def classes_of(df: DataFrame, key: str, column: str, *also: str) -> DataFrame:
    """(key, *also, class_id, copies) of the non-null keys and texts; a class has one stored text and one value of each of ``also``."""
    rows = df.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(F.col(key).cast("long").alias(key), *also, F.md5(column).alias("_h"), F.length(column).alias("_n")).distinct()
    per = rows.groupBy(*also, "_h", "_n").agg(F.min(key).alias("class_id"), F.count(F.lit(1)).alias("copies"))
    return rows.join(per, [*also, "_h", "_n"]).select(key, *also, "class_id", "copies")


def near_groups(df: DataFrame, key: str = "doc_id", column: str = "text", threshold: float = 0.8, min_words: int = 5, n: int = 5) -> DataFrame:
    """(key, class_id, n_links, group_id), one row per record, linear in the records.

    ``class_id``: smallest key with the same words; ``n_links``: linked other classes;
    ``group_id``: smallest key of the connected group. Records too short to compare are
    classes and groups of their own.
    """
    members, links = near_classes(df, key, column, threshold, min_words, n)
    members = stash(members, "p1-members")
    degree = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
    groups = connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    labelled = members.join(degree, "class_id", "left").join(groups.select(F.col("node").alias("class_id"), F.col("component").alias("group_id")), "class_id", "left")
    every = df.select(F.col(key).cast("long").alias("id")).where("id is not null").distinct()
    return every.join(labelled, "id", "left").select(
        F.col("id").alias(key), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("group_id", "class_id", "id").alias("group_id")
    )
