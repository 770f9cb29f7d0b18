"""Admission of batches against all history (problem 6).

The ledger keeps tables in a folder, bucketed and appended to batch by batch:

- ``hashes`` (p, id, before, after): the hash of the normalised content (the sequence of
  words), and the hashes of its paragraphs with those of each one's neighbours,
- ``sets``   (id, grams): hashes of the runs of words, for the exact comparison,
- ``hot``    (p): paragraphs that more than ``hot`` records have.

A new batch is hashed once and laid out in the buckets of ``hashes``. A bucket-local
semi-join gives the history's rows that have a hash of the batch (full copies share the
content's), a bucket-local join pairs them, and only pairs with any coverage read their
sets, which are semi-joined first. The history's text is never read again. A ledger is
opened again by its path, in any later session; a batch counts from when its rows are
in ``hashes``, which are written last.

Records are short lines, often without a paragraph break, so the paragraphs hashed are
passages of ``size`` words chosen by content (winnowing): two records that share
``size + window - 1`` words in a row share one. Records that match at 0.7 share longer
stretches. A hot passage (a footer, say) isn't looked up itself, but together with each
of its neighbours; where it becomes hot, the history's rows of it are stored so as well.
Such a pair of passages can be hot, too. What two records share in them alone is common
text of at least 0.7 of both, so only records with ``MOSTLY`` of their passages in hot
pairs need more: their sets are compared by rarest runs first (``near.prefix_candidates``),
which loses nothing and meets what all of them have last.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..runtime import drop_path, read_text, stash, temporary_path, write_text
from . import textkernel as K
from .near import prefix_candidates

#: Share of a record's passages from which on it consists mostly of common text.
MOSTLY = 0.3


def _passages(words: np.ndarray, edges: np.ndarray, size: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed passages: hashes of runs of ``size`` words, and the rows' boundaries.

    Of every ``window`` consecutive runs the smallest hash is taken (Schleimer et al.
    2003), so two texts with ``size + window - 1`` words in common have a passage in common.
    """
    values, bounds = K.runs(words, edges, size)
    row = np.repeat(np.arange(len(edges) - 1), np.diff(bounds))
    least = values.copy()
    for j in range(1, window):
        same = row[j:] == row[:-j]
        least[:-j][same] = np.minimum(least[:-j][same], values[j:][same])
    taken = least == values
    for j in range(1, window):
        taken[j:] |= (least[:-j] == values[j:]) & (row[j:] == row[:-j])
    at = np.zeros(len(edges), np.int64)
    np.cumsum(np.bincount(row[taken], minlength=len(edges) - 1), out=at[1:])
    return values[taken], at


def _prepare(key: str, column: str, min_words: int, n: int, size: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, column):
                words, edges = K.stored_words(K.Text.of(part.column(column)))
                long = np.diff(edges) >= min_words
                if not long.any():
                    continue
                keep = np.repeat(long, np.diff(edges))
                words = words[keep]
                counts = np.diff(edges)[long]
                edges = np.concatenate([[0], np.cumsum(counts)])
                high, low = K.sequence_keys(words, edges)
                grams, bounds = K.distinct(*K.runs(words, edges, n))
                hashes, at = _passages(words, edges, size, window)
                row = np.repeat(np.arange(len(edges) - 1), np.diff(at))
                same = np.concatenate([[False], row[1:] == row[:-1]])
                one = K.constants(1, 31)[0]
                joined = np.concatenate([hashes[:1], K.splitmix(hashes[:-1] * one + hashes[1:])])  # with the one before
                before = pa.array(joined.view(np.int64), mask=~same)
                after = pa.array(np.append(joined[1:], joined[:1]).view(np.int64), mask=~np.append(same[1:], same[:1] & False))
                lists = lambda x: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), x)  # noqa: B023,E731
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(np.flatnonzero(long))) for c in (key, "batch")), K.int64s(high), K.int64s(low), lists(K.int64s(hashes)), lists(before), lists(after), K.int_lists(grams, bounds)],
                    ["id", "batch", "k1", "k2", "paras", "before", "after", "grams"],
                )

    return run


SCHEMA = "id long, batch long, k1 long, k2 long, paras array<long>, before array<long>, after array<long>, grams array<long>"
_TABLES = {"hashes": ("p", "p long, id long, before long, after long"), "sets": ("id", "id long, grams array<long>"), "hot": ("p", "p long")}


class Ledger:
    """Everything accepted so far. ``admit`` takes one batch after the other.

    A record matches another when both have ``min_words`` words and their sets of runs of
    ``n`` words reach ``threshold``. Null, empty and shorter texts match nothing and are
    accepted. Records are taken in the order of their keys within a batch.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, threshold: float = 0.7, min_words: int = 20, n: int = 5, size: int = 8, window: int = 7, hot: int = 1000, buckets: int | None = None):
        """Opens the ledger at ``path`` with the settings it was made with, or makes a new one there.

        Without ``path`` it lies in the session's shared folder until the application ends.
        ``buckets``: by default the session's shuffle partitions, or one for each 16 M
        characters of the first batch where that is more.
        """
        self.spark, self.path = spark, path or temporary_path(spark, "ledger")
        self.settings = {"threshold": threshold, "min_words": min_words, "n": n, "size": size, "window": window, "hot": hot, "buckets": buckets}
        name = uuid.uuid4().hex[:12]
        self.names = {t: f"corpusloom_{t}_{name}" for t in _TABLES}
        known = read_text(spark, f"{self.path}/settings.json")
        self.empty, self.scratch = known is None, []
        if known:
            self.settings = json.loads(known)
            self._register()

    def _register(self) -> None:
        for table in _TABLES:
            self._create(self.names[table], table, f"{self.path}/{table}")

    def _create(self, name: str, table: str, path: str) -> None:
        by, schema = _TABLES[table]
        spec = f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.settings['buckets']} BUCKETS"
        self.spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet OPTIONS (compression 'zstd') {spec} LOCATION '{path}'")

    def _begin(self, rows: DataFrame, column: str) -> None:
        """Fix the number of buckets by the first batch, and make the tables."""
        if self.settings["buckets"] is None:
            chars = rows.agg(F.sum(F.length(column).cast("long"))).first()[0] or 0
            self.settings["buckets"] = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), chars >> 24)
        self._register()
        write_text(self.spark, f"{self.path}/settings.json", json.dumps(self.settings))

    def _append(self, table: str, rows: DataFrame) -> None:
        by, schema = _TABLES[table]
        rows = rows.select(*(c.split()[0] for c in schema.split(", ")))
        rows.repartition(self.settings["buckets"], by).sortWithinPartitions(by).write.insertInto(self.names[table])

    def _table(self, table: str) -> DataFrame:
        return self.spark.table(self.names[table])

    def close(self) -> None:
        """Forget the tables of this session; what lies at ``path`` stays."""
        for name in (*self.names.values(), *self.scratch):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def drop(self) -> None:
        """Remove the ledger; results of ``admit`` stay readable."""
        self.close()
        drop_path(self.spark, self.path)

    def _laid(self, rows: DataFrame, name: str, placed: bool = False) -> DataFrame:
        """``rows`` written once in the buckets of ``hashes``, so that joins by ``p`` move nothing. ``placed``: they lie in them already."""
        table, path = f"{self.names['hashes']}_{uuid.uuid4().hex[:8]}", temporary_path(self.spark, name)
        self._create(table, "hashes", path)
        self.scratch.append(table)
        none = F.lit(None).cast("long")
        rows = rows.select("p", "id", *(c if c in rows.columns else none.alias(c) for c in ("before", "after")))
        rows = rows if placed else rows.repartition(self.settings["buckets"], "p")
        rows.sortWithinPartitions("p").write.insertInto(table)
        return self.spark.table(table)

    def _met(self, posts: DataFrame, name: str) -> DataFrame:
        """The history's rows (p, id) that have a hash of ``posts``; each bucket looks into its own part only."""
        return self._laid(self._table("hashes").select("p", "id").join(posts.select("p").distinct(), "p", "left_semi"), name, True).select("p", "id")

    def _candidates(self, made: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(a, b, covered) with b in the batch and a in history or earlier in the batch; and the batch's rows for ``hashes``."""
        hot, fresh = self.settings["hot"], made.join(reps, "id", "left_semi")
        whole = fresh.select(F.xxhash64("k1", "k2").alias("p"), "id", F.lit(None).cast("long").alias("before"), F.lit(None).cast("long").alias("after"))
        each = fresh.select("id", F.explode(F.arrays_zip("paras", "before", "after")).alias("x")).select(F.col("x.paras").alias("p"), "id", F.col("x.before").alias("before"), F.col("x.after").alias("after"))
        posts = self._laid(whole.unionByName(each).distinct(), "p6-posts")
        known = self._table("hot")
        plain = posts.join(known, "p", "left_anti")
        met = self._met(plain, "p6-met")
        counts = lambda new, old: new.select("p", "id").distinct().select("p").unionByName(old.select("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("p")
        fresh_hot = stash(counts(plain, met), "p6-hot")
        newly, pairs = not fresh_hot.isEmpty(), None
        if newly:  # the history's rows of passages that have become hot are stored with their neighbours, too
            rows = self._table("hashes").join(fresh_hot, "p", "left_semi")
            self._append("hashes", stash(_contexts(rows).join(known, "p", "left_anti"), "p6-backfill"))
            self._append("hot", fresh_hot)
            plain, met = plain.join(fresh_hot, "p", "left_anti"), met.join(fresh_hot, "p", "left_anti")
        common = posts.join(self._table("hot"), "p", "left_semi")
        stored = posts
        if newly or not common.isEmpty():
            around = self._laid(_contexts(common), "p6-around")
            stored = stored.unionByName(around)
            plain_around = around.join(known, "p", "left_anti")
            met_around = self._met(plain_around, "p6-met-around")
            hot_around = stash(counts(plain_around, met_around), "p6-hot-around")
            self._append("hot", hot_around)
            plain, met = plain.unionByName(plain_around.join(hot_around, "p", "left_anti")), met.unionByName(met_around.join(hot_around, "p", "left_anti"))
            mostly = self._mostly(posts, common)
            if not mostly.isEmpty():
                pairs = self._common_text(mostly, around.join(mostly.select("id"), "id", "left_semi"), made)
        new = plain.select("p", F.col("id").alias("b")).distinct()
        among = plain.select("p", F.col("id").alias("a")).distinct()
        old = met.select("p", F.col("id").alias("a")).distinct()
        covered = new.join(old, "p").unionByName(new.join(among, "p").where("a < b")).select("a", "b")
        covered = covered if pairs is None else covered.unionByName(pairs)
        return stash(covered.groupBy("a", "b").agg(F.count(F.lit(1)).alias("covered")), "p6-pairs"), stored

    def _mostly(self, posts: DataFrame, common: DataFrame) -> DataFrame:
        """(id) of the batch's records with ``MOSTLY`` of their passages hot, and so in both of their pairs."""
        hot = self._table("hot").withColumn("h", F.lit(1))
        marked = common.join(hot.withColumnsRenamed({"p": "before", "h": "x"}), "before", "left").join(hot.withColumnsRenamed({"p": "after", "h": "y"}), "after", "left")
        inside = marked.where((F.col("before").isNull() | F.col("x").isNotNull()) & (F.col("after").isNull() | F.col("y").isNotNull())).groupBy("id").agg(F.count(F.lit(1)).alias("k"))
        total = posts.groupBy("id").agg((F.count(F.lit(1)) - 1).alias("n"))  # without the content's hash
        return stash(inside.join(total, "id").where(F.col("k") >= MOSTLY * F.col("n")).select("id"), "p6-mostly")

    def _common_text(self, mostly: DataFrame, around: DataFrame, made: DataFrame) -> DataFrame:
        """(a, b) among records of mostly common text, and between them and the history's records that have it."""
        old = self._met(around, "p6-common").select("id").distinct()
        sets = made.join(mostly, "id", "left_semi").select("id", "grams", F.lit(True).alias("new")).unionByName(self._table("sets").join(old, "id", "left_semi").withColumn("new", F.lit(False)))
        sets = stash(sets.dropDuplicates(["id"]), "p6-common-sets")
        found = prefix_candidates(sets.select("id", "grams"), self.settings["threshold"])
        new = sets.where("new").select("id")
        both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(new.withColumnRenamed("id", "b"), "b", "left_semi")
        return both.join(new.select(F.col("id").alias("a"), F.lit(True).alias("inside")), "a", "left").where("inside is null or a < b").select("a", "b")

    def admit(self, batch: DataFrame, key: str = "record_id", column: str = "text", order: str | None = None) -> DataFrame:
        """(accepted_id, record_id) of the refused records of ``batch``; accepts the others.

        Records are taken by key; with ``order``, the column that numbers the batches of a
        backlog, by number and then key, which gives what one call after the other would.
        Keys must not be those of accepted records; rows repeated within the batch count once.
        """
        s = self.settings
        number = F.lit(0) if order is None else F.col(order)
        rows = batch.select(F.col(key).cast("long").alias(key), number.cast("long").alias("batch"), column).where(f"{column} is not null and {key} is not null and batch is not null")
        if self.empty:
            self._begin(rows, column)
            self.empty = False
        made = stash(rows.mapInArrow(_prepare(key, column, s["min_words"], s["n"], s["size"], s["window"]), SCHEMA), "p6-made")
        first = made.groupBy("k1", "k2").agg(F.min_by("id", F.struct("batch", "id")).alias("rep"))
        members = stash(made.select("id", "batch", "k1", "k2").join(first, ["k1", "k2"]).select("id", "batch", "rep").distinct(), "p6-members")
        inside = members.where("id = rep").select("id", "batch")
        pairs, stored = self._candidates(made, inside.select("id"))

        # only what is paired reads its sets, of the batch and of history
        wanted = stash(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "p6-wanted")
        sets = made.select("id", "grams").join(wanted, "id", "left_semi").unionByName(self._table("sets").join(wanted, "id", "left_semi")).dropDuplicates(["id"])
        common = F.size(F.array_intersect("ga", "gb"))
        scored = pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a").join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
        scored = scored.select("a", "b", common.alias("common"), (F.size("ga") + F.size("gb")).alias("total"))
        links = scored.where(F.col("common") >= s["threshold"] * (F.col("total") - F.col("common")) - 1e-9).select("a", "b")
        # an end in history comes first; of two new ones, the one that is taken first
        numbered = links.join(inside.select(F.col("id").alias("a"), F.col("batch").alias("na")), "a", "left").join(inside.select(F.col("id").alias("b"), F.col("batch").alias("nb")), "b")
        late = F.struct("na", "a") > F.struct("nb", "b")
        numbered = numbered.withColumn("new", F.col("na").isNotNull()).withColumn("swap", F.col("new") & late)
        links = stash(numbered.select(F.when(F.col("swap"), F.col("b")).otherwise(F.col("a")).alias("a"), F.when(F.col("swap"), F.col("a")).otherwise(F.col("b")).alias("b"), "new"), "p6-links")

        by_history, edges = links.where("not new").select("a", "b"), links.where("new").select("a", "b")
        refused = self._first_wins(edges, by_history.select(F.col("b").alias("id")).distinct())
        accepted = stash(inside.select("id").join(refused, "id", "left_anti"), "p6-accepted")

        takers = by_history.unionByName(edges.join(accepted.select(F.col("id").alias("a")), "a", "left_semi"))
        # a copy repeats what its class repeats, and the class's first record where that was accepted
        whole = takers.select("a", F.col("b").alias("rep")).unionByName(accepted.select(F.col("id").alias("a"), F.col("id").alias("rep")))
        # links name the earlier representative first; later copies also follow later ones
        later = edges.join(accepted.select(F.col("id").alias("b")), "b", "left_semi").select(F.col("b").alias("a"), F.col("a").alias("rep"))
        found = whole.unionByName(later).join(members.select("rep", F.col("id").alias("record_id"), F.col("batch").alias("nb")), "rep").where("a <> record_id")
        found = found.join(inside.select(F.col("id").alias("a"), F.col("batch").alias("na")), "a", "left").where(F.col("na").isNull() | (F.struct("na", "a") < F.struct("nb", "record_id")))
        result = stash(found.select(F.col("a").alias("accepted_id"), "record_id").distinct(), "p6-found")
        self._append("sets", made.select("id", "grams").join(accepted, "id", "left_semi").dropDuplicates(["id"]))
        self._append("hashes", stored.join(accepted, "id", "left_semi"))
        while self.scratch:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.scratch.pop()}")
        return result

    def _first_wins(self, edges: DataFrame, refused: DataFrame) -> DataFrame:
        """Who is refused when records are taken in order: rounds over the undecided edges.

        A record none of whose earlier neighbours is undecided is decided, and so are those it
        refuses; rounds end when no edge has two undecided ends. A round is one written
        table; edges of records that others decide early leave it, so it shrinks quickly.
        """
        live, more = edges.join(refused.withColumnRenamed("id", "a"), "a", "left_anti").join(refused.withColumnRenamed("id", "b"), "b", "left_anti"), True
        while more:
            waiting = live.select(F.col("b").alias("a")).distinct()
            out = live.join(waiting, "a", "left_anti").select(F.col("b").alias("id")).distinct()
            # ends that are accepted (no earlier neighbour left) or refused leave the graph
            rest = live.join(waiting, "a", "left_semi").join(out.withColumnRenamed("id", "a"), "a", "left_anti").join(out.withColumnRenamed("id", "b"), "b", "left_anti")
            step = stash(rest.select("a", "b").unionByName(out.select(F.lit(None).cast("long").alias("a"), F.col("id").alias("b"))), "p6-round")
            refused = refused.unionByName(step.where("a is null").select(F.col("b").alias("id")))
            live = step.where("a is not null")
            more = not live.isEmpty()
        return refused


def _contexts(rows: DataFrame) -> DataFrame:
    """The rows' passages together with each of their neighbours, as rows of ``hashes``."""
    none = F.lit(None).cast("long")
    return rows.select(F.explode(F.array("before", "after")).alias("p"), "id", none.alias("before"), none.alias("after")).where("p is not null").distinct()


def admit_all(df: DataFrame, batch: str = "batch_no", key: str = "record_id", column: str = "text", backlog: bool = True, **options) -> DataFrame:
    """(accepted_id, record_id) over all batches of ``df`` in the order of ``batch``.

    The first batch makes the history; the others wait and are admitted against it as one
    ``backlog``, in their order, or each by a call of its own, which gives the same. Rows with a
    null batch belong to no batch. No batches: an empty result.
    """
    first = df.agg(F.min(batch)).first()[0]
    if first is None:
        return df.sparkSession.createDataFrame([], "accepted_id long, record_id long")
    later = [F.col(batch) > first]
    if not backlog:
        later = [F.col(batch) == r[0] for r in df.where(later[0]).select(batch).distinct().orderBy(batch).collect()]  # one row per batch
    ledger = Ledger(df.sparkSession, **options)
    out = ledger.admit(df.where(F.col(batch) == first), key, column)
    for some in later:
        out = out.unionByName(ledger.admit(df.where(some), key, column, batch))
    ledger.drop()
    return out
