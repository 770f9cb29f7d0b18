"""Long exact spans shared between records, by recompression (problem 10).

Each text starts as its code points. In every round two kinds of neighbours are named
(after Jez 2015): runs of one symbol, and pairs whose left symbol falls on the left side
and whose right symbol on the right side of this round's partition of the alphabet. A
name is a hash of what it stands for, so it is the same everywhere without any exchange,
and what a symbol does depends on itself and its neighbours only. Equal substrings hence
end up with equal symbols but for a few at their ends. Nothing is joined beyond
``2 * LEAST`` code points, so that symbols stay short against the span looked for.

A shared high-level symbol reveals a shared span: for every symbol the name and the hash
of the ``CONTEXT`` code points around its begin are posted, records that post the same are
paired on the difference of their positions, and the pairs are compared code point by
code point. Copies of a text fold into one class before anything is posted. A symbol that
very many records post (site footers just short of the wanted length) pairs nothing by
itself: its records post every window of ``min_chars`` code points around it, which only
truly shared spans have in common, so false pairs stay linear in the records. Equal windows
are equal stretches: they pair their records without reading the texts again, and how much
of a record is shared needs no pairs at all.

A common span of ``min_chars`` is missed only if none of the symbols that begin in its
middle ``min_chars - CONTEXT`` code points is consistent. Test and README give the recall
against brute force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from ..runtime import stash
from . import textkernel as K
from .near import only

LEAST, ROUNDS, CONTEXT = 20, 14, 160
#: A posted symbol that more records than this have is looked up by exact windows instead.
HOT = 64


def _compress(sym: np.ndarray, size: np.ndarray, row: np.ndarray, begin: np.ndarray, round_no: int) -> tuple[np.ndarray, ...]:
    """One round: name runs, then pairs. Returns the shorter arrays."""
    limit = 2 * LEAST
    joined = np.zeros(len(sym), bool)  # with the symbol before
    if len(sym) > 1:
        same = (sym[1:] == sym[:-1]) & (row[1:] == row[:-1])
        if same.any():
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            count = np.diff(np.append(first, len(sym)))
            fits = (count > 1) & (count * size[first] <= limit)
            if fits.any():
                joined = np.repeat(fits, count)
                joined[first] = False
                sym = sym.copy()
                sym[first[fits]] = K.splitmix(sym[first[fits]] + count[fits].astype(K.U64) * K.constants(1, 51)[0])
                size = size.copy()
                size[first[fits]] *= count[fits].astype(size.dtype)
                keep = ~joined
                sym, size, row, begin = sym[keep], size[keep], row[keep], begin[keep]
        side = (sym >> K.U64((round_no * 7 + 3) % 64)) & K.U64(1)
        pair = np.flatnonzero((side[:-1] == 0) & (side[1:] == 1) & (row[1:] == row[:-1]) & (size[:-1] + size[1:] <= limit))
        if len(pair):
            a, b = K.constants(2, 53)
            if not joined.any():
                sym, size = sym.copy(), size.copy()
            sym[pair] = K.splitmix(sym[pair] * a + sym[pair + 1] * b)
            size[pair] += size[pair + 1]
            keep = np.ones(len(sym), bool)
            keep[pair + 1] = False
            sym, size, row, begin = sym[keep], size[keep], row[keep], begin[keep]
    return sym, size, row, begin


def symbols(text: K.Text, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, rows and begins (in ``text.cp``) of the high-level symbols of all rows."""
    sym = K.splitmix((text.cp.astype(K.U64) + K.U64(1)) * K.constants(1, 52)[0])
    size = np.ones(len(sym), np.int16)
    row = np.repeat(np.arange(text.rows, dtype=np.int32), np.diff(text.starts))
    begin = np.arange(len(sym), dtype=np.int32)
    for r in range(rounds):
        sym, size, row, begin = _compress(sym, size, row, begin, r)
    return sym, row, begin


def _poster(key: str, column: str, min_chars: int):
    half = CONTEXT // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, column):
                text = K.Text.of(part.column(column))
                long = np.flatnonzero(np.diff(text.starts) >= min_chars)
                if not len(long):
                    continue
                prefix = text.hashed()
                lo, hi = text.starts[long], text.starts[long + 1]
                whole = K.span_hash(prefix, lo, hi)
                inner = np.flatnonzero(np.repeat(np.diff(text.starts) >= min_chars, np.diff(text.starts)))
                starts = np.concatenate([[0], np.cumsum(hi - lo)])
                kept = K.Text(text.cp[inner], starts)
                sym, row, begin = symbols(kept)
                at = begin.astype(np.int64)
                ok = (at - half >= starts[row]) & (at + half <= starts[row + 1])
                sym, row, at = sym[ok], row[ok], at[ok]
                real = at - starts[row] + lo[row]
                posted = K.splitmix(sym + K.span_hash(prefix, real - half, real + half))
                # within a stretch that repeats one symbol only its two ends are posted
                same = np.zeros(len(posted) + 1, bool)
                same[1:-1] = (posted[1:] == posted[:-1]) & (row[1:] == row[:-1])
                ends = ~(same[:-1] & same[1:])
                posted, row, at = posted[ends], row[ends], at[ends]
                edges = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(long)))])
                second = K.span_hash(prefix, lo, (lo + hi) // 2)  # with the length, a second witness of equality
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key).take(pa.array(long)),
                        K.int64s(whole),
                        K.int64s(second),
                        pa.array((hi - lo).astype(np.int32)),
                        K.int_lists(posted, edges),
                        K.int_lists((at - starts[row]).astype(np.int32), edges, pa.int32()),
                    ],
                    ["id", "k1", "k2", "chars", "posted", "at"],
                )

    return run


def _several(lists: DataFrame, name: str) -> DataFrame:
    """The rows (id, p, at, ...) whose ``p`` another row has too, with the number of rows ``n``.

    Counted with map-side combination and joined back, so that no task holds a symbol's list.
    """
    counts = lists.groupBy("p").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return stash(lists.join(counts, "p"), name)


def _windows(min_chars: int):
    half = CONTEXT // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, "text"):
                text = K.Text.of(part.column("text"))
                prefix = text.hashed()
                ats = part.column("ats")
                row = np.repeat(np.arange(part.num_rows), np.asarray(pa.compute.list_value_length(ats)))
                at = np.asarray(ats.flatten()).astype(np.int64) + text.starts[row]
                begin = (at[:, None] - half - np.arange(min_chars - CONTEXT + 1)).reshape(-1)
                row = np.repeat(row, min_chars - CONTEXT + 1)
                ok = (begin >= text.starts[row]) & (begin + min_chars <= text.starts[row + 1])
                begin, first = np.unique(begin[ok], return_index=True)
                row = row[ok][first]
                names = K.span_hash(prefix, begin, begin + min_chars)
                before = np.zeros(len(begin), bool)  # whether the window one code point earlier is there too
                before[1:] = (begin[1:] == begin[:-1] + 1) & (row[1:] == row[:-1])
                earlier = pa.array(np.concatenate([[0], names[:-1].view(np.int64)]) if len(names) else np.zeros(0, np.int64), mask=~before)
                # a second hash, of another base, so that equal windows are equal texts
                second = K.span_hash(prefix, begin, begin + min_chars // 2) ^ K.span_hash(prefix, begin + 7, begin + min_chars) * K.constants(1, 57)[0]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(row)), K.int64s(names), pa.array((begin - text.starts[row]).astype(np.int32)), K.int64s(second), earlier], ["id", "p", "at", "p2", "earlier"]
                )

    return run


def _verify(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = lambda t: np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4")
        for batch in batches:
            out: list[tuple[int, int, int, int, int]] = []
            memo: dict[int, np.ndarray] = {}
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "shifts")]
            for i, (a, b, shifts) in enumerate(zip(*columns)):
                if len(memo) > 500:
                    memo.clear()
                for name, key in (("ta", a), ("tb", b)):
                    if key not in memo:
                        memo[key] = decode(batch.column(name)[i].as_py())
                x, y = memo[a], memo[b]
                for shift in shifts:
                    lo, hi = max(0, shift), min(len(x), len(y) + shift)
                    differ = np.flatnonzero(x[lo:hi] != y[lo - shift : hi - shift])
                    edges = np.concatenate([[-1], differ, [hi - lo]])
                    for k in np.flatnonzero(np.diff(edges) > min_chars):
                        begin = int(edges[k]) + 1
                        out.append((a, b, lo + begin, lo + begin - shift, int(edges[k + 1]) - begin))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))], ["a", "b", "begin_a", "begin_b", "chars"])

    return run


def shared_spans(df: DataFrame, key: str = "doc_id", column: str = "text", min_chars: int = 200) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``members`` (id, class_id, chars), ``spans`` (a, b, begin_a, begin_b, chars) and ``windows`` (id, at, p, p2, earlier, n).

    A class holds the records with the same text, and is named by its smallest key. Spans
    are maximal, verified stretches of at least ``min_chars`` code points that two classes
    share, a < b, as far as a symbol of at most ``HOT`` classes reveals them; ``windows`` are the
    stretches of exactly ``min_chars`` around all other shared symbols that several classes
    have, so they stay linear in the records. Together they cover all that is shared. Null
    and shorter texts take no part.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(column).alias("text")).where("id is not null and text is not null")
    posted = stash(rows.mapInArrow(_poster("id", "text", min_chars), "id long, k1 long, k2 long, chars int, posted array<long>, at array<int>"), "p10-posted")
    first = stash(posted.groupBy("k1", "k2", "chars").agg(F.min("id").alias("class_id")), "p10-classes")
    members = posted.select("id", "k1", "k2", "chars").join(first, ["k1", "k2", "chars"]).select("id", "class_id", "chars").distinct()
    later = stash(members.where("id <> class_id").select("id"), "p10-copies")
    lists = posted.join(later, "id", "left_anti").select("id", F.explode(F.arrays_zip("posted", "at")).alias("x")).select("id", F.col("x.posted").alias("p"), F.col("x.at").alias("at"))
    shared = _several(lists, "p10-shared")
    hot = shared.where(F.col("n") > HOT).groupBy("id").agg(F.collect_set("at").alias("ats"))
    around = only(rows, "id", stash(hot.select("id"), "p10-hot")).join(hot, "id").dropDuplicates(["id"]).mapInArrow(_windows(min_chars), "id long, p long, at int, p2 long, earlier long")
    windows = _several(around, "p10-windows")
    shared = shared.where(F.col("n") <= HOT).select("id", "p", "at")
    left = shared.select(F.col("id").alias("a"), F.col("at").alias("i"), "p")
    right = shared.select(F.col("id").alias("b"), F.col("at").alias("j"), "p")
    shifts = left.join(right, "p").where("a < b").groupBy("a", "b").agg(F.collect_set(F.col("i") - F.col("j")).alias("shifts"))
    pairs = stash(shifts, "p10-pairs")
    wanted = stash(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "p10-wanted")
    texts = stash(only(rows, "id", wanted).dropDuplicates(["id"]), "p10-texts")
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    spans = both.mapInArrow(_verify(min_chars), "a long, b long, begin_a int, begin_b int, chars int")
    return members, stash(spans.distinct(), "p10-spans"), windows


def span_pairs(df: DataFrame, key: str = "doc_id", column: str = "text", min_chars: int = 200) -> DataFrame:
    """(key_a, key_b): records with a common stretch of ``min_chars`` code points, copies included.

    Equal windows pair their records without the texts (two 64-bit hashes of different
    stretches must agree), and each run of common windows does so once.
    """
    from .near import expand

    members, spans, windows = shared_spans(df, key, column, min_chars)
    side = lambda k: windows.select("p", "p2", F.col("id").alias(k), F.col("earlier").alias(f"e{k}"))
    fresh = F.col("ea").isNull() | F.col("eb").isNull() | (F.col("ea") != F.col("eb"))
    same = side("a").join(side("b"), ["p", "p2"]).where((F.col("a") < F.col("b")) & fresh).select("a", "b")
    return expand(members.select("id", "class_id"), spans.select("a", "b").unionByName(same).distinct(), f"{key}_a", f"{key}_b")


def shared_share(df: DataFrame, key: str = "doc_id", column: str = "text", min_chars: int = 200) -> DataFrame:
    """(key, chars, shared_chars, share): how much of each record stands in another one.

    Every record has a row; null and short texts share nothing. A text with a copy is
    shared wholly. Spans that overlap count once. No pairs are made of what many records
    share: a window that several classes have is shared, whoever they are.
    """
    members, spans, windows = shared_spans(df, key, column, min_chars)
    members = stash(members, "p10-members")
    # a window that only one text repeats is not shared with another one
    others = windows.groupBy("p").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x < y").select("p")
    reach = lambda c, lo, n: F.struct(F.col(c).alias("class_id"), F.col(lo).alias("lo"), (F.col(lo) + n).alias("hi"))
    ends = spans.select(F.explode(F.array(reach("a", "begin_a", F.col("chars")), reach("b", "begin_b", F.col("chars")))).alias("x")).select("x.*")
    ends = ends.unionByName(windows.join(others, "p", "left_semi").select(reach("id", "at", F.lit(min_chars)).alias("x")).select("x.*"))
    ends = ends.groupBy("class_id", "lo").agg(F.max("hi").alias("hi"))  # many partners, few distinct begins
    before = Window.partitionBy("class_id").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    covered = ends.withColumn("reach", F.coalesce(F.max("hi").over(before), F.lit(0))).groupBy("class_id").agg(F.sum(F.greatest(F.lit(0), F.col("hi") - F.greatest("lo", "reach"))).alias("covered"))
    copies = members.groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
    by_id = members.join(copies, "class_id").join(covered, "class_id", "left")
    by_id = by_id.select("id", F.when(F.col("n") > 1, F.col("chars")).otherwise(F.coalesce("covered", F.lit(0))).alias("shared_chars"))
    every = df.select(F.col(key).cast("long").alias("id"), F.coalesce(F.length(column), F.lit(0)).alias("chars")).where("id is not null").groupBy("id").agg(F.max("chars").alias("chars"))
    out = every.join(by_id, "id", "left").select(F.col("id").alias(key), F.col("chars").cast("long").alias("chars"), F.coalesce("shared_chars", F.lit(0)).cast("long").alias("shared_chars"))
    return out.withColumn("share", F.coalesce(F.try_divide("shared_chars", "chars"), F.lit(0.0)))
