"""Evaluation texts leaking into training text: a distributed positional index (problem 9).

The training text is indexed once, in segments of about two megabytes of text: for every
term the sorted list of its positions in the segment, with the documents' word boundaries.
A segment is one row; its terms are partitioned by hash into ``PARTS`` groups of columns,
so a search reads only the columns of the groups in which its terms lie. The index is a
table in a shared folder (``LeakIndex``): it is built once, appended to as documents come,
opened again by path, and searched any number of times without the text.

Search: every run of ``n`` test words is a phrase. In each segment the list of its rarest
term (by count over all segments) is shifted by the term's offset in the phrase, and
intersected with the shifted lists of its other terms, rarest first; what is left are the
phrase's exact starts. With ``slack`` a term may stand that many words off its place,
which gives proximity matches. Documents lie ``GAP`` positions apart, so no match crosses
from one into the next.

The items are a stated query set: they are searched in blocks of at most ``BLOCK_WORDS``
words, so what is broadcast is bounded whatever the number of items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..runtime import drop_path, temporary_path
from . import textkernel as K

GAP, BLOCK_WORDS, PART_BITS = 64, 2_000_000, 4
PARTS = 1 << PART_BITS
#: Bytes of a row group: some ten segments, as readers decode a group at a time.
ROW_GROUP = 32 << 20
_LISTS = ("terms", "counts", "positions")
#: docs, starts: the segment's documents and their first positions; per part the terms (64-bit hashes), their counts and positions.
SEGMENT = "docs array<long>, starts array<int>, " + ", ".join(f"terms_{p} array<long>, counts_{p} array<int>, positions_{p} array<int>" for p in range(PARTS))


def _phrases(items: list[tuple[int, str]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted term hashes; phrases as rows of term numbers; the item of each phrase."""
    words, edges = K.plain_words(K.Text.of_strings([t for _, t in items], lower=True))
    sizes = np.maximum(np.diff(edges) - n + 1, 0)
    starts = np.arange(sizes.sum()) + np.repeat(edges[:-1] - (np.cumsum(sizes) - sizes), sizes)
    used = words[starts[:, None] + np.arange(n)] if len(starts) else np.zeros((0, n), K.U64)
    terms, number = np.unique(used, return_inverse=True)
    return terms, number.reshape(-1, n), np.repeat(np.array([i for i, _ in items], np.int64), sizes)


def _indexer(key: str, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.slices(batch, column):
                words, edges = K.plain_words(K.Text.of(part.column(column), lower=True))
                position = np.arange(len(words)) + np.repeat(np.arange(part.num_rows), np.diff(edges)) * GAP
                order = np.argsort(words, kind="stable")  # positions stay sorted within a term
                words, position = words[order], position[order].astype(np.int32)
                first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
                counts = np.diff(np.append(first, len(words))).astype(np.int32)
                terms = words[first]
                cut = np.searchsorted(terms, _borders())
                at = np.append(first, len(words))
                rows = [(np.asarray(part.column(key)).astype(np.int64), (edges + np.arange(len(edges)) * GAP).astype(np.int32))]
                rows += [(terms[a:b].view(np.int64), counts[a:b], position[at[a] : at[b]]) for a, b in zip(cut, np.append(cut[1:], len(terms)))]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.list_(pa.from_numpy_dtype(x.dtype))) for r in rows for x in r], _names(range(PARTS)))

    return run


def _borders() -> np.ndarray:
    """The first term of each part."""
    return np.arange(PARTS, dtype=K.U64) << K.U64(64 - PART_BITS)


def _names(parts) -> list[str]:  # noqa: ANN001
    return ["docs", "starts", *(f"{c}_{p}" for p in parts for c in _LISTS)]


def _lists(batch: pa.RecordBatch, i: int, names: list[str]) -> list[np.ndarray]:
    return [batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in names]


def _counter(shared, parts: list[int]):
    """Counts of the searched terms by segment: (term, n), the number of a term and its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: np.ndarray = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                for p in parts:
                    terms, counts = _lists(batch, i, [f"terms_{p}", f"counts_{p}"])
                    if len(terms):
                        terms = terms.view(K.U64)
                        at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
                        total += np.where(terms[at] == wanted, counts[at], 0)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["term", "n"])

    return run


def _searcher(shared, parts: list[int], slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, phrases, items, order = shared.value  # order: each phrase's offsets, rarest term first
        n = phrases.shape[1]
        lines = np.arange(len(phrases))
        for batch in batches:
            for i in range(batch.num_rows):
                docs, starts = _lists(batch, i, ["docs", "starts"])
                known, counts, positions = [], [], []
                for p in parts:
                    t, c, x = _lists(batch, i, [f"{k}_{p}" for k in _LISTS])
                    at = np.flatnonzero(np.isin(t.view(K.U64), wanted, assume_unique=True))
                    ends = np.cumsum(c.astype(np.int64))
                    size = c[at].astype(np.int64)
                    total = np.cumsum(size)
                    known.append(t[at].view(K.U64)), counts.append(size)
                    positions.append(x[np.arange(total[-1] if len(at) else 0) + np.repeat(ends[at] - total, size)])
                terms = np.searchsorted(wanted, np.concatenate(known))  # ascending, as the parts are
                if not len(terms):
                    continue
                counts, positions = np.concatenate(counts), np.concatenate(positions).astype(np.int64)
                ends = np.cumsum(counts)
                lists = (np.repeat(terms, counts) << 32) | positions
                offset = order[:, 0]
                rare = phrases[lines, offset]
                at = np.minimum(np.searchsorted(terms, rare), len(terms) - 1)
                size = np.where(terms[at] == rare, counts[at], 0)
                phrase = np.repeat(lines, size)
                total = np.cumsum(size)
                start = positions[np.arange(len(phrase)) + np.repeat(ends[at] - counts[at] - total + size, size)] - offset[phrase]
                for k in range(1, n):
                    if not len(phrase):
                        break
                    offset = order[phrase, k]
                    place = (phrases[phrase, offset] << 32) + start + offset
                    near = np.searchsorted(lists, place - slack)
                    ok = lists[np.minimum(near, len(lists) - 1)] <= place + slack
                    ok &= near < len(lists)
                    phrase, start = phrase[ok], start[ok]
                if len(phrase):
                    row = np.searchsorted(starts, start + order[phrase, 0], "right") - 1
                    found, where = np.unique(np.stack([row, items[phrase]]), axis=1, return_inverse=True)
                    hits = np.bincount(where.reshape(-1), minlength=found.shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(docs[found[0]]), pa.array(found[1]), pa.array(hits)], ["doc_id", "item_id", "hits"])

    return run


class LeakIndex:
    """The stored postings of a training corpus, in the table of segments at ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        """Opens the index at ``path``, or names a new one in the session's shared folder."""
        self.spark, self.path = spark, path or temporary_path(spark, "leak-index")

    def add(self, documents: DataFrame, key: str = "doc_id", column: str = "text") -> LeakIndex:
        """Index more documents. Null keys and texts are left out; a key added twice is two documents."""
        docs = documents.select(F.col(key).cast("long").alias(key), column).where(f"{key} is not null and {column} is not null")
        docs.mapInArrow(_indexer(key, column), SEGMENT).write.mode("append").option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(self.path)
        return self

    def segments(self) -> DataFrame:
        return self.spark.read.schema(SEGMENT).parquet(self.path)

    def drop(self) -> None:
        drop_path(self.spark, self.path)

    def search(self, items: DataFrame, n: int = 8, slack: int = 0, key: str = "item_id", column: str = "text") -> DataFrame:
        """(doc_id, item_id, hits): documents with runs of ``n`` plain words of an item, and how many.

        ``slack`` 0: the words stand side by side, exactly; otherwise each may be up to
        ``slack`` words off (proximity). Null keys and texts, and items under ``n`` plain
        words, match nothing. No items or an empty index: no rows.
        """
        if 2 * slack >= GAP:
            raise ValueError(f"slack must be under {GAP // 2}")
        sc, index = self.spark.sparkContext, self.segments()
        tests = items.select(F.col(key).cast("long").alias("item"), F.col(column).alias("text")).where("item is not null and text is not null")
        words = tests.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
        blocks = max(1, -(-words // (2 * BLOCK_WORDS)))  # a word and its blank are two characters or more
        out = self.spark.createDataFrame([], "doc_id long, item_id long, hits long")
        for block in range(blocks):
            part = [(r[0], r[1]) for r in tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()]
            terms, phrases, owner = _phrases(part, n)
            if not len(phrases):
                continue
            parts = np.unique(terms >> K.U64(64 - PART_BITS)).astype(int).tolist()
            counted = index.select(*(f"{c}_{p}" for p in parts for c in _LISTS[:2])).mapInArrow(_counter(sc.broadcast(terms), parts), "term int, n long").groupBy("term").agg(F.sum("n"))
            frequency = np.zeros(len(terms), np.int64)
            for term, count in counted.collect():  # one row per test term of this block at most
                frequency[term] = count
            order = np.argsort(frequency[phrases], axis=1, kind="stable")
            query = sc.broadcast((terms, phrases.astype(np.int64), owner, order))
            out = out.unionByName(index.select(*_names(parts)).mapInArrow(_searcher(query, parts, slack), "doc_id long, item_id long, hits long"))
        return out


def passages(documents: DataFrame, items: DataFrame, n: int = 8, slack: int = 0, key: str = "doc_id", column: str = "text", item_key: str = "item_id", item_column: str = "text") -> DataFrame:
    """``LeakIndex.search`` in an index of ``documents`` that is made for this call and goes with the application.

    (doc_id, item_id, hits); repeated keys are reported once per row.
    """
    index = LeakIndex(documents.sparkSession).add(documents, key, column)
    return index.search(items, n, slack, item_key, item_column)
