"""Encoding a whole corpus with a public tokenizer (problem 8).

A text is cut before every single space that stands between two other characters; no
piece of the tokenizer crosses such a cut. The parts repeat heavily, so a worker keeps
the ids of the parts it has met and only new parts are split into pieces and encoded:
greedy longest matches are proposed, all adjacent pairs are tested at once, and only
pieces with an incompatible pair go through exact merging. Rows are then gathered from
the flat store of ids. There is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textkernel as K
from .bpe import Encoder, Merges, merges_path

#: Ids and parts a worker remembers before it starts afresh; results don't depend on it.
MEMORY_IDS, MEMORY_PARTS = 6_000_000, 600_000


class _Memory:
    """Ids of parts. ``("x",)`` is a text's first part, ``"x"`` a later one: a space and x."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.clear()

    def clear(self) -> None:
        self.number: dict = {}
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def learn(self, keys: list) -> None:
        """Encode parts that are not known yet. Parts with white space at an edge get length -1."""
        pieces: dict[bytes, int] = {}
        parts: list[list[int] | None] = []
        for key in keys:
            if isinstance(key, str):
                part = None if not key or key[0].isspace() or key[-1].isspace() else " " + key
            else:
                part = key[0] if len(key) == 2 or not (key[0][-1:].isspace() or not key[0]) else None
            parts.append(None if part is None else [pieces.setdefault(p.encode("utf-8", "surrogatepass"), len(pieces)) for p in self.encoder.split(part)])
        ids, bounds = self.encoder.encode_pieces(list(pieces))
        lengths = np.array([-1 if p is None else sum(int(bounds[i + 1] - bounds[i]) for i in p) for p in parts], np.int64)
        new = np.concatenate([np.zeros(0, np.int64), *(ids[bounds[i] : bounds[i + 1]] for p in parts if p for i in p)]).astype(np.int32)
        begins = len(self.ids) + np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))[:-1]]).astype(np.int64)
        base = len(self.begin)
        self.number.update(zip(keys, range(base, base + len(keys))))
        self.begin, self.length = np.concatenate([self.begin, begins]), np.concatenate([self.length, lengths])
        self.ids = np.concatenate([self.ids, new])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and boundaries of the texts."""
        if len(self.ids) > MEMORY_IDS or len(self.number) > MEMORY_PARTS:
            self.clear()
        keys: list = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                words = text.split(" ")
                words[0] = (words[0],)
                counts[i] = len(words)
                keys += words
        get = self.number.get
        number = list(map(get, keys))
        if None in number:
            self.learn(list({k for k, v in zip(keys, number) if v is None}))
            number = list(map(self.number.__getitem__, keys))
        number = np.array(number, np.int64)
        # texts with runs of white space around a cut are encoded whole
        owner = np.repeat(np.arange(len(texts)), counts)
        odd = np.unique(owner[self.length[number] < 0])
        if len(odd):
            whole = [(texts[i], int(i)) for i in odd]
            keep = np.ones(len(texts), bool)
            keep[odd] = False
            known = (len(self.begin), len(self.ids))
            self.learn(whole)
            again = np.array([self.number.pop(k) for k in whole], np.int64)
            number = np.concatenate([number[keep[owner]], again])
            owner = np.concatenate([owner[keep[owner]], odd])
            order = np.argsort(owner, kind="stable")
            number, owner = number[order], owner[order]
            out = self._gather(number, owner, len(texts))
            self.begin, self.length, self.ids = self.begin[: known[0]], self.length[: known[0]], self.ids[: known[1]]
            return out
        return self._gather(number, owner, len(texts))

    def _gather(self, number: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        length = self.length[number]
        total = np.cumsum(length)
        at = np.arange(total[-1] if len(total) else 0) + np.repeat(self.begin[number] - total + length, length)
        bounds = np.zeros(rows + 1, np.int64)
        np.cumsum(np.bincount(owner, weights=length, minlength=rows).astype(np.int64), out=bounds[1:])
        return self.ids[at], bounds


_worker: list[tuple[Merges, _Memory]] = []


def _memory(merges: Merges) -> _Memory:
    """The memory of this worker process for a vocabulary; tasks that follow one another share it."""
    if not _worker or _worker[0][0] is not merges:
        _worker[:] = [(merges, _Memory(Encoder(merges)))]
    return _worker[0][1]


def _encoder(shared, key: str, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(shared.value)
        for batch in batches:
            for part in K.slices(batch, column):
                ids, bounds = memory.encode(part.column(column).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(key), K.int_lists(ids, bounds, pa.int32())], [key, "ids"])

    return run


def encode(df: DataFrame, key: str = "doc_id", column: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(key, ids): the ids of each text without special tokens, one row per row of ``df``.

    Null and empty texts have an empty list; strings that spell special tokens are ordinary
    text. Null keys and repeated rows are kept as they are. ``tokenizer``: path of a
    byte-level vocabulary file; it is read on the driver and broadcast (its size is fixed).
    """
    merges = df.sparkSession.sparkContext.broadcast(Merges(tokenizer or merges_path()))
    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(column)).mapInArrow(_encoder(merges, key, column), f"{key} {kind}, ids array<int>")
