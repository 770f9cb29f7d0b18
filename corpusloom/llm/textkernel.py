"""Columnar text kernels: whole Arrow columns of text as flat NumPy arrays.

A text column becomes one array of code points plus row boundaries. Words, word
hashes and hashes of word runs are then computed for all rows of a slice at once,
with no Python object per word. All hashes are 64-bit and depend only on content.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of UTF-8 handled at once; keeps a worker's arrays at some tens of MB.
SLICE_BYTES = 1 << 21

# The 29 white-space code points of Unicode-aware word splitting.
WHITE_SPACE = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# The planes of Unicode that hold letters, marks, digits and format characters.
ASSIGNED = (*range(0x40000), *range(0xE0000, 0xE1000))

_tables: dict[str, np.ndarray] = {}


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (Steele et al. 2014) over an array."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants from a counter, the same on every machine."""
    return splitmix((np.arange(1, n + 1, dtype=U64) + U64(seed) * U64(1 << 20)) * U64(_BASE)) | U64(1)


def space_table() -> np.ndarray:
    if "space" not in _tables:
        t = np.zeros(0x110000, bool)
        t[WHITE_SPACE] = True
        _tables["space"] = t
    return _tables["space"]


def plain_table() -> np.ndarray:
    """True for letters, combining marks and decimal digits."""
    if "plain" not in _tables:
        cat = unicodedata.category
        t = np.zeros(0x110000, bool)
        t[list(ASSIGNED)] = [(c := cat(chr(i)))[0] in "LM" or c == "Nd" for i in ASSIGNED]
        _tables["plain"] = t
    return _tables["plain"]


def letter_table() -> np.ndarray:
    if "letter" not in _tables:
        cat = unicodedata.category
        t = np.zeros(0x110000, bool)
        t[list(ASSIGNED)] = [cat(chr(i))[0] == "L" for i in ASSIGNED]
        _tables["letter"] = t
    return _tables["letter"]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    have = _tables.get("pow")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        for name, base in (("pow", _BASE), ("inv", _INVERSE)):
            a = np.full(size, U64(base))
            a[0] = 1
            _tables[name] = np.multiply.accumulate(a)
    return _tables["pow"][:n], _tables["inv"][:n]


class Text:
    """Code points of some rows: ``cp`` and the row boundaries ``starts``."""

    def __init__(self, cp: np.ndarray, starts: np.ndarray):
        self.cp, self.starts = cp, starts

    @property
    def rows(self) -> int:
        return len(self.starts) - 1

    @classmethod
    def of(cls, column: pa.Array, lower: bool = False) -> Text:
        """Nulls become empty texts. ``lower``: as ``str.lower`` of each row."""
        if column.null_count:
            column = pc.fill_null(column, "")
        n = len(column)
        if not n:
            return cls(np.zeros(0, np.uint32), np.zeros(1, np.int64))
        wide = pa.types.is_large_string(column.type)
        buffers = column.buffers()
        offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
        raw = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
        try:
            joined = raw.tobytes().decode("utf-8")
        except UnicodeDecodeError:
            edges = (offsets - offsets[0]).tolist()
            blob = raw.tobytes()
            return cls.of_strings([blob[a:b].decode("utf-8", "replace") for a, b in zip(edges, edges[1:])], lower)
        at = offsets - offsets[0]
        if len(joined) != len(raw):
            lead = np.zeros(len(raw) + 1, np.int64)
            np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
            at = lead[at]
        if lower:
            # the only letters whose lower case has another length or depends on its neighbours
            if "İ" in joined or "Σ" in joined:
                edges = at.tolist()
                return cls.of_strings([joined[a:b] for a, b in zip(edges, edges[1:])], True)
            joined = joined.lower()
        return cls(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), at)

    @classmethod
    def of_strings(cls, texts: list[str], lower: bool = False) -> Text:
        if lower:
            texts = [t.lower() for t in texts]
        starts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=starts[1:])
        return cls(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4"), starts)

    def hashed(self) -> np.ndarray:
        """Prefix sums of the polynomial hash; ``span_hash`` reads any stretch from them."""
        n = len(self.cp)
        power, _ = powers(n)
        out = np.zeros(n + 1, U64)
        np.cumsum(splitmix((self.cp.astype(U64) + U64(1)) * U64(_BASE)) * power, out=out[1:])
        return out

    def words(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of kept code points: begins, ends, and word boundaries of rows."""
        n = len(self.cp)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(self.rows + 1, np.int64)
        before, after = np.empty(n, bool), np.empty(n, bool)
        before[0] = after[-1] = False
        before[1:], after[:-1] = keep[:-1], keep[1:]
        inner = self.starts[(self.starts > 0) & (self.starts < n)]
        before[inner] = False
        after[inner - 1] = False
        begins = np.flatnonzero(keep & ~before)
        ends = np.flatnonzero(keep & ~after) + 1
        return begins, ends, np.searchsorted(begins, self.starts)


def span_hash(prefix: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [begin, end); equal content gives equal hashes."""
    _, inverse = powers(len(prefix))
    return splitmix((prefix[ends] - prefix[begins]) * inverse[begins] + (ends - begins).astype(U64))


def stored_words(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words as stored, and the rows' boundaries among them."""
    begins, ends, edges = text.words(~space_table()[text.cp])
    return span_hash(text.hashed(), begins, ends), edges


def plain_words(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the plain words of an already lower-cased text, and the rows' boundaries."""
    begins, ends, edges = text.words(plain_table()[text.cp])
    return span_hash(text.hashed(), begins, ends), edges


def runs(words: np.ndarray, edges: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` consecutive words within rows, and the rows' boundaries."""
    sizes = np.maximum(np.diff(edges) - n + 1, 0)
    bounds = np.zeros(len(edges), np.int64)
    np.cumsum(sizes, out=bounds[1:])
    total = len(words) - n + 1
    if total <= 0 or not bounds[-1]:
        return np.zeros(0, U64), bounds
    factors = constants(n, 77)
    mixed = words[:total] * factors[0]
    for j in range(1, n):
        mixed += words[j : total + j] * factors[j]
    row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    return splitmix(mixed[row[:total] == row[n - 1 :]]), bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, and the new boundaries."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    edges = np.zeros(len(bounds), np.int64)
    np.cumsum(np.bincount(row[first], minlength=len(bounds) - 1), out=edges[1:])
    return values[first], edges


def sequence_keys(words: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each row's sequence of words."""
    power, inverse = powers(len(words) + 1)
    out = []
    for k, seed in enumerate((3, 5)):
        prefix = np.zeros(len(words) + 1, U64)
        mixed = splitmix(words * constants(1, seed)[0] + U64(k))
        np.cumsum(mixed * power[: len(words)], out=prefix[1:])
        out.append(splitmix((prefix[edges[1:]] - prefix[edges[:-1]]) * inverse[edges[:-1]] + np.diff(edges).astype(U64)))
    return out[0], out[1]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose text is about ``size`` bytes; a longer text is a part of its own."""
    array = batch.column(column)
    lengths = np.asarray(pc.fill_null(pc.binary_length(array), 0).cast(pa.int64()))
    total = np.cumsum(lengths)
    begin = 0
    while begin < len(total):
        base = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, base + size, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def int64s(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def int_lists(values: np.ndarray, edges: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow list column from flat values and boundaries."""
    flat = int64s(values) if kind is None else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), flat)
