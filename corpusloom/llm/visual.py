"""One consistent form for text that looks the same (problem 3).

Works on texts exploded to positioned code points (flat arrays with the row of each):

1. join with the decomposition table (full compatibility decomposition, recursive),
2. drop format characters, join with the look-alike table, turn white space into spaces,
3. put combining marks in the order of their class, within each run of marks,
4. recompose canonical pairs, starter by starter, until nothing composes,
5. collapse runs of spaces, trim, and rebuild the strings.

The tables hold one entry per code point of Unicode (built from ``unicodedata``) and the
look-alike rows, so their size is fixed; they are the broadcast side of the joins. The
whole thing is a map over rows without a shuffle.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..runtime import stash
from . import textkernel as K
from .near import spread

_S_BASE, _L_BASE, _V_BASE, _T_BASE, _L_COUNT, _V_COUNT, _T_COUNT = 0xAC00, 0x1100, 0x1161, 0x11A7, 19, 21, 28


class Tables:
    """Decompositions, combining classes, compositions and dropped code points, as arrays."""

    def __init__(self) -> None:
        size = sys.maxunicode + 1
        self.size = np.ones(size, np.int64)
        self.begin = np.arange(size, dtype=np.int64)  # into ``parts``: a code point that doesn't decompose is its own part
        parts = [np.arange(size, dtype=np.int64)]
        end = size
        self.klass = np.zeros(size, np.uint8)
        self.format = np.zeros(size, bool)
        firsts, seconds, made = [], [], []
        for cp in K.ASSIGNED:
            ch = chr(cp)
            if 0xD800 <= cp < 0xE000 or ch.isascii():
                continue
            if c := unicodedata.combining(ch):
                self.klass[cp] = c
            if unicodedata.category(ch) == "Cf":
                self.format[cp] = True
            how = unicodedata.decomposition(ch)
            if how or _S_BASE <= cp < _S_BASE + 11172:
                full = [ord(x) for x in unicodedata.normalize("NFKD", ch)]
                self.begin[cp], self.size[cp] = end, len(full)
                parts.append(np.array(full, np.int64))
                end += len(full)
            if how and "<" not in how and len(pair := how.split()) == 2 and unicodedata.normalize("NFC", ch) == ch:
                firsts.append(int(pair[0], 16)), seconds.append(int(pair[1], 16)), made.append(cp)
        self.parts = np.concatenate(parts)
        key = (np.array(firsts, np.int64) << 32) | np.array(seconds, np.int64)
        order = np.argsort(key)
        self.keys, self.made = key[order], np.array(made, np.int64)[order]

    def compose(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The composition of each pair, or -1."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        out = np.where(self.keys[at] == key, self.made[at], -1)
        lead, vowel = a - _L_BASE, b - _V_BASE
        lv = (lead >= 0) & (lead < _L_COUNT) & (vowel >= 0) & (vowel < _V_COUNT)
        out = np.where(lv, _S_BASE + (lead * _V_COUNT + vowel) * _T_COUNT, out)
        tail, syllable = b - _T_BASE, a - _S_BASE
        lvt = (syllable >= 0) & (syllable < 11172) & (syllable % _T_COUNT == 0) & (tail > 0) & (tail < _T_COUNT)
        return np.where(lvt, a + tail, out)


_shared: list[Tables] = []


def tables() -> Tables:
    if not _shared:
        _shared.append(Tables())
    return _shared[0]


def lookalike_map(pairs: dict[str, str]) -> np.ndarray:
    """The code point every code point counts as. Chains are followed to their end."""
    table = np.arange(sys.maxunicode + 1, dtype=np.int64)
    for seen in pairs:
        plain, met = seen, set()
        while plain in pairs and plain not in met:
            met.add(plain)
            plain = pairs[plain]
        table[ord(seen)] = ord(plain)
    return table


def _reorder(cp: np.ndarray, row: np.ndarray, klass: np.ndarray) -> np.ndarray:
    """Combining marks in the order of their class (stable), between starters."""
    k = klass[cp].astype(np.int64)
    new = (k == 0) | np.concatenate([[True], row[1:] != row[:-1]])
    if not ((k[1:] > 0) & (k[1:] < k[:-1]) & ~new[1:]).any():
        return cp
    return cp[np.lexsort((k, np.cumsum(new)))]


def _recompose(cp: np.ndarray, row: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Canonical composition: each round joins every starter with its next unblocked mark."""
    blocked = np.zeros(len(cp), bool)  # tried with its present starter and did not compose
    while len(cp) > 1:
        k = t.klass[cp].astype(np.int64)
        starter = np.maximum.accumulate(np.where((k == 0) | np.concatenate([[True], row[1:] != row[:-1]]), np.arange(len(cp)), 0))
        base = np.concatenate([[0], starter[:-1]])  # the starter before each code point
        at = np.flatnonzero((row[base] == row) & (np.arange(len(cp)) > 0) & (k[base] == 0) & ~blocked)
        # a mark is blocked by a mark of the same class, or by one of class 0, in between
        before = at - 1
        free = (before == base[at]) | ((k[before] < k[at]) & (k[before] > 0))
        at = at[free]
        made = t.compose(cp[base[at]], cp[at])
        hit = made >= 0
        at, made, owner = at[hit], made[hit], base[at[hit]]
        if not len(at):
            return cp, row
        # one composition per starter and round: the first; a starter that is itself composed now waits
        first = np.concatenate([[True], owner[1:] != owner[:-1]])
        at, made, owner = at[first], made[first], owner[first]
        free = ~np.isin(owner, at)
        at, made, owner = at[free], made[free], owner[free]
        cp = cp.copy()
        cp[owner] = made
        keep = np.ones(len(cp), bool)
        keep[at] = False
        cp, row, blocked = cp[keep], row[keep], blocked[keep]
    return cp, row


def normal_form(text: K.Text, alike: np.ndarray) -> K.Text:
    """The consistent form of every row."""
    t = tables()
    cp = text.cp.astype(np.int64)
    row = np.repeat(np.arange(text.rows), np.diff(text.starts))
    size = t.size[cp]
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(t.begin[cp] - ends + size, size)
    cp, row = t.parts[at], np.repeat(row, size)
    keep = ~t.format[cp]
    cp, row = alike[cp[keep]], row[keep]
    if len(cp):
        cp = _reorder(cp, row, t.klass)
        cp, row = _recompose(cp, row, t)
        cp = alike[cp]  # a composed letter can be a look-alike itself
    space = K.space_table()[cp]
    cp = np.where(space, 0x20, cp)
    if len(cp):
        edge = np.concatenate([[True], row[1:] != row[:-1]])
        keep = ~(space & (edge | np.concatenate([[False], space[:-1]])))  # leading, and all but the first of a run
        cp, row, space = cp[keep], row[keep], space[keep]
        if len(cp):
            keep = ~(space & np.concatenate([row[1:] != row[:-1], [True]]))  # trailing
            cp, row = cp[keep], row[keep]
    starts = np.zeros(text.rows + 1, np.int64)
    np.cumsum(np.bincount(row, minlength=text.rows), out=starts[1:])
    return K.Text(cp.astype(np.uint32), starts)


def _normaliser(column: str, alike: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = lookalike_map(alike)
        for batch in batches:
            for part in K.slices(batch, column):
                values = part.column(column)
                form = normal_form(K.Text.of(values), table)
                joined = form.cp.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                edges = form.starts.tolist()
                null = values.is_null().to_pylist()
                texts = [None if no else joined[a:b] for no, a, b in zip(null, edges, edges[1:])]
                yield pa.RecordBatch.from_arrays([*(c for n, c in zip(part.schema.names, part.columns) if n != column), values, pa.array(texts, pa.string())], [*(n for n in part.schema.names if n != column), column, "same_form"])

    return run


def read_lookalikes(table: DataFrame) -> dict[str, str]:
    """The look-alike table as a map; one code point each way, so at most one entry per code point."""
    rows = table.where("char_length(seen_char) = 1 and char_length(plain_char) = 1 and seen_char <> plain_char").groupBy("seen_char").agg(F.min("plain_char"))
    return {a: b for a, b in rows.collect()}


def normalise(df: DataFrame, lookalikes: DataFrame, key: str = "line_id", column: str = "text") -> DataFrame:
    """(key, text, same_form): each row with its consistent form.

    Null texts stay null, empty and blank ones become empty. Keys are passed as they are.
    """
    kind = df.schema[key].dataType.simpleString()
    return df.select(key, column).mapInArrow(_normaliser(column, read_lookalikes(lookalikes)), f"{key} {kind}, {column} string, same_form string")


def same_looking(df: DataFrame, lookalikes: DataFrame, key: str = "line_id", column: str = "text", min_shown: int = 20) -> DataFrame:
    """(key_a, key_b): rows stored differently that look the same and show ``min_shown`` characters.

    Rows with equal text fold into one class first, so a text repeated many times is
    compared once; a pair of classes is then spelled out as its rows' pairs, or, for very
    large classes, as pairs with the representatives (``near.spread``).
    """
    rows = normalise(df, lookalikes, key, column).where(f"{column} is not null and {key} is not null and char_length(same_form) >= {min_shown}")
    rows = rows.select(F.col(key).cast("long").alias("id"), F.xxhash64("same_form").alias("f1"), F.md5("same_form").alias("f2"), F.md5(column).alias("stored"))
    rows = stash(rows, "p3-forms")
    classes = rows.groupBy("f1", "f2", "stored").agg(F.min("id").alias("class_id"))
    several = classes.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("f1", "f2")
    classes = stash(classes.join(several, ["f1", "f2"], "left_semi"), "p3-classes")
    members = stash(rows.join(classes, ["f1", "f2", "stored"]).select("id", "class_id"), "p3-members")
    links = classes.select("f1", "f2", F.col("class_id").alias("a")).join(classes.select("f1", "f2", F.col("class_id").alias("b")), ["f1", "f2"]).where("a < b").select("a", "b")
    out = spread(links, members, members)
    return out.select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b"))
