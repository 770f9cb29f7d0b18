"""Language of documents and of their segments (problem 5).

Training: the n-grams of labelled samples go into Bloom filters that are sliced by bit:
slot i of one array holds, in bit l, slot i of language l's filter. One lookup of an
n-gram (the AND of its slots) returns the mask of all languages that may contain it.

Detection: per word, sentence and text the set bits are counted by language and corrected
for the filter's false positives, (hits - grams x rate) / grams (1 - rate). A word's score
for a language is its own corrected share plus those of its sentence and its text, over the
languages that write in the word's block of characters; the largest score decides, so an
English word within a Telugu sentence counts as English, and a word that both Hindi and
Marathi have goes with its sentence. Neighbouring words of one language are joined to
segments. The confidence is the share of the best score in the two best.

N-grams are of ``GRAM`` characters over the lower-case letters and marks with one blank
between words, and whole words. The filters' size is a parameter and is what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import textkernel as K

GRAM, SLOT_BITS, HASHES = 4, 20, 2
#: At most so many samples of a language are read for training (documented bound; the table has 40 each).
SAMPLES_PER_LANGUAGE = 2000

# Characters that end a segment.
_ENDERS = ".!?\n\r।॥  "

_tables: dict[str, np.ndarray] = {}


def _word_table() -> np.ndarray:
    """Letters and combining marks."""
    if "word" not in _tables:
        digits = np.zeros(0x110000, bool)
        digits[[i for i in K.ASSIGNED if chr(i).isdecimal()]] = True
        _tables["word"] = K.plain_table() & ~digits
    return _tables["word"]


def _grams(text: K.Text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams within words (blanks around them included) and of the words;
    the word of each; the words' begins and ends."""
    cp = text.cp
    keep = _word_table()[cp]
    begins, ends, _ = text.words(keep)
    if not len(begins):
        return np.zeros(0, K.U64), np.zeros(0, np.int64), begins, ends
    lengths = ends - begins
    place = np.cumsum(lengths + 1) - lengths  # of each word's first letter in a stream with one blank around words
    stream = np.full(int(place[-1] + lengths[-1] + 1), 0x20, np.int64)
    inner = np.flatnonzero(keep)
    stream[np.arange(len(inner)) + np.repeat(place - (np.cumsum(lengths) - lengths), lengths)] = cp[inner]
    n = len(stream) - GRAM + 1
    grams, owner = np.zeros(0, K.U64), np.zeros(0, np.int64)
    if n > 0:
        c = K.constants(GRAM, 41)
        x = stream.astype(K.U64)
        grams = x[:n] * c[0]
        for j in range(1, GRAM):
            grams += x[j : n + j] * c[j]
        blank = stream == 0x20
        within = ~blank[1 : n + 1]
        for j in range(2, GRAM - 1):
            within &= ~blank[j : n + j]
        at = np.flatnonzero(within)
        grams, owner = K.splitmix(grams[at]), np.searchsorted(place, at + 1, "right") - 1
    words = K.span_hash(text.hashed(), begins, ends) ^ K.U64(0x5DEECE66D)
    return np.concatenate([grams, words]), np.concatenate([owner, np.arange(len(begins))]), begins, ends


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    return [((grams >> K.U64(SLOT_BITS * i)) & K.U64((1 << SLOT_BITS) - 1)).astype(np.int64) for i in range(HASHES)]


@dataclass
class Filters:
    """Bit-sliced Bloom filters of some languages, and each one's rate of false positives."""

    languages: list[str]
    slots: np.ndarray
    rates: np.ndarray
    blocks: np.ndarray  # per block of 128 code points the mask of languages that write in it

    @classmethod
    def train(cls, samples: list[tuple[str, str]]) -> Filters:
        languages = sorted({lang for lang, _ in samples})
        if len(languages) > 64:
            raise ValueError("at most 64 languages")
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(k).bits >= max(1, len(languages)))
        slots, blocks = np.zeros(1 << SLOT_BITS, kind), np.zeros(0x110000 >> 7, kind)
        for i, lang in enumerate(languages):
            text = K.Text.of_strings([t for name, t in samples if name == lang], lower=True)
            grams, _, begins, _ = _grams(text)
            # a block counts as the language's where at least a twentieth of its words begin there
            count = np.bincount(text.cp[begins] >> 7, minlength=len(blocks))
            blocks[count * 20 >= max(1, len(begins))] |= kind(1 << i)
            for s in _slots(grams):
                slots[s] |= kind(1 << i)
        rates = np.array([(((slots >> kind(i)) & kind(1)).mean()) ** HASHES for i in range(len(languages))])
        return cls(languages, slots, rates, blocks)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """Per n-gram the mask of languages that may contain it."""
        first, *rest = _slots(grams)
        out = self.slots[first]
        for s in rest:
            out = out & self.slots[s]
        return out


def segments(text: K.Text, filters: Filters) -> tuple[np.ndarray, ...]:
    """Joined segments of all rows: row, begin, end (in the row), letters, language (-1: none), confidence."""
    n, count = len(text.cp), len(filters.languages)
    grams, owner, begins, ends = _grams(text)
    if not len(begins):
        return tuple(np.zeros(0, np.int64) for _ in range(5)) + (np.zeros(0),)
    ender = np.zeros(n + 1, np.int64)
    np.cumsum(np.isin(text.cp, [ord(c) for c in _ENDERS]), out=ender[1:])
    row = np.searchsorted(text.starts, begins, "right") - 1
    fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (ender[begins[1:]] != ender[begins[:-1]])])
    sentence = np.cumsum(fresh) - 1
    masks = filters.masks(grams)
    tested = np.bincount(owner, minlength=len(begins))
    of_sentence, of_row = np.bincount(sentence, weights=tested), np.maximum(np.bincount(row, weights=tested, minlength=text.rows), 1)
    block = filters.blocks[(text.cp[begins] >> 7).astype(np.int64)]
    kind = masks.dtype.type
    scores = np.empty((count, len(begins)))
    for i, rate in enumerate(filters.rates):
        bit = ((masks >> kind(i)) & kind(1)).astype(bool)
        hits = np.bincount(owner[bit], minlength=len(begins))
        share = lambda h, t: np.maximum((h - t * rate) / (t * (1 - rate)), 0)  # noqa: B023,E731
        near = share(np.bincount(sentence, weights=hits), of_sentence)[sentence]
        far = share(np.bincount(row, weights=hits, minlength=text.rows), of_row)[row]
        scores[i] = share(hits, tested) + 2 * near + 0.5 * far
        scores[i][(block != 0) & ((block >> kind(i)) & kind(1) == 0)] = 0
    best = scores.argmax(0)
    each = np.arange(len(begins))
    top = scores[best, each]
    scores[best, each] = 0
    lang = np.where(top > 0.02, best, -1)
    sure = np.where(lang >= 0, top / np.maximum(top + scores.max(0), 1e-9), 0)
    total = np.zeros(n + 1, np.int64)
    np.cumsum(K.letter_table()[text.cp], out=total[1:])
    letters = total[ends] - total[begins]
    new = np.flatnonzero(np.concatenate([[True], (lang[1:] != lang[:-1]) | (row[1:] != row[:-1])]))
    first = np.concatenate([[True], row[new[1:]] != row[new[:-1]]])
    base, stop = text.starts[row[new]], text.starts[row[new] + 1]
    at = np.where(first, base, begins[new])  # the stretches of a text cover it
    until = np.where(np.append(first[1:], True), stop, np.append(at[1:], n))
    weight = np.add.reduceat(letters, new)
    return row[new], at - base, until - base, weight, lang[new], np.add.reduceat(sure * letters, new) / np.maximum(weight, 1)


def _detector(shared, key: str, column: str, passed: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: Filters = shared.value
        names = pa.array([*filters.languages, None], pa.string())
        for batch in batches:
            for part in K.slices(batch, column):
                # the one letter whose lower case is two code points counts as its plain form, so positions are those of the stored text
                stored = pc.replace_substring(part.column(column), "İ", "i")
                row, begin, end, letters, lang, sure = segments(K.Text.of(stored, lower=True), filters)
                at = pa.array(row.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key).take(at),
                        *(part.column(c).take(at) for c in passed),
                        pa.array(begin.astype(np.int32)),
                        pa.array(end.astype(np.int32)),
                        pa.array(letters.astype(np.int32)),
                        names.take(pa.array(np.where(lang < 0, len(filters.languages), lang))),
                        pa.array(np.round(sure, 6)),
                    ],
                    [key, *passed, "begin", "end", "letters", "lang_found", "confidence"],
                )

    return run


def train(samples: DataFrame) -> Filters:
    """Filters from (lang, text) rows; at most ``SAMPLES_PER_LANGUAGE`` rows of a language, the smallest ids."""
    from pyspark.sql import Window

    numbered = samples.where("lang is not null and text is not null").withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("sample_id")))
    return Filters.train([(r[0], r[1]) for r in numbered.where(F.col("_n") <= SAMPLES_PER_LANGUAGE).select("lang", "text").collect()])


def language_segments(df: DataFrame, filters: Filters, key: str = "doc_id", column: str = "text", passed: tuple[str, ...] = ()) -> DataFrame:
    """(key, *passed, begin, end, letters, lang_found, confidence): the stretches of one language.

    Positions are code points; the stretches of a text cover it. ``lang_found`` is null
    where nothing tells a language (digits, symbols). Null and empty texts have no row.
    """
    shared = df.sparkSession.sparkContext.broadcast(filters)
    types = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in (key, *passed))
    rows = df.select(key, *passed, column).where(F.length(column) > 0)
    return rows.mapInArrow(_detector(shared, key, column, list(passed)), f"{types}begin int, end int, letters int, lang_found string, confidence double")


def document_languages(df: DataFrame, filters: Filters, key: str = "doc_id", column: str = "text", label: str = "lang", min_letters: int = 40, min_share: float = 0.1) -> DataFrame:
    """(key, label, found_lang, share, confidence, n_langs): each language with ``min_share`` of a document's letters.

    Documents under ``min_letters`` letters have no row. Repeated keys count as one document.
    """
    parts = language_segments(df, filters, key, column, (label,))
    per = parts.groupBy(key, label, "lang_found").agg(F.sum("letters").alias("letters"), F.sum(F.col("letters") * F.col("confidence")).alias("sure"))
    # all parts of a document are sums over its own few languages
    docs = per.groupBy(key, label).agg(F.sum("letters").alias("total"), F.collect_list(F.struct("lang_found", "letters", "sure")).alias("langs")).where(F.col("total") >= min_letters)
    held = F.filter("langs", lambda x: x["lang_found"].isNotNull() & (x["letters"] >= F.lit(min_share) * F.col("total")))
    docs = docs.select(key, label, "total", held.alias("langs"))
    return docs.select(key, F.col(label).alias("label"), "total", F.size("langs").alias("n_langs"), F.explode("langs").alias("x")).select(
        key, "label", F.col("x.lang_found").alias("found_lang"), (F.col("x.letters") / F.col("total")).alias("share"), (F.col("x.sure") / F.col("x.letters")).alias("confidence"), "n_langs"
    )


def wrong_labels(df: DataFrame, filters: Filters, key: str = "doc_id", column: str = "text", label: str = "lang") -> DataFrame:
    """(key, found_lang): the languages of documents whose label is not exactly their only language."""
    found = document_languages(df, filters, key, column, label)
    right = (F.col("n_langs") == 1) & F.col("label").eqNullSafe(F.col("found_lang"))
    return found.where(~right).select(key, "found_lang")
