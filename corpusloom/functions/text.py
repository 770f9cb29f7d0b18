"""Scalar text functions as Catalyst expressions; Arrow only where Spark has no function."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# The 29 code points that Python's str.strip and \s count as white space,
# as a character class both Java's and RE2's patterns accept.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
TELUGU = (0x0C00, 0x0C7F)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without Unicode white space at both ends. Null stays null."""
    return F.btrim(_col(c), F.lit(_SPACES))


# SPACE without the line feed.
INLINE = r"\t\x0b-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


@F.pandas_udf(StringType())
def _nfc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([t if t is None else unicodedata.normalize("NFC", t) for t in texts], index=texts.index, dtype=object)


# marked so that the optimizer, which moves filters below projections, does not evaluate it twice
_nfc = _nfc.asNondeterministic()


def nfc(c: Column | str) -> Column:
    """Canonical composition. ASCII texts, which it cannot change, are not sent to Python."""
    c = _col(c)
    return F.coalesce(_nfc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def clean_text(c: Column | str) -> Column:
    """A document in one regular form: composed, without control characters, one kind of
    line end, single blanks, stripped lines, at most one empty line in a row. Null stays null."""
    t = F.regexp_replace(nfc(c), CONTROL, "")
    t = F.replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    t = F.regexp_replace(t, r" [ \t]++|\t[ \t]*+", " ")  # a single blank stays as it is
    t = F.regexp_replace(t, rf"[{INLINE}]++\n[{INLINE}]*+|\n[{INLINE}]++", "\n")
    return strip(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def words(c: Column | str) -> Column:
    """The maximal runs without white space, in order; an empty array for a blank text."""
    return F.regexp_extract_all(_col(c), F.lit(f"[^{SPACE}]+"), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it, also within lambdas."""
    return F.transform(F.array(value), body)[0]


def _ngrams(w: Column, n: int) -> Column:
    grams = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.when(F.size(w) >= n, grams).otherwise(F.array().cast("array<string>"))


def ngrams(w: Column, n: int = 5) -> Column:
    """All runs of ``n`` neighbouring elements joined by one blank; none if there are fewer."""
    if n < 1:
        raise ValueError("n must be positive")
    return let(w, lambda x: _ngrams(x, n))


def md5_hash(c: Column) -> Column:
    """The first 32 bits of the MD5 digest as a number."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")


def shingle_hashes(text: Column | str, n: int = 5) -> Column:
    """Distinct 32-bit hashes of a text's runs of ``n`` words; a shorter text is one shingle, as it is."""
    text = _col(text)
    units = let(words(text), lambda w: F.when(F.size(w) >= n, _ngrams(w, n)).otherwise(F.array(text)))
    return F.array_distinct(F.transform(units, md5_hash))


def has_script(c: Column | str, first: int = TELUGU[0], last: int = TELUGU[1]) -> Column:
    """Whether any character lies in the range of code points."""
    return _col(c).rlike(rf"[\x{{{first:X}}}-\x{{{last:X}}}]")


def file_stem(name: str) -> str:
    """A data set's name as a file name."""
    return name.replace("/", "_")
