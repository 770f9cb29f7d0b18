import unicodedata

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as T

ODD = "ab \t\r\n\x00\x0b\x1c\x1f\x7f\x85\xa0\u200a\u3000 e\u0301\u00e9\u200b\u0c24\u0c48\u0c3f"

# One rule each: composition, control characters, line ends, blanks, lines, empty lines, ends.
CLEANED = [
    ("cafe\u0301", "caf\u00e9"),
    ("\u1100\u1161", "\uac00"),
    ("a\x00b\x0bc\x0cd\x1fe", "abcde"),
    ("keep\x7fthese\x85two", "keep\x7fthese\x85two"),
    ("one\r\ntwo\rthree", "one\ntwo\nthree"),
    ("one \t two\t\tthree\tfour", "one two three four"),
    ("hard\xa0\xa0space", "hard\xa0\xa0space"),
    ("line \n  next\u3000\n\xa0last", "line\nnext\nlast"),
    ("a\n\n\n\nb\n\nc", "a\n\nb\n\nc"),
    ("a\n \t\n\u2003\nb", "a\n\nb"),
    ("\n\n  x  \n\n", "x"),
    (" \t\r\n ", ""),
    ("a\x1c\x1db", "ab"),
    ("zero\u200bwidth", "zero\u200bwidth"),
]


def test_cleaning_rules(frame):
    rows = frame([t for t, _ in CLEANED]).select("ord", T.clean_text("text").alias("c")).orderBy("ord").collect()
    assert [r.c for r in rows] == [want for _, want in CLEANED]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=ODD, max_size=40), min_size=60, max_size=60))
def test_cleaning_properties(spark, frame, texts):
    rows = frame(texts).select("text", T.clean_text("text").alias("c"), T.strip("text").alias("s"), T.words("text").alias("w"))
    for r in rows.select("*", T.clean_text("c").alias("again")).collect():
        assert (r.s, r.w) == (r.text.strip(), r.text.split())
        if not any(ch < " " for ch in r.text):  # a control character can keep a letter and its mark apart
            assert r.again == r.c and unicodedata.is_normalized("NFC", r.c)
        assert "\n\n\n" not in r.c and "  " not in r.c and not any(ch < " " and ch != "\n" for ch in r.c)
        assert all(line == line.strip() for line in r.c.split("\n")) and r.c == r.c.strip()
        dropped = {chr(i) for i in range(32)}
        keep = lambda t: [ch for ch in unicodedata.normalize("NFD", t) if not ch.isspace() and ch not in dropped]  # noqa: B023,E731
        assert keep(r.c) == keep(r.text)  # nothing else is lost, and the order stays


def test_null_and_empty(frame):
    rows = frame([None, "", "   "]).select(T.clean_text("text"), F.size(T.words("text"))).collect()
    assert [r[0] for r in rows] == [None, "", ""]
    assert rows[1][1] == 0


def test_ngrams_and_short_rule(frame):
    rows = frame(["a b c d e f", "one two", "one  two"]).select(T.ngrams(T.words("text")).alias("g"), T.shingle_hashes("text").alias("h")).collect()
    assert rows[0].g == ["a b c d e", "b c d e f"]
    assert rows[1].g == [] and len(rows[1].h) == 1
    assert rows[1].h != rows[2].h  # a short text is hashed as it is


def test_script_range(frame):
    assert [r[0] for r in frame(["నది", "river"]).select(T.has_script("text")).collect()] == [True, False]
