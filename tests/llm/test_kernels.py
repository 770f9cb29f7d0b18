import unicodedata

import numpy as np
import pyarrow as pa
import regex
from hypothesis import given, settings, strategies as st

from corpusloom.llm import bpe, encode, textkernel as K, visual

ODD = st.text(alphabet="aAbİΣς éÉ \t\n\x1c\x85\xa0　​నక్0٣1²'.,😀ー", max_size=40)


def split(values, edges):
    return [values[a:b].tolist() for a, b in zip(edges, edges[1:])]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), ODD), max_size=12))
def test_words_and_runs(texts):
    column = pa.array(["skip", *texts, "skip"], pa.string()).slice(1, len(texts))
    plain = [t or "" for t in texts]
    for words, keep in ((K.stored_words(K.Text.of(column)), [t.split() for t in plain]), (K.plain_words(K.Text.of(column, lower=True)), [regex.sub(r"[^\p{L}\p{M}\p{Nd}]", " ", t.lower()).split() for t in plain])):
        values, edges = words
        assert np.diff(edges).tolist() == [len(w) for w in keep]
        names = {}
        for word, h in zip((w for ws in keep for w in ws), values.tolist()):
            assert names.setdefault(word, h) == h  # equal words, equal hashes
        assert len(set(names.values())) == len(names)
        grams, bounds = K.runs(values, edges, 2)
        assert np.diff(bounds).tolist() == [max(0, len(w) - 1) for w in keep]
        flat, at = K.distinct(grams, bounds)
        assert [len(x) for x in split(flat, at)] == [len({tuple(w[i : i + 2]) for i in range(len(w) - 1)}) for w in keep]


def test_slices_cover_long_texts():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 50, None, "b", "", "c" * 500, "d"])], ["t"])
    parts = list(K.slices(batch, "t", 60))
    assert sum(p.num_rows for p in parts) == 6 and len(parts) == 3


def test_surrogate_bytes_do_not_crash():
    column = pa.Array.from_buffers(pa.string(), 2, [None, pa.py_buffer(np.array([0, 2, 4], np.int32)), pa.py_buffer(b"a\xffbc")])
    assert K.Text.of(column).rows == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aé゙̀́かカｶﾞ가각ᄀ​­\xa0 \tﬁẠ̧̊dḋ᠋𝐀", max_size=20), min_size=1, max_size=10))
def test_normal_form_equals_unicodedata(texts):
    form = visual.normal_form(K.Text.of_strings(texts), visual.lookalike_map({}))
    joined = form.cp.astype("<u4").tobytes().decode("utf-32-le")
    for i, t in enumerate(texts):
        kept = "".join(c for c in unicodedata.normalize("NFKD", t) if unicodedata.category(c) != "Cf")
        assert joined[form.starts[i] : form.starts[i + 1]] == " ".join(unicodedata.normalize("NFC", kept).split())


def test_lookalikes_under_accents():
    form = visual.normal_form(K.Text.of_strings(["сѐll"]), visual.lookalike_map({"с": "c", "е": "e", "x": "y", "y": "x"}))
    assert form.cp.astype("<u4").tobytes().decode("utf-32-le") == "cèll"


MERGES = bpe.Merges(bpe.merges_path())


def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.merges_path())
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


WANT = reference()
MEMORY = encode._Memory(bpe.Encoder(MERGES))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="abest ing'l  \n\t\x1c\x85\xa0　0٣²éÉ😀క్న.,!-<|>", max_size=60), min_size=1, max_size=8))
def test_ids_equal_the_tokenizer(texts):
    ids, bounds = MEMORY.encode([*texts, None])
    assert split(ids, bounds) == [*map(WANT, texts), []]


def test_ids_of_hard_texts():
    rng = np.random.default_rng(3)
    texts = ["a" * 3000, " " * 500, "=- " * 400, "<|endoftext|>", "the" * 40 + "ing" * 40, "".join(map(chr, rng.integers(97, 123, 20_000))), "x  y", " x", "x ", "same", "same"]
    ids, bounds = MEMORY.encode(texts)
    assert split(ids, bounds) == [WANT(t) for t in texts]
    assert MEMORY.encoder.exact > 0


def test_merge_rounds_equal_the_tokenizer():
    words = ["hello", "aaaaa", "aaaaaa", "నది", "zzzzzzzzzzz", "thethe"]
    ids, bounds = MERGES.merge_rounds([w.encode() for w in words])
    assert split(ids, bounds) == [WANT(w) for w in words]
    assert MERGES.merge_rounds([])[1].tolist() == [0]


def test_memory_starts_afresh(monkeypatch):
    monkeypatch.setattr(encode, "MEMORY_PARTS", 3)
    memory = encode._Memory(bpe.Encoder(MERGES))
    for text in ("a b c d e", "f g h", "a b"):
        assert memory.encode([text])[0].tolist() == WANT(text)
