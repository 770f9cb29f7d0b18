import numpy as np
import pytest

from corpusloom.functions import minhash as M

BASE = "morning boats carried rice and lamps along the slow brown canal while old traders counted coins beside the quiet stone gate"
NEAR = BASE + " before noon came"
FAR = "seven engineers measured every cable under the bridge and wrote their numbers into a thick blue notebook"


def signature(text, num_perm=128, seed=1337, kind="blake2b"):
    values = np.array(sorted(M.shingles(text, kind=kind)), np.uint64)
    return M.signatures_of(values, np.array([0, len(values)]), *M.coefficients(num_perm, seed))[0]


def jaccard(a, b):
    x, y = M.shingles(a), M.shingles(b)
    return len(x & y) / len(x | y)


def test_shingles():
    assert M.shingles(BASE) == M.shingles(BASE)
    assert jaccard(BASE, NEAR) > 0.6
    assert jaccard(BASE, FAR) < 0.05
    assert len(M.shingles("two words")) == 1


def test_pinned_shingle_hashes():
    # first 32 bits of BLAKE2b with a 4-byte digest, and of MD5
    assert M.shingles("a b c d e") == {769012554} and M.shingles("a b c d e", kind="md5") == {607697051}
    assert M.shingles("a  b\u3000c d e f") == M.shingles("a b c d e") | M.shingles("b c d e f")


def test_pinned_coefficients():
    a, b = M.coefficients()
    assert a[:2].tolist() == [2024765128292662543, 427798353355711302]
    assert b[127] == 29027953461635623


def test_signature_equals_wrapping_formula():
    values = np.array([0, 1, 5, 2**32 - 1], np.uint64)
    a, b = M.coefficients()
    got = M.signatures_of(values, np.array([0, 4, 4]), a, b)
    want = [min((((int(x) * int(y) + int(z)) % 2**64) % M.PRIME) for x in values) for y, z in zip(a, b)]
    assert got[0].tolist() == want
    assert set(got[1].tolist()) == {M.MAX_HASH}


def test_similarity():
    assert len(signature(BASE, 64)) == 64
    assert (signature(BASE, seed=7) == signature(BASE, seed=7)).all()
    assert M.similarity_of(signature(BASE), signature(BASE)) == 1.0
    assert abs(M.similarity_of(signature(BASE, 256), signature(NEAR, 256)) - jaccard(BASE, NEAR)) < 0.12
    assert M.similarity_of(signature(BASE), signature(FAR)) < 0.1


def test_dataframe_signatures_and_bands(spark, frame):
    signed = M.signatures(frame([BASE, None, ""]))
    rows = {r.ord: r.sig for r in signed.collect()}
    assert set(rows) == {0, 2} and rows[0] == signature(BASE).tolist()
    cut = M.bands(M.signatures(frame([BASE]), num_perm=10), 3, 10).collect()
    assert [(r.band, len(r.bucket)) for r in cut] == [(0, 3), (1, 3), (2, 3)]  # the tenth position fills no band
    with pytest.raises(ValueError):
        M.bands(signed, 129, 128)
    with pytest.raises(ValueError):
        M.signatures(frame([]), kind="sha")
