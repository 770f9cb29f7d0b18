import random

import pytest

from corpusloom.operators import dedup
from corpusloom.operators.components import connected_components
from corpusloom.operators.overlap import OverlapIndex, overlap_report
from tests.test_minhash import BASE, FAR, NEAR


def run(frame, texts, **options):
    kept, stats = dedup.near_dedup(frame(texts), **options)
    return [r.text for r in kept.orderBy("ord").collect()], stats.first()


def test_exact_duplicates(frame):
    kept, s = run(frame, [BASE, BASE, " " + BASE, FAR])
    assert kept == [BASE, FAR] and s.exact_duplicates == 2


def test_near_duplicates_keep_the_first_unchanged(frame):
    kept, s = run(frame, [BASE, NEAR, FAR], threshold=0.6)
    assert kept == [BASE, FAR] and s.near_duplicates == 1


def test_distinct_stay_and_stats(frame):
    _, s = run(frame, [BASE, FAR, "short text"])
    assert (s.near_duplicates, s.documents_kept) == (0, 3)
    _, s = run(frame, [BASE, BASE, FAR, FAR])
    assert (s.documents_in, s.removed_fraction) == (4, 0.5)
    assert "50.0%" in dedup.format_dedup_stats(s)


def test_empty_and_null(frame):
    assert run(frame, [])[1].removed_fraction == 0.0
    kept, s = run(frame, [None, ""])
    assert kept == [""] and s.documents_in == 1


def test_threshold_is_monotone_and_result_stable(frame):
    texts = [BASE, NEAR, FAR, BASE + " again"]
    near = [run(frame, texts, threshold=t)[1].near_duplicates for t in (0.95, 0.5)]
    assert near[0] <= near[1]
    assert run(frame, texts, seed=99) == run(frame, texts, seed=99)
    one = dedup.near_dedup(frame(texts).repartition(1), 0.6)[0].orderBy("ord").collect()
    assert one == dedup.near_dedup(frame(texts).repartition(7), 0.6)[0].orderBy("ord").collect()


def test_sweep_and_jaccard(frame):
    rows = {r.threshold: r.near_duplicates for r in dedup.threshold_sweep(frame([BASE, NEAR, FAR]), (0.5, 0.95)).collect()}
    assert rows == {0.5: 1, 0.95: 0}
    pairs = frame([BASE, NEAR]).selectExpr("0L as src", "1L as dst").distinct()
    assert 0.6 < dedup.true_jaccard(frame([BASE, NEAR]), pairs).first().jaccard < 1


def test_clean_dedup_composes_and_counts(frame):
    texts = ["café " + "x" * 70, "café  " + "x" * 70, "short", None]
    assert dedup.exact_dedup_clean(frame(texts)).collect()[0].ord == 0
    s = dedup.clean_stats(frame(texts)).first()
    assert (s.documents_in, s.documents_kept, s.duplicates, s.too_short, s.script_share) == (3, 1, 1, 1, 0.0)
    assert dedup.clean_stats(frame([])).first().script_share == 0.0
    assert "duplicates 1" in dedup.format_clean_stats(s)


@pytest.mark.parametrize("kind", ["chain", "random", "star"])
def test_components(spark, kind):
    random.seed(5)
    edges = {"chain": [(i, i + 1) for i in range(60)], "random": [(random.randrange(80), random.randrange(80)) for _ in range(60)], "star": [(0, i) for i in range(1, 50)] + [(100, 101), (101, 101)]}[kind]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_components_of_nothing(spark):
    none = spark.createDataFrame([(None, 1), (3, 3)], "src long, dst long")
    assert connected_components(none).count() == 0


def test_components_of_several_graphs_at_once(spark):
    edges = [(0, 1, 2), (0, 2, 3), (1, 1, 2), (1, 7, 3), (1, 2, 9)]
    got = {(r.g, r.node): r.component for r in connected_components(spark.createDataFrame(edges, "g int, src long, dst long"), by="g").collect()}
    assert got == {(0, 1): 1, (0, 2): 1, (0, 3): 1, (1, 1): 1, (1, 2): 1, (1, 9): 1, (1, 3): 3, (1, 7): 3}


def test_overlap_by_existence_equals_pairs(spark, frame):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(200)]
    base = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(6)]
    change = lambda t: " ".join(w if rng.random() > 0.02 else "other" for w in t.split())
    index = OverlapIndex(num_bands=32).add(frame([change(t) for t in base for _ in range(8)] + base[:2] * 3))
    probes = frame([change(change(t)) for t in base for _ in range(6)] + base + ["nothing of it"])
    want = {r.probe for r in index.pairs(probes, 0.7).collect()}
    assert {r.ord for r in index.matches(probes, 0.7).collect()} == want and 5 < len(want) < 43


def test_overlap_index_is_opened_again(spark, frame, tmp_path):
    path = f"file://{tmp_path}/index"
    OverlapIndex(num_perm=64, num_bands=8, kind="md5", path=path).add(frame([BASE])).add(frame([FAR]))
    index = OverlapIndex.open(spark, path)
    assert (index.num_perm, index.kind, index.count()) == (64, "md5", 2)
    assert [r.ord for r in index.matches(frame([BASE, "other words"])).collect()] == [0]
    with pytest.raises(FileNotFoundError):
        OverlapIndex.open(spark, f"file://{tmp_path}/none")


def test_overlap(spark, frame):
    index = OverlapIndex().add(frame([BASE, FAR]))
    probes = frame([BASE + " again", "nothing like it in the other corpus at all", None])
    assert [r.ord for r in index.matches(probes, 0.6).collect()] == [0]
    assert index.count() == 2 and index.buckets() > 16
    assert OverlapIndex().pairs(probes).count() == 0
    marked = probes.selectExpr("ord", "text", "'s' as source")
    r = overlap_report(marked, index.matches(marked, 0.6), 2, 4).first()
    assert (r.probes, r.hits, r.coverage) == (3, 1, 0.5) and abs(r.est_rate - 2 / 3) < 1e-9
    assert overlap_report(marked, marked.limit(0), 0, 4).first().est_rate == 0.0
    with pytest.raises(ValueError):
        overlap_report(marked, marked, 1, 0)
