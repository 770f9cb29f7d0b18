"""Operators against brute force on small rows with nulls, empty and long texts, copies and clashing columns."""

import random
from collections import defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from corpusloom.llm import budget, bpe, crosssplit, encode, language, leak, ledger, mixing, near, spans, visual

CLASH = ["id", "a", "b", "k1", "p", "class_id", "posted", "size", "n", "term", "word", "part", "held"]


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8))) for _ in range(n))


def edited(rng, text, k):
    words = text.split(" ")
    for _ in range(k):
        words[rng.randrange(len(words))] = sentence(rng, 1)
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    out = [None, "", "   ", "short text", "x" * 30_000, sentence(rng, 4000)]
    for _ in range(40):
        base = sentence(rng, rng.randrange(20, 120))
        out += [base, base, base.replace(" ", "  "), *(edited(rng, base, k) for k in (1, 2, 4, 8)), "In front. " + base, base[: len(base) // 2] + sentence(rng, 40)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return df.select("*", *(F.lit("other").alias(c) for c in CLASH)).repartition(4)


def run_set(words, n):
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def plain(t):
    return regex.sub(r"[^\p{L}\p{M}\p{Nd}]", " ", t.lower()).split()


def similar(texts, least, n, t, split=str.split):
    sets = {i: run_set(split(x), n) for i, x in enumerate(texts) if x and len(split(x)) >= least}
    return {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b])}


def pairs(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_near_pairs(docs, texts):
    assert pairs(near.near_pairs(docs)) == similar(texts, 20, 5, 0.7)
    assert near.near_pairs(docs.limit(0)).count() == 0


def test_hot_variants_lose_no_pair(docs, texts, monkeypatch):
    monkeypatch.setattr(near.near_classes, "__defaults__", (*near.near_classes.__defaults__[:-1], 1))
    assert pairs(near.near_pairs(docs)) == similar(texts, 20, 5, 0.7)


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.7, 0.8, 0.95])
def test_prefix_candidates_hold_every_similar_pair(spark, threshold):
    rng = random.Random(int(threshold * 100))
    common = rng.sample(range(10_000), 60)
    sets = {i: set(rng.sample(common, rng.randrange(60))) | set(rng.sample(range(10_000), rng.randrange(1, 40))) for i in range(120)}
    df = spark.createDataFrame([(i, list(x)) for i, x in sets.items()], "id long, grams array<long>")
    got = pairs(near.prefix_candidates(df, threshold))
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}
    assert want <= got and len(got) < 120 * 119 / 2


def test_pages_around_one_boilerplate_give_few_candidates(spark):
    rng = random.Random(12)
    shared = sentence(rng, 40)
    count = {}
    for n in (200, 800):
        rows = [(i, f"{sentence(rng, 50)} {shared} {sentence(rng, 40)}") for i in range(n)]
        df = spark.createDataFrame(rows, "id long, text string")
        classes = near.signatures(df, "id", "text").withColumnRenamed("id", "class_id")
        count[n] = near.candidates(classes, lambda ids, df=df: near.run_sets(near.only(df, "id", ids), "id", "text"), 0.7, hot=8).count()
    assert count[800] <= 800  # of 319,600 pairs, none of which is similar


def expanded(found, members):
    """All pairs that pairs of classes and memberships stand for."""
    of = {r[0]: r.class_id for r in members}
    side = defaultdict(list)
    for k, c in of.items():
        side[c].append(k)
    out = {(a, b) for ks in side.values() for a in ks for b in ks if a < b}
    for a, b in found:
        out |= {(min(x, y), max(x, y)) for x in side[of[a]] for y in side[of[b]] if x != y}
    return out


def test_members_and_pairs_expand_to_all_pairs(spark):
    rng = random.Random(21)
    base = sentence(rng, 60)
    # two classes of 150 copies, near one another, and others near them
    rows = [*enumerate([base] * 150), *((200 + i, edited(rng, base, 1)) for i in range(5)), *((300 + i, base + " and more") for i in range(150)), (900, sentence(rng, 50)), (901, "short"), (902, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit("x")).withColumn("copies", F.lit("y"))
    texts = dict(rows)
    kept = {i: t for i, t in texts.items() if t and len(t.split()) >= 20}
    sets = {t: run_set(t.split(), 5) for t in kept.values()}
    near_texts = {(s, t) for s in sets for t in sets if len(sets[s] & sets[t]) >= 0.7 * len(sets[s] | sets[t])}
    want = {(a, b) for a in kept for b in kept if a < b and (kept[a], kept[b]) in near_texts}
    found, members = pairs(near.near_pairs(df)), near.near_members(df).collect()
    assert len(found) < len(want) and found <= want
    assert expanded(found, members) == want and {r.doc_id for r in members} == set(kept)
    assert next(r for r in members if r.doc_id == 449).copies == 150
    long = df.where(F.length("text") >= 200)
    assert expanded(pairs(spans.span_pairs(df)), near.classes_of(long, "doc_id", "text").collect()) == {(a, b) for a in kept for b in kept if a < b and 900 not in (a, b)}
    assert near.near_members(df.limit(0)).count() == 0


def test_cross_members_and_pairs_expand_to_all_pairs(spark):
    rng = random.Random(22)
    base = sentence(rng, 40)
    rows = [(i, "train", base) for i in range(150)] + [(200 + i, "test", base + "!") for i in range(150)] + [(400, "validation", edited(rng, base, 1)), (401, None, base), (402, "test", "few words"), (403, "train", None)]
    df = spark.createDataFrame(rows, "line_id long, split string, text string").withColumn("held", F.lit("x"))
    found, members = pairs(crosssplit.cross_pairs(df)), crosssplit.cross_members(df).collect()
    want = {(a, b) for a in range(150) for b in [*range(200, 350), 400]}
    side = {r.line_id: r.held for r in members}
    assert set(side) == {*range(150), *range(200, 350), 400} and len(found) < len(want)
    assert {p for p in expanded(found, members) if side[p[0]] != side[p[1]]} == want


def test_near_groups(docs, texts):
    rows = near.near_groups(docs).collect()
    assert len(rows) == len(texts) and all(r.group_id <= r.class_id <= r.doc_id for r in rows)
    by = {r.doc_id: r for r in rows}
    for a, b in similar(texts, 5, 5, 0.8):
        assert by[a].group_id == by[b].group_id


def test_one_group_of_copies_with_a_third_of_the_rows(spark, texts):
    rows = [(i, texts[6]) for i in range(40)] + [(100 + i, t) for i, t in enumerate(texts[7:60])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(near.near_groups(df).collect()) == len(rows)
    assert pairs(near.near_pairs(df)) >= {(i, j) for i in range(40) for j in range(i + 1, 40)}


def test_huge_classes_are_paired_through_representatives(spark):
    members = spark.createDataFrame([(i, 0) for i in range(6)] + [(i, 10) for i in range(10, 14)] + [(20, 20)], "id long, class_id long")
    links = spark.createDataFrame([(0, 10), (10, 20)], "a long, b long")
    got = pairs(near.expand(members, links, "x", "y", spelled=4))
    star = {(0, i) for i in range(1, 6)} | {(i, 10) for i in range(6)} | {(0, i) for i in range(10, 14)}
    assert got == star | {(i, j) for i in range(10, 14) for j in range(i + 1, 14)} | {(i, 20) for i in range(10, 14)}


def test_every_two_stored_texts_of_large_classes_are_listed(spark):
    rng = random.Random(8)
    words = sentence(rng, 150).split(" ")
    near_words = [*words[:-2], "other", "ending"]
    spaced = lambda w, n: [" ".join(w[:i]) + "  " + " ".join(w[i:]) for i in range(1, n + 1)]
    rows = [*enumerate(spaced(words, 105)), *enumerate(spaced(near_words, 103), 200), *((1000 + i, " ".join(words)) for i in range(102))]
    got = pairs(near.near_pairs(spark.createDataFrame(rows, "doc_id long, text string")))
    texts = [i for i, _ in rows if i < 1000]
    assert {p for p in got if p[1] < 1000} == {(a, b) for a in texts for b in texts if a < b}  # 208 stored texts, all pairs
    assert {p for p in got if p[0] >= 1000} == {(1000, 1000 + i) for i in range(1, 102)}  # one text's many copies: a star
    assert {p for p in got if p[0] < 1000 <= p[1]} == {(a, 1000 + i) for a in texts for i in range(102)}


def test_every_two_stored_texts_across_splits_are_listed(spark):
    rng = random.Random(9)
    words = sentence(rng, 150).split(" ")
    raised = lambda n: [" ".join([*words[:i], words[i].upper(), *words[i + 1 :]]) for i in range(n)]
    rows = [(i, "train", t) for i, t in enumerate(raised(105))] + [(200 + i, "test", t) for i, t in enumerate(raised(103))]
    df = spark.createDataFrame(rows, "line_id long, split string, text string")
    assert pairs(crosssplit.cross_pairs(df)) == {(a, 200 + b) for a in range(105) for b in range(103)}


def test_token_budget(spark, docs, texts):
    rows = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, " Web-A ").when(F.col("doc_id") % 3 == 1, "web_a")).withColumn("lang", F.lit("und")).withColumn("domain", F.lit(None).cast("string"))
    catalogue = spark.createDataFrame([("web_a", 1)], "name string, max_docs long")
    got = {(r.level, r.source): r for r in budget.token_budget(rows, catalogue).collect()}
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.merges_path())
    t.encode_special_tokens = True
    count = [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]
    assert got["all", None].tokens == sum(count) and got["all", None].docs == len(texts)
    assert got["source", "web_a"].tokens == sum(c for i, c in enumerate(count) if i % 3 < 2) and got["source", "web_a"].catalogued
    assert not got["source", None].catalogued and got["lang", None].tokens == sum(count)
    assert {r.doc_id: r.tokens for r in budget.token_counts(rows, ["doc_id"]).collect()} == {i: c for i, c in enumerate(count) if c}
    assert budget.token_budget(rows.limit(0), catalogue).count() == 0


def test_same_looking(spark):
    full = "Ｔhe quiet river ran past the old mill"
    rows = [(1, "The quiet river ran past the old mill"), (2, full), (3, "The quiet  river​ ran past the old mill "), (4, "Thе quiet river ran past the old mill"), (5, full), (6, "The quiet river ran past the new mill"), (7, "Ｔiny"), (8, "Tiny"), (9, None), (10, ""), (11, " ")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "line_id long, text string, id string")
    table = spark.createDataFrame([("е", "e"), ("ab", "c"), (None, "x")], "seen_char string, plain_char string")
    want = {(a, b) for a in range(1, 6) for b in range(a + 1, 6)} - {(2, 5)}
    assert pairs(visual.same_looking(df, table)) == want
    forms = {r.line_id: r.same_form for r in visual.normalise(df, table).collect()}
    assert forms[9] is None and forms[10] == forms[11] == "" and forms[4] == rows[0][1]
    assert visual.same_looking(df.limit(0), table.limit(0)).count() == 0


def test_cross_pairs_and_counts(docs, texts):
    rng = random.Random(4)
    split = [rng.choice(["train", "train", "validation", "test", None, "other"]) for _ in texts]
    rows = docs.withColumnRenamed("doc_id", "line_id").join(docs.sparkSession.createDataFrame(list(enumerate(split)), "line_id long, split string"), "line_id").withColumn("source", F.lit(None).cast("string"))
    side = {"train": 0, "validation": 1, "test": 1}
    want = {(a, b) for a, b in similar(texts, 8, 3, 0.6, plain) if {side.get(split[a]), side.get(split[b])} == {0, 1}}
    assert pairs(crosssplit.cross_pairs(rows)) == want and want
    counts = {r.split: (r.lines, r.overlapping) for r in crosssplit.overlap_counts(rows).collect()}
    hit = {x for p in want for x in p}
    for s in side:
        assert counts[s] == (split.count(s), sum(split[i] == s for i in hit))
    assert crosssplit.cross_pairs(rows.limit(0)).count() == 0
    assert crosssplit.cross_pairs(rows.where("split = 'train'")).count() == 0


SAMPLES = [("en", "the old farmer walked slowly to the green river and sold fresh bread"), ("de", "der alte bauer ging langsam zum fluss und verkaufte frisches brot"), ("te", "పాత రైతు నెమ్మదిగా నది వద్దకు నడిచారు మరియు తాజా రొట్టె అమ్మారు")]


def test_languages(spark):
    filters = language.Filters.train(SAMPLES)
    assert filters.languages == ["de", "en", "te"] and filters.rates.max() < 0.001
    en, de, te = (t for _, t in SAMPLES)
    rows = [(1, en, "en"), (2, en, "de"), (3, f"{en}. {te}!", "en"), (4, "12 34 ...", None), (5, None, "en"), (6, "", "en"), (7, f"{te} {te}", None), (8, f"{de}.\n{de}. {en}", "de"), (9, " ".join(["పాత farmer నది river తాజా bread రైతు green అమ్మారు slowly"] * 2), "te")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("letters", F.lit("x"))
    got = defaultdict(set)
    for r in language.wrong_labels(df, filters).collect():
        got[r.doc_id].add(r.found_lang)
    assert got == {2: {"en"}, 3: {"en", "te"}, 7: {"te"}, 8: {"en", "de"}, 9: {"en", "te"}}
    parts = [r for r in language.language_segments(df, filters).collect() if r.doc_id == 3]
    assert [(r.begin, r.lang_found) for r in sorted(parts, key=lambda r: r.begin)] == [(0, "en"), (len(en) + 2, "te")]
    assert all(0 <= r.confidence <= 1 for r in parts) and max(r.end for r in parts) == len(rows[2][1])
    assert language.wrong_labels(df.limit(0), filters).count() == 0


def test_held_out_language_accuracy(spark):
    import os

    path = "/root/testdata/sf0.001/lang_samples.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    rows = [(r.sample_id, r.lang, r.text) for r in spark.read.parquet(path).collect()]
    filters = language.Filters.train([(lang, t) for i, lang, t in rows if i % 4])
    df = spark.createDataFrame([(i, t, lang) for i, lang, t in rows if i % 4 == 0], "doc_id long, text string, lang string")
    found = language.document_languages(df, filters).collect()
    right = sum(r.found_lang == r.label and r.n_langs == 1 for r in found)
    assert right >= 0.98 * len(found)


def test_admission(spark, texts):
    rng = random.Random(8)
    order = list(range(len(texts)))
    rng.shuffle(order)
    batch = [rng.randrange(4) for _ in texts]
    rows = [(i, batch[k], texts[j]) for k, (i, j) in enumerate(zip(range(len(texts)), order))]
    df = spark.createDataFrame(rows, "record_id long, batch_no int, text string").withColumn("id", F.lit("x")).withColumn("k1", F.lit(1))
    close = defaultdict(set)
    for a, b in similar([r[2] for r in rows], 20, 5, 0.7):
        close[a].add(b), close[b].add(a)
    accepted, want = set(), set()
    for i, _, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        if met := close[i] & accepted:
            want |= {(a, i) for a in met}
        else:
            accepted.add(i)
    assert pairs(ledger.admit_all(df)) == want and want
    for hot in (1, 4):  # hot passages in context, and records of mostly common text by their rarest runs, lose nothing
        assert pairs(ledger.admit_all(df, backlog=hot > 1, hot=hot)) == want
    assert ledger.admit_all(df.limit(0)).count() == 0


def test_a_ledger_is_opened_again(spark, tmp_path):
    rng = random.Random(31)
    old = sentence(rng, 60)
    path = f"file://{tmp_path}/ledger"
    batch = lambda rows: spark.createDataFrame(rows, "record_id long, text string")
    first = ledger.Ledger(spark, path, hot=50, buckets=3)
    assert pairs(first.admit(batch([(5, old), (6, old), (7, edited(rng, old, 1)), (8, None), (9, "few")]))) == {(5, 6), (5, 7)}
    first.close()
    again = ledger.Ledger(spark, path)
    assert again.settings["hot"] == 50 and again.settings["buckets"] == 3
    new = sentence(rng, 60)
    assert pairs(again.admit(batch([(20, old + " x"), (21, new), (22, new + " y")]))) == {(5, 20), (21, 22)}
    again.close()
    third = ledger.Ledger(spark, path)
    assert pairs(third.admit(batch([(30, new), (31, sentence(rng, 60))]))) == {(21, 30)}
    third.drop()
    assert not (tmp_path / "ledger").exists()


def test_admission_of_common_text(spark):
    """Footers, and records that are mostly one template, in batches beyond the hot bound."""
    rng = random.Random(32)
    foot, template = sentence(rng, 40), sentence(rng, 80)
    texts = []
    for i in range(240):
        own = sentence(rng, rng.randrange(8, 40))
        texts.append([f"{sentence(rng, 70)} {foot}", f"{template} {own}", f"{own} {template} {foot}", sentence(rng, 50)][i % 4])
    texts += [edited(rng, t, 1) for t in texts[::9]]
    rows = [(i, i % 3, t) for i, t in enumerate(texts)]
    close = defaultdict(set)
    for a, b in similar(texts, 20, 5, 0.7):
        close[a].add(b), close[b].add(a)
    accepted, want = set(), set()
    for i, _, _ in sorted(rows, key=lambda r: (r[1], r[0])):
        met = close[i] & accepted
        want |= {(a, i) for a in met}
        if not met:
            accepted.add(i)
    df = spark.createDataFrame(rows, "record_id long, batch_no int, text string")
    assert pairs(ledger.admit_all(df, hot=10)) == want and len(want) > 50


def test_a_mix_larger_than_a_source_can_fill(spark):
    rows = [(i, "a", "x" * 100) for i in range(100)] + [(200 + i, "b", "y" * 50) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 3), ("none", 0.0, 1)], "name string, target_share double, max_repeats int")
    catalogue = spark.createDataFrame([("a", None)], "name string, max_docs long")
    default = {r.source: r for r in mixing.mix_report(docs, targets, catalogue).collect()}
    assert default["b"].size == 1500 == default["a"].size and default["b"].limits and not default["a"].limits
    assert default["a"].reach == 40_000 and default["b"].shortfall == 0
    more = {r.source: r for r in mixing.mix_report(docs, targets, catalogue, total=10_000).collect()}
    assert (more["a"].size, more["b"].size, more["b"].wanted, more["b"].shortfall) == (5000, 1500, 5000, 3500)
    assert abs(more["b"].actual_share - 1500 / 6500) < 1e-9 and more["b"].max_copies == 3


def test_mix(spark):
    sizes = {"a": [100] * 50, "b": [10, 20, 30] * 10, "c": [5] * 3}
    rows = [(i, s, "x" * n) for i, (s, n) in enumerate((s, n) for s, ns in sizes.items() for n in ns)] + [(900, None, "x"), (901, "a", None), (902, "A ", ""), (903, "d", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("x")).withColumn("src", F.lit("y"))
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 3), ("c", 0.05, 6), ("none", 0.05, 2)], "name string, target_share double, max_repeats int")
    catalogue = spark.createDataFrame([("a", None), ("b", 12), ("c", 100)], "name string, max_docs long")
    got = mixing.mix(docs, targets, catalogue).collect()
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    assert len(by["b"]) <= 12 and max(r.copies for r in got) <= 6 and "none" not in by
    assert max(r.copies for r in by["b"]) <= 3 and max(r.copies for r in by["a"]) == 1
    report = {r.source: r for r in mixing.mix_report(docs, targets, catalogue).collect()}
    assert report["none"].copies == 0
    assert abs(report["a"].actual_share / report["b"].actual_share - 1.25) < 0.15
    assert got == mixing.mix(docs.repartition(7), targets, catalogue).collect() or sorted(got) == sorted(mixing.mix(docs.repartition(7), targets, catalogue).collect())
    assert mixing.mix(docs.limit(0), targets, catalogue).count() == 0


def test_encode(docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.merges_path())
    t.encode_special_tokens = True
    got = {r.doc_id: r.ids for r in encode.encode(docs).collect()}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}
    assert encode.encode(docs.limit(0)).count() == 0


def test_passages(spark, docs, texts):
    words = (texts[10] or "").split()
    swapped = [*words[:4], *words[5:9]]  # the documents have one word more
    items = [(1, " ".join(words[3:20]).upper() + "!"), (2, "nothing of this stands anywhere in all of the texts"), (3, None), (4, "too short"), (5, " ".join(swapped)), (1, " ".join(words[3:20]))]
    tests = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(7))
    want = {(d, i) for d, x in enumerate(texts) if x for i, t in items if t and run_set(plain(t), 8) & run_set(plain(x), 8)}
    assert {(r.doc_id, r.item_id) for r in leak.passages(docs, tests).collect()} == want and want
    near_too = {(r.doc_id, r.item_id) for r in leak.passages(docs, tests, slack=2).collect()}
    assert want < near_too and (10, 5) in near_too
    assert leak.passages(docs, tests.limit(0)).count() == leak.passages(docs.limit(0), tests).count() == 0


def test_spans(docs, texts, monkeypatch):
    ids = [i for i, t in enumerate(texts) if t and len(t) >= 200]
    windows = {i: {texts[i][k : k + 200] for k in range(len(texts[i]) - 199)} for i in ids}
    want = {(a, b) for a in ids for b in ids if a < b and windows[a] & windows[b]}
    assert pairs(spans.span_pairs(docs)) == want and want
    monkeypatch.setattr(spans, "HOT", 3)  # the exact windows of hot symbols lose nothing
    assert pairs(spans.span_pairs(docs)) == want
    share = {r.doc_id: r for r in spans.shared_share(docs).collect()}
    assert len(share) == len(texts)
    others = {i: set().union(*(windows[j] for j in ids if j != i)) for i in ids[:30]}
    for i in ids[:30]:
        covered = np.zeros(len(texts[i]), bool)
        for k in range(len(texts[i]) - 199):
            if texts[i][k : k + 200] in others[i]:
                covered[k : k + 200] = True
        assert share[i].shared_chars == covered.sum()
    assert spans.span_pairs(docs.limit(0)).count() == 0


def test_leak_index_is_appended_to_and_opened_again(spark, docs, texts, tmp_path):
    path = f"file://{tmp_path}/index"
    leak.LeakIndex(spark, path).add(docs.where("doc_id < 100")).add(docs.where("doc_id >= 100"))
    words = texts[20].split()
    items = spark.createDataFrame([(1, " ".join(words[3:14])), (2, "of all this no word stands there at all")], "item_id long, text string")
    index = leak.LeakIndex(spark, path)
    got = {(r.doc_id, r.item_id) for r in index.search(items).collect()}
    assert got == {(r.doc_id, r.item_id) for r in leak.passages(docs, items).collect()} and (20, 1) in got
    assert {r.doc_id for r in index.search(items, 11).collect()} <= {d for d, _ in got}
    one = items.where("item_id = 1")
    assert "terms_15" in index.segments().columns and index.search(one).count() == len({d for d, i in got if i == 1})
    index.drop()


def test_a_footer_of_many_records_is_shared_without_pairs(spark, monkeypatch):
    monkeypatch.setattr(spans, "HOT", 8)
    rng = random.Random(41)
    foot = sentence(rng, 60)[:250]
    rows = [(i, f"{sentence(rng, 40)}{foot}{sentence(rng, 30)}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    share = {r.doc_id: r.shared_chars for r in spans.shared_share(df).collect()}
    windows = {i: [t[k : k + 200] for k in range(len(t) - 199)] for i, t in rows}
    for i, t in rows:
        others = set().union(*(windows[j] for j, _ in rows if j != i))
        covered = {c for k, w in enumerate(windows[i]) if w in others for c in range(k, k + 200)}
        assert share[i] == len(covered) >= 250
    _, found, windows = spans.shared_spans(df)
    assert found.count() == 0 and windows.count() <= 40 * 60  # linear, where the pairs are 780
    assert pairs(spans.span_pairs(df)) == {(a, b) for a in range(40) for b in range(a + 1, 40)}


def test_language_positions_are_those_of_the_stored_text(spark):
    filters = language.Filters.train(SAMPLES)
    text = f"İİİİ {SAMPLES[0][1]}. İ {SAMPLES[2][1]}"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    parts = sorted((r.begin, r.end, r.lang_found) for r in language.language_segments(df, filters).collect())
    assert parts[0][0] == 0 and parts[-1][1] == len(text) and all(x[1] == y[0] for x, y in zip(parts, parts[1:]))
    assert text[parts[-1][0]] == SAMPLES[2][1][0] and parts[-1][2] == "te"


def test_repeated_rows_change_nothing(docs):
    twice = docs.unionByName(docs)
    assert pairs(near.near_pairs(twice)) == pairs(near.near_pairs(docs))
    assert pairs(spans.span_pairs(twice)) == pairs(spans.span_pairs(docs))
    assert sorted(near.near_groups(twice).collect()) == sorted(near.near_groups(docs).collect())
    lines = docs.withColumn("split", F.when(F.col("doc_id") % 2 == 0, "train").otherwise("test")).withColumnRenamed("doc_id", "line_id")
    assert pairs(crosssplit.cross_pairs(lines.unionByName(lines))) == pairs(crosssplit.cross_pairs(lines))
    batches = docs.withColumnRenamed("doc_id", "record_id").withColumn("batch_no", F.lit(1))
    assert pairs(ledger.admit_all(batches.unionByName(batches))) == pairs(ledger.admit_all(batches))
