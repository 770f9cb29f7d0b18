import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom import cli
from corpusloom.operators import sources, tokens
from corpusloom.operators.prefix import running_total
from corpusloom.plans import prepare
from corpusloom.sources import readers, sinks
from corpusloom.streaming import incremental


def test_jsonl(spark, tmp_path):
    good = tmp_path / "a.jsonl"
    good.write_text('{"text": "one"}\n\n{"text": ""}\n{"other": 1}\n{"text": null}\n{"text": "two", "x": 3}\n')
    assert sorted(r.text for r in readers.jsonl(spark, str(good)).collect()) == ["one", "two"]
    bad = tmp_path / "b.jsonl"
    bad.write_text('{"text": "one"\n')
    with pytest.raises(Exception):  # noqa: B017
        readers.jsonl(spark, str(bad)).collect()


def test_text_tree(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.txt").write_bytes(b"  bad \xff byte here\r\nnext\r")
    (tmp_path / "a.txt").write_text("tiny")
    (tmp_path / "c.txt").write_text("long enough text")
    rows = readers.local_text(spark, str(tmp_path)).collect()
    assert [r.text for r in rows] == ["bad � byte here\nnext", "long enough text"]
    with pytest.raises(FileNotFoundError):
        readers.existing(spark, [str(tmp_path / "none")])
    assert rows[1].source == str(tmp_path / "c.txt")


def test_existing_inputs_on_any_file_system(spark, tmp_path, capsys):
    (tmp_path / "a").write_text("x")
    paths = [f"file://{tmp_path}/a", str(tmp_path / "gone"), str(tmp_path / "a")]
    assert readers.existing(spark, paths) == [paths[0], paths[2]]
    assert "gone" in capsys.readouterr().err


def test_limits_count_lines_without_text(spark, tmp_path):
    for name, rows in (("a", ["one", "", "two"]), ("b", ["three", "four"])):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"text": t}) + "\n" for t in rows))
    paths = [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")]
    lines = lambda limit=None: [(r.ord, r.text) for r in readers.numbered_lines(spark, paths, limit).orderBy("ord").collect()]
    assert lines() == [(0, "one"), (1, ""), (2, "two"), (3, "three"), (4, "four")]
    assert lines(2) == [(0, "one"), (1, "")] and lines(0) == []


def test_ordered_union_counts_empty_lines(frame):
    a, b = frame(["a", "", "c"]), frame([None, "e", "f"])
    lines = [(r.line, r.text) for r in readers.ordered_union([a, b], "ord", 1, 5).orderBy("line").collect()]
    assert lines == [(2, "c"), (4, "e")]
    assert readers.ordered_union([a], "ord", limit=0).count() == 0


def test_blocks(frame):
    text = "x" * 201 + "\n\n" + "y" * 200 + "\n\n" + "z" * 300
    assert [r.block for r in readers.blocks(frame([text])).orderBy("block").collect()] == [0, 2]
    assert [r.block for r in readers.blocks(frame([text]), per_file=1).collect()] == [0]


def test_collected_cap_lets_one_through(frame):
    texts = [" 123456789 ", " 1234567890 ", "abcdefghijk"]
    assert [r.ord for r in readers.collected(frame(texts)).orderBy("ord").collect()] == [1, 2]
    assert [r.ord for r in readers.collected(frame(texts), cap=0).collect()] == [1]


def test_wiki(spark):
    payload = json.dumps({"query": {"pages": {"7": {"extract": " " + "p" * 500 + " "}, "8": {"extract": "short"}, "9": {}}}})
    rows = readers.wiki_extracts(spark.createDataFrame([(payload,), ("{}",), (None,)], "payload string")).collect()
    assert [(r.page, len(r.text)) for r in rows] == [("7", 500)]
    assert "grnlimit=20" in readers.wiki_url("te")


def _crawl(monkeypatch, answers, **options):
    """What the crawler gives for these answers, and how many it asked for."""
    asked = iter(answers)

    def request(url, timeout):
        answer = next(asked)
        if isinstance(answer, Exception):
            raise answer
        return answer

    monkeypatch.setattr(readers, "request", request)
    reader = readers._WikipediaReader({k: str(v) for k, v in options.items()})
    return [row for p in reader.partitions() for row in reader.read(p)]


def test_crawl_ends_at_its_limit_or_with_a_reason(monkeypatch):
    pages = lambda *sizes: json.dumps({"query": {"pages": {str(i): {"extract": "p" * n} for i, n in enumerate(sizes)}}}).encode()
    rows = _crawl(monkeypatch, [pages(600, 10, 700), pages(800, 900)], limit=3)
    assert [len(json.loads(p)["query"]["pages"]) for p, _ in rows] == [2, 1] and all(r is None for _, r in rows)
    rows = _crawl(monkeypatch, [pages(600), OSError("no route")], limit=3)
    assert [r for _, r in rows] == [None, "OSError: no route"]
    assert _crawl(monkeypatch, [b'{"query": {}}'], limit=3) == [(None, "an answer without pages")]
    assert _crawl(monkeypatch, [b"<html>"], limit=3)[0][1].startswith("JSONDecodeError")
    assert _crawl(monkeypatch, [], limit=0) == []
    assert [p.value for p in readers._WikipediaReader({"limit": "5", "readers": "2"}).partitions()] == [3, 2]


def test_hub_rows_keep_what_arrived(monkeypatch):
    import sys
    import types

    def rows(*a, **k):
        yield from ({"body": t} for t in ("short", "long enough", None, "also long"))
        raise OSError("line lost")

    monkeypatch.setitem(sys.modules, "datasets", types.SimpleNamespace(load_dataset=rows))
    options = {"dataset": "d", "field": "body", "min_chars": "6"}
    read = lambda **more: list(readers._HubReader(options | more).read(readers.InputPartition(0)))
    assert read() == [("long enough", None), ("also long", None), (None, "OSError: line lost")]
    assert read(limit="1") == [("long enough", None)]
    monkeypatch.setitem(sys.modules, "datasets", None)
    assert read()[0][1].startswith("ModuleNotFoundError")


def test_caps(spark):
    specs = [sources.SourceSpec("a", "d", None, "train", 2, 3), sources.SourceSpec("b", "d", None, "train", 0, 0), sources.SourceSpec("e", "d", None, "train", None, 0)]
    df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate([("a", "xx"), ("a", "xxx"), ("a", "xxxx"), ("a", "xxxxx"), ("b", None), ("b", "y"), ("c", "zzz"), (None, "zzz"), ("e", "1"), ("e", "2")])], "ord long, source string, text string")
    catalogue = sources.catalogue_frame(spark, specs)
    assert sorted(r.ord for r in sources.capped(df, catalogue).collect()) == [1, 2, 4, 8, 9]
    assert sorted(r.ord for r in sources.capped(df, catalogue, only=["a"]).collect()) == [1, 2]
    b = {r.source: (r.docs, r.chars) for r in sources.budget(df).collect()}
    assert b["a"] == (4, 14) and b["b"] == (1, 1) and b[None] == (1, 3)
    assert sources.first_per_group(df, "source", "ord", 0).count() == 0


def test_run_log(spark):
    log = spark.createDataFrame([(1, "a", 5, 10, 2, 0.1, None, None, None, None, 1), (2, "a", 6, 12, 3, 0.1, "net" * 60, None, None, None, 2), (3, "b", None, None, None, None, None, True, 9, None, 1), (4, "c", None, None, None, None, None, None, None, "e" * 200, None)], "run_id long, source string, docs long, chars long, est_tokens long, gb double, interrupted string, skipped boolean, bytes_on_disk long, error_msg string, finished_at long")
    rows = {r.source: r for r in sources.run_summary(log).collect()}
    assert [rows[k].status for k in "abc"] == ["interrupted", "skipped", "failed"]
    assert len(rows["a"].interrupted) == 90 and len(rows["c"].error) == 120
    assert sources.total_tokens(log).first().est_tokens == 3
    assert sources.total_tokens(log.limit(0)).first().est_tokens == 0


def test_running_total(spark):
    df = spark.createDataFrame([(i, i % 3 if i % 5 else None) for i in range(200)], "k long, v long").repartition(5)
    rows = running_total(df, ["k"], "v").orderBy("k").collect()
    total = 0
    for r in rows:
        assert r.before == total
        total += r.v or 0


@pytest.mark.parametrize("total,val", [(1, 1), (10, 1), (199, 1), (200, 1), (999, 5), (1001, 6), (12345, 62)])
def test_split_formula_batch(total, val):
    assert tokens.val_size_batch(total, 0.005) == val


@pytest.mark.parametrize("total,val", [(1, 1), (10, 1), (999, 4), (1001, 5), (12345, 61)])
def test_split_formula_stream(total, val):
    assert tokens.val_size_stream(total, 0.005) == val


def test_split_conserves_tokens(frame):
    encoded = tokens.encode(frame(["abc", None, "", "defgh", "éé"]), tokens.ByteTokenizer, 256)
    parts = tokens.split(encoded, lambda n: 6).cache()
    flat = [i for w in ("train", "val") for r in tokens.part(parts, w).orderBy("ord").collect() for i in r.ids]
    assert flat == [*b"abc", 256, *b"defgh", 256, *"éé".encode(), 256]
    assert sum(len(r.ids) for r in tokens.part(parts, "val").collect()) == 6
    assert tokens.distinct_in_prefix(tokens.part(parts, "train"), 4).first()[0] == 4
    with pytest.raises(ValueError):
        tokens.val_size_stream(0)


def test_uint16():
    assert tokens.as_uint16([0, 65535]) == b"\x00\x00\xff\xff"
    with pytest.raises(OverflowError):
        tokens.as_uint16([65536])


def test_prepare_and_tokenize_write_the_stream_in_order(spark, frame, tmp_path):
    src = tmp_path / "in.jsonl"
    texts = [f"document number {i} " + "words " * (10 + i) for i in range(40)] + ["short"]
    src.write_text("".join(json.dumps({"text": t}) + "\n" for t in [*texts, texts[0]]))
    out = prepare.prepare(spark, [str(src)], str(tmp_path / "p"), tokens.ByteTokenizer, 0.1, eos_id=256)
    assert out["clean"]["documents_kept"] == 40 and out["clean"]["duplicates"] == 1
    joined = np.concatenate([np.fromfile(tmp_path / "p" / f"{w}.bin", "<u2") for w in ("train", "val")])
    assert len(joined) == sum(len(t.strip()) + 1 for t in texts[:40]) and (joined == 256).sum() == 40
    frames = [frame(texts[:20]), frame(texts[20:])]
    report = prepare.tokenize_corpus(frames, str(tmp_path / "t"), tokens.ByteTokenizer, 256)
    stream = np.concatenate([np.fromfile(tmp_path / "t" / f"{w}.bin", "<u2") for w in ("train", "val")])
    assert stream.tolist() == [i for t in texts for i in [*t.encode(), 256]]
    assert report["docs"] == 41 and report["docs_per_s"] > 0 < report["tokens_per_s"]
    assert not (tmp_path / "t" / "tokenise.progress").exists()
    again = prepare.tokenize_corpus(frames, str(tmp_path / "t"), tokens.ByteTokenizer, 256)
    assert again["train"] == report["train"]
    with pytest.raises(ValueError):
        prepare.prepare(spark, [str(src)], str(tmp_path / "q"), tokens.ByteTokenizer, min_chars=10_000)


def test_tokens_as_parts_with_a_manifest(spark, frame, tmp_path):
    texts = [f"text {i} " + "w" * i for i in range(50)]
    encoded = tokens.encode(frame(texts).repartition(6), tokens.ByteTokenizer, 256)
    parts = tokens.split(encoded, lambda n: 5)
    folder = tmp_path / "train.bin"
    out = sinks.write_tokens(tokens.part(parts, "train"), str(folder))
    manifest = json.loads((folder / "manifest.json").read_text())
    assert manifest["n_tokens"] == out["n_tokens"] and {n for n, _ in manifest["parts"]} == {f.name for f in folder.glob("*.part")}
    want = [i for t in texts for i in [*t.encode(), 256]][:-5]
    assert [i for n, _ in manifest["parts"] for i in np.fromfile(folder / n, "<u2").tolist()] == want
    sinks.join_parts(spark, f"file://{folder}", str(tmp_path / "flat.bin"), block=64)
    assert np.fromfile(tmp_path / "flat.bin", "<u2").tolist() == want
    (folder / manifest["parts"][0][0]).write_bytes(b"x")
    with pytest.raises(ValueError):
        sinks.join_parts(spark, str(folder), str(tmp_path / "flat.bin"))
    wide = frame(["x"]).selectExpr("0L as before", "array(65536) as ids")
    with pytest.raises(Exception, match="65535"):
        sinks.write_tokens(wide, str(tmp_path / "wide.bin"))


VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.mark.skipif(not __import__("os").path.exists(VOCABULARY), reason="no vocabulary files")
def test_vocabulary_files(spark, frame, tmp_path):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(VOCABULARY)
    model.encode_special_tokens = True
    texts = ["the quick brown fox", "నది ఒడ్డున", "<|endoftext|> is text"]
    got = {r.ord: r.ids for r in tokens.encode(frame([*texts, None, ""]), tokens.vocabulary(VOCABULARY), 7).collect()}
    assert got == {i: [*model.encode(t, add_special_tokens=False).ids, 7] for i, t in enumerate(texts)}
    source = tmp_path / "in.jsonl"
    source.write_text("".join(json.dumps({"text": t}) + "\n" for t in texts))
    assert cli.main(["tokenize", "--input", str(source), "--out-dir", str(tmp_path / "out"), "--vocab", VOCABULARY, "--val-fraction", "0.2"]) == 0
    stream = np.concatenate([np.fromfile(tmp_path / "out" / f"{w}.bin", "<u2") for w in ("train", "val")])
    assert stream.tolist() == [i for t in texts for i in model.encode(t, add_special_tokens=False).ids]
    with pytest.raises(ValueError):
        cli._tokenizer(VOCABULARY, "no such token")


def test_tokenizing_resumes_after_the_chunks_on_disk(spark, frame, tmp_path, monkeypatch):
    texts = [f"line {i}" for i in range(10)]
    frames, out = [frame(texts)], tmp_path / "t"
    encoded, encode = [], tokens.encode
    fail_at = [2]

    def counting(df, *a, **k):
        if len(encoded) == fail_at[0]:
            raise RuntimeError("killed")
        encoded.append(1)
        return encode(df, *a, **k)

    monkeypatch.setattr(tokens, "encode", counting)
    run = lambda: prepare.tokenize_corpus(frames, str(out), tokens.ByteTokenizer, 256, 0.1, chunk_lines=3)
    with pytest.raises(RuntimeError):
        run()
    note = json.loads((out / "tokenise.progress").read_text())
    assert note["docs"] == 6 and len(note["chunks"]) == 2
    encoded.clear()
    fail_at[0] = 99
    for f in (out / "tokens.stage" / "chunk=00000001").glob("*.parquet"):
        f.unlink()  # what lies there is less than the note says
    run()
    assert len(encoded) == 3  # the second chunk again, and the two that were missing
    stream = np.concatenate([np.fromfile(out / f"{w}.bin", "<u2") for w in ("train", "val")])
    assert stream.tolist() == [i for t in texts for i in [*t.encode(), 256]]


def _out_of_order(folder, n=120):
    """Two files of distinct texts, neither alphabetical nor in the order of the file names."""
    texts = [f"{(i * 37) % n:03d} numbered text {i} " + "words of it " * 8 + "." for i in range(n)]
    files = [folder / "z.jsonl", folder / "a.jsonl"]
    for f, rows in zip(files, (texts[: n // 2], texts[n // 2 :])):
        f.write_text("".join(json.dumps({"text": t}) + "\n" for t in rows))
    return texts, [str(f) for f in files]


def test_prepare_keeps_the_input_order(spark, tmp_path):
    texts, files = _out_of_order(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several splits a file
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert readers.jsonl(spark, files[0]).rdd.getNumPartitions() > 2
        prepare.prepare(spark, files, str(tmp_path / "p"), tokens.ByteTokenizer, 0.1, eos_id=256)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    stream = np.concatenate([np.fromfile(tmp_path / "p" / f"{w}.bin", "<u2") for w in ("train", "val")])
    assert stream.tolist() == [i for t in texts for i in [*t.encode(), 256]]


def test_cli_dedup_keeps_the_first_in_input_order(spark, tmp_path):
    rng = np.random.default_rng(5)
    words = lambda: " ".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), (60, 6)).view("<U6").ravel())
    base, others = words(), [words() for _ in range(6)]
    texts = [*others[:3], f"{base} zz", *others[3:], f"{base} aa"]  # the later near-duplicate is the alphabetically first
    source = tmp_path / "in.jsonl"
    source.write_text("".join(json.dumps({"text": t}) + "\n" for t in texts))
    assert cli.main(["dedup", "--input", str(source), "--out", str(tmp_path / "out")]) == 0
    kept = [json.loads(line)["text"] for f in sorted((tmp_path / "out").glob("part-*")) for line in f.read_text().splitlines()]
    assert kept == texts[:-1]


class _Upper(tokens.ByteTokenizer):
    def encode(self, text):
        return super().encode(text.upper())


def test_tokenize_encodes_again_what_has_changed(spark, frame, tmp_path, monkeypatch):
    out, encoded, write = str(tmp_path / "t"), [], sinks.write_tokens
    monkeypatch.setattr(tokens, "encode", lambda *a, f=tokens.encode: encoded.append(1) or f(*a))

    def stream(texts, make=tokens.ByteTokenizer, eos=256, limit=None):
        prepare.tokenize_corpus([frame(texts)], out, make, eos, 0.1, limit)
        return np.concatenate([np.fromfile(tmp_path / "t" / f"{w}.bin", "<u2") for w in ("train", "val")]).tolist()

    def interrupted(*a):
        monkeypatch.setattr(sinks, "write_tokens", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stream(*a)
        monkeypatch.setattr(sinks, "write_tokens", write)

    assert stream(["ab", "cd"], limit=1) == [*b"ab", 256]
    assert stream(["ab", "cd"]) == [*b"ab", 256, *b"cd", 256]
    assert stream(["ab", "cd", "ef"]) == [*b"ab", 256, *b"cd", 256, *b"ef", 256]
    assert not (tmp_path / "t" / "tokens.stage").exists()
    encoded.clear()
    interrupted(["ab", "cd"])
    assert stream(["ab", "cd"]) == [*b"ab", 256, *b"cd", 256] and len(encoded) == 1  # resumed
    for change in ((["ab", "ce"],), (["ab", "cd"], _Upper), (["ab", "cd"], tokens.ByteTokenizer, 9), (["ab", "cd"], tokens.ByteTokenizer, 256, 1)):
        interrupted(["ab", "cd"])
        encoded.clear()
        stream(*change)
        assert len(encoded) == 1


def test_source_sink(spark, frame, tmp_path):
    path = str(tmp_path / "s")
    assert sinks.write_source(frame(["a", "b"]), path, "s") == {"source": "s", "docs": 2}
    assert sinks.write_source(frame(["a"]), path, "s") == {"source": "s", "skipped": True}
    cut = frame(["a", "b", None]).withColumn("interrupted", F.when(F.col("text").isNull(), F.lit("r" * 100)))
    assert sinks.write_source(cut, str(tmp_path / "c"), "c") == {"source": "c", "docs": 2, "interrupted": "r" * 90}
    assert sinks.write_source(cut.where("text is null"), str(tmp_path / "n"), "n") == {"source": "n", "error": "r" * 100}
    failing = frame(["a"]).select(F.raise_error(F.lit("x" * 300)).cast("string").alias("text"))
    assert len(sinks.write_source(failing, str(tmp_path / "f"), "f")["error"]) == 120


def test_streams_resume(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.json").write_text('{"text": "ab"}\n{"text": ""}\n')
    args = (spark, str(folder), str(tmp_path / "out"), str(tmp_path / "ck"), tokens.ByteTokenizer, 256)
    incremental.encode_available(*args)
    (folder / "2.json").write_text('{"text": "c"}\n')
    incremental.encode_available(*args)
    incremental.encode_available(*args)
    assert sorted(r.ids for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [[97, 98, 256], [99, 256]]
    (folder / "3.json").write_text('{"text": "' + "w " * 100 + '"}\n')
    incremental.grow_index(spark, str(folder), str(tmp_path / "idx"), str(tmp_path / "ck2"), "ord")
    index = incremental.grow_index(spark, str(folder), str(tmp_path / "idx"), str(tmp_path / "ck2"), "ord")
    assert index.count() == 3  # each document once
