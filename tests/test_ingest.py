from pyspark.sql import functions as F

from corpusloom import cli
from corpusloom.operators.sources import SOURCES, SourceSpec
from corpusloom.plans import ingest


def test_ingest(spark, frame, tmp_path):
    specs = [SourceSpec("good", "d", None, "train", 2, 3), SourceSpec("gone", "d", None, "train", 5), SourceSpec("none", "d", None, "train", 5, 1000), SourceSpec("left", "d", None, "train", 5)]

    def read(spec):
        if spec.name == "gone":
            raise OSError("gated " * 60)
        return frame(["ab", "abc", None, "abcd", "abcde"])

    rows = {r.source: r for r in ingest.ingest_all(spark, specs, read, str(tmp_path), ["good", "gone", "none"]).collect()}
    assert (rows["good"].docs, rows["good"].chars, rows["good"].est_tokens) == (2, 7, 1) and rows["good"].gb > 0
    assert len(rows["gone"].error_msg) == 120 and rows["none"].error_msg == "no documents" and "left" not in rows
    again = ingest.ingest_source(specs[0], frame(["x"]), str(tmp_path))
    assert again["skipped"] and again["bytes_on_disk"] > 0
    assert ingest.ingest_source(specs[2], frame(["x" * 2000]), str(tmp_path))["docs"] == 1  # nothing was left behind
    assert ingest.input_bytes(spark.read.text(str(tmp_path / "good.jsonl"))) > 0


def test_what_arrived_before_an_interruption_is_kept(spark, frame, tmp_path, capsys):
    cut = frame(["abcd", "ab", "efgh", None]).withColumn("interrupted", F.when(F.col("text").isNull(), F.lit("OSError: line lost")))
    spec = SourceSpec("part", "d", None, "train", 5, 3)
    row = ingest.ingest_all(spark, [spec], lambda s: cut, str(tmp_path)).first()
    assert (row.docs, row.chars, row.interrupted, row.error_msg) == (2, 8, "OSError: line lost", None)
    again = ingest.ingest_all(spark, [spec], lambda s: cut, str(tmp_path))
    assert again.first().skipped and "skipped" in ingest.report(again)


def test_build_and_hub_commands(spark, frame, tmp_path, capsys):
    def read(spark, spec):
        if spec.name == "c4":
            raise OSError("gated")
        return frame(["x" * 250, "short", "y" * 300]).withColumn("interrupted", F.lit(None).cast("string"))

    assert [s.name for s in SOURCES] == ["fineweb2", "c4", "sangraha", "indiccorp", "wikipedia"]
    assert cli.main(["build", "--out", str(tmp_path / "b"), "--only", "fineweb2", "c4"], read) == 0
    out = capsys.readouterr().out
    assert "fineweb2: 2 documents" in out and "c4: gated" in out and "of 2.77B" in out
    assert not (tmp_path / "b" / "c4.jsonl").exists()
    assert cli.main(["hub", "--dataset", "a/b", "--max-samples", "1", "--output-dir", str(tmp_path / "h")], read) == 0
    assert "saved 1 samples" in capsys.readouterr().out and (tmp_path / "h" / "a_b_train.jsonl").exists()
