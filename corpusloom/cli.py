"""Command line: collect, hub, build, dedup, overlap, prepare, tokenize, budget."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions.text import file_stem
from .operators import dedup, sources, tokens
from .operators.overlap import OverlapIndex, overlap_report
from .plans import ingest, prepare as plans
from .runtime import path_exists, ship, stash
from .sources import readers, sinks


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("collect", help="merge a tree of text files into JSON lines")
    c.add_argument("--text-dir", required=True)
    c.add_argument("--output-dir", default="data")
    c = sub.add_parser("hub", help="take samples of a hosted data set into JSON lines")
    c.add_argument("--dataset", default="wikitext")
    c.add_argument("--split", default="train")
    c.add_argument("--max-samples", type=int, default=10_000)
    c.add_argument("--output-dir", default="data")
    c = sub.add_parser("build", help="fetch the catalogued sources, and report their tokens against the target")
    c.add_argument("--out", required=True)
    c.add_argument("--only", nargs="*")
    c = sub.add_parser("dedup", help="remove exact and near-duplicates")
    c.add_argument("--input", nargs="+", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--threshold", type=float, default=0.8)
    c = sub.add_parser("overlap", help="estimate how much of each input an indexed corpus holds")
    c.add_argument("--index", required=True, help="JSON lines to index, or an index made before")
    c.add_argument("--save", help="keep the index here, to be given as --index later")
    c.add_argument("--against", nargs="+", required=True)
    c.add_argument("--limit", type=int, default=150_000)
    c.add_argument("--population", type=int, required=True)
    c.add_argument("--probe", type=int, default=200)
    c.add_argument("--threshold", type=float, default=0.8)
    for name, fraction in (("prepare", 0.005), ("tokenize", 0.002)):
        c = sub.add_parser(name, help="clean, deduplicate, tokenise and split" if name == "prepare" else "tokenise JSON lines in order and split")
        c.add_argument("--input", nargs="+", required=True)
        c.add_argument("--out-dir", required=True)
        c.add_argument("--val-fraction", type=float, default=fraction)
        c.add_argument("--vocab", help="a tokenizer file; without one, ids are bytes and 256 ends a document")
        c.add_argument("--eos", help="the vocabulary's token that ends a document")
        c.add_argument("--parts", action="store_true", help="leave ordered parts with a manifest instead of flat files")
    c.add_argument("--limit", type=int)
    c = sub.add_parser("budget", help="documents, characters and estimated tokens by source")
    c.add_argument("--input", required=True)
    c.add_argument("--only", nargs="*")
    return p


def _tokenizer(vocab: str | None, eos: str | None) -> tuple[Callable[[], tokens.Tokenizer], int | None]:
    """What makes the tokenizer, and the end id."""
    if vocab is None:
        return tokens.ByteTokenizer, tokens.ByteTokenizer.eos_id
    make = tokens.vocabulary(vocab)
    if eos is None:
        return make, None
    end = make().id_of(eos)
    if end is None:
        raise ValueError(f"the vocabulary has no token {eos!r}")
    return make, end


def _indexed(spark: SparkSession, index: str, limit: int, save: str | None) -> OverlapIndex:
    if path_exists(spark, f"{index}/settings.json"):
        return OverlapIndex.open(spark, index)
    return OverlapIndex(path=save).add(readers.numbered_lines(spark, index, limit).where("text <> ''"))


def main(argv: list[str] | None = None, read: Callable[[SparkSession, sources.SourceSpec], DataFrame] = readers.hub_rows) -> int:
    """Run one command. ``read`` gives the rows of a catalogued source."""
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"corpusloom-{a.command}").getOrCreate()
    ship(spark)
    if a.command == "collect":
        rows, path = stash(readers.local_text(spark, a.text_dir), "local"), f"{a.output_dir}/local_text.jsonl"
        sinks.write_jsonl(rows.orderBy(F.split("path", "/")), path, ("text", "source"))
        print(f"merged {rows.count()} text files into {path}")
    elif a.command == "hub":
        spec, path = sources.SourceSpec(a.dataset, a.dataset, None, a.split, None, 0), f"{a.output_dir}/{file_stem(a.dataset)}_{a.split}.jsonl"
        rows = stash(read(spark, sources.SourceSpec(a.dataset, a.dataset, None, a.split, a.max_samples, 10)), "hub")
        for r in rows.where("interrupted is not null").take(1):
            print(f"interrupted: {r.interrupted}", file=sys.stderr)
        kept = readers.collected(rows.where("interrupted is null").withColumnRenamed(spec.text_field, "text"), cap=a.max_samples)
        sinks.write_jsonl(kept.orderBy("ord"), path)
        print(f"saved {spark.read.text(path).count()} samples to {path}")
    elif a.command == "build":
        print(ingest.report(ingest.ingest_all(spark, sources.SOURCES, lambda s: read(spark, s), a.out, a.only)))
    elif a.command == "dedup":
        docs = stash(readers.with_ord(readers.read_documents(spark, readers.existing(spark, a.input)), readers.INPUT_ORDER), "dedup-docs")
        kept, stats = dedup.near_dedup(docs, a.threshold)
        sinks.write_jsonl(kept.orderBy("ord"), a.out)
        print(dedup.format_dedup_stats(stats.first()))
    elif a.command == "overlap":
        index = _indexed(spark, a.index, a.limit, a.save)
        files = readers.text_documents(spark, readers.existing(spark, a.against))
        probes = readers.blocks(files, "path", per_file=a.probe).withColumn("ord", F.xxhash64("path", "block"))
        label = F.substring(F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1), 1, 14)
        probes = probes.withColumn("source", label)
        indexed = index.count()
        print(f"index: {indexed:,} documents, {index.buckets():,} buckets, {indexed / a.population:.1%} of the population")
        overlap_report(probes, index.matches(probes, a.threshold), indexed, a.population).show(1000, False)
    elif a.command in ("prepare", "tokenize"):
        make, end = _tokenizer(a.vocab, a.eos)
        if a.command == "prepare":
            print(json.dumps(plans.prepare(spark, a.input, a.out_dir, make, a.val_fraction, eos_id=end, joined=not a.parts)))
        else:
            frames = [readers.numbered_lines(spark, p, a.limit) for p in readers.existing(spark, a.input)]
            print(json.dumps(plans.tokenize_corpus(frames, a.out_dir, make, end, a.val_fraction, a.limit, joined=not a.parts)))
    else:
        docs = spark.read.parquet(a.input)
        sources.budget(docs.where(F.col("source").isin(a.only)) if a.only else docs).show(1000, False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
