"""End-to-end plans: clean, deduplicate, tokenise, split and write."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable

from pyspark.cloudpickle import dumps
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import dedup, tokens
from ..runtime import drop_path, read_text, stash, write_text
from ..sources import readers, sinks


def prepare(spark: SparkSession, paths: list[str], out_dir: str, make: Callable[[], tokens.Tokenizer], val_fraction: float = 0.005, min_chars: int = 64, eos_id: int | None = None, joined: bool = True) -> dict:
    """Clean, drop short and repeated texts, encode in input order, and write train.bin and val.bin.

    ``joined`` false leaves each as a folder of ordered parts with a manifest (``sinks.write_tokens``).
    """
    docs = stash(readers.with_ord(readers.read_documents(spark, readers.existing(spark, paths)).where("text is not null"), readers.INPUT_ORDER), "prepare-docs")
    groups = stash(dedup.cleaned_groups(docs), "prepare-groups")
    kept, stats = dedup.kept_groups(groups, min_chars), dedup.group_stats(groups, min_chars).first()
    if not stats.documents_kept:
        raise ValueError("no document is left after cleaning")
    encoded = stash(tokens.encode(kept, make, eos_id), "prepare-tokens")
    parts = stash(tokens.split(encoded, lambda n: tokens.val_size_batch(n, val_fraction)), "prepare-split")
    out = {w: sinks.write_tokens(tokens.part(parts, w), f"{out_dir}/{w}.bin", joined) for w in ("train", "val")}
    total = sum(x["n_tokens"] for x in out.values())
    return {"clean": stats.asDict(), **out, "tokens_per_char": total / max(1, stats.characters)}


def _encoding_id(lines: DataFrame, make: Callable[[], tokens.Tokenizer], eos_id: int | None, limit: int | None) -> str:
    """Names an encoding by its lines' positions and texts, the limit, the tokenizer and the end id.

    A tokenizer that cannot be serialised gives a new name each time, so it is never taken for another one.
    """
    content = lines.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(ord, text))"), F.expr("sum(cast(xxhash64(text, ord) as decimal(38, 0)))")).first()
    tokenizer = make()
    try:
        made = dumps((make, tokenizer))
    except Exception:  # noqa: BLE001 - whatever pickling raises
        made = uuid.uuid4().bytes
    sample = [tokenizer.encode(r.text) for r in lines.orderBy("ord").limit(20).collect()]
    return hashlib.sha256(made + repr((tuple(content), sample, eos_id, limit)).encode()).hexdigest()


def tokenize_corpus(
    frames: list[DataFrame], out_dir: str, make: Callable[[], tokens.Tokenizer], eos_id: int | None = None, val_fraction: float = 0.002, limit: int | None = None, order: str = "ord", chunk_lines: int = 2_000_000, joined: bool = True
) -> dict:
    """Encode inputs one after the other, without cleaning, and write both parts.

    Lines are encoded in chunks of ``chunk_lines``, each written under ``out_dir`` and then
    noted, with its documents and tokens, in ``tokenise.progress``. A run that is interrupted
    goes on after the last chunk whose note and files agree. The stage is named by what it
    encodes (``_encoding_id``), so other lines, another limit, tokenizer or end id start afresh;
    it is removed once both files are written. The report has documents and tokens a second.
    """
    began = time.perf_counter()
    spark = frames[0].sparkSession
    lines = stash(readers.ordered_union(frames, order, limit=limit).select(F.col("line").alias("ord"), "text"), "tokenize-lines")
    read = spark.read.schema("ord long, ids array<int>, n long").parquet
    stage, note = f"{out_dir}/tokens.stage", f"{out_dir}/tokenise.progress"
    name = _encoding_id(lines, make, eos_id, limit)
    done = json.loads(read_text(spark, note) or "{}")
    if done.get("encoding") != name:
        drop_path(spark, stage)  # of another encoding
        done = {"encoding": name, "docs": 0, "tokens": 0, "chunks": []}
    last = lines.agg(F.max("ord")).first()[0]
    if last is None:
        raise ValueError("the corpus has no tokens")
    for chunk in range(last // chunk_lines + 1):
        path = f"{stage}/chunk={chunk:08d}"
        if chunk < len(done["chunks"]):
            if sinks.committed(spark, path) and read(path).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] == done["chunks"][chunk][1]:
                continue
            done["chunks"] = done["chunks"][:chunk]  # what lies there is what counts
        some = lines.where((F.col("ord") >= chunk * chunk_lines) & (F.col("ord") < (chunk + 1) * chunk_lines))
        tokens.encode(some, make, eos_id).write.mode("overwrite").parquet(path)
        docs, n = read(path).agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        done["chunks"].append([docs, n])
        seconds = time.perf_counter() - began
        done |= {"docs": sum(d for d, _ in done["chunks"]), "tokens": sum(n for _, n in done["chunks"])}
        write_text(spark, note, json.dumps(done))  # after the data it describes
        print(f"  {done['docs']:>9,} docs  {done['tokens'] / 1e6:>7.1f}M tokens  {seconds:>5.0f}s  {done['tokens'] / seconds / 1e3:>6.0f}k tokens/s", flush=True)
    encoded = read(f"{stage}/*")
    parts = stash(tokens.split(encoded, lambda n: tokens.val_size_stream(n, val_fraction)), "tokenize-split")
    if parts.isEmpty():
        raise ValueError("the corpus has no tokens")
    out = {w: sinks.write_tokens(tokens.part(parts, w), f"{out_dir}/{w}.bin", joined) for w in ("train", "val")}
    distinct = tokens.distinct_in_prefix(tokens.part(parts, "train")).first()[0]
    elapsed = time.perf_counter() - began
    report = {**out, "docs": done["docs"], "elapsed_s": elapsed, "docs_per_s": done["docs"] / elapsed, "tokens_per_s": done["tokens"] / elapsed, "distinct_tokens_in_first_5M": distinct}
    write_text(spark, f"{out_dir}/report.json", json.dumps(report))
    drop_path(spark, stage)  # complete: nothing to resume
    drop_path(spark, note)
    return report
