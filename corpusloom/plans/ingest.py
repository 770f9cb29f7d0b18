"""Building a corpus source by source: filter, cap, write once, report."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.sources import TOKEN_TARGET, TOKENS_PER_CHAR, SourceSpec, catalogue_frame, capped
from ..runtime import file_size, stash
from ..sources import sinks

STATUS = "source string, docs long, chars long, est_tokens long, gb double, elapsed_s double, interrupted string, skipped boolean, bytes_on_disk long, error_msg string"


def input_bytes(df: DataFrame) -> int:
    """Total size of the files a frame is read from; files are listed, not read."""
    spark = df.sparkSession
    return sum(file_size(spark, f) for f in df.inputFiles())


def ingest_source(spec: SourceSpec, df: DataFrame, out_dir: str, order: str = "ord") -> dict:
    """Write one source's texts under ``out_dir`` and return its status row.

    ``df`` has the source's rows with ``spec.text_field`` and ``order``. Texts under
    ``min_chars`` are dropped, the first ``max_docs`` are kept. A source that lies there
    complete is skipped; one that fails is reported (error cut to 120 characters) and
    leaves nothing that a later call would take for complete. Where ``df`` has a column
    ``interrupted``, its rows with a reason there mark where reading was cut off: what had
    arrived is kept, and the reason (cut to 90 characters) is in the status.
    """
    spark, path, began = df.sparkSession, f"{out_dir}/{spec.name}.jsonl", time.perf_counter()
    empty = dict.fromkeys((f.split()[0] for f in STATUS.split(", "))) | {"source": spec.name}
    if sinks.committed(spark, path):
        return empty | {"skipped": True, "bytes_on_disk": file_size(spark, path)}
    reasons = None
    try:
        if "interrupted" in df.columns:
            df = stash(df, "arrived")  # read once: a second pass could be cut off elsewhere
            reasons = df.where("interrupted is not null").select("interrupted")
            df = df.where("interrupted is null")
        rows = df.select(F.col(order).alias("ord"), F.coalesce(F.col(spec.text_field), F.lit("")).alias("text"), F.lit(spec.name).alias("source"))
        kept = capped(rows, catalogue_frame(spark, [spec]))
        if reasons is not None:
            kept = kept.withColumn("interrupted", F.lit(None).cast("string")).unionByName(reasons, allowMissingColumns=True)
        status = sinks.write_source(kept, path, spec.name)
        if "error" in status:
            return empty | {"error_msg": status["error"]}
        chars = spark.read.schema("text string").json(path).agg(F.sum(F.length("text").cast("long"))).first()[0]
    except Exception as e:  # noqa: BLE001 - one source must not end the others
        return empty | {"error_msg": str(e)[:120]}
    return empty | {"interrupted": status.get("interrupted"), "docs": status["docs"], "chars": chars, "est_tokens": int(chars * TOKENS_PER_CHAR), "gb": file_size(spark, path) / 1e9, "elapsed_s": time.perf_counter() - began}


def ingest_all(spark: SparkSession, specs: list[SourceSpec], read: Callable[[SourceSpec], DataFrame], out_dir: str, only: list[str] | None = None) -> DataFrame:
    """The status rows of all sources, in order; a source that cannot be read is reported like one that cannot be written."""
    out = []
    for spec in specs:
        if only and spec.name not in only:
            continue
        try:
            df = read(spec)
        except Exception as e:  # noqa: BLE001
            out.append(dict.fromkeys((f.split()[0] for f in STATUS.split(", "))) | {"source": spec.name, "error_msg": str(e)[:120]})
            continue
        out.append(ingest_source(spec, df, out_dir))
    return spark.createDataFrame(out, STATUS)


def report(status: DataFrame) -> str:
    """The status rows as lines of text, and the estimated total against the target."""
    lines, total = [], 0
    for r in status.collect():  # one row per source
        if r.skipped:
            lines.append(f"{r.source}: already there ({r.bytes_on_disk / 1e9:.2f} GB), skipped")
        elif r.error_msg:
            lines.append(f"{r.source}: {r.error_msg}")
        else:
            total += r.est_tokens
            rate = r.docs / max(r.elapsed_s, 1e-9)
            lines.append(f"{r.source}: {r.docs:,} documents, {r.gb:.2f} GB, about {r.est_tokens / 1e9:.2f}B tokens, {r.elapsed_s:.0f} s, {rate:,.0f} documents/s" + (f", interrupted: {r.interrupted}" if r.interrupted else ""))
    return "\n".join([*lines, f"estimated tokens: {total / 1e9:.2f}B of {TOKEN_TARGET / 1e9:.2f}B"])
