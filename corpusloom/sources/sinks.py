"""Sinks: JSON lines with commit markers, and flat token files."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.tokens import as_uint16
from ..runtime import drop_path, file_size, path_exists, qualified, read_text, stash, write_text


def write_jsonl(df: DataFrame, path: str, fields: tuple[str, ...] = ("text",)) -> None:
    """One JSON object per row with the given fields, overwriting ``path``; null fields are left out."""
    df.select(F.to_json(F.struct(*fields)).alias("value")).write.mode("overwrite").text(path)


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a complete write lies at ``path``."""
    return path_exists(spark, f"{path}/_SUCCESS")


def write_source(df: DataFrame, path: str, source: str) -> dict:
    """Write a source once: a complete earlier write is skipped, a failed one leaves nothing complete.

    A reader that was cut off marks it by a row with a reason in a column ``interrupted``: what
    had arrived before is kept, and the reason is reported (cut to 90 characters). Returns a
    status row: source and docs, with interrupted or not; skipped; or error (cut to 120 characters).
    """
    spark = df.sparkSession
    if committed(spark, path):
        return {"source": source, "skipped": True}
    try:
        reason = None
        if "interrupted" in df.columns:
            df = stash(df.select("text", "interrupted"), "source")
            reason = df.where("interrupted is not null").agg(F.min("interrupted")).first()[0]
            df = df.where("interrupted is null")
        write_jsonl(df, path)
        docs = spark.read.text(path).count()
    except Exception as e:  # noqa: BLE001 - one source must not end the others
        return {"source": source, "error": str(e)[:120]}
    if not docs:
        drop_path(spark, path)  # an empty write must not count as complete
        return {"source": source, "error": (reason or "no documents")[:120]}
    return {"source": source, "docs": docs} | ({"interrupted": reason[:90]} if reason else {})


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or address, and the path on it."""
    if "://" in path or path.startswith("file:"):
        return pa.fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pa.fs.LocalFileSystem(), path


def _part_writer(folder: str):
    """Writes each task's rows, neighbours in the stream, as one file of 16-bit ids named by its first position and attempt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, base = _open(folder)
        first, last, tokens, out, name = -1, -1, 0, None, ""
        for batch in batches:
            if not batch.num_rows:
                continue
            before, lists = np.asarray(batch.column("before")), batch.column("ids")
            ends = before + np.asarray(lists.value_lengths())
            if (last >= 0 and before[0] != last) or (before[1:] != ends[:-1]).any():
                raise ValueError("rows of a part must be neighbours in the stream")
            if out is None:
                first = int(before[0])
                name = f"{first:020d}-{TaskContext.get().taskAttemptId()}.part"
                out = fs.open_output_stream(f"{base}/{name}")
            out.write(as_uint16(lists.flatten()))
            tokens, last = tokens + len(lists.flatten()), int(ends[-1])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([first]), pa.array([tokens])], ["name", "first", "tokens"])

    return run


def write_tokens(stream: DataFrame, path: str, joined: bool = False) -> dict:
    """Write (before, ids) as 16-bit ids in stream order; returns tokens and bytes.

    ``path`` becomes a folder of parts and ``manifest.json``, which lists them in order; tasks
    write their parts side by side on the file system that driver and executors share, and
    the manifest, written last, makes them count. What it doesn't list (of failed attempts)
    is removed. ``joined``: one flat file instead, to which the driver copies the parts, a
    few megabytes at a time. An earlier result is replaced only when the new one is complete.
    """
    spark = stream.sparkSession
    path = qualified(spark, path)
    folder = f"{path}.parts" if joined else path
    fs, base = _open(folder)
    drop_path(spark, folder)
    fs.create_dir(base, recursive=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = stream.select("before", "ids").repartitionByRange(parts, "before").sortWithinPartitions("before")
    made = sorted(laid.mapInArrow(_part_writer(folder), "name string, first long, tokens long").collect(), key=lambda r: r.first)  # one row per task
    at = 0
    for part in made:
        if made and part.first != made[0].first + at:
            raise ValueError("parts of the stream are missing")
        at += part.tokens
    listed = {r.name for r in made}
    for info in fs.get_file_info(pa.fs.FileSelector(base)):
        if info.base_name not in listed:
            fs.delete_file(info.path)
    write_text(spark, f"{folder}/manifest.json", json.dumps({"n_tokens": at, "parts": [[r.name, r.tokens] for r in made]}))
    if joined:
        join_parts(spark, folder, path)
        drop_path(spark, folder)
    return {"n_tokens": at, "n_bytes": 2 * at}


def join_parts(spark: SparkSession, folder: str, path: str, block: int = 8 << 20) -> None:
    """One flat file of the parts that the folder's manifest lists, copied block by block."""
    folder, path = qualified(spark, folder), qualified(spark, path)
    listed = json.loads(read_text(spark, f"{folder}/manifest.json"))
    fs, base = _open(folder)
    target_fs, target = _open(path)
    with target_fs.open_output_stream(f"{target}.joining") as out:
        for name, tokens in listed["parts"]:
            if file_size(spark, f"{folder}/{name}") != 2 * tokens:
                raise ValueError(f"{name} is not what the manifest says")
            with fs.open_input_stream(f"{base}/{name}") as part:
                while data := part.read(block):
                    out.write(data)
    target_fs.move(f"{target}.joining", target)


__all__ = ["committed", "join_parts", "write_jsonl", "write_source", "write_tokens"]
