"""Token streams: encoding behind a small protocol, positions, splits and statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .prefix import running_total


class Tokenizer(Protocol):
    """``encode`` of one text; a tokenizer may also offer ``encode_all`` of a column: flat ids and row boundaries."""

    def encode(self, text: str) -> list[int]: ...


class ByteTokenizer:
    """UTF-8 bytes as ids; 256 is free for the end of a document."""

    eos_id = 256

    def encode(self, text: str) -> list[int]:
        return list(text.encode("utf-8", "surrogatepass"))

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The column's own buffers are the ids."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(texts) else np.zeros(0, np.uint8)
        return raw, offsets - offsets[0]


class VocabTokenizer:
    """A tokenizer file (JSON) of the public ``tokenizers`` package, without special tokens in the text.

    Made once per task from ``path``, or from the file's content, which a driver can read
    and hand to executors that lack the file.
    """

    def __init__(self, path: str | None = None, content: str | None = None):
        try:
            import tokenizers
        except ImportError as e:  # an optional package
            raise RuntimeError("vocabulary files need the package 'tokenizers'") from e
        self.model = tokenizers.Tokenizer.from_str(content) if content is not None else tokenizers.Tokenizer.from_file(path)
        self.model.encode_special_tokens = True

    @property
    def size(self) -> int:
        return self.model.get_vocab_size()

    def id_of(self, token: str) -> int | None:
        return self.model.token_to_id(token)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, add_special_tokens=False).ids

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.model.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        bounds = np.zeros(len(ids) + 1, np.int64)
        np.cumsum([len(i) for i in ids], out=bounds[1:])
        return np.fromiter((x for i in ids for x in i), np.int64, bounds[-1]), bounds


def vocabulary(path: str) -> Callable[[], VocabTokenizer]:
    """What makes the tokenizer of a vocabulary file in each task; the file is read here, on the driver."""
    with open(path, encoding="utf-8") as f:
        content = f.read()
    return partial(VocabTokenizer, None, content)


def _lists(tokenizer: Tokenizer, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if hasattr(tokenizer, "encode_all") and type(tokenizer).encode in (ByteTokenizer.encode, VocabTokenizer.encode):
        return tokenizer.encode_all(texts)
    ids = [tokenizer.encode(t) for t in texts.to_pylist()]
    bounds = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(i) for i in ids], out=bounds[1:])
    return np.fromiter((x for i in ids for x in i), np.int64, bounds[-1]), bounds


def encode(df: DataFrame, make: Callable[[], Tokenizer], eos_id: int | None = None, key: str = "ord", text: str = "text") -> DataFrame:
    """(key, ids, n): each non-empty text's ids, with the end id after each document if given.

    ``make`` builds the tokenizer once per task. Null and empty texts are skipped. Ids go
    from arrays to Arrow lists, without a Python list per document where the tokenizer allows it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                flat, bounds = _lists(tokenizer, part.column(text))
                if eos_id is not None:
                    whole = np.full(len(flat) + part.num_rows, eos_id, np.int32)
                    keep = np.ones(len(whole), bool)
                    bounds = bounds + np.arange(len(bounds))
                    keep[bounds[1:] - 1] = False
                    whole[keep] = flat
                    flat = whole
                ids = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(key), ids, pa.array(np.diff(bounds))], [key, "ids", "n"])

    rows = df.where(F.col(text) != "").select(F.col(key).cast("long").alias(key), text)
    return rows.mapInArrow(run, f"{key} long, ids array<int>, n long")


def val_size_batch(total: int, fraction: float = 0.005) -> int:
    """Validation tokens of the in-memory preparation: what is left behind the cut."""
    return total - int(total * (1.0 - fraction))


def val_size_stream(total: int, fraction: float = 0.002) -> int:
    """Validation tokens of the streaming tokeniser: at least one."""
    if total < 1:
        raise ValueError("no tokens to split")
    return max(1, int(total * fraction))


def split(tokens: DataFrame, val_size: Callable[[int], int], key: str = "ord") -> DataFrame:
    """(key, ids, n, before, train_n, val_n): the tail of the stream is validation, by position.

    The document on the boundary is cut: its first ``train_n`` ids are training. Only the
    total reaches the driver.
    """
    placed = running_total(tokens, [key], "n")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    cut = total - val_size(total) if total else 0
    train = F.greatest(F.lit(0), F.least(F.col("n"), F.lit(cut) - F.col("before")))
    return placed.withColumn("train_n", train.cast("long")).withColumn("val_n", F.col("n") - F.col("train_n"))


def part(split_tokens: DataFrame, which: str, key: str = "ord") -> DataFrame:
    """(key, before, ids) of the 'train' or 'val' part, without empty rows."""
    if which == "train":
        rows = split_tokens.where("train_n > 0").select(key, "before", F.expr("slice(ids, 1, cast(train_n as int))").alias("ids"))
    else:
        rows = split_tokens.where("val_n > 0").select(key, (F.col("before") + F.col("train_n")).alias("before"), F.expr("slice(ids, cast(train_n as int) + 1, cast(val_n as int))").alias("ids"))
    return rows


def distinct_in_prefix(train: DataFrame, limit: int = 5_000_000, key: str = "ord") -> DataFrame:
    """One row: distinct ids among the stream's first ``limit`` positions."""
    near = train.where(F.col("before") < limit).select(F.expr(f"slice(ids, 1, cast(least(size(ids), {limit} - before) as int))").alias("ids"))
    return near.select(F.explode("ids").alias("id")).agg(F.count_distinct("id").alias("distinct_tokens"))


def as_uint16(ids) -> bytes:  # noqa: ANN001
    """Little-endian 16-bit ids; one that does not fit is an error."""
    a = np.asarray(ids, np.int64)
    if len(a) and (a.min() < 0 or a.max() > 0xFFFF):
        raise OverflowError("token id outside 0..65535")
    return a.astype("<u2").tobytes()
