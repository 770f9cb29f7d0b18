"""Readers: JSON lines, text files, ordered unions, blocks, and optional network sources."""

from __future__ import annotations

import json
import sys
import urllib.parse
import urllib.request
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import strip
from ..operators.prefix import running_total
from ..operators.sources import SourceSpec, first_per_group
from ..runtime import path_exists, stash

USER_AGENT = "corpusloom/0.1 (corpus research)"
#: Pages an answer of the random-page generator has at most; a fixed value of the service.
PAGES_PER_REQUEST = 20


def with_ord(df: DataFrame, order: list[str], out: str = "ord") -> DataFrame:
    """``df`` with the 0-based position of each row in ``order``, by a distributed prefix count."""
    return running_total(df.withColumn("_one", F.lit(1)), order, "_one", out).drop("_one")


def jsonl(spark: SparkSession, path: str | list[str], schema: str = "text string") -> DataFrame:
    """JSON lines with non-empty ``text``; a malformed line fails the query, blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path).where("text <> ''")


def text_documents(spark: SparkSession, path: str | list[str], suffix: str | None = None, recursive: bool = False) -> DataFrame:
    """(path, text): each file is a document. Bad bytes become U+FFFD, line ends become LF."""
    reader = spark.read.option("recursiveFileLookup", recursive)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    files = reader.format("binaryFile").load(path)
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return files.select("path", F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")).alias("text"))


#: The input order of ``read_documents``: inputs, files, splits of a file, lines of a split.
INPUT_ORDER = ["source_ord", "path", "split_start", "split_line"]


def jsonl_lines(spark: SparkSession, path: str | list[str], empty: bool = False) -> DataFrame:
    """(path, split_start, split_line, text): JSON lines with what orders them, however the files are split.

    ``empty`` keeps lines without text, which limits count.
    """
    rows = spark.read.schema("text string").option("mode", "FAILFAST").json(path)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split_start"), "text")
    rows = rows.select("path", "split_start", F.monotonically_increasing_id().alias("split_line"), "text")
    return rows if empty else rows.where("text <> ''")


def numbered_lines(spark: SparkSession, path: str | list[str], limit: int | None = None) -> DataFrame:
    """(ord, text): all lines of JSON files by position, also those without text, or the first ``limit`` of them.

    Under a limit only the splits that hold the first lines are laid out: lines are counted
    per split, and splits that begin after the limit drop out before anything is sorted.
    """
    rows = jsonl_lines(spark, path, empty=True)
    if limit is not None:
        split = ["path", "split_start"]
        counts = stash(rows.groupBy(*split).agg(F.count(F.lit(1)).alias("n")), "split-counts")  # one row per split
        ahead = running_total(counts, split, "n", "ahead")
        rows = rows.join(ahead.where(F.col("ahead") < limit).select(*split), split, "left_semi")
    placed = with_ord(rows, ["path", "split_start", "split_line"])
    placed = placed if limit is None else placed.where(F.col("ord") < limit)
    return placed.select("ord", "text")


def read_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_ord, path, split_start, split_line, text): .jsonl files by line, any other file as one document, to be taken in ``INPUT_ORDER``."""
    out = spark.createDataFrame([], "source_ord int, path string, split_start long, split_line long, text string")
    for i, path in enumerate(paths):
        rows = jsonl_lines(spark, path) if path.endswith(".jsonl") else text_documents(spark, path).select("*", F.lit(0).cast("long").alias("split_start"), F.lit(0).cast("long").alias("split_line"))
        out = out.unionByName(rows.withColumn("source_ord", F.lit(i)))
    return out


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist, on whatever file system; others are named on standard error, and none left is an error."""
    found = []
    for path in paths:
        if path_exists(spark, path):
            found.append(path)
        else:
            print(f"no such input: {path}", file=sys.stderr)
    if not found:
        raise FileNotFoundError("none of the inputs exists")
    return found


def local_text(spark: SparkSession, root: str, min_chars: int = 10) -> DataFrame:
    """(path, text, source): stripped ``.txt`` files under ``root`` with ``min_chars`` characters, by path components; the source is the file's path."""
    rows = text_documents(spark, root, ".txt", True).select("path", strip("text").alias("text"))
    return rows.where(F.length("text") >= min_chars).withColumn("source", F.regexp_replace("path", "^file:/+", "/")).orderBy(F.split("path", "/"))


def ordered_union(frames: list[DataFrame], order: str, skip: int = 0, limit: int | None = None, text: str = "text") -> DataFrame:
    """(source_ord, order, text, line): the inputs one after the other, by line position.

    ``skip`` and ``limit`` count lines, also empty ones; empty and null texts are dropped
    afterwards. A limit of 0 gives nothing.
    """
    out = None
    for i, frame in enumerate(frames):
        rows = frame.select(F.lit(i).alias("source_ord"), F.col(order).cast("long").alias("pos"), F.col(text).alias("text"))
        out = rows if out is None else out.unionByName(rows)
    placed = with_ord(out, ["source_ord", "pos"], "line")
    if skip:
        placed = placed.where(F.col("line") >= skip)
    if limit is not None:
        placed = placed.where(F.col("line") < limit)
    return placed.where("text <> ''")


def blocks(df: DataFrame, key: str = "ord", text: str = "text", longer_than: int = 200, per_file: int | None = None) -> DataFrame:
    """(key, block, text): stretches between blank lines longer than ``longer_than``; the first ``per_file`` of each."""
    rows = df.select(key, F.posexplode(F.split(text, "\n\n", -1)).alias("block", "text")).where(F.length("text") > longer_than)
    return rows if per_file is None else first_per_group(rows, key, "block", per_file)


def collected(df: DataFrame, key: str = "ord", text: str = "text", min_chars: int = 10, cap: int | None = None) -> DataFrame:
    """(key, text): stripped texts with ``min_chars`` characters, at most ``cap`` by key; the cap is tested after a row is taken."""
    rows = df.select(key, strip(text).alias("text")).where(F.length("text") >= min_chars)
    if cap is None:
        return rows
    # only keys are laid out and counted; the texts are filtered by the last key that is taken
    last = with_ord(rows.select(key), [key], "_pos").where(F.col("_pos") == max(1, cap) - 1).first()
    return rows if last is None else rows.where(F.col(key) <= F.lit(last[0]))


def wiki_extracts(payloads: DataFrame, payload: str = "payload", min_chars: int = 500) -> DataFrame:
    """(page, text): stripped page extracts of MediaWiki query answers with ``min_chars`` characters."""
    parsed = payloads.select(F.from_json(payload, "query struct<pages: map<string, struct<extract: string>>>").alias("j"))
    pages = parsed.select(F.explode("j.query.pages").alias("page", "v"))
    return pages.select("page", strip("v.extract").alias("text")).where(F.length("text") >= min_chars)


def request(url: str, timeout: int = 30) -> bytes:
    """GET with this package's user agent."""
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": USER_AGENT}), timeout=timeout) as answer:  # noqa: S310
        return answer.read()


def fetch_url(url: str, destination: str, timeout: int = 60) -> str:
    """Save what ``url`` answers, overwriting ``destination``; folders are made."""
    target = Path(destination)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(request(url, timeout))
    return str(target)


def wiki_url(lang: str) -> str:
    """The address that answers with the extracts of some random pages."""
    # The service's parameters.
    asked = {"action": "query", "format": "json", "generator": "random", "grnnamespace": 0, "grnlimit": PAGES_PER_REQUEST, "prop": "extracts", "explaintext": 1, "exlimit": PAGES_PER_REQUEST}
    return f"https://{lang}.wikipedia.org/w/api.php?{urllib.parse.urlencode(asked)}"


class WikipediaSource(DataSource):
    """``spark.read.format("wiki_random")``: answers of the random-page generator, one per row.

    Options: ``lang``, ``limit`` (pages of at least ``min_chars`` characters, split over
    ``readers`` that crawl side by side), ``timeout``. A reader stops at its share of the limit,
    at a failed request or at an answer without pages; the last two are told by a row with
    a reason in ``interrupted`` and no payload. Parse with ``wiki_extracts``, which takes ``cap``.
    """

    @classmethod
    def name(cls) -> str:
        return "wiki_random"

    def schema(self) -> str:
        return "payload string, interrupted string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _WikipediaReader(dict(self.options))


class _WikipediaReader(DataSourceReader):
    def __init__(self, options: dict):
        self.lang, self.timeout = options.get("lang", "te"), int(options.get("timeout", 30))
        self.limit, self.min_chars, self.readers = int(options.get("limit", 200)), int(options.get("min_chars", 500)), int(options.get("readers", 1))

    def partitions(self) -> list[InputPartition]:
        shares = [self.limit // self.readers + (i < self.limit % self.readers) for i in range(self.readers)]
        return [InputPartition(n) for n in shares if n > 0]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        pages = 0
        while pages < partition.value:
            try:
                answer = json.loads(request(wiki_url(self.lang), self.timeout))
                found = (answer.get("query") or {}).get("pages") or {}
            except (OSError, ValueError, AttributeError) as e:
                yield (None, f"{type(e).__name__}: {e}"[:120])
                return
            if not found:
                yield (None, "an answer without pages")
                return
            kept = {}
            for page, content in found.items():
                if pages < partition.value and len((content.get("extract") or "").strip()) >= self.min_chars:
                    kept[page] = {"extract": content["extract"]}
                    pages += 1
            yield (json.dumps({"query": {"pages": kept}}), None)


class HubSource(DataSource):
    """``spark.read.format("hub_rows")``: rows (text, interrupted) of a hosted data set, streamed by the package ``datasets``.

    Options: ``dataset``, ``config``, ``split``, ``field``, ``limit`` (rows of at least ``min_chars``
    characters), ``readers`` (shards read side by side; the limit is split over them). What
    arrived before a failure is given, then a row with the reason in ``interrupted``.
    """

    @classmethod
    def name(cls) -> str:
        return "hub_rows"

    def schema(self) -> str:
        return "text string, interrupted string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _HubReader(dict(self.options))


class _HubReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.readers = options, int(options.get("readers", 1))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.readers)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o, i = self.options, partition.value
        limit, taken = o.get("limit"), 0
        share = None if limit is None else int(limit) // self.readers + (i < int(limit) % self.readers)
        try:
            from datasets import load_dataset  # an optional package

            rows = load_dataset(o["dataset"], o.get("config") or None, split=o.get("split", "train"), streaming=True)
            if self.readers > 1:
                rows = rows.shard(num_shards=self.readers, index=i)
            for row in rows:
                text = row.get(o.get("field", "text")) or ""
                if len(text) < int(o.get("min_chars", 0)):
                    continue
                yield (text, None)
                taken += 1
                if share is not None and taken >= share:
                    return
        except Exception as e:  # noqa: BLE001 - what arrived before is kept
            yield (None, f"{type(e).__name__}: {str(e)[:90]}")


def hub_rows(spark: SparkSession, spec: SourceSpec, readers: int = 1) -> DataFrame:
    """(ord, text field, interrupted) of a catalogued source, as it arrives."""
    spark.dataSource.register(HubSource)
    asked = {"dataset": spec.dataset, "config": spec.config, "split": spec.split, "field": spec.text_field, "limit": spec.max_docs, "min_chars": spec.min_chars, "readers": readers}
    rows = spark.read.format("hub_rows").options(**{k: str(v) for k, v in asked.items() if v is not None}).load()
    return rows.select(F.monotonically_increasing_id().alias("ord"), F.col("text").alias(spec.text_field), "interrupted")
