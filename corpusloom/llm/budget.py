"""Token budget per source, language and domain (problem 2).

Texts are cut, inside the JVM, before every single space between two other characters
(no piece of the tokenizer crosses such a cut), and the parts are counted per slice with
map-side combination. Only distinct parts go on: they are split into the tokenizer's
pieces, stored as arrays of byte symbols, and all pieces of a block go through merge
rounds together. A round joins every adjacent pair with the table of merge ranks and
applies each piece's lowest-ranked merge; the rounds end when no pair joins. A part's
number of tokens times its counts, summed per slice, is the exact token count of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import stash
from .bpe import PATTERN, Merges, merges_path
from .mixing import canonical_source

# Java spelling of Unicode white space
_SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_CUT = rf"(?<=[^{_SPACE}])(?= [^{_SPACE}])"


def _counter(shared, blocks: int = 20_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, split = shared.value, regex.compile(PATTERN).findall
        for batch in batches:
            for begin in range(0, batch.num_rows, blocks):
                part = batch.slice(begin, blocks)
                pieces: dict[bytes, int] = {}
                used = [[pieces.setdefault(p.encode(), len(pieces)) for p in split(t)] for t in part.column("part").to_pylist()]
                _, bounds = merges.merge_rounds(list(pieces))
                tokens = np.diff(bounds)
                owner = np.repeat(np.arange(len(used)), [len(u) for u in used])
                flat = np.fromiter((i for u in used for i in u), np.int64)
                total = np.bincount(owner, weights=tokens[flat], minlength=len(used)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("part"), pa.array(total)], ["part", "tokens"])

    return run


def token_counts(df: DataFrame, by: list[str], column: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(*by, tokens): exact token counts per group of ``by``, groups without any token left out.

    ``by`` may be a key for counts per document. Nulls in ``by`` form groups; null and
    empty texts add nothing.
    """
    merges = df.sparkSession.sparkContext.broadcast(Merges(tokenizer or merges_path()))
    parts = df.where(F.length(column) > 0).select(*by, F.explode(F.split(column, _CUT)).alias("part"))
    counted = stash(parts.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("n")), "p2-parts")
    sized = stash(counted.select("part").distinct().mapInArrow(_counter(merges), "part string, tokens long"), "p2-sized")
    return counted.join(sized, "part").groupBy(*by).agg(F.sum(F.col("n") * F.col("tokens")).alias("tokens"))


def _clean(name: str) -> Column:
    """Trimmed and lower case; null, empty and ``und`` labels as null."""
    c = F.lower(F.trim(F.col(name)))
    return F.when((c != "") & (c != "und"), c)


def token_budget(documents: DataFrame, catalog: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(level, source, lang, domain, catalogued, docs, chars, tokens, tokens_per_char).

    ``level`` 'slice' has one row per source (spelled as in the catalogue), language and
    domain; 'source', 'lang', 'domain' and 'all' have the totals. Null in a column that the
    level groups by means: missing or no label. ``docs`` and ``chars`` count every document,
    also null and empty ones; ``catalogued`` is false for sources the catalogue lacks and
    null where the level doesn't name a source. An empty table gives no rows.
    """
    by = ["source", "lang", "domain"]
    docs = documents.select(canonical_source("source").alias("source"), _clean("lang").alias("lang"), F.col("domain"), "text")
    tokens = token_counts(docs, by, "text", tokenizer)
    plain = docs.groupBy(*by).agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0)).alias("chars"))
    same = [plain[c].eqNullSafe(tokens[c]) for c in by]
    slices = stash(plain.join(tokens, same[0] & same[1] & same[2], "left").select(*(plain[c] for c in by), "docs", "chars", F.coalesce(tokens["tokens"], F.lit(0)).alias("tokens")), "p2-slices")
    sums = [F.sum(c).alias(c) for c in ("docs", "chars", "tokens")]
    out = slices.select(F.lit("slice").alias("level"), *by, "docs", "chars", "tokens")
    for level in by:
        part = slices.groupBy(level).agg(*sums)
        out = out.unionByName(part.select(F.lit(level).alias("level"), *(F.col(c) if c == level else F.lit(None).cast("string").alias(c) for c in by), "docs", "chars", "tokens"))
    whole = slices.groupBy().agg(*sums).where("docs > 0")
    out = out.unionByName(whole.select(F.lit("all").alias("level"), *(F.lit(None).cast("string").alias(c) for c in by), "docs", "chars", "tokens"))
    known = catalog.select(canonical_source("name").alias("source"), F.lit(True).alias("known")).where("source is not null").distinct()
    named = F.col("level").isin("slice", "source")
    return out.join(known, "source", "left").select(
        "level", *by, F.when(named, F.coalesce("known", F.lit(False))).alias("catalogued"), "docs", "chars", "tokens", F.coalesce(F.try_divide("tokens", "chars"), F.lit(0.0)).alias("tokens_per_char")
    )
