"""The queries of the engine's own operators, and the SQL that DuckDB runs for comparison."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import minhash as M
from ..functions import text as T
from ..operators import dedup, sources, tokens
from ..operators.components import connected_components
from ..operators.overlap import OverlapIndex, overlap_report
from ..runtime import load, stash, temporary_path
from ..sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- shared SQL -----------------------------------------------------------------------

W = T.SPACE
DOCS = "d AS (SELECT doc_id AS ord, text, lang, source FROM documents WHERE text <> '')"


def _strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '\A[{W}]+|[{W}]+\z', '', 'g')"


def _clean_sql(x: str) -> str:
    # piece by piece between NULs, at which DuckDB's nfc_normalize ends a string
    t = f"array_to_string(list_transform(string_split({x}, chr(0)), lambda p: nfc_normalize(p)), chr(0))"
    t = rf"regexp_replace({t}, '{T.CONTROL}', '', 'g')"
    t = f"replace(replace({t}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    t = rf"regexp_replace({t}, '[ \t]+', ' ', 'g')"
    t = f"array_to_string(list_transform(string_split({t}, chr(10)), lambda l: {_strip_sql('l')}), chr(10))"
    return _strip_sql(rf"regexp_replace({t}, '\n{{3,}}', chr(10) || chr(10), 'g')")


WORDS = rf"regexp_extract_all(text, '[^{W}]+')"
CLEAN = f"c AS (SELECT ord, {_clean_sql('text')} AS text FROM d)"
UNIQUE = f"u AS (SELECT min(ord) AS ord, arg_min(text, ord) AS text FROM (SELECT ord, text, {_strip_sql('text')} AS s FROM d) GROUP BY s)"
FIVE = " || ' ' || ".join(f"w[i + {k}]" for k in range(5))
H32 = "('0x' || substr(md5(g), 1, 8))::BIGINT"


def _shingles_sql(table: str) -> str:
    return f"""w AS (SELECT ord, text, {WORDS} AS w FROM {table}),
g AS (SELECT ord, {FIVE} AS g FROM (SELECT ord, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5) UNION ALL SELECT ord, text FROM w WHERE len(w) < 5),
h AS (SELECT DISTINCT ord, {H32} AS h FROM g)"""


def _perms_sql() -> str:
    a, b = M.coefficients()
    return "p(perm, a, b) AS (VALUES " + ", ".join(f"({i}, {x}::HUGEINT, {y}::HUGEINT)" for i, (x, y) in enumerate(zip(a.tolist(), b.tolist()))) + ")"


SIGNED = f"{_perms_sql()}, sig AS (SELECT ord, perm, min(((a * h + b) % 18446744073709551616::HUGEINT) % 2305843009213693951::HUGEINT)::BIGINT AS v FROM h, p GROUP BY ord, perm)"
BANDS = "bands AS (SELECT ord, perm // 8 AS band, string_agg(v::VARCHAR, ',' ORDER BY perm) AS bucket FROM sig GROUP BY ord, perm // 8)"
STARS = """firsts AS (SELECT band, bucket, min(ord) AS src FROM bands GROUP BY band, bucket HAVING count(*) > 1),
pairs AS (SELECT DISTINCT src, ord AS dst FROM bands JOIN firsts USING (band, bucket) WHERE src < ord),
edges AS (SELECT src, dst, count(*) FILTER (x.v = y.v) / 128.0::DOUBLE AS sim FROM pairs JOIN sig x ON x.ord = src JOIN sig y ON y.ord = dst AND y.perm = x.perm GROUP BY src, dst)"""
NEAR = f"{DOCS}, {UNIQUE}, {_shingles_sql('u')}, {SIGNED}, {BANDS}, {STARS}"


def _labels_sql(threshold: float = 0.8) -> str:
    return f"""both_ways AS (SELECT src AS x, dst AS y FROM edges WHERE sim >= {threshold} UNION SELECT dst, src FROM edges WHERE sim >= {threshold}),
reach AS (SELECT x AS ord, x AS r FROM both_ways UNION SELECT reach.ord, y FROM reach JOIN both_ways ON x = r),
labels AS (SELECT u.ord, coalesce(min(r), u.ord) AS cluster FROM u LEFT JOIN reach ON reach.ord = u.ord GROUP BY u.ord)"""


def docs(spark: SparkSession, d: str, spread: bool = True) -> DataFrame:
    """(ord, text, lang, source) of the non-empty documents."""
    return load(spark, d, "documents", spread).where("text <> ''").select(F.col("doc_id").alias("ord"), "text", "lang", "source")


# --- projections, filters, cleaning -----------------------------------------------------


@query(f"WITH {DOCS} SELECT ord, text FROM d")
def project_nonempty_text(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d, False).select("ord", "text")


@query(f"WITH {DOCS}, {CLEAN} SELECT ord, text FROM c")
def clean_text_norm(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("ord", T.clean_text("text").alias("text"))


@query(f"WITH {DOCS}, {CLEAN} SELECT ord FROM c WHERE length(text) >= 64")
def filter_min_chars_clean(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).where(F.length(T.clean_text("text")) >= 64).select("ord")


@query(f"WITH {DOCS} SELECT ord FROM d WHERE length(text) >= 200")
def filter_min_chars_raw(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d, False).where(F.length("text") >= 200).select("ord")


@query(f"WITH {DOCS} SELECT ord, {_strip_sql('text')} AS text FROM d WHERE length({_strip_sql('text')}) >= 10")
def filter_min_chars_stripped(spark: SparkSession, d: str) -> DataFrame:
    return readers.collected(docs(spark, d, False))


@query(f"WITH {DOCS}, s AS (SELECT ord, {_strip_sql('text')} AS text FROM d) SELECT ord, text FROM (SELECT *, row_number() OVER (ORDER BY ord) AS n FROM s WHERE length(text) >= 10) WHERE n <= 500")
def collected_capped(spark: SparkSession, d: str) -> DataFrame:
    """The first 500 stripped texts: the limit is the operator."""
    return readers.collected(docs(spark, d, False), cap=500)


@query(f"WITH {DOCS} SELECT lang, count(*) AS docs, count(*) FILTER (regexp_matches(text, '[\\x{{0C00}}-\\x{{0C7F}}]')) AS with_script, count(*) FILTER (regexp_matches(text, '[\\x{{0C00}}-\\x{{0C7F}}]')) / count(*)::DOUBLE AS share FROM d GROUP BY lang")
def script_share_by_lang(spark: SparkSession, d: str) -> DataFrame:
    hit = F.count(F.when(T.has_script("text"), 1))
    return docs(spark, d, False).groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), hit.alias("with_script"), (hit / F.count(F.lit(1))).alias("share"))


# --- exact duplicates -------------------------------------------------------------------


@query(f"WITH {DOCS}, {CLEAN} SELECT min(ord) AS ord, text FROM c WHERE length(text) >= 64 GROUP BY text")
def exact_dedup_clean(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_dedup_clean(docs(spark, d))


@query(
    f"""WITH {DOCS}, {CLEAN}, ok AS (SELECT * FROM c WHERE length(text) >= 64), k AS (SELECT DISTINCT text FROM ok)
SELECT (SELECT count(*) FROM c) AS documents_in, (SELECT count(*) FROM k) AS documents_kept, (SELECT count(*) FROM ok) - (SELECT count(*) FROM k) AS duplicates,
(SELECT count(*) FROM c WHERE length(text) < 64) AS too_short, (SELECT count(*) FROM k WHERE regexp_matches(text, '[\\x{{0C00}}-\\x{{0C7F}}]')) AS script_docs,
(SELECT coalesce(sum(length(text)), 0)::BIGINT FROM k) AS characters,
coalesce((SELECT count(*) FROM k WHERE regexp_matches(text, '[\\x{{0C00}}-\\x{{0C7F}}]')) / nullif((SELECT count(*) FROM k), 0)::DOUBLE, 0) AS script_share"""
)
def clean_stats(spark: SparkSession, d: str) -> DataFrame:
    return dedup.clean_stats(docs(spark, d))


@query(f"WITH {DOCS}, {UNIQUE} SELECT ord, text FROM u")
def exact_dedup_strip(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_dedup_strip(docs(spark, d))


@query(f"WITH {DOCS}, s AS (SELECT ord, {_strip_sql('text')} AS s FROM d) SELECT count(*) AS rows, s FROM s GROUP BY s HAVING count(*) > 1")
def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select(T.strip("text").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


# --- words, shingles, signatures ---------------------------------------------------------


@query(f"WITH {DOCS} SELECT ord, len({WORDS}) AS words, len(list_distinct({WORDS})) AS distinct_words FROM d")
def word_counts(spark: SparkSession, d: str) -> DataFrame:
    w = T.words("text")
    return docs(spark, d).select("ord", F.size(w).cast("long").alias("words"), F.size(F.array_distinct(w)).cast("long").alias("distinct_words"))


@query(f"WITH {DOCS}, w AS (SELECT ord, {WORDS} AS w FROM d) SELECT ord, i AS pos, {FIVE} AS gram FROM (SELECT ord, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)")
def word_ngrams(spark: SparkSession, d: str) -> DataFrame:
    grams = docs(spark, d).select("ord", F.posexplode(T.ngrams(T.words("text"))).alias("pos", "gram"))
    return grams.select("ord", (F.col("pos") + 1).cast("long").alias("pos"), "gram")


@query(f"WITH {DOCS}, {_shingles_sql('d')} SELECT ord, h FROM h")
def shingle_hashes(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("ord", F.explode(T.shingle_hashes("text")).alias("h"))


def _signed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return dedup.unique_signed(docs(spark, d), kind="md5")


@query(f"WITH {DOCS}, {UNIQUE}, {_shingles_sql('u')}, {SIGNED} SELECT ord, perm, v AS value FROM sig")
def minhash_signature(spark: SparkSession, d: str) -> DataFrame:
    return _signed(spark, d)[1].select("ord", F.posexplode("sig").alias("perm", "value"))


@query(f"WITH {DOCS}, {UNIQUE}, {_shingles_sql('u')}, {SIGNED}, {BANDS} SELECT ord, band, bucket FROM bands")
def lsh_bands(spark: SparkSession, d: str) -> DataFrame:
    return M.bands(_signed(spark, d)[1]).select("ord", "band", F.array_join(F.col("bucket").cast("array<string>"), ",").alias("bucket"))


@query(f"WITH {DOCS}, {UNIQUE}, {_shingles_sql('u')}, {SIGNED}, {BANDS}, s AS (SELECT count(*) AS size FROM bands GROUP BY band, bucket) SELECT size, count(*) AS buckets FROM s GROUP BY size")
def lsh_bucket_sizes(spark: SparkSession, d: str) -> DataFrame:
    per = M.bands(_signed(spark, d)[1]).groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("size"))
    return per.groupBy("size").agg(F.count(F.lit(1)).alias("buckets"))


# --- near-duplicates ----------------------------------------------------------------------


@query(f"WITH {NEAR} SELECT src, dst, sim FROM edges WHERE sim >= 0.8")
def near_dup_edges(spark: SparkSession, d: str) -> DataFrame:
    return dedup.star_edges(_signed(spark, d)[1])


@query(f"WITH RECURSIVE {NEAR}, {_labels_sql()} SELECT ord, cluster FROM labels")
def near_dup_clusters(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_dup_clusters(docs(spark, d), kind="md5")


@query(f"WITH RECURSIVE {NEAR}, {_labels_sql()} SELECT ord, text FROM u WHERE ord IN (SELECT ord FROM labels WHERE ord = cluster)")
def near_dedup_kept(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_dedup(docs(spark, d), kind="md5")[0]


@query(
    f"""WITH RECURSIVE {NEAR}, {_labels_sql()}, n AS (SELECT (SELECT count(*) FROM d) AS documents_in, (SELECT count(*) FROM labels WHERE ord = cluster) AS documents_kept, (SELECT count(*) FROM u) AS uniq)
SELECT documents_in, documents_kept, documents_in - uniq AS exact_duplicates, uniq - documents_kept AS near_duplicates, 1 - documents_kept / documents_in::DOUBLE AS removed_fraction FROM n"""
)
def dedup_stats(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_dedup(docs(spark, d), kind="md5")[1]


@query(f"WITH {NEAR} SELECT src, dst, sim FROM edges WHERE sim >= 0.6")
def near_dup_edges_06(spark: SparkSession, d: str) -> DataFrame:
    """Edges at 0.6 among the default candidates, which hold a pair at 0.6 with probability 0.24 (``dedup.threshold_sweep``)."""
    return dedup.star_edges(_signed(spark, d)[1], 0.6)


@query(
    f"""WITH RECURSIVE {NEAR}, th AS (SELECT unnest([0.5, 0.6, 0.7, 0.8, 0.9, 0.95]::DOUBLE[]) AS t),
both_ways AS (SELECT t, src AS x, dst AS y FROM edges, th WHERE sim >= t UNION SELECT t, dst, src FROM edges, th WHERE sim >= t),
reach AS (SELECT t, x AS ord, x AS r FROM both_ways UNION SELECT reach.t, reach.ord, y FROM reach JOIN both_ways b ON b.x = r AND b.t = reach.t),
low AS (SELECT t, ord, min(r) AS r FROM reach GROUP BY t, ord)
SELECT th.t AS threshold, count(*) FILTER (low.r < low.ord) AS near_duplicates FROM th LEFT JOIN low ON low.t = th.t GROUP BY th.t"""
)
def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    """Near-duplicates at six thresholds among the default candidates, which miss most pairs at 0.5 and 0.6 (``dedup.threshold_sweep``)."""
    return dedup.threshold_sweep(docs(spark, d), kind="md5")


@query(
    f"""WITH {NEAR}, e AS (SELECT src, dst FROM edges WHERE sim >= 0.8), n AS (SELECT ord, count(*) AS n FROM h GROUP BY ord),
c AS (SELECT src, dst, count(b.h) AS c FROM e JOIN h a ON a.ord = src LEFT JOIN h b ON b.ord = dst AND b.h = a.h GROUP BY src, dst)
SELECT src, dst, c / (x.n + y.n - c)::DOUBLE AS jaccard FROM c JOIN n x ON x.ord = src JOIN n y ON y.ord = dst"""
)
def true_jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    unique, signed = _signed(spark, d)
    return dedup.true_jaccard(unique, dedup.star_edges(signed))


@query()
def near_dedup_blake2b(spark: SparkSession, d: str) -> DataFrame:
    """The default shingle hash, which SQL does not have."""
    return dedup.near_dedup(docs(spark, d))[0].select("ord")


@query(
    """WITH RECURSIVE e AS (SELECT ps_a AS x, ps_b AS y FROM (SELECT (s_nationkey + 1000)::BIGINT AS ps_a, (s_suppkey + 100000)::BIGINT AS ps_b FROM supplier)),
b AS (SELECT x, y FROM e UNION SELECT y, x FROM e), r AS (SELECT x AS node, x AS r FROM b UNION SELECT node, y FROM r JOIN b ON b.x = r.r)
SELECT node, min(r) AS component FROM r GROUP BY node"""
)
def components_supplier_nation(spark: SparkSession, d: str) -> DataFrame:
    """Connected components of a bipartite graph with hot nodes."""
    s = load(spark, d, "supplier")
    return connected_components(s.select((F.col("s_nationkey") + 1000).cast("long").alias("src"), (F.col("s_suppkey") + 100000).alias("dst")))


# --- overlap ------------------------------------------------------------------------------

LINES = "d AS (SELECT line_id AS ord, text, source, split FROM corpus_lines WHERE text <> '' AND split IN ('train', 'validation', 'test'))"
OVERLAP = f"""{LINES}, held AS (SELECT * FROM d WHERE split = 'train'), asked AS (SELECT * FROM d WHERE split <> 'train' AND length(text) > 200),
both_sides AS (SELECT ord, text FROM held UNION ALL SELECT ord, text FROM asked), {_shingles_sql('both_sides')}, {SIGNED}, {BANDS},
pairs AS (SELECT DISTINCT a.ord AS probe, b.ord AS indexed FROM bands a JOIN bands b USING (band, bucket) SEMI JOIN asked ON asked.ord = a.ord SEMI JOIN held ON held.ord = b.ord),
scored AS (SELECT probe, indexed, count(*) FILTER (x.v = y.v) / 128.0::DOUBLE AS sim FROM pairs JOIN sig x ON x.ord = probe JOIN sig y ON y.ord = indexed AND y.perm = x.perm GROUP BY probe, indexed)"""


def _overlap(spark: SparkSession, d: str) -> tuple[OverlapIndex, DataFrame]:
    """The training split indexed, and the held-out lines of more than 200 characters that probe it."""
    lines = load(spark, d, "corpus_lines").where("text <> ''").select(F.col("line_id").alias("ord"), "text", "source", "split")
    return OverlapIndex(kind="md5").add(lines.where("split = 'train'")), lines.where("split in ('validation', 'test') and length(text) > 200").drop("split")


@query(f"WITH {OVERLAP} SELECT DISTINCT probe AS ord FROM scored WHERE sim >= 0.8")
def overlap_hits(spark: SparkSession, d: str) -> DataFrame:
    index, probes = _overlap(spark, d)
    return index.matches(probes).select("ord")


@query(f"WITH {OVERLAP} SELECT probe, indexed, sim FROM scored WHERE sim >= 0.8")
def overlap_pairs(spark: SparkSession, d: str) -> DataFrame:
    index, probes = _overlap(spark, d)
    return index.pairs(probes)


@query(
    f"""WITH {OVERLAP}, hits AS (SELECT DISTINCT probe AS ord FROM scored WHERE sim >= 0.8), c AS (SELECT count(*) / 1000000.0::DOUBLE AS coverage FROM held)
SELECT source, count(*) AS probes, count(hits.ord) AS hits, count(hits.ord) / count(*)::DOUBLE AS raw_rate, any_value(coverage) AS coverage, least(1.0, (count(hits.ord) / count(*)::DOUBLE) / any_value(coverage)) AS est_rate
FROM asked LEFT JOIN hits ON hits.ord = asked.ord, c GROUP BY source"""
)
def overlap_rates(spark: SparkSession, d: str) -> DataFrame:
    index, probes = _overlap(spark, d)
    return overlap_report(probes, index.matches(probes), index.count(), 1_000_000)


@query(
    f"""WITH d AS (SELECT doc_id * 2 + 1 AS ord, text FROM documents WHERE text <> ''), held AS (SELECT item_id * 2 AS ord, text FROM benchmark WHERE text <> ''),
both_sides AS (SELECT * FROM d UNION ALL SELECT * FROM held), {_shingles_sql('both_sides')}, {SIGNED}, bands AS (SELECT ord, perm // 2 AS band, string_agg(v::VARCHAR, ',' ORDER BY perm) AS bucket FROM sig GROUP BY ord, perm // 2),
pairs AS (SELECT DISTINCT a.ord AS probe, b.ord AS indexed FROM bands a JOIN bands b USING (band, bucket) WHERE a.ord % 2 = 1 AND b.ord % 2 = 0),
scored AS (SELECT probe, indexed, count(*) FILTER (x.v = y.v) / 128.0::DOUBLE AS sim FROM pairs JOIN sig x ON x.ord = probe JOIN sig y ON y.ord = indexed AND y.perm = x.perm GROUP BY probe, indexed)
SELECT (probe - 1) // 2 AS doc_id, indexed // 2 AS item_id, sim FROM scored WHERE sim >= 0.05"""
)
def benchmark_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Documents that resemble short test items: 64 bands of 2, and the low similarity that an item within a document has."""
    items = load(spark, d, "benchmark").where("text <> ''").select(F.col("item_id").alias("ord"), "text")
    found = OverlapIndex(kind="md5", num_bands=64).add(items).pairs(docs(spark, d), 0.05)
    return found.select(F.col("probe").alias("doc_id"), F.col("indexed").alias("item_id"), "sim")


# --- sources ------------------------------------------------------------------------------


@query(f"WITH {DOCS} SELECT source, count(*) AS docs, sum(length(text))::BIGINT AS chars, trunc(sum(length(text))::BIGINT * 0.208::DOUBLE)::BIGINT AS est_tokens FROM d GROUP BY source")
def source_budget(spark: SparkSession, d: str) -> DataFrame:
    return sources.budget(docs(spark, d, False))


CAPPED = """SELECT ord, source, text FROM (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY ord) AS n, max_docs FROM d JOIN source_catalog ON name = source
WHERE length(text) >= coalesce(min_chars, 0) {only}) WHERE max_docs IS NULL OR n <= greatest(max_docs, 1)"""


@query(f"WITH {DOCS} {CAPPED.format(only='')}")
def source_capped(spark: SparkSession, d: str) -> DataFrame:
    return sources.capped(docs(spark, d, False), load(spark, d, "source_catalog")).select("ord", "source", "text")


@query(f"WITH {DOCS} {CAPPED.format(only=chr(10) + 'AND source IN (' + chr(39) + 'webtelu' + chr(39) + ', ' + chr(39) + 'local_text' + chr(39) + ')')}")
def source_selected(spark: SparkSession, d: str) -> DataFrame:
    return sources.capped(docs(spark, d, False), load(spark, d, "source_catalog"), only=["webtelu", "local_text"]).select("ord", "source", "text")


LATEST = "l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY finished_at DESC NULLS LAST, run_id DESC) AS n FROM source_results WHERE source IS NOT NULL) WHERE n = 1), s AS (SELECT *, CASE WHEN error_msg IS NOT NULL THEN 'failed' WHEN skipped THEN 'skipped' WHEN interrupted IS NOT NULL THEN 'interrupted' ELSE 'ok' END AS status FROM l)"


@query(f"WITH {LATEST} SELECT source, status, docs, chars, est_tokens, gb, substr(interrupted, 1, 90) AS interrupted, substr(error_msg, 1, 120) AS error FROM s")
def source_runs(spark: SparkSession, d: str) -> DataFrame:
    return sources.run_summary(load(spark, d, "source_results"))


@query(f"WITH {LATEST} SELECT coalesce(sum(est_tokens) FILTER (status IN ('ok', 'interrupted')), 0)::BIGINT AS est_tokens, count(*) FILTER (status IN ('ok', 'interrupted')) AS fetched, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed FROM s")
def total_tokens(spark: SparkSession, d: str) -> DataFrame:
    return sources.total_tokens(load(spark, d, "source_results"))


# --- files --------------------------------------------------------------------------------


@query("SELECT row_number() OVER (ORDER BY line_id) - 1 AS ord, coalesce(text, '') AS text FROM local_lines")
def jsonl_scan(spark: SparkSession, d: str) -> DataFrame:
    """The local lines written as JSON lines, and read again with their line numbers."""
    path = temporary_path(spark, "lines")
    sinks.write_jsonl(load(spark, d, "local_lines").orderBy("line_id"), path)
    return readers.numbered_lines(spark, path).select("ord", F.coalesce("text", F.lit("")).alias("text"))


@query(f"WITH {DOCS}, x AS (SELECT unnest(list_append(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::INTEGER), 256)) AS id FROM d) SELECT id, count(*) AS n FROM x GROUP BY id")
def token_file_histogram(spark: SparkSession, d: str) -> DataFrame:
    """How often each id stands in the token file of the documents, which is written and read again."""
    path = temporary_path(spark, "token-file")
    stream = tokens.split(_tokens(spark, d), lambda total: 0)
    sinks.write_tokens(tokens.part(stream, "train"), path)

    def count(batches):  # noqa: ANN001, ANN202
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for content in batch.column("content"):
                total += np.bincount(np.frombuffer(content.as_buffer(), "<u2"), minlength=1 << 16)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["id", "n"])

    parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.part").load(path)
    return parts.select("content").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


# --- ordered reading ------------------------------------------------------------------------

UNION = "SELECT source_ord, pos, text, row_number() OVER (ORDER BY source_ord, pos) - 1 AS line FROM (SELECT 0 AS source_ord, doc_id AS pos, text FROM documents UNION ALL SELECT 1, line_id, text FROM local_lines)"


@query(f"SELECT source_ord, pos, text, line FROM ({UNION}) WHERE line >= 100 AND line < 1500 AND text <> ''")
def ordered_union_skip_limit(spark: SparkSession, d: str) -> DataFrame:
    """Skip and limit are the operator."""
    frames = [load(spark, d, "documents").withColumnRenamed("doc_id", "k"), load(spark, d, "local_lines").withColumnRenamed("line_id", "k")]
    return readers.ordered_union(frames, "k", 100, 1500)


@query(f"SELECT source_ord, pos, text, line FROM ({UNION}) WHERE text <> ''")
def ordered_union(spark: SparkSession, d: str) -> DataFrame:
    frames = [load(spark, d, "documents").withColumnRenamed("doc_id", "k"), load(spark, d, "local_lines").withColumnRenamed("line_id", "k")]
    return readers.ordered_union(frames, "k")


BLOCKS = f"{DOCS}, p AS (SELECT ord, string_split(text, chr(10) || chr(10)) AS parts FROM d), b AS (SELECT ord, i - 1 AS block, parts[i] AS text FROM (SELECT ord, parts, unnest(range(1, len(parts) + 1)) AS i FROM p) WHERE length(parts[i]) > 200)"


@query(f"WITH {BLOCKS} SELECT ord, block, text FROM b")
def block_split(spark: SparkSession, d: str) -> DataFrame:
    return readers.blocks(docs(spark, d, False)).select("ord", F.col("block").cast("long").alias("block"), "text")


@query(f"WITH {BLOCKS} SELECT ord, block, text FROM (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY block) AS n FROM b) WHERE n <= 2")
def block_head(spark: SparkSession, d: str) -> DataFrame:
    """The first two long blocks of each document: the limit is the operator."""
    return readers.blocks(docs(spark, d, False), per_file=2).select("ord", F.col("block").cast("long").alias("block"), "text")


@query("SELECT file_path, source, regexp_replace(text, '\\A[" + W + "]+|[" + W + "]+\\z', '', 'g') AS text FROM local_lines WHERE length(regexp_replace(text, '\\A[" + W + "]+|[" + W + "]+\\z', '', 'g')) >= 10")
def local_merge(spark: SparkSession, d: str) -> DataFrame:
    lines = load(spark, d, "local_lines")
    return lines.select("file_path", "source", T.strip("text").alias("text")).where(F.length("text") >= 10)


@query("SELECT line_id, text, source FROM local_lines")
def json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    lines = load(spark, d, "local_lines").select("line_id", F.to_json(F.struct("text", "source")).alias("j"))
    return lines.select("line_id", F.from_json("j", "text string, source string").alias("r")).select("line_id", "r.text", "r.source")


@query(f"WITH {DOCS} SELECT ord::VARCHAR AS page, {_strip_sql('text')} AS text FROM d WHERE length({_strip_sql('text')}) >= 500")
def wiki_payload_parse(spark: SparkSession, d: str) -> DataFrame:
    """Payloads of one page each, built from the documents, parsed again."""
    page = F.map_from_arrays(F.array(F.col("ord").cast("string")), F.array(F.struct(F.col("text").alias("extract"))))
    payloads = docs(spark, d).select(F.to_json(F.struct(F.struct(page.alias("pages")).alias("query"))).alias("payload"))
    return readers.wiki_extracts(payloads)


# --- tokens -------------------------------------------------------------------------------

TOKENS = f"{DOCS}, t AS (SELECT ord, strlen(text) + 1 AS n, text FROM d), o AS (SELECT *, coalesce(sum(n) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before, (SELECT sum(n) FROM t)::BIGINT AS total FROM t)"


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return stash(tokens.encode(docs(spark, d), tokens.ByteTokenizer, tokens.ByteTokenizer.eos_id), "byte-tokens")


@query(f"WITH {DOCS} SELECT ord, strlen(text) + 1 AS n, array_to_string(list_append(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::INTEGER), 256), ' ') AS ids FROM d")
def byte_tokens_eos(spark: SparkSession, d: str) -> DataFrame:
    return _tokens(spark, d).select("ord", "n", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query(f"WITH {TOKENS} SELECT ord, n, before FROM o")
def token_offsets(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.prefix import running_total

    return running_total(_tokens(spark, d).select("ord", "n"), ["ord"], "n")


def _split_sql(val: str) -> str:
    return f"WITH {TOKENS}, v AS (SELECT *, total - ({val}) AS cut FROM o) SELECT ord, before, n, greatest(0, least(n, cut - before))::BIGINT AS train_n, n - greatest(0, least(n, cut - before))::BIGINT AS val_n FROM v"


@query(_split_sql("total - trunc(total * (1.0::DOUBLE - 0.005::DOUBLE))::BIGINT"))
def train_val_split_prepare(spark: SparkSession, d: str) -> DataFrame:
    return tokens.split(_tokens(spark, d), tokens.val_size_batch).select("ord", "before", "n", "train_n", "val_n")


@query(_split_sql("greatest(1, trunc(total * 0.002::DOUBLE)::BIGINT)"))
def train_val_split_stream(spark: SparkSession, d: str) -> DataFrame:
    return tokens.split(_tokens(spark, d), tokens.val_size_stream).select("ord", "before", "n", "train_n", "val_n")


@query(
    f"""WITH {TOKENS}, b AS (SELECT ord, before, regexp_extract_all(hex(encode(text)), '..') AS x FROM o WHERE before < 5000000),
e AS (SELECT before + i - 1 AS pos, CASE WHEN i <= len(x) THEN x[i] ELSE 'eos' END AS id FROM (SELECT before, x, unnest(range(1, len(x) + 2)) AS i FROM b))
SELECT count(DISTINCT id) AS distinct_tokens FROM e WHERE pos < 5000000 AND pos < (SELECT any_value(total) - greatest(1, trunc(any_value(total) * 0.002::DOUBLE)::BIGINT) FROM o)"""
)
def distinct_tokens_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Distinct ids in the first five million training positions: the prefix is the operator."""
    parts = stash(tokens.split(_tokens(spark, d), tokens.val_size_stream), "split")
    return tokens.distinct_in_prefix(tokens.part(parts, "train"))


@query(f"WITH {DOCS}, {CLEAN}, k AS (SELECT DISTINCT text FROM c WHERE length(text) >= 64) SELECT sum(strlen(text) + 1)::BIGINT AS tokens, sum(length(text))::BIGINT AS chars, sum(strlen(text) + 1)::BIGINT / greatest(1, sum(length(text))::BIGINT)::DOUBLE AS tokens_per_char FROM k")
def tokens_per_char(spark: SparkSession, d: str) -> DataFrame:
    kept = stash(dedup.exact_dedup_clean(docs(spark, d)), "kept")
    n = tokens.encode(kept, tokens.ByteTokenizer, tokens.ByteTokenizer.eos_id).agg(F.sum("n").alias("tokens"))
    chars = kept.agg(F.sum(F.length("text").cast("long")).alias("chars"))
    return n.crossJoin(chars).withColumn("tokens_per_char", F.col("tokens") / F.greatest(F.lit(1), F.col("chars")))  # one row each
