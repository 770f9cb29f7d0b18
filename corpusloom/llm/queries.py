"""Queries of the training-data operators, and DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..runtime import load
from . import budget, crosssplit, encode, language, leak, ledger, mixing, near, spans, visual

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of documents of 20 words or more whose sets of 5-word runs have Jaccard >= 0.7."""
    return near.near_pairs(load(spark, d, "documents", spread=True))


def p1_members(spark: SparkSession, d: str) -> DataFrame:
    """The class of copies of every document that p1_found compares; with it, p1_found gives all pairs."""
    return near.near_members(load(spark, d, "documents"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    """Each document's class of copies, linked classes and near-duplicate group (5 words, 0.8)."""
    return near.near_groups(load(spark, d, "documents", spread=True))


def p2_budget(spark: SparkSession, d: str) -> DataFrame:
    """Token, character and document totals by source, language and domain."""
    return budget.token_budget(load(spark, d, "documents", spread=True), load(spark, d, "source_catalog"))


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """The documents and characters of p2_budget, which SQL can state."""
    return p2_budget(spark, d).drop("tokens", "tokens_per_char")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of local lines stored differently that look the same."""
    return visual.same_looking(load(spark, d, "local_lines", spread=True), load(spark, d, "lookalike_chars"))


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    """The consistent form of every local line."""
    return visual.normalise(load(spark, d, "local_lines", spread=True), load(spark, d, "lookalike_chars")).select("line_id", "same_form")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a train and a held-out line whose sets of 3-plain-word runs have Jaccard >= 0.6."""
    return crosssplit.cross_pairs(load(spark, d, "corpus_lines", spread=True))


def p4_members(spark: SparkSession, d: str) -> DataFrame:
    """The class of copies of every line that p4_found compares; with it, p4_found gives all pairs."""
    return crosssplit.cross_members(load(spark, d, "corpus_lines"))


def p4_counts(spark: SparkSession, d: str) -> DataFrame:
    """Lines and overlapping lines per split and source."""
    return crosssplit.overlap_counts(load(spark, d, "corpus_lines", spread=True))


def _filters(spark: SparkSession, d: str) -> language.Filters:
    return language.train(load(spark, d, "lang_samples"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Languages of the documents whose label is not exactly their only language."""
    return language.wrong_labels(load(spark, d, "documents", spread=True), _filters(spark, d))


def p5_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every document's languages with share of letters and confidence."""
    return language.document_languages(load(spark, d, "documents", spread=True), _filters(spark, d)).select("doc_id", "found_lang", "share", "confidence")


def p5_segments(spark: SparkSession, d: str) -> DataFrame:
    """The one-language stretches of every document."""
    return language.language_segments(load(spark, d, "documents", spread=True), _filters(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Refused batch records and the accepted records they repeat."""
    return ledger.admit_all(load(spark, d, "batch_lines"))


def p6_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Records and refused records per batch and source (canonical spelling, null its own group)."""
    lines = load(spark, d, "batch_lines")
    refused = ledger.admit_all(lines).select("record_id").distinct().withColumn("hit", F.lit(1))
    rows = lines.select("record_id", "batch_no", mixing.canonical_source("source").alias("source"))
    return rows.join(refused, "record_id", "left").groupBy("batch_no", "source").agg(F.count(F.lit(1)).alias("records"), F.count("hit").alias("refused"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mix with their number of copies."""
    return mixing.mix(load(spark, d, "documents"), load(spark, d, "mix_targets"), load(spark, d, "source_catalog"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual shares of the mix."""
    return mixing.mix_report(load(spark, d, "documents"), load(spark, d, "mix_targets"), load(spark, d, "source_catalog"))


def p7_shortfall(spark: SparkSession, d: str) -> DataFrame:
    """The report of a mix of as many code points as the whole corpus has: used-up sources fall short."""
    documents = load(spark, d, "documents")
    total = documents.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    return mixing.mix_report(documents, load(spark, d, "mix_targets"), load(spark, d, "source_catalog"), total=total)


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document by the 50k byte-level vocabulary."""
    return encode.encode(load(spark, d, "documents", spread=True))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents and the benchmark items of which 8 plain words in a row stand in them."""
    return leak.passages(load(spark, d, "documents", spread=True), load(spark, d, "benchmark")).select("doc_id", "item_id").distinct()


def p9_near(spark: SparkSession, d: str) -> DataFrame:
    """As p9_found, but each of the 8 words may stand two words off its place."""
    return leak.passages(load(spark, d, "documents", spread=True), load(spark, d, "benchmark"), slack=2)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of documents with a common stretch of 200 code points."""
    return spans.span_pairs(load(spark, d, "documents", spread=True))


def p10_members(spark: SparkSession, d: str) -> DataFrame:
    """The class of copies of every document that p10_found compares; with it, p10_found gives all pairs."""
    return near.classes_of(load(spark, d, "documents").where(F.length("text") >= 200), "doc_id", "text")


def p10_shared(spark: SparkSession, d: str) -> DataFrame:
    """How much of each document stands in another one."""
    return spans.shared_share(load(spark, d, "documents", spread=True))


def queries() -> dict[str, Query]:
    every = (p1_found, p1_members, p1_groups, p2_budget, p2_counts, p3_found, p3_forms, p4_found, p4_members, p4_counts, p5_found, p5_documents, p5_segments, p6_found, p6_by_source, p7_mix, p7_report, p7_shortfall, p8_ids, p9_found, p9_near, p10_found, p10_members, p10_shared)
    return {f.__name__: f for f in every}


_BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


_SOURCE = "regexp_replace(lower(regexp_replace(source, '^\\s+|\\s+$', '', 'g')), '[\\s\\-]+', '_', 'g')"


def _jaccard_sql(table: str, key: str, words: str, least: int, n: int, threshold: float, extra: str = "", where: str = "TRUE", rows: str = "TRUE") -> str:
    name = extra and f", {extra.split()[-1]}"
    run = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"""
WITH cut AS (SELECT {key} AS id{extra}, {words} AS w FROM {table} WHERE text IS NOT NULL AND {rows}),
long AS (SELECT * FROM cut WHERE len(w) >= {least}),
grams AS (SELECT DISTINCT id{name}, {run} AS g FROM (SELECT *, unnest(range(1, len(w) - {n} + 2)) AS i FROM long)),
sizes AS (SELECT id, count(*) AS n FROM grams GROUP BY id),
common AS (SELECT least(a.id, b.id) AS a, greatest(a.id, b.id) AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND {where} GROUP BY 1, 2)
SELECT a AS {key}_a, b AS {key}_b FROM common JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE c >= {threshold} * (x.n + y.n - c) - 1e-9"""


def _class_sql(table: str, key: str, where: str, by: str = "", shown: str = "") -> str:
    """Members of the classes of equal stored text."""
    over = f"OVER (PARTITION BY {by}text)"
    return f"SELECT {key}{shown}, min({key}) {over} AS class_id, count(*) {over} AS copies FROM {table} WHERE text IS NOT NULL AND {where}"


def _groups_sql(words: str) -> str:
    pairs = _jaccard_sql("documents", "doc_id", words, 5, 5, 0.8, where="a.id < b.id")
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, array_to_string({words}, ' ') AS s FROM documents WHERE len({words}) >= 5),
c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS class_id FROM w),
p AS (SELECT DISTINCT x.class_id AS a, y.class_id AS b FROM ({pairs}) q JOIN c x ON x.doc_id = q.doc_id_a JOIN c y ON y.doc_id = q.doc_id_b WHERE x.class_id <> y.class_id),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT a AS n, a AS m FROM e UNION SELECT r.n, e.b FROM r JOIN e ON e.a = r.m),
g AS (SELECT n, min(m) AS group_id FROM r GROUP BY n), l AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, coalesce(l.n_links, 0) AS n_links, coalesce(g.group_id, c.class_id, d.doc_id) AS group_id
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN l ON l.a = c.class_id LEFT JOIN g ON g.n = c.class_id"""


def _counts_sql() -> str:
    """Documents and characters by source, language and domain, and the totals of each."""
    lang = "nullif(nullif(lower(trim(lang, ' ')), ''), 'und')"
    levels = [("slice", ("source", "lang", "domain")), ("source", ("source",)), ("lang", ("lang",)), ("domain", ("domain",)), ("all", ())]
    parts = []
    for level, by in levels:
        shown = ", ".join(c if c in by else f"NULL AS {c}" for c in ("source", "lang", "domain"))
        known = "coalesce(source IN (SELECT name FROM source_catalog WHERE name IS NOT NULL), false)" if "source" in by else "NULL"
        parts.append(f"SELECT '{level}' AS level, {shown}, {known} AS catalogued, count(*) AS docs, coalesce(sum(length(text)), 0)::BIGINT AS chars FROM d" + (f" GROUP BY {', '.join(by)}" if by else ""))
    return f"WITH d AS (SELECT {_SOURCE} AS source, {lang} AS lang, domain, text FROM documents) " + " UNION ALL ".join(parts)


def _admission_sql(words: str, result: str) -> str:
    """Admission in order: one recursive step for each record that resembles another one. Records are numbered in their order first."""
    pairs = _jaccard_sql("numbered", "ord", words, 20, 5, 0.7, where="a.id < b.id")
    return f"""
WITH RECURSIVE numbered AS (SELECT row_number() OVER (ORDER BY batch_no, record_id) AS ord, record_id, batch_no, source, text FROM batch_lines),
pairs AS (SELECT ord_a AS a, ord_b AS b FROM ({pairs})),
asked AS (SELECT row_number() OVER (ORDER BY b) AS n, b, earlier FROM (SELECT b, list(a) AS earlier FROM pairs GROUP BY b)),
steps AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS refused UNION ALL
SELECT asked.n, CASE WHEN len(list_filter(earlier, lambda x: NOT list_contains(refused, x))) > 0 THEN list_append(refused, b) ELSE refused END FROM steps JOIN asked ON asked.n = steps.n + 1),
refused AS (SELECT DISTINCT unnest(refused) AS ord FROM (SELECT refused FROM steps ORDER BY n DESC LIMIT 1))
{result}"""


def oracle_sql() -> dict[str, str]:
    plain = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{Nd}]+')"
    stored = f"regexp_extract_all(text, '[^{_BLANK}]+')"
    eight = " || ' ' || ".join(f"w[i + {k}]" for k in range(8))
    runs = lambda table, key: f"SELECT DISTINCT {key}, {eight} AS g FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM (SELECT {key}, {plain} AS w FROM {table} WHERE text IS NOT NULL) WHERE len(w) >= 8)"
    windows = "WITH windows AS (SELECT doc_id, i, substr(text, i, 200) AS s FROM (SELECT doc_id, text, unnest(range(1, length(text) - 198)) AS i FROM documents WHERE length(text) >= 200)), several AS (SELECT s FROM windows GROUP BY s HAVING count(DISTINCT doc_id) > 1)"
    cross = _jaccard_sql("corpus_lines", "line_id", plain, 8, 3, 0.6, ", split = 'train' AS train", "a.train AND NOT b.train", "split IN ('train', 'validation', 'test')")
    return {
        "p1_found": _jaccard_sql("documents", "doc_id", stored, 20, 5, 0.7, where="a.id < b.id"),
        "p1_members": _class_sql("documents", "doc_id", f"len({stored}) >= 20"),
        "p1_groups": _groups_sql(stored),
        "p2_counts": _counts_sql(),
        "p4_found": cross,
        "p4_members": _class_sql("corpus_lines", "line_id", f"split IN ('train', 'validation', 'test') AND len({plain}) >= 8", "split = 'train', ", ", split <> 'train' AS held"),
        "p4_counts": f"SELECT split, source, count(*) AS lines, count(hit) AS overlapping FROM corpus_lines LEFT JOIN (SELECT DISTINCT unnest([line_id_a, line_id_b]) AS line_id, 1 AS hit FROM ({cross})) USING (line_id) WHERE split IN ('train', 'validation', 'test') GROUP BY split, source",
        "p6_found": _admission_sql(stored, "SELECT x.record_id AS accepted_id, y.record_id FROM pairs JOIN numbered x ON x.ord = a JOIN numbered y ON y.ord = b WHERE b IN (SELECT ord FROM refused) AND a NOT IN (SELECT ord FROM refused)"),
        "p6_by_source": _admission_sql(stored, f"SELECT batch_no, {_SOURCE} AS source, count(*) AS records, count(refused.ord) AS refused FROM numbered LEFT JOIN refused USING (ord) GROUP BY ALL"),
        "p9_found": f"SELECT DISTINCT doc_id, item_id FROM ({runs('documents', 'doc_id')}) JOIN ({runs('benchmark', 'item_id')}) USING (g)",
        "p9_near": f"""
WITH dw AS (SELECT doc_id, unnest(range(len(w))) AS pos, unnest(w) AS word FROM (SELECT doc_id, {plain} AS w FROM documents WHERE text IS NOT NULL)),
ph AS (SELECT item_id, i AS phrase, unnest(range(8)) AS k, unnest(w[i:i + 7]) AS word FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM (SELECT item_id, {plain} AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) >= 8)),
n AS (SELECT word, count(*) AS n FROM dw GROUP BY word),
anchor AS (SELECT * FROM (SELECT item_id, phrase, k, word, row_number() OVER (PARTITION BY item_id, phrase ORDER BY coalesce(n, 0), k) AS r FROM ph LEFT JOIN n USING (word)) WHERE r = 1),
st AS (SELECT item_id, phrase, doc_id, pos - k AS begin FROM anchor JOIN dw USING (word)),
ok AS (SELECT st.item_id, st.phrase, st.doc_id, begin FROM st JOIN ph ON ph.item_id = st.item_id AND ph.phrase = st.phrase JOIN dw ON dw.doc_id = st.doc_id AND dw.word = ph.word
WHERE dw.pos BETWEEN begin + ph.k - 2 AND begin + ph.k + 2 GROUP BY ALL HAVING count(DISTINCT ph.k) = 8)
SELECT doc_id, item_id, count(*) AS hits FROM ok GROUP BY doc_id, item_id""",
        "p10_found": f"{windows}, held AS (SELECT DISTINCT doc_id, s FROM windows SEMI JOIN several USING (s)) SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM held a JOIN held b ON a.s = b.s AND a.doc_id < b.doc_id",
        "p10_members": _class_sql("documents", "doc_id", "length(text) >= 200"),
        "p10_shared": f"""{windows}, place AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM windows SEMI JOIN several USING (s)),
covered AS (SELECT doc_id, sum(least(200, coalesce(after - i, 200)))::BIGINT AS n FROM place GROUP BY doc_id)
SELECT doc_id, coalesce(length(text), 0)::BIGINT AS chars, coalesce(n, 0)::BIGINT AS shared_chars, CASE WHEN length(text) > 0 THEN coalesce(n, 0) / length(text)::DOUBLE ELSE 0.0::DOUBLE END AS share FROM documents LEFT JOIN covered USING (doc_id)""",
    }
