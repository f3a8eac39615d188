"""The registered queries of this subpackage, one for each operator, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from dqspark.llm.bpe import token_digests
from dqspark.llm.divergence import audit_sources
from dqspark.llm.exact import exact_duplicates
from dqspark.llm.fingerprints import fingerprint_edits
from dqspark.llm.html import extract_pages
from dqspark.llm.jaccard import jaccard_components
from dqspark.llm.langid import fit_languages, held_out, identify_languages
from dqspark.llm.lengths import length_histogram, length_report
from dqspark.llm.lines import dedup_lines
from dqspark.llm.mixing import mix_sources
from dqspark.llm.search import search
from dqspark.llm.suffixtree import fit_tree, score_documents
from dqspark.llm.toxicity import fit_toxicity, score_toxicity
from dqspark.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANKS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(use_utc(spark), sf_dir)
        if oracle:
            ORACLES[fn.__name__] = oracle.strip()
        return fn

    return register


@query(rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOW}, '[^\x20\x09-\x0D]+') w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) s FROM words)
), sizes AS (SELECT doc_id, count(*) n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id a, y.doc_id b, count(*) c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
    GROUP BY ALL) JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
  WHERE 100 * c >= 75 * (sa.n + sb.n - c)
), reach AS (
  SELECT a root, a node FROM links UNION SELECT root, b FROM reach JOIN links ON a = node
), least AS (SELECT node, min(root) root FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) n_shingles, least(d.doc_id, coalesce(root, d.doc_id)) component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.node = d.doc_id
""")
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@query(rf"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) n, sha256(regexp_replace(coalesce(text, ''), '{BLANKS}', '', 'g')) h
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best keep_id, count(*) OVER (PARTITION BY h) group_size,
  row_number() OVER best = 1 kept, h text_sha256
FROM t WINDOW best AS (PARTITION BY h ORDER BY n DESC, doc_id)
""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query()
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@query(r"""
WITH lines AS (
  SELECT doc_id, unnest(l) line, generate_subscripts(l, 1) place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k FROM lines
), common AS (
  SELECT k, max(doc_id) last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, line, place, c.k IS NOT NULL AND doc_id < last AS lost FROM keyed LEFT JOIN common c ON c.k = keyed.k
)
SELECT doc_id, count(*) n_lines, count(*) FILTER (lost) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT lost), '')) kept_sha256
FROM marked GROUP BY doc_id
""")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


@query()
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = table(spark, sf_dir, "documents")
    return length_report(length_histogram(documents, ranks, public_tokenizers.PATTERN))


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = fit_languages(rows.filter("not held_out"))
    found = identify_languages(rows.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query()
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    tree, unigrams = fit_tree(rows.filter(~held_out(F.col("doc_id"), fold=1)))
    scored = score_documents(rows, tree, unigrams)
    return scored.withColumn("held_out", held_out(F.col("doc_id"), fold=1))


@query()
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query(rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w FROM documents
), sizes AS (
  SELECT doc_id, len(w)::BIGINT n FROM words
), totals AS (
  SELECT count(*) FILTER (n > 0) n_docs, sum(n)::BIGINT n_terms FROM sizes
), counts AS (
  SELECT doc_id, term, count(*) tf FROM (SELECT doc_id, unnest(w) term FROM words) GROUP BY ALL
), asked AS (
  SELECT item_id, term, count(*) times FROM (
    SELECT item_id, unnest(regexp_extract_all({LOW}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term FROM benchmark)
  GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT w
  FROM counts, totals WHERE term IN (SELECT term FROM asked) GROUP BY term
), scores AS (
  SELECT item_id, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id), totals
  GROUP BY ALL
)
SELECT item_id, (row_number() OVER best)::INTEGER AS "rank", doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY "rank" <= 20
""")
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id"), folds=3, fold=1).alias("held_out"))
    model = fit_toxicity(rows.filter("not held_out"), table(spark, sf_dir, "labels"))
    return score_toxicity(rows, model).select("doc_id", "held_out", "score", "predicted")


@query(rf"""
WITH docs AS (
  SELECT coalesce(lang, '') lang, coalesce(source, '') source,
    regexp_extract_all({LOW}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') w
  FROM documents
), parts AS (
  SELECT lang, source FROM docs GROUP BY ALL
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) term FROM docs) GROUP BY ALL HAVING count(*) >= 3
), sizes AS (
  SELECT lang, count(*) v FROM kept GROUP BY lang
), found AS (
  SELECT lang, source, term, count(*) c FROM (SELECT lang, source, unnest(w) term FROM docs) JOIN kept USING (lang, term)
  GROUP BY ALL
), counts AS (
  SELECT lang, source, term, coalesce(c, 0) c FROM parts JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, c,
    1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang, source) + v) p
  FROM counts JOIN sizes USING (lang)
), whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 1)) // (sum(sum(c)) OVER (PARTITION BY lang) + any_value(v)) q
  FROM counts JOIN sizes USING (lang) GROUP BY lang, term
), found_pairs AS (
  SELECT a.lang, a.source, b.source item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS "value"
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), both_parts AS (
  SELECT a.lang, a.source, 'pair' part, b.source item, coalesce(f."value", 0) AS "value"
  FROM parts a JOIN parts b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN found_pairs f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares JOIN whole USING (lang, term) WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, "value"::BIGINT AS "value", (row_number() OVER best)::INTEGER AS "rank" FROM both_parts
WINDOW best AS (PARTITION BY lang, source, part ORDER BY "value" DESC, item)
QUALIFY part = 'pair' OR "rank" <= 200
""")
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(table(spark, sf_dir, "documents"))
