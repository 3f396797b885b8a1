"""The queries of this subpackage: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm import ann, bpe, jaccard_join, kd_shards, language_id, mixing, quality_forest, substring_dedup, toxicity, url_reputation
from tallystone.llm.common import table

#: (verdict, host and path) of the URL filter's rules.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def vocabulary_path() -> str:
    """The vocabulary file of op4 and the pipeline; other callers pass their own path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_ivf_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of the document with its id."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return url_reputation.judge(table(spark, sf_dir, "pages"), outcomes, URL_RULES).drop("posterior_bound")


def op3_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, vocabulary_path(), outputs=("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shards(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents")).drop("chunk")


def op10_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_forest.judge(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_ivf_pq, op2_url_reputation, op3_poisson_mixing, op4_forced_boundary_bpe, op5_kd_shards, op6_substring_dedup, op7_toxicity, op8_language_id, op9_jaccard_join, op10_quality_forest]
    return {f.__name__: f for f in found}


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The level's rows have n, good and the parent's mean m; the prior's weight comes from their spread.
_WEIGHT = "SELECT CASE WHEN rho > 0 THEN greatest(1.0, least(10000.0, 1 / rho - 1)) ELSE 10000.0 END AS k FROM (SELECT CASE WHEN sum(n * m * (1 - m) * (n - 1)) > 0 THEN sum(pow(good - n * m, 2) - n * m * (1 - m)) / sum(n * m * (1 - m) * (n - 1)) ELSE 0 END AS rho FROM {rows})"
_BELIEF = "SELECT {key}, k * m + good AS a, k * (1 - m) + n - good AS b FROM {rows}, {weight}"

OP2_SQL = f"""
WITH rests AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
named AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{_LETTERS}', '{_LETTERS.lower()}'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rests),
told AS (SELECT doc_id AS page_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
hosts AS (SELECT host, CAST(count(good) AS DOUBLE) AS n, CAST(coalesce(sum(good), 0) AS DOUBLE) AS good FROM named LEFT JOIN told USING (page_id) GROUP BY host),
placed AS (SELECT *, string_split(host, '.')[-1] AS suffix, array_to_string(list_slice(string_split(host, '.'), greatest(len(string_split(host, '.')) - 1, 1), len(string_split(host, '.'))), '.') AS domain FROM hosts),
s AS (SELECT suffix, sum(n) AS n, sum(good) AS good, (SELECT (sum(good) + 1) / (sum(n) + 2) FROM hosts) AS m FROM placed GROUP BY suffix),
sk AS ({_WEIGHT.format(rows='s')}), sb AS ({_BELIEF.format(key='suffix', rows='s', weight='sk')}),
d AS (SELECT x.*, a / (a + b) AS m FROM (SELECT suffix, domain, sum(n) AS n, sum(good) AS good FROM placed GROUP BY suffix, domain) x JOIN sb USING (suffix)),
dk AS ({_WEIGHT.format(rows='d')}), db AS ({_BELIEF.format(key='domain', rows='d', weight='dk')}),
h AS (SELECT host, n, good, a / (a + b) AS m FROM placed JOIN db USING (domain)),
hk AS ({_WEIGHT.format(rows='h')}), hb AS ({_BELIEF.format(key='host', rows='h', weight='hk')}),
bounds AS (SELECT host, a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS bound FROM hb),
ruled AS (SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/' WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/' WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/' WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM named)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END AS verdict FROM ruled JOIN bounds USING (host)"""

OP3_SQL = """
WITH RECURSIVE counts AS (SELECT coalesce('s' || source, 'n') AS src, count(*) AS n FROM documents GROUP BY ALL),
rated AS (SELECT src, n, pow(CAST(n AS DOUBLE), 0.5) / (SELECT sum(pow(CAST(n AS DOUBLE), 0.5)) FROM counts) * (SELECT sum(n) FROM counts) / n AS rate FROM counts),
cut AS (SELECT src, rate, CAST(greatest(1, ceil(rate / 64)) AS BIGINT) AS pieces, rate / greatest(1, ceil(rate / 64)) AS mean FROM rated),
steps(src, mean, i, p, upto) AS (SELECT src, mean, 0, exp(-mean), exp(-mean) FROM cut UNION ALL SELECT src, mean, i + 1, p * mean / (i + 1), upto + p * mean / (i + 1) FROM steps WHERE i < mean + 12 * sqrt(mean) + 24),
tables AS (SELECT src, list(upto ORDER BY i) AS upto FROM steps GROUP BY src),
drawn AS (SELECT d.*, c.rate, list_sum(list_transform(range(pieces), lambda i: len(list_filter(t.upto, lambda u: u <= CAST('0x' || substr(md5(concat('17:', coalesce(CAST(d.doc_id AS VARCHAR), 'null'), ':', i)), 1, 13) AS BIGINT) / 4503599627370496.0)))) AS n_copies FROM documents d JOIN cut c ON c.src = coalesce('s' || d.source, 'n') JOIN tables t ON t.src = c.src),
copied AS (SELECT * REPLACE (round(rate, 6) AS rate, CAST(n_copies AS BIGINT) AS n_copies), unnest(range(CAST(n_copies AS BIGINT))) AS copy FROM drawn)
SELECT *, CAST('0x' || substr(md5(concat('18:', coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', copy)), 1, 13) AS BIGINT) AS shuffle_key FROM copied"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express over whole tables."""
    return {"op2_url_reputation": OP2_SQL, "op3_poisson_mixing": OP3_SQL}
