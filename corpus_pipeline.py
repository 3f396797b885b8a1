"""A pipeline from documents to tokens: each stage works on what the one before it kept.

Stages, each writing Parquet that the next one reads: language identification (documents in no learned language go),
n-gram Jaccard join (the smallest document of each group stays), substring dedup (repeated passages go), mixing of the
sources by Poisson replication, and BPE encoding with a decoding check.

Defined results. Documents without a letter (null and empty texts among them) go in the first stage; when no row has a
language, none is learned and all go. Rows with a null doc_id or source stay: null ids link with nothing and are dedupped
only against texts with an id, and a null source is a source. Rows that share a doc_id are one document to the second
stage, which keeps one of them. Long texts are read whole. An empty table gives an empty result. All stages but the last
return the columns of documents, further columns untouched whatever their names; the last returns them without the text,
and n_tokens, ids and decoded_sha256, which replace columns of those names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm import bpe, jaccard_join, language_id, mixing, substring_dedup
from tallystone.llm.common import materialize, table, unnamed
from tallystone.llm.queries import vocabulary_path

#: Below this score a text is in none of the learned languages.
LEAST_SCORE = 0.05
#: A SQL form is None: the stages learn, hash and walk graphs; tests hold all rows against a brute-force version.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text is in a learned language."""
    plain, at = unnamed(docs)
    found = language_id.identify(plain, at["doc_id"], at["text"], at["lang"])
    kept = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*plain.columns).toDF(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group that links join, and one row of each doc_id."""
    return jaccard_join.keep_first(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A text that loses words becomes its kept words, joined by spaces, and n_chars its length; others stay as they are."""
    plain, at = unnamed(docs)
    cleaned = substring_dedup.remove_repeats(plain, at["doc_id"], at["text"])
    changed = F.col("n_removed") > 0
    made = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col(at["text"]))}
    if "n_chars" in at:
        made["n_chars"] = F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col(at["n_chars"]))
    return cleaned.select(*(made.get(c, F.col(at[c])).alias(c) for c in docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate and its own draw say, in a global random order."""
    plain, at = unnamed(docs)
    return mixing.mix(plain, at["source"], at["doc_id"]).select(*plain.columns).toDF(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_tokens, ids and decoded_sha256 in place of the text."""
    made = bpe.encode_decode(docs, vocabulary_path(), outputs=("n_tokens", "ids", "decoded_sha256"), cache=60_000)
    return made.drop("text")


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("mixing", mixed),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
