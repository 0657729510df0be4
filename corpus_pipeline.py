"""From raw documents to encoded training text: five stages, each a Spark job over its whole input.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and gives the next stage's
documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark.llm import bpe, jaccard_trie, language, mixing, pii
from ontime_spark.llm.catalog import vocabulary
from ontime_spark.llm.common import keep, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model is sure enough of; the others, and letterless ones, go."""
    model = language.train(docs, key=F.col("doc_id"))
    return language.predict(docs, model).filter(~F.col("rejected")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): the one with the least id.

    Of several with this id a hash of the whole row chooses, always alike; an id comes before none. Different
    texts of one id are different documents. Of texts without words one of each id stays, and all without an id.
    """
    return jaccard_trie.one_of_each_group(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its personal data replaced by the kind's name; n_chars follows the text."""
    found = pii.find_personal_data(docs, pii.train(), with_redacted=True)
    return found.withColumn("text", F.col("redacted")).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target rate, in one global shuffle."""
    return mixing.mix(docs).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, and digests of ids and of what they decode to."""
    encoded = bpe.encode_decode(docs, vocabulary(), public_tokenizers.PATTERN, keep_columns=["doc_id", "lang", "source"])
    return encoded.select("doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("personal_data", remove_personal_data),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Trained models, a regular-expression engine's offsets and byte-pair merges have no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over all documents; every other stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
