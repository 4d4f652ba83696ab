"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir), calls one operator of ``zonepulse.llm`` on all
documents that its predecessor kept, and returns a DataFrame. All but the last return the
columns of documents. ``run`` applies the stages to the table ``documents``.

1. language ID: documents of no known language go (no letter, or letters and n-grams that
   no learned language has);
2. SimHash near-dedup: of each component one document stays, that of the smallest doc_id;
3. secret scan: secrets are replaced by ``[SECRET]``, ``n_chars`` follows;
4. source mix: documents are left out or repeated so that the sources meet their targets;
5. BPE: every document of the mix encoded and decoded; counts and digests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonepulse.llm.bpe import token_digests
from zonepulse.llm.common import materialise, read_table
from zonepulse.llm.langid import keep_identified
from zonepulse.llm.mixing import mix_documents
from zonepulse.llm.secret_scan import redact_secrets
from zonepulse.llm.simhash import drop_near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return keep_identified(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 3-word shingles, 3 bits."""
    return drop_near_duplicates(docs, shingle=3, max_bits=3)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets hidden."""
    return redact_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: weights 3, 1, 2 in turn, 150 % of all words, at most twice a source."""
    return mix_documents(docs)


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return token_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("bpe_round_trip", bpe_round_trip),
]

#: SQL has no support vector machines and no tokenizer; the tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
