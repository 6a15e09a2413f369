"""A training corpus from raw documents: quality filter, exact and near deduplication, pseudonyms, packing.

Part of the `personweave.llm` subpackage. Every stage reads the documents that the one before kept and returns the columns
of `documents`; the last one returns the packed pieces.

In all stages null texts count as empty, texts are taken whole, an empty table gives an empty result, rows without an id
or with a repeated one are rows like others, and further columns of whatever name stay with their rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personweave.llm.exact_dedup import exact_dedup
from personweave.llm.packing import pack_documents
from personweave.llm.pii import pseudonymise
from personweave.llm.quality import quality_scores
from personweave.llm.queries import CAPACITY, END_ID, KEY, TOKENIZER
from personweave.llm.session import small_batches
from personweave.llm.simhash_dedup import one_of_each_component
from personweave.sources.scratch import scratch_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the rows that the quality classifier rejects. Equal texts share their fate, and all stay if no label is usable."""
    labels = small_batches(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(docs, labels, carry=True).where("predicted = 1").select("record.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of equal texts: the longest original, then the smallest id, then any. All empty and null
    texts are equal."""
    small_batches(spark)
    return exact_dedup(docs, carry=True).where("kept").select("record.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each component of near-duplicates: the one with the smallest id, of equal or missing ids any one.
    What goes is a row, not an id: another text under the same id stays. Texts without a word are near each other."""
    small_batches(spark)
    return one_of_each_component(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; `n_chars` follows a text that changed. No row goes; null texts stay null."""
    small_batches(spark)
    out = pseudonymise(docs, KEY, carry=True)
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_values") > 0, F.char_length("text").cast("long"))
           .otherwise(F.col("record.n_chars"))}
    return out.select(*[new.get(c, F.col("record")[c]).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every row, packed into sequences; a null text is its end mark alone. Repeated rows are packed as often."""
    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path(TOKENIZER), CAPACITY, END_ID)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("pii", hide_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None  # a fitted classifier, pseudonyms and tokens cannot be said in SQL; tests compare with brute force
