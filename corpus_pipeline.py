"""A corpus pipeline of five operators: toxicity, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame, which is written as Parquet and read again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketlens.llm import minhash, mixing, packing, secrets_scan, toxicity
from basketlens.llm.common import table, written
from basketlens.llm.queries import PACKING, WORD_BPE


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores as toxic go.

    NULL and empty texts score as texts without features; repeated rows are judged alike and all
    go or stay; other columns are carried as they are; an empty table stays empty. Labels are
    those of ``sf_dir``."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id.

    Texts without words (also NULL) have no near duplicates; of repeated rows of the kept
    document one stays; rows with a NULL doc_id stay; other columns are carried as they are; an
    empty table stays empty."""
    return minhash.drop_near_duplicates(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mask; ``n_chars`` follows the text.

    No row goes: NULL and empty texts, repeated rows and texts without secrets stay as they are,
    and so do other columns; an empty table stays empty."""
    return secrets_scan.mask_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources have their target shares, in random order.

    NULL is a source of its own; a NULL text has no characters; repeated rows draw the same number
    of copies; the columns stay those of the input (one called ``copy`` or ``shuffle_key`` holds
    what mixing puts there); an empty table stays empty."""
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences.

    A NULL or empty text is its end id alone; a long text is cut into pieces; repeated rows are
    documents of their own; other columns are not read; an empty table gives no rows."""
    return packing.pack(docs, WORD_BPE, PACKING)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained classifier and MinHash have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
