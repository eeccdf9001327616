"""A corpus pipeline of five operators, each stage working on all that the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import langid, mixing, packing, secrets, shinglejoin
from ledgerspark.llm.queries import held_out
from ledgerspark.session import shared_dir


def _apart(docs: DataFrame) -> DataFrame:
    """``text`` and all columns as ``row``, so that none meets an operator's column of the same name."""
    return docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence stay; those rejected, and texts that are null or without a letter, go.

    The model is fitted on labelled rows of ``docs``; an empty table, or one without a labelled row, keeps nothing. Repeated
    rows and null ids are treated like any.
    """
    config = langid.LangidConfig()
    texts, langs = langid.sample_labelled(docs, ~held_out(), config)
    found = langid.predict(_apart(docs), langid.fit(texts, langs, config))
    return found.filter("accepted").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts one row stays, with the smallest id of the group; rows without an id go like others, after
    those with one. Texts without a word stay, repeated ones with an id once."""
    return shinglejoin.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets found in its text are replaced by a mark, and n_chars then counts the new text. Null texts stay null."""
    found = secrets.scan_secrets(_apart(docs), secrets.fit())
    hit = F.col("n_findings") > 0
    new = {"text": F.col("redacted"), "n_chars": F.when(hit, F.length("redacted")).otherwise(F.col("row.n_chars")).cast("long")}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, each as often as it takes it. A null source is one of its own; sources without words go."""
    return mixing.take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes; rows that the mix repeats are packed each, wordless ones in no bin."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("mix", mix), ("pack", pack)]

#: Learned and hashed stages are beyond SQL; tests/llm hold the stages and run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
