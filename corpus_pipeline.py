"""From raw documents to packed training sequences: five stages over whole tables.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last keep the
columns of ``documents``; what a stage drops or rewrites is gone for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crease.llm import decontam, minhash, packing, pii, toxicity
from crease.session import ensure_checkpoint_dir, materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the least doc_id (of rows
    that share it, one).  Documents without words, or without an id, stay."""
    ensure_checkpoint_dir(spark)
    judged = minhash.near_duplicates(docs, width=5, percent=80)
    lost = judged.where("not kept").select("doc_id").distinct()
    kept = docs.join(lost, "doc_id", "left_anti").select(docs.columns)
    again = judged.where("kept and n_shingles > 0").groupBy("doc_id").count().where("count > 1").select("doc_id")
    twice = kept.join(again, "doc_id", "left_semi").select(docs.columns)
    return kept.join(again, "doc_id", "left_anti").select(docs.columns).union(twice.dropDuplicates(["doc_id"]))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, within the edit budget, go."""
    return decontam.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind in brackets."""
    ensure_checkpoint_dir(spark)
    return pii.redact(docs, pii.fit(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences: pieces of documents by window, related ones together."""
    ensure_checkpoint_dir(spark)
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_benchmark_leaks),
          ("personal_data", redact_personal_data), ("packing", pack_sequences)]

#: No stage but the joins between them can be put in SQL: they train models, sketch,
#: match within edit distances and call a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
