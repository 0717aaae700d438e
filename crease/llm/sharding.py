"""Sharding by jump consistent hashing (Lamping and Veach, 2014)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from crease.llm.text import mix
from crease.session import materialize

_U = np.uint64


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; one more shard only takes keys into itself.

    The public algorithm, for all keys at once: a key leaves the loop when its
    next jump lands at or beyond ``shards`` (about ln(shards) rounds).
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = np.asarray(keys).astype(np.uint64, copy=True)
    here = np.zeros(len(state), dtype=np.int64)
    open_ = np.arange(len(state))
    while len(open_):
        s = state[open_] * _U(2862933555777941757) + _U(1)
        state[open_] = s
        to = ((here[open_] + 1) * (float(1 << 31) / ((s >> _U(33)).astype(np.float64) + 1.0))).astype(np.int64)
        inside = to < shards
        open_ = open_[inside]
        here[open_] = to[inside]
    return here.astype(np.int32)


def key_bits(ids: pa.Array) -> np.ndarray:
    """Well mixed key of each id; a null counts as id 0."""
    return mix(ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64) + _U(0x9E3779B97F4A7C15))


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's place: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, part``.

    ``shard`` depends on the id and the shard count alone (law ``key``);
    ``grown_shard`` is the shard with one more.  ``slot`` counts gaplessly from
    0 in each shard: a task numbers its own rows of each shard, and the counts
    of all tasks (one row per task and shard) give each task its first slot.  So
    no shard is gathered in one place, and rows are not shuffled by shard.

    Null id: the key of id 0.  Null text: size 16, CRC of no bytes (0).
    Repeated ids share a shard and get slots of their own.  No rows: no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"),
                         F.spark_partition_id().alias("part"))

    def place(batches):
        seen = np.zeros(shards, dtype=np.int64)
        for b in batches:
            bits = key_bits(b.column(0))
            here = jump_hash(bits, shards)
            order = np.argsort(here, kind="stable")
            counts = np.bincount(here, minlength=shards)
            first = np.repeat(np.cumsum(counts) - counts, counts)
            rank = np.empty(len(here), dtype=np.int64)
            rank[order] = np.arange(len(here)) - first
            rank += seen[here]
            seen += counts
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(here), pa.array(rank), pa.array(jump_hash(bits, shards + 1))],
                names=["doc_id", "size", "text_crc32", "part", "shard", "rank", "grown_shard"])

    placed = materialize(narrow.mapInArrow(
        place, "doc_id long, size long, text_crc32 long, part int, shard int, rank long, grown_shard int"), "shards")
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    return placed.join(firsts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("first_slot") + F.col("rank")).alias("slot"), "grown_shard", "part")


def write_shards(docs: DataFrame, shards: int, path: str, id_col: str = "doc_id") -> None:
    """Write whole rows into one folder per shard (``shard=N``), without a shuffle."""
    def place(batches):
        for b in batches:
            at = b.schema.get_field_index(id_col)
            yield b.append_column(shard_col, pa.array(jump_hash(key_bits(b.column(at)), shards)))

    shard_col = "shard"
    while shard_col in docs.columns:              # a column of that name in the input is kept
        shard_col += "_"
    schema = StructType(list(docs.schema)).add(shard_col, IntegerType())
    docs.mapInArrow(place, schema).write.partitionBy(shard_col).parquet(path)
