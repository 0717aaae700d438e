"""File sources and sinks, previews and partition reports."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.session import materialize

# Reader options of every scan in the reference: a header line, "-" for a
# missing value, and stop at the first malformed row.
# Columns are matched to the header by name, and all of the schema's columns are
# parsed even when few are selected, so a malformed cell in one stops the scan.
CSV_OPTIONS = {"header": "true", "nullValue": "-", "mode": "FAILFAST"}


def csv_scan(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
             names: dict[str, str] | None = None, **options: str) -> DataFrame:
    """CSV scan with an explicit schema (S1): no inference pass over the file.

    Any Hadoop path works (``hdfs://``, ``s3a://``, a local folder); a row that
    does not fit the schema raises at read time.  Columns are found by the names in
    the header, whatever their order there; ``names`` gives the header's name of a
    schema column where they differ.  A column the header lacks raises.
    """
    want = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = names or {}
    opts = {**CSV_OPTIONS, **options}
    if opts["header"] != "true":
        return spark.read.schema(want).options(**opts).csv(path)
    # the header alone is read here (no inference); a name that is missing raises below
    header = spark.read.options(**{**opts, "inferSchema": "false"}).csv(path).columns
    types = {names.get(f.name, f.name): f for f in want.fields}
    lost = [n for n in types if n not in header]
    if lost:
        raise ValueError(f"the header of {path} lacks the columns {lost}")
    ordered = T.StructType([T.StructField(n, types[n].dataType if n in types else T.StringType()) for n in header])
    rows = spark.read.schema(ordered).options(**opts).csv(path).select(
        *[F.col(f"`{n}`").alias(f.name) for n, f in types.items()])
    # true for every row; it reads all columns, so every cell is parsed even if few are selected
    return rows.where(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]) >= F.lit(-(1 << 63)))


def csv_overwrite(df: DataFrame, path: str) -> None:
    """CSV sink that replaces the folder (S5).  No index column is written."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def csv_append(df: DataFrame, path: str) -> None:
    """CSV sink that adds files to the folder (S4); each file has its own header line."""
    df.write.mode("append").option("header", "true").csv(path)


# ---- appends that count once

# The manifest has one row for each batch that was appended whole: its name and its folder.
_MANIFEST = "batch string, folder string"


def _batches(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(batch, folder) of the batches that were appended whole."""
    try:
        rows = spark.read.schema(_MANIFEST).json(f"{path.rstrip('/')}/manifest/*").dropna().collect()     # a row per batch
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((r["batch"], r["folder"]) for r in rows)


def csv_append_batch(df: DataFrame, path: str, batch: str) -> bool:
    """Append ``df`` as the batch of that name, once: a job that runs again adds nothing.

    The files go to a folder of their own, and only when all are written does the
    manifest name it; :func:`csv_scan_batches` reads what the manifest names.  So a job that failed
    halfway leaves files that nobody reads, and its next run appends the batch whole.
    Two runs of a batch at the same time both write, and the manifest names the folder of the
    later.  Returns whether the batch was new.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if any(b == batch for b, _ in _batches(spark, path)):
        return False
    name = hashlib.md5(batch.encode()).hexdigest()
    folder = f"parts/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("header", "true").csv(f"{path}/{folder}")
    spark.createDataFrame([(batch, folder)], _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{path}/manifest/{name}")
    return True


def csv_scan_batches(spark: SparkSession, path: str, schema: T.StructType | str, **options: str) -> DataFrame:
    """CSV scan (S1) of all batches that were appended whole; without any, no rows."""
    path = path.rstrip("/")
    folders = [f"{path}/{folder}" for _, folder in _batches(spark, path)]
    if not folders:
        return spark.createDataFrame([], schema)
    return csv_scan(spark, folders, schema, **options)


def preview(df: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """First ``n`` rows in key order (S7): a top-n, planned as TakeOrderedAndProject."""
    return df.orderBy(*keys).limit(n)


# a task's rows are numbered from its partition's number times 2 ** 33 on
_TASK_BITS = 33


def ordered_rows(df: DataFrame, keys: Sequence[str | Column], position: str = "position") -> DataFrame:
    """All rows with their 1-based place in key order (O1): gapless, and no task holds all rows.

    Rows are dealt to partitions by ranges of the keys (Spark samples the ranges), sorted inside,
    and numbered there; the partitions' row counts (one number each) give each its first place.
    Rows that share all keys are told apart by a hash of the row and then by where they were read,
    so that a key which very many rows share is spread over partitions too; among equal
    keys the order is by that hash, and equal rows are interchangeable.  The rows are written once, in order.
    """
    spark, names = df.sparkSession, df.columns
    x = df.withColumns({"_tie": F.xxhash64(*names), "_read": F.monotonically_increasing_id()})
    order = [*keys, "_tie", "_read"]
    placed = materialize(x.repartitionByRange(*order).sortWithinPartitions(*order)
                         .select(*names, F.monotonically_increasing_id().alias("_at")), "ordered")
    part = F.shiftright("_at", _TASK_BITS).alias("_part")
    counts = sorted((r["_part"], r["n"]) for r in placed.groupBy(part).agg(F.count("*").alias("n")).collect())
    first, rows = 1, []
    for p, n in counts:
        rows.append((p, first - (p << _TASK_BITS)))
        first += n
    starts = spark.createDataFrame(rows, "_part long, _start long")
    return placed.withColumn("_part", part).join(starts, "_part").select(
        *names, (F.col("_at") + F.col("_start")).alias(position))


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files with their 0-based place: ``position, value``.

    Places run on from file to file, by file name.  The files are read in splits of any
    size: a split's lines are numbered by the task that reads it, and the splits' line
    counts (one row each) give each split its first place.
    """
    read = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"))
    lines = materialize(read, "lines")
    splits = lines.groupBy("_file", "_block").agg(F.count("*").alias("n"), F.min("_at").alias("least")).collect()
    place, rows = 0, []
    for r in sorted(splits, key=lambda r: (r["_file"], r["_block"])):
        rows.append((r["_file"], r["_block"], place - r["least"]))
        place += r["n"]
    starts = spark.createDataFrame(rows, "_file string, _block long, _start long")
    return lines.join(starts, ["_file", "_block"]).select((F.col("_at") + F.col("_start")).alias("position"), "value")


def profile_partitions(df: DataFrame) -> DataFrame:
    """Rows per partition (S8), computed by the executors."""
    return (df.select(F.spark_partition_id().alias("partition"))
            .groupBy("partition").agg(F.count("*").alias("rows")))


def schema_report(df: DataFrame) -> DataFrame:
    """Column name, type and nullability as a table (S8, the printSchema half)."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string, nullable boolean")


def repartition_rows(df: DataFrame, n: int, keys: Iterable[str] | None = None) -> DataFrame:
    """Repartition to ``n`` (R1), by hash of ``keys`` when given; content unchanged."""
    keys = list(keys or [])
    return df.repartition(n, *keys) if keys else df.repartition(n)


LINEUP_SCHEMA = T.StructType([
    T.StructField("match_id", T.LongType(), False),
    T.StructField("innings", T.IntegerType(), False),
    T.StructField("batting", T.ArrayType(T.StringType()), False),
    T.StructField("bowling", T.ArrayType(T.StringType()), False),
])


def lineup_table(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType = LINEUP_SCHEMA
                 ) -> DataFrame:
    """Line-ups typed in by a user -> table (S6): (match_id, innings, batting, bowling).

    For a handful of literal line-ups; line-ups of many matches belong in a file.
    """
    return spark.createDataFrame(list(rows), schema)
