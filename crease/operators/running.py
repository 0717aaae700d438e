"""Running (prefix) aggregates that do not put a whole group into one task.

A plain ``Window.partitionBy(match).orderBy(ball)`` sends every row of a match
to one task, and that task buffers the group.  If one match (or user, or
source) holds a third of all rows, that is a third of the data in one task.

Here each group is cut into *chunks* by a column that rises with the order
(for example ``(ball_no - 1) div 4096`` or the hour of a timestamp):

1. per (group, chunk) totals: one partial aggregate, so a hot group is
   combined map-side before the shuffle;
2. prefix over chunks: a window on the small chunk table gives, for each
   chunk, the total of all earlier chunks of its group;
3. join back on (group, chunk) and run the window inside each chunk only,
   adding the offset.

The input is hash-partitioned once by (group, chunk) for the join back and
the inner window.  Step 2 can itself be chunked (``levels`` > 1), so the
chunk table of a group with billions of rows is not one task either.

Both the join and the inner window are keyed by (group, chunk), so the large
side is shuffled once and a hot group is spread over as many tasks as it has
chunks.  Supported kinds are associative: ``sum``, ``max``, ``min``,
``product``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGG = {"sum": F.sum, "max": F.max, "min": F.min, "product": F.product}


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``out`` = kind(``value``) over earlier rows.

    ``inclusive`` takes the current row into the frame; otherwise the frame
    ends one row before it.  Sums of no rows are 0, products 1, max/min null.
    """

    out: str
    kind: str
    value: Column | str
    inclusive: bool = True


def _combine(kind: str, before: Column, within: Column) -> Column:
    if kind == "sum":
        return F.coalesce(before, F.lit(0)) + F.coalesce(within, F.lit(0))
    if kind == "product":
        return F.coalesce(before, F.lit(1.0)) * F.coalesce(within, F.lit(1.0))
    if kind == "max":
        return F.greatest(before, within)
    if kind == "min":
        return F.least(before, within)
    raise ValueError(f"unsupported running kind {kind!r}")


def running_aggregates(df: DataFrame, keys: list[str], order: list[str | Column],
                       chunk: Column, specs: list[Running], levels: int = 1,
                       fanout: int = 4096) -> DataFrame:
    """Add one column per spec with the running aggregate within ``keys``.

    ``order`` must be a total order inside each group, and ``chunk`` (an
    integer) must not fall as ``order`` rises.  Rows with a null key are
    dropped (they belong to no group, as in a pandas group-by).

    The totals of earlier chunks are themselves a running aggregate over the
    chunk table; with ``levels`` > 1 that table is chunked in turn
    (``fanout`` chunks per chunk), so even a group with 10^11 rows never puts
    more than ``fanout`` rows of any level into one window task.  One level
    is the default: its chunk window holds one row per chunk of a group
    (a 16-million-ball innings at 4,096 balls a chunk, or 170 days of hourly
    chunks, is 4,096 rows), and each extra level costs an aggregate and a
    join over the chunk table.
    """
    for s in specs:
        if s.kind not in _AGG:
            raise ValueError(f"unsupported running kind {s.kind!r}")
    ck = f"_chunk{levels}"
    x = df.dropna(subset=keys).withColumn(ck, chunk)
    for i, s in enumerate(specs):
        x = x.withColumn(f"_v{i}", F.col(s.value) if isinstance(s.value, str) else s.value)
    pkeys = keys + [ck]
    # The join back and the inner window both need the rows by (group, chunk);
    # one explicit shuffle serves them (the chunk totals read a pruned copy).
    x = x.repartition(*pkeys)

    per_chunk = x.groupBy(*pkeys).agg(
        *[_AGG[s.kind](f"_v{i}").alias(f"_t{i}") for i, s in enumerate(specs)])
    if levels > 1:
        offsets = running_aggregates(
            per_chunk, keys, [ck], F.floor(F.col(ck) / fanout),
            [Running(f"_o{i}", s.kind, f"_t{i}", inclusive=False) for i, s in enumerate(specs)],
            levels - 1, fanout).select(*pkeys, *[f"_o{i}" for i in range(len(specs))])
    else:
        earlier = (Window.partitionBy(*keys).orderBy(ck)
                   .rowsBetween(Window.unboundedPreceding, -1))
        offsets = per_chunk.select(
            *pkeys, *[_AGG[s.kind](f"_t{i}").over(earlier).alias(f"_o{i}")
                      for i, s in enumerate(specs)])

    inner = Window.partitionBy(*pkeys).orderBy(*order)
    incl = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    excl = inner.rowsBetween(Window.unboundedPreceding, -1)
    joined = x.join(offsets, pkeys, "inner")
    out = joined.select(
        *[c for c in x.columns if not c.startswith("_v") and c != ck],
        *[_combine(s.kind, F.col(f"_o{i}"),
                   _AGG[s.kind](f"_v{i}").over(incl if s.inclusive else excl)).alias(s.out)
          for i, s in enumerate(specs)])
    return out


def ordinal(df: DataFrame, keys: list[str], order: list[str], chunk: Column,
            out: str = "n") -> DataFrame:
    """1-based position of each row inside its group (``row_number``), chunked."""
    return running_aggregates(df, keys, order, chunk,
                              [Running(out, "sum", F.lit(1).cast("long"))])


def levels_for(rows: int, chunk: int = 4096, fanout: int = 4096) -> int:
    """The ``levels`` for a group of that many rows in chunks of ``chunk``: no window holds more than ``fanout`` chunks."""
    levels, chunks = 1, -(-rows // chunk)
    while chunks > fanout:
        levels, chunks = levels + 1, -(-chunks // fanout)
    return levels


def dense_ordinal(df: DataFrame, keys: list[str], order: list[str], out: str = "n") -> DataFrame:
    """1-based position of each row inside its group, however unevenly its rows lie along ``order``.

    No chunk width is needed: rows are dealt by sampled ranges of (keys, order), so
    a group with very many rows within one hour, or one instant, is cut where its rows are.  A row's
    position is its place among all rows (:func:`crease.sources.files.ordered_rows`) less
    the first place of its group, which a partial aggregate finds.  Rows with a null key are dropped; rows
    that share all of ``order`` too stand in the order of a hash of the row.
    """
    from crease.session import splittable
    from crease.sources.files import ordered_rows

    placed = ordered_rows(df.dropna(subset=keys), [*keys, *order], "_place")
    first = placed.groupBy(*keys).agg(F.min("_place").alias("_first"))
    return placed.join(splittable(first, *keys), keys).select(
        *df.columns, (F.col("_place") - F.col("_first") + 1).alias(out))
