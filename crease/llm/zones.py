"""Centroid clustering over space-filling-curve zone maps.

Vectors of whole numbers are put in the order of a Hilbert curve (Skilling, 2004:
axes to transposed index), by a range shuffle, and cut into blocks of
consecutive vectors.  A block stores its vectors and the box of its least and greatest
components.  In every round a block first meets the centroids with its box alone: a
centroid whose least distance to the box is beyond another's greatest can be
nearest to none of the block's vectors.  The rest, its candidates, are
compared with all vectors of the block at once, in whole numbers.

Blocks are written once; a round reads them, adds up each task's vectors by centroid and
shuffles those sums alone (centroids times components numbers from each task).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.text import forget_in_worker
from crease.session import materialize

COMPONENTS = 64
SCALE = 64             # a component x becomes floor(SCALE * x)
CENTROIDS = 16
ROUNDS = 3
SEED = 1
BITS = 4               # of a component in the curve's index
BLOCK = 256            # vectors of a block
LIMIT = 1 << 27        # greatest size of a whole number: 64 squared differences of such fit a long
_EXACT = 1 << 20       # up to here a product of matrices of doubles is exact


# ---- whole numbers, curve and blocks ----------------------------------------

def _kept(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch (id, array) that are kept, and their whole numbers."""
    lists = batch.column(1).cast(pa.list_(pa.float64()))
    sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == COMPONENTS)
    flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)       # a null component is NaN
    with np.errstate(invalid="ignore"):
        whole = np.floor(SCALE * flat.reshape(-1, COMPONENTS))
        good = (np.abs(whole) <= LIMIT).all(axis=1)                                  # false for NaN and infinity
    return rows[good], whole[good].astype(np.int32)


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v, least, greatest) of the rows that are kept; ``v`` is COMPONENTS little-endian 32-bit numbers."""
    def run(batches):
        forget_in_worker()
        for b in batches:
            rows, v = _kept(b)
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)), pa.array([x.astype("<i4").tobytes() for x in v], pa.binary()),
                     pa.array(v.min(axis=1)), pa.array(v.max(axis=1))], names=["vec_id", "v", "least", "greatest"])

    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("e")).mapInArrow(
        run, "vec_id long, v binary, least int, greatest int")


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """(rows, bits * axes / 8) bytes: the place on the Hilbert curve of each row of cell
    numbers below ``2 ** bits``, highest bits first, so that bytes compare as places do."""
    x = np.ascontiguousarray(cells.T).astype(np.uint8)                # (axes, rows)
    axes = len(x)
    for b in range(bits - 1, 0, -1):
        low = np.uint8((1 << b) - 1)
        for i in range(axes):
            high = (x[i] >> np.uint8(b) & np.uint8(1)).astype(bool)
            swap = np.where(high, np.uint8(0), (x[0] ^ x[i]) & low)   # exchange the low bits of axes 0 and i, or
            x[0] ^= np.where(high, low, swap)                         # turn those of axis 0 round
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> np.uint8(b) & np.uint8(1), np.uint8((1 << b) - 1), np.uint8(0))
    x ^= turn
    planes = np.stack([x >> np.uint8(b) & np.uint8(1) for b in range(bits - 1, -1, -1)])      # (bits, axes, rows)
    return np.packbits(planes.reshape(bits * axes, -1).T, axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(-1, COMPONENTS)


def zone_maps(whole: DataFrame, least: int, greatest: int) -> DataFrame:
    """Blocks of vectors along the curve: ``ids, v, lo, hi`` (vectors, and the corners of their box).

    The range shuffle goes by place on the curve, then by a number of the written
    row, so that a place (or vector) that very many rows share is spread over partitions too.
    """
    span = greatest - least + 1

    def index(batches):
        for b in batches:
            cells = (_matrix(b.column(1)).astype(np.int64) - least << BITS) // span
            key = hilbert_index(cells)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([k.tobytes() for k in key], pa.binary())],
                                             names=["vec_id", "v", "row", "key"])

    def block(batches):
        ids, rows = [], []

        def flush():
            v = _matrix(pa.array(rows, pa.binary()))
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([v.tobytes()], pa.binary()),
                 pa.array([v.min(axis=0).tobytes()], pa.binary()), pa.array([v.max(axis=0).tobytes()], pa.binary())],
                names=["ids", "v", "lo", "hi"])

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                rows.append(v)
                if len(rows) == BLOCK:
                    yield flush()
                    ids, rows = [], []
        if rows:
            yield flush()

    numbered = whole.select("vec_id", "v", F.monotonically_increasing_id().alias("row"))
    keyed = numbered.mapInArrow(index, "vec_id long, v binary, row long, key binary")
    placed = keyed.repartitionByRange("key", "row").sortWithinPartitions("key", "row").select("vec_id", "v")
    return materialize(placed.mapInArrow(block, "ids array<long>, v binary, lo binary, hi binary"), "zones")


# ---- rounds -----------------------------------------------------------------

def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to some vector within the box."""
    lo, hi = lo.astype(np.int64), hi.astype(np.int64)
    least = (np.maximum(np.maximum(lo - centroids, centroids - hi), 0) ** 2).sum(axis=1)
    most = (np.maximum(np.abs(centroids - lo), np.abs(centroids - hi)) ** 2).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def nearest(v: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector ``among`` the given (ties: the smaller number), and the squared distance."""
    c = centroids[among]
    if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) <= _EXACT:
        x, y = v.astype(np.float64), c.astype(np.float64)
        d = ((x ** 2).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y ** 2).sum(axis=1)).astype(np.int64)
    else:
        d = np.stack([((v.astype(np.int64) - one) ** 2).sum(axis=1) for one in c], axis=1)
    best = d.argmin(axis=1)
    return among[best], d[np.arange(len(v)), best]


def _blocks(batches, centroids: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, vectors, cluster, squared distance) of every block."""
    for b in batches:
        for ids, v, lo, hi in zip(*[c.to_pylist() for c in b.columns], strict=True):
            v = np.frombuffer(v, dtype="<i4").reshape(-1, COMPONENTS)
            among = candidates(np.frombuffer(lo, dtype="<i4"), np.frombuffer(hi, dtype="<i4"), centroids)
            yield ids, v, *nearest(v, centroids, among)


def _moved(zones: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid that has vectors at the floor of their exact mean; the others stay."""
    k = len(centroids)

    def add(batches):
        total = np.zeros((k, COMPONENTS + 1), dtype=np.int64)         # component sums, then the number of vectors
        for _, v, cluster, _ in _blocks(batches, centroids):
            for c in np.unique(cluster):
                mine = v[cluster == c]
                total[c, :-1] += mine.sum(axis=0, dtype=np.int64)
                total[c, -1] += len(mine)
        some = np.flatnonzero(total[:, -1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(some, COMPONENTS + 1).astype(np.int32)),
             pa.array(np.tile(np.arange(COMPONENTS + 1, dtype=np.int32), len(some))), pa.array(total[some].reshape(-1))],
            names=["c", "i", "n"])

    sums = (zones.mapInArrow(add, "c int, i int, n long").groupBy("c", "i")
            .agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n")).collect())          # centroids * (components + 1) rows
    total = {(r["c"], r["i"]): int(r["n"]) for r in sums}
    out = centroids.copy()
    for c in {c for c, _ in total}:
        out[c] = [total[c, i] // total[c, COMPONENTS] for i in range(COMPONENTS)]
    return out


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Kept are vectors of exactly COMPONENTS components, none null or non-finite;
    components beyond ``LIMIT / SCALE`` in size, whose squared distance need not fit a long,
    leave a vector out as non-finite ones do.  The start is the ``k`` kept vectors whose
    ids have the smallest SHA-256 of ``seed:id`` (of rows that share an id, the least
    bytes first; a null id starts nothing), or all there are.  Repeated rows count each for
    itself, a null id stays null, an inertia beyond a long is null.  No kept vectors, or none with
    an id: no rows.
    """
    whole = materialize(whole_vectors(vectors, id_col, vec_col), "whole")
    hashed = whole.where("vec_id is not null").select(
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "vec_id", "v")
    start = hashed.orderBy("h", "vec_id", "v").limit(k).collect()                        # k rows
    spark = vectors.sparkSession
    if not start:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    centroids = np.stack([np.frombuffer(r["v"], dtype="<i4") for r in start]).astype(np.int64)
    ends = whole.agg(F.min("least"), F.max("greatest")).first()
    zones = zone_maps(whole.select("vec_id", "v"), ends[0], ends[1])
    for _ in range(rounds):
        centroids = _moved(zones, centroids)

    def assign(batches):
        for ids, _, to, distance in _blocks(batches, centroids):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(to.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    placed = materialize(zones.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()      # k rows
    of = {r["cluster"]: int(r["s"]) for r in sums}
    long = lambda n: F.lit(n if n < 1 << 63 else None).cast("long")
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = F.array(*[F.struct(long(of.get(c, 0)).alias("s"), F.lit(names[c]).alias("h")) for c in range(len(names))])
    mine = table[F.col("cluster")]
    return placed.select("vec_id", "cluster", "distance", mine["s"].alias("cluster_inertia"),
                         long(sum(of.values())).alias("inertia"), mine["h"].alias("centroid_sha256"))


#: The same in DuckDB: every vector with every centroid, rounds written out.
def _sql(k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    parts = [f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS})""",
             f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS c, v FROM (
  SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h LIMIT {k}) s)"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS (
  SELECT vec_id, v, d['c'] AS cluster, d['d'] AS distance FROM (
    SELECT k.vec_id, any_value(k.v) AS v, min({{'d': list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))),
                                               'c': c.c}}) AS d
    FROM kept k CROSS JOIN c{r} c GROUP BY k.vec_id) s)""")
        if r < rounds:
            parts.append(f"""m{r} AS (
  SELECT cluster, list(m ORDER BY i) AS v FROM (
    SELECT cluster, i, CAST(floor_div AS BIGINT) AS m FROM (
      SELECT cluster, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
      FROM (SELECT cluster, unnest(range(1, {COMPONENTS + 1})) AS i, unnest(v) AS x FROM a{r}) u GROUP BY cluster, i) f) g
  GROUP BY cluster),
c{r + 1} AS (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.c)""")
    return f"""WITH {", ".join(parts)}
SELECT a.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.cluster"""


ORACLE_SQL = _sql()
