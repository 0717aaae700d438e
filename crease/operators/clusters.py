"""Player clusters: feature vectors, K-means (MLlib), assignment, cost, elbow sweep.

Fitting is MLlib's distributed K-means.  Assignment and cost are plain column
expressions: the k centres (a table of k rows, k chosen by the caller) are
read as one scalar subquery holding an array, so every point finds its nearest
centre in a projection - no join of points with centres and no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.fixed import ELBOW_FRACTION, ELBOW_KS, KMEANS_ROUNDS, KMEANS_SEED
from crease.functions import unit_hash

# Rows of a partition that an iterative fit scans; the partitions of a fit follow from the number of its rows.
FIT_ROWS = 20_000
FIT_PARTITIONS = 8          # partitions of a fit at least
# Points and centres of ``lloyd`` lie on a grid of this many steps to a unit.
GRID = 1024


def assemble_features(df: DataFrame, cols: list[str], out: str = "features",
                      handle_invalid: str = "error", scale: bool = False) -> DataFrame:
    """Feature vector per row (M1).  A NULL/NaN feature raises; with
    ``handle_invalid="skip"`` such rows are left out (:func:`invalid_rows` lists them).

    ``scale=True`` divides each feature by its standard deviation (the
    reference imports a scaler but does not use it, so the default is off).
    """
    v = VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid)
    res = v.transform(df)
    if scale:
        s = StandardScaler(inputCol=out, outputCol=f"{out}_scaled", withMean=False, withStd=True)
        res = s.fit(res).transform(res).drop(out).withColumnRenamed(f"{out}_scaled", out)
    return res


def invalid_rows(df: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """Keys of the rows that :func:`assemble_features` can't take (a NULL or NaN feature)."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    return df.where(bad).select(*keys)


def sample_rows(df: DataFrame, fraction: float, seed: int, keys: Iterable[str]) -> DataFrame:
    """Bernoulli sample without replacement (M5): each row kept with probability ``fraction``.

    The draw of a row is a hash of (seed, its unique ``keys``; rows that share
    them are kept or left together), not a position in its partition, so a partition recomputed
    after a lost executor - whose rows may come back in another order -
    yields the same sample, and a cached sample never changes under a fit.
    """
    return df.filter(unit_hash(F.lit(seed), *keys) < fraction)


def fit_partitions(rows: int, per: int = FIT_ROWS) -> int:
    """Partitions of an iterative fit on that many rows: no task holds more than about ``per`` of them."""
    return max(FIT_PARTITIONS, -(-rows // per))


def placed(points: DataFrame, key: str | list[str] = "Player", partitions: int | None = None) -> DataFrame:
    """Points in partitions by a hash of their unique key and sorted inside; how many follows from
    the number of points (one count) unless stated.

    MLlib's start centres and sums depend on which rows stand where; with the
    rows placed by key the same points give the same fit whatever the session's
    shuffle setting, the input's order or a task that ran twice.
    """
    keys = [key] if isinstance(key, str) else key
    n = fit_partitions(points.count()) if partitions is None else partitions
    return points.repartition(n, *keys).sortWithinPartitions(*keys)


def fit_clusters(points: DataFrame, k: int, seed: int = 1, features: str = "features",
                 max_iter: int = 20, key: str = "Player", partitions: int | None = None) -> KMeansModel:
    """MLlib K-means fit (M2) on points placed by their unique ``key``."""
    return KMeans(k=k, seed=seed, featuresCol=features, maxIter=max_iter).fit(
        placed(points.select(key, features), key, partitions))


def centres_table(model: KMeansModel, k_label: int | None = None) -> DataFrame:
    """Centres of a fitted model as a table (cluster, center array<double>[, k])."""
    spark = model.summary.predictions.sparkSession if model.hasSummary else None
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    df = spark.createDataFrame(rows, "cluster int, center array<double>")
    return df if k_label is None else df.withColumn("k", F.lit(k_label))


def as_array(col: str | Column) -> Column:
    """A vector or numeric array column as array<double>."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("array<double>")


def _centre_array(centres: DataFrame) -> Column:
    """All centres, sorted by id, as one scalar value; the caller's k fixes its size."""
    return centres.select(F.array_sort(F.collect_list(F.struct(
        F.col("cluster").cast("int").alias("cluster"),
        F.col("center").cast("array<double>").alias("center"))))).scalar()


def _sq_dist(p: Column, c: Column) -> Column:
    return F.aggregate(F.zip_with(p, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                       lambda acc, x: acc + x)


def nearest(p: Column, centre_array: Column) -> Column:
    """struct(d, id) of the nearest centre; ties go to the smaller id."""
    return F.array_min(F.transform(centre_array, lambda c: F.struct(
        _sq_dist(p, c["center"]).alias("d"), c["cluster"].alias("id"))))


def assign_clusters(points: DataFrame, centres: DataFrame, vec: str = "features",
                    keep: Iterable[str] | None = None) -> DataFrame:
    """Nearest centre of every point (M3): adds ``cluster`` and squared ``distance``."""
    keep = list(keep) if keep is not None else [c for c in points.columns if c != vec]
    # the centre array is bound to a column first: a subquery may not sit inside a lambda
    x = points.withColumn("_centres", _centre_array(centres))
    best = nearest(as_array(vector_to_array(F.col(vec)) if _is_vector(points, vec) else F.col(vec)),
                   F.col("_centres"))
    return x.select(*keep, best["id"].alias("cluster"), best["d"].alias("distance"))


def kmeans_cost(points: DataFrame, centres: DataFrame, vec: str = "features") -> DataFrame:
    """Sum of squared distances to the nearest centre (A9), one row."""
    return assign_clusters(points, centres, vec, keep=[]).agg(F.sum("distance").alias("cost"))


def _is_vector(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, VectorUDT)


def elbow_curve(points: DataFrame, ks: Iterable[int] = ELBOW_KS, fraction: float = ELBOW_FRACTION,
                seed: int = KMEANS_SEED, features: str = "features", parallelism: int = 4,
                key: str = "Player", partitions: int | None = None) -> DataFrame:
    """Cost for each k (M4): fit on a sample, cost on all points; a (k, cost) table.

    The points are cached for the sweep.  Each fit is a distributed MLlib job
    on the sample; up to ``parallelism`` fits are submitted at once from
    driver threads (as MLlib's own model selection does), since they are
    independent.  The costs of all k are then computed in one pass over the
    points: each point meets the centre sets of every k inside a projection,
    and a partial aggregate by k sums them.  The result has one row per k
    (a size fixed by ``ks``), so it is computed here and the cache released.
    A sample with fewer points than the greatest k raises: raise ``fraction``.
    """
    from concurrent.futures import ThreadPoolExecutor
    ks = list(ks)
    spark = points.sparkSession
    pts = points.select(key, features).persist()
    sample = placed(sample_rows(pts, fraction, seed, [key]), key, partitions).persist()
    try:
        n = sample.count()
        if n < max(ks):
            raise ValueError(f"the sample holds {n} points, fewer than k = {max(ks)}; raise the fraction")

        def centres_for(k: int) -> list:
            m = KMeans(k=k, seed=seed, featuresCol=features).fit(sample)
            return [(i, [float(x) for x in c]) for i, c in enumerate(m.clusterCenters())]

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            sets = list(zip(ks, pool.map(centres_for, ks)))
        table = spark.createDataFrame(
            [(k, cs) for k, cs in sets],
            "k int, centres array<struct<cluster:int, center:array<double>>>")
        all_sets = table.select(F.array_sort(F.collect_list(F.struct("k", "centres")))).scalar()
        p = as_array(vector_to_array(F.col(features)) if _is_vector(pts, features) else F.col(features))
        x = pts.withColumn("_sets", all_sets)
        per_point = x.select(F.explode(F.transform(F.col("_sets"), lambda s: F.struct(
            s["k"].alias("k"), nearest(p, s["centres"])["d"].alias("d")))).alias("kd"))
        costs = (per_point.groupBy(F.col("kd.k").alias("k"))
                 .agg(F.sum("kd.d").alias("cost")).collect())
    finally:
        sample.unpersist()
        pts.unpersist()
    return spark.createDataFrame([(r.k, r.cost) for r in costs], "k int, cost double")


# ---- rounds from stated start centres, all k at once


def on_grid(points: DataFrame, features: list[str], key: str = "Player", grid: int = GRID) -> DataFrame:
    """(key, v): the features as whole numbers of grid steps, nearest first (halves up).  Rows with a
    NULL feature are left out, as :func:`assemble_features` does with ``skip``."""
    steps = [F.floor(F.col(c).cast("double") * grid + 0.5) for c in features]
    return points.dropna(subset=features).select(key, F.array(*steps).alias("v"))


def start_points(points: DataFrame, n: int, seed: int = KMEANS_SEED, key: str = "Player") -> list[list[int]]:
    """The ``n`` points whose keys hash lowest (ties: the lesser key): the same on every run."""
    rows = points.orderBy(unit_hash(F.lit(seed), key), key).limit(n).collect()          # n rows
    return [list(r["v"]) for r in rows]


def _long_dist(p: Column, c: Column) -> Column:
    return F.aggregate(F.zip_with(p, c, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda s, x: s + x)


def _with_sets(points: DataFrame, sets: dict[int, list[list[int]]]) -> DataFrame:
    """Every point with the centre sets of all k as one value (their sizes are the caller's)."""
    spark = points.sparkSession
    table = spark.createDataFrame([([(k, [(i, c) for i, c in enumerate(cs)]) for k, cs in sets.items()],)],
                                  "sets array<struct<k:int, centres:array<struct<id:int, center:array<bigint>>>>>")
    # the value is bound to a column first: a subquery may not sit inside a lambda
    return points.withColumn("_sets", table.select("sets").scalar())


def _per_set() -> Column:
    """For every k the nearest centre of point ``v``, ties to the smaller id: (k, d, id)."""
    near = lambda s: F.array_min(F.transform(s["centres"], lambda c: F.struct(
        _long_dist(F.col("v"), c["center"]).alias("d"), c["id"].alias("id"))))
    return F.transform(F.col("_sets"), lambda s: F.struct(s["k"].alias("k"), near(s).alias("at")))


def lloyd(points: DataFrame, ks: Iterable[int], rounds: int = KMEANS_ROUNDS, seed: int = KMEANS_SEED,
          key: str = "Player") -> dict[int, list[list[int]]]:
    """K-means for all ``ks`` at once (M2, M4): the centres of each k after ``rounds`` rounds, in grid steps.

    Set k starts from the first k points of :func:`start_points` (all there are, when they are
    fewer).  A round is one scan and one aggregate: each point finds its nearest centre in every
    set inside a projection, and sums and counts by (k, centre) are combined before the
    shuffle; a centre moves to the floor of its points' mean, one without points stays.
    Whole numbers throughout, so a fit does not depend on the order of rows or on partitions
    (an overflow raises).  Only centres reach the driver; rounds end early once none moves.
    """
    ks = list(ks)
    start = start_points(points, max(ks), seed, key)
    if not start:
        return {k: [] for k in ks}
    sets = {k: start[:k] for k in ks}
    dims = len(start[0])
    for _ in range(rounds):
        x = _with_sets(points, sets).select("v", F.explode(_per_set()).alias("s"))
        sums = x.groupBy(F.col("s.k").alias("k"), F.col("s.at.id").alias("id")).agg(
            F.count("*").alias("n"), *[F.sum(F.col("v")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(dims)]).collect()
        moved = {k: list(cs) for k, cs in sets.items()}
        for r in sums:                                                                   # at most sum(ks) rows
            moved[r["k"]][r["id"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]
        if moved == sets:
            break
        sets = moved
    return sets


def grid_centres(spark, centres: list[list[int]], grid: int = GRID) -> DataFrame:
    """Centres in grid steps as a table (cluster, center array<double>)."""
    return spark.createDataFrame([(i, [x / grid for x in c]) for i, c in enumerate(centres)], "cluster int, center array<double>")


def grid_assign(points: DataFrame, centres: list[list[int]], key: str = "Player", grid: int = GRID) -> DataFrame:
    """(key, cluster, distance): the nearest centre of every point on the grid, and the squared distance in units."""
    at = F.get(_per_set(), F.lit(0))["at"]
    return _with_sets(points, {len(centres): centres}).select(
        key, at["id"].alias("cluster"), (at["d"].cast("double") / float(grid * grid)).alias("distance"))


def grid_costs(points: DataFrame, sets: dict[int, list[list[int]]], grid: int = GRID) -> DataFrame:
    """(k, cost): for each centre set the sum of squared distances of all points, in one pass."""
    x = _with_sets(points, sets).select(F.explode(_per_set()).alias("s"))
    cost = F.sum(F.col("s.at.d").cast("decimal(20,0)")).cast("double") / float(grid * grid)
    return x.groupBy(F.col("s.k").alias("k")).agg(cost.alias("cost"))


def lloyd_elbow(points: DataFrame, ks: Iterable[int] = ELBOW_KS, fraction: float = ELBOW_FRACTION, rounds: int = KMEANS_ROUNDS,
                seed: int = KMEANS_SEED, key: str = "Player", grid: int = GRID) -> DataFrame:
    """Cost for each k (M4) from :func:`lloyd` on a sample, cost on all points.

    ``points`` (key, v) are read once a round: materialize them first.
    """
    sets = lloyd(sample_rows(points, fraction, seed, [key]), ks, rounds, seed, key)
    return grid_costs(points, {k: cs for k, cs in sets.items() if cs}, grid)


def cluster_sizes(assignments: DataFrame, cluster: str = "Cluster") -> DataFrame:
    """Players per cluster (A5)."""
    return assignments.groupBy(cluster).agg(F.count("*").alias("players"))
