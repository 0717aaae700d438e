"""Session helpers: one place for the settings every job and test relies on."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that shape the physical plan.  AQE re-plans joins at run time
# (broadcast only when the measured side is under the threshold, skew-join
# splitting, partition coalescing), so no operator hard-codes a broadcast.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def scale_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` on ``cores`` task slots.

    Start with enough shuffle partitions that each holds about
    ``partition_bytes`` of the input (at least two per core), read files in
    splits of the same size, and let AQE coalesce small partitions and split
    skewed ones toward that size.  At 100 TB on 8,000 cores this gives about
    400,000 initial shuffle partitions of 256 MiB, each well inside an
    executor's memory; at sf0.1 on 8 cores it gives 16.
    """
    n = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def build_session(master: str = "local[8]", app: str = "crease",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, loopback driver)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.bindAddress", "127.0.0.1")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**PLAN_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    On a cluster ``spark.checkpoint.dir`` names a shared file system path and is
    used as is; when it is unset, a ``local`` session makes a scratch folder and
    any other session raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="crease-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        sc = spark.sparkContext
    except Exception:          # a Spark Connect session has no SparkContext here
        return path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/crease-{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(remove_written, spark)
    _WRITTEN.append(path)
    return path


_WRITTEN: list[str] = []


def remove_written(spark: SparkSession) -> None:
    """Delete the folders that this process wrote (also done when Python exits).

    Results that still read them must have been written or collected before.
    """
    try:
        jvm = spark._jvm
        conf = jvm.org.apache.hadoop.conf.Configuration()
        while _WRITTEN:
            path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
            path.getFileSystem(conf).delete(path, True)
    except Exception:          # the JVM has gone first; the shared folder's own clean-up remains
        _WRITTEN.clear()


def materialize(df, name: str):
    """Write ``df`` as parquet to a fresh folder of the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but computes ``df`` once (a
    reliable checkpoint of an uncached plan runs it twice) and stores it
    columnar, so later readers prune columns.  The files outlive a lost
    executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def at_once(*steps):
    """The results of independent steps, functions without arguments that write or fit something, run side
    by side: the tail of one step's tasks leaves slots that another's fill."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


def splittable(side, *keys: str):
    """``side`` of a join on ``keys``, so that a hot key of the other side can be split.

    AQE splits a hot key only when both sides are shuffled for the join itself.  An
    aggregate on the join's own keys already lies by them, is not shuffled again,
    and so pins each key to one task.  Its keys pass through an expression here
    that keeps their values but not that knowledge: the join shuffles the aggregate,
    the smaller side, once more (or broadcasts it, when it measures small).
    """
    from pyspark.sql import functions as F

    return side.withColumns({k: F.array_max(F.array(k)) for k in keys})
