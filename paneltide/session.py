"""SparkSession construction and cluster-safe lineage cutting."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a job needs regardless of where it runs.  Sizes such as
# shuffle partitions are left to the cluster (AQE coalesces them).
_CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce shuffle partitions by the advisory size, not by default
    # parallelism (the documented production setting): small post-aggregate
    # stages become one or two tasks instead of one per core.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Model fits aggregate dozens of co-moments in one pass; keep them inside
    # whole-stage codegen (default 100 buffer fields would fall back to the
    # interpreted path).
    "spark.sql.codegen.maxFields": "1000",
    # Checkpoints (the CUSUM prefix sum) are removed by Spark once their RDD
    # is no longer referenced, instead of accumulating in the shared folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "paneltide",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the settings the library relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _CORE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect sessions have no context
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only set one when unset.

    On a cluster the setting names a shared folder (HDFS/object store) that
    survives executor loss.  Only local test sessions fall back to a scratch
    folder, since there the driver *is* the only machine.
    """
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not d:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="paneltide-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a later step must see *exactly* the rows (and partition ids) an
    earlier step saw, and where recomputation after an executor loss would be
    expensive.  Never a local checkpoint: those die with the executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sizing_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a run over ``input_bytes`` on ``total_cores``.

    Scan splits and post-shuffle partitions aim at ``target_partition_bytes``
    (fits executor memory with room for sort/aggregate buffers); the initial
    shuffle partition count is a multiple of the core count so AQE has room to
    coalesce small partitions and split skewed ones.  Example: 100 TB on 8000
    cores -> 416,000 initial shuffle partitions (52 waves), 256 MB scan splits.
    """
    parts = max(total_cores * 2, -(-input_bytes // target_partition_bytes))
    parts = -(-parts // total_cores) * total_cores          # round up to a multiple of cores
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
    }


def _zip_package() -> str:
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="paneltide-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    return path


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (pandas UDFs,
    ``mapInPandas``): zip it once per session and ship it -- ``addPyFile`` on a
    classic session (the in-process ``spark-submit --py-files``), artifacts
    under Spark Connect."""
    sc = _context(spark)
    key = id(sc) if sc is not None else id(spark)
    if key in _SHIPPED:
        return
    if sc is not None:
        sc.addPyFile(_zip_package())
    else:
        spark.addArtifacts(_zip_package(), pyfile=True)
    _SHIPPED.add(key)
