"""Intermediate stage sinks/sources (parquet replaces serialized R objects).

A ``StageStore`` keeps one version of each stage.  A version is named after what
the stage was made from: the versions of the stages it read, the listing of the
source files (names, sizes, times) and its parameters.  Its rows go to a folder of
its own, ``<root>/<stage>/version=<version>``; the manifest
``<root>/_manifests/<stage>.json`` is written last, and then other versions are
removed.  A run that finds a manifest of the version it wants reads the stage
instead of making it, so a run that was stopped goes on after its last whole
stage, and one with other inputs makes anew what depends on them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Part of every version: changed by hand when stages change their meaning.
FORMAT = "1"


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Parquet stage.  Rows of one partition value are brought together first
    (AQE splits the large values), so a value gets few files, not one from
    every task."""
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _manifest(spark: SparkSession, root: str, name: str) -> dict | None:
    path = f"{root}/_manifests/{name}.json"
    fs, where = _file_system(spark, path)
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if fs.exists(where) else None


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A stage by its folder: its current version, or the folder itself where it
    has no manifest."""
    root, _, name = path.rstrip("/").rpartition("/")
    found = _manifest(spark, root, name)
    return spark.read.parquet(f"{path.rstrip('/')}/version={found['version']}" if found else path)


def source_version(spark: SparkSession, folder: str) -> str:
    """A name for the files below a folder as they are now; nothing is read of
    them but the listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    n, total = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return f"{n}-{total}"


class StageStore:
    """The stages below ``root``; ``versions`` has those made or found so far."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.versions: dict[str, str] = {}

    def stage(self, name: str, make: Callable[[], DataFrame], made_from: Sequence[str], partition_by: list[str] | None = None) -> DataFrame:
        """The stage ``name``, made only where its version is not whole yet.
        ``made_from``: versions of its inputs and its parameters."""
        version = hashlib.sha256(json.dumps([FORMAT, name, *made_from]).encode()).hexdigest()[:16]
        self.versions[name] = version
        folder = f"{self.root}/{name}/version={version}"
        found = _manifest(self.spark, self.root, name)
        if not found or found["version"] != version:
            rows = Observation(f"stage {name}")
            df = make()
            write_stage(df.observe(rows, F.count(F.lit(1)).alias("rows")), folder, partition_by=partition_by)
            self._commit(name, {"stage": name, "version": version, "rows": rows.get["rows"], "columns": df.columns})
            found = _manifest(self.spark, self.root, name)
        return self.spark.read.parquet(folder).select(*[F.col(f"`{c}`") for c in found["columns"]])

    def _commit(self, name: str, manifest: dict) -> None:
        """Write the manifest in one rename, then remove the stage's other files."""
        path = f"{self.root}/_manifests/{name}.json"
        fs, where = _file_system(self.spark, path)
        _, part = _file_system(self.spark, f"{path}.{manifest['version']}")
        out = fs.create(part, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        fs.delete(where, False)
        fs.rename(part, where)
        _, folder = _file_system(self.spark, f"{self.root}/{name}")
        for entry in fs.listStatus(folder):
            if entry.getPath().getName() != f"version={manifest['version']}":
                fs.delete(entry.getPath(), True)
