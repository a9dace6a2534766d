"""Spark helpers that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one all executors share (spark.checkpoint.dir)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: later
    steps see the same rows, and a lost executor costs no recomputation."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class workspace:
    """Tables of one job below a new shared folder, removed when no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, shared_folder(spark, name)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def remove(self) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda's variable is a
    computed value, where a repeated expression would be computed again."""
    return F.transform(F.array(value), body)[0]


def remainder_of_id(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """64-bit key of a row's id and text: repeated rows share it."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def one_per_key(df: DataFrame, key: str = "rk") -> DataFrame:
    """One row of each key; the group limit leaves one per task before the shuffle."""
    turn = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return df.withColumn("turn", turn).filter("turn = 1").drop("turn")


def rows_as_structs(df: DataFrame) -> DataFrame:
    """Each row as one struct column ``row``: whatever an operator adds beside
    it cannot clash with a column of the input."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def field(batch: pa.RecordBatch, name: str) -> pa.Array:
    """Field ``name`` of the ``row`` struct of a batch."""
    return pc.struct_field(batch.column(0), name)


def packed(values: np.ndarray, widths=(np.uint8, np.uint16, np.uint32, np.uint64)) -> bytes:
    """Values in the narrowest of the widths that holds them all."""
    top = int(values.max()) if len(values) else 0
    return values.astype(next(w for w in widths if top <= np.iinfo(w).max)).tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{len(raw) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def broadcast_value(spark: SparkSession, value):
    return spark.sparkContext.broadcast(value)
