"""Landing CSVs -> long crime table, incrementally (file-source stream).

Each micro-batch parses only files not seen before (the source's file log in
the checkpoint), applies the same content filter and unpivot as the batch
ingest, and appends to a parquet stage partitioned by year.  The checkpoint
lives under the cluster's shared ``spark.checkpoint.dir`` unless given, so a
restarted driver or lost executor resumes without duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir
from ..sources import landing as LD


def crime_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming DataFrame of long crime rows from newly landed crime files."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    return LD.crime_long_of(LD.crime_files(reader, landing_dir))


def ingest_available(spark: SparkSession, landing_dir: str, out_dir: str,
                     checkpoint: str | None = None) -> StreamingQuery:
    """Process every file landed so far, then stop (``availableNow``)."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing-crime-stream"
    q = (crime_stream(spark, landing_dir).writeStream
         .format("parquet").option("path", out_dir).option("checkpointLocation", ckpt)
         .partitionBy("year").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def maintain_crime_wide(spark: SparkSession, landing_dir: str, stage_dir: str,
                        checkpoint: str | None = None) -> StreamingQuery:
    """Keep the wide (agency x month, one column per type) crime table current
    as landing files arrive, recomputing only the years a batch touches.

    One landing file carries one type, so a batch only has part of each wide
    row; every micro-batch therefore (1) writes its long rows under
    ``long/epoch=<id>`` (overwrite: a replayed epoch rewrites, never
    duplicates) and (2) rebuilds the wide rows of the affected years from the
    whole long stage with dynamic partition overwrite.  Both steps are
    idempotent, so the result is exactly-once even across restarts.
    """
    stage = stage_dir.rstrip("/")
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing-crime-wide"

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        s = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{stage}/long/epoch={epoch_id}")
        years = [r.year for r in batch.select("year").distinct().collect() if r.year is not None]
        if not years:
            return
        long = s.read.parquet(f"{stage}/long").filter(F.col("year").isin(years)).drop("epoch")
        wide = LD.crime_by_type(long, validate=True)
        (wide.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("year").parquet(f"{stage}/wide"))

    q = (crime_stream(spark, landing_dir).writeStream
         .foreachBatch(per_batch).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
