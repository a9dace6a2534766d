import os

from paneltide.sources import landing as LD
from paneltide.streaming.landing import ingest_available

from .fixture_files import AGENCIES, MONTHS, write_landing


def test_incremental_ingest_exactly_once(spark, scratch):
    land = os.path.join(scratch, "landing")
    out = os.path.join(scratch, "stage")
    ckpt = os.path.join(scratch, "ckpt")
    info = write_landing(land)
    ingest_available(spark, land, out, checkpoint=ckpt)
    n1 = spark.read.parquet(out).count()
    assert n1 == info["crime_files"] * len(MONTHS)
    # Re-running with nothing new adds nothing.
    ingest_available(spark, land, out, checkpoint=ckpt)
    assert spark.read.parquet(out).count() == n1
    # A newly landed file is picked up once.
    src = os.path.join(land, f"{AGENCIES[0][0]}_arson.csv")
    with open(src, encoding="utf-8") as f:
        body = f.read()
    with open(os.path.join(land, "MN9990000_arson.csv"), "w", encoding="utf-8") as f:
        f.write(body.replace(AGENCIES[0][1], "New Agency"))
    ingest_available(spark, land, out, checkpoint=ckpt)
    df = spark.read.parquet(out)
    assert df.count() == n1 + len(MONTHS)
    assert df.filter(df.ori == "MN9990000").count() == len(MONTHS)


def test_cli_stream_ingest(spark, scratch):
    from paneltide import cli
    land, out = os.path.join(scratch, "landing"), os.path.join(scratch, "stream_out")
    info = write_landing(land)
    cli.main(["stream-ingest", "--landing", land, "--out", out, "--checkpoint", os.path.join(scratch, "ck")])
    assert spark.read.parquet(out).count() == info["crime_files"] * len(MONTHS)


def test_incremental_wide_table_matches_batch(spark, scratch):
    from pyspark.sql import functions as F
    from paneltide.streaming.landing import maintain_crime_wide
    land, stage, ckpt = (os.path.join(scratch, d) for d in ("landing", "stage", "ck"))
    write_landing(land)
    maintain_crime_wide(spark, land, stage, checkpoint=ckpt)
    # a later landing file (a new agency) only rewrites the years it touches
    src = os.path.join(land, f"{AGENCIES[0][0]}_arson.csv")
    with open(src, encoding="utf-8") as f:
        body = f.read()
    with open(os.path.join(land, "MN9990000_arson.csv"), "w", encoding="utf-8") as f:
        f.write(body.replace(AGENCIES[0][1], "New Agency"))
    maintain_crime_wide(spark, land, stage, checkpoint=ckpt)
    got = spark.read.parquet(os.path.join(stage, "wide"))
    expect = LD.crime_by_type(LD.crime_long(spark, land))
    cols = sorted(expect.columns)
    assert got.count() == expect.count() == (len(AGENCIES) + 1) * len(MONTHS)
    assert got.select(*cols).exceptAll(expect.select(*cols)).count() == 0
    assert got.filter(F.col("ori") == "MN9990000").count() == len(MONTHS)
