"""Landing-file ingest: one CSV per (agency ORI, type), wide by period.

File contract (S14): ``{ORI}_{type}.csv``; crime files are wide by month
(``MM-yyyy`` headers, first row = agency, second row = its "Clearances",
sometimes junk one-field rows after), officer files are wide by year.

Everything is one multi-file scan per family (S1/S2/S6/S7), a row per file
whose cells are keyed by that file's own header: Spark packs the many small
files into partitions (``maxPartitionBytes``/``openCostInBytes``)
and never loops over files on the driver.  Keys come from the file name via
``_metadata.file_name`` (S9); the file-family split is a glob filter and a
name predicate (S2).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import parse_month_label, zero_to_null
from ..operators.reshape import pivot_wide

# The incident types that appear in landing file names.
CRIME_TYPES = ["arson", "assaults", "burglary", "gta", "homicides", "larceny", "rape", "robbery"]

FILE_KEY = r"^([^_]+)_(.+)\.csv$"   # ORI _ type .csv
OFFICERS_GLOB = "*_officers.csv"


def ori_from_label(label) -> "F.Column":
    """Agency code from a picker label such as 'Aitkin ORI: MN0010000'
    (the text the landing files were named from)."""
    c = F.col(label) if isinstance(label, str) else label
    return F.trim(F.split_part(c, F.lit("ORI:"), F.lit(2)))


def landing_name(ori, crime_type) -> "F.Column":
    """The landing file name contract ``{ORI}_{type}.csv``."""
    o = F.col(ori) if isinstance(ori, str) else ori
    t = F.col(crime_type) if isinstance(crime_type, str) else crime_type
    return F.concat(o, F.lit("_"), t, F.lit(".csv"))


#: Cells of one landing line at most; a file with a longer line is an error.
MAX_CELLS = 1024
#: Header labels of the month columns.
MONTH_LABEL = "^[0-9]{2}-[0-9]{4}$"


def csv_cells(line) -> "F.Column":
    """The ``MAX_CELLS`` first cells of one CSV line by the engine's own parser,
    trimmed; blank and missing ones are NULL."""
    names = [f"c{i}" for i in range(MAX_CELLS + 1)]
    parsed = F.from_csv(line, F.lit(", ".join(f"{n} STRING" for n in names)), {
        "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "nullValue": "",
        "maxColumns": str(4 * MAX_CELLS), "maxCharsPerColumn": "-1"})
    wide = F.raise_error(F.lit(f"a landing line has more than {MAX_CELLS} cells")).cast("string")
    # the parsed line is a lambda's variable, which is computed once
    cells = F.transform(F.array(parsed), lambda p: F.array(
        F.when(p[names[-1]].isNotNull(), wide).otherwise(p[names[0]]), *[p[n] for n in names[1:-1]]))[0]
    return F.transform(cells, lambda c: F.trim(c))


def landing_files(reader, landing_dir: str, glob: str = "*.csv") -> DataFrame:
    """(file, header, rows) of each landing file, one row a file: a file holds
    one agency and one type, a few lines whatever the number of agencies.

    ``reader`` is ``spark.read`` or ``spark.readStream``.  Every file keeps its
    own header, so files with different periods read together correctly.
    """
    raw = (reader.option("pathGlobFilter", glob).text(landing_dir, wholetext=True)
           .select(F.col("_metadata.file_name").alias("file"),
                   F.regexp_replace("value", "^\ufeff", "").alias("value")))
    lines = F.filter(F.split("value", "\r?\n"), lambda x: F.length(F.trim(x)) > 0)
    return (raw.withColumn("lines", lines)
               .select("file", csv_cells(F.get("lines", F.lit(0))).alias("header"),
                       F.transform(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))), csv_cells).alias("rows")))


def _key(col: str, i: int):
    return F.regexp_extract(F.col(col), FILE_KEY, i)


def crime_files(reader, landing_dir: str) -> DataFrame:
    """Every landing file but the officers' ones."""
    return landing_files(reader, landing_dir).filter(~F.col("file").rlike(r"_officers\.csv$"))


def _is_agency(cells):
    s = F.get(cells, F.lit(0))
    return F.coalesce((F.length(s) > 0) & ~s.endswith(" Clearances") & ~s.startswith("_"), F.lit(False))


def agency_rows(files: DataFrame, validate: bool = True) -> DataFrame:
    """S8/O4 (quirk Q8): adds ``cells``, the agency row of each file.

    The "<agency> Clearances" row and junk trailer rows (``_type ...``) are not
    agency rows.  A file without exactly one agency row fails the job that reads
    it, named in the error; ``validate=False`` takes the first and drops a file
    that has none.
    """
    own = files.withColumn("own", F.filter("rows", _is_agency))
    if not validate:
        return own.filter(F.size("own") > 0).withColumn("cells", F.get("own", F.lit(0))).drop("own")
    wrong = F.raise_error(F.concat(F.lit("landing file "), F.col("file"), F.lit(" has "),
                                   F.size("own").cast("string"), F.lit(" agency rows, not one")))
    cells = F.when(F.size("own") == 1, F.get("own", F.lit(0))).otherwise(wrong.cast("array<string>"))
    return own.withColumn("cells", cells).drop("own")


def labelled_cells(files: DataFrame, *keep) -> DataFrame:
    """One row per cell beyond the first that has a header name or a text: its own
    file's header name and text."""
    pairs = F.slice(F.zip_with("header", "cells", lambda a, b: F.struct(a.alias("label"), b.alias("text"))), 2, MAX_CELLS)
    some = F.filter(pairs, lambda p: p["label"].isNotNull() | p["text"].isNotNull())
    return files.select(*keep, F.explode(some).alias("p")).select(*keep, F.col("p.label").alias("label"), F.col("p.text").alias("text"))


def _month(label: str = "label"):
    return F.when(F.col(label).rlike(MONTH_LABEL), parse_month_label(label))


def crime_long_of(files: DataFrame, validate: bool = True) -> DataFrame:
    """Crime files -> (series, ori, crime_type, month DATE, year, count INT).
    Columns are taken by their month label; others are in ``crime_rejects``."""
    first = agency_rows(files, validate).withColumns({
        "series": F.get("cells", F.lit(0)), "ori": _key("file", 1), "crime_type": _key("file", 2)})
    long = labelled_cells(first, "series", "ori", "crime_type")
    # Counts are read through double, so "3.0" is 3; blank cells stay NULL.
    count = F.expr("try_cast(try_cast(text AS DOUBLE) AS INT)")
    return (long.withColumn("month", _month()).filter("month is not null")
            .select("series", "ori", "crime_type", "month", F.year("month").alias("year"), count.alias("count")))


def crime_rejects(spark: SparkSession, landing_dir: str) -> DataFrame:
    """What the crime ingest leaves out: (file, reason, label, text).

    ``column``: a cell under a header that is no month; ``count``: a text that is
    no number under a month; ``agency rows``: a file without exactly one agency
    row, with their number as text (the ingest stops at it, unless told not to).
    """
    files = crime_files(spark.read, landing_dir)
    cells = labelled_cells(agency_rows(files, validate=False), "file").filter("text is not null").withColumn("month", _month())
    wrong = F.when(F.col("month").isNull(), "column").when(F.expr("try_cast(try_cast(text AS DOUBLE) AS INT)").isNull(), "count")
    agencies = F.size(F.filter("rows", _is_agency))
    return (cells.select("file", wrong.alias("reason"), "label", "text").filter("reason is not null")
            .unionByName(files.filter(agencies != 1).select("file", F.lit("agency rows").alias("reason"), F.lit(None).cast("string").alias("label"),
                                                            agencies.cast("string").alias("text"))))


def crime_long(spark: SparkSession, landing_dir: str, validate: bool = True) -> DataFrame:
    """All crime files in long form.  Blank cells stay NULL here (quirk Q1);
    zero-fill happens at the merge."""
    return crime_long_of(crime_files(spark.read, landing_dir), validate)


def crime_by_type(long: DataFrame, types: Sequence[str] = CRIME_TYPES, validate: bool = False) -> DataFrame:
    """One row per (series, month, ori, year), one column per type; with
    ``validate``, a repeated cell fails the pivot itself (R8)."""
    return pivot_wide(long, ["series", "month", "ori", "year"], "crime_type", list(types),
                      value_col="count", agg=F.first, name=str, unique=validate)


def officers_long(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Officer files -> (ori, year, officers); 0 means missing.
    Columns are the year names of each file's own header."""
    files = landing_files(spark.read, landing_dir, OFFICERS_GLOB).withColumn("ori", _key("file", 1))
    rows = files.select("ori", "header", F.explode("rows").alias("cells"))
    long = labelled_cells(rows, "ori").filter(F.col("label").rlike("^[0-9]{4}$"))
    officers = F.expr("try_cast(text AS DOUBLE)")
    return long.select("ori", F.col("label").cast("int").alias("year"), zero_to_null(officers).alias("officers"))


def crime_data(spark: SparkSession, landing_dir: str, validate: bool = True) -> DataFrame:
    """Entry 1 result: monthly wide crime counts with the agency's officers.

    ``validate`` (default on) turns a landing file without exactly one agency
    row (S8, checked while reading) and repeated pivot keys (R8, checked by the
    pivot) into errors instead of silently mixed rows.
    """
    wide = crime_by_type(crime_long(spark, landing_dir, validate=validate), validate=validate)
    return wide.join(officers_long(spark, landing_dir), ["ori", "year"], "left")
