"""Cleaning of submissions: checks per file, a decision on its gaps, and the corrected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firn.functions import dates
from firn.functions.dims import GRACE_ROW
from firn.operators import filters, series
from firn.sources import catalogue

KEY = ["file_name"]
#: Columns that a file must hold one value of if its gaps are filled.
CONSTANT = ["unit", "user_group", "region_id", "glacier_area_reference", "glacier_area_observed", "remarks"]
PLAIN = ["hydrological_correction_value", "sea_level_correction_value"]


def decisions(rows: DataFrame) -> DataFrame:
    """file_name, both checks, and what is done: gaps of two days at most are closed; gravimetry files whose other gaps (under 300 days)
    are all 0 beside gaps over 350 days stay, other gravimetry is interpolated, the rest is for a person."""
    gap = F.datediff(F.lead("start_date").over(filters.by(KEY)), "end_date")
    gaps = rows.withColumn("gap_", gap).groupBy(*KEY).agg(
        F.bool_and(F.coalesce(F.col("gap_") <= 2, F.lit(True))).alias("small_"),
        F.bool_or(F.coalesce(F.col("gap_") > 350, F.lit(False))).alias("long_"),
        F.bool_and(F.coalesce((F.col("gap_") == 0) | (F.col("gap_") >= 300), F.lit(True))).alias("clean_"),
    )
    out = filters.submission_checks(rows, KEY).join(gaps, KEY)
    gravimetry = F.lower("file_name").contains("gravimetry")
    two_missions = F.when(F.col("clean_"), "none").otherwise("inspect")
    todo = F.when(F.col("date_check_satisfied"), F.lit("none")).when(F.col("small_"), "close").when(gravimetry & F.col("long_"), two_missions).when(gravimetry, "interpolate").otherwise("inspect")
    done = F.when(todo == "close", "end dates moved to the next start").when(todo == "interpolate", "gaps interpolated").when(todo == "inspect", "inspect manually")
    reason = F.concat_ws("; ", done, F.when(~F.col("nodata_check_satisfied"), "no-data rows removed"))
    return out.select(*KEY, "date_check_satisfied", "nodata_check_satisfied", todo.alias("action"), reason.alias("reason_for_edit"))


def cleaned(rows: DataFrame, cumulative_files: list[str] = ()) -> DataFrame:
    """Corrected rows: file_name, seq, start_date, end_date, change, error, and those of CONSTANT and PLAIN that rows have.

    The files named are cumulative and are differenced first. Filled files lose the row that bridges the two satellite
    missions, and must hold one value of each column of CONSTANT.
    """
    todo = decisions(rows).select(*KEY, "action", "nodata_check_satisfied")
    tagged = rows.join(todo, KEY)
    tagged = filters.without_nodata(tagged.where("NOT nodata_check_satisfied")).unionByName(tagged.where("nodata_check_satisfied"))
    constant, plain = ([c for c in names if c in rows.columns] for names in (CONSTANT, PLAIN))
    own = [*KEY, "seq", "start_date", "end_date", "change", "error", *plain, *constant]
    still = tagged.where("action IN ('none', 'inspect')").select(*own)
    closed = series.small_gaps_closed(tagged.where("action = 'close'"), KEY).select(*own)
    torn = tagged.where("action = 'interpolate'")
    named = F.col("file_name").isin(list(cumulative_files)) if cumulative_files else F.lit(False)
    torn = series.decumulated(torn.where(named), KEY).unionByName(torn.where(~named))
    filled = series.gaps_interpolated(torn, KEY, plain=tuple(plain), without_start=GRACE_ROW)
    filled = filled.join(series.constant_columns(torn, constant, KEY), KEY).select(*own)
    out = still.unionByName(closed).unionByName(filled)
    return out.withColumn("seq", F.row_number().over(Window.partitionBy(*KEY).orderBy("seq")))


def clean(spark: SparkSession, submissions: str, out: str, cumulative_files: list[str] = ()) -> DataFrame:
    """The job: read the submissions below a path, write the corrected rows (out/files, a folder each) and the record of the
    edits (out/record), and return the record."""
    rows = catalogue.submissions(spark, submissions)
    record = decisions(rows)
    made = cleaned(rows, cumulative_files).withColumns({"start_date_fractional": dates.fractional_year("start_date"), "end_date_fractional": dates.fractional_year("end_date")})
    made.repartition("file_name").sortWithinPartitions("file_name", "seq").write.mode("overwrite").partitionBy("file_name").option("header", True).csv(f"{out}/files")
    record.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/record")
    return record
