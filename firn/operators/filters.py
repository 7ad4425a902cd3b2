"""Filters, predicates and small aggregates over interval series.

A series is the rows of one `keys` value, ordered by `seq`: start_date, end_date, change, error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firn.functions import dates
from firn.functions.dims import GRACE_GAP, NODATA_LIMIT

KEYS = ["dataset_id"]


def by(keys: list[str] = KEYS) -> Window:
    return Window.partitionBy(*keys).orderBy("seq")


def filtered(datasets: DataFrame, **equal: str | None) -> DataFrame:
    """Rows whose columns equal the given values without case; None asks nothing."""
    conditions = [F.lower(c) == v.lower() for c, v in equal.items() if v is not None]
    return datasets.where(reduce(Column.__and__, conditions)) if conditions else datasets


def with_settings(datasets: DataFrame, region: str, group: str, exclude_annual=(), exclude_trend=(), include_annual=(), include_trend=()) -> DataFrame:
    """Datasets of a data group in a region under its settings, with `role` annual or trend.

    The merged group takes trends from demdiff and annual series from glaciological datasets, demdiff first.
    """
    parts = ["demdiff", "glaciological"] if group == "demdiff_and_glaciological" else [group]
    own = reduce(DataFrame.unionByName, [filtered(datasets, region=region, data_group=g).withColumn("part_", F.lit(k)) for k, g in enumerate(parts)])

    def role(name: str, excluded, included) -> DataFrame:
        left = [x.lower() for x in excluded or () if x is not None]
        rows = own.where(~F.lower("user_group").isin(left)) if left else own
        if len(parts) == 2:
            rows = rows.where(F.col("data_group") == ("glaciological" if name == "annual" else "demdiff"))
        extra = combined_datasets(datasets, region, included).withColumn("user_group", F.concat("user_group", F.lit("_#"))).withColumn("part_", F.lit(9))
        return rows.unionByName(extra).withColumn("role", F.lit(name))

    return role("annual", exclude_annual, include_annual).unionByName(role("trend", exclude_trend, include_trend)).drop("part_")


def combined_datasets(datasets: DataFrame, region: str, names) -> DataFrame:
    """Of each name the first `combined` dataset of the region; names without one are skipped."""
    wanted = [x.lower() for x in names or () if x is not None]
    own = filtered(datasets, region=region, data_group="combined").where(F.lower("user_group").isin(wanted) if wanted else F.lit(False))
    first = F.row_number().over(Window.partitionBy(F.lower("user_group")).orderBy("dataset_ord"))
    return own.withColumn("first_", first).where("first_ = 1").drop("first_")


def in_window(obs: DataFrame, start: float | None, end: float | None, gap: bool = False) -> DataFrame:
    """Rows inside [start, end]; with gap, all others."""
    inside = F.lit(True)
    if start is not None:
        inside &= F.col("start_date") >= start
    if end is not None:
        inside &= F.col("end_date") <= end
    return obs.where(~inside if gap else inside)


def without_satellite_gap(obs: DataFrame, gap: tuple[float, float] = GRACE_GAP) -> DataFrame:
    """Annual gravimetry loses its rows inside the gap between the two missions."""
    inside = (F.col("start_date") >= gap[0]) & (F.col("end_date") <= gap[1])
    return obs.where(~((F.col("data_group") == "gravimetry") & (F.col("role") == "annual") & inside))


def contiguous(obs: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """keys, is_contiguous: every row starts where the one before ends."""
    before = obs.withColumn("before_", F.lag("end_date").over(by(keys)))
    return before.groupBy(*keys).agg(F.bool_and(F.coalesce(F.col("before_") == F.col("start_date"), F.lit(True))).alias("is_contiguous"))


def on_monthly_grid(obs: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    near = lambda c: F.abs(dates.snap_to_month(c) - F.col(c)) < 1.5e-7
    return obs.groupBy(*keys).agg(F.bool_and(near("start_date") & near("end_date")).alias("is_monthly"))


def on_annual_grid(obs: DataFrame, year_start: Column | float, keys: list[str] = KEYS) -> DataFrame:
    year_start = dates._col(year_start)
    on = lambda c: F.col(c) % 1 == year_start
    return obs.groupBy(*keys).agg(F.bool_and(on("start_date") & on("end_date")).alias("is_annual"))


def same_unit(datasets: DataFrame, keys: list[str]) -> DataFrame:
    return datasets.groupBy(*keys).agg((F.count_distinct("unit") <= 1).alias("same_unit"))


def has_duplicates(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg((F.count(F.lit(1)) != F.count_distinct(column)).alias("has_duplicates"))


def finite(c: str) -> Column:
    return F.when(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c))


def extremes(obs: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """First and last dates, finite extremes of change, and the finest and coarsest resolution to three digits."""
    length = dates.three_digits(F.col("end_date") - F.col("start_date"))
    return obs.groupBy(*keys).agg(
        F.min("start_date").alias("min_start"), F.max("start_date").alias("max_start"), F.min("end_date").alias("min_end"), F.max("end_date").alias("max_end"),
        F.min(finite("change")).alias("min_change"), F.max(finite("change")).alias("max_change"), F.min(length).alias("finest"), F.max(length).alias("coarsest"), F.count(F.lit(1)).alias("n"),
    )


def nodata_limit(unit: str = "unit") -> Column:
    pairs = [F.lit(x) for k, v in NODATA_LIMIT.items() for x in (k, v)]
    return F.try_element_at(F.create_map(*pairs), F.lower(unit))


def without_nodata(obs: DataFrame) -> DataFrame:
    """Rows beyond the unit's limit go; a value at the limit stays, as do rows of other units."""
    return obs.where(F.coalesce(F.abs("change") <= nodata_limit(), F.lit(True)))


def submission_checks(submissions: DataFrame, keys: list[str]) -> DataFrame:
    """Per file: whether each row ends on the day the next one starts, and whether all changes are within the unit's limit."""
    nxt = submissions.withColumn("next_", F.lead("start_date").over(by(keys)))
    return nxt.groupBy(*keys).agg(
        F.bool_and(F.coalesce(F.col("next_") == F.col("end_date"), F.lit(True))).alias("date_check_satisfied"),
        F.bool_and(F.coalesce(F.abs("change") < nodata_limit(), nodata_limit().isNull())).alias("nodata_check_satisfied"),
    )


def only_needed(obs: DataFrame) -> DataFrame:
    """Without the four optional columns."""
    return obs.drop("glacier_area_reference", "glacier_area_observed", "hydrological_correction_value", "remarks")
