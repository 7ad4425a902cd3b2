"""Units and grids of whole series: monthly and annual, spread, shifted, converted. Branches are columns, not loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firn.functions import dates, units
from firn.operators.combine import total_trend, year_sums
from firn.operators.filters import KEYS, extremes, on_annual_grid, on_monthly_grid
from firn.operators.series import monthly_resampled

_CORE = ["start_date", "end_date", "change", "error"]


def to_mwe(obs: DataFrame, regions: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """m or Gt (case aside) to mwe, with the errors of density or without that of area. Other units are an error."""
    rows = obs.join(extremes(obs, keys).select(*keys, "finest"), keys).join(F.broadcast(regions.select(F.col("name").alias("region"), F.col("area").alias("a_"), F.col("area_uncertainty_percentage").alias("u_"))), "region", "left")
    unit = F.lower("unit")
    c = F.when(F.col("unit") == "mwe", F.col("change")).when(unit == "m", units.metres_to_mwe("change")).when(unit == "gt", units.gt_to_mwe("change", "a_"))
    e = F.when(F.col("unit") == "mwe", F.col("error")).when(unit == "m", units.mwe_error_of_metres(units.metres_to_mwe("change"), units.metres_to_mwe("error"), "finest"))
    e = e.when(unit == "gt", units.gt_to_mwe(units.without_area_error("change", "error", "a_", "u_"), "a_"))
    known = (F.col("unit") == "mwe") | unit.isin("m", "gt")
    return rows.withColumns({"change": F.when(known, c).otherwise(F.raise_error(F.concat(F.lit("no conversion to mwe from "), F.col("unit"))).cast("double")), "error": e, "unit": F.lit("mwe")}).drop("finest", "a_", "u_")


def to_gt(obs: DataFrame, regions: DataFrame) -> DataFrame:
    """mwe to Gt with the error of area. Other units, and series with the area change applied, are an error."""
    rows = obs.join(F.broadcast(regions.select(F.col("name").alias("region"), F.col("area").alias("a_"), F.col("area_uncertainty_percentage").alias("u_"))), "region", "left")
    gt, e = units.mwe_to_gt("change", "a_"), units.mwe_to_gt("error", "a_")
    is_gt = F.lower("unit") == "gt"
    bad = F.col("area_change_applied") | ~(is_gt | (F.lower("unit") == "mwe"))
    c = F.when(bad, F.raise_error(F.lit("only mwe without area change converts to Gt")).cast("double")).when(is_gt, F.col("change")).otherwise(gt)
    return rows.withColumns({"change": c, "error": F.when(is_gt, F.col("error")).otherwise(units.with_area_error(gt, e, "a_", "u_")), "unit": F.lit("gt")}).drop("a_", "u_")


def area_change(obs: DataFrame, regions: DataFrame, apply: bool = True) -> DataFrame:
    """Apply or remove the effect of the area's change over time on m or mwe; errors stay. Twice the same is an error."""
    r = regions.select(F.col("name").alias("region"), F.col("area").alias("a_"), F.col("area_change").alias("d_"), F.col("area_change_reference_year").cast("double").alias("y_"))
    rows = obs.join(F.broadcast(r), "region", "left")
    ratio = F.try_divide(F.col("a_"), units.adjusted_area("start_date", "end_date", "a_", "d_", "y_"))
    bad = ~F.lower("unit").isin("m", "mwe") | (F.col("area_change_applied") == apply)
    c = F.when(bad, F.raise_error(F.lit("area change needs m or mwe, and alternates")).cast("double")).otherwise(F.col("change") * ratio if apply else F.try_divide(F.col("change"), ratio))
    return rows.withColumns({"change": c, "area_change_applied": F.lit(apply)}).drop("a_", "d_", "y_")


def shifted_to_months(obs: DataFrame) -> DataFrame:
    return obs.withColumn("start_date", dates.snap_to_month("start_date")).withColumn("end_date", dates.snap_to_month("end_date"))


def to_monthly(obs: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Series on the grid stay, those of half a year and coarser are shifted, finer ones are resampled."""
    state = extremes(obs, keys).join(on_monthly_grid(obs, keys), keys).select(*keys, F.when(F.col("is_monthly"), "as_is").when(F.col("finest") >= 0.5, "shift").otherwise("resample").alias("branch_"))
    rows = obs.join(state, keys)
    own = [*keys, "seq", *_CORE]
    out = rows.where("branch_ = 'as_is'").select(*own).unionByName(shifted_to_months(rows.where("branch_ = 'shift'")).select(*own))
    return out.unionByName(monthly_resampled(rows.where("branch_ = 'resample'"), keys).select(*own))


def spread_over_years(obs: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows of several whole years as equal annual rows."""
    n = F.rint(F.col("end_date") - F.col("start_date")).cast("int")
    rows = obs.withColumn("n_", n).withColumn("k_", F.explode(F.sequence(F.lit(0), n - 1)))
    return rows.select(*keys, "seq", (F.col("start_date") + F.col("k_")).alias("start_date"), (F.col("start_date") + F.col("k_") + 1).alias("end_date"), (F.col("change") / F.col("n_")).alias("change"), (F.col("error") / F.col("n_")).alias("error"))


def to_annual(obs: DataFrame, year_start: Column | float, keys: list[str] = KEYS, covered: bool = False) -> DataFrame:
    """Monthly-grid series to years: up to a year by sums, coarser ones spread, which must lie on the annual grid. covered: without years that no row lies in."""
    start = dates._col(year_start)
    state = extremes(obs, keys).join(on_annual_grid(obs.withColumn("ys_", start), F.col("ys_"), keys), keys).select(*keys, (F.col("finest") > 1).alias("coarse_"), "is_annual")
    rows = obs.join(state, keys)
    guard = F.when(F.col("is_annual"), F.col("change")).otherwise(F.raise_error(F.lit("a series coarser than a year is not on the annual grid")).cast("double"))
    fine = year_sums(rows.where(~F.col("coarse_")), keys, year_start)
    fine = (fine.where("covered") if covered else fine).drop("covered")
    coarse = spread_over_years(rows.where("coarse_").withColumn("change", guard), keys).drop("seq")
    return fine.unionByName(coarse).withColumn("seq", F.row_number().over(Window.partitionBy(*keys).orderBy("start_date")))


def shifted_proportionally(obs: DataFrame, year_start: Column | float) -> DataFrame:
    """Both ends to the nearest year boundary, changes and errors in proportion to the lengths."""
    s, e = dates.nearest_year("start_date", year_start), dates.nearest_year("end_date", year_start)
    f = F.try_divide(e - s, F.col("end_date") - F.col("start_date"))
    return obs.withColumns({"change": F.col("change") * f, "error": F.col("error") * f, "start_date": s, "end_date": e})


def longterm(obs: DataFrame, year_start: Column | float, method: str = "regression", keys: list[str] = KEYS) -> DataFrame:
    """Series finer than a year to one trend over their full years, annual ones from start to end; coarser ones stay as rows."""
    start = dates._col(year_start)
    state = extremes(obs, keys).select(*keys, "finest", "min_start", "max_end")
    rows = obs.withColumn("ys_", start).join(state, keys)
    years = dates.full_years("min_start", "max_end", F.col("ys_"))
    clipped = rows.where("finest < 1").withColumn("y_", years).where(F.size("y_") > 0).where((F.col("start_date") >= F.element_at("y_", 1)) & (F.col("end_date") <= F.element_at("y_", -1) + 1))
    own = [*keys, *_CORE]
    out = total_trend(clipped, keys, method).select(*own).unionByName(total_trend(rows.where("finest = 1"), keys).select(*own))
    return out.unionByName(rows.where("finest > 1").select(*own))
