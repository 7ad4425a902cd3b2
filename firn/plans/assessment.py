"""The assessment: all regions and data groups through one plan, to regional and global consensus.

`obs` holds the rows of all datasets with their metadata: region, data_group (the group that is calculated), dataset_id,
role (annual or trend), unit, seq, start_date, end_date, change, error. `regions` is the region dimension with a column
year_start (see `with_years`), and `seasonal` the monthly series in mwe of each region (see `seasonal_series`). Loops over
regions and groups are keys here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firn.functions import dates, units
from firn.operators import calibrate, combine, filters, grid, series
from firn.operators.stored import written

GROUP = ["region", "data_group"]
DATASET = [*GROUP, "dataset_id", "role"]
#: A series without gaps, in one unit.
SLICE = [*DATASET, "slice_id", "unit", "year_start"]
_DATED = ["start_date", "end_date", "change", "error"]


@dataclass(frozen=True)
class Settings:
    """What a run asks: its years, how trends are taken from fine series, and how coarse ones come to the year grid."""

    start_year: float
    end_year: float
    trend_method: str = "regression"
    seasonal_method: str = "proportional"

    @property
    def window(self) -> tuple[float, float]:
        return float(self.start_year), float(self.end_year)


def with_years(regions: DataFrame, calendar: list[str] = ()) -> DataFrame:
    """The region dimension with year_start: 0 for the regions named, else that of the glaciological year."""
    start = F.when(F.col("name").isin(list(calendar)), 0.0) if calendar else F.when(F.lit(False), 0.0)
    return regions.withColumn("year_start", start.otherwise(F.col("glaciological_year_start")))


def _year_start(df: DataFrame, regions: DataFrame) -> DataFrame:
    return df.join(F.broadcast(regions.select(F.col("name").alias("region"), "year_start")), "region")


def prepared(obs: DataFrame, regions: DataFrame) -> DataFrame:
    """Needed columns, without the satellite gap, cut at gaps and on months, in the units they came in."""
    rows = series.sliced_at_gaps(filters.without_satellite_gap(filters.only_needed(obs)), DATASET)
    return grid.to_monthly(_year_start(rows, regions), SLICE)


def _series(rows: DataFrame) -> DataFrame:
    return rows.withColumn("series", F.concat_ws("|", *[F.col(c).cast("string") for c in SLICE]))


def corrected(rows: DataFrame, seasonal: DataFrame | None, method: str) -> DataFrame:
    """Series of years and more (SLICE, seq) on the year grid: in proportion, or by the region's seasonal series."""
    if method == "proportional":
        return grid.shifted_proportionally(rows, F.col("year_start"))
    if method != "seasonal_homogenization":
        raise NotImplementedError(method)
    if seasonal is None:
        raise ValueError("seasonal homogenization needs a seasonal series")
    own = _series(rows)
    out = calibrate.homogenised(own, seasonal, ["region"], F.col("year_start"))
    return out.join(own.select(*SLICE, "series").distinct(), ["region", "series"]).drop("series")


def _with_yearly(monthly: DataFrame) -> DataFrame:
    state = filters.extremes(monthly, SLICE).select(*SLICE, ((F.col("finest") == 1) & (F.col("coarsest") == 1)).alias("yearly"))
    return monthly.join(state, SLICE)


def _yearly(rows: DataFrame, regions: DataFrame) -> DataFrame:
    return grid.to_mwe(rows.where("yearly").drop("yearly"), regions, SLICE)


def annual_series(monthly: DataFrame, regions: DataFrame, seasonal: DataFrame | None, method: str) -> DataFrame:
    """Annual datasets on the year grid in mwe. Those of just a year a row are converted and shifted; others are summed over
    full years, or spread over them, first, since the density's error is that of a year then."""
    rows = _with_yearly(monthly)
    yearly = corrected(_yearly(rows, regions), seasonal, method)
    other = grid.to_mwe(grid.to_annual(rows.where("NOT yearly"), F.col("year_start"), SLICE, covered=True), regions, SLICE)
    own = [*GROUP, "dataset_id", "slice_id", *_DATED]
    return yearly.select(*own).unionByName(other.select(*own))


def variability(annual: DataFrame) -> DataFrame:
    """The annual series of each group, de-trended over the years that all have, and averaged. Slices of a dataset count as one."""
    return combine.consensus(annual, GROUP, remove_trend=True)


def backup_series(own: DataFrame, seasonal: DataFrame | None, regions: DataFrame, window: tuple[float, float]) -> DataFrame:
    """Of each region one annual series over all groups, extended by its seasonal series where it is short, without errors."""
    both = combine.consensus(own.withColumnRenamed("data_group", "dataset_id"), ["region"], remove_trend=True, add_trend=True)
    both = both.select("region", *_DATED)
    if seasonal is not None:
        both = combine.extended_if_shorter(both, _seasonal_years(seasonal, regions), ["region"], window)
    return both.withColumn("error", F.lit(0.0))


def _seasonal_years(seasonal: DataFrame, regions: DataFrame) -> DataFrame:
    keys = ["region", "year_start"]
    return grid.to_annual(_year_start(seasonal, regions), F.col("year_start"), keys, covered=True).select("region", *_DATED)


def trends(monthly: DataFrame, regions: DataFrame, seasonal: DataFrame | None, settings: Settings) -> DataFrame:
    """Long-term trends in mwe on the year grid, of what lies in the run's years. Conversion comes after extraction, as the
    density's error depends on the length of the trend. Each slice of a dataset is a trend series of its own."""
    rows = _in_run(monthly, settings)
    fine = grid.longterm(rows.where("finest < 1").drop("finest"), F.col("year_start"), settings.trend_method, SLICE)
    coarse = corrected(_coarse(rows, regions), seasonal, settings.seasonal_method)
    own = [*GROUP, F.concat_ws("|", "dataset_id", "slice_id").alias("trend"), *_DATED]
    out = grid.to_mwe(fine, regions, SLICE).select(*own).unionByName(coarse.select(*own))
    return out.withColumn("seq", F.row_number().over(Window.partitionBy(*GROUP, "trend").orderBy("start_date")))


def _in_run(monthly: DataFrame, settings: Settings) -> DataFrame:
    rows = monthly.join(filters.extremes(monthly, SLICE).select(*SLICE, "finest"), SLICE)
    return filters.in_window(rows, *settings.window)


def _coarse(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """Trends of years and more in mwe: yearly series from start to end, coarser ones by row."""
    yearly = combine.total_trend(rows.where("finest = 1"), SLICE).select(*SLICE, *_DATED)
    coarse = yearly.unionByName(rows.where("finest > 1").select(*SLICE, *_DATED))
    coarse = coarse.withColumn("seq", F.row_number().over(Window.partitionBy(*SLICE).orderBy("start_date")))
    return grid.to_mwe(coarse, regions, SLICE)


def recalibrated(annual: DataFrame, trend: DataFrame) -> DataFrame:
    """Each group's variability moved onto its trends and averaged over the trend series."""
    each = calibrate.onto_trends(trend, _steps(annual), GROUP)
    return combine.consensus(each.withColumnRenamed("trend", "dataset_id"), GROUP)


def _steps(annual: DataFrame) -> DataFrame:
    return annual.withColumn("step", F.row_number().over(Window.partitionBy(*GROUP).orderBy("start_date")))


def group_stages(obs: DataFrame, regions: DataFrame, settings: Settings, seasonal: DataFrame | None = None) -> dict[str, DataFrame]:
    """The stages of each region and data group, from raw rows on months to the result in mwe with the area change applied."""
    monthly = written(prepared(obs, regions), "monthly")
    annual = written(annual_series(monthly.where("role = 'annual'"), regions, seasonal, settings.seasonal_method), "annual")
    own = written(variability(annual).select(*GROUP, *_DATED), "variability")
    spare = written(backup_series(own, seasonal, regions, settings.window), "backup")

    trend = written(trends(monthly.where("role = 'trend'"), regions, seasonal, settings), "trends")
    groups = monthly.select(*GROUP).distinct()
    bare = groups.join(own.select(*GROUP).distinct(), GROUP, "left_anti").join(spare, "region")
    bare = bare.withColumns({"dataset_id": F.lit("backup"), "role": F.lit("annual"), "slice_id": F.lit(1), "unit": F.lit("mwe")})
    bare = bare.withColumn("seq", F.row_number().over(Window.partitionBy(*GROUP).orderBy("start_date")))
    bare = variability(corrected(_year_start(bare, regions), seasonal, settings.seasonal_method)).select(*GROUP, *_DATED)
    spans = trend.groupBy(*GROUP).agg(F.min("start_date").alias("low"), F.max("end_date").alias("high"))
    every = groups.join(spare, "region").select(*GROUP, *_DATED)
    extended = written(combine.extended_if_shorter(own.unionByName(bare), every, GROUP, spans), "extended")
    out = recalibrated(extended, trend).withColumn("unit", F.lit("mwe")).withColumn("area_change_applied", F.lit(False))
    raw = lambda role: monthly.where(F.col("role") == role)
    return {
        "annual_raw": raw("annual"), "trends_raw": raw("trend"), "annual_homogenized": annual, "annual_anomalies": own, "trends_homogenized": trend,
        "calibrated_series": extended, "final": written(grid.area_change(out, regions, True), "groups"),
    }


def group_results(obs: DataFrame, regions: DataFrame, settings: Settings, seasonal: DataFrame | None = None) -> DataFrame:
    """Result of each region and data group in mwe with the area change applied."""
    return group_stages(obs, regions, settings, seasonal)["final"]


def regional_results(groups: DataFrame) -> DataFrame:
    """Consensus of the groups of each region: de-trended, averaged, trend given back."""
    out = combine.consensus(groups.withColumnRenamed("data_group", "dataset_id"), ["region"], remove_trend=True, add_trend=True)
    return out.withColumn("unit", F.lit("mwe")).withColumn("area_change_applied", F.lit(True))


def in_gt(results: DataFrame, regions: DataFrame) -> DataFrame:
    """Results of regions or groups in Gt: the area change is taken back, then the area is constant."""
    return grid.to_gt(grid.area_change(results, regions, False), regions)


def _consensus_series(regional: DataFrame) -> DataFrame:
    return regional.withColumn("series", F.lit("consensus")).withColumn("seq", F.row_number().over(Window.partitionBy("region").orderBy("start_date")))


def to_calendar_years(regional: DataFrame, seasonal: DataFrame | None = None, missing: str = "raise") -> DataFrame:
    """Regional results on calendar years: by the region's seasonal series, or where there is none at all in proportion. A region
    that lacks one where others have theirs is an error; with missing="report" it is left out, and `violations` lists it."""
    if seasonal is None:
        return grid.shifted_proportionally(regional, 0.0)
    if missing not in ("raise", "report"):
        raise ValueError(f"no way {missing} with regions without a seasonal series")
    own = _consensus_series(regional)
    if missing == "raise":
        there = seasonal.select("region").distinct().withColumn("there_", F.lit(True))
        lacks = F.raise_error(F.concat(F.lit("no seasonal series for "), F.col("region"))).cast("double")
        own = own.join(there, "region", "left").withColumn("change", F.when(F.col("there_"), F.col("change")).otherwise(lacks)).drop("there_")
    out = calibrate.homogenised(own, seasonal, ["region"], 0.0)
    meta = regional.select("region", "unit", "area_change_applied").distinct()
    return out.drop("series", "seq").join(F.broadcast(meta), "region")


def global_result(regional: DataFrame, regions: DataFrame, start_year: int, end_year: int, unit: str = "mwe") -> DataFrame:
    """All regions on calendar years in one, with n_regions, the number of those that have the period: mwe by adjusted areas, Gt by
    sums. `regional` is in mwe."""
    rows = filters.in_window(regional, start_year, end_year + 1)
    dated = ["start_date", "end_date"]
    n = rows.where("change IS NOT NULL").groupBy(*dated).agg(F.count_distinct("region").alias("n_regions"))
    if unit == "gt":
        out = combine.summed(in_gt(rows, regions))
    else:
        r = regions.select(F.col("name").alias("region"), F.col("area").alias("a_"), F.col("area_change").alias("d_"), F.col("area_change_reference_year").cast("double").alias("y_"))
        out = combine.area_weighted(rows.join(F.broadcast(r), "region").withColumn("adjusted_area", units.adjusted_area("start_date", "end_date", "a_", "d_", "y_")))
    return out.join(n, dated, "left").na.fill(0, ["n_regions"])


def violations(stages: dict[str, DataFrame], regions: DataFrame, settings: Settings, seasonal: DataFrame | None = None, regional: DataFrame | None = None, wanted: list[tuple[str, str]] = ()) -> DataFrame:
    """What a run left out: stage, region, data_group, series, start_date, end_date, reason.

    Rows of years and more whose window the seasonal series does not fill, or whose region has none (annual_homogenized,
    trends_homogenized, and of `regional` results calendar); trends that their group's annual series does not cover (final); and
    groups with data or in `wanted` (region, data group) that have no result. What a row lacks is null.
    """
    cols = ["region", "data_group", "series", "start_date", "end_date", "reason"]
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    found = []
    if settings.seasonal_method != "proportional" and seasonal is not None:
        yearly = _yearly(_with_yearly(stages["annual_raw"]), regions)
        for stage, rows in (("annual_homogenized", yearly), ("trends_homogenized", _coarse(_in_run(stages["trends_raw"], settings), regions))):
            own = _series(rows)
            lost = calibrate.unfilled(own, seasonal, ["region"], F.col("year_start")).join(own.select(*GROUP, "series").distinct(), ["region", "series"])
            found.append((stage, lost.select(*cols)))
    lost = calibrate.without_cover(stages["trends_homogenized"], _steps(stages["calibrated_series"]), GROUP)
    found.append(("final", lost.withColumnRenamed("trend", "series").select(*cols)))
    groups = stages["annual_raw"].select(*GROUP).union(stages["trends_raw"].select(*GROUP)).distinct().withColumn("reason", F.lit("no result"))
    if wanted:
        asked = regions.sparkSession.createDataFrame(list(wanted), "region string, data_group string").join(groups, GROUP, "left_anti")
        groups = groups.unionByName(asked.withColumn("reason", F.lit("no data")))
    bare = groups.join(stages["final"].select(*GROUP).distinct(), GROUP, "left_anti")
    found.append(("final", bare.select(*GROUP, none("series", "string"), none("start_date", "double"), none("end_date", "double"), "reason")))
    if regional is not None and seasonal is not None:
        lost = calibrate.unfilled(_consensus_series(regional), seasonal, ["region"], 0.0)
        found.append(("calendar", lost.select("region", none("data_group", "string"), *cols[2:])))
    out = None
    for stage, rows in found:
        part = rows.select(F.lit(stage).alias("stage"), *cols)
        out = part if out is None else out.unionByName(part)
    return out


def selected(datasets: DataFrame, groups: list[tuple[str, str]], lists: list[tuple[str, str, str, str, str]]) -> DataFrame:
    """Datasets of each (region, data group) with their role and `group`, the group they are calculated in.

    lists: (region, group, role, exclude or include, user group). Included ones are the first `combined` dataset of that name
    in the region. The merged group takes trends from demdiff and annual series from glaciological datasets. Names are
    compared without case. This is filters.with_settings for all regions and groups at once.
    """
    spark = datasets.sparkSession
    parts = []
    for region, group in groups:
        for role in ("annual", "trend"):
            part = {"annual": "glaciological", "trend": "demdiff"}[role] if group == "demdiff_and_glaciological" else group
            parts.append((region.lower(), group, role, part))
    named = spark.createDataFrame(parts, "region_ string, group string, role string, part_ string")
    marks = spark.createDataFrame([(r.lower(), g, role, kind, name.lower()) for r, g, role, kind, name in lists], "region_ string, group string, role string, kind_ string, name_ string")
    keyed = datasets.withColumn("region_", F.lower("region")).withColumn("part_", F.lower("data_group")).withColumn("name_", F.lower("user_group"))
    own = keyed.join(F.broadcast(named), ["region_", "part_"])
    own = own.join(F.broadcast(marks.where("kind_ = 'exclude'").drop("kind_")), ["region_", "group", "role", "name_"], "left_anti")
    first = F.row_number().over(Window.partitionBy("region_", "name_").orderBy("dataset_ord"))
    combined = keyed.where("part_ = 'combined'").withColumn("first_", first).where("first_ = 1").drop("first_")
    extra = combined.join(F.broadcast(marks.where("kind_ = 'include'").drop("kind_")), ["region_", "name_"]).withColumn("user_group", F.concat("user_group", F.lit("_#")))
    return own.unionByName(extra).drop("region_", "part_", "name_")


def seasonal_series(obs: DataFrame, regions: DataFrame, chosen: DataFrame) -> DataFrame:
    """Of each region the first dataset of the chosen (region, user_group, data_group), on months and then in mwe."""
    first = obs.join(F.broadcast(chosen), ["region", "user_group", "data_group"], "left_semi").withColumn("n_", F.dense_rank().over(Window.partitionBy("region").orderBy("dataset_ord"))).where("n_ = 1").drop("n_")
    keys = ["region", "unit"]
    return grid.to_mwe(grid.to_monthly(filters.only_needed(first), keys), regions, keys).select("region", "seq", *_DATED)


def plot_rates(obs: DataFrame) -> DataFrame:
    """Change a year with its band."""
    n = F.col("end_date") - F.col("start_date")
    rate, e = F.try_divide(F.col("change"), n), F.try_divide(F.col("error"), n)
    return obs.withColumns({"x": F.col("start_date"), "y": rate, "lo": rate - e, "hi": rate + e})


def plot_levels(obs: DataFrame, keys: list[str]) -> DataFrame:
    """Cumulative change with its band, and breaks at gaps."""
    points = series.cumulative(obs, keys, gaps=True)
    return points.select(*keys, "step", "sub", F.col("date").alias("x"), F.col("change").alias("y"), (F.col("change") - F.col("error")).alias("lo"), (F.col("change") + F.col("error")).alias("hi"))


def aligned(points: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    """Cumulative points moved to the reference's level at their first month; where the reference does not reach over that month, to 0
    at the reference's first one. Levels between points are linear, over gaps as well; series without a reference stay."""
    m, on = dates.month_index, [k for k in keys if k in reference.columns]
    known = reference.where("change IS NOT NULL").select(*on, "date", "change")
    reach = known.groupBy(*on).agg(F.min("date").alias("low_"), F.max("date").alias("high_"))
    first = points.groupBy(*keys).agg(dates.snap_to_month(F.min("date")).alias("date")).join(reach, on)
    inside = (m("date") >= m("low_")) & (m("date") <= m("high_"))
    above = first.where(inside)
    level = series.interpolated(known, above.select(*on, "date").distinct(), on).withColumnRenamed("change", "by_")
    up = above.join(level, [*on, "date"]).select(*keys, "by_")
    begin = first.where(~inside).select(*keys, dates.snap_to_month("low_").alias("date"))
    own = points.where("change IS NOT NULL").select(*keys, "date", "change")
    down = series.interpolated(own, begin, keys).select(*keys, (-F.col("change")).alias("by_"))
    return points.join(up.unionByName(down), keys, "left").withColumn("change", F.col("change") + F.coalesce("by_", F.lit(0.0))).drop("by_")


def figures(stages: dict[str, DataFrame], levels: bool = True) -> DataFrame:
    """All figures as one long table: figure, kind (rate, or level: summed up over the row's series), region, data_group,
    dataset_id, x, y, lo, hi. Rows that lack a key have it null."""
    keys, out = [*GROUP, "dataset_id"], None
    for name, df in stages.items():
        df = df.withColumns({c: F.lit(None).cast("string") for c in keys if c not in df.columns})
        parts = [plot_rates(df).withColumn("kind", F.lit("rate"))]
        if levels:
            named = df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in keys], *_DATED)
            named = named.withColumn("seq", F.row_number().over(Window.partitionBy(*keys).orderBy("start_date")))
            parts.append(plot_levels(named, keys).withColumns({c: F.nullif(F.col(c), F.lit("")) for c in keys}).withColumn("kind", F.lit("level")))
        for part in parts:
            part = part.select(F.lit(name).alias("figure"), "kind", *keys, "x", "y", "lo", "hi")
            out = part if out is None else out.unionByName(part)
    return out
