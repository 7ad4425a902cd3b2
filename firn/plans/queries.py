"""Every operator as a query over the driver's tables; firn.plans.oracle has the SQL of the same names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firn.functions import dates, dims, units
from firn.operators import calibrate, combine, filters, grid, series
from firn.operators.stored import shared_path, written
from firn.plans import assessment, cleaning
from firn.plans.tables import events, orders, parts, shipments, table
from firn.sources import catalogue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
RG = ["region"]


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(n), 6).alias(n) if t == "double" else F.col(n).cast("bigint").alias(n) if t in ("int", "smallint") else F.col(n) for n, t in df.dtypes])


def half_open(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Trends of two and three years, and an annual series, per region."""
    annual = combine.year_sums(orders(spark, sf_dir), RG, 0.0).withColumn("step", F.row_number().over(Window.partitionBy("region").orderBy("start_date"))).drop("covered")
    spans = F.array(*[F.struct(F.lit(k).alias("seq"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, (a, b) in enumerate(((1995.0, 1997.0), (1997.0, 2000.0), (1990.0, 1996.0)), 1)])
    base = annual.groupBy("region").agg(F.avg("change").alias("c")).withColumn("x", F.explode(spans))
    trends = base.select("region", F.lit("t").alias("trend"), F.col("x.seq").alias("seq"), F.col("x.a").alias("start_date"), F.col("x.b").alias("end_date"), (F.col("c") * F.col("x.seq")).alias("change"), F.lit(0.5).alias("error"))
    return trends, annual


# --- sources, projections, filters


@query
def scan_project_orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("order_year"), F.col("o_totalprice").alias("change"))


@query
def region_dimension(spark, sf):
    return dims.regions(spark, 6).where("rgi_id <= 5").select(F.col("rgi_id").cast("bigint").alias("rgi_id"), "name", "area", "area_change", "glaciological_year_start")


@query
def catalogue_filter_ci(spark, sf):
    return filters.filtered(parts(spark, sf), region="Alaska", data_group="STANDARD").select("dataset_ord", "user_group", "data_group", "region")


@query
def catalogue_regions(spark, sf):
    return parts(spark, sf).select("region").distinct()


@query
def include_exclude_lists(spark, sf):
    d = parts(spark, sf).withColumn("data_group", F.when(F.col("data_group") == "PROMO", "combined").otherwise(F.lower("data_group")))
    out = filters.with_settings(d, "alaska", "standard", exclude_annual=["BRAND#11", None], exclude_trend=["brand#12"], include_annual=["Brand#13"])
    return out.select("dataset_ord", "user_group", "role")


@query
def merged_group_roles(spark, sf):
    d = parts(spark, sf).withColumn("data_group", F.when(F.col("data_group") == "PROMO", "demdiff").when(F.col("data_group") == "ECONOMY", "glaciological").otherwise("other"))
    return filters.with_settings(d, "alaska", "demdiff_and_glaciological").groupBy("role", "data_group").agg(F.count(F.lit(1)).alias("n"))


@query
def first_combined_dataset(spark, sf):
    d = parts(spark, sf).withColumn("data_group", F.lit("combined"))
    return filters.combined_datasets(d, "alaska", ["brand#11", "Brand#22", "nobody"]).select("dataset_ord", "user_group")


@query
def date_window(spark, sf):
    return rounded(filters.in_window(orders(spark, sf), 1996.0, 1998.5).select("dataset_id", "seq", "change"))


@query
def date_window_gap(spark, sf):
    return rounded(filters.in_window(orders(spark, sf), 1996.0, 1998.5, gap=True).select("dataset_id", "seq", "change"))


@query
def satellite_gap(spark, sf):
    rows = orders(spark, sf).withColumn("data_group", F.when(F.col("region") == "alaska", "gravimetry").otherwise("altimetry")).withColumn("role", F.lit("annual"))
    return rounded(filters.without_satellite_gap(rows, (1997.4, 1998.6)).select("dataset_id", "seq", "data_group"))


@query
def contiguous_check(spark, sf):
    return filters.contiguous(orders(spark, sf))


@query
def monthly_grid_check(spark, sf):
    rows = orders(spark, sf).unionByName(orders(spark, sf).where("user_group = '1-URGENT'").withColumns({"dataset_id": F.concat(F.lit("x"), F.col("dataset_id")), "start_date": F.col("start_date") + 0.01}))
    return filters.on_monthly_grid(rows)


@query
def annual_grid_check(spark, sf):
    return filters.on_annual_grid(combine.year_sums(orders(spark, sf), RG, 0.75).unionByName(combine.year_sums(orders(spark, sf).where("region = 'alaska'"), RG, 0.25).withColumn("region", F.lit("other"))), 0.75, RG)


@query
def same_unit(spark, sf):
    return filters.same_unit(parts(spark, sf), ["data_group"])


@query
def duplicate_dates(spark, sf):
    return filters.has_duplicates(orders(spark, sf), "start_date", RG)


@query
def series_extremes(spark, sf):
    return rounded(filters.extremes(orders(spark, sf)))


def _submissions(spark, sf):
    """Five files of each event type: days with gaps of a day (a), a gap of a week in gravimetry (b), a gap of over a year
    beside those of a day (c) or alone (d), and a gap of a week in altimetry (e)."""
    rows = events(spark, sf)
    nxt = F.coalesce(F.lead("start_date").over(Window.partitionBy("dataset_id").orderBy("seq")), F.col("end_date"))
    rows = rows.withColumn("next_", nxt).withColumn("kind", F.explode(F.array(*map(F.lit, "abcde"))))
    rows = rows.where("NOT (kind IN ('b', 'e') AND dayofyear(start_date) BETWEEN 10 AND 16)")
    rows = rows.withColumn("end_date", F.when((F.col("kind") == "d") & (F.dayofyear("start_date") != 13), F.col("next_")).otherwise(F.col("end_date")))
    late = F.col("kind").isin("c", "d") & (F.dayofyear("start_date") > 14)
    rows = rows.withColumns({c: F.when(late, F.date_add(c, 400)).otherwise(F.col(c)) for c in ("start_date", "end_date")})
    group = F.when((F.col("kind") == "e") | (F.col("kind") == "a") & (F.col("dataset_id") >= "p"), "altimetry").otherwise("gravimetry")
    unit = F.when(F.col("dataset_id") < "m", "m").otherwise("Gt")
    named = rows.withColumn("file_name", F.concat("dataset_id", F.lit("_"), "kind", F.lit("_"), group, F.lit(".csv"))).withColumn("unit", unit)
    return named.withColumn("user_group", F.col("dataset_id")).drop("dataset_id", "next_", "kind")


@query
def submission_checks(spark, sf):
    return filters.submission_checks(_submissions(spark, sf), ["file_name"])


@query
def nodata_removal(spark, sf):
    return rounded(filters.without_nodata(_submissions(spark, sf)).select("file_name", "seq", "change"))


@query
def submission_decisions(spark, sf):
    return cleaning.decisions(_submissions(spark, sf)).select("file_name", "action", "reason_for_edit")


@query
def submission_cleaned(spark, sf):
    return rounded(cleaning.cleaned(_submissions(spark, sf)).select("file_name", "seq", F.col("start_date").cast("string").alias("start_date"), F.col("end_date").cast("string").alias("end_date"), "change", "error", "unit"))


# --- joins and aggregates


@query
def outer_align_mean(spark, sf):
    rows = orders(spark, sf)
    return rounded(rows.groupBy("region", "start_date", "end_date").agg(F.avg("change").alias("change"), F.count("change").alias("n_series")))


@query
def extend_coalesce(spark, sf):
    rows = orders(spark, sf)
    a = rows.where("user_group = '1-URGENT' AND start_date < 1998.0")
    return rounded(combine.outer_extended(a, rows.where("user_group = '2-HIGH' AND start_date >= 1996.0"), RG))


@query
def extend_if_shorter(spark, sf):
    rows = orders(spark, sf)
    a = rows.where("user_group = '1-URGENT' AND (start_date < 1998.0 OR region = 'alaska')")
    return rounded(combine.extended_if_shorter(a, rows.where("user_group = '2-HIGH' AND start_date >= 1996.0"), RG, (1995.0, 2001.0)))


@query
def common_period(spark, sf):
    rows = orders(spark, sf).where("NOT (user_group = '5-LOW' AND seq % 5 = 0)")
    starts, ends = combine.common_period(rows, RG)
    return rounded(starts.select("region", F.lit("start").alias("side"), F.col("start_date").alias("date")).unionByName(ends.select("region", F.lit("end").alias("side"), F.col("end_date").alias("date"))))


@query
def years_containment(spark, sf):
    return rounded(combine.year_sums(orders(spark, sf), ["dataset_id"], 0.75))


@query
def nearest_year(spark, sf):
    rows = events(spark, sf)
    x = dates.fractional_year("start_date")
    return rounded(rows.select("dataset_id", "seq", dates.nearest_year(x, 0.25).alias("g"), dates.nearest_year(F.lit(2010.25), 0.75).alias("tie")))


@query
def matched_indices(spark, sf):
    rows = orders(spark, sf)
    return rounded(combine.matched(rows.where("region = 'alaska'").select("start_date").distinct(), rows.where("start_date >= 1996.5 AND region <> 'alaska'").select("start_date").distinct(), "start_date"))


@query
def matched_near(spark, sf):
    rows = orders(spark, sf)
    return rounded(combine.matched(rows.where("region = 'alaska'").select("start_date").distinct(), rows.where("start_date >= 1996.5 AND region <> 'alaska'").select((F.col("start_date") + 0.001).alias("start_date")).distinct(), "start_date", 0.01))


@query
def distance_matrix(spark, sf):
    trends, annual = half_open(spark, sf)
    both = trends.select("region", F.col("seq").alias("trend_seq"), F.col("start_date").alias("ts"), F.col("end_date").alias("te")).join(annual.select("region", "step", "start_date"), "region")
    return rounded(both.select("region", "trend_seq", "step", dates.distance_to_period("start_date", "ts", "te", 1.0).alias("distance")))


@query
def time_span(spark, sf):
    return rounded(combine.time_span(orders(spark, sf), RG))


@query
def longterm_start_vs_end(spark, sf):
    return rounded(combine.total_trend(orders(spark, sf)))


@query
def longterm_regression(spark, sf):
    return rounded(combine.total_trend(orders(spark, sf), method="regression"))


@query
def regression_slope(spark, sf):
    return rounded(series.slope(series.cumulative(orders(spark, sf), ["dataset_id"])))


@query
def consensus_average(spark, sf):
    return rounded(combine.consensus(orders(spark, sf), RG))


@query
def consensus_detrended(spark, sf):
    return rounded(combine.consensus(orders(spark, sf), RG, remove_trend=True))


@query
def consensus_addback(spark, sf):
    return rounded(combine.consensus(orders(spark, sf), RG, remove_trend=True, add_trend=True))


def _weighted(spark, sf):
    r = dims.regions(spark).select(F.col("name").alias("region"), "area", F.col("area_change").alias("ac"), F.col("area_change_reference_year").cast("double").alias("ry"))
    return combine.consensus(orders(spark, sf), RG).join(F.broadcast(r), "region").withColumn("adjusted_area", units.adjusted_area("start_date", "end_date", "area", "ac", "ry"))


@query
def global_mwe(spark, sf):
    return rounded(combine.area_weighted(_weighted(spark, sf)).withColumn("area", F.round("area", 3)))


@query
def global_gt(spark, sf):
    return rounded(combine.summed(combine.consensus(orders(spark, sf), RG)))


@query
def adjusted_areas(spark, sf):
    return rounded(_weighted(spark, sf).select("region", "start_date", F.round("adjusted_area", 3).alias("adjusted_area")))


# --- windows, grids, gaps


@query
def cumulative_changes(spark, sf):
    return rounded(series.cumulative(orders(spark, sf)).select("dataset_id", "step", "sub", "date", "change"))


@query
def cumulative_errors(spark, sf):
    return rounded(series.cumulative(orders(spark, sf)).select("dataset_id", "step", "sub", "error"))


@query
def cumulative_with_gaps(spark, sf):
    rows = orders(spark, sf).where("NOT seq % 9 = 4")
    return rounded(series.cumulative(rows, gaps=True))


@query
def derivative_from_cumulative(spark, sf):
    return rounded(series.derivative(series.cumulative(orders(spark, sf)).select("dataset_id", "date", "change")))


@query
def moving_average_window(spark, sf):
    rows = orders(spark, sf).select("dataset_id", F.col("start_date").alias("date"), "change")
    return rounded(series.moving_average(rows, 13 / 12, clip=True))


@query
def moving_average_samples(spark, sf):
    return rounded(series.running_mean(orders(spark, sf), 5).select("dataset_id", "seq", "average"))


@query
def monthly_grid_points(spark, sf):
    spans = shipments(spark, sf).groupBy("dataset_id").agg((F.min("start_date") + 0.01).alias("low"), (F.max("end_date") - 0.01).alias("high"))
    return rounded(series.month_points(spans, ["dataset_id"]))


@query
def monthly_resample(spark, sf):
    return rounded(series.monthly_resampled(shipments(spark, sf)).select("dataset_id", "start_date", "end_date", "change", "error"))


@query
def nearest_resample(spark, sf):
    rows = shipments(spark, sf)
    knots = rows.select("dataset_id", F.col("start_date").alias("date"), "change")
    return rounded(series.interpolated(knots, rows.select("dataset_id", (F.col("start_date") + 0.1).alias("date")), mode="nearest"))


@query
def gap_slices(spark, sf):
    return rounded(series.sliced_at_gaps(events(spark, sf)).select("dataset_id", "seq", "slice_id"))


@query
def recombine_slices(spark, sf):
    return rounded(series.recombined(series.sliced_at_gaps(events(spark, sf))).select("dataset_id", "seq", "change"))


@query
def close_small_gaps(spark, sf):
    out = series.small_gaps_closed(events(spark, sf))
    return rounded(out.select("dataset_id", "seq", F.col("end_date").cast("string").alias("end_date")))


@query
def interpolate_rate_gaps(spark, sf):
    out = series.gaps_interpolated(events(spark, sf), least_days=0)
    return rounded(out.select("dataset_id", "seq", F.col("start_date").cast("string").alias("start_date"), F.col("end_date").cast("string").alias("end_date"), "change", "error", "is_filled"))


@query
def decumulate(spark, sf):
    return rounded(series.decumulated(shipments(spark, sf)).select("dataset_id", "seq", "change"))


@query
def fill_backward(spark, sf):
    rows = events(spark, sf).withColumn("change", F.when(F.col("seq") % 3 == 0, F.col("change")))
    return rounded(series.filled_back(rows, "change").select("dataset_id", "seq", "change"))


@query
def fill_by_index(spark, sf):
    rows = events(spark, sf).withColumn("change", F.when(F.col("seq") % 4 == 2, F.col("change")))
    return rounded(series.filled_by_index(rows, "change", ["dataset_id"]).select("dataset_id", "seq", "change"))


@query
def fractional_year(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(dates.fractional_year("ts"), 9).alias("x"))


@query
def fractional_year_inverse(spark, sf):
    back = dates.from_fractional_year(dates.fractional_year("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(F.timestamp_add("SECOND", F.lit(1), back), "yyyy-MM-dd").alias("day"))


@query
def full_years(spark, sf):
    spans = combine.time_span(orders(spark, sf), ["dataset_id"])
    return rounded(spans.select("dataset_id", F.explode(dates.full_years("min_start", "max_end", 0.75)).alias("year")))


@query
def parsed_dates(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "no date").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("text"))
    return rows.select("o_orderkey", dates.parsed_date("text").cast("string").alias("day"))


@query
def three_digits(spark, sf):
    return table(spark, sf, "part").select("p_partkey", dates.three_digits("p_retailprice").alias("x"))


# --- units


def _unit(f: Callable[[], Column]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: table(spark, sf, "part").select("p_partkey", F.round(f(), 8).alias("value"))


QUERIES |= {
    "units_metres_to_gt": _unit(lambda: units.metres_to_gt("p_size", F.col("p_retailprice"))), "units_gt_to_metres": _unit(lambda: units.gt_to_metres("p_size", F.col("p_retailprice"))),
    "units_metres_to_mwe": _unit(lambda: units.metres_to_mwe("p_size")), "units_mwe_to_metres": _unit(lambda: units.mwe_to_metres("p_size")),
    "units_mwe_to_gt": _unit(lambda: units.mwe_to_gt("p_size", F.col("p_retailprice"))), "units_gt_to_mwe": _unit(lambda: units.gt_to_mwe("p_size", F.col("p_retailprice"))),
    "units_gt_to_sea_level": _unit(lambda: units.gt_to_sea_level(-F.col("p_retailprice"))), "density_uncertainty": _unit(lambda: units.density_uncertainty(F.col("p_size") / 4)),
}


def _with_unit(spark, sf):
    unit = F.when(F.col("user_group") == "1-URGENT", "mwe").when(F.col("user_group") == "2-HIGH", "M").otherwise("Gt")
    return orders(spark, sf).withColumn("unit", unit).withColumn("area_change_applied", F.lit(False))


@query
def unit_to_mwe(spark, sf):
    out = grid.to_mwe(_with_unit(spark, sf), dims.regions(spark)).select("dataset_id", "seq", "change", "error", "unit")
    return out.withColumns({"change": F.round("change", 9), "error": F.round("error", 9), "seq": F.col("seq").cast("bigint")})


@query
def unit_to_gt(spark, sf):
    return rounded(grid.to_gt(_with_unit(spark, sf).where("unit <> 'M'"), dims.regions(spark)).select("dataset_id", "seq", "change", "error", "unit"))


@query
def area_change_apply(spark, sf):
    return rounded(grid.area_change(_with_unit(spark, sf).where("unit <> 'Gt'"), dims.regions(spark)).select("dataset_id", "seq", "change", "area_change_applied"))


@query
def area_change_remove(spark, sf):
    rows = _with_unit(spark, sf).where("unit <> 'Gt'").withColumn("area_change_applied", F.lit(True))
    return rounded(grid.area_change(rows, dims.regions(spark), False).select("dataset_id", "seq", "change", "area_change_applied"))


# --- grids and calibration


@query
def shift_month(spark, sf):
    rows = orders(spark, sf).withColumn("start_date", F.col("start_date") + 0.03).withColumn("end_date", F.col("end_date") + 0.05)
    return rounded(grid.shifted_to_months(rows).select("dataset_id", "seq", "start_date", "end_date"))


@query
def shift_proportional(spark, sf):
    rows = shipments(spark, sf).withColumn("end_date", F.col("start_date") + 2.1)
    return rounded(grid.shifted_proportionally(rows, 0.75).select("dataset_id", "seq", "start_date", "end_date", "change", "error"))


@query
def to_monthly_grid(spark, sf):
    return rounded(grid.to_monthly(shipments(spark, sf).withColumn("start_date", F.col("start_date") + 0.01).withColumn("end_date", F.col("end_date") + 0.01)).select("dataset_id", "start_date", "end_date", "change"))


@query
def to_annual_grid(spark, sf):
    return rounded(grid.to_annual(orders(spark, sf), 0.75).select("dataset_id", "seq", "start_date", "change", "error"))


@query
def spread_trend_to_years(spark, sf):
    rows = shipments(spark, sf).withColumn("end_date", F.col("start_date") + F.col("seq") % 4 + 1)
    return rounded(grid.spread_over_years(rows))


@query
def longterm_trends(spark, sf):
    return rounded(grid.longterm(orders(spark, sf), 0.75, "start_vs_end"))


@query
def calibrate_trends(spark, sf):
    trends, annual = half_open(spark, sf)
    return rounded(calibrate.calibrated(trends, annual, RG).select("region", "trend_seq", "step", "value", "distance"))


@query
def calibrate_combine_p2(spark, sf):
    trends, annual = half_open(spark, sf)
    return rounded(calibrate.combined(calibrate.calibrated(trends, annual, RG), RG, 2.0).select("region", "step", "change"))


@query
def calibrate_combine_p0(spark, sf):
    trends, annual = half_open(spark, sf)
    return rounded(calibrate.combined(calibrate.calibrated(trends, annual, RG), RG, 0.0).select("region", "step", "change"))


@query
def calibrate_combine_outside(spark, sf):
    trends, annual = half_open(spark, sf)
    return rounded(calibrate.combined_outside(trends, annual, RG).select("region", "step", "change"))


@query
def calibrate_onto_trends(spark, sf):
    trends, annual = half_open(spark, sf)
    return rounded(calibrate.onto_trends(trends, annual, RG).select("region", "step", "change", "error"))


@query
def seasonal_homogenise(spark, sf):
    monthly = orders(spark, sf).where("user_group = '1-URGENT'")
    years = combine.year_sums(orders(spark, sf).where("user_group = '2-HIGH'"), ["region", "user_group"], 0.5).drop("covered")
    own = years.select("region", F.col("user_group").alias("series"), "start_date", "end_date", "change", "error").withColumn("seq", F.row_number().over(Window.partitionBy("region", "series").orderBy("start_date")))
    return rounded(calibrate.homogenised(own, monthly, RG, 0.75))


@query
def imbie_style_average(spark, sf):
    points = series.cumulative(shipments(spark, sf)).withColumn("g", F.lit("all"))
    return rounded(combine.monthly_combination(points, ["g"]))


@query
def imbie_style_errors(spark, sf):
    points = series.cumulative(shipments(spark, sf)).withColumn("g", F.lit("all"))
    return rounded(combine.monthly_combination(points, ["g"], tolerance=1.5, errors=True))


@query
def metadata_json(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query
def csv_by_header(spark, sf):
    """Observations written as CSV files of three headers, which differ in order and in optional columns, and read back at once."""
    ours = {v: k for k, v in catalogue.OBSERVATION_COLUMNS.items()}
    start, end, change, error, *areas = list(ours)[:6]
    rows = orders(spark, sf).withColumns({areas[0]: F.col("seq") * 2.0, areas[1]: F.col("seq") * 3.0, "remarks": F.col("dataset_id")})
    rows = written(rows.withColumns({theirs: F.col(own) for theirs, own in ours.items() if own in rows.columns}), "observations")
    headers = {"1": [start, end, change, error, *areas, "remarks"], "2": ["remarks", error, areas[0], end, change, start], "3": [change, areas[1], "remarks", start, error, end]}
    path = shared_path(spark, "csv")
    for n, names in headers.items():
        rows.where(F.translate(F.substring("user_group", 1, 1), "45", "12") == n).select(*names).write.option("header", True).csv(f"{path}/{n}")
    read = catalogue.observations(spark, [f"{path}/{n}" for n in headers])
    return rounded(read.select(F.col("remarks").alias("dataset_id"), "start_date", "end_date", "change", "error", *areas))


@query
def slug_names(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", catalogue.object_name(F.col("p_brand"), F.lit("demdiff"), F.col("p_name")).alias("object"), catalogue.information_name(F.lower("p_type"), F.col("p_name")).alias("information"))


@query
def rate_bands(spark, sf):
    return rounded(assessment.plot_rates(shipments(spark, sf)).select("dataset_id", "seq", "x", "y", "lo", "hi"))


@query
def level_bands(spark, sf):
    return rounded(assessment.plot_levels(shipments(spark, sf), ["dataset_id"]).select("dataset_id", "step", "sub", "x", "y", "lo", "hi"))


@query
def vertical_adjustment(spark, sf):
    rows = orders(spark, sf)
    points = series.cumulative(rows.where("user_group <> '1-URGENT' AND start_date >= 1997.0"), ["region", "dataset_id"])
    reference = series.cumulative(rows.where("user_group = '1-URGENT'"), ["region"])
    return rounded(assessment.aligned(points, reference, ["region", "dataset_id"]).select("dataset_id", "date", "change"))


@query
def vertical_adjustment_between(spark, sf):
    """Series that begin between two levels of a yearly reference."""
    rows = orders(spark, sf)
    points = series.cumulative(rows.where("user_group <> '1-URGENT' AND start_date >= 1997.2"), ["region", "dataset_id"])
    years = combine.year_sums(rows.where("user_group = '1-URGENT'"), RG, 0.0).withColumn("seq", F.row_number().over(Window.partitionBy("region").orderBy("start_date")))
    return rounded(assessment.aligned(points, series.cumulative(years, RG), ["region", "dataset_id"]).select("dataset_id", "date", "change"))


# --- the whole assessment


SETTINGS = assessment.Settings(1996, 2001)


def _assessed(spark, sf):
    """Three data groups. Monthly orders of two (one priority in metres, one with gaps, one region's altimetry cut short), a
    series of calendar years beside them, and two-row trends in metres in a group without annual series."""
    regions = assessment.with_years(dims.regions(spark))
    cols = ["region", "data_group", "dataset_id", "role", "unit", "seq", "start_date", "end_date", "change", "error"]
    monthly = orders(spark, sf).withColumn("data_group", F.when(F.col("user_group") < "3", "altimetry").otherwise("gravimetry"))
    monthly = monthly.withColumn("unit", F.when(F.col("user_group") < "4", "mwe").when(F.col("user_group") < "5", "m").otherwise("mwe"))
    whole = combine.year_sums(orders(spark, sf), RG, 0.0).withColumns({"change": F.col("change") / 5, "error": F.col("error") / 5, "data_group": F.lit("altimetry"), "unit": F.lit("mwe")})
    whole = whole.withColumn("dataset_id", F.concat("region", F.lit("|years"))).withColumn("seq", F.row_number().over(Window.partitionBy("region").orderBy("start_date")))
    short = (F.col("region") == "alaska") & (F.col("data_group") == "altimetry") & (F.col("start_date") >= 1998)
    annual = monthly.where("NOT (user_group = '5-LOW' AND seq % 40 = 39)").withColumn("role", F.lit("annual")).select(*cols)
    annual = annual.unionByName(whole.withColumn("role", F.lit("annual")).select(*cols)).where(~short)
    trend = monthly.withColumn("role", F.lit("trend")).select(*cols).unionByName(whole.withColumn("role", F.lit("trend")).select(*cols))
    spans = F.array(*[F.struct(F.lit(k).alias("seq"), F.lit(a).alias("a"), F.lit(b).alias("b")) for k, (a, b) in enumerate(((1996.5, 1999.0), (1999.0, 2000.5)), 1)])
    coarse = orders(spark, sf).groupBy("region").agg(F.avg("change").alias("c")).withColumn("x", F.explode(spans))
    coarse = coarse.select(
        "region", F.lit("demdiff").alias("data_group"), F.concat("region", F.lit("|dem")).alias("dataset_id"), F.lit("trend").alias("role"), F.lit("m").alias("unit"), F.col("x.seq").alias("seq"),
        F.col("x.a").alias("start_date"), F.col("x.b").alias("end_date"), (F.col("c") * (F.col("x.b") - F.col("x.a")) * 10).alias("change"), F.lit(0.4).alias("error"),
    )
    return annual.unionByName(trend).unionByName(coarse), regions


def _assessed_groups(spark, sf):
    obs, regions = _assessed(spark, sf)
    return assessment.group_results(written(obs, "observations"), regions, SETTINGS), regions


def _seasonal(spark, sf):
    return orders(spark, sf).where("user_group = '1-URGENT'").select("region", "seq", "start_date", "end_date", "change", "error")


@query
def assessment_groups(spark, sf):
    groups, _ = _assessed_groups(spark, sf)
    return rounded(groups.select("region", "data_group", "start_date", "end_date", "change", "error"))


@query
def assessment_regions(spark, sf):
    groups, _ = _assessed_groups(spark, sf)
    return rounded(assessment.regional_results(groups).select("region", "start_date", "end_date", "change", "error"))


@query
def assessment_regions_gt(spark, sf):
    groups, regions = _assessed_groups(spark, sf)
    return rounded(assessment.in_gt(assessment.regional_results(groups), regions).select("region", "start_date", "end_date", "change", "error"))


def _calendar(spark, sf):
    groups, regions = _assessed_groups(spark, sf)
    regional = written(assessment.regional_results(groups), "regional")
    return assessment.to_calendar_years(regional, written(_seasonal(spark, sf), "seasonal")), regions


def _seasonal_but_alaska(spark, sf):
    return written(_seasonal(spark, sf).where("region <> 'alaska'"), "seasonal")


@query
def assessment_global(spark, sf):
    years, regions = _calendar(spark, sf)
    return rounded(assessment.global_result(years, regions, 1996, 2000).select("start_date", "end_date", "change", "error", "n_regions"))


@query
def assessment_global_gt(spark, sf):
    years, regions = _calendar(spark, sf)
    return rounded(assessment.global_result(years, regions, 1996, 2000, "gt").select("start_date", "end_date", "change", "error", "n_regions"))


@query
def assessment_global_partial(spark, sf):
    """The world without a region that has no seasonal series: the result says of how many regions it is."""
    groups, regions = _assessed_groups(spark, sf)
    regional = written(assessment.regional_results(groups), "regional")
    years = assessment.to_calendar_years(regional, _seasonal_but_alaska(spark, sf), missing="report")
    return rounded(assessment.global_result(years, regions, 1996, 2000).select("start_date", "end_date", "change", "error", "n_regions"))


@query
def assessment_violations(spark, sf):
    """What a run leaves out: a region without a seasonal series, windows that it does not fill, trends without cover, a group without data."""
    obs, regions = _assessed(spark, sf)
    stages = assessment.group_stages(written(obs, "observations"), regions, SETTINGS)
    regional = written(assessment.regional_results(stages["final"]), "regional")
    lost = assessment.violations(stages, regions, SETTINGS, _seasonal_but_alaska(spark, sf), regional, [("alaska", "combined"), ("alaska", "demdiff")])
    return rounded(lost.select("stage", "region", "data_group", "start_date", "end_date", "reason"))


@query
def trends_without_cover(spark, sf):
    trends, annual = half_open(spark, sf)
    more = trends.where("seq = 2").withColumns({"seq": F.lit(4), "start_date": F.lit(1998.25), "end_date": F.lit(1998.75)})
    return rounded(calibrate.without_cover(trends.unionByName(more), annual, RG).select("region", "seq", "start_date", "end_date", "reason"))


@query
def seasonal_correction(spark, sf):
    """Yearly datasets by the seasonal method inside the plan."""
    obs, regions = _assessed(spark, sf)
    yearly = written(assessment.prepared(obs.where("dataset_id LIKE '%|years' AND role = 'trend'"), regions), "yearly")
    seasonal = written(_seasonal(spark, sf), "seasonal")
    return rounded(assessment.annual_series(yearly, regions, seasonal, "seasonal_homogenization").select("region", "start_date", "end_date", "change", "error"))


@query
def spline_resample(spark, sf):
    rows = shipments(spark, sf)
    knots = rows.select("dataset_id", F.col("start_date").alias("date"), "change")
    return rounded(series.interpolated(knots, rows.select("dataset_id", (F.col("start_date") + 0.125).alias("date")), mode="spline"))
