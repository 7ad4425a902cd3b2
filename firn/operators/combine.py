"""Alignment, consensus averages and totals over several series.

Series are aligned by grouping long rows on their dates, so an outer join of N series costs one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firn.functions import dates
from firn.operators.filters import KEYS
from firn.operators.series import cumulative, interpolated, month_points, slope
from firn.operators.stored import written


def common_period(obs: DataFrame, group: list[str], series: str = "dataset_id") -> tuple[DataFrame, DataFrame]:
    """Starts, and ends, that all series of a group have."""
    n = obs.groupBy(*group).agg(F.count_distinct(series).alias("all_"))

    def shared(c: str) -> DataFrame:
        each = obs.groupBy(*group, c).agg(F.count_distinct(series).alias("n_"))
        return each.join(n, group).where("n_ = all_").select(*group, c)

    return shared("start_date"), shared("end_date")


def time_span(obs: DataFrame, keys: list[str]) -> DataFrame:
    return obs.groupBy(*keys).agg(F.min("start_date").alias("min_start"), F.max("end_date").alias("max_end"))


def detrended(obs: DataFrame, group: list[str], series: str = "dataset_id") -> DataFrame:
    """change less its mean over the common period, which is kept as period_mean."""
    starts, ends = common_period(obs, group, series)
    rows = obs.join(starts.withColumn("s_", F.lit(True)), [*group, "start_date"], "left").join(ends.withColumn("e_", F.lit(True)), [*group, "end_date"], "left")
    mean = F.avg(F.when(F.col("s_") & F.col("e_"), F.col("change"))).over(Window.partitionBy(*group, series))
    return rows.withColumn("period_mean", mean).withColumn("change", F.col("change") - F.col("period_mean")).drop("s_", "e_")


def consensus(obs: DataFrame, group: list[str], remove_trend: bool = False, add_trend: bool = False, series: str = "dataset_id") -> DataFrame:
    """Mean of all series of a group by (start, end), with its error.

    The error joins the series' own, in quadrature over their number, with 1.96 standard deviations of all residuals of the
    group that are not 0 over the root of the number of changes. With remove_trend series lose their mean of the common
    period first, and add_trend gives back the mean of those means.
    """
    rows = detrended(obs, group, series) if remove_trend else obs.withColumn("period_mean", F.lit(0.0))
    dated = [*group, "start_date", "end_date"]
    rows = rows.withColumn("residual", F.col("change") - F.avg("change").over(Window.partitionBy(*dated)))
    spread = rows.groupBy(*group).agg(F.coalesce(F.stddev_pop(F.when(F.abs("residual") > 1e-12, F.col("residual"))), F.lit(0.0)).alias("s_"))
    out = rows.groupBy(*dated).agg(F.avg("change").alias("change"), F.count("change").alias("n_series"), F.try_divide(F.sqrt(F.sum(F.col("error") * F.col("error"))), F.count("error")).alias("own_error"))
    out = out.join(spread, group).withColumn("error", F.sqrt(F.col("own_error") ** 2 + F.try_divide(1.96 * F.col("s_"), F.sqrt("n_series")) ** 2))
    if remove_trend and add_trend:
        each = rows.groupBy(*group, series).agg(F.first("period_mean").alias("m_"))
        mean = each.groupBy(*group).agg(F.when(F.count("m_") == F.count(F.lit(1)), F.avg("m_")).alias("m_"))
        out = out.join(mean, group).withColumn("change", F.col("change") + F.col("m_"))
    return out.select(*dated, "change", "error", "n_series")


def area_weighted(obs: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Mean of regions by adjusted_area; a region without a row in a period does not count."""
    a = F.col("adjusted_area")
    return obs.groupBy(*keys, "start_date", "end_date").agg(
        F.try_divide(F.sum(F.col("change") * a), F.sum(F.when(F.col("change").isNotNull(), a))).alias("change"),
        F.try_divide(F.sqrt(F.sum((F.col("error") * a) * (F.col("error") * a))), F.sum(F.when(F.col("change").isNotNull(), a))).alias("error"), F.sum(a).alias("area"),
    )


def summed(obs: DataFrame, keys: list[str] = ()) -> DataFrame:
    return obs.groupBy(*keys, "start_date", "end_date").agg(F.sum("change").alias("change"), F.sqrt(F.sum(F.col("error") * F.col("error"))).alias("error"))


def outer_extended(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """a's rows, and b's where a has none or nulls."""
    on = [*keys, "start_date", "end_date"]
    both = a.select(*on, F.col("change").alias("c_"), F.col("error").alias("e_")).join(b.select(*on, F.col("change").alias("d_"), F.col("error").alias("f_")), on, "full_outer")
    return both.select(*on, F.coalesce("c_", "d_").alias("change"), F.coalesce("e_", "f_").alias("error"))


def extended_if_shorter(a: DataFrame, b: DataFrame, keys: list[str], window: tuple[float, float] | DataFrame) -> DataFrame:
    """Series a, extended by b where a has gaps or does not reach over the window: a pair of dates, or a table of keys, low and high.

    Both then lose their means over the rows that lie in the period which both span; without such rows nothing is known of
    their levels and changes are null. Series that b lacks, or without a window, stay as they are.
    """
    w = Window.partitionBy(*keys).orderBy("start_date")
    own = a.withColumn("p_", F.lag("end_date").over(w)).groupBy(*keys).agg(F.min("start_date").alias("a_low"), F.max("end_date").alias("a_high"), F.bool_or(F.coalesce(F.col("p_") != F.col("start_date"), F.lit(False))).alias("torn"))
    own = own.withColumns({"low": F.lit(window[0]), "high": F.lit(window[1])}) if isinstance(window, tuple) else own.join(window.select(*keys, "low", "high"), keys)
    spare = b.groupBy(*keys).agg(F.min("start_date").alias("b_low"), F.max("end_date").alias("b_high"))
    short = own.where("a_low > low OR a_high < high OR torn").join(spare, keys)
    short = short.select(*keys, F.greatest("a_low", "b_low").alias("from_"), F.least("a_high", "b_high").alias("to_"))
    dated = [*keys, "start_date", "end_date"]

    def centred(x: DataFrame) -> DataFrame:
        inside = (F.col("start_date") >= F.col("from_")) & (F.col("end_date") <= F.col("to_"))
        mean = F.avg(F.when(inside, F.col("change"))).over(Window.partitionBy(*keys))
        return x.join(short, keys).withColumn("change", F.col("change") - mean).select(*dated, "change", "error")

    return a.join(short, keys, "left_anti").select(*dated, "change", "error").unionByName(outer_extended(centred(a), centred(b), keys))


def total_trend(obs: DataFrame, keys: list[str] = KEYS, method: str = "start_vs_end") -> DataFrame:
    """One row a series: its span, total change and error (root of summed squares over the number of rows, nulls counted)."""
    own = obs.groupBy(*keys).agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"), F.coalesce(F.sum("change"), F.lit(0.0)).alias("change"), (F.sqrt(F.coalesce(F.sum(F.col("error") * F.col("error")), F.lit(0.0))) / F.count(F.lit(1))).alias("error"))
    if method == "start_vs_end":
        return own
    if method != "regression":
        raise NotImplementedError(method)
    return own.drop("change").join(slope(cumulative(obs, keys), keys).select(*keys, F.col("trend").alias("change")), keys)


def year_sums(obs: DataFrame, keys: list[str], year_start: Column | float) -> DataFrame:
    """Sums over the full years of each series. Years are disjoint, so a row's year is computed and no range is joined; a year without rows has change 0 and no error."""
    start = dates._col(year_start)
    spans = obs.withColumn("ys_", start).groupBy(*keys).agg(F.min("start_date").alias("low"), F.max("end_date").alias("high"), F.first("ys_").alias("ys_"))
    years = spans.select(*keys, F.explode(dates.full_years("low", "high", F.col("ys_"))).alias("year"))
    own = obs.withColumn("year", F.floor(F.col("start_date") - start) + start).where("end_date <= year + 1")
    sums = own.groupBy(*keys, "year").agg(F.coalesce(F.sum("change"), F.lit(0.0)).alias("c_"), (F.sqrt(F.sum(F.col("error") * F.col("error"))) / F.count(F.lit(1))).alias("error"), F.lit(True).alias("covered"))
    out = years.join(sums, [*keys, "year"], "left")
    return out.select(*keys, F.col("year").alias("start_date"), (F.col("year") + 1).alias("end_date"), F.coalesce("c_", F.lit(0.0)).alias("change"), "error", F.coalesce("covered", F.lit(False)).alias("covered"))


def monthly_combination(points: DataFrame, group: list[str], series: str = "dataset_id", tolerance: float | None = None, errors: bool = False, average_months: int = 1) -> DataFrame:
    """Mean of several cumulative solutions on the monthly grid. tolerance: solutions farther from the mean of all values than
    so many of their standard deviations (one at least) do not count. average_months: means over so many months in a row."""
    keys = [*group, series]
    spans = points.groupBy(*keys).agg(F.min("date").alias("low"), F.max("date").alias("high"))
    each = interpolated(points, month_points(spans, keys), keys, ("change",)).withColumn("month", dates.month_index("date"))
    if tolerance is not None:
        whole = points.groupBy(*group).agg(F.avg("change").alias("m_"), F.stddev_pop("change").alias("s_"))
        each = each.join(whole, group).where(F.abs(F.col("change") - F.col("m_")) < max(tolerance, 1.0) * F.col("s_")).drop("m_", "s_")
    y = F.col("change")
    value = F.sqrt(F.sum(y * y) / F.count(y)) / F.sqrt(F.count(y)) if errors else F.avg(y)
    out = each.groupBy(*group, "month").agg(value.alias("change"), F.count(y).alias("n_series"))
    if average_months > 1:
        half = average_months // 2
        near = Window.partitionBy(*group).orderBy("month").rangeBetween(-half, average_months - 1 - half)
        out = out.withColumn("change", F.avg("change").over(near))
    return out


def _in_order(df: DataFrame, column: str) -> DataFrame:
    """df in ranges of a column, written, so that p_ (a range's place) stays."""
    return written(df.repartitionByRange(column).withColumn("p_", F.spark_partition_id()), "ranges")


def _numbered(df: DataFrame, column: str, name: str) -> DataFrame:
    """The sorted values of a column with their indices; duplicates are an error. Only the sizes of the ranges meet in one task."""
    one = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_"))
    one = one.select(F.when(F.col("n_") == 1, F.col(column)).otherwise(F.raise_error(F.lit("duplicate values")).cast("double")).alias(column))
    ranged = _in_order(one, column)
    sizes = ranged.groupBy("p_").agg(F.count(F.lit(1)).alias("n_"))
    sizes = sizes.select("p_", (F.sum("n_").over(Window.orderBy("p_").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_")).alias("before_"))
    place = F.col("before_") + F.row_number().over(Window.partitionBy("p_").orderBy(column)) - 1
    return ranged.join(F.broadcast(sizes), "p_").select(column, place.cast("int").alias(name))


def matched(a: DataFrame, b: DataFrame, column: str, tolerance: float = 0.0) -> DataFrame:
    """index_a, index_b of equal values, or of neighbours in sorted order nearer than tolerance. Indices are those of the sorted
    values; duplicates are an error."""
    x, y = _numbered(a, column, "index_a"), _numbered(b, column, "index_b")
    if tolerance == 0:
        return x.join(y, column).select("index_a", "index_b")
    none = F.lit(None).cast("int")
    both = _in_order(x.withColumn("index_b", none).unionByName(y.withColumn("index_a", none)), column)
    # The first row of each range is also the neighbour of the last one before it.
    row = F.struct(F.col(column).alias("v"), F.col("index_a").alias("a"), F.col("index_b").alias("b"))
    heads = both.groupBy("p_").agg(F.min(row).alias("head")).select("p_", F.lead("head").over(Window.orderBy("p_")).alias("head_"))
    near = both.withColumn("next_", F.lead(row).over(Window.partitionBy("p_").orderBy(column))).join(F.broadcast(heads), "p_")
    near = near.withColumn("next_", F.coalesce("next_", "head_")).where(F.abs(F.col("next_.v") - F.col(column)) < tolerance)
    both_ends = near.select(F.coalesce("index_a", "next_.a").alias("index_a"), F.coalesce("index_b", "next_.b").alias("index_b"))
    return both_ends.where("index_a IS NOT NULL AND index_b IS NOT NULL")
