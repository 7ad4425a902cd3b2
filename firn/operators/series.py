"""Cumulative and derivative views, interpolation, monthly grids, moving averages, slopes and gaps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firn.functions import dates
from firn.operators.filters import KEYS, by
from firn.operators.scan import BLOCK, counted_changes, filled, scanned


def cumulative(obs: DataFrame, keys: list[str] = KEYS, gaps: bool = False) -> DataFrame:
    """keys, step, sub, date, change, error: running sums from a leading 0; errors add in quadrature. With gaps, two rows for each gap: nothing, then the level before it."""
    change, square = F.coalesce("change", F.lit(0.0)), F.coalesce(F.col("error") * F.col("error"), F.lit(0.0))
    rows = scanned(obs.select(*keys, "seq", "start_date", "end_date", "change", "error"), keys, sums={"sum_": change, "squares_": square}, before={"before": F.col("end_date")})
    rows = rows.select(
        *keys, F.col("seq").alias("step"), F.lit(2).alias("sub"), F.col("end_date").alias("date"), F.col("sum_").alias("change"), F.sqrt("squares_").alias("error"), "start_date", "before",
        (F.col("sum_") - change).alias("c_"), F.sqrt(F.greatest(F.col("squares_") - square, F.lit(0.0))).alias("e_"),
    )
    # Rows of one kind or another come from one pass over the rows.
    none = F.lit(None).cast("double")
    row = lambda sub, date, change, error: F.struct(F.lit(sub).alias("sub"), F.col(date).alias("date"), change.alias("change"), error.alias("error"))
    out = [row(2, "date", F.col("change"), F.col("error")), F.when(F.col("before").isNull(), row(-1, "start_date", F.lit(0.0), F.lit(0.0)))]
    if gaps:
        gap = F.col("before") != F.col("start_date")
        out += [F.when(gap, row(0, "start_date", none, none)), F.when(gap, row(1, "start_date", F.col("c_"), F.col("e_")))]
    return rows.select(*keys, "step", F.explode(F.array_compact(F.array(*out))).alias("x_")).select(*keys, "step", "x_.*")


def derivative(points: DataFrame, keys: list[str] = KEYS, value: str = "change") -> DataFrame:
    """keys, start_date, end_date, value: differences of neighbouring points by date."""
    w = Window.partitionBy(*keys).orderBy("date")
    rows = points.select(*keys, F.lag("date").over(w).alias("start_date"), F.col("date").alias("end_date"), (F.col(value) - F.lag(value).over(w)).alias(value))
    return rows.where("start_date IS NOT NULL")


def month_points(spans: DataFrame, keys: list[str], low: str = "low", high: str = "high") -> DataFrame:
    """keys, date: month starts from that at or before low to that at or behind high."""
    t0, t1 = F.floor(F.col(low) * 12) / 12, F.ceil(F.col(high) * 12) / 12
    n = F.ceil((t1 - t0 + 1e-5) * 12).cast("int")
    return spans.select(*keys, t0.alias("t0"), F.explode(F.sequence(F.lit(0), n - 1)).alias("k")).select(*keys, (F.col("k") / 12 + F.col("t0")).alias("date"))


def interpolated(knots: DataFrame, at: DataFrame, keys: list[str] = KEYS, values: tuple[str, ...] = ("change",), mode: str = "linear") -> DataFrame:
    """Values of knots (keys, date, values) at the points `at` (keys, date): linear (held at the ends), nearest (half-way to the left) or spline.

    One sort by keys and date; the neighbouring knots come from last and first non-null values.
    """
    if mode == "spline":
        return _spline(knots, at, keys, values)
    if mode not in ("linear", "nearest"):
        raise ValueError(f"no mode {mode}")
    both = knots.select(*keys, "date", F.lit(True).alias("knot"), *values).unionByName(at.select(*keys, "date", F.lit(False).alias("knot")), allowMissingColumns=True)
    both = both.withColumn("point_", F.when(F.col("knot"), F.struct("date", *values)))
    w = Window.partitionBy(*keys).orderBy("date", F.desc("knot"))
    back = F.last("point_", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("point_", True).over(w.rowsBetween(0, Window.unboundedFollowing))
    rows = both.withColumn("a_", back).withColumn("b_", ahead).where(~F.col("knot"))

    def value(v: str) -> Column:
        a, b = F.col(f"a_.{v}"), F.col(f"b_.{v}")
        t, ta, tb = F.col("date"), F.col("a_.date"), F.col("b_.date")
        inner = a + (t - ta) * F.try_divide(b - a, tb - ta) if mode == "linear" else F.when(t - ta <= tb - t, a).otherwise(b)
        return F.when(F.col("a_").isNull(), b).when(F.col("b_").isNull() | (ta == t), a).otherwise(inner).alias(v)

    return rows.select(*keys, "date", *map(value, values))


def cubic_spline(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Interpolating cubic spline, not-a-knot at the ends; fewer than four points: the polynomial through them. Knots of one
    date count as their mean. The system of second derivatives is solved along its three diagonals."""
    x, where = np.unique(x, return_inverse=True)
    y = np.bincount(where, y) / np.bincount(where)
    if len(x) < 4:
        return np.polyval(np.polyfit(x - x[0], y, len(x) - 1), at - x[0])
    h, s = np.diff(x), np.diff(y) / np.diff(x)
    n = len(x) - 2
    low, mid, high, r = h[:-1].copy(), 2 * (h[:-1] + h[1:]), h[1:].copy(), 6 * np.diff(s)
    # The ends' derivatives continue their neighbours' line, and leave the system.
    mid[0] += h[0] * (h[0] + h[1]) / h[1]
    high[0] -= h[0] ** 2 / h[1]
    mid[-1] += h[-1] * (h[-1] + h[-2]) / h[-2]
    low[-1] -= h[-1] ** 2 / h[-2]
    for i in range(1, n):
        f = low[i] / mid[i - 1]
        mid[i] -= f * high[i - 1]
        r[i] -= f * r[i - 1]
    inner = np.empty(n)
    inner[-1] = r[-1] / mid[-1]
    for i in range(n - 2, -1, -1):
        inner[i] = (r[i] - high[i] * inner[i + 1]) / mid[i]
    first = ((h[0] + h[1]) * inner[0] - h[0] * inner[1]) / h[1]
    last = ((h[-1] + h[-2]) * inner[-1] - h[-1] * inner[-2]) / h[-2]
    m = np.concatenate([[first], inner, [last]])
    i = np.clip(np.searchsorted(x, at, "right") - 1, 0, n)
    t = at - x[i]
    return y[i] + t * (s[i] - h[i] * (2 * m[i] + m[i + 1]) / 6) + t**2 * m[i] / 2 + t**3 * (m[i + 1] - m[i]) / (6 * h[i])


def _spline(knots: DataFrame, at: DataFrame, keys: list[str], values: tuple[str, ...]) -> DataFrame:
    both = knots.select(*keys, "date", F.lit(True).alias("knot"), *values).unionByName(at.select(*keys, "date", F.lit(False).alias("knot")), allowMissingColumns=True)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        k, p = pdf[pdf["knot"]].sort_values("date"), pdf[~pdf["knot"]].copy()
        for v in values:
            own = k[k[v].notna()]
            p[v] = cubic_spline(own["date"].to_numpy(), own[v].to_numpy(), p["date"].to_numpy()) if len(own) else np.nan
        return p[[*keys, "date", *values]]

    kinds = dict(both.dtypes)
    return both.groupBy(*keys).applyInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in [*keys, "date", *values]))


def monthly_resampled(obs: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Interval changes and errors on the monthly grid: both are summed up, interpolated at month starts and differenced."""
    run = by(keys).rowsBetween(Window.unboundedPreceding, 0)
    sums = obs.select(*keys, F.col("end_date").alias("date"), F.coalesce(F.sum("change").over(run), F.lit(0.0)).alias("change"), F.coalesce(F.sum("error").over(run), F.lit(0.0)).alias("error"))
    spans = obs.groupBy(*keys).agg(F.min("start_date").alias("low"), F.max("end_date").alias("high"))
    knots = sums.unionByName(spans.select(*keys, F.col("low").alias("date"), F.lit(0.0).alias("change"), F.lit(0.0).alias("error")))
    points = interpolated(knots, month_points(spans, keys), keys, ("change", "error"))
    w = Window.partitionBy(*keys).orderBy("date")
    rows = points.select(*keys, F.lag("date").over(w).alias("start_date"), F.col("date").alias("end_date"), (F.col("change") - F.lag("change").over(w)).alias("change"), (F.col("error") - F.lag("error").over(w)).alias("error"))
    return rows.where("start_date IS NOT NULL").withColumn("seq", F.row_number().over(Window.partitionBy(*keys).orderBy("start_date")))


def moving_average(points: DataFrame, width: float, keys: list[str] = KEYS, clip: bool = False) -> DataFrame:
    """Mean of change over the points nearer than width / 2 (open bounds); dates lie on months. Clip empties the ends."""
    half = int(np.ceil(width * 12 / 2)) - 1
    w = Window.partitionBy(*keys).orderBy(dates.month_index("date")).rangeBetween(-half, half)
    out = points.withColumn("average", F.avg("change").over(w))
    if clip:
        whole = Window.partitionBy(*keys)
        low, high = F.min("date").over(whole) + width / 2 - 1, F.max("date").over(whole) - width / 2 + 1
        out = out.withColumn("average", F.when((F.col("date") >= low) & (F.col("date") <= high), F.col("average")))
    return out


def running_mean(obs: DataFrame, n: int, keys: list[str] = KEYS, value: str = "change") -> DataFrame:
    """Means of n rows in a row, one for each full run. Rows are numbered along the series and dealt over blocks of that number;
    the last n - 1 rows of a block also go to the next one."""
    block = max(BLOCK, n)
    rows = scanned(obs, keys, sums={"n_": F.lit(1)}).withColumn("block_", F.floor((F.col("n_") - 1) / block))
    late = F.pmod(F.col("n_") - 1, F.lit(block)) >= block - (n - 1)
    rows = rows.withColumn("to_", F.explode(F.when(late, F.array("block_", F.col("block_") + 1)).otherwise(F.array("block_"))))
    w = Window.partitionBy(*keys, "to_").orderBy("n_").rowsBetween(-(n - 1), 0)
    out = rows.withColumn("average", F.avg(value).over(w)).where((F.col("to_") == F.col("block_")) & (F.col("n_") >= n))
    return out.drop("n_", "block_", "to_")


def slope(points: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """keys, trend, trend_error: least-squares slope of change over date, and its standard error, times the time span."""
    y, x = F.col("change"), F.col("date")
    own = points.groupBy(*keys).agg(F.regr_slope(y, x).alias("s"), F.regr_sxx(y, x).alias("xx"), F.regr_sxy(y, x).alias("xy"), F.regr_syy(y, x).alias("yy"), F.count(F.lit(1)).alias("n"), (F.max("date") - F.min("date")).alias("span"))
    spread = F.sqrt(F.greatest(F.try_divide(F.try_divide(F.col("yy") - F.col("s") * F.col("xy"), F.col("n") - 2), F.col("xx")), F.lit(0.0)))
    return own.select(*keys, (F.col("s") * F.col("span")).alias("trend"), (F.when(F.col("n") == 2, 0.0).otherwise(spread) * F.col("span")).alias("trend_error"))


def filled_back(df: DataFrame, value: str, keys: list[str] = KEYS, order: str = "seq") -> DataFrame:
    return scanned(df, keys, order, first={"next_": F.col(value)}).withColumn(value, F.col("next_")).drop("next_")


def filled_by_index(df: DataFrame, value: str, keys: list[str], order: str = "seq") -> DataFrame:
    """Nulls filled linearly in the index of the order; the ends hold the nearest value."""
    return filled(df, keys, [value], order)


def sliced_at_gaps(obs: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """With slice_id, which grows by one at each gap: (dataset, slice) is a series without gaps."""
    rows = counted_changes(obs, keys, "start_date", "end_date", "gaps_")
    return rows.withColumn("slice_id", (F.col("gaps_") + 1).cast("int")).drop("gaps_")


def recombined(obs: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Slices as one series again, numbered by start; two rows of one start are an error."""
    w = Window.partitionBy(*keys).orderBy("start_date")
    rows = obs.drop("slice_id").withColumn("n_", F.count(F.lit(1)).over(Window.partitionBy(*keys, "start_date")))
    return rows.withColumn("seq", F.when(F.col("n_") == 1, F.row_number().over(w)).otherwise(F.raise_error(F.lit("two rows of a recombined series start at one date")).cast("int"))).drop("n_")


def small_gaps_closed(rows: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Each row ends where the next starts; the last is unchanged."""
    return scanned(rows, keys, behind={"next_": F.col("start_date")}).withColumn("end_date", F.coalesce("next_", "end_date")).drop("next_")


def gaps_interpolated(
    rows: DataFrame, keys: list[str] = KEYS, values: tuple[str, ...] = ("change", "error"), least_days: int = 1, plain: tuple[str, ...] = (), without_start: str | None = None
) -> DataFrame:
    """Rows of dates with a new row in each gap of over `least_days`: its rate per day, or for `plain` columns its value, is
    interpolated over the row index. Every row ends where the next starts; then rows that start on `without_start` go."""
    w = by(keys)
    rows = rows.withColumn("next_", F.lead("start_date").over(w)).withColumn("days_", F.datediff(F.coalesce("next_", "end_date"), "end_date"))
    rates = [F.try_divide(F.col(v), F.datediff("end_date", "start_date")).alias(v) for v in values]
    own = rows.select(*keys, F.col("seq").cast("double").alias("seq"), "start_date", "end_date", *rates, *plain, F.lit(False).alias("is_filled"))
    new = rows.where(F.col("days_") > least_days).select(*keys, (F.col("seq") + 0.5).alias("seq"), F.col("end_date").alias("start_date"), F.col("next_").alias("end_date"), *[F.lit(None).cast("double").alias(v) for v in (*values, *plain)], F.lit(True).alias("is_filled"))
    out = own.unionByName(new)
    out = filled(out, keys, [*values, *plain])
    out = out.withColumn("end_date", F.coalesce(F.lead("start_date").over(w), F.col("end_date")))
    if without_start:
        out = out.where(F.col("start_date") != F.lit(without_start).cast("date"))
    days = F.datediff("end_date", "start_date")
    return out.select(*keys, F.row_number().over(w).alias("seq"), "start_date", "end_date", *[(F.col(v) * days).alias(v) for v in values], *plain, "is_filled")


def decumulated(rows: DataFrame, keys: list[str] = KEYS, value: str = "change") -> DataFrame:
    """Differences of a cumulative column; the first is 0."""
    return scanned(rows, keys, before={"before_": F.col(value)}).withColumn(value, F.coalesce(F.col(value) - F.col("before_"), F.lit(0.0))).drop("before_")


def constant_columns(rows: DataFrame, columns: list[str], keys: list[str] = KEYS) -> DataFrame:
    """keys and the one value of each column; more than one is an error."""
    one = [F.when(F.count_distinct(c) <= 1, F.first(c, True)).otherwise(F.raise_error(F.lit(f"{c} is not constant"))).alias(c) for c in columns]
    return rows.groupBy(*keys).agg(*one)
