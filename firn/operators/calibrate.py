"""Calibration of annual or monthly series with long-term trends, and seasonal homogenisation.

Trends (group, trend, seq, start_date, end_date, change, error) meet the steps (group, step, start_date, end_date, change,
error) of their group's series. Containment is tested on whole months, which float dates cannot get wrong by an ulp. Steps of a
series follow each other without overlap, so those inside a trend are neighbours: their number and sum are differences of
running sums at the trend's two ends (`located`), and no trend meets its steps one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firn.functions import dates
from firn.functions.dims import SEASONAL_ERROR

m = dates.month_index


def calibrated(trends: DataFrame, steps: DataFrame, group: list[str]) -> DataFrame:
    """group, trend, trend_seq, step, value, distance: the series moved onto each trend that it covers, and each step's distance (1 inside)."""
    span = steps.groupBy(*group).agg(F.min("start_date").alias("low"), F.max("end_date").alias("high"), F.min_by(F.col("end_date") - F.col("start_date"), "start_date").alias("resolution"))
    t = trends.select(*group, "trend", F.col("seq").alias("trend_seq"), F.col("start_date").alias("ts"), F.col("end_date").alias("te"), F.col("change").alias("tc"), F.col("error").alias("t_error"))
    t = t.join(span, group).where((m("ts") >= m("low")) & (m("te") <= m("high")))
    both = t.join(steps.select(*group, "step", "start_date", "end_date", "change", "error"), group)
    inside = (m("start_date") >= m("ts")) & (m("end_date") <= m("te"))
    w = Window.partitionBy(*group, "trend", "trend_seq")
    n = F.count(F.when(inside, 1)).over(w)
    both = both.withColumn("correction", F.try_divide(F.col("tc"), n) - F.avg(F.when(inside, F.col("change"))).over(w))
    distance = F.when(inside, 1.0).otherwise(dates.distance_to_period("start_date", "ts", "te", F.col("resolution")) + 1)
    return both.withColumn("value", F.col("change") + F.col("correction")).withColumn("distance", F.round(distance, 9))


def combined(cal: DataFrame, group: list[str], p: float = 2.0) -> DataFrame:
    """One series of calibrated ones: weights of inverse distance to the power p; with p = 0 only trends that cover a step count."""
    rows = cal.withColumn("raw_", F.pow(1 / F.col("distance"), F.lit(p)) if p > 0 else (F.col("distance") == 1).cast("double"))
    rows = rows.withColumn("weight", F.try_divide("raw_", F.sum("raw_").over(Window.partitionBy(*group, "step"))))
    dated = [*group, "step", "start_date", "end_date"]
    return rows.groupBy(*dated).agg(F.sum(F.col("weight") * F.col("value")).alias("change"), F.first("error").alias("error"), F.count("weight").alias("n_")).where("n_ > 0").drop("n_")


def located(spans: DataFrame, steps: DataFrame, keys: list[str], low: str = "start_date", high: str = "end_date") -> DataFrame:
    """spans (keys and any columns) with the steps inside low to high: first_ and last_ (places in the order of starts, from 1),
    n_ and sum_ (of change, of which counted_ are not null); until_, the place of the last one that starts before high; and
    covered_: whether the series reaches over the whole span.

    One sort of the steps' and the spans' ends together; sums up to an end are looked up there.
    """
    change = F.coalesce("change", F.lit(0.0))
    one = F.struct(F.lit(1).alias("n"), change.alias("sum"), F.col("change").isNotNull().cast("int").alias("counted"))
    ends = steps.select(*keys, one.alias("one_"), F.inline(F.array(F.struct(m("start_date").alias("at_"), F.lit(1).alias("turn_")), F.struct(m("end_date").alias("at_"), F.lit(-1).alias("turn_")))))
    names = [c for c in spans.columns if c not in keys]
    # At one month steps end, then spans begin or end, then steps start.
    asked = spans.select(*keys, F.struct(*names).alias("span_"), F.inline(F.array(F.struct(m(low).alias("at_"), F.lit(True).alias("begins_")), F.struct(m(high).alias("at_"), F.lit(False).alias("begins_"))))).withColumn("turn_", F.lit(0))
    w = Window.partitionBy(*keys).orderBy("at_", "turn_").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    rows = ends.unionByName(asked, allowMissingColumns=True)
    # Before a span's begin the started steps count, up to its end the ended ones.
    up_to = [F.when(F.col("begins_"), F.sum(F.when(F.col("turn_") == 1, F.col(f"one_.{c}"))).over(w)).otherwise(F.sum(F.when(F.col("turn_") == -1, F.col(f"one_.{c}"))).over(w)).alias(f"{c}_") for c in ("n", "sum", "counted")]
    reach = [F.min(F.when(F.col("turn_") == 1, F.col("at_"))).over(whole).alias("low_"), F.max(F.when(F.col("turn_") == -1, F.col("at_"))).over(whole).alias("high_")]
    started = F.sum(F.when(F.col("turn_") == 1, 1)).over(w).alias("until_")
    rows = rows.select(*keys, "span_", "begins_", "at_", started, *up_to, *reach).where("span_ IS NOT NULL")
    side = lambda c, begins: F.coalesce(F.max(F.when(F.col("begins_") == begins, F.col(c))), F.lit(0))
    inside = [(side(c, False) - side(c, True)).alias(c) for c in ("n_", "sum_", "counted_")]
    covered = F.min(F.when(F.col("begins_"), F.col("at_") >= F.col("low_")).otherwise(F.col("at_") <= F.col("high_")))
    out = rows.groupBy(*keys, "span_").agg((side("n_", True) + 1).alias("first_"), side("n_", False).alias("last_"), side("until_", False).alias("until_"), *inside, F.coalesce(covered, F.lit(False)).alias("covered_"))
    return out.select(*keys, "span_.*", "first_", "last_", "until_", F.greatest("n_", F.lit(0)).alias("n_"), "sum_", "counted_", "covered_")


def _placed(steps: DataFrame, keys: list[str]) -> DataFrame:
    return steps.withColumn("i_", F.row_number().over(Window.partitionBy(*keys).orderBy("start_date")))


def _correction() -> Column:
    """What a trend adds to each step inside: its own mean change of a step less theirs."""
    return F.try_divide(F.col("change"), F.col("n_")) - F.try_divide(F.col("sum_"), F.col("counted_"))


def combined_outside(trends: DataFrame, steps: DataFrame, group: list[str]) -> DataFrame:
    """One series of those that `calibrated` moves onto the trends, by weights: the trends that cover a step share it, and the weights
    of other steps are filled linearly in the row-wise matrix of trends and steps: group, step, start_date, end_date, change, error.

    The matrix is not formed. A weight only changes at a trend's ends, so per step the sums over its trends of weights and of
    weighted corrections follow from running sums of what begins and ends there. Between covered steps both are linear. Before
    the first and behind the last one the matrix runs on from one trend's row to the next one's, so there the sums of a
    trend's follower or forerunner enter as well.
    """
    return _filled(located(trends, steps, group).where("covered_"), _placed(steps, group), group)


def _filled(trends: DataFrame, steps: DataFrame, group: list[str]) -> DataFrame:
    """combined_outside of trends that are located and covered, and steps with their places."""
    along = Window.partitionBy(*group).orderBy("seq")
    cor = _correction()
    t = trends.withColumn("c_", F.coalesce(cor, F.lit(0.0))).withColumn("v_", cor.isNotNull().cast("double"))
    side = lambda f, c: F.coalesce(f(c).over(along), F.lit(0.0))
    is_first, is_last = F.lag("v_").over(along).isNull(), F.lead("v_").over(along).isNull()
    # v: 1 where the correction is known, c: the correction; of the trend, its follower and forerunner, and at the matrix's ends alone.
    parts = {"n": F.lit(1.0), "v": F.col("v_"), "c": F.col("c_"), "vn": side(F.lead, "v_"), "cn": side(F.lead, "c_"), "vp": side(F.lag, "v_"), "cp": side(F.lag, "c_")}
    parts |= {k: F.when(end, F.col(x)).otherwise(0.0) for k, end, x in (("vf", is_first, "v_"), ("cf", is_first, "c_"), ("vl", is_last, "v_"), ("cl", is_last, "c_"))}
    # A step that starts inside a trend is covered, though it may end behind it.
    t = t.select(*group, "first_", "until_", *[c.alias(k) for k, c in parts.items()]).where("until_ >= first_")
    turn = lambda place, sign: F.struct(place.alias("i_"), *[(F.col(k) * sign).alias(f"d_{k}") for k in parts])
    turns = t.select(*group, F.inline(F.array(turn(F.col("first_"), 1), turn(F.col("until_") + 1, -1)))).groupBy(*group, "i_").agg(*[F.sum(f"d_{k}").alias(f"d_{k}") for k in parts])
    by_place = Window.partitionBy(*group).orderBy("i_")
    upto, rest = by_place.rowsBetween(Window.unboundedPreceding, 0), by_place.rowsBetween(0, Window.unboundedFollowing)
    rows = steps.join(turns, [*group, "i_"], "left")
    rows = rows.select(*steps.columns, *[F.coalesce(F.sum(f"d_{k}").over(upto), F.lit(0.0)).alias(k) for k in parts])
    n = F.rint("n")
    here = F.when(n > 0, F.struct("i_", *[(F.col(k) / n).alias(k) for k in parts if k != "n"]))
    rows = rows.select(*steps.columns, here.alias("here"))
    every = Window.partitionBy(*group)
    rows = rows.select(
        "*", F.last("here", True).over(upto).alias("p"), F.first("here", True).over(rest).alias("q"), F.min("here").over(every).alias("b"), F.max("here").over(every).alias("a"), F.max("i_").over(every).alias("size"), (F.max("here.v").over(every) > 0).alias("known"),
    )
    i, wrap = F.col("i_"), F.col("size") - F.col("a.i_") + F.col("b.i_")
    f, g = (F.col("size") - F.col("a.i_") + i) / wrap, (i - F.col("a.i_")) / wrap
    between = F.try_divide(i - F.col("p.i_"), F.col("q.i_") - F.col("p.i_"))

    def total(x: str) -> Column:
        """Sum over the trends of weights (x: v) or of weighted corrections (c)."""
        before = F.col(f"b.{x}f") + (1 - f) * F.col(f"a.{x}n") + f * (F.col(f"b.{x}") - F.col(f"b.{x}f"))
        behind = F.col(f"a.{x}l") + (1 - g) * (F.col(f"a.{x}") - F.col(f"a.{x}l")) + g * F.col(f"b.{x}p")
        inner = F.col(f"p.{x}") + between * (F.col(f"q.{x}") - F.col(f"p.{x}"))
        return F.when(F.col("here").isNotNull(), F.col(f"here.{x}")).when(F.col("p").isNull(), before).when(F.col("q").isNull(), behind).otherwise(inner)

    # Without any known correction no value is known.
    out = rows.where("b IS NOT NULL").withColumn("change", F.when(F.col("known"), F.col("change") * total("v") + total("c")))
    return out.drop("here", "p", "q", "a", "b", "size", "known")


def onto_trends(trends: DataFrame, steps: DataFrame, group: list[str]) -> DataFrame:
    """For each trend dataset the series calibrated with it: the mean over the trends that cover a step. The error adds that of the
    first covering trend, scaled to a step, in quadrature. Trends that the series does not cover, or that hold no step, give
    nothing: see `without_cover`."""
    resolution = steps.groupBy(*group).agg(F.min_by(F.col("end_date") - F.col("start_date"), "start_date").alias("r_"))
    own = located(trends, steps, group).where("covered_ AND n_ > 0").select(*group, "trend", "seq", "error", _correction().alias("c_"), F.explode(F.sequence("first_", "last_")).alias("i_"))
    each = own.groupBy(*group, "trend", "i_").agg(F.avg("c_").alias("c_"), F.min_by("error", "seq").alias("t_"))
    mean = trends.groupBy(*group, "trend").agg(F.avg(F.col("end_date") - F.col("start_date")).alias("mean_length")).join(resolution, group)
    out = each.join(_placed(steps, group).select(*group, "i_", "step", "start_date", "end_date", "change", F.col("error").alias("e_")), [*group, "i_"]).join(mean, [*group, "trend"])
    scaled = F.col("t_") * F.col("r_") / F.col("mean_length")
    error = F.sqrt(scaled * scaled + F.coalesce(F.col("e_") * F.col("e_"), F.lit(0.0)))
    return out.select(*group, "trend", "step", "start_date", "end_date", (F.col("change") + F.col("c_")).alias("change"), error.alias("error"))


def without_cover(trends: DataFrame, steps: DataFrame, group: list[str]) -> DataFrame:
    """The trends that `onto_trends` can't use, with `reason`."""
    reason = F.when(F.col("covered_"), "no step of the annual series lies inside the trend").otherwise("the annual series does not reach over the trend")
    return located(trends, steps, group).where("NOT covered_ OR n_ = 0").select(*trends.columns, reason.alias("reason"))


def _year_rows(own: DataFrame, seasonal: DataFrame, group: list[str], year_start: Column | float) -> DataFrame:
    """All rows of own with their window on the annual grid, the change and error there, and whether the seasonal series fills it."""
    keys = [*group, "series"]
    steps = own.select(*keys).distinct().join(seasonal.select(*group, F.col("seq").alias("step"), "start_date", "end_date", "change", "error"), group)
    rows = own.select(*keys, "seq", "start_date", "end_date", "change", "error", dates._col(year_start).alias("ys_"))
    rows = rows.withColumn("s1", dates.nearest_year("start_date", F.col("ys_"))).withColumn("e1", dates.nearest_year("end_date", F.col("ys_"))).drop("ys_")
    window = lambda is_new, s, e: F.struct(F.lit(is_new).alias("is_new"), F.col(s).alias("lo"), F.col(e).alias("hi"))
    spans = located(rows.select("*", F.inline(F.array(window(False, "start_date", "end_date"), window(True, "s1", "e1")))), steps, keys, "lo", "hi")
    one = _filled(spans.where("NOT is_new AND covered_"), _placed(steps, keys), keys)
    one = one.withColumn("level", F.sum("change").over(Window.partitionBy(*keys).orderBy("i_").rowsBetween(Window.unboundedPreceding, 0)))
    place = lambda end, c: F.struct(F.lit(end).alias("end_"), F.col(c).cast("bigint").alias("i_"))
    ends = spans.select(*keys, "seq", "is_new", "n_", F.inline(F.array(place("first", "first_"), place("last", "last_")))).where("n_ > 0")
    at = ends.join(one.select(*keys, F.col("i_").cast("bigint").alias("i_"), F.struct("level", "change", m("start_date").alias("from"), m("end_date").alias("to")).alias("at")), [*keys, "i_"])
    pick = lambda is_new, end: F.max(F.when((F.col("is_new") == is_new) & (F.col("end_") == end), F.col("at"))).alias(f"{end}_{is_new:d}")
    at = at.groupBy(*keys, "seq").agg(*[pick(n, e) for n in (False, True) for e in ("first", "last")])
    out = rows.join(at, [*keys, "seq"], "left")
    filled = F.coalesce((F.col("first_1.from") == m("s1")) & (F.col("last_1.to") == m("e1")), F.lit(False))
    change = F.col("last_1.level") - F.col("first_1.level") + F.col("first_1.change")
    extra = SEASONAL_ERROR * (F.abs(F.col("first_0.level") - F.col("first_1.level")) + F.abs(F.col("last_0.level") - F.col("last_1.level")))
    return out.select(*rows.columns, filled.alias("filled"), change.alias("change_1"), F.sqrt(F.col("error") * F.col("error") + extra * extra).alias("error_1"))


def homogenised(own: DataFrame, seasonal: DataFrame, group: list[str], year_start: Column | float) -> DataFrame:
    """Rows of each series (group, series, seq) on the annual grid by a seasonal series: each row's change becomes that of the
    calibrated seasonal series over the nearest years, its error grows with the moved parts. Windows that the seasonal series
    does not fill give no row: see `unfilled`."""
    rows = _year_rows(own, seasonal, group, year_start).where("filled")
    return rows.select(*group, "series", "seq", F.col("s1").alias("start_date"), F.col("e1").alias("end_date"), F.col("change_1").alias("change"), F.col("error_1").alias("error"))


def unfilled(own: DataFrame, seasonal: DataFrame, group: list[str], year_start: Column | float) -> DataFrame:
    """Rows of own that `homogenised` has no row for, with `reason`."""
    there = seasonal.select(*group).distinct().withColumn("there_", F.lit(True))
    rows = _year_rows(own, seasonal, group, year_start).where("NOT filled").join(there, group, "left")
    reason = F.when(F.col("there_"), "the seasonal series does not fill the window").otherwise("no seasonal series")
    return rows.select(*group, "series", "seq", "start_date", "end_date", reason.alias("reason"))
