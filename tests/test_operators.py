"""Operators against values worked out by hand, and properties that hold for any input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from firn.functions import dates, dims, units
from firn.operators import calibrate, combine, filters, grid, series
from firn.plans import assessment, cleaning

S = "dataset_id string, seq int, start_date double, end_date double, change double, error double"


@pytest.fixture(scope="session")
def make(spark):
    def of(rows, **more):
        """rows: (id, start, end, change, error)."""
        seq = {}
        out = []
        for r in rows:
            seq[r[0]] = seq.get(r[0], 0) + 1
            out.append((r[0], seq[r[0]], *map(float, r[1:3]), r[3], r[4]))
        return spark.createDataFrame(out, S).withColumns({k: F.lit(v) for k, v in more.items()})

    return of


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x if values else spark.range(1).select(column.alias("x")).first().x


GAP = [("a", 2010, 2011, 1.0, 0.1), ("a", 2011, 2012, 1.0, 0.05), ("a", 2013, 2014, 1.0, 0.2)]


def test_cumulative_with_a_gap(make):
    got = series.cumulative(make(GAP), gaps=True).orderBy("step", "sub").collect()
    assert [r.date for r in got] == [2010, 2011, 2012, 2013, 2013, 2014]
    assert [r.change for r in got] == [0, 1, 2, None, 2, 3]


def test_cumulative_errors(make):
    rows = make([("a", 2010 + k, 2011 + k, 1.0, e) for k, e in enumerate((3.0, 1.0, 2.0))])
    assert np.allclose([r.error for r in series.cumulative(rows).orderBy("date").collect()], [0, 3, math.sqrt(10), math.sqrt(14)])


def test_contiguous_and_slices(make):
    assert not filters.contiguous(make(GAP)).first().is_contiguous
    rows = make([("a", s, e, 1.0, 0.1) for s, e in ((2012, 2013), (2013, 2014), (2015, 2016), (2016, 2017), (2020, 2023))])
    cut = series.sliced_at_gaps(rows)
    assert [r.slice_id for r in cut.orderBy("seq").collect()] == [1, 1, 2, 2, 3]
    assert [tuple(r) for r in series.recombined(cut).orderBy("seq").collect()] == [tuple(r) for r in rows.orderBy("seq").collect()]


def test_full_years(spark):
    x = lambda lo, hi, ys: one(spark, dates.full_years(F.lit(lo), F.lit(hi), ys))
    assert x(2009.5, 2010.8, 0.75) == [2009.75]
    assert x(2009.7, 2015.8, 0.25) == [2010.25, 2011.25, 2012.25, 2013.25, 2014.25]
    assert x(2010.1, 2010.9, 0.0) == []


def test_dates(spark):
    assert one(spark, dates.fractional_year(F.lit("2001-01-01 00:00:00"))) == 2001.0
    assert one(spark, dates.fractional_year(F.lit("2000-07-01 00:00:00"))) == pytest.approx(2000 + 182 / 366)
    assert str(one(spark, dates.from_fractional_year(F.lit(2000.5)))) == "2000-07-02 00:00:00"
    assert one(spark, dates.nearest_year(F.lit(2010.5), 0.0)) == 2010 and one(spark, dates.nearest_year(F.lit(2010.6), 0.0)) == 2011
    assert [one(spark, dates.three_digits(F.lit(v))) for v in (1.005, 0.08333333, 123.5, 5.0)] == [1.0, 0.0833, 124.0, 5.0]
    assert one(spark, dates.distance_to_period(F.lit(2012.0), F.lit(2010.0), F.lit(2012.0), 1.0)) == 1.0
    assert one(spark, dates.snap_to_month(F.lit(2010.1))) == pytest.approx(2010 + 1 / 12)


def test_units(spark):
    assert one(spark, units.metres_to_gt(F.lit(20.0), F.lit(1000.0))) == pytest.approx(17.0)
    for there, back in ((units.metres_to_mwe, units.mwe_to_metres),):
        assert one(spark, back(there(F.lit(3.5)))) == pytest.approx(3.5)
    assert one(spark, units.gt_to_mwe(units.mwe_to_gt(F.lit(2.0), F.lit(500.0)), F.lit(500.0))) == pytest.approx(2.0)
    assert one(spark, units.gt_to_sea_level(F.lit(-362.5))) == pytest.approx(1.0)
    assert [one(spark, units.density_uncertainty(F.lit(t))) for t in (0.5, 1.0, 5.0, 10.0)] == [480, 240, 120, 60]
    assert one(spark, units.adjusted_area(F.lit(2008.5), F.lit(2009.5), F.lit(86725.0), F.lit(-0.48), F.lit(2009.0))) == 86725.0


def test_unit_round_trips(spark, make):
    r = dims.regions(spark)
    rows = make([("a", 2010 + k, 2011 + k, 1.0 + k, 0.3) for k in range(4)], region="iceland", unit="mwe", area_change_applied=False)
    back = grid.to_mwe(grid.to_gt(rows, r), r).orderBy("seq").collect()
    assert np.allclose([x.change for x in back], [1, 2, 3, 4]) and np.allclose([x.error for x in back], 0.3)
    undone = grid.area_change(grid.area_change(rows, r), r, False).orderBy("seq").collect()
    assert np.allclose([x.change for x in undone], [1, 2, 3, 4])
    with pytest.raises(Exception, match="alternates"):
        grid.area_change(grid.area_change(rows, r), r).collect()
    with pytest.raises(Exception, match="no conversion"):
        grid.to_mwe(rows.withColumn("unit", F.lit("meters")), r).collect()


def test_spread_and_proportional(make):
    got = grid.to_annual(make([("a", 2010, 2015, 5.0, 1.0)]), 0.0).orderBy("start_date").collect()
    assert [(r.start_date, r.change, r.error) for r in got] == [(2010.0 + k, 1.0, 0.2) for k in range(5)]
    r = grid.shifted_proportionally(make([("a", 2010.1, 2012.2, 2.1, 0.21)]), 0.0).first()
    assert (r.start_date, r.end_date) == (2010, 2012) and r.change == pytest.approx(2.0) and r.error == pytest.approx(0.2)


def test_monthly_resampling_conserves_change(make):
    rng = np.random.default_rng(0)
    at = np.cumsum(rng.uniform(0.02, 0.2, 30)) + 2000
    rows = make([("a", a, b, float(c), 0.1) for a, b, c in zip(at, at[1:], rng.normal(size=29), strict=False)])
    got = grid.to_monthly(rows).collect()
    assert sum(r.change for r in got) == pytest.approx(sum(r.change for r in rows.collect()))
    assert filters.on_monthly_grid(grid.to_monthly(rows)).first().is_monthly


def test_interpolation(make, spark):
    rng = np.random.default_rng(1)
    x, y = np.sort(rng.uniform(0, 10, 12)), rng.normal(size=12)
    at = np.linspace(-1, 11, 40)
    knots = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(x, y, strict=True)], "dataset_id string, date double, change double")
    points = spark.createDataFrame([("a", float(a)) for a in at], "dataset_id string, date double")
    got = lambda mode: np.array([r.change for r in series.interpolated(knots, points, mode=mode).orderBy("date").collect()])
    assert np.allclose(got("linear"), np.interp(at, x, y))
    assert np.allclose(got("nearest"), [y[np.argmin(np.abs(x - a))] for a in at])
    cubic = spark.createDataFrame([("a", float(k), float(k**3 - 2 * k)) for k in range(7)], "dataset_id string, date double, change double")
    q = spark.createDataFrame([("a", 0.5), ("a", 3.25)], "dataset_id string, date double")
    assert np.allclose([r.change for r in series.interpolated(cubic, q, mode="spline").orderBy("date").collect()], [0.125 - 1, 3.25**3 - 6.5])
    with pytest.raises(ValueError):
        series.interpolated(knots, points, mode="other")


def test_slope(make):
    r = series.slope(series.cumulative(make([("a", 2010 + k, 2011 + k, 2.0, 0.1) for k in range(5)]))).first()
    assert r.trend == pytest.approx(10.0) and r.trend_error == pytest.approx(0.0, abs=1e-9)


def test_average_of_two(make):
    rows = make([(d, 2010 + k, 2011 + k, f * (k + 1.0), 0.1) for d, f in (("a", 1), ("b", 2)) for k in range(3)], region="r")
    got = combine.consensus(rows, ["region"]).orderBy("start_date").collect()
    assert np.allclose([r.change for r in got], [1.5, 3.0, 4.5])
    alone = combine.consensus(rows.where("dataset_id = 'a'"), ["region"], remove_trend=True, add_trend=True).orderBy("start_date").collect()
    assert np.allclose([r.change for r in alone], [1, 2, 3]) and np.allclose([r.error for r in alone], 0.1)


def test_consensus_does_not_depend_on_order(make):
    rng = np.random.default_rng(2)
    rows = make([(d, 2010 + k, 2011 + k, float(rng.normal()), 0.1) for d in "abc" for k in range(6) if (d, k) != ("b", 2)], region="r")
    want = [tuple(r) for r in combine.consensus(rows, ["region"], True, True).orderBy("start_date").collect()]
    mixed = rows.orderBy(F.rand(3)).repartition(5)
    assert np.allclose([w[1:] for w in want], [tuple(r)[1:] for r in combine.consensus(mixed, ["region"], True, True).orderBy("start_date").collect()])


def test_common_period_with_a_gap(make):
    rows = make([("a", 2010, 2011, 1.0, 1.0), ("a", 2011, 2012, 1.0, 1.0), ("a", 2013, 2014, 1.0, 1.0), ("b", 2011, 2012, 1.0, 1.0), ("b", 2012, 2013, 1.0, 1.0), ("b", 2013, 2014, 1.0, 1.0)], region="r")
    starts, ends = combine.common_period(rows, ["region"])
    assert sorted(r.start_date for r in starts.collect()) == [2011, 2013] and sorted(r.end_date for r in ends.collect()) == [2012, 2014]


def test_calibration(make, spark):
    trends = spark.createDataFrame([("r", "t", 1, 2000.0, 2002.0, 3.0, 0.1), ("r", "t", 2, 2002.0, 2005.0, 8.0, 0.1)], "region string, trend string, seq int, start_date double, end_date double, change double, error double")
    steps = spark.createDataFrame([("r", k + 1, 2000.0 + k, 2001.0 + k, c, 0.1) for k, c in enumerate((1.0, 2.0, 3.0, 2.0, 1.0))], "region string, step int, start_date double, end_date double, change double, error double")
    cal = calibrate.calibrated(trends, steps, ["region"])
    got = calibrate.combined(cal, ["region"], 0.0).orderBy("step").collect()
    assert np.allclose([r.change for r in got], [1, 2, 11 / 3, 8 / 3, 5 / 3])
    assert [r.distance for r in cal.where("trend_seq = 2").orderBy("step").collect()] == [3, 2, 1, 1, 1]
    mean = calibrate.onto_trends(trends, steps, ["region"]).orderBy("step").collect()
    assert np.allclose([r.change for r in mean], [r.change for r in got])


def test_weights_outside_trends_equal_those_of_the_whole_matrix(spark):
    """Random trends, overlapping, with gaps between, some without steps inside or beyond the series, against the filled matrix."""
    rng = np.random.default_rng(11)
    steps, trends, want, onto = [], [], {}, {}
    for k in range(40):
        size = int(rng.integers(6, 30))
        change = [None if rng.random() < 0.05 else float(x) for x in rng.normal(size=size)]
        steps += [(k, i + 1, 2000.0 + i, 2001.0 + i, c, 0.1) for i, c in enumerate(change)]
        own = []
        for seq in range(1, int(rng.integers(1, 6))):
            lo = 1999.5 + rng.integers(0, 2 * size) / 2
            own.append((k, "t", seq, float(lo), float(lo + rng.integers(1, 12) / 2), float(rng.normal()), 0.1))
        trends += own
        own = [t for t in own if t[3] >= 2000 and t[4] <= 2000 + size]
        inside = np.array([[2000 + i >= t[3] and 2001 + i <= t[4] for i in range(size)] for t in own]).reshape(len(own), size)
        if not any(t[3] <= 2000 + i < t[4] for t in own for i in range(size)):
            continue
        x = np.array([np.nan if c is None else c for c in change])
        with np.errstate(all="ignore"):
            starts = np.array([[t[3] <= 2000 + i < t[4] for i in range(size)] for t in own]).reshape(len(own), size)
            weight = np.where(starts.sum(0) > 0, starts / starts.sum(0), np.nan).ravel()
            seen = np.flatnonzero(~np.isnan(weight))
            weight = np.interp(np.arange(len(weight)), seen, weight[seen]).reshape(inside.shape)
            cor = np.array([t[5] / r.sum() - np.nanmean(x[r]) if r.any() and not np.isnan(x[r]).all() else np.nan for t, r in zip(own, inside, strict=True)])
        value = weight * (x[None, :] + cor[:, None])
        mean = np.where(inside, x[None, :] + cor[:, None], np.nan)
        onto |= {(k, i + 1): (x[i], mean[inside[:, i], i].mean()) for i in range(size) if inside[:, i].any()}
        want |= {(k, i + 1): np.nansum(value[:, i]) for i in range(size) if not np.isnan(value[:, i]).all()}
    kinds = "start_date double, end_date double, change double, error double"
    t, st = spark.createDataFrame(trends, "k int, trend string, seq int, " + kinds), spark.createDataFrame(steps, "k int, step int, " + kinds)
    got = {(r.k, r.step): r.change for r in calibrate.combined_outside(t, st, ["k"]).collect() if r.change is not None}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    found = {(r.k, r.step): r.change for r in calibrate.onto_trends(t, st, ["k"]).collect()}
    assert found.keys() == onto.keys() and all(abs(found[i] - v) < 1e-9 for i, (x, v) in onto.items() if not np.isnan([x, v]).any())
    lost = calibrate.without_cover(t, st, ["k"])
    used = calibrate.located(t, st, ["k"]).where("covered_ AND n_ > 0").count()
    assert lost.count() + used == len(trends) and {r.reason[:10] for r in lost.collect()} == {"no step of", "the annual"}


def test_homogenised_keeps_a_flat_series(spark):
    monthly = spark.createDataFrame([("r", k + 1, 2000 + k / 12, 2000 + (k + 1) / 12, 0.1, 0.01) for k in range(96)], "region string, seq int, start_date double, end_date double, change double, error double")
    own = spark.createDataFrame([("r", "a", k + 1, 2001.5 + k, 2002.5 + k, 1.2, 0.2) for k in range(4)], "region string, series string, seq int, start_date double, end_date double, change double, error double")
    got = calibrate.homogenised(own, monthly, ["region"], 0.75).orderBy("start_date").collect()
    assert [r.start_date for r in got] == [2001.75 + k - 0 for k in range(4)] and np.allclose([r.change for r in got], 1.2)
    assert all(r.error > 0.2 for r in got)
    more = own.union(spark.createDataFrame([("r", "a", 5, 2006.5, 2009.5, 1.2, 0.2), ("s", "a", 1, 2001.5, 2002.5, 1.2, 0.2)], own.schema))
    lost = {(r.region, r.seq): r.reason for r in calibrate.unfilled(more, monthly, ["region"], 0.75).collect()}
    assert lost == {("r", 5): "the seasonal series does not fill the window", ("s", 1): "no seasonal series"}


def test_windows(make):
    rows = make([("a", 2010 + k, 2011 + k, 1.0, 0.1) for k in range(5)])
    assert [r.start_date for r in filters.in_window(rows, 2011, 2013).orderBy("seq").collect()] == [2011, 2012]
    assert filters.in_window(rows, 2011, 2013, gap=True).count() == 3
    avg = series.running_mean(rows, 2).orderBy("seq").collect()
    assert len(avg) == 4


def test_matched(spark):
    a, b = (spark.createDataFrame([(float(v),) for v in x], "v double") for x in ((1, 2, 3, 5), (2, 5, 7)))
    assert sorted(map(tuple, combine.matched(a, b, "v").collect())) == [(1, 0), (3, 1)]
    near = combine.matched(a, b.withColumn("v", F.col("v") + 0.05), "v", 0.1)
    assert sorted(map(tuple, near.collect())) == [(1, 0), (3, 1)]
    with pytest.raises(Exception, match="duplicate"):
        combine.matched(a.union(a), b, "v").collect()


def test_cleaning(spark):
    rows = [("x_altimetry.csv", k + 1, f"{2000 + k}-10-01", f"{2001 + k}-09-30", 0.5, 0.1, "mwe") for k in range(4)]
    rows += [("y_altimetry.csv", k + 1, f"{2000 + 5 * k}-01-01", f"{2005 + 5 * k}-01-01", -999.0 if k == 2 else 1.0, 0.1, "m") for k in range(4)]
    rows += [("z_gravimetry.csv", 1, "2010-01-01", "2010-02-01", 31.0, 1.0, "Gt"), ("z_gravimetry.csv", 2, "2010-03-01", "2010-04-01", 62.0, 1.0, "Gt")]
    df = spark.createDataFrame(rows, "file_name string, seq int, s string, e string, change double, error double, unit string").select("file_name", "seq", F.to_date("s").alias("start_date"), F.to_date("e").alias("end_date"), "change", "error", "unit")
    got = {r.file_name: (r.date_check_satisfied, r.nodata_check_satisfied, r.action) for r in cleaning.decisions(df).collect()}
    assert got == {"x_altimetry.csv": (False, True, "close"), "y_altimetry.csv": (True, False, "none"), "z_gravimetry.csv": (False, True, "interpolate")}
    out = cleaning.cleaned(df).orderBy("file_name", "seq").collect()
    x, y, z = ([r for r in out if r.file_name.startswith(k)] for k in "xyz")
    assert [str(r.end_date) for r in x] == ["2001-10-01", "2002-10-01", "2003-10-01", "2004-09-30"]
    assert [r.change for r in y] == [1.0, 1.0, 1.0]
    assert [str(r.start_date) for r in z] == ["2010-01-01", "2010-02-01", "2010-03-01"] and z[1].change == pytest.approx(28 * 1.5)


def test_empty_inputs(make, spark):
    none = make(GAP).limit(0).withColumns({"region": F.lit("iceland"), "unit": F.lit("m"), "area_change_applied": F.lit(False)})
    assert combine.consensus(none, ["region"], True, True).count() == 0
    assert grid.to_monthly(grid.to_mwe(none, dims.regions(spark))).count() == 0
    assert series.cumulative(none, gaps=True).count() == 0 and combine.year_sums(none, ["dataset_id"], 0.0).count() == 0


def test_figures(make):
    df = make(GAP, region="r", data_group="g")
    assert assessment.figures({"raw": df, "final": df}, levels=False).count() == 6
    made = assessment.figures({"raw": df, "final": df.drop("dataset_id")})
    assert made.where("kind = 'rate'").count() == 6 and made.where("kind = 'level' AND figure = 'raw'").count() == 6  # a start, three ends, a gap
    assert made.where("figure = 'final' AND dataset_id IS NOT NULL").count() == 0


def test_spline_against_a_dense_solution():
    rng = np.random.default_rng(4)
    x = np.cumsum(rng.uniform(0.2, 1.5, 40))
    y, at = rng.normal(size=40), np.linspace(x[0], x[-1], 300)
    h, s, n = np.diff(x), np.diff(y) / np.diff(x), 40
    a, r = np.zeros((n, n)), np.zeros(n)
    a[0, :3], a[-1, -3:] = (h[1], -(h[0] + h[1]), h[0]), (h[-1], -(h[-2] + h[-1]), h[-2])
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2], r[i] = (h[i - 1], 2 * (h[i - 1] + h[i]), h[i]), 6 * (s[i] - s[i - 1])
    m, i = np.linalg.solve(a, r), np.clip(np.searchsorted(x, at, "right") - 1, 0, n - 2)
    t = at - x[i]
    want = y[i] + t * (s[i] - h[i] * (2 * m[i] + m[i + 1]) / 6) + t**2 * m[i] / 2 + t**3 * (m[i + 1] - m[i]) / (6 * h[i])
    assert np.allclose(series.cubic_spline(x, y, at), want)
    twice = np.concatenate([x, x[:5]])
    assert np.allclose(series.cubic_spline(twice, np.concatenate([y, y[:5] + 2]), x[:5]), y[:5] + 1)
    assert np.isfinite(series.cubic_spline(np.arange(20_000.0), rng.normal(size=20_000), np.array([0.5, 19_998.5]))).all()


def test_annual_series_off_the_year_grid_are_shifted(spark, make):
    """Years of changes 1 to 5 from January keep their changes when they come to years from October; metres take the error of a year."""
    rows = [(f"{u}", u, k + 1, 2000.0 + k, 2001.0 + k, float(k + 1), 0.1) for u in ("mwe", "m") for k in range(5)]
    df = spark.createDataFrame(rows, "dataset_id string, unit string, seq int, start_date double, end_date double, change double, error double")
    df = df.withColumns({"region": F.lit("iceland"), "data_group": F.lit("altimetry"), "role": F.lit("annual")})
    regions = assessment.with_years(dims.regions(spark))
    got = assessment.annual_series(assessment.prepared(df, regions), regions, None, "proportional").orderBy("dataset_id", "start_date").collect()
    assert [(r.start_date, r.change) for r in got if r.dataset_id == "mwe"] == [(1999.75 + k, k + 1.0) for k in range(5)]
    m = next(r for r in got if r.dataset_id == "m")
    assert m.change == pytest.approx(850 / 997) and m.error == pytest.approx(850 / 997 * np.hypot(0.1, 240 / 850))
    with pytest.raises(ValueError):
        assessment.corrected(df, None, "seasonal_homogenization")
    with pytest.raises(NotImplementedError):
        assessment.corrected(df, None, "other")


def test_extension_without_common_years(make, spark):
    a = spark.createDataFrame([("r", 2000.0, 2001.0, 5.0, 0.1)], "region string, start_date double, end_date double, change double, error double")
    b = spark.createDataFrame([("r", 2003.0, 2004.0, 7.0, 0.2)], a.schema)
    got = combine.extended_if_shorter(a, b, ["region"], (1999.0, 2005.0)).orderBy("start_date").collect()
    assert [(r.start_date, r.change) for r in got] == [(2000.0, None), (2003.0, None)]
    assert combine.extended_if_shorter(a, b, ["region"], (2000.0, 2001.0)).first().change == 5.0
    window = spark.createDataFrame([("r", 2000.0, 2001.0)], "region string, low double, high double")
    assert combine.extended_if_shorter(a, b, ["region"], window).first().change == 5.0


def test_regions_without_a_seasonal_series_are_never_lost_silently(spark):
    kinds = "start_date double, end_date double, change double, error double"
    monthly = spark.createDataFrame([("alaska", k + 1, 2000 + k / 12, 2000 + (k + 1) / 12, 0.1, 0.01) for k in range(96)], "region string, seq int, " + kinds)
    rows = [(r, 2001.75 + k, 2002.75 + k, -1.0, 0.2) for r in ("alaska", "iceland") for k in range(4)]
    regional = spark.createDataFrame(rows, "region string, " + kinds).withColumns({"unit": F.lit("mwe"), "area_change_applied": F.lit(True)})
    with pytest.raises(Exception, match="no seasonal series for iceland"):
        assessment.to_calendar_years(regional, monthly).collect()
    with pytest.raises(ValueError):
        assessment.to_calendar_years(regional, monthly, missing="hide")
    years = assessment.to_calendar_years(regional, monthly, missing="report")
    assert {r.region for r in years.collect()} == {"alaska"}
    regions = assessment.with_years(dims.regions(spark))
    for unit in ("mwe", "gt"):
        assert {r.n_regions for r in assessment.global_result(years, regions, 2000, 2010, unit).collect()} == {1}
    none = regional.limit(0).withColumns({"data_group": F.lit("x"), "trend": F.lit("t"), "seq": F.lit(1)})
    stages = {k: none for k in ("annual_raw", "trends_raw", "trends_homogenized", "calibrated_series", "final")}
    settings = assessment.Settings(2000, 2010)
    lost = assessment.violations(stages, regions, settings, monthly, regional, [("iceland", "altimetry")]).collect()
    assert {(r.stage, r.region, r.data_group, r.reason) for r in lost} == {("calendar", "iceland", None, "no seasonal series"), ("final", "iceland", "altimetry", "no data")}
    assert len(lost) == 5


def test_series_of_many_blocks(spark, monkeypatch):
    """Whatever the size of a block, sums, neighbours and fillings are those of the whole series, numbers of rows may be missing."""
    from firn.operators import scan

    rng = np.random.default_rng(4)
    rows, want = [], {}
    for k in range(3):
        seqs = sorted(rng.choice(np.arange(1, 60), 40, replace=False).tolist())
        at = 2000.0
        for n in seqs:
            start = at + (0.5 if rng.random() < 0.2 else 0.0)
            rows.append((k, int(n), start, start + 1, None if rng.random() < 0.2 else float(rng.normal()), float(rng.random())))
            at = start + 1
    df = spark.createDataFrame(rows, "k int, seq int, start_date double, end_date double, change double, error double")
    found = {
        "cumulative": lambda: series.cumulative(df, ["k"], gaps=True), "slices": lambda: series.sliced_at_gaps(df, ["k"]), "closed": lambda: series.small_gaps_closed(df, ["k"]),
        "mean": lambda: series.running_mean(df, 5, ["k"]), "single": lambda: series.decumulated(df, ["k"]), "filled": lambda: series.filled_by_index(df, "change", ["k"]), "back": lambda: series.filled_back(df, "change", ["k"]),
    }
    rounded = lambda d: sorted(tuple(round(x, 9) + 0.0 if isinstance(x, float) else x for x in r) for r in d.na.fill(-99.0).collect())
    for name, f in found.items():
        want[name] = rounded(f())
    monkeypatch.setattr(scan, "BLOCK", 7)
    monkeypatch.setattr(series, "BLOCK", 7)
    for name, f in found.items():
        assert rounded(f()) == want[name], name
    own = [r for r in rows if r[0] == 1]
    sums = np.cumsum([r[4] or 0.0 for r in own])
    got = [r.change for r in series.cumulative(df, ["k"]).where("k = 1 AND sub = 2").orderBy("step").collect()]
    assert np.allclose(got, sums)
    gaps = np.cumsum([0] + [a[3] != b[2] for a, b in zip(own, own[1:], strict=False)]) + 1
    assert [r.slice_id for r in series.sliced_at_gaps(df, ["k"]).where("k = 1").orderBy("seq").collect()] == gaps.tolist()
    values = np.array([np.nan if r[4] is None else r[4] for r in own])
    known = np.flatnonzero(~np.isnan(values))
    got = [r.change for r in series.filled_by_index(df, "change", ["k"]).where("k = 1").orderBy("seq").collect()]
    assert np.allclose(got, np.interp(np.arange(len(values)), known, values[known]))
    plan = series.sliced_at_gaps(df, ["k"])._jdf.queryExecution().toString()
    assert "block_" in plan


def test_cumulative_series_meet_a_reference_between_its_points(spark):
    kinds = "k string, date double, change double"
    reference = spark.createDataFrame([("a", 2000.0, 0.0), ("a", 2001.0, 10.0), ("a", 2001.5, None), ("a", 2002.0, 20.0)], kinds)
    rows = [("a", "inside", 2001.5, 0.0), ("a", "inside", 2002.5, 5.0), ("a", "off", 2001.51, 0.0), ("a", "on", 2001.0, 1.0), ("a", "before", 1999.5, 0.0), ("a", "before", 2000.5, 4.0), ("b", "alone", 2001.0, 7.0)]
    points = spark.createDataFrame(rows, "k string, dataset_id string, date double, change double")
    got = {(r.dataset_id, r.date): r.change for r in assessment.aligned(points, reference, ["k", "dataset_id"]).collect()}
    want = {("inside", 2001.5): 15, ("inside", 2002.5): 20, ("off", 2001.51): 15, ("on", 2001.0): 11, ("before", 1999.5): -2, ("before", 2000.5): 2, ("alone", 2001.0): 7}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)
