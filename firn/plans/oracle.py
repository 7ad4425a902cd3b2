"""DuckDB SQL of the queries, written apart from the DataFrame code."""

from __future__ import annotations

ORDERS = """WITH reg(rid, region, area, ac, ry, unc) AS (VALUES (0, 'alaska', 86725.0::DOUBLE, -0.48::DOUBLE, 2009.0::DOUBLE, 0.05::DOUBLE), (1, 'western_canada_us', 14524.0, -0.54, 2003.0, 0.05),
 (2, 'arctic_canada_north', 105111.0, -0.07, 2000.0, 0.05), (3, 'arctic_canada_south', 40888.0, -0.08, 2001.0, 0.05), (4, 'greenland_periphery', 89717.0, -0.82, 2000.0, 0.05)),
cell AS (SELECT n_regionkey AS rid, o_orderpriority AS user_group, year(o_orderdate) AS y, month(o_orderdate) AS m, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 997e3 AS change, stddev_pop(o_totalprice) / 1e6 AS error
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4),
obs AS (SELECT region, user_group, region || '|' || user_group AS dataset_id, row_number() OVER (PARTITION BY region, user_group ORDER BY y, m) AS seq, y + (m - 1) / 12::DOUBLE AS start_date, y + m / 12::DOUBLE AS end_date, change, error, area, ac, ry, unc FROM cell JOIN reg USING (rid))"""
SHIPS = """WITH q AS (SELECT l_returnflag AS dataset_id, year(l_shipdate) AS y, quarter(l_shipdate) AS q, sum(l_quantity) / 1e3 AS change, stddev_pop(l_quantity) / 1e3 AS error FROM lineitem GROUP BY 1, 2, 3),
obs AS (SELECT dataset_id, row_number() OVER (PARTITION BY dataset_id ORDER BY y, q) AS seq, y + (q - 1) / 4::DOUBLE AS start_date, y + q / 4::DOUBLE AS end_date, change, error FROM q)"""
EVENTS = """WITH d AS (SELECT event_type AS dataset_id, CAST(ts AS DATE) AS start_date, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS change, coalesce(stddev_pop(value), 0.0) AS error FROM events WHERE dayofyear(ts) % 7 <> 0 GROUP BY 1, 2),
obs AS (SELECT dataset_id, row_number() OVER (PARTITION BY dataset_id ORDER BY start_date) AS seq, start_date, CAST(start_date + INTERVAL 1 DAY AS DATE) AS end_date, change, error FROM d)"""
PARTS = """WITH p AS (SELECT p_partkey AS dataset_ord, p_brand AS user_group, split_part(p_type, ' ', 1) AS data_group, p_size,
 CASE p_partkey % 5 WHEN 0 THEN 'alaska' WHEN 1 THEN 'western_canada_us' WHEN 2 THEN 'arctic_canada_north' WHEN 3 THEN 'arctic_canada_south' ELSE 'greenland_periphery' END AS region, CASE WHEN p_size % 3 = 0 THEN 'm' ELSE 'mwe' END AS unit FROM part)"""
SUBS = EVENTS + """, dn AS (SELECT *, coalesce(lead(start_date) OVER (PARTITION BY dataset_id ORDER BY seq), end_date) AS nx0 FROM obs),
kd AS (SELECT dn.*, kind FROM dn, (VALUES ('a'), ('b'), ('c'), ('d'), ('e')) AS v(kind) WHERE NOT (kind IN ('b', 'e') AND dayofyear(start_date) BETWEEN 10 AND 16)),
sub AS (SELECT dataset_id || '_' || kind || CASE WHEN kind = 'e' OR (kind = 'a' AND dataset_id >= 'p') THEN '_altimetry.csv' ELSE '_gravimetry.csv' END AS file_name, seq,
 CAST(start_date + INTERVAL (CASE WHEN kind IN ('c', 'd') AND dayofyear(start_date) > 14 THEN 400 ELSE 0 END) DAY AS DATE) AS start_date,
 CAST((CASE WHEN kind = 'd' AND dayofyear(start_date) <> 13 THEN nx0 ELSE end_date END) + INTERVAL (CASE WHEN kind IN ('c', 'd') AND dayofyear(start_date) > 14 THEN 400 ELSE 0 END) DAY AS DATE) AS end_date,
 change, error, CASE WHEN dataset_id < 'm' THEN 'm' ELSE 'Gt' END AS unit, CASE WHEN dataset_id < 'm' THEN 100 ELSE 10000 END AS lim FROM kd),
nx AS (SELECT *, lead(start_date) OVER (PARTITION BY file_name ORDER BY seq) AS nxt FROM sub),
chk AS (SELECT file_name, bool_and(coalesce(nxt = end_date, true)) AS dc, bool_and(abs(change) < lim) AS nd, max(coalesce(date_diff('day', end_date, nxt), 0)) AS most, bool_and(coalesce(date_diff('day', end_date, nxt) = 0 OR date_diff('day', end_date, nxt) >= 300, true)) AS neat FROM nx GROUP BY file_name),
act AS (SELECT *, CASE WHEN dc THEN 'none' WHEN most <= 2 THEN 'close' WHEN file_name LIKE '%altimetry%' THEN 'inspect' WHEN most > 350 AND neat THEN 'none' WHEN most > 350 THEN 'inspect' ELSE 'interpolate' END AS action FROM chk)"""
R = lambda *c: ", ".join(f"round({x}, 6) AS {x}" for x in c)

#: Whole years from offset o of the rows of t by key k, with sums.
YEARS = lambda t, k, o: f"""sp_ AS (SELECT {k}, min(start_date) AS lo, max(end_date) AS hi FROM {t} GROUP BY {k}),
yr_ AS (SELECT {k}, g + {o} AS s FROM sp_, (SELECT unnest(generate_series(1985, 2030)) AS g) WHERE g + {o} >= lo AND g + {o} + 1 <= hi),
yrs AS (SELECT yr_.{k}, s AS start_date, s + 1 AS end_date, coalesce(sum(change), 0) AS change, sqrt(sum(error * error)) / nullif(count(start_date), 0) AS error, count(start_date) > 0 AS covered FROM yr_ LEFT JOIN {t} AS t_ ON t_.{k} = yr_.{k} AND start_date >= s AND t_.end_date <= s + 1 GROUP BY yr_.{k}, s)"""  # noqa: E731
HALF = ORDERS + ", " + YEARS("obs", "region", "0.0::DOUBLE") + """, ann AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY start_date) AS step FROM yrs),
sp3(k, a, b) AS (VALUES (1, 1995.0::DOUBLE, 1997.0::DOUBLE), (2, 1997.0, 2000.0), (3, 1990.0, 1996.0)),
tr AS (SELECT region, k AS trend_seq, a AS ts, b AS te, avg(change) * k AS tc, 0.5 AS t_error FROM ann, sp3 GROUP BY region, k, a, b)"""
CAL = HALF + """, rng AS (SELECT region, min(start_date) AS lo, max(end_date) AS hi FROM ann GROUP BY region),
ok AS (SELECT tr.* FROM tr JOIN rng USING (region) WHERE ts >= lo AND te <= hi),
pair AS (SELECT ok.*, step, start_date, end_date, change, error, start_date >= ts AND end_date <= te AS inside FROM ok JOIN ann USING (region)),
cor AS (SELECT region, trend_seq, tc / sum(CASE WHEN inside THEN 1 ELSE 0 END) - avg(CASE WHEN inside THEN change END) AS cor FROM pair GROUP BY region, trend_seq, tc),
cal AS (SELECT pair.*, change + cor AS value, CASE WHEN inside THEN 1.0 WHEN start_date >= te THEN start_date - te + 2 ELSE ts - start_date + 1 END AS distance FROM pair JOIN cor USING (region, trend_seq))"""


def consensus(detrend: bool, addback: bool) -> str:
    mean = """ns AS (SELECT region, count(DISTINCT dataset_id) AS n FROM obs GROUP BY region),
cs AS (SELECT region, start_date FROM obs GROUP BY region, start_date HAVING count(DISTINCT dataset_id) = (SELECT n FROM ns WHERE ns.region = obs.region)),
ce AS (SELECT region, end_date FROM obs GROUP BY region, end_date HAVING count(DISTINCT dataset_id) = (SELECT n FROM ns WHERE ns.region = obs.region)),
me AS (SELECT region, dataset_id, avg(change) AS mu FROM obs WHERE (region, start_date) IN (SELECT region, start_date FROM cs) AND (region, end_date) IN (SELECT region, end_date FROM ce) GROUP BY region, dataset_id)"""
    if detrend:
        rows = mean + ", d AS (SELECT obs.region, obs.dataset_id, start_date, end_date, change - mu AS change, error FROM obs LEFT JOIN me USING (dataset_id))"
    else:
        rows = "d AS (SELECT region, dataset_id, start_date, end_date, change, error FROM obs)"
    back = " + (SELECT avg(mu) FROM me WHERE me.region = a.region)" if addback else ""
    return ORDERS + f""", {rows},
a AS (SELECT region, start_date, end_date, avg(change) AS c, count(change) AS n, sqrt(sum(error * error)) / count(error) AS e FROM d GROUP BY region, start_date, end_date),
s AS (SELECT d.region, coalesce(stddev_pop(CASE WHEN abs(d.change - a.c) > 1e-12 THEN d.change - a.c END), 0) AS s FROM d JOIN a ON d.region = a.region AND d.start_date = a.start_date AND d.end_date = a.end_date GROUP BY d.region),
con AS (SELECT a.region, a.start_date, a.end_date, c{back} AS change, sqrt(e * e + power(1.96 * s / sqrt(n), 2)) AS error, n AS n_series FROM a JOIN s USING (region))"""


CON = "SELECT region, round(start_date, 6) AS start_date, round(end_date, 6) AS end_date, round(change, 6) AS change, round(error, 6) AS error, n_series FROM con"
WEIGHED = consensus(False, False) + ", wa AS (SELECT con.*, area + ((start_date + end_date) / 2 - ry) * (ac / 100) * area AS aa FROM con JOIN reg USING (region))"
UNITED = ORDERS + """, u AS (SELECT *, CASE user_group WHEN '1-URGENT' THEN 'mwe' WHEN '2-HIGH' THEN 'M' ELSE 'Gt' END AS unit FROM obs),
f3 AS (SELECT dataset_id, min(round_even((end_date - start_date) * power(10.0, 2 - floor(log10(end_date - start_date))), 0) / power(10.0, 2 - floor(log10(end_date - start_date)))) AS finest FROM u GROUP BY dataset_id)"""
CUM = """cu AS (SELECT *, sum(change) OVER w AS cc, sqrt(sum(error * error) OVER w) AS ee, lag(end_date) OVER (PARTITION BY dataset_id ORDER BY seq) AS before FROM obs WINDOW w AS (PARTITION BY dataset_id ORDER BY seq ROWS UNBOUNDED PRECEDING)),
cum AS (SELECT dataset_id, seq AS step, 2 AS sub, end_date AS date, cc AS change, ee AS error FROM cu UNION ALL SELECT dataset_id, seq, -1, start_date, 0.0, 0.0 FROM cu WHERE before IS NULL)"""
#: Linear interpolation of cumulative sums of quarterly rows at months.
MONTHLY = SHIPS + """, sums AS (SELECT dataset_id, end_date AS d, sum(change) OVER w AS c, sum(error) OVER w AS e FROM obs WINDOW w AS (PARTITION BY dataset_id ORDER BY seq ROWS UNBOUNDED PRECEDING)),
kn AS (SELECT * FROM sums UNION ALL SELECT dataset_id, min(start_date), 0.0, 0.0 FROM obs GROUP BY dataset_id),
pt AS (SELECT dataset_id, lo + k / 12::DOUBLE AS d FROM (SELECT dataset_id, min(d) AS lo, max(d) AS hi FROM kn GROUP BY dataset_id), (SELECT unnest(generate_series(0, 400)) AS k) WHERE k <= round((hi - lo) * 12)),
ip AS (SELECT pt.dataset_id, pt.d, a.c + (pt.d - a.d) * (b.c - a.c) / (b.d - a.d) AS c, a.e + (pt.d - a.d) * (b.e - a.e) / (b.d - a.d) AS e FROM pt JOIN kn AS a ON a.dataset_id = pt.dataset_id JOIN kn AS b ON b.dataset_id = pt.dataset_id AND b.d > a.d
 WHERE NOT EXISTS (SELECT 1 FROM kn AS x WHERE x.dataset_id = a.dataset_id AND x.d > a.d AND x.d < b.d) AND pt.d > a.d - 1e-9 AND pt.d < b.d - 1e-9
 UNION ALL SELECT pt.dataset_id, pt.d, kn.c, kn.e FROM pt JOIN kn ON kn.dataset_id = pt.dataset_id AND abs(kn.d - pt.d) < 1e-9 WHERE kn.d = (SELECT max(d) FROM kn AS z WHERE z.dataset_id = kn.dataset_id)),
mo AS (SELECT dataset_id, lag(d) OVER w AS start_date, d AS end_date, c - lag(c) OVER w AS change, e - lag(e) OVER w AS error FROM ip WINDOW w AS (PARTITION BY dataset_id ORDER BY d))"""
GAPS = EVENTS + """, g1 AS (SELECT *, lead(start_date) OVER w AS nxt FROM obs WINDOW w AS (PARTITION BY dataset_id ORDER BY seq)),
own AS (SELECT dataset_id, seq * 2 AS i, start_date, end_date, change AS c, error AS e, false AS is_filled FROM g1 UNION ALL SELECT dataset_id, seq * 2 + 1, end_date, nxt, NULL, NULL, true FROM g1 WHERE nxt > end_date),
nn AS (SELECT *, row_number() OVER w AS seq, lag(c) OVER w AS c0, lead(c) OVER w AS c1, lag(e) OVER w AS e0, lead(e) OVER w AS e1, lead(start_date) OVER w AS nx FROM own WINDOW w AS (PARTITION BY dataset_id ORDER BY i))"""

SQL: dict[str, str] = {
    "scan_project_orders": "SELECT o_orderkey, year(o_orderdate) AS order_year, o_totalprice AS change FROM orders",
    "region_dimension": "SELECT * FROM (VALUES (0::BIGINT, 'global', 705644.0::DOUBLE, NULL::DOUBLE, 0.0::DOUBLE), (1, 'alaska', 86725, -0.48, 0.75), (2, 'western_canada_us', 14524, -0.54, 0.75), (3, 'arctic_canada_north', 105111, -0.07, 0.75), (4, 'arctic_canada_south', 40888, -0.08, 0.75), (5, 'greenland_periphery', 89717, -0.82, 0.75)) AS t(rgi_id, name, area, area_change, glaciological_year_start)",
    "catalogue_filter_ci": PARTS + " SELECT dataset_ord, user_group, data_group, region FROM p WHERE lower(region) = 'alaska' AND lower(data_group) = 'standard'",
    "catalogue_regions": PARTS + " SELECT DISTINCT region FROM p",
    "include_exclude_lists": PARTS + """, a AS (SELECT * FROM p WHERE region = 'alaska'), c AS (SELECT min(dataset_ord) AS dataset_ord FROM a WHERE data_group = 'PROMO' AND lower(user_group) = 'brand#13')
 SELECT dataset_ord, user_group, 'annual' AS role FROM a WHERE data_group = 'STANDARD' AND lower(user_group) <> 'brand#11' UNION ALL SELECT dataset_ord, user_group, 'trend' FROM a WHERE data_group = 'STANDARD' AND lower(user_group) <> 'brand#12'
 UNION ALL SELECT dataset_ord, user_group || '_#', 'annual' FROM a JOIN c USING (dataset_ord)""",
    "merged_group_roles": PARTS + " SELECT CASE data_group WHEN 'PROMO' THEN 'trend' ELSE 'annual' END AS role, CASE data_group WHEN 'PROMO' THEN 'demdiff' ELSE 'glaciological' END AS data_group, count(*) AS n FROM p WHERE region = 'alaska' AND data_group IN ('PROMO', 'ECONOMY') GROUP BY 1, 2",
    "first_combined_dataset": PARTS + " SELECT min(dataset_ord) AS dataset_ord, user_group FROM p WHERE region = 'alaska' AND lower(user_group) IN ('brand#11', 'brand#22') GROUP BY user_group",
    "date_window": ORDERS + " SELECT dataset_id, seq, round(change, 6) AS change FROM obs WHERE end_date <= 1998.5 AND start_date >= 1996.0",
    "date_window_gap": ORDERS + " SELECT dataset_id, seq, round(change, 6) AS change FROM obs WHERE NOT (end_date <= 1998.5 AND start_date >= 1996.0)",
    "satellite_gap": ORDERS + " SELECT dataset_id, seq, CASE region WHEN 'alaska' THEN 'gravimetry' ELSE 'altimetry' END AS data_group FROM obs WHERE region <> 'alaska' OR start_date < 1997.4 OR end_date > 1998.6",
    "contiguous_check": ORDERS + ", l AS (SELECT dataset_id, start_date, lag(end_date) OVER (PARTITION BY dataset_id ORDER BY seq) AS b FROM obs) SELECT dataset_id, bool_and(coalesce(b = start_date, true)) AS is_contiguous FROM l GROUP BY dataset_id",
    "monthly_grid_check": ORDERS + ", x AS (SELECT dataset_id, start_date, end_date FROM obs UNION ALL SELECT 'x' || dataset_id, start_date + 0.01, end_date FROM obs WHERE user_group = '1-URGENT') SELECT dataset_id, bool_and(abs(floor((start_date + 1 / 24::DOUBLE) * 12) / 12 - start_date) < 1.5e-7 AND abs(floor((end_date + 1 / 24::DOUBLE) * 12) / 12 - end_date) < 1.5e-7) AS is_monthly FROM x GROUP BY dataset_id",
    "annual_grid_check": ORDERS + ", " + YEARS("obs", "region", "0.75::DOUBLE") + """, q AS (SELECT min(start_date) AS lo, max(end_date) AS hi FROM obs WHERE region = 'alaska'),
 u AS (SELECT region, start_date, end_date FROM yrs UNION ALL SELECT 'other', g + 0.25, g + 1.25 FROM q, (SELECT unnest(generate_series(1985, 2030)) AS g) WHERE g + 0.25 >= lo AND g + 1.25 <= hi)
 SELECT region, bool_and(start_date - floor(start_date) = 0.75 AND end_date - floor(end_date) = 0.75) AS is_annual FROM u GROUP BY region""",
    "same_unit": PARTS + " SELECT data_group, count(DISTINCT unit) <= 1 AS same_unit FROM p GROUP BY data_group",
    "duplicate_dates": ORDERS + " SELECT region, count(*) <> count(DISTINCT start_date) AS has_duplicates FROM obs GROUP BY region",
    "series_extremes": ORDERS + f" SELECT dataset_id, {R('min_start', 'max_start', 'min_end', 'max_end', 'min_change', 'max_change')}, round(finest, 6) AS finest, round(coarsest, 6) AS coarsest, n FROM (SELECT dataset_id, min(round_even((end_date - start_date) * power(10.0, 2 - floor(log10(end_date - start_date))), 0) / power(10.0, 2 - floor(log10(end_date - start_date)))) AS finest, max(round_even((end_date - start_date) * power(10.0, 2 - floor(log10(end_date - start_date))), 0) / power(10.0, 2 - floor(log10(end_date - start_date)))) AS coarsest, min(start_date) AS min_start, max(start_date) AS max_start, min(end_date) AS min_end, max(end_date) AS max_end, min(change) AS min_change, max(change) AS max_change, count(*) AS n FROM obs GROUP BY dataset_id)",
    "submission_checks": SUBS + " SELECT file_name, dc AS date_check_satisfied, nd AS nodata_check_satisfied FROM chk",
    "nodata_removal": SUBS + " SELECT file_name, seq, round(change, 6) AS change FROM sub WHERE abs(change) <= lim",
    "submission_decisions": SUBS + """ SELECT file_name, action, concat_ws('; ', CASE action WHEN 'close' THEN 'end dates moved to the next start' WHEN 'interpolate' THEN 'gaps interpolated' WHEN 'inspect' THEN 'inspect manually' END, CASE WHEN NOT nd THEN 'no-data rows removed' END) AS reason_for_edit FROM act""",
    "submission_cleaned": SUBS + """, k AS (SELECT sub.*, action, lead(start_date) OVER (PARTITION BY file_name ORDER BY seq) AS nx FROM sub JOIN act USING (file_name) WHERE abs(change) <= lim),
 w AS (SELECT file_name, seq * 2 AS i, start_date, end_date, change / date_diff('day', start_date, end_date) AS c, error / date_diff('day', start_date, end_date) AS e, unit FROM k WHERE action = 'interpolate'
  UNION ALL SELECT file_name, seq * 2 + 1, end_date, nx, NULL, NULL, unit FROM k WHERE action = 'interpolate' AND date_diff('day', end_date, nx) > 1),
 v AS (SELECT file_name, i / 2.0 AS seq, start_date, coalesce(lead(start_date) OVER o, end_date) AS end_date, coalesce(c, (lag(c) OVER o + lead(c) OVER o) / 2) AS c, coalesce(e, (lag(e) OVER o + lead(e) OVER o) / 2) AS e, unit FROM w WINDOW o AS (PARTITION BY file_name ORDER BY i)),
 z AS (SELECT file_name, seq, start_date, CASE action WHEN 'close' THEN coalesce(nx, end_date) ELSE end_date END AS end_date, change, error, unit FROM k WHERE action <> 'interpolate'
  UNION ALL SELECT file_name, seq, start_date, end_date, c * date_diff('day', start_date, end_date), e * date_diff('day', start_date, end_date), unit FROM v)
 SELECT file_name, row_number() OVER (PARTITION BY file_name ORDER BY seq) AS seq, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, round(change, 6) AS change, round(error, 6) AS error, unit FROM z""",
    "outer_align_mean": ORDERS + " SELECT region, round(start_date, 6) AS start_date, round(end_date, 6) AS end_date, round(avg(change), 6) AS change, count(change) AS n_series FROM obs GROUP BY region, obs.start_date, obs.end_date",
    "extend_coalesce": ORDERS + """, a AS (SELECT * FROM obs WHERE user_group = '1-URGENT' AND start_date < 1998), b AS (SELECT * FROM obs WHERE user_group = '2-HIGH' AND start_date >= 1996)
 SELECT coalesce(a.region, b.region) AS region, round(coalesce(a.start_date, b.start_date), 6) AS start_date, round(coalesce(a.end_date, b.end_date), 6) AS end_date, round(coalesce(a.change, b.change), 6) AS change, round(coalesce(a.error, b.error), 6) AS error FROM a FULL JOIN b ON a.region = b.region AND a.start_date = b.start_date AND a.end_date = b.end_date""",
    "common_period": ORDERS + """, x AS (SELECT * FROM obs WHERE NOT (user_group = '5-LOW' AND seq % 5 = 0))
 SELECT region, 'start' AS side, round(start_date, 6) AS date FROM x GROUP BY region, start_date HAVING count(DISTINCT dataset_id) = 5 UNION ALL SELECT region, 'end', round(end_date, 6) FROM x GROUP BY region, end_date HAVING count(DISTINCT dataset_id) = 5""",
    "years_containment": ORDERS + ", " + YEARS("obs", "dataset_id", "0.75::DOUBLE") + f" SELECT dataset_id, {R('start_date', 'end_date', 'change', 'error')}, covered FROM yrs",
    "nearest_year": EVENTS + """, f AS (SELECT dataset_id, seq, year(start_date) + date_diff('day', make_date(year(start_date), 1, 1), start_date) / date_diff('day', make_date(year(start_date), 1, 1), make_date(year(start_date) + 1, 1, 1))::DOUBLE AS x FROM obs),
 c AS (SELECT unnest(generate_series(2000, 2030)) AS g) SELECT dataset_id, seq, (SELECT arg_min(g + 0.25::DOUBLE, abs(g + 0.25::DOUBLE - x) + g * 1e-9) FROM c) AS g, (SELECT arg_min(g + 0.75::DOUBLE, abs(g + 0.75::DOUBLE - 2010.25) + g * 1e-9) FROM c) AS tie FROM f""",
    "matched_indices": ORDERS + """, a AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT start_date AS v FROM obs WHERE region = 'alaska')), b AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT start_date AS v FROM obs WHERE region <> 'alaska' AND start_date >= 1996.5))
 SELECT a.i AS index_a, b.i AS index_b FROM a JOIN b USING (v)""",
    "matched_near": ORDERS + """, a AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT start_date AS v FROM obs WHERE region = 'alaska')), b AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM (SELECT DISTINCT start_date + 0.001 AS v FROM obs WHERE region <> 'alaska' AND start_date >= 1996.5))
 SELECT a.i AS index_a, b.i AS index_b FROM a JOIN b ON abs(a.v - b.v) < 0.01""",
    "distance_matrix": HALF + " SELECT region, trend_seq, step, round(CASE WHEN start_date >= te THEN start_date - te + 1 WHEN start_date < ts THEN ts - start_date ELSE 0 END, 6) AS distance FROM tr JOIN ann USING (region)",
    "time_span": ORDERS + " SELECT region, round(min(start_date), 6) AS min_start, round(max(end_date), 6) AS max_end FROM obs GROUP BY region",
    "longterm_start_vs_end": ORDERS + " SELECT dataset_id, round(min(o.start_date), 6) AS start_date, round(max(o.end_date), 6) AS end_date, round(sum(o.change), 6) AS change, round(sqrt(sum(o.error * o.error)) / count(*), 6) AS error FROM obs AS o GROUP BY dataset_id",
    "longterm_regression": ORDERS + ", " + CUM + ", sl AS (SELECT dataset_id, regr_slope(change, date) * (max(date) - min(date)) AS c FROM cum GROUP BY dataset_id), t AS (SELECT dataset_id, min(start_date) AS a, max(end_date) AS b, sqrt(sum(error * error)) / count(*) AS e FROM obs GROUP BY dataset_id) SELECT dataset_id, round(a, 6) AS start_date, round(b, 6) AS end_date, round(e, 6) AS error, round(c, 6) AS change FROM t JOIN sl USING (dataset_id)",
    "regression_slope": ORDERS + ", " + CUM + """, s AS (SELECT dataset_id, max(date) - min(date) AS w, count(*) AS n, avg(date) AS mx, avg(change) AS my, regr_slope(change, date) AS b FROM cum GROUP BY dataset_id),
 r AS (SELECT cum.dataset_id, sum(power(change - my - b * (date - mx), 2)) AS ss, sum(power(date - mx, 2)) AS xx FROM cum JOIN s USING (dataset_id) GROUP BY cum.dataset_id) SELECT s.dataset_id, round(b * w, 6) AS trend, round(sqrt(ss / (n - 2) / xx) * w, 6) AS trend_error FROM s JOIN r USING (dataset_id)""",
    "consensus_average": consensus(False, False) + " " + CON, "consensus_detrended": consensus(True, False) + " " + CON, "consensus_addback": consensus(True, True) + " " + CON,
    "global_mwe": WEIGHED + " SELECT round(start_date, 6) AS start_date, round(end_date, 6) AS end_date, round(sum(change * aa) / sum(aa), 6) AS change, round(sqrt(sum(power(error * aa, 2))) / sum(aa), 6) AS error, round(sum(aa), 3) AS area FROM wa GROUP BY wa.start_date, wa.end_date",
    "global_gt": consensus(False, False) + " SELECT round(start_date, 6) AS start_date, round(end_date, 6) AS end_date, round(sum(change), 6) AS change, round(sqrt(sum(error * error)), 6) AS error FROM con GROUP BY con.start_date, con.end_date",
    "adjusted_areas": WEIGHED + " SELECT region, round(start_date, 6) AS start_date, round(aa, 3) AS adjusted_area FROM wa",
    "cumulative_changes": ORDERS + ", " + CUM + " SELECT dataset_id, step, sub, round(date, 6) AS date, round(change, 6) AS change FROM cum",
    "cumulative_errors": ORDERS + ", " + CUM + " SELECT dataset_id, step, sub, round(error, 6) AS error FROM cum",
    "cumulative_with_gaps": ORDERS.replace("obs AS (", "ob0 AS (") + ", obs AS (SELECT * FROM ob0 WHERE seq % 9 <> 4), " + CUM + f""", br AS (SELECT *, lag(cc) OVER w AS c0, lag(ee) OVER w AS e0 FROM cu WINDOW w AS (PARTITION BY dataset_id ORDER BY seq)),
 al AS (SELECT * FROM cum UNION ALL SELECT dataset_id, seq, 0, start_date, NULL, NULL FROM br WHERE before <> start_date UNION ALL SELECT dataset_id, seq, 1, start_date, c0, e0 FROM br WHERE before <> start_date) SELECT dataset_id, step, sub, {R('date', 'change', 'error')} FROM al""",
    "derivative_from_cumulative": ORDERS + ", " + CUM + f", d AS (SELECT dataset_id, lag(date) OVER w AS start_date, date AS end_date, change - lag(change) OVER w AS change FROM cum WINDOW w AS (PARTITION BY dataset_id ORDER BY date)) SELECT dataset_id, {R('start_date', 'end_date', 'change')} FROM d WHERE start_date IS NOT NULL",
    "moving_average_window": ORDERS + """, p AS (SELECT dataset_id, start_date AS d, change, round(start_date * 12) AS m FROM obs), x AS (SELECT dataset_id, min(d) AS lo, max(d) AS hi FROM p GROUP BY dataset_id)
 SELECT a.dataset_id, round(a.d, 6) AS date, round(a.change, 6) AS change, round(CASE WHEN a.d >= lo + 13 / 24::DOUBLE - 1 AND a.d <= hi - 13 / 24::DOUBLE + 1 THEN avg(b.change) END, 6) AS average FROM p AS a JOIN p AS b ON a.dataset_id = b.dataset_id AND abs(a.m - b.m) <= 6 JOIN x ON x.dataset_id = a.dataset_id GROUP BY a.dataset_id, a.d, a.change, lo, hi""",
    "moving_average_samples": ORDERS + " SELECT dataset_id, seq, round(average, 6) AS average FROM (SELECT dataset_id, seq, avg(change) OVER (PARTITION BY dataset_id ORDER BY seq ROWS 4 PRECEDING) AS average FROM obs) WHERE seq >= 5",
    "monthly_grid_points": SHIPS + ", s AS (SELECT dataset_id, floor((min(start_date) + 0.01) * 12) / 12 AS t0, ceil((max(end_date) - 0.01) * 12) / 12 AS t1 FROM obs GROUP BY dataset_id) SELECT dataset_id, round(t0 + k / 12::DOUBLE, 6) AS date FROM s, (SELECT unnest(generate_series(0, 500)) AS k) WHERE k < ceil((t1 - t0 + 1e-5) * 12)",
    "monthly_resample": MONTHLY + f" SELECT dataset_id, {R('start_date', 'end_date', 'change', 'error')} FROM mo WHERE start_date IS NOT NULL",
    "nearest_resample": SHIPS + " SELECT p.dataset_id, round(p.start_date + 0.1, 6) AS date, round(arg_min(k.change, abs(k.start_date - p.start_date - 0.1) + k.start_date * 1e-9), 6) AS change FROM obs AS p JOIN obs AS k ON k.dataset_id = p.dataset_id GROUP BY p.dataset_id, p.start_date",
    "gap_slices": EVENTS + ", l AS (SELECT *, CASE WHEN lag(end_date) OVER w <> start_date THEN 1 ELSE 0 END AS g FROM obs WINDOW w AS (PARTITION BY dataset_id ORDER BY seq)) SELECT dataset_id, seq, CAST(1 + sum(g) OVER (PARTITION BY dataset_id ORDER BY seq) AS BIGINT) AS slice_id FROM l",
    "recombine_slices": EVENTS + " SELECT dataset_id, seq, round(change, 6) AS change FROM obs",
    "close_small_gaps": EVENTS + " SELECT dataset_id, seq, CAST(coalesce(lead(start_date) OVER (PARTITION BY dataset_id ORDER BY seq), end_date) AS VARCHAR) AS end_date FROM obs",
    "interpolate_rate_gaps": GAPS + " SELECT dataset_id, seq, CAST(start_date AS VARCHAR) AS start_date, CAST(coalesce(nx, end_date) AS VARCHAR) AS end_date, round(coalesce(c, (c0 + c1) / 2) * date_diff('day', start_date, coalesce(nx, end_date)), 6) AS change, round(coalesce(e, (e0 + e1) / 2) * date_diff('day', start_date, coalesce(nx, end_date)), 6) AS error, is_filled FROM nn",
    "decumulate": SHIPS + " SELECT dataset_id, seq, round(coalesce(change - lag(change) OVER (PARTITION BY dataset_id ORDER BY seq), 0), 6) AS change FROM obs",
    "fill_backward": EVENTS + " SELECT a.dataset_id, a.seq, round((SELECT b.change FROM obs AS b WHERE b.dataset_id = a.dataset_id AND b.seq = CAST(ceil(a.seq / 3::DOUBLE) AS BIGINT) * 3), 6) AS change FROM obs AS a",
    "fill_by_index": EVENTS + """, k AS (SELECT dataset_id, seq, change FROM obs WHERE seq % 4 = 2), x AS (SELECT o.dataset_id, o.seq, (SELECT max(seq) FROM k WHERE k.dataset_id = o.dataset_id AND k.seq <= o.seq) AS a, (SELECT min(seq) FROM k WHERE k.dataset_id = o.dataset_id AND k.seq >= o.seq) AS b FROM obs AS o)
 SELECT x.dataset_id, x.seq, round(CASE WHEN a IS NULL THEN kb.change WHEN b IS NULL OR a = b THEN ka.change ELSE ka.change + (x.seq - a) * (kb.change - ka.change) / (b - a) END, 6) AS change FROM x LEFT JOIN k AS ka ON ka.dataset_id = x.dataset_id AND ka.seq = a LEFT JOIN k AS kb ON kb.dataset_id = x.dataset_id AND kb.seq = b""",
    "fractional_year": "SELECT event_id, round(year(ts) + (epoch_us(ts) - epoch_us(make_timestamp(year(ts), 1, 1, 0, 0, 0.0))) / 1e6 / (86400.0 * date_diff('day', make_date(year(ts), 1, 1), make_date(year(ts) + 1, 1, 1))), 9) AS x FROM events",
    "fractional_year_inverse": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
    "full_years": ORDERS + ", s AS (SELECT dataset_id, min(start_date) AS lo, max(end_date) AS hi FROM obs GROUP BY dataset_id) SELECT dataset_id, g + 0.75::DOUBLE AS year FROM s, (SELECT unnest(generate_series(1985, 2030)) AS g) WHERE g + 0.75 >= lo AND g + 1.75 <= hi",
    "parsed_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
    "three_digits": "SELECT p_partkey, round_even(p_retailprice * power(10.0, 2 - floor(log10(p_retailprice))), 0) / power(10.0, 2 - floor(log10(p_retailprice))) AS x FROM part",
    "units_metres_to_gt": "SELECT p_partkey, round(p_size * 850 * (p_retailprice / 1e6), 8) AS value FROM part", "units_gt_to_metres": "SELECT p_partkey, round(1e6 * p_size / (p_retailprice * 850), 8) AS value FROM part",
    "units_metres_to_mwe": "SELECT p_partkey, round(p_size / 997::DOUBLE * 850, 8) AS value FROM part", "units_mwe_to_metres": "SELECT p_partkey, round(p_size * 997 / 850::DOUBLE, 8) AS value FROM part",
    "units_mwe_to_gt": "SELECT p_partkey, round(p_size * 997 * (p_retailprice / 1e6), 8) AS value FROM part", "units_gt_to_mwe": "SELECT p_partkey, round(1e6 * p_size / (p_retailprice * 997), 8) AS value FROM part",
    "units_gt_to_sea_level": "SELECT p_partkey, round(p_retailprice / 3.625e8 * 1e6, 8) AS value FROM part",
    "density_uncertainty": "SELECT p_partkey, CASE WHEN p_size < 4 THEN 480.0::DOUBLE WHEN p_size < 20 THEN 240 WHEN p_size < 40 THEN 120 ELSE 60 END AS value FROM part",
    "unit_to_mwe": UNITED + """ SELECT dataset_id, seq, round(CASE unit WHEN 'mwe' THEN change WHEN 'M' THEN change / 997 * 850 ELSE 1e6 * change / (area * 997) END, 9) AS change,
 round(CASE unit WHEN 'mwe' THEN error WHEN 'M' THEN abs(change / 997 * 850) * sqrt(power(error / change, 2) + power(480.0 / 850, 2)) ELSE 1e6 * (abs(change * sqrt(abs(error * error * area * area - change * change * area * area * unc * unc))) / (abs(change) * area)) / (area * 997) END, 9) AS error, 'mwe' AS unit FROM u""",
    "unit_to_gt": UNITED + """ SELECT dataset_id, seq, round(CASE unit WHEN 'mwe' THEN change * 997 * (area / 1e6) ELSE change END, 6) AS change, round(CASE unit WHEN 'mwe' THEN abs(change * 997 * (area / 1e6)) * sqrt(power(error / change, 2) + unc * unc) ELSE error END, 6) AS error, 'gt' AS unit FROM u WHERE unit <> 'M'""",
    "area_change_apply": UNITED + " SELECT dataset_id, seq, round(change * area / (area + ((start_date + end_date) / 2 - ry) * (ac / 100) * area), 6) AS change, true AS area_change_applied FROM u WHERE unit <> 'Gt'",
    "area_change_remove": UNITED + " SELECT dataset_id, seq, round(change / (area / (area + ((start_date + end_date) / 2 - ry) * (ac / 100) * area)), 6) AS change, false AS area_change_applied FROM u WHERE unit <> 'Gt'",
    "shift_month": ORDERS + " SELECT dataset_id, seq, round(floor((start_date + 0.03 + 1 / 24::DOUBLE) * 12) / 12, 6) AS start_date, round(floor((end_date + 0.05 + 1 / 24::DOUBLE) * 12) / 12, 6) AS end_date FROM obs",
    "shift_proportional": SHIPS + """, y AS (SELECT g + 0.75::DOUBLE AS g FROM (SELECT unnest(generate_series(1985, 2030)) AS g)), n AS (SELECT dataset_id, seq, change, error, (SELECT arg_min(g, abs(g - start_date) + g * 1e-9) FROM y) AS s, (SELECT arg_min(g, abs(g - start_date - 2.1) + g * 1e-9) FROM y) AS e FROM obs)
 SELECT dataset_id, seq, s AS start_date, e AS end_date, round(change / 2.1 * (e - s), 6) AS change, round(error / 2.1 * (e - s), 6) AS error FROM n""",
    "to_annual_grid": ORDERS + ", " + YEARS("obs", "dataset_id", "0.75::DOUBLE") + f" SELECT dataset_id, row_number() OVER (PARTITION BY dataset_id ORDER BY yrs.start_date) AS seq, {R('start_date', 'change', 'error')} FROM yrs",
    "spread_trend_to_years": SHIPS + " SELECT dataset_id, seq, round(start_date + k, 6) AS start_date, round(start_date + k + 1, 6) AS end_date, round(change / (seq % 4 + 1), 6) AS change, round(error / (seq % 4 + 1), 6) AS error FROM obs, (SELECT unnest(generate_series(0, 3)) AS k) WHERE k <= seq % 4",
    "longterm_trends": ORDERS + """, s AS (SELECT dataset_id, min(start_date) AS lo, max(end_date) AS hi FROM obs GROUP BY dataset_id), y AS (SELECT dataset_id, min(g + 0.75) AS a, max(g + 1.75) AS b FROM s, (SELECT unnest(generate_series(1985, 2030)) AS g) WHERE g + 0.75 >= lo AND g + 1.75 <= hi GROUP BY dataset_id)
 SELECT o.dataset_id, round(min(o.start_date), 6) AS start_date, round(max(o.end_date), 6) AS end_date, round(sum(o.change), 6) AS change, round(sqrt(sum(o.error * o.error)) / count(*), 6) AS error FROM obs AS o JOIN y ON y.dataset_id = o.dataset_id AND o.start_date >= a AND o.end_date <= b GROUP BY o.dataset_id""",
    "calibrate_trends": CAL + f" SELECT region, trend_seq, step, {R('value', 'distance')} FROM cal",
    "calibrate_combine_p2": CAL + " SELECT region, step, round(sum(value / power(distance, 2)) / sum(1 / power(distance, 2)), 6) AS change FROM cal GROUP BY region, step",
    "calibrate_combine_p0": CAL + " SELECT region, step, round(avg(value), 6) AS change FROM cal WHERE inside GROUP BY region, step",
    "calibrate_combine_outside": CAL + """, w0 AS (SELECT region, trend_seq, step, value, row_number() OVER (PARTITION BY region ORDER BY trend_seq, step) AS i, CASE WHEN sum(CASE WHEN inside THEN 1 ELSE 0 END) OVER (PARTITION BY region, step) > 0 THEN (CASE WHEN inside THEN 1.0 ELSE 0.0 END) / sum(CASE WHEN inside THEN 1 ELSE 0 END) OVER (PARTITION BY region, step) END AS w FROM cal),
 w1 AS (SELECT x.*, (SELECT max(i) FROM w0 AS a WHERE a.region = x.region AND a.i <= x.i AND a.w IS NOT NULL) AS ia, (SELECT min(i) FROM w0 AS b WHERE b.region = x.region AND b.i >= x.i AND b.w IS NOT NULL) AS ib FROM w0 AS x),
 w2 AS (SELECT w1.region, w1.step, w1.value, CASE WHEN ia IS NULL THEN kb.w WHEN ib IS NULL OR ia = ib THEN ka.w ELSE ka.w + (w1.i - ia) * (kb.w - ka.w) / (ib - ia) END AS w FROM w1 LEFT JOIN w0 AS ka ON ka.region = w1.region AND ka.i = ia LEFT JOIN w0 AS kb ON kb.region = w1.region AND kb.i = ib)
 SELECT region, step, round(sum(w * value), 6) AS change FROM w2 GROUP BY region, step""",
    "calibrate_onto_trends": CAL + " SELECT region, step, round(avg(value), 6) AS change, round(sqrt(power(0.5 * 1.0 / (8 / 3::DOUBLE + 1), 2) + coalesce(power(min(error), 2), 0)), 6) AS error FROM cal WHERE inside GROUP BY region, step",
    "metadata_json": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "slug_names": "SELECT p_partkey, replace(lower(p_brand || '_dem_differencing_' || p_name || '.csv'), ' ', '_') AS object, lower(p_type) || '_dataset_information_' || regexp_replace(p_name, '[^0-9a-zA-Z]+', '-', 'g') || '.pdf' AS information FROM part",
    "rate_bands": SHIPS + " SELECT dataset_id, seq, start_date AS x, round(change / (end_date - start_date), 6) AS y, round((change - error) / (end_date - start_date), 6) AS lo, round((change + error) / (end_date - start_date), 6) AS hi FROM obs",
    "level_bands": SHIPS + ", " + CUM + " SELECT dataset_id, step, sub, date AS x, round(change, 6) AS y, round(change - error, 6) AS lo, round(change + error, 6) AS hi FROM cum",
    "vertical_adjustment": ORDERS.replace("obs AS (", "ob0 AS (") + ", obs AS (SELECT * FROM ob0 WHERE user_group <> '1-URGENT' AND start_date >= 1997.0), " + CUM + """, rf AS (SELECT region, round(end_date * 12) AS m, sum(change) OVER (PARTITION BY region ORDER BY seq) AS lv FROM ob0 WHERE user_group = '1-URGENT'),
 ft AS (SELECT dataset_id, split_part(dataset_id, '|', 1) AS region, round(min(date) * 12) AS m0 FROM cum GROUP BY dataset_id), up AS (SELECT dataset_id, arg_max(lv, m) AS u FROM ft JOIN rf ON rf.region = ft.region AND m <= m0 GROUP BY dataset_id)
 SELECT cum.dataset_id, round(date, 6) AS date, round(change + u, 6) AS change FROM cum JOIN up USING (dataset_id)""",
}

# --- the assessment


def mean_of(p: str, src: str, keys: list[str], series: str, detrend: bool = False, addback: bool = False) -> str:
    """CTEs that end in p: the mean of the series of src by keys and dates, with its error."""
    k = ", ".join(keys)
    x = ", ".join(f"x.{c}" for c in keys)
    shared = lambda side: f"(SELECT {x}, x.{side} FROM {src} AS x JOIN {p}_n AS n USING ({k}) GROUP BY {x}, x.{side}, n.n HAVING count(DISTINCT x.{series}) = n.n)"
    back = f" + (SELECT CASE WHEN count(mu) = count(*) THEN avg(mu) END FROM {p}_m AS m WHERE {' AND '.join(f'm.{c} = a.{c}' for c in keys)})" if addback else ""
    return f"""{p}_n AS (SELECT {k}, count(DISTINCT {series}) AS n FROM {src} GROUP BY {k}),
{p}_s AS {shared("start_date")}, {p}_e AS {shared("end_date")},
{p}_i AS (SELECT {x}, x.{series}, avg(x.change) AS mu FROM {src} AS x JOIN {p}_s AS s USING ({k}, start_date) JOIN {p}_e AS e USING ({k}, end_date) GROUP BY {x}, x.{series}),
{p}_m AS (SELECT DISTINCT {x}, x.{series}, i.mu FROM {src} AS x LEFT JOIN {p}_i AS i USING ({k}, {series})),
{p}_d AS (SELECT {x}, x.{series}, x.start_date, x.end_date, x.change - {"m.mu" if detrend else "0"} AS change, x.error FROM {src} AS x JOIN {p}_m AS m USING ({k}, {series})),
{p}_a AS (SELECT {k}, start_date, end_date, avg(change) AS c, count(change) AS n, sqrt(sum(error * error)) / count(error) AS e FROM {p}_d GROUP BY {k}, start_date, end_date),
{p}_r AS (SELECT {", ".join(f"d.{c}" for c in keys)}, coalesce(stddev_pop(CASE WHEN abs(d.change - a.c) > 1e-12 THEN d.change - a.c END), 0) AS s FROM {p}_d AS d JOIN {p}_a AS a USING ({k}, start_date, end_date) GROUP BY {", ".join(f"d.{c}" for c in keys)}),
{p} AS (SELECT {", ".join(f"a.{c}" for c in keys)}, a.start_date, a.end_date, c{back} AS change, sqrt(e * e + power(1.96 * s / sqrt(n), 2)) AS error FROM {p}_a AS a JOIN {p}_r USING ({k}))"""


def homogenised(p: str, own: str, steps: str) -> str:
    """CTEs that end in p: the rows of own (region, seq, s0, e0, change, error, ys) on years from ys by the monthly steps of their region."""
    m = lambda c: f"round({c} * 12)"
    near = lambda c: f"CASE WHEN {c} - (floor({c} - ys) + ys) <= 0.5 THEN floor({c} - ys) + ys ELSE floor({c} - ys) + ys + 1 END"
    return f"""{p}_g AS (SELECT region, min(start_date) AS lo, max(end_date) AS hi FROM {steps} GROUP BY region),
{p}_p AS (SELECT o.region, o.seq AS k, o.change AS tc, s.seq AS step, s.start_date, s.end_date, s.change, {m("s.start_date")} >= {m("s0")} AND {m("s.end_date")} <= {m("e0")} AS inside
 FROM {own} AS o JOIN {p}_g AS g USING (region) JOIN {steps} AS s USING (region) WHERE {m("s0")} >= {m("lo")} AND {m("e0")} <= {m("hi")}),
{p}_c AS (SELECT region, k, tc / count(*) FILTER (WHERE inside) - avg(change) FILTER (WHERE inside) AS cor FROM {p}_p GROUP BY region, k, tc),
{p}_t AS (SELECT region, step, count(*) FILTER (WHERE inside) AS n FROM {p}_p GROUP BY region, step),
{p}_w AS (SELECT p.region, p.k, p.step, p.start_date, p.end_date, p.change + cor AS value, row_number() OVER (PARTITION BY p.region ORDER BY p.k, p.step) AS i, CASE WHEN n > 0 THEN (CASE WHEN inside THEN 1 ELSE 0 END) / n::DOUBLE END AS w
 FROM {p}_p AS p JOIN {p}_c USING (region, k) JOIN {p}_t AS t ON t.region = p.region AND t.step = p.step),
{p}_b AS (SELECT *, max(CASE WHEN w IS NOT NULL THEN i END) OVER (PARTITION BY region ORDER BY i) AS ia, min(CASE WHEN w IS NOT NULL THEN i END) OVER (PARTITION BY region ORDER BY i DESC) AS ib FROM {p}_w),
{p}_f AS (SELECT b.region, b.step, b.start_date, b.end_date, b.value, CASE WHEN ia IS NULL THEN y.w WHEN ib IS NULL OR ia = ib THEN x.w ELSE x.w + (b.i - ia) * (y.w - x.w) / (ib - ia) END AS w
 FROM {p}_b AS b LEFT JOIN {p}_w AS x ON x.region = b.region AND x.i = ia LEFT JOIN {p}_w AS y ON y.region = b.region AND y.i = ib),
{p}_o AS (SELECT region, step, start_date, end_date, sum(w * value) AS change FROM {p}_f GROUP BY ALL),
{p}_l AS (SELECT *, sum(change) OVER (PARTITION BY region ORDER BY step) AS level FROM {p}_o),
{p}_q AS (SELECT region, seq, s0, e0, error, {near("s0")} AS s1, {near("e0")} AS e1 FROM {own}),
{p}_j AS (SELECT q.*, l.step, l.start_date, l.end_date, l.change, l.level, {m("l.start_date")} >= {m("s0")} AND {m("l.end_date")} <= {m("e0")} AS was, {m("l.start_date")} >= {m("s1")} AND {m("l.end_date")} <= {m("e1")} AS now FROM {p}_q AS q JOIN {p}_l AS l USING (region)),
{p} AS (SELECT region, seq, s1 AS start_date, e1 AS end_date, sum(change) FILTER (WHERE now) AS change,
 sqrt(error * error + power(0.1 * (abs(arg_min(level, step) FILTER (WHERE was) - arg_min(level, step) FILTER (WHERE now)) + abs(arg_max(level, step) FILTER (WHERE was) - arg_max(level, step) FILTER (WHERE now))), 2)) AS error
 FROM {p}_j GROUP BY region, seq, s1, e1, error HAVING min({m("start_date")}) FILTER (WHERE now) = {m("s1")} AND max({m("end_date")}) FILTER (WHERE now) = {m("e1")})"""


_METRES = "abs(change / 997 * 850) * sqrt(power(error / change, 2) + power(240.0 / 850, 2))"
#: The assessment's input: `am` monthly annual rows by slice, `yl` rows of calendar years, `b0` monthly trend rows.
INPUT = ORDERS + ", " + YEARS("obs", "region", "0.0::DOUBLE") + """,
b0 AS (SELECT region, CASE WHEN user_group < '3' THEN 'altimetry' ELSE 'gravimetry' END AS grp, dataset_id, user_group, CASE WHEN user_group LIKE '4%' THEN 'm' ELSE 'mwe' END AS unit, seq, start_date, end_date, change, error FROM obs),
yl AS (SELECT region, 'altimetry' AS grp, region || '|years' AS dataset_id, start_date, end_date, change / 5 AS change, error / 5 AS error FROM yrs),
a0 AS (SELECT * FROM b0 WHERE NOT (user_group = '5-LOW' AND seq % 40 = 39) AND NOT (region = 'alaska' AND grp = 'altimetry' AND start_date >= 1998)),
a1 AS (SELECT *, CASE WHEN lag(end_date) OVER (PARTITION BY dataset_id ORDER BY seq) <> start_date THEN 1 ELSE 0 END AS torn FROM a0),
am AS (SELECT *, sum(torn) OVER (PARTITION BY dataset_id ORDER BY seq) AS slice FROM a1)"""
GROUPS = INPUT + f""",
sl AS (SELECT region, grp, dataset_id, unit, slice, min(start_date) AS lo, max(end_date) AS hi FROM am GROUP BY ALL),
sy AS (SELECT sl.*, g + 0.75::DOUBLE AS s FROM sl, (SELECT unnest(generate_series(1985, 2030)) AS g) WHERE g + 0.75 >= lo AND g + 1.75 <= hi),
sm AS (SELECT sy.region, sy.grp, sy.dataset_id, sy.unit, s AS start_date, s + 1 AS end_date, sum(am.change) AS change, sqrt(sum(am.error * am.error)) / count(*) AS error FROM sy JOIN am ON am.dataset_id = sy.dataset_id AND am.slice = sy.slice AND am.start_date >= s AND am.end_date <= s + 1 GROUP BY ALL),
an AS (SELECT region, grp, dataset_id, start_date, end_date, CASE unit WHEN 'm' THEN change / 997 * 850 ELSE change END AS change, CASE unit WHEN 'm' THEN {_METRES} ELSE error END AS error FROM sm
 UNION ALL SELECT region, grp, dataset_id, start_date - 0.25, end_date - 0.25, change, error FROM yl WHERE NOT (region = 'alaska' AND start_date >= 1998)),
{mean_of("va", "an", ["region", "grp"], "dataset_id", True)},
{mean_of("bk", "va", ["region"], "grp", True, True)},
tw AS (SELECT * FROM b0 WHERE start_date >= 1996 AND end_date <= 2001),
ty AS (SELECT dataset_id, min(g + 0.75) AS a, max(g + 1.75) AS b FROM (SELECT dataset_id, min(start_date) AS lo, max(end_date) AS hi FROM tw GROUP BY dataset_id), (SELECT unnest(generate_series(1985, 2030)) AS g) WHERE g + 0.75 >= lo AND g + 1.75 <= hi GROUP BY dataset_id),
tf AS (SELECT tw.*, a, b FROM tw JOIN ty USING (dataset_id) WHERE start_date >= a AND end_date <= b),
tp AS (SELECT dataset_id, end_date AS d, sum(change) OVER (PARTITION BY dataset_id ORDER BY seq) AS c FROM tf UNION ALL SELECT DISTINCT dataset_id, a, 0.0 FROM tf),
tg AS (SELECT dataset_id, regr_slope(c, d) * (max(d) - min(d)) AS change FROM tp GROUP BY dataset_id),
t1 AS (SELECT tf.region, grp, dataset_id, unit, min(start_date) AS start_date, max(end_date) AS end_date, any_value(tg.change) AS change, sqrt(sum(tf.error * tf.error)) / count(*) AS error FROM tf JOIN tg USING (dataset_id) GROUP BY tf.region, grp, dataset_id, unit),
cs(seq, a, b, a1, b1) AS (VALUES (1, 1996.5::DOUBLE, 1999.0::DOUBLE, 1996.75::DOUBLE, 1998.75::DOUBLE), (2, 1999.0, 2000.5, 1998.75, 2000.75)),
c0 AS (SELECT region, cs.seq, a, b, a1, b1, avg(change) * (b - a) * 10 AS change, 0.4::DOUBLE AS error FROM obs, cs GROUP BY region, cs.seq, a, b, a1, b1),
tr AS (SELECT region, grp, dataset_id AS trend, 1 AS seq, start_date AS ts, end_date AS te, CASE unit WHEN 'm' THEN change / 997 * 850 ELSE change END AS tc, CASE unit WHEN 'm' THEN {_METRES} ELSE error END AS e FROM t1
 UNION ALL SELECT region, grp, dataset_id, 1, min(start_date) - 0.25, max(end_date) - 0.25, sum(change), sqrt(sum(error * error)) / count(*) FROM yl WHERE start_date >= 1996 AND end_date <= 2001 GROUP BY region, grp, dataset_id
 UNION ALL SELECT region, 'demdiff', region || '|dem', seq, a1, b1, change / 997 * 850 * (b1 - a1) / (b - a), {_METRES} * (b1 - a1) / (b - a) FROM c0),
gs AS (SELECT DISTINCT region, grp FROM tr),
ev AS (SELECT gs.region, grp, start_date, end_date, change, 0.0::DOUBLE AS error FROM gs JOIN bk USING (region)),
ow AS (SELECT * FROM va UNION ALL SELECT region, grp, start_date, end_date, change - avg(change) OVER (PARTITION BY region), 0.0 FROM ev WHERE grp = 'demdiff'),
ot AS (SELECT *, coalesce(lag(end_date) OVER (PARTITION BY region, grp ORDER BY start_date) <> start_date, false) AS torn FROM ow),
oz AS (SELECT region, grp, min(start_date) AS al, max(end_date) AS ah, bool_or(torn) AS torn FROM ot GROUP BY region, grp),
sh AS (SELECT oz.region, oz.grp, greatest(al, bl) AS f, least(ah, bh) AS t FROM oz JOIN (SELECT region, grp, min(ts) AS lo, max(te) AS hi FROM tr GROUP BY region, grp) USING (region, grp)
 JOIN (SELECT region, grp, min(start_date) AS bl, max(end_date) AS bh FROM ev GROUP BY region, grp) USING (region, grp) WHERE al > lo OR ah < hi OR torn),
xa AS (SELECT x.region, x.grp, start_date, end_date, change - avg(CASE WHEN start_date >= f AND end_date <= t THEN change END) OVER (PARTITION BY x.region, x.grp) AS change, error FROM ow AS x JOIN sh USING (region, grp)),
xb AS (SELECT x.region, x.grp, start_date, end_date, change - avg(CASE WHEN start_date >= f AND end_date <= t THEN change END) OVER (PARTITION BY x.region, x.grp) AS change, error FROM ev AS x JOIN sh USING (region, grp)),
ex AS (SELECT * FROM ow WHERE NOT EXISTS (SELECT 1 FROM sh WHERE sh.region = ow.region AND sh.grp = ow.grp)
 UNION ALL SELECT coalesce(xa.region, xb.region), coalesce(xa.grp, xb.grp), coalesce(xa.start_date, xb.start_date), coalesce(xa.end_date, xb.end_date), coalesce(xa.change, xb.change), coalesce(xa.error, xb.error)
 FROM xa FULL JOIN xb ON xa.region = xb.region AND xa.grp = xb.grp AND xa.start_date = xb.start_date AND xa.end_date = xb.end_date),
er AS (SELECT region, grp, min(start_date) AS lo, max(end_date) AS hi FROM ex GROUP BY region, grp),
ip AS (SELECT tr.*, start_date, end_date, change, error FROM tr JOIN er USING (region, grp) JOIN ex USING (region, grp) WHERE ts >= lo AND te <= hi AND start_date >= ts AND end_date <= te),
iv AS (SELECT *, change + tc / count(*) OVER w - avg(change) OVER w AS value FROM ip WINDOW w AS (PARTITION BY region, grp, trend, seq)),
tl AS (SELECT region, grp, trend, avg(te - ts) AS len FROM tr GROUP BY region, grp, trend),
oo AS (SELECT region, grp, trend, start_date, end_date, avg(value) AS change, sqrt(power(arg_min(e, seq) / any_value(len), 2) + coalesce(power(any_value(error), 2), 0)) AS error FROM iv JOIN tl USING (region, grp, trend) GROUP BY region, grp, trend, start_date, end_date),
{mean_of("fi", "oo", ["region", "grp"], "trend")},
gr AS (SELECT region, grp, start_date, end_date, change * area / (area + ((start_date + end_date) / 2 - ry) * (ac / 100) * area) AS change, error FROM fi JOIN reg USING (region))"""
REGIONS = GROUPS + ", " + mean_of("re", "gr", ["region"], "grp", True, True)
#: Results in Gt: the area change goes, and the area's error comes.
IN_GT = lambda t: f"""SELECT region, start_date, end_date, c AS change, abs(c) * sqrt(power(error * 997 * (area / 1e6) / c, 2) + unc * unc) AS error
 FROM (SELECT t.*, change / (area / (area + ((start_date + end_date) / 2 - ry) * (ac / 100) * area)) * 997 * (area / 1e6) AS c, area, unc FROM {t} AS t JOIN reg USING (region))"""  # noqa: E731
CALENDAR = REGIONS + """, so AS (SELECT region, seq, start_date, end_date, change, error FROM obs WHERE user_group = '1-URGENT'),
ro AS (SELECT region, row_number() OVER (PARTITION BY region ORDER BY start_date) AS seq, start_date AS s0, end_date AS e0, change, error, 0.0::DOUBLE AS ys FROM re),
""" + homogenised("ca", "ro", "so") + ", cw AS (SELECT * FROM ca WHERE start_date >= 1996 AND end_date <= 2001)"

SQL |= {
    "assessment_groups": GROUPS + f" SELECT region, grp AS data_group, {R('start_date', 'end_date', 'change', 'error')} FROM gr",
    "assessment_regions": REGIONS + f" SELECT region, {R('start_date', 'end_date', 'change', 'error')} FROM re",
    "assessment_regions_gt": REGIONS + f" SELECT region, {R('start_date', 'end_date', 'change', 'error')} FROM ({IN_GT('re')})",
    "assessment_global": CALENDAR + f""", wt AS (SELECT cw.*, area + ((start_date + end_date) / 2 - ry) * (ac / 100) * area AS a FROM cw JOIN reg USING (region)),
 wg AS (SELECT start_date, end_date, sum(change * a) / sum(a) AS change, sqrt(sum(power(error * a, 2))) / sum(a) AS error, count(change) AS n_regions FROM wt GROUP BY start_date, end_date)
 SELECT {R('start_date', 'end_date', 'change', 'error')}, n_regions FROM wg""",
    "assessment_global_gt": CALENDAR + f", gg AS ({IN_GT('cw')}), wg AS (SELECT start_date, end_date, sum(change) AS change, sqrt(sum(error * error)) AS error, count(change) AS n_regions FROM gg GROUP BY start_date, end_date) SELECT {R('start_date', 'end_date', 'change', 'error')}, n_regions FROM wg",
    "seasonal_correction": INPUT + """, so AS (SELECT region, seq, start_date, end_date, change, error FROM obs WHERE user_group = '1-URGENT'),
yo AS (SELECT region, row_number() OVER (PARTITION BY region ORDER BY start_date) AS seq, start_date AS s0, end_date AS e0, change, error, 0.75::DOUBLE AS ys FROM yl), """ + homogenised("hy", "yo", "so") + f" SELECT region, {R('start_date', 'end_date', 'change', 'error')} FROM hy",
    "seasonal_homogenise": ORDERS + ", o2 AS (SELECT * FROM obs WHERE user_group = '2-HIGH'), " + YEARS("o2", "region", "0.5::DOUBLE") + """, so AS (SELECT region, seq, start_date, end_date, change, error FROM obs WHERE user_group = '1-URGENT'),
yo AS (SELECT region, row_number() OVER (PARTITION BY region ORDER BY start_date) AS seq, start_date AS s0, end_date AS e0, change, error, 0.75::DOUBLE AS ys FROM yrs), """ + homogenised("hy", "yo", "so") + f" SELECT region, '2-HIGH' AS series, seq, {R('start_date', 'end_date', 'change', 'error')} FROM hy",
    "extend_if_shorter": ORDERS + f""", a AS (SELECT * FROM obs WHERE user_group = '1-URGENT' AND (start_date < 1998 OR region = 'alaska')), b AS (SELECT * FROM obs WHERE user_group = '2-HIGH' AND start_date >= 1996),
 z AS (SELECT a.region, min(a.start_date) AS al, max(a.end_date) AS ah FROM a GROUP BY a.region), y AS (SELECT region, min(start_date) AS bl, max(end_date) AS bh FROM b GROUP BY region),
 s AS (SELECT region, greatest(al, bl) AS f, least(ah, bh) AS t FROM z JOIN y USING (region) WHERE al > 1995 OR ah < 2001),
 p AS (SELECT a.region, start_date, end_date, change - (SELECT avg(change) FROM a AS i WHERE i.region = s.region AND i.start_date >= f AND i.end_date <= t) AS change, error FROM a JOIN s ON a.region = s.region),
 q AS (SELECT b.region, start_date, end_date, change - (SELECT avg(change) FROM b AS i WHERE i.region = s.region AND i.start_date >= f AND i.end_date <= t) AS change, error FROM b JOIN s ON b.region = s.region),
 u AS (SELECT region, start_date, end_date, change, error FROM a WHERE region NOT IN (SELECT region FROM s) UNION ALL
 SELECT coalesce(p.region, q.region) AS region, coalesce(p.start_date, q.start_date) AS start_date, coalesce(p.end_date, q.end_date) AS end_date, coalesce(p.change, q.change) AS change, coalesce(p.error, q.error) AS error FROM p FULL JOIN q ON p.region = q.region AND p.start_date = q.start_date AND p.end_date = q.end_date)
 SELECT region, {R('start_date', 'end_date', 'change', 'error')} FROM u""",
    "to_monthly_grid": MONTHLY.replace("obs AS (SELECT dataset_id, row_number() OVER (PARTITION BY dataset_id ORDER BY y, q) AS seq, y + (q - 1) / 4::DOUBLE AS start_date, y + q / 4::DOUBLE AS end_date", "obs AS (SELECT dataset_id, row_number() OVER (PARTITION BY dataset_id ORDER BY y, q) AS seq, y + (q - 1) / 4::DOUBLE + 0.01 AS start_date, y + q / 4::DOUBLE + 0.01 AS end_date")
    .replace("pt AS (SELECT dataset_id, lo + k / 12::DOUBLE AS d FROM (SELECT dataset_id, min(d) AS lo, max(d) AS hi FROM kn GROUP BY dataset_id), (SELECT unnest(generate_series(0, 400)) AS k) WHERE k <= round((hi - lo) * 12))",
             "pt AS (SELECT dataset_id, least(greatest(floor(lo * 12) / 12 + k / 12::DOUBLE, lo), hi) AS d, floor(lo * 12) / 12 + k / 12::DOUBLE AS at FROM (SELECT dataset_id, min(d) AS lo, max(d) AS hi FROM kn GROUP BY dataset_id), (SELECT unnest(generate_series(0, 400)) AS k) WHERE k <= round((ceil(hi * 12) - floor(lo * 12))))")
    .replace("ip AS (SELECT pt.dataset_id, pt.d,", "ip AS (SELECT pt.dataset_id, pt.at AS d,").replace("UNION ALL SELECT pt.dataset_id, pt.d, kn.c", "UNION ALL SELECT pt.dataset_id, pt.at, kn.c")
    + f" SELECT dataset_id, {R('start_date', 'end_date', 'change')} FROM mo WHERE start_date IS NOT NULL",
    "imbie_style_average": MONTHLY + " SELECT 'all' AS g, CAST(round(d * 12) AS BIGINT) AS month, round(avg(c), 6) AS change, count(c) AS n_series FROM ip GROUP BY 2",
    "imbie_style_errors": MONTHLY + """, al AS (SELECT avg(c) AS mu, stddev_pop(c) AS sd FROM kn)
 SELECT 'all' AS g, CAST(round(d * 12) AS BIGINT) AS month, round(sqrt(sum(c * c) / count(c)) / sqrt(count(c)), 6) AS change, count(c) AS n_series FROM ip, al WHERE abs(c - mu) < 1.5 * sd GROUP BY 2""",
    # Quarters are evenly spaced, so the spline's ends reduce to single equations; the rest is solved along its diagonals.
    "spline_resample": "WITH RECURSIVE " + SHIPS.removeprefix("WITH ") + """, k AS (SELECT dataset_id, seq - 1 AS i, start_date AS x, change AS y, count(*) OVER (PARTITION BY dataset_id) - 1 AS n FROM obs),
 e AS (SELECT b.dataset_id, b.i, b.n, 6 * (c.y - 2 * b.y + a.y) / (0.25 * 0.25) AS r FROM k AS b JOIN k AS a ON a.dataset_id = b.dataset_id AND a.i = b.i - 1 JOIN k AS c ON c.dataset_id = b.dataset_id AND c.i = b.i + 1),
 fw AS (SELECT dataset_id, i, n, 6.0::DOUBLE AS mid, 0.0::DOUBLE AS high, r FROM e WHERE i = 1 UNION ALL
  SELECT e.dataset_id, e.i, e.n, CASE WHEN e.i = e.n - 1 THEN 6 ELSE 4 - fw.high / fw.mid END, CASE WHEN e.i = e.n - 1 THEN 0 ELSE 1 END, CASE WHEN e.i = e.n - 1 THEN e.r ELSE e.r - fw.r / fw.mid END FROM fw JOIN e ON e.dataset_id = fw.dataset_id AND e.i = fw.i + 1),
 bw AS (SELECT dataset_id, i, r / mid AS m FROM fw WHERE i = n - 1 UNION ALL SELECT fw.dataset_id, fw.i, (fw.r - fw.high * bw.m) / fw.mid FROM bw JOIN fw ON fw.dataset_id = bw.dataset_id AND fw.i = bw.i - 1),
 ms AS (SELECT dataset_id, i, m FROM bw UNION ALL SELECT a.dataset_id, 0, 2 * a.m - b.m FROM bw AS a JOIN bw AS b ON b.dataset_id = a.dataset_id AND b.i = 2 WHERE a.i = 1
  UNION ALL SELECT a.dataset_id, a.i + 1, 2 * a.m - b.m FROM bw AS a JOIN bw AS b ON b.dataset_id = a.dataset_id AND b.i = a.i - 1 WHERE a.i = (SELECT max(i) FROM bw AS z WHERE z.dataset_id = a.dataset_id)),
 pp AS (SELECT dataset_id, x + 0.125 AS date, least(i, n - 1) AS i, CASE WHEN i = n THEN 0.375 ELSE 0.125 END AS t FROM k)
 SELECT pp.dataset_id, round(date, 6) AS date, round(a.y + t * ((b.y - a.y) / 0.25 - 0.25 * (2 * p.m + q.m) / 6) + t * t * p.m / 2 + t * t * t * (q.m - p.m) / 1.5, 6) AS change
 FROM pp JOIN k AS a ON a.dataset_id = pp.dataset_id AND a.i = pp.i JOIN k AS b ON b.dataset_id = pp.dataset_id AND b.i = pp.i + 1 JOIN ms AS p ON p.dataset_id = pp.dataset_id AND p.i = pp.i JOIN ms AS q ON q.dataset_id = pp.dataset_id AND q.i = pp.i + 1""",
}

#: Which priorities' files lack which area column.
_AREA = lambda column, times, lacking: f"CASE WHEN substr(user_group, 1, 1) NOT IN {lacking} THEN seq * {times}::DOUBLE END AS {column}"
SQL["csv_by_header"] = ORDERS + f""" SELECT dataset_id, {R('start_date', 'end_date', 'change', 'error')}, {_AREA('glacier_area_reference', 2, "('3')")},
 {_AREA('glacier_area_observed', 3, "('2', '5')")} FROM obs"""

#: A run in which one region has no seasonal series.
_PARTIAL = lambda sql: sql.replace("FROM obs WHERE user_group = '1-URGENT'),", "FROM obs WHERE user_group = '1-URGENT' AND region <> 'alaska'),")
SQL["assessment_global_partial"] = _PARTIAL(SQL["assessment_global"])
SQL["assessment_violations"] = _PARTIAL(CALENDAR) + f""", no AS (SELECT ro.* FROM ro LEFT JOIN ca ON ca.region = ro.region AND ca.seq = ro.seq WHERE ca.seq IS NULL),
tn AS (SELECT tr.*, ts >= lo AND te <= hi AS covered FROM tr LEFT JOIN er USING (region, grp)),
ti AS (SELECT tn.region, tn.grp, tn.trend, tn.seq FROM tn JOIN ex ON ex.region = tn.region AND ex.grp = tn.grp WHERE start_date >= ts AND end_date <= te GROUP BY ALL)
SELECT 'calendar' AS stage, region, NULL::VARCHAR AS data_group, round(s0, 6) AS start_date, round(e0, 6) AS end_date,
 CASE WHEN region IN (SELECT region FROM so) THEN 'the seasonal series does not fill the window' ELSE 'no seasonal series' END AS reason FROM no
UNION ALL SELECT 'final', region, grp, round(ts, 6), round(te, 6),
 CASE WHEN covered THEN 'no step of the annual series lies inside the trend' ELSE 'the annual series does not reach over the trend' END FROM tn LEFT JOIN ti USING (region, grp, trend, seq) WHERE NOT coalesce(covered, false) OR ti.seq IS NULL
UNION ALL SELECT 'final', region, grp, NULL, NULL, 'no result' FROM gs WHERE NOT EXISTS (SELECT 1 FROM gr WHERE gr.region = gs.region AND gr.grp = gs.grp)
UNION ALL SELECT 'final', 'alaska', 'combined', NULL, NULL, 'no data'"""
SQL["trends_without_cover"] = HALF + """, rng AS (SELECT region, min(start_date) AS lo, max(end_date) AS hi FROM ann GROUP BY region),
m AS (SELECT region, trend_seq, ts, te FROM tr UNION ALL SELECT region, 4, 1998.25, 1998.75 FROM tr WHERE trend_seq = 2),
j AS (SELECT m.*, ts >= lo AND te <= hi AS covered, (SELECT count(*) FROM ann WHERE ann.region = m.region AND start_date >= ts AND end_date <= te) AS n FROM m JOIN rng USING (region))
SELECT region, trend_seq AS seq, round(ts, 6) AS start_date, round(te, 6) AS end_date,
 CASE WHEN covered THEN 'no step of the annual series lies inside the trend' ELSE 'the annual series does not reach over the trend' END AS reason FROM j WHERE NOT covered OR n = 0"""
SQL["vertical_adjustment_between"] = ORDERS.replace("obs AS (", "ob0 AS (") + ", obs AS (SELECT * FROM ob0 WHERE user_group <> '1-URGENT' AND start_date >= 1997.2), " + CUM + """,
 lv AS (SELECT region, sum(change) FILTER (start_date < 1997) + 0.25 * sum(change) FILTER (start_date >= 1997 AND start_date < 1998) AS u FROM ob0 WHERE user_group = '1-URGENT' GROUP BY region)
 SELECT cum.dataset_id, round(date, 6) AS date, round(change + u, 6) AS change FROM cum JOIN lv ON lv.region = split_part(cum.dataset_id, '|', 1)"""
