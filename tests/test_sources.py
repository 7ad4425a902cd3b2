"""Sources, sinks, settings and the command line."""

import json
from datetime import datetime

import pytest
import yaml
from pyspark.sql import functions as F

from firn.__main__ import main
from firn.functions import dims
from firn.sources import catalogue, sinks
from firn.sources.config import RegionConfig, RunConfig, SeasonalMethod, YearType

HEAD = "region,user_group,start_date_fractional,end_date_fractional,glacier_change_observed,glacier_change_uncertainty,glacier_area_reference,glacier_area_observed"


def test_catalogue(spark, tmp_path):
    entry = lambda f, r: {"filename": f, "region": r, "user_group": "u", "data_group": "altimetry", "unit": "m"}
    (tmp_path / "c.json").write_text(json.dumps({"base_path": ["a", "b"], "datasets": [entry("x.csv", "iceland"), entry("y.csv", "Alaska")]}))
    got = catalogue.load(spark, str(tmp_path / "c.json")).orderBy("dataset_ord").collect()
    assert [r.data_filepath for r in got] == ["a/b/x.csv", "a/b/y.csv"] and got[1].region == "alaska"
    with pytest.raises(Exception, match="unknown region"):
        catalogue.from_dict(spark, {"base_path": ["a"], "datasets": [entry("x.csv", "atlantis")]}).collect()


def test_observations_and_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEAD}\nr,u,2000,2005,-0.3,0.45,1,1\nr,u,2005,2010,NaN,0.5,1,1\n")
    got = catalogue.observations(spark, str(tmp_path / "a.csv"))
    rows = got.orderBy("seq").collect()
    assert [(r.seq, r.start_date, r.change) for r in rows] == [(1, 2000.0, -0.3), (2, 2005.0, None)]
    sinks.save_csv(got, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert "remarks" not in back.columns and back.count() == 2
    assert catalogue.read(spark, str(tmp_path / "a.csv")).count() == 2
    assert catalogue.csv_files(spark, str(tmp_path), "a").count() == 1
    with pytest.raises(NotImplementedError):
        catalogue.read(spark, "a.pdf")
    with pytest.raises(ValueError):
        catalogue.bucket_name(3, {1: "x", 2: "y"})


def test_files_of_different_headers(spark, tmp_path):
    """Columns meet by name: order and optional columns differ, one file is compressed, one is empty, one has a mark in front."""
    import gzip

    core = "start_date_fractional,end_date_fractional,glacier_change_observed,glacier_change_uncertainty"
    (tmp_path / "a.csv").write_text(f"{core},glacier_area_reference\n2000,2001,-1.5,0.1,7\n2001,2002,-2.5,0.1,8\n")
    (tmp_path / "b [1].csv").write_text("start_date_fractional,end_date_fractional,glacier_area_reference,glacier_change_observed,glacier_change_uncertainty,remarks\n2000,2001,77,-0.2,0.3,x\n")
    (tmp_path / "c.csv.gz").write_bytes(gzip.compress(f"remarks,{core}\n\"y, z\",2000,2001,-0.4,0.5\n".encode()))
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text(f"\ufeff{core},more\n2005,2006,1,2,3\n")
    got = {(r.dataset_id.rsplit("/")[-1], r.seq): r for r in catalogue.observations(spark, str(tmp_path)).collect()}
    values = {k: (r.change, r.error, r.glacier_area_reference, r.remarks) for k, r in got.items()}
    assert values == {
        ("a.csv", 1): (-1.5, 0.1, 7.0, None), ("a.csv", 2): (-2.5, 0.1, 8.0, None), ("b%20%5B1%5D.csv", 1): (-0.2, 0.3, 77.0, "x"), ("c.csv.gz", 1): (-0.4, 0.5, None, "y, z"), ("e.csv", 1): (1.0, 2.0, None, None),
    }
    (tmp_path / "f.csv").write_text("start_date_fractional,end_date_fractional\n2000,2001\n")
    with pytest.raises(ValueError, match="f.csv lacks glacier_change_observed"):
        catalogue.observations(spark, str(tmp_path))
    (tmp_path / "f.csv").write_text(f"{core},Start_date_fractional\n1,2,3,4,5\n")
    with pytest.raises(ValueError, match="several columns"):
        catalogue.observations(spark, str(tmp_path))
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "d.csv").write_text("")
    assert catalogue.observations(spark, str(empty)).count() == 0


def test_submissions_of_different_headers(spark, tmp_path):
    head = ["start_date", "end_date", "glacier_change_observed", "glacier_change_uncertainty", "unit", "user_group"]
    row = ["01/10/2000", "30/09/2001", "1.5", "0.1", "mwe", "u"]
    for k, order in enumerate(([0, 1, 2, 3, 4, 5], [5, 4, 3, 2, 1, 0], [2, 0, 4, 1, 5, 3])):
        extra = (["glacier_area_reference"], ["9.5"]) if k == 1 else ([], [])
        (tmp_path / f"{k}.csv").write_text(",".join([head[i] for i in order] + extra[0]) + "\n" + ",".join([row[i] for i in order] + extra[1]) + "\n")
    got = catalogue.submissions(spark, str(tmp_path)).orderBy("file_name").collect()
    assert {(str(r.start_date), str(r.end_date), r.change, r.error, r.unit, r.user_group) for r in got} == {("2000-10-01", "2001-09-30", 1.5, 0.1, "mwe", "u")}
    assert [r.glacier_area_reference for r in got] == [None, 9.5, None]


def test_submissions(spark, tmp_path):
    (tmp_path / "s.csv").write_text("region_id,start_date,end_date,glacier_change_observed,glacier_change_uncertainty,unit,user_group\n1,01/10/2000,30/09/2001,1.5,0.1,mwe,u\n")
    r = catalogue.submissions(spark, str(tmp_path / "s.csv")).first()
    assert (r.file_name, str(r.start_date), r.change) == ("s.csv", "2000-10-01", 1.5)
    top = spark.createDataFrame([("f.json", "grp", "x"), ("g.json", "other", None)], "submission_metadata_filename string, group_name string, note string")
    sub = spark.createDataFrame([("f.json", "isl", "dem_differencing", "y", "who", None)], "file_name string, region string, observational_source string, note string, lead_author_name string, rgi_version_select string")
    meta = catalogue.submission_metadata(top.withColumn("user_group", F.lit(None).cast("string")), sub)
    got = catalogue.from_submissions(meta.where("region IS NOT NULL"), spark.createDataFrame([("isl_dem_differencing_grp.csv", "m")], "dataset_id string, unit string"), dims.regions(spark)).first()
    assert (got.region, got.data_group, got.user_group, got.unit, got.rgi_version, got.additional_metadata) == ("iceland", "demdiff", "grp", "m", "6.0", {"note": "y"})


def test_only_new_files_are_loaded(spark, tmp_path):
    import os

    core = "start_date_fractional,end_date_fractional,glacier_change_observed,glacier_change_uncertainty"
    folder, table = tmp_path / "in put", f"{tmp_path}/table"
    folder.mkdir()
    write = lambda name, *values: (folder / name).write_text("\n".join([core, *(f"2000,2001,{v},0.1" for v in values)]) + "\n")
    values = lambda: sorted((r.dataset_id.rsplit("/")[-1], r.change) for r in catalogue.loaded(spark, table).collect())
    write("a.csv", 1)
    write("b+%c.csv", 2, 3)
    assert catalogue.load_new(spark, str(folder), table) == 2 and catalogue.load_new(spark, str(folder), table) == 0
    assert values() == [("a.csv", 1.0), ("b+%c.csv", 2.0), ("b+%c.csv", 3.0)]
    write("c.csv", 4)
    write("a.csv", 5, 6, 7)
    os.utime(folder / "a.csv", (2e9, 2e9))
    assert catalogue.load_new(spark, str(folder), table) == 2 and catalogue.load_new(spark, str(folder), table) == 0
    assert values() == [("a.csv", 5.0), ("a.csv", 6.0), ("a.csv", 7.0), ("b+%c.csv", 2.0), ("b+%c.csv", 3.0), ("c.csv", 4.0)]
    batches = [r.batch for r in spark.read.parquet(f"{table}/rows").select("batch").distinct().collect()]
    assert sorted(batches) == [1, 2]


def test_information_files(spark, tmp_path):
    store, out = tmp_path / "store", tmp_path / "out"
    store.mkdir()
    (store / "altimetry_dataset_information_a-b.pdf").write_bytes(b"%PDF\x00\xff")
    datasets = spark.createDataFrame([("altimetry", "a b")] * 2, "data_group string, user_group string")
    (path,) = catalogue.fetch_information(spark, datasets, str(store), str(out))
    assert (out / "altimetry_dataset_information_a-b.pdf").read_bytes() == b"%PDF\x00\xff" and path.endswith("a-b.pdf")
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        catalogue.fetch_information(spark, spark.createDataFrame([("altimetry", "c")], datasets.schema), str(store), str(out))


def test_many_files_in_one_job(spark, tmp_path):
    import csv

    rows = [("x/a.csv", 2.0, 1.5, None, 'say "hi", you'), ("x/a.csv", 1.0, None, None, "two\nlines"), ("y z.csv", 3.0, None, True, None)]
    df = spark.createDataFrame(rows, "file string, start double, change double, flag boolean, note string")
    for _ in range(2):  # the second run replaces the first one's files
        assert sinks.save_files(df, str(tmp_path), ["start"]) == ["x/a.csv", "y z.csv"]
    read = lambda name: list(csv.reader((tmp_path / name).open(newline="")))
    assert read("x/a.csv") == [["start", "change", "note"], ["1.0", "", "two\nlines"], ["2.0", "1.5", 'say "hi", you']]
    assert read("y z.csv") == [["start", "flag"], ["3.0", "true"]]
    for name in ("", "/a.csv", "a/../b.csv", "a/", ".", None):  # nothing but files below the base is written or replaced
        with pytest.raises(Exception, match="not a file's name"):
            sinks.save_files(df.withColumn("file", F.lit(name).cast("string")), str(tmp_path), ["start"])
    assert {p.name for p in tmp_path.iterdir() if not p.name.startswith((".", "_writing"))} == {"x", "y z.csv"}


def test_layout():
    at = sinks.Layout.stamped("out", datetime(2024, 5, 6, 7, 8))
    assert at.csv(6, "iceland", "altimetry", "x.csv", "annual_raw") == "out/2024-05-06_07-08/6_iceland/altimetry/csvs/annual_raw/x.csv"
    assert sinks.consensus_name("calendar", "gt", "iceland") == "consensus_calendar_year_gt_iceland.csv"


def _config(tmp_path, enabled=True, name="iceland"):
    folder = tmp_path / "run2"
    folder.mkdir(exist_ok=True)
    (folder / "i.yaml").write_text(yaml.safe_dump({"region_name": name, "year_type": "glaciological", "seasonal_correction_dataset": {"user_group": "u", "data_group": "altimetry"}, "region_run_settings": {"altimetry": {"exclude_annual_datasets": ["x", None]}}}))
    top = {"version": 2, "config_folder": "run", "result_base_path": str(tmp_path), "region_config_base_path": str(tmp_path), "catalogue_path": "c", "start_year": 2000, "end_year": 2010, "rgi_area_version": 6, "datagroups_to_calculate": ["altimetry"], "method_to_extract_trends": "regression", "seasonal_correction_method": "proportional", "regions": [{"region_name": "iceland", "enable_this_region": enabled, "config_file_path": "i.yaml"}]}
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(top))
    return tmp_path / "c.yaml", top


def test_settings(tmp_path):
    path, top = _config(tmp_path)
    config = RunConfig.load(path)
    assert config.seasonal_correction_method is SeasonalMethod.PROPORTIONAL and config.region_configs[0].year_type is YearType.GLACIOLOGICAL
    assert config.region_configs[0].settings("altimetry") == {"exclude_annual_datasets": ["x"]}
    (saved,) = config.save(tmp_path / "saved")
    assert RegionConfig.load(saved) == config.region_configs[0]
    path.write_text(yaml.safe_dump(top | {"more": 1}))
    with pytest.raises(KeyError, match="more"):
        RunConfig.load(path)
    path, _ = _config(tmp_path, name="alaska")
    with pytest.raises(ValueError):
        RunConfig.load(path)


def test_command_line(tmp_path):
    path, _ = _config(tmp_path, enabled=False)
    main([str(path), "-q"])


def _run(tmp_path, **more):
    """A catalogue of two regions with monthly, yearly and coarse files, and the settings of a run over it."""
    data = tmp_path / "data"
    data.mkdir()
    datasets = []

    def add(region, user, group, rows, unit="mwe"):
        name = f"{region}_{user}_{group}.csv"
        lines = [f"{region},{user},{s!r},{e!r},{c!r},{x!r},1,1" for s, e, c, x in rows]
        (data / name).write_text("\n".join([HEAD, *lines]) + "\n")
        datasets.append({"filename": name, "region": region, "user_group": user, "data_group": group, "unit": unit})

    months = lambda first, years: [(first + k / 12, first + (k + 1) / 12) for k in range(12 * years)]
    for n, region in enumerate(("iceland", "alaska")):
        add(region, "monthly", "altimetry", [(s, e, -0.1 - 0.01 * n + 0.05 * ((k % 12) < 6), 0.02) for k, (s, e) in enumerate(months(1999.0, 12))])
        add(region, "yearly", "altimetry", [(1999.0 + k, 2000.0 + k, -1.0 + 0.1 * (k % 3), 0.2) for k in range(12)])
        add(region, "left_out", "altimetry", [(1999.0 + k, 2000.0 + k, 99.0, 0.2) for k in range(12)])
        add(region, "coarse", "demdiff", [(2000.5, 2005.0, -5.0, 0.5), (2005.0, 2009.5, -6.0, 0.5)], "m")
        add(region, "both", "combined", [(2000.75, 2009.75, -8.0, 0.5)], "m")
    (tmp_path / "catalogue.json").write_text(json.dumps({"base_path": [str(data)], "datasets": datasets}))
    folder = tmp_path / "run2"
    folder.mkdir()
    for region, years in (("iceland", "glaciological"), ("alaska", "calendar")):
        own = {
            "altimetry": {"exclude_annual_datasets": ["LEFT_OUT", None], "exclude_trend_datasets": ["left_out", "yearly"]},
            "demdiff": {"exclude_annual_datasets": ["coarse"], "include_combined_trend_datasets": ["Both"]},
        }
        settings = {"region_name": region, "year_type": years, "seasonal_correction_dataset": {"user_group": "monthly", "data_group": "altimetry"}, "region_run_settings": own}
        (folder / f"{region}.yaml").write_text(yaml.safe_dump(settings))
    top = {
        "version": 2, "config_folder": "run", "result_base_path": str(tmp_path / "out"), "region_config_base_path": str(tmp_path), "catalogue_path": str(tmp_path / "catalogue.json"),
        "start_year": 2000, "end_year": 2010, "rgi_area_version": 6, "datagroups_to_calculate": ["altimetry", "demdiff"], "method_to_extract_trends": "regression",
        "seasonal_correction_method": "seasonal_homogenization", "regions": [{"region_name": r, "enable_this_region": True, "config_file_path": f"{r}.yaml"} for r in ("iceland", "alaska")],
    }
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(top | more))
    return tmp_path / "c.yaml"


def test_run_over_a_catalogue(spark, tmp_path):
    main([str(_run(tmp_path))])
    (base,) = (tmp_path / "out").iterdir()
    read = lambda path: spark.read.option("header", True).option("inferSchema", True).csv(f"file://{base}/{path}")
    world = read("0_global/consensus/csvs/global_mwe.csv").orderBy("start_date").collect()
    assert [r.start_date for r in world] == [float(y) for y in range(2001, 2009)] or len(world) >= 7
    assert all(-1.6 < r.change < -0.5 and 0 < r.error < 3 for r in world)
    assert [r.n_regions for r in world][1:-1] == [2] * (len(world) - 2)  # of the first and last years one region may lack a window
    lost = read("violations").collect()
    assert {(r.stage, r.reason) for r in lost} <= {(a, b) for a in ("annual_homogenized", "trends_homogenized", "calendar") for b in ("the seasonal series does not fill the window",)}
    gt = read("0_global/consensus/csvs/global_gt.csv").count()
    assert gt == len(world)
    stages = spark.read.parquet(f"file://{base}/stages")
    assert {r.stage for r in stages.select("stage").distinct().collect()} == {*sinks.STAGES, "final"}
    assert stages.where("abs(change) > 50").count() == 0  # the datasets that the lists exclude
    starts = lambda region: {r.start_date % 1 for r in stages.where(f"stage = 'final' AND region = '{region}'").collect()}
    assert starts("iceland") == {0.75} and starts("alaska") == {0.0}
    assert stages.where("stage = 'trends_homogenized' AND data_group = 'demdiff'").select("trend").distinct().count() == 4  # with the combined ones
    for name in ("consensus_hydrological_year_gt_iceland.csv", "consensus_calendar_year_mwe_iceland.csv"):
        assert read(f"6_iceland/consensus/csvs/{name}").count() > 5
    assert read("1_alaska/demdiff/csvs/demdiff_final_with_area_change.csv").count() > 5


def test_cleaning_job(spark, tmp_path):
    from firn.plans import cleaning

    head = "region_id,start_date,end_date,glacier_change_observed,glacier_change_uncertainty,unit,user_group,remarks,hydrological_correction_value\n"
    line = lambda s, e, c, h: f"6,{s},{e},{c},0.5,Gt,u,x,{h}\n"
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [("01/06/2017", "01/07/2017", 30.0, 1), ("01/06/2018", "01/07/2018", 60.0, 3), ("01/09/2018", "01/10/2018", 90.0, 5)]
    (folder / "isl_gravimetry_u.csv").write_text(head + "".join(line(*r) for r in rows))
    (folder / "isl_altimetry_u.csv").write_text(head + "".join(line(*r) for r in [("01/01/2010", "31/12/2010", 1.0, 1), ("01/01/2011", "31/12/2011", -99999.0, 1)]))
    record = {r.file_name: r.action for r in cleaning.clean(spark, str(folder), str(tmp_path / "out")).collect()}
    assert record == {"isl_gravimetry_u.csv": "interpolate", "isl_altimetry_u.csv": "close"}
    got = spark.read.option("header", True).csv(str(tmp_path / "out" / "files"))
    own = got.where("file_name = 'isl_gravimetry_u.csv'").orderBy(F.col("seq").cast("int")).collect()
    # The row that bridges the missions goes; the gap of July and August 2018 is filled.
    assert [r.start_date for r in own] == ["2017-06-01", "2018-06-01", "2018-07-01", "2018-09-01"]
    assert abs(float(own[2].change) - 2.5 * 62) < 1e-6 and float(own[2].hydrological_correction_value) == 4.0 and {r.remarks for r in own} == {"x"}
    assert got.where("file_name = 'isl_altimetry_u.csv'").count() == 1
    mixed_units = spark.createDataFrame([("g_gravimetry.csv", k, f"2001-0{2 * k + 1}-01", f"2001-0{2 * k + 2}-01", 1.0, 0.1, u) for k, u in enumerate(("m", "Gt"))], "file_name string, seq int, start_date string, end_date string, change double, error double, unit string")
    mixed_units = mixed_units.withColumns({c: F.to_date(c) for c in ("start_date", "end_date")})
    with pytest.raises(Exception, match="not constant"):
        cleaning.cleaned(mixed_units).collect()


def test_store_of_a_submission_system(spark, tmp_path):
    (tmp_path / "meta.json").write_text(json.dumps({"datasets": [{"submission_metadata_filename": "a.json", "user_group": "u1", "group_name": "grp"}]}))
    (tmp_path / "a.json").write_text(json.dumps({"region": "isl", "observational_source": "altimetry", "lead_author_name": "who", "rgi_version_select": "6.0", "note": "n"}))
    (tmp_path / "isl_altimetry_grp.csv").write_text(f"{HEAD},unit\nr,u,2000,2001,-0.3,0.45,1,1,m\nr,u,2001,2002,-0.4,0.45,1,1,m\n")
    got = catalogue.load(spark, catalogue.PLACEHOLDER, str(tmp_path))
    r = got.first()
    assert (r.region, r.data_group, r.user_group, r.unit, r.dataset_id) == ("iceland", "altimetry", "grp", "m", "isl_altimetry_grp.csv")
    assert catalogue.expanded(got).first().note == "n"
    rows = catalogue.with_rows(spark, got).orderBy("seq").collect()
    assert [(x.region, x.start_date, x.change) for x in rows] == [("iceland", 2000.0, -0.3), ("iceland", 2001.0, -0.4)]
    with pytest.raises(ValueError):
        catalogue.load(spark, catalogue.PLACEHOLDER)
