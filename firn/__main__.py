"""python -m firn CONFIG [OBSERVATIONS]: run the assessment on a catalogue, or on a table of observations."""

from __future__ import annotations

import argparse
import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firn.functions import dims
from firn.operators.stored import written
from firn.plans import assessment
from firn.sources import catalogue, sinks
from firn.sources.config import RunConfig, YearType, set_up_logging

_META = ["dataset_id", "dataset_ord", "region", "data_group", "user_group", "unit"]
#: Lists of a region's settings: role, and whether it takes datasets out or adds combined ones.
_LISTS = {
    "exclude_annual_datasets": ("annual", "exclude"), "exclude_trend_datasets": ("trend", "exclude"),
    "include_combined_annual_datasets": ("annual", "include"), "include_combined_trend_datasets": ("trend", "include"),
}


def assess(spark: SparkSession, config: RunConfig, obs: DataFrame) -> dict[str, DataFrame]:
    """The results of a run by name, from rows of all datasets with their metadata (see _META)."""
    names = [r.region_name for r in config.region_configs]
    calendar = [r.region_name for r in config.region_configs if r.year_type is YearType.CALENDAR]
    regions = assessment.with_years(dims.regions(spark, config.rgi_area_version), calendar)
    obs = obs.where(F.col("region").isin(names))
    pairs = [(r, g) for r in names for g in config.datagroups_to_calculate]
    lists = [(r.region_name, g, *_LISTS[k], x) for r in config.region_configs for g in config.datagroups_to_calculate for k, v in r.settings(g).items() if k in _LISTS for x in v]
    chosen = assessment.selected(obs.select(*_META).distinct(), pairs, lists).select("dataset_id", "role", F.col("group").alias("data_group"))
    rows = obs.drop("data_group").join(F.broadcast(chosen), "dataset_id")
    wanted = [(r.region_name, r.seasonal_correction_dataset["user_group"], r.seasonal_correction_dataset["data_group"]) for r in config.region_configs]
    wanted = spark.createDataFrame(wanted, "region string, user_group string, data_group string")
    seasonal = written(assessment.seasonal_series(obs, regions, wanted), "seasonal")
    settings = assessment.Settings(config.start_year, config.end_year, config.method_to_extract_trends.value, config.seasonal_correction_method.value)
    stages = assessment.group_stages(rows, regions, settings, seasonal)
    regional = written(assessment.regional_results(stages["final"]), "regional")
    years = written(assessment.to_calendar_years(regional, seasonal, missing="report"), "calendar")
    return stages | {
        "violations": written(assessment.violations(stages, regions, settings, seasonal, regional, pairs), "violations"),
        "final_gt": assessment.in_gt(stages["final"], regions), "consensus_mwe": regional, "consensus_gt": assessment.in_gt(regional, regions), "calendar_mwe": years, "calendar_gt": assessment.in_gt(years, regions),
        "global_mwe": assessment.global_result(years, regions, config.start_year, config.end_year), "global_gt": assessment.global_result(years, regions, config.start_year, config.end_year, "gt"),
    }


def save(results: dict[str, DataFrame], config: RunConfig, layout: sinks.Layout) -> None:
    """All stages in one partitioned table, and in one job the named CSV files of groups, regions and the world."""
    stages = [*sinks.STAGES, "final"]
    sinks.save_stages({k: results[k] for k in stages}, f"{layout.base}/stages")
    results["violations"].coalesce(1).write.mode("overwrite").option("header", True).csv(f"{layout.base}/violations")
    named = lambda *at: sinks.Layout("").csv(*at).lstrip("/")
    rgi_id = {name: number for number, name, *_ in dims.REGIONS}
    regions = [r.region_name for r in config.region_configs]
    by_key = lambda names, *keys: F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), F.concat_ws("|", *keys))
    parts = []
    for unit in ("mwe", "gt"):
        parts.append(results[f"global_{unit}"].withColumn("file", F.lit(named(0, "global", "consensus", sinks.global_name(unit)))))
        for years, stage in (("hydrological", "consensus"), ("calendar", "calendar")):
            files = {r: named(rgi_id[r], r, "consensus", sinks.consensus_name(years, unit, r)) for r in regions}
            parts.append(results[f"{stage}_{unit}"].withColumn("file", by_key(files, "region")))
    files = {f"{r}|{g}": named(rgi_id[r], r, g, sinks.final_name(g)) for r in regions for g in config.datagroups_to_calculate}
    parts.append(results["final"].withColumn("file", by_key(files, "region", "data_group")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    sinks.save_files(rows, layout.base, ["start_date"])
    config.save(layout.configs())


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="firn")
    parser.add_argument("config")
    parser.add_argument("observations", nargs="?", help="a Parquet table of rows of all datasets with their metadata, instead of the catalogue")
    parser.add_argument("--store", help="where the submission system's files lie, if the catalogue's path names that system")
    parser.add_argument("-q", "--no-outputs", action="store_true")
    parser.add_argument("-d", "--debug", action="store_true")
    parsed = parser.parse_args(args)
    set_up_logging(level=logging.DEBUG if parsed.debug else logging.INFO)
    config = RunConfig.load(parsed.config)
    if not config.region_configs:
        logging.info("no region is enabled")
        return
    spark = SparkSession.builder.appName("firn").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if parsed.observations:
        obs = spark.read.parquet(parsed.observations)
    else:
        obs = catalogue.with_rows(spark, catalogue.load(spark, config.catalogue_path, parsed.store))
    results = assess(spark, config, obs)
    for r in results["violations"].groupBy("stage", "region", "reason").count().orderBy("stage", "region").collect():  # a few a region
        logging.warning("%s: %s left out in %s: %s", r.stage, r["count"], r.region, r.reason)
    if parsed.no_outputs:
        logging.info("%d global years", results["global_mwe"].count())
        return
    save(results, config, sinks.Layout.stamped(config.result_base_path, datetime.now()))


if __name__ == "__main__":
    main()
