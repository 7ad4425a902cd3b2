"""Catalogue and submission sources: JSON or submission metadata to dataset rows, CSV files to observation rows."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firn.functions import dims
from firn.sources import headers

_ENTRY = "filename string, region string, user_group string, data_group string, unit string"
CATALOGUE_SCHEMA = f"base_path array<string>, datasets array<struct<{_ENTRY.replace(' string', ': string')}>>"
OBSERVATION_COLUMNS = {
    "start_date": "start_date_fractional", "end_date": "end_date_fractional", "change": "glacier_change_observed", "error": "glacier_change_uncertainty",
    "glacier_area_reference": "glacier_area_reference", "glacier_area_observed": "glacier_area_observed", "hydrological_correction_value": "hydrological_correction_value",
}
#: A source of this name means the submission system's metadata instead of a file.
PLACEHOLDER = "submission_system"


def from_json(spark: SparkSession, path: str) -> DataFrame:
    """Datasets of a catalogue file: one row an entry, in the order of the list."""
    return from_entries(spark.read.schema(CATALOGUE_SCHEMA).option("multiLine", True).json(path))


def from_dict(spark: SparkSession, catalogue: dict) -> DataFrame:
    return from_entries(spark.createDataFrame([catalogue], T._parse_datatype_string(CATALOGUE_SCHEMA)))


def from_entries(raw: DataFrame) -> DataFrame:
    """Explode a catalogue; regions and data groups must be known."""
    spark = raw.sparkSession
    flat = raw.select(F.concat_ws("/", "base_path").alias("base"), F.posexplode("datasets").alias("dataset_ord", "d")).select("base", "dataset_ord", "d.*")
    regions = F.broadcast(dims.regions(spark).select(F.col("name").alias("region"), F.lit(True).alias("r_")))
    groups = F.broadcast(dims.data_groups(spark).select(F.col("name").alias("data_group"), F.lit(True).alias("g_")))
    known = flat.withColumn("region", F.lower("region")).withColumn("data_group", F.lower("data_group")).join(regions, "region", "left").join(groups, "data_group", "left")
    ok = F.when(F.col("r_") & F.col("g_"), F.col("filename")).otherwise(F.raise_error(F.concat(F.lit("unknown region or data group: "), F.coalesce("region", F.lit("-")), F.lit(", "), F.coalesce("data_group", F.lit("-")))).cast("string"))
    path = F.concat_ws("/", "base", ok)
    return known.select(path.alias("dataset_id"), "dataset_ord", "region", "data_group", "user_group", F.lit(None).cast("string").alias("user"), F.lit("6.0").alias("rgi_version"), "unit", F.lit(False).alias("area_change_applied"), path.alias("data_filepath"), F.create_map().cast("map<string,string>").alias("additional_metadata"))


def from_list(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def submission_metadata(top: DataFrame, submissions: DataFrame) -> DataFrame:
    """Top-level entries (submission_metadata_filename, user_group, group_name, ...) joined to the fields of their submission's file, whose values win."""
    both = top.alias("t").join(submissions.withColumnRenamed("file_name", "submission_metadata_filename").alias("s"), "submission_metadata_filename", "left")
    shared = [c for c in top.columns if c in submissions.columns and c != "submission_metadata_filename"]
    rest = [F.col(f"t.{c}") for c in top.columns if c not in shared and c != "submission_metadata_filename"] + [F.col(f"s.{c}") for c in submissions.columns if c not in shared and c not in ("file_name", "submission_metadata_filename")]
    out = both.select("submission_metadata_filename", *rest, *[F.coalesce(f"s.{c}", f"t.{c}").alias(c) for c in shared])
    return out.withColumn("user_group", F.coalesce("group_name", "user_group")).drop("group_name") if "group_name" in out.columns else out


def from_submissions(metadata: DataFrame, first_units: DataFrame, regions: DataFrame) -> DataFrame:
    """Datasets of submission metadata: region by its short name in upper case, demdiff for dem_differencing, the unit of the file's first row, and all unused keys as a map."""
    used = {"region", "observational_source", "user_group", "rgi_version_select", "lead_author_name", "submission_metadata_filename"}
    other = [x for c in metadata.columns if c not in used for x in (F.lit(c), F.col(c).cast("string"))]
    extra = F.map_filter(F.create_map(*other), lambda k, v: v.isNotNull()) if other else F.create_map().cast("map<string,string>")
    rows = metadata.withColumn("extra_", extra).join(F.broadcast(regions.select(F.col("short_name").alias("s_"), F.col("name").alias("r_"))), F.upper("region") == F.col("s_"), "left")
    group = F.regexp_replace(F.lower("observational_source"), "dem_differencing", "demdiff")
    name = object_name(F.col("region"), F.col("observational_source"), F.col("user_group"))
    out = rows.select(name.alias("dataset_id"), F.col("r_").alias("region"), group.alias("data_group"), "user_group", F.col("lead_author_name").alias("user"), F.coalesce("rgi_version_select", F.lit("6.0")).alias("rgi_version"), F.col("extra_").alias("additional_metadata"))
    return out.join(first_units, "dataset_id", "left").withColumn("area_change_applied", F.lit(False))


def object_name(short_region: Column, data_group: Column, user_group: Column) -> Column:
    """{region}_{group}_{user}.csv in lower case, blanks as underscores, dem_differencing for demdiff."""
    group = F.when(F.lower(data_group) == "demdiff", F.lit("dem_differencing")).otherwise(data_group)
    return F.regexp_replace(F.lower(F.concat(F.concat_ws("_", short_region, group, user_group), F.lit(".csv"))), " ", "_")


def information_name(data_group: Column, user_group: Column) -> Column:
    return F.concat(data_group, F.lit("_dataset_information_"), F.regexp_replace(user_group, "[^0-9a-zA-Z]+", "-"), F.lit(".pdf"))


def observations(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CSV files to observation rows, each file by its own header; dataset_id is the file's path. Dates, change and error must be in
    every file; other columns may be missing in any. NaN becomes null."""
    raw = headers.by_header(spark, paths, mode="FAILFAST", needed=tuple(OBSERVATION_COLUMNS[c] for c in ("start_date", "end_date", "change", "error")))
    cols = []
    for ours, theirs in OBSERVATION_COLUMNS.items():
        value = headers.column(raw, theirs, "double")
        cols.append(F.when(~F.isnan(value), value).alias(ours))
    return raw.select(F.col("_file").alias("dataset_id"), _place(), *cols, headers.column(raw, "remarks").alias("remarks"))


def _place() -> Column:
    """The number of a row in its file."""
    return F.row_number().over(Window.partitionBy("_file").orderBy("_block", "_line")).alias("seq")


def load_new(spark: SparkSession, paths: str | list[str], table: str) -> int:
    """Load the observation files that `table` does not have yet, or not as they are now; gives their number.

    `table` is a folder: `files` lists path, length, time of modification and batch of what was loaded, `rows` has the rows by
    batch. Only new and changed files are read. A batch's rows are written before its list, to a folder of the batch's number, so a
    run that breaks off between leaves rows that the next one replaces. One run at a time loads a table.
    """
    known = _loaded_files(spark, table)
    fresh = headers.listing(spark, paths).join(known, ["path", "length", "modified"], "left_anti")
    names = [r.path for r in fresh.select("path").collect()]  # a name a file
    if names:
        batch = (known.agg(F.max("batch")).first()[0] or 0) + 1
        observations(spark, names).withColumn("dataset_id", headers.plain(F.col("dataset_id"))).write.mode("overwrite").parquet(f"{table}/rows/batch={batch}")
        now = spark.createDataFrame([(n,) for n in names], "path string")
        fresh.join(now, "path", "left_semi").withColumn("batch", F.lit(batch)).coalesce(1).write.mode("append").parquet(f"{table}/files")
    return len(names)


def _loaded_files(spark: SparkSession, table: str) -> DataFrame:
    kind = "path string, length bigint, modified timestamp, batch int"
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/files")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(f"{table}/files")


def loaded(spark: SparkSession, table: str) -> DataFrame:
    """The rows that `load_new` loaded, of each file those of its last batch. Files that are gone meanwhile keep their rows."""
    last = _loaded_files(spark, table).groupBy(F.col("path").alias("dataset_id")).agg(F.max("batch").alias("batch"))
    return spark.read.option("basePath", f"{table}/rows").parquet(f"{table}/rows").join(last, ["dataset_id", "batch"]).drop("batch")


def fetch_information(spark: SparkSession, datasets: DataFrame, store: str, folder: str) -> list[str]:
    """Copy the information file of each dataset (data_group, user_group) from a store to a folder of any file system; gives the
    paths. Files that the store lacks are an error. A few threads stream them from store to folder; none is held whole."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path, util = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.FileUtil

    def copy(name: str) -> str:
        source, target = path(f"{store.rstrip('/')}/{name}"), path(f"{folder.rstrip('/')}/{name}")
        util.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)
        return target.toString()

    names = sorted(r.name for r in datasets.select(information_name(F.col("data_group"), F.col("user_group")).alias("name")).distinct().collect())  # a name a dataset
    with ThreadPoolExecutor(headers.THREADS) as pool:
        return list(pool.map(copy, names))


def submissions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Submission CSV files, each by its own header, with their dates dd/MM/yyyy as dates: file_name, seq, start_date, end_date,
    change, error, unit, user_group, and of the optional columns those that any file has."""
    raw = headers.by_header(spark, paths)
    day = lambda c: F.try_to_timestamp(headers.column(raw, c), F.lit("dd/MM/yyyy")).cast("date").alias(c)
    number = lambda c, name: headers.column(raw, c, "double").alias(name)
    more = [number(c, c) for c in ("glacier_area_reference", "glacier_area_observed", "hydrological_correction_value", "sea_level_correction_value") if c in raw.columns]
    more += [F.col(c) for c in ("region_id", "remarks") if c in raw.columns]
    own = [headers.column(raw, c).alias(c) for c in ("unit", "user_group")]
    return raw.select(
        F.element_at(F.split("_file", "/"), -1).alias("file_name"), _place(), day("start_date"), day("end_date"),
        number("glacier_change_observed", "change"), number("glacier_change_uncertainty", "error"), *own, *more,
    )


def read(spark: SparkSession, uri: str) -> DataFrame:
    """CSV or JSON by the path's ending; others are not read."""
    if uri.endswith(".csv"):
        return spark.read.option("header", True).csv(uri)
    if uri.endswith(".json"):
        return spark.read.option("multiLine", True).json(uri)
    raise NotImplementedError(uri)


def csv_files(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Paths and contents of the CSV files below a folder whose names begin with prefix."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(path)
    return files.where(F.element_at(F.split("path", "/"), -1).startswith(prefix))


def expanded(datasets: DataFrame) -> DataFrame:
    """Datasets with a column for each key of their additional metadata; keys that are columns already keep theirs."""
    keys = sorted(r.k for r in datasets.select(F.explode(F.map_keys("additional_metadata")).alias("k")).distinct().collect())
    new = [F.try_element_at("additional_metadata", F.lit(k)).alias(k) for k in keys if k not in datasets.columns]
    return datasets.select(*[F.col(f"`{c}`") for c in datasets.columns if c != "additional_metadata"], *new)


def from_store(spark: SparkSession, store: str) -> DataFrame:
    """The datasets of a submission system's store: meta.json lists the submissions' own JSON files, beside them lie the CSV files."""
    store = store.rstrip("/")
    top = read(spark, f"{store}/meta.json").select(F.explode("datasets").alias("d")).select("d.*")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    own = spark.read.option("multiLine", True).option("pathGlobFilter", "*.json").json(store).select("*", name.alias("file_name"))
    own = own.where("file_name <> 'meta.json'").drop("datasets", "_corrupt_record")
    metadata = submission_metadata(top, own).where("region IS NOT NULL")
    raw = headers.by_header(spark, store, "*.csv")
    units = raw.groupBy(F.element_at(F.split("_file", "/"), -1).alias("dataset_id")).agg(F.min_by(headers.column(raw, "unit"), F.struct("_block", "_line")).alias("unit"))
    out = from_submissions(metadata, units, dims.regions(spark))
    path = F.concat(F.lit(f"{store}/"), F.col("dataset_id"))
    one_task = Window.partitionBy(F.lit(0)).orderBy("dataset_id")  # a catalogue is a row a dataset
    return out.withColumn("data_filepath", path).withColumn("dataset_ord", F.row_number().over(one_task) - 1)


def load(spark: SparkSession, source: str, store: str | None = None) -> DataFrame:
    """The datasets of a JSON catalogue, or with the name of the submission system those in `store`."""
    if source == PLACEHOLDER:
        if not store:
            raise ValueError("the submission system needs a store")
        return from_store(spark, store)
    return from_json(spark, source)


def with_rows(spark: SparkSession, datasets: DataFrame) -> DataFrame:
    """Observation rows of all datasets with the datasets' columns, met by the files' paths."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def qualified(path: str) -> str:
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(conf).makeQualified(at).toString()

    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    named = [(r.data_filepath, qualified(r.data_filepath)) for r in datasets.select("data_filepath").distinct().collect()]  # a row a dataset
    paths = spark.createDataFrame(named, "data_filepath string, path_ string").withColumn("path_", plain("path_"))
    rows = observations(spark, [p for _, p in named]).withColumn("path_", plain("dataset_id")).drop("dataset_id")
    return rows.join(F.broadcast(datasets.join(paths, "data_filepath")), "path_").drop("path_")


def bucket_name(version: int, names: dict[int, str]) -> str:
    if version not in names:
        raise ValueError(f"no store for version {version}")
    return names[version]


def clean_name(text: str) -> str:
    return re.sub("[^0-9a-zA-Z]+", "-", text)
