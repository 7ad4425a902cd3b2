"""Sinks: CSV without empty columns, partitioned stage tables, and the layout of result folders."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STAGES = ["annual_raw", "trends_raw", "annual_homogenized", "trends_homogenized", "annual_anomalies", "calibrated_series"]


def non_empty(df: DataFrame) -> DataFrame:
    """df without the columns that hold nothing but nulls."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c]])


def save_csv(df: DataFrame, path: str) -> None:
    """One file of a result series; a series is small by then."""
    non_empty(df).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def _cell(column: str) -> Column:
    """A value as it stands in a CSV file."""
    text = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))
    return F.when(text.rlike("[\",\r\n]"), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def save_files(rows: DataFrame, base: str, order: list[str], file: str = "file") -> list[str]:
    """Many CSV files in one job: each row goes to the file below `base` that its column `file` names, in order, and a file has the
    columns in which it has a value. Gives the files' names.

    One task writes all of a file, so files are as many as names. They are written beside and then moved in place by their
    names, which replaces older ones; a run that breaks off before leaves those as they were.
    """
    spark, columns = rows.sparkSession, [c for c in rows.columns if c != file]
    filled = rows.groupBy(file).agg(*[F.count(F.col(f"`{c}`")).alias(f"n_{k}") for k, c in enumerate(columns)])
    has = F.array(*[F.col(f"n_{k}") > 0 for k in range(len(columns))])
    proper = F.col(file).rlike(r"^[^/\s]") & ~F.col(file).rlike(r"(^|/)\.{0,2}(/|$)")
    name = F.when(F.coalesce(proper, F.lit(False)), F.col(file)).otherwise(F.raise_error(F.concat(F.lit("not a file's name below the base: "), F.coalesce(F.col(file), F.lit("null")))))
    files = filled.select(name.alias(file), has.alias("has_"), (F.row_number().over(Window.orderBy(file)) - 1).alias("file_"))  # a row a file
    used = lambda cells: F.array_join(F.transform(F.filter(F.arrays_zip(cells.alias("c"), F.col("has_").alias("h")), lambda x: x["h"]), lambda x: x["c"]), ",")
    heads = files.select("file_", F.lit(0).alias("kind_"), used(F.array(*[F.lit(c) for c in columns])).alias("value"))
    lines = rows.join(files, file).select("file_", F.lit(1).alias("kind_"), used(F.array(*map(_cell, columns))).alias("value"), *[F.col(c).alias(f"by_{c}") for c in order])
    every = heads.unionByName(lines, allowMissingColumns=True)
    aside = f"{base}/_writing-{uuid.uuid4().hex}"
    every.repartition("file_").sortWithinPartitions("file_", "kind_", *[f"by_{c}" for c in order]).select("file_", "value").write.partitionBy("file_").text(aside)

    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    names = {r["file_"]: r[file] for r in files.collect()}
    for number, name in names.items():
        (part,) = [x.getPath() for x in fs.listStatus(path(f"{aside}/file_={number}")) if not x.getPath().getName().startswith(("_", "."))]
        target = path(f"{base}/{name}")
        fs.mkdirs(target.getParent())
        fs.delete(target, True)
        if not fs.rename(part, target):
            raise OSError(f"{part} can't be moved to {target}")
    fs.delete(path(aside), True)
    return sorted(names.values())


def save_stages(stages: dict[str, DataFrame], path: str) -> None:
    """Rows of all stages, regions and groups in one partitioned table."""
    out = None
    for name, df in stages.items():
        part = df.withColumn("stage", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is not None:
        out.repartition("region", "data_group", "stage").write.mode("overwrite").partitionBy("region", "data_group", "stage").parquet(path)


@dataclass(frozen=True)
class Layout:
    """Paths of results below a base folder."""

    base: str

    def region(self, rgi_id: int, name: str) -> str:
        return f"{self.base}/{rgi_id}_{name}"

    def group(self, rgi_id: int, name: str, data_group: str) -> str:
        return f"{self.region(rgi_id, name)}/{data_group}"

    def csv(self, rgi_id: int, name: str, data_group: str, file: str, sub: str | None = None) -> str:
        return "/".join(x for x in (self.group(rgi_id, name, data_group), "csvs", sub, file) if x)

    def plot(self, rgi_id: int, name: str, data_group: str, file: str) -> str:
        return f"{self.group(rgi_id, name, data_group)}/plots/{file}"

    def configs(self) -> str:
        return f"{self.base}/configs"

    @classmethod
    def stamped(cls, base: str, now: datetime) -> Layout:
        return cls(f"{base}/{now:%Y-%m-%d_%H-%M}")


def final_name(data_group: str) -> str:
    return f"{data_group}_final_with_area_change.csv"


def consensus_name(calendar: str, unit: str, region: str) -> str:
    return f"consensus_{calendar}_year_{unit}_{region}.csv"


def global_name(unit: str) -> str:
    return f"global_{unit}.csv"
