"""CSV files read by their own headers: columns meet by name, whatever their order in each file, and may be missing in some.

Spark reads files of one scan by position. So the first line of each file is read beforehand, and nothing else of it, by a few
threads through the store's file system; files of the same header share a scan, and scans are united by name. There are as many
scans as different headers, however many files there are.
"""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Files whose first lines are read at once.
THREADS = 16


def listed(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> list[str]:
    """The files below the paths, which may be files, folders or patterns. Contents are not read."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return sorted(r.path for r in reader.load(paths).select("path").collect())  # a name a file


def listing(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """path, length and modified of the files below the paths; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths).select(plain(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified"))


def plain(path: Column) -> Column:
    """A file's path in one form, whether Spark escapes it or not."""
    decoded = F.when(path.rlike("%[0-9A-Fa-f]{2}"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file, compressed or not; none of an empty file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def columns_of(line: str, path: str) -> tuple[str, ...]:
    """Names in a header; one without a name gets that of its place. Names that differ in case alone, or not at all, are an error."""
    names = tuple(name or f"_c{i}" for i, name in enumerate(next(csv.reader([line.removeprefix("﻿")]), [])))
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"{path} has several columns of one name")
    return names


def by_header(spark: SparkSession, paths: str | list[str], pattern: str | None = None, mode: str = "PERMISSIVE", needed: tuple[str, ...] = ()) -> DataFrame:
    """Rows of CSV files as strings: all columns of any file, null where a file lacks one, and _file (its path), _block and
    _line, by which its rows are in order. A file without a `needed` column is an error. Empty files have no rows; without any
    file there are no columns but those."""
    files = listed(spark, paths, pattern)
    with ThreadPoolExecutor(THREADS) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f), files))
    headers: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if line is not None:
            names = columns_of(line, file)
            if lacking := [n for n in needed if n not in names]:
                raise ValueError(f"{file} lacks {', '.join(lacking)}")
            headers.setdefault(names, []).append(re.sub(r"([\\\[\]{}*?])", r"\\\1", file))
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line")]
    out = None
    for names, own in headers.items():
        kind = T.StructType([T.StructField(n, T.StringType()) for n in names])
        # A named header must be that of the schema still when the file is read.
        guarded = not any(re.fullmatch(r"_c\d+", n) for n in names)
        scan = spark.read.schema(kind).option("header", True).option("enforceSchema", not guarded).option("mode", mode).csv(own).select("*", *place)
        out = scan if out is None else out.unionByName(scan, allowMissingColumns=True)
    return out if out is not None else spark.createDataFrame([], "_file string, _block bigint, _line bigint")


def column(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column by name, or nulls where no file has it."""
    return (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind)
