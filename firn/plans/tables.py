"""The driver's tables as observations: monthly orders by region and priority, quarterly shipments, daily events with gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firn.functions import dims


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("seq", F.row_number().over(Window.partitionBy("dataset_id").orderBy("start_date")))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region, user_group, dataset_id, seq, start_date, end_date, change (sums over 997 thousand, which no rounding of decimals ties), error: a month of a region's priority a row."""
    t = lambda n: table(spark, sf_dir, n)
    small = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_regionkey").alias("r_regionkey"))
    rows = t("orders").join(small, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.groupBy("r_regionkey", F.col("o_orderpriority").alias("user_group"), F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg((F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / 997e3).alias("change"), (F.stddev_pop("o_totalprice") / 1e6).alias("error"))
    names = F.broadcast(dims.regions(spark).select((F.col("rgi_id") - 1).alias("r_regionkey"), F.col("name").alias("region")))
    out = rows.join(names, "r_regionkey").select("region", "user_group", F.concat_ws("|", "region", "user_group").alias("dataset_id"), (F.col("y") + (F.col("m") - 1) / 12).alias("start_date"), (F.col("y") + F.col("m") / 12).alias("end_date"), "change", "error")
    return _numbered(out)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dataset_id (return flag), seq, quarterly rows: change and error from quantities."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("dataset_id"), F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q")).agg((F.sum("l_quantity") / 1e3).alias("change"), (F.stddev_pop("l_quantity") / 1e3).alias("error"))
    return _numbered(rows.select("dataset_id", (F.col("y") + (F.col("q") - 1) / 4).alias("start_date"), (F.col("y") + F.col("q") / 4).alias("end_date"), "change", "error"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dataset_id (event type), seq, start_date and end_date as dates, daily; each seventh day is left out."""
    rows = table(spark, sf_dir, "events").where(F.dayofyear("ts") % 7 != 0).groupBy(F.col("event_type").alias("dataset_id"), F.to_date("ts").alias("start_date")).agg(F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("change"), F.coalesce(F.stddev_pop("value"), F.lit(0.0)).alias("error"))
    return _numbered(rows.select("dataset_id", "start_date", F.date_add("start_date", 1).alias("end_date"), "change", "error"))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets: a part each, its brand as user group, its type's first word as data group."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("dataset_ord"), F.col("p_brand").alias("user_group"), F.element_at(F.split("p_type", " "), 1).alias("data_group"), F.element_at(F.array(*[F.lit(r[1]) for r in dims.REGIONS[1:6]]), (F.col("p_partkey") % 5 + 1).cast("int")).alias("region"), F.when(F.col("p_size") % 3 == 0, "m").otherwise("mwe").alias("unit"))
