"""Exact dedup by content sort: range partitions of the normalised text, an external sort, full comparisons of neighbours.

The order is that of the leading PREFIX_CHARS characters of the normalised text and then of its digest, so splitters stay short
however long texts are, and equal texts are adjacent. Neighbours are compared in whole, over the borders of partitions too.

Texts are equal when identical after the removal of blanks and control spaces. A null text counts as empty. Of equal texts
the row with the most code points stays, then the one with the smallest id; a null id counts as the largest. Of repeated
rows (equal id and text) one stays. An empty table gives an empty result. Other columns are ignored or, where `carry`
names them, handed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firn.llm.common import SPACES, stripped, written

#: Range splitters are sampled on so many leading characters of the normalised text, then its digest.
PREFIX_CHARS = 24
_DROP = dict.fromkeys(map(ord, SPACES))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal neighbours in a sorted partition; only the last text and one batch are held.

    The first row of the partition and the last one carry their normalised text as `edge`.
    """
    run, last_sha, last_text, held, first = -1, None, None, None, True
    for batch in batches:
        if not len(batch):
            continue
        if held is not None:
            yield held[0]
        shas, texts = batch.column("sha").to_pylist(), batch.column("body")
        runs, heads, edges = [], [], [None] * len(batch)
        for i, sha in enumerate(shas):
            body = texts[i].as_py().translate(_DROP)
            head = sha != last_sha or body != last_text
            run += head
            last_sha, last_text = sha, body
            runs.append(run)
            heads.append(head)
            if first:
                edges[0], first = body, False
        keep = [c for c in batch.schema.names if c != "body"]

        def made(edge: list[str | None], batch: pa.RecordBatch = batch, keep: list[str] = keep, runs: list[int] = runs, heads: list[bool] = heads) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(runs, pa.int32()), pa.array(heads, pa.bool_()), pa.array(edge, pa.string())], names=[*keep, "run", "head", "edge"])

        held = made(edges), made([*edges[:-1], last_text])
    if held is not None:
        yield held[1]


def sorted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows in content order: id, sha of the normalised text, pid (place in the order of partitions), run, head, edge, and a struct `row` of carried columns.

    Rows of one text may cross partitions, since length and id also take part in the splitters; so a text that a third of
    all rows hold is dealt over many tasks.
    """
    text = F.col(f"`{text_col}`")
    body = F.coalesce(text, F.lit(""))
    cols = [F.col(f"`{id_col}`").alias("id"), body.alias("body"), stripped(text).alias("norm"), F.length(body).alias("n")]
    row = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []
    keyed = docs.select(*cols, *row).select("*", F.sha2("norm", 256).alias("sha"), F.substring("norm", 1, PREFIX_CHARS).alias("prefix")).drop("norm")
    order = ["prefix", "sha", F.desc("n"), F.asc_nulls_last("id")]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    flat = ranged.select("id", "body", "sha", F.spark_partition_id().alias("pid"), *(["row"] if carry else []))
    added = [T.StructField("run", T.IntegerType()), T.StructField("head", T.BooleanType()), T.StructField("edge", T.StringType())]
    return flat.mapInArrow(_runs, T.StructType([f for f in flat.schema if f.name != "body"] + added))


def _continued(rows: DataFrame) -> DataFrame:
    """pid: partitions whose first text is the last one of the partition before them that holds rows."""
    edge = rows.where("edge IS NOT NULL").groupBy("pid").agg(F.min_by("edge", F.struct("run", ~F.col("head"))).alias("first"), F.max_by("edge", "run").alias("last"))
    edge = written(edge, "edges")
    # A number a partition, so one task can order them.
    before = edge.select("pid").withColumn("before", F.lag("pid").over(Window.orderBy("pid"))).where("before IS NOT NULL")
    met = edge.select("pid", "first").join(before, "pid").join(edge.select(F.col("pid").alias("before"), "last"), "before")
    return written(met.where("first = last").select("pid"), "continued")


def _chains(runs: DataFrame, continued: DataFrame) -> DataFrame:
    """For the first and last run of each partition: the id that stays, the size of the whole group, and whether the group starts here.

    Two rows a partition at most, so one task can order them.
    """
    edge = F.struct("run", "keeper", "size")
    ends = runs.groupBy("pid").agg(F.min(edge).alias("a"), F.max(edge).alias("b"))
    ends = ends.select("pid", F.explode(F.array_distinct(F.array("a", "b"))).alias("e")).select("pid", "e.*")
    ends = ends.join(continued.withColumn("same", F.lit(True)), "pid", "left")
    along = Window.orderBy("pid", "run")
    ends = ends.withColumn("new", ~(F.coalesce("same", F.lit(False)) & (F.col("run") == 0)))
    ends = ends.withColumn("chain", F.sum(F.col("new").cast("int")).over(along))
    whole = Window.partitionBy("chain")
    first = F.min(F.struct("pid", "run", "keeper")).over(whole)
    return ends.select("pid", "run", first["keeper"].alias("chain_keep"), F.sum("size").over(whole).alias("chain_size"), F.col("new").alias("starts"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, sha (hex digest of the normalised text)."""
    rows = written(sorted_runs(docs, id_col, text_col), "content-sort")
    runs = rows.groupBy("pid", "run").agg(F.max(F.when(F.col("head"), F.col("id"))).alias("keeper"), F.count(F.lit(1)).alias("size"))
    runs = runs.join(_chains(runs, _continued(rows)), ["pid", "run"], "left").select(
        "pid", "run", F.when(F.col("starts").isNull(), F.col("keeper")).otherwise(F.col("chain_keep")).alias("keep_id"), F.coalesce("chain_size", "size").alias("group_size"), F.coalesce("starts", F.lit(True)).alias("starts")
    )
    return rows.join(runs, ["pid", "run"]).select("id", "keep_id", "group_size", (F.col("head") & F.col("starts")).alias("kept"), "sha")


def exact_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    rows = written(sorted_runs(docs, id_col, text_col, carry=docs.columns).where("head OR edge IS NOT NULL"), "content-sort")
    again = _continued(rows).withColumn("run", F.lit(0))
    return rows.where("head").join(again, ["pid", "run"], "left_anti").select("row.*")
