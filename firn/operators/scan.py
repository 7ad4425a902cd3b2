"""Running sums, neighbours and fillings along series of any length.

A series (keys, in the order of seq) is cut into blocks of BLOCK numbers of seq. A task has one block at a time, however long a
series is; of each block one row of totals goes on to the next blocks of its series, and comes back to the block's rows. So the
rows are shuffled once, as for a window over whole series, though what lies before is computed for totals and for rows: chain few
scans without a written table between them. A series within one block gets nothing from others. Keys are not null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536


def _blocks(df: DataFrame, order: str) -> DataFrame:
    return df.withColumn("block_", F.floor((F.col(order) - 1) / BLOCK))


def scanned(
    df: DataFrame, keys: list[str], order: str = "seq", sums: dict[str, Column] | None = None, before: dict[str, Column] | None = None,
    behind: dict[str, Column] | None = None, last: dict[str, Column] | None = None, first: dict[str, Column] | None = None,
) -> DataFrame:
    """df with new columns along each series: sums up to each row and with it (null where nothing was summed), values of the row
    before and of the row behind, the last value up to here that is not null, and the first from here on."""
    sums, before, behind, last, first = (x or {} for x in (sums, before, behind, last, first))
    blocks = _blocks(df, order)
    local = Window.partitionBy(*keys, "block_").orderBy(order)
    upto, rest = local.rowsBetween(Window.unboundedPreceding, 0), local.rowsBetween(0, Window.unboundedFollowing)
    one = lambda c: F.struct(c.alias("v"))  # noqa: E731  # a row's value that may be null is not the lack of a row
    found = {n: F.sum(c).over(upto) for n, c in sums.items()} | {n: F.lag(one(c)).over(local) for n, c in before.items()} | {n: F.lead(one(c)).over(local) for n, c in behind.items()}
    found |= {n: F.last(c, True).over(upto) for n, c in last.items()} | {n: F.first(c, True).over(rest) for n, c in first.items()}
    given = {n: one(c) for n, c in (before | behind).items()}
    rows = blocks.select("*", *[c.alias(n) for n, c in found.items()], *[c.alias(f"own_{n}") for n, c in given.items()])

    # A row a block: its sums and what its ends hold.
    totals = [F.max_by(n, order).alias(n) for n in (*sums, *last)] + [F.max_by(f"own_{n}", order).alias(n) for n in before]
    totals += [F.min_by(f"own_{n}", order).alias(n) for n in behind] + [F.min_by(n, order).alias(n) for n in first]
    along = Window.partitionBy(*keys).orderBy("block_")
    past, ahead = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    carry = {n: F.sum(n).over(past) for n in sums} | {n: F.lag(n).over(along) for n in before} | {n: F.lead(n).over(along) for n in behind}
    carry |= {n: F.last(n, True).over(past) for n in last} | {n: F.first(n, True).over(ahead) for n in first}
    ends = rows.groupBy(*keys, "block_").agg(*totals)
    ends = ends.select(*keys, "block_", *[c.alias(f"from_{n}") for n, c in carry.items()])
    out = rows.join(ends, [*keys, "block_"])

    def whole(n: str) -> Column:
        own, other = F.col(n), F.col(f"from_{n}")
        if n in sums:
            return F.when(own.isNull(), other).when(other.isNull(), own).otherwise(own + other)
        return F.coalesce(own, other)["v"] if n in given else F.coalesce(own, other)

    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[whole(n).alias(n) for n in found])


def counted_changes(df: DataFrame, keys: list[str], own: str, former: str, name: str, order: str = "seq") -> DataFrame:
    """df with `name`: how many rows up to here and with it, but for a series' first, have another value in `own` than the row before
    has in `former`. Changes at the seams of blocks are counted among the blocks."""
    local = Window.partitionBy(*keys, "block_").orderBy(order)
    rows = _blocks(df, order)
    rows = rows.withColumn("change_", F.coalesce((F.lag(former).over(local) != F.col(own)).cast("int"), F.lit(0)))
    rows = rows.withColumn("within_", F.sum("change_").over(local.rowsBetween(Window.unboundedPreceding, 0)))
    along = Window.partitionBy(*keys).orderBy("block_")
    ends = rows.groupBy(*keys, "block_").agg(F.max("within_").alias("n_"), F.min_by(own, order).alias("head_"), F.max_by(former, order).alias("tail_"))
    ends = ends.withColumn("seam_", F.coalesce((F.lag("tail_").over(along) != F.col("head_")).cast("int"), F.lit(0)))
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.select(*keys, "block_", (F.sum(F.col("n_") + F.col("seam_")).over(upto) - F.col("n_")).alias("from_"))
    out = rows.join(ends, [*keys, "block_"])
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("within_") + F.col("from_")).alias(name))


def filled(df: DataFrame, keys: list[str], values: list[str], order: str = "seq") -> DataFrame:
    """df with nulls of the values filled linearly in the index of the order; the ends hold the nearest value."""
    local = Window.partitionBy(*keys, "block_").orderBy(order)
    upto, rest = local.rowsBetween(Window.unboundedPreceding, 0), local.rowsBetween(0, Window.unboundedFollowing)
    rows = _blocks(df, order).withColumn("i_", F.row_number().over(local))
    point = lambda v: F.when(F.col(v).isNotNull(), F.struct(F.col("i_").cast("bigint").alias("i"), F.col(v).alias("v")))
    rows = rows.select("*", *[x for v in values for x in (F.last(point(v), True).over(upto).alias(f"a_{v}"), F.first(point(v), True).over(rest).alias(f"b_{v}"))])
    along = Window.partitionBy(*keys).orderBy("block_")
    past, ahead = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    ends = rows.groupBy(*keys, "block_").agg(F.max("i_").alias("n_"), *[x for v in values for x in (F.max_by(f"a_{v}", order).alias(f"a_{v}"), F.min_by(f"b_{v}", order).alias(f"b_{v}"))])
    ends = ends.withColumn("from_", F.coalesce(F.sum("n_").over(past), F.lit(0)))
    moved = lambda c: F.when(F.col(c).isNotNull(), F.struct((F.col(f"{c}.i") + F.col("from_")).alias("i"), F.col(f"{c}.v").alias("v")))
    carry = [x for v in values for x in (F.last(moved(f"a_{v}"), True).over(past).alias(f"past_{v}"), F.first(moved(f"b_{v}"), True).over(ahead).alias(f"ahead_{v}"))]
    rows = rows.join(ends.select(*keys, "block_", "from_", *carry), [*keys, "block_"])

    def value(v: str) -> Column:
        a, b = F.coalesce(moved(f"a_{v}"), F.col(f"past_{v}")), F.coalesce(moved(f"b_{v}"), F.col(f"ahead_{v}"))
        line = a["v"] + (F.col("i_") + F.col("from_") - a["i"]) * F.try_divide(b["v"] - a["v"], b["i"] - a["i"])
        return F.coalesce(F.col(v), F.when(a.isNull(), b["v"]).when(b.isNull(), a["v"]).otherwise(line))

    return rows.select(*[value(c).alias(c) if c in values else F.col(f"`{c}`") for c in df.columns])
