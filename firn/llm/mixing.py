"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, language, source). The budget flows down the tree: siblings share a node's tokens by weight, none gets
more than its subtree can give (its tokens times the largest number of epochs), and what one leaves over is shared by its
siblings in proportion to their weights. Only what all children of a node together cannot use counts as the node's own
shortage, and goes to the node's siblings. A leaf's budget is filled with whole epochs and, of one more epoch, the prefix
of that epoch's seeded order that holds as many tokens as are left: its last document is cut, so a leaf gives its budget to
the token.

A null level counts as its own child, named "" ; weights that are null, negative or not listed count as `other`. Null and
empty texts hold no tokens and are taken as often as a leaf's whole epochs, and once more if they lie in the prefix. Rows are
ordered by their hash, then their text's; repeated rows are taken alike, and if the budget ends among them each is cut
alike, which leaves fewer tokens unused than there are such rows. An empty table gives an empty result. The tree holds one
row a leaf, and the sources of one domain and language are sorted in one task; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firn.llm.common import written

LEVELS = ["domain", "lang", "source"]
#: The end of a leaf's prefix is sought in so many steps of so many hex digits: 256 sums a leaf and step.
STEP, STEPS = 2, 3
WORD = r"[^\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    """Words of a text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def _share(nodes: DataFrame, parent: list[str], budget: Column) -> DataFrame:
    """nodes (parent's columns, weight, cap) with `share`: the level at which the shares fill the budget.

    In the order of cap / weight a node is full if, with all before it full, its cap is below its part of the rest.
    """
    live = F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.0)
    rank = F.when(live > 0, F.col("cap") / live).otherwise(F.lit(float("inf")))
    nodes = nodes.withColumn("live", live).withColumn("rank", rank).withColumn("pool", budget)
    along = Window.partitionBy(*parent).orderBy("rank", *LEVELS[: len(parent) + 1][-1:])
    before, rest = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(0, Window.unboundedFollowing)
    nodes = nodes.withColumn("left", F.col("pool") - F.coalesce(F.sum(F.when(F.col("live") > 0, F.col("cap")).otherwise(0)).over(before), F.lit(0)))
    nodes = nodes.withColumn("weights", F.sum("live").over(rest))
    level = F.when(F.col("weights") > 0, F.greatest(F.col("left"), F.lit(0)) / F.col("weights"))
    nodes = nodes.withColumn("level", level).withColumn("full", (F.col("live") > 0) & (F.col("cap") <= F.round(F.col("level") * F.col("live"), 6)))
    # The first node that is not full sets the level for all after it; their own would be lower.
    nodes = nodes.withColumn("final", F.max(F.when(~F.col("full") & (F.col("live") > 0), F.col("level"))).over(Window.partitionBy(*parent)))
    share = F.when(F.col("live") <= 0, F.lit(0)).when(F.col("full"), F.col("cap")).otherwise(F.floor(F.round(F.col("final") * F.col("live"), 6)))
    return nodes.withColumn("share", F.least("cap", share.cast("bigint"))).drop("live", "rank", "pool", "left", "weights", "level", "full", "final")


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, float]], other: float, max_epochs: int, fraction: float | None = None, budget: int | None = None) -> DataFrame:
    """leaves (domain, lang, source, tokens) with `share`, the tokens each is to give of `budget` tokens or of a fraction of all."""
    if (fraction is None) == (budget is None):
        raise ValueError("either a fraction of all tokens or a budget in tokens")

    def weight(level: str) -> Column:
        own = [F.lit(x) for k, v in weights.get(level, {}).items() for x in (k, float(v))]
        listed = F.create_map(*own)[F.col(level)] if own else F.lit(None)
        return F.coalesce(F.when(listed >= 0, listed), F.lit(float(other)))

    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    top = caps.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    total = F.lit(int(budget)) if fraction is None else F.floor(F.round(F.sum("tokens").over(Window.partitionBy()) * float(fraction), 6))
    top = top.withColumn("total", total.cast("bigint"))
    share = _share(top.withColumn("weight", weight("domain")), [], F.col("total")).select("domain", F.col("share").alias("pool_"))
    for depth in (2, 3):
        parent, own = LEVELS[: depth - 1], LEVELS[:depth]
        nodes = caps.groupBy(*own).agg(F.sum("cap").alias("cap")).join(share, parent)
        share = _share(nodes.withColumn("weight", weight(own[-1])), parent, F.col("pool_")).select(*own, F.col("share").alias("pool_"))
    return leaves.join(share, LEVELS).withColumnRenamed("pool_", "share")


def _order(seed: int, epoch: Column, name: Column) -> Column:
    """A row's place in an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(name.cast("string"), F.lit(""))))


def copies(
    docs: DataFrame, domain: Column, weights: dict[str, dict[str, float]], fraction: float | None = None, max_epochs: int = 2, other: float = 1.0, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, budget: int | None = None, count: Column | None = None,
) -> DataFrame:
    """One row per row of docs: id, the levels, n_tokens, share (of its leaf), copies (in whole; 0: none), part_tokens (of one
    copy more, which the leaf's budget cuts after so many tokens), and a struct `row` of carried columns.

    fraction: of all tokens, or budget: tokens. count: tokens of a row, words of its text by default.

    An epoch's order is that of md5(seed:epoch:id). The place where a leaf's prefix ends is found by sums over parts of the
    order, each STEP hex digits of the digest finer than the one before; only rows of the last part are summed one by one.
    What is joined back to the documents is one row a leaf.
    """
    level = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    row = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []
    name, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    n_tokens = tokens(text) if count is None else F.coalesce(count.cast("bigint"), F.lit(0))
    flat = docs.select(name.alias("id"), level(domain).alias("domain"), level(F.col("lang")).alias("lang"), level(F.col("source")).alias("source"), n_tokens.alias("n_tokens"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("tie"), *row)
    lean = written(flat.drop("row"), "mixing")
    leaves = leaf_budgets(lean.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), weights, other, max_epochs, fraction, budget)
    held = F.col("tokens") > 0
    plan = leaves.select(*LEVELS, "share", F.when(held, F.expr("share div tokens")).otherwise(0).cast("int").alias("epochs"), F.when(held, F.expr("share % tokens")).otherwise(0).alias("rest"))
    # at: the digits of the part in which the prefix ends (null: there is none); before: the tokens that lie before it.
    plan = written(plan.withColumn("at", F.when(F.col("rest") > 0, F.lit(""))).withColumn("before", F.lit(0).cast("bigint")), "leaves")

    def ordered(rows: DataFrame) -> DataFrame:
        return rows.join(plan, LEVELS).withColumn("order", _order(seed, F.col("epochs"), F.col("id")))

    for digits in range(STEP, STEP * STEPS + 1, STEP):
        inside = ordered(lean).where(F.startswith("order", F.col("at"))).withColumn("part", F.substring("order", 1, digits))
        parts = inside.groupBy(*LEVELS, "part").agg(F.sum("n_tokens").alias("held"), F.first("rest").alias("rest"), F.first("before").alias("from"))
        upto = F.col("from") + F.sum("held").over(Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
        ends = parts.withColumn("upto", upto).where("upto > rest").groupBy(*LEVELS).agg(F.min(F.struct("part", (F.col("upto") - F.col("held")).alias("before"))).alias("end"))
        plan = written(plan.drop("at", "before").join(ends, LEVELS, "left").select(*LEVELS, "share", "epochs", "rest", F.col("end.part").alias("at"), F.col("end.before").alias("before")), "parts")

    # Equal rows count together, and share a cut.
    last = ordered(lean).where(F.startswith("order", F.col("at"))).groupBy(*LEVELS, "order", "tie").agg(F.sum("n_tokens").alias("held"), F.count(F.lit(1)).alias("n"), F.first("rest").alias("rest"), F.first("before").alias("from"))
    upto = F.col("from") + F.sum("held").over(Window.partitionBy(*LEVELS).orderBy("order", "tie").rowsBetween(Window.unboundedPreceding, 0))
    cut = F.floor((F.col("rest") - F.col("upto") + F.col("held")) / F.col("n")).cast("bigint")
    last = last.withColumn("upto", upto).where("upto > rest").withColumn("cut", cut).groupBy(*LEVELS).agg(F.min(F.struct("order", "tie", "cut")).alias("end"))
    plan = written(plan.join(last, LEVELS, "left").select(*LEVELS, "share", "epochs", "rest", "end"), "prefixes")
    place, end = F.struct("order", "tie"), F.struct("end.order", "end.tie")
    more = F.when(F.col("rest") == 0, 0).when(place < end, 1).otherwise(0)
    part = F.when((F.col("rest") > 0) & (place == end), F.col("end.cut")).otherwise(0)
    return ordered(flat).select("id", *LEVELS, "n_tokens", "share", (F.col("epochs") + more).cast("bigint").alias("copies"), part.cast("bigint").alias("part_tokens"), *(["row"] if carry else []))


def mixed(docs: DataFrame, domain: Column, weights: dict[str, dict[str, float]], fraction: float | None = None, place: bool = False, seed: int = 42, **kw) -> DataFrame:
    """The rows of docs as often as they are chosen, with all their columns. Texts are not cut: the document in which a leaf's
    budget ends is taken if at least half of it fits. place: with mix_epoch and mix_order, a row's place in its leaf's epoch."""
    made = copies(docs, domain, weights, fraction, carry=docs.columns, seed=seed, **kw)
    times = F.col("copies") + F.when(2 * F.col("part_tokens") >= F.greatest("n_tokens", F.lit(1)), 1).otherwise(0)
    chosen = made.withColumn("times", times.cast("int")).where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    return chosen.select("row.*", *([F.col("copy").alias("mix_epoch"), _order(seed, F.col("copy"), F.col("id")).alias("mix_order")] if place else []))
