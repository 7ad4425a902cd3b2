"""Filter interaction audit: what each order of a set of filters keeps and removes, from one pass over the documents.

Every document fails some subset of the filters, its mask. What an order of filters does to a document depends on the mask
alone, so all orders follow from how many documents of a part have each mask: the counts, and the counts of good and of toxic
ones, are stacked as rows over the masks and multiplied by integer matrices with a column for each (order, step). With five
filters these are 32 by 600.

A filter may be `duplicate`: it fails texts that a smaller id has as well. Since all else about a mask follows from the text,
documents of equal text are first counted by part and labels, and only those cells meet the smallest id of their text: a text
in very many documents costs a row for each part and label.

Null texts are empty texts. A null part is the part of the empty string. A null id is no smaller than any, and none is smaller
than it, so it never fails the duplicate filter; it has no labels. Repeated rows count each; equal ids do not fail each other.
Of several label rows of a document one that says 1 is enough; a null label says nothing. An empty table gives no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.llm.common import SPACES, written

#: What a filter sees of a document: the text, its words, the number of code points.
Filter = Callable[[Column, Column, Column], Column]
DUPLICATE = "duplicate"

#: Conditions of failure, by letter.
FIVE: dict[str, Filter | str] = {
    "A": lambda text, words, n: F.size(words) < 50,
    "B": lambda text, words, n: 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
    "C": lambda text, words, n: 100 * (n - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) > 5 * n,
    "D": lambda text, words, n: text.rlike(r"[#$%&*|]"),
    "E": DUPLICATE,
}


def matrices(letters: str) -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """The columns as (order, step), and 0/1 matrices of masks by columns: bit i of a mask is the failure of filter letters[i].

    kept: fails none of the filters up to the step. removed: fails the step's filter and none before. redundant: fails the
    step's filter and one before. unique: fails the step's filter alone. shapley: the counts of `removed` over all orders, for
    the step's filter.
    """
    orders = ["".join(o) for o in itertools.permutations(letters)]
    columns = [(o, s) for o in orders for s in range(1, len(letters) + 1)]
    bit = {c: 1 << i for i, c in enumerate(letters)}
    before = np.array([sum(bit[c] for c in o[: s - 1]) for o, s in columns])
    here = np.array([bit[o[s - 1]] for o, s in columns])
    mask = np.arange(1 << len(letters))[:, None]
    hit, earlier = (mask & here) > 0, (mask & before) > 0
    found = {"kept": ~hit & ~earlier, "removed": hit & ~earlier, "redundant": hit & earlier, "unique": mask == here}
    found = {k: v.astype(np.int64) for k, v in found.items()}
    same = (here[:, None] == here[None, :]).astype(np.int64)
    return columns, found | {"shapley": found["removed"] @ same}


def histograms(docs: DataFrame, labels: DataFrame, filters: dict[str, Filter | str] = FIVE, part: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters that they fail, and how many of them are labelled good or toxic."""
    text, words, n = F.col("_text"), F.col("_words"), F.col("_n")
    seen = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("_part"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    split = F.filter(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), lambda w: w != "")
    seen = seen.select("_id", "_part", "_text", split.alias("_words"), F.char_length(text).alias("_n"))
    bits = [F.when(f(text, words, n), 1 << i).otherwise(0) for i, f in enumerate(filters.values()) if f != DUPLICATE]
    mask = sum(bits[1:], bits[0]) if bits else F.lit(0)
    rows = seen.select("_id", "_part", F.unhex(F.sha2(text, 256)).alias("_sha"), mask.alias("_mask"))
    # Repeated rows fall to one with a count, so that a document that is repeated very often is one row below.
    rows = rows.groupBy("_id", "_part", "_sha", "_mask").agg(F.count(F.lit(1)).alias("_copies"))
    said = labels.select(F.col(f"`{id_col}`").alias("_id"), *(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int").alias(f"_{c}") for c in ("quality", "toxic"))).where("_id is not null")
    said = written(said.groupBy("_id").agg(F.max("_quality").alias("_good"), F.max("_toxic").alias("_toxic")), "labels")
    # Rows without an id meet no labels; they are dealt by their text.
    apart = F.when(F.col("_id").isNull(), F.xxhash64("_sha"))
    rows = rows.withColumn("_deal", F.coalesce(apart, F.lit(0))).join(said.withColumn("_deal", F.lit(0).cast("bigint")), ["_id", "_deal"], "left").na.fill(0, ["_good", "_toxic"])

    cell = ["_sha", "_part", "_mask", "_good", "_toxic"]
    nameless = F.sum(F.when(F.col("_id").isNull(), F.col("_copies")).otherwise(0))
    cells = rows.groupBy(*cell).agg(F.sum("_copies").alias("_n"), nameless.alias("_nameless"), F.min("_id").alias("_least"), F.min_by("_copies", "_id").alias("_at_least"))
    cells = written(cells, "cells")
    if DUPLICATE in filters.values():
        bit = 1 << list(filters.values()).index(DUPLICATE)
        first = written(cells.groupBy("_sha").agg(F.min("_least").alias("_first")), "firsts")
        stays = F.col("_nameless") + F.when(F.col("_least") == F.col("_first"), F.col("_at_least")).otherwise(0)
        cells = cells.join(first, "_sha").withColumn("_stays", stays)
        two = F.array(F.struct(F.col("_mask").alias("mask"), F.col("_stays").alias("n")), F.struct((F.col("_mask") + bit).alias("mask"), (F.col("_n") - F.col("_stays")).alias("n")))
        cells = cells.select("_part", "_good", "_toxic", F.inline(two))
    else:
        cells = cells.select("_part", "_good", "_toxic", F.col("_mask").alias("mask"), F.col("_n").alias("n"))
    sums = [F.sum("n").alias("n"), *(F.sum(F.col("n") * F.col(f"_{c}")).alias(c) for c in ("good", "toxic"))]
    return cells.groupBy(F.col("_part").alias("part"), "mask").agg(*sums)


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Filter | str] = FIVE, part: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each part, order of the filters and step, with counts of the part's documents: kept after the step, removed by
    it, redundant (failing its filter, but removed before), unique_fails (failing its filter only), good_lost and toxic_lost
    (removed here and so labelled), shapley (removed by its filter, summed over all orders)."""
    columns, found = matrices("".join(filters))
    orders, steps = [o for o, _ in columns], np.array([s for _, s in columns], np.int32)
    cells = 1 << len(filters)
    # At most one entry a mask in each part.
    parts = histograms(docs, labels, filters, part, id_col, text_col).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for lo in range(0, len(whole), 64):
                batch = whole.iloc[lo : lo + 64]
                stacked = np.zeros((3, len(batch), cells), np.int64)
                for i, row in enumerate(batch["cells"]):
                    for c in row:
                        stacked[:, i, c["mask"]] = c["n"], c["good"], c["toxic"]
                count, good, toxic = stacked
                yield pd.DataFrame({
                    "part": np.repeat(batch["part"].to_numpy(object), len(columns)), "filter_order": orders * len(batch), "step": np.tile(steps, len(batch)),
                    "kept": (count @ found["kept"]).ravel(), "removed": (count @ found["removed"]).ravel(), "redundant": (count @ found["redundant"]).ravel(),
                    "unique_fails": (count @ found["unique"]).ravel(), "good_lost": (good @ found["removed"]).ravel(), "toxic_lost": (toxic @ found["removed"]).ravel(),
                    "shapley": (count @ found["shapley"]).ravel(),
                })

    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return parts.mapInPandas(multiply, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in counts))
