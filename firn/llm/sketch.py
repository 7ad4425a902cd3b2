"""Threshold-scaled document fingerprints, in DataFrame functions alone.

A fingerprint holds the hash of every distinct shingle of five words that falls below a fixed fraction of the hash range.
Fingerprints of parts merge by union, and the share of one that another holds estimates containment however unequal the
documents are. A text of fewer words is one shingle; a text without words has an empty fingerprint. So that short texts
are not all alike, a text without a hash below the threshold keeps its least hash.

Null texts count as empty. Two empty fingerprints are alike (1), an empty and another are not (0). Null ids come first in
the order of ids; rows of one id are ordered by their text's hash. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
#: The fraction of the hash range that is retained.
FRACTION = 0.25
#: Documents are dealt in order over buckets of about so many bytes, one task each. There are FEWEST to MOST_BUCKETS; beyond
#: some 500 GB buckets grow with the table, and Spark's sort and window spill.
BUCKET_BYTES = 8_000_000
FEWEST, MOST_BUCKETS = 32, 65_536
_LEAST = -(2**63)


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def sketch(hashes: Column, shingle: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """Sorted distinct retained shingle hashes, as the upper 32 bits of the unsigned hash, from the column of word hashes."""
    n = F.size(hashes)
    each = F.transform(F.sequence(F.lit(1), n - (shingle - 1)), lambda i: F.xxhash64(*[F.element_at(hashes, i + k) for k in range(shingle)]))
    all_hashes = F.when(n >= shingle, each).when(n > 0, F.array(F.xxhash64(F.array_join(F.transform(hashes, lambda h: h.cast("string")), " ")))).otherwise(F.array().cast("array<bigint>"))
    bound = F.lit(_LEAST + math.floor(fraction * 2**64))
    # A one-element array binds the hashes, so that they are not computed twice.
    kept = F.transform(F.array(all_hashes), lambda a: F.when(F.exists(a, lambda h: h < bound), F.filter(a, lambda h: h < bound)).when(F.size(a) > 0, F.array(F.array_min(a))).otherwise(a))[0]
    return F.array_sort(F.array_distinct(F.transform(kept, lambda h: F.shiftrightunsigned(h.bitwiseXOR(F.lit(_LEAST)), 32))))


def printed(values: Column) -> Column:
    """A fingerprint as text, eight hex digits a hash."""
    return F.lower(F.array_join(F.transform(values, lambda h: F.lpad(F.hex(h), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles (0 to 1) of two fingerprints."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b holds."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merged(sketches: DataFrame, keys: list[str], column: str = "sketch", fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of groups of documents: the union of theirs, partly united before the shuffle."""
    bound = F.lit(math.floor(fraction * 2**32))
    one = sketches.select(*keys, F.explode(column).alias("h")).distinct().groupBy(*keys).agg(F.array_sort(F.collect_set("h")).alias(column))
    below = F.filter(column, lambda h: h < bound)
    return one.withColumn(column, F.when(F.size(below) > 0, below).otherwise(F.col(column)))


def _bucket(docs: DataFrame, id_col: str, n: int) -> Column:
    """The range of a row's id among n of about equal count; the splitters are n numbers at most, searched by halves."""
    ids = docs.select(F.col(id_col).cast("bigint").alias("id")).where("id IS NOT NULL")
    at = ids.agg(F.percentile_approx("id", [k / n for k in range(1, n)] or [0.5], max(10_000, 4 * n)).alias("at")).first().at if n > 1 else []
    at = sorted(set(at or []))
    steps = max(1, len(at)).bit_length()
    bounds = F.array(*[F.lit(int(x)) for x in at + [2**63 - 1] * (2**steps - len(at))])
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LEAST))
    halves = F.array(*[F.lit(2**s) for s in reversed(range(steps))])
    return F.aggregate(halves, F.lit(0), lambda low, half: F.when(F.element_at(bounds, low + half) <= key, low + half).otherwise(low))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """For each row: n_chars, the text's fingerprint, that of its edited text, and likenesses.

    Edited: the last floor(n_chars / 4) code points give way to the first as many of the next document by id, after the last
    the first. Documents are dealt once, by ranges of ids; the first of each range also goes to the range before, so no
    range needs another's rows.
    """
    flat = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    size = flat.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    buckets = int(min(MOST_BUCKETS, max(FEWEST, (size.bytes or 0) // BUCKET_BYTES), max(1, size.n // 2)))
    place = _bucket(flat, "doc_id", buckets)
    order = [F.asc_nulls_first("doc_id"), F.asc("tie")]
    keyed = flat.withColumn("bucket", place).withColumn("tie", F.xxhash64("text"))
    heads = keyed.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "tie")).alias("head"))
    # A row a range: the range before it, in a ring, among those that hold rows.
    ring = heads.select("bucket", "head").collect()
    used = sorted(r.bucket for r in ring)
    before = {b: used[k - 1] for k, b in enumerate(used)}
    rows = [(r.bucket, before[r.bucket], r.head.doc_id, r.head.tie) for r in ring]
    ids = flat.schema["doc_id"].dataType.simpleString()
    heads = docs.sparkSession.createDataFrame(rows, f"bucket int, before int, head_id {ids}, head_tie bigint")
    guarded = keyed.join(F.broadcast(heads), "bucket", "left")
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    # seq sorts a guard behind all rows of its range; equal rows at the head of a range each send a guard, of which any serves.
    mine = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guard"))
    guest = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("guard"))
    dealt = guarded.withColumn("to", F.explode(F.when(is_head, F.array(mine, guest)).otherwise(F.array(mine)))).select("doc_id", "text", "tie", "to.bucket", "to.guard")
    # As many partitions as buckets, so that few fall together whatever the session's number of partitions.
    dealt = dealt.repartition(buckets, "bucket")
    within = Window.partitionBy("bucket").orderBy(F.asc("guard"), *order)
    lined = dealt.withColumn("next_text", F.lead("text").over(within))
    n = F.length("text")
    cut = F.floor(n / 4)
    edited = F.concat(F.expr("substring(text, 1, length(text) - int(floor(length(text) / 4)))"), F.expr("substring(next_text, 1, int(floor(length(text) / 4)))"))
    lined = lined.withColumn("edited", F.coalesce(edited, F.col("text"))).drop("next_text")
    lined = lined.withColumn("words", word_hashes(F.col("text"))).withColumn("edited_words", word_hashes(F.col("edited")))
    lined = lined.select("doc_id", "tie", "bucket", "guard", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("words"), shingle, fraction).alias("own"), sketch(F.col("edited_words"), shingle, fraction).alias("changed"))
    lined = lined.withColumn("next", F.lead("own").over(within)).where(~F.col("guard")).withColumn("next", F.coalesce("next", "own"))
    return lined.select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("own")).alias("fingerprint"), printed(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"),
        containment(F.col("own"), F.col("changed")).alias("kept_share"), containment(F.col("own"), F.col("next")).alias("shared_next"),
    )
