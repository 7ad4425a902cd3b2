"""Substring dedup by seed and extend: winnowed anchors, extension both ways, maximal repeats of at least `window` words.

A window is `window` consecutive words. Its anchor is the least hash among its runs of SEED words (the leftmost of equal
ones), so equal windows have equal anchors at equal places, and neighbouring windows mostly share one. Windows that share
an anchor form a span, which reaches as far to both sides as they do: one short row stands for about a dozen windows.

Spans meet by the anchor's hash. Equal spans are counted before they are shuffled; with two or more of them all their
windows repeat. Where spans of one anchor differ, the repeat ends or an edit lies in between: only there, one span of
each kind is taken apart into its windows, which are counted by hash. So a passage in very many documents costs a row
per document, never a pair of documents.

What is left are maximal repeats: overlapping windows join, as far to both sides as the words repeat. Spans and windows are told
apart by their anchor's hash and a second one, 128 bits together, so that no words are shipped.

A word goes if a window that covers it has words that also start anywhere else, in the same document too; windows are
judged on the input. Words are `[^\\x20\\x09-\\x0D]+`, unchanged. Null texts have no words. Repeated rows repeat each other.
Null ids are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.llm.common import written

WINDOW = 35
#: Words of an anchor; each window holds WINDOW - SEED + 1 candidates.
SEED = 12
_R = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Hashes:
    """Hashes of runs of words of a text, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, words: list[bytes]):
        one = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        self.n, self.sums = len(one), []
        for r in _R:
            power = np.full(len(one) + 1, r, np.uint64)
            power[0] = 1
            inverse = np.full(len(one) + 1, pow(r, -1, 1 << 64), np.uint64)
            inverse[0] = 1
            self.sums.append((np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(one * np.uint64(r)) * np.cumprod(power)[:-1])]), np.cumprod(inverse)))

    def runs(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        """Hashes of words start to end (exclusive), elementwise; different `which` are independent."""
        total, inverse = self.sums[which]
        return _mix((total[end] - total[start]) * inverse[start])


def _anchors(hashes: Hashes, window: int, seed: int) -> np.ndarray:
    """For each window the place of its anchor: the leftmost least hash among its runs of `seed` words."""
    n, width = hashes.n - seed + 1, window - seed + 1
    at = np.arange(n)
    own = hashes.runs(at, at + seed, 0)
    best = at
    span = 1
    while span < width:  # best of `span` candidates, doubled until they are `width`
        step = min(span, width - span)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(own[right] < own[left], right, left)
        span += step
    return best


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _spans(words: list[bytes], window: int, seed: int) -> tuple[np.ndarray, ...] | None:
    """(anchor's hash, hash of the whole span, first window, last window, anchor's place) of each span of a text."""
    if len(words) < window:
        return None
    hashes = Hashes(words)
    place = _anchors(hashes, window, seed)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.append(first[1:], len(place)) - 1
    at = place[first]
    return hashes.runs(at, at + seed, 0), hashes.runs(first, last + window, 1), first, last, at


def _key(id_col: str, text_col: str) -> Column:
    """Rows of equal id and text share a key: their windows are judged alike."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-")), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))))


def _i64(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64), pa.int64())


def repeated_ranges(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(key, first, last): windows first to last of the rows of docs (key, body) have words that also start elsewhere."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 512):
                keys, cols = [], []
                for key, text in zip(*(whole.slice(lo, 512).column(c).to_pylist() for c in ("key", "body")), strict=True):
                    if (got := _spans(_words(text), window, seed)) is not None:
                        keys += [key] * len(got[0])
                        cols.append(got)
                if cols:
                    anchor, span, first, last, at = (np.concatenate(c) for c in zip(*cols, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), _i64(anchor), _i64(span), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(at, pa.int32())], names=["key", "anchor", "span", "first", "last", "place"])

    spans = docs.mapInArrow(find, "key binary, anchor bigint, span bigint, first int, last int, place int")
    spans = spans.select("key", "anchor", "span", (F.col("place") - F.col("first")).alias("before"), (F.col("last") - F.col("place")).alias("after"), "first")
    spans = written(spans, "spans")
    # Most anchors occur once; only counts of them are shuffled before those leave. Counts are written, since Spark splits a
    # hot key's rows only where a join's two sides are plain shuffles.
    shared = written(spans.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "anchors")
    spans = written(spans.join(shared, "anchor", "left_semi"), "shared-spans")
    kind = ["anchor", "span", "before", "after"]
    # One row a kind of span; the hottest passages shrink before the shuffle.
    kinds = written(spans.groupBy(*kind).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "first")).alias("one")), "kinds")
    several = written(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("anchor"), "several-kinds")
    length = F.col("before") + F.col("after") + 1
    # Every span whose kind occurs twice repeats as a whole.
    whole = spans.join(kinds.where("n > 1").select(*kind), kind).select("key", "first", (F.col("first") + length - 1).alias("last"))

    torn = kinds.join(several, "anchor", "left_semi").select(F.col("one.key").alias("key"), F.struct("anchor", F.col("one.first").alias("first"), "before", length.alias("len"), (F.col("n") == 1).alias("open")).alias("piece"))
    torn = torn.groupBy("key").agg(F.collect_list("piece").alias("pieces"))  # as many as the text's spans at most

    def tear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for lo in range(0, len(whole_batch), 256):
                keys, cols = [], []
                for row in whole_batch.slice(lo, 256).to_pylist():
                    hashes = Hashes(_words(row["body"]))
                    first, size = (np.array([p[c] for p in row["pieces"]], np.int64) for c in ("first", "len"))
                    which = np.repeat(np.arange(len(size)), size)
                    start = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + first[which]
                    anchor, before, is_open = (np.array([p[c] for p in row["pieces"]])[which] for c in ("anchor", "before", "open"))
                    keys += [row["key"]] * len(start)
                    cols.append((anchor.astype(np.int64), (first[which] + before - start).astype(np.int32), hashes.runs(start, start + window, 2), start.astype(np.int32), is_open))
                anchor, ahead, hashed, start, is_open = (np.concatenate(c) for c in zip(*cols, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), _i64(anchor), pa.array(ahead, pa.int32()), _i64(hashed), pa.array(start, pa.int32()), pa.array(is_open, pa.bool_())], names=["key", "anchor", "ahead", "hash", "start", "open"])

    # Equal rows give equal cells, of which one counts.
    cells = docs.join(torn, "key").mapInArrow(tear, "key binary, anchor bigint, ahead int, hash bigint, start int, open boolean").distinct()
    cells = written(cells, "windows")
    same = ["anchor", "ahead", "hash"]
    twice = written(cells.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated-windows")
    apart = cells.where("open").join(twice, same).select("key", F.col("start").alias("first"), F.col("start").alias("last"))
    return whole.unionByName(apart)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per row of docs: id, n_words, n_removed, repeats (its maximal repeats, as first word and the word behind the
    last), kept_text (the words left, joined by a blank), kept_sha256."""
    flat = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body"), _key(id_col, text_col).alias("key"))
    ranges = repeated_ranges(flat.select("key", "body"), window, seed)
    marks = ranges.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("marks"))  # fewer than the text has words

    ranges_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 512):
                batch = whole.slice(lo, 512)
                counts, removed, texts, found = [], [], [], []
                for text, marked in zip(batch.column("body").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                    words = _words(text)
                    if marked:
                        edge = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edge, [m["first"] for m in marked], 1)
                        np.add.at(edge, [m["last"] + window for m in marked], -1)
                        gone = np.cumsum(edge[:-1]) > 0
                        turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                        found.append([{"first": a, "end": b} for a, b in turn.reshape(-1, 2).tolist()])
                        left = [words[i] for i in np.flatnonzero(~gone).tolist()]
                    else:
                        found.append([])
                        left = words
                    counts.append(len(words))
                    removed.append(len(words) - len(left))
                    texts.append(b" ".join(left))
                sha = [hashlib.sha256(t).hexdigest() for t in texts]
                kept = pa.array([t.decode("utf-8", "surrogatepass") for t in texts], pa.string())
                cols = [batch.column("id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(found, ranges_type), kept, pa.array(sha, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "n_words", "n_removed", "repeats", "kept_text", "kept_sha256"])

    kind = flat.schema["id"].dataType.simpleString()
    joined = flat.join(marks, "key", "left").select("id", "body", "marks")
    return joined.mapInArrow(cut, f"id {kind}, n_words bigint, n_removed bigint, repeats array<struct<first:int,end:int>>, kept_text string, kept_sha256 string")
