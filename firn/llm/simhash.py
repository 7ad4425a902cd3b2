"""SimHash near-dedup with vantage-point trees.

A text is lower-cased (A-Z), cut into words and shingles; a bit of the fingerprint is 1 if it is set in over half the
shingles' hashes. Fingerprints within a Hamming radius link.

Search: equal fingerprints are one class. A pair within radius r differs by at most r // parts bits in one of `parts` parts
of the fingerprint, so each part has trees of its own with that smaller radius. A node of a tree splits its points at the
median distance to a vantage; by the triangle inequality only points within the radius of that boundary can have partners
on the far side, and those visit it too. So every such pair meets in the leaf where one of the two is at home. Two tiers
follow one rule: a tree fitted on a bounded sample deals the classes over shards, one task each, and in its shard a task
grows a tree over all points down to leaves of LEAF. Distances are checked on whole fingerprints. A shard that cannot be
split (a dense group) is compared block by block, and rows that a group has settled are not compared again.

`simhash_components` returns the components of the links. `near_distinct` looks for similar sets of shingles, whose fingerprints
differ in many bits; there bands of min-hashes, which texts without a shingle in common do not share, say which fingerprints are
compared, and these give candidates alone: exact Jaccard similarities decide (see there).

Null and empty texts have no words: fingerprint zero, which links like any other. Repeated rows and null ids are kept, one
result row for each; a component's id is its smallest non-null id. Ids are integers. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.llm.common import scratch, worker_cache, written
from firn.llm.components import components

SEED = 42
#: Points of a leaf inside a task, and classes of a shard (one task), about.
LEAF, SHARD = 64, 4_096
#: The trees that deal the shards are fitted on so many fingerprints of each shard, and at most SAMPLE in all.
FIT, SAMPLE = 64, 1_048_576
#: A shard that cannot be split, or the classes of one band, are compared in blocks of so many classes.
BLOCK = 262_144
#: Min-hashes of a set of shingles, and how many of them make a band.
HASHES, BAND = 64, 4
#: Pairs that are compared at once; leaves of more pairs than CROWD are compared row by row, settled rows left out.
PAIRS, CROWD = 400_000, 1_000_000
#: Shingles of the texts that one side of an exact comparison holds.
GRAMS = 2_000_000
#: Rows that the first batch of near duplicates holds at least, and the share of all rows left that it holds at least.
BATCH, BATCHES = 20_000, 64
#: Rows whose 16-byte names are broadcast at most; more of them are joined by a shuffle of the texts.
FEW = 1_000_000
#: Longest run of shingles whose bits are unpacked at once.
_STEP = 8_192
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)
_FACTORS = np.random.default_rng(SEED).integers(0, 2**31, (HASHES, 1), np.uint32) * np.uint32(2) + np.uint32(1)


def _hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, ends = b" ".join(words), [n + i for i, n in enumerate(accumulate(map(len, words)))]
    k = min(shingle, len(words))
    starts, hash64 = [0, *(e + 1 for e in ends)], xxhash.xxh64_intdigest
    return np.array([hash64(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :], strict=False)], np.uint64)


def simhash(text: str | None, shingle: int, words64: int = 1, distinct: bool = False) -> tuple[bytes, int]:
    """Fingerprint of 64 * words64 bits, big-endian, and the number of shingles. The first 64 bits are those of the plain XXH64."""
    hashes = _hashes(text, shingle)
    return _printed(np.unique(hashes) if distinct else hashes, words64)


def _printed(hashes: np.ndarray, words64: int) -> tuple[bytes, int]:
    n, total = len(hashes), np.zeros(64 * words64, np.int64)
    for lo in range(0, n, _STEP):
        first = hashes[lo : lo + _STEP]
        for w in range(words64):
            h = first
            if w:
                h = first * np.uint64(_ODD[w - 1])
                h ^= h >> np.uint64(29)
                h *= np.uint64(_ODD[w % len(_ODD)])
                h ^= h >> np.uint64(32)
            total[64 * w : 64 * w + 64] += np.unpackbits(h.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.uint32)
    return np.packbits(total * 2 > n).tobytes(), n


def bands(hashes: np.ndarray) -> np.ndarray:
    """A number (int32) for each band of the min-hashes of a set of shingles: two sets have one of them in common with a chance of
    their similarity to the power BAND."""
    high, least = (hashes >> np.uint64(32)).astype(np.uint32), np.full(HASHES, 2**32 - 1, np.uint32)
    for lo in range(0, len(high), 1_024):
        np.minimum(least, (high[lo : lo + 1_024] * _FACTORS).min(1), out=least)
    mixed = (least.reshape(-1, BAND).astype(np.uint64) * np.array(_ODD[:BAND], np.uint64)).sum(1)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(_ODD[-1])
    return (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)


def fingerprints(docs: DataFrame, shingle: int, words64: int = 1, text_col: str = "text", keep: list[str] | None = None, distinct: bool = False, banded: bool = False) -> DataFrame:
    """fp (binary) and n_shingles (long) beside the columns named in keep; with `distinct` repeated shingles count once, with
    `banded` there is `keys` (array of int), the numbers of the bands."""
    keep = keep or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("simhash")  # nothing is kept here, and what other operators kept goes
        for batch in batches:
            made, keys = [], []
            for t in batch.column("_text"):
                hashes = _hashes(t.as_py(), shingle)
                hashes = np.unique(hashes) if distinct else hashes
                made.append(_printed(hashes, words64))
                if banded:
                    keys.append(bands(hashes))
            out = [pa.array([f for f, _ in made], pa.binary()), pa.array([n for _, n in made], pa.int64())] + [pa.array(keys, pa.list_(pa.int32()))] * banded
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + out, names=[*keep, "fp", "n_shingles"] + ["keys"] * banded)

    flat = docs.select(*keep, F.col(text_col).alias("_text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema if f.name in keep]
    return flat.mapInArrow(run, ", ".join([*kinds, "fp binary", "n_shingles bigint"] + ["keys array<int>"] * banded))


# --- the search


class Tree:
    """A vantage-point tree over part values: arrays of nodes; a leaf has no vantage."""

    def __init__(self, values: np.ndarray, home: np.ndarray, radius: int, most: float, scale: float = 1.0, seed: int = SEED):
        """Splits nodes of more than `most` points, of which each stands for `scale`."""
        self.radius, self.vantage, self.mu, self.near, self.far, self.size = radius, [], [], [], [], []
        self._grow(values, home, most, scale, np.random.default_rng(seed))

    def _sides(self, d: np.ndarray, home: np.ndarray, mu: int) -> tuple[np.ndarray, ...]:
        """Points of the near side and of the far side, each with those at home there. Near points within the radius of the
        boundary visit the far side; visitors go wherever a partner may lie."""
        beyond = home & (d > mu)
        near = np.where(home, d <= mu, d <= mu + self.radius)
        return near, home & near, d >= np.where(beyond, 0, mu + 1 - self.radius), beyond

    def _grow(self, values: np.ndarray, home: np.ndarray, most: float, scale: float, rng: np.random.Generator) -> int:
        me, own = len(self.mu), np.flatnonzero(home)
        for a in (self.vantage, self.mu, self.near, self.far):
            a.append(None)
        self.size.append(len(values) * scale)
        if len(own) * scale <= most or len(own) < 2:
            return me
        vantage = values[own[rng.integers(len(own))]]
        d = np.bitwise_count(values ^ vantage).astype(np.int16)
        mu = int(np.median(d[own]))
        mu -= not (d[own] > mu).any()
        cost = lambda rows, at_home: at_home.sum() * (rows.sum() - at_home.sum() / 2)
        near, near_home, far, far_home = self._sides(d, home, mu)
        if mu < 0 or cost(near, near_home) + cost(far, far_home) > 0.95 * len(own) * (len(values) - len(own) / 2):
            return me
        self.vantage[me], self.mu[me] = vantage, mu
        self.near[me] = self._grow(values[near], near_home[near], most, scale, rng)
        self.far[me] = self._grow(values[far], far_home[far], most, scale, rng)
        return me

    def leaves(self, values: np.ndarray, home: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, points, home): the points that meet in each leaf, and whether they are at home there."""
        todo = [(0, np.arange(len(values)), home)]
        while todo:
            node, rows, own = todo.pop()
            if not len(rows):
                continue
            if self.mu[node] is None:
                yield node, rows, own
                continue
            d = np.bitwise_count(values[rows] ^ self.vantage[node]).astype(np.int16)
            near, near_home, far, far_home = self._sides(d, own, self.mu[node])
            todo += [(self.near[node], rows[near], near_home[near]), (self.far[node], rows[far], far_home[far])]


def part_radii(radius: int, parts: int) -> list[int]:
    """A radius for each part such that a pair within the whole radius is within it in some part: were it beyond in all, it would differ in more than `radius` bits."""
    spare = radius + 1 - parts
    return [max(spare // parts + (i < spare % parts), 0) for i in range(parts)]


def _part(fp: np.ndarray, part: int, parts: int) -> np.ndarray:
    """The values of one part of fingerprints (n, words) in the smallest type that holds them; parts divide the words evenly."""
    each = parts // fp.shape[1]
    bits = 64 // each
    kind = np.uint16 if bits <= 16 else np.uint32 if bits <= 32 else np.uint64
    return (fp[:, part // each] >> np.uint64(64 - bits * (part % each + 1)) & np.uint64(2**bits - 1)).astype(kind)


def _near(fp: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(fp[a] ^ fp[b]).sum(-1, dtype=np.int64) <= radius


def _crowded(fp: np.ndarray, rows: np.ndarray, radius: int, is_open: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a dense leaf: rows that are open are compared with all. What is yielded may close rows that were not compared yet."""
    done, step = np.zeros(len(rows), bool), max(1, PAIRS // len(rows))
    other = fp[rows].T.copy()
    while len(at := np.flatnonzero(~done & is_open(rows))[:step]):
        done[at] = True
        far = np.zeros((len(at), len(rows)), np.uint16)
        for w in range(len(other)):
            far += np.bitwise_count(other[w][at][:, None] ^ other[w])
        x, y = np.nonzero(far <= radius)
        ok = at[x] != y
        yield rows[at[x[ok]]], rows[y[ok]]


def _links(fp: np.ndarray, values: np.ndarray, home: np.ndarray, part_radius: int, radius: int, is_open: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within radius of one shard's points that are within part_radius in this part; of dense leaves also others."""
    held, n = [], 0

    def checked() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if held:
            x, y = map(np.concatenate, zip(*held, strict=True))
            close = _near(fp, x, y, radius)
            yield x[close], y[close]

    for _, rows, own in Tree(values, home, part_radius, LEAF).leaves(values, home):
        if not own.any() or len(rows) < 2:
            continue
        if own.sum() * len(rows) > CROWD:
            yield from _crowded(fp, rows, radius, is_open)
            continue
        at_home = rows[own]
        every = np.concatenate([at_home, rows[~own]])
        x, y = np.nonzero(np.bitwise_count(values[at_home][:, None] ^ values[every]) <= part_radius)
        ok = x < y
        held.append((at_home[x[ok]], every[y[ok]]))
        n += ok.sum()
        if n > PAIRS:
            yield from checked()
            held, n = [], 0
    yield from checked()


Found = Callable[..., pd.DataFrame]


def _words(col: pd.Series, words64: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), ">u8").astype(np.uint64).reshape(-1, words64)


def _searched(points: DataFrame, radius: int, words64: int, radii: list[int], shard: int, found: Found, schema: str) -> DataFrame:
    """What `found` makes of the links of each shard. points: fp (binary, unique) and what else `found` needs.

    found(rows, fp, part, links) gets a shard's rows and links(is_open), the pairs of row numbers within the radius.
    """
    spark, n, parts = points.sparkSession, points.count(), len(radii)
    fit = min(SAMPLE, FIT * -(-n // shard))
    share = min(1.0, 1.2 * fit / max(n, 1))
    got = points.select("fp")
    got = (got.sample(fraction=share, seed=SEED) if share < 1 else got).limit(fit).toPandas()
    sample = _words(pd.Series(sorted(got["fp"])), words64)
    all_home = np.ones(len(sample), bool)
    trees = spark.sparkContext.broadcast([Tree(_part(sample, p, parts), all_home, r, shard, n / max(len(sample), 1), p) for p, r in enumerate(radii)])
    kinds = {f.name: f.dataType.simpleString() for f in points.schema}

    def dealt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            fp, out = _words(pdf["fp"], words64), []
            for p, tree in enumerate(trees.value):
                for leaf, rows, home in tree.leaves(_part(fp, p, parts), np.ones(len(fp), bool)):
                    blocks = max(1, int(-(-tree.size[leaf] // BLOCK)))
                    mine = (fp[rows, 0] * np.uint64(_ODD[0]) >> np.uint64(33)).astype(np.int64) % blocks
                    out += [(rows, home, np.full(len(rows), (p << 32) + leaf), np.minimum(mine, other), np.maximum(mine, other)) for other in range(blocks)]
            if out:
                rows, home, cell, i, j = map(np.concatenate, zip(*out, strict=True))
                yield pdf.iloc[rows].assign(home=home, cell=cell, i=i, j=j)

    cells = points.mapInPandas(dealt, ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", home boolean, cell bigint, i int, j int")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        fp, part = _words(pdf["fp"], words64), int(pdf["cell"].iloc[0] >> 32)
        home = pdf["home"].to_numpy(bool)
        return found(pdf, fp, part, lambda is_open: _links(fp, _part(fp, part, parts), home, radii[part], radius, is_open))

    return cells.groupBy("cell", "i", "j").applyInPandas(compare, schema)


def _of_bands(points: DataFrame, shard: int) -> DataFrame:
    """The points once for each of their keys, beside band and key; rows of equal cell, i and j meet, of which only those of one
    band and key are compared. cell: some `shard` rows; i, j: blocks of a key that very many points have."""
    n = points.count()
    flat = points.select("*", F.posexplode("keys").alias("band", "key"))
    cell = F.pmod(F.xxhash64("band", "key"), F.lit(max(1, -(-n * (HASHES // BAND) // shard)))).alias("cell")
    if n > BLOCK:
        share = min(1.0, 256 / BLOCK)
        times = flat.select("band", "key").sample(fraction=share, seed=SEED).groupBy("band", "key").count()
        many = written(times.select("band", "key", F.ceil(F.col("count") / F.lit(share * BLOCK)).cast("int").alias("blocks")).where("blocks > 1"), "blocks")
        if not many.isEmpty():
            flat = flat.join(many, ["band", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            flat = flat.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            return flat.select(*points.columns, "band", "key", cell, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    return flat.select("*", cell, F.lit(0).alias("i"), F.lit(0).alias("j"))


def _equal(fp: np.ndarray, code: np.ndarray, radius: int, is_open: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within radius among rows of equal code; of codes that very many rows have, those with rows that are open."""
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.diff(code[order], prepend=-1))
    times = np.diff(starts, append=len(order))
    for k in np.flatnonzero(times * times > CROWD):
        yield from _crowded(fp, order[starts[k] : starts[k] + times[k]], radius, is_open)
    order = order[np.repeat(times * times <= CROWD, times)]
    sorted_, at, apart = code[order], np.arange(len(order)), 1
    while len(at := at[at + apart < len(order)]) and len(at := at[sorted_[at] == sorted_[at + apart]]):
        for lo in range(0, len(at), PAIRS):
            x, y = order[at[lo : lo + PAIRS]], order[at[lo : lo + PAIRS] + apart]
            close = _near(fp, x, y, radius)
            yield x[close], y[close]
        apart += 1


def _banded(points: DataFrame, radius: int, words64: int, shard: int, found: Found, schema: str, once: bool = True) -> DataFrame:
    """What `found` makes of the pairs of points within radius that have a key of some band in common. points: fp (binary, unique),
    keys, and what else `found` needs. With `once` a pair is seen in the first such band alone.

    found(rows, fp, links) gets rows of a cell and links(is_open), the pairs of row numbers.
    """
    flat = _of_bands(points, shard)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        code = (pdf["band"].to_numpy(np.int64) << 32) + (pdf["key"].to_numpy(np.int64) & 0xFFFFFFFF)
        _, at, times = np.unique(code, return_inverse=True, return_counts=True)
        some = np.flatnonzero(times[at] > 1)  # who is alone with a key goes at once
        pdf, code = pdf.iloc[some], code[some]
        fp = _words(pdf["fp"], words64)
        keys = np.stack(pdf["keys"]) if once and len(pdf) else None

        def links(is_open: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for x, y in _equal(fp, code, radius, is_open):
                ok = np.ones(len(x), bool) if keys is None else (keys[x] == keys[y]).argmax(1) == code[x] >> 32
                yield x[ok], y[ok]

        return found(pdf, fp, links)

    return (flat if once else flat.drop("keys")).groupBy("cell", "i", "j").applyInPandas(compare, schema)


# --- components


def _labels(n: int, a: np.ndarray, b: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
    """The least row of each row's component under the edges (a, b) and the labels known so far."""
    labels = np.arange(n) if known is None else known.copy()
    while len(a):
        low = np.minimum(labels[a], labels[b])
        np.minimum.at(labels, labels[a], low)
        np.minimum.at(labels, labels[b], low)
        while (labels[labels] != labels).any():
            labels = labels[labels]
        apart = labels[a] != labels[b]
        a, b = a[apart], b[apart]
    return labels


def links(classes: DataFrame, radius: int, words64: int, radii: list[int], shard: int = SHARD) -> DataFrame:
    """Edges (a, b) of fingerprints that connect just what all pairs within radius, and within its part's radius in some part, connect.

    classes: fp binary, unique. Each task returns a spanning forest of its links, so a dense group does not give all its pairs.
    """

    def forest(pdf: pd.DataFrame, fp: np.ndarray, part: int, pairs: Callable) -> pd.DataFrame:
        known = np.arange(len(fp))

        def outside(rows: np.ndarray) -> np.ndarray:
            """Rows of a dense leaf that are not of its largest component, whose own links need no search."""
            which, times = np.unique(known[rows], return_counts=True)
            return known[rows] != which[times.argmax()]

        for x, y in pairs(outside):
            apart = known[x] != known[y]
            known = _labels(len(fp), x[apart], y[apart], known)
        at = np.flatnonzero(known != np.arange(len(known)))
        names = pdf["fp"].to_numpy()
        return pd.DataFrame({"a": names[at], "b": names[known[at]]})

    return _searched(classes.select("fp"), radius, words64, radii, shard, forest, "a binary, b binary")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, shard: int = SHARD) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id (smallest id reachable through links)."""
    flat = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").alias("_body"))
    prints = written(fingerprints(flat, shingle, 1, "_body", ["_id"]), "simhash")
    classes = written(prints.groupBy("fp").agg(F.min("_id").alias("least")), "classes")
    labels = components(links(classes, radius, 1, part_radii(radius, 2), shard))
    found = written(classes.join(labels.withColumnRenamed("node", "fp"), "fp"), "members")
    # Tables are written before joins on a key that may be hot, so that Spark can split it.
    whole = written(found.groupBy("label").agg(F.min("least").alias("all")), "components")
    member = found.join(whole, "label").select("fp", "all", F.lit(True).alias("linked"))
    final = written(classes.join(member, "fp", "left").select("fp", F.when(F.col("linked"), F.col("all")).otherwise(F.col("least")).alias("component_id")), "labelled")
    return prints.join(final, "fp").select(F.col("_id").alias("id"), F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


# --- near duplicates


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The sorted hashes of the text's different shingles."""
    return np.unique(_hashes(text, shingle).view(np.int64))


def _node(id_col: str, text_col: str) -> Column:
    """Rows of equal id and text share a node: they stay or go together."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-")), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))))


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose sets (node, grams: sorted) have at least this Jaccard similarity; two empty sets are alike.

    Nodes are dealt over blocks of some GRAMS shingles; a set goes once to each cell of two blocks in which it has a pair.
    """
    blocks = max(1, -(-(sets.agg(F.sum(F.size("grams"))).first()[0] or 0) // GRAMS))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    placed = pairs.select("a", "b", block("a").alias("i"), block("b").alias("j"))
    held = placed.select(F.col("i").alias("k"), F.col("j").alias("l"), F.explode(F.array("a", "b")).alias("node")).distinct().join(sets, "node")

    def compare(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        grams = dict(zip(known["node"], known["grams"], strict=True))

        def same(a: np.ndarray, b: np.ndarray) -> bool:
            if min(len(a), len(b)) < similarity * max(len(a), len(b)):
                return False
            if not len(a):
                return True
            both = (a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum()
            return both >= similarity * (len(a) + len(b) - both)

        ok = [same(grams[a], grams[b]) for a, b in zip(asked["a"], asked["b"], strict=True)]
        return asked.loc[ok, ["a", "b"]]

    return placed.groupBy("i", "j").cogroup(held.groupBy("k", "l")).applyInPandas(compare, "a binary, b binary")


def first_of_neighbours(edges: DataFrame) -> DataFrame:
    """Of the edges (low, high), structs in order, the nodes that go when each node stays unless it has a neighbour that stays before it: one column, node.

    Each round settles all nodes that have no unsettled neighbour before them.
    """
    gone: DataFrame | None = None
    while not edges.isEmpty():
        stay = edges.select(F.col("low").alias("node")).distinct().join(edges.select(F.col("high").alias("node")), "node", "left_anti")
        out = written(edges.join(stay.withColumnRenamed("node", "low"), "low", "left_semi").select(F.col("high").alias("node")).distinct(), "gone")
        left = edges.join(stay.withColumnRenamed("node", "low"), "low", "left_anti")
        for end in ("low", "high"):
            left = left.join(out.withColumnRenamed("node", end), end, "left_anti")
        gone = out if gone is None else gone.unionByName(out)
        edges = written(left.select("low", "high"), "edges-left")
    return edges.select(F.col("low").alias("node")) if gone is None else gone


def near_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, words64: int = 5, shard: int = 131_072, batch: int = BATCH) -> DataFrame:
    """The rows of docs, with all columns, that stay when rows are taken in order of their ids (nulls last) and a row goes if
    its Jaccard similarity of shingle sets to one that stayed is at least so high. So no two that stay are alike, and each
    that goes is like one that stayed. Equal rows stay or go together; texts without words are alike.

    Candidates: texts that have one of 16 bands of four min-hashes in common (at a similarity of 0.8 all but 1 - (1 - 0.8^4)^16,
    0.02 %, have), and whose fingerprints are near: a similarity s is a cosine of 2s / (1 + s) or more, so those of the distinct
    shingles within the expected Hamming distance at that cosine and four standard deviations. Texts without a shingle in common
    never meet, so the search grows with the table and not with its square. Exact similarities decide on all candidates:
    1. A class of equal fingerprints without a candidate before it gives its first row as a centre, which stays.
    2. Rows are compared with the centres near them, and go if they are alike. A group of copies of any size ends here, with
       as many comparisons as it has rows.
    3. The rows left are taken in growing batches in the order of their ids. Inside a batch the candidate pairs are compared one
       by one, and what is alike is settled in order; rows behind it go if they are alike to one of the batch that stayed. So
       a large family of texts, some of which are alike, costs its rows times those that stay.
    """
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), _node(id_col, text_col).alias("_node"))
    with scratch(docs.sparkSession) as keep:
        gone = keep(near_removed(docs, id_col, text_col, shingle, similarity, words64, shard, batch).select(F.col("node").alias("_node")), "removed")
    few = gone.count() <= FEW
    return named.join(F.broadcast(gone) if few else gone, "_node", "left_anti").select("_row.*")


def near_removed(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float, words64: int, shard: int, batch: int) -> DataFrame:
    """The nodes of the rows that `near_distinct` drops."""
    bits, share = 64 * words64, float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    radius = round(bits * share + 4 * (bits * share * (1 - share)) ** 0.5)
    flat = docs.select(_node(id_col, text_col).alias("_node"), F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").alias("_body"))
    prints = fingerprints(flat, shingle, words64, "_body", ["_node", "_id"], distinct=True, banded=True)
    me = F.struct(F.col("_id").isNull().alias("none"), F.coalesce("_id", F.lit(0)).alias("id"), F.col("_node").alias("node"))
    prints = written(prints.select("fp", "keys", me.alias("me")), "simhash")

    def order(pdf: pd.DataFrame, fp: np.ndarray) -> np.ndarray:
        rank = np.empty(len(pdf), np.int64)
        rank[np.lexsort((*fp.T, pdf["id"].to_numpy(), pdf["none"].to_numpy(bool)))] = np.arange(len(pdf))
        return rank

    def preceded(pdf: pd.DataFrame, fp: np.ndarray, pairs: Callable) -> pd.DataFrame:
        rank, after, met = order(pdf, fp), np.zeros(len(fp), bool), np.zeros(len(fp), bool)
        for x, y in pairs(lambda rows: ~after[rows]):
            met[x] = met[y] = True
            after[np.where(rank[x] < rank[y], y, x)] = True
        return pd.DataFrame({"fp": pdf["fp"].to_numpy()[met], "after": after[met]})

    def of_centres(pdf: pd.DataFrame, fp: np.ndarray, pairs: Callable) -> pd.DataFrame:
        centre, asks = (pdf[c].to_numpy(bool) for c in ("centre", "asks"))
        names, out = pdf["fp"].to_numpy(), [(np.zeros(0, np.int64),) * 2]
        for x, y in pairs(lambda rows: centre[rows]):
            for a, b in ((x, y), (y, x)):
                ok = asks[a] & centre[b]
                out.append((a[ok], b[ok]))
        x, y = map(np.concatenate, zip(*out, strict=True))
        return pd.DataFrame({"fp": names[x], "other": names[y]})

    def every(pdf: pd.DataFrame, fp: np.ndarray, pairs: Callable) -> pd.DataFrame:
        names, out = pdf["fp"].to_numpy(), [(np.zeros(0, np.int64),) * 2]
        out += pairs(lambda rows: np.ones(len(rows), bool))
        x, y = map(np.concatenate, zip(*out, strict=True))
        return pd.DataFrame({"fp": names[x], "other": names[y]})

    # A class has the keys of its first row.
    classes = prints.groupBy("fp").agg(F.min(F.struct(F.col("me").alias("least"), "keys")).alias("first"), F.count(F.lit(1)).alias("n"))
    classes = written(classes.select("fp", "first.*", "n"), "classes")
    met = _banded(classes.select("fp", "keys", "least.none", "least.id"), radius, words64, shard, preceded, "fp binary, after boolean", once=False).groupBy("fp").agg(F.bool_or("after").alias("after"))
    play = classes.join(met, "fp", "left").where("after IS NOT NULL OR n > 1").select("fp", "keys", "least", "n", (~F.coalesce("after", F.lit(False))).alias("centre"))
    play = written(play, "candidates")
    rows = written(prints.drop("keys").join(play.select("fp", "keys", "centre", "least"), "fp").select("fp", "keys", "me", (F.col("centre") & (F.col("me") == F.col("least"))).alias("centre")).distinct(), "candidate-rows")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = pa.array([shingle_set(t.as_py(), shingle) for t in part.column("_body")], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("node"), made], names=["node", "grams"])

    few = rows.count() <= FEW
    names = rows.select(F.col("me.node").alias("_node"))
    texts = flat.join(F.broadcast(names) if few else names, "_node", "left_semi").dropDuplicates(["_node"]).select(F.col("_node").alias("node"), "_body")
    sets = written(texts.mapInArrow(grams, "node binary, grams array<bigint>"), "sets")

    def like(asking: DataFrame, stayed: DataFrame) -> DataFrame:
        """The nodes of `asking` that are alike to one of `stayed`; both hold fp, keys and me."""
        points = asking.select("fp", "keys", F.lit(True).alias("asks")).unionByName(stayed.select("fp", "keys", F.lit(False).alias("asks")))
        points = written(points.groupBy("fp", "keys").agg(F.bool_or("asks").alias("asks"), F.bool_or(~F.col("asks")).alias("centre")), "points")
        met = _banded(points, radius, words64, shard, of_centres, "fp binary, other binary").distinct()
        met = met.unionByName(points.where("asks AND centre").select("fp", F.col("fp").alias("other")))
        met = written(met.join(stayed.select(F.col("fp").alias("other"), F.col("me.node").alias("b")), "other").select("fp", "b"), "near-stayed")
        asked = written(asking.select("fp", F.col("me.node").alias("a")).join(met, "fp").select("a", "b"), "asked")
        return written(alike(asked, sets, similarity).select(F.col("a").alias("node")).distinct(), "gone")

    def among(these: DataFrame) -> DataFrame:
        """The nodes of `these` that go when they are settled in order."""
        met = _banded(these.select("fp", "keys").distinct(), radius, words64, shard, every, "fp binary, other binary").distinct()
        met = met.unionByName(these.groupBy("fp").count().where("count > 1").select("fp", F.col("fp").alias("other")))
        pairs = met.join(these.select("fp", F.col("me").alias("x")), "fp").join(these.select(F.col("fp").alias("other"), F.col("me").alias("y")), "other").where("x <> y")
        pairs = written(pairs.select(F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high")).distinct(), "pairs")
        true = alike(pairs.select(F.col("low.node").alias("a"), F.col("high.node").alias("b")), sets, similarity)
        edges = pairs.join(true, (F.col("low.node") == F.col("a")) & (F.col("high.node") == F.col("b")), "left_semi")
        return first_of_neighbours(written(edges, "edges")).select("node.node")

    def without(these: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
        return written(these.join(nodes.select(F.col("node").alias("_gone")), F.col("me.node") == F.col("_gone"), "left_anti").select("fp", "keys", "me"), name)

    rest = rows.where("NOT centre").select("fp", "keys", "me")
    gone = like(rest, rows.where("centre").select("fp", "keys", "me"))
    left = without(rest, gone, "rows-left")
    while n := left.count():
        size = max(batch, n // BATCHES)
        # A bound on ids, so that a batch is a beginning of the order; null ids are the last batch.
        bound = left.where("NOT me.none").agg(F.percentile_approx("me.id", min(1.0, size / n), 1_000)).first()[0] if n > size else None
        inside = F.lit(True) if bound is None else ~F.col("me.none") & (F.col("me.id") <= bound)
        head = written(left.where(inside), "batch")
        late = written(among(head), "gone")
        gone = gone.unionByName(late)
        if bound is None:
            break
        tail = left.where(~inside)
        behind = like(tail, without(head, late, "stayed"))
        gone = gone.unionByName(behind)
        left = without(tail, behind, "rows-left")
    return gone
