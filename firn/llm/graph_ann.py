"""Approximate nearest neighbours by robust-pruned directed graphs, one a shard, searched by beam.

Vectors are dealt over shards of about `shard_rows` by a hash of their components. One task builds a shard's graph: points
come in batches, a greedy search over the graph so far proposes neighbours for each, and of these, nearest first, a candidate
stays unless one that stayed is nearer to it by the factor `alpha` (relaxed distance pruning, so that edges stay diverse and
some are long). Edges are entered in reverse too and pruned again where a point has too many. A search keeps the `beam`
nearest points found, opens the nearest unopened one until none is left, in every shard; the shards' answers are merged.
Distances of answers are computed anew in double precision.

Equal vectors are one point, with its k + 1 smallest ids: no answer needs more of them, a vector that a third of the rows have
costs a task k + 1 rows, and no graph has to tell equal points apart. Shards and blocks of queries are bounded, so a task's
memory is bounded by `shard_rows` and `block`.

Rows whose id or vector is null, whose vector is empty or zero or holds a null or a component that is not finite take no part.
Vectors of different lengths never meet. Repeated rows count once; if an id has several vectors, the nearest of them counts,
and a query of several vectors looks from all of them. Ties go to the smaller id. An empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firn.llm.common import written

#: Distinct vectors of a shard, most edges of a point, points kept by a search while building, by a query; slack of pruning.
SHARD_ROWS, DEGREE, BUILD_BEAM, BEAM, ALPHA = 4096, 32, 48, 128, 1.2
#: Queries of a block, which meets a shard in one task; points or queries that search at once.
BLOCK, LOCKSTEP = 65_536, 256
#: A search begins at so many points: the one nearest to the mean and others by chance.
ENTRIES = 16


def _distances(x: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of q (rows) to the points at[row]; infinite where at is negative."""
    apart = x[at] - q[:, None, :]
    d = np.einsum("brd,brd->br", apart, apart)
    d[at < 0] = np.inf
    return d


def beam_search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, q: np.ndarray, beam: int, seen: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(points, squared distances) of the nearest `beam` points found for each row of q, nearest first, -1 where there are fewer.
    `seen` gets what each step opened, as (rows, points, distances)."""
    ids = np.full((len(q), beam), -1, np.int32)
    dist = np.full((len(q), beam), np.inf, np.float32)
    first = np.broadcast_to(entries[:beam], (len(q), min(beam, len(entries))))
    ids[:, : first.shape[1]], dist[:, : first.shape[1]] = first, _distances(x, q, first)
    is_open = ids >= 0
    while True:
        masked = np.where(is_open, dist, np.inf)
        best = masked.argmin(1)
        rows = np.flatnonzero(np.isfinite(masked[np.arange(len(q)), best]))
        if not len(rows):
            break
        best = best[rows]
        if seen is not None:
            seen.append((rows, ids[rows, best], dist[rows, best]))
        is_open[rows, best] = False
        near, have = graph[ids[rows, best]], ids[rows]
        near = np.where((near[:, :, None] == have[:, None, :]).any(2), -1, near)
        all_ids, all_dist = np.concatenate([have, near], 1), np.concatenate([dist[rows], _distances(x, q[rows], near)], 1)
        keep = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        ids[rows], dist[rows] = np.take_along_axis(all_ids, keep, 1), np.take_along_axis(all_dist, keep, 1)
        all_open = np.concatenate([is_open[rows], near >= 0], 1)
        is_open[rows] = np.take_along_axis(all_open, keep, 1) & np.isfinite(dist[rows])
    order = dist.argsort(1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    ids[~np.isfinite(dist)] = -1
    return ids, dist


def robust_prune(x: np.ndarray, norms: np.ndarray, cand: np.ndarray, dist: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each row, of candidates with their squared distances: nearest first, those that none chosen before is nearer to by
    the factor alpha; `degree` at most, -1 where there are fewer. Equal candidates count once."""
    order = dist.argsort(1, kind="stable")
    cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
    points = x[cand]
    own = norms[cand]
    between = own[:, :, None] + own[:, None, :] - 2 * np.matmul(points, points.transpose(0, 2, 1))
    alive = np.isfinite(dist)
    chosen = np.full((len(cand), degree), -1, np.int32)
    rows = np.arange(len(cand))
    for slot in range(degree):
        pick = alive.argmax(1)
        some = alive[rows, pick]
        if not some.any():
            break
        name = cand[rows, pick]
        chosen[some, slot] = name[some]
        alive &= (alpha * alpha * np.maximum(between[rows, pick], 0) > dist) & (cand != name[:, None])
    return chosen


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entries) of the points x, float32 by rows: graph[i] holds the edges of point i, padded with -1."""
    n = len(x)
    rng = np.random.default_rng(seed)
    norms = np.einsum("nd,nd->n", x, x)
    medoid = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    entries = np.unique(np.append(rng.choice(n, min(n, ENTRIES - 1), replace=False), medoid)).astype(np.int32)
    graph = np.full((n, degree), -1, np.int32)
    if n > 1:  # a graph by chance to begin with, as sparse as a fourth of the degree
        some = max(1, degree // 4)
        graph[:, :some] = rng.integers(0, n, (n, some))
        graph[graph == np.arange(n)[:, None]] = -1
    points = rng.permutation(n)
    for lo in range(0, n, LOCKSTEP):
        batch = points[lo : lo + LOCKSTEP]
        seen: list = []
        found, near = beam_search(x, graph, entries, x[batch], beam, seen)
        steps = np.full((len(batch), len(seen)), -1, np.int32)
        far = np.full((len(batch), len(seen)), np.inf, np.float32)
        for k, (rows, at, d) in enumerate(seen):
            steps[rows, k], far[rows, k] = at, d
        linked = graph[batch]
        cand = np.concatenate([found, steps, linked], 1)
        dist = np.concatenate([near, far, _distances(x, x[batch], linked)], 1)
        dist[cand == batch[:, None]] = np.inf
        graph[batch] = robust_prune(x, norms, cand, dist, degree, alpha)
        _reverse(x, norms, graph, batch, degree, alpha)
    return graph, entries


def _reverse(x: np.ndarray, norms: np.ndarray, graph: np.ndarray, batch: np.ndarray, degree: int, alpha: float) -> None:
    """Enter the edges of the batch's points in reverse; points with more than `degree` are pruned."""
    to, row = graph[batch].ravel(), np.repeat(batch, degree)
    to, row = to[to >= 0], row[graph[batch].ravel() >= 0]
    order = np.argsort(to, kind="stable")
    to, row = to[order], row[order]
    target, start, count = np.unique(to, return_index=True, return_counts=True)
    for width in (8, 64, LOCKSTEP):  # points of few new edges are not padded to those of many
        here = (count <= width) & (count > (0 if width == 8 else 8 if width == 64 else 64))
        for lo in range(0, int(here.sum()), LOCKSTEP):
            q, s, c = (a[here][lo : lo + LOCKSTEP] for a in (target, start, count))
            spot = np.arange(c.max())[None, :]
            new = np.where(spot < c[:, None], row[np.minimum(s[:, None] + spot, len(row) - 1)], -1).astype(np.int32)
            new[(new[:, :, None] == graph[q][:, None, :]).any(2)] = -1
            cand = np.concatenate([graph[q], new], 1)
            dist = _distances(x, x[q], cand)
            over = (cand >= 0).sum(1) > degree
            first = np.take_along_axis(cand, dist.argsort(1, kind="stable"), 1)[:, :degree]
            if over.any():
                first[over] = robust_prune(x, norms, cand[over], dist[over], degree, alpha)
            graph[q] = first


def valid(vec: Column) -> Column:
    """Whether a vector takes part: neither null nor empty nor zero, all components finite."""
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(vec, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray, dim: int, kind: type) -> np.ndarray:
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), dim)


def build_index(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> DataFrame:
    """The graphs as a table: dim, shard, shards (of that dim), node, vec, ids (the k + 1 smallest of the point), near (edges),
    entry (whether searches begin there)."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").alias("vec")).where(F.col("id").isNotNull() & valid(F.col("vec"))).groupBy("vec", "id").agg(F.lit(0).alias("_"))
    # The smallest ids of each vector are found before rows are shuffled by vector.
    least = rows.withColumn("at", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("at") <= k + 1)
    points = written(least.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), "points")
    sizes = {r["dim"]: r["n"] for r in points.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a length of vectors
    shards = {d: -(-n // shard_rows) for d, n in sizes.items()}
    if not shards:
        return points.sparkSession.createDataFrame([], _index_type(points))
    many = F.element_at(F.create_map(*(F.lit(v) for pair in shards.items() for v in pair)), F.size("vec"))
    dealt = points.select(F.size("vec").alias("dim"), many.alias("shards"), "vec", "ids").withColumn("shard", F.pmod(F.xxhash64("vec"), F.col("shards")).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        exact = _matrix(table.column("vec"), table.column("dim")[0].as_py(), np.float64)
        x = _placed(exact, *_frame(exact))
        graph, entries = build_graph(x, degree, beam, alpha)
        entry = np.zeros(len(x), bool)
        entry[entries] = True
        near = pa.ListArray.from_arrays(np.arange(0, graph.size + 1, degree, dtype=np.int32), pa.array(graph.ravel(), pa.int32()))
        table = table.select(["dim", "shard", "shards", "vec", "ids"])
        return table.append_column("node", pa.array(np.arange(len(x)), pa.int32())).append_column("near", near).append_column("entry", pa.array(entry)).select(["dim", "shard", "shards", "node", "vec", "ids", "near", "entry"])

    graphs = dealt.repartition(_tasks(sum(shards.values())), "dim", "shard").groupBy("dim", "shard").applyInArrow(build, _index_type(points))
    return written(graphs, "graphs")


def _frame(exact: np.ndarray) -> tuple[np.ndarray, float]:
    """Centre and scale of a shard that a few far points don't move."""
    centre = np.median(exact, 0)
    return centre, float(np.median(np.abs(exact - centre).max(1))) or 1.0


def _placed(exact: np.ndarray, centre: np.ndarray, scale: float) -> np.ndarray:
    """Where a graph has the points: in single precision about its centre; components over a thousand times the usual are cut
    there, so that a far point blurs no others. Answers are measured on the vectors themselves."""
    with np.errstate(over="ignore"):
        return np.clip((exact - centre) / scale, -1000, 1000).astype(np.float32)


def _exact(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances; where squares overflow they are taken of parts of the largest component."""
    apart = points - q
    with np.errstate(over="ignore"):
        far = np.sqrt((apart**2).sum(1))
    for i in np.flatnonzero(np.isinf(far)):
        most = np.abs(apart[i]).max()
        far[i] = most * np.sqrt(((apart[i] / most) ** 2).sum()) if np.isfinite(most) else np.inf
    return far


def _tasks(groups: int) -> int:
    """Partitions for so many groups that cost much to compute: few of them fall together."""
    return min(4 * groups, 20_000)


def _index_type(points: DataFrame) -> str:
    kinds = dict(points.dtypes)
    return f"dim int, shard int, shards int, node int, vec {kinds['vec']}, ids {kinds['ids']}, near array<int>, entry boolean"


def search(index: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, beam: int = BEAM, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query among all rows but those of its own id, by Euclidean
    distance in double precision, from a beam search of every shard."""
    asked = queries.select(F.col(f"`{id_col}`").alias("query_id"), F.col(f"`{vec_col}`").alias("asked")).where(F.col("query_id").isNotNull() & valid(F.col("asked"))).distinct()
    asked = written(asked.withColumn("dim", F.size("asked")), "queries")
    blocks = max(1, -(-asked.count() // block))
    shards = {r["dim"]: r["shards"] for r in index.groupBy("dim").agg(F.max("shards").alias("shards")).collect()}  # a row a length of vectors
    kind = dict(index.dtypes)["ids"][len("array<") : -1]
    result = f"query_id {dict(asked.dtypes)['query_id']}, vec_id {kind}, score double"
    if not shards:
        return index.sparkSession.createDataFrame([], result).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    many = F.element_at(F.create_map(*(F.lit(v) for pair in shards.items() for v in pair)), F.col("dim"))
    # A query of a length that no vector has meets no shard.
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).where(many.isNotNull()).withColumn("shard", F.explode(F.sequence(F.lit(0), many - 1)))
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def nearest(key: tuple, graph: pa.Table, wanted: pa.Table) -> pa.Table:
        names, others, scores = [], [], []
        if len(graph) and len(wanted):
            graph = graph.sort_by("node")
            dim = graph.column("dim")[0].as_py()
            exact, q_exact = _matrix(graph.column("vec"), dim, np.float64), _matrix(wanted.column("asked"), dim, np.float64)
            edges = _matrix(graph.column("near"), len(graph.column("near")[0]), np.int32)
            entries = np.flatnonzero(graph.column("entry").to_numpy()).astype(np.int32)
            frame = _frame(exact)
            x, q = _placed(exact, *frame), _placed(q_exact, *frame)
            ids, asks = graph.column("ids").to_pylist(), wanted.column("query_id").to_pylist()
            for lo in range(0, len(q), LOCKSTEP):
                found, _ = beam_search(x, edges, entries, q[lo : lo + LOCKSTEP], beam)
                for i, row in enumerate(found, lo):
                    row = row[row >= 0]
                    far = _exact(exact[row], q_exact[i])
                    best: dict = {}
                    last = -1.0
                    for d, at in sorted(zip(far.tolist(), row.tolist(), strict=True)):
                        if len(best) >= k and d > last:
                            break
                        for name in ids[at]:
                            if name != asks[i]:
                                best.setdefault(name, d)
                        last = d
                    for name, d in sorted(best.items(), key=lambda b: (b[1], b[0]))[:k]:
                        names.append(asks[i])
                        others.append(name)
                        scores.append(d)
        kinds = wanted.schema.field("query_id").type, graph.schema.field("ids").type.value_type, pa.float64()
        return pa.table([pa.array(v, t) for v, t in zip((names, others, scores), kinds, strict=True)], names=["query_id", "vec_id", "score"])

    keys = ["dim", "shard", "block"]
    tasks = _tasks(blocks * sum(shards.values()))
    left, right = index.repartition(tasks, *keys).groupBy(*keys), asked.repartition(tasks, *keys).groupBy(*keys)
    found = left.cogroup(right).applyInArrow(nearest, result)
    found = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
