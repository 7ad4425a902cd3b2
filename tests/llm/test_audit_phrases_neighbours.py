"""Filter audit, phrases and neighbours against plain Python, on awkward rows and on parts of the driver's tables."""

import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from firn.llm import filter_audit, graph_ann, phrases

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="session")
def some(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- filter audit


def plain_audit(docs, labels):
    ids = defaultdict(list)
    for i, t, _ in docs:
        ids[t or ""].append(i)
    good, toxic = ({i for i, *x in labels if x[k] == 1} for k in (0, 1))
    rows = []
    for i, t, s in docs:
        t = t or ""
        w = WORDS.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}
        fails["E"] = i is not None and any(j is not None and j < i for j in ids[t])
        rows.append((s or "", fails, i in good and i is not None, i in toxic and i is not None))
    out = {}
    for o in itertools.permutations("ABCDE"):
        for part in {r[0] for r in rows}:
            left = [r for r in rows if r[0] == part]
            for step, c in enumerate(o, 1):
                here, rest = [r for r in left if r[1][c]], [r for r in left if not r[1][c]]
                mine = [r for r in rows if r[0] == part]
                failing = sum(r[1][c] for r in mine)
                alone = sum(r[1][c] and sum(r[1].values()) == 1 for r in mine)
                out[part, "".join(o), step] = [len(rest), len(here), failing - len(here), alone, sum(r[2] for r in here), sum(r[3] for r in here)]
                left = rest
    share = Counter()
    for (part, o, step), v in out.items():
        share[part, o[step - 1]] += v[1]
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("table", ["docs", "some"])
def test_audit(table, request, spark, sf_dir):
    df = request.getfixturevalue(table)
    labels = [(3, 1, 0), (4, 1, 1), (9, None, 1), (9, 1, None), (12, 0, 1), (13, 1, 0), (None, 1, 1), (99, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int") if table == "docs" else spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in filter_audit.audit(df, labels).collect()}
    rows = [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]
    assert got == plain_audit(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert sum(1 for k in got if k[0] == "") in (0, 600)


def test_audit_edges(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(empty, labels).count() == 0
    two = {"X": lambda text, words, n: n > 100, "Y": lambda text, words, n: F.size(words) == 0}
    got = filter_audit.audit(docs, labels, two, part="lang")
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got.count() == 4 * 4  # the parts de, en, fr and the empty string
    # One text in very many documents, of which the smallest id occurs twice: those two stay.
    many = spark.range(3000).select((F.col("id") + 5).alias("doc_id"), F.lit("Same text").alias("text"), F.lit("s").alias("source"))
    twice = spark.createDataFrame([(1, "Same text", "s")] * 2, "doc_id bigint, text string, source string")
    (row,) = filter_audit.audit(many.union(twice), labels, {"E": filter_audit.DUPLICATE}).collect()
    assert (row.kept, row.removed, row.unique_fails, row.shapley) == (2, 3000, 3000, 3000)


def test_matrices_are_32_by_600():
    columns, found = filter_audit.matrices("ABCDE")
    assert len(columns) == 600 and all(m.shape == (32, 600) and m.dtype == np.int64 for m in found.values())


# --- phrases


def plain_phrases(rows, least, top):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    inside = Counter()
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i : i + k]] = max(inside[lang, w[i : i + k]], a)
    best = defaultdict(list)
    for (lang, w), a in cand.items():
        if 100 * inside[lang, w] < 80 * a:
            score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            best[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, i): (p.decode(), -a, l, r, total[lang], -s) for lang, found in best.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)}


def as_found(df):
    return {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


@pytest.mark.parametrize(("table", "least", "top"), [("docs", 2, 2000), ("docs", 3, 7), ("some", 4, 50), ("some", 30, 2000)])
def test_phrases(table, least, top, request, monkeypatch):
    monkeypatch.setattr(phrases, "PART", 700)  # patterns that lie over many parts
    monkeypatch.setattr(phrases, "CHUNK", 20_000)
    df = request.getfixturevalue(table)
    want = plain_phrases([(r.lang, r.text) for r in df.select("lang", "text").collect()], least, top)
    assert as_found(phrases.collocations(df, least=least, top=top)) == want


def test_phrases_with_full_tables_of_bits(some, monkeypatch):
    """If every bit is set nothing is cut beforehand, and results are the same."""
    want = as_found(phrases.collocations(some, least=10))
    monkeypatch.setattr(phrases, "_table", lambda hashes, bits: b"\xff" * (bits // 8))
    assert as_found(phrases.collocations(some, least=10)) == want


def test_phrases_edges(spark, empty):
    assert phrases.collocations(empty).count() == 0
    rows = [("\x01 a\tB\x1c c.d", "en")] * 30 + [("x " * 100, None), ("y y y y", "und"), (None, "en"), ("", "en")]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert as_found(phrases.collocations(df)) == plain_phrases([(b, a) for a, b in rows], 30, 2000)


def test_texts_of_a_rare_language_are_taken_together(monkeypatch):
    """Texts wait until their language has enough of them, or an average share of what waits; none is lost."""
    import pyarrow as pa

    monkeypatch.setattr(phrases, "CHUNK", 1000)
    monkeypatch.setattr(phrases, "WAITING", 2000, raising=False)
    texts = [("rare" if k % 10 == 0 else "often", f"w{k} " * 10) for k in range(300)] + [("long", "l " * 5000)]
    batches = [pa.RecordBatch.from_pydict({"lang": [x for x, _ in texts[lo : lo + 7]], "text": [t for _, t in texts[lo : lo + 7]]}) for lo in range(0, len(texts), 7)]
    made, found = Counter(), Counter()
    for chunk in phrases._chunks(iter(batches)):
        made[chunk.lang] += 1
        found.update((chunk.lang, w.decode()) for w in chunk.words.take(pa.array(chunk.at)).to_pylist() if w != phrases._END)
    assert found == Counter((lang, w) for lang, t in texts for w in t.split())
    assert made["rare"] <= 2 and made["long"] == 1 and made["often"] < 20


@pytest.mark.parametrize("bits", [3, 16, 17, 31])
def test_distinct_rows_of_numbers(bits):
    rng = np.random.default_rng(bits)
    top = rng.integers(0, 1 << bits, 3).tolist() + [0, (1 << bits) - 1]
    for n in (0, 1, 500):
        rows = rng.choice(np.array(top, np.uint64), (n, 4))
        cols, f = phrases._distinct(list(rows.T), bits)
        assert dict(zip(zip(*(c.tolist() for c in cols)), f.tolist())) == Counter(map(tuple, rows.tolist())) and len(f) == len(set(map(tuple, rows.tolist())))


# --- neighbours


def plain_neighbours(rows, asked, k=10):
    rows = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q in {i for i, _ in rows if asked(i)}:
        best = {}
        for i, v in rows:
            for j, u in rows:
                if j == q and i != q and len(u) == len(v):
                    best[i] = min(best.get(i, math.inf), math.dist(u, v))
        for n, (d, i) in enumerate(sorted((d, i) for i, d in best.items())[:k], 1):
            out[q, n] = i, d
    return out


def found_by(df, asked, **more):
    index = graph_ann.build_index(df, **more)
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in graph_ann.search(index, df.where(asked)).collect()}


def same(got, want):
    return got.keys() == want.keys() and all(got[k][0] == want[k][0] and math.isclose(got[k][1], want[k][1], rel_tol=1e-12, abs_tol=1e-12) for k in want)


@pytest.mark.parametrize("shard_rows", [5, 4096])
def test_neighbours_of_awkward_rows(spark, shard_rows):
    rng = np.random.default_rng(3)
    some = [(i, rng.normal(size=3).tolist()) for i in range(1, 40)]
    rows = [*some, (0, [1.0, 2.0, 3.0]), *((i, [1.0, 2.0, 3.0]) for i in range(200, 240)), (300, [1.0, 2.0, 3.0]), (300, [1.0, 2.0, 3.0]), (400, [5.0, 5.0]), (401, [4.0, 5.0])]
    rows += [(500, None), (600, []), (700, [0.0, 0.0, 0.0]), (800, [1.0, None, 2.0]), (900, [float("nan"), 1.0, 1.0]), (1000, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (1100, [7.0] * 5)]
    rows += [(1200, [1.0, 0.0, 0.0]), (1200, [0.0, 4.0, 0.0]), (1300, [1e200, 1.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, id int, shard string").repartition(3)
    got = found_by(df, "vec_id % 100 = 0", shard_rows=shard_rows)
    want = plain_neighbours(rows, lambda i: i % 100 == 0)
    far = 1300
    assert same({k: v for k, v in got.items() if k[0] != far}, {k: v for k, v in want.items() if k[0] != far})
    # At such a distance all others are equally far in double precision, and which are found depends on the beam.
    assert len([k for k in got if k[0] == far]) == 10
    assert found_by(df.limit(0), "true") == {}


def test_recall(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = found_by(df, "vec_id % 100 = 0", shard_rows=200), plain_neighbours(rows, lambda i: i % 100 == 0)
    assert got.keys() == want.keys()
    assert len({(k[0], v[0]) for k, v in got.items()} & {(k[0], v[0]) for k, v in want.items()}) >= 0.95 * len(want)


def test_graph_of_clusters():
    """Tight clusters far apart: a search reaches them all, and edges stay within the degree."""
    rng = np.random.default_rng(7)
    x = (rng.normal(size=(40, 16)) * 20).repeat(50, 0) + rng.normal(size=(2000, 16))
    x = x.astype(np.float32)
    graph, entries = graph_ann.build_graph(x, degree=24, beam=40)
    assert graph.shape == (2000, 24) and all(len(set(g[g >= 0])) == (g >= 0).sum() and i not in g for i, g in enumerate(graph))
    found, _ = graph_ann.beam_search(x, graph, entries, x[::10], 64)
    hits = 0
    for q, f in zip(x[::10], found, strict=True):
        hits += len(set(np.argsort(((x - q) ** 2).sum(1))[:10]) & set(f[:10]))
    assert hits >= 0.95 * 10 * len(found)
