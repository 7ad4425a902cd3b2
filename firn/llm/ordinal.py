"""Quality by ordinal regression with cumulative links on graded ratings.

P(grade > k) = sigmoid(x w - t_k) with one weight vector over hashed features of the words, their shapes and immediate
repeats, and ordered thresholds t. Of these x is a mean over the words, so that a text of any length is read in whole. A few
words that spoil a good text would vanish in a mean: words that are far more frequent in texts of the middle grade than in those
of the highest one, by a test on the fit's sample, are cues, and x says of each whether the text has it. Out come the expected
grade and the tail probability on which documents are selected: that of the highest grade, so toxic ones go as those of low quality.

Grades: 0 for quality 0, 1 for quality 1 with toxic 1, else 2; a null toxic counts as 0, rows with null quality are not
used. The fit sees a bounded, seeded sample of rated documents, each of them whole: what comes to the driver of a document is
its features, at most BUCKETS numbers. Without ratings of two grades nothing is rejected. Null and empty texts have no words
to speak against them: they get the model's prior odds, and are accepted. Repeated rows and null ids are kept as they are, an empty table gives an empty result, and
other columns are ignored or handed through; those of the names that `scored` adds are replaced.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firn.llm.common import scratch, stripped, worker_cache, written

#: The fit sees at most so many rated documents.
ROWS = 2_500
BUCKETS = 1 << 15
#: Words that a worker keeps scores of.
KEPT = 120_000
#: A document stays if the probability of a grade of at least ACCEPT is at least this.
ACCEPT, TAIL = 2, 0.5
#: Cues: places of their hashes, least documents with one, least standard deviations above what is expected, and most of them.
CUE_BUCKETS, CUE_ROWS, CUE_DEVIATIONS, CUES = 1 << 22, 5, 6.0, 1024
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8, as blanks and control spaces part them, in the fit and in scoring."""
    return (text or "").encode("utf-8", "surrogatepass").split()


_SHAPE = bytes(ord("X") if chr(c).isupper() else ord("x") if chr(c).isalpha() else ord("9") if chr(c).isdigit() else c for c in range(128)) + bytes(range(128, 256))
_RUN = re.compile(rb"(.)\1+", re.S)


def word_features(word: bytes) -> tuple[int, int, int]:
    """Buckets of the word itself without case, its shape, and its last two characters."""
    if word.isascii():
        lower, shape, end = word.lower(), word[:64].translate(_SHAPE), word[-2:]
    else:
        text = word.decode("utf-8", "surrogatepass")
        made = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in text[:64])
        lower, shape, end = (x.encode("utf-8", "surrogatepass") for x in (text.lower(), made, text[-2:]))
    return tuple(zlib.crc32(k + v) % BUCKETS for k, v in ((b"w", lower), (b"s", _RUN.sub(rb"\1", shape)), (b"e", end)))


def cue_of(word: bytes) -> int:
    """Place of a word without case and marks around it."""
    return zlib.crc32(word.lower().strip(_MARKS)) % CUE_BUCKETS


#: Places of the weights behind the buckets; those of cues follow.
_REPEAT, _PRIOR, _CUES = BUCKETS, BUCKETS + 1, BUCKETS + 2


def doc_features(words: list[bytes]) -> dict[int, float]:
    """Mean features of a text; the weights' last places are that of immediate repeats and of the prior."""
    out: dict[int, float] = {_PRIOR: 1.0}
    for w, n in Counter(words).items():
        for f in word_features(w):
            out[f] = out.get(f, 0.0) + n / len(words)
    if repeats := sum(a == b for a, b in zip(words, words[1:], strict=False)):
        out[_REPEAT] = repeats / len(words)
    return out


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray
    #: Places of the cues in ascending order, whose weights are the last ones.
    cues: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def tails(self, score: np.ndarray) -> np.ndarray:
        """(n, grades - 1): P(grade > k)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], grades: int = 3, steps: int = 900, rate: float = 0.5, decay: float = 1e-5, seed: int = 42, cues: np.ndarray | None = None) -> Ordinal:
    """Maximum likelihood by Adagrad on minibatches of (features, values, grade); thresholds stay ordered as sums of exponentials."""
    rng = np.random.default_rng(seed)
    at, value, y = [a for a, _, _ in rows], [v for _, v, _ in rows], np.array([g for _, _, g in rows])
    cues = np.zeros(0, np.int64) if cues is None else cues
    w, gw = np.zeros(_CUES + len(cues)), np.full(_CUES + len(cues), 1e-3)
    raw, graw = np.array([-1.0] + [0.0] * (grades - 2)), np.full(grades - 1, 1e-3)
    for _ in range(steps):
        some = rng.integers(len(rows), size=min(256, len(rows)))
        ids = np.repeat(np.arange(len(some)), [len(at[i]) for i in some])
        feats, vals = np.concatenate([at[i] for i in some]), np.concatenate([value[i] for i in some])
        score = np.bincount(ids, w[feats] * vals, len(some))
        t = raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))])
        p = np.concatenate([np.ones((len(some), 1)), 1 / (1 + np.exp(np.clip(t[None] - score[:, None], -40, 40))), np.zeros((len(some), 1))], 1)
        slope = p * (1 - p)
        k = y[some]
        row = np.arange(len(some))
        mass = np.maximum(p[row, k] - p[row, k + 1], 1e-9)
        g = -(slope[row, k] - slope[row, k + 1]) / mass  # by the score
        gt = np.zeros(grades - 1)
        for j in range(grades - 1):
            gt[j] = (slope[row, k] * (k == j + 1) - slope[row, k + 1] * (k == j)) @ (1 / mass) / len(some)
        used, where = np.unique(feats, return_inverse=True)
        grad = np.bincount(where, g[ids] * vals, len(used)) / len(some) + decay * w[used]
        gw[used] += grad**2
        w[used] -= rate * grad / np.sqrt(gw[used])
        graded = np.array([gt.sum()] + [gt[j:].sum() * np.exp(raw[j]) for j in range(1, grades - 1)])
        graw += graded**2
        raw -= rate * graded / np.sqrt(graw)
    return Ordinal(w, raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))]), cues)


def rated(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts with their grade."""
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2)
    marks = labels.where("quality IS NOT NULL").select(F.col(f"`{id_col}`").alias("_id"), grade.alias("grade"))
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("body")).join(marks, "_id")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS, seed: int = 42) -> Ordinal | None:
    """Fit on at most `rows` rated documents, chosen by the hash of their id before texts are read."""
    n = labels.count()
    chosen = labels.withColumn("_order", F.xxhash64(F.col(f"`{id_col}`"), F.lit(seed))).where(F.pmod("_order", F.lit(1_000_003)) < min(1.0, 2 * rows / max(n, 1)) * 1_000_003).orderBy("_order", id_col).limit(rows)

    def features(frames):
        for pdf in frames:
            words = [words_of(t) for t in pdf["body"]]
            made = [doc_features(w) for w in words]
            seen = [np.unique(np.fromiter(map(cue_of, set(w)), np.int32)) for w in words]
            yield pd.DataFrame({"_id": pdf["_id"], "grade": pdf["grade"], "at": [np.fromiter(d, np.int32, len(d)) for d in made], "value": [np.fromiter(d.values(), np.float32, len(d)) for d in made], "seen": seen})

    lot = rated(docs, chosen, id_col, text_col)
    kind = lot.schema["_id"].dataType.simpleString()
    with scratch(docs.sparkSession):
        lot = written(lot.mapInPandas(features, f"_id {kind}, grade int, at array<int>, value array<float>, seen array<int>"), "rated")
        cues = _cues(lot)
        hits = F.array_intersect("seen", F.array(*map(F.lit, cues)).cast("array<int>"))
        got = lot.select("_id", "grade", "at", "value", hits.alias("hits")).orderBy("_id", "grade").limit(rows).toPandas()
    if got["grade"].nunique() < 2:
        return None
    place = lambda hits: np.searchsorted(cues, np.sort(np.asarray(hits, np.int64))) + _CUES
    made = [(np.concatenate([np.asarray(a, np.int64), place(h)]), np.concatenate([np.asarray(v, float), np.ones(len(h))]), int(g)) for a, v, h, g in zip(got["at"], got["value"], got["hits"], got["grade"], strict=True)]
    return fit(made, seed=seed, cues=np.array(cues, np.int64))


def _cues(lot: DataFrame) -> list[int]:
    """Places of words that documents of the middle grade have far more often than those of the highest, ascending, CUES at most."""
    lot = lot.where("grade >= 1")
    n, low = lot.agg(F.count(F.lit(1)), F.count(F.when(F.col("grade") == 1, 1))).first()
    if not low or low == n:
        return []
    p = low / n
    held = lot.select("grade", F.explode("seen").alias("cue")).groupBy("cue").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("grade") == 1, 1)).alias("low"))
    deviations = (F.col("low") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p))
    best = held.where((F.col("n") >= CUE_ROWS) & (deviations > CUE_DEVIATIONS)).orderBy(deviations.desc(), "cue").limit(CUES)
    return sorted(r["cue"] for r in best.collect())


def scored(docs: DataFrame, model: Ordinal | None, text_col: str = "text", accept: int = ACCEPT, tail: float = TAIL) -> DataFrame:
    """docs with expected_grade, tail_probability of a grade of at least `accept`, top_probability (of the highest grade), and accepted.

    Without a model the grade is null, the probabilities are 1 and all rows are accepted.
    """
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    added = ["expected_grade", "tail_probability", "top_probability", "accepted"]

    def scores(texts: list[str | None], model: Ordinal) -> np.ndarray:
        """The mean of the scores of a text's words, which a worker keeps, and the share of immediate repeats."""
        cache = worker_cache("ordinal")
        if cache.get("key") != key or len(cache["at"]) > KEPT:
            cache.update(key=key, at={}, score=np.zeros(0), cue=np.zeros(0, np.int64))
        at, parts = cache["at"], [words_of(t) for t in texts]
        known, sizes = len(at), np.array([len(p) for p in parts])
        ids = np.array([at.setdefault(w, len(at)) for p in parts for w in p], np.int64)
        if len(at) > known:
            fresh = np.array([word_features(w) for w in islice(at, known, None)], np.int64)
            cache["score"] = np.concatenate([cache["score"], model.weights[fresh].sum(1)])
            places = np.fromiter(map(cue_of, islice(at, known, None)), np.int64, len(at) - known)
            spot = np.searchsorted(model.cues, places)
            found = np.append(model.cues, -1)[spot] == places
            cache["cue"] = np.concatenate([cache["cue"], np.where(found, spot, -1)])
        owner = np.repeat(np.arange(len(parts)), sizes)
        again = np.flatnonzero((ids[1:] == ids[:-1]) & (owner[1:] == owner[:-1]))
        total = np.bincount(owner, cache["score"][ids], len(parts)) + model.weights[_REPEAT] * np.bincount(owner[again], minlength=len(parts))
        score = model.weights[_PRIOR] + total / np.maximum(sizes, 1)
        cue = cache["cue"][ids]
        held = np.unique(np.stack([owner[cue >= 0], cue[cue >= 0]]), axis=1)  # each cue of a text once
        return score + np.bincount(held[0], model.weights[_CUES + held[1]], len(parts))

    @F.pandas_udf("expected_grade double, tail_probability double, top_probability double")
    def grade(text: pd.Series) -> pd.DataFrame:
        model = shared.value
        if model is None:
            return pd.DataFrame({"expected_grade": np.full(len(text), np.nan), "tail_probability": np.ones(len(text)), "top_probability": np.ones(len(text))})
        texts = text.tolist()
        p = model.tails(np.concatenate([np.zeros(0), *(scores(texts[lo : lo + 256], model) for lo in range(0, len(texts), 256))]))
        return pd.DataFrame({"expected_grade": p.sum(1), "tail_probability": p[:, accept - 1], "top_probability": p[:, -1]})

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).alias("row")
    made = docs.select(row, grade(F.col(f"`{text_col}`")).alias("grade"), (stripped(F.col(f"`{text_col}`")) == "").alias("bare"))
    return made.select("row.*", F.nanvl("grade.expected_grade", F.lit(None)).alias("expected_grade"), "grade.tail_probability", "grade.top_probability", ((F.col("grade.tail_probability") >= tail) | F.col("bare")).alias("accepted"))


def accepted(docs: DataFrame, model: Ordinal | None, text_col: str = "text", accept: int = ACCEPT, tail: float = TAIL) -> DataFrame:
    """The rows of docs that are good enough, with their columns."""
    made = scored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text_col}`").alias("_text")), model, "_text", accept, tail)
    return made.where("accepted").select("_row.*")
