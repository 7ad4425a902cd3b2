"""Language identification with a linear-chain conditional random field over words.

A word's features are its character n-grams with word-boundary marks (those at a mark are its affixes), itself, and the
languages that a lexicon from the training texts gives it. Transitions between the languages of neighbouring words are
learned. Forward-backward gives each word's language probabilities; a document's language is that with the highest mean.

Texts are lower-cased and words are runs of letters (Unicode's L), so a null text or one without letters has no language
(`und`, score 0). Training takes a bounded, seeded sample of the distinct texts of each language, each of them whole;
prediction never sees language, source or id. Repeated rows and null ids give one result row each; an empty table gives an
empty result; without any training row all is `und`. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firn.llm.common import worker_cache, written

#: The fit sees at most so many texts of a language, of so many characters together; texts longer than LONG come last.
ROWS, CHARS, LONG = 300, 400_000, 20_000
BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
#: Words that a worker keeps scores of, and words that pass through one chain.
KEPT, CHAIN = 400_000, 200_000
#: More languages than this are an error.
LANGUAGES = 256
_WORD = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word's number, feature) of all features of distinct words, but those of the lexicon."""
    marked = [f"^{w}$" for w in words]
    lens = np.array([len(w) for w in marked], np.int64)
    cps = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lens)
    ids, feats = [], []
    h = np.zeros(len(cps), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        h = h[: len(cps) - n + 1] * np.uint64(0x100000001B3) + cps[n - 1 :] if n > 1 else cps.copy()
        if n in GRAMS:
            ok = owner[: len(h)] == owner[n - 1 :]
            g = h[ok] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
            ids.append(owner[: len(h)][ok])
            feats.append(((g ^ (g >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64))
    import xxhash

    ids.append(np.arange(len(words)))
    feats.append(np.array([xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass"), 7) % BUCKETS for w in words], np.int64))
    return np.concatenate(ids), np.concatenate(feats)


def forward_backward(emit: np.ndarray, trans: np.ndarray, start: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probabilities of each word's labels, forward and backward messages) of chains that lie one after another.

    emit: (n, labels) log scores; first: where a chain begins. The row of words is cut into blocks that run side by side:
    the products of their transition matrices link them, so the result is that of a word-by-word pass.
    """
    n, labels = emit.shape
    size = max(1, int(n**0.5))
    blocks = -(-n // size)
    pad = blocks * size - n
    scores = np.exp(np.concatenate([emit, np.zeros((pad, labels))]) - np.concatenate([emit.max(1), np.zeros(pad)])[:, None]).reshape(blocks, size, labels)
    head = np.concatenate([first, np.ones(pad, bool)]).reshape(blocks, size)
    a, s = np.exp(trans), np.exp(start)
    product = np.broadcast_to(np.eye(labels), (blocks, labels, labels)).copy()
    for k in range(size):
        product = np.where(head[:, k, None, None], product.sum(2, keepdims=True) * s, product @ a) * scores[:, k, None, :]
        product /= product.sum((1, 2), keepdims=True)
    into, back = np.empty((blocks, labels)), np.empty((blocks, labels))
    v = np.full(labels, 1 / labels)
    for b in range(blocks):
        into[b] = v
        v = v @ product[b]
        v /= v.sum()
    v = np.ones(labels)
    for b in range(blocks - 1, -1, -1):
        back[b] = v
        v = product[b] @ v
        v /= v.sum()
    alpha, beta = np.empty_like(scores), np.empty_like(scores)
    v = into
    for k in range(size):
        v = np.where(head[:, k, None], v.sum(1, keepdims=True) * s, v @ a) * scores[:, k]
        v = v / v.sum(1, keepdims=True)
        alpha[:, k] = v
    v = back
    for k in range(size - 1, -1, -1):
        beta[:, k] = v
        w = scores[:, k] * v
        v = np.where(head[:, k, None], (w @ s)[:, None], w @ a.T)
        v = v / v.sum(1, keepdims=True)
    alpha, beta = alpha.reshape(-1, labels)[:n], beta.reshape(-1, labels)[:n]
    gamma = alpha * beta
    return gamma / gamma.sum(1, keepdims=True), alpha, beta


@dataclass
class Crf:
    """A fitted chain: weights of features, of the lexicon, of transitions and of starts."""

    languages: list[str]
    weights: np.ndarray
    lexicon: dict[str, int] = field(default_factory=dict)
    lexical: np.ndarray | None = None
    trans: np.ndarray | None = None
    start: np.ndarray | None = None

    def emissions(self, words: list[str]) -> np.ndarray:
        ids, feats = features(words)
        out = np.stack([np.bincount(ids, self.weights[feats, c], len(words)) for c in range(len(self.languages))], 1)
        return out + self.lexical[[self.lexicon.get(w, len(self.languages)) for w in words]]


def fit(sequences: list[tuple[list[str], int]], languages: list[str], epochs: int = 6, rate: float = 0.2, seed: int = 42) -> Crf:
    """Train on (words, language) spans. Chains are made of a few spans each, so that there are switches to learn."""
    rng, labels = np.random.default_rng(seed), len(languages)
    model = Crf(languages, np.zeros((BUCKETS, labels)), {}, np.zeros((labels + 1, labels)), np.zeros((labels, labels)), np.zeros(labels))
    seen: dict[str, np.ndarray] = {}
    for words, lang in sequences:
        for w in set(words):
            seen.setdefault(w, np.zeros(labels))[lang] += 1
    model.lexicon = {w: int(c.argmax()) for w, c in seen.items() if c.sum() >= 3 and c.max() >= 0.9 * c.sum()}
    spans = [(words[lo : lo + 25], lang) for words, lang in sequences for lo in range(0, len(words), 25)]
    grads = [np.full_like(x, 1e-2) for x in (model.weights, model.lexical, model.trans, model.start)]

    def step(which: int, at, gradient: np.ndarray) -> None:
        param = (model.weights, model.lexical, model.trans, model.start)[which]
        grads[which][at] += gradient**2
        param[at] -= rate * gradient / np.sqrt(grads[which][at])

    for _ in range(epochs):
        order = rng.permutation(len(spans))
        for lo in range(0, len(order), 96):
            some = [spans[i] for i in order[lo : lo + 96]]
            words = [w for s, _ in some for w in s]
            truth = np.concatenate([np.full(len(s), lang) for s, lang in some])
            starts = np.cumsum([0, *(len(s) for s, _ in some[:-1])])
            first = np.zeros(len(words), bool)
            first[starts[::3]] = True  # three spans a chain
            ids, feats = features(words)
            lex = np.array([model.lexicon.get(w, labels) for w in words])
            # Of a third of the words the lexicon keeps silent, so that the n-grams are learned too.
            lex[rng.random(len(words)) < 0.33] = labels
            emit = np.stack([np.bincount(ids, model.weights[feats, c], len(words)) for c in range(labels)], 1) + model.lexical[lex]
            gamma, alpha, beta = forward_backward(emit, model.trans, model.start, first)
            error = gamma.copy()
            error[np.arange(len(words)), truth] -= 1
            error /= len(some)
            used, where = np.unique(feats, return_inverse=True)
            step(0, used, np.stack([np.bincount(where, error[ids, c], len(used)) for c in range(labels)], 1))
            g = np.zeros_like(model.lexical)
            np.add.at(g, lex, error)
            g[labels] = 0
            step(1, slice(None), g)
            inner = np.flatnonzero(~first)
            if len(inner):
                w = np.exp(emit[inner] - emit[inner].max(1, keepdims=True)) * beta[inner]
                pair = alpha[inner - 1][:, :, None] * np.exp(model.trans)[None] * w[:, None, :]
                g = (pair / pair.sum((1, 2), keepdims=True)).sum(0)
                np.add.at(g, (truth[inner - 1], truth[inner]), -1.0)
                step(2, slice(None), g / len(some))
            step(3, slice(None), error[first].sum(0))
    return model


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rows: int = ROWS, chars: int = CHARS, seed: int = 42) -> Crf | None:
    """Fit on at most `rows` distinct texts of each language, of `chars` characters together, in the order of their hashes.

    Hashes of all texts are counted once; texts are read for those chosen. A language of long texts alone gives one at least.
    """
    body = F.col(f"`{text_col}`")
    flat = docs.where(F.col(f"`{lang_col}`").isNotNull() & body.isNotNull()).select(F.col(f"`{lang_col}`").alias("lang"), body.alias("body"), F.xxhash64(body, F.lit(seed)).alias("order"))
    keys = written(flat.select("lang", "order", F.length("body").alias("n")).distinct(), "languages")
    counts = keys.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    if not counts:
        return None
    chance = F.create_map(*[F.lit(x) for r in counts for x in (r.lang, min(1.0, 3 * rows / r["count"]))])
    late = F.col("n") > LONG
    along = Window.partitionBy("lang").orderBy(late, "order")
    some = keys.where(F.pmod("order", F.lit(1_000_003)) < chance[F.col("lang")] * 1_000_003)
    some = some.withColumn("place", F.row_number().over(along)).withColumn("upto", F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    some = written(some.where((F.col("place") <= rows) & ((F.col("upto") <= chars) | (F.col("place") == 1))).select("lang", "order"), "chosen-texts")
    # At most `rows` a language, of at most LANGUAGES languages.
    got = flat.join(F.broadcast(some), ["lang", "order"]).dropDuplicates(["lang", "order"]).orderBy("lang", "order").select("lang", "body").collect()
    languages = sorted({r.lang for r in got})
    sequences = [(words_of(r.body), languages.index(r.lang)) for r in got]
    return fit([x for x in sequences if x[0]], languages, seed=seed) if any(w for w, _ in sequences) else None


def label_words(words: list[str], model: Crf, key: str, first: np.ndarray) -> np.ndarray:
    """Language probabilities of words; scores of distinct words are kept by the worker."""
    cache = worker_cache("crf")
    if cache.get("key") != key or len(cache["at"]) > KEPT:
        cache.update(key=key, at={}, emit=np.zeros((0, len(model.languages))))
    at = cache["at"]
    known = len(at)
    ids = np.fromiter((at.setdefault(w, len(at)) for w in words), np.int64, len(words))
    if len(at) > known:
        cache["emit"] = np.concatenate([cache["emit"], model.emissions(list(islice(at, known, None)))])
    return forward_backward(cache["emit"][ids], model.trans, model.start, first)[0]


def identify(docs: DataFrame, model: Crf | None, id_col: str = "doc_id", text_col: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """id, kept columns, lang_pred, score, and spans: runs of words of one language as (lang, words)."""
    flat = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("_body"), *(keep or []))
    names = [c for c in flat.columns if c != "_body"]
    if clash := {"lang_pred", "score", "spans"} & set(names) or len(set(names)) < len(names):
        raise ValueError(f"kept columns need other names: {clash}")
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def predict(texts: list[str | None]) -> tuple[list, list, list]:
        model, words, owner = shared.value, [], []
        for t in texts:
            own = words_of(t) if model else []
            owner.append(len(own))
            words += own
        langs, scores, spans = ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]
        if words:
            sizes = np.array(owner)
            begin = np.cumsum(sizes) - sizes
            full = np.flatnonzero(sizes)
            first = np.zeros(len(words), bool)
            first[begin[full]] = True
            gamma = label_words(words, model, key, first)
            mean = np.add.reduceat(gamma, begin[full], axis=0) / sizes[full][:, None]
            best = gamma.argmax(1)
            change = np.flatnonzero(first | np.concatenate([[True], best[1:] != best[:-1]]))
            run = np.diff(np.append(change, len(words)))
            of = np.searchsorted(begin[full], change, "right") - 1
            for d, m in zip(full.tolist(), mean, strict=True):
                langs[d], scores[d] = model.languages[int(m.argmax())], float(min(1.0, m.max()))
            for d, c, r in zip(full[of].tolist(), best[change].tolist(), run.tolist(), strict=True):
                spans[d].append({"lang": model.languages[c], "words": r})
        return langs, scores, spans

    kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = np.cumsum([len(t.as_py() or "") for t in whole.column("_body")]) if len(whole) else np.zeros(0)
            edges = [0, *(np.flatnonzero(np.diff(sizes // (5 * CHAIN))) + 1).tolist(), len(whole)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if hi > lo:
                    part = whole.slice(lo, hi - lo)
                    langs, scores, spans = predict(part.column("_body").to_pylist())
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, kind)], names=[*names, "lang_pred", "score", "spans"])

    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema if f.name in names)
    return flat.mapInArrow(run, f"{cols}, lang_pred string, score double, spans array<struct<lang:string,words:bigint>>")
