"""Phrase collocation mining: contiguous pattern growth from projected occurrences, prefix by prefix.

Texts are lower-cased in A-Z and split at `[.,;:!?\\x0A-\\x0D]` into pieces, those into words `[^\\x20\\x09]+`. Everything counts per
language; null is the language `und`.

Each occurrence of a frequent word is a pointer into its piece, shipped as what a pattern can grow into: the words from there
on, four at most, cut where a word or a pair of words is surely not frequent. Equal ones of a task fall to one with a weight.
They are sorted by range over all tasks, so the projected occurrences of a prefix are neighbours, the prefixes of a task follow each
other, and a prefix with very many occurrences lies over several tasks, whose sums are added afterwards. A task grows patterns
to the right, depth first: the slice of a prefix falls into the slices of its extensions, and those of enough weight grow on.
Sorted rows are taken in bounded parts; patterns at the edge of a part are handed on without regard to their weight.

What cannot be frequent is found beforehand: words by exact counts, then pairs of frequent words, then triples of such pairs, these
by their hashes' counts. Tasks know the frequent ones of each length from a table of bits of a fixed size, which every hash of
a frequent one sets: what has no bit is not frequent. Others may pass, and more of them the fuller the tables are, but phrases are
counted exactly; only less is cut beforehand.

A phrase's score is that of its weakest cut: of a = f(phrase), l = f(first part), r = f(rest) it is floor(2000000 a / (l + r)), in
decimals of 38 digits. Ties go to the shorter first part. A candidate is dropped if its words lie inside a longer one that
has at least 80 % of its count. Null and empty texts have no words; repeated rows count each; ids and other columns are ignored;
an empty table gives no rows. Texts are valid UTF-8.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firn.llm.common import scratch, written

#: Words of the longest phrase, and the least count of a candidate.
LONGEST, LEAST = 4, 30
#: Best phrases of a language.
TOP = 2000
#: Bits of a table of frequent runs of words; bytes of a language's text that are taken at once, and of texts that wait for it.
BITS, CHUNK, WAITING = 1 << 26, 1 << 22, 1 << 23
#: Hashes of runs that are counted at once, and rows that are handed on at once.
COUNTED, ROWS = 1 << 21, 1 << 17
#: Sorted rows in which patterns grow at once.
PART = 1 << 18
#: A byte that no UTF-8 text has stands for the end of a piece.
_END = b"\xff"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + b"\t" + b".,;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + b" " + _END * 10)


def _chunks(batches: Iterator[pa.RecordBatch], wait: bool = True) -> Iterator[_Chunk]:
    """Texts of a language, of CHUNK bytes together at most, but for longer texts, which are whole. WAITING bytes of all languages
    are held at most; then those with an average share or more go, so that texts of rarer ones are not taken in small parts. Without
    `wait`, all go at CHUNK bytes of all languages."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter[str] = Counter()
    waiting = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            sizes[lang] += len(text)
            waiting += len(text)
            if sizes[lang] >= CHUNK or waiting >= (WAITING if wait else CHUNK):
                for full in list(sizes) if not wait else [lang] if sizes[lang] >= CHUNK else [x for x, n in sizes.items() if n * len(sizes) >= waiting]:
                    waiting -= sizes.pop(full)
                    yield _Chunk(full, held.pop(full))
    yield from itertools.starmap(_Chunk, held.items())


def _ahead(a: np.ndarray, n: int = 1) -> np.ndarray:
    """What stands n places on."""
    return np.concatenate([a[n:], np.zeros(min(n, len(a)), a.dtype)])


def _longer(run: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of runs with one word more."""
    mixed = run * np.uint64(0x9E3779B97F4A7C15) + (word ^ (word >> np.uint64(29)))
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def _distinct(cols: list[np.ndarray], bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of numbers of so many bits, and how many rows are equal to each."""
    if len(cols) * bits <= 64:
        key = np.zeros(len(cols[0]), np.uint64)
        for c in cols:
            key = key << np.uint64(bits) | c
        key, n = np.unique(key, return_counts=True)
        return [key >> np.uint64(k * bits) & np.uint64((1 << bits) - 1) for k in reversed(range(len(cols)))], n
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    new = np.flatnonzero(np.any([np.concatenate([np.ones(min(1, len(c)), bool), c[1:] != c[:-1]]) for c in cols], axis=0))
    return [c[new] for c in cols], np.diff(np.append(new, len(order)))


def _has(table: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    at = (hashed & np.uint64(8 * len(table) - 1)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


class _Chunk:
    """Texts of one language as numbers. at: the word of each place; words: what the numbers stand for, _END among them."""

    def __init__(self, lang: str, texts: list[bytes]):
        joined = _END.join(texts).translate(_TABLE).replace(_END, b" \xff ")
        # Arrow splits and numbers the words without an object for each; it looks for ASCII blanks and does not decode the bytes.
        whole = pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(joined)], np.int64)), pa.py_buffer(joined)])
        coded = pc.ascii_split_whitespace(whole).flatten().dictionary_encode()
        self.lang, self.at, self.words = lang, coded.indices.to_numpy(), coded.dictionary.cast(pa.large_binary())
        self.named = self.words.to_pylist()
        self.real = np.ones(len(self.named), bool)
        if b"" in self.named:  # beside a blank at either end
            self.real[empty := self.named.index(b"")] = False
            self.at = self.at[self.at != empty]
        if _END in self.named:
            self.real[self.named.index(_END)] = False

    @cached_property
    def hashes(self) -> np.ndarray:
        head = self.lang.encode("utf-8", "surrogatepass") + b"\t"
        return np.fromiter((xxhash.xxh64_intdigest(head + w, seed=42) for w in self.named), np.uint64, len(self.named))

    def frequent(self, table: np.ndarray) -> np.ndarray:
        """Which of the words may be frequent."""
        return self.real & _has(table, self.hashes)

    def runs(self, tables: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Hashes of the runs, one word longer than there are tables, whose shorter runs may all be frequent; and for each table, the
        first of which is of single words, at which places a run of its length may be frequent."""
        own = self.hashes[self.at]
        run, flags = own, [self.frequent(tables[0])[self.at]]
        for n, table in enumerate([*tables[1:], None], 1):
            may = flags[-1] & _ahead(flags[-1])
            run = _longer(run, _ahead(own, n))
            if table is None:
                return run[may], flags
            may[may] = _has(table, run[may])
            flags.append(may)
        raise AssertionError

    def rows(self, words: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        langs = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(words), np.int32)), pa.array([self.lang])).cast(pa.string())
        return pa.RecordBatch.from_arrays([langs, words.cast(pa.binary()).cast(pa.string(), safe=False), pa.array(counts, pa.int64())], names=["lang", "words", "f"])


_ROWS = "lang string, words string, f bigint"


def _table(hashes: DataFrame, bits: int) -> bytes:
    """The bits that the rows' `hash` sets; `bits` / 8 bytes, however many rows there are."""
    place = F.col("hash").bitwiseAND(F.lit(bits - 1))
    blocks = hashes.select(F.shiftright(place, 15).alias("block"), place.bitwiseAND(F.lit(32767)).alias("bit")).groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    table = bytearray(bits // 8)
    for row in blocks.collect():  # of 4 kB, together no more than the table
        table[row["block"] * 4096 : row["block"] * 4096 + 4096] = row["bits"]
    return bytes(table)


def _texts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text")).where("text is not null")


def _counted(partial: DataFrame) -> DataFrame:
    return partial.groupBy("lang", "words").agg(F.sum("f").alias("f"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, words, f) of every word, and of all words together where `words` is null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            n = np.bincount(chunk.at, minlength=len(chunk.words)) * chunk.real
            here = np.flatnonzero(n)
            words = pa.concat_arrays([chunk.words.take(pa.array(here)), pa.nulls(1, pa.large_binary())])
            yield chunk.rows(words, np.append(n[here], n.sum()))

    return _counted(texts.mapInArrow(count, _ROWS))


def run_counts(texts: DataFrame, tables: list[bytes]) -> DataFrame:
    """(hash, f): runs one word longer than there are tables whose shorter runs may all be frequent, counted by the lower half of their
    hash, since equal halves of different runs only let more pass."""
    shared = [texts.sparkSession.sparkContext.broadcast(t) for t in tables]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [np.frombuffer(t.value, np.uint8) for t in shared]
        held: list[np.ndarray] = []
        for chunk in itertools.chain(_chunks(batches), [None]):
            if chunk:
                held.append(chunk.runs(own)[0].astype(np.uint32))
            if sum(map(len, held)) >= COUNTED or not chunk:
                hashed, n = np.unique(np.concatenate([np.zeros(0, np.uint32), *held]), return_counts=True)
                held = []
                for lo in range(0, len(hashed), ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(hashed[lo : lo + ROWS].astype(np.int64)), pa.array(n[lo : lo + ROWS], pa.int64())], names=["hash", "f"])

    return texts.mapInArrow(count, "hash bigint, f bigint").groupBy("hash").agg(F.sum("f").alias("f"))


def occurrences(texts: DataFrame, tables: list[bytes]) -> DataFrame:
    """(lang, words, f): from each place where a pair may be frequent, the words on, four at most, each followed by a blank, as far as
    pairs and triples may be frequent by their tables; f of them, summed over the texts that a task takes at once."""
    shared = [texts.sparkSession.sparkContext.broadcast(t) for t in tables]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [np.frombuffer(t.value, np.uint8) for t in shared]
        for chunk in _chunks(batches, wait=False):
            _, (_, pair, triple) = chunk.runs(own)
            # Numbers of the words that may be frequent; 0: no word.
            frequent = np.flatnonzero(chunk.frequent(own[0]))
            number = np.zeros(len(chunk.named), np.uint64)
            number[frequent] = np.arange(1, len(frequent) + 1)
            w, at = number[chunk.at], np.flatnonzero(pair)
            third, fourth = triple[at], triple[at] & _ahead(triple)[at]
            cols, n = _distinct([w[at], _ahead(w)[at], _ahead(w, 2)[at] * third, _ahead(w, 3)[at] * fourth], len(frequent).bit_length())
            words = pa.array([b"", *(chunk.named[k] + b" " for k in frequent.tolist())], pa.large_binary())
            yield chunk.rows(pc.binary_join_element_wise(*(words.take(pa.array(c)) for c in cols), pa.scalar(b"", pa.large_binary())), n)

    return texts.mapInArrow(project, _ROWS)


def grown(lang: np.ndarray, words: np.ndarray, weight: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(row, length, weight) of patterns of two words and more in sorted rows of words (numbers, -1 behind the last): the pattern is
    the first `length` words of the row. Patterns that reach the first or the last row are given whatever their weight."""
    n, depth = words.shape
    change = np.concatenate([[True], lang[1:] != lang[:-1]]) if n else np.zeros(0, bool)
    starts = []
    for d in range(depth):
        change = change | np.concatenate([[True], words[1:, d] != words[:-1, d]])
        starts.append(np.flatnonzero(change))
    total = np.concatenate([[0], np.cumsum(weight)])
    found: list[tuple[int, int, int]] = []

    def grow(lo: int, hi: int, d: int) -> None:
        own = starts[d][np.searchsorted(starts[d], lo) : np.searchsorted(starts[d], hi)]
        ends = np.append(own[1:], hi)
        support = total[ends] - total[own]
        for i in np.flatnonzero(((support >= least) | (own == 0) | (ends == n)) & (words[own, d] >= 0)).tolist():
            if d:
                found.append((int(own[i]), d + 1, int(support[i])))
            if d + 1 < depth:
                grow(int(own[i]), int(ends[i]), d + 1)

    if n:
        grow(0, n, 0)
    return found


def frequent_phrases(projected: DataFrame, least: int) -> DataFrame:
    """(lang, words, f) of phrases of two words and more with f >= least, from `occurrences`."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            lang = part.column("lang").combine_chunks().dictionary_encode()
            split = pc.split_pattern(part.column("words").combine_chunks().cast(pa.binary()), b" ")
            flat = split.flatten().dictionary_encode()
            size = np.diff(split.offsets.to_numpy()) - 1  # a blank follows the last word
            at = np.minimum(split.offsets.to_numpy()[:-1, None] - split.offsets[0].as_py() + np.arange(LONGEST), len(flat) - 1)
            numbers = np.where(np.arange(LONGEST) < size[:, None], flat.indices.to_numpy()[at], -1)
            langs = lang.indices.to_numpy()
            found = grown(langs, numbers, part.column("f").to_numpy(), least)
            names, vocabulary = lang.dictionary, flat.dictionary.to_pylist()
            row = np.array([r for r, _, _ in found], np.int64)
            words = pa.array([b" ".join(vocabulary[k] for k in numbers[r, :d]) for r, d, _ in found], pa.binary()).cast(pa.string(), safe=False)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(langs[row])), words, pa.array([f for _, _, f in found], pa.int64())], names=["lang", "words", "f"])

    ordered = projected.repartitionByRange("lang", "words").sortWithinPartitions("lang", "words")
    return _counted(ordered.mapInArrow(grow, _ROWS)).where(F.col("f") >= least)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= PART:
            yield pa.Table.from_batches(held)
            held = []
    if sum(map(len, held)):
        yield pa.Table.from_batches(held)


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each language by score, then count, then bytes of the phrase."""
    texts = _texts(docs, lang, text)
    counted = written(word_counts(texts).where((F.col("f") >= least) | F.col("words").isNull()), "words")
    words = counted.where("words is not null")
    tables = [_table(words.select(F.xxhash64(F.concat("lang", F.lit("\t"), "words")).alias("hash")), BITS)]
    while len(tables) < LONGEST - 1:  # of pairs, then of triples
        tables.append(_table(run_counts(texts, tables).where(F.col("f") >= least), BITS))
    with scratch(docs.sparkSession) as keep:
        phrases = keep(frequent_phrases(written(occurrences(texts, tables), "occurrences"), least), "phrases")
    size = F.size(F.split("words", " "))
    # A phrase within a longer one: of the longer ones' counts the largest decides.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice(F.split("words", " "), i, n), " "))))
    around = phrases.where(size > 2).select("lang", F.explode(inner).alias("words"), F.col("f").alias("longer")).groupBy("lang", "words").agg(F.max("longer").alias("longer"))
    wide = lambda c: c.cast("decimal(20,0)")
    swallowed = F.coalesce(100 * wide(F.col("longer")) >= 80 * wide(F.col("f")), F.lit(False))
    left = phrases.join(around, ["lang", "words"], "left").where(~swallowed).select("lang", "words", F.col("f").alias("a"))
    # Rows of a hot part ("the" ends very many phrases) are split by Spark where both sides are tables.
    w = F.split("words", " ")
    cut = left.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cut = cut.select("*", F.array_join(F.slice(w, F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice(w, F.col("k") + 1, size), " ").alias("tail"))
    part = written(words.unionByName(phrases), "parts")
    cut = written(cut, "cuts").join(part.select("lang", F.col("words").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = written(cut, "heads").join(part.select("lang", F.col("words").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    # As a is at most l and r, the quotient is at most a million.
    score = F.expr("(cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    weakest = cut.select("*", score.alias("score")).groupBy("lang", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("at"))
    weakest = weakest.select("lang", F.col("words").alias("phrase"), "a", "at.l", "at.r", "at.score")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    deal = F.pmod(F.xxhash64("phrase"), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # The best of each share of a language, then the best of those.
    best = weakest.withColumn("deal", deal).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    n = counted.where("words is null").select("lang", F.col("f").alias("n"))
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
