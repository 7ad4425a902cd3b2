"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash of the last 32 code points cuts a text into chunks, so a passage that documents share is cut alike wherever
it stands. One pass counts chunks over all documents; those that repeat and save most work form a bounded list of shared
chunks, which one job encodes once for all documents. Cuts fall anywhere, so joins are repaired: each chunk gives up what lies
outside its first and last safe place, and the text between the shared ones is encoded as one piece. A place is
likely safe where a blank or line feed follows a character that is not white space. Each join is checked by its ids: the words
on its two sides are encoded together, and must give the ids that they have apart; where they don't, the join is widened to
the whole text, which is encoded as one piece. So are all texts if the vocabulary's pre-tokenizer is not one of bytes that
splits at blanks. Within a piece, runs of text between safe places of plain ASCII white space go through a dictionary that
the worker keeps, so the tokenizer sees frequent runs once: of two halves the older goes when the newer is full, and runs that
are met again move to the newer. Every run's ids are decoded; a text with one that does not come back is encoded and decoded
whole.

A null text counts as empty and has no tokens. Repeated rows and null ids give one result row each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firn.llm.common import worker_cache, written

#: Mean distance of cuts as a power of two, and the least length of a chunk, in code points.
CHUNK_BITS = 9
CHUNK_LEAST = 128
#: Code points that are hashed at once.
BLOCK = 1 << 13
#: Shared chunks, about, and the longest of them.
SHARED = 8_192
SHARED_CHARS = 8_192
#: Runs, and checked joins, that a worker keeps.
RUNS, JOINS = 200_000, 30_000
#: Runs that are encoded as one line, and lines that are encoded at once.
LINE, LINES = 128, 8
_RUN = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: White space, or what some tables take for it, beside the four characters above: a piece with any of it is one run.
_ODD = re.compile("[\x0b\x0c\x1c-\x1f\x7f-\xa0\u1680\u180e\u2000-\u206f\u3000\ufeff]")


def cuts(cps: np.ndarray) -> list[int]:
    """Places of content-defined cuts, without both ends."""
    found, last = [], 0
    for lo in range(0, len(cps), BLOCK):
        # The hash at a place takes 32 code points; those before the block are computed again.
        from_ = max(0, lo - 31)
        h = cps[from_ : lo + BLOCK] * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        for step in (1, 2, 4, 8, 16):
            if len(h) > step:
                h[step:] += h[:-step] << np.uint32(step)
        for at in (np.flatnonzero(h[lo - from_ :] < np.uint32(1 << (32 - CHUNK_BITS))) + lo + 1).tolist():
            if at - last >= CHUNK_LEAST and at < len(cps):
                found.append(at)
                last = at
    return found


def _safe(cps: np.ndarray) -> np.ndarray:
    at = np.flatnonzero((cps == 32) | (cps == 10))
    at = at[at > 0]
    before = cps[at - 1]
    solid = ((before > 32) & (before < 0x7F)) | (before > 0xA0)
    if len(before) and before.max() >= 0x1680:
        solid &= ~(((before >= 0x2000) & (before <= 0x206F)) | np.isin(before, (0x1680, 0x180E, 0x3000, 0xFEFF)))
    return at[solid]


def pieces(text: str) -> list[tuple[str, bool]]:
    """The text in pieces that encode apart; whether each is a chunk's inner part or a repaired join."""
    if len(text) < 2 * CHUNK_LEAST:
        return [(text, True)] if text else []
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = [0, *cuts(cps), len(text)]
    if len(bounds) == 2:
        return [(text, True)]
    safe = _safe(cps)
    left, right = np.searchsorted(safe, bounds[:-1], "left"), np.searchsorted(safe, bounds[1:], "right")
    out, done = [], 0
    for k, (lo, hi) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        start = 0 if k == 0 else int(safe[lo]) if lo < len(safe) else len(text)
        end = len(text) if k == len(bounds) - 2 else int(safe[hi - 1]) if hi else 0
        if end <= start:
            continue
        if start > done:
            out.append((text[done:start], False))
        out.append((text[start:end], True))
        done = end
    if done < len(text):
        out.append((text[done:], False))
    return out


def _splits_at_blanks(path: str) -> bool:
    """Whether texts may be encoded in pieces: a byte-level pre-tokenizer with its own pattern, nothing that rewrites texts."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    pre = made.get("pre_tokenizer") or {}
    return made.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)


def _tokenizer(path: str) -> tuple:
    """(tokenizer, newer and older half of kept runs, checked joins, bytes of each token, digits of each id, whether it splits at blanks) of this worker; runs map a text to its decimal ids joined by commas."""
    cache = worker_cache("bpe")
    if path not in cache:
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        # A token of the byte-level vocabulary is written with a character for each byte; an added one stands for itself.
        added = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
        sizes = np.array([len(added.get(i) or tokenizer.id_to_token(i) or "") for i in range(tokenizer.get_vocab_size())])
        cache[path] = (tokenizer, [{}, {}], {}, sizes, np.array([len(str(i)) for i in range(len(sizes))]), _splits_at_blanks(path))
    return cache[path]


def _encoded(tokenizer, texts: list[str]) -> list[tuple[str, int, str]]:
    ids = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    back = tokenizer.decode_batch(ids, skip_special_tokens=False)
    return [(",".join(map(str, i)), len(i), t if b == t else b) for t, i, b in zip(texts, ids, back, strict=True)]


def _encoded_runs(tokenizer, sizes: np.ndarray, digits: np.ndarray, runs: Iterable[str]) -> dict[str, str]:
    """Decimal ids of the runs that come back when decoded. Those that begin with white space and end without are encoded many at a
    time, as safe places part them, and told apart by their tokens' bytes."""
    many, alone, made = [], [], {}
    for r in runs:
        (many.append if r[0] <= " " < r[-1] else alone.append)(r)
    groups = [many[lo : lo + LINE] for lo in range(0, len(many), LINE)]
    for lo in range(0, len(groups), LINES):
        lines = ["".join(g) for g in groups[lo : lo + LINES]]
        ids = [e.ids for e in tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        for group, line, own, back in zip(groups[lo : lo + LINES], lines, ids, tokenizer.decode_batch(ids, skip_special_tokens=False), strict=True):
            numbers = np.array(own, np.int64)
            ends = np.cumsum(sizes[numbers])
            want = np.cumsum([*map(len, group)] if line.isascii() else [len(r.encode("utf-8", "surrogatepass")) for r in group])
            at = np.searchsorted(ends, want)
            if back != line or at[-1] >= len(ends) or (ends[at] != want).any():
                alone += group
                continue
            text, stop = ",".join(map(str, own)), np.cumsum(digits[numbers] + 1)[at].tolist()
            made.update(zip(group, [text[x : y - 1] for x, y in zip([0, *stop], stop, strict=False)], strict=True))
    made.update((r, ids) for r, (ids, _, back) in zip(alone, _encoded(tokenizer, alone), strict=True) if back == r)
    return made


def _name(piece: str) -> bytes:
    return xxhash.xxh3_128_digest(piece.encode("utf-8", "surrogatepass"))


def _tail(piece: str) -> str:
    """The last run of a piece."""
    end = len(piece.rstrip(" \t\n\r"))
    at = max(piece.rfind(c, 0, end) for c in " \t\n\r") + 1
    return piece[len(piece[:at].rstrip(" \t\n\r")) :]


def _broken_joins(tokenizer, runs: dict, joins: dict, parts: list[list[str]]) -> set[int]:
    """Numbers of the texts in which the words beside a join have other ids together than apart."""
    beside = [[(_tail(a), _RUN.match(b)[0]) for a, b in zip(own, own[1:], strict=False)] for own in parts]
    new = list({pair for own in beside for pair in own}.difference(joins))
    ids = lambda texts: [",".join(map(str, e.ids)) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    alone = list({x for pair in new for x in pair}.difference(runs))
    apart = dict(zip(alone, ids(alone), strict=True))
    known = lambda x: runs[x] if x in runs else apart[x]
    for (a, b), together in zip(new, ids([a + b for a, b in new]), strict=True):
        joins[a, b] = together == f"{known(a)},{known(b)}"
    return {k for k, own in enumerate(beside) if not all(joins[pair] for pair in own)}


def encode_texts(texts: list[str], path: str, shared: dict[bytes, tuple[str, int]] | None = None) -> list[tuple[str, int, str]]:
    """(decimal ids joined by commas, their number, decoded text) of each text; shared: ids and their number of chunks that are encoded already."""
    tokenizer, kept, joins, sizes, digits, splits = _tokenizer(path)
    if not splits:
        return _encoded(tokenizer, texts)
    if len(kept[0]) > RUNS // 2:
        kept[:] = {}, kept[0]
    if len(joins) > JOINS:
        joins.clear()
    runs, older = kept
    parts, known, cut, whole, new = [], {}, {}, set(), set()
    for t in texts:
        odd = _ODD.search(t) is not None
        part, at, end = [], 0, 0
        # Pieces that are not shared are not parted from each other, unless an odd one would have all of them encoded as one run.
        for piece, inner in pieces(t):
            start, end = end, end + len(piece)
            made = shared.get(_name(piece)) if shared and inner and CHUNK_LEAST <= len(piece) <= SHARED_CHARS else None
            if made is not None or odd:
                part += [t[at:start], piece] if at < start else [piece]
                at = end
            if made is not None:
                known[piece] = made[0]
        if at < end:
            part.append(t[at:])
        parts.append(part)
    for piece in {p for part in parts for p in part}.difference(known):
        if _ODD.search(piece) is None:
            cut[piece] = _RUN.findall(piece)
            new.update(itertools.filterfalse(runs.__contains__, cut[piece]))
        else:
            whole.add(piece)
    runs.update((r, older[r]) for r in new if r in older)
    runs.update(_encoded_runs(tokenizer, sizes, digits, new.difference(runs)))
    strange = new.difference(runs)
    known.update((p, ids) for p, (ids, _, back) in zip(whole, _encoded(tokenizer, list(whole)), strict=True) if back == p)
    known.update((piece, ",".join(map(runs.__getitem__, own))) for piece, own in cut.items() if strange.isdisjoint(own))
    broken = _broken_joins(tokenizer, runs, joins, parts)
    out = []
    for k, (text, part) in enumerate(zip(texts, parts, strict=True)):
        got = [known.get(p) for p in part]
        if k in broken or None in got:
            out.append(_encoded(tokenizer, [text])[0])
        else:
            ids = ",".join(got)
            out.append((ids, ids.count(",") + 1 if ids else 0, text))
    return out


def shared_chunks(texts: DataFrame, path: str, most: int = SHARED) -> dict[bytes, tuple[str, int]]:
    """Ids, and their number, of about `most` chunks that repeat over all documents, those that save most first, by name.

    Chunks are chosen by a histogram of what they save, so the driver gets them alone. Each is encoded once, from one text
    that holds it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, list[int]] = {}
            for text, at in zip(batch.column("body"), batch.column("at").to_pylist(), strict=True):
                for piece, inner in pieces(text.as_py() or ""):
                    if inner and CHUNK_LEAST <= len(piece) <= SHARED_CHARS:
                        entry = seen.setdefault(_name(piece), [0, len(piece), at])
                        entry[0] += 1
            both = np.array(list(seen.values()), np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), *(pa.array(both[:, c]) for c in range(3))], names=["chunk", "n", "chars", "at"])

    flat = texts.select("body", F.xxhash64("body").alias("at"))
    counts = flat.mapInArrow(count, "chunk binary, n bigint, chars bigint, at bigint").groupBy("chunk").agg(F.sum("n").alias("n"), F.max("chars").alias("chars"), F.min("at").alias("at"))
    counts = written(counts.where("n > 1").withColumn("step", F.floor(F.log2(F.expr("(n - 1) * chars")) * 8).cast("int")), "chunks")
    least, share, held = 0, 1.0, 0
    for r in counts.groupBy("step").count().orderBy(F.desc("step")).collect():  # some hundreds of steps at most
        least, share = r.step, min(1.0, (most - held) / r["count"])
        held += r["count"]
        if held >= most:
            break
    chance = F.pmod(F.xxhash64("chunk"), F.lit(1_000_003)) < share * 1_000_003
    chosen = written(counts.where((F.col("step") > least) | (F.col("step") == least) & chance).select("chunk", "at"), "shared-chunks")
    wanted = chosen.groupBy("at").agg(F.collect_list("chunk").alias("chunks"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)[0]
        for batch in batches:
            out = {}
            for text, chunks in zip(*(batch.column(c).to_pylist() for c in ("body", "chunks")), strict=True):
                named = {_name(p): p for p, inner in pieces(text) if inner}
                own = [c for c in chunks if c in named]
                for c, (ids, n, back) in zip(own, _encoded(tokenizer, [named[c] for c in own]), strict=True):
                    if back == named[c]:
                        out[c] = ids, n
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), pa.array([i for i, _ in out.values()], pa.string()), pa.array([n for _, n in out.values()], pa.int64())], names=["chunk", "ids", "n"])

    # About `most` rows.
    made = flat.join(F.broadcast(wanted), "at").dropDuplicates(["at"]).select("body", "chunks").mapInArrow(encode, "chunk binary, ids string, n bigint")
    return {bytes(r.chunk): (r.ids, r.n) for r in made.collect()}


def bpe(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 and, if asked for, ids.

    path: a tokenizer file that every executor can read, as installed with the vocabulary's package.
    """
    flat = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body"))
    shared = docs.sparkSession.sparkContext.broadcast(shared_chunks(flat.select("body"), path))
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, len(whole), 256):
                batch = whole.slice(lo, 256)
                got = encode_texts(batch.column("body").to_pylist(), path, shared.value)
                sha = [hashlib.sha256(ids.encode()).hexdigest() for ids, _, _ in got]
                back = [hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() for _, _, text in got]
                cols = [batch.column("id"), pa.array([n for _, n, _ in got], pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                if with_ids:
                    flat_ids = np.fromstring(",".join(ids for ids, n, _ in got if n), np.int32, sep=",")
                    ends = np.cumsum([0, *(n for _, n, _ in got)]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat_ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = flat.schema["id"].dataType.simpleString()
    return flat.mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
