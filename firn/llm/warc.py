"""WARC archives under Zstandard: one frame a record, the dictionary in the leading skippable frame.

Spark's text writer puts out the frames, with an empty skippable frame as line separator, so each file is a plain
sequence of frames, lies in any store that Spark can write to, and is committed task by task. The reader takes whole
files of bounded size, walks the frames by their block headers, and checks each record's version line, required headers,
lengths and digests. What fails a check comes back as a row with `error` set and does not stop the others. Archives of other
writers are read as well: all record types, header names in any case, with or without a dictionary; a block that is no HTTP
message is the payload itself, and digests other than SHA-1 are handed through unchecked.

A null payload counts as empty and a null url as an empty one. Of pages with equal payloads of at least `least` bytes the
one with the largest id is the response and the others revisit it; null ids count as smallest; repeated rows of that id
are responses too. No pages give archives without records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firn.llm.common import shared_path, written

#: Fixed values of the formats: the magic of a skippable frame that holds a dictionary, of any skippable frame, of a frame.
DICT_MAGIC, SKIP_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0x184D2A50, 0xFD2FB528
#: An empty skippable frame; all its bytes are ASCII.
SEPARATOR = struct.pack("<II", SKIP_MAGIC, 0)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
TYPES = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
#: The dictionary is trained on the beginnings of so many pages.
DICT_PAGES, DICT_CHARS, DICT_BYTES = 256, 4_096, 32_768
_DATE = "2024-01-01T00:00:00Z"


def dictionary(pages: DataFrame, payload_col: str) -> bytes:
    """A dictionary from a bounded sample of pages, the same for the same pages."""
    body = F.substring(F.coalesce(F.col(payload_col), F.lit("")), 1, DICT_CHARS)
    share = min(1.0, 4 * DICT_PAGES / max(1, pages.count()))
    lot = pages.select(body.alias("body"), F.xxhash64(body).alias("order")).where("body <> ''").where(F.pmod("order", F.lit(1_000_003)) <= share * 1_000_003)
    some = [r.body.encode("utf-8", "surrogatepass") for r in lot.orderBy("order", "body").limit(DICT_PAGES).collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, some).as_bytes()
    except zstandard.ZstdError:  # too few samples: plain content serves as a dictionary as well
        return b"".join(some)[:DICT_BYTES] or b"WARC/1.1\r\nWARC-Type: response\r\n"


def record(page_id: int | None, url: str, payload: bytes, digest: str, keeper: int | None) -> bytes:
    """A whole record; keeper: the id of the response that this page revisits, else None."""
    revisit = keeper is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {uri}", f"WARC-Date: {_DATE}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{keeper}>"] if revisit else []),
        f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def frames(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(magic, start, end) of each frame; ValueError where the lengths don't hold. Of a skippable frame start is its content's."""
    at, view = 0, memoryview(data)
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError(f"cut off at {at}")
        magic, length = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == SKIP_MAGIC:
            end = at + 8 + length
            if end > len(data):
                raise ValueError(f"a skippable frame at {at} is longer than the file")
            yield magic, at + 8, end
        elif magic == FRAME_MAGIC:
            try:
                head = zstandard.get_frame_parameters(view[at : at + 18])
                end = at + zstandard.frame_header_size(view[at : at + 18])
            except zstandard.ZstdError as e:
                raise ValueError(f"frame at {at}: {e}") from e
            last = 0
            while not last:
                if end + 3 > len(data):
                    raise ValueError(f"frame at {at} is longer than the file")
                block = int.from_bytes(view[end : end + 3], "little")
                last, kind = block & 1, block >> 1 & 3
                end += 3 + (1 if kind == 1 else block >> 3)
            end += 4 * head.has_checksum
            if end > len(data):
                raise ValueError(f"frame at {at} is longer than the file")
            yield magic, at, end
        else:
            raise ValueError(f"no frame at {at}")
        at = end


def _fields(lines: list[str]) -> dict[str, str]:
    """Header fields by their names in lower case; continued lines belong to the field before them."""
    out: dict[str, str] = {}
    name = ""
    for line in lines:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _page(uri: str | None) -> int | None:
    """The page's id in a record's id of ours, else null."""
    own = (uri or "").strip("<>").removeprefix("urn:page:")
    return int(own) if own.lstrip("-").isdigit() else None


def parse(raw: bytes) -> dict:
    """The fields of a record; ValueError for what is wrong with it."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC header")
    named = _fields(lines[1:])
    if missing := [x for x in REQUIRED if x.lower() not in named]:
        raise ValueError(f"without {', '.join(missing)}")
    if not named["content-length"].isdigit() or int(named["content-length"]) + 4 != len(rest) or rest[-4:] != b"\r\n\r\n":
        raise ValueError("Content-Length does not hold")
    block, kind = rest[:-4], named["warc-type"].lower()
    if kind not in TYPES:
        raise ValueError(f"no record type {kind}")
    payload, stated, encoded = block, None, False
    if named.get("content-type", "").lower().startswith("application/http"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        fields = _fields(http.decode("latin-1").split("\r\n")[1:])
        encoded = "transfer-encoding" in fields
        if not gap:
            raise ValueError("no HTTP header")
        if "content-length" in fields:
            if not fields["content-length"].isdigit():
                raise ValueError("the HTTP header's length is no number")
            stated = int(fields["content-length"])
    whole = kind != "revisit" and "warc-truncated" not in named
    if kind == "response" and whole and stated is not None and stated != len(payload):
        raise ValueError("the payload's length does not hold")
    if kind == "revisit" and payload and stated is not None:
        raise ValueError("a revisit with a payload")
    if kind == "revisit" and not {"warc-refers-to", "warc-refers-to-target-uri", "warc-payload-digest"} & set(named):
        raise ValueError("a revisit of nothing")
    name, _, digest = named.get("warc-payload-digest", "").rpartition(":")
    if name.lower() == "sha1" and whole and not encoded and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest.upper():
        raise ValueError("the payload's digest does not hold")
    size = stated if kind == "revisit" else len(payload)
    return {
        "page_id": _page(named["warc-record-id"]), "url": named.get("warc-target-uri"), "record_type": kind, "payload_bytes": size, "payload_digest": digest, "refers_to": _page(named.get("warc-refers-to")),
        "payload": None if kind == "revisit" else payload, "record_id": named["warc-record-id"].strip("<>"), "refers_to_id": named["warc-refers-to"].strip("<>") if "warc-refers-to" in named else None, "date": named["warc-date"], "error": None,
    }


_FIELDS = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(), "record_id": pa.string(), "refers_to_id": pa.string(), "date": pa.string(), "error": pa.string()}


def unpack(data: bytes) -> Iterator[dict]:
    """The records of one archive."""
    reader, first = zstandard.ZstdDecompressor(), True
    try:
        for magic, start, end in frames(data):
            if magic == DICT_MAGIC and first:
                body = data[start:end]
                if body[:4] == struct.pack("<I", FRAME_MAGIC):
                    body = zstandard.ZstdDecompressor().decompress(body)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            elif magic == FRAME_MAGIC:
                try:
                    yield parse(reader.decompress(data[start:end]))
                except (ValueError, zstandard.ZstdError) as e:
                    yield dict.fromkeys(_FIELDS) | {"error": f"record at {start}: {e}"}
            first = False
    except ValueError as e:
        yield dict.fromkeys(_FIELDS) | {"error": str(e)}


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> None:
    """Write one record a page into archives below path, a file for each partition.

    Digests that repeat are counted and written before their pages meet them, so that Spark can split a hot digest's pages.
    """
    words = dictionary(pages, payload_col)
    lead = struct.pack("<II", DICT_MAGIC, len(words)) + words
    body = F.coalesce(F.col(payload_col), F.lit(""))
    flat = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), body.alias("html"), F.sha1(body).alias("sha"))
    keepers = flat.where(F.octet_length("html") >= least).groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    keepers = written(keepers, "keepers")
    marked = flat.join(keepers, "sha", "left").withColumn("keeper", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(words), write_checksum=True, write_content_size=True)
        head = [lead]
        for whole in batches:
            for lo in range(0, len(whole), 512):
                out = head
                for r in whole.slice(lo, 512).to_pylist():
                    digest = base64.b32encode(bytes.fromhex(r["sha"])).decode()
                    out.append(packer.compress(record(r["page_id"], r["url"], r["html"].encode("utf-8", "surrogatepass"), digest, r["keeper"])))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                head = []

    packed = marked.select("page_id", "url", "html", "sha", "keeper").mapInArrow(run, "frame binary")
    packed.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR.decode("ascii")).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row a record of the archives below path: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (null for revisits), record_id, refers_to_id, date, error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows: list[dict] = []
                for r in unpack(content.as_py()):
                    rows.append(r)
                    if len(rows) == 512:
                        yield pa.RecordBatch.from_pylist(rows, pa.schema(list(_FIELDS.items())))
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(list(_FIELDS.items())))

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary, record_id string, refers_to_id string, date string, error string")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write pages to archives in the shared folder and read them back."""
    path = shared_path(pages.sparkSession, "warc")
    write_archives(pages, path, least=least)
    return read_archives(pages.sparkSession, path)
