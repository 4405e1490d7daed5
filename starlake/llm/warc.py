"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing. Each task turns its pages into records, trains a dictionary on the first records of an archive and
emits the archive as rows: the dictionary's skippable frame (magic 0x184D2A5D), then a frame per record.
Spark's text writer puts the rows into files with its own commit protocol, so archives can go to any store
that Spark writes to, and a lost task leaves no partial file. The writer's line separator is an empty
skippable frame, which decoders pass over. An archive is closed at ``target`` bytes, which bounds what a
reader holds.

Of records with equal payloads, the one with the smallest page_id is a response, the others revisit it
(identical-payload-digest profile: HTTP headers only).

Reading. Any archive of this kind: optional dictionary (plain or itself a Zstandard frame), then frames; each
frame must hold exactly one record. Versions, mandatory headers, Content-Length against the block, the
HTTP Content-Length against the payload, and both digests are checked. A record that fails has ``error``
set; a frame that can't be decoded ends its archive with an error row.
"""
from __future__ import annotations

from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1
from struct import pack, unpack_from
from urllib.parse import quote
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, text_slices

DICTIONARY = 0x184D2A5D
SKIPPABLE = 0x184D2A50  # to 0x184D2A5F
FRAME = 0xFD2FB528
SEPARATOR = pack("<II", SKIPPABLE, 0).decode("ascii")
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")


def _digest(data: bytes) -> str:
    return b32encode(sha1(data).digest()).decode()


def _urn(page_id: object) -> str:
    return f"<urn:uuid:{uuid5(NAMESPACE_URL, f'page:{page_id}')}>"


# ---- writing ---------------------------------------------------------------------------------------

def record(page_id: object, url: str | None, payload: bytes, first_id: object, date: str) -> bytes:
    """One record; ``first_id`` is the page of equal payload that it revisits, or None."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if first_id is not None else http + payload
    head = [("WARC-Type", "response" if first_id is None else "revisit"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date),
            ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", "sha1:" + _digest(payload)),
            ("WARC-Block-Digest", "sha1:" + _digest(block)), ("Content-Length", str(len(block)))]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="%/:?#[]@!$&'()*+,;=~")))
    if page_id is not None:
        head.append(("Page-Id", str(page_id)))
    if first_id is not None:
        head += [("WARC-Profile", REVISIT), ("WARC-Refers-To", _urn(first_id)), ("Refers-To-Page-Id", str(first_id))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _train(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict | None:
    try:
        return zstandard.train_dictionary(size, samples, threads=0)
    except zstandard.ZstdError:  # too few or too small samples
        return None


def _archives(date: str, target: int, samples: int, dictionary: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, archive, at, size = TaskContext.get().partitionId(), 0, 0, 0
        held: list[bytes] = []
        compressor = None

        def rows(frames: list[bytes]) -> pa.RecordBatch:
            nonlocal at
            at += len(frames)
            return pa.RecordBatch.from_arrays([pa.array([f"{part:06d}-{archive:05d}"] * len(frames)), pa.array(range(at - len(frames), at), pa.int64()),
                                               pa.array(frames, pa.binary())], names=["archive", "at", "frame"])

        def start() -> list[bytes]:
            nonlocal compressor, held
            trained = _train([r[: 16 << 10] for r in held], dictionary)
            compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True, **({"dict_data": trained} if trained else {}))
            first = [pack("<II", DICTIONARY, len(trained)) + trained.as_bytes()] if trained else []
            frames, held = first + [compressor.compress(r) for r in held], []
            return frames

        for b in text_slices(batches, 2, min(target, 4 << 20)):
            frames = []
            for page_id, url, html, first_id in zip(*(c.to_pylist() for c in b.columns)):
                r = record(page_id, url, (html or "").encode(), first_id, date)
                if compressor is None:
                    held.append(r)
                    if len(held) >= samples or sum(map(len, held)) >= target // 4:
                        frames += start()
                else:
                    frames.append(compressor.compress(r))
            size += sum(map(len, frames))
            if frames:
                yield rows(frames)
            if size >= target:
                archive, at, size, compressor = archive + 1, 0, 0, None
        if held:
            yield rows(start())

    return run


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "1970-01-01T00:00:00Z",
          target: int = 32 << 20, samples: int = 64, dictionary: int = 32 << 10, level: int = 3, least_revisit: int = 0) -> None:
    """Write a record per row of ``pages`` below ``path``.

    Payloads are the html in UTF-8 (null: empty); those of at least ``least_revisit`` bytes are written
    once and revisited. Rows that repeat the smallest page_id are responses, too; a null page_id is
    written without one and revisits, unless no record of that payload has an id. A null url leaves
    out the target. Other columns are ignored; an empty table writes no archive.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("html")))
    copies = cut(rows.where(F.octet_length("html") >= least_revisit).groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                 .where("n > 1 and first_id is not null").select("sha", "first_id"))
    marked = rows.join(copies, "sha", "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("first_id"))
    frames = marked.mapInArrow(_archives(date, target, samples, dictionary, level), "archive string, at long, frame binary")
    (frames.sortWithinPartitions("archive", "at").select("archive", F.col("frame").cast("string").alias("frame"))
     .write.partitionBy("archive").option("lineSep", SEPARATOR).text(path))


# ---- reading ---------------------------------------------------------------------------------------

def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends: its header, its blocks, its checksum."""
    flags = data[at + 4]
    to = at + zstandard.frame_header_size(data[at: at + 18])
    while True:
        if to + 3 > len(data):
            raise ValueError("truncated frame")
        head = data[to] | data[to + 1] << 8 | data[to + 2] << 16
        kind, size = head >> 1 & 3, head >> 3
        if kind == 3:
            raise ValueError("reserved block type")
        to += 3 + (1 if kind == 1 else size)
        if head & 1:
            break
    to += 4 * (flags >> 2 & 1)
    if to > len(data):
        raise ValueError("truncated frame")
    return to


def _decoder(dictionary: bytes | None) -> zstandard.ZstdDecompressor:
    if not dictionary:
        return zstandard.ZstdDecompressor()
    if unpack_from("<I", dictionary)[0] == FRAME:
        dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))


def records(content: bytes | pa.Buffer) -> Iterator[tuple[int, int, bytes | None, str | None]]:
    """(offset, length, record, error) of each frame of an archive."""
    data, at, decoder = memoryview(content).cast("B"), 0, None
    while at < len(data):
        try:
            if at + 8 > len(data):
                raise ValueError("truncated frame")
            magic, size = unpack_from("<II", data, at)
            if SKIPPABLE <= magic <= SKIPPABLE + 15:
                if at + 8 + size > len(data):
                    raise ValueError("truncated skippable frame")
                if magic == DICTIONARY:
                    if at:
                        raise ValueError("dictionary after the archive's begin")
                    decoder = _decoder(bytes(data[8: 8 + size]))
                at += 8 + size
                continue
            if magic != FRAME:
                raise ValueError(f"no frame at {at}")
            decoder = decoder or _decoder(None)
            to = frame_end(data, at)
            yield at, to - at, decoder.decompressobj().decompress(data[at:to]), None
            at = to
        except (ValueError, zstandard.ZstdError) as e:
            yield at, len(data) - at, None, str(e)
            return


def parse(raw: bytes) -> dict:
    """Headers and payload of one record; ``error`` says what is wrong with it."""
    out: dict = {"headers": {}, "payload": None, "payload_bytes": None, "payload_digest": None, "error": None}
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        return out | {"error": "no WARC version line"}
    headers = out["headers"]
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            return out | {"error": f"bad header line {line[:60]!r}"}
        headers[name.strip().lower()] = value.strip()
    if missing := [h for h in MANDATORY if h not in headers]:
        return out | {"error": f"no {missing[0]}"}
    if not headers["content-length"].isascii() or not headers["content-length"].isdigit():
        return out | {"error": "bad content-length"}
    size = int(headers["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        return out | {"error": f"content-length is {size}, the block has {len(rest) - 4}"}
    block = rest[:size]
    said = headers.get("warc-block-digest")
    if said and said.startswith("sha1:") and said[5:] != _digest(block):
        return out | {"error": "block digest differs"}
    digest = headers.get("warc-payload-digest", "")
    out["payload_digest"] = digest[5:] if digest.startswith("sha1:") else None
    if headers.get("content-type", "").startswith("application/http"):
        http, sep, payload = block.partition(b"\r\n\r\n")
        if not sep:
            return out | {"error": "no end of the HTTP headers"}
        fields = dict(x.lower().split(b":", 1) for x in http.split(b"\r\n")[1:] if b":" in x)
        length = fields.get(b"content-length", b"").strip()
        revisit = headers["warc-type"] == "revisit"
        if length and not length.isdigit():
            return out | {"error": "bad HTTP content-length"}
        if length and not revisit and int(length) != len(payload):
            return out | {"error": f"HTTP content-length is {int(length)}, the payload has {len(payload)}"}
        out["payload"] = None if revisit else payload
        out["payload_bytes"] = int(length) if length else None if revisit else len(payload)
    else:
        out |= {"payload": block, "payload_bytes": size}
    if out["payload"] is not None and out["payload_digest"] and out["payload_digest"] != _digest(out["payload"]):
        return out | {"error": "payload digest differs"}
    return out


def read(spark: SparkSession, path: str, with_payload: bool = True, files: str = "part-*") -> DataFrame:
    """``(archive, offset, length, record_type, record_id, uri, headers, payload_bytes, payload_digest, error[, payload])``.

    A row per record of all archives below ``path`` whose file name matches ``files``; ``headers`` has
    lower-case names. An archive is one row of Spark's binary reader and must fit a task's memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0), b.column(1)):
                rows: list[tuple] = []
                size = 0
                for offset, length, raw, error in records(content.as_buffer()):
                    x = parse(raw) if raw is not None else {"headers": {}, "payload": None, "payload_bytes": None, "payload_digest": None, "error": error}
                    h = x["headers"]
                    rows.append((name.as_py(), offset, length, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"), list(h.items()),
                                 x["payload_bytes"], x["payload_digest"], x["error"], *[x["payload"]] * with_payload))
                    size += len(raw or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    text, long = pa.string(), pa.int64()
    types = [text, long, long, text, text, text, pa.map_(text, text), long, text, text] + [pa.binary()] * with_payload
    names = ["archive", "offset", "length", "record_type", "record_id", "uri", "headers", "payload_bytes", "payload_digest", "error"] + ["payload"] * with_payload
    schema = ("archive string, offset long, length long, record_type string, record_id string, uri string, headers map<string, string>, "
              "payload_bytes long, payload_digest string, error string" + ", payload binary" * with_payload)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", files).load(path)
    return found.select("path", "content").mapInArrow(run, schema)
