"""Round trips, deduplication, damaged and foreign archives."""
import glob
from base64 import b32encode
from hashlib import sha1
from struct import pack

import zstandard

from starlake.llm import warc

SCHEMA = "page_id long, url string, html string, at int, archive string"


def digest(html):
    return b32encode(sha1((html or "").encode()).digest()).decode()


def page_rows():
    rows = [(k, f"http://e.org/{k}?q=é", f"<p>page {k}</p>" * (k % 40), None, None) for k in range(300)]
    rows += [(500 + k, None, "<p>same</p>", 1, "x") for k in range(50)]
    return rows + [(600, "a\r\nWARC-Type: x", None, 2, None), (601, "", "", 3, None), (None, "u", "<p>same</p>", 4, None), (700, "b", "é日" * 200_000, 5, None),
                   (1, "http://e.org/again", "<p>page 1</p>", 6, None), (None, "only", "null ids only", 7, None), (None, "only", "null ids only", 7, None)]


def test_round_trip(spark, tmp_path):
    rows, path = page_rows(), str(tmp_path / "w")
    warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3), path, target=20_000, samples=16)
    got = warc.read(spark, path).collect()
    assert all(r.error is None for r in got)
    first = {}
    for i, _, html, *_ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = []
    for i, _, html, *_ in rows:
        to = first.get(html or "")
        kind = "response" if to is None or to == i else "revisit"
        want.append((i, len((html or "").encode()), digest(html), kind, None if kind == "response" else to))
    page = lambda r, name: int(r.headers[name]) if name in r.headers else None
    assert sorted(((page(r, "page-id"), r.payload_bytes, r.payload_digest, r.record_type, page(r, "refers-to-page-id")) for r in got), key=str) == sorted(want, key=str)
    assert {bytes(r.payload).decode() for r in got if r.record_type == "response"} == {h or "" for _, _, h, *_ in rows}
    files = glob.glob(path + "/archive=*/part-*")
    assert len(files) > 3
    for f in files:
        with open(f, "rb") as x:
            data = x.read()
        assert data[:4] in (pack("<I", warc.DICTIONARY), pack("<I", warc.FRAME))
        whole = b"".join(raw for _, _, raw, _ in warc.records(data))
        assert whole.count(b"WARC/1.1\r\n") == len(list(warc.records(data)))


def test_small_payloads_can_stay_responses(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(spark.createDataFrame(page_rows(), SCHEMA), path, least_revisit=100)
    assert {r.record_type for r in warc.read(spark, path).collect()} == {"response"}


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(spark.createDataFrame([], SCHEMA), path)
    assert warc.read(spark, path).collect() == []


def archive(records, dictionary=None, packed=False, **how):
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    c = zstandard.ZstdCompressor(**({"dict_data": trained} if trained else {}), **how)
    held = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
    head = pack("<II", warc.DICTIONARY, len(held)) + held if held else b""
    return head + b"".join(c.compress(r) for r in records)


def test_foreign_archives(spark, tmp_path):
    records = [warc.record(k, f"u{k}", b"payload %d " % k * 400, None, "2020-01-01T00:00:00Z") for k in range(100)]
    trained = zstandard.train_dictionary(4096, records).as_bytes()
    for name, data in {"plain": archive(records), "dict": archive(records, trained), "packed": archive(records, trained, True),
                       "checksum": archive(records, trained, write_checksum=True), "sizeless": archive(records, write_content_size=False)}.items():
        assert [raw for _, _, raw, _ in warc.records(data)] == records, name
        (tmp_path / f"{name}.warc.zst").write_bytes(data)
    got = warc.read(spark, str(tmp_path), files="*.warc.zst").collect()
    assert len(got) == 500 and all(r.error is None for r in got)


def test_damage_is_reported():
    good = warc.record(1, "u", b"hello world", None, "2020-01-01T00:00:00Z")

    def error(old, new):
        assert old in good
        return warc.parse(good.replace(old, new, 1))["error"]

    assert warc.parse(good)["error"] is None
    assert "version" in error(b"WARC/1.1", b"WARC/9.9")
    assert "no warc-date" in error(b"WARC-Date", b"WARC-Dote")
    assert "block digest" in error(b"hello", b"jello")
    size = warc.parse(good)["headers"]["content-length"].encode()
    assert "content-length" in error(b"\r\nContent-Length: " + size, b"\r\nContent-Length: 9" + size)
    assert "header line" in error(b"WARC-Type: ", b"WARC-Type ")
    assert "bad content-length" in error(b"\r\nContent-Length: " + size, b"\r\nContent-Length: x")
    assert "the block has" in warc.parse(good[:-1])["error"]
    frames = archive([good, good])
    assert [e for *_, e in warc.records(frames[:-3])] == [None, "truncated frame"]
    assert [e is None for *_, e in warc.records(frames + b"\x00" * 9)] == [True, True, False]
    assert [e for *_, e in warc.records(pack("<II", warc.DICTIONARY, 99))] == ["truncated skippable frame"]
    late = frames + pack("<II", warc.DICTIONARY, 0)
    assert "dictionary after" in [e for *_, e in warc.records(late)][-1]


def test_http_lengths_are_checked():
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nhello"
    raw = (b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nWARC-Date: d\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n"
           % len(block) + block + b"\r\n\r\n")
    assert "the payload has 5" in warc.parse(raw)["error"]
