import hashlib
import io
import os
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.helpers import odd_columns
from tidemart.llm import warc as W
from tidemart.llm.common import scratch

BIG = "<p>é</p>" * 120_000
SAME = "<html>" + "same page " * 20 + "</html>"
ROWS = [(5, "http://a/5", SAME), (3, "http://a/3", SAME), (9, None, SAME), (None, "http://a/none", SAME), (3, "http://a/3", SAME),
        (1, "http://a/1", "short"), (2, "http://a/2", "short"), (4, "http://a/é \r\nX: y", "x" * 99), (6, "http://b/%20", "y" * 100),
        (7, "", "y" * 100), (8, "http://b/8", None), (10, "http://b/10", ""), (11, "http://b/11", BIG), (12, "u", BIG),
        (13, "http://c", "a\r\n\r\nWARC/1.1\r\n\r\n" * 10), (14, "http://c", "é" * 50), (None, None, "z" * 200), (None, None, "z" * 200)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def brute(rows):
    """Sorted (page_id, bytes, digest, type, refers_to)."""
    by = {}
    for i, _, t in rows:
        by.setdefault((t or "").encode(), []).append(i)
    out = []
    for data, ids in by.items():
        first = min((i for i in ids if i is not None), default=None)
        mine = [len(data), hashlib.sha256(data).hexdigest()]
        if len(data) < 100:
            out += [(i, *mine, "response", None) for i in ids]
            continue
        ids = list(ids)
        ids.remove(first)
        out += [(first, *mine, "response", None)] + [(i, *mine, "revisit", first) for i in ids]
    return sorted(out, key=repr)


def answer(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def odd(df):
    df = odd_columns(df)
    for c in ("row", "payload", "record_id", "refers_to", "refers_id", "file", "frame", "n", "first", "least", "run"):
        df = df.withColumn(c, F.lit("x"))
    return df


def test_matches_brute_force_with_odd_rows(spark):
    folder = scratch(spark, "t-warc")
    index = W.write_archives(odd(frame(spark, ROWS)), folder, frame_bytes=500, file_bytes=2000)
    back = W.read_archives(spark, folder, payload=True)
    assert answer(back) == brute(ROWS)
    got = sorted(((r.page_id, r.url, bytes(r.payload).decode()) for r in back.where("record_type = 'response'").collect()), key=repr)
    want = [(i, u, t or "") for i, u, t in ROWS]
    assert all(x in want for x in got)
    assert {r.url for r in back.collect()} == {u for _, u, _ in ROWS}
    responses = {r.record_id: r for r in back.where("record_type = 'response'").collect()}
    for r in back.where("record_type = 'revisit'").collect():
        assert responses[r.refers_id].payload_digest == r.payload_digest and r.payload is None
    assert index.select("record_id").distinct().count() == len(ROWS) == index.count()
    assert index.select("file").distinct().count() > 1


def test_empty_table(spark):
    folder = scratch(spark, "t-warc")
    assert W.write_archives(frame(spark, []), folder).count() == 0
    assert W.read_archives(spark, folder).count() == 0


def test_hot_payload(spark):
    rows = [(i, f"u{i}", SAME if i % 3 else f"page {i} " * 30) for i in range(3000)]
    folder = scratch(spark, "t-warc")
    W.write_archives(frame(spark, rows), folder)
    assert answer(W.read_archives(spark, folder)) == brute(rows)


def test_fetch_reads_records_by_id(spark):
    folder = scratch(spark, "t-warc")
    rows = [(i, f"u{i}", f"page {i} " * 50) for i in range(400)]
    index = W.write_archives(frame(spark, rows), folder, frame_bytes=3000, file_bytes=1000)
    wanted = index.where("page_id % 7 = 0").select("record_id")
    got = sorted((r.page_id, r.url, bytes(r.payload).decode()) for r in W.fetch(spark, folder, wanted.union(wanted)).collect())
    assert got == [r for r in rows if r[0] % 7 == 0]


class File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def bundle(n=50, frame_bytes=1000):
    w = W.BundleWriter(frame_bytes)
    places = []
    for k in range(n):
        payload = f"payload {k}\r\n\r\n".encode() * (k + 1)
        data = W.record(W.uuid_of(str(k)), k, f"http://x/{k}", hashlib.sha256(payload).hexdigest(), payload, len(payload))
        places.append((*w.add(data), len(data), payload))
    return b"".join(w.finish()), places


def test_bundle_is_plain_zstandard_with_a_seek_table():
    data, places = bundle()
    assert struct.unpack("<I", data[-4:])[0] == 0x8F92EAB1
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain.count(b"WARC-Type: response") == len(places)
    b = W.Bundle(File(data))
    assert b"".join(p for _, p in b.frames()) == plain
    for frame_, offset, length, payload in places:
        assert b.record(frame_, offset, length)["payload"] == payload
    assert [k for k, _ in b.frames(3, 5)] == [3, 4] and len(b.sizes) > 10


def test_damage_is_noticed():
    data, places = bundle()
    for bad in (data[:-1], data[:-40] + data[-39:], data[:len(data) // 2] + b"????" + data[len(data) // 2 + 4:], data[10:]):
        with pytest.raises((ValueError, zstandard.ZstdError, struct.error)):
            list(W.Bundle(File(bad)).frames())
    data = W.record(W.uuid_of("a"), 1, "u", hashlib.sha256(b"other").hexdigest(), b"payload", 7)
    with pytest.raises(ValueError):
        W.parse(data)


def test_files_of_other_attempts_are_not_read(spark):
    folder = scratch(spark, "t-warc")
    W.write_archives(frame(spark, ROWS), folder)
    with open(os.path.join(folder.removeprefix("file://"), "part-000000-999999-00000.warc.zst"), "wb") as f:
        f.write(b"left by a lost executor")
    assert answer(W.read_archives(spark, folder)) == brute(ROWS)
