"""WARC archives in seekable Zstandard bundles.

Method: a record per page; records are gathered into frames of about
FRAME_BYTES, each compressed on its own, and a file of frames ends with a seek
table (the public seekable format: a skippable frame with the compressed and
plain size and a checksum of every frame, and a footer). The index maps every
record id to its file, its frame and its place within the frame, so a record
is read by decompressing one frame, and a task can read any run of frames.

Of the records with equal payloads of at least ``REVISIT_BYTES``, that with the
smallest page_id is the response; the others are revisits, which have its id
and the HTTP header but no payload. A group of equal payloads may hold a third
of all rows: its response is found per (digest, salt) first and travels back
the same way. The rows are written once with a number each, and the revisits
are joined to them by it, so no task gets a group.

A file's name has the attempt that wrote it, and only committed attempts are in
the index: files of lost executors are never read. Files are put in place
whole.

Defined cases: null html counts as empty; a null page_id comes after all
others and is written without its header; of rows with one page_id and one
payload, one is the response and the others revisit it; null urls have no
header, others that are not plain ASCII have their exact form in a header of
their own; a very long payload has a frame of its own; an empty table gives an
empty index and no files; extra columns are not looked at."""

from __future__ import annotations

import hashlib
import json
import struct

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import open_file, put_file, scratch, stored, table, utf8_rows

FRAME_BYTES = 1 << 18       # of records before compression
FILE_BYTES = 1 << 26        # of frames after it
READ_BYTES = 1 << 26        # read by a task, about
RUN_FRAMES = 16             # frames that are read together
REVISIT_BYTES = 100
SALTS = 64                  # parts of one group of equal payloads
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"       # the pages have no date of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1        # fixed values of the seekable format
CHECKSUMS = 0x80
INDEX = "record_id string, page_id bigint, record_type string, file string, frame int, offset bigint, length bigint"


# records

def _lines(headers: list[tuple[str, str]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in headers).encode()


def _target(url: str | None) -> list[tuple[str, str]]:
    if url is None:
        return []
    plain = "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)
    return [("WARC-Target-URI", plain)] + ([("X-Target-URL", json.dumps(url))] if plain != url else [])


def record(record_id: str, page_id: int | None, url: str | None, digest: str, payload: bytes | None, payload_bytes: int,
           refers_id: str | None = None, refers_to: int | None = None) -> bytes:
    """A response record, or (with ``refers_id``) a revisit without the payload."""
    http = (b"HTTP/1.1 200 OK\r\n" + _lines([("Content-Type", "text/html; charset=utf-8"),
                                              ("Content-Length", str(payload_bytes))]) + b"\r\n")
    block = http if refers_id else http + payload
    headers = [("WARC-Type", "revisit" if refers_id else "response"), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"),
               ("WARC-Date", DATE), *_target(url), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if refers_id:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{refers_id}>")]
        if refers_to is not None:
            headers.append(("X-Refers-To-Page-ID", str(refers_to)))
    headers += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"".join((b"WARC/1.1\r\n", _lines(headers), b"\r\n", block, b"\r\n\r\n"))


def _info() -> bytes:
    block = _lines([("software", "tidemart"), ("format", "WARC file version 1.1")])
    return b"".join((b"WARC/1.1\r\n", _lines([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:uuid:" + uuid_of("info") + ">"),
                                              ("WARC-Date", DATE), ("Content-Type", "application/warc-fields"),
                                              ("Content-Length", str(len(block)))]), b"\r\n", block, b"\r\n\r\n"))


def uuid_of(name: str) -> str:
    h = hashlib.sha256(name.encode()).hexdigest()
    return "-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:32]))


def _headers(data: bytes, at: int) -> tuple[str, dict[str, str], int]:
    """First line, headers (by lower-case name) and where the block begins."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split("\r\n")
    return first, {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, end + 4


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at ``at`` of a frame, and where the next one begins."""
    first, h, start = _headers(data, at)
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record here")
    stop = start + int(h["content-length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise ValueError("a record is cut short")
    number = lambda x: int(x) if x is not None else None        # noqa: E731
    name = lambda x: x.removeprefix("<urn:uuid:").removesuffix(">") if x else None      # noqa: E731
    out = {"record_id": name(h["warc-record-id"]), "record_type": h["warc-type"], "page_id": number(h.get("x-page-id")),
           "url": json.loads(h["x-target-url"]) if "x-target-url" in h else h.get("warc-target-uri"),
           "refers_id": name(h.get("warc-refers-to")), "refers_to": number(h.get("x-refers-to-page-id")), "payload": None}
    if h["warc-type"] != "warcinfo":
        _, http, body = _headers(data, start)
        out |= {"payload_bytes": int(http["content-length"]), "payload_digest": h["warc-payload-digest"].removeprefix("sha256:")}
        if h["warc-type"] == "response":
            payload = data[body:stop]
            if len(payload) != out["payload_bytes"] or hashlib.sha256(payload).hexdigest() != out["payload_digest"]:
                raise ValueError(f"the payload of {out['record_id']} does not have its digest")
            out["payload"] = payload
    return out, stop + 4


# bundles

class BundleWriter:
    """Gathers records into frames; ``finish`` gives the pieces of the file."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        import zstandard
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.frame_bytes, self.frames, self.sizes, self.size = frame_bytes, [], [], 0
        self.open, self.held = [], 0
        self.add(_info())

    def add(self, data: bytes) -> tuple[int, int]:
        """The frame that the record is in, and its place in it."""
        if self.held and self.held + len(data) > self.frame_bytes:
            self._close()
        place = len(self.frames), self.held
        self.open.append(data)
        self.held += len(data)
        return place

    def _close(self) -> None:
        import xxhash
        data = b"".join(self.open)
        frame = self.compressor.compress(data)
        self.frames.append(frame)
        self.sizes.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.size += len(frame)
        self.open, self.held = [], 0

    def finish(self) -> list[bytes]:
        if self.held:
            self._close()
        entries = b"".join(struct.pack("<3I", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), CHECKSUMS, SEEKABLE)
        return [*self.frames, struct.pack("<2I", SKIPPABLE, len(entries)), entries]


class Bundle:
    """A seekable file: reads its seek table, then only the frames asked for."""

    def __init__(self, file):
        import zstandard
        self.file, self.plain = file, zstandard.ZstdDecompressor()
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end")
        width = 3 if flags & CHECKSUMS else 2
        start = size - 9 - 4 * width * n - 8
        if struct.unpack("<2I", self._read(start, 8)) != (SKIPPABLE, 4 * width * n + 9):
            raise ValueError("the seek table is not whole")
        values = struct.unpack(f"<{width * n}I", self._read(start + 8, 4 * width * n))
        self.sizes = [values[k:k + width] for k in range(0, width * n, width)]
        self.starts = [0]
        for s in self.sizes:
            self.starts.append(self.starts[-1] + s[0])
        if self.starts[-1] != start:
            raise ValueError("the seek table does not match the file")

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("the file is cut short")
        return data

    def frames(self, first: int = 0, stop: int | None = None):
        """(number, plain bytes) of a run of frames, by one read."""
        import xxhash
        stop = len(self.sizes) if stop is None else min(stop, len(self.sizes))
        data = self._read(self.starts[first], self.starts[stop] - self.starts[first])
        for k in range(first, stop):
            at = self.starts[k] - self.starts[first]
            plain = self.plain.decompress(data[at:at + self.sizes[k][0]], max_output_size=self.sizes[k][1])
            if len(plain) != self.sizes[k][1] or self.sizes[k][2:] and xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.sizes[k][2]:
                raise ValueError(f"frame {k} does not have its checksum")
            yield k, plain

    def record(self, frame: int, offset: int, length: int) -> dict:
        _, plain = next(self.frames(frame, frame + 1))
        return parse(plain[offset:offset + length])[0]


# Spark

def _uuid(*parts: Column) -> Column:
    h = F.sha2(F.concat_ws("\n", *parts).cast("binary"), 256)
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def plan_records(pages: DataFrame) -> DataFrame:
    """The pages with record_id, digest and, where they repeat a payload, the
    refers_id and refers_to of the response."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    staged = stored(pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
                                 "url", html.alias("payload"), F.sha2(html, 256).alias("digest")), "warc-pages", "zstd")
    rows = (staged.where(F.octet_length("payload") >= REVISIT_BYTES)
            .select("row", "page_id", "digest", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt")))
    rows = stored(rows, "warc-rows")
    least = F.struct(F.isnull("page_id").alias("none"), "page_id", "row")
    parts = rows.groupBy("digest", "salt").agg(F.min(least).alias("least"), F.count(F.lit(1)).alias("n"))
    groups = (parts.groupBy("digest").agg(F.min("least").alias("least"), F.sum("n").alias("n"),
                                          F.collect_list("salt").alias("salts"))        # at most SALTS entries
              .where("n > 1").select("digest", F.explode("salts").alias("salt"), F.col("least.page_id").alias("refers_to"),
                                     F.col("least.row").alias("first")))
    own = lambda page, row: _uuid(F.coalesce(page.cast("string"), F.lit("-")), F.col("digest"), row.cast("string"))     # noqa: E731
    revisits = (rows.join(groups, ["digest", "salt"]).where("row != first")
                .select("row", own(F.col("refers_to"), F.col("first")).alias("refers_id"), "refers_to"))
    return (staged.join(revisits, "row", "left")
            .select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"),
                    F.when(F.isnull("refers_id"), F.col("payload")).alias("payload"),
                    own(F.col("page_id"), F.col("row")).alias("record_id"), "refers_id", "refers_to"))


def write_archives(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as bundles in ``folder`` and their index
    beside them; returns the index (see INDEX)."""
    shape = ["record_id", "page_id", "record_type", "file", "frame", "offset", "length"]

    def batches(it):
        import pyarrow as pa
        from pyspark import TaskContext
        kinds = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("file", pa.string()),
                           ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
        task, made = TaskContext.get(), 0
        writer, rows = None, []

        def flush():
            nonlocal writer, rows, made
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{made:05d}.warc.zst"
            put_file(folder, name, writer.finish())
            cols = [[r[k] for r in rows] for k in range(3)] + [[name] * len(rows)] + [[r[k] for r in rows] for k in range(3, 6)]
            writer, rows, made = None, [], made + 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kinds, strict=True)], names=shape)
        for b in it:
            col = {n: b.column(k) for k, n in enumerate(b.schema.names)}
            lists = [col[n].to_pylist() for n in ("record_id", "page_id", "url", "digest", "payload_bytes", "refers_id", "refers_to")]
            for k, (rid, page, url, digest, n, refers_id, refers_to) in enumerate(zip(*lists, strict=True)):
                writer = writer or BundleWriter(frame_bytes)
                data = record(rid, page, url, digest, col["payload"][k].as_py(), n, refers_id, refers_to)
                frame, offset = writer.add(data)
                rows.append((rid, page, "revisit" if refers_id else "response", frame, offset, len(data)))
                if writer.size >= file_bytes:
                    yield flush()
        if rows:
            yield flush()
    index = plan_records(pages).mapInArrow(batches, INDEX)
    index.write.parquet(f"{folder}/index")
    return open_index(pages.sparkSession, folder)


def open_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


RECORD = ("page_id bigint, record_id string, record_type string, url string, payload_bytes bigint, payload_digest string, "
          "refers_id string, refers_to bigint")


def _batch(found: list[dict], payload: bool):
    import pyarrow as pa
    kinds = [("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_id", pa.string()), ("refers_to", pa.int64())]
    kinds += [("payload", pa.binary())] * payload
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], k) for n, k in kinds], names=[n for n, _ in kinds])


def read_archives(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """Every record of the indexed files (see RECORD; ``payload`` adds the payload,
    null for revisits). Tasks read runs of frames; digests are computed anew."""
    runs = (open_index(spark, folder)
            .groupBy("file", F.expr(f"frame div {RUN_FRAMES}").alias("run")).agg(F.sum("length").alias("bytes")))
    runs = stored(runs, "warc-runs")
    sums = runs.agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    tasks = max(1, -(-(sums["bytes"] or 0) // READ_BYTES), min(sums["n"], 3 * spark.sparkContext.defaultParallelism))

    def batches(it):
        for b in it:
            for name, run in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with open_file(folder, name) as f:
                    found, held = [], 0
                    for _, plain in Bundle(f).frames(run * RUN_FRAMES, (run + 1) * RUN_FRAMES):
                        at = 0
                        while at < len(plain):
                            r, at = parse(plain, at)
                            if r["record_type"] != "warcinfo":
                                found.append(r if payload else r | {"payload": None})
                        held += len(plain) * payload
                        if found and (len(found) >= 4096 or held >= READ_BYTES):
                            yield _batch(found, payload)
                            found, held = [], 0
                    if found:
                        yield _batch(found, payload)
    return (runs.select("file", F.col("run").cast("int").alias("run")).repartition(tasks)
            .mapInArrow(batches, RECORD + ", payload binary" * payload))


def fetch(spark: SparkSession, folder: str, ids: DataFrame) -> DataFrame:
    """The records (with payload) whose record_id is in ``ids``: by the index, only
    their frames are read."""
    wanted = (open_index(spark, folder).join(ids.select("record_id").distinct(), "record_id", "left_semi")
              .select("file", "frame", "offset", "length").repartition("file", "frame").sortWithinPartitions("file", "frame"))

    def batches(it):
        name, file, bundle, frame, plain = None, None, None, None, b""
        for b in it:
            for n, k, offset, length in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):
                if n != name:
                    if file:
                        file.close()
                    name, file, frame = n, open_file(folder, n), None
                    bundle = Bundle(file)
                if k != frame:
                    frame, plain = next(bundle.frames(k, k + 1))
                yield _batch([parse(plain[offset:offset + length])[0]], True)
    return wanted.mapInArrow(batches, RECORD + ", payload binary")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP12_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id <> first THEN first END AS refers_to
FROM q
"""
