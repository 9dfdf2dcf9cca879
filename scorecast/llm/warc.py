"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding a group of
whole WARC records, and ends with the seek table of the public *seekable
format*: a skippable frame with the compressed and decompressed size of every
frame.  Any Zstandard tool reads the file; a seekable reader fetches one frame.
The index maps record identifiers to (bundle, frame, offset in the frame,
length).

Every write task makes its own bundles under names that no other attempt
uses and returns their index rows, so a task that is run again leaves at most
a file that no index names.  Files go through ``pyarrow.fs``: local, HDFS and
object stores are the same to it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, bloom_bits, bloom_of, cut, filesystem, make_folder, maybe_in, ship, text_or_empty

FRAME_BYTES = 1 << 20      # records are gathered into frames of about this many bytes
BUNDLE_BYTES = 64 << 20    # a bundle of this compressed size is closed
DATE = "1970-01-01T00:00:00Z"

# fixed values of the Zstandard seekable format
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1

_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")   # the URL name space of RFC 4122


def record_id(page_id, digest: str) -> str:
    return f"<{uuid.uuid5(_NAMES, f'urn:page:{page_id}:{digest}').urn}>"


def _line(name: str, value) -> bytes:
    # white space and control characters would end the header line early
    text = "".join(c if c.isprintable() and not c.isspace() else f"%{ord(c):02X}" for c in str(value))
    return f"{name}: {text}\r\n".encode("utf-8", "replace")


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False, date: str = DATE) -> tuple[str, bytes]:
    """(record id, one WARC/1.1 record).  A revisit has the HTTP header with
    the payload's length, but not the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    rid = record_id(page_id, digest)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + _line("Content-Length", len(payload)) + b"\r\n"
    body = http if revisit else http + payload
    head = [b"WARC/1.1\r\n", _line("WARC-Type", "revisit" if revisit else "response"), _line("WARC-Record-ID", rid), _line("WARC-Date", date)]
    if url is not None:
        head.append(_line("WARC-Target-URI", url))
    head.append(_line("WARC-Payload-Digest", "sha1:" + digest))
    if page_id is not None:
        head.append(_line("X-Page-ID", page_id))
    if revisit:
        head.append(_line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        head.append(_line("WARC-Refers-To", record_id(refers_to, digest)))
        if refers_to is not None:
            head.append(_line("X-Refers-To-Page-ID", refers_to))
    head += [b"Content-Type: application/http;msgtype=response\r\n", _line("Content-Length", len(body)), b"\r\n"]
    return rid, b"".join(head) + body + b"\r\n\r\n"


def parse(data: bytes):
    """The records of a frame: (offset, header, HTTP header, payload)."""
    at = 0
    while at < len(data):
        cut_at = data.index(b"\r\n\r\n", at)
        lines = data[at:cut_at].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        n = int(head["Content-Length"])
        body = data[cut_at + 4: cut_at + 4 + n]
        http, _, payload = body.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in http.decode("latin-1").split("\r\n")[1:])
        yield at, head, fields, payload
        at = cut_at + 4 + n + 4


class Bundle:
    """Writer of one bundle."""

    def __init__(self, fs, path: str, level: int = 3):
        import zstandard
        self.out, self.z, self.frames, self.size = fs.open_output_stream(path, compression=None), zstandard.ZstdCompressor(level=level), [], 0

    def frame(self, data: bytes) -> None:
        packed = self.z.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data)))
        self.size += len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(f) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame of an open bundle."""
    end = f.size()
    f.seek(end - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    f.seek(end - 9 - n * entry)
    raw, at, out = f.read(n * entry), 0, []
    for i in range(n):
        packed, size = struct.unpack_from("<II", raw, i * entry)
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(f, entry: tuple[int, int, int]) -> bytes:
    import zstandard
    f.seek(entry[0])
    data = zstandard.ZstdDecompressor().decompressobj().decompress(f.read(entry[1]))
    if len(data) != entry[2]:
        raise ValueError(f"a frame of {entry[2]} bytes has {len(data)}")
    return data


INDEX = "bundle string, frame int, offset long, length long, record_id string, page_id long"


def _writer(folder: str, frame_bytes: int, bundle_bytes: int, date: str):
    def run(batches):
        fs, root = filesystem(folder)
        bundle, name, held, size, rows = None, None, [], 0, []

        def flush():
            nonlocal held, size, bundle, name
            if not held:
                return
            if bundle is None:
                name = f"{uuid.uuid4().hex}.warc.zst"
                bundle = Bundle(fs, f"{root}/{name}")
            at = 0
            for rid, page_id, data in held:
                rows.append((name, len(bundle.frames), at, len(data), rid, page_id))
                at += len(data)
            bundle.frame(b"".join(x[2] for x in held))
            held, size = [], 0
            if bundle.size >= bundle_bytes:
                bundle.close()
                bundle = None

        def ready():
            nonlocal rows
            cols = list(zip(*rows)) or [[]] * 6
            rows = []
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{x}" for x in cols[0]], kinds[0]),
                                               *(pa.array(c, k) for c, k in zip(cols[1:], kinds[1:]))],
                                              ["bundle", "frame", "offset", "length", "record_id", "page_id"])

        for batch in batches:
            for page_id, url, html, keep, n in zip(*(batch.column(i) for i in range(5))):
                payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                page_id = page_id.as_py()
                again = n.as_py() is not None and page_id != keep.as_py()
                rid, data = record(page_id, url.as_py(), payload, keep.as_py(), again, date)
                held.append((rid, page_id, data))
                size += len(data)
                if size >= frame_bytes:
                    flush()
            if rows:
                yield ready()
        flush()
        if bundle is not None:
            bundle.close()
        if rows:
            yield ready()
    return run


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, date: str = DATE) -> DataFrame:
    """Write one record per row of ``pages`` into bundles in ``folder`` (which
    every executor must reach) and return the index.

    Of rows with equal payloads (null html is an empty payload) that with the
    largest id is a response with the payload; the others are revisits that
    refer to it.  Rows that repeat the largest id are all responses.  If all
    ids of a payload are null, all are responses; a null id beside others is a
    revisit.  A null url leaves out the target; other columns are ignored.
    Equal payloads far apart meet in a narrow grouping of digests; the html of
    rows outside the Bloom filter of repeated digests never shuffles.
    An empty table gives an empty index and no file."""
    spark = pages.sparkSession
    ship(spark)
    html = text_or_empty(html_col)
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), html.alias("html"),
                       F.sha2(html, 256).alias("sha"))
    n = pages.count()
    groups = cut(src.groupBy("sha").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    bits = bloom_bits(groups.count())
    marked = maybe_in(src, F.xxhash64("sha"), bloom_of(groups.select(F.xxhash64("sha").alias("h")), "h", bits), bits, "maybe")
    alone = marked.filter(~F.col("maybe")).select("id", "url", "html", F.lit(None).cast("long").alias("keep"), F.lit(None).cast("long").alias("n"))
    again = attach(marked.filter("maybe").select("id", "url", "html", "sha"), groups, ["sha"], "n", n).select("id", "url", "html", "keep", "n")
    make_folder(spark, folder)
    return cut(alone.unionByName(again).mapInArrow(_writer(folder, frame_bytes, bundle_bytes, date), INDEX))


FRAMES = 64           # frames that a task reads back, once there are more tasks than cores
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, "
           "record_id string, bundle string, frame int, offset long, html string")


def _reader(batches):
    name, f, entries = None, None, []
    for batch in batches:
        rows = []
        for bundle, frame in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if bundle != name:
                if f is not None:
                    f.close()
                folder, _, file = bundle.rpartition("/")
                fs, root = filesystem(folder)
                name, f = bundle, fs.open_input_file(f"{root}/{file}")
                entries = seek_table(f)
            for at, head, http, payload in parse(read_frame(f, entries[frame])):
                digest, kind, html = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"], None
                size = int(http["Content-Length"])
                if kind == "response":
                    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != size:
                        raise ValueError(f"damaged record at {bundle} frame {frame} offset {at}")
                    html = payload.decode("utf-8", "replace")
                number = lambda k: int(head[k]) if k in head else None
                rows.append((number("X-Page-ID"), size, digest, kind, number("X-Refers-To-Page-ID"), head.get("WARC-Target-URI"),
                             head["WARC-Record-ID"], bundle, frame, at, html))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string())
            names = [x.split()[0] for x in RECORDS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read(index: DataFrame) -> DataFrame:
    """All records of the bundles that ``index`` names, read frame by frame
    through their seek tables; responses are checked against their digests.
    ``html`` is null for revisits; ``refers_to`` is their response's id."""
    ship(index.sparkSession)
    frames = cut(index.select("bundle", "frame").distinct())
    # the rows are tiny, what they stand for is not: the number of tasks follows the frames
    n, cores = frames.count(), index.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n, 2 * cores), -(-n // FRAMES))
    frames = frames.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame")
    return frames.mapInArrow(_reader, RECORDS)


def fetch(index: DataFrame, record_ids: list[str]) -> DataFrame:
    """The records with these identifiers: only their frames are read."""
    wanted = index.filter(F.col("record_id").isin(record_ids))
    found = read(wanted)
    return found.join(wanted.select("bundle", "frame", "offset"), ["bundle", "frame", "offset"], "left_semi")
