import base64
import hashlib

import pyarrow.fs
import zstandard

from scorecast.llm import warc

PAGES = "page_id long, url string, html string, keep long, n int, sha string"


def rows():
    out = [(i, f"http://h/{i}", f"<p>page {i % 7} é</p>" * (i % 5), 1, 2, "x") for i in range(200)]
    return out + [(500, None, None, 0, 0, None), (501, "bad url\r\nX: y", "", 0, 0, None), (502, "u", "a\r\n\r\nWARC/1.1\r\n" * 50, 0, 0, None),
                  (503, "u", "z" * 3_000_000, 0, 0, None), (None, "u", "null id", 0, 0, None), (504, "u", "twice", 0, 0, None), (504, "u", "twice", 0, 0, None)]


def test_round_trip(spark, tmp_path):
    data = rows()
    index = warc.write(spark.createDataFrame(data, PAGES).repartition(4), str(tmp_path), frame_bytes=2000, bundle_bytes=20_000)
    got = warc.read(index).collect()
    assert len(got) == len(data)
    largest = {}
    for r in data:
        largest[r[2] or ""] = max(largest.get(r[2] or "", -1), -1 if r[0] is None else r[0])
    for r in got:
        if r["page_id"] is None:
            assert r["record_type"] == "response" and r["html"] == "null id"
            continue
        payload = next(x[2] or "" for x in data if x[0] == r["page_id"])
        assert r["payload_bytes"] == len(payload.encode())
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()
        first = largest[payload] == r["page_id"]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first else ("revisit", largest[payload]))
        assert r["html"] == (payload if first else None)
    one = index.filter("page_id = 502").first()
    found = warc.fetch(index, [one["record_id"]]).collect()
    assert [r["page_id"] for r in found] == [502] and found[0]["offset"] == one["offset"]


def test_bundle_is_plain_zstandard_with_a_seek_table(spark, tmp_path):
    warc.write(spark.createDataFrame(rows()[:50], PAGES).coalesce(1), str(tmp_path), frame_bytes=1000).count()
    path = next(p for p in tmp_path.iterdir() if p.name.endswith(".warc.zst"))
    with pyarrow.fs.LocalFileSystem().open_input_file(str(path)) as f:
        table = warc.seek_table(f)
        frames = [warc.read_frame(f, e) for e in table]
    assert len(table) > 3 and all(x.startswith(b"WARC/1.1\r\n") for x in frames)
    with open(path, "rb") as f:
        whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert whole == b"".join(frames)


def test_empty_table(spark, tmp_path):
    index = warc.write(spark.createDataFrame([], PAGES), str(tmp_path))
    assert index.count() == 0 and warc.read(index).count() == 0 and not list(tmp_path.iterdir())
