import gzip
import hashlib
import io
import os
import zlib

import pytest
from pyspark.sql import functions as F

from tunemill.llm import warc


def brute(rows):
    firsts = {}
    for p, h in rows:
        if p is not None and len((h or "").encode()) >= 100:
            firsts[h] = min(p, firsts.get(h, p))
    out = []
    for p, h in rows:
        b = (h or "").encode()
        again = len(b) >= 100 and firsts.get(h, p) != p
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", firsts[h] if again else None))
    return sorted(out, key=repr)


ROWS = [(1, "x" * 99), (2, "x" * 99), (3, "é" * 50), (5, "é" * 50), (4, "é" * 50), (6, None), (7, ""), (8, None),
        (9, "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40), (10, "\r\n\r\n" * 30), (11, "\r\n\r\n" * 30),
        (12, "long " * 400000), (13, "long " * 400000), (None, "é" * 50), (None, "n" * 200), (None, "n" * 200), (-4, "é" * 50),
        (-4, "é" * 50), (20, "\x00\x1f\x8b" * 60)]


def pages(spark, rows):
    return spark.createDataFrame([(p, f"http://h/{p}\r\nX: é", h, 3) for p, h in rows],
                                 "page_id long, url string, html string, record_type int")


def test_op11_against_brute_force(spark):
    rows = ROWS + [(100 + i, "hot" * 50) for i in range(300)]
    got = sorted(map(tuple, warc.op11(spark, pages(spark, rows).repartition(3)).collect()), key=repr)
    assert got == brute(rows)
    assert warc.op11(spark, pages(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_files_are_cut_and_every_record_is_read_once(spark, tmpdir_path, compression):
    path = f"file://{tmpdir_path}/w"
    df = pages(spark, ROWS * 20)
    warc.write_pages(df, path, compression=compression, file_bytes=20000, split_bytes=3000)
    names = [f for f in os.listdir(f"{tmpdir_path}/w") if ".warc" in f]
    assert len(names) > 3
    for split in (1, 3000, 1 << 30):
        all_ = warc.read_warc(spark, path, split_bytes=split)
        assert all_.where("record_type <> 'warcinfo'").count() == len(ROWS) * 20
        assert all_.where("record_type = 'warcinfo'").count() == len(names)
    assert warc.read_warc(spark, path, split_bytes=1).rdd.getNumPartitions() > len(names)
    back = warc.read_pages(spark, path)
    assert sorted(map(tuple, back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()),
                  key=repr) == brute(ROWS * 20)
    url = back.where("page_id = 1").first().url
    assert url == "http://h/1%0D%0AX: é"
    # each member is a gzip file of its own
    if compression == "gzip":
        with open(f"{tmpdir_path}/w/{names[0]}", "rb") as f:
            assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_append_overwrite_and_lost_attempts(spark, tmpdir_path):
    path = f"{tmpdir_path}/w"
    row = spark.createDataFrame([("resource", "urn:a:1", b"abc")], "record_type string, record_id string, payload binary")
    warc.write_warc(row, path)
    warc.write_warc(row, path)
    with open(f"{path}/part-lost.warc", "wb") as f:  # of a task that was lost: not in the manifest
        f.write(warc.record({"record_type": "resource", "record_id": "urn:a:2", "payload": b"x"}))
    read = warc.read_warc(spark, path).where("record_type = 'resource'")
    assert [(r.record_id, bytes(r.payload)) for r in read.collect()] == [("urn:a:1", b"abc")] * 2
    warc.write_warc(row, path, mode="overwrite")
    assert warc.read_warc(spark, path).where("record_type = 'resource'").count() == 1


def foreign(n=50):
    """Records as other programs write them: other header case, folded and repeated lines, no skip length."""
    out = []
    for i in range(n):
        body = f"body {i} ".encode() * (i * 40)
        head = (f"WARC/1.0\r\nwarc-type: {'request' if i % 2 else 'metadata'}\r\nWARC-RECORD-ID: <urn:x:{i}>\r\n"
                f"WARC-Concurrent-To: <a>\r\nWARC-Concurrent-To: <b>\r\nX-Long: one\r\n  two\r\nContent-Length: {len(body)}\r\n\r\n")
        out.append(head.encode() + body + b"\r\n\r\n")
    return out


@pytest.mark.parametrize("kind", ["plain", "members", "one member"])
def test_foreign_files(spark, tmpdir_path, kind):
    recs = foreign()
    data = {"plain": b"".join(recs), "members": b"".join(map(gzip.compress, recs)), "one member": gzip.compress(b"".join(recs))}[kind]
    name = "f.warc" if kind == "plain" else "f.warc.gz"
    for folder in ("one", "two"):
        os.makedirs(f"{tmpdir_path}/{folder}")
        with open(f"{tmpdir_path}/{folder}/{name}", "wb") as f:
            f.write(data)
    df = warc.read_warc(spark, tmpdir_path)
    assert df.count() == 100 and df.select("file").distinct().count() == 2
    r = df.where("record_id = 'urn:x:7'").first()
    assert (r.record_type, bytes(r.payload), r.headers["X-Long"], r.headers["WARC-Concurrent-To"]) == (
        "request", b"body 7 " * 280, "one two", "<a>, <b>")
    assert df.where("record_type = 'request' and block_length > 2000").count() == 2 * sum(
        len(f"body {i} ") * i * 40 > 2000 for i in range(1, 50, 2))
    assert df.where("target_uri is null and record_id like 'urn:x:1%' and date is null").count() == 22
    assert df.where("record_type in ('metadata', 'x') and headers['X-Long'] = 'one two'").count() == 50


def test_predicates_are_pushed(spark, tmpdir_path):
    warc.write_pages(pages(spark, ROWS), tmpdir_path + "/w")
    reader = warc.WarcReader({"path": tmpdir_path + "/w"})
    f = [warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("file",), "x"), warc.IsNotNull(("headers",))]
    assert list(reader.pushFilters(f)) == f[1:] and reader.filters == f[:1]
    where = (F.col("record_type") == "revisit") & F.col("headers").isNotNull()
    plan = warc.read_warc(spark, tmpdir_path + "/w").where(where)._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(headers" in plan and "= revisit" not in plan, plan  # Spark filters what the source does not


class Counted(io.FileIO):
    read_bytes = 0

    def read(self, n=-1):
        got = super().read(n)
        Counted.read_bytes += len(got)
        return got

    def readinto(self, b):
        n = super().readinto(b)
        Counted.read_bytes += n
        return n


@pytest.mark.parametrize("kind", ["warc", "warc.gz"])
def test_unwanted_payloads_are_not_read(tmpdir_path, monkeypatch, kind):
    """Records that fail a header predicate cost their headers, not their blocks."""
    name = f"{tmpdir_path}/a.{kind}"
    big = os.urandom(8 << 20)
    rows = [{"record_type": t, "record_id": f"urn:{i}", "payload": big if t == "resource" else b"small"}
            for i, t in enumerate(["resource", "metadata"] * 4)]
    with open(name, "wb") as f:
        for r in rows:
            f.write(warc.gzip_member(warc.record(r)) if kind.endswith("gz") else warc.record(r))

    class Fs:
        open_input_file = staticmethod(lambda n: Counted(n))
    reader = warc.WarcReader({"path": name})
    list(reader.pushFilters([warc.EqualTo(("record_type",), "metadata")]))
    Counted.read_bytes = 0
    got = list(reader.records(Fs, name, 0, None))
    assert [r["payload"] for r in got] == [b"small"] * 4
    assert Counted.read_bytes < 12 * warc.CHUNK < len(big)


def test_broken_places(spark, tmpdir_path):
    recs = foreign(5)
    with open(f"{tmpdir_path}/a.warc", "wb") as f:
        f.write(b"".join(recs)[:-60])
    with open(f"{tmpdir_path}/b.warc.gz", "wb") as f:
        f.write(gzip.compress(recs[1]) + zlib.compress(b"no member"))
    with pytest.raises(Exception, match="ends within a record|no gzip member"):
        warc.read_warc(spark, tmpdir_path).collect()
    got = warc.read_warc(spark, tmpdir_path, mode="permissive").collect()
    assert sorted(r.record_type for r in got).count("unreadable") == 2 and len(got) == 7
