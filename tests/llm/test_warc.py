import base64
import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from replyloom.llm import warc

SCHEMA = "page_id long, url string, html string, key string, digest string, bucket string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def test_round_trip(spark, tmp_path, prose):
    rows = [(i, f"http://h/{i} é", prose(i % 40, 300)) for i in range(200)] + [
        (500, None, None), (501, "a\r\nInjected: b", ""), (None, "n", "only here"), (7, "again", prose(7, 300)),
    ]
    folder = str(tmp_path / "a")
    manifest = warc.write(pages(spark, rows), folder, shard_bytes=50_000, roll_bytes=4_000)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) and manifest.count() > 5
    found = warc.read(spark, folder).collect()
    first = {}
    for key, _, html in rows:
        if key is not None:
            first[html or ""] = min(first.get(html or "", key), key)
    def digest(html):
        return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()

    want = sorted(
        (str(k), len((h or "").encode()), digest(h), "revisit" if k is not None and first[h or ""] < k else "response",
         str(first[h or ""] if k is not None and first[h or ""] < k else None))
        for k, _, h in rows
    )
    assert sorted((str(r.key), r.n_bytes, r.digest, r.record_type, str(r.refers_to)) for r in found) == want
    texts = {r.key: r.payload for r in found if r.record_type == "response"}
    assert bytes(texts[3]).decode() == prose(3, 300) and bytes(texts[500]) == b""


def test_same_files_on_every_run(spark, tmp_path, prose):
    rows = [(i, "u", prose(i % 30, 200)) for i in range(90)]
    contents = []
    for run in range(2):
        folder = tmp_path / f"r{run}"
        warc.write(pages(spark, rows).repartition(run + 2), str(folder), shard_bytes=20_000, roll_bytes=5_000)
        contents.append({f.rsplit("/", 1)[1]: open(f, "rb").read() for f in glob.glob(f"{folder}/*.warc.gz")})
    assert contents[0] == contents[1] and len(contents[0]) > 2
    record = gzip.decompress(contents[0][min(contents[0])]).split(b"\r\n\r\n")[0]
    assert record.startswith(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:")


def test_small_payloads_are_all_responses(spark, tmp_path):
    folder = str(tmp_path / "s")
    warc.write(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]), folder, min_bytes=3)
    found = {r.key: (r.record_type, r.refers_to) for r in warc.read(spark, folder).collect()}
    assert found == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_damage_and_strangers(spark, tmp_path):
    folder = tmp_path / "d"
    warc.write(pages(spark, [(1, "u", "some text"), (2, "u", "other")]), str(folder))
    (folder / "shard-00000000-00009.warc.gz").write_bytes(b"left behind")  # not in the manifest
    (folder / ".shard-00000000-00000.warc.gz.abc").write_bytes(b"of a lost attempt")
    assert warc.read(spark, str(folder)).count() == 2
    (name,) = [f for f in glob.glob(f"{folder}/*-00000.warc.gz")]
    data = gzip.decompress(open(name, "rb").read()).replace(b"some text", b"some TEXT")
    open(name, "wb").write(gzip.compress(data))
    with pytest.raises(Exception, match="differs"):
        warc.read(spark, str(folder)).collect()


def test_no_pages_and_a_long_one(spark, tmp_path):
    warc.write(pages(spark, []), str(tmp_path / "e"))
    assert warc.read(spark, str(tmp_path / "e")).count() == 0
    warc.write(pages(spark, [(1, "u", "long " * 500_000)]), str(tmp_path / "l"))
    assert warc.read(spark, str(tmp_path / "l")).first().n_bytes == 2_500_000
