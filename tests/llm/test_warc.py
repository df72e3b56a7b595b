"""WARC: records written and read back at any split size, hidden magic bytes, edge rows."""

import gzip
import io
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shiplens.llm import warc as W

ROWS = [
    (1, "http://a", "<p>é one</p>"), (2, "http://b", "<p>é one</p>"), (3, None, "other"), (4, "http://d", None), (5, "x", ""),
    (None, "http://n", "other"), (None, "http://m", "only a null id"), (6, "line\r\nfeed", "WARC/1.1\r\n\r\n"), (3, None, "other"),
    (7, "http://long", "long " * 200_000),
]


def written(spark, rows, folder):
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, sha1 string").repartition(3)
    return W.write_archives(df, folder)


@pytest.mark.parametrize("split", [7, 1000, 1 << 23])
def test_every_record_is_read_once_at_any_split(spark, tmp_dir, split):
    rows = ROWS[:-1] if split == 7 else ROWS
    archives = written(spark, rows, tmp_dir)
    got = W.read_archives(archives, split).collect()
    want = []
    for p, u, h in rows:
        ids = [q for q, _, g in rows if (g or "") == (h or "") and q is not None]
        first = min(ids, default=None)
        body = (h or "").encode()
        want.append((p, "response" if p == first else "revisit", None if p == first else first, len(body), W.base32_sha1(body)))
    assert sorted([(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got], key=str) == sorted(want, key=str)
    payloads = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response" and r.page_id is not None}
    assert all(payloads[p] == (h or "").encode() for p, _, h in rows if p in payloads)
    assert {(r.path, r.offset) for r in got}.__len__() == len(rows)


def test_archives_are_gzip_members_of_warc_records(spark, tmp_dir):
    paths = [r.path for r in written(spark, ROWS, tmp_dir).collect()]
    assert sum(gzip.open(p.removeprefix("file://")).read().count(b"WARC-Record-ID") for p in paths) == len(ROWS)


def test_magic_inside_a_payload_is_no_record():
    inner = W.response_bytes(9, "u", b"inner")
    rng = random.Random(0)
    noise = bytes(rng.randrange(256) for _ in range(4000))
    # stored, not compressed: the inner member's bytes show up in the archive as they are
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    outer = stored.compress(gzip.decompress(W.response_bytes(1, "u", noise + inner + noise))) + stored.flush()
    data = outer + W.response_bytes(2, "u", b"x" + W._MAGIC * 5)
    assert inner[:40] in data
    for split in (50, 977, 4096, len(data)):
        found = [f["warc-record-id"] for s in range(0, len(data), split) for _, f, _ in W.owned_records(io.BytesIO(data), len(data), s, min(len(data), s + split))]
        assert found == ["<urn:page:1>", "<urn:page:2>"]


def test_damaged_member_is_skipped():
    a, b, c = (W.response_bytes(i, "u", b"payload" * 50) for i in (1, 2, 3))
    broken = bytearray(b)
    broken[60] ^= 255
    data = a + bytes(broken) + c
    found = [f["warc-record-id"] for _, f, _ in W.owned_records(io.BytesIO(data), len(data), 0, len(data))]
    assert "<urn:page:3>" in found and "<urn:page:2>" not in found


def test_empty_table(spark, tmp_dir):
    archives = written(spark, ROWS, tmp_dir + "/full").limit(0)
    assert W.read_archives(archives).count() == 0
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    made = W.write_archives(empty, tmp_dir + "/none")
    assert W.read_archives(made).count() == 0 and not os.listdir(tmp_dir + "/none/archives")


def test_payloads_of_revisits_are_not_passed_on(spark):
    rows = [(i, "u", "the page that a third of all rows hold") for i in range(300)] + [(i, "u", f"page {i}") for i in range(300, 900)] + [(None, "u", "page 301")] * 5
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4, "page_id").sortWithinPartitions("page_id")
    passed = W.without_repeats(W.fingerprinted(df)).select("page_id", (F.col("payload").isNotNull()).alias("whole")).collect()
    assert len(passed) == len(rows)
    # in page order each task passes the shared payload once
    assert sum(r.whole for r in passed if r.page_id is not None and r.page_id < 300) <= 4
    assert all(r.whole for r in passed if r.page_id is not None and r.page_id >= 300)


def test_hot_payload_in_any_order_keeps_the_smallest_page(spark, tmp_dir):
    rng = random.Random(4)
    rows = [(i, "u", "hot") for i in range(200)] + [(0, "u", "hot")]
    rng.shuffle(rows)
    archives = W.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), tmp_dir)
    got = W.read_archives(archives).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.page_id == 0) == [(0, "response", None)] * 2
    assert len(got) == 201 and all((r.record_type, r.refers_to, r.payload_bytes) == ("revisit", 0, 3) for r in got if r.page_id)


def test_folders_are_qualified(spark, tmp_dir):
    assert W.qualified(spark, tmp_dir) == f"file://{tmp_dir}" == W.qualified(spark, f"file:{tmp_dir}")
    archives = W.write_archives(spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string"), f"{tmp_dir}/a b")
    assert all(r.path.startswith("file://") for r in archives.collect()) and W.read_archives(archives).count() == 1
