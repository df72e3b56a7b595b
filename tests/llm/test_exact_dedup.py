"""Exact dedup: index structure, byte comparison in chains, and edge rows."""

import hashlib
import re

import numpy as np
import pytest

from shiplens.llm import exact_dedup as X


def plain(rows):
    """Brute force over (doc_id, text): the row that stays and the group size of each row."""
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), X._NO_ID if d is None else d))
    out = []
    for d, t in rows:
        norm = re.sub("[\x20\x09-\x0d]", "", t or "")
        size, keep = len(groups[norm]), min(groups[norm])
        keep_id = None if keep[1] == X._NO_ID else keep[1]
        out.append((d, keep_id, size, d == keep_id and -keep[0] == len(t or ""), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(i, f"text {i % 7}" + " " * (i % 3)) for i in range(60)] + [
    (100, None), (101, ""), (102, " \t\n\x0b\x0c\r"), (None, ""), (None, "only null ids"), (None, "only  null ids"),
    (103, "a b"), (103, "a b"), (104, "ab "), (105, "ab "), (106, "é x"), (107, "éx"), (108, "z " * 40_000), (109, "z" * 40_000),
]


@pytest.mark.parametrize("key_bits,capacity", [(64, 10_000), (64, 4), (3, 4)])
def test_groups_equal_brute_force_even_with_colliding_keys(spark, key_bits, capacity):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    got = X.duplicate_groups(df, key_bits=key_bits, capacity=capacity)
    got = got.select("doc_id", "keep_id", "group_size", "kept", "sha").collect()
    assert sorted([tuple(r) for r in got], key=str) == plain(ROWS)


def test_directory_splits_full_buckets_and_doubles():
    counts = np.zeros(1 << 6, np.int64)
    counts[0] = 50  # one prefix that can't be split further than the last bit
    counts[40:] = 3
    d = X.Directory(counts, capacity=10, max_depth=6)
    assert len(d.entries) == 1 << d.depth == 64
    load = {}
    for prefix in range(64):
        bucket = d.bucket(prefix << 58)
        load[bucket] = load.get(bucket, 0) + counts[prefix]
    assert all(n <= 10 for b, n in load.items() if b != d.bucket(0)) and load[d.bucket(0)] == 50
    for b, depth in enumerate(d.local):  # a bucket of local depth d has 2**(depth - d) entries
        assert d.entries.count(b) == 1 << (d.depth - depth)
    assert X.Directory(counts, capacity=10**6, max_depth=6).entries == [0]


def test_index_is_written_per_bucket_with_its_texts(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    index = X.build_index(df, capacity=4)
    assert index.select("bucket").distinct().count() > 3
    assert sum(len(r.members) for r in index.collect()) == len(ROWS)
    assert {bytes(r.text) for r in index.where("text is not null").collect()} == {re.sub("[\x20\x09-\x0d]", "", t or "").encode() for _, t in ROWS}


@pytest.mark.parametrize("resident,key_bits", [(X.RESIDENT_BYTES, 64), (X.RESIDENT_BYTES, 3), (200, 3), (0, 3)])
def test_a_hot_text_travels_once_per_task(spark, monkeypatch, resident, key_bits):
    monkeypatch.setattr(X, "bounded_batches", lambda s: s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10"))
    rows = [(i, "the hot text" + " " * (i % 5) if i % 3 == 0 else f"text {i % 40}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    index = X.build_index(df, key_bits=key_bits, resident=resident).collect()
    hot = [r for r in index if r.sha == hashlib.sha256(b"thehottext").hexdigest()]
    assert len(hot) >= 20 * 0.9 and len({(r.key, r.chain) for r in hot}) == 1
    sent = sum(r.text is not None for r in hot)
    assert sent == len(hot) if resident == 0 else sent == 3
    got = X.duplicate_groups(df, key_bits=key_bits, resident=resident).select("doc_id", "keep_id", "group_size", "kept", "sha").collect()
    assert sorted([tuple(r) for r in got], key=str) == plain(rows)


def test_carried_texts_are_bounded():
    c = X._Carried(0, 100)
    seen = [c.number(b"hot") if i % 2 else c.number(b"%040d" % i) for i in range(200)]
    assert sum(send for _, send in seen[1::2]) == 1  # a text seen all along stays
    assert all(send for _, send in seen[::2]) and len(c.young) + len(c.old) <= 6
    assert c.number(b"x" * 51)[1] and c.number(b"x" * 51)[1]  # too long to be kept


def test_stage_keeps_one_row_and_all_columns(spark):
    rows = [(d, t, f"{i}", "c") for i, (d, t) in enumerate(ROWS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, keep_id string, `row` string")
    got = X.exact_dedup(df)
    assert got.columns == df.columns
    kept = got.collect()
    assert len(kept) == len({x[4] for x in plain(ROWS)})
    assert all(r.row == "c" for r in kept)
    assert X.exact_dedup(df.limit(0)).count() == 0
    assert X.duplicate_groups(df.limit(0)).count() == 0
