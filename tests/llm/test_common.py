"""Helpers: sorted groups across Arrow batches, key lookup, components."""

import random
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest

from shiplens.llm.common import runs
from shiplens.llm.components import connected
from shiplens.llm.lookup import KeyTable


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_groupby_at_any_batch_cut(seed):
    rng = random.Random(seed)
    rows = sorted((rng.randint(0, 5), rng.randint(0, 3), rng.randint(0, 99)) for _ in range(rng.randint(0, 120)))
    cuts = sorted(rng.randint(0, len(rows)) for _ in range(rng.randint(0, 12)))
    batches = [
        pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows[a:b]], pa.int64()) for c in range(3)], names=["a", "b", "v"])
        for a, b in zip([0, *cuts], [*cuts, len(rows)])
    ]
    want = [[r[2] for r in g] for _, g in groupby(rows, key=lambda r: r[:2])]
    got = [v.tolist() for (v,) in runs(batches, ["a", "b"], ["v"])]
    # groups of one row are left out, but a group of one that was carried is no group either
    assert sorted(got) == sorted(g for g in want if len(g) > 1)


def test_key_table_finds_every_key_and_nothing_else():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**64, 20_000, np.uint64))
    table = KeyTable(keys[::2])
    assert np.array_equal(table.find(keys[::2]), np.arange(len(keys[::2])))
    assert (table.find(keys[1::2]) == -1).all()
    assert table.find(np.array([0], np.uint64))[0] == -1 and KeyTable(np.array([0], np.uint64)).find(np.array([0], np.uint64))[0] == 0
    with pytest.raises(ValueError):
        KeyTable(np.array([1, 1], np.uint64))


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 600)] + [(700, 701), (701, 702), (702, 700), (-5, 700), (800, 800)]
    rng = random.Random(4)
    rng.shuffle(links)
    links = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in links]
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 101)} | {i: 500 for i in range(501, 600)} | {i: -5 for i in (700, 701, 702)}
    assert got == want
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0
