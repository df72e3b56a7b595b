"""SimHash near-dedup against all-pairs brute force."""

import random

import numpy as np
import xxhash
from itertools import combinations

from shiplens.llm import simhash
from shiplens.llm.components import connected
from tests.conftest import SF_CHECK


def plain_fingerprint(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, ids, bits=4):
    """Union-find over all pairs; component id is the smallest non-null id."""
    arr = np.array(fps, np.uint64)
    up = list(range(len(arr)))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= bits):
            up[find(i)] = find(i + 1 + int(j))
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_triples_cover_every_four_positions():
    triples = simhash.covering_triples()
    assert len(triples) == 20
    assert all(any(set(t) <= set(q) for t in triples) for q in combinations(range(8), 4))


def test_fingerprint_matches_the_plain_definition():
    for t in ["", None, " \t\n", "one", "One two  three", "a b c d", "A b c d e f g h", "Ünï CODE wörds é " * 9]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    fps = [simhash.fingerprint(r.text) for r in docs]
    want = {r.doc_id: (f"{f:016x}", c) for r, f, c in zip(docs, fps, plain_components(fps, [r.doc_id for r in docs]))}
    got = simhash.op10_simhash_near_dedup(spark, SF_CHECK).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want
    assert len(got) == len(docs)


def test_links_on_dense_and_chained_fingerprints_with_small_blocks(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for _ in range(150):  # a dense group
        fps.add(base ^ sum(1 << b for b in rng.sample(range(64), 3)))
    walk = rng.getrandbits(64)
    for _ in range(80):  # a chain
        walk ^= sum(1 << b for b in rng.sample(range(64), 4))
        fps.add(walk)
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    want = plain_components(fps, signed)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for block in (32768, 16):
        pairs = simhash.links(df, block=block)
        roots = {r.node: r.root for r in connected(pairs).collect()}
        assert [roots.get(f, f) for f in signed] == want
        assert pairs.count() <= 20 * 8 * len(fps)


def test_edge_rows(spark):
    rows = [(1, None, "x"), (None, "", "x"), (3, "same words in a row here", "x"), (3, "same words in a row here", "x"), (4, "same words in a row here", "y"), (None, "lonely text of its own", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1), (0, 1), (3, 3), (3, 3), (4, 3), (0, None)], key=str)
    kept = simhash.near_dedup(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_different_texts_under_null_and_equal_ids_stay(spark):
    text = lambda k: " ".join(f"w{k}x{i * (k + 3)}" for i in range(40))
    rows = [(None, text(k)) for k in range(6)]  # null ids, all different
    rows += [(None, text(0)), (None, text(6)), (5, text(6)), (9, text(6))]  # a repeat; a null id beside a number
    rows += [(7, text(7)), (7, text(8)), (7, text(8)), (2, text(8))]  # one id, two texts, one of them kept under 2
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    assert len({simhash.fingerprint(text(k)) for k in range(9)}) == 9
    want = [(None, text(k)) for k in range(6)] + [(5, text(6)), (7, text(7)), (2, text(8))]
    got = [(r.doc_id, r.text) for r in simhash.near_dedup(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_very_long_text():
    text = " ".join(str(i * 7919 % 1000) for i in range(150_000))
    assert simhash.fingerprint(text) == simhash.fingerprint(text.replace(" ", "\n"))
