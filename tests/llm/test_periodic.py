import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from shiplens.llm import periodic


def brute_runs(words):
    """Every maximal stretch of each period, by definition."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words):
            j = i + q
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            whole = words[i:j]
            if len(whole) >= max(6, 4 * q) and not any(all(whole[k] == whole[k - d] for k in range(d, len(whole))) for d in range(1, q)):
                found.append((i, j - i, q))
            i = max(i + 1, j - q + 1)
    return sorted(set(found), key=lambda r: (r[0], r[2]))


def brute_words(doc_id, text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def brute_row(doc_id, text):
    words = brute_words(doc_id, text)
    runs = brute_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, exponent, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(kept)))


def brute_lyndon(codes, descending):
    """Longest Lyndon word at each place: up to the next smaller suffix."""
    key = [-c if descending else c for c in codes]
    return [next((j - i for j in range(i + 1, len(key)) if key[j:] < key[i:]), len(key) - i) for i in range(len(key))]


@settings(deadline=None, max_examples=300)
@given(st.lists(st.integers(0, 3), max_size=40), st.booleans())
def test_groups_are_longest_lyndon_words(codes, descending):
    group, length = periodic.lyndon_groups(codes, descending)
    assert length == brute_lyndon(codes, descending)
    words = {}
    for i, g in enumerate(group):
        assert words.setdefault(g, codes[i : i + length[i]]) == codes[i : i + length[i]]
    assert len({tuple(w) for w in words.values()}) == len(words)


@settings(deadline=None, max_examples=500)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 9)), max_size=6))
def test_runs_equal_brute_force(parts):
    words = [str(w) for p, k in parts for w in p * k]
    got = periodic._block([" ".join(words).encode(), None, " ".join(words[::-1]).encode()])
    for row, text in zip(got, (words, [], words[::-1]), strict=True):
        assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == brute_runs(text)
        assert row["n_words"] == len(text)


def test_long_periodic_texts_take_linear_time():
    words = ["a", "b", "a", "c"] * 30_000 + ["x"] * 100_000
    row = periodic._block([" ".join(words).encode()])[0]
    assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == [(0, 120_000, 4), (120_000, 100_000, 1)]
    assert row["collapsed"] == "a b a c x"


def test_query_equals_brute_force(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(None, "a b c " * 9), (3, None), (4, ""), (5, " \t\n"), (6, "é" + " é" * 7), (7, "a\xa0b " * 12)]
    for i in range(10, 260):
        words = [rnd.choice("abcdefgh") * rnd.randint(1, 2) for _ in range(rnd.randint(0, 120))]
        if i % 3 == 0 and words:
            at = rnd.randrange(len(words))
            words[at:at] = words[: rnd.randint(1, 6)] * rnd.randint(2, 8)
        rows.append((i, rnd.choice([" ", "\n", "\t\r", "  "]).join(words)))
    rows += [rows[-1], rows[20]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as periodic", "1 as start")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, periodic.op12_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want = sorted((brute_row(i, t) for i, t in rows), key=str)
    assert got == want
    assert sum(r[1] > 0 for r in got) > 40


def test_empty_table_and_clashing_name(spark):
    import pytest

    empty = spark.createDataFrame([], "doc_id long, text string, periodic int")
    with pytest.raises(ValueError, match="name another"):
        periodic.with_runs(empty)
    assert periodic.with_runs(empty, out="found").collect() == []
