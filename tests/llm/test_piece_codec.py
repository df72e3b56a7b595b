"""Merge-dropout encoding: the model's own result at rate 0, an agenda by hand, and round trips."""

import random

import numpy as np
import pytest

from shiplens.llm import piece_codec as P
from tests.conftest import SF_CHECK

TEXTS = [
    "a", " ", "  two  spaces ", "line\nline\ttab\x00", "日本語 テキスト 😀 é", "▁ literal mark ▁▁", "x" * 500, "word " * 300,
    "MixedCase, punctuation! (and) 12345", "aaaa" * 60 + " tail", " nbsp", "Éauxment entre le queeux",
]


@pytest.fixture(scope="module")
def table():
    return P.merge_table(P.default_model_path())


def plain_agenda(text, key, rate, t, pieces):
    """One document by a plain scan for the best candidate, on strings."""
    chars = [P.SPACE if c == " " else c for c in " " + text]
    known = [t.chars[ord(" ")] if c == P.SPACE and o == " " else -1 if o == P.SPACE else t.chars[ord(o)] for c, o in zip(chars, " " + text)]
    symbols = [[c if i >= 0 else None, o, k] for k, (c, o, i) in enumerate(zip(chars, " " + text, known))]
    while True:
        best = None
        for i in range(len(symbols) - 1):
            a, b = symbols[i][0], symbols[i + 1][0]
            if a is None or b is None or (a[-1:] != P.SPACE and b[0] == P.SPACE):
                continue
            p = pieces.get(a + b)
            if p is None:
                continue
            u = P.keyed_uniform(np.uint64(key), np.array([symbols[i + 1][2]]), np.array([p[0]]))[0]
            if (rate == 0 or u >= rate) and (best is None or p[1] > best[0]):
                best = (p[1], i)
        if best is None:
            break
        i = best[1]
        symbols[i][0] += symbols.pop(i + 1)[0]
    out = []
    for s, o, _ in symbols:
        out += [pieces[s][0]] if s is not None else [t.byte0 + x for x in o.encode()]
    return out


def test_rate_zero_is_the_models_own_encoding(table):
    sp = P.processor(P.default_model_path())
    texts = [t for t in TEXTS if P.SPACE not in t]
    got = P.encode_texts(texts, [9] * len(texts), 0.0, table)
    assert [g.tolist() for g in got] == [sp.encode(t) for t in texts]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5])
def test_array_rounds_equal_a_plain_agenda(table, rate):
    sp = P.processor(P.default_model_path())
    pieces = {p: (i, sp.get_score(i)) for i, p in enumerate(P.vocabulary(P.default_model_path())) if P.is_plain(P.default_model_path(), i)}
    texts = [t for t in TEXTS if len(t) < 90]
    keys = [P.document_key(i, 5) for i in range(len(texts))]
    got = P.encode_texts(texts, keys, rate, table)
    assert [g.tolist() for g in got] == [plain_agenda(t, k, rate, table, pieces) for t, k in zip(texts, keys)]


def test_heap_equals_array_rounds(table, monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("thean io") for _ in range(80)) for _ in range(20)]
    keys = [P.document_key(i, 1) for i in range(20)]
    a = P.encode_texts(texts, keys, 0.2, table)
    monkeypatch.setattr(P, "_LONG", 0)
    b = P.encode_texts(texts, keys, 0.2, table)
    assert all(np.array_equal(x, y) for x, y in zip(a, b))


def test_round_trip_seeds_and_a_text_without_spaces(table):
    long = "abcdefgh" * 20_000
    for t in [*TEXTS, long]:
        a, b, c = (P.encode_texts([t], [P.document_key(1, seed)], 0.3, table)[0].tolist() for seed in (1, 1, 2))
        assert P.decode_ids(a, table) == P.decode_ids(c, table) == t
        assert a == b and (a != c or len(t) < 40)


def test_query_is_lossless_over_all_documents(spark):
    got = P.op3_sentencepiece_codec(spark, SF_CHECK).collect()
    assert len(got) == 1000 and all(r.lossless and r.n_pieces == len(r.piece_ids) for r in got)


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "", "y"), (None, "some words", "z"), (2, "some words", "z"), (2, "some words", "z")], "doc_id long, text string, decoded_sha256 string")
    got = P.decoded(P.encoded(df)).collect()
    assert [r.piece_ids for r in got][:2] == [None, []]
    assert [r.decoded_text for r in got] == [r.text for r in got]
    assert got[3].piece_ids == got[4].piece_ids and got[0].decoded_sha256 == "x"
    assert P.decoded(P.encoded(df.limit(0))).count() == 0
