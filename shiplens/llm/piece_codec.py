"""SentencePiece merge encoding with seeded merge-dropout, and decoding.

The vocabulary of a public merge-type SentencePiece model is used as it is.
Encoding starts from characters and repeatedly performs the best candidate
merge of each word (highest piece score, leftmost on ties), as the model's
own agenda does; a candidate is skipped when the keyed hash of (seed,
document, boundary position, merged piece) falls below the dropout rate.  The
same seed gives the same segmentation on every run and retry; another seed,
document or position gives another one.  With rate 0 the result equals the
model's own encoding.

Words (no piece reaches across a word mark that follows other text) are
independent, so each round performs one merge in every open word of a batch
with array operations.  Words beyond ``_LONG`` characters go through a heap
instead, which is N log N for a text without any space.

Characters outside the vocabulary, and a literal word mark, become byte
pieces, so decoding restores every text exactly.

Edge cases: a null text has null pieces and decodes to null; an empty text has
none and decodes to empty; a null doc_id counts as key 0; repeated rows get
equal pieces; an empty table gives an empty result; other columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import bounded_batches, read
from shiplens.llm.lookup import KeyTable
from shiplens.llm.pieces import SPACE, default_model_path, is_plain, processor, vocabulary

DROPOUT = 0.1
SEED = 20240
_LONG = 96
_AT_ONCE = 60_000  # characters worked on at once
_NONE = np.int64(2**62)


class MergeTable:
    """Characters, pair merges in score order and byte pieces of a merge-type model."""

    def __init__(self, path: str):
        sp, pieces = processor(path), vocabulary(path)
        plain = {p: i for i, p in enumerate(pieces) if is_plain(path, i)}
        self.byte0 = sp.piece_to_id("<0x00>")
        if not sp.is_byte(self.byte0):
            raise ValueError("decoding can only be lossless with a byte-fallback vocabulary")
        if any(SPACE in p.lstrip(SPACE) for p in plain):
            raise ValueError("pieces across words are not supported")
        self.chars = np.full(0x110000, -1, np.int32)
        for p, i in plain.items():
            if len(p) == 1:
                self.chars[ord(p)] = i
        self.chars[ord(" ")], self.chars[ord(SPACE)] = self.chars[ord(SPACE)], -1
        pairs = [(a, b, i) for p, i in plain.items() for k in range(1, len(p)) if (a := plain.get(p[:k])) is not None and (b := plain.get(p[k:])) is not None]
        a, b, merged = np.array(pairs, np.int64).T.copy()
        self.merged = merged.astype(np.int32)
        self.table = KeyTable((a << 32 | b).astype(np.uint64))
        order = sorted(plain.values(), key=lambda i: -sp.get_score(i))
        ranks, rank, last = {}, -1, None
        for i in order:
            if sp.get_score(i) != last:
                rank, last = rank + 1, sp.get_score(i)
            ranks[i] = rank
        self.rank = np.array([ranks[i] for i in self.merged.tolist()], np.int64)
        # rank in the high half, room for a position in the low half; index -1: no merge
        self.wide = np.append(self.rank << 32, _NONE)
        self.narrow = np.append(self.rank << 16, 2**31 - 1).astype(np.int32) if rank < 2**15 - 1 else None
        self.bytes = [bytes([i - self.byte0]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() if is_plain(path, i) else b"" for i, p in enumerate(pieces)]

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.table.find((left.astype(np.int64) << 32 | right).view(np.uint64))


@lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def keyed_uniform(key: np.ndarray, boundary: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """A hash of the three in [0, 1)."""
    x = key ^ (boundary.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (piece.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


def document_key(doc_id: int | None, seed: int) -> int:
    return ((doc_id or 0) * 0xD1342543DE82EF95 + seed * 0x2545F4914F6CDD1D + 0x9E3779B9) & (2**64 - 1)


def heap_merges(ids: list[int], at: list[int], key: int, rate: float, t: MergeTable) -> list[int]:
    """One word's merges with an agenda; ``at`` are the symbols' positions in the document."""
    ids, n = list(ids), len(ids)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]

    def candidates(lefts):
        lefts = [i for i in lefts if i >= 0 and after[i] >= 0]
        if not lefts:
            return []
        rights = [after[i] for i in lefts]
        found = t.find(np.array([ids[i] for i in lefts], np.int64), np.array([ids[i] for i in rights], np.int64))
        ok = np.flatnonzero(found >= 0)
        if rate > 0 and len(ok):
            where = np.array([at[rights[k]] for k in ok], np.int64)
            ok = ok[keyed_uniform(np.uint64(key), where, t.merged[found[ok]]) >= rate]
        return [(int(t.rank[found[k]]), lefts[k], rights[k], ids[lefts[k]], ids[rights[k]], int(t.merged[found[k]])) for k in ok]

    agenda = candidates(range(n - 1))
    heapify(agenda)
    while agenda:
        _, i, j, a, b, merged = heappop(agenda)
        if after[i] != j or ids[i] != a or ids[j] != b:
            continue
        ids[i], ids[j] = merged, None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for c in candidates([before[i], i]):
            heappush(agenda, c)
    return [i for i in ids if i is not None]


def _merge_words(ids: np.ndarray, at: np.ndarray, starts: np.ndarray, keys: np.ndarray, rate: float, t: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """All merges of the words that begin at ``starts``: final ids and their word numbers.

    ``found[i]`` is the merge of symbols i and i + 1 (-1: none, or skipped).
    A round performs the best merge of each open word, drops words that have
    none, and looks up only the pairs beside the new symbols.
    """

    def candidates(i, owner):
        got = t.find(ids[i], ids[i + 1])
        if rate > 0:
            hit = np.flatnonzero(got >= 0)
            skipped = keyed_uniform(keys[owner[hit]], at[i[hit] + 1], t.merged[got[hit]]) < rate
            got[hit[skipped]] = -1
        return got

    narrow = t.narrow is not None and len(ids) <= 1 << 16  # half the memory traffic
    rank_of, low = (t.narrow, 0xFFFF) if narrow else (t.wide, 0xFFFFFFFF)
    position = np.arange(len(ids), dtype=rank_of.dtype)
    word = np.arange(len(starts))
    lengths = np.diff(np.append(starts, len(ids)))
    inner = np.ones(len(ids), bool)
    inner[starts + lengths - 1] = False
    found = np.full(len(ids), -1, np.int32)
    i = np.flatnonzero(inner)
    found[i] = candidates(i, np.repeat(word, lengths - 1))
    done_ids, done_words = [], []
    while len(ids):
        best = np.minimum.reduceat(rank_of[found] | position[: len(ids)], starts)
        open_ = best < rank_of[-1]
        if not open_.all():
            closed = np.repeat(~open_, lengths)
            done_ids.append(ids[closed])
            done_words.append(np.repeat(word[~open_], lengths[~open_]))
            stays = ~closed
        else:
            stays = np.ones(len(ids), bool)
        chosen = best[open_] & low
        ids[chosen] = t.merged[found[chosen]]
        stays[chosen + 1] = False
        place = chosen - (starts[open_] - np.concatenate([[0], np.cumsum(lengths[open_] - 1)])[:-1])
        ids, at, found = ids[stays], at[stays], found[stays]
        word, keys, lengths = word[open_], keys[open_], lengths[open_] - 1
        starts = np.cumsum(lengths) - lengths
        found[place] = -1
        owner = np.arange(len(starts))
        for pair, has in ((place, place < starts + lengths - 1), (place - 1, place > starts)):
            pair = pair[has]
            found[pair] = candidates(pair, owner[has])
    return np.concatenate(done_ids), np.concatenate(done_words)


def encode_texts(texts: list[str], keys: list[int], rate: float, t: MergeTable) -> list[np.ndarray]:
    """Piece ids of each (non-empty) text."""
    points = np.frombuffer("".join([" " + x for x in texts]).encode("utf-32-le"), np.uint32).astype(np.int32)
    sizes = np.array([len(x) + 1 for x in texts])
    begins = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(texts)), sizes)
    ids = t.chars[points]
    ids = np.where(ids < 0, -1 - points, ids)
    mark = points == 32
    first = mark.copy()
    first[1:] &= ~mark[:-1]
    first[begins] = True
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(ids)))
    at = (np.arange(len(ids)) - begins[doc]).astype(np.int32)
    word_doc = doc[starts]
    word_keys = np.array(keys, np.uint64)[word_doc]
    long = lengths > _LONG
    in_short = np.repeat(~long, lengths)
    short_starts = np.cumsum(lengths[~long]) - lengths[~long]
    out_ids, out_words = [], []
    if in_short.any():
        got, words = _merge_words(ids[in_short], at[in_short], short_starts, word_keys[~long], rate, t)
        out_ids.append(got)
        out_words.append(np.flatnonzero(~long)[words])
    for w in np.flatnonzero(long):
        span = slice(starts[w], starts[w] + lengths[w])
        got = np.array(heap_merges(ids[span].tolist(), at[span].tolist(), int(word_keys[w]), rate, t), np.int64)
        out_ids.append(got)
        out_words.append(np.full(len(got), w))
    got, words = np.concatenate(out_ids), np.concatenate(out_words)
    order = np.argsort(words, kind="stable")
    got, docs = got[order], word_doc[words[order]]
    unknown = np.flatnonzero(got < 0)
    if len(unknown):  # byte pieces for characters outside the vocabulary
        code = -1 - got[unknown]
        got[unknown] = t.byte0 + code
        wide = unknown[code > 127]
        if len(wide):
            coded = [chr(c).encode() for c in code[code > 127].tolist()]
            times = np.ones(len(got), np.int64)
            times[wide] = [len(c) for c in coded]
            offset = (np.cumsum(times) - times)[wide]
            got, docs = np.repeat(got, times), np.repeat(docs, times)
            for o, c in zip(offset.tolist(), coded):
                got[o : o + len(c)] = np.frombuffer(c, np.uint8) + t.byte0
    cuts = np.searchsorted(docs, np.arange(1, len(texts)))
    return np.split(got.astype(np.int32), cuts)


def decode_ids(ids, t: MergeTable) -> str:
    """The text of piece ids: their bytes, without the word mark that encoding puts in front."""
    return b"".join(map(t.bytes.__getitem__, ids)).decode("utf-8", "replace")[1:]


def encoded(docs: DataFrame, rate: float = DROPOUT, seed: int = SEED, model: str | None = None) -> DataFrame:
    """``docs`` with ``piece_ids array<int>``."""
    model = model or default_model_path()
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        t = merge_table(model)
        none = np.empty(0, np.int32)
        for ids, texts in batches:
            out: list = [None if x is None else none for x in texts]
            todo, chars = [], 0
            for i, x in [*enumerate(texts), (None, None)]:
                if todo and (x is None or chars + len(x) > _AT_ONCE):
                    keys = [document_key(None if pd.isna(ids[k]) else int(ids[k]), seed) for k in todo]
                    for k, got in zip(todo, encode_texts([texts[k] for k in todo], keys, rate, t)):
                        out[k] = got
                    todo, chars = [], 0
                if x:
                    todo.append(i)
                    chars += len(x) + 1
            yield pd.Series(out, dtype=object)

    # a document id as text: a long column with nulls would arrive as floats
    return docs.withColumn("piece_ids", encode(F.col("doc_id").cast("string"), F.col("text")))


def decoded(pieces: DataFrame, model: str | None = None) -> DataFrame:
    """``pieces`` with ``decoded_text``, the text its ``piece_ids`` stand for."""
    model = model or default_model_path()
    bounded_batches(pieces.sparkSession)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = merge_table(model)
        for lists in batches:
            yield pd.Series([None if x is None else decode_ids(x.tolist(), t) for x in lists], dtype=object)

    return pieces.withColumn("decoded_text", decode("piece_ids"))


def op3_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document under merge-dropout, and a digest of the text read back from them."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    back = decoded(encoded(docs))
    return back.select(
        "doc_id",
        "piece_ids",
        F.coalesce(F.size("piece_ids"), F.lit(0)).alias("n_pieces"),
        F.sha2("decoded_text", 256).alias("decoded_sha256"),
        F.col("decoded_text").eqNullSafe(F.col("text")).alias("lossless"),
    )
