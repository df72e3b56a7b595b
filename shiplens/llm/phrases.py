"""Phrase collocations from count streams kept in prefix and suffix order.

The layout is that of external language-model estimation.  Counts of phrases
are streams sorted by their words (prefix order) and by their words from the
last to the first (suffix order).  One pass over the prefix stream meets each
phrase right after its own heads and right before its extensions to the right;
one pass over the suffix stream does the same for tails and extensions to the
left; the two streams are then merged on the phrase.  No count is looked up in
a hash table.

Only phrases that can reach the least count enter the streams.  A phrase is no
more frequent than any part of it, so a position takes part in order k only if
the shorter phrases there are frequent.  That sieve is a bit table of bounded
size (``MAX_BITS``): it may let a rare phrase pass, never hold a frequent one
back, and the exact counts that follow decide.  The sieve's counts are made from
sorted blocks of phrase keys, dealt by key range and merged.

Edge cases: a null text has no words; a null ``lang`` is ``und``; an empty
table gives no rows; repeated rows count again; a text of any length is read
whole; equal scores are ordered by count and then by the phrase's UTF-8 bytes;
columns beside ``lang`` and ``text`` are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiplens.llm.common import bounded_batches, byte_slices, read, staged

LEAST = 30
LONGEST = 4
TOP = 2000
# a longer phrase with this share of the count (in hundredths) takes a candidate's place
SUBSUMED = 80
# the sieve has 16 bits for a phrase that passes, but no more than this (16 MB)
MAX_BITS = 1 << 27
BLOCK_BYTES = 4 << 20
# phrase keys sorted together before they are sent on, and merged in one task
RUN_KEYS, BUCKET_KEYS = 1 << 21, 1 << 22
TOP_SALTS = 64

_SEPARATOR, _BREAK = b" \t", b".,;:!?\n\x0b\x0c\r"
_ODD, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_KIND = np.zeros(256, np.uint8)
_KIND[list(_SEPARATOR)], _KIND[list(_BREAK)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Block:
    """The words of some texts as arrays.

    ``codes`` index ``words``, ``lang`` indexes ``langs`` (both per word), and
    ``linked[t]`` says that the words t and t+1 stand in one piece.
    """

    def __init__(self, langs: pa.Array, texts: pa.Array):
        texts = texts.fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        kind = _KIND[raw]
        inside = kind == 0
        firsts = offsets[:-1][offsets[:-1] < len(raw)]
        before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[firsts] = False
        after[firsts[firsts > 0] - 1] = False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        doc = np.searchsorted(offsets, starts, side="right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
        self.linked = np.zeros(len(starts), bool)
        self.linked[:-1] = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
        ends = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        letters = pa.py_buffer(_LOWER[raw[inside]])
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), letters]).dictionary_encode()
        self.words = coded.dictionary
        self.codes = coded.indices.to_numpy().astype(np.int64)
        named = langs.dictionary_encode()
        self.langs = named.dictionary
        self.lang = named.indices.to_numpy()[doc].astype(np.int64)

    def keys(self) -> np.ndarray:
        """64-bit key of each word within its language."""
        return word_keys(self.words, self.codes, self.langs, self.lang)


def word_keys(words: pa.Array, codes: np.ndarray, langs: pa.Array, lang: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    of_word = np.fromiter((digest(w) for w in words.to_pylist()), np.uint64, len(words))
    of_lang = np.fromiter((digest(x.encode(), 7) for x in langs.to_pylist()), np.uint64, len(langs))
    return _mixed(of_word[codes] * _ODD + of_lang[lang])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _ODD2
    return x ^ (x >> np.uint64(32))


def _phrase_keys(keys: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """Keys of the phrases of ``order`` words that begin at ``at``."""
    out = keys[at] + np.uint64(order)
    for k in range(1, order):
        out = out * _ODD + keys[at + k]
    return _mixed(out)


class Sieve:
    """A table of bits: ``passes`` is true for every key that was put in, and for few others.

    With ``key_bits`` it holds kept keys (:func:`_kept`) of phrases, else keys of words.
    """

    def __init__(self, table: np.ndarray, key_bits: int | None = None):
        self.table, self.key_bits = table, key_bits

    def passes(self, keys: np.ndarray) -> np.ndarray:
        at = _bit(keys if self.key_bits is None else _kept(keys, self.key_bits), len(self.table) * 64)
        return (self.table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def _bit(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys * _ODD) >> np.uint64(64 - (bits.bit_length() - 1))


def _shared_sieve(keys: DataFrame, key_bits: int | None = None):
    """The broadcast :class:`Sieve` of a long column ``key``; at most ``MAX_BITS`` large."""
    bits = min(MAX_BITS, 1 << max(16, (16 * keys.count()).bit_length()))

    def slots(batches):
        for b in batches:
            at = _bit(b.column(0).to_numpy().view(np.uint64), bits)
            at = np.sort(at)
            slot = (at >> np.uint64(6)).astype(np.int64)
            starts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(at) else []
            if len(starts):
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), starts)
                yield pa.RecordBatch.from_arrays([pa.array(slot[starts]), pa.array(value.view(np.int64))], names=["slot", "value"])

    # at most bits / 64 rows reach the driver
    found = keys.mapInArrow(slots, "slot long, value long").groupBy("slot").agg(F.bit_or("value").alias("value")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[found.column("slot").to_numpy()] = found.column("value").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(Sieve(table, key_bits))


def _texts(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))


def _blocks(batches) -> Iterator[Block]:
    for part in byte_slices(batches, "text", BLOCK_BYTES):
        yield Block(part.column(0), part.column(1))


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, phrase, a``: the words that occur ``least`` times or more; a null phrase counts all words of the language."""

    def counted(batches):
        for block in _blocks(batches):
            if not len(block.codes):
                continue
            key = block.codes * len(block.langs) + block.lang
            count = np.bincount(key)
            key = np.flatnonzero(count)
            words = block.words.cast(pa.string()).take(pa.array(key // len(block.langs)))
            totals = np.bincount(block.lang, minlength=len(block.langs))
            lang = pa.concat_arrays([block.langs.take(pa.array(key % len(block.langs))), block.langs])
            phrase = pa.concat_arrays([words, pa.nulls(len(totals), pa.string())])
            yield pa.RecordBatch.from_arrays([lang, phrase, pa.array(np.concatenate([count[key], totals]))], names=["lang", "phrase", "a"])

    parts = _texts(docs).mapInArrow(counted, "lang string, phrase string, a long")
    return parts.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where((F.col("a") >= least) | F.col("phrase").isNull())


def _word_sieve(words: DataFrame):
    def keyed(batches):
        for b in batches:
            langs = b.column(0).dictionary_encode()
            keys = word_keys(b.column(1).cast(pa.binary()), np.arange(b.num_rows), langs.dictionary, langs.indices.to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])

    return _shared_sieve(words.where("phrase is not null").select("lang", "phrase").mapInArrow(keyed, "key long"))


def _starts(block: Block, keys: np.ndarray, sieves: list[Sieve]) -> dict[int, np.ndarray]:
    """Where phrases of each order may begin: words that pass, then pairs, then threes and fours."""
    word = sieves[0].passes(keys)
    pair = np.zeros(len(keys), bool)
    at = np.flatnonzero(word[:-1] & word[1:] & block.linked[:-1])
    if len(sieves) > 1:
        at = at[sieves[1].passes(_phrase_keys(keys, at, 2))]
    pair[at] = True
    out = {2: at}
    if len(sieves) == 1:
        return out
    out[3] = np.flatnonzero(pair[:-1] & pair[1:])
    out[4] = np.flatnonzero(pair[:-2] & pair[1:-1] & pair[2:])
    if len(sieves) > 2:
        three = np.zeros(len(keys), bool)
        out[3] = out[3][sieves[2].passes(_phrase_keys(keys, out[3], 3))]
        three[out[3]] = True
        out[4] = out[4][three[out[4]] & three[out[4] + 1]]
        out[4] = out[4][sieves[2].passes(_phrase_keys(keys, out[4], 4))]
    return out


def _key_bits(n_words: int) -> int:
    """Leading bits of a key that name its bucket: about BUCKET_KEYS keys to a bucket."""
    return max(8, int(max(n_words, 1) // BUCKET_KEYS).bit_length())


def _kept(keys: np.ndarray, bits: int) -> np.ndarray:
    """A key as kept in the streams: its bucket and its last 32 bits."""
    return ((keys >> np.uint64(64 - bits)) << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))


def _frequent_keys(docs: DataFrame, shared: list, orders: tuple[int, ...], bits: int, least: int) -> DataFrame:
    """The kept keys of phrases of ``orders`` that occur ``least`` times or more."""

    def run(held):
        keys, count = np.unique(np.concatenate(held), return_counts=True)
        bucket = (keys >> np.uint64(32)).astype(np.int32)
        count = np.minimum(count, least).astype(np.uint8 if least < 256 else np.int64)
        which, first = np.unique(bucket, return_index=True)
        ends = np.append(first[1:], len(keys))
        low = keys.astype(np.uint32)
        columns = [pa.array(which), pa.array([low[i:j].tobytes() for i, j in zip(first, ends, strict=True)], pa.binary()), pa.array([count[i:j].tobytes() for i, j in zip(first, ends, strict=True)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["bucket", "low", "count"])

    def sorted_runs(batches):
        sieves, held, size = [x.value for x in shared], [], 0
        for block in _blocks(batches):
            keys = block.keys()
            if len(keys) < 2:
                continue
            starts = _starts(block, keys, sieves)
            for k in orders:
                if len(starts[k]):
                    held.append(_kept(_phrase_keys(keys, starts[k], k), bits))
                    size += len(starts[k])
            if size >= RUN_KEYS:
                yield run(held)
                held, size = [], 0
        if held:
            yield run(held)

    def merged(batches):
        def total(bucket, lows, counts):
            low, count = np.concatenate(lows), np.concatenate(counts).astype(np.int64)
            order = np.argsort(low, kind="stable")  # the parts are sorted runs: a merge
            low = low[order]
            starts = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
            keep = low[starts[np.add.reduceat(count[order], starts) >= least]]
            return pa.RecordBatch.from_arrays([pa.array(((np.uint64(bucket) << np.uint64(32)) | keep.astype(np.uint64)).view(np.int64))], names=["key"])

        now, lows, counts = None, [], []
        for b in batches:
            for bucket, low, count in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                if bucket != now and lows:
                    yield total(now, lows, counts)
                    lows, counts = [], []
                now = bucket
                lows.append(np.frombuffer(low.as_buffer(), np.uint32))
                counts.append(np.frombuffer(count.as_buffer(), np.uint8 if least < 256 else np.int64))
        if lows:
            yield total(now, lows, counts)

    runs = _texts(docs).mapInArrow(sorted_runs, "bucket int, low binary, count binary")
    return runs.repartition(1 << bits, "bucket").sortWithinPartitions("bucket").mapInArrow(merged, "key long")


def _exact_counts(docs: DataFrame, shared: list, least: int) -> DataFrame:
    """``lang, phrase, a`` of the phrases of two words and more that occur ``least`` times or more."""

    def counted(batches):
        sieves = [x.value for x in shared]
        for block in _blocks(batches):
            if len(block.codes) < 2:
                continue
            starts = _starts(block, block.keys(), sieves)
            words = block.words.cast(pa.string())
            for k, at in starts.items():
                if not len(at):
                    continue
                # rank the phrases exactly, a word at a time, so that equal rank means equal words
                rank = block.lang[at]
                for j in range(k):
                    rank = np.unique(rank * len(words) + block.codes[at + j], return_inverse=True)[1]
                _, first, count = np.unique(rank, return_index=True, return_counts=True)
                one = at[first]
                phrase = pc.binary_join_element_wise(*[words.take(pa.array(block.codes[one + j])) for j in range(k)], " ")
                yield pa.RecordBatch.from_arrays([block.langs.take(pa.array(block.lang[one])), phrase, pa.array(count)], names=["lang", "phrase", "a"])

    parts = _texts(docs).mapInArrow(counted, "lang string, phrase string, a long")
    return parts.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def count_streams(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Counts of words (with totals per language) and of phrases of 2 to 4 words, both staged."""
    words = staged(word_counts(docs, least), "words")
    total = words.where("phrase is null").agg(F.sum("a")).first()[0] or 0
    bits = _key_bits(total)
    shared = [_word_sieve(words)]
    for orders in ((2,), (3, 4)):
        keys = staged(_frequent_keys(docs, shared, orders, bits, least), "phrase-keys")
        shared.append(_shared_sieve(keys, bits))
    phrases = staged(_exact_counts(docs, shared, least), "phrases")
    for x in shared:
        x.unpersist()
    return words, phrases


def _in_order(words: DataFrame, phrases: DataFrame, side: str) -> DataFrame:
    """One pass over the count stream in prefix (``l``) or suffix (``r``) order.

    ``lang, phrase, a, <side>1..3`` (counts of the parts of 1 to 3 words at
    that end) and ``<side>_longer`` (greatest count of an extension by a word
    at the other end).  In the stream a part of two or three words stands
    right before all phrases that begin with it, so its count is carried
    along; the parts of one word come from their own stream by a merge join.
    """
    w = F.split("phrase", " ")
    rows = phrases.select("lang", "phrase", "a", F.size(w).alias("k"), (w if side == "l" else F.reverse(w)).alias("w"))
    rows = rows.select("lang", "phrase", "a", "k", *[F.get("w", F.lit(i)).alias(f"w{i + 1}") for i in range(LONGEST)])
    pair = Window.partitionBy("lang", "w1", "w2")
    stream = pair.orderBy(F.col("w3").asc_nulls_first(), F.col("w4").asc_nulls_first())
    three = Window.partitionBy("lang", "w1", "w2", "w3")
    count = lambda k: F.when(F.col("k") == k, F.col("a"))
    passed = rows.select(
        *["lang", "phrase", "a", "k", "w1"],
        F.first("a").over(stream).alias(f"{side}2"),
        F.last(count(3), ignorenulls=True).over(stream).alias(f"{side}3"),
        F.when(F.col("k") == 2, F.max(count(3)).over(pair)).when(F.col("k") == 3, F.max(count(4)).over(three)).alias(f"{side}_longer"),
    )
    one = words.where("phrase is not null").select("lang", F.col("phrase").alias("w1"), F.col("a").alias(f"{side}1"))
    return passed.join(one.hint("merge"), ["lang", "w1"]).drop("w1")


def scored_phrases(words: DataFrame, phrases: DataFrame, subsumed: int = SUBSUMED) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of each candidate that no longer phrase takes the place of."""
    heads = _in_order(words, phrases, "l")
    tails = _in_order(words, phrases, "r").drop("a", "k")
    both = heads.join(tails.hint("merge"), ["lang", "phrase"])
    # a longer candidate around this one holds an extension by one word, which is no rarer
    longer = F.greatest(F.coalesce("l_longer", F.lit(0)), F.coalesce("r_longer", F.lit(0)))
    both = both.where(100 * longer < subsumed * F.col("a"))
    cut = "struct(cast((cast(a as decimal(20,0)) * 2000000) div (cast(l{k} as decimal(20,0)) + r{j}) as bigint) as score, {k} as cut, l{k} as l, r{j} as r)"
    best = F
    for size in range(2, LONGEST + 1):
        cuts = [F.expr(cut.format(k=k, j=size - k)) for k in range(1, size)]
        best = best.when(F.col("k") == size, F.least(*cuts) if size > 2 else cuts[0])
    return both.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def top_phrases(scored: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language with their ``rank``; a language is cut in parts first, so no task gets all of it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS))
    few = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    few = few.where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).drop("part")


def collocations(docs: DataFrame, least: int = LEAST, subsumed: int = SUBSUMED, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language of ``docs(lang, text)``."""
    words, phrases = count_streams(docs, least)
    total = words.where("phrase is null").select("lang", F.col("a").alias("n"))
    ranked = top_phrases(scored_phrases(words, phrases, subsumed), top)
    return ranked.join(total.hint("merge"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language over all ``documents``."""
    return collocations(read(spark, sf_dir, "documents").select("lang", "text"))


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?
-
]')) AS piece
  FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
  GROUP BY ALL
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
often AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM grams WHERE f >= 30),
cuts AS (
  SELECT p.lang, p.k, p.phrase, p.f AS a, h.f AS l, t.f AS r, h.k AS cut,
         ((2000000::HUGEINT * p.f) // (h.f + t.f))::BIGINT AS score
  FROM often p
  JOIN often h ON h.lang = p.lang AND h.k < p.k AND h.phrase = array_to_string(p.w[1:h.k], ' ')
  JOIN often t ON t.lang = p.lang AND t.k = p.k - h.k AND t.phrase = array_to_string(p.w[h.k + 1:p.k], ' ')
  WHERE p.k >= 2
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, k, w, f, i, unnest(range(i + 1, k + 1)) AS j
        FROM (SELECT lang, k, w, f, unnest(range(1, k)) AS i FROM often WHERE k > 2))
  WHERE j - i + 1 < k GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_parts x USING (lang, phrase)
  WHERE 100 * coalesce(x.longer, 0) < 80 * b.a
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase) ASC) AS rank,
         phrase, a, l, r, score FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
