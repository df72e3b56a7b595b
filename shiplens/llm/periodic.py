"""Periodic runs of words: maximal repetitions found from their Lyndon roots.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), long enough, that no neighbouring word extends keeping q.  Each
run has a root, a Lyndon word of length q, which is the longest Lyndon word at
each of its places in the run under one of two orders of the words: some order
or its reverse.  Phase one of Baier's suffix sorter groups the places of a text
by their longest Lyndon word, so running it under both orders gives both Lyndon
arrays (:func:`lyndon_groups`).  Neighbouring places of one group are repeats of
a root; extending them by the longest common extension (:func:`_extended`) gives the run.

Only places that a run can hold are sorted.  A run of ``least`` = 6 words and
four periods consists of triples of words that occur three times or more in the
text, so stretches of other words are cut out first (:func:`_stretches`); what
is cut out can't be in a run, so no run is lost or shortened.

Edge cases: a null or blank text has no words and no runs, and collapses to an
empty text; a text of any length is read whole and never split, so one very
long text is one task's work; texts don't share state, so repeated rows have
equal results; ties between longest runs go to the smallest start, then the
smallest period; an empty table gives no rows; other columns pass through
unread, and an added column may not have the name of one that is there (error).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import bounded_batches, read

LEAST_WORDS, LEAST_PERIODS = 6, 4
BLOCK_BYTES = 4 << 20
TYPE = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"
_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed", pa.string()),
])
_ODD, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def lyndon_groups(codes: list[int], descending: bool = False) -> tuple[list[int], list[int]]:
    """For each place: its group, and the length of its longest Lyndon word; places of one group have the same word.

    Negative codes are ends of texts, smaller than all words in both orders.
    Groups are finished from the greatest to the smallest: the places of a
    finished group with word u each lengthen the word of the nearest place to
    the left in a smaller group by u.  Those places then leave their group for
    new ones right above it, by how often u follows.
    """
    size = len(codes)
    members: list[list[int]] = []
    length: list[int] = []
    below, above = [], []  # neighbours in the order of the groups' words, -1 at the ends
    group = [-1] * size
    first: dict[int, int] = {}
    for c in sorted(set(codes), reverse=descending):
        if c >= 0:
            first[c] = len(members)
            below.append(len(members) - 1)
            above.append(len(members) + 1)
            members.append([])
            length.append(1)
    if not members:
        return group, [0] * size
    above[-1] = -1
    for i, c in enumerate(codes):
        if c >= 0:
            group[i] = first[c]
            members[first[c]].append(i)
    left = [-1] * size  # the nearest place to the left in a smaller group, once finished
    finished = bytearray(size)
    g = len(members) - 1
    while g >= 0:
        places, counts = [], []
        for i in members[g]:
            if group[i] != g:
                continue
            p = i - 1
            while p >= 0 and finished[p]:
                p = left[p]
            left[i] = p
            finished[i] = 1
            if p >= 0 and codes[p] >= 0:
                if places and places[-1] == p:
                    counts[-1] += 1
                else:
                    places.append(p)
                    counts.append(1)
        moved: dict[tuple[int, int], list[int]] = {}
        for p, count in zip(places, counts, strict=True):
            moved.setdefault((group[p], count), []).append(p)
        under = {old: old for old, _ in moved}
        for old, count in sorted(moved):
            new, low = len(members), under[old]
            high = above[low]
            members.append(moved[old, count])
            length.append(length[old] + count * length[g])
            below.append(low)
            above.append(high)
            above[low] = new
            if high >= 0:
                below[high] = new
            under[old] = new
            for p in moved[old, count]:
                group[p] = new
        g = below[g]
    return group, [length[x] if x >= 0 else 0 for x in group]


def _extended(codes: list[int], start: int, end: int, period: int) -> tuple[int, int]:
    """The longest stretch around ``[start, end)`` in which words ``period`` apart are equal."""
    while start and codes[start - 1] == codes[start - 1 + period]:
        start -= 1
    while end < len(codes) and codes[end] == codes[end - period]:
        end += 1
    return start, end


def runs_of(codes: list[int]) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of texts set one after the other, each followed by a negative code of its own."""
    found = set()
    for descending in (False, True):
        group, length = lyndon_groups(codes, descending)
        i, last = 0, len(codes)
        for i in range(last):
            q = length[i]
            # the first of at least two neighbouring places of a root
            if not q or i + q >= last or group[i + q] != group[i] or (i >= q and group[i - q] == group[i]):
                continue
            end = i + 2 * q
            while end < last and group[end] == group[i]:
                end += q
            start, end = _extended(codes, i, end, q)
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
                found.add((start, end - start, q))
    return sorted(found, key=lambda x: (x[0], x[2]))


def _stretches(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that runs can hold: triples of words that one text has three times or more.

    Texts end with a code below -1, different from text to text.
    """
    text = np.cumsum(codes < -1).astype(np.uint64)
    x = codes.astype(np.uint64)
    key = ((x[:-2] * _ODD + x[1:-1]) * _ODD + x[2:]) * _ODD2 + text[:-2]
    key = (key ^ (key >> np.uint64(29))) * _ODD  # equal triples have equal keys; others rarely do, which costs time only
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])) if len(order) else np.empty(0, np.int64)
    often = np.diff(np.append(starts, len(order))) >= 3
    at = order[np.repeat(often, np.diff(np.append(starts, len(order))))]
    held = np.zeros(len(codes) + 2, bool)
    for k in range(3):
        held[at + k + 1] = True
    held[1:-1] &= codes >= 0
    edges = np.flatnonzero(held[1:] != held[:-1])
    first, last = edges[::2], edges[1::2]
    long = last - first >= LEAST_WORDS
    return first[long], last[long]


class _Codes(dict):
    """A number for each word seen."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _block(texts: list[bytes | None]) -> list[dict]:
    """One struct of ``TYPE`` for each text."""
    number = _Codes()
    words = [(t or b"").split() for t in texts]  # bytes split at [\x20\x09-\x0D]+ alone
    coded = []
    for k, w in enumerate(words):
        coded.append(np.fromiter(map(number.__getitem__, w), np.int64, len(w)))
        coded.append(np.array([-2 - k]))
    offsets = np.cumsum([0, *(len(w) + 1 for w in words)])
    codes = np.concatenate(coded) if coded else np.empty(0, np.int64)
    found: list[list[dict]] = [[] for _ in words]
    if len(codes) > 2:
        first, last = _stretches(codes)
        joined: list[int] = []
        at = []  # where each stretch begins in ``joined``
        for i, (a, b) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
            at.append(len(joined))
            joined.extend(codes[a:b].tolist())
            joined.append(-2 - i)
        runs = runs_of(joined)
        if runs:
            begin = np.array([r[0] for r in runs])
            which = np.searchsorted(at, begin, side="right") - 1
            place = first[which] + begin - np.array(at)[which]
            text = np.searchsorted(offsets, place, side="right") - 1
            for t, s, (_, length, period) in zip(text.tolist(), (place - offsets[text]).tolist(), runs, strict=True):
                found[t].append({"start": s, "length": length, "period": period})
    return [{"n_words": len(w), "runs": r, "collapsed": _collapsed(w, r).decode()} for w, r in zip(words, found, strict=True)]


def _collapsed(words: list[bytes], runs: list[dict]) -> bytes:
    """The words that no run contains after its first period, with one space between."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for r in runs:
        kept[r["start"] + r["period"] : r["start"] + r["length"]] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


def with_runs(docs: DataFrame, text: str | Column = "text", out: str = "periodic") -> DataFrame:
    """``docs`` with a struct ``out``: the number of words, the runs by start and period, and the text without its repeats."""
    if out in docs.columns:
        raise ValueError(f"the rows have a column {out} of their own; name another")
    bounded_batches(docs.sparkSession)

    @F.arrow_udf(TYPE)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            rows, texts, size = [], [], 0
            for value in values:
                value = value.as_py()
                if texts and size + len(value or b"") > BLOCK_BYTES:
                    rows += _block(texts)
                    texts, size = [], 0
                texts.append(value)
                size += len(value or b"")
            yield pa.array(rows + _block(texts), _ARROW)

    return docs.withColumn(out, found((F.col(text) if isinstance(text, str) else text).cast("binary")))


def longest_run(runs: Column) -> Column:
    """The longest run; ties go to the smallest start, then the smallest period; null if there is none."""
    order = F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    return F.array_min(order)


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with the words of a tenth of the documents made periodic from some place on.

    With h = crc32(doc_id as text) and g = floor(h / 10): if h % 10 is 0, word
    i >= a becomes word a + (i - a) % p, with a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    A null doc_id has no h.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # a step of its own, so that each text is split once
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, split).alias("words"))
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    period = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    repeated = F.concat(F.slice("words", F.lit(1), a), F.slice(period, F.lit(1), n - a))
    return rows.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, its longest run, and digests of its runs and of its text without repeats."""
    docs = planted(read(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = with_runs(docs).select("doc_id", "periodic", longest_run(F.col("periodic.runs")).alias("best"))
    lines = F.transform("periodic.runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.select(
        "doc_id",
        F.size("periodic.runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"),
    )
