"""Toxic spans by a linear-chain conditional random field, summed up to a document score.

Each word is outside (O) or inside (T) a toxic span.  The score of a tagging is
the sum of word scores of its T words and of transition scores; O has score 0,
so the tagging without any T has score 0 and a text's probability of holding a
toxic span is 1 - exp(-log Z).  Word scores come from hashed features of the
word (whole, first 3 to 8 letters, last 3) and of its neighbours.

Labelled tokens come from labelled documents: a word form or word beginning is
evidence if its share of the distinct contexts (word with both neighbours) of toxic
documents is far above its share in clean ones; copies of a text share their contexts,
so they count once.  The words of toxic documents that have such a form are T,
all others and all words of clean documents O.  A toxic document without any
such word has no known spans and takes no part.  The chain is then trained by
maximum likelihood: every step is a Spark job over the staged tokens that
returns the gradient, and L-BFGS moves the weights.

Marginals of T make spans (``TOXIC_AT`` or more, as offsets in code points) and
the document's score: a logistic function of the sum of their squares and of the
number of words, fitted to the labels of the sample.  A word that is toxic in
one text and ordinary in another thus weighs less in a long text; the squares
keep the many tiny marginals of a long text from adding up to a toxic word.

Forward and backward passes run over whole batches of texts at once: with two
states each pass is a chain of fractional linear maps of one number, the ratio
of the two states, composed block by block (:func:`_chain`).

Training reads a bounded sample of labelled documents (``TRAIN_TOXIC`` and
``TRAIN_CLEAN`` in expectation, by a hash of doc_id, the same on every run);
scoring reads every text whole, however long.

Edge cases: a null text or one without words has score 0 and no spans; null
labels take no part; a doc_id with labels of both kinds takes no part, equal
labels count once; of several texts under one sampled doc_id the greatest is
learned; without toxic or without clean documents, or when no form stands out,
every score is 0; a null doc_id is never learned and counts as not held out;
repeated rows have equal scores; an empty table gives no rows; other columns
pass through unread, and an added column may not have the name of one there (error).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import HASHES, bounded_batches, crc_fold, hash_value, read, staged

TRAIN_TOXIC, TRAIN_CLEAN = 2000, 4000
BITS = 18
TRAIN_PARTS = 6
STEPS, HISTORY, RIDGE = 25, 8, 0.3
# a form is evidence if toxic contexts have it this much more often than clean ones, at two standard errors
EVIDENCE, LEAST_CONTEXTS = 4.0, 5
TOXIC_AT = 0.5
SHORTEST, LONGEST = 3, 8
BLOCK_CHARS = 2 << 20
TYPE = "struct<score: double, spans: array<struct<start: int, end: int, probability: double>>>"
_ARROW = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])))])
_WORD = re.compile(r"\w+")
_CACHE = 300_000
# hashed features of a word, then those of it as a neighbour
OWN, NEAR = LONGEST - SHORTEST + 3, 2
_ODD = 0x9E3779B97F4A7C15


def _features(word: str) -> list[int]:
    """Hashes of a word's forms: itself, its beginnings (the word's own hash where it is too short), its end."""
    crc = zlib.crc32
    whole = crc(word.encode("utf-8", "surrogatepass"))
    out = [whole]
    h = crc(word[:SHORTEST].encode("utf-8", "surrogatepass"))
    for k in range(SHORTEST, LONGEST + 1):
        out.append(h ^ 0x5BD1E995 if len(word) >= k else whole)
        h = crc(word[k : k + 1].encode("utf-8", "surrogatepass"), h)
    out.append(crc(word[-3:].encode("utf-8", "surrogatepass")) ^ 0x2545F491)
    return out


def _index(hashes: np.ndarray, role: int, bits: int) -> np.ndarray:
    x = (hashes.astype(np.uint64) + np.uint64(role << 33)) * np.uint64(_ODD)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)).astype(np.int64)


def _indexes(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights used by each word: for its own score, for the next word's, for the last word's."""
    h = np.array([_features(w.lower()) for w in words], np.uint64).reshape(len(words), OWN)
    near = h[:, [0, 3]]  # the word and its first five letters
    return _index(h, 0, bits), _index(near, 1, bits), _index(near, 2, bits)


def _chain(c: np.ndarray, d: np.ndarray, e: np.ndarray, start: float) -> np.ndarray:
    """All x[t] = (c[t] + d[t] x[t-1]) / (1 + e[t] x[t-1]) with x[-1] = start."""
    n = len(c)
    size = max(1, math.isqrt(n))
    blocks = -(-n // size)
    pad = blocks * size - n
    c, d, e = (np.concatenate([v, np.full(pad, fill)]).reshape(blocks, size).T.copy() for v, fill in ((c, 0.0), (d, 1.0), (e, 0.0)))
    # the map of each block: x -> (p x + q) / (r x + s)
    p, q, r, s = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for t in range(size):
        p, q, r, s = d[t] * p + c[t] * r, d[t] * q + c[t] * s, e[t] * p + r, e[t] * q + s
        scale = 1 / np.maximum(np.maximum(p, q), np.maximum(r, s))
        p, q, r, s = p * scale, q * scale, r * scale, s * scale
    first, x = np.empty(blocks), start
    for k, (pk, qk, rk, sk) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True)):
        first[k] = x
        x = (pk * x + qk) / (rk * x + sk)
    out, x = np.empty((size, blocks)), first
    for t in range(size):
        x = out[t] = (c[t] + d[t] * x) / (1 + e[t] * x)
    return out.T.ravel()[:n]


class Chain:
    """Probabilities of texts set one after the other; ``first`` marks their first words."""

    def __init__(self, scores: np.ndarray, first: np.ndarray, moves: np.ndarray):
        """``moves``: transition scores O to T, T to O, T to T."""
        scores = np.clip(scores, -30, 30)
        to, back, stay = np.exp(moves)
        weight = np.exp(scores)
        self.first = first
        self.ot = to * weight
        self.tt = np.where(first, self.ot, stay * weight)
        self.to = np.where(first, 1.0, back)
        self.ratio = _chain(self.ot, self.tt, self.to, 0.0)
        after = np.ones(len(scores))
        after[:-1] = _chain(self.to[:0:-1], self.tt[:0:-1], self.ot[:0:-1], 1.0)[::-1]
        self.after = after

    def marginals(self) -> np.ndarray:
        both = self.ratio * self.after
        return both / (1 + both)

    def log_z(self) -> np.ndarray:
        """Log of the sum over all taggings, per text."""
        starts = np.flatnonzero(self.first)
        before = np.append(0.0, self.ratio[:-1])
        step = np.where(self.first, 0.0, np.log1p(self.to * before))
        last = np.append(starts[1:], len(self.ratio)) - 1
        return np.add.reduceat(step, starts) + np.log1p(self.ratio[last])

    def moves(self) -> np.ndarray:
        """Expected numbers of the transitions O to T, T to O, T to T."""
        before = np.where(self.first, 0.0, np.append(0.0, self.ratio[:-1]))
        ot, back, stay = self.ot * self.after, before * self.to, before * self.tt * self.after
        total = 1 + ot + back + stay
        return np.array([(ot / total).sum(), (back / total).sum(), (stay / total).sum()])


def _scores(own: np.ndarray, as_last: np.ndarray, as_next: np.ndarray, first: np.ndarray, bias: float) -> np.ndarray:
    """Word scores from what each word gives to itself, to the word after and to the word before it."""
    out = own + bias
    inner = ~first[1:]
    out[1:] += np.where(inner, as_last[:-1], 0)
    out[:-1] += np.where(inner, as_next[1:], 0)
    return out


# -- labelled tokens ----------------------------------------------------------------


def labelled_texts(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN) -> DataFrame:
    """``doc_id, toxic, weight, text``: the bounded sample, one row per doc_id that stands for ``weight`` labels."""
    usable = labels.where("toxic is not null and doc_id is not null").where(crc_fold("doc_id", 5) != 0)
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    usable = usable.where("toxic = most and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int"))
    n = {r[0]: r[1] for r in usable.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, toxic / max(n.get(1, 0), 1))).otherwise(min(1.0, clean / max(n.get(0, 0), 1)))
    # about `toxic + clean` ids, whatever the size of the tables
    sample = usable.withColumn("weight", 1 / share).where(hash_value(F.col("doc_id")) < share * HASHES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    return rows.groupBy("doc_id", "toxic", "weight").agg(F.max("text").alias("text")).where("text is not null")


def evidence(sample: DataFrame) -> set[str]:
    """Word forms that mark toxic documents: a beginning, or a whole word with ``$``."""

    def contexts(batches):
        for b in batches:
            words, key, toxic = [], [], []
            for text, label in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                found = _WORD.findall(text.lower())
                h = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in ["", *found, ""]], np.uint64)
                words += found
                key.append((h[:-2] * np.uint64(_ODD) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:])
                toxic += [label] * len(found)
            if words:
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.concatenate(key).view(np.int64)), pa.array(toxic, pa.int32())], names=["word", "context", "toxic"])

    bounded_batches(sample.sparkSession)
    rows = sample.select("doc_id", "text", "toxic").mapInArrow(contexts, "word string, context long, toxic int")
    once = rows.groupBy("word", "context").agg(F.min("toxic").alias("toxic"))  # seen in a clean document: clean
    words = once.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    forms = F.concat(
        F.transform(F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length("word"))), lambda k: F.substring("word", 1, k)),
        F.array(F.concat("word", F.lit("$"))),
    )
    whole = F.array(F.concat("word", F.lit("$")))
    forms = words.select(F.explode(F.when(F.length("word") >= SHORTEST, forms).otherwise(whole)).alias("form"), "t", "c").groupBy("form").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    total = words.agg(F.sum("t"), F.sum("c")).first()
    if not total[0] or not total[1]:
        return set()
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    low = F.log(t / F.lit(total[0] + 1.0)) - F.log(c / F.lit(total[1] + 1.0)) - 2 * F.sqrt(1 / t + 1 / c)
    # forms of the bounded sample's words
    return {r[0] for r in forms.where((F.col("t") >= LEAST_CONTEXTS) & (low > math.log(EVIDENCE))).select("form").collect()}


def is_evidence(word: str, forms: set[str]) -> bool:
    return word + "$" in forms or any(word[:k] in forms for k in range(SHORTEST, min(LONGEST, len(word)) + 1))


def _token_blocks(sample: DataFrame, forms: set[str], bits: int) -> DataFrame:
    """The labelled words of some texts in a row: their codes, labels and first words, and the weights each code uses."""
    names = ["codes", "toxic", "first", "own", "as_last", "as_next"]

    def blocks(batches):
        for b in batches:
            number: dict[str, int] = {}
            codes, toxic, first = [], [], []
            for text, label in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words = [w.lower() for w in _WORD.findall(text)]
                tags = [bool(label) and is_evidence(w, forms) for w in words]
                if not words or (label and not any(tags)):
                    continue
                codes += [number.setdefault(w, len(number)) for w in words]
                toxic += tags
                first += [True] + [False] * (len(words) - 1)
            if codes:
                arrays = [np.array(codes, np.int32), np.array(toxic, bool), np.array(first, bool), *(x.astype(np.int32) for x in _indexes(list(number), bits))]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays], names=names)

    rows = sample.select("doc_id", "text", "toxic").repartition(TRAIN_PARTS)
    return rows.mapInArrow(blocks, ", ".join(f"{n} binary" for n in names))


class Model:
    """Weights of hashed features, of every word (``bias``), of the transitions, and of a document's score; without a vector all scores are 0."""

    def __init__(self, vector: np.ndarray | None, bits: int = BITS, document: np.ndarray | None = None):
        self.bits, self.vector, self.document = bits, vector, document
        if vector is not None:
            self.weights, self.bias, self.moves = vector[: 1 << bits], vector[1 << bits], vector[(1 << bits) + 1 :]


def loss_and_gradient(vector: np.ndarray, blocks: list[tuple], bits: int) -> tuple[float, np.ndarray]:
    """Negative log likelihood of the labelled words of ``blocks`` and its gradient."""
    model, gradient, loss = Model(vector, bits), np.zeros(len(vector)), 0.0
    w = model.weights
    for codes, toxic, first, own, as_last, as_next in blocks:
        scores = _scores(w[own].sum(1)[codes], w[as_last].sum(1)[codes], w[as_next].sum(1)[codes], first, model.bias)
        chain = Chain(scores, first, model.moves)
        before = np.append(False, toxic[:-1]) & ~first
        seen = np.array([(toxic & ~before).sum(), (before & ~toxic).sum(), (before & toxic).sum()])
        loss += chain.log_z().sum() - scores[toxic].sum() - seen @ model.moves
        rest = chain.marginals() - toxic
        n = len(own)
        inner = np.append(~first[1:], False)  # words with one after them
        to_next, to_last = np.append(rest[1:], 0.0) * inner, np.append(0.0, rest[:-1]) * ~first
        for index, part in ((own, rest), (as_last, to_next), (as_next, to_last)):
            each = np.bincount(codes, part, n)
            for k in range(index.shape[1]):
                gradient[: 1 << bits] += np.bincount(index[:, k], each, 1 << bits)
        gradient[1 << bits] += rest.sum()
        gradient[(1 << bits) + 1 :] += chain.moves() - seen
    return loss, gradient


def _summed(blocks: DataFrame, vector: np.ndarray, bits: int) -> tuple[float, np.ndarray]:
    """:func:`loss_and_gradient` over all staged blocks.

    One row with its part of the gradient leaves each of the few tasks
    (``TRAIN_PARTS`` files of a bounded sample), so a step shuffles nothing.
    """
    shared, size = blocks.sparkSession.sparkContext.broadcast(vector), len(vector)

    def part(batches):
        loss, gradient = 0.0, np.zeros(size)
        for b in batches:
            for row in zip(*(b.column(i) for i in range(6)), strict=True):
                raw = [np.frombuffer(x.as_buffer(), t) for x, t in zip(row, (np.int32, bool, bool, np.int32, np.int32, np.int32), strict=True)]
                one = (*raw[:3], raw[3].reshape(-1, OWN), raw[4].reshape(-1, NEAR), raw[5].reshape(-1, NEAR))
                more, g = loss_and_gradient(shared.value, [one], bits)
                loss += more
                gradient += g
        if loss:
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([gradient.astype(np.float32).tobytes()], pa.binary())], names=["loss", "gradient"])

    parts = blocks.mapInArrow(part, "loss double, gradient binary").toArrow()
    shared.destroy()
    # in one order whatever task ended first, so that the same sample gives the same model
    loss, total = 0.0, np.zeros(size)
    for i in np.argsort(parts.column(0).to_numpy(), kind="stable"):
        loss += parts.column(0)[int(i)].as_py()
        total += np.frombuffer(parts.column(1)[int(i)].as_buffer(), np.float32)
    return loss, total


def minimised(value, start: np.ndarray, steps: int = STEPS, history: int = HISTORY) -> np.ndarray:
    """L-BFGS with halved steps; ``value`` returns the loss and its gradient."""
    x, past = start, []
    loss, g = value(x)
    for _ in range(steps):
        d, back = g.copy(), []
        for s, y in reversed(past):
            a = (s @ d) / (s @ y)
            back.append(a)
            d -= a * y
        d *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(np.linalg.norm(g), 1e-12)
        for (s, y), a in zip(past, reversed(back), strict=True):
            d += (a - (y @ d) / (s @ y)) * s
        size, slope = 1.0, g @ d
        while size > 1e-4:
            x1 = x - size * d
            loss1, g1 = value(x1)
            if loss1 <= loss - 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        if (x1 - x) @ (g1 - g) > 1e-12:
            past = [*past, (x1 - x, g1 - g)][-history:]
        done = loss - loss1 < 1e-5 * abs(loss1)
        x, loss, g = x1, loss1, g1
        if done:
            break
    return x


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, steps: int = STEPS) -> Model:
    """The chain learned from ``labels(doc_id, toxic)`` of documents outside the held-out fold."""
    sample = staged(labelled_texts(docs, labels), "toxicity-sample")
    forms = evidence(sample)
    if not forms:
        return Model(None, bits)
    blocks = staged(_token_blocks(sample, forms, bits), "toxicity-tokens")
    start = np.zeros((1 << bits) + 4)
    start[1 << bits :] = -6, 0, 0, 0

    def value(x):
        loss, g = _summed(blocks, x, bits)
        pull = RIDGE * x
        pull[1 << bits] = 0
        return loss + 0.5 * (pull @ x), g + pull

    model = Model(minimised(value, start, steps), bits)
    model.document = _document_weights(sample, model)
    return model


def _document_features(squares: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(squares)), np.log(squares + 1e-3), np.log(n_words)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        slope = x.T @ (weight * (p - y)) + RIDGE * w
        w = w - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), slope)
    return w


def _document_weights(sample: DataFrame, model: Model) -> np.ndarray:
    """Regression of the labels of the bounded sample on what the chain finds in each text; length alone never raises a score."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def found(batches):
        cache = _Words(shared.value)
        for b in batches:
            some, _, size, p = _marginals(b.column(0).to_pylist(), cache)
            if some:
                squares = np.add.reduceat(p * p, np.cumsum(size) - size)
                yield pa.RecordBatch.from_arrays([b.column(1).take(pa.array(some)), b.column(2).take(pa.array(some)), pa.array(squares), pa.array(size)], names=["toxic", "weight", "squares", "n"])

    rows = sample.select("text", "toxic", "weight").mapInArrow(found, "toxic int, weight double, squares double, n long").toArrow()
    y, weight, squares, n = (rows.column(i).to_numpy() for i in range(4))
    x = _document_features(squares, n)
    w = _logistic(x, y, weight)
    return w if w[2] <= 0 else np.append(_logistic(x[:, :2], y, weight), 0.0)


# -- scoring ------------------------------------------------------------------------


class _Words:
    """Codes of the words seen and what each gives to scores; emptied when it holds too many."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.given = np.empty((3, 1 << 16))

    def codes(self, words: list[str]) -> np.ndarray:
        code = self.code
        known = len(code)
        out = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words))
        if len(code) > known:
            while len(code) > self.given.shape[1]:
                self.given = np.concatenate([self.given, np.empty_like(self.given)], axis=1)
            new = list(code)[known:] if known else list(code)
            for k, index in enumerate(_indexes(new, self.model.bits)):
                self.given[k, known : len(code)] = self.model.weights[index].sum(1)
        return out


def _marginals(texts: list[str | None], cache: _Words) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Which texts have words, where their words start and how many they are, and the marginals of all words."""
    words = [_WORD.findall(t or "") for t in texts]
    some = [i for i, w in enumerate(words) if w]
    size = np.array([len(words[i]) for i in some], np.int64)
    starts = np.cumsum(size) - size
    if not some:
        return some, starts, size, np.empty(0)
    if len(cache.code) > _CACHE:
        cache.clear()
    codes = cache.codes([w for i in some for w in words[i]])
    first = np.zeros(len(codes), bool)
    first[starts] = True
    model = cache.model
    return some, starts, size, Chain(_scores(*cache.given[:, codes], first, model.bias), first, model.moves).marginals()


def _tagged(texts: list[str | None], cache: _Words) -> list[dict]:
    """One struct of ``TYPE`` for each text."""
    out: list[dict] = [{"score": 0.0, "spans": []} for _ in texts]
    if cache.model.vector is None:
        return out
    some, starts, size, p = _marginals(texts, cache)
    if not some:
        return out
    x = _document_features(np.add.reduceat(p * p, starts), size) @ cache.model.document
    for i, score in zip(some, (1 / (1 + np.exp(-np.clip(x, -35, 35)))).tolist(), strict=True):
        out[i]["score"] = score
    for k in np.unique(np.searchsorted(starts, np.flatnonzero(p >= TOXIC_AT), side="right") - 1):
        out[some[k]]["spans"] = _spans(texts[some[k]], p[starts[k] : starts[k] + size[k]])
    return out


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Stretches of toxic words as offsets in code points, each with its greatest marginal."""
    found, open_ = [], None
    for m, one in zip(_WORD.finditer(text), p.tolist(), strict=True):
        if one < TOXIC_AT:
            open_ = None
        elif open_ is None:
            found.append(open_ := {"start": m.start(), "end": m.end(), "probability": one})
        else:
            open_["end"], open_["probability"] = m.end(), max(open_["probability"], one)
    return found


def tagged(docs: DataFrame, model: Model, text: str | Column = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a struct ``out``: the score of the text and its toxic spans."""
    if out in docs.columns:
        raise ValueError(f"the rows have a column {out} of their own; name another")
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(TYPE)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = _Words(shared.value)
        for values in batches:
            rows, texts, size = [], [], 0
            for value in values:
                value = value.as_py()
                if texts and size + len(value or "") > BLOCK_CHARS:
                    rows += _tagged(texts, cache)
                    texts, size = [], 0
                texts.append(value)
                size += len(value or "")
            yield pa.array(rows + _tagged(texts, cache), _ARROW)

    return docs.withColumn(out, found(F.col(text) if isinstance(text, str) else text))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of the held-out fold are never read."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = tagged(docs, fit(docs, read(spark, sf_dir, "labels")))
    return rows.select(
        "doc_id",
        F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= TOXIC_AT).cast("int").alias("predicted"),
        F.col("toxicity.spans").alias("spans"),
    )
