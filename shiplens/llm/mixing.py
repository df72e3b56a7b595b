"""Mixing to target weights with soft domain membership.

A multinomial logistic classifier, trained on a bounded sample
of a labelled table, gives each document posterior shares over the domains.  Document rates
are then fitted by distributed projected-gradient least squares:

    minimise || A w - T ||^2  over  w >= 0,   A[d, i] = tokens_i * posterior_i[d]

where T holds the token totals that the target weights ask for.  The residual
is measured in the metric of H = sum_i tokens_i p_i p_i' and steps are taken in
the metric of the tokens, so the step size 1 is the inverse Lipschitz constant:

    y_i  =   w_i + b (w_i - w'_i)                          w' the rates one step before
    w_i  <-  max(0, y_i - p_i . H^-1 (A y - T)),           starting at w = w' = 1

with b the usual momentum, begun anew whenever the residual grows.  Each step is one
aggregation of as many sums as there are domains; rates are a fold of the
steps over the posteriors, staged as numbers every ``STAGE_EVERY`` steps of the fit.
Among the rates that meet the targets this finds ones close to 1.

The fit runs to ``TOLERANCE`` or until the steps no longer move; then the
targets are out of reach (a domain without documents, say), and the caller is told: a
warning with what is missed, or :class:`OutOfReach` under ``strict``.

A document is emitted ``floor(rate)`` times, and once more if a keyed hash of
its doc_id falls below the fraction.

All of the main path is DataFrame expressions and Spark ML on DataFrames.

Edge cases: a null or blank text has no tokens and gets the posteriors of all-zero
features; a text of any length counts whole; a null doc_id is hashed as null; repeated
rows get equal rates; domains without labelled rows have posterior 0 and their target is
then out of reach; without any labelled rows all posteriors are equal; an empty table
gives an empty result; other columns pass through.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import HASHES, from_row, hash_value, read, staged

TARGETS = {"de": 0.2, "en": 0.5, "es": 0.1, "fr": 0.2}
# Labelled documents sampled in expectation, and of a rarer domain at least so many.
TRAIN_ROWS, PER_DOMAIN = 4000, 400
STEPS, STAGE_EVERY = 400, 25
# Of all tokens: the most that a domain may be off its target.
TOLERANCE = 1e-6
SEED = 7

# Choices: letter sequences and symbols whose frequency tells languages and kinds of
# text apart; a feature is the share of characters in them.  Hashed words in their place
# drove the pipeline's executors over their memory (see the README).
SEQUENCES = ("th", "wh", "ing", "ch", "ei", "sch", "ß", "ü", "é", "è", "ou", "eau", "ó", "ñ", "ción", "|", "!", "%")


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def with_features(docs: DataFrame) -> DataFrame:
    """``docs(text, ...)`` with ``_tokens`` (words) and ``_f0..`` (share of characters in each sequence)."""
    size = F.greatest(F.char_length(_text()), F.lit(1))
    shares = {
        f"_f{k}": 100.0 * (F.char_length(_text()) - F.char_length(F.replace(_text(), F.lit(s), F.lit("")))) / size
        for k, s in enumerate(SEQUENCES)
    }
    return docs.withColumns({"_tokens": F.regexp_count(_text(), F.lit(r"[^ \t-\r]+")).cast("double")} | shares)


def train(labelled: DataFrame, domains: list[str]) -> np.ndarray | None:
    """Logits of each domain: a row of feature weights and the bias; None without labels.

    ``labelled(text, domain)`` is expected to be a bounded sample.
    """
    position = F.array_position(F.array(*map(F.lit, domains)), F.col("domain"))
    rows = with_features(labelled).withColumn("label", (position - 1).cast("double")).where("label >= 0")
    rows = staged(rows.select("label", *[f"_f{k}" for k in range(len(SEQUENCES))]), "mixing-train")
    seen = [int(r.label) for r in rows.select("label").distinct().sort("label").collect()]  # domains at most
    weights = np.zeros((len(domains), len(SEQUENCES) + 1))
    absent = [d for d in range(len(domains)) if d not in seen]
    weights[absent, -1] = -np.inf
    if not seen:
        return None
    if len(seen) > 1:
        vectors = VectorAssembler(inputCols=[f"_f{k}" for k in range(len(SEQUENCES))], outputCol="features").transform(rows)
        model = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60).fit(vectors)
        fitted = np.hstack([model.coefficientMatrix.toArray(), model.interceptVector.toArray()[:, None]])
        weights[seen] = fitted[seen]
    return weights


def with_posteriors(docs: DataFrame, weights: np.ndarray | None, domains: list[str]) -> DataFrame:
    """``docs`` with ``_tokens`` and ``_p0..``, the posterior of each domain."""
    rows = with_features(docs)
    if weights is None:
        weights = np.zeros((len(domains), len(SEQUENCES) + 1))
    logits = {}
    for d, row in enumerate(weights.tolist()):
        if row[-1] != -np.inf:
            logits[d] = sum((F.col(f"_f{k}") * w for k, w in enumerate(row[:-1])), F.lit(row[-1]))
    rows = rows.withColumns({f"_l{d}": e for d, e in logits.items()})
    top = F.greatest(*[F.col(f"_l{d}") for d in logits]) if len(logits) > 1 else F.col(f"_l{next(iter(logits))}")
    rows = rows.withColumn("_top", top).withColumns({f"_e{d}": F.exp(F.col(f"_l{d}") - F.col("_top")) for d in logits})
    total = sum((F.col(f"_e{d}") for d in logits), F.lit(0.0))
    rows = rows.withColumn("_all", total)
    rows = rows.withColumns({f"_p{d}": F.col(f"_e{d}") / F.col("_all") if d in logits else F.lit(0.0) for d in range(len(domains))})
    extra = ["_top", "_all", *[f"_f{k}" for k in range(len(SEQUENCES))], *[f"_{x}{d}" for d in logits for x in "le"]]
    return rows.drop(*extra)


@dataclass(frozen=True)
class Step:
    momentum: float
    move: tuple[float, ...]


@dataclass
class Fit:
    """Steps taken, and by how much each domain's tokens miss their target, as a share of all tokens."""

    steps: list[Step]
    missed: np.ndarray

    @property
    def reached(self) -> bool:
        return not len(self.missed) or np.abs(self.missed).max() <= TOLERANCE


class OutOfReach(ValueError):
    """No nonnegative rates meet the targets."""


def rate_pair(steps: list[Step], n: int, start: Column | None = None) -> Column:
    """``struct<w, before>``: the rates after ``steps`` and one step before, as a fold over the posteriors ``_p0..``."""
    one = F.lit(1.0)
    pair = F.struct(one.alias("w"), one.alias("before")) if start is None else start
    if not steps:
        return pair
    # built from text in one call; the optimizer folds it to a literal
    text = ";".join(",".join(map(repr, (s.momentum, *s.move))) for s in steps)
    rows = F.transform(F.split(F.lit(text), ";"), lambda x: F.split(x, ",").cast("array<double>"))
    posteriors = F.array(*[F.col(f"_p{d}").cast("double") for d in range(n)])

    def stepped(acc: Column, step: Column) -> Column:
        ahead = acc["w"] + F.get(step, F.lit(0)) * (acc["w"] - acc["before"])
        for d in range(n):
            ahead = ahead - F.get(acc["p"], F.lit(d)) * F.get(step, F.lit(d + 1))
        return F.struct(F.greatest(F.lit(0.0), ahead).alias("w"), acc["w"].alias("before"), acc["p"].alias("p"))

    begin = F.struct(pair["w"].alias("w"), pair["before"].alias("before"), posteriors.alias("p"))
    return F.aggregate(rows, begin, stepped, lambda acc: F.struct(acc["w"].alias("w"), acc["before"].alias("before")))


def fit_rates(posteriors: DataFrame, targets: dict[str, float], budget: float | None = None, max_steps: int = STEPS, stage_every: int = STAGE_EVERY) -> Fit:
    """Projected-gradient steps for ``posteriors(_tokens, _p0..)``; ``budget`` defaults to all tokens."""
    n = len(targets)
    share = np.array([targets[d] for d in sorted(targets)], float)
    p = [F.col(f"_p{d}") for d in range(n)]
    pairs = [(a, b) for a in range(n) for b in range(a, n)]
    sums = posteriors.agg(F.sum("_tokens").alias("t"), *[F.sum(F.col("_tokens") * p[a] * p[b]).alias(f"h{a}_{b}") for a, b in pairs]).first()
    if not sums["t"]:
        return Fit([], np.zeros(0))
    wanted = share / share.sum() * (budget or sums["t"])
    metric = np.zeros((n, n))
    for a, b in pairs:
        metric[a, b] = metric[b, a] = sums[f"h{a}_{b}"]
    inverse = np.linalg.pinv(metric, rcond=1e-10)
    steps: list[Step] = []
    rows, fresh, momentum, best = posteriors.select("_tokens", *p), [], 1.0, np.inf
    start, still = None, 0
    for k in range(max_steps + 1):
        # totals of the rates, and of their last change: the totals of any point ahead follow
        pair = rate_pair(fresh, n, start)
        now = rows.withColumn("_pair", pair).agg(
            *[F.sum(F.col("_tokens") * F.col("_pair.w") * x) for x in p], *[F.sum(F.col("_tokens") * F.col("_pair.before") * x) for x in p]
        )
        totals = np.array(now.first(), float)
        at, before = totals[:n], totals[n:]
        missed = (at - wanted) / wanted.sum()
        still = still + 1 if k and np.abs(at - before).max() < 1e-3 * TOLERANCE * wanted.sum() else 0
        if np.abs(missed).max() <= TOLERANCE or k == max_steps or still == 2:
            break
        # the residual in its own metric; when it grows, the momentum starts anew
        value = (at - wanted) @ inverse @ (at - wanted)
        if value > best:
            momentum = 1.0
        best = value
        after = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        beta, momentum = (momentum - 1) / after, after
        step = Step(float(beta), tuple((inverse @ (at + beta * (at - before) - wanted)).tolist()))
        steps.append(step)
        fresh.append(step)
        if len(fresh) == stage_every:
            rows = staged(rows.withColumn("_pair", rate_pair(fresh, n, start)).select("_tokens", *p, F.col("_pair").alias("_start")), "mixing-rates")
            start, fresh = F.col("_start"), []
    return Fit(steps, missed)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, per_domain: int = PER_DOMAIN) -> DataFrame:
    """``(text, domain)`` of a bounded sample of the labelled documents, their domain being ``lang``.

    About ``rows`` in all, and of each of :data:`TARGETS`' rarer domains about ``per_domain``.
    """
    ids = labels.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    known = docs.where("lang is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("domain"))
    labelled = known.select("doc_id", "domain").join(ids, "doc_id")
    n = {r["domain"]: r["n"] for r in labelled.where(F.col("domain").isin(sorted(TARGETS))).groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = max(sum(n.values()), 1)
    share = F.lit(min(1.0, rows / total))
    for domain, size in n.items():
        share = F.when(F.col("domain") == domain, min(1.0, max(rows / total, per_domain / size))).otherwise(share)
    # about rows + domains * per_domain ids, small enough to broadcast
    sample = labelled.where(hash_value(F.col("doc_id")) < share * HASHES).select("doc_id").distinct()
    return known.join(F.broadcast(sample), "doc_id").select("text", "domain")


def rated(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, seed: int = SEED, carry: list[str] | None = None, strict: bool = False
) -> DataFrame:
    """``(row, id, _tokens, _p0.., rate, copies)`` for each row of ``docs``; domains in name order.

    ``row`` holds the columns to ``carry`` (default: all).  The posteriors are
    staged with it, so the features are computed once and the steps of the
    fit read sums of a few numeric columns.
    """
    targets = targets or TARGETS
    n = len(targets)
    weights = train(labelled, sorted(targets))
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row")
    packed = docs.select(row, F.col("doc_id").alias("id"), "text")
    found = staged(with_posteriors(packed, weights, sorted(targets)).select("row", "id", "_tokens", *[f"_p{d}" for d in range(n)]), "mixing-posteriors")
    fit = fit_rates(found, targets)
    if not fit.reached:
        told = ", ".join(f"{d} {m:+.6f}" for d, m in zip(sorted(targets), fit.missed))
        if strict:
            raise OutOfReach(f"targets missed by these shares of all tokens: {told}")
        warnings.warn(f"targets missed by these shares of all tokens: {told}", stacklevel=2)
    uniform = F.xxhash64(F.lit(seed), "id").bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    rows = found.withColumn("rate", rate_pair(fit.steps, n)["w"])
    return rows.withColumn("copies", F.floor("rate") + (uniform < F.col("rate") - F.floor("rate")).cast("long"))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, seed: int = SEED, strict: bool = False) -> DataFrame:
    """The rows of ``docs``, each as often as its rate asks for, with the columns of ``docs``."""
    rows = rated(docs, labelled, targets, seed, strict=strict)
    return from_row(rows.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))))


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, rate and copies of every document for the default targets."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labelled = labelled_sample(docs, read(spark, sf_dir, "labels"))
    found = rated(docs, labelled, carry=["doc_id"])
    shares = [F.col(f"_p{k}").alias(f"p_{d}") for k, d in enumerate(sorted(TARGETS))]
    return found.select(F.col("id").alias("doc_id"), F.col("_tokens").cast("long").alias("n_tokens"), *shares, "rate", "copies")
