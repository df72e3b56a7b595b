"""A fitted forest as a table of nodes, as native columns and as SQL (ML-5, ML-9, ML-10).

The saved pipeline is read once: every tree node becomes a row stating the raw
input it tests (a number, or a category of a text column), the factor that the
scaler applies and the threshold.  From that table

* :func:`scored_natively` builds one native CASE column per tree, so a batch or a
  stream is scored inside generated code, without model classes;
* :func:`scoring_sql` states the same in SQL over the stored table, so another
  engine can verify every probability.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.operators.schema import quoted

NODES = "tree int, node int, is_leaf boolean, left_node int, right_node int, input string, category string, factor double, threshold double, p1 double"


def feature_slots(model: PipelineModel) -> list[tuple[str, str | None, float]]:
    """For each entry of the feature vector: raw input, category (None for a number), scaling factor."""
    labels: dict[str, tuple[str, list[str]]] = {}
    slots: list[tuple[str, str | None]] = []
    factors: list[float] | None = None
    for stage in model.stages:
        kind = type(stage).__name__
        if kind == "StringIndexerModel":
            for c, out, values in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray, strict=True):
                labels[out] = (c, list(values))
        elif kind == "OneHotEncoderModel":
            for c, out in zip(stage.getInputCols(), stage.getOutputCols(), strict=True):
                labels[out] = labels[c]
        elif kind == "VectorAssembler":
            for c in stage.getInputCols():
                slots += [(labels[c][0], value) for value in labels[c][1]] if c in labels else [(c, None)]
        elif kind == "StandardScalerModel":
            factors = [1.0 / s if s else 0.0 for s in map(float, stage.std)]
    if factors is None:
        factors = [1.0] * len(slots)
    if len(factors) != len(slots):
        raise ValueError(f"{len(slots)} slots were assembled but {len(factors)} scaled")
    return [(c, value, f) for (c, value), f in zip(slots, factors, strict=True)]


def node_table(spark: SparkSession, model_path: str, model: PipelineModel) -> DataFrame:
    """The nodes of the forest saved at ``model_path`` (``NODES``); ``model`` is that pipeline, loaded."""
    at, forest = next((i, s) for i, s in enumerate(model.stages) if isinstance(s, RandomForestClassificationModel))
    if forest.numClasses != 2:
        raise ValueError("a forest of two classes is expected")
    folder = f"{at:0{len(str(len(model.stages)))}d}_{forest.uid}"
    stored = spark.read.parquet(f"{model_path.rstrip('/')}/stages/{folder}/data").select("treeID", "nodeData.*")
    slots = spark.createDataFrame([(i, *s) for i, s in enumerate(feature_slots(model))], "slot int, input string, category string, factor double")
    leaf = F.col("leftChild") < 0
    stats = F.col("impurityStats")
    nodes = stored.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        leaf.alias("is_leaf"),
        F.col("leftChild").alias("left_node"),
        F.col("rightChild").alias("right_node"),
        F.when(~leaf, F.col("split.featureIndex")).alias("slot"),
        F.when(~leaf, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(~leaf & (F.col("split.numCategories") >= 0), F.raise_error("a split on categories is not a threshold")).alias("bad"),
        (stats[1] / (stats[0] + stats[1])).alias("p1"),
    )
    # trees times nodes rows, at most slots rows: both bounded by the model
    return nodes.where("bad is null").join(F.broadcast(slots), "slot", "left").select(
        "tree", "node", "is_leaf", "left_node", "right_node", "input", "category", "factor", "threshold", "p1"
    )


# Forests of at most this many nodes become one CASE expression inside generated
# code; a larger one would outgrow a generated method. As one expression it walks arrays of
# nodes instead, far slower than the model's own transform; as columns per tree
# (:func:`votes`) it is faster.
CASE_NODES = 400


def probability(df: DataFrame, nodes: DataFrame, case_nodes: int = CASE_NODES) -> Column:
    """The forest's probability of class 1 as a native column over the raw inputs of ``df``.

    The node table (trees times at most 2 to the depth plus 1 rows) is read to
    the driver; missing inputs must be filled as for the model.
    """
    forest = _trees(nodes)
    if sum(map(len, forest)) <= case_nodes:
        return reduce(lambda a, b: a + b, [_case(t, 0) for t in forest]) / F.lit(float(len(forest)))
    return _walk(forest)


def _trees(nodes: DataFrame) -> list[dict]:
    trees: dict[int, dict[int, tuple]] = {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r
    return [trees[t] for t in sorted(trees)]


def _slot_value(input_: str, category: str | None, factor: float) -> Column:
    c = F.col(quoted(input_))
    if category is None:
        return c.cast("double") * F.lit(factor)
    return F.when(c == F.lit(category), F.lit(factor)).otherwise(F.lit(0.0))


def _case(tree: dict, node: int) -> Column:
    r = tree[node]
    if r["is_leaf"]:
        return F.lit(r["p1"])
    low = _slot_value(r["input"], r["category"], r["factor"]) <= F.lit(r["threshold"])
    return F.when(low, _case(tree, r["left_node"])).otherwise(_case(tree, r["right_node"]))


def _walk(forest: list[dict]) -> Column:
    """Votes by stepping through the trees, stored as complete binary trees in arrays.

    Node i has the children 2i + 1 and 2i + 2; a leaf above the last level is
    continued to the left down to it.
    """
    depth = max(_depth(t, 0) for t in forest)
    inner, last = 2**depth - 1, 2**depth
    slots: dict[tuple, int] = {}
    slot, threshold, leaf = [], [], []
    for tree in forest:
        at: list = [tree[0]]
        for i in range(inner):
            r = at[i]
            if r["is_leaf"]:
                slot.append(0)
                threshold.append(float("inf"))
                at += [r, r]
            else:
                slot.append(slots.setdefault((r["input"], r["category"], r["factor"]), len(slots)))
                threshold.append(r["threshold"])
                at += [tree[r["left_node"]], tree[r["right_node"]]]
        leaf += [r["p1"] for r in at[inner:]]
    values = F.array(*[_slot_value(*s) for s in slots]) if slots else F.array(F.lit(0.0))
    # built from text in one call; the optimizer folds them to literals
    fixed = lambda xs, kind: F.split(F.lit(",".join(map(_number_text, xs))), ",").cast(f"array<{kind}>")
    slots_at, thresholds, leaves = fixed(slot, "int"), fixed(threshold, "double"), fixed(leaf, "double")

    def leaf_of(x: Column, tree: Column) -> Column:
        def step(i: Column, _: Column) -> Column:
            at = tree * inner + i
            return 2 * i + 1 + F.when(F.get(x, F.get(slots_at, at)) > F.get(thresholds, at), 1).otherwise(0)

        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) - inner if depth else F.lit(0)

    def vote(acc: Column, tree: Column) -> Column:
        return F.struct(acc["x"].alias("x"), (acc["sum"] + F.get(leaves, tree * last + leaf_of(acc["x"], tree))).alias("sum"))

    start = F.struct(values.alias("x"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(forest) - 1)), start, vote, lambda acc: acc["sum"] / len(forest))


def _depth(tree: dict, node: int) -> int:
    r = tree[node]
    return 0 if r["is_leaf"] else 1 + max(_depth(tree, r["left_node"]), _depth(tree, r["right_node"]))


def _number_text(x: float) -> str:
    return "Infinity" if x == float("inf") else repr(x)


@dataclass(frozen=True)
class Votes:
    """SQL text of a forest as columns, by name: its distinct tests, then one nested CASE per tree over them."""

    tests: dict[str, str]
    trees: dict[str, str]

    @property
    def probability(self) -> Column:
        return F.expr(f"({' + '.join(self.trees)}) / {float(len(self.trees))!r}D")


def votes(nodes: DataFrame) -> Votes:
    """The whole forest of a node table as text; the nodes are read to the driver.

    Trees share their tests (at most one per input and split point), so each is
    evaluated once per row.
    """
    tests: dict[tuple, str] = {}

    def vote(tree: dict, node: int) -> str:
        r = tree[node]
        if r["is_leaf"]:
            return f"{r['p1']!r}D"
        test = tests.setdefault((r["input"], r["category"], r["factor"], r["threshold"]), f"__test_{len(tests)}")
        return f"CASE WHEN {test} THEN {vote(tree, r['left_node'])} ELSE {vote(tree, r['right_node'])} END"

    trees = {f"__vote_{i}": vote(tree, 0) for i, tree in enumerate(_trees(nodes))}
    return Votes({name: _test_text(*key) for key, name in tests.items()}, trees)


def _test_text(input_: str, category: str | None, factor: float, threshold: float) -> str:
    c = quoted(input_)
    if category is None:
        return f"coalesce(CAST({c} AS DOUBLE) * {factor!r}D <= {threshold!r}D, false)"
    # as bytes: no quotes or backslashes to escape
    same = f"coalesce({c} = CAST(X'{category.encode().hex()}' AS STRING), false)"
    return f"CASE WHEN {same} THEN {str(factor <= threshold).lower()} ELSE {str(0.0 <= threshold).lower()} END"


def scored_by(df: DataFrame, forest: Votes) -> DataFrame:
    """``df`` with ``prob_class_1`` and ``prediction`` by all trees of ``forest``.

    Tests, trees and sum are three projections, which Spark keeps apart because
    each column is used more than once; a projection of more than
    ``spark.sql.codegen.maxFields`` columns is generated in short methods.
    """
    voted = df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in forest.tests.items()])
    voted = voted.selectExpr("*", *[f"{sql} AS {name}" for name, sql in forest.trees.items()])
    p = forest.probability
    both = {"prob_class_1": p, "prediction": F.when(p > 0.5, 1.0).otherwise(0.0)}
    return voted.withColumns(both).drop(*forest.tests, *forest.trees)


def scored_natively(df: DataFrame, nodes: DataFrame) -> DataFrame:
    """``df`` with ``prob_class_1`` and ``prediction`` from the node table alone, by every tree in it."""
    return scored_by(df, votes(nodes))


def scoring_sql(rows: str, nodes: str, texts: Sequence[str], numbers: Sequence[str], depth: int) -> str:
    """CTEs ending in ``forest_scored``: the rows of query ``rows`` with ``prob_class_1``, by walking the stored ``nodes``.

    ``nodes`` is a table or a table function call; ``texts`` and ``numbers`` name the raw inputs.
    The order of adding votes shows below 12 digits: round once, to fewer, before comparing.
    """
    cases = [f"WHEN '{c}' THEN CASE WHEN f.{c} = n.category THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for c in texts]
    cases += [f"WHEN '{c}' THEN CAST(f.{c} AS DOUBLE)" for c in numbers]
    value = f"n.factor * CASE n.input {' '.join(cases)} END"
    ctes = [
        f"forest_rows AS (SELECT row_number() OVER () AS rid, * FROM ({rows}))",
        f"forest_nodes AS (SELECT * FROM {nodes})",
        "walk0 AS (SELECT rid, tree, 0 AS node FROM forest_rows, (SELECT DISTINCT tree FROM forest_nodes))",
    ]
    for k in range(depth):
        ctes.append(
            f"walk{k + 1} AS (SELECT w.rid, w.tree, CASE WHEN n.is_leaf THEN w.node WHEN {value} <= n.threshold THEN n.left_node "
            f"ELSE n.right_node END AS node FROM walk{k} w JOIN forest_nodes n ON n.tree = w.tree AND n.node = w.node JOIN forest_rows f ON f.rid = w.rid)"
        )
    ctes.append(
        f"forest_votes AS (SELECT rid, sum(p1) / count(*) AS prob_class_1 FROM walk{depth} w "
        "JOIN forest_nodes n ON n.tree = w.tree AND n.node = w.node GROUP BY rid)"
    )
    ctes.append(
        "forest_scored AS (SELECT f.*, v.prob_class_1, CASE WHEN round(v.prob_class_1, 12) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction "
        "FROM forest_rows f JOIN forest_votes v ON v.rid = f.rid)"
    )
    return ",\n".join(ctes)
