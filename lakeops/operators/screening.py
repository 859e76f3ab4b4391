"""Factor screening by chi-square and decision-tree rules, all on Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from lakeops.session import local_table

# Chi-square critical values at one degree of freedom for p = 0.01, 0.05, 0.1.
CRITICAL = ((6.6348966, 3), (3.8414588, 2), (2.7055435, 1))
MIN_TARGET = 20


def contingency(
    df: DataFrame, factors: Sequence[str], target: str, klass: str, classes: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Four cells per (factor, class).

    A class is tested against every row whose target is 0. One pass sums each factor's two
    values per side (the base, or a class), so expressions grow with the factors and the
    classes, not with their product; the few sums are turned around afterwards.
    """
    w = F.col(weight) if weight else F.lit(1)
    side = F.when(F.col(target) == 0, -1)
    for j, name in enumerate(classes):
        side = side.when((F.col(target) == 1) & (F.col(klass) == name), j)
    sums = (
        df.withColumn("__side", side)
        .filter(F.col("__side").isNotNull())
        .groupBy("__side")
        .agg(*[F.sum(F.when(F.col(f) == v, w).otherwise(0)).alias(f"__{v}_{i}") for i, f in enumerate(factors) for v in (0, 1)])
    )
    by_factor = F.array(*[F.struct(F.lit(i).alias("__i"), *[F.col(f"__{v}_{i}").alias(f"__{v}") for v in (0, 1)]) for i in range(len(factors))])

    def of(k: int, v: int) -> Column:
        return F.sum(F.when(F.col("__side") == k, F.col(f"__{v}")).otherwise(0)).alias(f"__{v}_{k}")

    cells = sums.select("__side", F.inline(by_factor)).groupBy("__i").agg(*[of(k, v) for k in range(-1, len(classes)) for v in (0, 1)])

    def cell(k: int, v: int) -> Column:
        return F.coalesce(F.col(f"`__{v}_{k}`"), F.lit(0)).cast("long")

    listed = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"),
                *[cell(-1, v).alias(f"base_{v}") for v in (0, 1)],
                *[cell(j, v).alias(f"target_{v}") for v in (0, 1)],
            )
            for j, name in enumerate(classes)
        ]
    )
    named = local_table(df.sparkSession, list(enumerate(factors)), "__i int, factor string")
    return named.join(cells, "__i", "left").select("factor", F.inline(listed))


def chi2_screen(
    df: DataFrame,
    factors: Sequence[str],
    target: str,
    klass: str,
    classes: Sequence[str],
    weight: str | None = None,
    min_target: int = MIN_TARGET,
) -> DataFrame:
    """OP-147: Pearson chi-square per (factor, class) with a signed verdict.

    Pairs with a target cell below ``min_target`` or an empty base cell are left out. The
    sign compares target/base ratios of the factor's two values.
    """
    cells = contingency(df, factors, target, klass, classes, weight).filter(
        (F.col("target_0") >= min_target)
        & (F.col("target_1") >= min_target)
        & (F.col("base_0") > 0)
        & (F.col("base_1") > 0)
    )
    a, b, c, d = (F.col(x).cast("double") for x in ("base_0", "target_0", "base_1", "target_1"))
    n = a + b + c + d
    statistic = n * (a * d - b * c) * (a * d - b * c) / ((a + b) * (c + d) * (a + c) * (b + d))
    level = F.lit(0)
    for bound, strength in reversed(CRITICAL):
        level = F.when(F.col("chi2") >= bound, strength).otherwise(level)
    up = b / a <= d / c
    return (
        cells.withColumn("chi2", statistic)
        .withColumn("score", F.when(up, level).otherwise(-level))
        .withColumn(
            "verdict",
            F.when(F.col("score") == 0, "==")
            .when(F.col("score") > 0, F.expr("repeat('+', score)"))
            .otherwise(F.expr("repeat('-', -score)")),
        )
    )


def factor_scores(screen: DataFrame) -> DataFrame:
    """OP-148: signed verdicts summed per factor."""
    return screen.groupBy("factor").agg(F.sum("score").alias("score"))


def fit_tree(
    df: DataFrame, factors: Sequence[str], target: str, min_leaf: int, depth: int = 5
) -> tuple[DecisionTreeClassificationModel, DataFrame]:
    """OP-149/150: a tree on 0/1 factors, and every row with its prediction and leaf."""
    ready = VectorAssembler(inputCols=list(factors), outputCol="__features").transform(
        df.withColumn("__label", F.col(target).cast("double"))
    )
    model = DecisionTreeClassifier(
        featuresCol="__features", labelCol="__label", minInstancesPerNode=min_leaf, maxDepth=depth, leafCol="leaf", seed=1
    ).fit(ready)
    scored = model.transform(ready).drop("__features", "__label", "rawPrediction", "probability")
    return model, scored.withColumn("leaf", F.col("leaf").cast("int"))


def leaf_stats(scored: DataFrame, target: str) -> DataFrame:
    """OP-150: population, hits and precision per leaf."""
    hit = F.col("prediction") == F.col(target)
    return scored.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("prediction").cast("int").alias("predicted"),
        F.sum(F.when(hit, 1).otherwise(0)).alias("correct"),
        F.sum(F.when(hit, 0).otherwise(1)).alias("wrong"),
        F.sum(F.col(target)).alias("positives"),
        F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("precision"),
        F.avg(F.col(target).cast("double")).alias("rate"),
    )


def leaf_rules(model: DecisionTreeClassificationModel, df: DataFrame, factors: Sequence[str]) -> DataFrame:
    """OP-151: the (factor, must hold) conditions leading to each leaf.

    The model is walked on the driver: its size is bounded by the tree depth. Leaves are
    numbered the way ``leafCol`` numbers them, left to right.
    """
    rows, leaf = [], 0
    stack = [(model._call_java("rootNode"), ())]
    while stack:
        node, path = stack.pop()
        if node.subtreeDepth() == 0:
            rows += [(leaf, step, factors[f], holds) for step, (f, holds) in enumerate(path)]
            leaf += 1
            continue
        feature = node.split().featureIndex()
        stack.append((node.rightChild(), (*path, (feature, True))))
        stack.append((node.leftChild(), (*path, (feature, False))))
    return local_table(df.sparkSession, rows, "leaf int, step int, factor string, holds boolean")


def top_leaves(stats: DataFrame, at_least: int, n: int = 15) -> DataFrame:
    """OP-151: the leaves with the highest rate among the populated ones."""
    return stats.filter(F.col("rows") >= at_least).orderBy(F.col("rate").desc(), F.col("leaf")).limit(n)


def importance(model: DecisionTreeClassificationModel, df: DataFrame, factors: Sequence[str]) -> DataFrame:
    """OP-152: positive feature importances, largest first."""
    rows = [(f, float(v)) for f, v in zip(factors, model.featureImportances.toArray()) if v > 0]
    return local_table(df.sparkSession, rows, "factor string, importance double").orderBy(F.col("importance").desc())


def signed_importance(ranked: DataFrame, scores: DataFrame, complements: DataFrame | None = None) -> DataFrame:
    """OP-152: factors that lower the target are shown as their complement.

    ``complements`` maps a factor to the name of its opposite (factor, opposite).
    """
    joined = ranked.join(scores, "factor", "left")
    lowers = F.coalesce(F.col("score"), F.lit(0)) < 0
    if complements is None:
        name = F.when(lowers, F.concat(F.lit("not "), F.col("factor"))).otherwise(F.col("factor"))
        return joined.select(name.alias("factor"), "importance")
    named = joined.join(complements, "factor", "left")
    name = F.when(lowers, F.coalesce("opposite", F.concat(F.lit("not "), F.col("factor")))).otherwise(F.col("factor"))
    return named.select(name.alias("factor"), "importance")


