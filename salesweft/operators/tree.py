"""Regression trees over the driver features, grown level by level from grouped statistics.

A split sends the rows whose column holds one value to one side and all others
to the other, as a 0/1 column of a one-hot encoding would.  One aggregation per
level counts and sums the target by tree, node, column and value; both sides of
every possible split follow from these sums, so rows are never moved or
gathered, and a level costs the same for one tree as for many.  Several trees,
such as those of a cross-validation, therefore grow in the same passes.

The best split has the largest reduction of the squared error; equal ones are
taken by column order, then value.  The choice depends on sums of whole numbers
only, so it is the same whatever the partitioning.  What reaches the driver is
one row per node: at most ``2 ** max_depth`` for each tree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from salesweft.operators import drivers, selection
from salesweft.session import written

MIN_LEAF = 5
FOLDS = 5


@dataclass(frozen=True)
class Node:
    """A node; ``column`` is None at a leaf.  ``gain`` is the reduction of the sum of squared errors."""

    prediction: float
    rows: int
    gain: float
    column: str | None = None
    value: str | None = None
    absent: "Node | None" = None
    present: "Node | None" = None

    def depth(self) -> int:
        if self.column is None:
            return 0
        return 1 + max(self.absent.depth(), self.present.depth())

    def score(self) -> Column:
        if self.column is None:
            return F.lit(self.prediction)
        is_value = F.coalesce(F.col(self.column) == self.value, F.lit(False))
        return F.when(is_value, self.present.score()).otherwise(self.absent.score())

    def leaves(self) -> list["Node"]:
        if self.column is None:
            return [self]
        return self.absent.leaves() + self.present.leaves()

    def leaf_number(self, first: int = 0) -> Column:
        """Position of a row's leaf in :meth:`leaves`."""
        if self.column is None:
            return F.lit(first)
        is_value = F.coalesce(F.col(self.column) == self.value, F.lit(False))
        return F.when(is_value, self.present.leaf_number(first + len(self.absent.leaves()))).otherwise(
            self.absent.leaf_number(first)
        )

    def splits(self) -> list[tuple[str, float]]:
        if self.column is None:
            return []
        here = [(f"{self.column}_{self.value}", self.gain)]
        return here + self.absent.splits() + self.present.splits()

    def listed(self, number: int = 1) -> list[tuple[int, "Node"]]:
        """All nodes with their numbers; node n has the children 2n (absent) and 2n + 1 (present)."""
        if self.column is None:
            return [(number, self)]
        return [(number, self), *self.absent.listed(2 * number), *self.present.listed(2 * number + 1)]


def _of(columns: list[str], name: Column) -> Column:
    """The row's value of the column with that name."""
    out = F.lit(None).cast("string")
    for c in columns:
        out = F.when(name == c, F.col(c)).otherwise(out)
    return out


def _best_splits(state: DataFrame, columns: list[str], min_samples_split: int, min_leaf: int) -> DataFrame:
    """Per tree and node its rows and sum, and its best split with the rows, sum and gain of the present side.

    The gain of a split is the difference of both sides' means, squared, times
    ``n (N - n) / N``; written with sums it is exactly 0 where the means agree.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)]))
    stats = state.select("tree", "node", "y", pairs.alias("p")).groupBy("tree", "node", F.col("p.place").alias("place"), F.col("p.value").alias("value")).agg(
        F.count("*").alias("n"), F.sum("y").alias("s")
    )
    whole = Window.partitionBy("tree", "node", "place")
    sided = stats.withColumn("all_n", F.sum("n").over(whole)).withColumn("all_s", F.sum("s").over(whole))
    n, total = F.col("n").cast("double"), F.col("all_n").cast("double")
    apart = F.col("s") * total - F.col("all_s") * n
    gain = apart * apart / (total * n * (total - n))
    fits = F.col("value").isNotNull() & (F.col("n") >= min_leaf) & (F.col("all_n") - F.col("n") >= min_leaf) & (F.col("all_n") >= min_samples_split) & (gain > 0)
    split = F.when(fits, F.struct((-gain).alias("loss"), "place", "value", "n", "s"))
    return sided.groupBy("tree", "node").agg(F.max("all_n").alias("rows"), F.max(F.when(F.col("place") == 0, F.col("all_s"))).alias("total"), F.min(split).alias("best"))


def grow(
    features: DataFrame,
    trees: Column,
    max_depth: int = 5,
    min_samples_split: int = 20,
    min_leaf: int = MIN_LEAF,
    columns: list[str] = drivers.FEATURE_COLUMNS,
) -> dict[int, Node]:
    """Trees by number; ``trees`` is an array column with the numbers of those that a row belongs to.

    ``features`` should be a written table: every level reads it once.
    """
    spark = features.sparkSession
    y = F.col(drivers.TARGET).cast("double").alias("y")
    state = features.where(F.col(drivers.TARGET).isNotNull()).select(*columns, y, F.explode(trees).alias("tree"), F.lit(1).cast("long").alias("node"))
    sums: dict[tuple[int, int], tuple[int, float]] = {}
    splits: dict[tuple[int, int], tuple] = {}
    for depth in range(max_depth):
        found = _best_splits(state, columns, min_samples_split, min_leaf).collect()
        level = []
        for r in found:
            tree, node, best = r["tree"], r["node"], r["best"]
            if depth == 0:
                sums[tree, node] = (r["rows"], r["total"])
            if best is None:
                continue
            rows, total = sums[tree, node]
            sums[tree, 2 * node] = (rows - best["n"], total - best["s"])
            sums[tree, 2 * node + 1] = (best["n"], best["s"])
            splits[tree, node] = (columns[best["place"]], best["value"], -best["loss"])
            level.append((tree, node, columns[best["place"]], best["value"]))
        if not level:
            break
        taken = spark.createDataFrame(level, "tree int, node long, s_column string, s_value string")
        present = F.coalesce((_of(columns, F.col("s_column")).cast("string") == F.col("s_value")).cast("long"), F.lit(0))
        state = state.join(F.broadcast(taken), ["tree", "node"]).select(*columns, "y", "tree", (F.col("node") * 2 + present).alias("node"))

    def build(tree: int, node: int) -> Node:
        rows, total = sums[tree, node]
        if (tree, node) not in splits:
            return Node(total / rows, rows, 0.0)
        column, value, gain = splits[tree, node]
        return Node(total / rows, rows, gain, column, value, build(tree, 2 * node), build(tree, 2 * node + 1))

    return {tree: build(tree, 1) for tree, node in sums if node == 1}


def train_tree(features: DataFrame, **options) -> Node:
    """One tree over all rows; an empty table gives a leaf of 0."""
    return grow(features, F.array(F.lit(0)), **options).get(0, Node(0.0, 0, 0.0))


def predict(features: DataFrame, tree: Node) -> DataFrame:
    """Add ``prediction``."""
    return features.withColumn("prediction", tree.score())


def error_metrics(scored: DataFrame, label: str = drivers.TARGET, prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE and R² in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction)
    error = y - p
    ss_res, ss_tot = F.sum(error * error), F.var_pop(y) * F.count(y)
    return scored.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
        F.when(ss_tot > 0, 1 - ss_res / ss_tot).otherwise(F.lit(0.0)).alias("r2"),
    )


def tree_metrics(features: DataFrame, tree: Node) -> DataFrame:
    """In-sample metrics and the depth of the tree."""
    return error_metrics(predict(features, tree)).withColumn("depth", F.lit(tree.depth()))


def checks(features: DataFrame, tree: Node, min_leaf: int = MIN_LEAF, tolerance: float = 1e-6) -> DataFrame:
    """``(check, value)``: rows and violations of what a tree promises."""
    target = F.col(drivers.TARGET).cast("double")
    leaves = predict(features, tree).groupBy(tree.leaf_number().alias("leaf")).agg(
        F.count("*").alias("n"), F.avg(target).alias("mean"), F.max("prediction").alias("p"), F.min("prediction").alias("q")
    )
    numbered = features.sparkSession.createDataFrame([(i, float(leaf.rows)) for i, leaf in enumerate(tree.leaves())], "leaf int, told double")
    joined = numbered.join(leaves, "leaf", "left")
    close = lambda a, b: F.abs(a - b) <= tolerance * F.greatest(F.lit(1.0), F.abs(b))
    found = joined.agg(
        F.sum("n").alias("rows"),
        F.count_if(F.coalesce("n", F.lit(0)) < min_leaf).alias("small_leaves"),
        F.count_if(~close(F.col("told"), F.coalesce("n", F.lit(0)))).alias("wrong_leaf_sizes"),
        F.count_if(~close(F.col("p"), F.col("mean")) | (F.col("p") != F.col("q"))).alias("wrong_leaf_means"),
    )
    return found.unpivot([], found.columns, "check", "value")


def importance(spark: SparkSession, tree: Node) -> DataFrame:
    """``(feature, importance)`` over the splits, shares of 1."""
    sums: dict[str, float] = {}
    for feature, gain in tree.splits():
        sums[feature] = sums.get(feature, 0.0) + gain
    total = sum(sums.values()) or 1.0
    rows = [(f, g / total) for f, g in sorted(sums.items())]
    return spark.createDataFrame(rows, "feature string, importance double")


def with_folds(features: DataFrame, folds: int = 5, columns: list[str] = drivers.FEATURE_COLUMNS) -> DataFrame:
    """Contiguous, unshuffled folds of equal size in key order.

    The first folds take one row more when the count does not divide.
    """
    ranked = selection.placed(features, [F.asc(c) for c in columns], "_rank").withColumnRenamed("_rank_of", "_total")
    share, more = F.floor(F.col("_total") / folds), F.col("_total") % folds
    long = more * (share + 1)
    fold = F.when(F.col("_rank") < long, F.floor(F.col("_rank") / (share + 1))).otherwise(
        more + F.floor((F.col("_rank") - long) / F.greatest(share, F.lit(1)))
    )
    return ranked.select(*features.columns, fold.cast("int").alias("fold"))


def cross_validation(features: DataFrame, folds: int = FOLDS, columns: list[str] = drivers.FEATURE_COLUMNS, **options) -> tuple[dict[int, Node], DataFrame]:
    """``(trees, errors)``: tree 0 is over all rows, tree ``f + 1`` over all but fold ``f``.

    All trees grow in the same passes.  The errors are one row per fold: its
    rows and their mean squared error under the tree that has not seen them.
    """
    folded = written(with_folds(features, folds, columns), "folds")
    seen = F.concat(F.array(F.lit(0)), F.filter(F.array(*[F.lit(f + 1) for f in range(folds)]), lambda t: t != F.col("fold") + 1))
    trees = grow(folded, seen, columns=columns, **options)
    score = F.lit(None).cast("double")
    for f in range(folds):
        if f + 1 in trees:
            score = F.when(F.col("fold") == f, trees[f + 1].score()).otherwise(score)
    error = F.col(drivers.TARGET).cast("double") - score
    return trees, folded.groupBy("fold").agg(F.count("*").alias("rows"), F.avg(error * error).alias("mse"))


def cross_validated_mse(features: DataFrame, folds: int = FOLDS, **tree_options) -> float:
    """Mean of the held-out mean squared errors."""
    _, errors = cross_validation(features, folds, **tree_options)
    return errors.agg(F.avg("mse")).first()[0]


def split_table(spark: SparkSession, trees: dict[int, Node]) -> DataFrame:
    """``(tree, node, feature, rows, mean, gain)`` of every split."""
    rows = [
        (tree, number, f"{node.column}_{node.value}", node.rows, node.prediction, node.gain)
        for tree, root in sorted(trees.items()) for number, node in root.listed() if node.column is not None
    ]
    return spark.createDataFrame(rows, "tree int, node long, feature string, rows long, mean double, gain double")


def prediction_sample(features: DataFrame, tree: Node, n: int = 10, seed: int = 42) -> DataFrame:
    """Some rows with active columns, actual and predicted volume.

    The draw is a digest of seed and key columns, whatever the partitioning.
    """
    draw = F.md5(F.concat_ws("|", F.lit(seed), *drivers.FEATURE_COLUMNS))
    picked = selection.top(features.withColumn("_draw", draw), n, F.asc("_draw"), *map(F.asc, drivers.FEATURE_COLUMNS)).drop("_draw")
    actual, predicted = F.col(drivers.TARGET), F.col("prediction")
    return predict(picked, tree).select(
        drivers.active_features().alias("features"),
        actual.cast("long").alias("actual_sales"), predicted.cast("long").alias("predicted_sales"),
        F.abs(actual - predicted).cast("long").alias("error"),
    )
