"""A shallow tree as tables of rules and nodes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binning import bin_index, widen
from ..functions.columns import col, number
from ..spec import TableSpec
from .encoding import encode_categories
from .models import FittedModel, fit_model, label_index

LEAF = "_leaf"


@dataclass
class Node:
    """A node of a fitted tree; ids follow 1, 2i, 2i + 1."""

    id: int
    feature: str | None = None
    threshold: float | None = None
    left: Node | None = None
    right: Node | None = None
    leaf: int | None = None

    def walk(self):
        yield self
        for child in (self.left, self.right):
            if child is not None:
                yield from child.walk()

    def leaves(self) -> list[int]:
        return [n.leaf for n in self.walk() if n.leaf is not None]


def read_tree(model: FittedModel) -> Node:
    """The fitted model's nodes; leaves are numbered from the left."""
    count = iter(range(1 << 30))

    def read(found, id: int) -> Node:
        if found.subtreeDepth() == 0:
            return Node(id, leaf=next(count))
        split = found.split()
        node = Node(id, model.xs[split.featureIndex()], split.threshold())
        node.left = read(found.leftChild(), 2 * id)
        node.right = read(found.rightChild(), 2 * id + 1)
        return node

    return read(model.model._java_obj.rootNode(), 1)


def leaf_rules(root: Node) -> dict[int, str]:
    """Readable condition of each leaf, one bound per side and feature."""
    out: dict[int, str] = {}

    def visit(node: Node, low: dict[str, float], high: dict[str, float]) -> None:
        if node.leaf is not None:
            terms = [
                f"{f} {sign} {bound[f]:g}"
                for f in dict.fromkeys([*low, *high])
                for sign, bound in ((">", low), ("<=", high))
                if f in bound
            ]
            out[node.leaf] = " and ".join(terms) or "all rows"
            return
        f, t = node.feature, node.threshold
        visit(node.left, low, {**high, f: min(t, high.get(f, t))})
        visit(node.right, {**low, f: max(t, low.get(f, t))}, high)

    visit(root, {}, {})
    return out


def leaf_of(root: Node) -> Column:
    """Leaf number of a row as one expression."""
    if root.leaf is not None:
        return F.lit(root.leaf)
    return F.when(number(root.feature) <= F.lit(root.threshold), leaf_of(root.left)).otherwise(
        leaf_of(root.right)
    )


@dataclass
class ExplainedTree:
    model: FittedModel
    root: Node
    frame: DataFrame
    spec: TableSpec

    def with_leaf(self, df: DataFrame) -> DataFrame:
        return df.withColumn(LEAF, leaf_of(self.root))

    def rules(self) -> DataFrame:
        """(leaf, rule, n, share, mean) or, for classes, (…, class_counts)."""
        target = self.spec.target
        rows = self.with_leaf(self.frame.select(*[col(c) for c in (*self.model.xs, target)]))
        texts = self.frame.sparkSession.createDataFrame(
            sorted(leaf_rules(self.root).items()), f"{LEAF} int, rule string"
        )
        if self.model.classes is None:
            stats = rows.groupBy(LEAF).agg(
                F.count(F.lit(1)).alias("n"), F.avg(number(target)).alias("value")
            )
        else:
            stats = (
                rows.groupBy(LEAF, col(target).cast("string").alias("_class"))
                .agg(F.count(F.lit(1)).alias("_n"))
                .groupBy(LEAF)
                .agg(
                    F.sum("_n").alias("n"),
                    F.map_from_entries(
                        F.sort_array(F.collect_list(F.struct("_class", "_n")))
                    ).alias("value"),
                )
            )
        total = self.frame.agg(F.count(F.lit(1)).alias("_total"))
        n_all = total.first()["_total"]
        label = "mean" if self.model.classes is None else "class_counts"
        return (
            stats.join(F.broadcast(texts), LEAF)
            .select(
                F.col(LEAF).alias("leaf"),
                "rule",
                "n",
                (F.col("n") / F.lit(float(n_all))).alias("share"),
                F.col("value").alias(label),
            )
            .orderBy("leaf")
        )

    def nodes(self, bins: int = 30) -> DataFrame:
        """(node, feature, threshold, left, right, n, histogram) with the target's
        distribution at each node, over shared bins or over classes.

        Rows are counted once per leaf; a node adds up its leaves.
        """
        target = self.spec.target
        rows = self.frame.select(*[col(c) for c in (*self.model.xs, target)])
        if self.model.classes is None:
            ends = rows.agg(F.min(number(target)).alias("a"), F.max(number(target)).alias("b")).first()
            lo, hi = widen(F.lit(ends["a"]), F.lit(ends["b"]))
            group = bin_index(number(target), lo, hi, bins)
        else:
            group = label_index(target, self.model.classes).cast("int")
        counts = (
            self.with_leaf(rows)
            .groupBy(LEAF, group.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        members = [(n.id, leaf) for n in self.root.walk() for leaf in n.leaves()]
        shape = [
            (n.id, n.feature, n.threshold, n.left.id if n.left else None, n.right.id if n.right else None)
            for n in self.root.walk()
        ]
        spark = self.frame.sparkSession
        inside = spark.createDataFrame(members, f"node int, {LEAF} int")
        layout = spark.createDataFrame(shape, "node int, feature string, threshold double, left int, right int")
        filled = (
            counts.join(F.broadcast(inside), LEAF)
            .groupBy("node", "bin")
            .agg(F.sum("n").alias("n"))
            .groupBy("node")
            .agg(
                F.sum("n").alias("n"),
                F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("histogram"),
            )
        )
        return filled.join(F.broadcast(layout), "node").select(*layout.columns, "n", "histogram").orderBy("node")

    def importance(self) -> DataFrame:
        """(feature, importance, rank) by the tree's own importance."""
        ranked = sorted(self.model.importances.items(), key=lambda item: (-item[1], item[0]))
        return self.frame.sparkSession.createDataFrame(
            [(f, v, i) for i, (f, v) in enumerate(ranked, 1)], "feature string, importance double, rank int"
        )


def explain_tree(
    df: DataFrame, spec: TableSpec, features: Sequence[str] | None = None, max_depth: int = 4, seed: int = 0
) -> ExplainedTree:
    """Fit a shallow tree on the features (text categories as ordinal codes)."""
    coded = encode_categories(df, spec)
    features = list(features) if features is not None else spec.numerics(df) + spec.categories(df)
    family = "tree_reg" if spec.numerical_target else "tree_clf"
    model = fit_model(coded, features, spec.target, family, {"max_depth": max_depth}, seed)
    return ExplainedTree(model, read_tree(model), coded, spec)


def tree_rules(df: DataFrame, spec: TableSpec, features=None, max_depth: int = 4, seed: int = 0) -> DataFrame:
    return explain_tree(df, spec, features, max_depth, seed).rules()


def tree_nodes(df: DataFrame, spec: TableSpec, features=None, max_depth: int = 4, seed: int = 0) -> DataFrame:
    return explain_tree(df, spec, features, max_depth, seed).nodes()
