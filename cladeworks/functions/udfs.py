"""Tree and sequence functions on a session, for SQL: one Arrow batch at a time; table functions give rows of trees and families."""

import pandas as pd
from pyspark.sql import SparkSession

from . import trees as tr


def _on_trees(function, returns: str):
    """A pandas UDF of Newick texts; null for a text that can't be read."""
    from pyspark.sql.functions import pandas_udf

    def one(newick):
        try:
            return function(tr.parse(newick)) if newick else None
        except (ValueError, RecursionError):
            return None

    def run(column: pd.Series) -> pd.Series:
        return column.map(one, na_action=None).astype(object)

    return pandas_udf(run, returns)


def _text(root) -> str | None:
    return tr.text(root) if root is not None else None


#: Name, function of a tree, what it returns.
FUNCTIONS = {
    "tree_tips": (lambda t: len(t.tips()), "int"),
    "tree_taxa": (lambda t: len(tr.taxa(t)), "int"),
    "tree_labels": (lambda t: t.labels(), "array<string>"),
    "tree_support": (tr.mean_support, "double"),
    "tree_trim": (lambda t: _text(tr.trim(t)), "string"),
    "tree_cut": (lambda t: [tr.text(p) for p in tr.cut(t)], "array<string>"),
    "tree_orthologs": (lambda t: [tr.text(p) for p in ([t] if tr.one_to_one(t) else tr.maximum_inclusion(t))], "array<string>"),
    "tree_unrooted": (lambda t: tr.text(tr.unrooted(t)), "string"),
    "tree_ordered": (lambda t: tr.text(tr.ordered(t)), "string"),
    "tree_guide": (lambda t: tr.text(tr.named(t), lambda c: None), "string"),
}


class TreeNodes:
    """Rows of a tree's clades, parts before wholes; none for a text that can't be read."""

    def eval(self, newick: str):
        try:
            root = tr.parse(newick) if newick else None
        except (ValueError, RecursionError):
            return
        number = {}
        for k, (clade, _) in enumerate(root.walk() if root else ()):
            number[id(clade)] = k
        for clade, parent in root.walk() if root else ():
            yield number[id(clade)], number[id(parent)] if parent is not None else None, clade.label, float(clade.length), clade.tip


class TreeSplits:
    """The inner branches of a tree: sorted taxa below and beside each."""

    def eval(self, newick: str):
        try:
            root = tr.parse(newick) if newick else None
        except (ValueError, RecursionError):
            return
        every = set(root.labels()) if root else set()
        for clade, parent in root.walk() if root else ():
            if parent is not None and not clade.tip:
                below = set(clade.labels())
                yield sorted(below), sorted(every - below), float(clade.length), clade.label


class FamilyAlignment:
    """Aligned rows of a partition of (seq_id, sequence); the partition is one family."""

    def __init__(self):
        self.family = {}

    def eval(self, row):
        self.family[row["seq_id"]] = row["sequence"] or ""

    def terminate(self):
        from .phylogeny import align_star

        yield from align_star(self.family).items()


#: Name, class, columns of each table function.
TABLE_FUNCTIONS = {
    "tree_nodes": (TreeNodes, "node_id int, parent_id int, label string, length double, is_tip boolean"),
    "tree_splits": (TreeSplits, "below array<string>, beside array<string>, length double, label string"),
    "family_alignment": (FamilyAlignment, "seq_id string, row string"),
}


def register(spark: SparkSession) -> list[str]:
    """Puts :data:`FUNCTIONS` and :data:`TABLE_FUNCTIONS` on the session and returns their names."""
    from pyspark.sql.functions import udtf

    for name, (function, returns) in FUNCTIONS.items():
        spark.udf.register(name, _on_trees(function, returns))
    for name, (made, returns) in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, udtf(made, returnType=returns))
    return [*FUNCTIONS, *TABLE_FUNCTIONS]
