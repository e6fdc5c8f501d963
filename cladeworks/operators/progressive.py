"""Progressive alignment of families: profiles are merged up a guide tree, a job a level over all families.

What a merge hands on is a profile and, for each of its two sides, where its columns went, and never rows: so a family's
size bounds no task but for its guide tree, which is made from short sketches. Once all are merged, the maps are joined
downwards, a job a level, and each sequence is written into its root's columns by itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import profiles as pf
from ..functions import trees as tr
from .graphs import cut_lineage
from .search import dealt

STATE = "aln_id string, node int, n long, profile binary, marks binary"


def guide_steps(sequences: DataFrame) -> DataFrame:
    """aln_id, node, up, left, level of every node of the guide trees of (aln_id, nth, sequence): up is null at the root; level is the round of the merge above."""
    import pandas as pd

    def sketch(frames):
        for frame in frames:
            yield pd.DataFrame({"aln_id": frame["aln_id"], "nth": frame["nth"], "sketch": [pf.word_sketch(t).tobytes() for t in frame["sequence"]]})

    def steps(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("nth")
        n = len(frame)
        pairs = pf.merge_order(np.array([np.frombuffer(x, np.float32) for x in frame["sketch"]]))
        return _steps(frame["aln_id"].iloc[0], n, pairs)

    rows = sequences.mapInPandas(sketch, "aln_id string, nth int, sketch binary")
    return rows.groupBy("aln_id").applyInPandas(steps, "aln_id string, node int, up int, left boolean, level int")


def _steps(aln_id: str, n: int, pairs: list[tuple[int, int]]):
    import pandas as pd

    level, out = [0] * n, []
    for k, (i, j) in enumerate(pairs):
        level.append(max(level[i], level[j]) + 1)
        out += [(aln_id, i, n + k, True, level[-1]), (aln_id, j, n + k, False, level[-1])]
    out.append((aln_id, n + len(pairs) - 1, None, True, 0))
    return pd.DataFrame(out, columns=["aln_id", "node", "up", "left", "level"]).astype({"up": "Int32"})


def steps_of_trees(trees: DataFrame, numbered: DataFrame) -> DataFrame:
    """As :func:`guide_steps`, after given trees (aln_id, newick) of the families' sequences; ``numbered``: aln_id, nth, seq_id.
    Parts are merged from the first on; sequences that the tree lacks, or all of an unreadable one, come last."""
    import pandas as pd

    names = numbered.groupBy("aln_id").agg(F.collect_list(F.struct(F.translate("seq_id", "@", "_").alias("name"), "nth")).alias("names"))

    def run(frames):
        for frame in frames:
            out = []
            for aln_id, newick, own in frame[["aln_id", "newick", "names"]].itertuples(index=False):
                place = {x["name"]: x["nth"] for x in sorted(own, key=lambda x: -x["nth"])}
                pairs, made, seen, n = [], {}, set(), len(own)

                def merged(parts, pairs=pairs, n=n):
                    parts = [p for p in parts if p is not None]
                    while len(parts) > 1:
                        pairs.append((parts[0], parts[1]))
                        parts = [n + len(pairs) - 1, *parts[2:]]
                    return parts[0] if parts else None

                try:
                    root = tr.parse(newick or "", lenient=True)
                except ValueError:
                    root = tr.Clade()
                for clade, _ in root.walk():
                    if clade.tip:
                        nth = place.get(clade.label.replace("@", "_"))
                        made[id(clade)] = None if nth in seen else nth
                        seen.add(nth)
                    else:
                        made[id(clade)] = merged([made[id(p)] for p in clade.parts])
                merged([made[id(root)], *(k for k in range(n) if k not in seen)])
                out.append(_steps(aln_id, n, pairs))
            yield pd.concat(out) if out else pd.DataFrame({"aln_id": [], "node": [], "up": [], "left": [], "level": []})

    return names.join(trees.select("aln_id", "newick"), "aln_id", "left").mapInPandas(run, "aln_id string, node int, up int, left boolean, level int")


def aligned(sequences: DataFrame, protein: bool = False, insertions: bool = False, trees: DataFrame | None = None) -> DataFrame:
    """aln_id, seq_id, row of (aln_id, seq_id, sequence). With ``insertions``, columns that two merges left without a partner are never aligned
    again and cost nothing. ``trees`` (aln_id, newick) guide the merges where given.

    Null and empty sequences are rows of gaps; rows that repeat an identifier are each aligned; a family of one sequence is its own alignment.
    """
    import pandas as pd

    own = sequences.select("aln_id", "seq_id", F.coalesce("sequence", F.lit("")).alias("sequence"))
    nth = F.row_number().over(_by_name())
    given = cut_lineage(own.withColumn("nth", nth - 1), "families")
    steps = guide_steps(given.select("aln_id", "nth", "sequence")) if trees is None else steps_of_trees(trees, given.select("aln_id", "nth", "seq_id"))
    steps = cut_lineage(steps, "guide-steps")
    size = 20 if protein else 4

    def leaves(frames):
        for frame in frames:
            made = [pf.one_row(t, protein) for t in frame["sequence"]]
            yield pd.DataFrame({"aln_id": frame["aln_id"], "node": frame["nth"], "n": 1, "profile": [x.astype(np.float32).tobytes() for x in made], "marks": [bytes(len(x)) for x in made]})

    def merge(frames):
        names = ["aln_id", "node", "n", "profile", "marks", "at_a", "at_b", "width"]
        for frame in frames:
            jobs = []
            for a, b, na, nb, ma, mb in frame[["a", "b", "na", "nb", "ma", "mb"]].itertuples(index=False):
                a, b = (np.frombuffer(x, np.float32).reshape(-1, size) for x in (a, b))
                jobs.append((a, b, na, nb, np.frombuffer(ma, np.int8), np.frombuffer(mb, np.int8)))
            none = lambda a, b, na, nb, *_: (a, b, na, nb, np.zeros(len(a), np.int8), np.zeros(len(b), np.int8))
            found, out = pf.align_many(jobs if insertions else [none(*x) for x in jobs]), []
            for aln_id, up, (a, b, na, nb, ma, mb), (at_a, at_b, width) in zip(frame["aln_id"], frame["up"], jobs, found, strict=True):
                both, marks = pf.joined(a, b, at_a, at_b, width, ma, mb)
                out.append((aln_id, up, na + nb, both.astype(np.float32).tobytes(), marks.tobytes(), at_a.astype(np.int32).tobytes(), at_b.astype(np.int32).tobytes(), width))
            yield pd.DataFrame(out, columns=names)

    top = steps.agg(F.max("level")).first()[0] or 0
    state = cut_lineage(dealt(given.select("aln_id", "nth", "sequence"), "aln_id", "nth").mapInPandas(leaves, STATE), "profiles")
    maps = []
    for level in range(1, top + 1):
        due = steps.where(F.col("level") == level)
        side = lambda left, p, n, m, node: due.where(F.col("left") == left).join(state, ["aln_id", "node"]).select("aln_id", "up", F.col("node").alias(node), F.col("profile").alias(p), F.col("n").alias(n), F.col("marks").alias(m))
        pairs = dealt(side(True, "a", "na", "ma", "x").join(side(False, "b", "nb", "mb", "y"), ["aln_id", "up"]), "aln_id", "up")
        found = cut_lineage(pairs.mapInPandas(merge, STATE + ", at_a binary, at_b binary, width int"), "merged")
        maps.append(found.select("aln_id", F.col("node").alias("up"), "at_a", "at_b", "width"))
        # what is still to be merged
        state = cut_lineage(state.join(due.select("aln_id", "node"), ["aln_id", "node"], "left_anti").union(found.select(state.columns)), "profiles")
    roots = steps.where(F.col("up").isNull()).join(state.select("aln_id", "node", F.length("marks").alias("width")), ["aln_id", "node"])
    places = cut_lineage(roots.select("aln_id", "node", F.lit(None).cast("binary").alias("at"), "width"), "places")
    done = places

    def down(frames):
        for frame in frames:
            at = []
            for own, above in zip(frame["own"], frame["at"], strict=True):
                own = np.frombuffer(own, np.int32)
                at.append(own.tobytes() if above is None else np.frombuffer(above, np.int32)[own].tobytes())
            yield pd.DataFrame({"aln_id": frame["aln_id"], "node": frame["node"], "at": at, "width": frame["width"]})

    for level in range(top, 0, -1):
        below = steps.where(F.col("level") == level).join(maps[level - 1].drop("width"), ["aln_id", "up"])
        below = below.select("aln_id", "up", "node", F.when(F.col("left"), F.col("at_a")).otherwise(F.col("at_b")).alias("own"))
        above = done.select("aln_id", F.col("node").alias("up"), "at", "width")
        new = below.join(above, ["aln_id", "up"]).select("aln_id", "node", "own", "at", "width").mapInPandas(down, "aln_id string, node int, at binary, width int")
        done = cut_lineage(done.join(steps.where(F.col("level") == level).select("aln_id", F.col("up").alias("node")).distinct(), ["aln_id", "node"], "left_anti").union(new), "places")

    def write(frames):
        for frame in frames:
            rows = []
            for text, at, width in zip(frame["sequence"], frame["at"], frame["width"], strict=True):
                cells = np.full(int(width), ord("-"), np.uint32)
                codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                cells[slice(None) if at is None else np.frombuffer(at, np.int32)] = codes
                rows.append(cells.tobytes().decode("utf-32-le"))
            yield pd.DataFrame({"aln_id": frame["aln_id"], "seq_id": frame["seq_id"], "row": rows})

    named = given.join(done.select("aln_id", F.col("node").alias("nth"), "at", "width"), ["aln_id", "nth"])
    return named.select("aln_id", "seq_id", "sequence", "at", "width").mapInPandas(write, "aln_id string, seq_id string, row string")


def _by_name():
    from pyspark.sql.window import Window

    return Window.partitionBy("aln_id").orderBy("seq_id", "sequence")
