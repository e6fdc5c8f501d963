"""Tree and alignment operators over DataFrames: one tree, alignment or group at a time inside Arrow-backed tasks.

Kernels never fail a job: an unreadable tree is a row of status ``error``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import phylogeny as ph
from ..functions import trees as tr
from .search import dealt

RESULT = "tree_id string, piece int, newick string, leaves_before int, leaves_after int, modified boolean, status string, error string"


def _each(trees: DataFrame, kernel: Callable[[tr.Clade, dict], Iterable[tuple[int, tr.Clade | None, str]]], extra: tuple[str, ...] = ()) -> DataFrame:
    """RESULT of the kernel for each tree; trees are dealt to all parts, and of a batch only one is ever held as clades."""

    def run(row):
        before = 0
        try:
            root = tr.parse(row["newick"] or "")
            before, old = len(root.tips()), sorted(root.labels())
            for piece, tree, status in kernel(root, row):
                yield row["tree_id"], piece, tr.text(tree) if tree else None, before, len(tree.tips()) if tree else 0, tree is None or sorted(tree.labels()) != old, status, None
        except (ValueError, RecursionError) as e:
            yield row["tree_id"], 0, None, before, 0, False, "error", str(e)

    return _rows_of(trees.select("tree_id", "newick", *extra), run, RESULT)


#: Rows that leave a tree's kernel at once.
ROWS = 5000


def _rows_of(trees: DataFrame, kernel: Callable[[dict], Iterable[tuple]], schema: str) -> DataFrame:
    """The rows of ``kernel`` for each row of (tree_id, newick, ...), which is made an object by itself; what leaves it is some rows at a time."""
    import pyarrow as pa

    arrow = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    types = pa.schema([(x.split()[0], arrow[x.split()[1]]) for x in schema.split(", ")])

    def run(batches):
        out = []
        ready = lambda: pa.RecordBatch.from_pydict({n: [r[k] for r in out] for k, n in enumerate(types.names)}, types)
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(k)[at].as_py() for k, n in enumerate(batch.schema.names)}
                for found in kernel(row):
                    out.append(found)
                    if len(out) == ROWS:
                        yield ready()
                        out = []
            if out:
                yield ready()
                out = []

    return dealt(trees, "tree_id").mapInArrow(run, schema)


def trim_tips(trees: DataFrame, relative: float = 0.2, absolute: float = 0.3, ratio: float = 20.0, passes: int = 10, least: int = 4) -> DataFrame:
    def kernel(root, _):
        old = sorted(root.labels())
        new = tr.trim(root, relative, absolute, ratio, passes)
        status = "skipped" if new is None or len(new.tips()) < least else "unchanged" if sorted(new.labels()) == old else "processed"
        yield 0, None if status == "skipped" else new, status

    return _each(trees, kernel)


def mask_tips(trees: DataFrame, alignments: DataFrame, least: int = 4, paraphyletic: bool = False) -> DataFrame:
    """Masks tips of (tree_id, newick) by characters of the alignment of the same identifier."""
    from .alignments import informative

    counts = alignments.groupBy(F.col("aln_id").alias("tree_id")).agg(F.map_from_entries(F.collect_list(F.struct(F.translate("seq_id", "@", "_"), informative(F.col("row"))))).alias("characters"))

    def kernel(root, row):
        old = sorted(root.labels())
        new = tr.mask(root, dict(row["characters"] or {}), least, paraphyletic)
        yield 0, new, "skipped" if new is None else "unchanged" if sorted(new.labels()) == old else "processed"

    return _each(trees.join(counts, "tree_id", "left"), kernel, ("characters",))


def cut_branches(trees: DataFrame, longest: float = 0.02, least_taxa: int = 4, least_piece: int = 4) -> DataFrame:
    def kernel(root, _):
        n = len(tr.taxa(root))
        if n < least_taxa:
            yield 0, None, "skipped"
            return
        whole = tr.parse(tr.text(root))
        pieces = tr.cut(root, longest, least_piece)
        if len(pieces) == 1 and len(tr.taxa(pieces[0])) == n:
            yield 0, whole, "unchanged"
            return
        large = [tr.unrooted(p) for p in pieces if len(tr.taxa(p)) >= least_piece]
        if not pieces:
            yield 0, None, "skipped"
        elif not large:
            yield 0, whole, "copied_original"
        for k, piece in enumerate(large, 1):
            yield k, piece, "cut"

    return _each(trees, kernel)


def prune_orthologs(trees: DataFrame, least: int = 4, **trimming) -> DataFrame:
    """One-to-one trees as they are, others split by maximum inclusion."""

    def kernel(root, _):
        if tr.one_to_one(root, least):
            yield 0, root, "1to1_ortholog"
            return
        found = tr.maximum_inclusion(root, least, **trimming)
        for k, piece in enumerate(found, 1):
            yield k, piece, "pruned"
        if not found:
            yield 0, None, "skipped"

    return _each(trees, kernel)


def rooted_orthologs(trees: DataFrame) -> DataFrame:
    """Rooted trees split at duplications until no taxon is in a piece twice."""

    def kernel(root, _):
        for k, piece in enumerate(tr.rooted_orthologs(root), 1):
            yield k, piece, "ortholog"

    return _each(trees, kernel)


def route(results: DataFrame, last: bool) -> tuple[DataFrame, DataFrame]:
    """(trees that are done, trees for the next iteration): changed ones go round again, except that the last iteration ends with those unchanged."""
    kept = results.where(F.col("newick").isNotNull())
    return kept.where(~F.col("modified")), kept.where(F.lit(False) if last else F.col("modified"))


def nodes(trees: DataFrame) -> DataFrame:
    """tree_id, node_id, parent_id, child_pos, label, length, is_tip of every clade, parents first."""
    schema = "tree_id string, node_id int, parent_id int, child_pos int, label string, length double, is_tip boolean"

    def run(row):
        try:
            stack, n = [(tr.parse(row["newick"] or ""), None, 0)], 0
        except ValueError:
            return
        while stack:
            clade, parent, pos = stack.pop()
            yield row["tree_id"], n, parent, pos, clade.label, clade.length, clade.tip
            stack.extend((p, n, k) for k, p in reversed(list(enumerate(clade.parts))))
            n += 1

    return _rows_of(trees.select("tree_id", "newick"), run, schema)


def _families(rows: DataFrame, column: str, kernel: Callable[[str, list[str], list[str]], Iterable[tuple]], schema: str) -> DataFrame:
    """``kernel`` of each aln_id, its seq_ids and what ``column`` has for them; families are dealt to all parts and follow one another there,
    so many small ones cost no call each."""
    import pyarrow as pa

    names = [x.split()[0] for x in schema.split(", ")]
    types = pa.schema([(x.split()[0], {"string": pa.string(), "double": pa.float64()}[x.split()[1]]) for x in schema.split(", ")])
    most = 1 << 22

    def run(batches):
        key, ids, texts, out, letters = None, [], [], [], 0

        def ready():
            return pa.RecordBatch.from_pydict({n: [r[k] for r in out] for k, n in enumerate(names)}, types)

        for batch in batches:
            for aln_id, seq_id, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if ids and aln_id != key:
                    out += kernel(key, ids, texts)
                    letters += sum(len(x or "") for x in texts)
                    ids, texts = [], []
                    if letters > most or len(out) > 10_000:
                        yield ready()
                        out, letters = [], 0
                key = aln_id
                ids.append(seq_id)
                texts.append(text)
        if ids:
            out += kernel(key, ids, texts)
        if out:
            yield ready()

    return dealt(rows.select("aln_id", "seq_id", column), "aln_id").sortWithinPartitions("aln_id", "seq_id").mapInArrow(run, schema)


def align(sequences: DataFrame) -> DataFrame:
    """aln_id, seq_id, row of groups of (aln_id, seq_id, sequence)."""

    def run(aln_id, ids, texts):
        return [(aln_id, k, row) for k, row in ph.align_star(dict(zip(ids, texts, strict=True))).items()]

    return _families(sequences, "sequence", run, "aln_id string, seq_id string, row string")


def distance_trees(rows: DataFrame, replicates: int = 0, protein: bool = False, seed: int = 1) -> DataFrame:
    """tree_id, newick of each alignment; with replicates, inner labels are bootstrap percentages."""

    def run(aln_id, ids, texts):
        own = {k.replace("@", "_"): r for k, r in zip(ids, texts, strict=True)}
        root = ph.bootstrapped(own, replicates, seed, protein) if replicates else ph.neighbor_joining(*ph.distances(own, protein))
        return [(aln_id, tr.text(root))]

    return _families(rows, "row", run, "tree_id string, newick string")


def likelihood_trees(rows: DataFrame, replicates: int = 0, protein: bool = False, seed: int = 1) -> DataFrame:
    """tree_id, newick, log_likelihood: the maximum-likelihood tree of each alignment of (aln_id, seq_id, row); with replicates,
    inner labels are percentages of support. A null row is one without letters."""
    from ..functions import likelihood as lk

    def run(aln_id, ids, texts):
        root, value = lk.ml_tree({k.replace("@", "_"): r or "" for k, r in zip(ids, texts, strict=True)}, protein, replicates, seed)
        return [(aln_id, tr.text(root), value)]

    return _families(rows, "row", run, "tree_id string, newick string, log_likelihood double")


def species_distances(trees: DataFrame, whole: bool = False) -> DataFrame:
    """a, b, d: mean number of inner nodes between two taxa over all gene trees, the mean per tree first. ``whole`` labels are taxa.

    A clade holds a count and a sum of depths a taxon, so a tree leaves a row a pair of taxa and its pairs of tips are never made.
    """

    def run(row):
        try:
            root = tr.parse(row["newick"] or "")
        except ValueError:
            return
        below: dict[int, dict[str, tuple[int, int]]] = {}
        pairs: dict[tuple[str, str], list[int]] = {}
        for clade, _ in root.walk():
            if clade.tip:
                below[id(clade)] = {clade.label if whole else tr.taxon(clade.label): (1, 0)}
                continue
            seen: dict[str, tuple[int, int]] = {}
            for part in clade.parts:
                own = below.pop(id(part))
                for a, (n, x) in own.items():
                    for b, (m, y) in seen.items():
                        if a != b:
                            found = pairs.setdefault((min(a, b), max(a, b)), [0, 0])
                            found[0] += n * m
                            found[1] += x * m + y * n + n * m
                for a, (n, x) in own.items():
                    m, y = seen.get(a, (0, 0))
                    seen[a] = n + m, x + y
            below[id(clade)] = {a: (n, x + n) for a, (n, x) in seen.items()}
        yield from ((row["tree_id"], a, b, n, x) for (a, b), (n, x) in pairs.items())

    pairs = _rows_of(trees.select("tree_id", "newick"), run, "tree_id string, a string, b string, n long, d long")
    return pairs.groupBy("tree_id", "a", "b").agg((F.sum("d") / F.sum("n")).alias("d")).groupBy("a", "b").agg(F.avg("d").alias("d"))


def branch_observations(species: str, trees: DataFrame, least_support: float = 0.0) -> DataFrame:
    """branch_id, gene_tree_id, length: lengths of the gene trees' branches that meet a branch of the species tree (B<k> in
    walking order), and of shared single tips (T:<label>) once a gene tree."""
    import pandas as pd

    def run(frames):
        bits: dict[str, int] = {}
        root = tr.opened(tr.parse(species, lenient=True))
        wanted = [(f"B{k}", s) for k, (_, s) in enumerate(tr.splits(root, bits))]
        for frame in frames:
            out = []
            for tree_id, newick in zip(frame["tree_id"], frame["newick"], strict=True):
                try:
                    gene = tr.parse(newick or "", lenient=True)
                    name = {1 << bits.setdefault(c.label, len(bits)): c for c in gene.tips()}
                    tips = set()
                    for _, g in tr.splits(gene, bits):
                        if least_support > float(g.label or 0):
                            continue
                        alone = {m for m in (*g.lefts, *g.rights) if m in name}
                        for branch, s in wanted:
                            if s.meets(g):
                                out.append((branch, tree_id, g.length))
                                tips |= {m for m in (*s.lefts, *s.rights) if m in alone}
                    out += [(f"T:{name[m].label}", tree_id, name[m].length) for m in sorted(tips)]
                except ValueError:
                    continue
            yield pd.DataFrame(out, columns=["branch_id", "gene_tree_id", "length"])

    return trees.select("tree_id", "newick").mapInPandas(run, "branch_id string, gene_tree_id string, length double")


def _grams(texts: DataFrame, q: int) -> DataFrame:
    """n (number of a text), gram: a hash of each word of q letters and of how often the text has had it before."""
    import pandas as pd
    import numpy as np

    def run(frames):
        for frame in frames:
            numbers, grams = [], []
            for n, text in zip(frame["n"], frame["sequence"], strict=True):
                x = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
                code = np.zeros(max(len(x) - q + 1, 0), np.uint64)
                for k in range(q):
                    code = code * np.uint64(0x5851F42D4C957F2D) + x[k : k + len(code)] + np.uint64(1)
                code.sort()
                new = np.ones(len(code), bool)
                new[1:] = code[1:] != code[:-1]
                nth = np.arange(len(code)) - np.maximum.accumulate(np.where(new, np.arange(len(code)), 0))
                grams.append((code * np.uint64(0x2545F4914F6CDD1D) + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
                numbers.append(np.full(len(code), n))
            if grams:
                yield pd.DataFrame({"n": np.concatenate(numbers), "gram": np.concatenate(grams)})

    return texts.select("n", "sequence").mapInPandas(run, "n long, gram long")


#: Most sequences, and letters of them, of a node that is clustered in one go.
NODE, NODE_LETTERS = 256, 1 << 20


def centroids(sequences: DataFrame, identity: float = 0.9) -> DataFrame:
    """node, query, target: greedy centroid clusters of the sequences of each node. Longest first (then by name), a sequence
    goes to the first centroid whose edits leave that identity, else it is a centroid itself.

    Nodes of at most NODE sequences and NODE_LETTERS letters are a group each, whose texts are sent once; larger ones go by :func:`_centroids_by_words`.
    """
    import pandas as pd
    from .graphs import cut_lineage

    given = sequences.select("node", F.col("seq_id").alias("query"), "sequence").where(F.col("node").isNotNull() & F.col("sequence").isNotNull())
    sizes = given.groupBy("node").agg(F.count("*").alias("_n"), F.sum(F.length("sequence")).alias("_l"))
    large = cut_lineage(sizes.where((F.col("_n") > NODE) | (F.col("_l") > NODE_LETTERS)).select("node"), "large-nodes")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows.groupby("sequence")["query"].min()
        found = ph.greedy_centroids({(name, text): text for text, name in own.items()}, identity)
        target = {text: of[0] for (_, text), of in found.items()}
        return pd.DataFrame({"node": rows["node"], "query": rows["query"], "target": rows["sequence"].map(target)})

    inner = dealt(given.join(large, "node", "left_anti"), "node").groupBy("node").applyInPandas(run, "node string, query string, target string")
    if large.isEmpty():
        return inner
    return inner.union(_centroids_by_words(given.join(large, "node", "left_semi").withColumnRenamed("query", "seq_id"), identity))


def _centroids_by_words(sequences: DataFrame, identity: float) -> DataFrame:
    """The same of nodes of any size.

    Nothing is compared node by node. d edits leave a text of l letters at least l - q + 1 - d * q of its words of q letters,
    so two near texts share one of the d * q + 1 words of either that the fewest texts have; texts meet by these words.
    A text that is the first in each of its words is a centroid, and takes the texts it is near to. Only what is left over is
    compared pair by pair, and of it, round by round, the texts that no earlier near one is left of become centroids.
    Last, all members are held against the centroids found on the way, as a member belongs to its first one.
    """
    from .graphs import cut_lineage

    q = max(1, min(8, int(0.5 / max(1 - identity, 1e-9))))
    edits = lambda size: F.floor(F.lit(1 - identity) * size + 1e-9)
    rank = F.struct((-F.length("sequence")).alias("size"), F.col("seq_id").alias("name"))
    texts = sequences.groupBy("node", "sequence").agg(F.min("seq_id").alias("seq_id"))
    texts = cut_lineage(texts.select(F.xxhash64("node", "seq_id").alias("n"), "node", "seq_id", "sequence", rank.alias("rank")), "texts")
    words = cut_lineage(_grams(texts, q).join(texts.select("n", "node"), "n"), "grams")
    held = words.join(words.groupBy("node", "gram").agg(F.count("*").alias("_f")).where(F.col("_f") > 1), ["node", "gram"])
    own = texts.select("n", "rank", (edits(F.length("sequence")) * q + 1).alias("_few"), (F.length("sequence") - q + 1).alias("_all"))
    order = Window.partitionBy("n").orderBy("_f", "gram")
    held = held.join(own, "n").withColumns({"_r": F.row_number().over(order), "_h": F.count("*").over(Window.partitionBy("n"))})
    # words that no other text has come first
    blocks = cut_lineage(held.where(F.col("_r") + F.col("_all") - F.col("_h") <= F.col("_few")).select("node", "gram", "n", "rank"), "blocks")

    def near(pairs: DataFrame) -> DataFrame:
        """a, b of the pairs that leave the identity; b comes first."""
        left = texts.select(F.col("n").alias("a"), F.col("sequence").alias("_x"))
        right = texts.select(F.col("n").alias("b"), F.col("sequence").alias("_y"))
        both = pairs.select("a", "b").distinct().join(left, "a").join(right, "b").where(F.length("_y") - F.length("_x") <= edits(F.length("_x")))

        def run(frames):
            for frame in frames:
                for _, group in frame.groupby("a"):
                    x = group["_x"].iloc[0]
                    keep = ph.edit_distances(x, group["_y"].tolist()) <= (1 - identity) * len(x) + 1e-9
                    yield group[["a", "b"]][keep]

        return cut_lineage(both.mapInPandas(run, "a long, b long"), "near")

    first = blocks.groupBy("node", "gram").agg(F.min("rank").alias("_first"), F.min_by("n", "rank").alias("b"))
    placed = blocks.join(first, ["node", "gram"])
    led = placed.groupBy("n").agg(F.min(F.col("_first.name") == F.col("rank.name")).alias("_own"))
    heads = cut_lineage(texts.select("n").join(led.where(~F.col("_own")), "n", "left_anti"), "heads")
    taken = near(placed.join(heads.select(F.col("n").alias("b")), "b", "left_semi").where(F.col("n") != F.col("b")).select(F.col("n").alias("a"), "b"))
    rest = cut_lineage(texts.select("n", "rank").join(heads, "n", "left_anti").join(taken.select(F.col("a").alias("n")), "n", "left_anti"), "rest")
    left = blocks.join(rest.select("n"), "n", "left_semi")
    one, two = left.alias("x"), left.alias("y")
    inner = near(one.join(two, ["node", "gram"]).where(F.col("y.rank") < F.col("x.rank")).select(F.col("x.n").alias("a"), F.col("y.n").alias("b")))
    found, open_ = heads.limit(0), cut_lineage(rest.select("n"), "open")
    while not open_.isEmpty():
        links = inner.join(open_.select(F.col("n").alias("a")), "a", "left_semi").join(open_.select(F.col("n").alias("b")), "b", "left_semi")
        new = cut_lineage(open_.join(links.select(F.col("a").alias("n")), "n", "left_anti"), "found")
        gone = inner.join(new.select(F.col("n").alias("b")), "b", "left_semi").select(F.col("a").alias("n"))
        open_ = cut_lineage(open_.join(new, "n", "left_anti").join(gone, "n", "left_anti"), "open")
        found = cut_lineage(found.union(new), "found")
    late = blocks.join(found, "n", "left_semi").select("node", "gram", F.col("n").alias("b"), F.col("rank").alias("_rank"))
    members = blocks.join(taken.select(F.col("a").alias("n")), "n", "left_semi").select("node", "gram", F.col("n").alias("a"), "rank")
    more = near(members.join(late, ["node", "gram"]).where(F.col("_rank") < F.col("rank")).select("a", "b"))
    to_found = inner.join(found.select(F.col("n").alias("b")), "b", "left_semi").select("a", "b")
    every = taken.union(more).union(to_found).join(texts.select(F.col("n").alias("b"), "rank"), "b")
    named = every.groupBy("a").agg(F.min("rank").alias("_best")).select(F.col("a").alias("n"), F.col("_best.name").alias("_target"))
    of = texts.join(named, "n", "left").select("node", "sequence", F.coalesce("_target", "seq_id").alias("target"))
    return sequences.select("node", F.col("seq_id").alias("query"), "sequence").join(of, ["node", "sequence"]).select("node", "query", "target")


def cluster_up(sequences: DataFrame, guide: str, identity: float = 0.9) -> DataFrame:
    """seq_id, cluster: sequences (node: a tip of the guide tree) clustered at each node from the tips up, a node's centroids
    going on to its parent. One job a level; the guide tree is small and read on the driver."""
    from .graphs import combine_results, cut_lineage

    root = tr.parse(guide)
    level = tr.levels(root)
    parent = {c.label: p.label for c, p in root.walk() if p is not None}
    spark = sequences.sparkSession
    up = spark.createDataFrame([(k, v) for k, v in parent.items()], "node string, _up string")
    here, pairs = sequences.select("node", "seq_id", "sequence"), None
    for k in range(1, max(level.values()) + 1):
        names = spark.createDataFrame([(c, level[p]) for c, p in parent.items()], "node string, _l int").where(F.col("_l") == k)
        due = here.join(names, "node", "left_semi").join(up, "node").select(F.col("_up").alias("node"), "seq_id", "sequence")
        found = cut_lineage(centroids(due, identity), "centroids")
        pairs = found if pairs is None else pairs.union(found)
        kept = due.join(found.where(F.col("query") == F.col("target")).select(F.col("query").alias("seq_id")), "seq_id", "left_semi")
        here = cut_lineage(here.join(names, "node", "left_anti").unionByName(kept.select("node", "seq_id", "sequence")), "centroids")
    moved = combine_results(pairs.select("query", "target"))
    alone = sequences.join(moved, "seq_id", "left_anti").select("seq_id", F.col("seq_id").alias("cluster"))
    return moved.union(alone)


def kmer_hits(sequences: DataFrame, k: int = 8, shared: int = 4, targets: int = 20, targets_of: DataFrame | None = None) -> DataFrame:
    """query, target, shared: pairs of (seq_id, sequence) that share ``shared`` words of k letters, best ``targets`` a query;
    targets are of ``targets_of`` if it is given.

    Equal sequences are one in the search and come back in its result. Of each sequence's n words, the n - shared + 1 that
    the fewest sequences have find the pairs (two sequences that share enough have one of these in common), and only these
    pairs are counted over all their words; so words that most sequences hold are joined only where a sequence has
    hardly any other, and none is left out.
    """
    text = lambda df: df.select("seq_id", "sequence", F.xxhash64("sequence").alias("_c"))
    left = text(sequences)
    right = left if targets_of is None else text(targets_of)
    one = left if targets_of is None else left.union(right)
    place = F.sequence(F.lit(1), F.length("sequence") - k + 1)
    words = one.where(F.length("sequence") >= k).dropDuplicates(["_c"]).select("_c", F.explode(F.array_distinct(F.transform(place, lambda i: F.substring("sequence", i, F.lit(k))))).alias("word"))
    often = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    held = words.join(often, "word")
    rank = F.row_number().over(Window.partitionBy("_c").orderBy("n", "word"))
    every = F.count("*").over(Window.partitionBy("_c"))
    first = held.withColumns({"_r": rank, "_all": every}).where(F.col("_r") <= F.col("_all") - shared + 1)
    near = first.select(F.col("_c").alias("_q"), "word").join(first.select(F.col("_c").alias("_t"), "word"), "word").where(F.col("_q") != F.col("_t")).select("_q", "_t").distinct()
    bags = held.groupBy("_c").agg(F.collect_list(F.xxhash64("word")).alias("_w"))
    both = near.join(bags.select(F.col("_c").alias("_q"), F.col("_w").alias("_a")), "_q").join(bags.select(F.col("_c").alias("_t"), F.col("_w").alias("_b")), "_t")
    counts = both.select("_q", "_t", F.size(F.array_intersect("_a", "_b")).cast("long").alias("shared")).where(F.col("shared") >= shared)
    # a sequence shares all its words with those equal to it
    same = words.groupBy("_c").agg(F.count("*").alias("shared")).where(F.col("shared") >= shared).select(F.col("_c").alias("_q"), F.col("_c").alias("_t"), "shared")
    names = right.select(F.col("seq_id").alias("target"), F.col("_c").alias("_t"))
    # of equal targets no more than can be among the best
    names = names.withColumn("_k", F.row_number().over(Window.partitionBy("_t").orderBy("target"))).where(F.col("_k") <= targets + 1).drop("_k")
    pairs = counts.union(same).join(names, "_t").join(left.select(F.col("seq_id").alias("query"), F.col("_c").alias("_q")), "_q").where(F.col("query") != F.col("target"))
    best = Window.partitionBy("query").orderBy(F.col("shared").desc(), "target")
    return pairs.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= targets).select("query", "target", "shared")


def frames_of(contigs: DataFrame) -> DataFrame:
    """seq_id (contig:frame), contig, frame, sequence: the proteins of the six reading frames of (seq_id, sequence)."""
    from ..functions.scalars import six_frames

    rows = contigs.select(F.col("seq_id").alias("contig"), F.explode(six_frames(F.col("sequence"))).alias("_f"))
    return rows.select(F.concat_ws(":", "contig", F.col("_f.frame").cast("string")).alias("seq_id"), "contig", F.col("_f.frame").alias("frame"), F.col("_f.protein").alias("sequence")).where(F.length("sequence") > 0)


def set_cover(pairs: DataFrame) -> DataFrame:
    """seq_id, cluster by greedy set cover of links (query, target): the sequence with the most linked ones that are free
    becomes a representative with them, of equal ones the smaller, until none is free.

    All sequences that come before every free one within two links are taken in one round, which gives the same clusters
    as one at a time; a round is a few joins, written to the shared folder.
    """
    from .graphs import cut_lineage

    links = pairs.where(F.col("query") != F.col("target")).select(F.col("query").alias("a"), F.col("target").alias("b"))
    links = cut_lineage(links.union(links.select("b", "a")).distinct(), "cover-links")
    alone = pairs.select(F.explode(F.array("query", "target")).alias("seq_id")).distinct().join(links.select(F.col("a").alias("seq_id")).distinct(), "seq_id", "left_anti")
    free, done = cut_lineage(links.select(F.col("a").alias("n")).distinct(), "cover-free"), alone.select("seq_id", F.col("seq_id").alias("cluster"))
    while not free.isEmpty():
        own = cut_lineage(links.join(free, F.col("a") == F.col("n"), "left_semi").join(free, F.col("b") == F.col("n"), "left_semi"), "cover-links")
        size = free.join(own.groupBy("a").agg(F.count("*").alias("_s")), F.col("n") == F.col("a"), "left").select("n", F.struct((-F.coalesce("_s", F.lit(0))).alias("s"), F.col("n").alias("n")).alias("rank"))
        size = cut_lineage(size, "cover-size")
        # the best rank within one link, then within two
        near = own.join(size, F.col("b") == F.col("n")).select(F.col("a").alias("n"), "rank").union(size).groupBy("n").agg(F.min("rank").alias("rank"))
        wide = own.join(near, F.col("b") == F.col("n")).select(F.col("a").alias("n"), "rank").union(near).groupBy("n").agg(F.min("rank").alias("rank"))
        chosen = cut_lineage(wide.where(F.col("rank.n") == F.col("n")).select(F.col("n").alias("cluster")), "cover-chosen")
        taken = chosen.select(F.col("cluster").alias("seq_id"), "cluster").union(own.join(chosen, F.col("a") == F.col("cluster")).select(F.col("b").alias("seq_id"), "cluster"))
        taken = cut_lineage(taken, "cover-taken")
        done = done.union(taken)
        free = cut_lineage(free.join(taken, F.col("n") == F.col("seq_id"), "left_anti"), "cover-free")
        links = own
    return done
