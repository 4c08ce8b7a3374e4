"""MinHash near-dedup as a chosen-path set similarity join.

Each text becomes its set of 4-word shingles (64-bit hashes) and, per tree and
path of branches, a *selected minwise token*.  A tree is a recursion: a node
holds documents; if it is larger than ``leaf`` its documents branch into the
children named by their selected tokens of the next level, else it is a leaf.
Every path of branches has hash functions of its own, so what two documents
share in one node says nothing about the nodes beside it.  Similar documents
follow a common path with a probability that the number of independent trees
drives to the target recall (``recall()``; 0.9999997 at similarity 0.8 with the
defaults, even where every level is used).

Comparing inside nodes is exact and never emits all pairs of a group:

1. every document of a node is compared with the node's smallest document
   (linear) and candidates are verified on the full sets;
2. nodes that still hold several components are compared exhaustively, but
   only across components, again on the full sets: first the nodes above
   ``leaf`` that no level was left to branch, in blocks that emit spanning
   links only (``_block_links``), then the small ones by pairs.

So a group of copies costs one link per copy, and any two documents that share
a node and are similar end in one component.  Exact copies (equal sets) are
reduced to one representative before the trees.

Defined cases: a null or empty text has no shingles and is linked with
nothing; rows with one ``doc_id`` are one document, linked by any of its texts; a null ``doc_id`` is never
linked (its component is null, it is kept); an empty table gives an empty
result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import checkpointed, fits_broadcast
from . import kernel as K
from .components import components, tasks_for


PARITY = 1024  # bits of a set's parity bitmap
BLOCK = 1 << 18  # shingles of one side of a block comparison
WIDE = 8  # a row with a set or its sketch counts as so many small rows
PIVOTS = 64  # documents of a node that are compared with all others before its blocks are


@dataclass(frozen=True)
class Join:
    """``width``-word shingles; link if 100 * |A & B| >= ``percent`` * |A | B|.
    ``branches[l]`` children per document at level l of each of ``trees`` trees;
    a node of at most ``leaf`` documents is not branched further."""

    width: int = 5
    percent: int = 80
    trees: int = 8
    branches: tuple[int, ...] = (2, 2, 1, 1)
    leaf: int = 24

    def paths(self, level: int) -> int:
        """Paths of branches from the root to the children of this level."""
        return math.prod(self.branches[:level + 1])

    @property
    def functions(self) -> int:
        return self.first(len(self.branches))

    def first(self, level: int) -> int:
        """Number of the first function of a level; those of a level stand together."""
        return self.trees * sum(self.paths(k) for k in range(level))

    def function(self, tree, level: int, path):
        """Place, among its level's, of the function that names the children at the end of this path (of ``paths(level)``)."""
        return tree * self.paths(level) + path

    def recall(self, similarity: float = 0.8) -> float:
        """Least probability that two documents of this similarity share a node of the deepest level."""
        p = 1.0
        for b in reversed(self.branches):
            p = 1 - (1 - similarity * p) ** b
        return 1 - (1 - p) ** self.trees


def shingle_slices(column, width: int):
    """Yield (first row, last row, sorted distinct shingle hashes of its texts one after the other, bounds per
    text) for slices of whole texts, so that what is held does not grow with the batch."""
    for a, z, offs, data in K.text_slices(column):
        low = K.lowered(data)
        start, end, first = K.word_bounds(low, offs)
        words = K.word_hashes(low, start, end)
        at, per = K.windows(first, width)
        h = K.window_hashes(words, at, width)
        count = np.diff(first)
        stop = np.cumsum(per)
        tokens = []
        for b, e, f, n in zip(stop - per, stop, first[:-1], count, strict=True):
            if e > b:
                s = np.sort(h[b:e])
                s = s[np.concatenate(([True], s[1:] != s[:-1]))]
            else:  # fewer words than a shingle: the whole sequence is one
                s = K.window_hashes(words, np.array([f]), n) if n else h[:0]
            tokens.append(s)
        bounds = np.concatenate(([0], np.cumsum(np.array([len(s) for s in tokens], np.int64)))).astype(np.int64)
        yield a, z, np.concatenate(tokens), bounds


def shingle_sets(column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, one text after the other; bounds per text)."""
    tokens, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, t, bounds in shingle_slices(column, width):
        tokens.append(t)
        sizes.append(np.diff(bounds))
    return np.concatenate(tokens), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int64)


def _multipliers(n: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(7))
    return rng.integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def selected_tokens(tokens: np.ndarray, bounds: np.ndarray, functions: int) -> np.ndarray:
    """(texts, functions) int32: the minwise token of every text under each hash function; 0 for an empty set."""
    n = len(bounds) - 1
    out = np.zeros((n, functions), np.int32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        step = 1 << 18  # tokens at a time stay in the processor's cache
        cuts = [0]
        while cuts[-1] < len(full):
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(bounds[full + 1], bounds[full[cuts[-1]]] + step, "right"))))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            lo, rows = bounds[full[a]], full[a:b]
            part, at = tokens[lo:bounds[rows[-1] + 1]], bounds[rows] - lo
            for f, m in enumerate(_multipliers(functions)):
                least = np.minimum.reduceat(((part * m) >> np.uint64(32)).astype(np.uint32), at)
                out[rows, f] = least.view(np.int32)
    return out


def parity_bits(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, PARITY / 64) int64: a bitmap in which every member of a set toggles one bit."""
    n, rows = len(bounds) - 1, []
    for a in range(0, n, 512):
        z = min(a + 512, n)
        lo, hi = bounds[a], bounds[z]
        row = np.repeat(np.arange(z - a), np.diff(bounds[a:z + 1]))
        bit = (K.mix(tokens[lo:hi]) >> np.uint64(64 - PARITY.bit_length() + 1)).astype(np.int64)
        odd = np.bincount(row * PARITY + bit, minlength=(z - a) * PARITY) & 1
        rows.append(np.packbits(odd.astype(bool)).view(np.int64).reshape(z - a, -1))
    return np.concatenate(rows) if rows else np.zeros((0, PARITY // 64), np.int64)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))


def sketches(docs: DataFrame, join: Join) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, tokens, parity): set size, 128-bit digest of the set,
    its selected tokens and its parity bitmap."""
    def run(batches):
        for b in batches:
            for a, z, tokens, bounds in shingle_slices(b.column(1), join.width):
                c1 = np.concatenate((np.zeros(1, np.uint64), np.cumsum(K.mix(tokens), dtype=np.uint64)))
                c2 = np.concatenate((np.zeros(1, np.uint64), np.cumsum(K.mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)))
                s1, s2 = (c[bounds[1:]] - c[bounds[:-1]] for c in (c1, c2))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, z - a), pa.array(np.diff(bounds)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                     _lists(selected_tokens(tokens, bounds, join.functions)), _lists(parity_bits(tokens, bounds))],
                    ["doc_id", "n_shingles", "s1", "s2", "tokens", "parity"])

    return docs.select("doc_id", "text").mapInArrow(
        K.tidy(run), f"doc_id {_id_type(docs)}, n_shingles long, s1 long, s2 long, tokens array<int>, parity array<long>")


def full_sets(docs: DataFrame, ids: DataFrame, join: Join) -> DataFrame:
    """(id, members array<long>): the shingle sets of the documents in ``ids``."""
    def run(batches):
        for b in batches:
            for a, z, tokens, bounds in shingle_slices(b.column(1), join.width):
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), lists], ["id", "members"])

    side = F.broadcast(ids) if fits_broadcast(ids) else ids
    wanted = docs.select("doc_id", "text").join(side, F.col("doc_id") == F.col("id"), "left_semi")
    return wanted.mapInArrow(K.tidy(run), f"id {_id_type(docs)}, members array<long>")


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _may_link(x: str, y: str, join: Join) -> Column:
    """False only for pairs that are not linked.

    Two sets whose parity bitmaps differ in d bits differ in at least d members,
    and a link allows ``(100 - percent) / (100 + percent)`` of the two sizes.
    The smaller set of a link has at least ``percent`` of the larger one's size,
    which still holds where sets are too large for the bitmap.
    """
    differ = F.expr(f"aggregate(zip_with({x}.parity, {y}.parity, (p, q) -> bit_count(p ^ q)), 0, (s, v) -> s + v)")
    m, n = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    return (100 * F.least(m, n) >= join.percent * F.greatest(m, n)) & (
        (100 + join.percent) * differ <= (100 - join.percent) * (m + n))


def _few(df: DataFrame, rows: int) -> DataFrame:
    """Checkpoint of ``df``, which has at most ``rows`` rows, in as many files as these need.  An executor
    starts a process per file it creates, so files follow the rows and not the shuffle partitions."""
    return checkpointed(df.coalesce(tasks_for(rows)))


def _tree_nodes(reps: DataFrame, join: Join) -> DataFrame:
    """(node, id, n, pivot): the documents of all final nodes with at least two
    members, each node's size and its smallest document.  Checkpointed."""
    def nodes_of(level: int) -> Column:
        """The nodes of a document at the ends of all paths of a level, tree by tree; each is named by its
        tree and by the branches and selected tokens on its path."""
        def named(place: Column) -> Column:
            tree = F.floor(place / join.paths(level)).cast("int")
            node = F.xxhash64(tree)
            for k, b in enumerate(join.branches[:level + 1]):
                at = F.floor(place / (join.paths(level) // join.paths(k))).cast("int")  # the place of its ancestor of level k
                node = F.xxhash64(node, F.pmod(at, F.lit(b)), F.get("tokens", F.lit(join.first(k)) + at))
            return node

        return F.transform(F.sequence(F.lit(0), F.lit(join.trees * join.paths(level) - 1)), named)

    def words(level: int) -> range:
        return range(-(-join.trees * join.paths(level) // 64))

    rows = reps.count()
    members, found = reps.select("id", F.posexplode(nodes_of(0)).alias("place", "node")), []
    for level in range(len(join.branches)):
        size = members.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("pivot")).where("n > 1")
        shared = _few(members.join(size, "node"), rows * join.trees * join.paths(level))
        last = level + 1 == len(join.branches)
        found.append((shared if last else shared.where(F.col("n") <= join.leaf)).select(
            "node", "id", "n", "pivot"))
        if last:
            break
        large = shared.where(F.col("n") > join.leaf).select("id", "place")
        if large.isEmpty():
            break
        # an id meets its tokens once a level; its places above are bits of a few numbers
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place") % 64)
        places = large.groupBy("id").agg(*[
            F.bit_or(F.when(F.floor(F.col("place") / 64) == w, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"w{w}") for w in words(level)])
        above = F.floor(F.col("place") / join.branches[level + 1]).cast("int")
        kept = F.get(F.array(*[f"w{w}" for w in words(level)]), F.floor(above / 64).cast("int"))
        tokens = reps.select("id", F.slice("tokens", 1, join.first(level + 2)).alias("tokens"))
        members = places.join(tokens, "id").select(
            "id", *[f"w{w}" for w in words(level)], F.posexplode(nodes_of(level + 1)).alias("place", "node")).where(
            F.call_function("getbit", kept, above % 64) == 1).select("id", "place", "node")
    nodes = found[0]
    for f in found[1:]:
        nodes = nodes.unionByName(f)
    return nodes


def _verified(docs: DataFrame, pairs: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) that are linked, decided on the full sets.  Checkpointed.
    Of an id with several texts each is compared; one that is linked links the id."""
    n = pairs.count()
    ids = _few(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), n)
    sets = _few(full_sets(docs, ids, join).distinct(), ids.count() * WIDE)
    left, right = (sets.select(F.col("id").alias(c), F.col("members").alias(f"m{c}")) for c in "ab")
    both = F.size(F.array_intersect("ma", "mb"))
    linked = pairs.join(left, "a").join(right, "b").where(
        100 * both >= join.percent * (F.size("ma") + F.size("mb") - both))
    return _few(linked.select("a", "b").distinct(), n)


def _spanning(rows: pa.Table, percent: int) -> pa.Table:
    """Links (a, b) between the ``left`` rows of a block and all its rows, one per
    component that a left row joins: never more than there are rows."""
    left, ids = np.flatnonzero(rows["left"].to_numpy()), rows["id"].to_pylist()
    owner = rows["component"].combine_chunks().dictionary_encode().indices.to_numpy().copy()
    members = rows["members"].combine_chunks()
    bounds = members.offsets.to_numpy().astype(np.int64)
    _, token = np.unique(members.values.to_numpy()[bounds[0]:bounds[-1]], return_inverse=True)
    bounds = bounds - bounds[0]
    size, mark = np.diff(bounds), np.zeros(int(token.max(initial=-1)) + 1, bool)
    a, b = [], []
    for x in left:
        own = token[bounds[x]:bounds[x + 1]]
        mark[own] = True
        both = np.add.reduceat(mark[token], bounds[:-1], dtype=np.int64)
        mark[own] = False
        linked = (100 * both >= percent * (size[x] + size - both)) & (owner != owner[x])
        joined, first = np.unique(owner[linked], return_index=True)
        a += [ids[x]] * len(joined)
        b += [ids[y] for y in np.flatnonzero(linked)[first]]
        if len(joined):
            owner[np.isin(owner, joined)] = owner[x]
    kind = rows.schema.field("id").type
    return pa.table({"a": pa.array(a, kind), "b": pa.array(b, kind)})


def _sides(placed: DataFrame, most: int) -> DataFrame:
    """``placed`` (node, id, component) with ``outside``: not in the node's largest
    component, and ``others``: how many of the node's documents are not.  ``most``: no more rows.  Checkpointed."""
    main = placed.groupBy("node", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("node").agg(
        F.max_by("component", F.struct("c", "component")).alias("main"), (F.sum("c") - F.max("c")).alias("others"))
    return _few(placed.join(main, "node").select(
        "node", "id", "component", (F.col("component") != F.col("main")).alias("outside"), "others"), most)


def _block_links(docs: DataFrame, sides: DataFrame, sizes: DataFrame, join: Join, most: int,
                 pivots: int | None = None) -> DataFrame:
    """Spanning links across the components of each node of ``sides``.

    The documents outside a node's largest component are its left side, all of
    them are its right side.  Both sides are dealt by a hash of the id to blocks of
    about ``BLOCK`` shingles; every pair of a left and a right block is one group,
    so no group grows with the node, and a set is sent once per block it meets.
    ``pivots``: only so many left documents of a node are compared (a first pass
    that leaves little for the whole one).  ``most``: no more rows in ``sides``.  Checkpointed.
    """
    rows = sides.join(sizes, "id")
    if pivots:
        nearest = Window.partitionBy("node").orderBy(F.xxhash64("node", "id"), "id")
        few = rows.where("outside").select("node", "id").withColumn("r", F.row_number().over(nearest)).where(
            F.col("r") <= pivots).select("node", "id", F.lit(True).alias("outside"))
        rows = rows.drop("outside").join(few, ["node", "id"], "left").withColumn("outside", F.col("outside").isNotNull())
    rows = _few(rows.select("node", "id", "component", "n_shingles", "outside"), most)
    shares = rows.groupBy("node").agg(
        *[F.ceil(F.sum(c) / BLOCK).cast("int").alias(n) for n, c in (
            ("rights", F.col("n_shingles")), ("lefts", F.when(F.col("outside"), F.col("n_shingles"))))])
    dealt = rows.join(shares, "node").withColumn("h", F.xxhash64(F.lit("block"), "id"))

    def to(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    right = dealt.select("node", "id", "component", F.lit(False).alias("left"),
                         F.pmod("h", "rights").cast("int").alias("rb"), to("lefts").alias("lb"))
    left = dealt.where("outside").select("node", "id", "component", F.lit(True).alias("left"),
                                         to("rights").alias("rb"), F.pmod("h", "lefts").cast("int").alias("lb"))
    ids = _few(rows.select("id").distinct(), most)
    sets = _few(full_sets(docs, ids, join).distinct(), ids.count() * WIDE)
    kind, percent = _id_type(docs), join.percent
    return _few(left.unionByName(right).join(sets, "id").groupBy("node", "lb", "rb").applyInArrow(
        lambda block: _spanning(block, percent), f"a {kind}, b {kind}").distinct(), most)


def _labels(links: DataFrame) -> DataFrame:
    """(id, component): for every linked id a smaller one it reaches, or itself if it has none, by a few
    steps down the links (a > b).  Ids of one label are connected; not all that are connected share a
    label, which costs comparisons but no result.  Checkpointed."""
    few = tasks_for(links.count())
    low = links.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("component")).coalesce(few).groupBy("id").agg(
        F.min("component").alias("component")).coalesce(few)
    for _ in range(2):  # each step doubles the distance
        low = checkpointed(low)
        next_ = low.select(F.col("id").alias("component"), F.col("component").alias("further"))
        low = low.join(next_, "component", "left").select("id", F.coalesce("further", "component").alias("component")).coalesce(few)
    return checkpointed(low)


def near_duplicates(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    base = checkpointed(sketches(docs, join))
    whole = base.where("n_shingles > 0 and doc_id is not null")
    key, rows = ["n_shingles", "s1", "s2"], base.count()
    reps = _few(whole.groupBy(*key).agg(
        F.min("doc_id").alias("id"), F.first("tokens").alias("tokens"), F.first("parity").alias("parity")), rows * WIDE)
    copies = whole.select("doc_id", *key).join(reps.select("id", *key), key).where("doc_id <> id").select(
        F.col("doc_id").alias("a"), F.col("id").alias("b"))
    nodes = _tree_nodes(reps, join)
    most = rows * join.trees * join.paths(len(join.branches) - 1)  # places of documents in nodes
    marks = reps.select("id", F.struct("n_shingles", "parity").alias("m"))

    def similar(pairs: DataFrame) -> DataFrame:
        """Pairs that have to be verified."""
        m1, m2 = (marks.select(F.col("id").alias(c), F.col("m").alias(f"m{c}")) for c in "ab")
        return pairs.join(m1, "a").join(m2, "b").where(_may_link("ma", "mb", join)).select("a", "b")

    stars = _few(similar(nodes.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()), most)
    links = _verified(docs, stars, join)

    # what the stars left apart: nodes of several components, compared across them
    def mixed(part: DataFrame, labels: DataFrame) -> DataFrame:
        placed = part.select("node", "id").join(labels, "id", "left").select(
            "node", "id", F.coalesce("component", "id").alias("component"))
        several = placed.groupBy("node").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("m"),
            F.bit_xor(F.xxhash64("id")).alias("x")).where("lo < hi")
        # of nodes with the same documents one is enough
        return placed.join(several.groupBy("m", "x").agg(F.min("node").alias("node")).select("node"), "node")

    labels, sizes = _labels(links), reps.select("id", "n_shingles")
    large = nodes.where(F.col("n") > join.leaf)
    sides = _sides(mixed(large, labels), most)
    if not sides.isEmpty():
        links = links.unionByName(_block_links(docs, sides, sizes, join, most, PIVOTS))
        labels = _labels(links)
        crowded = sides.where(F.col("others") > PIVOTS).select("node").distinct()
        sides = _sides(mixed(large.join(crowded, "node", "left_semi"), labels), most)
        if not sides.isEmpty():
            links = links.unionByName(_block_links(docs, sides, sizes, join, most))
            labels = _labels(links)
    apart = mixed(nodes.where(F.col("n") <= join.leaf), labels).join(marks, "id")
    x = apart.select("node", F.col("id").alias("a"), F.col("component").alias("ca"), F.col("m").alias("ma"))
    y = apart.select("node", F.col("id").alias("b"), F.col("component").alias("cb"), F.col("m").alias("mb"))
    across = x.join(y, "node").where(F.col("ca") < F.col("cb")).where(_may_link("ma", "mb", join)).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    across = _few(across.join(stars, ["a", "b"], "left_anti"), most)
    if not across.isEmpty():
        links = links.unionByName(_verified(docs, across, join))
    comps = components(links.unionByName(copies))
    return base.select("doc_id", "n_shingles").join(
        comps.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        (F.col("doc_id") == F.coalesce("component", "doc_id")).alias("kept")).withColumn(
        "kept", F.coalesce("kept", F.lit(True)))


def keep_one(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """The rows of ``docs`` without the near-duplicates of a document with a smaller id.
    Rows that repeat id and text stay once; other texts of a kept id stay, and so do
    all rows without an id."""
    found = near_duplicates(docs, join).groupBy("doc_id").agg(
        F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("doc_id is not null and (not kept or n > 1)")
    found = checkpointed(found)
    gone, often = found.where("not kept").select("doc_id"), found.where("kept").select("doc_id")

    def side(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if fits_broadcast(ids) else ids

    if often.isEmpty():
        return docs.join(side(gone), "doc_id", "left_anti").select(docs.columns)
    once = docs.join(side(found.select("doc_id")), "doc_id", "left_anti").select(docs.columns)
    repeated = docs.join(side(often), "doc_id", "left_semi").select(docs.columns)
    return once.unionByName(repeated.dropDuplicates(["doc_id", "text"]))
