"""N-gram Jaccard join with a MinHash LSH forest.

Documents are sets of word five-grams. Every tree of the forest sorts the sets by a signature of MinHash values:
sets with a common prefix are neighbours, the nodes of a trie. One walk along the sorted entries
connects the sets of all its nodes, at all depths. Sets that share a node of the full depth in some tree are
candidates first, and are verified exactly, by counting common five-grams.

The matched prefix is then shortened as the links found demand. A link of similarity s shares a node of depth d
in some of t trees with the probability 1 - (1 - s**d)**t. So the links found say how many there are of each
similarity, and how many of them every depth misses. The next depth is the longest that misses few enough for the
target recall, and at the shortest one even links at the threshold are as good as all found. A corpus of close
copies stops early, one with links near the threshold goes on. Only components that have grown are compared
again.

No pair is ever a row. Equal sets are one class first, so copies cost nothing. Classes that meet, in
whatever tree, form candidate components; a component is compared in one task, or, cut into blocks, in
one task for each pair of blocks. A task hands back one row for each class with a link: the number of
its links, the least class it is connected with, and how close its links are. Components beyond ``large``
classes (chains through passages that many documents share) are compared tree by tree instead, only where
prefixes match, and a pair counts in the first tree where it meets.

Cases: null texts and texts without words link with nothing; texts of fewer than five words are one
gram, the whole text. Texts of any length are read whole. Repeated rows are copies of each other. Ids may be null
or repeated. Ties for the first document of a group go to the row read first. An empty table gives an empty
result. Columns that have the name of a column added here are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.llm.tables import stored, without, words

MIXER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Forest:
    gram: int = 5
    # Links have common / all >= threshold_of[0] / threshold_of[1].
    threshold_of: tuple[int, int] = (4, 5)
    trees: int = 24
    depth: int = 8
    target_recall: float = 0.99999
    # With fewer links than this, what they say about others is not relied on.
    least_links: int = 200
    seed: int = 20
    # Classes in a block, and in a component that is compared as a whole.
    block: int = 512
    large: int = 8192
    # Classes whose texts are looked up by a broadcast of their row numbers; more take a shuffle join.
    broadcast_classes: int = 500_000

    def missed(self, similarity: np.ndarray | float, depth: int) -> np.ndarray | float:
        """The probability that sets share no node of that depth."""
        return (1 - np.asarray(similarity) ** depth) ** self.trees

    def least_depth(self) -> int:
        """The longest prefix at which sets at the threshold meet with the target recall."""
        s = self.threshold_of[0] / self.threshold_of[1]
        depth = self.depth
        while depth > 1 and self.missed(s, depth) > 1 - self.target_recall:
            depth -= 1
        return depth

    def next_depth(self, depth: int, links: np.ndarray) -> int | None:
        """The depth to go on with after ``depth``, or None to stop: ``links`` counts the links found by
        similarity, in equal bins from the threshold to 1."""
        if depth <= self.least_depth():
            return None
        if links.sum() < self.least_links:
            return self.least_depth()
        s = self.threshold_of[0] / self.threshold_of[1]
        # The lowest similarity of each bin, so that the estimate errs to the side of more.
        similarity = s + (1 - s) * np.arange(len(links)) / len(links)
        there = links / (1 - self.missed(similarity, depth))
        for d in range(depth, self.least_depth(), -1):
            if (there * self.missed(similarity, d)).sum() <= (1 - self.target_recall) * there.sum():
                return d if d < depth else None
        return self.least_depth()


DEFAULT = Forest()
ADDED = ("class_id", "n_links", "is_first")
# Bins of similarity that links are counted in.
BINS = 20


def gram_hashes(text: str | None, gram: int) -> np.ndarray:
    """Sorted distinct 64 bit hashes of the word n-grams; of the whole text if it is shorter."""
    tokens = words(text)
    if not tokens:
        return np.zeros(0, np.uint64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in tokens], np.uint64)
    size = min(gram, len(tokens))
    mixed = np.full(len(tokens) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k : len(tokens) - size + 1 + k]) * MIXER
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _multipliers(forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(forest.seed)
    n = forest.trees * forest.depth
    draw = lambda: rng.integers(0, 2**63, (n, 1), dtype=np.uint64)
    return draw() * np.uint64(2) + np.uint64(1), draw()


def signature(grams: np.ndarray, by: tuple[np.ndarray, np.ndarray]) -> bytes:
    """The MinHash values of all trees, 16 mixed bits of each, those of a tree together."""
    least = np.full(len(by[0]), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 1024):
        hashed = grams[at : at + 1024] * by[0]
        hashed += by[1]
        np.minimum(least, hashed.min(axis=1), out=least)
    return (least * MIXER >> np.uint64(48)).astype(np.uint16).tobytes()


def sign(docs: DataFrame, text: str, forest: Forest) -> DataFrame:
    """``docs`` with ``_set`` (a digest of the set; null without words) and ``_signature``."""
    kept = docs.schema.fields
    added = [T.StructField("_set", T.BinaryType()), T.StructField("_signature", T.BinaryType())]
    schema = T.StructType([*kept, *added])
    names = [f.name for f in kept]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = _multipliers(forest)
        for batch in batches:
            sets, signatures = [], []
            for t in batch.column(text).to_pylist():
                grams = gram_hashes(t, forest.gram)
                sets.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                signatures.append(signature(grams, by) if len(grams) else None)
            columns = [pa.array(sets, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *columns], schema.fieldNames())

    return docs.mapInArrow(signed, schema)


def _prefix(tree: Column, depth: int, forest: Forest) -> Column:
    """The first ``depth`` values of a tree."""
    return F.substring("signature", tree * (2 * forest.depth) + 1, F.lit(2 * depth))


def trie_edges(classes: DataFrame, forest: Forest) -> DataFrame:
    """``a``, ``b``, ``depth``: the edges of at least some depth connect the classes that share a node of
    that depth in some tree.

    The entries of all trees (class, signature of the tree) are sorted together, over any number of
    tasks: a node that many classes share may span several. Along the sorted entries, each is connected with
    the first of those with which it has as much in common as with the one before it; so the edges of a
    node are stars, as many as levels below it. The ends of neighbouring tasks are compared afterwards.
    """
    spark, least, depth = classes.sparkSession, forest.least_depth(), forest.depth
    trees = F.transform(F.sequence(F.lit(0), F.lit(forest.trees - 1)), lambda t: _prefix(t, depth, forest))
    entries = classes.select("node", F.posexplode(trees).alias("tree", "prefix"))
    order = ["tree", "prefix", "node"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = entries.select(order).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ends: list[tuple] = []  # (tree, prefix, class) of the first entry and of the last so far
        starts = np.zeros(depth + 1, np.int64)  # the class that the current run of each depth began with
        for batch in batches:
            if not len(batch):
                continue
            tree, node = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            data = batch.column(1).to_pylist()
            before = ends[-1] if ends else (-1, data[0], -1)
            values = np.frombuffer(b"".join([before[1], *data]), np.uint16).reshape(-1, depth)
            same = (values[1:] == values[:-1]) & (tree == np.append(before[0], tree[:-1]))[:, None]
            common = np.cumprod(same, axis=1).sum(axis=1)
            first = np.empty(len(node), np.int64)
            for d in range(least, depth + 1):
                begins = np.maximum.accumulate(np.where(common < d, np.arange(len(node)), -1))
                start = np.where(begins < 0, starts[d], node[begins])
                starts[d] = start[-1]
                first = np.where(common == d, start, first)
            entry = lambda i: (int(tree[i]), data[i], int(node[i]))  # noqa: B023, E731
            ends = [ends[0] if ends else entry(0), entry(-1)]
            linked = common >= least
            yield _edge_rows(node[linked], first[linked], common[linked])
        for turn, (t, prefix, n) in enumerate(ends):
            yield _edge_rows([n], [turn], [t], prefix, part)

    schema = "a long, b long, depth int, part int, prefix binary"
    walked = stored(ordered.mapInArrow(walk, schema), "trie")
    # Two rows for each task. For these, b tells the first from the last, and depth is the tree.
    found = sorted(walked.where("part is not null").collect(), key=lambda r: (r["part"], r["b"]))
    across = []
    for last, first in zip(found[1::2], found[2::2], strict=False):
        x, y = (np.frombuffer(bytes(r["prefix"]), np.uint16) for r in (last, first))
        common = int(np.cumprod(x == y).sum()) if last["depth"] == first["depth"] else 0
        if common >= least:
            across.append((first["a"], last["a"], common))
    stitched = spark.createDataFrame(across, "a long, b long, depth int")
    return walked.where("part is null").select("a", "b", "depth").unionByName(stitched)


def _edge_rows(a, b, depth, prefix: bytes | None = None, part: int | None = None) -> pa.RecordBatch:
    n = len(a)
    columns = [
        pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(depth, pa.int32()),
        pa.array([part] * n, pa.int32()), pa.array([prefix] * n, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "depth", "part", "prefix"])


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node connected with it) for every node of ``edges`` (a, b) that
    is not a root itself.

    Alternating stars: every node points its larger neighbours, then its smaller ones, to the least of
    them, until nothing changes. Rounds are written to the shared folder and grow with the logarithm of
    the length of chains.
    """
    state = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    summary = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")]
    before = state.agg(*summary).first()
    while before["n"]:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that both sides of the join are shuffled for it, and adaptive execution can split the
        # edges of a node that a large part of all nodes points to.
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pointed = F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        small = large.join(least, "u").select(pointed.alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        state = stored(small, "edges")
        now = state.agg(*summary).first()
        if now == before:
            break
        before = now
    return state.select(F.col("u").alias("node"), F.col("v").alias("root"))


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each pair of sets has in common: blocks of a 0/1 matrix times itself."""
    n = len(sets)
    if n == 2:
        both = np.intersect1d(sets[0], sets[1], assume_unique=True).size
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    chosen = shared[column]
    row, column = row[chosen], number[column[chosen]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    # Each product is exact in float32, their sum in float64.
    total = np.zeros((n, n))
    width = max(256, 4_000_000 // n)
    last = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, last, width):
        a, b = np.searchsorted(column, (at, at + width))
        dense = np.zeros((n, min(width, last - at)), np.float32)
        dense[row[a:b], column[a:b] - at] = 1
        total += dense @ dense.T
    return total.astype(np.int64)


def _roots(link: np.ndarray) -> np.ndarray:
    """The least index connected with each index of a symmetric boolean matrix."""
    n = len(link)
    root = np.arange(n)
    seen = np.zeros(n, bool)
    for start in range(n):
        if seen[start]:
            continue
        front = np.zeros(n, bool)
        front[start] = True
        reached = front.copy()
        while front.any():
            front = link[front].any(axis=0) & ~reached
            reached |= front
        root[reached] = start
        seen |= reached
    return root


def compare(node, block, copies, sets, keys, tree: int, forest: Forest):
    """One task: (nodes with links, links of each, least connected node of each, classes linked with each by
    similarity).

    Rows of equal blocks are compared with each other only if the task has one block. ``keys`` are
    needed where ``tree`` is not negative: pairs that meet in an earlier tree are left to that.
    """
    order = np.argsort(node, kind="stable")
    order = order[np.unique(node[order], return_index=True)[1]]
    node, block, copies = node[order], block[order], copies[order]
    sets = [sets[i] for i in order]
    size = np.array([len(s) for s in sets], np.int64)
    common = common_counts(sets) if len(sets) > 1 else np.zeros((1, 1), np.int64)
    part, whole = forest.threshold_of
    link = (part + whole) * common >= part * (size[:, None] + size[None, :])
    np.fill_diagonal(link, False)
    if block.min() != block.max():
        link &= block[:, None] != block[None, :]
    if tree >= 0:
        table = np.stack([keys[i] for i in order])
        link &= table[:, None, tree] == table[None, :, tree]
        for t in range(tree):
            link &= table[:, None, t] != table[None, :, t]
    linked = link.any(axis=1)
    near = np.zeros((len(node), BINS), np.int64)
    least = part / whole
    # A few rows at a time: in a group of close copies every pair is a link.
    for a in range(0, len(node), 64):
        i, j = np.nonzero(link[a : a + 64])
        both = common[a : a + 64][i, j]
        similarity = both / (size[a + i] + size[j] - both)
        at = np.clip(((similarity - least) / (1 - least) * BINS).astype(np.int64), 0, BINS - 1)
        near[a : a + 64] = np.bincount(i * BINS + at, minlength=len(link[a : a + 64]) * BINS).reshape(-1, BINS)
    return node[linked], (link @ copies)[linked], node[_roots(link)][linked], near[linked]


def _tasks(group: list[Column], size: Column, forest: Forest) -> list[Column]:
    """Columns that deal a class to the tasks of its group: one for each pair with its block."""
    blocks = F.ceil(size / F.lit(forest.block)).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda j: F.struct(F.least(own, j).alias("low"), F.greatest(own, j).alias("high"), own.alias("block")),
    )
    return [*group, F.explode(pairs).alias("pair")]


TASK = ["tree", "key", "low", "high"]


def verified(tasks: DataFrame, forest: Forest) -> DataFrame:
    """``tasks`` compared: node, links, root. Rows of a task are neighbours after a sort, and a task
    is bounded by two blocks, so groups are cut out of the stream."""
    names = [*TASK, "block", "node", "copies", "text", "keys"]
    schema = "node long, links long, root long, near array<int>"

    def finish(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        sets = [gram_hashes(t, forest.gram) for t in columns[7]]
        tree = columns[0][0]
        keys = [np.array(k) for k in columns[8]] if tree >= 0 else None
        numbers = [np.array(columns[i], np.int64) for i in (5, 4, 6)]
        *found, near = compare(*numbers, sets, keys, tree, forest)
        columns = [*(pa.array(f.astype(np.int64)) for f in found), pa.array(list(near.astype(np.int32)), pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, ["node", "links", "root", "near"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if open_rows and row[:4] != open_rows[0][:4]:
                    if len(open_rows) > 1:
                        yield finish(open_rows)
                    open_rows = []
                open_rows.append(row)
        if len(open_rows) > 1:
            yield finish(open_rows)

    return tasks.select(names).repartition(*TASK).sortWithinPartitions(*TASK).mapInArrow(compared, schema)


def _texts(signed: DataFrame, text: str, wanted: DataFrame, forest: Forest) -> DataFrame:
    """``wanted`` (node, first_row, ...) with the text of one document of each class, found by its row
    number: ids may be null or repeated any number of times."""
    if wanted.count() <= forest.broadcast_classes:
        wanted = F.broadcast(wanted)
    texts = signed.select("_row", F.col(f"`{text}`").alias("text"))
    return texts.join(wanted, F.col("_row") == F.col("first_row")).drop("_row", "first_row")


def _candidates(edges: DataFrame, before: DataFrame | None, forest: Forest) -> DataFrame:
    """``node``, ``root``, ``size`` of the components of ``edges``, and whether they have ``grown``: they are
    not one of the components ``before``, or they are so large that they were not compared as a whole."""
    roots = components(edges)
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    if before is None:
        members = members.withColumn("old", F.col("node"))
    else:
        members = members.join(before.select("node", F.col("root").alias("old")), "node", "left")
        members = members.withColumn("old", F.coalesce("old", "node"))
    facts = members.groupBy("root").agg(
        F.count(F.lit(1)).alias("size"), ((F.min("old") != F.max("old")) | (F.count(F.lit(1)) > forest.large)).alias("grown")
    )
    return stored(members.drop("old").join(facts, "root"), "candidates")


def _compared(candidates: DataFrame, classes: DataFrame, signed: DataFrame, text: str, depth: int, forest: Forest) -> DataFrame:
    """The links of the candidates: node, links, root, near."""
    wanted = stored(candidates.join(classes.select("node", "first_row", "copies", "signature"), "node"), "wanted")
    small = wanted.where(F.col("size") <= forest.large).drop("signature")
    tasks = _texts(signed, text, small, forest).select(
        "node", "copies", "text", F.lit(None).cast("array<bigint>").alias("keys"),
        *_tasks([F.lit(-1).alias("tree"), F.col("root").alias("key")], F.col("size"), forest),
    )
    large = wanted.where(F.col("size") > forest.large)
    if not large.isEmpty():
        # Only where prefixes match: the nodes of this depth, each a group of its own.
        keys = F.transform(F.sequence(F.lit(0), F.lit(forest.trees - 1)), lambda t: F.xxhash64(_prefix(t, depth, forest)))
        large = stored(large.withColumn("keys", keys).drop("signature"), "large")
        members = large.select("node", F.posexplode("keys").alias("tree", "key"))
        groups = members.groupBy("tree", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = members.join(groups, ["tree", "key"])
        parts = met.join(_texts(signed, text, large, forest).select("node", "copies", "text", "keys"), "node").select(
            "node", "copies", "text", "keys", *_tasks([F.col("tree"), F.col("key")], F.col("n"), forest)
        )
        tasks = tasks.unionByName(parts)
    return stored(verified(tasks.select("*", "pair.*"), forest), "links")


def linked_classes(classes: DataFrame, signed: DataFrame, text: str, forest: Forest = DEFAULT) -> tuple[DataFrame, int]:
    """(node, links, root, near of every class with a link; the depth at which matching stopped)."""
    edges = trie_edges(classes, forest)
    depth, before, found = forest.depth, None, None
    while True:
        candidates = _candidates(edges.where(F.col("depth") >= depth).select("a", "b"), before, forest)
        grown = candidates if before is None else candidates.where("grown")
        new = _compared(grown, classes, signed, text, depth, forest)
        found = new if found is None else found.join(grown.select("node"), "node", "left_anti").unionByName(new)
        sums = found.agg(*[F.coalesce(F.sum(F.get("near", F.lit(i))), F.lit(0)).alias(f"n{i}") for i in range(BINS)]).first()
        # Each link is seen from both its ends.
        shorter = forest.next_depth(depth, np.array(sums, np.float64) / 2)
        if shorter is None:
            return found, depth
        depth, before = shorter, candidates


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    forest: Forest = DEFAULT,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` (without the text, unless ``keep_text``) with ``class_id``, the least id among all
    documents connected by links, ``n_links``, the number of documents it has a link with, copies
    included, and ``is_first``, true for one document of each such group (one with the least id).
    Documents without words have their own id and no links and are first."""
    docs = without(docs, (*ADDED, "_set", "_signature", "_row"))
    # The texts are stored with their row numbers, even if they are not handed back: see ``_texts``.
    signed = sign(docs, text, forest).withColumn("_row", F.monotonically_increasing_id())
    signed = stored(signed, "signed", compression="zstd")
    order = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), "_row")
    classes = (
        signed.where("_set is not null")
        .groupBy("_set")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("_signature").alias("signature"))
        .select("_set", "first", F.col("first._row").alias("first_row"), "copies", "signature")
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = stored(classes, "classes")
    found, _ = linked_classes(classes, signed, text, forest)
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("_set", "node", "first", "copies").join(linked, "node", "left").join(links, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    result = named.join(least, "root").select(
        "_set", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = [F.col(f"`{c}`") for c in docs.columns if keep_text or c != text]
    alone = F.col("_set").isNull()
    return signed.drop("_signature").join(result, "_set", "left").select(
        *out,
        F.when(alone, F.col(doc_id)).otherwise(F.col("least.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | (F.col("_row") == F.col("least._row"))).alias("is_first"),
    )
