"""Exact Jaccard self-join of word n-gram sets by count vectors, and the components of its links.

Two documents link when their sets have ``share`` of their union in common. Equal sets are one class.

Blocking. Sets whose sizes allow a link lie in the same or in neighbouring size classes. For a size class,
tokens are hashed into groups, more groups than two linked sets can differ in. So linked sets agree
entirely in some group, and a group's whole content is a key they share: the join loses no link. Light
groups are no keys: empty ones, and for high shares also those of one token, so that neither they nor
single tokens that many documents hold bring unrelated sets together. To keep the guarantee there are spare groups; a set with more light
groups than spare ones adds the keys of another grouping, until one has few enough.

Join. Every set is a point: how many of its tokens fall into each of a number of hash groups (a power of
two that grows with the set, so that vectors of two sizes can be folded to the smaller number). Where a key
brings sets together, an R-tree over their points bounds the overlap of two nodes, or points, by the sum of
coordinate minima of their upper corners. What survives ties sets into families. Within a family the same
tree gives the pairs to verify by intersecting the sets, surest first; pairs that are connected already are
skipped. Groups above ``GROUP`` sets are cut into blocks by hash and every two blocks are joined in a task of
their own, so no task holds an unbounded group. Only links that connect something new leave a task;
components follow from them by alternating large and small stars.

Defined results: null and empty texts and texts without words have an empty set, no links, and are their
own component. A text with fewer words than a shingle is one shingle. Rows with a null id get their set
size, no links and no component. Ids should be unique: rows that share an id and head a class count as one
document. Other columns, also of clashing names, are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import binary_values, column, release, steps, store
from docquarry.llm.shingles import mix, shingle_sets

LEAF = 32
FAN = 8
GROUP = 1024
# Edges that one task turns into stars at a time.
TASK_EDGES = 1_000_000
# Groupings that a set may add before it falls back to keys for light groups too.
GROUPINGS = 24
# Points have about one axis for so many tokens, within these numbers of axes.
TOKENS_PER_AXIS = 6
AXES = (16, 1 << 14)
# Pairs that are Python numbers at once, and coordinates of paired corners that are compared at once.
PAIRS = 1 << 16
CORNERS = 1 << 20
_CONTENT = np.uint64(0xA0761D6478BD642F)
_AXIS = np.uint64(0xE7037ED1A0B428DB)


# --- blocking ---


def most_apart(a: int, b: int, share: tuple[int, int]) -> int:
    """The most tokens in which linked sets of these sizes can differ."""
    p, q = share
    return (q - p) * (a + b) // (q + p)


@cache
def size_classes(share: tuple[int, int], largest: int) -> list[tuple[int, int, int, int, int]]:
    """(lowest size, highest size, groups, spare groups, tokens of a light group) of consecutive size classes that cover ``largest``."""
    p, q = share
    classes, low = [], 1
    while not classes or classes[-1][1] < largest:
        high = max(low, low * q // p)
        apart = most_apart(high, high, share)
        # Partners from the class before are smaller still.
        groups, light = _groups(max(1, low * p // q), apart) if apart else (1, 0)
        classes.append((low, high, groups, groups - apart - 1, light))
        low = high + 1
    return classes


def _groups(size: int, apart: int) -> tuple[int, int]:
    """The number of groups, and up to how many tokens a group is light.

    The fewest groups whose spare ones exceed the expected light ones by a deviation; groups of one token are
    light too if half as many groups again suffice for that. Small sets get what comes closest.
    """
    found, closest = (apart + 1, 0), math.inf
    for light in (1, 0):
        for groups in range(apart + 1, 3 * (apart + 1) // 2 + 3):
            mean = size / groups
            expected = math.exp(-mean) * (1 + light * mean) * groups
            away = (expected - (groups - apart - 1)) / math.sqrt(expected + 1e-9)
            if away < closest:
                found, closest = (groups, light), away
            if away <= -1:
                return groups, light
    return found


def group_keys(tokens: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The keys of a set, for its own size class and for the next, where larger partners are."""
    n = len(tokens)
    classes = size_classes(share, 1 << (n * share[1] // share[0] + 1).bit_length())
    own = next(i for i, c in enumerate(classes) if c[1] >= n)
    content = mix(tokens * _CONTENT)
    high, low = (content >> np.uint64(32)).astype(np.float64), (content & np.uint64(0xFFFFFFFF)).astype(np.float64)
    found = []
    for number in (own, own + 1):
        first, last, groups, spare, light = classes[number]
        if groups < 2 or most_apart(n, last, share) < first - n:
            continue  # linked sets are equal here, or none of that class is close enough in size
        # Of two linked sets the one that stops first has few enough light groups there, so some heavy group is
        # equal in both; the other set has added the keys of that grouping too.
        for grouping in range(GROUPINGS + 1):
            group = (mix(content + np.uint64(grouping)) % np.uint64(groups)).astype(np.int64)
            counts = np.bincount(group, minlength=groups)
            heavy = counts > light
            enough = groups - int(heavy.sum()) <= spare
            if grouping == GROUPINGS:
                heavy[:] = True
            # Sums of 32-bit halves are exact in doubles; together they stand for the group's content.
            sums = np.bincount(group, high, groups).astype(np.uint64) * _AXIS + np.bincount(group, low, groups).astype(np.uint64)
            place = np.uint64((number << 40) + (grouping << 32)) + np.arange(groups, dtype=np.uint64)
            found.append(mix(mix(sums + counts.astype(np.uint64)) + place * _CONTENT)[heavy])
            if enough:
                break
    return np.concatenate(found) if found else np.empty(0, np.uint64)


# --- points ---


def axes_of(n: int) -> int:
    return min(max(1 << (n // TOKENS_PER_AXIS).bit_length(), AXES[0]), AXES[1])


def point_of(tokens: np.ndarray) -> bytes:
    """The count vector of a set, 1 or 2 bytes a count."""
    axes = axes_of(len(tokens))
    counts = np.bincount((mix(tokens ^ _AXIS) & np.uint64(axes - 1)).astype(np.int64), minlength=axes)
    kind = "u1" if counts.max() < 256 else "<u2" if counts.max() < 65536 else "<u4"
    return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


def points_of(encoded: list[bytes]) -> np.ndarray:
    """Count vectors as a matrix, folded to the fewest axes among them."""
    vectors = [np.frombuffer(e, f"<u{e[0]}", offset=1).astype(np.int32) for e in encoded]
    axes = min(map(len, vectors))
    return np.stack([v.reshape(-1, axes).sum(0, dtype=np.int32) for v in vectors])


# --- the R-tree join ---


class Tree:
    """Points packed by size and then by their widest coordinates; each level keeps upper corners and smallest sizes."""

    def __init__(self, points: np.ndarray) -> None:
        sizes = points.sum(1)
        order = np.argsort(sizes, kind="stable")
        slab = max(LEAF, math.isqrt(len(points) * LEAF))
        packed = []
        for begin in range(0, len(order), slab):
            part = order[begin: begin + slab]
            axis = int(points[part].var(0).argmax())
            packed.append(part[np.argsort(points[part, axis], kind="stable")])
        self.order = np.concatenate(packed)
        self.levels = [(points[self.order], sizes[self.order])]
        width = LEAF
        while len(self.levels[-1][1]) > 1:
            corners, least = self.levels[-1]
            cuts = np.arange(0, len(least), width)
            self.levels.append((np.maximum.reduceat(corners, cuts), np.minimum.reduceat(least, cuts)))
            width = FAN

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the children one level below, and which of the nodes each belongs to."""
        width = LEAF if level == 1 else FAN
        every = nodes[:, None] * width + np.arange(width)
        inside = every < len(self.levels[level - 1][1])
        return every[inside], np.nonzero(inside)[0]


def candidate_pairs(left: Tree, right: Tree, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of points whose coordinate minima allow a link, and the slack of that bound; the trees may be the same."""
    p, q = share
    level = max(len(left.levels), len(right.levels)) - 1
    for tree in (left, right):  # equal heights, by repeating the root
        while len(tree.levels) <= level:
            tree.levels.append(tree.levels[-1])
    a = b = np.zeros(1, np.int64)
    while True:
        (corner_a, least_a), (corner_b, least_b) = left.levels[level], right.levels[level]
        kept, slacks = [], []
        step = max(1, CORNERS // corner_a.shape[1])
        for begin in range(0, len(a), step):
            i, j = a[begin: begin + step], b[begin: begin + step]
            bound = np.minimum(corner_a[i], corner_b[j]).sum(1, dtype=np.int64)
            slack = bound * (p + q) - p * (least_a[i] + least_b[j]).astype(np.int64)
            ok = np.flatnonzero(slack >= 0)
            kept.append(begin + ok)
            slacks.append(slack[ok])
        at = np.concatenate(kept) if kept else np.empty(0, np.int64)
        a, b = a[at], b[at]
        if level == 0:
            return left.order[a], right.order[b], np.concatenate(slacks) if slacks else at
        a, b = _descend(left, right, level, a, b)
        if left is right:
            a, b = a[a <= b], b[a <= b]
            if level == 1:
                a, b = a[a < b], b[a < b]
        level -= 1


def _descend(left: Tree, right: Tree, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of the paired nodes; a repeated root is its own child."""
    def below(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if tree.levels[level] is tree.levels[level - 1]:
            return nodes, np.arange(len(nodes))
        return tree.children(level, nodes)

    child_a, pair_a = below(left, a)
    child_b, pair_b = below(right, b)
    width_b = np.bincount(pair_b, minlength=len(b))
    first_b = np.cumsum(width_b) - width_b
    repeat = width_b[pair_a]
    ends = np.cumsum(repeat)
    total = int(ends[-1]) if len(ends) else 0
    offset = np.arange(total) - np.repeat(ends - repeat, repeat)
    return np.repeat(child_a, repeat), child_b[np.repeat(first_b[pair_a], repeat) + offset]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def linked(a: np.ndarray, b: np.ndarray, share: tuple[int, int]) -> bool:
    both = overlap(a, b)
    return share[1] * both >= share[0] * (len(a) + len(b) - both)


def near_pairs(encoded: list[bytes], split: int | None, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that the bound allows. With ``split`` only pairs of a point before it and one from it on."""
    points = points_of(encoded)
    if split is None:
        tree = Tree(points)
        return candidate_pairs(tree, tree, share)
    a, b, slack = candidate_pairs(Tree(points[:split]), Tree(points[split:]), share)
    return a, b + split, slack


def ties(ids: np.ndarray, encoded: list[bytes], split: int | None, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Edges that tie together what the bound cannot tell apart: each set and the first of its kind here."""
    a, b, _ = near_pairs(encoded, split, share)
    label = lowest_reached(a, b, len(ids))
    tied = np.flatnonzero(label != np.arange(len(ids)))
    return ids[tied], ids[label[tied]]


def links(ids: np.ndarray, sets: list[np.ndarray], split: int | None, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Verified links that connect sets not yet connected."""
    parent = list(range(len(ids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    a, b, slack = near_pairs([point_of(s) for s in sets], split, share)
    surest = np.argsort(-slack, kind="stable")
    found = []
    for first in range(0, len(surest), PAIRS):
        part = surest[first: first + PAIRS]
        for i, j in zip(a[part].tolist(), b[part].tolist()):
            one, other = root(i), root(j)
            if one != other and linked(sets[i], sets[j], share):
                parent[max(one, other)] = min(one, other)
                found.append((i, j))
    at = np.array(found, np.int64).reshape(-1, 2)
    return ids[at[:, 0]], ids[at[:, 1]]


# --- components ---


def lowest_reached(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest of ``n`` nodes that each reaches by the edges: roots take the lower root, paths are halved."""
    label = np.arange(n)
    while True:
        left, right = label[a], label[b]
        if (left == right).all():
            return label
        low = np.minimum(left, right)
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        while (label[label] != label).any():
            label = label[label]


def _as_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of a task as stars around their smallest nodes, in portions of bounded size."""
    held: list[pa.RecordBatch] = []

    def close() -> pa.RecordBatch:
        ends = np.concatenate([column(b, c).to_numpy() for c in ("u", "v") for b in held])
        nodes, place = np.unique(ends, return_inverse=True)
        label = lowest_reached(place[: len(place) // 2], place[len(place) // 2:], len(nodes))
        leaves = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.record_batch([pa.array(nodes[leaves]), pa.array(nodes[label[leaves]])], ["u", "v"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= TASK_EDGES:
            yield close()
            held = []
    if held:
        yield close()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a, b) can reach.

    First every task turns its edges into stars. What is left fits one task up to ``TASK_EDGES`` edges (16 bytes
    each), which then finishes. More edges go on in rounds: a large star ties every neighbour above a node to the
    smallest node next to it, a small star does so for the neighbours below, until nothing changes. Rounds
    grow with the logarithm of the nodes. Minima are pre-aggregated; joins back to them can be split by AQE.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    edges = store(edges.mapInArrow(_as_stars, "u long, v long"), "edges")
    before = None
    while edges.limit(TASK_EDGES + 1).count() > TASK_EDGES:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = store(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), "low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = store(large, "edges")
        low = store(large.groupBy("u").agg(F.min("v").alias("low")), "low")
        small = large.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = store(small.unionByName(low.select("u", F.col("low").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        edges = store(edges.repartition(1).mapInArrow(_as_stars, "u long, v long"), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


# --- the corpus ---


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def described(rows: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, digest, point) of every row."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            sets = shingle_sets(binary_values(column(batch, "text")), width)
            columns = [[len(s) for s in sets], [*map(_digest, sets)], [point_of(s) if len(s) else None for s in sets]]
            kinds = (pa.int64(), pa.binary(), pa.binary())
            yield pa.record_batch(
                [column(batch, "doc_id"), *map(pa.array, columns, kinds)], ["doc_id", "n_shingles", "digest", "point"]
            )
        release()

    return rows.mapInArrow(sized, "doc_id long, n_shingles long, digest binary, point binary")


def shared_keys(rows: DataFrame, width: int, share: tuple[int, int]) -> DataFrame:
    """(bucket, doc_id): the sets that a key brings together; keys of the same sets are one bucket.

    The ids of a key's sets are summed up over a window, so all ids of one key meet in a task, which spills
    them. Counting keys first and joining the repeated ones back would split them, but took more than the
    3,000 MB of an executor (see the README).
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            ids = column(batch, "doc_id").to_numpy()
            sets = shingle_sets(binary_values(column(batch, "text")), width)
            keys = [group_keys(s, share) if len(s) else np.empty(0, np.uint64) for s in sets]
            found = np.concatenate([*keys, np.empty(0, np.uint64)])
            yield pa.record_batch(
                [pa.array(found.view(np.int64)), pa.array(np.repeat(ids, [len(k) for k in keys]))], ["key", "doc_id"]
            )
        release()

    together = Window.partitionBy("key")
    hashed = F.xxhash64("doc_id")
    found = rows.mapInArrow(keyed, "key long, doc_id long").withColumns({
        "n": F.count("*").over(together),
        "sum": F.sum(hashed.bitwiseAND(0xFFFFFFFFFF)).over(together),
        "xor": F.bit_xor(hashed).over(together),
    })
    return found.where("n > 1").select(F.xxhash64("n", "sum", "xor").alias("bucket"), "doc_id").distinct()


def in_blocks(members: DataFrame, group: str, node: str) -> DataFrame:
    """The members once for every pair of blocks of their group: (group, low, high, block, node, ...), a pair's rows together."""
    blocks = members.groupBy(group).agg(F.ceil(F.count("*") / GROUP).alias("blocks"))
    rows = members.join(store(blocks.where("blocks > 1"), "blocks"), group, "left")
    rows = rows.withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(node), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")
    return rows.repartition(group, "low", "high").sortWithinPartitions(group, "low", "high", "block", node)


def pairs_of(rows: DataFrame, found_in, value: str, decode) -> DataFrame:
    """Edges (a, b) that ``found_in(ids, values, split)`` finds in each task's group of ``rows`` (see ``in_blocks``)."""
    rows = rows.select(rows.columns[0], "low", "high", "block", "doc_id", value)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, values, blocks = None, [], [], []

        def close() -> pa.RecordBatch | None:
            split = blocks.index(task[2]) if blocks[0] != blocks[-1] else None
            if len(ids) < 2 or (split is None and task[1] != task[2]):
                return None
            a, b = found_in(np.array(ids), values, split)
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for group, low, high, block, doc_id, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (group, low, high) != task:
                    if ids and (out := close()) is not None:
                        yield out
                    task, ids, values, blocks = (group, low, high), [], [], []
                ids.append(doc_id)
                values.append(decode(raw))
                blocks.append(block)
        if ids and (out := close()) is not None:
            yield out
        release()

    return rows.mapInArrow(searched, "a long, b long")


def component_ids(
    docs: DataFrame, width: int = 3, share: tuple[int, int] = (9, 10), text: str = "text", doc: str = "doc_id"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sizes = store(described(rows, width), "sets")
    named = sizes.where("n_shingles > 0 and doc_id is not null")
    classes = store(named.groupBy("digest").agg(F.min("doc_id").alias("head"), F.count("*").alias("copies")), "set_classes")

    # Rows whose set has a smaller id elsewhere, or that have none, need no keys.
    repeated = classes.where("copies > 1").select("digest", "head")
    others = named.join(repeated, "digest").where("doc_id <> head").select("doc_id").distinct()
    heads = rows.where("doc_id is not null").join(store(others, "other_copies"), "doc_id", "left_anti")
    buckets = store(shared_keys(heads, width, share), "buckets")
    points = buckets.join(named.select("doc_id", "point"), "doc_id")
    tied = pairs_of(in_blocks(points, "bucket", "doc_id"), lambda *of: ties(*of, share), "point", lambda raw: raw)
    family = store(components(tied), "families")

    members = rows.join(family.select(F.col("node").alias("doc_id"), F.col("component").alias("family")), "doc_id")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            sets = shingle_sets(binary_values(column(batch, "text")), width)
            data = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.record_batch([column(batch, "family"), column(batch, "doc_id"), data], ["family", "doc_id", "tokens"])
        release()

    sets = members.mapInArrow(tokens, "family long, doc_id long, tokens binary").where(F.octet_length("tokens") > 0)
    sets = store(sets, "family_sets")
    found = pairs_of(
        in_blocks(sets, "family", "doc_id"), lambda *of: links(*of, share), "tokens", lambda raw: np.frombuffer(raw, np.uint64)
    )
    component = store(components(found), "components")

    known = classes.join(component, F.col("head") == F.col("node"), "left").where("copies > 1 or node is not null")
    known = store(known.select("digest", F.coalesce("component", "head").alias("component")), "set_components")
    return sizes.join(known, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    )


def without_repeats(
    docs: DataFrame, width: int = 5, share: tuple[int, int] = (4, 5), text: str = "text", doc: str = "doc_id"
) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Rows without an id all stay. Of rows that repeat an id one stays.
    """
    found = component_ids(docs, width, share, text, doc).where("doc_id is not null")
    # A name that the documents do not have.
    name = "own_id"
    while name in docs.columns:
        name += "_"
    found = store(found.select(F.col("doc_id").alias(name), "component_id"), "component_ids")
    gone = store(found.where(F.col(name) != F.col("component_id")).select(name).distinct(), "repeats")
    twice = store(found.groupBy(name).agg(F.count("*").alias("copies")).where("copies > 1").select(name), "repeated_ids")
    own_id = docs[doc].cast("long") == F.col(name)
    kept = docs.join(gone, own_id, "left_anti")
    if twice.isEmpty():
        return kept
    repeated = kept.join(twice, own_id, "left_semi").dropDuplicates([doc])
    return kept.join(twice, own_id, "left_anti").unionByName(repeated)
