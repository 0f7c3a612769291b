"""Approximate nearest neighbours by learned partitions.

Fit, in one task on a bounded sample: the exact neighbour graph of three quarters of the sample is cut into
balanced parts by recursive bisection (the graph's slowest varying vector, split at its median, then swaps that
cut fewer edges). A softmax classifier with one hidden layer learns, from a vector, the shares of its neighbours
in each part. The number of parts that a query visits is the smallest that finds ``RECALL`` of the neighbours of
the quarter that was held back.

Index and search, on all rows: the classifier sends every vector to its most probable part, and a query to
its most probable parts, where exact double-precision distances rank the candidates. Equal vectors are
one point with their smallest ids, as no more of them can be among the nearest. Parts are searched in groups of
neighbouring parts, up to ``CELL_ROWS`` points together, and a query gives one list of its nearest per group, of
the parts in it that it visits. Parts with more points, and groups with many queries, are split by hash into cells
of bounded size, so no task holds an unbounded group.

Defined results: vectors that are null, empty, zero, of another length than the most common one, or with
null or non-finite components take no part, nor do rows without an id. Ties go to the smaller id. A row never
finds its own id; repeated ids count as one row each, so a repeated id is found once per row by others,
and a repeated query is answered once. Distances of huge vectors that a double cannot hold are infinite, and ranked
by id.
Fewer candidates than asked for give fewer rows. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import column, store

SAMPLE = 8192
GRAPH = 10
PART_ROWS = 128
MOST_PARTS = 256
HIDDEN = 64
RECALL = 0.98
# Above it squares of components may not fit a double.
HUGE = 1e100
CELL_ROWS = 16_384
CELL_QUERIES = 2048
NEAREST = 10


class Router(NamedTuple):
    unit: float  # a power of two that brings huge components down
    mean: np.ndarray
    scale: float
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    probes: int


# --- fit ---


def neighbour_graph(vectors: np.ndarray, k: int, queries: np.ndarray | None = None) -> np.ndarray:
    """The ``k`` nearest vectors of each query, in blocks; without queries the nearest others of each vector."""
    squares = (vectors**2).sum(1)
    asked, found = vectors if queries is None else queries, []
    for begin in range(0, len(asked), 256):
        far = squares - 2 * asked[begin: begin + 256] @ vectors.T
        if queries is None:
            far[np.arange(len(far)), begin + np.arange(len(far))] = np.inf
        found.append(np.argpartition(far, k - 1, axis=1)[:, :k])
    return np.concatenate(found)


def bisect(members: np.ndarray, graph: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of the members (sizes differ by one at most) that cut few edges of the graph."""
    place = np.full(len(graph), -1)
    place[members] = np.arange(len(members))
    source = np.repeat(np.arange(len(members)), graph.shape[1])
    target = place[graph[members].ravel()]
    source, target = source[target >= 0], target[target >= 0]
    left, right = np.concatenate([source, target]), np.concatenate([target, source])
    degree = np.bincount(left, minlength=len(members)) + 1.0
    value = rng.standard_normal(len(members))
    for _ in range(60):  # smoothing, with the constant removed, leaves the slowest varying vector
        value = (value + np.bincount(left, value[right], len(members))) / degree
        value -= value @ degree / degree.sum()
        value /= np.abs(value).max() or 1.0
    side = np.zeros(len(members), bool)
    side[np.argsort(value, kind="stable")[len(members) // 2:]] = True
    for _ in range(10):
        across = np.bincount(left, side[left] != side[right], len(members))
        gain = 2 * across - (degree - 1)
        a, b = (np.flatnonzero(side == s) for s in (False, True))
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        n = int(np.argmax(np.append(gain[a[: len(b)]] + gain[b[: len(a)]] <= 0, True)))
        n = (n + 1) // 2  # neighbours on both sides that swap together gain less; half of them is safe
        if not n:
            break
        before = (side[left] != side[right]).sum()
        swapped = side.copy()
        swapped[a[:n]], swapped[b[:n]] = True, False
        if (swapped[left] != swapped[right]).sum() >= before:
            break
        side = swapped
    return members[~side], members[side]


def balanced_parts(graph: np.ndarray, n_parts: int, seed: int = 3) -> np.ndarray:
    """The part of each vertex; ``n_parts`` is a power of two."""
    rng = np.random.default_rng(seed)
    groups = [np.arange(len(graph))]
    while len(groups) < n_parts:
        groups = [half for g in groups for half in bisect(g, graph, rng)]
    part = np.empty(len(graph), np.int64)
    for i, group in enumerate(groups):
        part[group] = i
    return part


def _forward(layers, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(x @ layers[0] + layers[1], 0)
    logits = hidden @ layers[2] + layers[3]
    chances = np.exp(logits - logits.max(1, keepdims=True))
    return hidden, chances / chances.sum(1, keepdims=True)


def _unit(vectors: np.ndarray) -> float:
    most = float(np.abs(vectors).max(initial=0.0))
    return 1.0 if most < HUGE else 2.0 ** -int(np.log2(most))


def _inputs(vectors: np.ndarray, unit: float, mean: np.ndarray, scale: float) -> np.ndarray:
    return np.clip((vectors * unit - mean) / scale, -1e4, 1e4).astype(np.float32)


def chances(router: Router, vectors: np.ndarray) -> np.ndarray:
    return _forward(router.layers, _inputs(vectors, router.unit, router.mean, router.scale))[1]


def fit(vectors: np.ndarray, n_rows: int, seed: int = 3, epochs: int = 40) -> Router:
    """The router of ``n_rows`` vectors, from a sample of them."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(vectors))
    held, taught = np.split(order, [len(order) // 4])
    wanted = max(1, min(n_rows // PART_ROWS, MOST_PARTS, len(taught) // 24))
    n_parts = 1 << (wanted.bit_length() - 1)
    unit = _unit(vectors)
    mean = (vectors * unit).mean(0)
    scale = float((vectors * unit - mean).std()) or 1.0
    x = _inputs(vectors[taught], unit, mean, scale)
    layers = [
        rng.standard_normal((x.shape[1], HIDDEN)) * np.sqrt(2 / x.shape[1]), np.zeros(HIDDEN),
        rng.standard_normal((HIDDEN, n_parts)) * np.sqrt(1 / HIDDEN), np.zeros(n_parts),
    ]
    layers = [w.astype(np.float32) for w in layers]
    if n_parts == 1:
        return Router(unit, mean, scale, tuple(layers), 1)
    k = min(GRAPH, len(x) - 1)
    graph = neighbour_graph(x, k)
    part = balanced_parts(graph, n_parts)
    target = np.zeros((len(x), n_parts), np.float32)
    np.add.at(target, (np.repeat(np.arange(len(x)), k), part[graph.ravel()]), 1 / (k + 1))
    target[np.arange(len(x)), part] += 1 / (k + 1)
    steps = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    t = 0
    for epoch in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            t += 1
            hidden, guess = _forward(layers, x[rows])
            error = (guess - target[rows]) / len(rows)
            back = (error @ layers[2].T) * (hidden > 0)
            slopes = [x[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(0)]
            for w, g, m, v in zip(layers, slopes, *steps):  # Adam
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (1 - epoch / epochs) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    # How many parts a held-back query must visit to meet its neighbours, each in its most probable part.
    home = _forward(layers, x)[1].argmax(1)
    asked = _inputs(vectors[held], unit, mean, scale)
    rank = np.argsort(np.argsort(-_forward(layers, asked)[1], axis=1, kind="stable"), axis=1)
    near = neighbour_graph(x, k, asked)
    needed = np.sort(rank[np.repeat(np.arange(len(asked)), k), home[near.ravel()]])
    probes = int(needed[min(len(needed) - 1, int(RECALL * len(needed)))]) + 1
    return Router(unit, mean, scale, tuple(layers), probes)


# --- rows ---


def _matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)


def usable(rows: DataFrame, vector: str, ident: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    v = F.col("vector")
    found = rows.select(F.col(ident).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    found = found.where(F.col("vec_id").isNotNull() & v.isNotNull() & fine)
    length = found.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return found.where(F.size(v) == (length["n"] if length else 0))


def nearest_in_cell(
    points: np.ndarray, point_ids: np.ndarray, queries: np.ndarray, k: int, visited: list[np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the ``k`` visited points of the smallest exact distance, ties to the smaller id, and the distances."""
    # A power of two changes no digit of a distance.
    unit = min(_unit(points), _unit(queries))
    points, queries = points * unit, queries * unit
    squares = (points**2).sum(1)
    for query, near in zip(queries, visited):
        if len(near) > k and unit == 1.0:
            # The expanded form loses digits, so everything near its k-th value is measured exactly.
            far = (squares - 2 * (points @ query))[near]
            limit = np.partition(far, k - 1)[k - 1] + 1e-9 * (float(query @ query) + float(squares.max()))
            near = near[far <= limit]
        with np.errstate(over="ignore"):
            exact = np.sqrt(((points[near] - query) ** 2).sum(1)) / unit
        best = np.lexsort((point_ids[near], exact))[:k]
        yield point_ids[near[best]], exact[best]


def search(
    rows: DataFrame, is_query: str, k: int = NEAREST, vector: str = "embedding", ident: str = "vec_id", sample: int = SAMPLE
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for every row that ``is_query`` (SQL over vec_id) names."""
    spark = rows.sparkSession
    # A point is a vector with its k + 1 smallest distinct ids: one may be the query's own. Repeated rows are counted
    # first, so that they take no places. The limit applies before the shuffle too.
    every = usable(rows, vector, ident).groupBy("vector", "vec_id").agg(F.count("*").alias("copies"))
    every = store(every, "vectors")
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    points = every.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("vector")
    points = points.agg(F.min("vec_id").alias("point"), F.sort_array(F.collect_list(F.struct("vec_id", "copies"))).alias("ids"))
    points = store(points.select("point", "vector", "ids"), "points")
    n_points = points.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n_points:
        return spark.createDataFrame([], schema)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = [_matrix(column(batch, "vector")) for batch in batches if batch.num_rows]
        if vectors:
            yield pa.record_batch([pa.array([pickle.dumps(fit(np.concatenate(vectors), n_points))], pa.binary())], ["router"])

    taught = points.orderBy(F.xxhash64("point"), "point").limit(sample).select("vector")
    found = taught.coalesce(1).mapInArrow(fitted, "router binary").first()
    router = spark.sparkContext.broadcast(bytes(found["router"]))  # bounded by the number of parts

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pickle.loads(router.value)
        for batch in batches:
            if batch.num_rows:
                order = np.argsort(-chances(known, _matrix(column(batch, "vector"))), axis=1, kind="stable")
                parts = pa.array(list(order[:, : known.probes].astype(np.int32)), pa.list_(pa.int32()))
                yield pa.record_batch([*batch.columns, parts], [*batch.schema.names, "parts"])

    # Which points the queries are; a vector that many queries share is searched once.
    asked = every.where(is_query).select("vec_id", "vector")
    asked = store(asked.join(points.select("point", "vector"), "vector").select(F.col("vec_id").alias("query_id"), "point"), "asked")
    asking = asked.select("point").distinct().withColumn("asks", F.lit(True))
    placed = points.join(asking, "point", "left").select("point", "vector", F.coalesce("asks", F.lit(False)).alias("asks"))
    placed = store(placed.mapInArrow(routed, "point long, vector array<double>, asks boolean, parts array<int>"), "placed")

    held = placed.groupBy(F.get("parts", F.lit(0)).alias("part")).agg(F.count("*").alias("n"))
    visits = placed.where("asks").select(F.explode("parts").alias("part")).groupBy("part").agg(F.count("*").alias("q"))
    sizes = {r["part"]: (r["n"], r["q"]) for r in held.join(visits, "part").collect()}  # one row per part
    # Neighbouring parts go together while they fit; per group its row cells and query cells.
    group_of, groups, full = {}, [], CELL_ROWS
    for part, (n, q) in sorted(sizes.items()):
        if full + n > CELL_ROWS:
            groups.append([0, 0])
            full = 0
        full += n
        group_of[part] = len(groups) - 1
        groups[-1] = [groups[-1][0] + n, groups[-1][1] + q]
    if not groups:
        return spark.createDataFrame([], schema)
    group = F.array(*[F.lit(group_of.get(part, -1)) for part in range(max(sizes) + 1)])
    row_cells = F.array(*[F.lit(-(-n // CELL_ROWS)) for n, _ in groups])
    query_cells = F.array(*[F.lit(-(-q // CELL_QUERIES)) for _, q in groups])
    salt, part = F.xxhash64("point"), F.get("parts", F.lit(0))
    stored = placed.withColumn("group", F.get(group, part)).where("group >= 0")
    stored = stored.select(
        "group", F.pmod(salt, F.get(row_cells, "group")).alias("row_cell"),
        F.explode(F.sequence(F.lit(0), F.get(query_cells, "group") - 1)).alias("query_cell"),
        "point", "vector", F.array(part).alias("parts"), F.lit(False).alias("asks"),
    )
    met = F.array_distinct(F.filter(F.transform("parts", lambda p: F.get(group, p)), lambda g: g >= 0))
    visiting = placed.where("asks").withColumn("group", F.explode(met)).select(
        "group", F.explode(F.sequence(F.lit(0), F.get(row_cells, "group") - 1)).alias("row_cell"),
        F.pmod(salt, F.get(query_cells, "group")).alias("query_cell"), "point", "vector", "parts", F.lit(True).alias("asks"),
    )

    def ranked(cell: pa.Table) -> pa.Table:
        asks = cell["asks"].to_numpy()
        ids = cell["point"].to_numpy()
        vectors = _matrix(cell["vector"].combine_chunks())
        parts = cell["parts"].to_pylist()
        own, found = ids[~asks], []
        if len(own):
            part_of = np.array([p[0] for p, asked in zip(parts, asks.tolist()) if not asked])
            visited = [np.flatnonzero(np.isin(part_of, p)) for p, asked in zip(parts, asks.tolist()) if asked]
            found = list(nearest_in_cell(vectors[~asks], own, vectors[asks], k + 1, visited))
        query = np.repeat(ids[asks], [len(f[0]) for f in found]) if found else own[:0]
        hits = np.concatenate([f[0] for f in found]) if found else own[:0]
        far = np.concatenate([f[1] for f in found]) if found else np.empty(0)
        return pa.table({"query": query, "hit": hits, "score": far})

    cells = stored.unionByName(visiting).groupBy("group", "row_cell", "query_cell")
    hits = cells.applyInArrow(ranked, "query long, hit long, score double")
    best = F.row_number().over(Window.partitionBy("query").orderBy("score", "hit"))
    hits = hits.withColumn("nth", best).where(F.col("nth") <= k + 1).drop("nth")
    hits = hits.join(points.select(F.col("point").alias("hit"), "ids"), "hit").select("query", "score", F.inline("ids"))
    best = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    hits = hits.withColumn("nth", best).where(F.col("nth") <= k + 1).select(F.col("query").alias("point"), "score", "vec_id", "copies")
    answers = asked.join(store(hits, "hits"), "point").where("query_id <> vec_id")
    # Only now an id takes a place for each of its rows.
    places = F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k)))).alias("copy")
    answers = answers.select("query_id", "vec_id", "score", places)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
