"""One linear SVM per label, fitted together, and margins for whole tables.

Each label minimises ``0.5 * (|w|^2 + b^2) + C * sum(max(0, 1 - y * (w.x + b))^2)``. The rows become
sparse blocks once, in row order and in feature order, and stay cached. In each pass executors compute
loss and gradient of all labels over their blocks, Spark adds the parts up by label, and the driver
takes a quasi-Newton step.

All labels share their curvature: a label's Hessian is ``1 + 2 C X'X`` over the rows inside its
margin. A few passes of Hessian-vector products, on a block of vectors at once, span a space in which
``X'X`` is known (block Lanczos). Each label's steps start from the inverse of the Hessian that it
and the label's share of rows inside the margin imply, and L-BFGS pairs correct the rest, so few
passes are needed.

Driver and task hold matrices of labels x vocabulary, both bounded by settings (100 x 50,000 doubles
are 40 MB); the driver also keeps two such matrices for each of the last ten steps, and the
``CURVATURE * DEPTH`` vectors of the shared curvature (288 x 50,000 doubles are 115 MB).
"""

from __future__ import annotations

import sys
import warnings
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.config import DEFAULTS, Settings

# The functions below that run in tasks travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows a task turns into one dense matrix at a time.
BLOCK_ROWS = 8

# Entries and rows of a sparse block; a row with more entries is a block of its own. Products make a block dense, which
# these bound: longer blocks share more features, and have more empty cells.
BLOCK_ENTRIES = 1 << 12
DENSE_ROWS = 1 << 9

# Vectors of the shared curvature that a pass multiplies, and passes that add as many to the space.
CURVATURE = 48
DEPTH = 6

# Past steps that all labels keep together, and that one keeps at most: fewer labels remember more.
STEPS = 270
LONGEST = 40

# Part of a new direction, relative to the largest eigenvalue, that is taken for rounding.
ROUNDING = 1e-9

# Setting by which the files of a query's shuffles go when it ends: a fit has a shuffle of tasks x labels x vocabulary
# in each pass, which would all stay until the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Gradients one merging task adds up.
MERGE_WIDTH = 64


@dataclass(frozen=True)
class LinearModel:
    """Weights by vocabulary position; labels in vocabulary rank order."""

    labels: list[str]
    weights: np.ndarray
    intercepts: np.ndarray
    # Per label, whether the fit reached its tolerance; True for models that were not fitted.
    converged: np.ndarray | None = None

    def to_table(self, spark: SparkSession) -> DataFrame:
        """One row per label: ``(rank, label, intercept, weights)``."""
        rows = pa.table({
            "rank": pa.array(range(1, len(self.labels) + 1), pa.int32()),
            "label": pa.array(self.labels, pa.string()),
            "intercept": pa.array(self.intercepts, pa.float64()),
            "weights": pa.array(list(self.weights), pa.list_(pa.float64())),
        })
        return spark.createDataFrame(rows)

    @classmethod
    def from_table(cls, table: DataFrame) -> LinearModel:
        rows = table.orderBy("rank").collect()
        return cls(
            [row.label for row in rows],
            np.array([row.weights for row in rows], dtype=np.float64),
            np.array([row.intercept for row in rows], dtype=np.float64),
        )

    @classmethod
    def from_coefficients(
        cls, labels: list[str], coefficients: DataFrame, features: int, intercept: float = 0.0
    ) -> LinearModel:
        """From rows ``(label, idx, coef)``, at most labels x vocabulary of them; absent ones are 0."""
        weights = np.zeros((len(labels), features))
        place = {label: i for i, label in enumerate(labels)}
        by_label = coefficients.groupBy("label").agg(
            F.collect_list("idx").alias("idx"), F.collect_list("coef").alias("coef")
        )
        for label, idx, coef in zip(*by_label.toArrow().select(["label", "idx", "coef"])):
            weights[place[label.as_py()], idx.values.to_numpy()] = coef.values.to_numpy()
        return cls(labels, weights, np.full(len(labels), intercept))


def coefficient_rows(model_table: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Non-zero weights as ``(label, gram, coef)``."""
    entries = model_table.select("label", F.posexplode("weights").alias("idx", "coef")).where("coef <> 0")
    return entries.join(F.broadcast(vocabulary.select("idx", "gram")), "idx").select("label", "gram", "coef")


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and concatenated items of a list column."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, column.flatten().to_numpy(zero_copy_only=False)


def _blocks(indices: pa.ListArray, values: pa.ListArray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Row blocks as ``(rows, features, matrix)``: a dense matrix over the features a block holds."""
    lengths, places = _lists(indices)
    _, weights = _lists(values)
    ends = np.concatenate(([0], np.cumsum(lengths)))
    for start in range(0, len(lengths), BLOCK_ROWS):
        stop = min(start + BLOCK_ROWS, len(lengths))
        part = slice(ends[start], ends[stop])
        features, column = np.unique(places[part], return_inverse=True)
        matrix = np.zeros((stop - start, len(features)))
        matrix[np.repeat(np.arange(stop - start), lengths[start:stop]), column] = weights[part]
        yield slice(start, stop), features, matrix


def margin_column(spark: SparkSession, model: LinearModel, indices: Column, values: Column) -> Column:
    """``array<double>``: the margin of every label for a sparse row."""
    shared = spark.sparkContext.broadcast((np.ascontiguousarray(model.weights.T), model.intercepts))

    @F.arrow_udf("array<double>")
    def margins(index_lists: pa.Array, value_lists: pa.Array) -> pa.Array:
        by_feature, intercepts = shared.value
        out = np.empty((len(index_lists), len(intercepts)))
        for rows, features, matrix in _blocks(index_lists, value_lists):
            out[rows] = matrix @ by_feature[features] + intercepts
        ends = np.arange(len(index_lists) + 1, dtype=np.int32) * len(intercepts)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))

    return margins(indices, values)


def with_margins(vectors: DataFrame, model: LinearModel) -> DataFrame:
    column = margin_column(vectors.sparkSession, model, F.col("indices"), F.col("values"))
    return vectors.withColumn("margins", column)


def predicted_labels(margins: Column, labels: list[str]) -> Column:
    """Labels with a margin above 0, in rank order.

    Margins are rounded to nine places first, so the order of a sum cannot decide the sign.
    """
    if not labels:
        return F.array().cast("array<string>")
    pairs = F.zip_with(
        F.array(*[F.lit(label) for label in labels]), margins,
        lambda label, margin: F.when(F.round(margin, 9) > 0, label),
    )
    return F.array_compact(pairs)


def long_margins(vectors: DataFrame, model: LinearModel, key: str = "doc_id") -> DataFrame:
    """``(key, label, margin)`` for every row and label."""
    names = F.array(*[F.lit(label) for label in model.labels])
    return (
        with_margins(vectors, model)
        .select(key, F.posexplode_outer("margins").alias("pos", "margin"))
        .where("pos is not null")
        .select(key, F.get(names, F.col("pos")).alias("label"), "margin")
    )


def predict(vectors: DataFrame, model: LinearModel, key: str = "doc_id") -> DataFrame:
    """``(key, labels)``: the predicted labels of each row, possibly none."""
    return with_margins(vectors, model).select(
        key, predicted_labels(F.col("margins"), model.labels).alias("labels")
    )


# --- fitting ---


BLOCK_COLUMNS = ("features", "cells", "values", "targets", "target_ends")
_KINDS = dict(zip(BLOCK_COLUMNS, (np.int32, np.int32, np.float64, np.int32, np.int32)))


def sparse_blocks(train: DataFrame) -> DataFrame:
    """The rows as sparse blocks, a block per row of the result.

    A block holds its distinct ``features``, and of each entry the ``cells`` number, row by row, in the matrix
    of its rows and these features, and the ``values``.
    """

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, indices = _lists(batch.column("indices"))
            _, values = _lists(batch.column("values"))
            counts, targets = _lists(batch.column("targets"))
            ends, target_ends = np.cumsum(lengths), np.cumsum(counts)
            packed: list[list[bytes]] = []
            start = 0
            while start < batch.num_rows:
                before = ends[start] - lengths[start]
                stop = int(np.searchsorted(ends, before + BLOCK_ENTRIES, "right"))
                stop = max(start + 1, min(stop, start + DENSE_ROWS))
                entries = slice(before, ends[stop - 1])
                features, places = np.unique(indices[entries], return_inverse=True)
                rows = np.repeat(np.arange(stop - start), lengths[start:stop])
                target_start = target_ends[start] - counts[start]
                parts = (
                    features, rows * len(features) + places, values[entries],
                    targets[target_start: target_ends[stop - 1]], target_ends[start:stop] - target_start,
                )
                packed.append([np.ascontiguousarray(part, kind).tobytes() for part, kind in zip(parts, _KINDS.values())])
                start = stop
            yield pa.RecordBatch.from_arrays(
                [pa.array([block[i] for block in packed], pa.binary()) for i in range(len(BLOCK_COLUMNS))], names=list(BLOCK_COLUMNS)
            )

    rows = train.select("indices", "values", "targets")
    return rows.mapInArrow(built, ", ".join(f"{name} binary" for name in BLOCK_COLUMNS))


class _Block:
    """A sparse block as a dense matrix of its rows and the features they hold."""

    def __init__(self, batch: pa.RecordBatch, row: int) -> None:
        parts = {}
        for name, kind in _KINDS.items():
            buffer = batch.column(name)[row].as_buffer()
            parts[name] = np.frombuffer(buffer, kind) if buffer.size else np.empty(0, kind)
        self.features, self.targets, self.target_ends = parts["features"], parts["targets"], parts["target_ends"]
        self.size = len(self.target_ends)
        shape = (self.size, len(self.features))
        self.matrix = np.bincount(parts["cells"], parts["values"], shape[0] * shape[1]).reshape(shape)

    def times(self, vectors: np.ndarray) -> np.ndarray:
        """Rows x columns: the block times a dense matrix with a row per feature of the vocabulary."""
        return self.matrix @ vectors.take(self.features, axis=0)

    def transposed_times(self, pulls: np.ndarray) -> np.ndarray:
        """Features of the block x columns."""
        return self.matrix.T @ pulls

    def signs(self, labels: int) -> np.ndarray:
        signs = np.full((self.size, labels), -1.0)
        signs[np.repeat(np.arange(self.size), np.diff(self.target_ends, prepend=0)), self.targets] = 1.0
        return signs


def _added_up(blocks: DataFrame, partial, columns: int) -> list[np.ndarray]:
    """The sums over all tasks of ``partial(blocks of the task)``: vectors by column, one to each."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = partial(_Block(batch, row) for batch in batches for row in range(batch.num_rows))
        packed = pa.array([np.ascontiguousarray(v).tobytes() for v in vectors], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(range(columns), pa.int32()), packed], names=["label", "sums"])

    conf = blocks.sparkSession.conf
    before = conf.get(DROP_SHUFFLES)
    conf.set(DROP_SHUFFLES, "true")
    try:
        totals = blocks.mapInArrow(sums, "label int, sums binary")
        if blocks.rdd.getNumPartitions() > MERGE_WIDTH:
            # No group holds the sums of more than MERGE_WIDTH tasks, then tasks / MERGE_WIDTH of these sums.
            slots = totals.withColumn("slot", F.floor(F.spark_partition_id() / MERGE_WIDTH))
            totals = slots.groupBy("label", "slot").applyInArrow(_add_up, "label int, sums binary")
        table = totals.groupBy("label").applyInArrow(_add_up, "label int, sums binary").toArrow()
    finally:
        conf.set(DROP_SHUFFLES, before)
    found: list[np.ndarray] = [np.empty(0)] * columns
    for label, packed in zip(table.column("label").to_pylist(), table.column("sums")):
        found[label] = np.frombuffer(packed.as_buffer())
    return found


def _add_up(parts: pa.Table) -> pa.Table:
    """Add the packed sums of one label: one row per task that read training rows."""
    total = np.zeros(len(parts.column("sums")[0].as_buffer()) // 8)
    for packed in parts.column("sums"):
        total += np.frombuffer(packed.as_buffer())
    return pa.table({"label": parts.column("label").combine_chunks().slice(0, 1), "sums": [total.tobytes()]})


def loss_and_gradient(
    blocks: DataFrame, active: np.ndarray, all_labels: int, weights: np.ndarray, intercepts: np.ndarray, c: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Loss sum, rows inside the margin, intercept gradient and weight gradient per active label, without the penalty.

    ``active`` holds the label positions that the rows of ``weights`` and ``intercepts`` stand for.
    """
    labels, features = weights.shape
    shared = blocks.sparkSession.sparkContext.broadcast((np.ascontiguousarray(weights.T), intercepts))

    def partial(held: Iterator[_Block]) -> np.ndarray:
        by_feature, bias = shared.value
        sums = np.zeros((3 + features, labels))
        for block in held:
            signs = block.signs(all_labels)[:, active]
            short = np.maximum(0.0, 1.0 - signs * (block.times(by_feature) + bias))
            pull = -2.0 * c * signs * short
            sums[0] += c * np.square(short).sum(axis=0)
            sums[1] += (short > 0).sum(axis=0)
            sums[2] += pull.sum(axis=0)
            sums[3 + block.features] += block.transposed_times(pull)
        return sums.T

    sums = np.array(_added_up(blocks, partial, labels)).reshape(labels, 3 + features)
    shared.destroy()
    return sums[:, 0], sums[:, 1], sums[:, 2], sums[:, 3:]


def gram_product(blocks: DataFrame, vectors: np.ndarray) -> np.ndarray:
    """``X'X`` times the columns of ``vectors``; the last row stands for the intercept, a feature of 1 in every row."""
    width = vectors.shape[1]
    shared = blocks.sparkSession.sparkContext.broadcast(vectors)

    def partial(held: Iterator[_Block]) -> np.ndarray:
        known = shared.value
        sums = np.zeros(known.shape)
        for block in held:
            products = block.times(known) + known[-1]
            sums[-1] += products.sum(axis=0)
            sums[block.features] += block.transposed_times(products)
        return sums.T

    found = np.array(_added_up(blocks, partial, width)).reshape(width, len(vectors)).T
    shared.destroy()
    return found


def curvature(
    blocks: DataFrame, features: int, vectors: int | None = None, depth: int | None = None
) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues of ``X'X`` within a space and their vectors, and a value that stands for the rest.


    The space is spanned by a block of ``X'X`` times vectors from a fixed seed and its next ``depth - 1``
    products (block Lanczos, each block orthogonal to all before it). It holds the large eigenvalues well; the
    smallest values of the space lie below what it leaves out, so the one at a third stands for the rest, and
    0 where the space takes in all of ``X'X``.
    """
    width, depth = min(vectors or CURVATURE, features + 1), depth or DEPTH
    block = gram_product(blocks, np.random.default_rng(11).standard_normal((features + 1, width)))
    basis, within, scale, left = np.empty((features + 1, 0)), np.empty((0, 0)), np.linalg.norm(block, 2), False
    for step in range(depth + 1):
        for _ in range(2):  # twice, so that rounding leaves nothing of the earlier blocks
            block = block - basis @ (basis.T @ block)
        block, sizes, _ = np.linalg.svd(block, full_matrices=False)
        block = block[:, sizes > ROUNDING * scale]
        left = block.shape[1] > 0
        if not left or step == depth:
            break
        block, _ = np.linalg.qr(block - basis @ (basis.T @ block))
        known, basis = basis.shape[1], np.hstack([basis, block])
        block = gram_product(blocks, block)
        across = basis.T @ block
        within = np.block([[within, across[:known]], [across[:known].T, across[known:]]])
        scale = max(scale if step else 0.0, np.linalg.norm(across, 2))
    values, turn = np.linalg.eigh((within + within.T) / 2)
    values = np.maximum(values, 0.0)
    return values, basis @ turn, float(values[len(values) // 3]) if left else 0.0


class _Inverse:
    """The inverse of ``1 + 2 C p X'X`` by the shared curvature, p being the share of rows inside the margin."""

    def __init__(self, values: np.ndarray, vectors: np.ndarray, rest: float, c: float) -> None:
        self.values, self.vectors, self.rest, self.c = values, vectors, rest, c

    def __call__(self, gradients: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """The inverse times each row, with the share of the row."""
        steep = 2.0 * self.c * shares[:, None]
        rest, known = 1.0 + steep * self.rest, 1.0 + steep * self.values
        return gradients / rest + ((1.0 / known - 1.0 / rest) * (gradients @ self.vectors)) @ self.vectors.T


def _directions(gradients: np.ndarray, histories: list[deque], inverse, shares: np.ndarray) -> np.ndarray:
    """L-BFGS directions of labels from their past steps; ``inverse`` applies the guess of the inverse Hessians."""
    steps, taken = gradients.copy(), []
    for step, history in zip(steps, histories):
        taken.append([])
        for move, change, weight in reversed(history):
            taken[-1].append(weight * move.dot(step))
            step -= taken[-1][-1] * change
    steps = inverse(steps, shares)
    for step, history, parts in zip(steps, histories, taken):
        for (move, change, weight), part in zip(history, reversed(parts)):
            step += move * (part - weight * change.dot(step))
    return -steps


def fit_labels(
    blocks: DataFrame,
    positives: np.ndarray,
    rows: int,
    features: int,
    settings: Settings = DEFAULTS,
    tolerance: float = 1e-4,
    max_passes: int = 300,
    memory: int = 10,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weights, intercepts, final objective, and whether the tolerance was reached, per label.

    ``blocks`` are those of ``sparse_blocks``. One pass over them serves the trial points of all
    labels that are still moving; a label stops when its gradient has shrunk by ``tolerance`` times
    its share of the rarer class.
    """
    labels = len(positives)
    point = np.zeros((labels, features + 1))
    value, inside = np.zeros(labels), np.ones(labels)
    gradient = np.zeros_like(point)

    def evaluate(active: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        loss, held, bias, slope = loss_and_gradient(blocks, active, labels, at[:, :-1], at[:, -1], settings.svc_c)
        return 0.5 * np.square(at).sum(axis=1) + loss, held / rows, at + np.column_stack([slope, bias])

    moving = (positives > 0) & (positives < rows)
    active = np.flatnonzero(moving)
    if not len(active):
        return point[:, :-1], point[:, -1], value, np.ones(labels, bool)
    inverse = _Inverse(*curvature(blocks, features), settings.svc_c)
    value[active], inside[active], gradient[active] = evaluate(active, point[active])
    goal = np.zeros(labels)
    goal[:] = tolerance * np.minimum(positives, rows - positives) / rows * np.linalg.norm(gradient, axis=1)
    histories: list[deque] = [deque() for _ in range(labels)]
    direction = np.zeros_like(point)
    length = np.ones(labels)
    turned = active
    for _ in range(max_passes):
        shares = np.maximum(inside, 1.0 / rows)
        direction[turned] = _directions(gradient[turned], [histories[label] for label in turned], inverse, shares[turned])
        active = np.flatnonzero(moving)
        kept = max(memory, min(LONGEST, STEPS // len(active)))
        trials = point[active] + length[active, None] * direction[active]
        turned = []
        for label, trial, trial_value, trial_inside, trial_gradient in zip(active, trials, *evaluate(active, trials)):
            slope = gradient[label].dot(direction[label])
            if trial_value > value[label] + 1e-4 * length[label] * slope:
                length[label] /= 2.0
                moving[label] = length[label] > 1e-12
                continue
            move, change = trial - point[label], trial_gradient - gradient[label]
            if move.dot(change) > 1e-12:
                histories[label].append((move, change, 1.0 / move.dot(change)))
            while len(histories[label]) > kept:
                histories[label].popleft()
            point[label], value[label], inside[label], gradient[label] = trial, trial_value, trial_inside, trial_gradient
            moving[label] = np.linalg.norm(trial_gradient) > goal[label]
            length[label] = 1.0
            if moving[label]:
                turned.append(label)
            else:
                histories[label].clear()
        if not moving.any():
            break
    return point[:, :-1], point[:, -1], value, np.linalg.norm(gradient, axis=1) <= goal


def label_support(train: DataFrame, labels: int) -> tuple[np.ndarray, int]:
    """Rows per label position, and all rows."""
    counts = np.zeros(labels)
    for row in train.select(F.explode("targets").alias("t")).groupBy("t").count().collect():
        counts[row.t] = row["count"]
    return counts, train.count()


def fit_model(
    train: DataFrame, labels: list[str], features: int, settings: Settings = DEFAULTS, **options
) -> tuple[LinearModel, np.ndarray]:
    """Fit all labels; a label with one class in training gets a constant answer."""
    positives, rows = label_support(train, len(labels))
    # Every pass reads the blocks again, and each task hands back labels x vocabulary: one for each core, not for each
    # split. A lost executor's part comes back from the stored table.
    tasks = train.sparkSession.sparkContext.defaultParallelism
    blocks = sparse_blocks(train.coalesce(tasks)).persist(StorageLevel.MEMORY_AND_DISK)
    weights, intercepts, objective, converged = fit_labels(blocks, positives, rows, features, settings, **options)
    blocks.unpersist()
    if not converged.all():
        stuck = [label for label, done in zip(labels, converged) if not done]
        warnings.warn(f"the fit stopped before its tolerance for {len(stuck)} labels: {stuck[:5]}", stacklevel=2)
    for constant, sign in ((positives == 0, -np.inf), (positives == rows, np.inf)):
        intercepts[constant] = sign
    return LinearModel(labels, weights, intercepts, converged), objective
