"""Binary logistic regression whose weights and gradients stay on the executors.

MLlib's fit sends the driver a gradient per evaluation of the loss, eight bytes for every feature. Here blocks of features
hold their part of the weights, the gradient and the last steps; blocks of rows get the weights and answer with their
part of the gradient. The driver chooses direction and length of each step from scalar products, by the same limited-memory
BFGS, line search and tests of convergence as MLlib's fit, and gets the weights once, at the end.

Three places do this work. Rows of up to ``TASK_CELLS`` values are fitted by a single task, which costs no job per
evaluation. More rows lie in files of the shared folder, which the tasks of every evaluation map into memory
(:class:`InFiles`). Where that folder is no mounted one, weights and gradients travel by shuffles (:class:`InShuffles`).
"""

from __future__ import annotations

import contextlib
import itertools
import math
import os
import pickle
import shutil
import sys
import uuid
from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.sources.files import scratch_dir

# executors receive the functions themselves, so they need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A block of features: shift, penalty, weights, gradient, the last steps (changes of the weights, newest first), the last
#: turns (changes of the gradient) and the block's part of the loss and of the scalar products
Weights = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]
#: Scaled rows: their labels, first cell and number of cells, and slot and value of every cell; each row has a cell
Rows = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]

#: Features of a block of weights, values of a block of rows
FEATURES, CELLS = 1 << 15, 1 << 15
#: Steps that the next direction is made from, as many as in MLlib's fit
HISTORY = 10
#: Values of the loss that a new one is held against, as many as in MLlib's fit
VALUES = 20
#: Steps after which the weights are written, which cuts their lineage
WRITTEN = 30
#: Bytes of gradients that the driver may be sent by MLlib's own fit
DRIVER_BYTES = 16 << 20
#: Values of all rows that one task fits alone, 12 bytes each
TASK_CELLS = 1 << 23
#: Values of the rows in a file
FILE_CELLS = 1 << 20


class Move(NamedTuple):
    """A step of ``length`` along a sum of the gradient and of the newest steps and turns."""

    length: float
    of_gradient: float
    of_steps: np.ndarray
    of_turns: np.ndarray


class SearchFailed(ArithmeticError):
    pass


def fit(estimator: LogisticRegression, table: DataFrame) -> LogisticRegressionModel:
    """The model of ``estimator`` for ``table``: by MLlib where its gradients are few or the job is another one than
    two classes with a ridge penalty, else by blocks."""
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    first = table.select(features).first()
    width = len(first[0]) if first else 0
    extra = ("weightCol", "threshold", "thresholds", "lowerBoundsOnCoefficients", "upperBoundsOnCoefficients",
             "lowerBoundsOnIntercepts", "upperBoundsOnIntercepts")
    plain = (
        estimator.getStandardization() and estimator.getFitIntercept() and estimator.getElasticNetParam() == 0.0
        and estimator.getFamily() in ("auto", "binomial") and not any(estimator.isSet(name) for name in extra)
    )
    if not plain or 8 * width * estimator.getMaxIter() <= DRIVER_BYTES:
        return estimator.fit(table)
    rows = table.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().limit(3).collect()}
    return fit_in_blocks(estimator, rows, counts) if set(counts) == {0.0, 1.0} else estimator.fit(table)


def fit_in_blocks(estimator: LogisticRegression, rows: DataFrame, counts: dict[float, int]) -> LogisticRegressionModel:
    """``rows`` has the columns ``label`` and ``features``; ``counts`` is the number of rows of either label."""
    spark, total = rows.sparkSession, sum(counts.values())
    sc = spark.sparkContext
    moments = rows.select(Summarizer.metrics("mean", "std", "numNonZeros").summary(F.col("features")).alias("m")).first()["m"]
    mean, std = moments["mean"].toArray(), moments["std"].toArray()
    scale = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
    # the intercept is the weight of a last feature without values, shifted by minus one
    shift = np.append(scale * mean, -1.0)
    intercept = math.log(counts[1.0] / counts[0.0])
    shared = sc.broadcast((scale, shift))
    job = Job(total, len(shift), estimator.getRegParam(), intercept, estimator.getTol(), estimator.getMaxIter())
    try:
        if moments["numNonZeros"].toArray().sum() <= TASK_CELLS:
            made = rows.coalesce(1).mapInArrow(partial(fitted_alone, job=job, shared=shared), "weights binary").first()
            found = np.frombuffer(made["weights"])
        else:
            with contextlib.ExitStack() as stack:
                folder = mounted(spark, scratch_dir(spark, "weights"))
                if folder:
                    place_of_work = InFiles(stack, rows, job, shared, folder)
                else:
                    place_of_work = InShuffles(stack, rows, job, shared, partial(scratch_dir, spark, "weights"))
                found = Search(place_of_work, job).minimised()
    finally:
        shared.unpersist()
    coefficients, intercept = found[:-1] * scale, float(found[-1] - found[:-1] @ shift[:-1])
    made = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        estimator.uid, _py2java(sc, Vectors.dense(coefficients)), intercept
    )
    return estimator._copyValues(LogisticRegressionModel(made))


def mounted(spark, path: str) -> str | None:
    """The local name of a folder, or None where it lies in a store that is not mounted."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    url = urlparse(store.makeQualified(place).toString())
    return unquote(url.path) if url.scheme == "file" else None


class Job(NamedTuple):
    total: int
    width: int
    penalty: float
    intercept: float
    tolerance: float
    most: int

    def blocks(self) -> int:
        return math.ceil(self.width / FEATURES)

    def start(self, first: int, last: int, shift: np.ndarray) -> Weights:
        """The features from ``first`` to before ``last`` at the start: no weights but the intercept."""
        own = np.arange(first, min(last, self.width)) == self.width - 1
        none = np.zeros((0, len(own)))
        shift = shift[first:last]
        return shift, np.where(own, 0.0, self.penalty), np.where(own, self.intercept, 0.0), np.zeros_like(shift), none, none, ()


# -- in tasks -----------------------------------------------------------------------------


def place(key: int) -> int:
    return key


def scaled(labels: np.ndarray, counts: np.ndarray, slot: np.ndarray, values: np.ndarray, scale: np.ndarray) -> Rows:
    if not counts.all():
        # sums by row need a cell in each, so rows without cells get a zero
        at = np.repeat(np.cumsum(counts) - counts, counts == 0)
        slot, values, counts = np.insert(slot, at, 0), np.insert(values, at, 0.0), np.maximum(counts, 1)
    return labels, np.cumsum(counts) - counts, counts, slot, values * scale[slot]


def cells_of(vector: dict) -> tuple[np.ndarray, np.ndarray]:
    values = np.array(vector["values"], np.float64)
    if vector["indices"] is not None:
        return np.array(vector["indices"], np.int32), values
    slot = np.flatnonzero(values).astype(np.int32)
    return slot, values[slot]


def row_blocks(batches: Iterable[pa.RecordBatch], scale: np.ndarray, most: int) -> Iterator[Rows]:
    """Blocks of rows with at least ``most`` values, but for the last one. A batch is a label and a stored vector a row."""
    held, cells = [], 0

    def block() -> Rows:
        return scaled(*map(np.concatenate, zip(*held, strict=True)), scale)

    for batch in batches:
        labels, vectors = batch.column(0).to_numpy(), batch.column(1)
        if vectors.field("type").to_numpy().any():
            slot, value = zip(*map(cells_of, vectors.to_pylist()), strict=True)
            counts, slot, value = np.array([len(v) for v in value]), np.concatenate(slot), np.concatenate(value)
        else:
            slot, value = (vectors.field(name).flatten().to_numpy() for name in ("indices", "values"))
            counts = np.diff(vectors.field("values").offsets.to_numpy()).astype(np.int64)
        ends, first = np.cumsum(counts + 1), 0
        while first < len(counts):
            before = ends[first - 1] if first else 0
            last = min(int(np.searchsorted(ends, before + most - cells)) + 1, len(counts))
            own = slice(before - first, ends[last - 1] - last)
            held.append((labels[first:last], counts[first:last], slot[own], value[own]))
            cells += ends[last - 1] - before
            first = last
            if cells >= most:
                yield block()
                held, cells = [], 0
    if held:
        yield block()


def moved(block: Weights, move: Move | None) -> np.ndarray:
    _, _, weights, gradient, steps, turns, _ = block
    if move is None:
        return weights
    kept = len(move.of_steps)
    return weights + move.length * (move.of_gradient * gradient + move.of_steps @ steps[:kept] + move.of_turns @ turns[:kept])


def image(rows: Rows, vector: np.ndarray, shift: float) -> np.ndarray:
    """Products of the rows with a vector; ``shift`` is that of the shifts."""
    _, starts, _, slot, x = rows
    return np.add.reduceat(x * vector[slot], starts) - shift


def pull(items: Iterable[tuple[Rows, np.ndarray]], width: int) -> tuple[np.ndarray, float, float]:
    """Of rows and their margins: the gradient without shifts, the sum of the errors and the loss."""
    gradient, rest, loss = np.zeros(width), 0.0, 0.0
    for (labels, _, counts, slot, x), margin in items:
        loss += np.logaddexp(0.0, np.where(labels > 0, -margin, margin)).sum()
        with np.errstate(over="ignore"):
            error = 1.0 / (1.0 + np.exp(-margin)) - labels
        rest += error.sum()
        np.add.at(gradient, slot.astype(np.intp), x * np.repeat(error, counts))
    return gradient, rest, loss


def reached(block: Weights, move: Move | None, pulled: np.ndarray, rest: float, loss: float, total: int) -> Weights:
    """A block of features after the step, with its part of the loss and of the scalar products."""
    shift, penalty, old_weights, old_gradient, steps, turns, _ = block
    weights = moved(block, move)
    gradient = (pulled - shift * rest) / total + penalty * weights
    if move is not None:
        kept = min(len(move.of_steps), HISTORY - 1)
        steps = np.vstack([weights - old_weights, steps[:kept]])
        turns = np.vstack([gradient - old_gradient, turns[:kept]])
    new = np.vstack([gradient, steps[:1], turns[:1]])
    own = loss / total + (penalty * weights) @ weights / 2, new @ gradient, steps @ new.T, turns @ new.T
    return shift, penalty, weights, gradient, steps, turns, own


def fitted_alone(batches: Iterable[pa.RecordBatch], job: Job, shared) -> Iterator[pa.RecordBatch]:
    scale, shift = shared.value
    rows = list(row_blocks(batches, scale, CELLS))
    found = Search(InTask(rows, job, shift), job).minimised()
    yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], ["weights"])


class InTask:
    """All rows and all features in the memory of one task."""

    def __init__(self, rows: list[Rows], job: Job, shift: np.ndarray):
        self.rows, self.job, self.start = rows, job, job.start(0, job.width, shift)

    def point(self, block: Weights, move: Move | None) -> Point:
        weights = moved(block, move)
        shift = block[0] @ weights
        pulled = pull(((rows, image(rows, weights, shift)) for rows in self.rows), len(weights))
        made = reached(block, move, *pulled, self.job.total)
        return Point.summed(made, [made[-1]])

    def release(self, block: Weights) -> None:
        pass

    def taken(self, point: Point, done: int) -> Point:
        return point

    def weights(self, block: Weights) -> np.ndarray:
        return block[2]


# -- by files that are mapped into memory ---------------------------------------------------


class At(NamedTuple):
    """Weights by the number of the evaluation that made them, and the numbers of the steps that are kept, newest first."""

    number: int
    history: tuple[int, ...]


def written(path: str, *arrays: np.ndarray) -> None:
    # whole or not at all; a task that is run again writes the same
    with open(part := f"{path}.{uuid.uuid4().hex}", "wb") as file:
        for array in arrays:
            file.write(np.ascontiguousarray(array).data)
    os.replace(part, path)


def mapped(path: str) -> np.ndarray:
    return np.asarray(np.memmap(path, np.float64, "r"))


def write_rows(batches: Iterable[pa.RecordBatch], folder: str, shared) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for number, rows in enumerate(row_blocks(batches, shared.value[0], FILE_CELLS)):
        labels, starts, counts, slot, x = rows
        written(f"{folder}/rows-{part}-{number}", np.array([len(labels), len(x)]), labels, starts, counts, x, slot)
        yield pa.RecordBatch.from_pylist([{"part": part, "number": number, "cells": len(x)}])


def read_rows(path: str) -> Rows:
    raw = np.asarray(np.memmap(path, np.uint8, "r"))
    rows, cells = raw[:16].view(np.int64)
    labels, starts, counts, x, slot = np.split(raw[16:], np.cumsum([8 * rows, 8 * rows, 8 * rows, 8 * cells]))
    return labels.view(np.float64), starts.view(np.int64), counts.view(np.int64), slot.view(np.int32), x.view(np.float64)


def vectors(folder: str, kind: str, at: At, index: int, kept: int) -> tuple[np.ndarray, ...]:
    """Weights, gradient, steps and turns of a block of features, or their images of a part of the rows."""
    weights, gradient, *_ = mapped(f"{folder}/{kind}-{at.number}-{index}").reshape(4, -1)
    past = [mapped(f"{folder}/{kind}-{number}-{index}").reshape(4, -1) for number in at.history[:kept]]
    none = [np.zeros((0, len(weights)))]
    return weights, gradient, np.vstack(none + [p[2] for p in past]), np.vstack(none + [p[3] for p in past])


def image_all(part: int, folder: str, rows: list[Rows], at: At, before: tuple[At, Move] | None, job: Job, shift: np.ndarray) -> None:
    gradient = np.concatenate([mapped(f"{folder}/weights-{at.number}-{b}").reshape(4, -1)[1] for b in range(job.blocks())])
    product = shift @ gradient
    gradient = np.concatenate([image(r, gradient, product) for r in rows])
    if before is None:
        new = np.full_like(gradient, job.intercept), gradient, np.zeros_like(gradient), np.zeros_like(gradient)
    else:
        old = None, None, *vectors(folder, "images", before[0], part, len(before[1].of_steps)), ()
        weights = moved(old, before[1])
        new = weights, gradient, weights - old[2], gradient - old[3]
    written(f"{folder}/images-{at.number}-{part}", *new)


def answer(
    part: int, folder: str, names: list[list[str]], number: int, at: At | None, before: tuple[At, Move] | None, fresh: bool,
    move: Move | None, job: Job, shared,
) -> tuple[float, float]:
    """Writes the gradient of a part of the rows; gives the sum of its errors and its loss."""
    rows = [read_rows(f"{folder}/{name}") for name in names[part]]
    if move is None:
        margin = np.full(sum(len(r[0]) for r in rows), job.intercept)
    else:
        if fresh:
            image_all(part, folder, rows, at, before, job, shared.value[1])
        margin = moved((None, None, *vectors(folder, "images", at, part, len(move.of_steps)), ()), move)
    cuts = np.split(margin, np.cumsum([len(r[0]) for r in rows])[:-1])
    gradient, rest, loss = pull(zip(rows, cuts, strict=True), job.width)
    written(f"{folder}/pull-{number}-{part}", gradient)
    return rest, loss


def collected(
    block: int, folder: str, parts: int, number: int, at: At | None, move: Move | None, rest: float, loss: float, job: Job, shared
) -> tuple:
    """Writes a block of features after the step; gives its part of the loss and of the scalar products."""
    first, last = block * FEATURES, (block + 1) * FEATURES
    pulled = sum(mapped(f"{folder}/pull-{number}-{part}")[first:last] for part in range(parts))
    old = job.start(first, last, shared.value[1])
    if move is not None:
        old = *old[:2], *vectors(folder, "weights", at, block, len(move.of_steps)), ()
    made = reached(old, move, pulled, rest, loss if block == 0 else 0.0, job.total)
    newest = (made[4][0], made[5][0]) if move is not None else (np.zeros_like(pulled),) * 2
    written(f"{folder}/weights-{number}-{block}", made[2], made[3], *newest)
    return made[-1]


class InFiles:
    """Rows, weights and gradients in files of a shared folder.

    An evaluation is two jobs of one stage: tasks by parts of the rows write their gradients, tasks by blocks of features
    sum them up and write the weights of the step. The products of rows and weights are kept like the weights, so a
    part needs nothing of them but the gradient at the end of each step.
    """

    start = None

    def __init__(self, stack: contextlib.ExitStack, rows: DataFrame, job: Job, shared, folder: str):
        os.makedirs(folder)
        stack.callback(shutil.rmtree, folder, ignore_errors=True)
        sc = rows.sparkSession.sparkContext
        files = rows.mapInArrow(partial(write_rows, folder=folder, shared=shared), "part long, number long, cells long").collect()
        names = [[] for _ in range(min(sc.defaultParallelism, len(files)))]
        loads = [0] * len(names)
        for file in sorted(files, key=lambda f: (-f["cells"], f["part"], f["number"])):
            least = loads.index(min(loads))
            names[least].append(f"rows-{file['part']}-{file['number']}")
            loads[least] += file["cells"]
        self.folder, self.names, self.job, self.shared = folder, names, job, shared
        self.parts, self.blocks = (sc.parallelize(range(n), n) for n in (len(names), job.blocks()))
        self.number, self.before, self.imaged, self.kept = -1, {}, set(), set()

    def point(self, at: At | None, move: Move | None) -> Point:
        self.number += 1
        same = {"folder": self.folder, "number": self.number, "at": at, "move": move, "job": self.job, "shared": self.shared}
        fresh = at is not None and at.number not in self.imaged
        answers = self.parts.map(
            partial(answer, **same, names=self.names, before=self.before.get(at), fresh=fresh)
        ).collect()
        rest, loss = (sum(part) for part in zip(*answers, strict=True))
        figures = self.blocks.map(partial(collected, **same, parts=len(self.names), rest=rest, loss=loss)).collect()
        history = () if move is None else (self.number, *at.history[: min(len(move.of_steps), HISTORY - 1)])
        made = At(self.number, history)
        self.kept.add(self.number)
        if move is not None:
            self.imaged.add(at.number)
            self.before = {made: (at, move)}
            needed = {self.number, at.number, *at.history}
            self.drop("weights", "images", numbers=self.kept - needed)
            self.kept &= needed
        self.drop("pull", numbers={self.number})
        return Point.summed(made, figures)

    def drop(self, *kinds: str, numbers: set[int]) -> None:
        for kind in kinds:
            for number in numbers:
                for index in range(max(len(self.names), self.job.blocks())):
                    with contextlib.suppress(FileNotFoundError):
                        os.remove(f"{self.folder}/{kind}-{number}-{index}")

    def release(self, at: At) -> None:
        pass  # goes with the next evaluation

    def taken(self, point: Point, done: int) -> Point:
        return point

    def weights(self, at: At) -> np.ndarray:
        return np.concatenate([mapped(f"{self.folder}/weights-{at.number}-{b}").reshape(4, -1)[0] for b in range(self.job.blocks())])


# -- by shuffles ----------------------------------------------------------------------------


def stored_blocks(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    for rows in row_blocks(batches, shared.value[0], CELLS):
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(rows, 5)], pa.binary())], ["block"])


def dealt(part: int, blocks: Iterable, parts: int) -> Iterator[tuple[int, Rows]]:
    for number, block in enumerate(blocks):
        yield (part + number) % parts, pickle.loads(block["block"])


def to_rows(item: tuple[int, Weights], move: Move | None, parts: int) -> Iterator[tuple]:
    number, block = item
    weights = moved(block, move)
    message = number, weights, block[0] @ weights
    for part in range(parts):
        yield part, message


def gradients(items: Iterable[tuple]) -> Iterator[tuple]:
    """The weights come first, then the rows. Gives each block of features its part of the gradient."""
    sent, part = [], None

    def margins() -> Iterator[tuple[Rows, np.ndarray]]:
        for _, rows in itertools.chain([first], items):
            yield rows, image(rows, weights, shift)

    for part, value in (items := iter(items)):
        if len(value) != 3:
            first = part, value
            break
        sent.append(value)
    else:
        return
    sent.sort(key=lambda message: message[0])
    weights, shift = np.concatenate([message[1] for message in sent]), sum(message[2] for message in sent)
    gradient, rest, loss = pull(margins(), len(weights))
    ends = np.cumsum([len(message[1]) for message in sent])
    for (number, own, _), end in zip(sent, ends, strict=True):
        yield number, (part, gradient[end - len(own) : end], rest, loss if number == 0 else 0.0)


def stepped(items: Iterable[tuple], move: Move | None, total: int) -> Iterator[tuple[int, Weights]]:
    number, block = next(items := iter(items))
    # in the order of the parts, so that equal fits round alike
    answers = sorted((value for _, value in items), key=lambda answer: answer[0])
    yield number, reached(block, move, *(sum(a[n] for a in answers) for n in (1, 2, 3)), total)


def figures(item: tuple[int, Weights]) -> tuple:
    return item[1][-1]


def final(item: tuple[int, Weights]) -> tuple[int, np.ndarray]:
    return item[0], item[1][2]


class InShuffles:
    """Rows and weights in Spark's block store; an evaluation is a job of three stages."""

    def __init__(self, stack: contextlib.ExitStack, rows: DataFrame, job: Job, shared, path):
        sc = rows.sparkSession.sparkContext
        self.job, self.path, self.parts, self.blocks = job, path, sc.defaultParallelism, job.blocks()
        stored = rows.mapInArrow(partial(stored_blocks, shared=shared), "block binary").rdd
        table = stored.mapPartitionsWithIndex(partial(dealt, parts=self.parts)).partitionBy(self.parts, place)
        self.table = table.persist(StorageLevel.MEMORY_AND_DISK)
        stack.callback(table.unpersist)
        shift = shared.value[1]
        starts = [(n, job.start(n * FEATURES, (n + 1) * FEATURES, shift)) for n in range(self.blocks)]
        self.start = sc.parallelize(starts, self.blocks).partitionBy(self.blocks, place)

    def point(self, weights: RDD, move: Move | None) -> Point:
        sent = weights.flatMap(partial(to_rows, move=move, parts=self.parts)).partitionBy(self.parts, place)
        answers = sent.union(self.table).mapPartitions(gradients).partitionBy(self.blocks, place)
        made = weights.union(answers).mapPartitions(partial(stepped, move=move, total=self.job.total), preservesPartitioning=True)
        made.persist(StorageLevel.MEMORY_AND_DISK)
        return Point.summed(made, made.map(figures).collect())

    def release(self, weights: RDD) -> None:
        weights.unpersist()

    def taken(self, point: Point, done: int) -> Point:
        """Every ``WRITTEN`` steps the weights are written, which cuts their lineage."""
        if done % WRITTEN:
            return point
        path = self.path()
        point.weights.saveAsPickleFile(path)
        point.weights.unpersist()
        read = point.weights.context.pickleFile(path).partitionBy(self.blocks, place)
        return point._replace(weights=read.persist(StorageLevel.MEMORY_AND_DISK))

    def weights(self, weights: RDD) -> np.ndarray:
        return np.concatenate([part for _, part in sorted(weights.map(final).collect(), key=lambda item: item[0])])


# -- the search: scalars only ---------------------------------------------------------------


class Point(NamedTuple):
    """Weights at the end of a step: their value, squared gradient and products with the history.

    ``of_steps`` and ``of_turns`` have a row per step or turn, newest first, and columns for the gradient, the newest
    step and the newest turn.
    """

    weights: object
    value: float
    squared: float
    of_steps: np.ndarray
    of_turns: np.ndarray

    @staticmethod
    def summed(weights, figures: list[tuple]) -> Point:
        value, products, of_steps, of_turns = (sum(part) for part in zip(*figures, strict=True))
        return Point(weights, value, products[0], of_steps, of_turns)


class Trial(NamedTuple):
    length: float
    value: float
    slope: float
    point: Point


class Search:
    def __init__(self, work: InTask | InFiles | InShuffles, job: Job):
        self.work, self.most, self.tolerance = work, job.most, job.tolerance
        self.forget()

    def forget(self) -> None:
        # products of steps with turns, and of turns with turns
        self.crossed, self.squares = np.zeros((0, 0)), np.zeros((0, 0))

    def remember(self, point: Point) -> None:
        """Products of the newest step and turn beside those of the older ones that are kept."""
        kept = len(point.of_steps) - 1
        crossed, squares = np.empty((kept + 1, kept + 1)), np.empty((kept + 1, kept + 1))
        crossed[1:, 1:], squares[1:, 1:] = self.crossed[:kept, :kept], self.squares[:kept, :kept]
        crossed[:, 0], crossed[0, :] = point.of_steps[:, 2], point.of_turns[:, 1]
        squares[:, 0] = squares[0, :] = point.of_turns[:, 2]
        self.crossed, self.squares = crossed, squares

    def direction(self, point: Point) -> tuple[float, np.ndarray, np.ndarray, float]:
        """Shares of gradient, steps and turns in the next direction, and the slope along it."""
        kept = len(self.crossed)
        along_steps, along_turns = point.of_steps[:kept, 0], point.of_turns[:kept, 0]
        of_gradient, of_steps, of_turns = 1.0, np.zeros(kept), np.zeros(kept)
        if kept:
            if not self.crossed[0, 0] >= 0:
                raise SearchFailed("curvature below zero")
            shares = np.zeros(kept)
            for i in range(kept):
                shares[i] = (along_steps[i] + self.crossed[i] @ of_turns) / self.crossed[i, i]
                if math.isnan(shares[i]):
                    raise SearchFailed("no curvature")
                of_turns[i] -= shares[i]
            scale = self.crossed[0, 0] / self.squares[0, 0]
            of_gradient, of_turns = scale, of_turns * scale
            for i in reversed(range(kept)):
                product = of_gradient * along_turns[i] + self.crossed[:, i] @ of_steps + self.squares[i] @ of_turns
                of_steps[i] += shares[i] - product / self.crossed[i, i]
        of_gradient, of_steps, of_turns = -of_gradient, -of_steps, -of_turns
        return of_gradient, of_steps, of_turns, of_gradient * point.squared + of_steps @ along_steps + of_turns @ along_turns

    def step(self, point: Point, initial: bool) -> Point:
        """The next point, by a line search for the strong Wolfe conditions."""
        *shares, slope = self.direction(point)
        if not slope <= 0:
            raise SearchFailed("not a descent")
        tried = []

        def at(length: float) -> Trial:
            if not math.isfinite(length):
                raise SearchFailed("no length")
            for trial in tried:
                self.work.release(trial.weights)
            made = self.work.point(point.weights, Move(length, *shares))
            tried[:] = [made]
            return Trial(length, made.value, made.of_steps[0, 0] / length, made)

        try:
            found = wolfe(at, Trial(0.0, point.value, slope, point), 1.0 / math.sqrt(point.squared) if initial else 1.0)
            if found.length * math.sqrt(point.squared) < 1e-10:
                raise SearchFailed("step too short")
        except SearchFailed:
            for trial in tried:
                self.work.release(trial.weights)
            raise
        return found.point

    def minimised(self) -> np.ndarray:
        point = self.work.point(self.work.start, None)
        first, values, done, failed = point.value, [math.inf], 0, False
        with np.errstate(all="ignore"):
            while done < self.most and not self.converged(point, values, first):
                try:
                    made = self.step(point, initial=done == 0)
                except SearchFailed:
                    if failed:
                        break
                    failed = True
                    self.forget()
                    continue
                self.remember(made)
                self.work.release(point.weights)
                failed, done = False, done + 1
                point = self.work.taken(made, done)
                values = [*values, point.value][-VALUES:]
        self.steps, self.value = done, point.value
        found = self.work.weights(point.weights)
        self.work.release(point.weights)
        return found

    def converged(self, point: Point, values: list[float], first: float) -> bool:
        flat = len(values) >= 2 and abs(point.value - max(values)) <= self.tolerance * first
        return flat or math.sqrt(point.squared) <= max(self.tolerance * abs(point.value), 1e-8)


def wolfe(at, start: Trial, length: float, least: float = 1e-4, flat: float = 0.9, rounds: int = 10) -> Trial:
    """A trial that lowers the value enough and is flat enough (Nocedal and Wright, algorithms 3.5 and 3.6)."""

    def too_high(trial: Trial) -> bool:
        return trial.value > start.value + least * trial.length * start.slope

    def narrowed(low: Trial, high: Trial) -> Trial:
        for _ in range(rounds):
            trial = at(between(*sorted((low, high), key=lambda t: t.length)))
            if too_high(trial) or trial.value >= low.value:
                high = trial
                continue
            if abs(trial.slope) <= flat * abs(start.slope):
                return trial
            if trial.slope * (high.length - low.length) >= 0:
                high = low
            low = trial
        raise SearchFailed("interval not narrowed")

    low = start
    for n in range(rounds):
        trial = at(length)
        if not math.isfinite(trial.value):
            length /= 2.0
            continue
        if too_high(trial) or trial.value >= low.value and n > 0:
            return narrowed(low, trial)
        if abs(trial.slope) <= flat * abs(start.slope):
            return trial
        if trial.slope >= 0:
            return narrowed(trial, low)
        low, length = trial, length * 1.5
    raise SearchFailed("no trial holds")


def between(left: Trial, right: Trial) -> float:
    """The least point of the cubic through both ends, kept off them by a tenth."""
    span = right.length - left.length
    a = left.slope + right.slope - 3 * (left.value - right.value) / (left.length - right.length)
    b = np.sqrt(np.float64(a * a - left.slope * right.slope))
    length = right.length - span * (right.slope + b - a) / (right.slope - left.slope + 2 * b)
    return float(min(max(length, left.length + 0.1 * span), left.length + 0.9 * span)) if not np.isnan(length) else math.nan
