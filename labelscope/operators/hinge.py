"""One-vs-rest linear SVM with squared hinge loss, all classes solved at once.

For each class k the optimum of  w'w / 2 + sum_i c_ik max(0, 1 - y_ik (w'x_i + b))^2 , where the intercept b
is a weight like the others (a constant feature of 1, penalised too), y_ik is 1 for rows of class k and -1
for the rest, and c_ik is C, times the class weight where y_ik is 1 (with two classes: on both sides).

The solver is L-BFGS, one per class, in lockstep. All its vectors are combinations of rows, so each is kept with the rows:
a coefficient and a product with the vector per row and class. The rows lie in groups. A pass adds up the groups' combinations
by column, hands each group the sums of its columns back, and sends the driver only products of vectors, some 70
numbers per group and class. Neither the driver nor a task holds columns x classes numbers. The matrices of a group are stored
once, by column for the sums and by row for the products; a pass writes nothing but the vectors.
"""

from __future__ import annotations

import gc
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelscope.functions.scores import argmax_label
from labelscope.runtime import dropped, stored, written

#: Sums (columns x classes) of a block of columns; nonzeros that a product multiplies at once; pairs that L-BFGS remembers.
PIECE, NONZEROS, MEMORY = 1 << 22, 1 << 17, 10
#: Nonzeros of a group of rows; passes after which the groups' vectors are stored and what led to them is dropped.
GROUP, LINEAGE = 1 << 22, 8


def sparse_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, indices, values) of a batch of ML vectors, dense ones included."""
    kind = column.field("type").to_numpy(zero_copy_only=False)
    values = column.field("values")
    size = pc.list_value_length(values).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    flat = pc.list_flatten(values).to_numpy(zero_copy_only=False)
    index = np.arange(len(flat)) - np.repeat(at[:-1], size)
    sparse = np.repeat(kind == 0, size)
    index[sparse] = pc.list_flatten(column.field("indices")).to_numpy(zero_copy_only=False)
    return at, index, flat


def margins(at: np.ndarray, index: np.ndarray, value: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Rows times ``weights`` (columns by class)."""
    found, weights = np.zeros((len(at) - 1, weights.shape[1])), np.ascontiguousarray(weights.T)
    for a, b in row_parts(at, NONZEROS):
        span, full = slice(at[a], at[b]), a + np.flatnonzero(np.diff(at[a:b + 1]))
        if len(full):
            columns, factor, starts = index[span], value[span], at[full] - at[a]
            for k, weight in enumerate(weights):
                found[full, k] = np.add.reduceat(weight.take(columns) * factor, starts)
    return found


def row_parts(at: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Spans of rows with about ``limit`` nonzeros."""
    start = 0
    while start < len(at) - 1:
        stop = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
        yield start, stop
        start = stop


def packed(columns: int, keep: list[str]):
    """Task that makes one row of its rows: their vectors, a last column of ones included, and the columns ``keep`` as an Arrow stream."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, indices, values, kept = [], [], [], []
        for batch in batches:
            at, index, value = sparse_rows(batch.column("features"))
            sizes.append(np.diff(at) + 1)
            indices.append(np.insert(index, at[1:], columns))
            values.append(np.insert(value, at[1:], 1.0))
            kept.append(batch.select(keep))
        if sum(map(len, sizes)):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kept[0].schema) as out:
                for batch in kept:
                    out.write_batch(batch)
            at = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            yield pa.RecordBatch.from_pydict({
                "g": pa.array([TaskContext.get().partitionId()], pa.int64()), "at": [at.astype(np.int64).tobytes()],
                "index": [np.concatenate(indices).astype(np.int32).tobytes()], "value": [np.concatenate(values).tobytes()],
                "kept": [sink.getvalue().to_pybytes()]})

    return task


@dataclass
class Group:
    """Rows of a group. ``columns``: those it has, by block and number; ``index`` gives places among them."""

    at: np.ndarray
    index: np.ndarray
    value: np.ndarray
    columns: np.ndarray
    starts: np.ndarray
    kept: bytes

    def spans(self) -> Iterator[tuple[int, int, int]]:
        return spans(self.starts)


def spans(starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(block, start, stop) of the columns."""
    for b, (start, stop) in enumerate(zip(starts[:-1], starts[1:])):
        if stop > start:
            yield b, start, stop


@dataclass
class ByColumn:
    """A group's numbers in some of its columns: the columns' numbers by block, where each one starts, rows and values."""

    columns: np.ndarray
    starts: np.ndarray
    first: np.ndarray
    row: np.ndarray
    value: np.ndarray

    def sums(self, factors: np.ndarray) -> np.ndarray:
        """Sums of rows times ``factors``, by column and class."""
        factors, found = np.ascontiguousarray(factors.T), np.zeros((len(self.columns), factors.shape[1]))
        at = np.append(self.first, len(self.row))
        for a, b in row_parts(at, NONZEROS):
            row, value, first = self.row[at[a]:at[b]], self.value[at[a]:at[b]], at[a:b] - at[a]
            for k, factor in enumerate(factors):
                found[a:b, k] = np.add.reduceat(factor.take(row) * value, first)
        return found


@dataclass
class ByRow:
    """The same numbers by row; ``index`` gives places among the columns."""

    at: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def products(self, weights: np.ndarray) -> np.ndarray:
        return margins(self.at, self.index, self.value, weights)


@dataclass
class Up:
    """What a group adds up for others: the columns that other groups have too."""

    shared: ByColumn


@dataclass
class Down:
    """What turns sums by column into products: the shared columns by row, and those that no other group has."""

    starts: np.ndarray
    shared: ByRow
    own: ByColumn
    own_rows: ByRow


@dataclass
class Vectors:
    """Vectors of the solver: arrays of (coefficients, products) by row and class."""

    y: np.ndarray
    point: np.ndarray
    slope: np.ndarray
    step: np.ndarray
    trial_slope: np.ndarray
    loss: np.ndarray | None = None
    steps: list = field(default_factory=list)
    turns: list = field(default_factory=list)

    def follow(self, order: "Order") -> None:
        """Takes or drops the last trial, class by class, and makes the next step."""
        for j in sorted(set(order.slot[order.slot >= 0].tolist())):
            if j == len(self.steps):
                self.steps.append(np.zeros_like(self.point))
                self.turns.append(np.zeros_like(self.point))
            here = order.slot == j
            self.steps[j][..., here] = self.step[..., here]
            self.turns[j][..., here] = (self.trial_slope - self.slope)[..., here]
        self.point[..., order.took] += self.step[..., order.took]
        self.slope[..., order.took] = self.trial_slope[..., order.took]
        way = order.mix[0] * self.slope
        for j, (s, t) in enumerate(zip(self.steps, self.turns)):
            way += order.mix[1 + j] * s + order.mix[1 + MEMORY + j] * t
        self.step = order.length * way

    def pull(self, cost_own: np.ndarray, cost_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients of the loss's falling direction at the trial point, and the loss by class."""
        own = self.y[:, None] == np.arange(len(cost_own))
        sign = np.where(own, 1.0, -1.0)
        gap = np.maximum(0.0, 1 - sign * (self.point[1] + self.step[1]))
        cost = np.where(own, cost_own[self.y, None], cost_rest[self.y, None])
        return 2 * cost * sign * gap, (cost * gap * gap).sum(axis=0)

    def products(self) -> tuple[np.ndarray, np.ndarray]:
        """Objective by class; step, turn and slope of the trial times themselves and the remembered pairs (this group's part)."""
        fresh = [self.step, self.trial_slope - self.slope, self.trial_slope]
        times = np.zeros((3, 3 + 2 * MEMORY, self.point.shape[2]))
        others = [*enumerate(fresh), *enumerate(self.steps, 3), *enumerate(self.turns, 3 + MEMORY)]
        for a, one in enumerate(fresh):
            for b, other in others:
                times[a, b] = (one[0] * other[1]).sum(axis=0)
        trial = self.point + self.step
        return 0.5 * (trial[0] * trial[1]).sum(axis=0) + self.loss, times


@dataclass
class Order:
    """What a pass does with each class: whether the last trial holds, the place that its pair gets (or -1), the mix of slope and
    pairs that is the next direction, the length, and whether the class still moves."""

    took: np.ndarray
    slot: np.ndarray
    mix: np.ndarray
    length: np.ndarray
    active: np.ndarray


def place(key: int) -> int:
    """Keys are numbers of partitions."""
    return key


def grouped(row: T.Row, blocks: int) -> tuple[int, Group]:
    """A row of ``packed`` as a group with columns of its own, in blocks by remainder."""
    columns, index = np.unique(np.frombuffer(row["index"], np.int32), return_inverse=True)
    order = np.lexsort((columns, columns % blocks))
    places = np.empty(len(order), np.int32)
    places[order] = np.arange(len(order))
    columns = columns[order]
    starts = np.searchsorted(columns % blocks, np.arange(blocks + 1))
    return row["g"], Group(np.frombuffer(row["at"], np.int64), places[index], np.frombuffer(row["value"]), columns, starts, row["kept"])


def groups_of(rows: DataFrame, columns: int, nonzeros: int, keep: list[str], blocks: int) -> tuple[RDD, int]:
    """The rows in groups, one per partition, and the number of partitions."""
    context = rows.sparkSession.sparkContext
    parts = max(context.defaultParallelism, -(-nonzeros // GROUP))
    made = rows.repartition(parts).mapInArrow(packed(columns, keep), "g long, at binary, index binary, value binary, kept binary")
    return made.rdd.map(lambda row: grouped(row, blocks)).partitionBy(parts, place).persist(StorageLevel.MEMORY_AND_DISK), parts


def together(rdds: list[RDD], answers: RDD | None, parts: int, use) -> RDD:
    """What ``use`` yields for each group, from g, its items of ``rdds`` and its answers by block; the answers travel, the rest
    stays where it is."""

    def task(items: Iterable) -> Iterator[tuple]:
        held, got = {}, {}
        for g, item in items:
            if isinstance(item, tuple):
                got.setdefault(g, {})[item[0]] = item[1]
            else:
                held.setdefault(g, {})[type(item)] = item
        for g, found in held.items():
            yield from use(g, *(found[kind] for kind in sorted(found, key=lambda kind: kind.__name__)), got.get(g, {}))

    whole = rdds[0]
    for rdd in [*rdds[1:], *([] if answers is None else [answers.partitionBy(parts, place)])]:
        whole = whole.union(rdd)
    # what is keyed by block is not where its key says
    return whole.mapPartitions(task, preservesPartitioning=answers is not None)


def count_shared(items: Iterable) -> Iterator[tuple]:
    """Tells each group which of its columns other groups have too."""
    asked: dict[int, list] = {}
    for b, (g, columns) in items:
        asked.setdefault(b, []).append((g, columns))
    for b, asks in asked.items():
        columns, n = np.unique(np.concatenate([c for _, c in asks]), return_counts=True)
        for g, own in asks:
            yield g, (b, n[np.searchsorted(columns, own)] > 1)


def add_up(items: Iterable) -> dict[int, tuple[list, np.ndarray, np.ndarray]]:
    """block -> (messages, columns, sums by column)."""
    sent: dict[int, list] = {}
    for b, message in items:
        sent.setdefault(b, []).append(message)
    found = {}
    for b, messages in sent.items():
        columns = np.unique(np.concatenate([m[1] for m in messages]))
        total = np.zeros((len(columns), messages[0][2].shape[1]))
        for _, own, sums in sorted(messages, key=lambda m: m[0]):
            total[np.searchsorted(columns, own)] += sums
        found[b] = messages, columns, total
    return found


def answer_sums(items: Iterable) -> Iterator[tuple]:
    """Each group gets the sums of the columns that it sent."""
    for b, (messages, columns, total) in add_up(items).items():
        for g, own, _ in messages:
            yield g, (b, total[np.searchsorted(columns, own)])


def by_both(row: np.ndarray, index: np.ndarray, value: np.ndarray, rows: int, columns: np.ndarray, starts: np.ndarray) -> tuple[ByColumn, ByRow]:
    """Numbers in the order of their rows, by column and by row."""
    at = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])
    order = np.argsort(index, kind="stable")
    first = np.searchsorted(index[order], np.arange(len(columns)))
    return ByColumn(columns, starts, first, row[order], value[order]), ByRow(at, index, value)


def begin(groups: RDD, parts: int, blocks: int, classes: int) -> tuple[RDD, RDD, RDD]:
    """Groups that know which columns they share, at the zero point: what they add up, what they multiply, and their vectors."""

    def start(g: int, group: Group, answers: dict) -> Iterator[tuple]:
        shared = np.zeros(len(group.columns), bool)
        for b, a, z in group.spans():
            shared[a:z] = answers[b]
        rows, places = len(group.at) - 1, np.where(shared, np.cumsum(shared), np.cumsum(~shared)).astype(np.int32) - np.int32(1)
        row, several = np.repeat(np.arange(rows, dtype=np.int32), np.diff(group.at)), shared[group.index]
        made = []
        for mine, some in ((shared, several), (~shared, ~several)):
            starts = np.concatenate([[0], np.cumsum(mine)])[group.starts]
            made.append(by_both(row[some], places[group.index[some]], group.value[some], rows, group.columns[mine], starts))
        with pa.ipc.open_stream(group.kept) as stream:
            y = stream.read_all().column("y").to_numpy().astype(np.int64)
        (up, down), (own, own_rows) = made
        yield g, [Up(up), Down(up.starts, down, own, own_rows), Vectors(y, *(np.zeros((2, len(y), classes)) for _ in range(4)))]

    asks = groups.flatMap(lambda x: [(b, (x[0], x[1].columns[a:z])) for b, a, z in x[1].spans()])
    whole = together([groups], asks.partitionBy(blocks, place).mapPartitions(count_shared), parts, start).persist(StorageLevel.MEMORY_AND_DISK)
    found = tuple(whole.mapValues(lambda x, k=k: x[k]).persist(StorageLevel.MEMORY_AND_DISK) for k in range(3))
    for rdd in found:
        rdd._jrdd.count()
    whole.unpersist()
    return found


class Said(AccumulatorParam):
    """What the groups tell the driver, by group; a task that runs twice says the same."""

    def zero(self, value: dict) -> dict:
        return {}

    def addInPlace(self, one: dict, other: dict) -> dict:
        one.update(other)
        return one


def one_pass(up: RDD, down: RDD, vectors: RDD, order: Order, said, parts: int, blocks: int, cost_own: np.ndarray, cost_rest: np.ndarray) -> RDD:
    """The vectors at the next trial, its slope known; their products are ``said``."""

    def send(g: int, up: Up, mine: Vectors, _: dict) -> Iterator[tuple]:
        mine.follow(order)
        sums = up.shared.sums(mine.pull(cost_own, cost_rest)[0][:, order.active])
        for b, a, z in spans(up.shared.starts):
            yield b, (g, up.shared.columns[a:z], sums[a:z])

    def finish(g: int, down: Down, mine: Vectors, answers: dict) -> Iterator[tuple]:
        mine.follow(order)
        pull, mine.loss = mine.pull(cost_own, cost_rest)
        some = pull[:, order.active]
        sums = np.zeros((down.starts[-1], some.shape[1]))
        for b, a, z in spans(down.starts):
            sums[a:z] = answers[b]
        pulled = np.zeros_like(pull)
        pulled[:, order.active] = down.shared.products(sums) + down.own_rows.products(down.own.sums(some))
        mine.trial_slope = mine.point + mine.step - np.stack([pull, pulled])
        said.add({g: mine.products()})
        yield g, mine

    answers = together([up, vectors], None, parts, send).partitionBy(blocks, place).mapPartitions(answer_sums)
    return together([down, vectors], answers, parts, finish)


@dataclass
class Descent:
    """L-BFGS of one class, of which the driver has the products of slope and pairs: places 0, 1 + j (step j) and
    1 + MEMORY + j (turn j)."""

    value: float
    times: np.ndarray
    goal: float
    order: list = field(default_factory=list)
    mix: np.ndarray | None = None
    rise: float = 0.0
    length: float = 1.0

    def norm(self) -> float:
        return max(self.times[0, 0], 0.0) ** 0.5

    def settled(self) -> bool:
        return self.norm() <= self.goal

    def aim(self) -> None:
        """Direction from the remembered pairs (two-loop recursion)."""
        q, factors = np.zeros(1 + 2 * MEMORY), []
        q[0] = 1.0
        for j in reversed(self.order):
            s, t = 1 + j, 1 + MEMORY + j
            factors.append(self.times[s] @ q / self.times[s, t])
            q[t] -= factors[-1]
        if self.order:
            s, t = 1 + self.order[-1], 1 + MEMORY + self.order[-1]
            q *= self.times[s, t] / self.times[t, t]
        for j, a in zip(self.order, reversed(factors)):
            s, t = 1 + j, 1 + MEMORY + j
            q[s] += a - self.times[t] @ q / self.times[s, t]
        self.mix, self.rise = -q, -(self.times[0] @ q)
        self.length = 1.0 if self.order else min(1.0, 1.0 / max(self.norm(), 1e-300))

    def take(self, value: float, fresh: np.ndarray) -> tuple[bool, int]:
        """Accepts the trial point if it descends enough, else shortens the step; ``fresh``: products of the trial's step, turn and
        slope. Returns whether it was accepted and the place of its pair."""
        if value > self.value + 1e-4 * self.length * self.rise and self.length >= 1e-12:
            best = -self.rise * self.length**2 / (2 * (value - self.value - self.rise * self.length))
            self.length = min(max(best, 0.1 * self.length), 0.5 * self.length)
            return False, -1
        slot = -1
        self.put(0, fresh[2, 2], fresh[2, 3:])
        if fresh[0, 1] > 1e-12 * fresh[1, 1]:
            slot = self.order.pop(0) if len(self.order) == MEMORY else len(self.order)
            self.order.append(slot)
            s, t = 1 + slot, 1 + MEMORY + slot
            self.put(s, fresh[0, 2], fresh[0, 3:])
            self.put(t, fresh[1, 2], fresh[1, 3:])
            self.times[s, s], self.times[t, t] = fresh[0, 0], fresh[1, 1]
            self.times[s, t] = self.times[t, s] = fresh[0, 1]
        self.value = value
        self.aim()
        return True, slot

    def put(self, at: int, with_slope: float, with_pairs: np.ndarray) -> None:
        line = np.append(with_slope, with_pairs)
        self.times[at], self.times[:, at] = line, line


def cut(spark: SparkSession, vectors: RDD, parts: int, before: str | None) -> tuple[RDD, str]:
    """``vectors`` read back from a table, and its path; the table ``before`` and the shuffles that led here are dropped."""
    path = written(spark.createDataFrame(vectors.map(lambda x: (x[0], pickle.dumps(x[1]))), "g long, state binary"), "svm-groups")
    vectors.unpersist()
    if before:
        dropped(spark, [before])
    # Spark deletes shuffles when nothing in Python or in the JVM refers to them
    gc.collect()
    spark._jvm.System.gc()
    rows = spark.read.schema("g long, state binary").parquet(path).rdd.map(lambda r: (r["g"], r["state"]))
    return rows.partitionBy(parts, place).mapValues(lambda state: pickle.loads(state)).persist(StorageLevel.MEMORY_AND_DISK), path


def minimise(
    spark: SparkSession, vectors: RDD, parts: int, classes: int, evaluate, said, tolerance: float, max_passes: int
) -> tuple[RDD, Order, str | None]:
    """Vectors, the order that ends them, and the table they come from; every class stops when its gradient is ``tolerance`` times the first one."""
    nothing = np.zeros(classes, bool)
    order = Order(nothing, np.full(classes, -1), np.zeros((1 + 2 * MEMORY, classes)), np.zeros(classes), ~nothing)
    runs: list[Descent] = []
    path = None
    for count in range(max_passes + 1):
        after = evaluate(vectors, order).persist(StorageLevel.MEMORY_AND_DISK)
        said.value = {}
        after._jrdd.count()  # in the JVM: the vectors do not travel to be counted
        told = [found for _, found in sorted(said.value.items())]
        vectors.unpersist()
        vectors, value, fresh = after, sum(p[0] for p in told), sum(p[1] for p in told)
        if count % LINEAGE == LINEAGE - 1:
            after, vectors, path = None, *cut(spark, vectors, parts, path)
        took, slot = nothing.copy(), np.full(classes, -1)
        if not runs:
            took[:] = True
            for k in range(classes):
                times = np.zeros((1 + 2 * MEMORY, 1 + 2 * MEMORY))
                times[0, 0] = fresh[2, 2, k]
                runs.append(Descent(value[k], times, tolerance * max(times[0, 0], 0.0) ** 0.5))
                runs[k].aim()
        else:
            for k in np.flatnonzero(order.active):
                took[k], slot[k] = runs[k].take(value[k], fresh[..., k])
        active = np.array([not run.settled() for run in runs])
        length = np.where(active, [run.length for run in runs], 0.0)
        order = Order(took, slot, np.stack([run.mix for run in runs], axis=1), length, active)
        if not active.any():
            break
    return vectors, order, path


@dataclass
class SvmHead:
    """A fitted head: ``table`` has the sums of each block of columns, (block, columns, weights) in bytes; ``size`` columns, of which
    the last one is the intercept, in ``blocks`` blocks by remainder."""

    classes: list[str]
    table: DataFrame | None
    size: int
    blocks: int
    score_type: str = "decision_function"

    @property
    def weights(self) -> np.ndarray:
        """Weights by column and class, all of them in the driver."""
        found = np.zeros((self.size, len(self.classes)))
        for row in self.table.collect() if self.classes else []:
            found[np.frombuffer(row["columns"], np.int32)] = np.frombuffer(row["weights"]).reshape(-1, len(self.classes))
        return found

    def predict(self, features: DataFrame) -> DataFrame:
        """(other columns of ``features``, y_pred, scores, classes, score_type), stored; scores are the margins."""
        spark, n = features.sparkSession, len(self.classes)
        keep = [f for f in features.schema.fields if f.name != "features"]
        schema = T.StructType([*keep, T.StructField("scores", T.ArrayType(T.DoubleType()))])
        names = F.lit(self.classes)
        rows = features.mapInArrow(width_of, "n long, nonzeros long").agg(F.sum("nonzeros")).first()[0] or 0
        groups, parts = groups_of(features, self.size - 1, rows, [f.name for f in keep], self.blocks)

        def look_up(items: Iterable) -> Iterator[tuple]:
            held, asks = {}, []
            for b, item in items:
                if isinstance(item, T.Row):
                    held[b] = np.frombuffer(item["columns"], np.int32), np.frombuffer(item["weights"]).reshape(-1, n)
                else:
                    asks.append((b, item))
            for b, (g, own) in asks:
                columns, weights = held.get(b, (np.zeros(0, np.int32), np.zeros((0, n))))
                at = np.searchsorted(columns, own)
                known = at < len(columns)
                known[known] = columns[at[known]] == own[known]
                found = np.zeros((len(own), n))
                found[known] = weights[at[known]]
                yield g, (b, found)

        def score(_: int, group: Group, answers: dict) -> Iterator[tuple]:
            weights = np.zeros((len(group.columns), n))
            for b, a, z in group.spans():
                weights[a:z] = answers[b]
            scores = margins(group.at, group.index, group.value, weights)
            with pa.ipc.open_stream(group.kept) as stream:
                kept = stream.read_all().combine_chunks()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(scores) + 1, dtype=np.int32) * n), pa.array(scores.ravel()))
            table = kept.append_column("scores", lists)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            yield (sink.getvalue().to_pybytes(),)

        def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in batch.column("part"):
                    with pa.ipc.open_stream(part.as_py()) as stream:
                        yield from stream

        asks = groups.flatMap(lambda x: [(b, (x[0], x[1].columns[a:z])) for b, a, z in x[1].spans()])
        blocks = self.table.rdd.map(lambda row: (row["block"], row)).partitionBy(self.blocks, place)
        answers = blocks.union(asks.partitionBy(self.blocks, place)).mapPartitions(look_up)
        parts = spark.createDataFrame(together([groups], answers, parts, score), "part binary")
        scored = stored(parts.mapInArrow(unpacked, schema), "svm-scores")
        groups.unpersist()
        return scored.select(
            *[f.name for f in keep], argmax_label(F.col("scores"), names).alias("y_pred"), "scores", names.alias("classes"),
            F.lit(self.score_type).alias("score_type"),
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """The classes with the numbers of columns and blocks, and the weights by block, below ``path``."""
        rows = [(k, c, self.size, self.blocks) for k, c in enumerate(self.classes)]
        spark.createDataFrame(rows, "i int, label string, size long, blocks int").write.parquet(f"{path}/classes")
        self.table.write.parquet(f"{path}/weights")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "SvmHead":
        rows = spark.read.parquet(f"{path}/classes").orderBy("i").collect()
        return SvmHead([r["label"] for r in rows], spark.read.parquet(f"{path}/weights"), rows[0]["size"], rows[0]["blocks"])


def squared_hinge_head(
    features: DataFrame, C: float = 1.0, class_weight: str | None = None, tolerance: float = 1e-4, max_passes: int = 1000
) -> SvmHead:
    """Fits on (label, features); ``class_weight`` 'balanced' weighs a class by n / (K * n_c)."""
    spark = features.sparkSession
    counts = {r["label"]: r["n"] for r in features.groupBy("label").agg(F.count("*").alias("n")).orderBy("label").collect()}
    classes, n = list(counts), sum(counts.values())
    weight = np.array([n / (len(classes) * counts[c]) if class_weight == "balanced" else 1.0 for c in classes])
    rest = C * (weight if len(classes) == 2 else np.ones(len(classes)))
    # each class's index goes into the rows as a number; classes are one literal map
    place_of = F.create_map(*[x for k, c in enumerate(classes) for x in (F.lit(c), F.lit(k))])
    width = features.mapInArrow(width_of, "n long, nonzeros long").agg(F.max("n"), F.sum("nonzeros")).first()
    columns = width[0] or 0
    blocks = max(spark.sparkContext.defaultParallelism, -(-(columns + 1) * len(classes) // PIECE))
    if not classes:
        return SvmHead(classes, None, columns + 1, blocks)
    rows = features.select(F.element_at(place_of, F.col("label")).alias("y"), "features")
    packs, parts = groups_of(rows, columns, width[1], ["y"], blocks)
    up, down, start = begin(packs, parts, blocks, len(classes))
    packs.unpersist()
    said = spark.sparkContext.accumulator({}, Said())
    evaluate = lambda vectors, order: one_pass(up, down, vectors, order, said, parts, blocks, C * weight, rest)
    vectors, last, path = minimise(spark, start, parts, len(classes), evaluate, said, tolerance, max_passes)

    def send(g: int, down: Down, up: Up, mine: Vectors, _: dict) -> Iterator[tuple]:
        mine.follow(last)
        for part in (up.shared, down.own):
            sums = part.sums(mine.point[0])
            for b, a, z in spans(part.starts):
                yield b, (g, part.columns[a:z], sums[a:z])

    def settle(items: Iterable) -> Iterator[tuple]:
        for b, (_, found, total) in add_up(items).items():
            yield b, found.astype(np.int32).tobytes(), total.tobytes()

    sums = together([up, down, vectors], None, parts, send).partitionBy(blocks, place).mapPartitions(settle)
    table = stored(spark.createDataFrame(sums, "block long, columns binary, weights binary"), "svm-weights")
    for used in (up, down, vectors):
        used.unpersist()
    if path:
        dropped(spark, [path])
    return SvmHead(classes, table, columns + 1, blocks)


def width_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns and nonzeros of the vectors of each batch."""
    for batch in batches:
        column = batch.column("features")
        sizes = pc.list_value_length(column.field("values"))
        widest = max(pc.max(sizes).as_py() or 0, pc.max(column.field("size")).as_py() or 0)
        yield pa.RecordBatch.from_pydict({"n": pa.array([widest], pa.int64()), "nonzeros": pa.array([pc.sum(sizes).as_py() or 0], pa.int64())})
