"""Multinomial logistic regression on sparse rows, by Newton's method.

Two ways to the same optimum; the steps of both come from conjugate gradients, one product
with the Hessian a pass, which never is whole. ``fit_softmax`` keeps rows on the executors,
sends them the coefficients and adds up what has the size of the model. ``fit_by_rows`` is for
more terms than rows: the penalty makes the best coefficients sums over the rows' entries, so
the driver holds a figure per row and class, executors keep the entries by ranges of
positions, and coefficients are only ever made there, a range at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.operators.workers import settle_worker
from waybill.session import materialised

#: Rows of a block of arrays.
STEP = 2048
#: Bytes of sums that the driver adds up itself; more are added on the executors first.
DIRECT = 1 << 26

#: Entries of a range of positions that are kept together, and of a task's ranges from which there are more tasks.
RANGE, TASK = 1 << 17, 1 << 23
#: Entries of a written block: large values take Parquet's writer large buffers outside the heap.
WRITTEN = 1 << 15

#: An entry in a range.
ENTRY = np.dtype([("at", np.int32), ("position", np.int32), ("value", np.float64)])

#: Row, position and value of each entry; label and weight of each row.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class SoftmaxFit:
    """Coefficients as (class, position), one intercept a class, and the passes that they took."""

    coefficients: np.ndarray = field(repr=False)
    intercepts: np.ndarray
    passes: int

    def table(self, rows: DataFrame) -> DataFrame:
        """(position, b): a coefficient a class of every position; ``rows`` only gives the session."""
        k, size = self.coefficients.shape
        lists = pa.FixedSizeListArray.from_arrays(pa.array(self.coefficients.T.ravel()), k).cast(pa.list_(pa.float64()))
        return rows.sparkSession.createDataFrame(pa.table({"position": pa.array(range(size), pa.int64()), "b": lists}))


@dataclass(frozen=True)
class RowFit:
    """Coefficients as a written table (position, b), ``b`` a list by class; intercepts and passes."""

    coefficients: DataFrame = field(repr=False)
    intercepts: np.ndarray
    passes: int


def entry_arrays(entries: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and value of each entry of a column of lists of them."""
    flat = entries.flatten()
    lengths = pc.fill_null(pc.list_value_length(entries), 0).to_numpy(zero_copy_only=False)
    at = np.repeat(np.arange(len(entries)), lengths)
    return at, flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)


def _margins(at, position, value, n: int, beta: np.ndarray) -> np.ndarray:
    """(class, row); the last column of ``beta`` holds what every row gets."""
    return np.stack([np.bincount(at, value * b[position], n) + b[-1] for b in beta])


def _softmax(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities, and the logarithm of the sum of exponentials."""
    top = z.max(axis=0)
    e = np.exp(z - top)
    total = e.sum(axis=0)
    return e / total, top + np.log(total)


def _by_position(at, position, value, rows: np.ndarray, width: int) -> np.ndarray:
    """(class, position): sums of each row's figure times its entries; last, of the rows alone."""
    out = np.stack([np.bincount(position, value * r[at], width) for r in rows])
    out[:, -1] += rows.sum(axis=1)
    return out


def _blocks(rows: DataFrame) -> RDD:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, STEP):
                b = whole.slice(start, STEP)
                arrays = [*entry_arrays(b.column("entries")), b.column("label").to_numpy(), b.column("weight").to_numpy()]
                kinds = (np.int32, np.int32, np.float64, np.int32, np.float64)
                parts = [pa.array([a.astype(k).tobytes()], pa.binary()) for a, k in zip(arrays, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(parts, ["at", "position", "value", "label", "weight"])

    def block(r) -> Block:
        return tuple(np.frombuffer(r[n], k) for n, k in (("at", np.int32), ("position", np.int32), ("value", float), ("label", np.int32), ("weight", float)))

    schema = "at binary, position binary, value binary, label binary, weight binary"
    return rows.select("entries", "label", "weight").mapInArrow(packed, schema).rdd.map(block).persist(StorageLevel.MEMORY_AND_DISK)


class _Passes:
    """Sums over the kept blocks."""

    def __init__(self, blocks: RDD, shape: tuple[int, int]) -> None:
        self.blocks, self.shape, self.made = blocks, shape, 0
        self.tasks = blocks.getNumPartitions()

    def _total(self, compute, size: int, *given: np.ndarray) -> np.ndarray:
        self.made += 1
        sent = self.blocks.context.broadcast(given)

        def partial(some: Iterator[Block]) -> Iterator[np.ndarray]:
            settle_worker()
            total = np.zeros(size)
            for b in some:
                compute(total, b, *sent.value)
            yield total

        parts = self.blocks.mapPartitions(partial)
        total = parts.treeReduce(np.add) if self.tasks * size * 8 > DIRECT else sum(parts.collect())
        sent.unpersist()
        return total

    def slopes(self, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss, gradient and diagonal of the Hessian."""
        k, width = self.shape
        size = k * width

        def compute(total: np.ndarray, b: Block, beta: np.ndarray) -> None:
            at, position, value, label, weight = b
            z = _margins(at, position, value, len(label), beta)
            p, log_sum = _softmax(z)
            rows = np.arange(len(label))
            total[0] += np.sum(weight * (log_sum - z[label, rows]))
            total[1 + size :] += _by_position(at, position, value**2, weight * p * (1 - p), width).ravel()
            p[label, rows] -= 1
            total[1 : 1 + size] += _by_position(at, position, value, weight * p, width).ravel()

        flat = self._total(compute, 1 + 2 * size, beta)
        return float(flat[0]), flat[1 : 1 + size].reshape(self.shape), flat[1 + size :].reshape(self.shape)

    def product(self, beta: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The Hessian at ``beta`` times ``v``."""
        width = self.shape[1]

        def compute(total: np.ndarray, b: Block, beta: np.ndarray, v: np.ndarray) -> None:
            at, position, value, label, weight = b
            p, _ = _softmax(_margins(at, position, value, len(label), beta))
            u = _margins(at, position, value, len(label), v)
            total += _by_position(at, position, value, weight * p * (u - (p * u).sum(axis=0)), width).ravel()

        return self._total(compute, self.shape[0] * width, beta, v).reshape(self.shape)


def fit_softmax(rows: DataFrame, size: int, classes: int, ridge: float = 1.0, tolerance: float = 1e-8, most_steps: int = 100) -> SoftmaxFit:
    """Fit on rows of (entries, label, weight): positions below ``size`` with values, a class number, a weight.

    The objective is the sum of weighted log losses plus ``ridge`` |coefficients|^2 / 2,
    intercepts being free; they are centred, as a common shift changes nothing. It ends when no part
    of the gradient, per unit of weight, is above ``tolerance``. A step that doesn't lower the
    objective is halved.
    """
    shape = (classes, size + 1)
    penalty = np.full(shape, ridge)
    penalty[:, -1] = 0.0
    blocks = _blocks(rows)
    passes = _Passes(blocks, shape)
    weight = blocks.map(lambda b: float(b[4].sum())).sum()

    def objective(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, gradient, diagonal = passes.slopes(beta)
        return loss + 0.5 * float((penalty * beta**2).sum()), gradient + penalty * beta, diagonal + penalty

    beta = np.zeros(shape)
    loss, gradient, diagonal = objective(beta)
    first = np.abs(gradient).max()
    for _ in range(most_steps):
        worst = np.abs(gradient).max()
        if worst <= tolerance * weight:
            break
        move = _solved(lambda v, b=beta: passes.product(b, v) + penalty * v, gradient, diagonal, min(0.1, float(np.sqrt(worst / first))))
        slope, share = float((gradient * move).sum()), 1.0
        while True:
            tried = beta - share * move
            found = objective(tried)
            if found[0] <= loss - 1e-4 * share * slope + 1e-12 * abs(loss) or share < 1e-6:
                break
            share /= 2
        if share < 1e-6:
            break
        beta, (loss, gradient, diagonal) = tried, found
    blocks.unpersist()
    return SoftmaxFit(beta[:, :-1], beta[:, -1] - beta[:, -1].mean(), passes.made)


def _solved(product, wanted: np.ndarray, diagonal: np.ndarray, share: float, most: int = 500) -> np.ndarray:
    """x with product(x) = ``wanted``, but for ``share`` of its norm, by conjugate gradients scaled by the diagonal."""
    scale = 1 / np.maximum(diagonal, 1e-12)
    x, left = np.zeros_like(wanted), wanted.copy()
    z = scale * left
    way, size = z, float((left * z).sum())
    enough = share**2 * size
    for _ in range(most):
        if size <= enough:
            break
        turned = product(way)
        curve = float((way * turned).sum())
        if curve <= 0:
            break
        step = size / curve
        x, left = x + step * way, left - step * turned
        z = scale * left
        new = float((left * z).sum())
        way, size = z + new / size * way, new
    return x if x.any() else scale * wanted


# --- more terms than rows ----------------------------------------------------


class _Ranges:
    """The entries of all rows by ranges of positions, and labels and weights of the rows."""

    def __init__(self, rows: DataFrame, size: int) -> None:
        self.spark = rows.sparkSession
        blocks = materialised(rows.select("entries", "label", "weight").mapInArrow(_numbered_blocks, "block long, label binary, weight binary, n long, entries binary"))
        found = sorted(blocks.select("block", "label", "weight", "n").collect(), key=lambda r: r["block"])
        self.label = np.concatenate([np.frombuffer(r["label"], np.int32) for r in found] or [np.zeros(0, np.int32)])
        self.weight = np.concatenate([np.frombuffer(r["weight"]) for r in found] or [np.zeros(0)])
        self.n, n_entries = len(self.label), sum(r["n"] for r in found)
        lengths = [len(r["label"]) // 4 for r in found]
        first = {r["block"]: int(end - n) for r, n, end in zip(found, lengths, np.cumsum(lengths), strict=True)}
        self.tasks = max(self.spark.sparkContext.defaultParallelism, -(-n_entries // TASK))
        # Each range takes a task an array of all rows, so it has as many entries at least.
        parts = self.tasks * max(1, -(-n_entries // (self.tasks * max(RANGE, self.n))))
        width = -(-size // parts)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for block, given in zip(b.column("block").to_pylist(), b.column("entries"), strict=True):
                    entries = np.frombuffer(given.as_buffer(), ENTRY)
                    entries = entries[np.argsort(entries["position"], kind="stable")]
                    part, start = np.unique(entries["position"] // width, return_index=True)
                    ends = [*start[1:], len(entries)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part, pa.int32()), pa.array([first[block]] * len(part), pa.int64()), pa.array([entries[s:e].tobytes() for s, e in zip(start, ends, strict=True)], pa.binary())],
                        ["part", "first", "entries"],
                    )

        def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces: dict[int, list[np.ndarray]] = {}
            for b in batches:
                for part, start, given in zip(b.column("part").to_pylist(), b.column("first").to_pylist(), b.column("entries").to_pylist(), strict=True):
                    piece = np.frombuffer(given, ENTRY).copy()
                    piece["at"] += start
                    pieces.setdefault(part, []).append(piece)
            for part in sorted(pieces):
                whole = np.concatenate(pieces.pop(part))
                whole = whole[np.lexsort((whole["at"], whole["position"]))]
                yield pa.RecordBatch.from_arrays([pa.array([part * width], pa.int64()), pa.array([whole.tobytes()], pa.binary())], ["start", "entries"])

        cuts = blocks.select("block", "entries").mapInArrow(cut, "part int, first long, entries binary")
        dealt = cuts.repartitionById(self.tasks, F.col("part") % self.tasks)
        self.size, self.width, self.passes = size, width, 0
        found = dealt.mapInArrow(gathered, "start long, entries binary")
        self.kept = found.rdd.map(lambda r: (r["start"], r["entries"])).persist(StorageLevel.MEMORY_AND_DISK)

    def product(self, figures: np.ndarray) -> np.ndarray:
        """(class, row): every row's entries times the coefficients that ``figures`` (class, row) give."""
        self.passes += 1
        width, shape = self.width, figures.shape
        sent = self.kept.context.broadcast(figures)

        def partial(some: Iterator[tuple[int, bytes]]) -> Iterator[np.ndarray]:
            settle_worker()
            total = np.zeros(shape)
            for start, given in some:
                at, position, value = _columns(given, start)
                for out, f in zip(total, sent.value, strict=True):
                    b = np.bincount(position, value * f[at], width)
                    out += np.bincount(at, value * b[position], shape[1])
            yield total

        parts = self.kept.mapPartitions(partial)
        several = self.kept.getNumPartitions()
        total = parts.treeReduce(np.add) if several * figures.nbytes > DIRECT else sum(parts.collect(), np.zeros(shape))
        sent.destroy()
        return total

    def coefficients(self, figures: np.ndarray) -> DataFrame:
        """(position, b) of all positions: the sums over rows of their entries times their figures, written."""
        width, size = self.width, self.size
        sent = self.kept.context.broadcast(figures)

        def found(some: Iterator[tuple[int, bytes]]) -> Iterator[tuple[int, list[float]]]:
            for start, given in some:
                at, position, value = _columns(given, start)
                n = min(width, size - start)
                sums = np.column_stack([np.bincount(position, value * f[at], n) for f in sent.value])
                yield from zip(range(start, start + n), sums.tolist(), strict=True)

        rows = self.kept.mapPartitions(found)
        return materialised(self.spark.createDataFrame(rows, "position long, b array<double>"))


def _columns(given, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, positions from ``start`` on and values, each in one piece."""
    entries = np.frombuffer(given, ENTRY)
    return entries["at"].copy(), entries["position"] - start, entries["value"].copy()


def _numbered_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some thousand rows a block, fewer of long ones; its number is that of its task and its own within it."""
    block = TaskContext.get().partitionId() << 32
    for whole in batches:
        n_entries = len(whole.column("entries").flatten())
        step = max(1, min(STEP, whole.num_rows * WRITTEN // max(n_entries, 1)))
        for start in range(0, whole.num_rows, step):
            b = whole.slice(start, step)
            at, position, value = entry_arrays(b.column("entries"))
            entries = np.empty(len(at), ENTRY)
            entries["at"], entries["position"], entries["value"] = at, position, value
            label, weight = b.column("label").to_numpy().astype(np.int32), b.column("weight").to_numpy().astype(float)
            parts = [pa.array([a.tobytes()], pa.binary()) for a in (label, weight, entries)]
            yield pa.RecordBatch.from_arrays([pa.array([block]), *parts[:2], pa.array([len(at)]), parts[2]], ["block", "label", "weight", "n", "entries"])
            block += 1


def fit_by_rows(rows: DataFrame, size: int, classes: int, ridge: float = 1.0, tolerance: float = 1e-8, most_steps: int = 100) -> RowFit:
    """``fit_softmax`` with a figure per row and class in place of coefficients.

    Coefficients that are sums of the rows' entries times figures a have the margins K a, K being
    the rows' inner products; gradient, steps and their products with the Hessian are such
    sums too. A pass multiplies by K, range by range of positions, without K being whole. It ends when
    the norm of the gradient, per unit of weight, is at most ``tolerance``.
    """
    ranges = _Ranges(rows, size)
    weight, rows_now = ranges.weight, np.arange(ranges.n)
    label = np.zeros((classes, ranges.n))
    label[ranges.label, rows_now] = 1.0

    def objective(a: np.ndarray, ka: np.ndarray, b: np.ndarray) -> tuple[float, np.ndarray]:
        z = ka + b[:, None]
        p, log_sum = _softmax(z)
        return float(np.sum(weight * (log_sum - z[ranges.label, rows_now]))) + 0.5 * ridge * float((a * ka).sum()), p

    a, ka, b = np.zeros(label.shape), np.zeros(label.shape), np.zeros(classes)
    loss, p = objective(a, ka, b)
    first = None
    for _ in range(most_steps):
        miss = weight * (p - label)
        slope, slope_b = ridge * a + miss, miss.sum(axis=1)
        k_slope = ranges.product(slope)
        worst = float(np.sqrt(max((slope * k_slope).sum(), 0.0) + (slope_b**2).sum()))
        first = worst if first is None else first
        if worst <= tolerance * weight.sum():
            break
        x, kx, x_b = _solved_by_rows(ranges.product, p, weight, ridge, (slope, k_slope, slope_b), min(0.1, float(np.sqrt(worst / first))))
        down, share = float((slope * kx).sum() + (slope_b * x_b).sum()), 1.0
        while True:
            tried = (a - share * x, ka - share * kx, b - share * x_b)
            found, p_found = objective(*tried)
            if found <= loss - 1e-4 * share * down + 1e-12 * abs(loss) or share < 1e-6:
                break
            share /= 2
        if share < 1e-6:
            break
        (a, ka, b), loss, p = tried, found, p_found
    coefficients = ranges.coefficients(a)
    ranges.kept.unpersist()
    return RowFit(coefficients, b - b.mean(), ranges.passes)


def _solved_by_rows(product, p: np.ndarray, weight: np.ndarray, ridge: float, wanted: tuple, share: float, most: int = 500) -> tuple:
    """Figures x, K x and intercepts that the Hessian turns into ``wanted``, but for ``share`` of its norm.

    Conjugate gradients, scaled by the ridge and the mean curvature of a row, and by the curvature of the intercepts.
    """
    curve_b = np.maximum((weight * p * (1 - p)).sum(axis=1), 1e-12)
    flat = ridge + float(curve_b.sum()) / p.size
    left, k_left, left_b = wanted
    size = float((left * k_left).sum() / flat + (left_b**2 / curve_b).sum())
    way, k_way, way_b = left / flat, k_left / flat, left_b / curve_b
    x, kx, x_b = np.zeros_like(left), np.zeros_like(left), np.zeros_like(left_b)
    enough = share**2 * size
    for _ in range(most):
        if size <= enough:
            break
        u = k_way + way_b[:, None]
        bent = weight * p * (u - (p * u).sum(axis=0))
        turned, turned_b = ridge * way + bent, bent.sum(axis=1)
        curve = float((k_way * turned).sum() + (way_b * turned_b).sum())
        if curve <= 0:
            break
        step = size / curve
        x, kx, x_b = x + step * way, kx + step * k_way, x_b + step * way_b
        left, left_b = left - step * turned, left_b - step * turned_b
        k_left = product(left)
        new = float((left * k_left).sum() / flat + (left_b**2 / curve_b).sum())
        way, k_way, way_b = left / flat + new / size * way, k_left / flat + new / size * k_way, left_b / curve_b + new / size * way_b
        size = new
    return x, kx, x_b
