"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. Pairs of a preferred and a
rejected document are drawn from the labels, and the weights minimise the logistic loss
of the pairs' feature differences. A quantile of the strengths is the threshold. All
labelled rows are fitted: they are dealt by hash into blocks, pairs are drawn within a
block, and what comes back from a pass is a block's gradient and Hessian.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.shared import carried, forget, strings, text_key
from waybill.operators.quantiles import exact_quantiles
from waybill.session import materialised, observed

#: Pairs of a fit on rows that the driver holds.
PAIRS = 60_000
#: Labelled rows of a block; rows of either kind it has at least, if need be by copies; pairs a row of its commoner kind.
BLOCK, LEAST, ROUNDS = 4096, 64, 3
#: Score at the threshold.
CUT = 0.7
SEED = 3
MARKS = "#*$%&|<>!?.,;:-_@/()\"'=+"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def features(text: str | None) -> np.ndarray:
    """Figures of a text that don't depend on its language or topic."""
    text = text or ""
    words = _WORD.findall(text)
    n = max(1, len(words))
    raw = text.encode("utf-8", "replace")
    bytes_of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(1, len(raw))
    upper, lower, digit = bytes_of[65:91].sum(), bytes_of[97:123].sum(), bytes_of[48:58].sum()
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    rare = sum(1 for c in counts.values() if c == 1)
    most = max(counts.values(), default=0)
    pairs = len(set(zip(words, words[1:], strict=False)))
    shares = [
        np.log1p(len(words)),
        len(text) / n,
        upper / max(1, upper + lower),
        np.log1p(100 * digit / size),
        np.log1p(100 * bytes_of[128:].sum() / size),
        np.log1p(n / max(1, len(lines))),
        len(counts) / n,
        rare / n,
        most / n,
        pairs / n,
        len(set(lines)) / max(1, len(lines)),
        sum(map(str.isupper, words)) / n,
        sum(map(str.isalpha, words)) / n,
    ]
    return np.array(shares + [np.log1p(100 * bytes_of[ord(m)] / size) for m in MARKS])


def held_out(doc_id: Column) -> Column:
    """Rows that the fit never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, ``CUT`` at the threshold; strengths have unit spread on the fitted rows."""
        z = np.clip(((x - self.mean) / self.scale) @ self.weights - self.cut + np.log(CUT / (1 - CUT)), -30, 30)
        return 1 / (1 + np.exp(-z))


def fitted(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, penalty: float = 1e-3, seed: int = SEED) -> Model:
    """Weights by Newton's method on ``pairs`` seeded (preferred, rejected) pairs.

    The threshold is the quantile of strengths at the share of rejected rows. Without
    rows of both kinds nothing is known and every score is ``CUT``.
    """
    width = len(features(""))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = (x - mean) / scale
    rng = np.random.default_rng(seed)
    gap = x[good[rng.integers(len(good), size=pairs)]] - x[bad[rng.integers(len(bad), size=pairs)]]
    w = _newton(lambda w: tuple(a / pairs for a in _slopes(gap, w)), width, penalty)
    s = x @ w
    spread = s.std() or 1.0
    return Model(mean, scale, w / spread * 3, float(np.quantile(s / spread * 3, len(bad) / (len(good) + len(bad)))))


def _slopes(gap: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the pairs' logistic loss."""
    p = 1 / (1 + np.exp(-np.clip(gap @ w, -30, 30)))
    return gap.T @ (p - 1), (gap * (p * (1 - p))[:, None]).T @ gap


def _newton(mean_slopes: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], width: int, penalty: float) -> np.ndarray:
    """Weights where the penalised loss is least."""
    w = np.zeros(width)
    for _ in range(30):
        slope, curve = mean_slopes(w)
        step = np.linalg.solve(curve + penalty * np.eye(width), slope + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


@F.arrow_udf(T.BinaryType())
def _features(text: pa.Array) -> pa.Array:
    forget()
    return pa.array([features(t).tobytes() for t in strings(text)], pa.binary())


def _matrix(x: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(x)).reshape(len(x), -1)


def _measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d_id, key, x): features in place of texts."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("d_id"), text_key(text).alias("key"), _features(text).alias("x"))


def _labelled(measured: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(hash, y, x): the rows that a fit may use, those that repeat id, text and label once."""
    known = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("y"))
    known = known.where(F.col("l_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("l_id"))).distinct()
    found = measured.join(known, measured["d_id"] == known["l_id"])
    # Features of equal texts are equal, so any one of them stands for all.
    found = found.select("d_id", "y", "key", "x").dropDuplicates(["d_id", "y", "key"])
    return found.select(F.xxhash64("d_id", "key").alias("hash"), "y", "x")


def _dealt(rows: DataFrame, counts: tuple[int, int]) -> DataFrame:
    """(block, x, y, own): arrays of the rows dealt to a block by their hash.

    Every block has to have rows of both kinds. Of a kind that is too rare for that each
    row is copied to the blocks after its own; ``own`` tells rows from copies.
    """
    n = -(-sum(counts) // BLOCK)
    copies = [min(n, max(1, -(-n * LEAST // c))) for c in counts]
    each = F.sequence(F.lit(0), F.when(F.col("y") == 1, copies[1] - 1).otherwise(copies[0] - 1))
    placed = rows.select("hash", "y", "x", F.explode(each).alias("copy"))
    placed = placed.withColumn("block", F.pmod(F.col("hash") + F.col("copy"), F.lit(n)))

    def packed(block: pa.Table) -> pa.Table:
        block = block.sort_by([("copy", "ascending"), ("hash", "ascending"), ("y", "ascending")])
        y, own = block.column("y").to_numpy().astype(np.int8), (block.column("copy").to_numpy() == 0).astype(np.int8)
        x = b"".join(block.column("x").to_pylist())
        return pa.table({"block": block.column("block")[:1], **{n: pa.array([v], pa.binary()) for n, v in (("x", x), ("y", y.tobytes()), ("own", own.tobytes()))}})

    # Told how many, as adaptive execution would put blocks into one task and each pass would read them in one.
    return placed.repartition(min(n, 1000), "block").groupBy("block").applyInArrow(packed, "block long, x binary, y binary, own binary")


Block = tuple[int, np.ndarray, np.ndarray, np.ndarray]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Number, features, labels and marks of own rows of each block."""
    for b in batches:
        for r in range(b.num_rows):
            number, x, y, own = (b.column(c)[r] for c in ("block", "x", "y", "own"))
            y = np.frombuffer(y.as_buffer(), np.int8)
            yield number.as_py(), np.frombuffer(x.as_buffer()).reshape(len(y), -1), y, np.frombuffer(own.as_buffer(), np.int8) == 1


def _per_block(blocks: DataFrame, figures: Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """What ``figures`` says of each block, in order of their numbers, so that sums are the same in every run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([block[0]], pa.int64()), pa.array([figures(*block).tobytes()], pa.binary())], ["block", "figures"])

    return [np.frombuffer(r["figures"]) for r in sorted(blocks.mapInArrow(run, "block long, figures binary").collect(), key=lambda r: r["block"])]


def _moments(parts: list[np.ndarray]) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and standard deviation from each block's (rows, mean, squares about it)."""
    n, mean, squares = 0.0, 0.0, 0.0
    for part in parts:
        m, (mid, around) = part[0], np.split(part[1:], 2)
        if m:
            gap = mid - mean
            n, mean, squares = n + m, mean + gap * m / (n + m), squares + around + gap**2 * n * m / (n + m)
    return int(n), mean, np.sqrt(squares / n)


def _moment_parts(x: np.ndarray) -> np.ndarray:
    mean = x.mean(0) if len(x) else np.zeros(x.shape[1])
    return np.concatenate([[len(x)], mean, ((x - mean) ** 2).sum(0)])


def _paired(number: int, y: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a block's preferred and rejected rows, pair by pair: each row is in ``ROUNDS`` pairs or more."""
    rng = np.random.default_rng([seed, number])
    sides = [np.flatnonzero(y == 1), np.flatnonzero(y == 0)]
    most = max(map(len, sides))
    if not all(map(len, sides)):
        return np.zeros(0, int), np.zeros(0, int)
    # Each side in random orders, one after the other, the rarer as often as it takes.
    laid = [np.concatenate([rng.permutation(s) for _ in range(-(-most * ROUNDS // len(s)))])[: most * ROUNDS] for s in sides]
    return laid[0], laid[1]


def _fitted_blocks(blocks: DataFrame, counts: tuple[int, int], penalty: float = 1e-3, seed: int = SEED) -> Model:
    """``fitted`` by passes over blocks: all rows, pairs of rows of one block."""
    width = len(features(""))
    _, mean, scale = _moments(_per_block(blocks, lambda _, x, y, own: _moment_parts(x[own])))
    scale = np.where(scale > 1e-9, scale, 1.0)

    def sums(w: np.ndarray):
        def figures(number: int, x: np.ndarray, y: np.ndarray, own: np.ndarray) -> np.ndarray:
            good, bad = _paired(number, y, seed)
            total = np.zeros(1 + width + width * width)
            for at in range(0, len(good), BLOCK):
                gap = (x[good[at : at + BLOCK]] - x[bad[at : at + BLOCK]]) / scale
                slope, curve = _slopes(gap, w)
                total += np.concatenate([[len(gap)], slope, curve.ravel()])
            return total

        return figures

    def mean_slopes(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = sum(_per_block(blocks, sums(w)))
        return total[1 : 1 + width] / total[0], total[1 + width :].reshape(width, width) / total[0]

    w = _newton(mean_slopes, width, penalty)

    def strengths(x: np.ndarray) -> np.ndarray:
        return ((x - mean) / scale) @ w

    _, _, spread = _moments(_per_block(blocks, lambda _, x, y, own: _moment_parts(strengths(x[own])[:, None])))
    w = w / (spread[0] or 1.0) * 3

    def own_strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x, _, own in _blocks(batches):
            s = strengths(x[own])
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(s), np.int32)), pa.array(s)], ["all", "strength"])

    share = counts[0] / sum(counts)
    cut = exact_quantiles(blocks.mapInArrow(own_strengths, "all int, strength double"), ["all"], "strength", {"cut": share}, few_groups=True)
    return Model(mean, scale, w, float(cut.first()["cut"]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int | None = None) -> Model:
    """Fit on all labelled documents, or on ``rows`` of them, chosen by hash of ids and texts, where that is given.

    Held-out rows, null labels and labels other than 0 and 1 are never used; an id with
    both labels counts with both. Rows that repeat id and text are one document; of an id
    with several texts each counts. Texts become features where they lie; features are
    written with their labels, dealt into blocks and read by each pass. Only sums a block
    come to the driver, or the ``rows`` that were asked for.
    """
    return _fit(_measured(docs.where(~held_out(F.col(id_col))), id_col, text_col), labels, id_col, label_col, rows)


def _fit(measured: DataFrame, labels: DataFrame, id_col: str, label_col: str, rows: int | None = None) -> Model:
    found = _labelled(measured, labels, id_col, label_col)
    if rows is not None:
        got = sorted((r["hash"], r["y"], r["x"]) for r in found.orderBy("hash", "y").limit(rows).toLocalIterator())
        return fitted(_matrix([g[2] for g in got]), np.array([g[1] for g in got], int))
    found, seen = observed(found, rows=F.count(F.lit(1)), good=F.coalesce(F.sum("y"), F.lit(0)))
    # Without any row Spark may leave the figures out.
    counts = (seen.get("rows", 0) - seen.get("good", 0), seen.get("good", 0))
    if not all(counts):
        return fitted(np.zeros((0, len(features("")))), np.zeros(0, int))
    return _fitted_blocks(materialised(_dealt(found, counts)), counts)


def score_of(model: Model, text: Column) -> Column:
    """The model's score of each whole text, from 0 to 1; a null text is scored as empty."""

    @F.arrow_udf(T.DoubleType())
    def score(text: pa.Array) -> pa.Array:
        forget()
        if not len(text):
            return pa.array([], pa.float64())
        return pa.array(model.scores(np.stack([features(t) for t in strings(text)])))

    return score(text)


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, that score ``CUT`` or more."""
    rows = carried(docs).withColumn("score", score_of(model, F.col("row")[text_col]))
    return rows.where(F.col("score") >= CUT).select("row.*")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``.

    predicted is 1 from score ``CUT`` on. Null ids are not held out. Without usable labels
    every score is ``CUT`` and nothing is rejected. Other columns are ignored; an empty
    table gives an empty result.
    """
    rows = materialised(_measured(docs, id_col, text_col))
    model = _fit(rows.where(~held_out(F.col("d_id"))), labels, id_col, label_col)

    @F.pandas_udf(T.DoubleType())
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(_matrix(list(x))) if len(x) else [], dtype=float)

    rows = rows.select(F.col("d_id").alias("doc_id"), score("x").alias("score"))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
