"""Embedding near-duplicates by randomised-rotation binary codes.

Each vector is turned by one random rotation and kept as its signs and one factor, after
RaBitQ (Gao and Long 2024): signs of one vector against the turned other vector, divided
by the factor, estimate their inner product without bias, and the factor bounds the
error. Only pairs whose upper confidence bound reaches the threshold are computed
again, in double precision. Which pairs meet at all is decided by an inverted index:
a vector lives in the list of its nearest centroid and visits those of its next nearest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.components import components, tile_labels
from waybill.llm.tiles import bounds, grouped
from waybill.session import materialised

THRESHOLD = 0.95
#: Half-width of the confidence bound in standard errors: a link is missed with a chance below 1e-6.
SIGMAS = 5.0
#: Rows a centroid, most centroids, rows a centroid in the fitting sample, lists a vector is in.
LIST_ROWS, MOST_LISTS, SAMPLE_ROWS, LISTS = 512, 4096, 16, 6
#: Rows of one side of a tile.
TILE = 1024
SEED = 11


def valid(batch: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions and unit vectors of the rows that can have links."""
    at, out = [], []
    for i, v in enumerate(batch.to_pylist()):
        if v is None or not len(v) or any(x is None for x in v):
            continue
        x = np.array(v, np.float64)
        if not np.isfinite(x).all():
            continue
        # Scaled by the largest component first, so huge and tiny vectors have a norm too.
        top = np.abs(x).max()
        if top > 0:
            x = x / top
            at.append(i)
            out.append(x / np.sqrt(x @ x))
    return np.array(at, np.int64), out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, width, unit as bytes), unit null where the vector links with nothing."""
    for b in batches:
        at, vectors = valid(b.column("embedding"))
        unit: list[bytes | None] = [None] * b.num_rows
        width = np.zeros(b.num_rows, np.int32)
        for i, v in zip(at, vectors, strict=True):
            unit[i] = v.tobytes()
            width[i] = len(v)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(width), pa.array(unit, pa.binary())], ["vec_id", "width", "unit"])


def rotation(width: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for the same width everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([seed, width]).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def fitted_centroids(classes: DataFrame, width: int, n: int, sample_rows: int, list_rows: int, most: int) -> np.ndarray:
    """Unit centroids from a bounded sample: rows of smallest hash, a few rounds of spherical k-means."""
    k = int(min(most, max(1, n // list_rows)))
    rows = classes.where(F.col("width") == width).select("unit").orderBy(F.xxhash64("unit"), "unit").limit(k * sample_rows).collect()
    x = np.frombuffer(b"".join(bytes(r["unit"]) for r in rows)).reshape(-1, width)
    c = x[:k]
    for _ in range(4 if k > 1 else 0):
        best = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        total = np.zeros((k, width))
        np.add.at(total, best, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 1e-9, total / np.maximum(norm, 1e-9), c)
    return c


def _listed(centroids: dict[int, np.ndarray], lists: int):
    """(cls, width, unit, lists): the nearest list first, then those that are visited."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            width = b.column("width").to_numpy()
            out: list[np.ndarray] = [np.zeros(0, np.int32)] * b.num_rows
            units = b.column("unit")
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                c = centroids[int(w)]
                x = np.frombuffer(b"".join(units[int(i)].as_py() for i in at)).reshape(-1, w)
                near = x @ c.T
                m = min(lists, c.shape[0])
                top = np.argpartition(-near, m - 1, axis=1)[:, :m] if m < c.shape[0] else np.tile(np.arange(m), (len(at), 1))
                top = np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1)
                for i, row in zip(at, top, strict=True):
                    out[i] = row.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("cls"), b.column("n"), b.column("width"), units, pa.array([o.tolist() for o in out], pa.list_(pa.int32()))],
                ["cls", "n", "width", "unit", "lists"],
            )

    return run


def _candidates(x: np.ndarray, y: np.ndarray, threshold: float, sigmas: float, turn: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first row of x, mask of pairs to compute) by slices of x.

    ``est`` = <signs of x, turned y> / (sqrt(d) f) with f = <signs / sqrt(d), turned x>; its
    error has standard deviation at most sqrt((1 - f^2) / f^2) / sqrt(d - 1).
    """
    d = x.shape[1]
    tx, ty = x @ turn, (y @ turn).astype(np.float32)
    f = np.abs(tx).sum(1) / np.sqrt(d)
    signs = (np.where(tx >= 0, 1.0, -1.0) / (np.sqrt(d) * f[:, None])).astype(np.float32)
    slack = sigmas * np.sqrt(np.maximum(0.0, 1 - f * f) / (f * f)) / np.sqrt(max(1, d - 1)) + 1e-4
    for at in range(0, len(x), 256):
        est = signs[at : at + 256] @ ty.T
        yield at, est >= (threshold - slack[at : at + 256]).astype(np.float32)[:, None]


def links_between(x: np.ndarray, y: np.ndarray, threshold: float, sigmas: float, turn: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (of x, of y) whose double-precision cosine reaches the threshold."""
    for at, mask in _candidates(x, y, threshold, sigmas, turn):
        i, j = np.nonzero(mask)
        for s in range(0, len(i), 1 << 16):
            a, b = i[s : s + (1 << 16)] + at, j[s : s + (1 << 16)]
            near = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
            yield a[near], b[near]


def _compared(threshold: float, sigmas: float):
    keys = ["width", "list", "first", "second"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, keys):
            at = bounds(table, keys)
            for s, e in zip(at, at[1:], strict=False):
                g = table.slice(s, e - s)
                width, here = g.column("width")[0].as_py(), g.column("list")[0].as_py()
                turn = rotation(width)
                cls, n = g.column("cls").to_numpy(), g.column("n").to_numpy()
                x = np.frombuffer(b"".join(g.column("unit").to_pylist())).reshape(-1, width)
                home = g.column("home").to_numpy()
                lists = g.column("lists").to_pylist()
                # A tile of homes meets homes or visitors, each pair of rows once.
                one = g.column("first")[0].as_py() == g.column("second")[0].as_py()
                side = g.column("side").to_numpy()
                left = np.arange(len(x)) if one else np.flatnonzero(side == 0)
                right = left if one else np.flatnonzero(side == 1)
                count = np.zeros(len(x), np.int64)
                pairs = []
                for i, j in links_between(x[left], x[right], threshold, sigmas, turn):
                    a, b = left[i], right[j]
                    ok = a < b if one else np.ones(len(a), bool)
                    # Two visitors meet elsewhere; a pair that meets in both its lists counts in the smaller.
                    ok &= home[a] | home[b]
                    for p in np.flatnonzero(ok & ~(home[a] & home[b])):
                        own, guest = (a[p], b[p]) if home[a[p]] else (b[p], a[p])
                        there = lists[guest][0]
                        if there in lists[own] and there < here:
                            ok[p] = False
                    a, b = a[ok], b[ok]
                    np.add.at(count, a, n[b])
                    np.add.at(count, b, n[a])
                    pairs.append((a, b))
                labels = tile_labels(len(x), pairs)
                told = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([pa.array(cls[told]), pa.array(cls[labels[told]]), pa.array(count[told])], ["a", "b", "links"])

    return run


def embedding_dedup(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    sigmas: float = SIGMAS,
    lists: int = LISTS,
    list_rows: int = LIST_ROWS,
    most_lists: int = MOST_LISTS,
    sample_rows: int = SAMPLE_ROWS,
    tile: int = TILE,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    Null or zero vectors, and those with null or non-finite components, link with nothing
    and are their own component; vectors of different lengths never link. Equal
    directions are one class before anything is compared; n_links counts rows. Repeated
    ids are rows like others. A null id has no links of its own name but counts for
    others. Other columns are ignored, an empty table gives an empty result.

    Every row is indexed. Centroids are fitted on at most ``most_lists * sample_rows``
    rows. A list, however large, is cut into tiles, and a task holds one pair of tiles.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    units = materialised(rows.mapInArrow(_units, f"vec_id {kind}, width int, unit binary"))
    good = units.where(F.col("unit").isNotNull())
    classes = good.groupBy("unit", "width").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = materialised(classes.select(F.xxhash64("unit", "width").alias("cls"), "unit", "width", "n", "least"))
    widths = {r["width"]: r["n"] for r in classes.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}
    centroids = {w: fitted_centroids(classes, w, n, sample_rows, list_rows, most_lists) for w, n in widths.items()}
    listed = classes.select("cls", "n", "width", "unit").mapInArrow(
        _listed(centroids, lists), "cls long, n long, width int, unit binary, lists array<int>"
    )
    placed = materialised(listed).select("*", F.posexplode("lists").alias("rank", "list")).withColumn("home", F.col("rank") == 0)
    # Chunks of a list's homes and of its visitors: homes meet homes and visitors.
    sizes = placed.groupBy("width", "list").agg(
        F.ceil(F.sum(F.col("home").cast("long")) / tile).cast("int").alias("homes"),
        F.ceil(F.sum((~F.col("home")).cast("long")) / tile).cast("int").alias("guests"),
    )
    placed = placed.join(sizes, ["width", "list"]).where("homes > 0")
    # Chunk numbers: homes 0.., then guests.
    own = F.when(F.col("home"), F.pmod("cls", "homes")).otherwise(F.col("homes") + F.pmod("cls", F.greatest("guests", F.lit(1))))
    others = F.when(F.col("home"), F.sequence(F.lit(0), F.col("homes") + F.col("guests") - 1)).otherwise(F.sequence(F.lit(0), F.col("homes") - 1))
    tiles = placed.select("width", "list", "cls", "n", "unit", "lists", "home", own.cast("int").alias("own"), F.explode(others).alias("other")).select(
        "width",
        "list",
        F.least("own", "other").alias("first"),
        F.greatest("own", "other").alias("second"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "cls",
        "n",
        "unit",
        "lists",
        "home",
    )
    keys = ["width", "list", "first", "second"]
    found = tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compared(threshold, sigmas), "a long, b long, links long")
    found = materialised(found)
    counts = found.groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(found.select("a", "b"))
    named = classes.join(counts, classes["cls"] == counts["a"], "left").join(roots, classes["cls"] == roots["node"], "left")
    named = named.select("cls", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    named = materialised(named)
    # Written as well: a component with a third of all vectors is then a join that can be split.
    least = materialised(named.groupBy("root").agg(F.min("least").alias("component_id")))
    named = named.join(least, "root").select("cls", "n_links", "component_id")
    out = units.withColumn("u_cls", F.when(F.col("unit").isNotNull(), F.xxhash64("unit", "width"))).drop("unit")
    out = out.join(named, out["u_cls"] == named["cls"], "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
