"""SimHash near-duplicates by tiled exact comparison.

Fingerprints within ``radius`` bits agree on at least one of radius + 1 blocks of bits,
so tiles are laid within groups that share a block: exact, and far fewer tiles than over
all fingerprints. A group that is larger than a tile is cut by population count, and
tiles whose counts differ beyond the radius never meet. Within a pair of tiles all
fingerprints are compared by exclusive-or and bit count in numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.components import components, tile_labels
from waybill.llm.shared import carried, text_key
from waybill.llm.tiles import bounds, grouped
from waybill.session import materialised

RADIUS = 4
SHINGLE = 4
#: Fingerprints in a tile.
TILE = 2048
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the hashes of the text's shingles."""
    words = _WORD.findall((text or "").translate(_LOWER))
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < width else map(" ".join, zip(*(words[k:] for k in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - width + 1)
    hashes = np.fromiter((digest(g, 42) for g in grams), np.uint64, n)
    # Numbers of set bits, from slices that keep memory bounded for long texts.
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        values = np.fromiter((fingerprint(t.as_py()) for t in b.column("text")), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(values.view(np.int64))], ["doc_id", "key", "fp"])


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, fp as signed 64 bits), one row per row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_fingerprints, f"doc_id {kind}, key long, fp long")


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, bits) of radius + 1 blocks that cover 64 bits."""
    edges = [round(64 * k / (radius + 1)) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _pairs(x: np.ndarray, y: np.ndarray | None, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (in x, in y or x itself) of links, in slices that bound memory."""
    other = x if y is None else y
    step = max(1, (1 << 20) // max(1, len(other)))
    for at in range(0, len(x), step):
        near = np.bitwise_count(x[at : at + step, None] ^ other[None, :]) <= radius
        i, j = np.nonzero(near)
        yield i + at, j


def _short(fp: np.ndarray, at: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within many small groups at once: each row against the one k places on."""
    group = np.repeat(np.arange(len(at) - 1), np.diff(at))
    found = []
    for k in range(1, int(np.diff(at).max())):
        i = np.flatnonzero(group[k:] == group[:-k])
        if not len(i):
            break
        found.append(i[np.bitwise_count(fp[i] ^ fp[i + k]) <= radius])
        found[-1] = np.stack([found[-1], found[-1] + k])
    a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), int)
    return a, b


SMALL = 64


def _compared(radius: int):
    keys = ["block", "part", "first", "second"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, keys):
            fp = table.column("fp").to_numpy().view(np.uint64)
            side = table.column("side").to_numpy()
            at = bounds(table, keys)
            sizes = np.diff(at)
            out = []
            small = sizes <= SMALL
            small[small] = table.column("first").to_numpy()[at[:-1][small]] == table.column("second").to_numpy()[at[:-1][small]]
            if small.any():
                rows = np.flatnonzero(np.repeat(small, sizes))
                a, b = _short(fp[rows], np.append(0, np.cumsum(sizes[small])), radius)
                out.append((fp[rows[a]], fp[rows[b]]))
            for g in np.flatnonzero(~small):
                x, s = fp[at[g] : at[g + 1]], side[at[g] : at[g + 1]]
                if s.any():
                    left, right = np.flatnonzero(s == 0), np.flatnonzero(s == 1)
                    links = ((left[i], right[j]) for i, j in _pairs(x[left], x[right], radius))
                else:
                    links = _pairs(x, None, radius)
                labels = tile_labels(len(x), links)
                hung = np.flatnonzero(labels != np.arange(len(x)))
                out.append((x[hung], x[labels[hung]]))
            for a, b in out:
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return run


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect all of ``fps`` (distinct fp) within ``radius`` bits.

    Inside a pair of tiles only a spanning forest of the links is returned.
    """
    blocks = [
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << bits) - 1)).alias("part"))
        for k, (shift, bits) in enumerate(_blocks(radius))
    ]
    rows = fps.select("fp", F.bit_count("fp").alias("ones"), F.explode(F.array(*blocks)).alias("x")).select("fp", "ones", "x.*")
    group = ["block", "part"]
    # Groups larger than a tile: by population count, and by hash where one count alone is too large.
    per_count = rows.groupBy(*group, "ones").agg(F.count(F.lit(1)).alias("n"))
    cells = per_count.groupBy(*group).agg(
        F.sum("n").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int").alias("chunks")))).alias("chunks"),
    )
    large = cells.where(F.col("n") > tile).select(*group, "chunks")
    rows = rows.join(large, group, "left")
    whole = rows.where(F.col("chunks").isNull()).select(*group, F.lit(0).alias("first"), F.lit(0).alias("second"), F.lit(0).alias("side"), "fp")
    own = F.col("ones") * 1_000_000 + F.pmod(F.xxhash64("fp"), F.element_at("chunks", F.col("ones")))

    def meets(q: Column) -> Column:
        n = F.try_element_at(F.col("chunks"), q)
        return F.when(n.isNull(), F.array().cast("array<int>")).otherwise(
            F.transform(F.sequence(F.lit(0), n - 1), lambda d: (q * 1_000_000 + d).cast("int"))
        )

    cut = rows.where(F.col("chunks").isNotNull()).withColumn("own", own.cast("int"))
    near = F.sequence(F.col("ones") - radius, F.col("ones") + radius)
    cut = cut.select(*group, "fp", "own", F.explode(F.flatten(F.transform(near, meets))).alias("other"))
    cut = cut.select(
        *group, F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"), (F.col("own") > F.col("other")).cast("int").alias("side"), "fp"
    )
    keys = [*group, "first", "second"]
    tiles = whole.unionByName(cut).repartition(*keys).sortWithinPartitions(*keys)
    return tiles.mapInArrow(_compared(radius), "a long, b long")


def clustered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, key, fp, root, component_id), one row per row: root names a component, component_id is its least id.

    Equal fingerprints, however many, are one row before anything is compared.
    """
    prints = materialised(fingerprints(docs, id_col, text_col))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(classes.select("fp"), radius))
    named = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = materialised(named)
    # Written as well: a component with a third of all fingerprints is then a join that can be split.
    smallest = materialised(named.groupBy("root").agg(F.min("least").alias("component_id")))
    return prints.join(named.join(smallest, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "key", "fp", "root", "component_id"
    )


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id, kept: one row per row of ``docs``.

    Texts without words (null, empty) have fingerprint zero and are linked like any other.
    component_id is the smallest doc_id reachable by links, the row itself included; null
    ids are never the smallest unless there are no others, and then it is null. kept says
    that a row has that id. Repeated rows are returned as often as they occur, other
    columns are ignored, an empty table gives an empty result.
    """
    return clustered(docs, id_col, text_col, radius).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Rows of ``docs``, all columns: one of each component, that with the smallest id (nulls last)."""
    found = clustered(docs, id_col, text_col, radius)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("b"))
    best = best.select("b.doc_id", "b.key")
    row = F.col("row")
    rows = carried(docs).withColumns({"id": row[id_col], "text_key": text_key(row[text_col])})
    rows = rows.join(best, rows["id"].eqNullSafe(best["doc_id"]) & (rows["text_key"] == best["key"]))
    # Rows that repeat both id and text are told apart by nothing; any one of them stays.
    turn = F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("key"))
    return rows.withColumn("turn", turn).where("turn = 1").select("row.*")
