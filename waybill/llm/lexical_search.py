"""Ranked lexical search by bag deduplication.

A query sees no more of a document than the terms of the items, how often each occurs, and
the integer m that its length gives. Documents alike in these score alike for every item,
so they are one class: it is scored once, and only the classes that come to the top are
opened again into their members, by ascending id. Copies, templates and documents without
any term of an item cost nothing more, however many there are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.session import materialised

TOP = 10
#: Terms of items that are sent to all executors at most; beyond, terms are joined instead.
VOCABULARY = 1 << 18
#: Numbers in a table of (terms, items) at most; items beyond are another block.
CELLS = 1 << 22

# Terms are runs of ASCII letters, digits and everything beyond ASCII.
_TERM_BYTES = bytes(c for c in range(256) if chr(c).isascii() and not chr(c).isalnum())
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_PLAIN = bytes.maketrans(UPPER + _TERM_BYTES, LOWER + b" " * len(_TERM_BYTES))


def terms(text: bytes | None) -> list[bytes]:
    """Terms in order; all bytes of a character beyond ASCII lie beyond ASCII too."""
    return (text or b"").translate(_PLAIN).split()


def _bagged(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = vocabulary.value if vocabulary else None
        for b in batches:
            lengths, sizes, names, numbers = [], [], [], []
            for text in b.column("text").cast(pa.binary()):
                found = terms(text.as_py())
                lengths.append(len(found))
                counts = Counter(found)
                own = sorted(wanted.intersection(counts) if wanted is not None else counts)
                sizes.append(len(own))
                names += own
                numbers += map(counts.__getitem__, own)
            ends = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(names, pa.string())),
                    pa.ListArray.from_arrays(ends, pa.array(numbers, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return run


def bags(docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str, most: int = VOCABULARY) -> DataFrame:
    """(doc_id, n, terms, tfs): a row per document: all its terms counted, those of ``vocabulary`` (term) listed.

    ``terms`` is in byte order, ``tfs`` goes with it. A vocabulary of up to ``most`` terms
    is sent to the executors; a larger one is joined by term, with the same result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, terms array<string>, tfs array<long>"
    few = vocabulary.limit(most + 1).collect()
    if len(few) <= most:
        sent = spark.sparkContext.broadcast(frozenset(r["term"].encode() for r in few))
        return materialised(rows.mapInArrow(_bagged(sent), schema))
    every = materialised(rows.mapInArrow(_bagged(None), schema).withColumn("row", F.monotonically_increasing_id()))
    each = every.select("row", F.explode(F.arrays_zip("terms", "tfs")).alias("t")).select("row", F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))
    own = each.join(vocabulary, "term").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("term", "tf"))).alias("bag"))
    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    joined = every.select("row", "doc_id", "n").join(own, "row", "left").withColumn("bag", F.coalesce("bag", empty))
    return materialised(joined.select("doc_id", "n", F.col("bag.term").alias("terms"), F.col("bag.tf").alias("tfs")))


def weighted_terms(bagged: DataFrame, item_terms: DataFrame, n_docs: int) -> DataFrame:
    """(item_id, term, w) for terms that any document holds; others add nothing to a score."""
    df = bagged.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ratio = F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double")
    return item_terms.join(df, "term").select("item_id", "term", F.floor(1000 * F.log(ratio)).cast("long").alias("w"))


def _blocks(postings: DataFrame, cells: int) -> Iterator[tuple[list, dict[str, int], np.ndarray]]:
    """(items, terms by number, weights) of as many items at a time as a table of ``cells`` numbers takes.

    Items come in order, a few at a time, so the driver holds one block of the query set.
    """
    items, at, parts = [], {}, []

    def table():
        w = np.zeros((len(at), len(items)), np.int64)
        for j, own in enumerate(parts):
            w[[at[t] for t, _ in own], j] = [x for _, x in own]
        return items, at, w

    rows = postings.groupBy("item_id").agg(F.collect_list(F.struct("term", "w")).alias("own")).orderBy("item_id")
    for r in rows.toLocalIterator():
        own = [(p["term"], p["w"]) for p in r["own"]]
        new = len(at) + sum(t not in at for t, _ in own)
        if items and new * (len(items) + 1) > cells:
            yield table()
            items, at, parts = [], {}, []
        for t, _ in own:
            at.setdefault(t, len(at))
        items.append(r["item_id"])
        parts.append(own)
    if items:
        yield table()


def _best(score: np.ndarray, first: np.ndarray, null: np.ndarray, top: int, floor: int) -> np.ndarray:
    """Positions of the ``top`` highest scores of ``floor`` or more, ties to the smallest first id, nulls last."""
    some = np.flatnonzero(score >= floor)
    if len(some) > top:
        least = np.partition(score[some], len(some) - top)[len(some) - top]
        some = some[score[some] >= least]
    return some[np.lexsort((first[some], null[some], -score[some]))[:top]]


def _scored(block, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, at, weights = block.value
        names = pa.array(list(at), pa.string())
        n = len(items)
        best: list = [[] for _ in range(n)]
        for whole in batches:
            # So many classes at a time that their (term, item) products stay small.
            for b in _sliced(whole, max(1, (1 << 21) // max(1, n))):
                lists, tfs = b.column("terms"), b.column("tfs").flatten().to_numpy()
                number = pc.fill_null(pc.index_in(lists.flatten(), names), -1).to_numpy()
                sizes = pc.list_value_length(lists).to_numpy()
                owner = np.repeat(np.arange(len(sizes)), sizes)
                m = b.column("m").to_numpy()
                value = 1_000_000_000 * tfs // (1000 * tfs + 8 * m[owner])
                own = number >= 0
                owner, number, value = owner[own], number[own], value[own]
                if not len(owner):
                    continue
                starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                scores = np.add.reduceat(weights[number] * value[:, None], starts, axis=0)
                classes = owner[starts]
                first = b.column("first").take(pa.array(classes))
                null = pc.is_null(first).to_numpy(zero_copy_only=False)
                rank = pc.rank(first, "ascending", null_placement="at_end", tiebreaker="min").to_numpy()
                ids = b.column("class_id").take(pa.array(classes)).to_pylist()
                firsts = first.to_pylist()
                for j in range(n):
                    floor = -best[j][-1][0] if len(best[j]) == top else 1
                    for i in _best(scores[:, j], rank, null, top, floor):
                        best[j].append((-int(scores[i, j]), bool(null[i]), firsts[i], ids[i]))
                    if len(best[j]) > top:
                        best[j] = sorted(best[j], key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[:top]
        rows = [(j, c, -s) for j in range(n) for s, _, _, c in best[j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
            ["at", "class_id", "score"],
        )

    return run


def _sliced(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, so many at a time that they list ``most`` terms, or one by one."""
    sizes = pc.list_value_length(batch.column("terms")).to_numpy()
    at = 0
    while at < len(sizes):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), most, "right")))
        yield batch.slice(at, n)
        at += n


def _classes(bagged: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(hash, m, terms, tfs, doc_id) of documents with a term of an item."""
    m = F.expr(f"cast(100 - 90 + ((90 * n * {n_docs}L) div {max(1, n_terms)}L) as bigint)")
    rows = bagged.where(F.size("terms") > 0).withColumn("m", m)
    return rows.select(F.xxhash64("m", "terms", "tfs").alias("hash"), "m", "terms", "tfs", "doc_id")


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    vocabulary: int = VOCABULARY,
    cells: int = CELLS,
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` documents with a score above 0.

    The score sums w (10^9 tf div (1000 tf + 8 m)) over the item's distinct terms, in whole
    numbers. Equal scores go by ascending id, null ids last; rows that repeat an id each
    have a rank. A null text has no term and is no document of the corpus; items without a
    text, or whose terms no document holds, get no rows; rows that share an item_id are one
    item with the terms of all. Empty tables give an empty result, other columns are
    ignored. Texts of any length are read whole.

    Documents reach the shuffle as (hash, m, terms, tfs): the hash brings like ones
    together and grouping by the vector itself verifies them, so vectors whose hashes
    agree by chance stay two classes. A class with a third of all documents is a row a task
    before the shuffle, and ``top`` ids a task when it is opened. Items are scored in
    blocks of bounded size; a task keeps ``top`` classes an item.
    """
    spark: SparkSession = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    wanted = asked.select(F.col("item_id").alias("doc_id"), "text").mapInArrow(
        _bagged(None), f"doc_id {asked.schema['item_id'].dataType.simpleString()}, n long, terms array<string>, tfs array<long>"
    )
    item_terms = materialised(wanted.select(F.col("doc_id").alias("item_id"), F.explode("terms").alias("term")).distinct())
    words = item_terms.select("term").distinct()
    bagged = bags(docs, words, id_col, text_col, vocabulary)
    n_docs, n_terms = bagged.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    postings = materialised(weighted_terms(bagged, item_terms, n_docs))

    rows = _classes(bagged, n_docs, n_terms)
    key = ["hash", "m", "terms", "tfs"]
    classes = rows.groupBy(*key).agg(F.min("doc_id").alias("first")).withColumn("class_id", F.monotonically_increasing_id())
    classes = materialised(classes)
    scored = None
    for names, at, weights in _blocks(postings, cells):
        sent = spark.sparkContext.broadcast((names, at, weights))
        part = classes.select("class_id", "m", "terms", "tfs", "first").mapInArrow(_scored(sent, top), "at int, class_id long, score long")
        of = spark.createDataFrame(list(enumerate(names)), f"at int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        part = part.join(F.broadcast(of), "at").select("item_id", "class_id", "score")
        scored = part if scored is None else scored.unionByName(part)
    if scored is None:
        kind = asked.schema["item_id"].dataType.simpleString()
        scored = spark.createDataFrame([], f"item_id {kind}, class_id long, score long")
    scored = materialised(scored)
    nulls_last = lambda c: F.col(c).asc_nulls_last()
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), nulls_last("first"))
    kept = scored.join(classes.select("class_id", "first"), "class_id").withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    kept = materialised(kept.select("item_id", "class_id", "score"))

    # Only the classes that came to the top are opened: by hash, then by the vector itself.
    open_classes = materialised(classes.join(kept.select("class_id").distinct(), "class_id", "left_semi").select("class_id", *key))
    near = rows.join(open_classes.select("hash").distinct(), "hash", "left_semi").alias("d")
    same = [F.col(f"d.{c}") == F.col(f"c.{c}") for c in key]
    members = near.join(open_classes.alias("c"), same).select("class_id", "doc_id")
    own = Window.partitionBy("class_id").orderBy(nulls_last("doc_id"))
    members = materialised(members.withColumn("turn", F.row_number().over(own)).where(F.col("turn") <= top).drop("turn"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), nulls_last("doc_id")))
    return kept.join(members, "class_id").withColumn("rank", rank).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
