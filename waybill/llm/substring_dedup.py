"""Substring dedup by recompression.

Every text is a sequence of word names and is parsed in rounds (Jez 2013): runs of one
name become one name, then names are split in two sides by a bit of their hash and every
pair (left side, right side) becomes one name. A name is a hash of what it stands for,
so all tasks give the same name to the same run or pair without asking each other.

Equal passages are parsed alike away from their ends. For every name the words that its
making has looked at are carried along; where they lie within a window, every copy of
the window holds the same name at the same place. Each window of words elects one of its
names as anchor: the highest level first, then the smallest hash. An anchor that occurs
once in the corpus proves all its windows unique. Names do no more than that: repeats are
found by hashes of words. Single windows have 128 bits over all their words; stretches of
windows, compared at once, have 64 over all words and 64 over those round the anchor.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.shared import text_key
from waybill.session import materialised

WINDOW = 20
ROUNDS = 2
#: Words before and from an anchor's first word that may decide about it. Windows longer than both can elect it.
BEFORE, AFTER = 4, 6
#: Words that are parsed and combined at once. One longer text is parsed alone.
SLICE_WORDS = 400_000
KEPT_WORDS = 300_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ODD = np.random.default_rng(5).integers(1, 1 << 63, size=(3, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordNames(dict):
    """The 64-bit name of a word; frequent words are looked up."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        name = self[word] = xxhash.xxh64_intdigest(word, 1)
        return name

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _shifted(x: np.ndarray, by: int, fill) -> np.ndarray:
    out = np.full_like(x, fill)
    if by > 0:
        out[by:] = x[:-by]
    else:
        out[:by] = x[-by:]
    return out


def parsed(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS, before: int = BEFORE, after: int = AFTER) -> np.ndarray:
    """Rank of every word as an anchor: the level's complement in the upper 3 bits, then a hash.

    ``doc`` numbers the text of each word. A symbol stands for words [b, e); deciding on it
    looked at [c, f). Beyond the ends of a text lies what no window can see.
    """
    n = len(names)
    far = np.int64(1 << 40)
    s, d, b = names, doc, np.arange(n, dtype=np.int64)
    c, f = b.copy(), b + 1
    rank = (mixed(s) >> np.uint64(3)) | np.uint64(7 << 61)

    def neighbours():
        left = np.zeros(len(s), bool)
        left[1:] = d[1:] == d[:-1]
        right = np.zeros(len(s), bool)
        right[:-1] = left[1:]
        return left, right, np.where(left, _shifted(c, 1, 0), -far), np.where(right, _shifted(f, -1, 0), far)

    for level in range(1, rounds + 1):
        # Runs: each symbol looks at both neighbours to know whether the run goes on.
        left, right, c_left, f_right = neighbours()
        c, f = np.minimum(c, c_left), np.maximum(f, f_right)
        goes_on = np.zeros(len(s), bool)
        goes_on[1:] = left[1:] & (s[1:] == s[:-1])
        if goes_on.any():
            at = np.flatnonzero(~goes_on)
            size = np.diff(np.append(at, len(s)))
            s = np.where(size > 1, mixed(s[at] ^ (size.astype(np.uint64) * _ODD[2, level])), s[at])
            last = at + size - 1
            d, b, c, f = d[at], b[at], np.minimum(c[at], c[last]), np.maximum(f[at], f[last])
        # Pairs: left sides look at what follows, right sides at what comes before.
        is_right = (mixed(s ^ _ODD[2, 32 + level]) & np.uint64(1)).astype(bool)
        left, right, c_left, f_right = neighbours()
        c, f = np.where(is_right, np.minimum(c, c_left), c), np.where(is_right, f, np.maximum(f, f_right))
        second = np.zeros(len(s), bool)
        second[1:] = left[1:] & is_right[1:] & ~is_right[:-1]
        at = np.flatnonzero(~second)
        paired = np.zeros(len(at), bool)
        paired[:-1] = np.diff(at) > 1
        if len(at):
            paired[-1] = at[-1] < len(s) - 1
        last = at + paired
        s = np.where(paired, mixed(s[at] * _ODD[0, level] + mixed(s[last]) * _ODD[1, level]), s[at])
        d, b, c, f = d[at], b[at], np.minimum(c[at], c[last]), np.maximum(f[at], f[last])
        seen = (c >= b - before) & (f <= b + after)
        rank[b[seen]] = (mixed(s[seen]) >> np.uint64(3)) | np.uint64((7 - level) << 61)
    return rank


def elected(rank: np.ndarray, starts: np.ndarray, window: int, before: int = BEFORE, after: int = AFTER) -> np.ndarray:
    """The anchor (position of its first word) of the windows that begin at ``starts``: least rank, then leftmost."""
    width = window - before - after + 1
    pos = np.arange(len(rank))
    span = 1
    while span < width:
        step = min(span, width - span)
        better = rank[step:] < rank[:-step]
        rank, pos = np.where(better, rank[step:], rank[:-step]), np.where(better, pos[step:], pos[:-step])
        span += step
    return pos[starts + before]


class Sums:
    """Hashes of any ranges of a name sequence, from running sums of names times powers of an odd base."""

    def __init__(self, names: np.ndarray, row: int):
        n, base = len(names), int(_ODD[row, 63])
        grow, shrink = (np.full(n + 1, x, np.uint64) for x in (base, pow(base, -1, 1 << 64)))
        grow[0] = shrink[0] = 1
        np.multiply.accumulate(grow, out=grow)
        self.back = np.multiply.accumulate(shrink)
        self.upto = np.append(np.uint64(0), np.cumsum(names * grow[:-1], dtype=np.uint64))

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.upto[stop] - self.upto[start]) * self.back[start] + (stop - start).astype(np.uint64))


class Slice:
    """Texts of one slice, in order of (doc_id, version): their words' names and numbers."""

    def __init__(self, rows: pa.Table, names: WordNames):
        order = pc.sort_indices(rows, sort_keys=[("doc_id", "ascending"), ("version", "ascending")], null_placement="at_start")
        self.rows = rows.take(order)
        words = [names.of(_WORD.findall(t or "")) for t in self.rows.column("text").to_pylist()]
        self.size = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.names = np.concatenate([*words, np.zeros(0, np.uint64)])
        self.doc = np.repeat(np.arange(len(words)), self.size)

    def ids(self, doc: np.ndarray) -> list[pa.Array]:
        at = pa.array(doc)
        return [self.rows.column(k).take(at).combine_chunks() for k in ("doc_id", "version")]


def _slices(batches: Iterator[pa.RecordBatch], names: WordNames) -> Iterator[Slice]:
    held, size = [], 0
    for b in batches:
        lengths = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False)
        at = 0
        for i, n in enumerate(lengths):
            size += n
            if size >= 6 * SLICE_WORDS:
                held.append(b.slice(at, i + 1 - at))
                yield Slice(pa.Table.from_batches(held), names)
                held, size, at = [], 0, i + 1
        if at < b.num_rows:
            held.append(b.slice(at))
    if held:
        yield Slice(pa.Table.from_batches(held), names)


def _settled(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Rows, in order of place, that equal an earlier one of this slice in both hashes."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], second[order]
    out = np.zeros(len(order), bool)
    out[order[1:]] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    return out


def _sent(x: Slice, doc: np.ndarray, first: np.ndarray, second: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Rows for the shuffle by ``route``. Settled rows need no task of their key, so a key sends
    one row per slice, however often it occurs; they go with their document.
    """
    settled = _settled(first, second)
    route = np.where(settled, mixed((x.first[doc] + x.size[doc]).astype(np.uint64) * _ODD[2, 3]), first)
    rest = np.where(settled, np.uint64(0), second)
    arrays = [pa.array(route.view(np.int64)), pa.array(rest.view(np.int64)), pa.array(settled), *x.ids(doc), pa.array(place.astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, ["route", "rest", "settled", "doc_id", "version", "place"])


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WordNames()
        for x in _slices(batches, names):
            at = np.arange(len(x.names))
            starts = at[at + window <= (x.first + x.size)[x.doc]] if len(at) else at
            if not len(starts):
                continue
            anchor = elected(parsed(x.names, x.doc), starts, window)
            new = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            last = np.append(new[1:], len(anchor)) - 1
            p, doc = anchor[new], x.doc[anchor[new]]
            key = Sums(x.names, 0)(p - BEFORE, p + AFTER)
            # The stretch of words of all windows that the anchor speaks for.
            stretch = Sums(x.names, 1)(starts[new], starts[last] + window) ^ mixed((p - starts[new]).astype(np.uint64))
            place = ((p - x.first[doc]) << 16) | ((p - starts[new]) << 8) | (p - starts[last])
            yield _sent(x, doc, key, stretch, place)

    return run


def spans_of(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window start of packed places."""
    p = places >> 16
    return p - ((places >> 8) & 255), p - (places & 255)


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = WordNames()
        for x in _slices(batches, names):
            places = x.rows.column("open").combine_chunks()
            doc, v = pc.list_parent_indices(places).to_numpy(), np.asarray(pc.list_flatten(places))
            if not len(v):
                continue
            first, last = spans_of(v)
            n = last - first + 1
            starts = np.repeat(first, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            doc = np.repeat(doc, n)
            order = np.lexsort((starts, doc))
            starts, doc = starts[order], doc[order]
            at = x.first[doc] + starts
            yield _sent(x, doc, Sums(x.names, 0)(at, at + window), Sums(x.names, 1)(at, at + window), starts)

    return run


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, sha, texts = [], [], [], []
            for t, copied, settled, starts in zip(*(b.column(c) for c in ("text", "copied", "settled", "starts")), strict=True):
                words = _WORD.findall(t.as_py() or "")
                n = len(words)
                kept = words
                if copied.as_py():
                    kept = words if n < window else []
                elif settled.is_valid or starts.is_valid:
                    edge = np.zeros(n + 1, np.int64)
                    for first, last in (
                        spans_of(np.asarray(settled.values)) if settled.is_valid else (None, None),
                        (np.asarray(starts.values),) * 2 if starts.is_valid else (None, None),
                    ):
                        if first is not None:
                            np.add.at(edge, first, 1)
                            np.add.at(edge, last + window, -1)
                    kept = [w for w, out in zip(words, (np.cumsum(edge) > 0).tolist(), strict=False) if not out]
                text = " ".join(kept)
                n_words.append(n)
                n_removed.append(n - len(kept))
                sha.append(hashlib.sha256(text.encode()).hexdigest())
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return run


def _versions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, version): rows that share an id but not a text get different versions.

    Ids are unique in most tables, and then nothing is joined: the version is 0.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keys = rows.select("doc_id", text_key(F.col("text")).alias("key"))
    several = keys.groupBy("doc_id").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least <> most")
    if several.isEmpty():
        return rows.withColumn("version", F.lit(0))
    numbered = keys.distinct().withColumn("version", F.row_number().over(Window.partitionBy("doc_id").orderBy("key")))
    numbered = numbered.select(F.col("doc_id").alias("n_id"), F.col("key").alias("n_key"), "version")
    rows = rows.withColumn("key", text_key(F.col("text")))
    same = rows["doc_id"].eqNullSafe(numbered["n_id"]) & (rows["key"] == numbered["n_key"])
    return rows.join(numbered, same).select("doc_id", "text", "version")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text: one row per row of ``docs``.

    A word goes if a window of ``window`` words that covers it has started earlier: in a
    smaller doc_id (null is smallest), or in the same document. Windows are judged on the
    input. A null text has no words. Rows that repeat id and text are one document, of
    rows that share only the id the order is that of a hash of their texts. Other columns
    are ignored; an empty table gives an empty result. ``window`` must exceed
    BEFORE + AFTER and be at most 200.

    The stages: texts that equal an earlier one whole are set aside; anchors with the hash
    of their stretch (all windows they speak for) meet by anchor; a stretch that has
    occurred before is settled, an anchor with one stretch only is done, and the first
    of each of several stretches is opened: only its windows are compared one by one.
    Texts are shuffled once: all joins below use the same exchange. Of repeated rows one
    goes through these stages, and what is found goes to all of them.
    """
    if not BEFORE + AFTER < window <= 200:
        raise ValueError(f"window must be within {BEFORE + AFTER + 1} and 200")
    rows = _versions(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    ids = ["doc_id", "version"]
    sent = f"route long, rest long, settled boolean, doc_id {kind}, version int, place long"

    def on_ids(side: DataFrame, how: str, *columns: str, left: DataFrame = rows) -> DataFrame:
        side = side.withColumnsRenamed({"doc_id": "s_id", "version": "s_version"})
        same = left["doc_id"].eqNullSafe(side["s_id"]) & (left["version"] == side["s_version"])
        return left.join(side, same, how).select(*ids, "text", *columns)

    whole = rows.select(*ids, F.md5("text").alias("digest"))
    least = whole.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNotNull(), *ids)).alias("first"), F.count(F.lit(1)).alias("n")
    )
    # Written, so that the join is of two plain shuffles and a hot group of copies can be split.
    least = materialised(least.where("n > 1").select("digest", "first"))
    place = F.struct(F.col("doc_id").isNotNull(), *ids)
    copies = whole.join(least, "digest").where(place != F.col("first")).select(*ids).distinct()

    # Rows that repeat an id and its text speak once: else each would be the other's earlier copy.
    parts = [rows]
    repeats = materialised(rows.groupBy(*ids).count().where("count > 1").select(*ids))
    if not repeats.isEmpty():
        parts = [on_ids(repeats, "left_anti"), on_ids(repeats, "left_semi").dropDuplicates(ids)]

    def once(side: DataFrame, how: str, *columns: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [on_ids(side, how, *columns, left=p) for p in parts])

    anchors = once(copies, "left_anti").mapInArrow(_anchors(window), sent)
    stretch = Window.partitionBy("route", "rest", "settled").orderBy(*ids, "place")
    route = Window.partitionBy("route")
    met = anchors.withColumns(
        {
            "settled": F.col("settled") | (F.row_number().over(stretch) > 1),
            "several": F.min("rest").over(route) != F.max("rest").over(route),
        }
    ).where("settled or several")
    places = met.groupBy(*ids).agg(
        F.collect_list(F.when(F.col("settled"), F.col("place"))).alias("settled"),
        F.collect_list(F.when(~F.col("settled"), F.col("place"))).alias("open"),
    )
    opened = once(places, "left", "open").where(F.size("open") > 0)
    turn = Window.partitionBy("route", "rest", "settled").orderBy(*ids, "place")
    found = opened.mapInArrow(_windows(window), sent).withColumn("turn", F.row_number().over(turn)).where("settled or turn > 1")
    starts = found.groupBy(*ids).agg(F.collect_list("place").alias("starts"))
    out = on_ids(places, "left", "settled")
    out = on_ids(starts, "left", "settled", "starts", left=out)
    out = on_ids(copies.withColumn("copied", F.lit(True)), "left", "settled", "starts", "copied", left=out)
    return out.select("doc_id", "text", F.coalesce("copied", F.lit(False)).alias("copied"), "settled", "starts").mapInArrow(
        _kept(window), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
