"""Best-fit packing by minimum bin slack.

A bin is opened with the longest piece left and then filled with the feasible
combination of lengths that comes nearest to full: subset sums of the available
lengths are kept as one bitset, an integer whose bit s says that s tokens can be added.
The combination is read back from the bitsets and removed.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.shared import kept, strings, text_key
from waybill.session import materialised

LENGTH = 4096
END = 1
#: Pieces that are packed together. A group leaves about one bin that isn't full, and those are packed again.
GROUP = 30_000
#: Strings between white space whose ids a Python worker keeps; they are forgotten together when there are more.
KEPT = 1_000_000
#: Marks that may follow a word. No apostrophe: the tokenizer has patterns that begin with it.
MARKS = ".,;:!?*#%&$"
_CHUNK = re.compile(r"[^\x20\x09-\x0D]+")


class ChunkIds:
    """Ids of a text by ``tokenizers``, found string by string between white space.

    The tokenizer drops white space and never joins across it, so a text's ids are those
    of its strings in order. Nor does it join letters and the marks after them, so new
    strings are cut into a lower-case word and its marks. Words are given to the
    tokenizer many at once; each ends with its one id of a word's end. If that doesn't
    hold (letters that lower-casing takes apart), strings are given to it one by one.
    """

    def __init__(self, path: str, kept: int = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.kept = Tokenizer.from_file(path), kept
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.last = np.array([END], "<u4").tobytes()

    def chunks(self, text: str) -> list[str]:
        # str.split also splits at four control characters that are no white space to the tokenizer.
        return _CHUNK.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def _encoded(self, strings: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _learn_words(self, words: list[str]) -> None:
        for at in range(0, len(words), 256):
            part = words[at : at + 256]
            ids = self._encoded([" ".join(part)])[0]
            stop = np.flatnonzero(self.ends[ids]) + 1
            each = np.split(ids, stop[:-1]) if len(stop) == len(part) else self._encoded(part)
            self.words.update(zip(part, (i.tobytes() for i in each), strict=True))

    def learn(self, chunks: set[str]) -> None:
        """Make ``chunks`` known; what was known is forgotten when it gets too much."""
        fresh = chunks.difference(self.known)
        if len(self.known) + len(fresh) > self.kept:
            self.known, self.words, fresh = {}, {}, chunks
        plain, odd = {}, []
        for c in fresh:
            word = c.rstrip(MARKS)
            # Below this letter lower-casing gives one letter for one, whatever its neighbours.
            if word.isalpha() and max(word) < "\u0130":
                plain[c] = word.lower()
            else:
                odd.append(c)
        marks = {c[len(w) :] for c, w in plain.items()}
        odd += [m for m in marks if m not in self.known]
        self._learn_words(list({w for w in plain.values() if w not in self.words}))
        for at in range(0, len(odd), 4096):
            part = odd[at : at + 4096]
            self.known.update(zip(part, (i.tobytes() for i in self._encoded(part)), strict=True))
        for c, w in plain.items():
            self.known[c] = self.words[w] + self.known[c[len(w) :]]

    def of(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each text, ``END`` last."""
        for some in batched(texts, 64):
            lists = [self.chunks(t) for t in some]
            self.learn(set().union(*lists))
            get = self.known.__getitem__
            for chunks in lists:
                yield np.frombuffer(b"".join(map(get, chunks)) + self.last, "<u4")

    def __call__(self, text: str) -> np.ndarray:
        return next(self.of([text]))


def _shared_ids(path: str) -> ChunkIds:
    """One for each Python worker, which keeps what it knows from task to task."""
    return kept(("packing", path), lambda: ChunkIds(path))


def _pieces(path: str, length: int):
    names = ["doc_id", "key", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _shared_ids(path)
        for b in batches:
            row, piece, start, size, crc = [], [], [], [], []
            for i, ids in enumerate(known.of(t or "" for t in strings(b.column("text")))):
                for k, s in enumerate(range(0, len(ids), length)):
                    part = ids[s : s + length]
                    row.append(i)
                    piece.append(k)
                    start.append(s)
                    size.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(at), b.column("key").take(at), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, size, crc))],
                names,
            )

    return run


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, key, piece, start, length, ids_crc32): every document's ids, then ``END``, cut only if longer."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_pieces(path, length), f"doc_id {kind}, key long, piece int, start long, length long, ids_crc32 long")


def fullest(lengths: list[int], counts: list[int], room: int) -> list[int]:
    """Lengths (each at most as often as ``counts`` says) with the largest sum up to ``room``.

    ``lengths`` descends. Sets grow one copy at a time until one fills the room; the way
    back goes through the sets in reverse.
    """
    mask = (1 << (room + 1)) - 1
    sums, steps, target = 1, [], 1 << room
    for length, n in zip(lengths, counts, strict=True):
        if length > room:
            continue
        for _ in range(min(n, room // length)):
            grown = sums | ((sums << length) & mask)
            if grown == sums:
                break
            steps.append((length, sums))
            sums = grown
        if sums & target:
            break
    best, chosen = sums.bit_length() - 1, []
    for length, before in reversed(steps):
        if not (before >> best) & 1:
            chosen.append(length)
            best -= length
    return chosen


def packed_bins(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number, offset of each piece, and tokens in each bin."""
    order = np.argsort(-sizes, kind="stable")
    distinct, first = np.unique(-sizes[order], return_index=True)
    distinct = (-distinct).tolist()
    ends = [*first[1:].tolist(), len(order)]
    where, left = {d: f for d, f in zip(distinct, first.tolist(), strict=True)}, {}
    for d, f, e in zip(distinct, first.tolist(), ends, strict=True):
        left[d] = e - f
    bins, offset, full = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    while left:
        top = next(iter(left))
        chosen = [top]
        left[top] -= 1
        if not left[top]:
            del left[top]
        if top < length:
            chosen += fullest(list(left), list(left.values()), length - top)
        for d in chosen[1:]:
            left[d] -= 1
            if not left[d]:
                del left[d]
        at = 0
        for d in chosen:
            i = order[where[d]]
            where[d] += 1
            bins[i], offset[i] = len(full), at
            at += d
        full.append(at)
    return bins, offset, np.array(full, np.int64)


def _packed(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "key", "piece", "number"], ascending=False, kind="stable")
        bins, offset, full = packed_bins(group["length"].to_numpy(), length)
        return group.assign(bin=bins, offset=offset, full=full[bins])

    return run


def _round(rows: DataFrame, number: int, n: int, group: int, length: int) -> DataFrame:
    """Pack ``rows`` in groups of about ``group`` pieces; adds sequence_id, offset, full."""
    names = ["doc_id", "key", "piece", "number", "start", "length", "ids_crc32"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    groups = max(1, -(-n // group))
    placed = F.pmod(F.xxhash64("number", F.lit(number)), F.lit(groups))
    out = rows.select(*names, placed.alias("grp")).groupBy("grp").applyInPandas(_packed(length), f"{kinds}, grp long, bin long, offset long, full long")
    sequence = (F.lit(number) * F.lit(1 << 58)) + F.col("grp") * F.lit(1 << 26) + F.col("bin")
    return out.select(*names, sequence.alias("sequence_id"), "offset", "full")


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, group: int = GROUP
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    A null text is empty: its only id is ``END``. Repeated rows are packed as often as they
    occur; other columns are ignored; an empty table gives an empty result.

    Pieces (no texts, no ids) are numbered when they are written and dealt by the hash of
    their number into groups of about ``group``, whatever their ids, lengths or sources, so
    no group is hot, not even of repeated rows. Bins that aren't full are opened again and
    their pieces packed in a second round over all groups.
    """
    numbered = pieces(docs, path, id_col, text_col, length).withColumn("number", F.monotonically_increasing_id())
    cut = materialised(numbered)
    first = materialised(_round(cut, 0, cut.count(), group, length))
    again = first.where(F.col("full") < length)
    second = _round(again, 1, again.count(), group, length)
    out = first.where(F.col("full") == length).unionByName(second)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
