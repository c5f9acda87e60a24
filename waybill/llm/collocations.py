"""Phrase collocations by top-order marginalisation.

Every word position leads one window of the longest phrase length, padded where its piece
ends, and only these windows are taken from texts. A shorter phrase is a prefix of the
windows that start where it starts: its count is the sum of theirs. Windows are counted a
chunk at a time inside the tasks that read the texts, meet by their first two words, and
give the sums of all their prefixes; a ROLLUP brings these together. No n-gram order but
the longest is ever taken from a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.session import materialised

# What ends a piece of text. Words are parted by blanks and tabs.
ENDS = b".,;:!?\n\x0b\x0c\r"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
#: No word holds a full stop, so it stands for every end of a piece.
_PLAIN = bytes.maketrans(UPPER + ENDS, LOWER + b"." * len(ENDS))

LONGEST = 3
LEAST = 10
TOP = 2000
#: Windows counted at a time in a task, and bytes of text that become words at a time.
CHUNK = 1 << 22
SLICE = 1 << 20
#: Windows sent to the JVM at a time.
SENT = 1 << 14
#: Starts of windows that are split at most, parts of each, and the share of documents that is asked for them.
MANY = 1000
SPLIT = 64
SAMPLE = 1 / 64
#: Windows of the sample from which on a start may be worth splitting.
HOT_ROWS = 100


class _Numbers(dict):
    """Words by number, in order of appearance; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _numbered(texts: list[bytes | None], numbers: _Numbers, longest: int) -> np.ndarray:
    """Words of the texts by number, with zeros between pieces and behind the last."""
    plain = b" . ".join(t for t in texts if t).translate(_PLAIN).replace(b".", b" . ").split()
    plain.extend([b"."] * (longest - 1))
    return np.fromiter(map(numbers.__getitem__, plain), np.int64, len(plain))


def _windows(words: np.ndarray, longest: int, bits: int) -> np.ndarray:
    """One number a word: itself and the words that follow it in its piece, ``bits`` bits each."""
    n = len(words) - longest + 1
    key, runs_on = words[:n].copy(), words[:n] > 0
    starts = runs_on.copy()
    for k in range(1, longest):
        runs_on &= words[k : k + n] > 0
        key = (key << bits) | np.where(runs_on, words[k : k + n], 0)
    return key[starts]


def _joined(words: list[pa.Array], n: int) -> pa.Array:
    """Words of a row parted by a blank, without the nulls at the end; n rows."""
    out = pc.fill_null(words[0], "") if words else pa.repeat("", n)
    for w in words[1:]:
        out = pc.if_else(pc.is_null(w), out, pc.binary_join_element_wise(out, pc.fill_null(w, ""), " "))
    return out


def _first_words(phrases: pa.Array, k: int) -> pa.Array:
    return pc.replace_substring_regex(phrases, rf"^((?:[^ ]+ ){{{k - 1}}}[^ ]+) .*$", r"\1")


def _emitted(found: dict[str, list[np.ndarray]], numbers: _Numbers, longest: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Distinct windows of a chunk with their counts, like ones side by side, which shrinks what is shuffled."""
    names = pa.array([None, *list(numbers)[1:]], pa.string())
    for lang, parts in found.items():
        # In place: a chunk is held once, and then what is different in it.
        keys = np.concatenate(parts)
        parts.clear()
        if not len(keys):
            continue
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, counts = keys[first], np.diff(np.append(first, len(keys)))
        for at in range(0, len(keys), SENT):
            some, n = keys[at : at + SENT], counts[at : at + SENT]
            words = [names.take(pa.array((some >> (bits * (longest - 1 - k))) & ((1 << bits) - 1))) for k in range(longest)]
            start, rest = _joined(words[:2], len(some)), _joined(words[2:], len(some))
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(some)), start, rest, pa.array(n)], ["lang", "start", "rest", "a"])


def _counted(longest: int, chunk: int):
    bits = 63 // longest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, found, n = _Numbers({b".": 0}), {}, 0
        for b in batches:
            texts, langs = b.column("text").cast(pa.binary()), b.column("lang").to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
            for lang in dict.fromkeys(langs):
                rows = np.flatnonzero(langs == lang)
                part = np.cumsum(sizes[rows]) // SLICE
                for some in np.split(rows, np.flatnonzero(np.diff(part)) + 1):
                    words = _numbered(texts.take(pa.array(some)).to_pylist(), numbers, longest)
                    if len(numbers) > 1 << bits:
                        # Too many words for a number of so few bits: count what is there and number anew.
                        yield from _emitted(found, numbers, longest, bits)
                        found, n, numbers = {}, 0, _Numbers({b".": 0})
                        yield from _alone(texts.take(pa.array(some)).to_pylist(), lang, longest, bits)
                        continue
                    found.setdefault(lang, []).append(_windows(words, longest, bits))
                    n += len(words)
                    if n >= chunk:
                        yield from _emitted(found, numbers, longest, bits)
                        found, n, numbers = {}, 0, _Numbers({b".": 0})
        yield from _emitted(found, numbers, longest, bits)

    return run


def _alone(texts: list[bytes | None], lang: str, longest: int, bits: int) -> Iterator[pa.RecordBatch]:
    """The windows of a few texts, a stretch of words at a time that cannot hold too many different ones."""
    plain = b" . ".join(t for t in texts if t).translate(_PLAIN).replace(b".", b" . ").split()
    step = (1 << bits) - longest - 1
    for at in range(0, len(plain), step):
        numbers = _Numbers({b".": 0})
        stretch = plain[at : at + step + longest - 1]
        # The words behind the stretch only fill its last windows.
        stretch.extend([b"."] * (min(step, len(plain) - at) + longest - 1 - len(stretch)))
        words = np.fromiter(map(numbers.__getitem__, stretch), np.int64, len(stretch))
        yield from _emitted({lang: [_windows(words, longest, bits)]}, numbers, longest, bits)


def lead_windows(docs: DataFrame, text_col: str, lang_col: str, longest: int, chunk: int) -> DataFrame:
    """(lang, start, rest, a): each window of up to ``longest`` words that a word leads, counted by chunk.

    ``start`` has its first two words, ``rest`` the others, parted by a blank; fewer than
    ``longest`` mean that the piece ends there.
    """
    if not 2 <= longest <= 9:
        raise ValueError("longest must be 2 to 9")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_counted(longest, chunk), "lang string, start string, rest string, a long")


def _hot_starts(docs: DataFrame, text_col: str, lang_col: str, longest: int, chunk: int) -> list[tuple[str, str]]:
    """The (lang, start) with most of a sample's windows, ``MANY`` of them at most.

    They only decide how rows are dealt out; any answer gives the same counts.
    """
    some = lead_windows(docs.sample(SAMPLE, 17), text_col, lang_col, longest, chunk)
    some = some.groupBy("lang", "start").agg(F.count(F.lit(1)).alias("rows"))
    return [(r["lang"], r["start"]) for r in some.orderBy(F.desc("rows")).limit(MANY).where(F.col("rows") >= HOT_ROWS).collect()]


def _changes(column: pa.Array) -> np.ndarray:
    """Whether a value differs from the one before it; the first does."""
    differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return np.append(True, differs)


def _prefix_sums(longest: int, least: int):
    """Sums by phrase and by each of its prefixes, of a batch of windows in the order of their words.

    What begins or ends with its batch, or is dealt out over tasks, may go on elsewhere: it
    is passed on whatever its sum. Other phrases below ``least`` stop here. Single words
    are always passed on, as all of them make the number of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            lang, start, rest = (b.column(c) for c in ("lang", "start", "rest"))
            a, deal = b.column("a").to_numpy(), b.column("deal").to_numpy()
            other = _changes(lang)

            def summed(words: int, phrase: pa.Array, new: np.ndarray, open_: np.ndarray, some: np.ndarray) -> pa.RecordBatch:
                at = np.flatnonzero(new)
                sums = np.add.reduceat(a, at)
                keep = ((sums >= least) | open_[at]) & some[at]
                keep[[0, -1]] = some[at[[0, -1]]]
                rows = pa.array(at[keep])
                columns = [lang.take(rows), pa.repeat(pa.scalar(words, pa.int32()), len(rows)), phrase.take(rows), pa.array(sums[keep])]
                return pa.RecordBatch.from_arrays(columns, ["lang", "words", "phrase", "a"])

            pair = other | _changes(start)
            sizes = np.where(pc.equal(rest, "").to_numpy(zero_copy_only=False), 0, pc.add(pc.count_substring(rest, " "), 1).to_numpy())
            whole, every = np.zeros(len(a), bool), np.ones(len(a), bool)
            for k in range(longest - 2, 0, -1):
                part = rest if k == longest - 2 else _first_words(rest, k)
                phrase = pc.binary_join_element_wise(start, part, " ")
                yield summed(k + 2, phrase, pair | _changes(part), whole if k == longest - 2 else every, sizes >= k)
            yield summed(2, start, pair, deal > 0, pc.match_substring(start, " ").to_numpy(zero_copy_only=False))
            word = _first_words(start, 1)
            yield summed(1, word, other | _changes(word), every, every)

    return run


def phrase_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST, chunk: int = CHUNK
) -> DataFrame:
    """(lang, words, phrase, a): phrases of 1 to ``longest`` words with ``least`` occurrences or more.

    words 0 and an empty phrase give the number of all words of a language.

    Windows are shuffled once, by their first two words, and put in order, so that what has
    a prefix in common stands together and is summed as it passes by; a start with very
    many windows is dealt out by its third word too. The sums of words and the few phrases
    that are left are then brought together, and a ROLLUP adds the words of a language.
    """
    hot = _hot_starts(docs, text_col, lang_col, longest, chunk)
    marked = [F.concat_ws(" ", F.lit(lang), F.lit(start)) for lang, start in hot]
    third = F.xxhash64(F.substring_index("rest", " ", 1))
    deal = F.when(F.concat_ws(" ", "lang", "start").isin(*marked), F.pmod(third, F.lit(SPLIT)).cast("int") + 1).otherwise(0) if hot else F.lit(0)
    windows = lead_windows(docs, text_col, lang_col, longest, chunk).withColumn("deal", deal)
    windows = windows.repartition("lang", "start", "deal").sortWithinPartitions("start", "lang", "rest")
    sums = windows.mapInArrow(_prefix_sums(longest, least), "lang string, words int, phrase string, a long")
    rolled = sums.rollup("lang", "words", "phrase").agg(F.sum("a").alias("a"), F.grouping_id().alias("g"))
    phrases = (F.col("g") == 0) & (F.col("a") >= least)
    total = (F.col("g") == 1) & (F.col("words") == 1)
    rolled = rolled.where(phrases | total)
    return rolled.select("lang", F.when(F.col("g") == 0, F.col("words")).otherwise(0).alias("words"), F.coalesce("phrase", F.lit("")).alias("phrase"), "a")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    chunk: int = CHUNK,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A phrase of 2 to ``longest`` words is scored floor(10^6 a^2 / (l r)) at its weakest cut,
    ties to the first; products are decimals of 38 digits. A phrase inside a longer one
    with at least half its count is dropped. Order: score, count, then phrase in byte order.

    Null texts are empty, a null language is ``und``, empty texts and tables give no rows,
    repeated rows count as often as they occur, other columns are ignored. Texts of any
    length are read whole. A phrase that a third of all texts hold is a row a chunk before
    anything is shuffled.
    """
    counts = materialised(phrase_counts(docs, text_col, lang_col, longest, least, chunk))
    candidates = counts.where(F.col("words") >= 2)
    parts = F.split("phrase", " ")

    def joined(first, length) -> Column:
        return F.array_join(F.slice(parts, first, length), " ")

    cuts = F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(k.alias("k"), joined(F.lit(1), k).alias("left"), joined(k + 1, F.col("words") - k).alias("right")),
    )
    cut = candidates.select("lang", "phrase", "words", "a", F.explode(cuts).alias("c")).select("lang", "phrase", "words", "a", "c.*")
    known = counts.where(F.col("words") >= 1)
    cut = cut.join(known.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cut = cut.join(known.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    # Exact: 18 digits each for a, l and r; no count passes them.
    score = F.expr("(cast(a as decimal(18)) * cast(a as decimal(18)) * 1000000bd) div (cast(l as decimal(18)) * cast(r as decimal(18)))")
    weakest = cut.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("m"))

    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: joined(i, n)),
        )
    )
    inside = candidates.where("words > 2").select("lang", F.explode(spans).alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = weakest.join(inside, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 50 * a")
    # The first of each part of a language come first, so that no language is put in order in one task.
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = left.select("lang", "phrase", "a", "m.l", "m.r", "m.score", F.pmod(F.xxhash64("phrase"), F.lit(SPLIT)).alias("part"))
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))
    rows = rows.withColumn("place", place).where(F.col("place") <= top)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    totals = counts.where("words = 0").select("lang", F.col("a").alias("n"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
