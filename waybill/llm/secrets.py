"""Secret scan by corpus-wide ownership frequency.

Candidates are found by pattern in every text. Their hashes are counted over the whole
corpus by distinct repositories and owners: what many owners hold is a copied example,
what many repositories of few owners hold goes round among them, and what few of both hold
and looks drawn at random is a live secret. The looser pattern alone would
mark too much, so a loose candidate becomes a span only if it is owner-specific.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.shared import carried, let, same_row, text_key
from waybill.session import materialised

# What counts as a base span. Group 2 of assign has the value.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Minimum characters: of the value for assign, of the match for the others.
LEAST = {"assign": 6, "access": 20, "hex": 24, "loose": 20}
#: Runs of fewer characters fail anyway; asking for them here saves their rows.
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": r"[0-9a-f]{24,}", "loose": r"[A-Za-z0-9+/_=-]{20,}"}
#: A text without any of these has no candidate.
ANY = r"[A-Za-z0-9+/_=-]{20,}|(?i:password|passwd|secret|token|api_?key)"
ORDER = ["assign", "access", "hex", "loose"]
#: Owners from which on a value is a widely copied example, and repositories from which on
#: a value of fewer owners is a copy that goes round among them (a template, a fixture).
WIDE = 5
ROUND = 50


def looks_drawn(value: Column) -> Column:
    """At least 16 characters with four letters, four digits and ten different characters."""
    letters = F.length(value) - F.length(F.regexp_replace(value, "[A-Za-z]", ""))
    digits = F.length(value) - F.length(F.regexp_replace(value, "[0-9]", ""))
    different = F.size(F.array_distinct(F.split(value, "")))
    return (F.length(value) >= 16) & (letters >= 4) & (digits >= 4) & (different >= 10)


def candidates(docs: DataFrame, id_col: str, text_col: str, repository_col: str, owner_col: str) -> DataFrame:
    """(doc_id, key, repository, owner, kind, start, end, value), a row for each match.

    Places are code points, the end exclusive. Splitting a text by a pattern gives what
    lies between its matches, so running lengths of both give the places; they run
    within (document, kind), which a document's own length bounds.
    """
    text = F.col("text")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        text_key(F.col(text_col)).alias("key"),
        F.col(repository_col).cast("string").alias("repository"),
        F.col(owner_col).cast("string").alias("owner"),
        F.col(text_col).alias("text"),
    ).where(F.coalesce(text.rlike(ANY), F.lit(False)))

    def found(kind: str) -> Column:
        pairs = F.arrays_zip(
            F.split(text, PATTERNS[kind], -1).alias("gap"),
            F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)).alias("match"),
        )
        hits = F.transform(pairs, lambda p, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(p["gap"]).alias("gap"), p["match"].alias("match")))
        return F.filter(hits, lambda h: h["match"].isNotNull())

    rows = rows.select("doc_id", "key", "repository", "owner", F.explode(F.concat(*[found(k) for k in ORDER])).alias("h"))
    rows = rows.select("doc_id", "key", "repository", "owner", "h.*").dropDuplicates(["doc_id", "key", "kind", "i"])
    before = Window.partitionBy("doc_id", "key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(before))
    value = F.when(F.col("kind") == "assign", F.regexp_extract("match", ASSIGN, 2)).otherwise(F.col("match"))
    rows = rows.withColumns({"start": F.col("end") - F.length("match"), "value": value})
    long_enough = F.lit(False)
    for kind, least in LEAST.items():
        long_enough = long_enough | ((F.col("kind") == kind) & (F.length("value") >= least))
    rows = rows.where(long_enough)
    # A loose candidate that meets a base span of its document is that span.
    place = Window.partitionBy("doc_id", "key").orderBy("start")
    base = F.col("kind") != "loose"
    reach = F.max(F.when(base, F.col("end"))).over(place.rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(base, F.col("start"))).over(place.rangeBetween(0, Window.unboundedFollowing))
    rows = rows.withColumns({"reach": reach, "ahead": ahead})
    apart = (F.coalesce("reach", F.lit(-1)) <= F.col("start")) & (F.coalesce(F.col("ahead"), F.col("end")) >= F.col("end"))
    return rows.where(base | (apart & looks_drawn(F.col("value")))).select(
        "doc_id", "key", "repository", "owner", "kind", "start", "end", "value"
    )


def ownership(found: DataFrame, wide: int = WIDE, round_: int = ROUND) -> DataFrame:
    """Per candidate hash: spans, distinct repositories and owners, verdict.

    Many owners make an ``example``, many repositories of few owners a ``copied`` value;
    what few repositories of few owners hold is ``live`` if it looks drawn, else ``weak``.

    Distinct (hash, repository, owner) come first, combined before the shuffle, so a value
    that a third of all documents hold is a row per owner and repository. A null
    repository or owner counts as one of its own.
    """
    holder = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(c) for c in ("repository", "owner")]
    value = F.col("value")
    each = found.select(F.sha2("value", 256).alias("hash"), *holder, looks_drawn(value).alias("drawn"))
    each = each.groupBy("hash", "drawn", "repository", "owner").agg(F.count(F.lit(1)).alias("spans"))
    owners = each.groupBy("hash", "drawn", "owner").agg(F.sum("spans").alias("spans"), F.count(F.lit(1)).alias("repositories"))
    counted = owners.groupBy("hash", "drawn").agg(
        F.sum("spans").alias("spans"), F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners")
    )
    verdict = F.when(F.col("owners") >= wide, "example").when(F.col("repositories") >= round_, "copied")
    verdict = verdict.when(F.col("drawn"), "live").otherwise("weak")
    return counted.withColumn("verdict", verdict).drop("drawn")


def judged(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repository_col: str = "doc_id",
    owner_col: str = "source",
    wide: int = WIDE,
    round_: int = ROUND,
) -> DataFrame:
    """(doc_id, key, spans) of documents with spans; spans by start, then kind, each with its verdict."""
    found = materialised(candidates(docs, id_col, text_col, repository_col, owner_col))
    # Written, so that a value which a third of all documents hold is a join that can be split.
    verdicts = materialised(ownership(found, wide, round_).select("hash", "verdict"))
    rows = found.withColumn("hash", F.sha2("value", 256)).join(verdicts, "hash")
    rows = rows.where((F.col("kind") != "loose") | (F.col("verdict") == "live"))
    rank = F.array_position(F.lit(ORDER), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "end", "kind", "verdict", "hash")
    return rows.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row per row of ``docs``.

    A null text is empty and has no spans, as is a table without rows. Rows that repeat id
    and text are one document, and each gets its spans; rows that share only the id are
    different documents. Other columns are ignored.
    """
    hits = judged(docs, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"))
    joined = rows.join(hits, same_row(rows, hits, "doc_id", "key"), "left")
    spans = F.coalesce(hits["spans"], F.array().cast(hits.schema["spans"].dataType))
    line = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return joined.select(
        rows["doc_id"],
        *[number(k) for k in ORDER[:3]],
        F.sha2(line(F.filter(spans, lambda s: s["kind"] != "loose")), 256).alias("base_sha256"),
        line(spans).alias("spans"),
    )


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every span's characters replaced by a mark: [EXAMPLE] for values that many
    owners hold, [COPIED] for those in many repositories of few owners, [SECRET] for all others. Overlapping spans share a mark. Texts without
    spans, null texts and all other columns stay.
    """
    hits = judged(docs, id_col, text_col, **options)
    row = F.col("row")
    rows = carried(docs).withColumns({"id": row[id_col], "text_key": text_key(row[text_col])})
    rows = rows.join(hits, rows["id"].eqNullSafe(hits["doc_id"]) & (rows["text_key"] == hits["key"]), "left")
    text = F.when(F.col("spans").isNull(), row[text_col]).otherwise(_marked(row[text_col], F.col("spans")))
    return rows.select(row.withField(text_col, text).alias("row")).select("row.*")


def _marked(text: Column, spans: Column) -> Column:
    """The text between spans and, for each group of overlapping ones, the mark of its first."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        mark = F.when(s["verdict"] == "example", "[EXAMPLE]").when(s["verdict"] == "copied", "[COPIED]").otherwise("[SECRET]")
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        new = F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(gap, mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), new.alias("out"))

    rest = lambda a: F.substring(text, (a["at"] + 1).cast("int"), F.length(text))
    return let(F.aggregate(spans, start, step), lambda a: F.concat(F.array_join(a["out"], ""), rest(a)))
