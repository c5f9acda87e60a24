"""Mixing sources to target weights by hierarchical budgeting.

Weights run down a tree of domain, language and source. A node that can't use its budget
(its rows are spent after ``max_epochs`` passes) passes the rest to its siblings; only
what a whole subtree can't use goes up to the ancestors' siblings. Every leaf then
takes the token-prefix of its seeded epochs that its budget pays for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.shared import carried, text_key, words
from waybill.session import materialised

LEVELS = ["domain", "lang", "source"]


def filled(children: DataFrame, parent: list[str]) -> DataFrame:
    """Adds ``budget``: ``parent_budget`` shared by weight, none above its ``capacity``.

    All open children rise together (budget = level x weight) until they are full. In the
    order in which they fill, the i-th is full exactly if the level that empties the
    parent's budget over it and all later ones reaches capacity / weight. Children of
    weight 0 get nothing. No loop: two running sums over the children of a node.
    """
    order = Window.partitionBy(*parent).orderBy((F.col("capacity") / F.col("weight")).asc(), *LEVELS)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("parent_budget") - F.coalesce(F.sum("capacity").over(earlier), F.lit(0.0))
    level = F.greatest(left, F.lit(0.0)) / F.sum("weight").over(later)
    rows = children.where(F.col("weight") > 0).withColumn("level", level)
    # From the first child that doesn't fill, the level stays; the levels of later ones are lower.
    full = F.col("level") * F.col("weight") >= F.col("capacity")
    held = F.max(F.when(~full, F.col("level"))).over(Window.partitionBy(*parent))
    rows = rows.withColumn("held", held)
    return rows.withColumn("budget", F.least("capacity", F.coalesce(F.col("held") * F.col("weight"), F.col("capacity")))).drop("level", "held")


def budgets(leaves: DataFrame, weights: DataFrame, share: float, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) of leaves; ``leaves`` has their tokens.

    ``weights`` has (domain, lang, source, weight); a node's weight is its leaves' sum and
    counts relative to its siblings. Leaves without weight get no budget. The tree has a
    row per leaf, far fewer than documents.
    """
    given = weights.select(*[F.col(c).alias(f"w_{c}") for c in LEVELS], "weight")
    leaf = leaves.join(given, [F.col(c).eqNullSafe(F.col(f"w_{c}")) for c in LEVELS], "left").select(
        *LEVELS,
        "tokens",
        F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight"),
    )
    # What has no weight can't be used, so it's no capacity of its ancestors either.
    usable = F.when(F.col("weight") > 0, F.col("tokens") * float(max_epochs)).otherwise(0.0)
    leaf = leaf.withColumn("capacity", usable)
    total = leaf.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()["t"] * share
    above: DataFrame | None = None
    for depth in range(1, len(LEVELS) + 1):
        keys, parent = LEVELS[:depth], LEVELS[: depth - 1]
        nodes = leaf.groupBy(*keys).agg(F.sum("weight").alias("weight"), F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        if above is None:
            nodes = nodes.withColumn("parent_budget", F.lit(float(total)))
        else:
            up = above.select(*[F.col(c).alias(f"up_{c}") for c in parent], F.col("budget").alias("parent_budget"))
            nodes = nodes.join(up, [F.col(c).eqNullSafe(F.col(f"up_{c}")) for c in parent]).select(*keys, "weight", "capacity", "tokens", "parent_budget")
        missing = [F.lit(None).cast("string").alias(c) for c in LEVELS[depth:]]
        above = filled(nodes.select(*keys, *missing, "weight", "capacity", "tokens", "parent_budget"), parent).select(*keys, "tokens", "budget")
    return above


def mixed(
    docs: DataFrame,
    weights: DataFrame,
    share: float = 0.8,
    max_epochs: int = 4,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    levels: tuple[str, str, str] = ("domain", "lang", "source"),
) -> DataFrame:
    """doc_id, key, domain, lang, source, n_tokens, copies: one row per row of ``docs``.

    ``share`` of all tokens (words) is the budget; copies is how many epochs of its leaf
    take the row. Whole epochs come first; the next, in an order drawn by ``seed`` and the
    epoch's number, takes rows while the tokens before them stay below the rest of the
    budget, so a leaf passes its budget by less than one document. Null levels are values
    like others, null texts have no tokens and ride along with the epoch, repeated rows
    are drawn alike. Leaves that are not in ``weights`` are not taken.

    Order within a leaf is found in two steps: tokens are summed by range of the drawn
    hash (its first three hex digits, 4,096 ranges), and only the range in which the budget ends is put in order row by row, so a
    leaf with a third of all rows is spread over its ranges.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        text_key(F.col(text_col)).alias("key"),
        *[F.col(c).cast("string").alias(n) for c, n in zip(levels, LEVELS, strict=True)],
        F.size(words(F.col(text_col))).cast("long").alias("n_tokens"),
    )
    rows = materialised(rows)
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    plan = budgets(leaves, weights, share, max_epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int")
    plan = materialised(plan.select(*[F.col(c).alias(f"p_{c}") for c in LEVELS], whole.alias("whole"), F.col("budget"), F.col("tokens")))
    rest = F.greatest(F.col("budget") - F.col("whole") * F.col("tokens"), F.lit(0.0))
    joined = rows.join(plan, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in LEVELS], "left")
    drawn = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce("whole", F.lit(0)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 16)
    joined = joined.select(
        "doc_id", "key", *LEVELS, "n_tokens", "whole", rest.alias("rest"), drawn.alias("drawn"), F.substring(drawn, 1, 3).alias("bucket")
    )
    sums = joined.where(F.col("whole").isNotNull()).groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("t"), F.first("rest").alias("r"))
    run = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("t").over(run), F.lit(0)))
    # Ranges wholly before the end are taken, the one that holds it is put in order, later ones are left.
    kind = F.when(F.col("before") + F.col("t") <= F.col("r"), "all").when(F.col("before") < F.col("r"), "part").otherwise("none")
    sums = sums.select(*[F.col(c).alias(f"b_{c}") for c in LEVELS], F.col("bucket").alias("b_bucket"), "before", kind.alias("kind"))
    same = [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in LEVELS]
    joined = joined.join(sums, [*same, F.col("bucket") == F.col("b_bucket")], "left")
    kept = [*LEVELS, "n_tokens"]
    clear = joined.where(F.coalesce("kind", F.lit("none")) != "part").select(
        "doc_id", "key", *kept, F.when(F.col("kind") == "all", F.col("whole") + 1).otherwise(F.coalesce("whole", F.lit(0))).alias("copies")
    )
    inside = Window.partitionBy(*LEVELS, "bucket").orderBy("drawn", "doc_id", "key").rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    part = joined.where(F.col("kind") == "part").select(
        "doc_id", "key", *kept, (F.col("whole") + (so_far < F.col("rest")).cast("int")).alias("copies")
    )
    return clear.unionByName(part)


def taken(docs: DataFrame, copies: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, as often as ``copies`` (of ``mixed``) says."""
    most = copies.groupBy("doc_id", "key").agg(F.max("copies").alias("copies")).where("copies > 0")
    row = F.col("row")
    rows = carried(docs).withColumns({"id": row[id_col], "text_key": text_key(row[text_col])})
    rows = rows.join(most, rows["id"].eqNullSafe(most["doc_id"]) & (rows["text_key"] == most["key"]))
    return rows.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
