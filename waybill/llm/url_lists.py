"""URL filters by a temporal join with dated lists.

A list is a log of dated entries: from a day on, a domain is blocked, allowed or on no
list. Each entry holds until the next one for the same key, and a capture is judged by
the entries in force on the day it was fetched, not by today's list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.shared import let
from waybill.session import materialised


def host_of(url: Column) -> Column:
    """Lower-case host without user, port, final dot; null where there is none."""
    host = F.lower(F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def keys_of(host: Column) -> Column:
    """(key, labels) for the host and all its parent domains, the top-level domain too."""
    return let(
        F.split(host, r"\.", -1),
        lambda parts: F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda n: F.struct(F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".").alias("key"), n.alias("labels")),
        ),
    )


def intervals(entries: DataFrame, key_col: str = "domain", day_col: str = "listed_on", action_col: str = "action") -> DataFrame:
    """(key, log): one row per key with its intervals (since, until, action) in order.

    ``until`` is the day of the next entry, null for the last. Of entries of one key and
    day the alphabetically last action holds (remove, block, allow: remove wins). Entries
    without key or day say nothing.
    """
    log = entries.select(F.lower(F.col(key_col)).alias("key"), F.col(day_col).cast("date").alias("since"), F.col(action_col).alias("action"))
    log = log.where(F.col("key").isNotNull() & F.col("since").isNotNull())
    log = log.groupBy("key", "since").agg(F.max("action").alias("action"))
    logs = log.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("since", "action"))).alias("e"))
    interval = lambda x, i: F.struct(x["since"].alias("since"), F.get(F.col("e"), i + 1)["since"].alias("until"), x["action"].alias("action"))
    return logs.select("key", F.transform("e", interval).alias("log"))


def url_filter(
    pages: DataFrame,
    entries: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    day_col: str = "fetched_on",
) -> DataFrame:
    """page_id, url, fetched_on, host, rule, action, kept: one row per row of ``pages``.

    Of the entries in force that name the host or a parent domain, the longest decides:
    "block" drops the page; "allow", "remove" (off the list) or no entry keep it. A page
    without host or fetch day has no entry and is kept. Repeated rows are judged once and
    returned as often as they occur.

    A key has one row, whatever its history, so the as-of join adds no rows and a host
    with a third of all captures is split like any skewed join. Captures are reduced to
    distinct (host, day) before their parent domains are spelt out.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(day_col).cast("date").alias("fetched_on"),
        host_of(F.col(url_col)).alias("host"),
    )
    visits = rows.where(F.col("host").isNotNull() & F.col("fetched_on").isNotNull()).select("host", "fetched_on").distinct()
    asked = visits.select("host", "fetched_on", F.explode(keys_of(F.col("host"))).alias("k")).select("host", "fetched_on", "k.*")
    # Both small sides are written: a hot domain or host is then a join that can be split.
    joined = asked.join(materialised(intervals(entries)), "key")
    in_force = F.filter(
        "log", lambda x: (x["since"] <= F.col("fetched_on")) & F.coalesce(F.col("fetched_on") < x["until"], F.lit(True))
    )
    active = joined.select("host", "fetched_on", "key", "labels", F.get(in_force, F.lit(0))["action"].alias("action"))
    best = active.where(F.col("action") != "remove").groupBy("host", "fetched_on").agg(F.max(F.struct("labels", "key", "action")).alias("b"))
    best = materialised(best.select("host", "fetched_on", F.col("b.key").alias("rule"), F.col("b.action").alias("action")))
    return rows.join(best, ["host", "fetched_on"], "left").select(
        "page_id", "url", "fetched_on", "host", "rule", "action", (F.coalesce("action", F.lit("")) != "block").alias("kept")
    )
