"""Running totals, as-of counts and quantiles against brute force."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from waybill.functions.numbers import ordered_bucket
from waybill.operators.asof import attach_known, cumulative_history, known_before, with_known
from waybill.operators.quantiles import exact_quantiles
from waybill.operators.running import running_totals

T0 = dt.datetime(2018, 1, 1)


def test_running_totals_per_key(spark):
    rng = random.Random(1)
    rows = [(k, i, rng.randint(0, 9)) for k in "ab" for i in rng.sample(range(500), 120)]
    df = spark.createDataFrame(rows, "k string, pos int, v int")
    for exclusive in (False, True):
        got = running_totals(
            df, ["k"], "pos", ["v"], F.floor(F.col("pos") / 37), exclusive=exclusive
        )
        found = {(r.k, r.pos): r.v for r in got.collect()}
        for k, pos, _ in rows:
            known = [v for kk, p, v in rows if kk == k and (p < pos or (p == pos and not exclusive))]
            assert found[k, pos] == sum(known)


def test_running_totals_without_key_and_null_key(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("x", 1, 7)], "k string, pos int, v int")
    got = running_totals(df, ["k"], "pos", ["v"], F.col("pos"))
    assert sorted((str(r.k), r.pos, r.v) for r in got.collect()) == [
        ("None", 1, None), ("None", 2, None), ("x", 1, 7),
    ]
    total = running_totals(df.filter("k is null").drop("k"), [], "pos", ["v"], F.col("pos"))
    assert sorted((r.pos, r.v) for r in total.collect()) == [(1, 5), (2, 11)]


def _orders(n, seed, sellers):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        bought = T0 + dt.timedelta(seconds=rng.randint(0, 40) * 1800)
        known = bought + dt.timedelta(seconds=rng.randint(0, 30) * 1800)
        rows.append((i, rng.choice(sellers), bought, known, rng.randint(0, 1)))
    return rows


SCHEMA = "id int, seller string, bought timestamp_ntz, known timestamp_ntz, late int"
MEASURES = {"n": F.lit, "late_n": F.col}


@pytest.mark.parametrize("keys", [["seller"], []])
def test_known_before_matches_brute_force(spark, keys):
    # One seller owns most rows and times collide often.
    rows = _orders(300, 3, ["hot"] * 6 + ["a", "b"])
    df = spark.createDataFrame(rows, SCHEMA)
    known = known_before(df, keys, "known", "bought", {"n": F.lit(1), "late_n": F.col("late")})
    got = {r.id: r for r in attach_known(df, known, keys, "bought").collect()}
    assert len(got) == len(rows)
    for i, seller, bought, _, _ in rows:
        past = [r for r in rows if r[3] < bought and (not keys or r[1] == seller)]
        assert got[i].n == len(past)
        assert got[i].late_n == sum(r[4] for r in past)
        assert got[i].last_seen == max((r[3] for r in past), default=None)


def test_known_before_matches_merge_asof(spark):
    rows = _orders(200, 5, ["a", "b", "c"])
    df = spark.createDataFrame(rows, SCHEMA)
    known = known_before(df, ["seller"], "known", "bought", {"n": F.lit(1)})
    got = {r.id: r.n for r in attach_known(df, known, ["seller"], "bought").collect()}
    pdf = pd.DataFrame(rows, columns=["id", "seller", "bought", "known", "late"])
    history = pdf.sort_values("known")
    history["cum"] = history.groupby("seller").cumcount() + 1
    merged = pd.merge_asof(
        pdf.drop(columns="known").sort_values("bought"),
        history[["seller", "known", "cum"]],
        left_on="bought",
        right_on="known",
        by="seller",
        allow_exact_matches=False,
    )
    assert got == {i: int(c) if c == c else 0 for i, c in zip(merged["id"], merged["cum"])}


def test_exact_match_and_first_order_are_not_known(spark):
    rows = [
        (1, "s", T0, T0 + dt.timedelta(days=1), 1),
        (2, "s", T0 + dt.timedelta(days=1), T0 + dt.timedelta(days=2), 0),
        (3, "s", T0 + dt.timedelta(days=1, microseconds=1), T0 + dt.timedelta(days=3), 0),
        (4, "quiet", T0 + dt.timedelta(days=5), T0 + dt.timedelta(days=6), 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    known = known_before(df, ["seller"], "known", "bought", {"n": F.lit(1), "l": F.col("late")})
    got = {r.id: (r.n, r.l) for r in attach_known(df, known, ["seller"], "bought").collect()}
    assert got == {1: (0, 0), 2: (0, 0), 3: (1, 1), 4: (0, 0)}


def test_cumulative_history_counts_simultaneous_rows_once(spark):
    rows = [(1, "s", T0, T0, 1), (2, "s", T0, T0, 0), (3, "s", T0, T0 + dt.timedelta(days=40), 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = cumulative_history(df, ["seller"], "known", {"n": F.lit(1), "l": F.col("late")})
    assert sorted((r.known, r.n, r.l) for r in got.collect()) == [
        (T0, 2, 1), (T0 + dt.timedelta(days=40), 3, 2),
    ]


def test_ordered_bucket_never_decreases(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([
        rng.normal(0, 1, 300), rng.lognormal(0, 9, 300), -rng.lognormal(0, 9, 300),
        2.0 ** np.arange(-30, 30), np.nextafter(2.0 ** np.arange(-30, 30), 0), [0.0, 1e-300, -1e300],
    ])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for bits in (8, 24):
        rows = df.select("v", ordered_bucket(F.col("v"), bits).alias("b")).collect()
        buckets = [r.b for r in sorted(rows, key=lambda r: r.v)]
        assert buckets == sorted(buckets)


@pytest.mark.parametrize("seed", [0, 1])
def test_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    groups = {
        "normal": rng.normal(0, 50, 301),
        "ties": rng.integers(0, 4, 200).astype(float),
        "tiny": np.array([1.0, 2.0, 3.0, 10.0]),
        "one": np.array([7.5]),
        "close": 100 + rng.random(150) * 1e-6,
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("normal", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q90": 0.9, "q1": 1.0}
    for few in (True, False):
        got = {r.g: r for r in exact_quantiles(df, ["g"], "v", wanted, few_groups=few).collect()}
        assert set(got) == set(groups)
        for g, vs in groups.items():
            for name, p in wanted.items():
                assert got[g][name] == pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12)


def test_quantiles_without_groups(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)], "v double")
    assert exact_quantiles(df, [], "v", {"m": 0.5}, few_groups=True).first().m == 2.5


@pytest.mark.parametrize("keys", [["seller"], []])
def test_with_known_is_known_before_attached(spark, keys):
    # Ties, repeated rows, and rows without seller, purchase or outcome time; the row keeps all its columns.
    rows = _orders(300, 5, ["hot"] * 6 + ["a", "b"])
    rows += rows[:20] + [(900, None, T0, T0, 1), (901, "a", None, T0, 1), (902, "a", T0, None, 1), (903, None, None, None, None)]
    rows += [(904 + i, "a", T0 + dt.timedelta(days=40 * i), T0 + dt.timedelta(days=41 * i), 1) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    measures = {"n": F.lit(1), "late_n": F.col("late")}
    expected = attach_known(df, known_before(df, keys, "known", "bought", measures), keys, "bought")
    names = [*df.columns, "n", "late_n", "last_seen"]
    got = with_known(df, keys, "known", "bought", measures)
    assert sorted(map(str, got.select(names).collect())) == sorted(map(str, expected.select(names).collect()))
