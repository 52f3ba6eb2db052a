"""Keys, lookups and medians under skew, against brute force."""

import random
import statistics
from decimal import Decimal

import pytest
from compare import values
from pyspark.sql import functions as F

from ledgerlake.operators import keys, marts
from ledgerlake.session import shared_folder


@pytest.fixture
def skewed(frame):
    """A third of the rows on one key, some on no key, identical copies among them."""
    rng = random.Random(5)
    rows = [(1, "hot", 7)] * 400
    rows += [(rng.randint(2, 60), "x", rng.randint(0, 9)) for _ in range(760)]
    rows += [(None, "none", 1)] * 40
    return frame("k int, tag string, n int", rows), rows


def test_hot_keys_are_few(skewed):
    df, _ = skewed
    assert values(keys.hot_keys(df, "k", 100)) == [(1, 4)]
    assert {r._parts for r in keys.hot_keys(df, "k", 30).where("k is null").collect()} == {2}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("part", [None, 1, 30, 10**6])
def test_lookup_gives_the_same_rows_whatever_the_skew(frame, skewed, how, part):
    df, rows = skewed
    dim = frame("k int, name string", [(k, f"name{k}") for k in range(1, 50)])
    names = {k: f"name{k}" for k in range(1, 50)}
    expected = [(k, tag, n, names.get(k)) for k, tag, n in rows if how == "left" or k in names]
    got = values(keys.lookup(df, dim, "k", how, part), "k", "tag", "n", "name")
    assert got == sorted(expected, key=repr)


def test_large_joins_are_dealt_by_their_rows(frame, monkeypatch):
    """Tasks of a join grow in number with its rows, also where the session shuffles into few."""
    monkeypatch.setattr(keys, "PART_ROWS", 50)
    fact, dim = frame("k int, n int", [(i % 250, i) for i in range(500)]), frame("k int, v int", [(i, -i) for i in range(250)])
    joined = keys.lookup(fact, dim, "k", "inner", 50)
    assert joined.rdd.getNumPartitions() == 10
    assert values(joined, "k", "n", "v") == sorted([(i % 250, i, -(i % 250)) for i in range(500)], key=repr)
    assert keys.dealt(fact, 4 * keys.PART_ROWS, "k") is fact


def test_hot_branch_disappears_when_no_key_is_hot(frame):
    fact = frame("k int, n int", [(i % 50, i) for i in range(500)])
    dim = frame("k int, v int", [(i, i) for i in range(50)])
    joined = keys.lookup(fact, dim, "k", "inner", 500)
    joined.collect()
    final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Union" not in final


def test_rows_are_numbered_without_gaps(frame):
    rng = random.Random(3)
    rows = [(rng.randint(0, 5), i) for i in rng.sample(range(1000), 500)]
    numbered = keys.number_rows(frame("a int, b int", rows), ["a", "b"], "sk")
    expected = [(i + 1, a, b) for i, (a, b) in enumerate(sorted(rows))]
    assert sorted(tuple(r) for r in numbered.select("sk", "a", "b").collect()) == expected


def test_numbering_survives_more_rows_than_partitions_and_none(frame):
    assert keys.number_rows(frame("a int", []), ["a"], "sk").count() == 0
    assert values(keys.surrogate_key(frame("a int", [(9,), (4,)]), "a", "sk"), "sk", "a") == [(1, 4), (2, 9)]


def test_latest_per_key_breaks_ties_the_same_way_every_time(frame):
    rows = [(1, "2020-01-01", "a"), (1, "2021-01-01", "b"), (1, "2021-01-01", "c"), (2, None, "d"), (2, "2019-01-01", "e")]
    df = frame("k int, at string, v string", rows)
    expected = [(1, "2021-01-01", "c"), (2, "2019-01-01", "e")]
    assert values(keys.latest_per_key(df, ["k"], ["at"])) == expected
    assert values(keys.latest_per_key(df.repartition(7), ["k"], ["at"])) == expected


@pytest.mark.parametrize("sizes", [[1], [2], [5, 6], [301, 500]])
def test_exact_median_by_brute_force(frame, sizes):
    rng = random.Random(sum(sizes))
    rows, expected = [], []
    for g, size in enumerate(sizes):
        group = [Decimal(rng.choice([0, 1, 99, 10_000, rng.randint(0, 10**9)])) / 100 for _ in range(size)]
        rows += [(f"g{g}", v) for v in group]
        expected.append((f"g{g}", float(statistics.median(group))))
    rows += [(None, Decimal("3.00")), ("g0", None)]
    expected.append((None, 3.0))
    got = marts.exact_median(frame("g string, v decimal(14,2)", rows), "g", "v")
    assert sorted(((r.g, float(r.mediana)) for r in got.collect()), key=repr) == sorted(expected, key=repr)


def test_median_of_a_hot_value(frame):
    rows = [("g", Decimal("5.00"))] * 500 + [("g", Decimal(i)) for i in range(100)]
    got = marts.exact_median(frame("g string, v decimal(14,2)", rows), "g", "v").first()
    assert float(got.mediana) == 5.0


def test_checkpoints_go_to_the_named_folder(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert shared_folder(spark)
    if named:
        assert shared_folder(spark) == named


def test_allocation_adds_up(frame):
    df = frame("k int, w int", [(1, 1), (2, 5), (3, 5), (4, 0)])
    # Shares round to 1, 5, 5 and at least 1; the first of the two largest gives back the 2 too many.
    assert values(marts.allocate(df, "k", "w", 10), "k", "cota") == [(1, 1), (2, 3), (3, 5), (4, 1)]
    rest = marts.allocate(frame("k int, w int", [(1, 1), (2, 1), (3, 1)]), "k", "w", 10)
    assert values(rest, "k", "cota") == [(1, 4), (2, 3), (3, 3)]
    assert rest.agg(F.sum("cota")).first()[0] == 10
