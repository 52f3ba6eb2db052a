import datetime as dt

import pytest
from compare import values
from pyspark.sql import functions as F

from ledgerlake.operators import history as h

day = dt.date
LOAD = "k int, band string, note string"
OPEN = dt.date(9999, 12, 31)


def versions(df):
    return values(df, "k", "band", "note", h.START, h.END, h.CURRENT)


def test_a_load_closes_what_it_changes(frame):
    first = h.first_versions(frame(LOAD, [(1, "A", "x"), (2, "A", "x"), (3, None, "x"), (4, "A", "x"), (None, "A", "x"), (4, "A", "a")]), ["k"], ["band"], "2020-01-01")
    assert versions(first) == [(1, "A", "x", day(2020, 1, 1), OPEN, True), (2, "A", "x", day(2020, 1, 1), OPEN, True), (3, None, "x", day(2020, 1, 1), OPEN, True), (4, "A", "x", day(2020, 1, 1), OPEN, True)]
    load = frame(LOAD, [(1, "B", "y"), (2, "A", "y"), (3, "", "y"), (5, "C", "y"), (None, "Z", "y")])
    merged = h.merge_load(first, load, ["k"], ["band"], "2020-03-01")
    assert versions(merged) == sorted([
        (1, "A", "x", day(2020, 1, 1), day(2020, 2, 29), False), (1, "B", "y", day(2020, 3, 1), OPEN, True),
        (2, "A", "y", day(2020, 1, 1), OPEN, True),  # only an untracked column is new
        (3, None, "x", day(2020, 1, 1), day(2020, 2, 29), False), (3, "", "y", day(2020, 3, 1), OPEN, True),  # a missing value is one of its own
        (4, "A", "x", day(2020, 1, 1), OPEN, True),  # not in the load
        (5, "C", "y", day(2020, 3, 1), OPEN, True),
    ], key=repr)
    assert merged.where(h.CURRENT).groupBy("k").count().where("count > 1").count() == 0


def test_loads_of_the_same_day_and_late_ones(frame):
    first = h.first_versions(frame(LOAD, [(1, "A", "x"), (2, "A", "x")]), ["k"], ["band"], "2020-05-01")
    again = h.merge_load(first, frame(LOAD, [(1, "B", "y")]), ["k"], ["band"], "2020-05-01")
    assert versions(again) == [(1, "B", "y", day(2020, 5, 1), OPEN, True), (2, "A", "x", day(2020, 5, 1), OPEN, True)]
    late = h.merge_load(again, frame(LOAD, [(2, "C", "z"), (7, "C", "z")]), ["k"], ["band"], "2020-04-01")
    assert versions(late) == versions(again) + [(7, "C", "z", day(2020, 4, 1), OPEN, True)]


def test_all_loads_at_once_are_the_loads_one_by_one(spark, frame):
    import random

    rng = random.Random(4)
    loads = [(k, rng.choice("AB"), f"{d}", day(2020, d, 1)) for d in range(1, 9) for k in range(12) if rng.random() < 0.7]
    at_once = h.history_of(frame(LOAD + ", at date", loads[::-1]), ["k"], ["band"], "at")
    one_by_one = None
    for d in sorted({r[3] for r in loads}):
        load = frame(LOAD, [r[:3] for r in loads if r[3] == d])
        one_by_one = h.first_versions(load, ["k"], ["band"], d) if one_by_one is None else h.stored(h.merge_load(one_by_one, load, ["k"], ["band"], d), "history")
    assert versions(at_once) == versions(one_by_one)
    assert at_once.where(h.CURRENT).count() == len({r[0] for r in loads})


def test_facts_meet_the_version_of_their_day(spark, frame):
    history = h.history_of(frame(LOAD + ", at date", [(1, "A", "", day(2020, 1, 15)), (1, "B", "", day(2020, 3, 10)), (2, "C", "", day(2020, 2, 1))]), ["k"], ["band"], "at")
    facts = frame("id int, k int, t timestamp_ntz", [
        (1, 1, dt.datetime(2020, 1, 14, 23)), (2, 1, dt.datetime(2020, 1, 15)), (3, 1, dt.datetime(2020, 3, 9, 23, 59)), (4, 1, dt.datetime(2020, 3, 10)),
        (5, 1, dt.datetime(2031, 1, 1)), (6, 2, dt.datetime(2020, 1, 31)), (7, 3, dt.datetime(2020, 2, 1)), (8, None, dt.datetime(2020, 2, 1)), (9, 1, None)])
    found = h.lookup_at(facts, history, ["k"], "t", ["band"], "left")
    assert values(found, "id", "band") == [(1, None), (2, "A"), (3, "A"), (4, "B"), (5, "B"), (6, None), (7, None), (8, None), (9, None)]
    assert h.lookup_at(facts, history, ["k"], "t", ["band"]).count() == 4
    assert h.lookup_at(facts.limit(0), history, ["k"], "t", ["band"], "left").count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        physical = h.lookup_at(facts, history, ["k"], "t", ["band"], "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_month" in plan and "NestedLoop" not in physical and "Cartesian" not in physical


def test_versions_keep_their_keys(frame):
    first = h.first_versions(frame(LOAD, [(3, "A", ""), (1, "A", "")]), ["k"], ["band"], "2020-01-01")
    keyed = h.stored(h.with_version_keys(first, ["k"], "sk"), "keyed")
    assert values(keyed, "k", "sk") == [(1, 1), (3, 2)]
    merged = h.merge_load(first, frame(LOAD, [(1, "B", ""), (2, "A", "")]), ["k"], ["band"], "2020-02-01")
    again = h.with_version_keys(merged, ["k"], "sk", keyed)
    assert values(again, "k", h.START, "sk") == [(1, day(2020, 1, 1), 1), (1, day(2020, 2, 1), 3), (2, day(2020, 2, 1), 4), (3, day(2020, 1, 1), 2)]


@pytest.mark.parametrize("a,b,same", [((None, "x"), ("x", None), False), (("a|1:b", "c"), ("a", "b|1:c"), False), (("1", None), ("1", None), True), (("-", ""), (None, ""), False)])
def test_digests_tell_rows_apart(frame, a, b, same):
    rows = frame("p string, q string", [a, b]).select(h.digest(["p", "q"]).alias("d"))
    assert (rows.distinct().count() == 1) == same


def test_valid_on_a_day(frame):
    history = h.history_of(frame(LOAD + ", at date", [(1, "A", "", day(2020, 1, 1)), (1, "B", "", day(2020, 2, 1))]), ["k"], ["band"], "at")
    assert [values(h.valid_on(history, d), "band") for d in ("2019-12-31", "2020-01-31", "2020-02-01")] == [[], [("A",)], [("B",)]]
