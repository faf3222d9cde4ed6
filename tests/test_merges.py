"""Merge rules, against plain Python over small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spendloom.operators import filters, joins, merge

D = [dt.date(2018, 1, i) for i in range(1, 9)]
ADS = "ad int, day date, clicks int"
KEYS = ["ad", "day"]


def random_ads(seed, n):
    """Rows in which a third share one key and some key parts are missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((1, D[0], i))
        else:
            ad = rng.choice([None, 1, 2, 3, 4])
            rows.append((ad, rng.choice([None, *D]), i))
    return rows


def expected_insert(target, source):
    known = {(a, d) for a, d, _ in target if a is not None and d is not None}
    return [r for r in source if (r[0], r[1]) not in known]


@pytest.mark.parametrize("prune", [None, "day"])
@pytest.mark.parametrize("seed", range(3))
def test_insert_only(make, values, seed, prune):
    target, source = random_ads(seed, 30), random_ads(seed + 100, 40)
    target = [r for r in target if r[0] != 2]
    got = merge.rows_to_insert(make(target, ADS), make(source, ADS), KEYS, prune)
    assert got.columns == ["ad", "day", "clicks"]
    want = expected_insert(target, source)
    assert values(got) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])


def test_insert_only_twice_is_once(make, values):
    target = [(1, D[0], 10)]
    source = [(1, D[0], 99), (2, D[0], 5), (2, D[0], 6)]
    once = merge.merge_insert(make(target, ADS), make(source, ADS), KEYS, "day")
    twice = merge.merge_insert(once, make(source, ADS), KEYS, "day")
    assert values(once) == values(twice) == [(1, D[0], 10), (2, D[0], 5), (2, D[0], 6)]


def test_rows_with_a_missing_key_go_in_every_time(make):
    source = make([(None, D[0], 5)], ADS)
    once = merge.merge_insert(make([], ADS), source, KEYS)
    assert merge.merge_insert(once, source, KEYS).count() == 2


def test_insert_into_and_from_nothing(make):
    some, none = make([(1, D[0], 1)], ADS), make([], ADS)
    assert merge.merge_insert(none, some, KEYS, "day").count() == 1
    assert merge.merge_insert(some, none, KEYS, "day").count() == 1


POSTS = "id string, title string, clicks int"


def upsert(make, target, source):
    insert = lambda new: new.withColumn("title", F.upper("title"))
    return merge.merge_upsert(make(target, POSTS), make(source, POSTS), ["id"], ["clicks"], insert)


def test_upsert_changes_counters_only(make, values):
    got = upsert(make, [("a", "old", 1), ("b", "b", 2)], [("a", "new", 9), ("c", "see", 3)])
    assert values(got) == [("a", "old", 9), ("b", "b", 2), ("c", "SEE", 3)]


def test_upsert_may_set_a_counter_to_missing(make, values):
    assert values(upsert(make, [("a", "old", 1)], [("a", "new", None)])) == [("a", "old", None)]


def test_upsert_refreshes_every_row_of_a_target_key(make, values):
    got = upsert(make, [("a", "x", 1), ("a", "y", 2)], [("a", "new", 9)])
    assert values(got) == [("a", "x", 9), ("a", "y", 9)]


def test_upsert_with_missing_keys(make, values):
    got = upsert(make, [(None, "t", 1)], [(None, "s", 2), (None, "u", 3)])
    assert values(got) == [(None, "S", 2), (None, "U", 3), (None, "t", 1)]


def test_upsert_fails_on_a_repeated_source_key(make):
    with pytest.raises(Exception, match="duplicate source key"):
        upsert(make, [("a", "old", 1)], [("a", "x", 2), ("a", "y", 3)]).collect()


CONTACTS = "vid int, program string"


def test_replace_all_rows_of_a_key(make, values):
    target = make([(1, "a"), (1, "b"), (2, "c"), (None, "n")], CONTACTS)
    source = make([(1, "x"), (1, "y"), (3, "z")], CONTACTS)
    got = merge.replace_by_key(target, source, ["vid"])
    assert values(got) == [(None, "n"), (1, "x"), (1, "y"), (2, "c"), (3, "z")]
    again = merge.replace_by_key(got, source, ["vid"])
    assert values(again) == values(got)


def test_delete_matched(make, values):
    target = make([(1, "a"), (2, "c"), (None, "n")], CONTACTS)
    assert values(merge.delete_matched(target, make([(1, "x"), (None, "y")], CONTACTS), ["vid"])) == [
        (None, "n"),
        (2, "c"),
    ]


def test_latest_day(make, values):
    df = make([(1, D[0], 1), (1, D[3], 2), (2, D[3], 3), (3, None, 4)], ADS)
    assert values(merge.delete_latest_day(df, "day")) == [(1, D[0], 1), (3, None, 4)]
    assert merge.delete_latest_day(make([], ADS), "day").count() == 0
    assert merge.delete_latest_day(make([(3, None, 4)], ADS), "day").count() == 1


def test_high_water_mark(make, values):
    staged = make([(1, D[0], 0), (2, D[3], 0), (3, D[5], 0), (4, None, 0)], ADS)
    stored = make([(9, D[1], 0), (9, D[3], 0)], ADS)
    kept = merge.highwater_prune(staged, "day", stored, "day")
    assert values(kept, "ad") == [(2,), (3,), (4,)]
    assert merge.highwater_prune(staged, "day", make([], ADS), "day").count() == 4


def test_classify(make, values):
    source = make([(1, "b"), (2, "b"), (3, "b"), (4, "b"), (5, None)], "id int, at string")
    stored = make([(1, "a"), (2, "b"), (3, "c"), (4, None), (5, "a"), (6, "a"), (1, "a")], "id int, upd string")
    got = merge.classify(source, stored, "id", "at", "upd")
    assert values(got, "id", "STATE") == [
        (1, "modified"),
        (2, "unchanged"),
        (3, "unchanged"),
        (4, "new"),
        (5, "unchanged"),
    ]


def test_cascade(make, values):
    ids = make([(1,), (1,), (None,)], "vid int")
    parent, child = merge.delete_cascade(make([(1, "a"), (2, "b")], CONTACTS), make([(1, "p"), (3, "q")], CONTACTS), ids, "vid")
    assert (values(parent), values(child)) == ([(2, "b")], [(3, "q")])


@pytest.mark.parametrize("stale, want", [(None, [1, 3]), (lambda stored, loaded: stored > loaded, [2, 3])])
def test_stale_keys(make, values, stale, want):
    stored = make([(1, "a"), (2, "c"), (3, "a"), (3, "a")], "vid int, upd string")
    loaded = make([(1, "b"), (1, "b"), (2, "b")], "vid int, seen string")
    extra = {} if stale is None else {"stale": stale}
    assert values(joins.stale_keys(stored, loaded, "vid", "upd", "seen", **extra)) == [(v,) for v in want]


def test_missing_keys_are_spread(make):
    df = make([(None, i) for i in range(200)] + [("x", 1000)], "mail string, vid int")
    keys = df.select(joins.spread_key(F.col("mail"), F.col("vid")).alias("k")).distinct()
    assert keys.count() == 201
    assert keys.filter(F.col("k") == "+x").count() == 1


def test_trailing_window_bounds(make, values):
    df = make([(i, d, 0) for i, d in enumerate(D)] + [(99, None, 0)], ADS)
    closed = filters.trailing_window(df, "day", "2018-01-05", 2)
    running = filters.trailing_window(df, "day", "2018-01-05", 2, include_today=True)
    assert [d for (d,) in values(closed, "day")] == D[2:4]
    assert [d for (d,) in values(running, "day")] == D[2:5]


def test_differs_keeps_missing(make, values):
    df = make([("PERSONAL",), ("BUSINESS",), (None,)], "type string")
    assert values(df.filter(filters.differs(F.col("type"), "PERSONAL"))) == [(None,), ("BUSINESS",)]


def test_left_join(make, values):
    left = make([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, l string")
    right = make([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "k int, r string")
    got = joins.left_join(left, right, ["k"])
    assert values(got) == values(left.join(right, "k", "left"))
    assert got.columns == ["k", "l", "r"]
    assert joins.left_join(left, right.limit(0), ["k"]).count() == 4


# --- repeated keys, whatever join Spark picks ------------------------------------------


@pytest.fixture(params=["broadcast", "shuffled"])
def join_kind(spark, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


POSTS = "id string, title string, clicks int"


@pytest.mark.parametrize("stored", [4000, 1, 0])
def test_upsert_fails_on_repeated_keys_after_the_last_stored_one(make, join_kind, stored):
    target = make([(f"a{i:05}", "old", 1) for i in range(stored)], POSTS)
    source = make([(f"z{i:03}", "new", 2) for i in range(20)] + [(f"z{i:03}", "again", 3) for i in range(10)], POSTS)
    with pytest.raises(Exception, match="duplicate source key"):
        merge.merge_upsert(target, source, ["id"], ["clicks"]).collect()


def test_upsert_fails_when_the_target_is_filtered_on_the_key(make, join_kind):
    target = make([("a", "old", 1), ("m", "old", 1)], POSTS).filter("id > 'k'")
    source = make([("b", "x", 2), ("b", "y", 3), ("m", "x", 2)], POSTS)
    with pytest.raises(Exception, match="duplicate source key"):
        merge.merge_upsert(target, source, ["id"], ["clicks"]).collect()
    with pytest.raises(Exception, match="duplicate source key"):
        merge.merge_upsert(target, source, ["id"], ["clicks"]).select("id").collect()


def test_upsert_gives_the_same_with_either_join(make, values, join_kind):
    target = make([("a", "old", 1), (None, "null", 5)], POSTS)
    source = make([("a", "new", 2), ("b", "new", 3), (None, "n1", 4), (None, "n2", 4)], POSTS)
    got = merge.merge_upsert(target, source, ["id"], ["clicks"])
    assert values(got) == [(None, "n1", 4), (None, "n2", 4), (None, "null", 5), ("a", "old", 2), ("b", "new", 3)]
