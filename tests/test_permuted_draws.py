"""Keyed permutations, the draws built on them, weights from a large table, dictionaries
numbered by range and the card pool, against plain sequential code."""

import bisect
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tabsmith.functions.draws import shuffled, u
from tabsmith.operators import draws, keyed, prefix


def _u(stream, *keys):
    return int(hashlib.md5(":".join(["42", stream, *map(str, keys)]).encode()).hexdigest()[:13], 16) / 2 ** 52


def _place(n, i, stream, *keys):
    """The i-th place of the permutation in plain Python."""
    p, k = 2147483647, int(hashlib.md5(":".join(["42", stream, *map(str, keys)]).encode()).hexdigest()[:13], 16) % 2147483647
    for _ in range(16):
        pair = (k * 2147483648 + (k * 69621 + 7) % p - i) % n
        y = (max(i, pair) + k) % p
        if (y * y % p * 48271 % p) % 2:
            i = pair
        k = (k * 48271 + 1) % p
    return i


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 54, 1000, 10 ** 6])
def test_all_places_are_a_permutation(spark, n):
    got = shuffled(spark.range(n), n, {"p": F.col("id")}, "t", F.lit(7))
    r = got.agg(F.count_distinct("p"), F.min("p"), F.max("p")).first()
    assert tuple(r) == ((n, 0, n - 1) if n else (0, None, None))
    if n <= 1000:
        assert [x.p for x in got.orderBy("id").collect()] == [_place(n, i, "t", 7) for i in range(n)]


def test_places_outside_are_null_and_first_places_are_even(spark):
    got = shuffled(spark.range(-2, 5), 3, {"p": F.col("id")}, "t").orderBy("id").collect()
    assert [r.p is None for r in got] == [True, True, False, False, False, True, True]
    counts = shuffled(spark.range(60000), 6, {"a": 0, "b": 1}, "t", "id").groupBy("a", "b").count().collect()
    assert len(counts) == 30 and all(abs(r["count"] - 2000) < 250 for r in counts)


def test_picks_of_a_list_and_what_is_missing(spark):
    own = spark.createDataFrame([("g", f"o{i}") for i in range(5)] + [("h", "o1"), ("h", "x2")], "grp string, item string")
    general = spark.createDataFrame([(f"x{i}",) for i in range(4)], "item string")
    rows = spark.range(300).select("id", F.element_at(F.array(F.lit("g"), F.lit("h"), F.lit("none"), F.lit(None)), (F.col("id") % 4 + 1).cast("int")).alias("grp"))
    out = draws.fallback_lists(rows, ["id"], "grp", own, general, "item", F.lit(3), 3, "s", "picks").collect()
    lists = {"g": [f"o{i}" for i in range(5)], "h": ["o1", "x2"]}
    assert len(out) == 300
    for r in out:
        mine = lists.get(r.grp, [])
        want = [mine[_place(len(mine), i, "s", r.id)] for i in range(min(3, len(mine)))]
        more = [f"x{_place(4, i, 's:general', r.id)}" for i in range(3)] if len(mine) < 3 else []
        assert r.picks == want + [x for x in more if x not in mine][:3 - len(want)]


def test_a_million_weights_need_no_nested_loop(spark):
    w = spark.range(10 ** 6).select("id", F.when(F.col("id") == 77, 10 ** 7).otherwise(F.col("id") % 3).alias("w"))
    slices = draws.weighted_slices(w, "id", "id", "w")
    out = draws.pick_weighted_table(spark.range(2000).withColumnRenamed("id", "k"), slices, "t", ["k"], "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    ends, total, values = [], 0, []
    for i in range(10 ** 6):
        x = 10 ** 7 if i == 77 else i % 3
        if x:
            total += x
            ends.append(total)
            values.append(i)
    got = {r.k: r.v for r in out.collect()}
    assert got == {k: values[bisect.bisect_right(ends, math.floor(_u("t", k) * total))] for k in range(2000)}


def test_no_weights(spark):
    none = draws.weighted_slices(spark.createDataFrame([(1, "a", 0), (2, "b", None), (None, "c", 3)], "k long, v string, w long"), "k", "v", "w")
    assert [r.x for r in draws.pick_weighted_table(spark.range(2), none, "t", ["id"], "x").collect()] == [None, None]


def test_dictionary_is_numbered_without_a_window_over_it(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 != 0, F.md5((F.col("id") % 3000).cast("string"))).alias("v"))
    out = prefix.dense_index(df, "v")
    want = sorted({r.v for r in df.collect()} - {None})
    assert [(r.idx, r.v) for r in out.orderBy("idx").collect()] == list(enumerate(want))
    assert "Window [row_number() windowspecdefinition(v" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert prefix.dense_index(df.where("v IS NULL"), "v").count() == 0


def test_prefix_max_matches_a_window(spark):
    from pyspark.sql import Window
    df = spark.range(900).select((F.col("id") * 7 - 400).alias("id"), F.pmod(F.hash("id"), F.lit(50)).cast("bigint").alias("x"))
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("m", F.coalesce(F.max("x").over(w), F.lit(-1)).cast("bigint"))
    for levels in (1, 2, 3):
        got = prefix.prefix_max(df, "id", [("x", "m")], -1, block_size=23, levels=levels)
        assert got.select("id", "x", "m").exceptAll(want).count() == 0


def _sequential_cards(ids, p, cap, stream="card"):
    cards, out = [], []
    for k in sorted(ids):
        mine = None
        if _u(stream + ":reuse", k) < p:
            mine = next((j for t in range(len(cards)) if cards[j := _place(len(cards), t, stream + ":pick", k)][1] < cap), None)
        if mine is None:
            cards.append([k, 0])
            mine = len(cards) - 1
        cards[mine][1] += 1
        out.append((k, cards[mine][0], mine, cards[mine][1], cards[mine][1] == 1))
    return out


@pytest.mark.parametrize("n,p,cap", [(2500, 0.4, 5), (120, 0.7, 5), (15, 1.0, 5), (40, 0.6, 1)])
def test_cards_as_dealt_one_by_one(spark, n, p, cap):
    ids = [3 * i - 70 for i in range(n)]
    rows = spark.createDataFrame([(i,) for i in ids] + [(None,)], "k long").repartition(3)
    got = [tuple(r) for r in keyed.pool_reuse(rows, "k", p_reuse=p, cap=cap).collect()]
    assert (None, None, None, None, None) in got
    assert sorted(r for r in got if r[0] is not None) == _sequential_cards(ids, p, cap)


def test_ranked_codes_are_unique_and_refuse_a_full_space(spark):
    rows = spark.range(2000).withColumn("g", F.when(F.col("id") % 10 < 8, "hot").otherwise("rare"))
    out = draws.ranked_codes(rows, "id", F.col("g"), 1600, "t", "code", block_size=100)
    assert out.count() == out.select("g", "code").distinct().count() == 2000
    with pytest.raises(Exception, match="more rows than codes"):
        draws.ranked_codes(rows, "id", F.col("g"), 1599, "t", "code").collect()


def test_draw_is_the_one_of_the_library(spark):
    assert spark.range(3).select(u("t", "id").alias("x")).orderBy("id").collect()[2].x == _u("t", 2)
