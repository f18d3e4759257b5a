"""Terms and words that contain each other, against a plain double loop."""

import random

from pyspark.sql import functions as F

from tabsmith.operators import derive, profile


def test_pairs_equal_a_double_loop_without_a_nested_loop(spark):
    rnd = random.Random(4)
    make = lambda lo, hi: "".join(rnd.choice("abé") for _ in range(rnd.randint(lo, hi)))
    terms = {make(1, 9) for _ in range(150)} | {make(600, 900) for _ in range(4)} | {"", "b" * 255 + "a" + "b" * 300}
    words = {make(2, 6) for _ in range(60)} | {make(255, 262) for _ in range(3)} | {"a" + "b" * 258, ""}
    words |= {max(terms, key=len)[250:262]}
    t = spark.createDataFrame([(x,) for x in sorted(terms)] * 2, "term string")
    w = spark.createDataFrame([(x,) for x in sorted(words)] * 2, "word string")
    out = derive.term_matches(t, w)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = sorted(map(tuple, out.collect()))
    assert got == sorted((a, b) for a in terms for b in words if a and b and (a in b or b in a))


def test_no_terms_or_no_words(spark):
    none, some = spark.createDataFrame([], "term string"), spark.createDataFrame([("x",)], "word string")
    assert derive.term_matches(none, some).count() == 0
    assert derive.term_matches(some.withColumnRenamed("word", "term"), none.withColumnRenamed("term", "word")).count() == 0
    docs = spark.createDataFrame([(1, "abc xyz"), (2, None), (3, "")], "id long, text string")
    terms = derive.row_terms(docs, "id", "text")
    words = spark.createDataFrame([("s", "B"), ("s", "bc"), ("r", "xyzz"), ("q", "none")], "spec string, word string")
    scores = derive.specialist_scores(terms, "id", words, "spec").orderBy("id", "spec").collect()
    assert [tuple(r) for r in scores] == [(1, "r", 1), (1, "s", 1)]


def test_best_specialists_are_counted_in_one_row_per_key(spark, monkeypatch):
    monkeypatch.setattr(derive, "SCORE_CELLS", 8)               # several pieces a batch
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("abc") for _ in range(rnd.randint(2, 5))) for _ in range(40)]
    rows = [(rnd.choice([None, *range(60)]), t) for t in vocabulary for _ in range(9)] + [(99, "zzz"), (98, None)]
    words = [(f"s{i:02}", w) for i in range(23) for w in rnd.sample(vocabulary, 2)] + [("s01", None), (None, "ab"), ("t", "ab")]
    t, w = spark.createDataFrame(rows, "id long, term string"), spark.createDataFrame(words, "spec string, word string")
    want = {}
    for key, term in rows:
        for s in {s for s, x in words if s and x and term and (x in term or term in x)}:
            want[key, s] = want.get((key, s), 0) + 1
    long = derive.specialist_scores(t, "id", w, "spec")
    assert sorted(map(repr, map(tuple, long.collect()))) == sorted(repr((k, s, n)) for (k, s), n in want.items())
    best = derive.best_specialists(t, "id", w, "spec")
    top = {}
    for (k, s), n in sorted(want.items(), key=lambda x: x[0][1]):
        top.setdefault(k, {}).setdefault(n, []).append(s)
    top = {k: (max(x), x[max(x)]) for k, x in top.items()}
    assert {r["id"]: (r["score"], r["spec"]) for r in best.collect()} == top
    # a row per (key, specialist) is neither made nor windowed
    match = profile.best_match(best, "id", "spec")
    plan = match._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan
    assert sorted(map(repr, map(tuple, match.collect()))) == sorted(map(repr, map(tuple, profile.best_match(long, "id", "spec").collect())))
