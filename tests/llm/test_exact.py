"""Operators with exact contracts against brute force: sharding, Jaccard join, top-k,
substring removal, decontamination, language-model counts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabsmith.llm import common, decontaminate, language_model, neardup, sharding, substrings, topk
from tabsmith.llm.words import mix


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def words(text, lower=False):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", t)


@pytest.fixture(scope="module", params=["awkward", "small_docs", "no_docs"])
def docs(request):
    return request.getfixturevalue(request.param)


def test_sharding(docs):
    rows, out = rows_of(docs), sharding.assign_shards(docs, 24).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    by, groups = defaultdict(list), defaultdict(set)
    for r in out:
        by[r["shard"]].append(r)
        groups[(r["text_crc32"], r["size"])].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 24
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    assert all(len(s) == 1 for s in groups.values())


def test_sharding_is_near_equal_but_for_a_huge_group(spark):
    rows = [(i, "x" * 5000) for i in range(300)] + [(1000 + i, f"{i} " * (i % 40 + 5)) for i in range(3000)]
    out = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 24).collect()
    sums = Counter()
    for r in out:
        sums[r["shard"]] += r["size"]
    huge = next(r["shard"] for r in out if r["doc_id"] == 0)
    rest = [v for s, v in sums.items() if s != huge]
    assert sums[huge] == 300 * 5008 and len(rest) == 23 and max(rest) - min(rest) < 0.02 * max(rest)


def test_packing_into_fixed_capacity():
    rng = np.random.default_rng(1)
    sizes = sorted(Counter(rng.integers(1, 60, 500).tolist()).items(), reverse=True)
    runs = sharding.best_fit_decreasing(sizes, 100)
    load, packed = Counter(), Counter()
    for size, n, at in runs:
        load[at] += size * n
        packed[size] += n
    assert max(load.values()) <= 100 and packed == Counter(dict(sizes))
    # the same packing one item at a time
    left: list[int] = []
    for size, n in sizes:
        for _ in range(n):
            fit = [x for x in left if x >= size]
            if fit:
                left.remove(min(fit))
                left.append(min(fit) - size)
            else:
                left.append(100 - size)
    assert len(load) == len(left) and sorted(100 - x for x in left) == sorted(load.values())


def brute_components(rows, k, percent):
    sets = []
    for i, t in rows:
        w = words(t, True)
        sets.append((i, frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    named = [(i, s) for i, s in sets if i is not None and s]
    for x, (a, s) in enumerate(named):
        for b, t in named[:x]:
            n = len(s & t)
            if 100 * n >= percent * (len(s) + len(t) - n):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return Counter((i, len(s), find(i) if i is not None and s else i) for i, s in sets)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard_join(docs, k, percent):
    out = neardup.similar_documents(docs, k, percent).collect()
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out)
    assert got == brute_components(rows_of(docs), k, percent)


def test_jaccard_join_of_chained_near_copies(spark):
    rng = np.random.default_rng(4)
    base, rows = [f"v{x}" for x in rng.integers(0, 5000, 120)], []
    for i in range(150):                # each document differs from the one before in a word or two
        base = list(base)
        base[int(rng.integers(0, len(base)))] = f"n{i}"
        rows.append((i, " ".join(base)))
        rows.append((1000 + i, " ".join(rng.choice(base, 60))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.similar_documents(df, 3, 90).collect())
    assert got == brute_components(rows, 3, 90)


def test_bitmap_bound_never_refuses_a_link():
    rng = np.random.default_rng(2)
    for n in (5, 40, 700):
        x = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        y = np.concatenate([x[: int(n * 0.95)], rng.integers(0, 2 ** 63, max(1, n // 40)).astype(np.uint64)])
        sets = neardup.ShingleSets.__new__(neardup.ShingleSets)
        sets.g, sets.doc = np.concatenate([np.sort(x), np.sort(y)]), np.repeat([0, 1], [len(x), len(y)])
        sets.n = np.array([len(x), len(y)])
        sets.first = np.array([0, len(x), len(x) + len(y)])
        a, b = sets.bitmaps()
        size = min(len(a), len(b))
        differing = int(np.bitwise_count(neardup.folded(a, size) ^ neardup.folded(b, size)).sum())
        assert differing <= len(set(x.tolist()) ^ set(y.tolist()))


def brute_top(rows, k, every):
    vecs = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in vecs if i % every == 0}):
        qv = next(v for i, v in vecs if i == q)
        best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in vecs if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [8192, 7])
def test_top_k(spark, block):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(90)]
    rows += [(90 + i, rows[i % 5][1]) for i in range(30)]                 # ties
    rows += [(200, None), (220, [1.0, None] + [0.0] * 6), (240, [float("nan")] * 8), (260, [float("inf")] * 8), (None, [0.1] * 8), (280, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    stored = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = sorted(tuple(r) for r in topk.top_k(df, 20, 20, block=block, query_block=3).collect())
    assert got == brute_top(stored, 20, 20)
    few = df.where("vec_id < 4 OR vec_id = 20")
    assert sorted(tuple(r) for r in topk.top_k(few, 20, 20).collect()) == brute_top([r for r in stored if r[0] in (0, 1, 2, 3, 20)], 20, 20)
    assert topk.top_k(df.where("vec_id < 0"), 20, 20).collect() == []


@pytest.mark.parametrize("hot", [2000, 1])
def test_substring_removal(docs, hot):
    rows = rows_of(docs)
    size = 35
    texts = [words(t) for _, t in rows]
    starts = Counter(tuple(w[j:j + size]) for w in texts for j in range(len(w) - size + 1))
    want = Counter()
    for (i, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for j in range(len(w) - size + 1):
            if starts[tuple(w[j:j + size])] > 1:
                gone[j:j + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[(i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)] += 1
    out = substrings.remove_repeats(docs, size=size, hot=hot).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"], r["kept"]) for r in out) == want


def bench_rows():
    return [(1, " ".join(f"w{i}" for i in range(14))), (2, "One!"), (3, None), (4, ""), (5, "two words"), (None, "w7 w8 w9"), (2, "One!"),
            (11, " ".join(f"w{i}" for i in range(100, 112)))]


@pytest.mark.parametrize("block", [1 << 16, 3])
def test_decontamination(spark, awkward, small_docs, no_docs, block):
    bench = spark.createDataFrame(bench_rows(), "item_id long, text string")
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    pats = defaultdict(set)
    for i, t in bench_rows():
        w = norm(t)
        for j in range(max(1, len(w) - 9) if w else 0):
            pats[tuple(w[j:j + 10])].add(None if i is None else str(i))
    inserted = spark.createDataFrame([(900, "x y " + " ".join(f"W{i}" for i in range(13)) + " z w7, w8; w9"), (901, " ".join(f"w{i}" for i in range(9)))], "doc_id long, text string")
    for docs in (awkward, small_docs, no_docs, inserted):
        want = Counter()
        for i, t in rows_of(docs):
            w, hit, items = norm(t), set(), set()
            for m in {len(p) for p in pats}:
                for j in range(len(w) - m + 1):
                    if tuple(w[j:j + m]) in pats:
                        hit.update(range(j, j + m))
                        items |= pats[tuple(w[j:j + m])]
            ids = ",".join(sorted(x for x in items if x is not None))
            want[(i, len(w), len(hit), len(items), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))] += 1
        got = decontaminate.hit_report(docs, bench, block_patterns=block).collect()
        assert Counter(tuple(r) for r in got) == want
        clean = decontaminate.without_hits(docs, bench, block_patterns=block)
        assert clean.columns == docs.columns
        assert clean.count() == sum(n for k, n in want.items() if not k[-1])
    nothing = decontaminate.hit_report(awkward, bench.where("item_id = 3"))
    assert nothing.where("contaminated").count() == 0 and nothing.count() == awkward.count()


def test_language_model_counts(docs):
    rows = rows_of(docs)
    out = [r for r in language_model.score_texts(docs).collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c, ends = Counter(), 0
    for i, t in rows:
        if not held(i):
            c.update(words(t, True))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    base = lambda x: math.log10((x + 1) / (n + v + 1))
    want = Counter()
    for i, t in rows:
        w = words(t, True)
        want[(i, held(i), len(w) + 1, sum(c[x] > 0 for x in w) + (ends > 0), n, round(sum(base(c[x]) for x in w) + base(ends), 5))] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in out) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)


@pytest.mark.parametrize("hot", [1, 2000])
def test_segments_grow_in_proportion_to_repeated_rows(spark, monkeypatch, hot):
    """Equal rows stand for each other: 400 copies need no more segments than 200."""
    made, real = [], substrings.segments

    def counted(*args):
        out = real(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(substrings, "segments", counted)
    text = " ".join(f"w{i}" for i in range(60))
    for n in (200, 400):
        rows = [(None, text)] * n + [(1, "x " + text), (2, text)]
        out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), size=35, hot=hot).collect()
        assert sorted(r["n_removed"] for r in out) == [60] * (n + 2)
    assert made[0] == made[1] < 30


def test_a_pair_of_near_copies_comes_from_one_tile(spark):
    """60 classes in 20 common tiles, then two of them in a small tile of their own too."""
    rows = [(1000 * t + 7, c, c) for t in range(20) for c in range(60)] + [(5, 3, 3), (5, 61, 61)]
    tiles = spark.createDataFrame(rows, "tile long, cid long, comp long")
    maps = spark.createDataFrame([(c, 20, bytes(8)) for c in range(62)], "cid long, n long, bitmap binary")
    got = Counter((r["a"], r["b"]) for r in neardup.tile_pairs(neardup.first_tiles(tiles).join(maps, "cid"), 80).collect())
    assert got == Counter([(a, b) for b in range(60) for a in range(b)] + [(3, 61)])


def test_the_jaccard_join_takes_few_shuffles(spark, monkeypatch):
    """Near copies in a chain, the first and last far apart, so that both rounds find links."""
    shuffles, written = [], neardup.materialize

    def counted(df, name="stage"):
        shuffles.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return written(df, name)

    monkeypatch.setattr(neardup, "materialize", counted)
    monkeypatch.setattr(common, "materialize", counted)
    rng = np.random.default_rng(4)
    base, rows = [f"v{x}" for x in rng.integers(0, 5000, 120)], []
    for i in range(150):
        base = list(base)
        base[int(rng.integers(0, len(base)))] = f"n{i}"
        rows.append((i, " ".join(base)))
    out = neardup.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()) == brute_components(rows, 3, 90)
    assert len(shuffles) <= 14 and sum(shuffles) <= 40


def test_components_do_not_shuffle_the_edges_first(spark, monkeypatch):
    """Stars are done in one round, so one written stage."""
    written, real = [], common.materialize
    monkeypatch.setattr(common, "materialize", lambda df, name="stage": written.append(name) or real(df, name))
    edges = [(100 * s, 100 * s + i) for s in range(3) for i in range(1, 9)] + [(5000, 5000), (108, 100), (101, 100)]
    got = Counter(tuple(r) for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == Counter((100 * s + i, 100 * s) for s in range(3) for i in range(9)) and len(written) == 1


def test_a_tile_names_the_pivots_of_all_its_classes(spark):
    rng = random.Random(6)
    base = [f"p{i}" for i in range(200)]
    rows = [(i, " ".join(w if rng.random() < 0.99 else f"q{rng.random()}" for w in base)) for i in range(40)]
    tiles = neardup.shared_tiles(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 90).collect()
    members: dict = {}
    for r in tiles:
        members.setdefault(r["tile"], []).append(r["cid"])
    assert any(len(c) > 2 for c in members.values())
    place = lambda c, seed: int(mix(np.array([c]).view(np.uint64) ^ np.uint64(seed))[0])
    for r in tiles:
        assert [r[p] for p in neardup.PIVOTS] == [min(members[r["tile"]], key=lambda c: place(c, s)) for s in neardup.SEEDS]
