"""Token counts, centroid clustering and hard negatives against the tokenizer's library
and brute force."""

import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsmith.llm import centroids, negatives, queries, token_counts
from tests.conftest import SF_CHECK
from tests.oracle_check import compare, duck

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CLASH = ["n", "s", "c", "rank", "score", "place", "kth", "qb", "cb", "n_tokens", "cluster", "distance", "positive", "windows", "q"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def machine():
    return token_counts.Transducer(token_counts.read_pieces(MODEL))


def counts(machine, texts):
    import pyarrow as pa
    from tabsmith.llm.words import pieces
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    return [n for _, buf, offs in pieces(batch, "text") for n in machine.count(buf, offs).tolist()]


@pytest.mark.parametrize("source", ["awkward", "small_docs", "no_docs"])
def test_token_counts(request, library, source):
    docs = request.getfixturevalue(source)
    out = token_counts.count_tokens(docs, MODEL, limit=50)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in docs.select("doc_id", "text").collect())
    got = out.collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 50) for r in got)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("theinr ▁\n", max_size=200), st.text("ab", max_size=400)), max_size=5))
def test_any_text(library, machine, texts):
    assert counts(machine, texts) == [len(library.encode(t)) for t in texts]


def test_long_stretches_are_composed_of_blocks(library, machine):
    rnd = random.Random(5)
    texts = ["a" * 5001, "ab" * 3000 + "c", " " * 1000 + "x", "=" * 777, "".join(rnd.choice("aeinrst") for _ in range(9000)), "hello" * 999]
    assert counts(machine, texts) == [len(library.encode(t)) for t in texts]


def test_tables_compiled_anew_give_the_same(library, monkeypatch):
    monkeypatch.setattr(token_counts, "STATES", 500)
    monkeypatch.setattr(token_counts, "LANES", 300)
    rnd = random.Random(6)
    machine = token_counts.Transducer(token_counts.read_pieces(MODEL))
    for _ in range(3):
        texts = [" ".join("".join(rnd.choice("aeiounrstlm") for _ in range(rnd.randint(1, 9))) for _ in range(100)) + "e" * 200 for _ in range(10)]
        assert counts(machine, texts) == [len(library.encode(t)) for t in texts]
        assert len(machine.states) < 3000


# vectors

VEC = "vec_id long, embedding array<float>, label int"


def awkward_vectors(dims, n, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 0.2, (5, dims))
    rows = []
    for i in range(n):
        v = (centre[i % 5] + rng.normal(0, 0.08, dims)).astype(np.float32).tolist()
        rows.append((i, v, i % 4))
    rows[3] = (3, None, 1)
    rows[4] = (4, [None, *rows[4][1][1:]], 1)
    rows[5] = (5, [float("nan"), *rows[5][1][1:]], 1)
    rows[6] = (6, [float("inf"), *rows[6][1][1:]], 1)
    rows[8] = (8, rows[9][1], 0)                        # ties
    rows[10] = (10, rows[9][1], None)
    rows += [rows[20], rows[20], (0, rows[1][1], 2), (100, rows[2][1], 3), (None, rows[7][1], 1)]
    return rows


def usable(v, dims=None):
    return v is not None and (dims is None or len(v) == dims) and all(c is not None and math.isfinite(c) for c in v)


def frame(spark, rows):
    return spark.createDataFrame(rows, VEC).repartition(3).withColumns({c: F.lit("extra") for c in CLASH})


def brute_clusters(rows, k, rounds, dims):
    x = [(i, [math.floor(64 * c) for c in v]) for i, v, _ in rows if usable(v, dims)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in x if i is not None)[:k]
    c = [v for _, v in start]
    if not c:
        return []
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in x]
        for j in range(len(c)):
            own = [v for (_, v), a in zip(x, at) if a == j]
            if own:
                c[j] = [sum(col) // len(own) for col in zip(*own)]
    got = [(i, *nearest(v)) for i, v in x]
    return [(i, j, d, sum(e for _, e, f in got if f == j), sum(e for _, e, _ in got),
             hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in got]


@pytest.mark.parametrize("n,k", [(130, 16), (130, 3), (12, 16)])
def test_clusters(spark, n, k):
    rows = awkward_vectors(64, 130, 1)[-n:] + [(500, [0.5] * 63, 1), (501, [0.5] * 65, 1), (502, [], 1), (503, [-7.0] * 64, 1)]
    out = centroids.cluster(frame(spark, rows), k=k)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, brute_clusters(rows, k, 3, 64)))


def test_clusters_of_nothing(spark):
    assert centroids.cluster(spark.createDataFrame([], VEC)).count() == 0
    assert centroids.cluster(spark.createDataFrame([(None, [1.0] * 64, 1)], VEC)).count() == 0


def test_a_component_beyond_the_limit_is_an_error(spark):
    with pytest.raises(Exception, match="exceeds"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64, 1)], VEC)).count()
    with pytest.raises(Exception, match="too long"):
        negatives.hard_negatives(spark.createDataFrame([(100, [1e30] * 4, 1)], VEC)).count()


def test_the_search_rejects_and_stays_exact():
    rng = np.random.default_rng(2)
    c, x = rng.integers(-300, 300, (64, 16)) + rng.integers(-800, 800, (64, 1)), rng.integers(-300, 300, (3000, 16)) + rng.integers(-800, 800, (3000, 1))
    c[9] = c[3]
    at, dist, measured = centroids.Centroids(c).nearest(x)
    full = ((x[:, None] - c[None]) ** 2).sum(-1)
    assert (at == full.argmin(1)).all() and (dist == full.min(1)).all() and measured < 0.3 * full.size


def brute_negatives(rows, positives=5, wanted=10, every=100):
    x = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * c) for c in v]) for i, v, lab in rows if i is not None and lab is not None and usable(v)]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for a in sorted({i for i, _, _ in x if i % every == 0}):
        _, label, q = min(r for r in x if r[0] == a)
        score = [(-dot(q, v), i, lab) for i, lab, v in x if i != a]
        good = sorted(r for r in score if r[2] == label)[:positives]
        other = sorted((s, i) for s, i, lab in score + [(-dot(q, v), i, lab) for i, lab, v in x if i == a] if lab != label)
        for s, i, _ in good:
            inside = [(t, j) for t, j in other if 30 * -s <= 100 * -t <= 90 * -s][:wanted]
            out += [(a, i, r + 1, j, -s, -t) for r, (t, j) in enumerate(inside)]
    return out


@pytest.mark.parametrize("block", [16384, 40])
@pytest.mark.parametrize("dims", [6, 64])
def test_hard_negatives(spark, dims, block):
    rows = awkward_vectors(dims, 420, 3) + [(600, [0.1, 0.2], 1), (601, [], 2)]
    out = negatives.hard_negatives(frame(spark, rows), block=block, anchor_block=2)
    want = brute_negatives(rows)
    assert want and sorted(map(tuple, out.collect())) == sorted(want)


def test_hard_negatives_of_nothing(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], VEC)).count() == 0


def test_the_scan_drops_rows_before_reading_them_whole():
    rng = np.random.default_rng(4)
    x = (rng.normal(0, 3000, (4000, 64)) * 0.8 ** np.arange(64)).astype(np.int64)
    block = negatives.Columns(np.arange(4000), np.zeros(4000, np.int64), x)
    left = []
    q, floor = x[7], int(np.sort(x @ x[7])[-6])
    block.scan(q, np.ones(4000, bool), lambda low, high: (left.append(len(low)), high >= floor)[1])
    assert left[0] == 4000 and left[3] < 400 and left[-1] == 6


@pytest.mark.parametrize("key", ["op12_centroid_clustering", "op13_hard_negatives"])
def test_query_matches_its_sql(spark, key):
    ok, msg = compare(queries.QUERIES[key](spark, SF_CHECK), duck(SF_CHECK), queries.ORACLES[key])
    assert ok, msg
