"""Page extraction, trained models, mixing and the pipeline."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.llm import decontaminate, langid, language_model, mixing, pages, quality, sharding
from tests.conftest import SF_CHECK
from tabsmith.llm.common import components
from tabsmith.llm.queries import ORACLES, QUERIES
from tabsmith.session import materialize
from tests.llm.conftest import SF
from tests.llm.test_exact import brute_components
from tests.oracle_check import compare, duck

PAGES = {
    "<html><body><nav><a href='/'>Home</a></nav><article><h1>A &amp; B</h1><p>One,\n two.<br><p>Three&nbsp;four<div class='ad'>Buy</div></article></body></html>":
        "A & B\nOne, two.\nThree four",
    "<body><header><h1>Site</h1></header><main><p>Long text of the story, with words.</p><ul><li>First point.</li><li>Second point.</li></ul>"
    "<section id=comments><p>Nice!</p></section></main><aside>More</aside><footer>&copy; x</footer></body>":
        "Long text of the story, with words.\nFirst point.\nSecond point.",
    "<div class=cookie-notice>We use cookies.</div><div class='post-content'><p>Alpha beta gamma delta, epsilon.</p><p>Zeta.</p></div><form><p>Mail</p></form>":
        "Alpha beta gamma delta, epsilon.\nZeta.",
    "<script>var a='<p>no</p>'</script><style>p{}</style><p>only</p><!-- <p>gone</p> -->": "only",
    "<article><h2><a href='/x'>Linked title</a></h2><p>Words of the story.</p><ul><li><a>Other</a></li><li><a>Pages</a></li></ul></article>":
        "Linked title\nWords of the story.",
    "plain text": "plain text",
    "<p>a<p>b &#233; &lt;c&gt;": "a\nb é <c>",
    "": "", None: "", "<html><body></body></html>": "", "<p>unclosed <b>bold <a href=": "unclosed bold <a href=",
}


def test_pages(spark):
    rows = [(i, f"u{i}", h) for i, h in enumerate(PAGES)] + [(None, None, "<p>x</p>"), (0, "u0", "<p>y</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("extra")).withColumn("n_chars", F.lit(0))
    got = Counter(tuple(r) for r in pages.extract_pages(df).collect())
    want = Counter((i, f"u{i}", t, len(t)) for i, t in enumerate(PAGES.values())) + Counter([(None, None, "x", 1), (0, "u0", "y", 1)])
    assert got == want
    assert pages.extract_pages(df.where("page_id < -1")).count() == 0


def test_very_long_page_is_whole():
    body = "".join(f"<p>Sentence {i}, with words.</p>" for i in range(20000))
    assert pages.main_text(f"<nav><a>x</a></nav><article>{body}</article>").count("\n") == 19999


LONG = "".join(f"<p>Paragraph {i} of the story, with many words in it, and some more of them, so that it is long.</p>" * 3 for i in range(6))


@pytest.mark.parametrize("before,inner", [
    ("<h1>Title</h1><p class=lead>Lead.</p>", f"<div class=content>{LONG}</div>"),
    ("<section class=intro><h2>Title</h2><p>Lead.</p></section>", f"<section class=rest>{LONG}</section>"),
    ("<h1>Title</h1><p>Lead.</p>", "<ul>" + LONG.replace("<p>", "<li>").replace("</p>", "</li>") + "</ul>"),
    ("<h1>Title</h1><p>Lead.</p>", "<table>" + LONG.replace("<p>", "<tr><td>").replace("</p>", "</td></tr>") + "</table>"),
])
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<body><div id=x>{}</div></body>", "<body><main>{}</main></body>"])
def test_title_and_lead_beside_the_long_container_stay(before, inner, wrap):
    got = pages.main_text(wrap.format(before + inner)).split("\n")
    assert got[:2] == ["Title", "Lead."] and len(got) == 20


def test_short_article_beside_a_long_one_stays():
    got = pages.main_text(f"<div>Site</div><article><p>Short one.</p></article><article>{LONG}</article>").split("\n")
    assert got[0] == "Short one." and len(got) == 19


@pytest.mark.parametrize("tag", ["div class='content has-sidebar'", "div class='overflow-hidden'", "div class='with-comments'", "div class='md:hidden no-nav'",
                                 "div class='sidebar'", "div id=popup", "form action='/x.aspx' method=post", "section title=\"the hidden truth\"",
                                 "section data-x='class=ad' title='id=menu'"])
@pytest.mark.parametrize("outer", ["<body>{}</body>", "<body><form id=aspnet>{}</form></body>", "<body><div class='page has-nav'>{}</div></body>"])
def test_one_name_does_not_empty_a_page(tag, outer):
    end = tag.split()[0]
    inside = f"<h1>Title</h1><p title=\"the hidden truth\">Lead.</p>{LONG}<div class='comments'><p>Nice.</p></div><p hidden>Gone.</p>"
    page = outer.format(f"<nav>Menu</nav><div class=cookie-notice>We use cookies.</div><{tag}>{inside}</{end}><footer>End</footer>")
    assert pages.main_text(page).split("\n") == ["Title", "Lead."] + pages.main_text(LONG).split("\n")


def test_names_count_beside_an_article():
    comments = "".join(f"<p>Comment {i}.</p>" for i in range(20))
    assert pages.main_text(f"<article><header class=entry-header><h1>T</h1></header>{LONG}</article><div class=article-comments>{comments}</div>"
                           "<form><p>Mail us.</p></form><div class='x hidden'>Not shown.</div>") == "T\n" + pages.main_text(LONG)


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id]).all()
    held = out[out.held_out & out.lang.notna()]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert out.score.between(0, 1).all()


def test_language_id_of_awkward_rows(awkward, no_docs):
    out = langid.identify(awkward).collect()
    assert len(out) == awkward.count()
    text = Counter((r["doc_id"], r["text"]) for r in awkward.collect())
    und = sum(n for (_, t), n in text.items() if not any(c.isalpha() for c in t or ""))
    assert sum(r["lang_pred"] == "und" for r in out) == und
    assert {r["lang_pred"] for r in out} <= {"en", "fr", "und"}
    assert langid.identify(no_docs).count() == 0
    unlabelled = awkward.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(unlabelled).collect()} == {"und"}


def test_unlabelled_texts_with_a_letter_stay(spark):
    docs = spark.createDataFrame([(1, "Some text.", None), (2, "12 !?", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in langid.in_known_language(docs, langid.trained(docs)).collect()] == [1]


def test_gru_gradients_match_differences():
    m = langid.ByteLabeller(["a", "b"], seed=1)
    x, y = np.random.default_rng(0).integers(0, 256, (6, 3)).astype(np.uint8), np.array([0, 1, 1])
    for g in (m.ahead, m.behind):
        g.params = {k: v.astype(np.float64) for k, v in g.params.items()}

    def loss():
        s = list(m.ahead.run(x))
        p = np.stack([m.softmax(m.out["v"][:, :langid.HIDDEN].astype(float) @ h) for h in s])
        return -np.log(p[:, y, np.arange(3)]).mean()

    tape: list = []
    states = np.stack(list(m.ahead.run(x, tape)))
    v = m.out["v"][:, :langid.HIDDEN].astype(float)
    p = np.stack([m.softmax(v @ h) for h in states])
    p[:, y, np.arange(3)] -= 1
    grad = m.ahead.back(tape, list(v.T @ (p / (6 * 3))))
    for name, at in (("u", (3, 2)), ("u", (20, 1)), ("b", (2, 0)), ("wx", (5, int(x[0, 0]))), ("wx", (17, int(x[2, 1])))):
        old = m.ahead.params[name][at]
        m.ahead.params[name][at] = old + 1e-3
        up = loss()
        m.ahead.params[name][at] = old - 1e-3
        down = loss()
        m.ahead.params[name][at] = old
        assert abs((up - down) / 2e-3 - grad[name][at]) < 1e-3 + 0.05 * abs(grad[name][at])


def test_language_model_beats_base_on_held_out_texts(spark):
    out = language_model.score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").toPandas()
    assert out.score.sum() > out.base_score.sum()
    assert np.allclose(out.perplexity, 10 ** (-out.score / out.n_tokens))


@pytest.mark.parametrize("most", [language_model.LOOKUP, 9000, 0])
def test_words_past_the_frequent_ones_have_classes_of_their_own(spark, most):
    rng = np.random.default_rng(1)
    rare = [[f"{k}{zlib.crc32(f'{k}{i}'.encode()):x}" for i in range(400)] for k in "ab"]
    texts = [" ".join(f"f{j}" for j in rng.permutation(8800)) for _ in range(6)]        # fill the frequent ranks
    texts += [f"{x} {w} {y}" for words, x, y in ((rare[0], "x", "xx"), (rare[1], "y", "yy")) for w in words for _ in range(4)]
    asked = [(x, w, y) for i in range(400) for w in (rare[0][i], rare[1][i]) for x, y in (("x", "xx"), ("y", "yy"))]
    free = [i for i in range(100000) if zlib.crc32(str(i).encode()) % 7 == 2][: len(asked)]                 # held out: not learned from
    learn = [i for i in range(100000, 200000) if zlib.crc32(str(i).encode()) % 7 != 2][: len(texts)]
    rows = list(zip(learn, texts)) + [(i, " ".join(a)) for i, a in zip(free, asked)]
    got = {r["doc_id"]: r["score"] for r in language_model.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), most=most).collect()}
    score = {a: got[i] for i, a in zip(free, asked)}
    right = [score[x, w, y] > score[u, w, v] for words, (x, y), (u, v) in ((rare[0], ("x", "xx"), ("y", "yy")), (rare[1], ("y", "yy"), ("x", "xx"))) for w in words]
    assert np.mean(right) > 0.99


def test_quality_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = quality.grade_texts(docs, labels).join(quality.graded(labels), "doc_id").where("held_out").toPandas()
    toxic = out.grade == 0
    assert (~out.keep[~toxic]).mean() < 0.02                    # clean documents stay
    assert out.p_not_toxic[~toxic].mean() - out.p_not_toxic[toxic].mean() > 0.3
    assert ((out.p_good >= 0.5) == (out.grade == 2)).mean() > 0.9
    assert (out.p_good <= out.p_not_toxic + 1e-12).all()
    assert np.allclose(out.expected_grade, out.p_good + out.p_not_toxic)


def test_quality_catches_planted_words(spark):
    rng = np.random.default_rng(0)
    vocabulary = [f"v{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        w = list(rng.choice(vocabulary, int(rng.integers(20, 200))))
        bad = i % 6 == 0
        if bad:
            w[3] = "vile"
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = quality.grade_texts(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).where("held_out").toPandas()
    assert (out.keep == (out.doc_id % 6 != 0)).mean() > 0.97


def test_quality_learns_words_of_few_texts_from_a_large_sample():
    rng = np.random.default_rng(2)
    n, vocabulary = 12000, [f"v{i:04d}" for i in range(2000)]          # all words of one shape
    texts = [" ".join(rng.choice(vocabulary, 30)) for _ in range(n)]
    y = np.arange(n) % 3
    for k, i in enumerate(np.flatnonzero(y == 0)):
        texts[i] += f" x{k // 40:04d}"                       # each in 40 toxic texts and in no other
    for i in np.flatnonzero(y == 2):
        texts[i] += " f0000"

    def features(texts):
        raw = [t.encode() for t in texts]
        return quality.Features(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])]))

    f = features(texts)
    model = quality.OrdinalModel(3).fit(f.idx, f.first, y, np.ones(n))
    plain = texts[1::3][:200]
    assert (model.tails(features([f"{t} x{k % 100:04d}" for k, t in enumerate(plain)]))[:, 0] < 0.65).mean() > 0.97
    assert (model.tails(features(plain))[:, 0] >= 0.65).mean() > 0.97


def test_quality_of_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 1), (3, 1, 0), (5, None, 1), (None, 1, 0), (77777, 1, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in quality.graded(labels).collect()} == {(0, 2), (3, 0), (77777, 0), (9, 1)}
    for lab in (labels, labels.where("doc_id < 0")):
        out = quality.grade_texts(awkward, lab).collect()
        assert len(out) == awkward.count() and all(0 <= r["expected_grade"] <= 2 for r in out)
    assert quality.grade_texts(no_docs, labels).count() == 0


def test_components_say_when_rounds_are_not_enough(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(path, max_rounds=1)
    assert {r["comp"] for r in components(path).collect()} == {0}


def mix_input(spark):
    rows = [(i, "hot" if i < 400 else f"s{i % 6}", " ".join(["t"] * (1 + i % 17))) for i in range(700)]
    return spark.createDataFrame(rows + [(900, None, "a b c"), (901, "void", ""), (902, "hot", None)], "doc_id long, source string, text string")


@pytest.mark.parametrize("entropy,repeats", [(0.99, 4.0), (0.99, 1.2), (0.1, 4.0)])
def test_mixing_equals_brute_force(spark, entropy, repeats):
    docs = mix_input(spark)
    sizes = {(r["doc_id"], r["source"]): len((r["text"] or "").split()) for r in docs.collect()}
    tokens: Counter = Counter()
    for (_, s), n in sizes.items():
        tokens[s] += n
    tokens = Counter({s: n for s, n in tokens.items() if n})
    total = sum(tokens.values())
    measure = lambda k: [(t / total) ** (k / 4096) for t in tokens.values()]
    ent = lambda p: (math.log(sum(p)) - sum(x * math.log(x) for x in p) / sum(p)) / math.log(len(p))
    rep = lambda p: max(x / t for x, t in zip(p, tokens.values())) / sum(p) * total
    k = max((k for k in range(4097) if ent(measure(k)) >= entropy), default=0)
    if rep(measure(k)) > repeats:
        k = min((k for k in range(4097) if rep(measure(k)) <= repeats), default=4096)
    p = dict(zip(tokens, measure(k)))
    got = mixing.draw_mix(docs, entropy, repeats).collect()
    used, by_pass = Counter(), defaultdict(list)
    for r in got:
        used[r["source"]] += r["n_tokens"]
        by_pass[(r["source"], r["pass"])].append(r)
        assert sizes[(r["doc_id"], r["source"])] == r["n_tokens"]
    for s, t in tokens.items():
        weight = {x: tokens[x] if k == 4096 else math.floor(y * 1e9 + 0.5) for x, y in p.items()}
        target = weight[s] * total // sum(weight.values())
        assert target - 17 < used[s] <= target
        assert target / t <= repeats + 1e-6 or k == 4096
        for n in range(target // t):
            assert sum(r["n_tokens"] for r in by_pass[(s, n)]) == t                      # whole passes
    for rows in by_pass.values():                                                        # starts are running sums
        at = 0
        for r in sorted((r for r in rows if r["n_tokens"]), key=lambda r: r["start"]):      # rows without tokens take no place
            assert r["start"] == at
            at += r["n_tokens"]
    assert {r["doc_id"] for r in got} >= {901, 902}


@pytest.mark.parametrize("parts", [1, 8, 200])
def test_mixing_at_exponent_one_returns_every_document(spark, parts):
    docs = mix_input(spark).repartition(parts)
    assert mixing.mixed_documents(docs, entropy=0.1).exceptAll(docs).count() == 0
    assert mixing.mixed_documents(docs, entropy=0.1).count() == docs.count()


def test_mixing_query_repeats_documents(spark):
    got = QUERIES["op7_mixing"](spark, SF_CHECK)
    assert got.where("pass > 0").count() > 0
    ok, msg = compare(got, duck(SF_CHECK), ORACLES["op7_mixing"])
    assert ok, msg


def test_mixing_of_awkward_rows(awkward, no_docs):
    out = mixing.mixed_documents(awkward)
    assert out.columns == awkward.columns
    assert out.count() > 0
    assert mixing.draw_mix(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).columns == no_docs.columns


def test_sharded_documents_keep_columns(awkward):
    out = sharding.sharded_documents(awkward)
    assert out.columns == [*awkward.columns, "_shard"] and out.count() == awkward.count()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, key):
    ok, msg = compare(QUERIES[key](spark, SF), duck(SF), ORACLES[key])
    assert ok, f"{key}: {msg}"


def test_one_query_per_operator():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 11)}


def test_pipeline(spark):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["language_id", "ngram_jaccard", "decontamination", "mixing", "sharding"] and cp.ORACLE_SQL is None
    docs, tables = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        tables[name] = docs = materialize(stage(spark, docs, SF), name)
        if name != "sharding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {name: Counter(r["doc_id"] for r in t.select("doc_id").collect()) for name, t in tables.items()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(ids["language_id"]) == {i for i, t in text.items() if any(c.isalpha() for c in t or "")}
    left = [(i, text[i]) for i in ids["language_id"]]
    assert ids["ngram_jaccard"] == Counter(i for i, _, c in brute_components(left, 5, 80) if i == c)
    hits = {r["doc_id"] for r in decontaminate.hit_report(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
    assert set(ids["decontamination"]) == set(ids["ngram_jaccard"]) - hits
    assert set(ids["mixing"]) <= set(ids["decontamination"]) and max(ids["mixing"].values()) <= 5
    assert ids["sharding"] == ids["mixing"]
    assert cp.run(spark, SF).count() == sum(ids["sharding"].values())


def test_pipeline_of_awkward_and_empty_tables(spark, awkward, no_docs):
    import corpus_pipeline as cp

    for docs in (awkward, no_docs):
        cols = docs.columns
        for name, stage in cp.STAGES[:-1]:
            docs = materialize(stage(spark, docs, SF), name)
            assert docs.columns == cols
        out = cp.STAGES[-1][1](spark, docs, SF)
        assert out.columns[:-1] == cols and out.count() == docs.count()
