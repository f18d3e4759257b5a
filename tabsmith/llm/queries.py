"""One query per operator, with production parameters over its whole table."""

from __future__ import annotations

from tabsmith.llm import centroids, decontaminate, langid, language_model, mixing, neardup, negatives, pages, quality, sharding, substrings, token_counts, topk
from tabsmith.llm.registry import ORACLES, QUERIES, query
from tabsmith.sources.tables import read

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op1_sharding")
def op1(spark, sf):
    return sharding.assign_shards(read(spark, sf, "documents"), n_shards=24)


OP2_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda j: w[j] || ' ' || w[j + 1] || ' ' || w[j + 2])) END g FROM w),
x AS (SELECT doc_id, len(g) n, unnest(g) s FROM g),
o AS (SELECT a.doc_id a, b.doc_id b, any_value(a.n) na, any_value(b.n) nb, count(*) c
      FROM x a JOIN x b ON a.s = b.s AND a.doc_id < b.doc_id AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT a, b FROM o WHERE 100 * c >= 90 * (na + nb - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM g UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT g.doc_id, len(g)::BIGINT n_shingles, m.c component_id FROM g JOIN (SELECT doc_id, min(c) c FROM r GROUP BY doc_id) m USING (doc_id)
"""


@query("op2_ngram_jaccard", OP2_SQL)
def op2(spark, sf):
    return neardup.similar_documents(read(spark, sf, "documents"), shingle=3, percent=90).select("doc_id", "n_shingles", "component_id")


@query("op3_html_extraction")
def op3(spark, sf):
    return pages.extract_pages(read(spark, sf, "pages"))


@query("op4_quality")
def op4(spark, sf):
    return quality.grade_texts(read(spark, sf, "documents"), read(spark, sf, "labels"))


@query("op5_lm_scoring")
def op5(spark, sf):
    return language_model.score_texts(read(spark, sf, "documents"))


@query("op6_language_id")
def op6(spark, sf):
    return langid.identify(read(spark, sf, "documents"))


OP7_SQL = r"""
WITH u AS (SELECT doc_id, source, sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))::BIGINT n_tokens FROM documents GROUP BY ALL),
t AS (SELECT sum(n_tokens)::BIGINT total FROM u),
s AS (SELECT source, sum(n_tokens)::BIGINT tokens, sum(n_tokens)::DOUBLE / any_value(total) share FROM u, t WHERE n_tokens > 0 GROUP BY source),
g AS (SELECT k, round((ln(sum(p)) - sum(p * ln(p)) / sum(p)) / ln(count(*)), 9) entropy, round(max(p / tokens) / sum(p) * any_value(total), 9) repeats
      FROM (SELECT k, tokens, share ** (k / 4096.0) p FROM s, range(4097) r(k)), t GROUP BY k),
e AS (SELECT greatest((SELECT max(k) FROM g WHERE entropy >= 0.999), coalesce((SELECT min(k) FROM g WHERE repeats <= 4), 4096)) k),
y AS (SELECT source, tokens, CASE WHEN k = 4096 THEN tokens ELSE round(share ** (k / 4096.0) * 1e9) END::HUGEINT weight FROM s, e),
plan AS (SELECT source, tokens, (weight * total // (SELECT sum(weight) FROM y))::BIGINT target FROM y, t),
x AS (SELECT u.*, target // tokens full_passes, target % tokens rest,
             unnest(CASE WHEN n_tokens = 0 THEN [0] ELSE range(0, coalesce(target // tokens, 0) + 1) END)::INT pass
      FROM u LEFT JOIN plan p ON u.source IS NOT DISTINCT FROM p.source),
o AS (SELECT *, md5('7-block:' || pass || ':' || ('0x' || substr(md5('block:' || doc_id), 1, 2))::INT) block_place, md5('7:' || pass || ':' || doc_id) place FROM x),
w AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source, pass ORDER BY block_place, place, doc_id
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT "start" FROM o)
SELECT doc_id, source, n_tokens, pass, "start" FROM w WHERE n_tokens = 0 OR pass < full_passes OR "start" + n_tokens <= rest
"""


@query("op7_mixing", OP7_SQL)
def op7(spark, sf):
    """A target above the entropy that the sources have, so that exponents below 1 and
    second passes occur."""
    return mixing.draw_mix(read(spark, sf, "documents"), entropy=0.999, max_repeats=4.0)


OP8_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id query_id, c.vec_id vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op8_exact_topk", OP8_SQL)
def op8(spark, sf):
    return topk.top_k(read(spark, sf, "embeddings"), k=20, every=20)


OP9_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents),
g AS (SELECT doc_id, j, md5(array_to_string(list_slice(w, j, j + 34), ' ')) win
      FROM w, unnest(generate_series(1, len(w) - 34)) t(j)),
r AS (SELECT win FROM g GROUP BY win HAVING count(*) > 1),
gone AS (SELECT doc_id, list(DISTINCT j + k) pos FROM g JOIN r USING (win), unnest(range(35)) s(k) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT n_words, coalesce(len(pos), 0)::BIGINT n_removed,
       sha256(array_to_string(CASE WHEN pos IS NULL THEN w
                              ELSE list_filter(w, lambda x, i: NOT list_contains(pos, i)) END, ' ')) kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""


@query("op9_substring_dedup", OP9_SQL)
def op9(spark, sf):
    return substrings.remove_repeats(read(spark, sf, "documents"), size=35, keep_text=False)


OP10_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) m, list_slice(w, j, j + least(len(w), 10) - 1) win
      FROM b, unnest(generate_series(1, greatest(len(w) - 9, 1))) t(j) WHERE len(w) > 0),
dw AS (SELECT doc_id, m, j, list_slice(w, j, j + m - 1) win
       FROM d, (SELECT DISTINCT m FROM p) ms, unnest(generate_series(1, len(w) - m + 1)) t(j)),
h AS (SELECT doc_id, j, m, item_id FROM dw JOIN p USING (m, win)),
n AS (SELECT doc_id, count(DISTINCT j + k) n_hit FROM h, unnest(range(m)) s(k) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) ids FROM h GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT n_words, coalesce(n_hit, 0)::BIGINT n_hit, coalesce(n_items, 0)::BIGINT n_items,
       sha256(coalesce(ids, '')) items_sha256, n_hit IS NOT NULL contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""


@query("op10_decontamination", OP10_SQL)
def op10(spark, sf):
    return decontaminate.hit_report(read(spark, sf, "documents"), read(spark, sf, "benchmark"), n=10)


@query("op11_token_counts")
def op11(spark, sf):
    import public_tokenizers

    return token_counts.count_tokens(read(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op12_sql(rounds: int = 3, k: int = 16) -> str:
    """The rounds unrolled: r0 holds the first centroids, a<i> the assignments to r<i>."""
    dist = "list_sum(list_transform(list_zip(v, cv), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    out = f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, v FROM (
    SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)::BIGINT) v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)),
r0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v cv FROM (
  SELECT v, sha256('1:' || vec_id) h FROM x WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k}))"""
    for i in range(rounds + 1):
        out += f""",
a{i} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, c := c)) b FROM (SELECT r, c, {dist} d FROM x, r{i}) GROUP BY r)"""
        if i < rounds:
            out += f""",
r{i + 1} AS MATERIALIZED (SELECT c, coalesce(m, cv) cv FROM r{i} LEFT JOIN (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) m FROM (
    SELECT b.c c, j, sum(v[j])::BIGINT s, count(*) n FROM a{i} JOIN x USING (r), range(1, 65) t(j) GROUP BY ALL) GROUP BY c) USING (c))"""
    return out + f"""
SELECT vec_id, b.c::INT AS cluster, b.d AS distance, sum(b.d) OVER (PARTITION BY b.c)::BIGINT cluster_inertia, sum(b.d) OVER ()::BIGINT inertia,
       sha256(array_to_string(cv, ',')) centroid_sha256
FROM a{rounds} JOIN x USING (r) JOIN r{rounds} ON r{rounds}.c = b.c
"""


@query("op12_centroid_clustering", op12_sql())
def op12(spark, sf):
    return centroids.cluster(read(spark, sf, "embeddings"), k=16, rounds=3, seed=1, dims=64, scale=64)


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id anchor_id, c.vec_id vec_id, a.label = c.label same, list_dot_product(a.v::DOUBLE[], c.v::DOUBLE[])::BIGINT score
      FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
p AS (SELECT anchor_id, vec_id positive_id, score positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, vec_id negative_id, score negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark, sf):
    return negatives.hard_negatives(read(spark, sf, "embeddings"))


__all__ = ["QUERIES", "ORACLES"]
