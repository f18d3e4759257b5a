"""Temperature mixing of sources, realised as budgeted block permutations.

The share of a source in the mix is its token share to the power ``exponent``,
normalised. The exponent is bisected on a grid in [0, 1]: the largest one whose mix has
at least the wanted entropy (as a fraction of the entropy of equal shares), but not so
small that a source would be repeated more often than ``max_repeats``.

Each source then runs through its documents in passes. A pass is a permutation of the
source's blocks (documents by hash of doc_id) and of the documents in each block, seeded
by the pass; the last pass stops at the source's budget. Running token counts are sums
over blocks plus a window inside one block, so a source with a third of all rows is
numbered by many tasks. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import pick
from tabsmith.session import materialize

GRID = 4096             # exponents k / GRID
BLOCKS = 256            # blocks of a source
WEIGHTS = 1e9           # weights of sources are whole numbers of 1 / WEIGHTS


def n_tokens(text: Column) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+; null has none."""
    return F.coalesce(F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")), F.lit(0)).cast("bigint")


def mix_measures(sources: DataFrame, exponent: float, budget: float) -> tuple[float, float]:
    """(entropy of the mix as a fraction of that of equal shares, most repeats)."""
    p = F.col("share") ** F.lit(float(exponent))
    r = sources.agg(F.sum(p).alias("z"), F.sum(p * F.log(p)).alias("plogp"), F.max(p / F.col("tokens")).alias("m"), F.count(F.lit(1)).alias("n")).first()
    entropy = math.log(r["z"]) - r["plogp"] / r["z"]
    # rounded: the order of a sum must not decide a comparison
    return (round(entropy / math.log(r["n"]), 9) if r["n"] > 1 else 1.0), round(r["m"] / r["z"] * budget, 9)


def choose_exponent(sources: DataFrame, entropy: float, max_repeats: float, budget: float) -> float:
    """Bisect the exponent: entropy falls and the repeats fall as it grows."""
    def largest(ok) -> int:
        low, high = 0, GRID + 1             # ok(low) holds or low is 0
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if ok(mid) else (low, mid)
        return low

    by_entropy = largest(lambda k: mix_measures(sources, k / GRID, budget)[0] >= entropy)
    if mix_measures(sources, by_entropy / GRID, budget)[1] <= max_repeats:
        return by_entropy / GRID
    too_often = largest(lambda k: mix_measures(sources, k / GRID, budget)[1] > max_repeats)
    return min(GRID, too_often + 1) / GRID


def draw_mix(docs: DataFrame, entropy: float = 0.95, max_repeats: float = 4.0, budget: int | None = None, seed: int = 7,
             id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix: one row per use of a document: doc_id, source, n_tokens, pass (from 0),
    start (tokens of its source's pass before it).

    ``budget`` is the number of tokens of the mix (default: those of the input); a source
    ends at the last document that fits its share of it. Rows with one doc_id and source
    are one unit. A null source is a source like others; a null doc_id is one unit per
    source. Units without tokens cost nothing and are used once. Ties in a permutation
    fall to the smaller doc_id. An empty table gives an empty mix."""
    units = (pick(docs, doc_id=id_col, source=source_col, text=text_col)
             .select("doc_id", "source", n_tokens(F.col("text")).alias("n_tokens"))
             .groupBy("doc_id", "source").agg(F.sum("n_tokens").alias("n_tokens")))
    units = materialize(units, "units")
    sources = units.where("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    sources = materialize(sources.withColumn("share", F.col("tokens") / F.lit(float(max(1, total)))), "sources")
    whole = budget or total
    exponent = choose_exponent(sources, entropy, max_repeats, whole) if total else 1.0
    # budgets in whole numbers: weights on a fixed grid, so that no sum of floats and no
    # order of tasks moves a token; at exponent 1 the weights are the tokens themselves
    weight = F.col("tokens") if exponent == 1.0 else F.round((F.col("share") ** F.lit(exponent)) * F.lit(WEIGHTS), 0)
    sources = sources.withColumn("weight", weight.cast("decimal(19,0)"))
    z = int(sources.agg(F.sum("weight")).first()[0] or 1)
    target = F.expr(f"CAST(weight * CAST({whole} AS DECIMAL(18,0)) div CAST({z} AS DECIMAL(20,0)) AS BIGINT)")
    sources = sources.withColumn("target", target)
    plan = sources.select("source", F.expr("CAST(target div tokens AS INT)").alias("full"), F.expr("target % tokens").alias("rest"))

    id_text, src = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("u.source")
    uses = units.alias("u").join(plan.alias("p"), src.eqNullSafe(F.col("p.source")), "left").select(
        "u.doc_id", "u.source", "u.n_tokens", F.col("full"), F.col("rest"))
    zero = F.col("n_tokens") == 0
    uses = uses.withColumn("pass", F.explode(F.when(zero, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.coalesce("full", F.lit(0))))))
    uses = (uses.withColumn("block", F.conv(F.substring(F.md5(F.concat(F.lit("block:"), id_text)), 1, 2), 16, 10).cast("int"))
            .withColumn("place", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("pass").cast("string"), id_text))))
    uses = materialize(uses, "uses")
    block_place = F.md5(F.concat_ws(":", F.lit(f"{seed}-block"), F.col("pass").cast("string"), F.col("block").cast("string")))
    w_blocks = Window.partitionBy("source", "pass").orderBy(block_place).rowsBetween(Window.unboundedPreceding, -1)
    before = (uses.groupBy("source", "pass", "block").agg(F.sum("n_tokens").alias("t"))
              .select("source", "pass", "block", F.coalesce(F.sum("t").over(w_blocks), F.lit(0)).alias("before")))
    w_in = Window.partitionBy("source", "pass", "block").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    u, b = uses.withColumn("inside", F.coalesce(F.sum("n_tokens").over(w_in), F.lit(0))).alias("u"), before.alias("b")
    placed = u.join(b, F.col("u.source").eqNullSafe(F.col("b.source")) & (F.col("u.pass") == F.col("b.pass")) & (F.col("u.block") == F.col("b.block")))
    start = F.col("before") + F.col("inside")
    fits = zero | (F.col("u.pass") < F.col("full")) | (start + F.col("n_tokens") <= F.col("rest"))
    return placed.where(fits).select("u.doc_id", "u.source", "n_tokens", F.col("u.pass").alias("pass"), start.alias("start"))


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs``, each as often as the mix uses its document; all columns.

    Rows with one doc_id and source go together; null ids and sources are matched as in
    ``draw_mix``; texts without words are kept once; an empty table stays empty."""
    uses = draw_mix(docs, **kw).groupBy("doc_id", "source").agg(F.count(F.lit(1)).cast("int").alias("uses"))
    uses = uses.select(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("uses").alias("_mix_uses"))
    id_col, source_col = kw.get("id_col", "doc_id"), kw.get("source_col", "source")
    drawn = docs.join(uses, docs[id_col].eqNullSafe(uses["_mix_id"]) & docs[source_col].eqNullSafe(uses["_mix_source"]))
    cols = [docs[c] for c in docs.columns]
    return drawn.select(*cols, F.explode(F.sequence(F.lit(1), F.col("_mix_uses"))).alias("_mix_use")).drop("_mix_use")
