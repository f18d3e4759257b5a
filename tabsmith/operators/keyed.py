"""Keyed constraints K-1..K-6.

The reference keeps these as mutable hash maps updated record by record. Here each
is a set-based job over the whole table:

* first-wins per key: ``min_by`` aggregation (partial aggregation, so a hot key is
  combined map-side) joined back;
* n-th use per key: ``keyed_row_number`` (per key and block, no single-task key);
* sequential pools (clients, cards): two-phase prefix sums over the row order
  (``prefix_sum``), with the pick among earlier entries drawn from the count of
  entries created before the row; cards with a limited number of uses are dealt by
  deferred acceptance.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.draws import shuffled, u
from tabsmith.operators.prefix import DEFAULT_BLOCK, keyed_row_number, levels_for, prefix_max, prefix_sum
from tabsmith.session import materialize
from tabsmith.sources import fixed


def first_wins(df: DataFrame, key_cols: Sequence[str], value_col: str, order_cols: Sequence[str],
               out_col: str) -> DataFrame:
    """K-1: per key the value of the first row in ``order_cols`` order (one row per key)."""
    ordering = F.struct(*[F.col(c) for c in order_cols])
    return df.groupBy(*key_cols).agg(F.min_by(F.col(value_col), ordering).alias(out_col))


def apply_first_wins(df: DataFrame, key_cols: Sequence[str], value_col: str, order_cols: Sequence[str],
                     out_col: str) -> DataFrame:
    """K-1/K-2 joined back: every row gets its key's first value (a pair lookup when
    ``key_cols`` has two columns). A row whose key has a null part has no entry: it stays,
    with null. Such rows don't go through the join, where they would meet in one task."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key_cols])
    keyed_rows = df.where(whole)
    fw = first_wins(keyed_rows, key_cols, value_col, order_cols, out_col)
    kind = fw.schema[out_col].dataType
    out = keyed_rows.join(fw, list(key_cols), "left").select(*df.columns, out_col)
    return out.unionByName(df.where(~whole).withColumn(out_col, F.lit(None).cast(kind)))


def usage_number(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str], block: Column,
                 out_col: str = "use_no") -> DataFrame:
    """K-3: the n-th use of each key in order (1-based)."""
    return keyed_row_number(df, key_cols, order_cols, block, out_col)


def usage_cap(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str], block: Column,
              cap: int = fixed.CARD_REUSE_LIMIT) -> DataFrame:
    """K-3: use number and whether the use is within the cap."""
    out = usage_number(df, key_cols, order_cols, block, "use_no")
    return out.withColumn("allowed", F.col("use_no") <= F.lit(cap))


def _first_rows_bound(df: DataFrame, order_col: str, n: int):
    """The n-th smallest order value (distributed top-n, one scalar to the driver)."""
    if n <= 0:
        return None
    top = df.select(order_col).orderBy(order_col).limit(n)
    return top.agg(F.max(order_col)).first()[0]


def repeat_assign(rows: DataFrame, order_col: str, stream: str = "client",
                  p_repeat: float = fixed.CLIENT_REPEAT_PROBABILITY, pool_min: int = fixed.CLIENT_POOL_MIN,
                  block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """K-5: each row is a new client, or with p_repeat (once the pool holds pool_min
    clients) a uniform pick among the clients created before it.

    new = (row is among the first pool_min rows) or draw >= p_repeat;
    client_no of a new row = number of new rows before it; a repeat row picks
    floor(draw * clients_before). Exact and deterministic, no sequential loop."""
    bound = _first_rows_bound(rows, order_col, pool_min)
    first = F.lit(False) if bound is None else F.coalesce(F.col(order_col) <= F.lit(bound), F.lit(False))
    d = rows.withColumn("is_new", first | (u(stream + ":repeat", order_col) >= F.lit(p_repeat)))
    d = prefix_sum(d, order_col, [(F.col("is_new").cast("bigint"), "clients_before")], block_size, levels=levels_for(rows, order_col, block_size))
    pick = F.floor(u(stream + ":pick", order_col) * F.col("clients_before")).cast("bigint")
    return d.withColumn("client_no", F.when(F.col("is_new"), F.col("clients_before")).otherwise(pick)) \
        .drop("clients_before")


def opened_cards(rows: DataFrame, order_col: str, stream: str, p_reuse: float, cap: int, block_size: int) -> DataFrame:
    """The rows with ``_before``, the number of cards open before the row, and ``_opens``.

    A row opens a card when its draw says so, or when every card is full. Each row before it
    used one card, so all are full when the rows before are ``cap`` times the cards before:
    whether a row opens one depends on counts alone. With N(i) rows before row i that want a
    new card, cards(i) = N(i) + max(0, max over j < i of floor(j / cap) + 1 - N(j + 1)), the
    least number that never falls short; both parts are blocked scans."""
    levels = levels_for(rows, order_col, block_size)
    d = rows.withColumn("_wants", (u(stream + ":reuse", order_col) >= F.lit(p_reuse)).cast("bigint"))
    d = prefix_sum(d, order_col, [(F.lit(1), "_i"), ("_wants", "_n")], block_size, levels=levels)
    need = F.floor(F.col("_i") / F.lit(cap)).cast("bigint") + 1
    d = prefix_max(d, order_col, [(need - F.col("_n") - F.col("_wants"), "_lack")], 0, block_size, levels=levels)
    d = d.withColumn("_before", F.col("_n") + F.greatest(F.col("_lack"), F.lit(0)))
    return d.withColumn("_opens", (F.col("_wants") == 1) | (F.col("_before") < need)).drop("_wants", "_i", "_n", "_lack")


def pool_reuse(rows: DataFrame, order_col: str, stream: str = "card",
               p_reuse: float = fixed.CARD_REUSE_PROBABILITY, cap: int = fixed.CARD_REUSE_LIMIT,
               block_size: int = DEFAULT_BLOCK, max_rounds: int = 10_000) -> DataFrame:
    """K-4: with p_reuse a row reuses a card opened before it, uniform over those that still
    have room (used fewer than ``cap`` times by earlier rows); it opens a new card otherwise,
    or when no card has room. Adds card_id (the order value of the row that opened it),
    card_no (its number from 0), use_no and new_card. ``order_col`` is unique; a row without
    it is kept, with nulls.

    The sequential rule, as a set of jobs: which rows open cards depends on counts alone
    (``opened_cards``). A reusing row goes through the cards before it in the order of a
    permutation of its own, and takes the first with room. Since every card prefers earlier
    rows, that is what deferred acceptance gives: in a round, rows without a card ask their
    next one; a card holds the earliest ``cap`` - 1 that ever asked; whoever it refuses asks
    on, until nobody is refused. Only the cards asked in a round are looked at, so rounds
    shrink quickly while cards have room; they grow in number as all but few are full."""
    pool = materialize(opened_cards(rows.select(order_col).where(F.col(order_col).isNotNull()), order_col, stream, p_reuse, cap, block_size), "pool")

    def asking(d: DataFrame) -> DataFrame:
        return shuffled(d, F.col("_n"), {"_card": F.col("_try")}, stream + ":pick", "_row").select("_row", "_n", "_try", "_card")

    by_card = Window.partitionBy("_card").orderBy("_row")
    first = asking(pool.where(~F.col("_opens")).select(F.col(order_col).alias("_row"), F.col("_before").alias("_n"), F.lit(0).cast("bigint").alias("_try")))
    first = materialize(first.withColumn("_held", F.row_number().over(by_card) < cap), "card-asks")
    asks = materialize(asking(first.where("NOT _held").withColumn("_try", F.lit(1).cast("bigint"))), "card-asks")
    granted, later = first.where("_held").drop("_held"), []
    for done in range(max_rounds):
        if asks.isEmpty():
            break
        # all that ever asked the cards asked now, without those refused at once
        old = reduce(DataFrame.unionByName, [granted, *later])
        contest = old.join(asks.select("_card").distinct(), "_card", "left_semi").withColumn("_old", F.lit(1)).unionByName(asks.withColumn("_old", F.lit(0)))
        ranked = contest.withColumn("_rank", F.row_number().over(by_card)).withColumn(
            "_was", F.sum("_old").over(by_card.rowsBetween(Window.unboundedPreceding, 0)))
        # refused now: beyond the limit, and not refused in an earlier round
        out = (F.col("_rank") >= cap) & ((F.col("_old") == 0) | (F.col("_was") < cap))
        later.append(asks)
        asks = materialize(asking(ranked.where(out).withColumn("_try", F.col("_try") + 1)), "card-asks")
        if done % 8 == 7:       # keeps the plan of a round from growing
            later = [materialize(reduce(DataFrame.unionByName, later), "card-asks")]
    else:
        raise RuntimeError(f"cards are not settled after {max_rounds} rounds: nearly all are full")

    # a row's card is the last it asked
    uses = first.select("_row", "_card")
    if later:
        last = reduce(DataFrame.unionByName, later).groupBy("_row").agg(F.max_by("_card", "_try").alias("_card"))
        uses = uses.join(last.select("_row"), "_row", "left_anti").unionByName(last)
    uses = uses.unionByName(pool.where("_opens").select(F.col(order_col).alias("_row"), F.col("_before").alias("_card")))
    done = uses.select(F.col("_row").alias(order_col), F.first("_row").over(by_card).alias("card_id"), F.col("_card").alias("card_no"),
                       F.row_number().over(by_card).cast("bigint").alias("use_no"))
    done = done.withColumn("new_card", F.col("use_no") == 1)
    if rows.columns == [order_col]:
        nulls = rows.where(F.col(order_col).isNull()).select(order_col, *[F.lit(None).cast(done.schema[c].dataType).alias(c) for c in done.columns[1:]])
        return done.unionByName(nulls)
    return rows.join(done, order_col, "left")


def unique_register(df: DataFrame, value_col: str, order_col: str, out_col: str = "accepted") -> DataFrame:
    """K-6: a value is accepted for its first row only (refuse values already seen).
    Min order per value by aggregation (partial, skew-safe), joined back."""
    firsts = df.where(F.col(value_col).isNotNull()).groupBy(value_col).agg(F.min(order_col).alias("_first"))
    j = df.join(firsts, value_col, "left")
    return j.withColumn(out_col, F.coalesce(F.col(order_col) == F.col("_first"), F.lit(False))).drop("_first")
