"""Draw operators D-1..D-11 (reproducible, see ``functions.draws``).

Dictionaries are joined on an integer index computed from the draw, so picking is an
equi-join (hash join, broadcast when the counted dictionary is small) rather than a
scan. k of a dictionary's list are the first k places of a keyed permutation, in constant
time each (``functions.draws.shuffled``). k of a group's rows is a ``row_number`` over
draws with a literal upper bound, which lets Spark insert a partial per-group limit before
the shuffle (WindowGroupLimit), so a group holding a third of all rows sends at most k rows
per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.draws import pick_index, rand_int, shuffled, u
from tabsmith.operators.joins import checked_broadcast
from tabsmith.operators.prefix import DEFAULT_BLOCK, dense_index, keyed_row_number, levels_for, prefix_sum
from tabsmith.session import materialize


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pick_uniform(df: DataFrame, dictionary: DataFrame, stream: str, keys: Sequence, out_col: str,
                 n: int | None = None, idx_col: str = "idx", value_col: str = "value") -> DataFrame:
    """D-1: one uniform dictionary entry per row (``choice``). The dictionary size is a
    scalar subquery unless given; the join is on the drawn index."""
    if n is not None and n == 0:
        return df.withColumn(out_col, F.lit(None).cast("string"))
    size = F.lit(n) if n is not None else dictionary.agg(F.count(F.lit(1))).scalar()
    d = df.withColumn("_pick", F.floor(u(stream, *keys) * size).cast("bigint"))
    lk = checked_broadcast(dictionary.select(F.col(idx_col).alias("_pick"), F.col(value_col).alias(out_col)))
    return d.join(lk, "_pick", "left").drop("_pick")


def weighted_slices(weights: DataFrame, order_col: str, value_col: str, weight_col: str) -> DataFrame:
    """(value, lo, hi): the slice of [0, total) that each whole weight takes, in key order.
    The running sum is a blocked prefix sum, so the table may be of any size; weights of 0
    or less, or null, and rows without a key have no slice."""
    w = weights.select(F.col(order_col).alias("_o"), F.col(value_col).alias("value"), F.col(weight_col).cast("bigint").alias("_w"))
    w = w.where((F.col("_w") > 0) & F.col("_o").isNotNull())
    w = prefix_sum(w, "_o", [("_w", "lo")], levels=levels_for(w, "_o"))
    return w.select("value", "lo", (F.col("lo") + F.col("_w")).alias("hi"))


def pick_weighted_table(df: DataFrame, slices: DataFrame, stream: str, keys: Sequence, out_col: str, total: int | None = None,
                        default=None) -> DataFrame:
    """D-2 with the distribution as data, a table (value, lo, hi) of any size whose slices
    fill [0, n): each row draws t = floor(u * total) and takes the value of its slice, or
    ``default`` where there is none. ``total`` is n unless given: less leaves the tail
    unreachable, more leaves draws to the default.

    [0, total) is cut into about as many cells of equal width as there are slices. A slice
    is listed in every cell it meets, a row looks into the cell of its draw (an equi-join),
    and the exact comparison decides. A draw meets 2 slices on average, whatever their
    sizes; the cells hold at most twice as many entries as there are slices, and draws
    spread evenly over cells. The grid is broadcast only behind the byte check."""
    slices = materialize(slices, "weight-slices")
    n, end = slices.agg(F.count(F.lit(1)), F.max("hi")).first()
    kind = slices.schema["value"].dataType
    if not n:
        return df.withColumn(out_col, F.lit(default).cast(kind))
    width = max(1, -(-end // n))
    cell = lambda c: F.call_function("div", c, F.lit(width).cast("bigint"))
    grid = slices.withColumn("_cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))))
    grid = checked_broadcast(grid.select("_cell", "lo", "hi", F.col("value").alias(out_col)))
    d = df.withColumn("_t", pick_index(end if total is None else total, stream, *keys))
    d = d.withColumn("_cell", cell(F.col("_t")))
    j = d.join(grid, (d["_cell"] == grid["_cell"]) & (d["_t"] >= grid["lo"]) & (d["_t"] < grid["hi"]), "left")
    return j.select(*df.columns, F.coalesce(out_col, F.lit(default).cast(kind)).alias(out_col))


def pick_tiered(df: DataFrame, tiers: DataFrame, total, stream: str, keys: Sequence,
                out_col: str) -> DataFrame:
    """D-3: positional step weights (value, weight, cum_lo, cum_hi) with integer
    cumulative weights; the pick is t = floor(u * total) inside [cum_lo, cum_hi).
    ``total`` is an int or a column (e.g. a scalar subquery over a weights table)."""
    d = df.withColumn("_t", pick_index(total, stream, *keys))
    lk = checked_broadcast(tiers.select(F.col("value").alias(out_col), "cum_lo", "cum_hi"))
    j = d.join(lk, (d["_t"] >= lk["cum_lo"]) & (d["_t"] < lk["cum_hi"]), "left")
    return j.drop("_t", "cum_lo", "cum_hi")


def bernoulli(stream: str, keys: Sequence, p: float, yes, no) -> Column:
    """D-5: ``yes`` with probability p, else ``no``."""
    return F.when(u(stream, *keys) < F.lit(p), yes).otherwise(no)


def top_k_by_draw(cands: DataFrame, group_cols: Sequence[str], item_cols: Sequence[str], k: Column,
                  k_max: int, stream: str, rank_col: str = "rank",
                  prio: Column | None = None) -> DataFrame:
    """k items per group without replacement, ordered by a per-(group, item) draw
    (optionally after a priority column). ``k_max`` is the literal bound on k."""
    draw = u(stream, *group_cols, *item_cols)
    order = ([prio] if prio is not None else []) + [draw] + [F.col(c) for c in item_cols]
    w = Window.partitionBy(*group_cols).orderBy(*order)
    ranked = cands.withColumn("_rn", F.row_number().over(w))
    kept = ranked.where((F.col("_rn") <= F.lit(k_max)) & (F.col("_rn") <= k))
    return kept.withColumn(rank_col, F.col("_rn").cast("bigint")).drop("_rn")


def sample_k_of_n(rows: DataFrame, group_cols: Sequence[str], item_cols: Sequence[str], k_min: int, k_max: int,
                  stream: str, rank_col: str = "rank") -> DataFrame:
    """D-6: per group draw k in [k_min, k_max], keep k of its rows at random."""
    k = rand_int(k_min, k_max, stream + ":k", *group_cols)
    return top_k_by_draw(rows, group_cols, item_cols, k, k_max, stream, rank_col)


def sample_replace(df: DataFrame, dictionary: DataFrame, stream: str, keys: Sequence[str], k_min: int, k_max: int,
                   out_col: str, n: int | None = None) -> DataFrame:
    """D-7: k in [k_min, k_max] per row, k dictionary entries with replacement
    (one row per slot, slot 1..k)."""
    k = rand_int(k_min, k_max, stream + ":k", *keys)
    slots = df.withColumn("slot", F.explode(F.sequence(F.lit(1).cast("bigint"), k)))
    return pick_uniform(slots, dictionary, stream, [*keys, "slot"], out_col, n=n)


def pick_grouped(df: DataFrame, group_col: str, lookup: DataFrame, lookup_group: str, lookup_value: str,
                 stream: str, keys: Sequence, out_col: str, block: Column | None = None) -> DataFrame:
    """D-8: uniform pick inside a group chosen earlier. The lookup is numbered per group
    (idx, n); the row first gets its group's size, then joins on (group, idx).

    ``block`` (a column non-decreasing in ``lookup_value``, e.g. ``key div 65536``)
    numbers large groups in pieces (``keyed_row_number``) when the lookup is a growing
    dimension rather than a dictionary."""
    lk = lookup.select(F.col(lookup_group).alias("_g"), F.col(lookup_value).alias(out_col)).distinct()
    if block is None:
        w = Window.partitionBy("_g").orderBy(out_col)
        numbered = lk.withColumn("_idx", (F.row_number().over(w) - 1).cast("bigint"))
    else:
        blk = block if isinstance(block, Column) else F.col(block)
        numbered = keyed_row_number(lk.withColumn("_b", blk), ["_g"], [out_col], F.col("_b"), "_rn")
        numbered = numbered.withColumn("_idx", F.col("_rn") - 1).drop("_rn", "_b")
    sizes = numbered.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("_g", "_sg")
    numbered = checked_broadcast(numbered.select(F.col("_g").alias("_ng"), F.col("_idx").alias("_nidx"), F.col(out_col).alias("_nv")))
    d = df.join(checked_broadcast(sizes), F.col(group_col) == F.col("_sg"), "left").drop("_sg")
    d = d.withColumn("_idx", F.floor(u(stream, *keys) * F.col("_n")).cast("bigint"))
    j = d.join(numbered, (F.col(group_col) == F.col("_ng")) & (F.col("_idx") == F.col("_nidx")), "left")
    return j.withColumnRenamed("_nv", out_col).drop("_idx", "_n", "_ng", "_nidx")


def item_lists(own: DataFrame, group_col: str, item_col: str, common: Sequence[str] = ()) -> DataFrame:
    """(group, _own): each group's distinct items, and the ``common`` ones, as one sorted
    array (a dictionary's list). Groups without items of their own are not listed."""
    items = F.collect_set(item_col)
    if common:
        items = F.array_union(items, F.array(*[F.lit(w) for w in common]))
    return own.groupBy(group_col).agg(F.array_sort(items).alias("_own"))


def _by_index(df: DataFrame, dictionary: DataFrame, idx: dict[str, Column]) -> DataFrame:
    """Columns out -> value of the (idx, value) dictionary at an index column, null where
    the index is null. A null looks for an index that no entry has, a different one for
    different rows, so that such rows don't meet in one task."""
    entries = checked_broadcast(dictionary.select(F.col("idx").alias("_di"), F.col("value").alias("_dv")))
    for out, i in idx.items():
        nowhere = -1 - F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns[:1]]), F.lit(1 << 20))
        df = df.withColumn("_at", F.coalesce(i, nowhere))
        df = df.join(entries.withColumnRenamed("_dv", out), F.col("_at") == F.col("_di"), "left").drop("_at", "_di")
    return df


def _first_places(items: Column, n_picked: Column, places: Sequence[str]) -> Column:
    """The items at the first ``n_picked`` of the place columns, in that order."""
    return F.slice(F.array(*[F.get(items, F.col(c).cast("int")) for c in places]), F.lit(1), n_picked)


def fallback_lists(rows: DataFrame, row_keys: Sequence[str], group_col: str, own: DataFrame, general: DataFrame,
                   item_col: str, k: Column, k_max: int, stream: str, out_col: str) -> DataFrame:
    """D-9 with the picks as an array column ``out_col`` of the rows: k items (``k_max`` at
    most) from the group's own list; if it is shorter than k, all of it plus picks from the
    general list that are not in it.

    ``own``: (group, item) and ``general``: (item) are dictionaries. A row's i-th own pick is
    the i-th place of a permutation keyed by the row (``shuffled``), so a pick costs the same
    for a list of any length; the general list is never carried by a row but joined on the
    index of a pick. Among the first k places of the general list at most as many are in the
    own list as that has items, so k places always suffice."""
    lists = checked_broadcast(item_lists(own, group_col, item_col))
    numbered = dense_index(general, item_col).withColumnRenamed(item_col, "value")
    n_general = numbered.agg(F.count(F.lit(1))).scalar()
    d = rows.join(lists, group_col, "left").withColumn("_own", F.coalesce(F.col("_own"), F.array().cast("array<string>")))
    d = d.withColumn("_k", F.least(k, F.lit(k_max)).cast("int")).withColumn("_n", F.least(F.size("_own"), F.col("_k")))
    at, extra = [f"_p{i}" for i in range(k_max)], [f"_g{i}" for i in range(k_max)]
    # only the places that a row picks are looked up in its permutations
    d = shuffled(d, F.size("_own"), {c: F.when(i < F.col("_n"), F.lit(i)) for i, c in enumerate(at)}, stream, *row_keys)
    short = F.col("_n") < F.col("_k")
    d = shuffled(d, n_general, {c: F.when(short & (i < F.col("_k")), F.lit(i)) for i, c in enumerate(extra)}, stream + ":general", *row_keys)
    d = _by_index(d, numbered, {f"_w{i}": F.col(c) for i, c in enumerate(extra)})
    more = F.filter(F.array(*[F.col(f"_w{i}") for i in range(k_max)]), lambda w: w.isNotNull() & ~F.array_contains("_own", w))
    picks = F.concat(_first_places(F.col("_own"), F.col("_n"), at), F.slice(more, F.lit(1), F.col("_k") - F.col("_n")))
    return d.select(*rows.columns, picks.alias(out_col))


def _as_rows(d: DataFrame, row_keys: Sequence[str], list_col: str, item_col: str) -> DataFrame:
    """One row per pick with its rank from 1. The outer form: an inner one makes Spark infer
    a filter on the list's size, in which all that the list is made of appears anew."""
    rows = d.select(*row_keys, F.posexplode_outer(list_col).alias("_r", item_col)).where(F.col("_r").isNotNull())
    return rows.select(*row_keys, item_col, (F.col("_r") + 1).cast("bigint").alias("rank"))


def fallback_fill(rows: DataFrame, row_keys: Sequence[str], group_col: str, own: DataFrame, general: DataFrame,
                  item_col: str, k: Column, k_max: int, stream: str) -> DataFrame:
    """D-9 as rows: one row per pick (row keys, item, rank from 1)."""
    d = fallback_lists(rows.select(*row_keys, group_col), row_keys, group_col, own, general, item_col, k, k_max, stream, "_picks")
    return _as_rows(d, row_keys, "_picks", item_col)


def candidates_merge(rows: DataFrame, row_keys: Sequence[str], group_col: str, own: DataFrame, common: Sequence[str],
                     dictionary: DataFrame, item_col: str, k: Column, k_max: int, stream: str) -> DataFrame:
    """D-10: k items (``k_max`` at most) from the group's own list plus ``common`` words; when
    these are fewer than k, the missing number is drawn from the whole dictionary (idx,
    value), with replacement, first. Duplicates count once; the order of the picks is a
    permutation keyed by the row.

    A drawn word is joined on its index, so no row carries the dictionary, and no list is
    sorted per row: a group's list is sorted once."""
    lists = checked_broadcast(item_lists(own, group_col, item_col, common))
    alone = F.array(*[F.lit(w) for w in sorted(set(common))]) if common else F.array().cast("array<string>")
    n_words = dictionary.agg(F.count(F.lit(1))).scalar()
    d = rows.select(*row_keys, group_col).join(lists, group_col, "left").withColumn("_base", F.coalesce(F.col("_own"), alone))
    d = d.withColumn("_k", F.least(k, F.lit(k_max)).cast("int"))
    missing = F.col("_k") - F.size("_base")
    d = _by_index(d, dictionary, {f"_w{i}": F.when(i <= missing, pick_index(n_words, stream + ":extra", *row_keys, F.lit(i)))
                                  for i in range(1, k_max + 1)})
    drawn = F.filter(F.array(*[F.col(f"_w{i}") for i in range(1, k_max + 1)]), lambda w: w.isNotNull())
    d = d.withColumn("_all", F.when(missing > 0, F.array_union("_base", drawn)).otherwise(F.col("_base")))
    at = [f"_p{i}" for i in range(k_max)]
    d = shuffled(d, F.size("_all"), {c: i for i, c in enumerate(at)}, stream, *row_keys)
    return _as_rows(d.withColumn("_picks", _first_places(F.col("_all"), F.least(F.col("_k"), F.size("_all")), at)), row_keys, "_picks", item_col)


def ranked_codes(rows: DataFrame, key_col: str, group: Column, space: Column | int, stream: str, out_col: str,
                 block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """A place of its own for every row in the code space of its group, without rounds or a
    register: rows are numbered within the group by a unique long key and the number is
    sent through a permutation of 0..space-1 keyed by the group. Adds ``out_col``; fails
    when a group has more rows than its space. Large groups are numbered in pieces."""
    d = rows.withColumn("_grp", group).withColumn("_space", (space if isinstance(space, Column) else F.lit(space)).cast("bigint"))
    d = keyed_row_number(d, ["_grp"], [key_col], F.floor(F.col(key_col) / F.lit(block_size)).cast("bigint"), "_no")
    d = shuffled(d, F.col("_space"), {"_place": F.col("_no") - 1}, stream, F.col("_grp"))
    full = F.raise_error(F.concat(F.lit("more rows than codes in the space of "), F.col("_grp"))).cast("bigint")
    return d.select(*rows.columns, F.coalesce(F.col("_place"), full).alias(out_col))


def unique_codes(rows: DataFrame, key_col: str, code: Callable[[int], Column], out_col: str, max_rounds: int = 64) -> DataFrame:
    """A code of its own for every row (K-6 refuses codes already given): (key, attempt,
    out_col). In round r the rows not yet placed draw ``code(r)``; a code goes to its
    first claimant (smallest key) unless an earlier round gave it away. Each round is
    written, and only unplaced rows go on. Keys are distinct and not null."""
    left, placed, open_ = rows, None, rows.count()
    for attempt in range(1, max_rounds + 1):
        cand = left.withColumn(out_col, code(attempt))
        won = cand.groupBy(out_col).agg(F.min(key_col).alias(key_col)).withColumn("attempt", F.lit(attempt).cast("bigint"))
        if placed is not None:
            won = won.join(placed.select(out_col), out_col, "left_anti")
        won = materialize(won.select(key_col, "attempt", out_col), "placed")
        placed = won if placed is None else placed.union(won)
        open_ -= won.count()
        if not open_:
            return placed
        left = materialize(left.join(won.select(key_col), key_col, "left_anti"), "unplaced")
    raise RuntimeError(f"{open_} rows have no code after {max_rounds} rounds: the space of codes is too small")


def unique_batch(rows: DataFrame, key_col: str, stream: str, out_col: str, spread: int = 16, max_rounds: int = 64) -> DataFrame:
    """D-11: a value of its own for every row, from a space of ``spread`` x rows values
    (about 1 / spread of the rows stay for the next round)."""
    keys = materialize(rows.select(key_col).distinct(), "unplaced")
    space = keys.count() * spread
    placed = unique_codes(keys, key_col, lambda r: pick_index(space, stream, key_col, F.lit(r)), out_col, max_rounds)
    return rows.join(placed, key_col, "left")
