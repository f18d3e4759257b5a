"""Reproducible draws.

Every draw is a pure function of (seed, stream, row key): the first 52 bits of
``md5("seed:stream:key...")`` divided by 2^52 (exact in a double). The value does not depend on
partitioning, task order or engine, so the same row gets the same draw under 1 or
1000 partitions, and an SQL engine with ``md5`` can repeat it bit for bit
(``sql_u`` renders the same expression as SQL text for the oracles).

``shuffled(df, n, {out: i}, ...)`` adds the i-th place of a keyed permutation of 0..n-1: k picks
without repeats are the places 0..k-1, in constant time each, however long the list is.
It is a swap-or-not shuffle: in each round a key pairs every place x with (key - x) mod n,
and a bit that depends on the larger of the two, so on the pair, says whether the two
change places. Each round permutes 0..n-1 itself, for any n; ``_ROUNDS`` of them leave a
place unmoved with probability 2^-16.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: default seed of a run
SEED = 42

_TWO52 = 4503599627370496.0


def _key(stream: str, ids, seed: int) -> Column:
    parts = [F.lit(str(seed)), F.lit(stream)] + [
        (F.col(i) if isinstance(i, str) else i).cast("string") for i in ids
    ]
    return F.concat_ws(":", *parts)


def u(stream: str, *ids, seed: int = SEED) -> Column:
    """Uniform double in [0, 1) keyed by (seed, stream, ids)."""
    h = F.conv(F.substring(F.md5(_key(stream, ids, seed)), 1, 13), 16, 10)
    return h.cast("bigint").cast("double") / F.lit(_TWO52)


def rand_int(lo, hi, stream: str, *ids, seed: int = SEED) -> Column:
    """Integer uniform on [lo, hi] (both inclusive, like ``randint``). lo/hi may be columns."""
    lo_c = lo if isinstance(lo, Column) else F.lit(int(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(int(hi))
    return (lo_c + F.floor(u(stream, *ids, seed=seed) * (hi_c - lo_c + 1))).cast("bigint")


def pick_index(n, stream: str, *ids, seed: int = SEED) -> Column:
    """0-based index uniform over n items (n may be a column)."""
    n_c = n if isinstance(n, Column) else F.lit(int(n))
    return F.floor(u(stream, *ids, seed=seed) * n_c).cast("bigint")


# fixed values: modulus (a Mersenne prime, so that products of two residues stay below
# 2^62) and multipliers of the round keys
_P, _M, _M2 = 2147483647, 48271, 69621
_ROUNDS = 16


def _round_keys() -> list[tuple[int, int]]:
    """(A, C) of each round: its key is (A * digest + C) mod _P, a linear congruence's steps."""
    out = [(1, 0)]
    for _ in range(_ROUNDS - 1):
        a, c = out[-1]
        out.append((a * _M % _P, (c * _M + 1) % _P))
    return out


def _swapped(x: str, k: str, shift: str, n: str) -> str:
    """One round as SQL text, the same in both engines: no sum here is negative."""
    pair = f"({shift} + {n} - {x}) % {n}"
    y = f"((greatest({x}, {pair}) + {k}) % {_P})"
    return f"CASE WHEN ({y} * {y} % {_P} * {_M} % {_P}) % 2 = 1 THEN {pair} ELSE {x} END"


def _shift(k: str, n: str) -> str:
    return f"({k} * 2147483648 + ({k} * {_M2} + 7) % {_P}) % {n}"


def shuffled(df: DataFrame, n, places: dict[str, Column | int], stream: str, *ids, seed: int = SEED) -> DataFrame:
    """The frame with columns out -> place: the ``i``-th place (0 <= i < n) of a permutation
    of 0..n-1 keyed by (seed, stream, ids), for each (out, i) of ``places``. ``n`` and the
    places are whole numbers or columns, n up to 2^52; the column is null for other i.

    One digest a row, whatever the number of places; the rounds are a fold over their keys,
    and a place that is null costs nothing."""
    col = lambda x: (x if isinstance(x, Column) else F.lit(int(x))).cast("bigint")
    held, js = [c for c in df.columns if c not in places], range(len(places))
    d = df.withColumns({"__n": col(n), "__h": F.conv(F.substring(F.md5(_key(stream, ids, seed)), 1, 13), 16, 10).cast("bigint") % _P}
                       | {f"__i{j}": col(i) for j, i in enumerate(places.values())})
    keys = ", ".join(f"({a} * __h + {c}) % {_P}" for a, c in _round_keys())
    wanted = f"coalesce({', '.join(f'__i{j}' for j in js)}) IS NOT NULL"        # a row without any place has no rounds
    d = d.selectExpr("*", "greatest(__n, 1L) AS __m", f"CASE WHEN {wanted} THEN array({keys}) END AS __keys")
    d = d.selectExpr("*", f"transform(__keys, k -> named_struct('k', k, 's', {_shift('k', '__m')})) AS __rounds")
    step = _swapped("x", "r.k", "r.s", "__m")
    out = [f"CASE WHEN __i{j} >= 0 AND __i{j} < __n THEN aggregate(__rounds, __i{j}, (x, r) -> {step}) END AS `{name}`" for j, name in enumerate(places)]
    return d.selectExpr(*[f"`{c}`" for c in held], *out)


# ---- SQL twins (used by the oracle catalogue) -------------------------------------

def sql_u(stream: str, *ids: str, seed: int = SEED) -> str:
    parts = ", ".join([f"'{seed}'", f"'{stream}'"] + [f"CAST({i} AS VARCHAR)" for i in ids])
    return (
        f"(CAST(CAST(('0x' || substr(md5(concat_ws(':', {parts})), 1, 13)) AS BIGINT) AS DOUBLE)"
        f" / CAST({_TWO52!r} AS DOUBLE))"
    )


def sql_rand_int(lo, hi, stream: str, *ids: str, seed: int = SEED) -> str:
    return f"CAST(({lo}) + floor({sql_u(stream, *ids, seed=seed)} * (({hi}) - ({lo}) + 1)) AS BIGINT)"


def sql_pick_index(n, stream: str, *ids: str, seed: int = SEED) -> str:
    return f"CAST(floor({sql_u(stream, *ids, seed=seed)} * ({n})) AS BIGINT)"


def sql_shuffled(n: str, i: str, stream: str, *ids: str, seed: int = SEED) -> str:
    """Twin of ``shuffled``: a fold over the rounds; sub-selects name the parts."""
    parts = ", ".join([f"'{seed}'", f"'{stream}'"] + [f"CAST({x} AS VARCHAR)" for x in ids])
    digest = f"CAST(('0x' || substr(md5(concat_ws(':', {parts})), 1, 13)) AS BIGINT) % {_P}"
    keys = ", ".join(f"({a} * _h + {c}) % {_P}" for a, c in _round_keys())
    step = _swapped("x", "_keys[w + 1]", _shift("_keys[w + 1]", "_n"), "_n")
    return (f"(SELECT CASE WHEN _i >= 0 AND _i < _n THEN list_reduce(list_prepend(_i, range({_ROUNDS})), lambda x, w: {step}) END FROM "
            f"(SELECT *, [{keys}] AS _keys FROM (SELECT CAST({n} AS BIGINT) AS _n, CAST({i} AS BIGINT) AS _i, {digest} AS _h)))")
