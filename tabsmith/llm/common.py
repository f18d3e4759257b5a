"""Shared pieces of the operators: column picking, Arrow steps, joins by row identity,
connected components."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.session import materialize


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns under the operator's own names (``new=old``), so that no
    other column of the input can clash with what the operator adds."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in cols.items()])


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with underscores in front until the frame has no such column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def strings(values) -> pa.Array:
    return pa.array(values, pa.string())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges`` (a long, b long): one row
    (id, comp) per node that has an edge, comp the smallest id reachable.

    Alternates large-star and small-star: every node links its larger neighbours, then
    its smaller ones, to the smallest one it sees. Each round is written to the shared
    folder; the number of rounds grows with the logarithm of the component size. No
    neighbour list is collected: a node's minimum is an aggregate. ``edges`` is read more
    than once: best a written table. Raises when ``max_rounds``
    rounds are not enough."""
    e = edges.where(F.col("a") != F.col("b")).select("a", "b")
    for _ in range(max_rounds):
        both = both_of(e, ("a", "b"), ("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where(F.col("b") > F.col("a")).join(low, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = large.where(F.col("a") != F.col("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = both_of(large.join(low, "a"), ("b", "m"), ("a", "m"))
        e = materialize(small.where(F.col("a") != F.col("b")).distinct(), "edges")
        # done when all is stars: one edge per node, and no centre has an edge of its own
        ends = both_of(e.select("a", "b", F.lit(1).alias("edges"), F.lit(0).alias("none")), ("a", "edges"), ("b", "none"))
        if ends.groupBy("a").agg(F.sum("b").alias("n"), F.min("b").alias("least")).where("n > 1 OR n = 1 AND least = 0").isEmpty():
            break
    else:
        raise RuntimeError(f"connected components have not converged after {max_rounds} rounds")
    # each node has one edge now, to the smallest id of its component
    return both_of(e, ("a", "b"), ("b", "b")).select(F.col("a").alias("id"), F.col("b").alias("comp")).distinct()


def both_of(df: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Two rows (a, b) of each row, from two pairs of its columns; the frame is read once."""
    pairs = [F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in (first, second)]
    return df.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")


def schema(*fields: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])


def whole_groups(batches, key: str):
    """Tables of a partition sorted by ``key`` that hold only whole key groups; the last
    group of a batch waits for the next batch."""
    rest: list[pa.Table] = []
    for b in batches:
        t = pa.Table.from_batches([b])
        if not t.num_rows:
            continue
        k = t.column(key).combine_chunks().to_numpy(zero_copy_only=False)
        if rest and rest[-1].column(key)[-1].as_py() != k[0]:
            yield pa.concat_tables(rest).combine_chunks()
            rest = []
        at = int((k != k[-1]).nonzero()[0][-1]) + 1 if (k != k[-1]).any() else 0
        if at:
            rest.append(t.slice(0, at))
            yield pa.concat_tables(rest).combine_chunks()
            rest = []
        rest.append(t.slice(at))
    if rest:
        yield pa.concat_tables(rest).combine_chunks()
