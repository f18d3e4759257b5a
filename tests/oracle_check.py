"""Compare each bound query with its DuckDB oracle: row count, column names and types,
and the multiset of rows (order-insensitive)."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

_SPARK_TO_DUCK = {
    T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR",
    T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE",
    T.BooleanType: "BOOLEAN", T.ShortType: "SMALLINT", T.FloatType: "FLOAT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat() if not isinstance(v, str) else v
    return v


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    sp_types = {f.name: _SPARK_TO_DUCK.get(type(f.dataType), f.dataType.simpleString().upper())
                for f in spark_df.schema.fields}
    rel = con.sql(sql)
    dk_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    if sorted(sp_types) != sorted(dk_types):
        return False, f"columns differ spark={sorted(sp_types)} duck={sorted(dk_types)}"
    bad_types = {c: (sp_types[c], dk_types[c]) for c in sp_types if sp_types[c] != dk_types[c]}
    cols = sorted(sp_types)
    srows = [tuple(_norm(r[c]) for c in cols) for r in spark_df.select(*cols).collect()]
    drows = [tuple(_norm(v) for v in row) for row in rel.select(*[f'"{c}"' for c in cols]).fetchall()]
    if len(srows) != len(drows):
        return False, f"rows spark={len(srows)} duck={len(drows)}"
    key = lambda r: tuple((x is None, str(x)) for x in r)
    s_sorted, d_sorted = sorted(srows, key=key), sorted(drows, key=key)
    diffs = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b]
    if diffs:
        return False, f"{len(diffs)} rows differ, first spark={diffs[0][0]} duck={diffs[0][1]}"
    if bad_types:
        return False, f"types differ {bad_types} (values equal, {len(srows)} rows)"
    return True, f"{len(srows)} rows"


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from tabsmith.session import local_session
    sf_dir = "/root/testdata/sf0.01"
    only = argv[1:]
    spark = local_session()
    tz = os.environ.get("CHECK_TZ")
    if tz:
        spark.conf.set("spark.sql.session.timeZone", tz)
    con = duck(sf_dir)
    qs, os_ = entry.queries(), entry.oracle_sql()
    ok_n = 0
    for k, fn in qs.items():
        if only and k not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if k in os_:
                ok, msg = compare(df, con, os_[k])
            else:
                ok, msg = True, f"no oracle, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        ok_n += ok
        print(f"{'OK ' if ok else 'BAD'} {k:24s} {time.time() - t:6.1f}s {msg}", flush=True)
    print(f"{ok_n} ok")


if __name__ == "__main__":
    main(sys.argv)
