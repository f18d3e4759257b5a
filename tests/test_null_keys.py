"""Null keys against the SQL of the same rules, the gap message, and import without the
optional parts."""

import os
import shutil
import subprocess
import sys

import duckdb
from pyspark.sql import functions as F

from tabsmith.operators import keyed, quality
from tabsmith.plans.bind_keyed import day_block
from tests.conftest import ROOT, SF_SMALL

NULLED = """SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN user_id END user_id,
  CASE WHEN event_id % 5 <> 0 THEN event_type END event_type, value, ts FROM read_parquet('{}/events.parquet')"""


def _events(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "event_type", "value", "ts")
    return ev.withColumns({"user_id": F.when(F.col("event_id") % 3 != 0, F.col("user_id")),
                           "event_type": F.when(F.col("event_id") % 5 != 0, F.col("event_type"))})


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_pair_lookup_keeps_rows_without_a_key(spark):
    got = keyed.apply_first_wins(_events(spark), ["user_id", "event_type"], "value", ["ts", "event_id"], "v")
    want = duckdb.sql(f"""WITH e AS ({NULLED.format(SF_SMALL)}) SELECT event_id, f.v FROM e LEFT JOIN
      (SELECT user_id, event_type, first(value ORDER BY ts, event_id) v FROM e GROUP BY ALL) f USING (user_id, event_type)""").fetchall()
    assert _rows(got, "event_id", "v") == sorted(want, key=str)


def test_visits_without_a_client_follow_each_other(spark):
    ev = _events(spark).withColumn("res", F.col("ts") + F.expr("INTERVAL 3 HOURS"))
    got = quality.revisit_gaps(ev, "user_id", "ts", "res", "event_id", day_block())
    want = duckdb.sql(f"""WITH e AS ({NULLED.format(SF_SMALL)}) SELECT event_id,
      date_diff('microsecond', lag(ts + INTERVAL 3 HOURS) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 3.6e9 FROM e""").fetchall()
    assert _rows(got, "event_id", "gap_hours") == sorted(want, key=str)
    assert got.columns == [*ev.columns, "prev_result", "gap_hours", "too_soon"]


def test_gap_message(spark):
    rows = [("2024-01-01 10:00:00", "2024-01-01 20:15:00"), ("2024-01-01 10:00:00", "2024-01-03 10:00:00"),
            ("2024-01-01 10:00:00", "2024-01-20 10:03:00"), ("2024-01-02 10:00:00", "2024-01-01 09:57:00"), (None, "2024-01-01 09:57:00")]
    df = spark.createDataFrame(rows, "a string, b string").select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in "ab"])
    got = [r[0] for r in df.select(quality.gap_message("a", "b")).collect()]
    due = "results are due after 24 to 168 hours, got "
    assert got == [due + "10.3", "", due + "456.1", due + "-24.1", ""]


def test_contract_without_the_optional_package(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path)
    shutil.copytree(os.path.join(ROOT, "tabsmith"), tmp_path / "tabsmith", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = ("import __spark_entry__ as c; q, o = c.queries(), c.oracle_sql(); "
            "assert set(o) <= set(q) and len(q) > 85 and not any(k.startswith('op') or k == 'pipeline' for k in q); print(c.__file__)")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr
    assert str(tmp_path) in out.stdout
