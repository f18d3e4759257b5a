"""Awkward inputs shared by the operator tests."""

import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_rows():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["Été", "naïve", "THE", "the", "a", "straße", "x" * 90, "中文字"]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, base, long = prose(60), prose(300), prose(9000)
    near = base.split()
    near[150] = "changed"
    texts = [None, "", "   \t\n", "one", "One", "two words", "TWO  WORDS", "!!! 123 ...", base, base, base.upper(), " ".join(near),
             prose(40) + "  " + passage + "\n" + prose(30), passage + " " + passage, prose(20) + " " + passage, long, long + " tail",
             " nbsp em", "a\u0000b c", prose(34), prose(35), prose(36)]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("s0", "s1", None)[i % 5 % 3], None) for i, t in enumerate(texts)]
    rows += [(8, base, "en", "s0", 1), (8, prose(50), "fr", "s1", 2), (None, base, "en", "s0", 3), (None, None, None, None, None), (-7, passage, "en", "s0", 4)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    """Rows with nulls, repeats, ties, empty and long texts, and columns whose names an
    operator might want."""
    df = spark.createDataFrame(awkward_rows(), DOCS).repartition(3)
    clash = ["key", "shard", "size", "n_words", "n", "row", "score", "cid", "tile", "comp", "pass", "spans", "items", "held_out", "units", "tokens", "uses"]
    return df.withColumns({c: F.lit("extra") for c in clash})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
