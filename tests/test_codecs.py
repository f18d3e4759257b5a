"""Check digits against vectors computed by hand from the stated rules."""

from pyspark.sql import functions as F

from tabsmith.functions import codecs


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("r")).first()["r"]


def test_snils_control_edges(spark):
    # weights 9..1; 920000010 -> 81+16+2 = 99; +1 -> 100; +2 -> 101; 996100000 -> 201 (mod 101 = 100)
    cases = {"920000010": 99, "920000011": 0, "920000012": 0, "920000013": 1, "996100000": 0, "112233445": 95}
    for digits, control in cases.items():
        assert _one(spark, codecs.snils_control, digits) == control, digits


def test_snils_format_and_validate(spark):
    assert _one(spark, codecs.snils_format, "112233445") == "112-233-445 95"
    assert _one(spark, codecs.snils_valid, "112-233-445 95") is True
    assert _one(spark, codecs.snils_valid, "112-233-445 59") is False
    assert _one(spark, codecs.snils_valid, "112 233 445 95") is False


def test_luhn(spark):
    assert _one(spark, codecs.luhn_check_digit, "411111111111111") == 1
    assert _one(spark, codecs.luhn_check_digit, "220004123456789") == int(_luhn_digit("220004123456789"))
    assert _one(spark, codecs.luhn_valid, "4111 1111 1111 1111") is True
    assert _one(spark, codecs.luhn_valid, "4111 1111 1111 1112") is False   # one wrong digit
    assert _one(spark, codecs.luhn_valid, "4111 1111 1111 111") is False    # 15 digits
    assert _one(spark, codecs.group4, "4111111111111111") == "4111 1111 1111 1111"


def _luhn_digit(p15: str) -> str:
    for c in "0123456789":
        total = 0
        for i, ch in enumerate((p15 + c)[::-1]):
            d = int(ch)
            if i % 2 == 1:
                d = d * 2 - 9 if d * 2 > 9 else d * 2
            total += d
        if total % 10 == 0:
            return c
    raise AssertionError
