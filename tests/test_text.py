"""C-S2 / C-S3: card texts and whole bank codes."""

from pyspark.sql import functions as F

from tesoro.functions import text as T


def test_card_texts(spark):
    cases = {1_234_567.0: "1.23M", -1_234_567.0: "-1.23M", 2_345_678_901.0: "2345.68M", 45_600.0: "46K", -45_400.0: "-45K",
             2_500.0: "2K", 999_999.0: "1000K", 789.0: "789", -12.6: "-13", 0.0: "0", -0.3: "-0", 999.7: "1,000"}
    df = spark.createDataFrame([(x,) for x in cases], "x double")
    got = {r.x: (r.t, r.c) for r in df.select("x", T.compact_number("x").alias("t"), T.signed_compact("x").alias("c")).collect()}
    assert {x: t for x, (t, _) in got.items()} == cases
    assert got[1_234_567.0][1] == "+ 1.23M" and got[-45_400.0][1] == "- 45K" and got[0.0][1] == "- 0"


def test_whole_codes(spark):
    df = spark.createDataFrame([("SAN",), ("SANX",), ("JPM",), ("jpm",), (None,)], "c string")
    got = [r[0] for r in df.select(T.code_map(F.col("c"), T.BANK_THEME_COLOURS, T.BANK_THEME_DEFAULT)).collect()]
    assert got == ["#EC0000", "#888888", "#117ACA", "#888888", "#888888"]
