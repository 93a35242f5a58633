"""Plain amounts and meters take a short way, which must give what the long one gives."""

from pyspark.sql import functions as F

from wattledger.functions import scalars as S

TEXTS = ["5", "5\n", "-12.5", "0012.30", "12.345", "12.", ".5", "1,234", "1,234.50", "R 7", "-", "", None, "1e3", "--1", "1.2.3", "999999999999999.99", "9999999999999999", "٣", "5 0", " 5", "12.30\r\n"]
METERS = ["007", "ab 1", "AB1\n", "12.0", "ab12", "", None, " x9", "é1", "A\tB"]


def test_short_ways_give_what_the_long_ones_give(spark):
    """A blank in front is trimmed, but keeps a text from being plain."""
    for drop in (True, False):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
        for r in rows.select("t", S.money_cents("t", drop).alias("a"), S.money_cents(F.concat(F.lit(" "), "t"), drop).alias("b")).collect():
            assert r["a"] == r["b"], r
    rows = spark.createDataFrame([(t,) for t in METERS], "t string")
    for r in rows.select("t", S.meter_no("t").alias("a"), S.meter_no(F.concat(F.lit(" "), "t")).alias("b"), S.raw_meter_no("t").alias("c"), S.raw_meter_no(F.concat(F.lit(" "), "t")).alias("d")).collect():
        assert r["a"] == r["b"] and r["c"] == r["d"], r
    assert [r[0] for r in spark.createDataFrame([("AB1\n",), ("12.0",), (None,)], "t string").select(S.raw_meter_no("t")).collect()] == ["AB1", "12", ""]
