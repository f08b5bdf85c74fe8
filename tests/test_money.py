"""Courier tiers, payout floors and rating rounding (edge rows of the fixtures)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tabulark.functions.money import rounded_rating, tier_index, tier_payout, tier_share


def _tiers(spark, rows):
    df = spark.createDataFrame(rows, "rate10 long, n long")
    return df.select(tier_share(tier_index(F.col("rate10"), F.col("n"))).alias("share"),
                     rounded_rating(F.col("rate10"), F.col("n")).alias("avg")).collect()


@pytest.mark.parametrize("avg,share", [
    ("3.99", "0.05"), ("4.0", "0.07"), ("4.49", "0.07"), ("4.5", "0.08"),
    ("4.89", "0.08"), ("4.9", "0.10"), ("5.0", "0.10")])
def test_tier_edges(spark, avg, share):
    # n = 100 deliveries whose ratings sum to avg * 100 (tenths: avg * 1000)
    rate10 = int(Decimal(avg) * 1000)
    got = _tiers(spark, [(rate10, 100)])[0]
    assert got["share"] == Decimal(share)


def test_rounded_rating_uses_exact_tier(spark):
    # 4.45 -> stored 4.5 but tier 7 %; 4.85 -> stored 4.9 but tier 8 %
    got = _tiers(spark, [(4450, 100), (4850, 100)])
    assert [r["avg"] for r in got] == [Decimal("4.5"), Decimal("4.9")]
    assert [r["share"] for r in got] == [Decimal("0.07"), Decimal("0.08")]


@pytest.mark.parametrize("total,tier,payout", [
    ("2000", 0, "100"), ("2000.01", 0, "100.0005"),
    ("2142.85", 1, "150"), ("2142.86", 1, "150.0002"),
    ("2187.5", 2, "175"), ("2187.51", 2, "175.0008"),
    ("2000", 3, "200"), ("2000.01", 3, "200.001")])
def test_payout_floors(spark, total, tier, payout):
    df = spark.createDataFrame([(Decimal(total), tier)], "total decimal(19,5), tier int")
    got = df.select(tier_payout(F.col("total"), F.col("tier")).cast("decimal(19,5)").alias("p")).collect()
    assert got[0]["p"] == Decimal(payout)
