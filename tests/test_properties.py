"""Properties: exact tiers and rounding, deterministic rebuilds."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabulark.functions.money import COURIER_TIERS, rounded_rating, tier_index, tier_payout
from tabulark.plans import dims
from tabulark.sources import adapters
from tabulark.sources.driver import Tables

from conftest import SF0001

groups = st.lists(st.tuples(st.integers(1, 500), st.integers(1, 50), st.integers(0, 10**9)),
                  min_size=1, max_size=40)


def _expected(n, ratings_sum, total_cents):
    avg = Decimal(ratings_sum) / Decimal(n)
    tier = next((i for i, (b, _, _) in enumerate(COURIER_TIERS) if b is not None and avg < b),
                len(COURIER_TIERS) - 1)
    _, share, floor = COURIER_TIERS[tier]
    total = Decimal(total_cents) / 100
    payout = max(total * share, floor).quantize(Decimal("0.00001"), ROUND_HALF_UP)
    stored = avg.quantize(Decimal("0.1"), ROUND_HALF_UP)
    return tier, stored, payout


@settings(max_examples=15, deadline=None)
@given(groups)
def test_tiers_rounding_and_payout_are_exact(spark, rows):
    data = []
    for n, per, cents in rows:
        ratings_sum = min(5 * n, max(n, n * (per % 5 + 1) - per % 3))  # ratings in 1..5
        data.append((n, ratings_sum * 10, Decimal(cents) / 100, ratings_sum))
    df = spark.createDataFrame(data, "n long, rate10 long, total decimal(19,2), s long")
    tier = tier_index(F.col("rate10"), F.col("n"))
    got = df.select("n", "s", "total", tier.alias("tier"),
                    rounded_rating(F.col("rate10"), F.col("n")).alias("avg"),
                    tier_payout(F.col("total"), tier).cast("decimal(19,5)").alias("pay")).collect()
    for r in got:
        want_tier, want_avg, want_pay = _expected(r.n, r.s, int(r.total * 100))
        assert (r.tier, r.avg, r.pay) == (want_tier, want_avg, want_pay)


def test_rebuild_is_deterministic(spark):
    t = Tables(spark, SF0001)
    docs = adapters.user_documents(t)
    a = dims.dim_users(docs).table
    b = dims.dim_users(docs.repartition(7)).table
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
