"""Exact money arithmetic and the courier rating tiers.

Money stays ``decimal`` end to end: values are cast to ``decimal(19,5)``
before they are multiplied or summed, literals are decimal (a Python float
literal would turn the whole expression into double), and every stored
money column ends with a cast to ``decimal(19,5)`` (half-up rounding).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import col_

# Settlement rules of the business.
PROCESSING_FEE_RATE = Decimal("0.25")
TIP_SHARE = Decimal("0.95")
# Courier tiers: (upper bound of average rating, exclusive; payout share; payout floor).
# Last tier has no upper bound.
COURIER_TIERS = [
    (Decimal("4"), Decimal("0.05"), Decimal("100")),
    (Decimal("4.5"), Decimal("0.07"), Decimal("150")),
    (Decimal("4.9"), Decimal("0.08"), Decimal("175")),
    (None, Decimal("0.10"), Decimal("200")),
]


def dec(value) -> Column:
    """Decimal literal (keeps decimal arithmetic decimal)."""
    return F.lit(Decimal(str(value)))


def money(c: str | Column) -> Column:
    return col_(c).cast("decimal(19,5)")


def times(c: str | Column, rate) -> Column:
    return col_(c) * dec(rate)


def tier_index(rate_tenths_sum: Column, n: Column) -> Column:
    """Tier of an average rating, decided exactly on integers.

    ``rate_tenths_sum`` is the sum of ratings times ten, ``n`` the count, so
    ``avg < b`` becomes ``rate_tenths_sum < 10*b*n``; no rounding of the
    average can move a courier across a tier edge.
    """
    expr = F.lit(len(COURIER_TIERS) - 1)
    for i in range(len(COURIER_TIERS) - 2, -1, -1):
        bound = int(COURIER_TIERS[i][0] * 10)
        expr = F.when(rate_tenths_sum < F.lit(bound) * n, F.lit(i)).otherwise(expr)
    return expr


def tier_payout(total: Column, tier: Column) -> Column:
    """``greatest(total * share, floor)`` of the tier; exact decimal."""
    out = None
    for i, (_, share, floor) in enumerate(COURIER_TIERS):
        value = F.greatest(total * dec(share), dec(floor))
        out = F.when(tier == i, value) if out is None else out.when(tier == i, value)
    return out


def tier_share(tier: Column) -> Column:
    out = None
    for i, (_, share, _) in enumerate(COURIER_TIERS):
        out = F.when(tier == i, dec(share)) if out is None else out.when(tier == i, dec(share))
    return out


def tier_floor(tier: Column) -> Column:
    out = None
    for i, (_, _, floor) in enumerate(COURIER_TIERS):
        out = F.when(tier == i, dec(floor)) if out is None else out.when(tier == i, dec(floor))
    return out


def rounded_rating(rate_tenths_sum: Column, n: Column) -> Column:
    """Average rating rounded half up to one place, as ``decimal(2,1)``:
    ``floor((2*S + n) / (2n))`` tenths, with S the sum in tenths."""
    tenths = F.floor((F.lit(2) * rate_tenths_sum + n) / (F.lit(2) * n))
    return (tenths.cast("decimal(3,0)") / dec("10")).cast("decimal(2,1)")
