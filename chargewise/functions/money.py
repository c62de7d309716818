"""Money arithmetic.

Amounts stay exact decimals through every sum and product; the feed's
CHARGEBACK_AMOUNT is cast to double once, at the end, so the value does
not depend on the order in which partial sums were added. Decimals
cannot hold NaN, so the source's NaN-to-zero step reduces to NULL-to-zero.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def rate(amount: Column, share: Decimal) -> Column:
    """abs(amount) x share, exact."""
    return F.abs(amount) * F.lit(share)


def zero_if_missing(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(Decimal(0)))


def to_feed_amount(amount: Column) -> Column:
    return amount.cast("double")
