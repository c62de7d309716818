"""Text helpers: feed comments and the exemption flag."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chargewise import params as P


def comment_702(tracking: Column) -> Column:
    """A missing tracking number leaves an empty slot, not a NULL comment."""
    return F.concat(F.lit(P.COMMENT_702_PREFIX),
                    F.coalesce(tracking.cast("string"), F.lit("")),
                    F.lit(P.COMMENT_702_SUFFIX))


def comment_706(pro_number: Column) -> Column:
    """NULL in, NULL out: a missing PRO number gives a NULL comment."""
    return F.concat(F.lit(P.COMMENT_706_PREFIX), pro_number.cast("string"),
                    F.lit(P.COMMENT_706_SUFFIX))


def comment_710(order_date: Column, cancel_date: Column) -> Column:
    """'Order Date: <d>;Cancellation Date: <d>;' with ISO dates; NULL if a date is NULL."""
    return F.concat(F.lit(P.COMMENT_710_ORDER), order_date.cast("string"), F.lit(";"),
                    F.lit(P.COMMENT_710_CANCEL), cancel_date.cast("string"), F.lit(";"))


def any_contains(text: Column, fragments: Iterable[str]) -> Column:
    """True if `text` contains any fragment literally (no LIKE wildcards)."""
    result = F.lit(False)
    for fragment in fragments:
        result = result | text.contains(fragment)
    return result


def flag_yn(condition: Column) -> Column:
    """'Y' where the condition is true, 'N' where it is false or NULL."""
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def exemption_flag(code: Column, text: Column, codes: Iterable[str],
                   fragments: Iterable[str]) -> Column:
    """'Y' if the note code is listed or the note text holds a listed fragment."""
    return flag_yn(code.isin(list(codes)) | any_contains(text, fragments))
