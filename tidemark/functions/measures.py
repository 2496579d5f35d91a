"""Money, keys of unknown members, soft deletes and discount arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
UNKNOWN = "-1"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def money(column: Column | str) -> Column:
    return _col(column).cast(MONEY)


def safe_ratio(part: Column | str, whole: Column | str) -> Column:
    """part / whole as double; null where the whole is zero."""
    return F.try_divide(_col(part).cast("double"), _col(whole).cast("double"))


def or_unknown(key: Column | str) -> Column:
    """A dimension key for a fact row; '-1' where no member was found."""
    return F.coalesce(_col(key).try_cast("string"), F.lit(UNKNOWN))


def signed(amount: Column | str, transaction_type: Column | str = "transaction_type") -> Column:
    """Positive for purchases, negative for returns, null for any other type."""
    kind = _col(transaction_type)
    return F.when(kind == "Purchase", _col(amount)).when(kind == "Return", -_col(amount))


def removal(deleted: str = "date_deleted", removed: str = "date_removed") -> tuple[Column, Column]:
    """When a row ended, and why. A deletion outranks a removal."""
    return (
        F.coalesce(F.col(deleted), F.col(removed)).alias("removed_at"),
        F.when(F.col(deleted).isNotNull(), F.lit("deleted"))
        .when(F.col(removed).isNotNull(), F.lit("removed"))
        .alias("removal_reason"),
    )


def discount_level(transaction_id: str = "transaction_id", line_id: str = "transaction_line_id") -> Column:
    return F.when(F.col(transaction_id).isNotNull(), F.lit("Order")).when(
        F.col(line_id).isNotNull(), F.lit("Line Item")
    )


def _not_negative(column: Column) -> Column:
    """Floor at zero; null stays null."""
    return F.when(column < 0, F.lit(0).cast("decimal(38,12)")).otherwise(column)


def discounted_price(pool: Column | str, price: Column | str, value: Column | str) -> Column:
    """Unit price after a line discount, never below zero; null for an unknown pool."""
    pool, price, value = _col(pool), _col(price), _col(value)
    share = price * (F.lit(1) - value / F.lit(100))
    after = (
        F.when(pool == "FIXED", value.cast("decimal(38,12)"))
        .when(pool == "FLAT", (price - value).cast("decimal(38,12)"))
        .when(pool.isin("PERCENT", "BOGO"), share.cast("decimal(38,12)"))
    )
    return _not_negative(after)


def discounted_units(pool: Column | str, quantity: Column | str) -> Column:
    """Units a discount applies to: every second one of a buy-one-get-one pool."""
    pool, quantity = _col(pool), _col(quantity)
    half = F.floor(quantity.cast("int") / F.lit(2)).cast("int")
    return F.when(pool == "BOGO", half).otherwise(quantity.cast("int"))


def discount_amount(
    pool: Column | str, price: Column | str, value: Column | str, quantity: Column | str
) -> Column:
    """Amount taken off one line; 0 for an unknown pool, negative where a fixed price is above the unit price."""
    off = _col(price).cast("decimal(38,12)") - discounted_price(pool, price, value)
    return F.coalesce(off * discounted_units(pool, quantity), F.lit(0)).cast(MONEY)
