"""Order-book measures over arrays of struct(price, qty)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ordered(levels: Column, descending: bool) -> Column:
    """Each level against the next one: strictly monotone prices."""
    last = F.greatest(F.size(levels) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(levels, 1, last), F.slice(levels, 2, last),
        lambda a, b: (a["price"] > b["price"]) if descending else (a["price"] < b["price"]),
    )
    return F.forall(pairs, lambda ok: ok)


def book_valid(bids: str | Column, asks: str | Column) -> Column:
    """Bids fall, asks rise, no negative quantity, best bid below best ask; an empty side is not valid."""
    b, a = _col(bids), _col(asks)
    filled = (F.size(b) > 0) & (F.size(a) > 0)
    quantities = F.forall(b, lambda x: x["qty"] >= 0) & F.forall(a, lambda x: x["qty"] >= 0)
    checks = _ordered(b, True) & _ordered(a, False) & quantities & (F.get(b, F.lit(0))["price"] < F.get(a, F.lit(0))["price"])
    return F.coalesce(F.when(filled, checks), F.lit(False))


def spread(bids: str | Column, asks: str | Column) -> Column:
    return F.get(_col(asks), F.lit(0))["price"] - F.get(_col(bids), F.lit(0))["price"]


def _walk(levels: Column, notional: Column) -> Column:
    """Take levels in order until `notional` is filled: struct(left, qty)."""
    start = F.struct(notional.cast("double").alias("left"), F.lit(0.0).alias("qty"))

    def step(acc: Column, level: Column) -> Column:
        price, qty = level["price"].cast("double"), level["qty"].cast("double")
        taken = F.least(acc["left"], price * qty)
        return F.struct((acc["left"] - taken).alias("left"), (acc["qty"] + taken / price).alias("qty"))

    return F.aggregate(levels, start, step)


def depth(levels: str | Column, notional: float | Column) -> Column:
    """Quantity obtained for a notional; null when the book is too thin to fill it."""
    target = F.lit(notional) if isinstance(notional, (int, float)) else notional
    walked = _walk(_col(levels), target)
    return F.when(walked["left"] <= 1e-9, walked["qty"])


def impact(levels: str | Column, notional: float | Column, mid: Column) -> Column:
    """Average fill price against the mid, over the mid; null when not fillable."""
    target = F.lit(notional) if isinstance(notional, (int, float)) else notional
    average = target.cast("double") / depth(levels, target)
    return (average - mid.cast("double")) / mid.cast("double")
