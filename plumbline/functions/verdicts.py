"""Verdict ladders. Unknown input never yields a better verdict than known bad input would allow."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.contracts import IDENTITY_FIELDS, PASSIVE_REASON, PERMISSION_GATES, STATUSES


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _known(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit(False))


def count_true(flags: list[str | Column]) -> Column:
    return reduce(lambda a, b: a + b, [_known(f).cast("int") for f in flags])


def compression_state(volume_falling: Column, volatility_falling: Column, body_shrinking: Column,
                      macd_near_zero: Column, oi_contracting: Column, needed: int = 4) -> Column:
    """struct(met, compressed): how many of the five signs of compression hold."""
    met = count_true([volume_falling, volatility_falling, body_shrinking, macd_near_zero, oi_contracting])
    return F.struct(met.alias("met"), (met >= needed).alias("compressed"))


def release_direction(break_up: Column, break_down: Column, volume_up: Column, taker_buy_up: Column,
                      taker_sell_up: Column, oi_turned_up: Column, oi_up: Column, retest_held: Column) -> Column:
    """`long` or `short` only when every listed condition is known to hold."""
    long = _known(break_up) & _known(volume_up) & _known(taker_buy_up) & _known(oi_turned_up) & _known(retest_held)
    short = _known(break_down) & _known(volume_up) & _known(taker_sell_up) & _known(oi_up)
    return F.when(long & ~short, "long").when(short & ~long, "short").otherwise("none")


def risk_release(fast_fall: Column, oi_falling: Column, near_demand: Column, seller_exhausted: Column) -> Column:
    return _known(fast_fall) & _known(oi_falling) & _known(near_demand) & _known(seller_exhausted)


def permission(gates: dict[str, Column], order: list[str] = PERMISSION_GATES) -> Column:
    """struct(allowed, reason): gates are asked in order, the first that does not pass is the reason."""
    reason = F.lit(None).cast("string")
    for name in reversed(order):
        passed = _known(gates[name]) if name in gates else F.lit(False)
        reason = F.when(~passed, F.lit(name)).otherwise(reason)
    return F.struct(reason.isNull().alias("allowed"), reason.alias("reason"))


def admission_layers(data_gate: Column, research: Column, trading: Column, real_money: Column) -> Column:
    """Four independent states; missing or unknown values are `closed`, no layer raises another."""
    def state(c: Column) -> Column:
        return F.when(F.coalesce(c, F.lit("")) == "open", "open").otherwise("closed")

    return F.struct(state(data_gate).alias("data_gate"), state(research).alias("research"),
                    state(trading).alias("trading"), state(real_money).alias("real_money"))


def fill_verdict(kind: str | Column, valid_book: str | Column) -> Column:
    """struct(terminal_state, reason) of a scenario."""
    passive = _col(kind).startswith("passive")
    state = F.when(passive, "canceled").when(_known(valid_book), "filled").otherwise("unknown")
    reason = F.when(passive, PASSIVE_REASON).when(~_known(valid_book), "BOOK_INVALID")
    return F.struct(state.alias("terminal_state"), reason.alias("reason"))


def availability(hard_failure: Column, evidence_missing: Column, minor_gap: Column, fallback: Column,
                 upstream_done: Column) -> Column:
    """unavailable / undetermined / limited / available, asked in this fixed order."""
    return (
        F.when(_known(hard_failure), "unavailable")
        .when(F.coalesce(evidence_missing, F.lit(True)), "undetermined")
        .when(_known(minor_gap), F.when(_known(fallback), "limited").otherwise("undetermined"))
        .when(_known(upstream_done), "available")
        .otherwise("undetermined")
    )


def identity_verdict(fields: dict[str, Column], conflict: Column, names: list[str] = IDENTITY_FIELDS) -> Column:
    """An explicit conflict rejects; otherwise all fields must be bound, else undetermined."""
    bound = reduce(lambda a, b: a & b, [fields[n].isNotNull() if n in fields else F.lit(False) for n in names])
    return F.when(_known(conflict), "rejected").when(bound, "proven").otherwise("undetermined")


def status_rank(status: str | Column, order: list[str] = STATUSES) -> Column:
    """Position in the worst-first order; an unlisted status ranks as the worst."""
    ladder = F.lit(0)
    for rank, name in reversed(list(enumerate(order))):
        ladder = F.when(_col(status) == name, rank).otherwise(ladder)
    return ladder
