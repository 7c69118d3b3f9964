"""Market features on bars.

A symbol may have any number of bars. They are numbered once (`number_bars`) and cut into blocks: features that look a fixed number
of bars back or ahead work on blocks with a halo, running ones carry their state from block to block, and the recursion of
an exponential mean is an affine map, so that blocks hand on what it leaves behind. No window spans a symbol.
Bars that are not numbered yet are numbered here, and the number is dropped again; hand in numbered bars to do it once.
Defaults (14, 20, 12/26/9, bands) are choices of this library and are parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.ordering import BLOCK, earlier, in_blocks, numbered, over_blocks, upto

BY = ["symbol"]
AT = "bar_ts"
ROW = "bar_no"


def number_bars(bars: DataFrame, by: list[str] = BY) -> DataFrame:
    """Bars with their number inside the symbol, from 0; one bar per symbol and time."""
    return numbered(bars, by, [F.col(AT)], ROW)


def _on_numbered(bars: DataFrame, by: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return work(bars) if ROW in bars.columns else work(number_bars(bars, by)).drop(ROW)


def _near(bars: DataFrame, by: list[str], before: int, after: int, make: Callable[[DataFrame, list[str]], DataFrame], block: int) -> DataFrame:
    return _on_numbered(bars, by, lambda x: in_blocks(x, by, ROW, before, after, make, block))


def _w(by: list[str]):
    return W.partitionBy(*by).orderBy(ROW)


def _d(name: str) -> Column:
    return F.col(name).cast("double")


def _volatility(bars: DataFrame, by: list[str], n: int) -> DataFrame:
    w = _w(by)
    frame = w.rowsBetween(-n + 1, 0)
    before = F.lag("close").over(w)
    base = bars.withColumn("true_range", F.greatest(
        _d("high") - _d("low"), F.abs(_d("high") - before.cast("double")), F.abs(_d("low") - before.cast("double")),
    )).withColumn("log_return", F.ln(_d("close") / before.cast("double")))
    full = F.count("*").over(frame) == n
    base = base.withColumn("atr", F.when(full, F.avg("true_range").over(frame))).withColumn(
        "realised_vol", F.when(full, F.stddev_samp("log_return").over(frame)))
    return base.withColumn("volatility_falling", (F.col("atr") < F.lag("atr", n).over(w)) & (
        F.col("realised_vol") < F.lag("realised_vol", n).over(w)))


def volatility(bars: DataFrame, n: int = 14, by: list[str] = BY, block: int = BLOCK) -> DataFrame:
    """True range, its n-bar mean, realised volatility, and whether both fell against n bars before."""
    return _near(bars, by, 2 * n, 0, lambda x, keys: _volatility(x, keys, n), block)


def _volume_ratio(bars: DataFrame, by: list[str], short: int, long: int) -> DataFrame:
    w = _w(by)
    full = F.count("*").over(w.rowsBetween(-long + 1, 0)) == long
    ratio = F.avg(_d("volume")).over(w.rowsBetween(-short + 1, 0)) / F.avg(_d("volume")).over(w.rowsBetween(-long + 1, 0))
    fall = F.coalesce(F.col("volume") < F.lag("volume").over(w), F.lit(False))
    return bars.withColumn("volume_ratio", F.when(full, ratio)).withColumn("volume_falling", F.col("volume_ratio") < 1).withColumn("__fall", fall)


def _fall_run(bars: DataFrame, by: list[str], block: int) -> DataFrame:
    """Bars since the last one whose volume did not fall: its number is carried from block to block."""
    held = over_blocks(bars, by, ROW, {"__still": (F.when(~F.col("__fall"), F.col(ROW)), "max")}, {"fall_run": lambda w: F.max("__still").over(upto(w))}, block)
    return held.withColumn("fall_run", F.col(ROW) - F.col("fall_run")).drop("__fall")


def volume_contraction(bars: DataFrame, short: int = 5, long: int = 20, by: list[str] = BY, block: int = BLOCK) -> DataFrame:
    """Short over long mean volume, and the length of the current run of falling volume."""
    def work(x: DataFrame) -> DataFrame:
        return _fall_run(in_blocks(x, by, ROW, long, 0, lambda r, keys: _volume_ratio(r, keys, short, long), block), by, block)

    return _on_numbered(bars, by, work)


#: Blocks of an exponential mean that count for a later one: beyond them the product of the decays is below the smallest double.
HANDED_ON = 16


def ema(df: DataFrame, values: dict[str, tuple[str, int]], by: list[str] = BY, row: str = ROW) -> DataFrame:
    """Exponential means `values` (name: column, n) with weight 2 / (n + 1), started at the first value; needs a 0-based gapless row number.

    Over a block of m rows the recursion is the affine map x -> d^m x + b, d being the decay and b the weighted sum of the block. Blocks have 24 times
    the largest n rows, so d^m is below 1e-20. Each block sends its b to those after it, which compose the maps: one row a block goes around.
    Means whose decay over such a block is no number any more (n much smaller than the largest) get blocks of their own.
    """
    small = {name: v for name, v in values.items() if (1.0 - 2.0 / (v[1] + 1)) ** (24 * max(n for _, n in values.values())) < 1e-250}
    if len(small) == len(values):  # n = 1 only: the value itself
        return df.withColumns({name: _d(column) for name, (column, _) in values.items()})
    if small:
        return ema(ema(df, {k: v for k, v in values.items() if k not in small}, by, row), small, by, row)
    size = 24 * max(n for _, n in values.values())
    chunk, i = F.floor(F.col(row) / size), F.col(row) % size
    decay = {name: 1.0 - 2.0 / (n + 1) for name, (_, n) in values.items()}

    def share(name: str) -> Column:
        return F.when(F.col(row) == 0, _d(values[name][0])).otherwise(_d(values[name][0]) * (1.0 - decay[name]))

    full = df.withColumn("__chunk", chunk).groupBy(*by, "__chunk").agg(
        *[F.sum(share(name) * F.pow(F.lit(d), size - 1 - i)).alias(f"__{name}") for name, d in decay.items()])
    sent = full.select(*by, "__chunk", F.explode(F.sequence(F.lit(1), F.lit(HANDED_ON))).alias("__far"), *[f"__{name}" for name in values])
    seeds = sent.withColumn("__chunk", F.col("__chunk") + F.col("__far")).groupBy(*by, "__chunk").agg(
        *[F.sum(F.col(f"__{name}") * F.pow(F.lit(d), F.lit(size) * (F.col("__far") - 1))).alias(f"__{name}") for name, d in decay.items()])
    inside = W.partitionBy(*by, "__chunk").orderBy(row).rowsBetween(W.unboundedPreceding, 0)
    local = df.withColumn("__chunk", chunk).withColumns({name: F.pow(F.lit(d), i) * F.sum(share(name) * F.pow(F.lit(d), -i)).over(inside) for name, d in decay.items()})
    return local.join(seeds, [*by, "__chunk"], "left").withColumns(
        {name: F.col(name) + F.pow(F.lit(d), i + 1) * F.coalesce(f"__{name}", F.lit(0.0)) for name, d in decay.items()}
    ).drop("__chunk", *[f"__{name}" for name in values])


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, by: list[str] = BY) -> DataFrame:
    def work(x: DataFrame) -> DataFrame:
        both = ema(x, {"ema_fast": ("close", fast), "ema_slow": ("close", slow)}, by)
        return ema(both.withColumn("macd", F.col("ema_fast") - F.col("ema_slow")), {"macd_signal": ("macd", signal)}, by)

    return _on_numbered(bars, by, work)


def macd_near_zero(atr: str = "atr", band: float = 0.25) -> Column:
    """Distance of MACD from zero within a fraction of ATR."""
    return F.abs("macd") <= F.col(atr) * band


def _body_ratio(bars: DataFrame, by: list[str], n: int) -> DataFrame:
    span = _d("high") - _d("low")
    base = bars.withColumn("body_ratio", F.when(span > 0, F.abs(_d("close") - _d("open")) / span))
    mean = F.avg("body_ratio").over(_w(by).rowsBetween(-n, -1))
    return base.withColumn("body_mean", mean).withColumn("body_shrinking", F.col("body_ratio") < F.col("body_mean"))


def body_ratio(bars: DataFrame, n: int = 14, by: list[str] = BY, block: int = BLOCK) -> DataFrame:
    """Candle body over range against the mean of the n bars before."""
    return _near(bars, by, n, 0, lambda x, keys: _body_ratio(x, keys, n), block)


def _oi_change(oi: DataFrame, by: list[str], n: int, value: str) -> DataFrame:
    w = _w(by)
    step = F.col(value) - F.lag(value).over(w)
    base = oi.withColumn("oi_step", step).withColumn("oi_change", F.col(value) - F.lag(value, n).over(w))
    turned = (F.col("oi_step") > 0) & (F.lag("oi_step").over(w) < 0)
    return base.withColumn("oi_turned_up", turned).withColumn("oi_contracting", F.col("oi_change") <= 0)


def oi_change(oi: DataFrame, n: int = 5, by: list[str] = BY, value: str = "oi", block: int = BLOCK) -> DataFrame:
    """Open-interest change over n bars and the turn from falling to rising."""
    return _near(oi, by, max(n, 2), 0, lambda x, keys: _oi_change(x, keys, n, value), block)


def _range_break(bars: DataFrame, by: list[str], n: int, confirm: int) -> DataFrame:
    w = _w(by)
    trailing, following = w.rowsBetween(-n, -1), w.rowsBetween(1, confirm)
    full = F.count("*").over(trailing) == n
    base = bars.withColumn("range_high", F.when(full, F.max("high").over(trailing))).withColumn(
        "range_low", F.when(full, F.min("low").over(trailing)))
    base = base.withColumn("break_side", F.when(F.col("close") > F.col("range_high"), "up").when(
        F.col("close") < F.col("range_low"), "down"))
    back = F.when(F.col("break_side") == "up", F.min("close").over(following) <= F.col("range_high")).when(
        F.col("break_side") == "down", F.max("close").over(following) >= F.col("range_low"))
    return base.withColumn("false_break", back)


def range_break(bars: DataFrame, n: int = 20, confirm: int = 3, by: list[str] = BY, block: int = BLOCK) -> DataFrame:
    """Close beyond the trailing range; `false_break` when a close of the next bars is back inside."""
    return _near(bars, by, n, confirm, lambda x, keys: _range_break(x, keys, n, confirm), block)


def session_range_break(bars: DataFrame, session: str, day: str, tested: str = "europe", prior: str = "asia", by: list[str] = BY) -> DataFrame:
    """Bars of session `tested` whose close lies beyond the range of session `prior` of the same session day.

    `false_break` when a later close of the session is back inside, null on its last bar. A window holds the bars of one session.
    """
    of_day = [*by, day]
    ranges = bars.filter(F.col(session) == prior).groupBy(*of_day).agg(F.max("high").alias("range_high"), F.min("low").alias("range_low"))
    later = W.partitionBy(*of_day).orderBy(AT).rowsBetween(1, W.unboundedFollowing)
    rows = bars.filter(F.col(session) == tested).join(ranges, of_day, "left").withColumn(
        "break_side", F.when(F.col("close") > F.col("range_high"), "up").when(F.col("close") < F.col("range_low"), "down"))
    back = F.when(F.col("break_side") == "up", F.min("close").over(later) <= F.col("range_high")).when(
        F.col("break_side") == "down", F.max("close").over(later) >= F.col("range_low"))
    return rows.withColumn("false_break", back)


def _retest_hold(bars: DataFrame, by: list[str], n: int) -> DataFrame:
    following = _w(by).rowsBetween(1, n)
    held = F.when((F.col("break_side") == "up") & (F.count("*").over(following) == n),
                  F.min("low").over(following) > F.col("range_high"))
    return bars.withColumn("retest_held", held)


def retest_hold(bars: DataFrame, n: int = 3, by: list[str] = BY, block: int = BLOCK) -> DataFrame:
    """After an upward break the lows of the next n bars stay above the level (null when not yet known)."""
    return _near(bars, by, 0, n, lambda x, keys: _retest_hold(x, keys, n), block)


def bounded_features(bars: DataFrame, n: int = 14, short: int = 5, long: int = 20, trailing: int = 20, confirm: int = 3, held: int = 3,
                     by: list[str] = BY, block: int = BLOCK) -> DataFrame:
    """`volatility`, `volume_contraction`, `body_ratio`, `range_break` and `retest_hold` in one pass over the blocks of numbered bars."""
    def make(x: DataFrame, keys: list[str]) -> DataFrame:
        x = _body_ratio(_volume_ratio(_volatility(x, keys, n), keys, short, long), keys, n)
        return _retest_hold(_range_break(x, keys, trailing, confirm), keys, held)

    return _fall_run(in_blocks(bars, by, ROW, max(2 * n, long, trailing), max(confirm, held), make, block), by, block)


def first_release(bars: DataFrame, compressed: str = "compressed", qualified: str = "qualified", by: list[str] = BY, block: int = BLOCK) -> DataFrame:
    """The first qualified bar after each run of compressed bars; `compression_run` numbers the runs.

    Three numbers are carried: how many runs have begun, where the last one did, and where the last qualified bar was.
    """
    def work(x: DataFrame) -> DataFrame:
        now = F.coalesce(F.col(compressed), F.lit(False))
        seen = over_blocks(x, by, ROW, {"__now": (now, "last")}, {"__was": lambda w: F.lag("__now").over(w)}, block)
        start = now & ~F.coalesce("__was", F.lit(False))
        ready = ~now & F.coalesce(F.col(qualified), F.lit(False))
        state = {"__start": (start.cast("bigint"), "sum"), "__begun": (F.when(start, F.col(ROW)), "max"), "__ready": (F.when(ready, F.col(ROW)), "max")}
        runs = over_blocks(seen, by, ROW, state, {
            "compression_run": lambda w: F.sum("__start").over(upto(w)), "__begun": lambda w: F.max("__begun").over(upto(w)),
            "__before": lambda w: F.max("__ready").over(earlier(w))}, block)
        first = ready & F.coalesce((F.col("__begun") > F.coalesce("__before", F.lit(-1))), F.lit(False))
        return runs.withColumn("is_first_release", first).drop("__was", "__begun", "__before")

    return _on_numbered(bars, by, work)
