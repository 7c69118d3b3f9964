"""Ordered work (lag, running totals, row numbers, as-of) when one key may hold most of the rows.

A plain window sorts a whole key in one task. Here rows are range-partitioned by (key, order): Spark samples the keys and
cuts the rows into parts of about equal size, through the middle of a large key or of a crowd of equal order values alike.
A part is a chunk and each key of a chunk a window partition. What earlier chunks of a key leave behind (a count, a
maximum, the last row) enters as one *seed* row at the head of the chunk. A chunk is contiguous, so only its first key
can have begun earlier: the summaries that seeds are made of are two rows a chunk at most, whatever the rows.

The number of parts is `spark.sql.shuffle.partitions`, the setting of every other shuffle; adaptive execution merges small
ones. The cut rows are written once to the shared folder, so that summaries and windows see the same chunks after a lost
executor too, and the input is evaluated twice (for the sample and for the write) and never again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plumbline.session import materialise


def micros(ts: str | Column) -> Column:
    """Microseconds since the epoch, as whole numbers: they can be shifted and negated."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def cut(df: DataFrame, by: list[str], order: list[str], name: str = "ordered") -> DataFrame:
    """Range-partition by (`by`, `order`) and store the rows with `__chunk`, which never falls along that order.

    Rows equal in both go on by a digest of the whole row, so that a crowd of ties is cut as well; only copies equal in
    every column stay together. Keys keep their types and are compared as what they are, nulls first.
    """
    digested = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    ranged = df.withColumn("__tie", F.xxhash64(*digested)).repartitionByRange(*by, *order, "__tie")
    return materialise(ranged.drop("__tie").withColumn("__chunk", F.spark_partition_id()), name)


def _spanning(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the first and the last key of each chunk: no other key can reach into another chunk."""
    if not by:
        return rows
    key = F.struct(*by)
    edges = rows.groupBy("__chunk").agg(F.min(key).alias("__first"), F.max(key).alias("__last"))
    return rows.join(edges, "__chunk").filter(key.eqNullSafe(F.col("__first")) | key.eqNullSafe(F.col("__last"))).drop("__first", "__last")


# How the value of a chunk is summed up, and how summaries of earlier chunks are put together.
_SUMMARY = {
    "sum": lambda name, order: F.sum(name),
    "max": lambda name, order: F.max(name),
    "min": lambda name, order: F.min(name),
    "last": lambda name, order: F.max_by(name, F.struct(*order)),
}
_PREFIX = {"sum": F.sum, "max": F.max, "min": F.min, "last": F.last}


def over_order(
    df: DataFrame,
    by: list[str],
    order: list[Column],
    state: dict[str, tuple[Column, str]],
    outputs: dict[str, Callable[[WindowSpec], Column]],
    whole: bool = False,
) -> DataFrame:
    """Window functions over `by` in `order` whose result needs only `state` of the rows before.

    `state` names a row value and how it is carried (`sum`, `max`, `min`, `last`);
    `outputs` build columns from the state on a window that already holds the seed.
    `order` must be total and ascending (negate numbers for descending); nulls come first. `whole` leaves keys uncut,
    for rows already reduced to few per key (bars, days, members).
    """
    keys = [f"__o{i}" for i in range(len(order))]
    rows = df.select(
        "*", *[c.alias(k) for c, k in zip(order, keys)],
        *[value.alias(name) for name, (value, _) in state.items()],
    )
    if whole:  # a table bucketed by `by` and sorted in order needs no exchange and no sort
        plain = W.partitionBy(*by).orderBy(*keys)
        return rows.select(*df.columns, *[make(plain).alias(name) for name, make in outputs.items()])
    rows = cut(rows, by, keys)
    return _carried(rows, _spanning(rows, by), by, keys, state, outputs, df.columns)


def _carried(rows: DataFrame, edges: DataFrame, by: list[str], keys: list[str], state: dict[str, tuple[Column, str]],
             outputs: dict[str, Callable[[WindowSpec], Column]], columns: list[str]) -> DataFrame:
    """`outputs` over the chunks of `rows`, each begun by a seed made of the summaries of the chunks before; `edges` are the rows to sum up."""
    summary = edges.groupBy(*by, "__chunk").agg(*[_SUMMARY[kind](name, keys).alias(name) for name, (_, kind) in state.items()])
    before = W.partitionBy(*by).orderBy("__chunk")
    earlier = before.rowsBetween(W.unboundedPreceding, -1)
    seeds = summary.select(
        *by, "__chunk", F.row_number().over(before).alias("__nth"),
        *[_PREFIX[kind](name).over(earlier).alias(name) for name, (_, kind) in state.items()],
    ).filter("__nth > 1").drop("__nth").withColumn("__row", F.lit(0))
    window = W.partitionBy(*by, "__chunk").orderBy("__row", *keys)
    return (
        rows.withColumn("__row", F.lit(1)).unionByName(seeds, allowMissingColumns=True)
        .select(*columns, "__row", *[make(window).alias(name) for name, make in outputs.items()])
        .filter("__row = 1").drop("__row")
    )


def upto(window: WindowSpec) -> WindowSpec:
    """Frame from the seed to the current row."""
    return window.rowsBetween(W.unboundedPreceding, W.currentRow)


def earlier(window: WindowSpec) -> WindowSpec:
    """Frame from the seed to the row before the current one."""
    return window.rowsBetween(W.unboundedPreceding, -1)


def prior(df: DataFrame, by: list[str], order: list[Column], cols: list[str], name: str = "prior",
          whole: bool = False) -> DataFrame:
    """The row before, as struct `name` of `cols` (null on the first row of a key)."""
    return over_order(
        df, by, order, {"__prior": (F.struct(*cols), "last")},
        {name: lambda w: F.lag("__prior").over(w)}, whole,
    )


def ordinal(df: DataFrame, by: list[str], order: list[Column], name: str = "ordinal",
            whole: bool = False) -> DataFrame:
    """Exact row number of each row inside its key (the whole table when `by` is empty)."""
    return over_order(
        df, by, order, {"__one": (F.lit(1).cast("bigint"), "sum")},
        {name: lambda w: F.sum("__one").over(upto(w))}, whole,
    )


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join rows, whose keys may be skewed, to a side of one row per key (`inner`, `left`, `left_semi`, `left_anti`).

    Nothing is measured or hinted: the optimizer broadcasts what it sees to be small, and where it does not, adaptive execution
    splits the large partitions of `left`, one of a single key too. Key columns of `right` take the types of `left`.
    """
    kinds = {f.name: f.dataType for f in left.schema}
    right = right.select(*[F.col(c).cast(kinds[c]).alias(c) if c in on else F.col(c) for c in right.columns])
    return left.join(right, on, how)


def place_all(df: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """Number all rows of a table in the order of keys of any type, each compared as what it is."""
    return ordinal(df, [], order, name)


# ---- numbered rows: blocks of a fixed number of rows ----

#: Rows of a key that one block holds.
BLOCK = 1 << 16


def numbered(df: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """Rows with their number inside the key (0, 1, 2, ...), in an order that should be total.

    Rows are range-partitioned, sorted in their partition and stored with their place in it; per partition and key one row says how many of the key
    came before. Numbers do not change when they are read again, and blocks follow from numbers, so nothing is sampled or stored a second time.
    """
    keys = [f"__o{i}" for i in range(len(order))]
    rows = df.select("*", *[c.alias(k) for c, k in zip(order, keys)])
    ranged = rows.repartitionByRange(*by, *keys).sortWithinPartitions(*by, *keys)
    # The upper bits of the running id are the partition, the lower 33 the place in it.
    placed = materialise(ranged.drop(*keys).withColumn("__id", F.monotonically_increasing_id()), name).withColumn(
        "__chunk", F.shiftright("__id", 33)).withColumn("__at", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
    held = placed.groupBy(*by, "__chunk").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.partitionBy(*by).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = materialise(held.select(*[F.col(c).alias(f"__{c}") for c in by], "__chunk", (before - F.col("__first")).alias("__start")), f"{name}-starts")
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    joined = placed.withColumnRenamed("__chunk", "__part").join(starts, [*same, F.col("__part") == F.col("__chunk")])
    return joined.select(*df.columns, (F.col("__at") + F.col("__start")).alias(name))


def in_blocks(df: DataFrame, by: list[str], row: str, before: int, after: int,
              make: Callable[[DataFrame, list[str]], DataFrame], size: int = BLOCK) -> DataFrame:
    """Window functions that look at most `before` rows back and `after` rows ahead, on numbered rows of keys of any size.

    A key is cut into blocks of `size` rows; the rows at the edges of a block are copied into its neighbour as a halo.
    `make(rows, keys)` adds columns with windows over `keys`, ordered by `row`; functions built upon one another need the sum of what each looks back.
    """
    if max(before, after) > size:
        raise ValueError("a block must be as long as its halo")
    block, at = F.floor(F.col(row) / size), F.col(row) % size

    def copy(shift: int, wanted: Column | None) -> Column:
        one = F.struct((block + shift).alias("__block"), F.lit(shift == 0).alias("__own"))
        return one if wanted is None else F.when(wanted, one)

    copies = [copy(0, None), *([copy(1, at >= size - before)] if before else []), *([copy(-1, (at < after) & (block > 0))] if after else [])]
    spread = df.select("*", F.inline(F.array_compact(F.array(*copies))))
    return make(spread, [*by, "__block"]).filter("__own").drop("__block", "__own")


def over_blocks(df: DataFrame, by: list[str], row: str, state: dict[str, tuple[Column, str]],
                outputs: dict[str, Callable[[WindowSpec], Column]], size: int = BLOCK) -> DataFrame:
    """`over_order` for numbered rows: what earlier blocks leave behind enters a block as a seed row. Only one row per block is ever
    brought together by key; numbers may have gaps."""
    rows = df.select("*", F.col(row).alias("__o0"), F.floor(F.col(row) / size).alias("__chunk"), *[value.alias(name) for name, (value, _) in state.items()])
    return _carried(rows, rows, by, ["__o0"], state, outputs, df.columns)
