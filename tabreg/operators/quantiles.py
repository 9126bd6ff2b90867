"""Quantiles: exact by radix selection, approximate by one sketch pass.

An exact percentile aggregate keeps every value in one buffer and a global sort
moves every value, so neither holds for columns of 10^12 values. Here a double
is read as a 64-bit integer of the same order. A pass counts the values by their next
sixteen bits, or by all that are left where a searched range holds no more values than that has digits, for all columns and
wanted ranks together; the digit that holds a rank is
found by a running sum over at most 65,536 counts, and the next pass looks at
the values below that digit only. Four passes find any rank, and a digit that holds a
single value (one price in a third of the rows) ends its search at once. Counts
are combined before the shuffle, so a pass moves counts and never values.

Counts can be taken by parts of the table as well: what all parts but one would give
is the difference of two counts, so the quantiles outside each of k folds come
out of the same passes.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources import stage

DIGIT_BITS = 16
LARGEST_EXPONENT, BIAS, FRACTION_BITS = 1023, 1023, 52


def ordered_bits(value: Column) -> Column:
    """A long that orders as the double does: exponent and fraction of its magnitude, negated for negative values.

    Scaling by a power of two is exact. NULL gives NULL; NaN has no place.
    """
    size = F.abs(value)
    power = F.least(F.floor(F.log2(size)), F.lit(LARGEST_EXPONENT).cast("long"))
    unit = F.pow(F.lit(2.0), power)  # the logarithm may be off by one next to a power of two
    above, below = size >= 2 * unit, size < unit
    exponent = power + F.when(above, 1).when(below, -1).otherwise(0)
    unit = F.when(above, 2 * unit).when(below, unit / 2).otherwise(unit)
    fraction = (size / unit * float(1 << FRACTION_BITS)).cast("long")
    bits = (exponent + (BIAS - 1)) * (1 << FRACTION_BITS) + fraction
    bits = (
        F.when(size == 0, F.lit(0).cast("long"))
        .when(size == math.inf, F.lit(2047 << FRACTION_BITS))
        .when(size < 2.0**-1022, (size * 2.0**537 * 2.0**537).cast("long"))
        .otherwise(bits)
    )
    return F.when(value < 0, -bits).otherwise(bits)


def double_of(bits: int) -> float:
    """The double whose ``ordered_bits`` are ``bits``."""
    value = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -value if bits < 0 else value


@dataclass
class _Target:
    """One wanted rank: ``rank`` counts from 1 among the values whose bits begin with ``prefix``, outside part ``without``."""

    column: int
    without: int | None
    slot: int
    total: int
    rank: int
    prefix: int
    held: int  # values with this prefix in the whole table
    value: float | None = None


def exact_quantiles(
    df: DataFrame,
    columns: str | Sequence[str],
    probabilities: Sequence[float],
    interpolate: bool = False,
    cache: bool = True,
) -> dict[str, list[float | None]]:
    """Exact quantiles of numeric columns over their non-null, non-NaN values.

    Discrete by default: the value of rank ceil(p * n). With ``interpolate``
    the two neighbours of position p * (n - 1) are mixed linearly. A column
    without values gives None. The wanted columns are stored between passes;
    turn ``cache`` off when ``df`` is a plain scan of a stored table.
    """
    return quantiles_without_parts(df, columns, probabilities, interpolate=interpolate, cache=cache)[None]


def quantiles_without_parts(
    df: DataFrame,
    columns: str | Sequence[str],
    probabilities: Sequence[float],
    part_col: str | None = None,
    parts: Sequence[int] = (),
    interpolate: bool = False,
    cache: bool = True,
) -> dict[int | None, dict[str, list[float | None]]]:
    """``exact_quantiles`` of all rows (key None), and for each of ``parts`` of the rows outside that part.

    All of them come out of the same four passes at most.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    part = F.col(part_col).cast("int") if part_col else F.lit(None).cast("int")
    values = df.select(part.alias("part"), *[ordered_bits(_clean(n)).alias(f"v{i}") for i, n in enumerate(names)])
    if cache:
        values = stage(values, "quantile-values")
    slots = [(p, side) for p in probabilities for side in ((0, 1) if interpolate else (0,))]
    targets = _select(values, len(names), [int(p) for p in parts], slots, interpolate)

    def answer(without: int | None, column: int, at: int) -> float | None:
        width = 2 if interpolate else 1
        found = [targets.get((column, without, at * width + side)) for side in range(width)]
        if found[0] is None:
            return None
        if not interpolate:
            return found[0].value
        position = probabilities[at] * (found[0].total - 1)
        low, high = found[0].value, found[1].value
        return low if low == high else low + (high - low) * (position - math.floor(position))

    return {
        without: {name: [answer(without, i, at) for at in range(len(probabilities))] for i, name in enumerate(names)}
        for without in (None, *map(int, parts))
    }


def approx_quantiles(
    df: DataFrame,
    columns: str | Sequence[str],
    probabilities: Sequence[float],
    relative_error: float = 0.01,
) -> dict[str, list[float | None]]:
    """Quantiles within ``relative_error`` of the wanted rank, one pass for all columns."""
    names = [columns] if isinstance(columns, str) else list(columns)
    accuracy = math.ceil(1.0 / relative_error)
    row = df.agg(
        *[
            F.percentile_approx(_clean(n), list(probabilities), accuracy).alias(f"v{i}")
            for i, n in enumerate(names)
        ]
    ).first()
    return {n: list(row[f"v{i}"] or [None] * len(probabilities)) for i, n in enumerate(names)}


def quantiles(
    df: DataFrame,
    columns: str | Sequence[str],
    probabilities: Sequence[float],
    relative_error: float = 0.0,
    cache: bool = True,
) -> dict[str, list[float | None]]:
    """Exact for ``relative_error`` 0, else approximate."""
    if relative_error > 0:
        return approx_quantiles(df, columns, probabilities, relative_error)
    return exact_quantiles(df, columns, probabilities, cache=cache)


def _clean(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def _select(values: DataFrame, n_columns: int, parts: list[int], slots: list[tuple[float, int]], interpolate: bool) -> dict:
    """(column, without, slot) -> target with its value; columns without values have none."""
    long = _paired(values, n_columns)
    total = F.col("total").cast("double")

    def rank(p: float, side: int) -> Column:
        if not interpolate:
            return F.greatest(F.lit(1).cast("long"), F.least(F.col("total"), F.ceil(F.lit(p) * total)))
        position = F.lit(p) * (total - 1)
        return (F.ceil(position) if side else F.floor(position)) + 1

    ranks = F.array(*[F.struct(F.lit(s).alias("slot"), rank(*slot).alias("rank")) for s, slot in enumerate(slots)])
    first = _counts(long, 64 - DIGIT_BITS, parts)
    every = Window.partitionBy("column", "without")
    first = first.withColumns({"total": F.sum("n").over(every), "upto": F.sum("n").over(every.orderBy("digit"))})
    targets: dict[tuple, _Target] = {}
    open_targets = _found(first.withColumn("ranks", ranks), targets)
    shift = 64 - DIGIT_BITS
    while open_targets:
        few = all(t.held <= 1 << DIGIT_BITS for t in open_targets)
        below = 0 if few else shift - DIGIT_BITS
        open_targets = _next_digit(values.sparkSession, long, open_targets, shift, below, parts, targets)
        shift = below
    return targets


def _paired(values: DataFrame, n_columns: int) -> DataFrame:
    """(part, column, bits) of every value.

    They come from a generator, of one column too: what follows reads the bits that it gives, and does not compute them at each mention.
    """
    pairs = [F.struct(F.lit(i).alias("column"), F.col(f"v{i}").alias("bits")) for i in range(n_columns)]
    return values.select("part", F.inline(F.array(*pairs))).filter("bits is not null")


def _counts(long: DataFrame, shift: int, parts: list[int]) -> DataFrame:
    """(column, digit, lowest, highest, held, without, n): values by all bits above ``shift``, of the whole table and outside each part."""
    grouped = long.groupBy("column", F.shiftright("bits", shift).alias("digit")).agg(
        F.count(F.lit(1)).alias("all"), F.min("bits").alias("lowest"), F.max("bits").alias("highest"),
        *[F.count_if(F.col("part") == p).alias(f"in{p}") for p in parts],
    )
    outside = [F.struct(F.lit(None).cast("int").alias("without"), F.col("all").alias("n"))]
    outside += [F.struct(F.lit(p).alias("without"), (F.col("all") - F.col(f"in{p}")).alias("n")) for p in parts]
    return grouped.select("column", "digit", "lowest", "highest", F.col("all").alias("held"), F.inline(F.array(*outside))).filter("n > 0")


def _found(counted: DataFrame, targets: dict) -> list[_Target]:
    """Takes over the digits that hold wanted ranks: one row per target reaches the driver. Gives the targets still open."""
    below = F.col("upto") - F.col("n")
    inside = F.filter("ranks", lambda r: (r["rank"] > below) & (r["rank"] <= F.col("upto")))
    hits = counted.select("column", "without", "digit", "lowest", "highest", "held", "total", below.alias("below"), F.inline(inside))
    still = []
    for r in hits.collect():
        target = _Target(r["column"], r["without"], r["slot"], r["total"], r["rank"] - r["below"], r["digit"], r["held"])
        if r["lowest"] == r["highest"]:
            target.value = double_of(r["lowest"])
        else:
            still.append(target)
        targets[target.column, target.without, target.slot] = target
    return still


def _next_digit(
    spark: SparkSession, long: DataFrame, wanted: list[_Target], above: int, shift: int, parts: list[int], targets: dict
) -> list[_Target]:
    """One more pass: the bits from ``above`` down to ``shift`` of each open target."""
    begins = sorted({(t.column, t.prefix) for t in wanted})
    inside = F.lit(False)
    for column, prefix in begins:
        inside |= (F.col("column") == column) & F.col("bits").between(prefix << above, (prefix + 1 << above) - 1)
    rows: dict[tuple, list] = {}
    for t in wanted:
        rows.setdefault((t.column, t.without, t.prefix, t.total), []).append((t.slot, t.rank))
    asked = spark.createDataFrame(
        [(*key, ranks) for key, ranks in rows.items()],
        "column int, without int, prefix long, total long, ranks array<struct<slot:int,rank:long>>",
    )
    counted = _counts(long.filter(inside), shift, sorted({t.without for t in wanted if t.without is not None}) if parts else [])
    counted = counted.withColumn("prefix", F.shiftright("digit", above - shift)).alias("c").join(
        asked.alias("a"),
        (F.col("c.column") == F.col("a.column")) & (F.col("c.prefix") == F.col("a.prefix")) & F.col("c.without").eqNullSafe(F.col("a.without")),
    ).select("c.*", "ranks", "total")
    counted = counted.withColumn("upto", F.sum("n").over(Window.partitionBy("column", "without", "prefix").orderBy("digit")))
    return _found(counted, targets)
