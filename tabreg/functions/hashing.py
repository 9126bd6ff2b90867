"""Reproducible pseudo-randomness from a row key.

``rand``, ``sample`` and ``randomSplit`` depend on how rows fall into
partitions, so a lost executor or another cluster size changes the result.
Here every draw is a pure function of (seed, row key): narrow, JVM-side, and
equal on any layout and in any engine that has md5.
"""

from __future__ import annotations

from collections.abc import Sequence

from decimal import Decimal, localcontext

from pyspark.sql import Column, functions as F

DIGITS = 15
BUCKETS = 1 << 4 * DIGITS


def hash_digits(key: str | Sequence[str], seed: int | str) -> Column:
    """Fifteen hex digits (60 bits) drawn uniformly: the first ones of md5('seed:key').

    Fixed width, so comparing the text compares the numbers; thresholds stay
    in this form and save the conversion.
    """
    names = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(n).cast("string") for n in names])
    return F.substring(F.md5(text), 1, DIGITS)


def hash_bucket(key: str | Sequence[str], seed: int | str) -> Column:
    """A uniform integer in [0, 2^60)."""
    return F.conv(hash_digits(key, seed), 16, 10).cast("long")


def hash_fraction_below(key: str | Sequence[str], seed: int | str, fraction: float) -> Column:
    """True for about ``fraction`` of the keys."""
    limit = int(fraction * BUCKETS)
    return F.lit(limit >= BUCKETS) | (hash_digits(key, seed) < F.lit(_digits(min(limit, BUCKETS - 1))))


def poisson_cutoffs(rate: float = 1.0) -> list[int]:
    """Integer cut-offs int(CDF(k) * 2^60), k = 0, 1, ... until the tail holds no point of the grid."""
    with localcontext() as context:
        context.prec = 50
        mean = Decimal(str(rate))
        cutoffs, term, cdf, k = [], (-mean).exp(), Decimal(0), 0
        while (1 - cdf) * BUCKETS >= 1:
            cdf += term
            cutoffs.append(int(cdf * BUCKETS))
            k += 1
            term *= mean / k
        return cutoffs


def poisson_count(digits: Column, rate: float = 1.0) -> Column:
    """Poisson(rate) draw for uniform ``hash_digits``: how many cut-offs they reach.

    The cut-offs rise, so the first one above the digits ends the search: at rate 1 the hash is looked at twice on average.
    """
    cutoffs = [_digits(c) for c in poisson_cutoffs(rate) if c < BUCKETS]
    draws = F.when(digits < F.lit(cutoffs[0]), 0)
    for reached, cutoff in enumerate(cutoffs[1:], 1):
        draws = draws.when(digits < F.lit(cutoff), reached)
    return draws.when(digits >= F.lit(cutoffs[-1]), len(cutoffs))


def poisson_positive(digits: Column, rate: float = 1.0) -> Column:
    """Whether the draw is above 0, with a single look at the hash (filters do not share subexpressions)."""
    return digits >= F.lit(_digits(poisson_cutoffs(rate)[0]))


def _digits(number: int) -> str:
    return f"{number:0{DIGITS}x}"
