"""Repeatable random draws.

Each draw is a function of (seed, number of the draw) through md5, never of the partition it
happens to be computed in, so a lost and recomputed task gives the same rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_BITS52 = float(2**52)
_MAX_POSITION = float(2**62)


def _digest(seed: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts]))


def _uniform_at(digest: Column, slot: int) -> Column:
    """Slot 0 or 1 of a digest as a number strictly between 0 and 1 (52 bits)."""
    bits = F.conv(F.substring(digest, 1 + 13 * slot, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / _BITS52


def uniform(seed: str, *parts: Column) -> Column:
    return _uniform_at(_digest(seed, *parts), 0)


def shuffle_key(seed: str, *parts: Column) -> Column:
    """Sort by this for a random order."""
    return _digest(seed, *parts)


def normal(seed: str, draw: Column, mean: Column, deviation: Column) -> Column:
    """Normal draw by the Box-Muller formula."""
    digest = _digest(seed, draw)
    radius = F.sqrt(F.lit(-2.0) * F.ln(_uniform_at(digest, 0)))
    angle = F.lit(2.0) * F.pi() * _uniform_at(digest, 1)
    return mean + deviation * radius * F.cos(angle)


def exponential(seed: str, draw: Column, rate: float) -> Column:
    """Exponential draw with mean 1/rate."""
    return -F.ln(uniform(seed, draw)) / F.lit(rate)


def zipf(seed: str, draw: Column, a: float, attempts: int = 32) -> Column:
    """Zipf draw (1, 2, 3, ... with P(x) ~ x^-a) by Devroye's rejection method.

    The first accepted attempt counts. `coalesce` stops there, and about three in four are
    accepted, so the list of the later attempts is made for one row in 200. Should all 32 be
    refused (probability below 1e-15) the draw is 1, the likeliest value: it is never null.

    The law ends at 2^62. An `a` so near to 1 that over 1 % of the attempts lie beyond is refused.
    """
    if not 2.0 ** (-62.0 * (a - 1.0)) <= 0.01:
        raise ValueError(f"a = {a}: too near to 1 for draws up to 2^62")
    b = 2.0 ** (a - 1.0)

    def accept(pair: Column) -> Column:
        x = pair["x"]
        t = F.pow(F.lit(1.0) + F.lit(1.0) / x, F.lit(a - 1.0))
        fits = pair["v"] * x * (t - 1.0) / (b - 1.0) <= t / b
        return F.when((x <= _MAX_POSITION) & fits, x.cast("long"))

    def attempt(k: Column) -> Column:
        digest = _digest(seed, draw, k)
        raw = F.pow(_uniform_at(digest, 0), F.lit(-1.0 / (a - 1.0)))
        # Capping before floor keeps the value inside a long; a capped draw is refused above.
        x = F.when(raw > _MAX_POSITION, F.lit(float("inf"))).otherwise(F.floor(raw).cast("double"))
        pair = F.struct(x.alias("x"), _uniform_at(digest, 1).alias("v"))
        return F.transform(F.array(pair), accept)[0]

    singly = min(4, attempts)
    later = F.transform(F.sequence(F.lit(singly), F.lit(attempts - 1)), attempt)
    firsts = [attempt(F.lit(k)) for k in range(singly)]
    return F.coalesce(*firsts, F.get(F.filter(later, lambda x: x.isNotNull()), F.lit(0)),
                      F.lit(1).cast("long"))
