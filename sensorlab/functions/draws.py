"""Random draws that depend on a row's key only, so any partitioning gives the same result."""

from pyspark.sql import Column, functions as F


def key_text(keys, time: str = None) -> Column:
    parts = [F.col(k).cast("string") for k in keys]
    if time is not None:
        parts.append(F.unix_micros(F.col(time).cast("timestamp")).cast("string"))
    return F.concat_ws("|", *parts)


def uniform(key: Column, tag: str, seed: int = 42) -> Column:
    """Uniform in [0, 1) from the key, a tag naming the draw, and the seed."""
    digest = F.md5(F.concat_ws("|", key, F.lit(tag), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(2 ** 48))


def normal(key: Column, tag: str, seed: int = 42) -> Column:
    """Standard normal by the Box-Muller transform."""
    radius = F.sqrt(-2 * F.log(1 - uniform(key, f"{tag}.r", seed)))
    return radius * F.cos(uniform(key, f"{tag}.a", seed) * F.lit(6.283185307179586))


def poisson_one(key: Column, tag: str, seed: int = 42, most: int = 12) -> Column:
    """Poisson draw with mean 1; the chance of more than ``most`` is below 1e-10."""
    u, cumulative, term, draw = uniform(key, tag, seed), 0.0, 0.36787944117144233, None
    for n in range(most + 1):
        cumulative += term
        draw = F.when(u < cumulative, n) if draw is None else draw.when(u < cumulative, n)
        term /= n + 1
    return draw.otherwise(most + 1)
