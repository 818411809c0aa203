"""Reproducible randomness: every draw is a digest of a key and a seed.

The result for a row depends on its key alone, so it survives repartitioning, retries and reruns,
and other SQL engines with ``md5`` give the same values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(key: Column | str, *salt: object) -> Column:
    """32 hex digits from the key and the salt parts."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", key.cast("string"), *(F.lit(str(s)) for s in salt)))


def hex_number(hex_digest: Column, first: int, length: int) -> Column:
    """``length`` hex digits of a digest, from 1-based position ``first``, as a bigint."""
    return F.conv(F.substring(hex_digest, first, length), 16, 10).cast("bigint")


def below(hex_digest: Column, bound: Column | int) -> Column:
    """Integer draw in [0, bound), from the first 12 digits."""
    return F.pmod(hex_number(hex_digest, 1, 12), bound if isinstance(bound, Column) else F.lit(bound))


def unit(hex_digest: Column, first: int = 1) -> Column:
    """Uniform draw in [0, 1) from 12 digits."""
    return hex_number(hex_digest, first, 12) / F.lit(float(16**12))


def normal(hex_digest: Column) -> Column:
    """Standard normal draw (Box-Muller) from digits 1-12 and 13-24."""
    radius = F.sqrt(-2.0 * F.log(1.0 - unit(hex_digest, 1)))
    return radius * F.cos(2.0 * F.pi() * unit(hex_digest, 13))


def share_cutoff(share: float) -> str:
    """8 hex digits that a uniformly distributed digest stays below with probability ``share``."""
    return format(min(round(share * 16**8), 16**8 - 1), "08x")


def is_odd(hex_digest: Column) -> Column:
    """Parity of the digest read as a number: that of its last digit."""
    return F.substring(hex_digest, 32, 1).isin(*"13579bdf")


def prefix_share(hex_digest: Column, share: float) -> Column:
    """True for about ``share`` of all digests."""
    return F.substring(hex_digest, 1, 8) < share_cutoff(share)
