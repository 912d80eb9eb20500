"""Reproducible uniforms from row keys.

A draw depends only on its key, never on partitioning, task retries or the order rows arrive in, so
a lost executor recomputes the same ensemble, and every use of a draw sees the same value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13  # 52 bits: exact in a double together with the half step below


def key_text(seed: int, purpose: str, *keys: Column) -> Column:
    """The text a draw is hashed from. Keys must be integers, dates or strings."""
    return F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), *[k.cast("string") for k in keys])


def hashed_uniform(seed: int, purpose: str, *keys: Column) -> Column:
    """Uniform double strictly inside (0, 1), one hash per draw."""
    digest = F.md5(key_text(seed, purpose, *keys))
    bits = F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("bigint")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << (4 * _HEX_DIGITS)))


# Modulus of the seeded sequences: products of two residues stay below 2^62.
_PRIME = (1 << 31) - 1


def sequence_seeds(text: Column) -> dict[str, Column]:
    """Coefficients of two cubic polynomials modulo a prime, hashed from a key.

    Evaluated at 1, 2, 3, ... by :func:`sequence_uniform` they give a sequence of uniforms of which
    any four are independent, at a few integer operations per draw instead of one hash.
    """
    seeds = {}
    for half, salted in enumerate((text, F.concat(text, F.lit("|low")))):
        digest = F.md5(salted)
        for k in range(4):
            bits = F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")
            seeds[f"_c{4 * half + k}"] = bits % _PRIME
    return seeds


def sequence_uniform(number: str, below: int = 1 << 31) -> Column:
    """Uniform double in (0, 1] for the draw ``number`` (1, 2, ... below ``below``, at most 2^31) of a seeded row.

    Remainders are taken where the next product might not fit an integer; a smaller bound saves some.
    """

    def polynomial(c0: int) -> str:
        value, most = f"_c{c0 + 3}", _PRIME
        for k in (2, 1, 0):
            value, most = f"({value} * {number} + _c{c0 + k})", most * below + _PRIME
            if k == 0 or most * below + _PRIME >= 1 << 63:
                value, most = f"{value} % {_PRIME}L", _PRIME
                value = f"({value})" if k else value
        return value

    return F.expr(
        f"(double({polynomial(0)}) + (double({polynomial(4)}) + 0.5D) / {_PRIME}.0D) / {_PRIME}.0D"
    )
