"""Seeded row order from arithmetic only, so that any engine reproduces it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_P = 2147483647  # Mersenne prime 2^31 - 1; keeps every product inside a signed 64-bit integer


def mix(key: str | Column, seed: int | Column = 42) -> Column:
    """Pseudo-random integer in [0, 2^31 - 1) for an integer key and a seed."""
    k = (F.col(key) if isinstance(key, str) else key).cast("bigint")
    s = (seed if isinstance(seed, Column) else F.lit(seed)).cast("bigint")
    a = F.pmod(F.pmod(k, F.lit(_P)) * 48271 + F.pmod(F.shiftright(k, 31), F.lit(_P)) * 69621 + F.pmod(s, F.lit(_P)) * 40692 + 11, F.lit(_P))
    b = F.pmod(a.bitwiseXOR(F.shiftright(a, 15)) * 39373 + 7, F.lit(_P))
    return F.pmod(b.bitwiseXOR(F.shiftright(b, 13)) * 16807, F.lit(_P))


def unit(key: str | Column, seed: int | Column = 42) -> Column:
    """The same as a double in [0, 1)."""
    return mix(key, seed) / F.lit(float(_P))


def mix_sql(key: str, seed: int | str = 42) -> str:
    """`mix` as a SQL expression over a non-negative integer key."""
    a = f"((({key}) % {_P}) * 48271 + ((({key}) >> 31) % {_P}) * 69621 + ({seed} % {_P}) * 40692 + 11) % {_P}"
    b = f"(xor(({a}), ({a}) >> 15) * 39373 + 7) % {_P}"
    return f"((xor(({b}), ({b}) >> 13) * 16807) % {_P})"


def row_hash(*cols: str | Column) -> Column:
    """Non-negative 31-bit hash of any columns, for salts and blocks (not reproduced elsewhere)."""
    return F.pmod(F.xxhash64(*cols), F.lit(_P))
