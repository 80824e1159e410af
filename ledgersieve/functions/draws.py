"""Seeded draws that depend only on the row's key.

rand() and randn() follow the partition layout, so a rerun on another cluster, or a
recomputed task, would corrupt other rows. A hash of (seed, key, purpose) does not. It
uses 32-bit integer steps that any SQL engine can repeat.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = 2**32 - 1
MULTIPLIER = 0x45D9F3B
DRAW_MULTIPLIER = 0x2C1B3C6D
_SPAN = float(2**32)


def salt(text: str) -> int:
    return zlib.crc32(text.encode())


def _mix(x: Column) -> Column:
    """Spread a number below 2^32 over that range."""
    for _ in range(2):
        x = (F.shiftright(x, 16).bitwiseXOR(x) * F.lit(MULTIPLIER)).bitwiseAND(F.lit(MASK))
    return F.shiftright(x, 16).bitwiseXOR(x)


def key_hash(seed: int, key: Column) -> Column:
    """Hash of a whole-number key. Keep it as a column: every draw of the row starts from it."""
    folded = key.bitwiseAND(F.lit(MASK)).bitwiseXOR(F.shiftright(key, 32).bitwiseAND(F.lit(MASK)))
    return _mix(folded.bitwiseXOR(F.lit(salt(f"seed {seed}"))))


def child_hash(parent: Column, number: Column) -> Column:
    """Hash of the numbered child of a hashed row."""
    return _mix((parent + number * F.lit(MULTIPLIER)).bitwiseAND(F.lit(MASK)))


def draw_int(row: Column, purpose: str) -> Column:
    """Uniform whole number in [0, 2^32). One step is enough: the row hash is mixed already."""
    x = (row.bitwiseXOR(F.lit(salt(purpose))) * F.lit(DRAW_MULTIPLIER)).bitwiseAND(F.lit(MASK))
    return F.shiftright(x, 15).bitwiseXOR(x)


def draw_below(row: Column, purpose: str, n: int) -> Column:
    """Uniform whole number in [0, n)."""
    return draw_int(row, purpose) % F.lit(n)


def draw_unit(row: Column, purpose: str) -> Column:
    """Uniform number in (0, 1]."""
    return (draw_int(row, purpose) + 1) / F.lit(_SPAN)


def draw_choice(row: Column, purpose: str, values: Sequence) -> Column:
    position = (draw_below(row, purpose, len(values)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), position)


def draw_normal(row: Column, purpose: str) -> Column:
    """Standard normal from two uniform draws (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(draw_unit(row, purpose + "/r")))
    return radius * F.cos(F.lit(2 * math.pi) * draw_unit(row, purpose + "/a"))
