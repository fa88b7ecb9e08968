"""Equal-width bins over [lo, hi] with a closed last bin."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def widen(lo: Column, hi: Column) -> tuple[Column, Column]:
    """A range of zero width becomes one unit wide, centred on its value."""
    flat = lo == hi
    return F.when(flat, lo - 0.5).otherwise(lo), F.when(flat, hi + 0.5).otherwise(hi)


def edge(i: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Left edge of bin ``i``; edge number ``bins`` is exactly ``hi``."""
    return F.when(i >= bins, hi).otherwise(i * ((hi - lo) / F.lit(float(bins))) + lo)


def bin_guess(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin by quotient, the closed end folded into the last bin; missing stays missing."""
    raw = F.floor((value - lo) / (hi - lo) * F.lit(float(bins))).cast("int")
    # A value just below the end can round up to it as well.
    return raw - (raw >= bins).cast("int")


def bin_settled(value: Column, guess: Column, lo: Column, hi: Column, bins: int) -> Column:
    """The guess compared with the two edges around it.

    The quotient can land one bin off where a value sits on an edge. Written as
    arithmetic on truth values: branches would multiply in the optimizer.
    """
    step = (hi - lo) / F.lit(float(bins))
    below = value < guess * step + lo
    above = (guess < bins - 1) & (value >= (guess + 1) * step + lo)
    return guess - below.cast("int") + above.cast("int")


def bin_index(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin of a value inside [lo, hi]."""
    return bin_settled(value, bin_guess(value, lo, hi, bins), lo, hi, bins)
