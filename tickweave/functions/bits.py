"""Input bitmasks as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ALL_MASK, BUTTON_MASK, BUTTONS, DIRECTION_MASK


def button(mask: Column, bit: int) -> Column:
    """0 or 1."""
    return F.shiftright(mask.bitwiseAND(1 << bit), bit).cast("int")


def buttons(mask: Column, prefix: str, names: tuple[str, ...] = BUTTONS) -> list[Column]:
    """One 0/1 column for each input, named prefix_name."""
    return [button(mask, i).alias(f"{prefix}_{name}") for i, name in enumerate(names)]


def mask_of(flags: list[Column]) -> Column:
    """The mask whose bit i is set where flag i is not 0; null where any flag is null."""
    return reduce(lambda a, b: a + b, (F.when(f != 0, 1 << i).when(f == 0, 0) for i, f in enumerate(flags)))


def direction(mask: Column) -> Column:
    return mask.bitwiseAND(DIRECTION_MASK)


def pressed(mask: Column) -> Column:
    return mask.bitwiseAND(BUTTON_MASK)


def clamp(mask: Column) -> Column:
    return mask.bitwiseAND(ALL_MASK)


def out_of_range(mask: Column, valid: int = ALL_MASK) -> Column:
    return mask.bitwiseAND(F.bitwise_not(F.lit(valid).cast("long"))) != 0


def from_axes(up_down: Column, left_right: Column, counters: list[Column]) -> Column:
    """The mask of signed axes (negative: up, left) and six counters that are pressed above 0."""
    flags = [up_down < 0, up_down > 0, left_right < 0, left_right > 0, *(c > 0 for c in counters)]
    return reduce(lambda a, b: a + b, (F.when(f, 1 << i).otherwise(0) for i, f in enumerate(flags)))


def density(*masks: Column) -> Column:
    """Inputs held in a frame, over all masks."""
    return reduce(lambda a, b: a + b, (F.bit_count(clamp(m)) for m in masks))


def held(mask: Column, names: tuple[str, ...] = BUTTONS) -> Column:
    """Names of the inputs that are held."""
    return F.array_compact(F.array(*(F.when(button(mask, i) == 1, F.lit(n)) for i, n in enumerate(names))))


def strictly_on(flag: Column) -> Column:
    """True for the text 1 alone."""
    return F.coalesce(flag.cast("string") == "1", F.lit(False))
