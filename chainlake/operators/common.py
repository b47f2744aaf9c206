"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def columns(names: str | Sequence[str]) -> list[str]:
    """A list of column names from one name or several."""
    return [names] if isinstance(names, str) else list(names)


def ordering(names: str | Sequence[str]) -> Column:
    """Ordering expression for ``max_by`` / ``min_by``.

    One column stays as it is: a fixed-width ordering keeps the aggregate on
    the hash path. Several columns need a struct.
    """
    names = columns(names)
    return F.col(names[0]) if len(names) == 1 else F.struct(*names)


def whole(dividend: Column, divisor: Column) -> Column:
    """Integer division; exact for longs, where ``/`` would go through doubles."""
    return F.call_function("div", dividend, divisor)


def floor_div(dividend: Column, divisor: int) -> Column:
    """Integer division that rounds down, also below zero."""
    by = F.lit(divisor).cast("long")
    return whole(dividend - F.pmod(dividend, by), by)
