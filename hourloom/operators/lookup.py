"""Join a per-key table onto a large frame whose keys may be very uneven."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Add the columns of `table`, which has one row per key, to the rows of `df`.

    One plain join: Spark broadcasts `table` only under its own size threshold, and adaptive execution
    splits the rows of a hot key, each part against the one row of the key. `how` is left or
    inner; null keys find nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    on = list(on)
    added = [c for c in table.columns if c not in on]
    return df.join(table, on, how).select(*df.columns, *added)
