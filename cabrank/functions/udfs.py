"""The same trip condition as a vectorised Python function.

The reports use ``conditions.expensive_short``. This variant reads text columns
batch by batch as Arrow arrays; it shows how a Python predicate plugs in, and
tests hold the two against each other.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from cabrank.functions.conditions import DECIMAL

WELL_FORMED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"


def _amounts(text: pa.Array) -> np.ndarray:
    """Plain decimals as numbers, anything else as NaN."""
    plain = pc.fill_null(pc.match_substring_regex(text, f"^(?:{DECIMAL})$"), False)
    values = np.full(len(text), np.nan)
    values[plain.to_numpy(zero_copy_only=False)] = np.array(text.filter(plain).to_pylist(), str).astype(float)
    return values


def _is_day(text: str) -> bool:
    try:
        date.fromisoformat(text)
    except ValueError:
        return False
    return True


def expensive_short_udf(
    first_day: date = date(2023, 1, 1),
    last_day: date = date(2023, 1, 7),
    min_fare: float = 50,
    max_distance: float = 1,
) -> Callable[..., Column]:
    """A boolean function of (pickup, fare, distance), all three as text.

    Well-formed times order as text like the moments they stand for, so the days
    are compared as text, and only trips within them are looked at closely.
    """
    start, end = str(first_day), str(last_day + timedelta(days=1))

    @F.arrow_udf("boolean")
    def keep(pickup: pa.Array, fare: pa.Array, distance: pa.Array) -> pa.Array:
        within = pc.and_(pc.greater_equal(pickup, start), pc.less(pickup, end))
        at = np.flatnonzero(pc.fill_null(within, False).to_numpy(zero_copy_only=False))
        near, days = pa.array(at), pickup.take(pa.array(at))
        formed = pc.match_substring_regex(days, WELL_FORMED).to_numpy(zero_copy_only=False).astype(bool)
        known = {day: _is_day(day) for day in pc.unique(pc.utf8_slice_codeunits(days, 0, 10)).to_pylist()}
        formed &= np.array([known[day] for day in pc.utf8_slice_codeunits(days, 0, 10).to_pylist()], bool)
        paid, went = _amounts(fare.take(near)), _amounts(distance.take(near))
        out = np.zeros(len(pickup), bool)
        out[at] = formed & (paid > min_fare) & (paid < np.inf) & (went < max_distance) & (went > -np.inf)
        return pa.array(out)

    return keep
