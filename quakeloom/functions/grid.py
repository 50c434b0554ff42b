"""Square latitude/longitude cells.

Batch statistics round half up, live reports round half to even; the same
event may therefore fall into different cells, so the mode is always named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeloom.functions.numeric import as_col, half_even_integer, half_up_integer

BATCH = "half_up"
LIVE = "half_even"
CELL = ["grid_lat", "grid_lon"]
_ROUNDING = {BATCH: half_up_integer, LIVE: half_even_integer}


def cell_centre(c: Column | str, size: float, mode: str) -> Column:
    return _ROUNDING[mode](as_col(c) / float(size)) * float(size)


def with_cell(df: DataFrame, size: float, mode: str) -> DataFrame:
    """Add ``grid_lat`` and ``grid_lon``, the centre of the row's cell."""
    return df.withColumns({
        "grid_lat": cell_centre("latitude", size, mode),
        "grid_lon": cell_centre("longitude", size, mode),
    })


def centres_within_reach(c: Column | str, size: float) -> Column:
    """Candidate centres whose box ``centre ± size`` may hold the value.

    Two centres per axis, three when the value sits on a centre. The bounds are
    inclusive of rounding, so callers keep the exact ``between`` test.
    """
    q = as_col(c) / float(size)
    low, high = F.ceil(q - 1).cast("double"), F.floor(q + 1).cast("double")
    ends = F.array(low * float(size), high * float(size))
    return F.when(high - low == 2, F.array(low * float(size), (low + 1) * float(size), high * float(size))).otherwise(ends)
