"""Code-to-label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.functions.columns import as_column

# Vendor codes. A code outside the list has no name.
VENDORS = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
    4: "Unknown/Other",
}

# Upper bounds (exclusive) of the tip classes after the zero class, and their labels.
ZERO_TIP = "0"
TIP_CLASSES = [(2, "0–2"), (5, "2–5"), (10, "5–10"), (20, "10–20")]
TOP_TIP = "20+"


def vendor_name(col: Column | str) -> Column:
    """Name of a vendor code, NULL when the code is not listed."""
    pairs = [F.lit(x) for item in VENDORS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), as_column(col).cast("int"))


def _tip_ladder(col: Column | str, values: list) -> Column:
    tip = as_column(col)
    ladder = F.when(tip == 0, values[0])
    for (bound, _), value in zip(TIP_CLASSES, values[1:]):
        ladder = ladder.when(tip < bound, value)
    return ladder.otherwise(values[-1])


def tip_bucket(col: Column | str) -> Column:
    """Tip class. A negative tip is below 2 and NULL falls through to the top class, as in a CASE ladder."""
    return _tip_ladder(col, [ZERO_TIP, *(label for _, label in TIP_CLASSES), TOP_TIP])


def tip_bucket_rank(col: Column | str) -> Column:
    """Sort position of the tip class."""
    return _tip_ladder(col, list(range(len(TIP_CLASSES) + 2)))
