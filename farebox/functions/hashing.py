"""Row identifiers: md5 over the text of chosen columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.functions.columns import as_column

# Fixed value: the text that stands for NULL inside a surrogate key.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def double_text(col: Column | str) -> Column:
    """Decimal text of a double without exponent and without a trailing '.0'; different numbers have different texts.

    Spark writes 1.0E7 where databases write 10000000; ids have to agree, so the exponent range goes
    through a decimal. Numbers that 26 digits before and 12 behind the point can't hold keep Spark's text, as do NaN and
    the infinities.
    """
    col = as_column(col)
    plain = col.cast("string")
    size = F.abs(col)
    wide = decimal_text(col.try_cast("decimal(38,12)"))
    return F.when(
        (col == 0) | ((size >= 1e-3) & (size < 1e7)),
        F.when(plain.endswith(".0"), F.substring_index(plain, ".", 1)).otherwise(plain),
    ).otherwise(F.when(wide.try_cast("double") == col, wide).otherwise(plain))


def decimal_text(col: Column | str) -> Column:
    """Text of a decimal with at least one decimal place, trailing zeros removed."""
    return F.rtrim(F.rtrim(as_column(col).cast("string"), F.lit("0")), F.lit("."))


def row_id(*cols: Column | str, sep: str = "-", null_token: str = "", as_bytes: bool = False) -> Column:
    """md5 of the columns' text joined by ``sep``.

    ``sep=""`` gives the unseparated form, in which ("1", "23") and ("12", "3") share an id; keep it for
    tables that already carry such ids.
    """
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(null_token)) for c in cols]
    digest = F.md5(F.concat_ws(sep, *parts))
    return F.unhex(digest) if as_bytes else digest


def surrogate_key(*cols: Column | str) -> Column:
    """Surrogate key with an explicit NULL token, so NULL and empty text differ."""
    return row_id(*cols, sep="-", null_token=SURROGATE_NULL)
