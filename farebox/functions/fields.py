"""JSON in and out of columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.functions.columns import as_column

MISSING = "N/A"


def json_fields(document: Column | str, fields: list[str], missing: str = MISSING) -> list[Column]:
    """The listed fields of a JSON object as text: an absent field gives ``missing``, an explicit null stays NULL."""
    doc = F.parse_json(as_column(document))
    out = []
    for name in fields:
        path = f'$["{name}"]'
        value = F.variant_get(doc, path, "variant")
        text = F.when(value.isNull(), F.lit(missing)).when(
            ~F.is_variant_null(value), F.variant_get(doc, path, "string")
        )
        out.append(text.alias(name))
    return out


def message_text(*cols: Column | str) -> Column:
    """One JSON object per row. NULL fields are written as null, and NaN (not valid JSON) as null too."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
