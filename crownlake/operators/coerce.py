"""Typed re-read of string results.

A remote SQL client pages results back as text (every cell a string, NULL as
an empty string). ``stringify`` reproduces that edge; ``coerce_result`` turns
the text back into types: numbers and dates that fail to parse become NULL,
rows where a coerced column is NULL are dropped, list-looking text becomes an
array, and the frame can be re-sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownlake.functions import columns as X

COERCERS = {
    "number": X.to_number,
    "date": X.to_date_or_null,
    "deck": X.parse_deck,
    "string": lambda c: X.col_(c),
}


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text; arrays as ``[a, b]``; NULL as ``""``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        text = X.render_deck(c) if isinstance(f.dataType, T.ArrayType) else c.cast("string")
        cols.append(F.coalesce(text, F.lit("")).alias(f.name))
    return df.select(*cols)


def coerce_result(
    df: DataFrame,
    types: Mapping[str, str],
    drop_null: bool = True,
    order_by: Sequence[str] = (),
    ascending: bool = True,
) -> DataFrame:
    """Coerce the named text columns; drop rows where any value is NULL, coerced or not."""
    out = df.select(*[
        COERCERS[types[c]](c).alias(c) if c in types else F.col(c) for c in df.columns
    ])
    if drop_null:
        out = out.dropna()
    if order_by:
        out = out.orderBy(*[F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_last()
                            for c in order_by])
    return out
