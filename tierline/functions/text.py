"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's str.strip() removes by default
# (str.isspace()): U+0009-U+000D, U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000. Spark's trim() removes
# spaces only.
PY_WHITESPACE_CLASS = ("[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
                       "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")
_EDGES = f"^{PY_WHITESPACE_CLASS}+|{PY_WHITESPACE_CLASS}+$"


def strip_whitespace(col: Column) -> Column:
    """Remove leading/trailing whitespace as Python's ``str.strip()`` does."""
    return F.regexp_replace(col, _EDGES, "")


def has_edge_whitespace(col: Column) -> Column:
    """True for non-null text that changes under ``strip_whitespace``."""
    return col.isNotNull() & (col != strip_whitespace(col))


def extract_player_id(col: Column, dtype: T.DataType) -> Column:
    """First run of digits of the value as INT, 0 when there is none.

    Text goes through ``regexp_extract``; floating values are cast to BIGINT
    first so large ids are not read from scientific notation.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        col = col.try_cast("bigint")
    text = col.cast("string")
    digits = F.regexp_extract(text, r"(\d+)", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def split_part_int(col: Column, sep: str, index: int) -> Column:
    """``split(col, sep)[index]`` as INT; NULL when the part is absent or not a number."""
    return F.try_element_at(F.split(col, sep), F.lit(index + 1)).try_cast("int")
