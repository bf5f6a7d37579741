"""Text columns: which column to read, and how to clean its values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that count as white space when testing for blank text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def string_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def resolve_text_column(df: DataFrame, declared: str) -> str:
    """The declared column, else the first string column, else an error."""
    if declared in df.columns:
        return declared
    candidates = string_columns(df)
    if not candidates:
        raise ValueError(f"no column '{declared}' and no string column among {df.columns}")
    return candidates[0]


def is_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE)) == ""


def normalise(value: Column) -> Column:
    """Any value as text; null becomes the empty string."""
    return F.coalesce(value.cast("string"), F.lit(""))


def first_nonblank(df: DataFrame, declared: str) -> Column:
    """The declared value when present, else the row's first non-blank string."""
    options = [F.col(declared).cast("string")] if declared in df.columns else []
    options += [F.when(~is_blank(F.col(c)), F.col(c)) for c in string_columns(df) if c != declared]
    if not options:
        raise ValueError(f"no text column in {df.columns}")
    return F.coalesce(*options)


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(~is_blank(F.col(column)))


def preview(text: Column, shown: int = 100) -> Column:
    """The first `shown` characters and an ellipsis when that saves space."""
    return F.when(
        F.length(text) > shown + 3, F.concat(F.substring(text, 1, shown), F.lit("..."))
    ).otherwise(text)
