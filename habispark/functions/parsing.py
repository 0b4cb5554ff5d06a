"""Lenient parsing of text cells into numbers, with one notion of "missing": NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from habispark.constants import NULL_TOKENS

# Spark's own text-to-double cast also takes "12d", "1f" and hexadecimal floats, so the shape is
# checked before the cast.
_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def lenient_number(text: Column) -> Column:
    """Double value of a text cell, NULL where the text is not a finite decimal number."""
    number = F.when(text.rlike(_DECIMAL), text.try_cast("double"))
    # Too large an exponent gives an infinity. nullif evaluates its argument once.
    return F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf")))


def lenient_integer(text: Column) -> Column:
    """Whole number of a text cell, NULL where it is no number; a fraction is an error."""
    number = lenient_number(text)
    failure = F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast("long")
    return F.when(number == F.floor(number), number.cast("long")).when(number.isNotNull(), failure)


def parse_decimal_comma(text: Column) -> Column:
    """Double value of a text cell that may use a comma as decimal mark."""
    return lenient_number(F.translate(text, ",", "."))


def normalize_null_tokens(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Cells holding one of the usual missing-value markers become NULL (all text columns)."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    chosen = texts if columns is None else texts & set(columns)
    return df.select(
        *[
            F.when(~F.col(f"`{c}`").isin(*NULL_TOKENS), F.col(f"`{c}`")).alias(c)
            if c in chosen
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
