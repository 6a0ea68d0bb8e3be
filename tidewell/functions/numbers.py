"""Locale-aware exact numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

PARSE, NON_FINITE, RANGE = "parse_error", "non_finite", "business_range"
_NON_FINITE = r"(?i)^[+-]?(nan|snan|inf|infinity)$"
_NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"


def cleaned(text: Column, locale: str) -> Column:
    """The text with a decimal point and no grouping; no number where its signs contradict each other.

    ``ru_KZ`` groups with spaces and has a decimal comma (or a point, not both);
    ``plain`` has a point and no grouping.
    """
    t = strip(text)
    if locale != "ru_KZ":
        return t
    return F.when(text.contains(",") & text.contains("."), F.lit("x")).otherwise(F.translate(t, ", \u00a0\u2009\u202f", "."))


def number(clean: Column) -> Column:
    """The decimal(38,8) that a cleaned text is, or null."""
    return F.when(clean.rlike(_NUMBER), F.replace(clean, F.lit("_"), F.lit(""))).try_cast("decimal(38,8)")


def why_none(text: Column, clean: Column, value: Column) -> Column:
    return F.when(text.isNull(), None).when(value.isNotNull(), None).when(clean.rlike(_NON_FINITE), NON_FINITE).otherwise(PARSE)


def parsed(text: Column, locale: str) -> tuple[Column, Column]:
    """(decimal(38,8), reason) of a text: one of them is null, both where the text is."""
    clean = cleaned(text, locale)
    value = number(clean)
    return value, why_none(text, clean, value)


def scaled(value: Column, scale: str) -> Column:
    return (value.cast("decimal(28,8)") * F.lit(scale).cast("decimal(6,4)")).cast("decimal(30,8)")


def fault(value: Column, wide: Column, numeric_type: str, signed: bool, least: str | None, most: str | None) -> Column:
    """Why a number is none of its field's: not whole, though an integer; out of the business range once scaled."""
    out = F.lit(False) if signed else wide < 0
    if least is not None:
        out = out | (wide < F.lit(least).cast("decimal(30,8)"))
    if most is not None:
        out = out | (wide > F.lit(most).cast("decimal(30,8)"))
    broken = (value != F.floor(value)) if numeric_type == "integer" else F.lit(False)
    return F.when(broken, PARSE).when(out, RANGE)


def validated(df: DataFrame, text: Column, name: str, *, numeric_type: str, locale: str, scale: str = "1", signed: bool = False, least: str | None = None, most: str | None = None) -> DataFrame:
    """``df`` with ``name``, a decimal(30,8), and ``name__reason``: parsed, whole if an integer, scaled, then in the business range.

    One projection a step, so that no regular expression is evaluated twice.
    """
    t, c, v, w, r = (f"__{name}_{x}" for x in "tcvwr")
    rows = df.withColumn(t, text.cast("string"))
    rows = rows.withColumn(c, cleaned(F.col(t), locale))
    rows = rows.withColumn(v, number(F.col(c)))
    rows = rows.withColumn(w, scaled(F.col(v), scale))
    rows = rows.withColumn(r, F.coalesce(why_none(F.col(t), F.col(c), F.col(v)), fault(F.col(v), F.col(w), numeric_type, signed, least, most)))
    rows = rows.withColumns({name: F.when(F.col(r).isNull(), F.col(w)), f"{name}__reason": F.col(r)})
    return rows.drop(t, c, v, w, r)
