"""Text normalisation."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that count as white space at the ends of a value: those of Unicode, and the separators of ASCII (fixed values).
SPACES = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def nfkc(c: Column, unicode: bool = True) -> Column:
    """Unicode NFKC. Spark has no such function, so only values beyond ASCII go through Arrow."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), _nfkc(c)).otherwise(c) if unicode else c


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfkc_items(s: pd.Series) -> pd.Series:
    return s.map(lambda xs: None if xs is None else [None if x is None else unicodedata.normalize("NFKC", x) for x in xs])


def nfkc_items(c: Column) -> Column:
    """Unicode NFKC of a list's items; only lists with an item beyond ASCII go through Arrow."""
    return F.when(F.exists(c, lambda x: x.rlike(r"[^\x00-\x7F]")), _nfkc_items(c)).otherwise(c)


def is_missing(c: Column, placeholders: list[str]) -> Column:
    """Null, blank, or one of the placeholders, compared without case."""
    folded = F.lower(strip(c))
    return c.isNull() | (folded == "") | folded.isin([p.strip().casefold() for p in placeholders])
