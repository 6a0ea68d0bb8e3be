"""Projection, categories, numbers, field policies."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, text

MISSING = "MISSING"


@dataclass(frozen=True)
class Category:
    """How a categorical field is normalised: aliases after trim, NFKC and upper case; a closed domain if there is one.

    A value outside the domain is missing or, with ``strict``, a reason to reject the record (``checked_categories``).
    """

    aliases: dict[str, str] = field(default_factory=dict)
    domain: tuple[str, ...] | None = None
    trim: bool = True
    unicode: bool = True
    case: str = "upper"
    strict: bool = False


def project(records: DataFrame, fields: dict[str, str], placeholders: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and model fields from source fields; null, blank and placeholders become null (MISSING when rendered).

    Lists keep their items; an empty list is missing. A source field that the
    records do not have is missing too.
    """
    out = []
    for name, source in fields.items():
        if source not in records.columns:
            out.append(F.lit(None).cast("string").alias(name))
            continue
        c = F.col(source)
        if records.schema[source].dataType.typeName() == "array":
            out.append(F.when(F.size(c) > 0, c).alias(name))
        else:
            c = c.cast("string")
            out.append(F.when(~text.is_missing(c, placeholders), c).alias(name))
    return records.select(*keep, *out)


def canonical(c: Column, rule: Category) -> Column:
    """The canonical form, whether in the domain or not; null for missing."""
    x = text.strip(c) if rule.trim else c
    x = text.nfkc(x, rule.unicode)
    x = F.upper(x) if rule.case == "upper" else F.lower(x) if rule.case == "lower" else x
    aliased = x
    for a, t in rule.aliases.items():
        aliased = F.when(x == a, t).otherwise(aliased)
    return F.when((aliased != "") & (aliased != MISSING), aliased)


def category(c: Column, rule: Category) -> Column:
    """The canonical value, null for missing or outside the domain."""
    x = canonical(c, rule)
    return F.when(x.isin(*rule.domain), x) if rule.domain else x


def _items(c: Column, rule: Category, kept) -> Column:
    """What ``kept`` makes of a list's items; null ones go. Python cannot run inside a lambda, so NFKC goes over the whole list first."""
    plain = Category(rule.aliases, rule.domain, rule.trim, False, rule.case)
    return F.filter(F.transform(text.nfkc_items(c) if rule.unicode else c, lambda x: kept(x, plain)), lambda x: x.isNotNull())


def _is_list(records: DataFrame, name: str) -> bool:
    return records.schema[name].dataType.typeName() == "array"


def categories(records: DataFrame, rules: dict[str, Category]) -> DataFrame:
    """Every field of ``rules`` in its canonical form; of a list each item, missing ones dropped, an empty list missing."""
    out = {}
    for name, rule in rules.items():
        if _is_list(records, name):
            items = _items(F.col(name), rule, category)
            out[name] = F.when(F.size(items) > 0, items)
        else:
            out[name] = category(F.col(name), rule)
    return records.withColumns(out)


def checked_categories(records: DataFrame, rules: dict[str, Category]) -> tuple[DataFrame, DataFrame]:
    """(records in canonical form, rejects): a value outside the domain of a strict field rejects its record, with every such field in ``details``."""
    broken = []
    for name, rule in rules.items():
        if rule.strict and rule.domain:
            if _is_list(records, name):
                # items outside the domain are what the domain leaves of them
                items = F.coalesce(_items(F.col(name), rule, canonical), F.array().cast("array<string>"))
                outside = F.size(F.array_except(items, F.array(*[F.lit(d) for d in rule.domain]))) > 0
            else:
                x = canonical(F.col(name), rule)
                outside = x.isNotNull() & ~x.isin(*rule.domain)
            broken.append(F.when(outside, f"domain:{name}"))
    rows = records.withColumn("details", F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))
    bad = rows.where(F.size("details") > 0).withColumn("reason", F.lit("source_contract_violation"))
    return categories(rows.where(F.size("details") == 0).drop("details"), rules), bad


def numeric(records: DataFrame, name: str, **rule) -> DataFrame:
    """``name`` as an exact decimal, null if invalid, and ``name__reason``."""
    return numbers.validated(records, F.col(name), name, **rule)


def apply_policies(records: DataFrame, excluded: list[str], multivalue: dict[str, tuple[bool, int]]) -> DataFrame:
    """Without ``excluded`` fields; lists sorted unless their order matters, then cut to their limit.

    ``multivalue``: field -> (order is significant, most values).
    """
    out = {}
    for name, (ordered, most) in multivalue.items():
        c = F.col(name) if ordered else F.array_sort(name)
        out[name] = F.slice(c, 1, most)
    return records.drop(*excluded).withColumns(out)


def rendered(c: Column) -> Column:
    """The value as text, MISSING for null."""
    return F.coalesce(c.cast("string"), F.lit(MISSING))
