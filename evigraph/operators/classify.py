"""Scalar rules and normalisers as columns (E*, F*, X*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_words(text: Column, *words: str) -> Column:
    """Blank cells and words that stand for nothing ('NA', 'n.a.', 'NULL') are null."""
    t = F.trim(text)
    return F.when((t != "") & ~t.isin(*words), t)


def digits(text: Column) -> Column:
    t = F.trim(text)
    return F.when(t.rlike(r"^\d+$"), t).try_cast("bigint")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def doi(text: Column) -> Column:
    return F.nullif(F.lower(F.regexp_replace(F.trim(text), r"(?i)^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")), F.lit(""))


def whole_index(x: Column) -> Column:
    """The whole number within a millionth of x, else null."""
    return F.when(F.abs(x - F.rint(x)) <= 1e-6, F.rint(x).cast("bigint"))


def split_ids(text: Column, separators: str = "[,;]") -> Column:
    return F.array_distinct(F.filter(F.transform(F.split(text, separators), lambda x: F.trim(x)), lambda x: x != ""))


def capped(items: Column, most: int = 25) -> Column:
    """struct(shown, n): the first of a list and its true count."""
    d = F.array_distinct(items)
    return F.struct(F.slice(d, 1, most).alias("shown"), F.size(d).alias("n"))


def after_prefix(text: Column) -> Column:
    return F.regexp_replace(text, r"^[^:]*:", "")


def without_parenthetical(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s*\([^)]*\)", ""))


def hit(p: Column, cut: float) -> Column:
    """True below the cut, false at or above it, null where it was not measured: a measured negative is a value."""
    return F.when(p.isNotNull() & ~F.isnan(p), p < cut)


def consumed(share: Column, threshold: Column, fdr: Column, cut: float = 0.05) -> Column:
    return F.when(share.isNotNull() & threshold.isNotNull() & fdr.isNotNull(), (share >= threshold) & (fdr <= cut))


def level(rules: list[tuple[Column, str]], default: str) -> Column:
    """The first rule that holds."""
    out = F.lit(default)
    for test, name in reversed(rules):
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def rules_met(rules: dict[str, Column]) -> Column:
    """Names of all rules that hold, in order; none: an empty list."""
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))


def not_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def atc_level5(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b([A-Z]\d{2}[A-Z]{2}\d{2})\b"), F.lit(1)))


def conjugate(name: Column) -> Column:
    """The acid of an -ate and the -ate of an acid; null for other names."""
    return F.when(name.rlike("ate$"), F.regexp_replace(name, "ate$", "ic acid")).when(name.rlike("ic acid$"), F.regexp_replace(name, "ic acid$", "ate"))
