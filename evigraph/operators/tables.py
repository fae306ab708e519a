"""Table-building operators: deterministic dedupe, merge, owner replace, sums on duplicates, list codec, type inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _filled(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c).cast("string") != "")


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the first in order (ascending columns, nulls first); rows with an empty key part go. A least struct: copies of a hot key meet as partial aggregates."""
    for c in key:
        df = df.filter(_filled(c))
    names = df.columns
    best = df.groupBy(*key).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in names if c not in key]), F.struct(*order)).alias("_row")) if set(names) - set(key) else df.select(*key).distinct()
    return best.select(*[F.col(f"`{c}`") if c in key else F.col(f"_row.`{c}`").alias(c) for c in names])


def full_dedupe(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows distinct over the declared fields, absent counting as empty."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in fields]).distinct()


def absorb(*tables: DataFrame) -> DataFrame:
    """Union of headers; earlier tables rank first (_src_rank)."""
    out = None
    for rank, t in enumerate(tables):
        t = t.withColumn("_src_rank", F.lit(rank))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def owner_replace(existing: DataFrame, new: DataFrame, column: str, value: str) -> DataFrame:
    """Rows the owner wrote before go and are written anew: running twice gives the same table."""
    return existing.filter(~F.col(column).eqNullSafe(F.lit(value))).unionByName(new, allowMissingColumns=True)


def sum_on_duplicate(df: DataFrame, key: list[str], sums: list[str], order: list) -> DataFrame:
    """First row of each key; whole-number fields of later rows are added to it."""
    digits = [F.sum(F.try_to_number(F.when(F.col(c).cast("string").rlike(r"^\d+$"), F.col(c).cast("string")), F.lit("999999999999999999"))).cast("long").alias(c) for c in sums]
    total = df.groupBy(*key).agg(*digits)
    return first_wins(df.drop(*sums), key, order).join(total, key)


def encode_list(items: Column) -> Column:
    """JSON text; an empty list is null."""
    return F.when(F.size(items) > 0, F.to_json(items))


def decode_list(text: Column) -> Column:
    """Null stays null, JSON becomes its list, other text a list of itself."""
    return F.when(text.isNull() | (text == ""), F.lit(None)).otherwise(F.when(text.startswith("["), F.coalesce(F.from_json(text, "array<string>"), F.array(text))).otherwise(F.array(text)))


def infer_integers(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns whose filled cells, one at least, are all whole numbers: one pass over all columns."""
    tests = [F.coalesce(F.min(F.when(_filled(c), F.col(c).cast("string").rlike(r"^-?\d+$"))), F.lit(False)).alias(c) for c in columns]
    row = df.agg(*tests).first()
    return [c for c in columns if row[c]]


def typed(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Cells as declared types ('int', 'float', 'bool', 'list', 'string'); undeclared all-digit columns are integers; empty is null."""
    free = [c for c in df.columns if c not in declared]
    kinds = {**dict.fromkeys(infer_integers(df, free) if free else [], "int"), **declared}
    casts = {"int": "bigint", "float": "double", "bool": "boolean"}
    out = []
    for c in df.columns:
        cell = F.nullif(F.col(c).cast("string"), F.lit(""))
        kind = kinds.get(c, "string")
        out.append((decode_list(cell) if kind == "list" else cell.try_cast(casts[kind]) if kind in casts else cell).alias(c))
    return df.select(*out)


def cited(df: DataFrame, id_column: str, source: str) -> DataFrame:
    """How often a source cites each id."""
    return df.filter(_filled(id_column)).groupBy(id_column).agg(F.count(F.lit(1)).alias("n_cited")).withColumn("source", F.lit(source))


def collapse(df: DataFrame, fields: list[str]) -> DataFrame:
    """Exact repeats as one row with their number."""
    return df.groupBy(*fields).agg(F.count(F.lit(1)).alias("duplicate_rows"))


def claim_merge(df: DataFrame, key: str, claim: str, names: str, lists: list[str]) -> DataFrame:
    """One row a key: the flag is OR-ed, lists are distinct and sorted, names are those of claiming rows if any claims."""
    claimed = F.array_sort(F.collect_set(F.when(F.col(claim), F.col(names))))
    every = F.array_sort(F.collect_set(names))
    return df.groupBy(key).agg(
        F.coalesce(F.bool_or(claim), F.lit(False)).alias(claim),
        F.when(F.bool_or(claim), claimed).otherwise(every).alias(names),
        *[F.array_sort(F.collect_set(c)).alias(c) for c in lists],
    )


def arms(df: DataFrame, key: str, size: str, texts: list[str]) -> DataFrame:
    """A study's arms as one row: total size, sizes in order, sorted distinct texts joined."""
    return df.groupBy(key).agg(F.sum(size).alias("total_size"), F.sort_array(F.collect_list(size)).alias("sizes"), *[F.array_join(F.array_sort(F.collect_set(c)), "; ").alias(c) for c in texts])
