"""Closed JSON contracts compiled to column predicates, and record checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One field of a flat closed object: JSON types, and optional enum, pattern, bounds."""

    name: str
    types: tuple[str, ...]
    required: bool = True
    enum: tuple[str, ...] = ()
    pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None


def contract_errors(raw: Column, rules: list[Rule], path: str = "$", parsed: Column | None = None) -> Column:
    """All error messages of the object at ``path`` of a JSON text, in rule order; an unreadable text gives one error.

    ``parsed`` is the text as a variant, where the table has it in a column already.
    """
    whole = F.try_parse_json(raw) if parsed is None else parsed
    keys = F.json_object_keys(F.get_json_object(raw, path))
    known = F.array(*[F.lit(r.name) for r in rules])
    checks = [F.when(F.size(F.array_except(keys, known)) > 0, F.concat(F.lit("additional: "), F.array_join(F.array_sort(F.array_except(keys, known)), ",")))]
    for r in rules:
        p = f"{path}.{r.name}"
        text = F.get_json_object(raw, p)
        kind = F.schema_of_variant(F.try_variant_get(whole, p, "variant"))
        present = F.array_contains(keys, r.name)
        names = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"), "boolean": ("BOOLEAN",), "null": ("VOID",), "object": ("OBJECT",), "array": ("ARRAY",)}
        allowed = [x for t in r.types for x in names[t]]
        if r.required:
            checks.append(F.when(~present, f"missing: {r.name}"))
        fits = F.regexp_extract(kind, "^[A-Z]+", 0).isin(*allowed)
        if "null" in r.types:
            fits = fits | text.isNull()
        checks.append(F.when(present & ~F.coalesce(fits, F.lit(False)), f"type: {r.name}"))
        if r.enum:
            checks.append(F.when(present & text.isNotNull() & ~text.isin(*r.enum), f"enum: {r.name}"))
        if r.pattern:
            checks.append(F.when(present & text.isNotNull() & ~text.rlike(r.pattern), f"pattern: {r.name}"))
        if r.minimum is not None:
            checks.append(F.when(present & (text.try_cast("double") < r.minimum), f"minimum: {r.name}"))
        if r.maximum is not None:
            checks.append(F.when(present & (text.try_cast("double") > r.maximum), f"maximum: {r.name}"))
    return F.when(whole.isNull() | keys.isNull(), F.array(F.lit("not an object"))).otherwise(F.array_compact(F.array(*checks)))


def record_report(df: DataFrame, id_col: str) -> DataFrame:
    """One row: rows, null or blank ids, repeated ids."""
    x = F.col(id_col).cast("string")
    return df.agg(F.count("*").alias("n_rows"), F.count_if(x.isNull() | (F.trim(x) == "")).alias("n_blank"), (F.count(x) - F.count_distinct(x)).alias("n_repeated"))


def import_reviewed(df: DataFrame, required: list[str], label: str, vocabulary: list[str]) -> DataFrame:
    """Rows with a label; missing columns, and labels outside the vocabulary, raise an error that names them."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    strange = out_of_vocabulary(df, label, vocabulary).orderBy(label).limit(20).collect()
    if strange:
        raise ValueError(f"unknown {label}: {', '.join(str(r[0]) for r in strange)}")
    return df.filter(F.col(label).isNotNull())


def out_of_vocabulary(df: DataFrame, column: str, vocabulary: list[str]) -> DataFrame:
    """Distinct non-null values outside a vocabulary, with their counts."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*vocabulary)).groupBy(column).agg(F.count("*").alias("n_rows"))
