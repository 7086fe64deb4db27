"""Nested closed contracts: compiled once to a checker that reports every breach with its place.

A contract is a tree: ``Obj`` (closed: every field is required, others are breaches), ``Arr`` and ``Leaf``. Texts are read
and checked in one narrow pass in batches; the compiled tree travels with the tasks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Check = Callable[[object, str, list[str]], None]


@dataclass(frozen=True)
class Leaf:
    """A scalar: ``kind`` is string, number, integer or boolean."""

    kind: str = "string"
    null: bool = False
    enum: tuple[str, ...] = ()
    const: str | None = None
    pattern: str | None = None
    least_length: int = 0
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Arr:
    item: object
    least: int = 0


@dataclass(frozen=True)
class Obj:
    fields: dict = field(default_factory=dict)
    null: bool = False
    optional: tuple[str, ...] = ()


_KINDS = {
    "string": lambda v: isinstance(v, str),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: not isinstance(v, bool) and (isinstance(v, int) or isinstance(v, float) and v.is_integer()),
    "boolean": lambda v: isinstance(v, bool),
}


def compile_contract(node: object) -> Check:
    """A function that appends the breaches of a value at a place to a list, in the order of the contract."""
    if isinstance(node, Leaf):
        fits, expression = _KINDS[node.kind], re.compile(node.pattern) if node.pattern else None

        def leaf(v: object, at: str, out: list[str]) -> None:
            if v is None and node.null:
                return
            if not fits(v):
                out.append(f"{at}: must be {node.kind}")
                return
            if node.enum and v not in node.enum:
                out.append(f"{at}: not an allowed value")
            if node.const is not None and v != node.const:
                out.append(f"{at}: must be {node.const}")
            if expression and not expression.search(v):
                out.append(f"{at}: must match {node.pattern}")
            if node.least_length and len(v) < node.least_length:
                out.append(f"{at}: too short")
            if node.low is not None and v < node.low:
                out.append(f"{at}: below {node.low}")
            if node.high is not None and v > node.high:
                out.append(f"{at}: above {node.high}")

        return leaf
    if isinstance(node, Arr):
        inner = compile_contract(node.item)

        def array(v: object, at: str, out: list[str]) -> None:
            if not isinstance(v, list):
                out.append(f"{at}: must be array")
                return
            if len(v) < node.least:
                out.append(f"{at}: fewer than {node.least} items")
            for i, x in enumerate(v):
                inner(x, f"{at}/{i}", out)

        return array
    checks = {k: compile_contract(x) for k, x in node.fields.items()}
    known, needed = set(checks), [k for k in checks if k not in node.optional]

    def obj(v: object, at: str, out: list[str]) -> None:
        if v is None and node.null:
            return
        if not isinstance(v, dict):
            out.append(f"{at}: must be object")
            return
        out += [f"{at}: missing {k}" for k in needed if k not in v]
        out += [f"{at}: additional {k}" for k in sorted(v.keys() - known)]
        for k, check in checks.items():
            if k in v:
                check(v[k], f"{at}/{k}", out)

    return obj


def validate(df: DataFrame, id_col: str, text_col: str, contract: object) -> DataFrame:
    """(id, parsed, valid, errors): whether each text is one JSON value, whether it keeps the contract, and all breaches.

    Null and unreadable texts aren't parsed and have no errors; repeated rows each give their own; an empty table gives none.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        check = compile_contract(contract)
        for b in batches:
            rows = []
            for key, text in zip(b["k"], b["t"]):
                out: list[str] = []
                try:
                    value = json.loads(text) if isinstance(text, str) else None
                    parsed = isinstance(text, str)
                except (ValueError, RecursionError):
                    parsed = False
                if parsed:
                    check(value, "", out)
                rows.append((key, parsed, parsed and not out, out))
            yield pd.DataFrame(rows, columns=["k", "parsed", "valid", "errors"])

    rows = df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, f"k {kind}, parsed boolean, valid boolean, errors array<string>").withColumnRenamed("k", id_col)
