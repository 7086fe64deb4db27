"""Shared inlining: nested records to related flat tables.

The element graph of a record type is analysed once. An element becomes a relation of its own when it
is the root, repeated, reachable from more than one parent element, or part of a cycle; every other
element is a singleton descendant and its leaves are inlined, under dotted column names, into the
nearest ancestor that is a relation. Each relation row has a key that is unique within its record and
a foreign key to the row of its parent relation.

The walk over one record touches only that record, so the shredding needs no shuffle at any size.
"""

from __future__ import annotations

import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import spread

LEAF = "text"


@dataclass(frozen=True)
class Edge:
    name: str
    target: str  # an element, or LEAF
    repeated: bool = False


@dataclass
class ElementGraph:
    """``elements`` maps an element to its child edges; ``root`` is the element of a whole record."""

    root: str
    elements: dict[str, list[Edge]]
    relations: set[str] = field(init=False)
    leaf_lists: dict[tuple[str, str], str] = field(init=False)

    def __post_init__(self) -> None:
        parents: dict[str, set[str]] = defaultdict(set)
        repeated: set[str] = set()
        for parent, edges in self.elements.items():
            for e in edges:
                if e.target != LEAF:
                    parents[e.target].add(f"{parent}.{e.name}")
                    if e.repeated:
                        repeated.add(e.target)
        shared = {x for x, ps in parents.items() if len(ps) > 1}
        self.relations = {self.root} | repeated | shared | self._cyclic()
        names = Counter(e.name for es in self.elements.values() for e in es if e.target == LEAF and e.repeated)
        self.leaf_lists = {
            (parent, e.name): e.name if names[e.name] == 1 else f"{parent}_{e.name}"
            for parent, es in self.elements.items()
            for e in es
            if e.target == LEAF and e.repeated
        }

    def _cyclic(self) -> set[str]:
        found = set()
        for start in self.elements:
            todo, seen = [e.target for e in self.elements[start]], set()
            while todo:
                x = todo.pop()
                if x == start:
                    found.add(start)
                    break
                if x != LEAF and x not in seen:
                    seen.add(x)
                    todo += [e.target for e in self.elements.get(x, [])]
        return found

    def columns(self, relation: str) -> list[str]:
        """Dotted names of the leaves that are inlined into a relation."""
        if relation in self.leaf_lists.values():
            return ["value"]
        out: list[str] = []

        def down(element: str, prefix: str) -> None:
            for e in self.elements[element]:
                if e.target == LEAF and not e.repeated:
                    out.append(prefix + e.name)
                elif e.target != LEAF and e.target not in self.relations:
                    down(e.target, f"{prefix}{e.name}.")

        down(relation, "")
        return out

    def all_relations(self) -> list[str]:
        return sorted(self.relations) + sorted(self.leaf_lists.values())

    @classmethod
    def from_struct(cls, root: str, schema: T.StructType, shared_types: dict[str, str] | None = None) -> ElementGraph:
        """``shared_types`` maps a field path to an element name, for types that several paths have in common."""
        elements: dict[str, list[Edge]] = {}
        names = shared_types or {}

        def visit(name: str, struct: T.StructType, path: str) -> None:
            if name in elements:
                return
            edges = elements[name] = []
            for f in struct.fields:
                kind, many = f.dataType, False
                if isinstance(kind, T.ArrayType):
                    kind, many = kind.elementType, True
                p = f"{path}.{f.name}".lstrip(".")
                if isinstance(kind, T.StructType):
                    child = names.get(p, f.name if f.name not in elements and f.name != root else p)
                    edges.append(Edge(f.name, child, many))
                    visit(child, kind, p)
                else:
                    edges.append(Edge(f.name, LEAF, many))

        visit(root, schema, "")
        return cls(root, elements)


_decoder = json.JSONDecoder()
#: Starts of objects and lists that are encoded as strings, once or more often.
_ENCODED = re.compile(r'"\s*(?:\\+["nrt]\s*)*[{\[]')


def _as_object(value: object) -> object:
    """An object, or a list, that was given as JSON text is that object, however often it was encoded."""
    while isinstance(value, str):
        text = value.strip()
        if text[:1] not in ("{", "[", '"') or len(text) < 2:
            break
        try:
            value = json.loads(text)
        except (ValueError, RecursionError):
            break
    return value


def _search(value: object, signature: frozenset[str]) -> dict | None:
    """The first object, in document order, with all the keys; an explicit stack bears any depth."""
    stack = [value]
    while stack:
        value = _as_object(stack.pop())
        if isinstance(value, dict):
            if signature <= value.keys():
                return value
            stack += reversed(value.values())
        elif isinstance(value, list):
            stack += reversed(value)
    return None


def find_record(text: str | None, signature: frozenset[str]) -> dict | None:
    """The first complete JSON object in ``text`` that has all the keys of ``signature``.

    Prose, fences, wrapper objects, lists and JSON that was encoded as a string are looked through.
    A text that is cut off inside the record gives None.
    """
    if not text:
        return None
    try:
        whole = json.loads(text)
    except (ValueError, RecursionError):
        pass
    else:
        return _search(whole, signature)
    # no record begins behind the last place of one of its keys
    last = min(max(text.rfind(f'"{k}"'), text.rfind(f'\\"{k}\\"')) for k in signature)
    pos = 0
    while True:
        starts = [i for i in (text.find("{", pos), text.find("[", pos)) if i >= 0]
        if not starts:
            break
        at = min(starts)
        try:
            value, end = _decoder.raw_decode(text, at)
        except (ValueError, RecursionError):
            pos = at + 1
            if pos > last:
                break
            continue
        if (found := _search(value, signature)) is not None:
            return found
        pos = end
    pos = 0
    while m := _ENCODED.search(text, pos):
        try:
            value, end = _decoder.raw_decode(text, m.start())
        except json.JSONDecodeError as e:
            # every start before the fault runs into the same fault
            if e.pos <= m.start():
                break
            pos = e.pos
            continue
        if (found := _search(value, signature)) is not None:
            return found
        pos = end - 1
    return None


def scalar_text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    return json.dumps(value, ensure_ascii=False)


SHRED_SCHEMA = T.StructType(
    [
        T.StructField("relation", T.StringType(), False),
        T.StructField("node", T.LongType(), False),
        T.StructField("parent_relation", T.StringType()),
        T.StructField("parent_node", T.LongType()),
        T.StructField("parent_ordinal", T.LongType()),
        T.StructField("edge", T.StringType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)


def shred_record(record: dict, graph: ElementGraph) -> list[tuple]:
    """The relation rows of one record, in document order; an explicit stack bears any depth of recursion."""
    rows: list[list] = []
    stack: list[tuple] = [(graph.root, record, None, None, None, None, 0)]
    while stack:
        relation, value, p_rel, p_node, p_ord, edge, ordinal = stack.pop()
        node = len(rows)
        fields: dict[str, str | None] = {}
        rows.append([relation, node, p_rel, p_node, p_ord, edge, ordinal, fields])
        if relation not in graph.elements:
            fields["value"] = scalar_text(value)
            continue
        later: list[tuple] = []
        inline: list[tuple[str, dict, str]] = [(relation, value if isinstance(value, dict) else {}, "")]
        if not isinstance(value, dict):
            fields["value"] = scalar_text(value)
        while inline:
            element, content, prefix = inline.pop()
            for e in graph.elements[element]:
                x = content.get(e.name)
                if x is None:
                    continue
                if e.target == LEAF and not e.repeated:
                    fields[prefix + e.name] = scalar_text(x)
                    continue
                if e.repeated:
                    opened = _as_object(x)
                    items = opened if isinstance(opened, list) else [x]
                else:
                    items = [x]
                target = graph.leaf_lists[(element, e.name)] if e.target == LEAF else e.target
                for k, item in enumerate(items):
                    if e.target != LEAF and isinstance(opened := _as_object(item), dict):
                        item = opened
                    if item is None:
                        continue
                    if e.target == LEAF or e.target in graph.relations:
                        later.append((target, item, relation, node, ordinal, prefix + e.name, k))
                    elif isinstance(item, dict):
                        inline.append((e.target, item, f"{prefix}{e.name}."))
        stack += reversed(later)
    return [tuple(r) for r in rows]


def shred(df: DataFrame, id_col: str, text_col: str, graph: ElementGraph, signature: frozenset[str], only: set[str] | None = None) -> DataFrame:
    """All relation rows of all records, as one long table.

    Columns: ``id_col`` and those of ``SHRED_SCHEMA``. ``ordinal`` counts from 0 in a list as written, null
    elements keep their place and give no row, and a bare value in place of a list is a list of one.
    Null, empty or cut-off texts, and texts without a record, give no rows; an empty table gives none;
    repeated input rows each give their own rows; columns other than the two named are ignored.
    ``only`` limits the relations that leave the worker.
    """
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField("record_key", id_type), *SHRED_SCHEMA.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = schema.fieldNames()
        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(batch["k"], batch["t"]):
                record = find_record(text if isinstance(text, str) else None, signature)
                if record is not None:
                    out += [(key, *r) for r in shred_record(record, graph) if only is None or r[0] in only]
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    rows = spread(df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")))
    return rows.mapInPandas(run, schema).withColumnRenamed("record_key", id_col)


def record_texts(df: DataFrame, id_col: str, text_col: str, signature: frozenset[str]) -> DataFrame:
    """(id, record): the record of each text that has one, as compact JSON, whatever it was wrapped in; fields that are encoded as text are opened."""
    kind = df.schema[id_col].dataType.simpleString()

    def opened(value: object) -> object:
        value = _as_object(value) if isinstance(value, str) and value[:1] in "{[" else value
        if isinstance(value, dict):
            return {k: opened(v) for k, v in value.items()}
        return [opened(v) for v in value] if isinstance(value, list) else value

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(k, find_record(t if isinstance(t, str) else None, signature)) for k, t in zip(b["k"], b["t"])]
            yield pd.DataFrame([(k, json.dumps(opened(r), ensure_ascii=False)) for k, r in found if r is not None], columns=["k", "record"])

    rows = spread(df.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")))
    return rows.mapInPandas(run, f"k {kind}, record string").withColumnRenamed("k", id_col)


def relation_table(shredded: DataFrame, id_col: str, graph: ElementGraph, relation: str) -> DataFrame:
    """One relation as a flat table: key ``(id_col, node)``, foreign key ``(parent_relation, parent_node)``, ordinal, inlined leaves."""
    keys = [id_col, "node", "parent_relation", "parent_node", "edge", "ordinal"]
    leaves = [F.col("fields")[c].alias(c.replace(".", "_")) for c in graph.columns(relation)]
    return shredded.filter(F.col("relation") == relation).select(*keys, *leaves)


def infer_graph(df: DataFrame, text_col: str, signature: frozenset[str], root: str = "record", max_paths: int = 10_000) -> ElementGraph:
    """The element graph that the records themselves show, found in one aggregated pass over all rows.

    An element is named by its path without positions. Only distinct paths reach the driver; more than
    ``max_paths`` of them (keys that are data, not names) raise an error.
    """
    schema = "path string, object boolean, many boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: set[tuple[str, bool, bool]] = set()
            for text in batch["t"]:
                record = find_record(text if isinstance(text, str) else None, signature)
                todo = [("", record)] if record is not None else []
                while todo:
                    path, value = todo.pop()
                    for name, x in value.items():
                        x = _as_object(x)
                        many = isinstance(x, list)
                        for item in x if many else [x]:
                            item = _as_object(item)
                            if item is None:
                                continue
                            p = f"{path}.{name}".lstrip(".")
                            seen.add((p, isinstance(item, dict), many))
                            if isinstance(item, dict):
                                todo.append((p, item))
            yield pd.DataFrame(sorted(seen), columns=["path", "object", "many"])

    paths = df.select(F.col(text_col).alias("t")).mapInPandas(run, schema).groupBy("path").agg(F.max("object").alias("object"), F.max("many").alias("many"))
    found = paths.limit(max_paths + 1).collect()
    if len(found) > max_paths:
        raise ValueError(f"more than {max_paths} distinct paths")
    elements: dict[str, list[Edge]] = {root: []} | {r.path: [] for r in found if r.object}
    for r in sorted(found):
        parent, _, name = r.path.rpartition(".")
        elements[parent or root].append(Edge(name, r.path if r.object else LEAF, r.many))
    return ElementGraph(root, elements)
