"""Nested JSON to related flat tables by shared inlining.

The schema graph has a node for each element name and an edge for each parent and child seen, marked where the child repeats. An
element gets a table of its own if it is the root, repeats below some parent, has more than one parent, or is recursive; every
other element is inlined, its scalars becoming dotted columns of the nearest ancestor with a table. Every row has its table,
the path of element names, its position and its parent's: `pos` holds one place (from 1, null members counted) for each
ancestor with a table and for the row itself, so (document, path, pos) is the primary key and the same without the last place
the foreign key.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: More element names than this are no schema but data in the place of names; the graph is refused, never cut.
MAX_EDGES = 20_000
ROOT = "entry"


def read_json(text: str | None):
    """The value of a JSON text, also behind a byte order mark or packed in JSON strings; None if it can't be read as a whole."""
    value = text
    for _ in range(8):
        if not isinstance(value, str):
            return value
        try:
            value = json.loads(value.lstrip("﻿").strip())
        except (ValueError, RecursionError):
            return None
    return None


def scalar(value) -> str | None:
    """A scalar as text: strings as they are, everything else as compact JSON; lone surrogates become U+FFFD."""
    if value is None:
        return None
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    try:
        text.encode()
    except UnicodeEncodeError:
        text = text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return text


def _members(value) -> list:
    """A lone object or value counts as a list of one, null as none."""
    return value if isinstance(value, list) else [] if value is None else [value]


@dataclass(frozen=True)
class SchemaGraph:
    """edges: (parent, child, the child repeats, the child is an object)."""

    edges: tuple[tuple[str, str, bool, bool], ...]
    root: str = ROOT

    def tables(self) -> set[str]:
        """The elements that get a table."""
        parents: dict[str, set[str]] = {}
        children: dict[str, set[str]] = {}
        out = {self.root}
        for parent, child, repeats, _ in self.edges:
            parents.setdefault(child, set()).add(parent)
            children.setdefault(parent, set()).add(child)
            if repeats:
                out.add(child)
        nested = {child for _, child, _, is_object in self.edges if is_object}
        out |= {child for child, above in parents.items() if len(above) > 1 and child in nested}
        for start in children:  # recursive: the element is below itself
            seen, todo = set(), list(children[start])
            while todo:
                if (name := todo.pop()) not in seen:
                    seen.add(name)
                    todo += children.get(name, ())
            if start in seen:
                out.add(start)
        return out


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: set[tuple[str, str, bool, bool]] = set()
        for text in batch.column(0).to_pylist():
            todo = [(ROOT, m) for m in _members(read_json(text))]
            while todo:
                parent, value = todo.pop()
                if isinstance(value, list):
                    todo += [(parent, m) for m in value]
                elif isinstance(value, dict):
                    for name, child in value.items():
                        name = scalar(name)
                        found.add((parent, name, isinstance(child, list), any(isinstance(m, dict) for m in _members(child))))
                        todo.append((name, child))
        cols = list(zip(*sorted(found))) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.bool_()), pa.array(cols[3], pa.bool_())],
            names=["parent", "child", "repeats", "is_object"],
        )


def analyse(df: DataFrame, json_col: str) -> SchemaGraph:
    """The schema graph of all records; its size is that of the schema, not of the data, and is checked."""
    edges = (
        df.select(F.col(json_col).cast("string").alias("body"))
        .where(F.col("body").isNotNull())
        .mapInArrow(_edges, "parent string, child string, repeats boolean, is_object boolean")
        .groupBy("parent", "child")
        .agg(F.max("repeats").alias("repeats"), F.max("is_object").alias("is_object"))
    )
    rows = edges.limit(MAX_EDGES + 1).collect()
    if len(rows) > MAX_EDGES:
        raise ValueError(f"more than {MAX_EDGES} pairs of parent and child names: the records use data as names")
    return SchemaGraph(tuple(sorted((r.parent, r.child, r.repeats, r.is_object) for r in rows)))


ROW_SCHEMA = "`table` string, path string, parent_path string, pos array<int>, parent_pos array<int>, is_object boolean, value string, `columns` map<string,string>"
_KINDS = [pa.string(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.bool_(), pa.string(), pa.map_(pa.string(), pa.string())]
_NAMES = ["table", "path", "parent_path", "pos", "parent_pos", "is_object", "value", "columns"]


def _flatten(body, tables: set[str]) -> Iterator[tuple]:
    """The rows of one record, with a stack of their own: the depth of a record is bounded by its parser only."""
    todo = [(ROOT, ROOT, None, (i,), None, m) for i, m in enumerate(_members(body), 1)]
    todo.reverse()
    while todo:
        name, path, above, pos, above_pos, value = todo.pop()
        if value is None or value == {}:
            continue
        if isinstance(value, list):  # a list within a list: its members share the place
            todo += [(name, path, above, pos, above_pos, m) for m in reversed(value)]
            continue
        columns: dict[str, str] = {}
        below: list[tuple] = []
        if isinstance(value, dict):
            inner = [("", path, value)]
            while inner:
                prefix, at, obj = inner.pop()
                for key, child in obj.items():
                    key = scalar(key)
                    if key in tables:
                        below += [(key, f"{at}/{key}", path, (*pos, i), pos, m) for i, m in enumerate(_members(child), 1)]
                    elif isinstance(child, dict):
                        inner.append((f"{prefix}{key}.", f"{at}/{key}", child))
                    elif child is not None:
                        columns[prefix + key] = scalar(child)
            yield name, path, above, list(pos), above_pos and list(above_pos), True, None, list(columns.items())
        else:
            yield name, path, above, list(pos), above_pos and list(above_pos), False, scalar(value), []
        todo += reversed(below)


def shred(df: DataFrame, id_col: str, json_col: str, graph: SchemaGraph | None = None) -> DataFrame:
    """All rows of all flat tables of the records: the id, table, path, parent_path, pos, parent_pos, is_object, value, columns.

    A record that is null, blank, cut off or no JSON gives no rows. null members give no row but keep their place. A lone object
    or value counts as a list of one. The same record twice under two ids gives its rows twice. Other columns of `df` are ignored,
    whatever their names. Text of any depth that the parser reads is flattened without recursion.
    """
    tables = (graph or analyse(df, json_col)).tables()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = list(_flatten(read_json(text), tables))
                at += [i] * len(own)
                rows += own
            cols = list(zip(*rows)) or [[]] * len(_NAMES)
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(cols, _KINDS))], names=["id", *_NAMES])

    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(F.col(id_col).alias("id"), F.col(json_col).cast("string").alias("body")).where(F.col("body").isNotNull())
    return source.mapInArrow(run, f"id {kind}, {ROW_SCHEMA}").withColumnRenamed("id", id_col)


def flat_table(shredded: DataFrame, id_col: str, name: str, columns: list[str]) -> DataFrame:
    """One table of a `shred` result with the given columns; a column that no row has is null throughout."""
    keys = [id_col, "path", "parent_path", "pos", "parent_pos", "value"]
    return shredded.where(F.col("table") == name).select(*keys, *(F.col("columns")[c].alias(c) for c in columns))


def lexicon_nodes(bodies: DataFrame, id_col: str = "body_id", json_col: str = "body") -> DataFrame:
    """The items, phrases and phrase translations of dictionary bodies: id, entry_no, kind, node_no, leaf_no, val.

    Objects of `item` and of an entry's own `phrase` (an empty object is an empty member) and the non-empty members of a phrase's
    `x`; a missing or null text gives ''.
    """
    graph = analyse(bodies, json_col)
    always = {(ROOT, "item", True, True), (ROOT, "phrase", True, True), ("phrase", "x", True, False)}
    rows = shred(bodies, id_col, json_col, SchemaGraph(tuple(sorted(set(graph.edges) | always))))
    val = {"item": "text", "phrase": "w"}
    node = (
        rows.where(F.col("path").isin(f"{ROOT}/item", f"{ROOT}/phrase") & F.col("is_object"))
        .withColumn("kind", F.col("table"))
        .withColumn("val", F.coalesce(F.when(F.col("kind") == "item", F.col("columns")[val["item"]]).otherwise(F.col("columns")[val["phrase"]]), F.lit("")))
        .withColumn("leaf_no", F.lit(0))
    )
    leaf = (
        rows.where((F.col("path") == f"{ROOT}/phrase/x") & (F.coalesce(F.col("value"), F.lit("")) != ""))
        .withColumn("kind", F.lit("x"))
        .withColumn("val", F.col("value"))
        .withColumn("leaf_no", F.col("pos")[2])
    )
    shape = [id_col, F.col("pos")[0].alias("entry_no"), "kind", F.col("pos")[1].alias("node_no"), "leaf_no", "val"]
    return node.select(*shape).unionByName(leaf.select(*shape))
