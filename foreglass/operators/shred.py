"""Deeply nested records as related flat tables (problem 7).

Method: columnar shredding. Every leaf path of the record becomes a column of
values with repetition and definition levels; the table of each repeated
ancestor is rebuilt from the level sequences, with the link to its parent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foreglass.functions import loosejson


@dataclass(frozen=True)
class Repeated:
    """A repeated part of a record: an array, or an object whose field names are the keys of its elements.

    ``name``: of the table; ``field``: where the part stands in its parent
    ('' for the parent itself); ``key``: the leaf that names an element, taken
    from the field name where the part is an object; ``scalar``: the leaf that
    an element which is no object stands for; ``leaves``: dotted paths of the
    other leaves; ``within``: a field that may wrap the record.
    """

    name: str
    field: str
    key: str
    scalar: str | None = None
    leaves: tuple[str, ...] = ()
    children: tuple["Repeated", ...] = field(default=())
    within: str | None = None

    def columns(self, keep: frozenset[str] | None) -> tuple[str, ...]:
        return (self.key, *(x for x in self.leaves if x != self.key and (keep is None or f"{self.name}.{x}" in keep)))


class Column:
    """Values of one leaf path. A definition level is the number of repeated ancestors present, plus one for a value that is not null."""

    __slots__ = ("repetition", "definition", "values")

    def __init__(self):
        self.repetition: list[int] = []
        self.definition: list[int] = []
        self.values: list[str | None] = []

    def add(self, repetition: int, definition: int, value: str | None) -> None:
        self.repetition.append(repetition)
        self.definition.append(definition)
        self.values.append(value)


def as_text(value: object) -> str | None:
    """A leaf as text: strings as they are, other values in JSON notation, None for null."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    return loosejson.json.dumps(value, ensure_ascii=False) if isinstance(value, (dict, list)) else str(value)


def _elements(value: object, part: Repeated) -> list[dict]:
    if isinstance(value, dict):
        return [({**x, part.key: k} if isinstance(x, dict) else {part.key: k, part.scalar: x}) for k, x in value.items()]
    if isinstance(value, list):
        return [x if isinstance(x, dict) else {part.scalar or part.key: x} for x in value]
    return []


def _leaf(element: dict, path: str) -> object:
    if path in element or "." not in path:
        return element.get(path)
    first, rest = path.split(".", 1)
    inner = element.get(first)
    return _leaf(inner, rest) if isinstance(inner, dict) else None


class Shredder:
    """Takes records apart into level columns and rebuilds the tables from them."""

    def __init__(self, root: Repeated, keep: frozenset[str] | None = None):
        self.root = root
        self.keep = keep
        self.columns: dict[tuple[str, str], Column] = {}
        self.parts: list[tuple[Repeated, Repeated | None, int]] = []
        self._prepare(root, None, 1)

    def _prepare(self, part: Repeated, parent: Repeated | None, depth: int) -> None:
        self.parts.append((part, parent, depth))
        for leaf in part.columns(self.keep):
            self.columns[part.name, leaf] = Column()
        for child in part.children:
            self._prepare(child, part, depth + 1)

    def record(self, value: object) -> None:
        root = self.root
        if root.within and isinstance(value, dict) and isinstance(value.get(root.within), (dict, list)):
            value = value[root.within]
        if root.field:
            value = value.get(root.field) if isinstance(value, dict) else None
        self._shred(root, value, 1, 0)

    def _missing(self, part: Repeated, repetition: int, definition: int) -> None:
        for leaf in part.columns(self.keep):
            self.columns[part.name, leaf].add(repetition, definition, None)
        for child in part.children:
            self._missing(child, repetition, definition)

    def _shred(self, part: Repeated, value: object, depth: int, repetition: int) -> None:
        elements = _elements(value, part)
        if not elements:
            self._missing(part, repetition, depth - 1)
            return
        for element in elements:
            for leaf in part.columns(self.keep):
                text = as_text(_leaf(element, leaf))
                self.columns[part.name, leaf].add(repetition, depth if text is None else depth + 1, text)
            for child in part.children:
                self._shred(child, element.get(child.field), depth + 1, repetition)
            repetition = depth

    def tables(self) -> Iterator[tuple[Repeated, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """``(part, record, place, parent place, parent element, leaf values)`` of each part, rebuilt from the levels.

        ``record``, ``place`` and ``parent place`` number the records of the
        block, the elements of a part in its record, and the elements its
        parent had by then; ``parent element`` numbers the parent's elements
        in the block.
        """
        for part, parent, depth in self.parts:
            first = self.columns[part.name, part.key]
            repetition, definition = np.array(first.repetition, np.int16), np.array(first.definition, np.int16)
            present = definition >= depth
            record = np.cumsum(repetition == 0) - 1
            place = _within_record(present & (repetition <= depth), record)
            above = (definition >= depth - 1) & (repetition <= depth - 1)
            parent_place = _within_record(above, record) if parent else np.full(len(record), -1)
            parent_element = np.cumsum(above) - 1 if parent else np.full(len(record), -1)
            values = [np.array(self.columns[part.name, leaf].values, object)[present] for leaf in part.columns(self.keep)]
            yield part, record[present], place[present], parent_place[present], parent_element[present], values


def _within_record(starts: np.ndarray, record: np.ndarray) -> np.ndarray:
    """Number, from 0, of the element that is open at each slot, counted anew in every record."""
    if not len(record):
        return np.zeros(0, np.int64)
    count = np.cumsum(starts)
    first = np.flatnonzero(np.diff(record, prepend=-1))
    base = (count - starts)[first]
    return count - base[record] - 1


def shred(df: DataFrame, identifier: str, text: str, root: Repeated, keep: list[str] | None = None, block: int = 2000) -> DataFrame:
    """``(root_id, elements)``: for each record with elements, its elements of all tables.

    An element is ``(part, place, parent, parent_key, key, leaves)``: the
    table's name, its number in the record, the number and key of its parent
    (-1 and null under the record), its own key and a map of its other leaves
    as text. ``keep`` names the leaves to take along, as ``table.leaf`` (all if
    None); keys always come. Null texts, texts cut off before their end and
    records without elements give no row. Records stay where they are: nothing
    is shuffled. ``root_id`` is text and may repeat or be null.
    """
    kept = None if keep is None else frozenset(keep)
    picked = df.select(df[identifier].cast("string").alias("root_id"), df[text].alias("text")).filter(F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                yield _block(batch.slice(at, block), root, kept)

    return picked.mapInArrow(run, "root_id string, elements array<struct<part: string, place: int, parent: int, parent_key: string, key: string, leaves: map<string,string>>>")


_ELEMENT = pa.struct([("part", pa.string()), ("place", pa.int32()), ("parent", pa.int32()), ("parent_key", pa.string()), ("key", pa.string()), ("leaves", pa.map_(pa.string(), pa.string()))])


def _block(batch: pa.RecordBatch, root: Repeated, keep: frozenset[str] | None) -> pa.RecordBatch:
    shredder = Shredder(root, keep)
    for text in batch.column("text").to_pylist():
        shredder.record(loosejson.read(text))
    keys: dict[str, np.ndarray] = {}
    parents = {part.name: parent for part, parent, _ in shredder.parts}
    record, part_name, place, parent, parent_key, key, leaf_count, leaf_names, leaf_values = [], [], [], [], [], [], [], [], []
    for part, rows, places, parent_places, parent_elements, values in shredder.tables():
        keys[part.name] = values[0]
        above = parents[part.name]
        record.append(rows)
        part_name += [part.name] * len(rows)
        place.append(places)
        parent.append(parent_places)
        parent_key.append(keys[above.name][parent_elements] if above else np.full(len(rows), None, object))
        key.append(values[0])
        names = part.columns(keep)[1:]
        leaf_count.append(np.full(len(rows), len(names)))
        leaf_names += list(names) * len(rows)
        leaf_values.append(np.stack(values[1:], axis=1).ravel() if names else np.zeros(0, object))
    record = np.concatenate(record)
    order = np.argsort(record, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(leaf_count))]).astype(np.int32)
    leaves = pa.MapArray.from_arrays(pa.array(offsets), pa.array(leaf_names, pa.string()), pa.array(np.concatenate(leaf_values), pa.string()))
    columns = [pa.array(part_name, pa.string()), pa.array(np.concatenate(place), pa.int32()), pa.array(np.concatenate(parent), pa.int32()), pa.array(np.concatenate(parent_key), pa.string()), pa.array(np.concatenate(key), pa.string()), leaves]
    elements = pa.StructArray.from_arrays(columns, fields=list(_ELEMENT)).take(pa.array(order))
    some, counts = np.unique(record, return_counts=True)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), elements)
    return pa.RecordBatch.from_arrays([batch.column("root_id").take(pa.array(some)), lists], names=["root_id", "elements"])


def flat_table(shredded: DataFrame, part: Repeated) -> DataFrame:
    """One table: ``root_id, place, parent, parent_key, key`` and a text column for each leaf, dots as underscores."""
    rows = shredded.select("root_id", F.explode(F.filter("elements", lambda e: e.part == part.name)).alias("e"))
    leaves = [F.col("e.leaves")[leaf].alias(leaf.replace(".", "_")) for leaf in part.leaves if leaf != part.key]
    return rows.select("root_id", "e.place", "e.parent", "e.parent_key", "e.key", *leaves)


def element_keys(shredded: DataFrame, child: Repeated) -> DataFrame:
    """``(root_id, child_key, grandchild_key)``: the distinct keys of the children ('' as grandchild) and of their children.

    Keys that repeat in a record go before anything is exploded, copies of a
    record by hash aggregation on all columns, so no record and no hot
    ``root_id`` gathers in one task. Null ids and keys are left out.
    """
    names = F.transform("elements", lambda e: F.when(e.part == child.name, F.struct(e.key.alias("child_key"), F.lit("").alias("grandchild_key"))).otherwise(F.struct(e.parent_key.alias("child_key"), e.key.alias("grandchild_key"))))
    rows = shredded.filter("root_id is not null").select("root_id", F.explode(F.array_distinct(names)).alias("e"))
    return rows.select("root_id", "e.child_key", "e.grandchild_key").filter("child_key is not null and grandchild_key is not null").distinct()
