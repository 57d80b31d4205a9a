"""Queries over the nested JSON fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from foreglass.operators.shred import Repeated, element_keys, flat_table, shred
from foreglass.queries.loose_sql import elements, loose

PROBABILITIES = Repeated("probabilities", "probabilities", "market", "probability", ("probability",), (Repeated("evidence", "evidence", "source_id", None, ("weight",)),), within="prediction")
MARKETS = Repeated("markets", "", "market", "price", ("yes_ask", "yes_bid", "no_ask", "no_bid", "liquidity"), (Repeated("levels", "levels", "price", None, ("size",)),))
SOURCES = Repeated("sources", "", "source_id", None, ("url", "title", "summary", "ranking"), (Repeated("related", "related", "source_id", None, ("score.text", "score.time")),), within="sources")

#: Field, table, identifier and shape of each nested text.
FIELDS = {
    "prediction": ("predictions", "prediction_id", PROBABILITIES),
    "market_data": ("submissions", "submission_id", MARKETS),
    "sources": ("sampled_rows", "submission_id", SOURCES),
}


def _shredded(spark: SparkSession, sf_dir: str, field: str, keep: list[str] | None = None) -> DataFrame:
    table, identifier, shape = FIELDS[field]
    return shred(spark.read.parquet(f"{sf_dir}/{table}.parquet"), identifier, field, shape, keep)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of all children and grandchildren of the three nested fields."""
    found = None
    for field, (_, _, shape) in FIELDS.items():
        keys = element_keys(_shredded(spark, sf_dir, field, keep=[]), shape).select(F.lit(field).alias("field_name"), "root_id", "child_key", "grandchild_key")
        found = keys if found is None else found.union(keys)
    return found


def _table(field: str, child: bool):
    shape = FIELDS[field][2]
    part = shape if child else shape.children[0]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # repeated deliveries of a row give the same rows once
        return flat_table(_shredded(spark, sf_dir, field), part).distinct()

    query.__doc__ = f"The flat table {part.name} of {field}."
    return query


QUERIES = {"p7_found": p7_found} | {f"p7_{part}": _table(field, child) for field, part, child in [
    ("prediction", "probabilities", True), ("prediction", "evidence", False),
    ("market_data", "markets", True), ("market_data", "levels", False),
    ("sources", "sources", True), ("sources", "related", False),
]}


def _leaf_sql(part: Repeated, leaf: str) -> str:
    """A leaf of the element ``e`` as text."""
    first, _, rest = leaf.partition(".")
    inside = f"e.value->>'$.\"{leaf}\"'" if not rest else f"coalesce(e.value->>'$.\"{leaf}\"', e.value->'{first}'->>'{rest}')"
    return f"case when json_type(e.value) = 'OBJECT' then {inside} {'else ' + _text_sql('e.value') if leaf == part.scalar else ''} end"


def _text_sql(json: str) -> str:
    return f"({json})->>'$'"


def _tables_sql(field: str) -> str:
    """Common table expressions ``child`` and ``grandchild`` with the elements of a field, in the order of the record."""
    table, identifier, shape = FIELDS[field]
    inner = f"case when json_type(j->'{shape.within}') in ('OBJECT', 'ARRAY') then j->'{shape.within}' else j end" if shape.within else "j"
    part = f"case when json_type(k) = 'OBJECT' then k->'{shape.field}' end" if shape.field else "k"
    below = shape.children[0]
    return f"""{loose('whole', f'select distinct cast({identifier} as varchar) root_id, {field} text from {table} where {field} is not null', 'text')},
 record as (select row_number() over () record, root_id, {inner} k from whole where j is not null),
 listed as (select record, root_id, {elements('l', shape.key, shape.scalar)} l from (select record, root_id, {part} l from record)),
 child as (select record, root_id, i - 1 place, l[i] e from listed, unnest(generate_series(1, len(l))) s(i)),
 inside as (select record, root_id, place parent, e.key parent_key, {elements("(e.value->'" + below.field + "')", below.key, below.scalar)} l from child where json_type(e.value) = 'OBJECT'),
 grandchild as (select record, root_id, row_number() over (partition by record order by parent, i) - 1 place, parent, parent_key, l[i] e from inside, unnest(generate_series(1, len(l))) s(i))"""


def _table_sql(field: str, child: bool) -> str:
    shape = FIELDS[field][2]
    part = shape if child else shape.children[0]
    leaves = "".join(f", {_leaf_sql(part, leaf)} {leaf.replace('.', '_')}" for leaf in part.leaves if leaf != part.key)
    above = "-1 parent, cast(null as varchar) parent_key" if child else "parent, parent_key"
    return f"with {_tables_sql(field)}\n select distinct root_id, place, {above}, e.key \"key\"{leaves} from {'child' if child else 'grandchild'}"


def _keys_sql(field: str) -> str:
    rows = "select root_id, e.key child_key, '' grandchild_key from child union select root_id, parent_key, e.key from grandchild"
    return f"select '{field}' field_name, * from (with {_tables_sql(field)} {rows}) where root_id is not null and child_key is not null and grandchild_key is not null"


ORACLE = {"p7_found": " union all ".join(_keys_sql(field) for field in FIELDS)} | {
    f"p7_{(FIELDS[field][2] if child else FIELDS[field][2].children[0]).name}": _table_sql(field, child) for field in FIELDS for child in (True, False)
}
