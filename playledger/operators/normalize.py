"""Nested records to parent and child tables.

Structs become `parent__field` columns. Every list becomes a child table whose rows point to
their parent (`_dlt_parent_id`), to the root record (`_dlt_root_id`) and to their place in the
list (`_dlt_list_idx`). Row ids are hashes of the root key and the path, so a rerun gives the
same ids. Nothing here shuffles: a child row is made where its parent row is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playledger.operators.upsert import new_keys, upsert

ROW_ID, PARENT_ID, ROOT_ID, LIST_IDX = "_dlt_id", "_dlt_parent_id", "_dlt_root_id", "_dlt_list_idx"


def snake_case(name: str) -> str:
    """`PyongsCount` and `pyongs-count` to `pyongs_count`; runs of underscores become one."""
    name = re.sub(r"[^0-9A-Za-z_]", "_", name)
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    name = re.sub(r"_+", "_", name).lower()
    return f"_{name}" if name[:1].isdigit() else name


def _row_id(*parts: Column) -> Column:
    """Hash of the parts, each with its length, so that no two lists of parts run together."""
    texts = [part.cast("string") for part in parts]
    marked = [F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts]
    return F.md5(F.concat(*marked))


def _unfold(column: Column, kind: T.DataType, name: str):
    """(plain columns, list columns) of a field, structs unfolded."""
    if isinstance(kind, T.StructType):
        plain, lists = {}, {}
        for field in kind.fields:
            sub_plain, sub_lists = _unfold(
                column.getField(field.name), field.dataType, f"{name}__{snake_case(field.name)}"
            )
            plain.update(sub_plain)
            lists.update(sub_lists)
        return plain, lists
    if isinstance(kind, T.ArrayType):
        return {}, {name: (column, kind.elementType)}
    return {name: column}, {}


def _unfold_all(fields):
    plain, lists = {}, {}
    for name, column, kind in fields:
        sub_plain, sub_lists = _unfold(column, kind, name)
        plain.update(sub_plain)
        lists.update(sub_lists)
    return plain, lists


def normalize(records: DataFrame, table: str, keys: Sequence[str]) -> dict[str, DataFrame]:
    """`{table: parent rows, table__list: child rows, ...}` of nested records unique on `keys`."""
    root_id = _row_id(F.lit(table), *(F.col(key) for key in keys))
    plain, lists = _unfold_all(
        (snake_case(f.name), F.col(f"`{f.name}`"), f.dataType) for f in records.schema.fields
    )
    columns = [column.alias(name) for name, column in plain.items()]
    tables = {table: records.select(*columns, root_id.alias(ROW_ID))}
    base = records.withColumns({ROW_ID: root_id, ROOT_ID: root_id})
    tables.update(_children(base, table, lists))
    return tables


def _children(parents: DataFrame, table: str, lists) -> dict[str, DataFrame]:
    tables = {}
    for name, (column, kind) in lists.items():
        child = f"{table}__{name}"
        items = parents.select(
            F.col(ROOT_ID),
            F.col(ROW_ID).alias(PARENT_ID),
            F.posexplode(column).alias(LIST_IDX, "value"),
        )
        items = items.withColumn(LIST_IDX, F.col(LIST_IDX).cast("long")).withColumn(
            ROW_ID, _row_id(F.col(PARENT_ID), F.lit(name), F.col(LIST_IDX))
        )
        links = [PARENT_ID, LIST_IDX, ROW_ID, ROOT_ID]
        if isinstance(kind, T.StructType):
            plain, nested = _unfold_all(
                (snake_case(f.name), F.col("value").getField(f.name), f.dataType)
                for f in kind.fields
            )
        else:
            plain, nested = _unfold(F.col("value"), kind, "value")
        tables[child] = items.select(*(c.alias(n) for n, c in plain.items()), *links)
        tables.update(_children(items, child, nested))
    return tables


def _fold_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per parent in a batch: its number of rows and its distinct values."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        values = rows.group_by([PARENT_ID, "value"], use_threads=False).aggregate([([], "count_all")])
        folded = values.group_by([PARENT_ID], use_threads=False).aggregate([("count_all", "sum"), ("value", "list")])
        folded = folded.select([PARENT_ID, "count_all_sum", "value_list"]).rename_columns([PARENT_ID, "rows", "values"])
        yield from folded.combine_chunks().to_batches()


def count_values(children: DataFrame) -> DataFrame:
    """Rows and distinct values per parent of a plain list's child table: `_dlt_parent_id, rows, distinct_values`.

    The children of a parent lie together where it is, so they are folded there: one row per
    parent is shuffled, with its id once, not one per value. A parent whose children come from
    several batches or records is merged behind the shuffle.
    """
    values = children.select(PARENT_ID, "value")
    kind = values.schema["value"].dataType.simpleString()
    folded = values.mapInArrow(_fold_values, f"{PARENT_ID} string, rows bigint, values array<{kind}>")
    # Shuffled as they are: a fold in the map tasks would sort them for next to nothing.
    by_parent = folded.repartition(PARENT_ID).groupBy(PARENT_ID)
    merged = by_parent.agg(F.sum("rows").alias("rows"), F.collect_list("values").alias("values"))
    distinct = F.size(F.array_distinct(F.flatten("values"))).cast("long")
    return merged.select(PARENT_ID, "rows", distinct.alias("distinct_values"))


def merge_children(target: DataFrame, incoming: DataFrame, roots: DataFrame) -> DataFrame:
    """Child rows follow their root: those of the rewritten roots are replaced as a whole."""
    rewritten = roots.select(F.col(ROW_ID).alias(ROOT_ID))
    kept = new_keys(target, rewritten, [ROOT_ID], unique=True)
    return kept.unionByName(incoming, allowMissingColumns=True)


def merge_normalized(
    current: dict[str, DataFrame], incoming: dict[str, DataFrame], table: str, keys: Sequence[str]
) -> dict[str, DataFrame]:
    """Merged parent and child tables; `incoming` must be unique on `keys`."""
    merged = {}
    for name in {**current, **incoming}:
        if name not in current:
            merged[name] = incoming[name]
        elif name == table:
            merged[name] = upsert(current[name], incoming[name], keys)
        else:
            fresh = incoming.get(name, current[name].limit(0))
            merged[name] = merge_children(current[name], fresh, incoming[table])
    return merged
