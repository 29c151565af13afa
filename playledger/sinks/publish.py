"""Tables that change at one moment: versions behind views, and one view that names the versions.

A published name is a view. Its rows are a partition of `<name>__versions`, and which partition
it is stands in the pointer, a view without files that holds one version per published name.
Replacing the pointer is one catalog statement, so a reader finds the old tables or the new
ones, never none and never some of each. A failure before that statement leaves a version no
pointer names; the next publication drops it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger.operators.upsert import dedupe, upsert
from playledger.sinks.tables import staged

VERSION = "published_version"


def _column(name: str) -> str:
    return name.split(".")[-1].lower()


def published_versions(spark: SparkSession, pointer: str) -> dict[str, str]:
    """The version of each name of a pointer, by the last part of the name; empty before the first."""
    if not spark.catalog.tableExists(pointer):
        return {}
    return spark.table(pointer).first().asDict()


def _versions_table(df: DataFrame, name: str) -> list[str]:
    """Makes the table of versions, or adds the columns it lacks; returns all its data columns."""
    spark, table = df.sparkSession, f"{name}__versions"
    if VERSION in df.columns:
        raise ValueError(f"{VERSION} is the name of the version column")
    given = {f.name: f.dataType for f in df.schema.fields}
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{n}` {t.simpleString()}" for n, t in given.items())
        spark.sql(f"CREATE TABLE {table} ({columns}, {VERSION} STRING) USING parquet PARTITIONED BY ({VERSION})")
    known = {f.name: f.dataType for f in spark.table(table).schema.fields if f.name != VERSION}
    differ = [n for n in given if n in known and known[n].simpleString() != given[n].simpleString()]
    if differ:
        raise ValueError(f"{name} holds other types in {differ}")
    added = [n for n in given if n not in known]
    if added:
        columns = ", ".join(f"`{n}` {given[n].simpleString()}" for n in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [*known, *added]


def _drop_versions(spark: SparkSession, name: str, kept: set[str | None]) -> None:
    table = f"{name}__versions"
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        version = row[0].split("=", 1)[1]
        if version not in kept:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({VERSION} = '{version}')")


def _point(spark: SparkSession, pointer: str, versions: dict[str, str]) -> None:
    named = ", ".join(f"'{version}' AS `{column}`" for column, version in versions.items())
    spark.sql(f"CREATE OR REPLACE VIEW {pointer} AS SELECT {named}")


def publish(frames: dict[str, DataFrame], pointer: str) -> dict[str, int]:
    """Replaces the published tables by `frames`, all at one moment; returns rows per name.

    Names of the pointer that are not in `frames` keep their version. The version replaced now
    stays until the next publication, for readers that have begun. A name that already is a plain
    table, two names with one last part, a column of another type than before and a column named
    as the version's are refused before anything is written. A frame may read the name it
    replaces. One publication runs at a time per pointer.
    """
    spark = next(iter(frames.values())).sparkSession
    if len({_column(name) for name in frames}) < len(frames):
        raise ValueError("published names must differ in their last part")
    for name in frames:
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            raise ValueError(f"{name} is a plain table, not a published one")
    old = published_versions(spark, pointer)
    new, counts = uuid.uuid4().hex, {}
    columns = {name: _versions_table(df, name) for name, df in frames.items()}
    for name, df in frames.items():
        fresh, counts[name] = staged(df)
        given = [F.col(f"`{c}`") if c in df.columns else F.lit(None).alias(c) for c in columns[name]]
        fresh.select(*given, F.lit(new).alias(VERSION)).write.insertInto(f"{name}__versions")
    # a name of its first publication starts with a version that has no rows
    before = dict.fromkeys(map(_column, frames), "") | old
    if before != old:
        _point(spark, pointer, before)
    for name in frames:
        if not spark.catalog.tableExists(name) or spark.table(name).columns != columns[name]:
            shown = ", ".join(f"`{c}`" for c in columns[name])
            spark.sql(
                f"CREATE OR REPLACE VIEW {name} AS SELECT {shown} FROM {name}__versions "
                f"WHERE {VERSION} = (SELECT `{_column(name)}` FROM {pointer})"
            )
    _point(spark, pointer, before | {_column(name): new for name in frames})
    for name in frames:
        _drop_versions(spark, name, {new, old.get(_column(name))})
    return counts


def publish_clustering(
    labels: DataFrame,
    centroids: DataFrame,
    labels_table: str,
    centroids_table: str,
    pointer: str,
    replace_all: bool = True,
) -> dict[str, int]:
    """Labels and centroids of one fit at one moment; without `replace_all` labels are upserted.

    The counts are those of the rows given, as in `write_clustering`.
    """
    spark = labels.sparkSession
    labels = labels.select(F.col("id").cast("long"), F.col("cluster").cast("long"))
    if replace_all:
        centers = centroids.select(F.col("cluster").cast("long"), F.col("centroid").cast("array<double>"))
        return publish({centroids_table: centers, labels_table: labels}, pointer)
    fresh, rows = staged(dedupe(labels, ["id"]))
    if rows:
        known = spark.table(labels_table) if spark.catalog.tableExists(labels_table) else fresh.limit(0)
        publish({labels_table: upsert(known, fresh, ["id"])}, pointer)
    return {labels_table: rows}
