"""Writes: append, replace, keyed merge and the loads built on them.

Plain parquet tables have no MERGE, so a merge writes the merged rows to a fresh table and
swaps it in; a table partitioned by a column that follows from the key rewrites only the
partitions it touches. What is merged is staged first, so that no plan reads the files it
replaces and no expensive input is computed twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from playledger.operators.normalize import merge_normalized
from playledger.operators.upsert import action_counts, dedupe, merge_with_actions, upsert
from playledger.operators.validate import require_unique
from playledger.session import ensure_checkpoint_dir
from playledger.sources.tables import finish_swap

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
KEY_BUCKET = "key_bucket"


def staged(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows, written to the checkpoint folder, and their number, counted on the way."""
    ensure_checkpoint_dir(df.sparkSession)
    seen = Observation()
    written = df.observe(seen, F.count(F.lit(1)).alias("rows")).checkpoint()
    return written, seen.get["rows"]


def _write(df: DataFrame, table: str, mode: str, partition_by: Sequence[str] = ()) -> int:
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return seen.get["rows"]


def _grown(df: DataFrame, table: str) -> DataFrame:
    """`df` with the columns of the stored table, to which those it lacks are added first."""
    spark = df.sparkSession
    known = spark.table(table).columns
    fresh = [f for f in df.schema.fields if f.name not in known]
    if fresh:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    stored = spark.table(table).schema.fields
    return df.select(
        *(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in stored)
    )


def append(df: DataFrame, table: str) -> int:
    """Adds rows as they are and returns their number; columns go by name, new ones are added."""
    spark = df.sparkSession
    finish_swap(spark, table)
    partition_by = []
    if spark.catalog.tableExists(table):
        df = _grown(df, table)
        partition_by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return _write(df, table, "append", partition_by)


def replace(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> int:
    """The whole table anew: written next to the old one, then swapped in."""
    spark = df.sparkSession
    finish_swap(spark, table)
    fresh = f"{table}__next"
    rows = _write(df, fresh, "overwrite", partition_by)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    return rows


def merge(
    incoming: DataFrame,
    table: str,
    keys: Sequence[str],
    order: Sequence[Column | str] | None = None,
) -> int:
    """Delete-insert by key; returns the number of incoming rows after deduplication."""
    spark = incoming.sparkSession
    finish_swap(spark, table)
    fresh, rows = staged(dedupe(incoming, keys, order))
    if not spark.catalog.tableExists(table):
        _write(fresh, table, "errorifexists")
    elif rows:
        replace(upsert(spark.table(table), fresh, keys), table)
    return rows


def _overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replaces the partitions that occur in `df`; `insertInto` reads the mode from the session."""
    conf = df.sparkSession.conf
    before = conf.get(OVERWRITE_MODE)
    conf.set(OVERWRITE_MODE, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        conf.set(OVERWRITE_MODE, before)


def merge_partitions(
    incoming: DataFrame,
    table: str,
    keys: Sequence[str],
    partition: str,
    order: Sequence[Column | str] | None = None,
) -> int:
    """As `merge`, rewriting only the partitions the incoming rows fall in, the null one included.

    `partition` must follow from the key, so that a key never moves between partitions.
    """
    spark = incoming.sparkSession
    finish_swap(spark, table)
    fresh, rows = staged(dedupe(incoming, keys, order))
    if not spark.catalog.tableExists(table):
        _write(fresh, table, "errorifexists", [partition])
        return rows
    if not rows:
        return rows
    fresh = _grown(fresh, table)
    target = spark.table(table)
    touched = fresh.select(F.col(partition).alias("_touched")).distinct()
    old = target.join(touched, F.col(partition) == F.col("_touched"), "left_semi")
    if not fresh.where(F.col(partition).isNull()).isEmpty():
        old = old.unionByName(target.where(F.col(partition).isNull()))
    merged, _ = staged(upsert(old, fresh, keys).select(*target.columns))
    _overwrite_partitions(merged, table)
    return rows


def merge_into_catalog(incoming: DataFrame, table: str, keys: Sequence[str]) -> None:
    """The merge as one statement, for table formats that support MERGE."""
    same = None
    for key in keys:
        test = F.col(f"{table}.{key}") == F.col(f"source.{key}")
        same = test if same is None else same & test
    source = incoming.alias("source")
    source.mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def merge_nested(incoming: dict[str, DataFrame], root: str, keys: Sequence[str]) -> dict[str, int]:
    """Merges normalised tables named like `incoming`; child rows follow their root."""
    spark = incoming[root].sparkSession
    fresh, counts = {}, {}
    for name, df in incoming.items():
        finish_swap(spark, name)
        fresh[name], counts[name] = staged(df)
    current = {name: spark.table(name) for name in incoming if spark.catalog.tableExists(name)}
    if len(current) == len(incoming) and not any(counts.values()):
        return counts
    for name, df in merge_normalized(current, fresh, root, keys).items():
        replace(df, name)
    return counts


def _key_bucket(buckets: int) -> Column:
    """The bucket of an id, alike for all types of the same id; rows without one share a bucket."""
    return F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(buckets)).cast("int")


def _load_buckets(fresh: DataFrame, table: str, only_if_changed: bool) -> dict[str, int]:
    """Merges into the touched buckets of a table and overwrites those in which a row changed.

    The numbers of the touched buckets, at most as many as the table has, select its partitions
    before anything is read. What is written was staged, so a load that fails is repeated as it was.
    """
    spark = fresh.sparkSession
    kept = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == f"{KEY_BUCKET}s").first()
    if kept is None:
        raise ValueError(f"{table} has a column {KEY_BUCKET} but no number of buckets")
    bucket = _key_bucket(int(kept["value"]))
    touched = [r[0] for r in fresh.select(bucket).distinct().collect()]
    if not touched:
        return {}
    old = spark.table(table).where(F.col(KEY_BUCKET).isin(touched))
    merged = merge_with_actions(old, fresh, "id", "embedding", only_if_changed=only_if_changed)
    merged, _ = staged(merged.withColumn(KEY_BUCKET, bucket))
    counts = {r["merge_action"]: r["rows"] for r in action_counts(merged).collect()}
    changed = merged.where("merge_action <> 'KEEP'").select(F.col(KEY_BUCKET).alias("_changed")).distinct()
    if counts:
        whole = merged.join(F.broadcast(changed), F.col(KEY_BUCKET) == F.col("_changed"), "left_semi")
        _overwrite_partitions(whole.select(*spark.table(table).columns).repartition(KEY_BUCKET), table)
    return counts


def load_embeddings(
    incoming: DataFrame,
    table: str,
    *,
    only_if_changed: bool,
    unique_source: bool = False,
    order: Sequence[Column | str] | None = None,
    buckets: int | None = None,
) -> dict[str, int]:
    """Inserts new embeddings and updates known ones; returns rows per action.

    `only_if_changed` rewrites a row only when its vector differs. `unique_source` rejects an
    input with repeated ids instead of keeping one row of each. `buckets` makes a new table one
    of that many partitions by a hash of the id (`key_bucket`, a column of the table); a later
    load of such a table reads and rewrites the buckets it touches only, whatever `buckets` says.
    """
    spark = incoming.sparkSession
    finish_swap(spark, table)
    if unique_source:
        require_unique(incoming, ["id"], "incoming embeddings")
    fresh, rows = staged(dedupe(incoming.select("id", "embedding"), ["id"], order))
    if not spark.catalog.tableExists(table):
        if not buckets:
            _write(fresh, table, "errorifexists")
            return {"INSERT": rows} if rows else {}
        # made empty with its number of buckets, so that a load that fails leaves a table the next one can use
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema.fields)
        spark.sql(
            f"CREATE TABLE {table} ({columns}, {KEY_BUCKET} INT) USING parquet "
            f"PARTITIONED BY ({KEY_BUCKET}) TBLPROPERTIES ('{KEY_BUCKET}s' = '{int(buckets)}')"
        )
    if KEY_BUCKET in spark.table(table).columns:
        return _load_buckets(fresh, table, only_if_changed)
    merged, _ = staged(
        merge_with_actions(
            spark.table(table), fresh, "id", "embedding", only_if_changed=only_if_changed
        )
    )
    counts = {r["merge_action"]: r["rows"] for r in action_counts(merged).collect()}
    if counts:
        replace(merged.drop("merge_action"), table)
    return counts


def load(
    incoming: DataFrame, table: str, format: str, url: str | None = None, **options: str
) -> dict[str, int]:
    """Loads embeddings into the named kind of destination.

    `table`: always update; `table-changed`: update only what differs; `jdbc`: replace the
    staging table of a database, whose own MERGE takes it from there.
    """
    if format == "table":
        return load_embeddings(incoming, table, only_if_changed=False)
    if format == "table-changed":
        return load_embeddings(incoming, table, only_if_changed=True)
    if format == "jdbc":
        if url is None:
            raise ValueError("a jdbc load needs a url")
        fresh, rows = staged(dedupe(incoming, ["id"]))
        fresh.write.format("jdbc").options(url=url, dbtable=table, **options).mode(
            "overwrite"
        ).save()
        return {"STAGED": rows}
    raise NotImplementedError(f"Unsupported destination type: {format}")


def write_clustering(
    labels: DataFrame,
    centroids: DataFrame,
    labels_table: str,
    centroids_table: str,
    replace_all: bool = True,
) -> dict[str, int]:
    """Writes labels, and with `replace_all` centroids too; otherwise labels are upserted."""
    labels = labels.select(F.col("id").cast("long"), F.col("cluster").cast("long"))
    if not replace_all:
        return {labels_table: merge(labels, labels_table, ["id"])}
    centers = centroids.select(
        F.col("cluster").cast("long"), F.col("centroid").cast("array<double>")
    ).orderBy("cluster")
    return {
        centroids_table: replace(centers, centroids_table),
        labels_table: replace(labels, labels_table),
    }
