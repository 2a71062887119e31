"""Keyed target tables: creation, schema growth and upsert.

A target is a Parquet table partitioned by a hash bucket of its key. An upsert
reads and rewrites only the buckets its keys fall into, each in a new folder that
the catalog is pointed to once it is complete. So readers never see half a bucket,
and an upsert that is repeated after a failure gives the same table.

Updates of one source may come out of order, as the micro-batches of a stream do. Then
the place of each row within its source is kept beside it, in a column that readers do
not see, and an update is ignored where the table has a later row of the same source.
"""

import re
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawltable.functions.names import named, quoted
from crawltable.functions.places import sortable
from crawltable.functions.shapes import table_schema

BUCKET = "key_bucket"
ORDER = "key_order"
MERGE_PROVIDERS = ("delta", "iceberg", "hudi")

# Keys up to this size are broadcast, each counted with its share of a hash table.
BROADCAST_BYTES = 32 << 20
KEY_OVERHEAD = 64

# Buckets up to this size are shuffled rather than searched for keys, which takes more jobs.
SHUFFLE_BYTES = 64 << 20

# Bytes of rows per writing task.
TASK_BYTES = 256 << 20

_ORDER_TYPE = T.StructType().add("source", T.StringType()).add("place", T.StringType())
_KEY_PROPERTY = "crawltable.key"
_BUCKETS_PROPERTY = "crawltable.buckets"


@dataclass(frozen=True)
class Target:
    """Where rows go.

    ``root`` holds the data; unset, the database's own folder does. ``buckets`` counts
    when the table is made: choose it so that a bucket will be some gigabytes;
    ``rebucket`` changes it later.
    """

    table: str
    namespace: str | tuple[str, ...] | None = None
    branch: str | None = None
    root: str | None = None
    buckets: int = 64

    @property
    def parts(self) -> tuple[str, ...]:
        """Namespace parts; a text is split at ``::`` and empty parts are dropped."""
        parts = self.namespace or ()
        if isinstance(parts, str):
            parts = parts.strip().split("::")
        return tuple(part for part in parts if part)

    @property
    def database(self) -> str | None:
        return "__".join(self.parts) or None

    @property
    def name(self) -> str:
        """Quoted table name; a branch is a table of its own beside the main one."""
        table = f"{self.table}__{self.branch}" if self.branch else self.table
        return ".".join(quoted(n) for n in (self.database, table) if n)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_table(
    spark: SparkSession, target: Target, schema: T.StructType, key: str
) -> None:
    """Create the table if it is missing, else add the columns it lacks.

    Columns are compared by name; none is dropped or changes its type.
    """
    if key not in schema.names:
        raise ValueError(f"the schema lacks the key column {key!r}")
    if not spark.catalog.tableExists(target.name):
        _create_table(spark, target, schema, key)
        return
    known = {name.lower() for name in spark.table(target.name).columns}
    missing = [f for f in schema.fields if f.name.lower() not in known]
    if missing:
        added = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {target.name} ADD COLUMNS ({added})")


def _create_table(spark, target, schema, key):
    if target.database is not None:
        at = f" LOCATION {_literal(f'{target.root}/{target.database}')}" if target.root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(target.database)}{at}")
    columns = ", ".join(
        f"{quoted(f.name)} {f.dataType.simpleString()}{' NOT NULL' * (f.name == key)}"
        for f in schema.fields
    )
    at = f"LOCATION {_literal(_table_folder(spark, target))}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {target.name} ({columns}, {BUCKET} INT) USING parquet "
        f"PARTITIONED BY ({BUCKET}) {at} TBLPROPERTIES "
        f"({_literal(_KEY_PROPERTY)} = {_literal(key)}, '{_BUCKETS_PROPERTY}' = '{target.buckets}')"
    )


def _table_folder(spark: SparkSession, target: Target) -> str:
    name = f"{target.table}__{target.branch}" if target.branch else target.table
    if target.root:
        return f"{target.root}/{target.database or 'default'}/{name}"
    database = spark.catalog.getDatabase(target.database or spark.catalog.currentDatabase())
    return f"{database.locationUri}/{name}"


def read_table(spark: SparkSession, target: Target) -> DataFrame:
    """The target's rows, without the columns for its own use."""
    return spark.table(target.name).drop(BUCKET, ORDER)


def upsert(
    spark: SparkSession,
    target: Target,
    updates: DataFrame,
    key: str,
    place: str | None = None,
    source: str = "",
) -> None:
    """Update the rows of known keys and insert the rest.

    ``updates`` has one row per key (see ``dedupe_last``) and gives the same rows when
    it is computed again; what does not should be staged first. Columns it lacks keep
    their value in updated rows and are null in inserted ones.

    ``place`` names a column by which the rows of a ``source`` are ordered, whatever
    upsert they come with: a row does not replace a later one of its source. It is stored
    as other columns are, unless its name begins with an underscore. A row of another
    source, or one stored without a place, is replaced in any case.
    """
    stored = [c for c in updates.columns if c != place or not c.startswith("_")]
    schema = table_schema(None, updates.select(*map(named, stored)).schema, key)
    if place is not None:
        schema = T.StructType([*schema.fields, T.StructField(ORDER, _ORDER_TYPE)])
        own = F.struct(F.lit(source).alias("source"), sortable(named(place), updates.schema[place].dataType).alias("place"))
        updates = updates.withColumn(ORDER, own.cast(_ORDER_TYPE))
        stored.append(ORDER)
    ensure_table(spark, target, schema, key)
    updates = _as_stored(spark.table(target.name).schema, updates.select(*map(named, stored)))
    details = _details(spark, target)
    if details["provider"] in MERGE_PROVIDERS:
        _merge_into(target, updates, key)
    elif _BUCKETS_PROPERTY in details["properties"]:
        _rewrite_buckets(spark, target, updates, key, details)
    else:
        _rewrite_table(spark, target, updates, key, details)


def _as_stored(schema: T.StructType, updates: DataFrame) -> DataFrame:
    """Names and types as the table has them; a value that does not fit fails."""
    stored = {f.name.lower(): f for f in schema.fields}
    columns = []
    for given in updates.schema.fields:
        wanted = stored[given.name.lower()]
        value = named(given.name)
        if given.dataType != wanted.dataType and wanted.name != ORDER:
            fitting = value.try_cast(wanted.dataType)
            unfit = fitting.isNull()
            if isinstance(given.dataType, T.NumericType) and isinstance(wanted.dataType, T.NumericType):
                unfit = unfit | (fitting.try_cast(given.dataType) != value)
            problem = F.raise_error(F.lit(f"a value of {wanted.name} does not fit its type"))
            value = F.when(value.isNotNull() & unfit, problem).otherwise(fitting)
        columns.append(value.alias(wanted.name))
    return updates.select(*columns)


def _details(spark: SparkSession, target: Target) -> dict:
    rows = spark.sql(f"DESCRIBE EXTENDED {target.name}").collect()
    described = {r.col_name: r.data_type for r in rows}
    properties = spark.sql(f"SHOW TBLPROPERTIES {target.name}").collect()
    return {
        "provider": described.get("Provider", "").lower(),
        "folder": described.get("Location", "").rstrip("/"),
        "partitioned": "# Partition Information" in described,
        "properties": {r.key: r.value for r in properties},
    }


def _merge_into(target: Target, updates: DataFrame, key: str) -> None:
    """For catalogs with row-level operations the table format does the work."""
    values = {c: F.col(f"updates.{quoted(c)}") for c in updates.columns}
    match = F.expr(f"{target.name}.{quoted(key)} = updates.{quoted(key)}")
    newer = None
    if ORDER in updates.columns:
        newer = ~_later(F.col(f"{target.name}.{ORDER}"), F.col(f"updates.{ORDER}"))
    (
        updates.alias("updates")
        .mergeInto(target.name, match)
        .whenMatched(newer)
        .update(values)
        .whenNotMatched()
        .insert(values)
        .merge()
    )


def _later(old: Column, new: Column) -> Column:
    """Whether a stored row comes after an update of its source."""
    later = (old["source"] == new["source"]) & (old["place"] > new["place"])
    return F.coalesce(later, F.lit(False))


def key_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(named(key)), F.lit(buckets)).cast("int")


def merge_rows(
    current: DataFrame,
    updates: DataFrame,
    key: str,
    spread: dict[str, Column],
    tasks: int | None = None,
) -> DataFrame:
    """``current`` with the updated rows in place of those of the same key.

    One window over both sides instead of a join: an update, if there is one, comes
    first among the rows of its key. ``spread`` gives columns the key determines, by
    which the rows are to be partitioned; they are part of the result. An update that
    comes before the current row in the order of their source is left out.
    """
    old = current.withColumn("_new", F.lit(False))
    new = updates.withColumn("_new", F.lit(True))
    both = old.unionByName(new, allowMissingColumns=True)
    if spread:
        both = _spread(both, spread, tasks)
    newest = Window.partitionBy(*spread, named(key)).orderBy(F.col("_new").desc())
    values = {
        c: F.when(F.col("_new"), F.lead(named(c)).over(newest)).otherwise(named(c))
        for c in current.columns
        if c not in updates.columns
    }
    late = F.lit(False)
    if ORDER in updates.columns:
        # The update is the first of the one or two rows, the current one the last.
        ends = newest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        late = _later(F.last(ORDER).over(ends), F.first(ORDER).over(ends))
    merged = both.withColumns({**values, "_updated": F.first("_new").over(newest), "_late": late})
    kept = F.when(F.col("_updated") & ~F.col("_late"), F.col("_new")).otherwise(~F.col("_new"))
    return merged.where(kept).select(*map(named, current.columns), *spread)


def replace_rows(
    current: DataFrame,
    updates: DataFrame,
    key: str,
    spread: dict[str, Column],
    tasks: int | None = None,
) -> DataFrame:
    """The same for few updates that have all columns: the target is not shuffled.

    Its rows stay where they are read, which is by bucket, and lose those whose key
    is among the broadcast ones, but for rows that come after their update.
    """
    ordered = ORDER in updates.columns
    place = [F.col(ORDER).alias("_order")] if ordered else []
    keys = F.broadcast(updates.select(named(key).alias("_key"), *place))
    same = named(key).eqNullSafe(F.col("_key"))
    if ordered:
        late = _later(F.col(ORDER), F.col("_order"))
        # Of the current rows only keys and places are read for this, at most one per update.
        early = current.join(keys, same & late).select("_key")
        same &= ~late
        updates = updates.join(F.broadcast(early), named(key).eqNullSafe(F.col("_key")), "left_anti")
    kept = current.join(keys, same, "left_anti")
    new = _spread(updates, spread, tasks)
    return kept.withColumns(spread).unionByName(new)


def _rewrite_buckets(spark, target, updates, key, details):
    buckets = int(details["properties"][_BUCKETS_PROPERTY])
    # At most one row per bucket; only the key is read to find them.
    size = F.octet_length(named(key).cast("string")) + KEY_OVERHEAD
    if ORDER in updates.columns:
        size += F.octet_length(F.col(ORDER)["place"])
    sizes = updates.groupBy(key_bucket(key, buckets).alias(BUCKET)).agg(F.sum(size).alias("size")).collect()
    touched = sorted(r[BUCKET] for r in sizes)
    if not touched:
        return
    partitions = spark.sql(f"SHOW PARTITIONS {target.name}").collect()
    existing = {int(r[0].removeprefix(f"{BUCKET}=")) for r in partitions}.intersection(touched)
    stored = spark.table(target.name).where(F.col(BUCKET).isin(sorted(existing)))
    current = stored.drop(BUCKET)
    # Tasks by the bytes to write, and at least as many as the session has partitions;
    # few buckets are split over more of them.
    held = _plan_bytes(stored) if existing else 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (_plan_bytes(updates) + held) // TASK_BYTES)
    split = F.pmod(F.hash(named(key)), F.lit(max(1, tasks // len(touched))))
    spread = {BUCKET: key_bucket(key, buckets), "_split": split}
    small = sum(r["size"] or KEY_OVERHEAD for r in sizes) <= BROADCAST_BYTES
    if not existing:
        merged = _spread(updates, spread, tasks)
    elif small and held > SHUFFLE_BYTES and set(current.columns) <= set(updates.columns):
        merged = replace_rows(current, updates, key, spread, tasks)
    else:
        merged = merge_rows(current, updates, key, spread, tasks)
    commit = f"{details['folder']}/{uuid.uuid4().hex}"
    merged.drop("_split").write.partitionBy(BUCKET).parquet(commit)
    if _folders(spark, commit) - {f"{BUCKET}={bucket}" for bucket in touched}:
        raise RuntimeError("the updates changed while they were merged; stage them first")
    _link(spark, target, commit, touched, existing)


def _plan_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a frame's size, 0 where it has none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def _spread(df: DataFrame, spread: dict[str, Column], tasks: int | None) -> DataFrame:
    spread_out = df.withColumns(spread)
    return spread_out.repartition(tasks, *spread) if tasks else spread_out.repartition(*spread)


def _folders(spark: SparkSession, folder: str) -> set[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{BUCKET}=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return {status.getPath().getName() for status in found}


def _link(spark, target, commit, buckets, existing) -> None:
    """Point the catalog to the new folders; the new buckets go in one statement."""
    added = []
    for bucket in buckets:
        place = f"PARTITION ({BUCKET} = {bucket})"
        folder = _literal(f"{commit}/{BUCKET}={bucket}")
        if bucket in existing:
            spark.sql(f"ALTER TABLE {target.name} {place} SET LOCATION {folder}")
        else:
            added.append(f"{place} LOCATION {folder}")
    if added:
        spark.sql(f"ALTER TABLE {target.name} ADD IF NOT EXISTS {' '.join(added)}")


def rebucket(spark: SparkSession, target: Target, buckets: int) -> None:
    """Write the table anew in another number of buckets.

    More buckets make small upserts cheaper: one of k keys rewrites at most k of them.
    The whole table is read and written once. Between dropping the old buckets from the
    catalog and adding the new ones readers see no rows; the old files stay until
    ``remove_superseded``.
    """
    if buckets <= 0:
        raise ValueError("buckets must be greater than zero")
    details = _details(spark, target)
    if _BUCKETS_PROPERTY not in details["properties"]:
        raise ValueError(f"{target.name} has no buckets")
    rows, key = spark.table(target.name).drop(BUCKET), details["properties"][_KEY_PROPERTY]
    size = _plan_bytes(spark.table(target.name))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES)
    split = F.pmod(F.hash(named(key)), F.lit(max(1, tasks // buckets)))
    commit = f"{details['folder']}/{uuid.uuid4().hex}"
    spread = {BUCKET: key_bucket(key, buckets), "_split": split}
    _spread(rows, spread, tasks).drop("_split").write.partitionBy(BUCKET).parquet(commit)
    old = [r[0] for r in spark.sql(f"SHOW PARTITIONS {target.name}").collect()]
    if old:
        places = ", ".join(f"PARTITION ({place.replace('=', ' = ')})" for place in old)
        spark.sql(f"ALTER TABLE {target.name} DROP IF EXISTS {places}")
    spark.sql(f"ALTER TABLE {target.name} SET TBLPROPERTIES ('{_BUCKETS_PROPERTY}' = '{buckets}')")
    new = sorted(int(name.removeprefix(f"{BUCKET}=")) for name in _folders(spark, commit))
    _link(spark, target, commit, new, set())


def remove_superseded(spark: SparkSession, target: Target) -> int:
    """Delete the bucket folders that later upserts have replaced, and count them.

    Run it when no query that began before the last upsert is still reading.
    """
    details = _details(spark, target)
    current = {unquote(file.rsplit("/", 1)[0]) for file in spark.table(target.name).inputFiles()}
    current = {re.sub("^file:/+", "/", folder) for folder in current}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{details['folder']}/*/{BUCKET}=*")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    removed = 0
    for status in files.globStatus(path):
        folder = re.sub("^file:/+", "/", status.getPath().toString())
        if folder not in current:
            removed += files.delete(status.getPath(), True)
    return removed


def _rewrite_table(spark, target, updates, key, details):
    """For a file table made elsewhere: a new copy that the catalog then points to."""
    if details["partitioned"]:
        raise ValueError(f"{target.name} has partitions of its own; upsert cannot keep them")
    merged = merge_rows(spark.table(target.name), updates, key, {})
    copy = f"{details['folder']}-{uuid.uuid4().hex}"
    merged.write.format(details["provider"]).save(copy)
    spark.sql(f"ALTER TABLE {target.name} SET LOCATION {_literal(copy)}")
