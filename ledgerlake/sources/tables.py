"""Catalog tables of a tenant's layers, and the write paths into them.

A keyed table is a base plus changes. Its folder holds one folder per committed write, ``change_batch=<number>-<name>``, with
Parquet files by load date; numbers only grow. A write appends a folder and touches no other file, so it costs its batch
whatever the table's size, readers never miss a file, and a write that dies before Spark's success marker does not exist.
Reading takes the rows of each key's last write. ``compact_table`` writes the current rows as a base into a new folder and then points
the table to it, one change of the catalog; readers of the old folder go on undisturbed.

One writer per table at a time; writes are ordered by a number kept in the table's properties. Old folders are left to the
storage's own retention.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import assert_key
from ledgerlake.functions.time import instant
from ledgerlake.operators.upsert import latest_by_few

LAYERS = ("raw", "staging", "curated", "delivery")
PROPERTY = "ledgerlake"
#: Of each row: the number of its write; partitions: the write's folder, and the load date.
NUMBER, BATCH, LOADED = "_change", "change_batch", "load_date"
BASE = "base"
#: Load dates up to which a compaction after a shuffle of all rows is not evened out once more.
FEW_DATES = 4
#: Rows of a join's side up to which it may be broadcast.
FEW_ROWS = 400_000


def database(tenant: str, layer: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{tenant}_{layer}"


def table_name(tenant: str, layer: str, name: str) -> str:
    return f"{database(tenant, layer)}.{name}"


def ensure_database(spark: SparkSession, tenant: str, layer: str, root: str | None = None) -> None:
    where = f" LOCATION '{root.rstrip('/')}/{database(tenant, layer)}'" if root else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database(tenant, layer)}{where}")


def ensure_table(
    spark: SparkSession, table: str, columns: Mapping[str, str], keys: Sequence[str] = (), buckets: int = 16, unique: Sequence[str] = ()
) -> None:
    """Create the table if missing; with ``keys`` as a keyed table.

    ``keys`` say which rows a write replaces (of child tables: the parent's key). ``unique`` columns name a row beside that: a
    child that comes under another parent leaves the old one. ``buckets`` is not used any more.
    """
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    if not keys:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet")
        return
    if spark.catalog.tableExists(table):
        return
    home = spark.catalog.getDatabase(table.split(".")[0]).locationUri.rstrip("/")
    folder = f"{home}/{table.split('.')[1]}-{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet LOCATION '{folder}'")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in spark.table(table).schema.fields])
    _set(spark, table, keys=",".join(keys), unique=",".join(unique), folder=folder, number="0", schema=schema.json())


def _set(spark: SparkSession, table: str, **values: str) -> None:
    """Keep values in the table's properties, as hexadecimal text: Spark hides values that look like secrets or addresses."""
    listed = ", ".join(f"'{PROPERTY}.{k}' = '{v.encode().hex()}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"][len(PROPERTY) + 1 :]: bytes.fromhex(r["value"]).decode() for r in found if r["key"].startswith(f"{PROPERTY}.")}


def keyed(spark: SparkSession, table: str) -> dict[str, str]:
    """What the table was created with; raises for a table that is not keyed."""
    found = _properties(spark, table)
    if "keys" not in found:
        raise ValueError(f"{table} is not a keyed table")
    return found


def source(spark: SparkSession, tenant: str, name: str) -> DataFrame:
    """A raw table."""
    return read(spark, table_name(tenant, "raw", name))


def read(spark: SparkSession, table: str) -> DataFrame:
    """The table's current rows, as of the writes committed by now."""
    found = _properties(spark, table)
    if "keys" not in found:
        spark.catalog.refreshTable(table)
        return spark.table(table)
    return _current(spark, found).drop(NUMBER, BATCH, LOADED)


def all_rows(spark: SparkSession, table: str) -> DataFrame:
    """Rows of all writes, replaced ones as well: at least the current rows, without a join."""
    found = _properties(spark, table)
    return history(spark, found)[0] if "keys" in found else read(spark, table)


def changed_after(spark: SparkSession, table: str, number: int) -> DataFrame:
    """Current rows of writes after ``number``; folders of earlier writes are pruned before anything is read."""
    later = (F.col(BATCH) > F.lit(f"{number:020d}~")) & (F.col(NUMBER) > number)
    return _current(spark, keyed(spark, table), later).drop(NUMBER, BATCH, LOADED)


def last_change(spark: SparkSession, table: str) -> int:
    """The number of the table's last committed write."""
    found = keyed(spark, table)
    return max([int(name.split("-")[0]) for name in committed(spark, found["folder"])], default=0)


def committed(spark: SparkSession, folder: str) -> list[str]:
    """Names of the writes that carry Spark's success marker, in order."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
    done = [n for n in names if n.startswith(f"{BATCH}=") and files.exists(hadoop.Path(f"{folder}/{n}/_SUCCESS"))]
    return sorted(n[len(BATCH) + 1 :] for n in done)


def history(spark: SparkSession, found: Mapping[str, str]) -> tuple[DataFrame, bool]:
    """All committed rows with write, folder and load date, and whether there are changes on top of a base."""
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    schema = T.StructType([*schema.fields, T.StructField(NUMBER, T.LongType()), T.StructField(BATCH, T.StringType()), T.StructField(LOADED, T.DateType())])
    names = committed(spark, found["folder"])
    if not names:
        return spark.createDataFrame([], schema), False
    rows = spark.read.schema(schema).option("basePath", found["folder"]).parquet(*[f"{found['folder']}/{BATCH}={n}" for n in names])
    return rows, any(not n.endswith(f"-{BASE}") for n in names)


def _current(spark: SparkSession, found: Mapping[str, str], wanted: Column | None = None, much: float = 0.25) -> DataFrame:
    """Current rows, or those among the wanted ones.

    Rows of the first write (the base, if there is one) are current unless a later write has their key, so which write of a
    key is the last comes from the key columns of the later writes alone; a table of one write is read as it is. Spark
    may broadcast that list if it has few rows, and then the first write is not shuffled. Where columns keep
    their first values and the later writes hold more than ``much`` of the first one's bytes, all rows are shuffled once instead.
    """
    rows, _ = history(spark, found)
    names = committed(spark, found["folder"])
    live = rows if wanted is None else rows.where(wanted)
    if len(names) < 2:
        return live
    keys, unique, kept = (found.get(k, "").split(",") if found.get(k) else [] for k in ("keys", "unique", "insert_only"))
    later = rows.where(F.col(BATCH) > names[0])
    sorts = wanted is None and _sorts(spark, found, much)
    many = (not sorts or any(unique)) and later.count() > FEW_ROWS  # from the files' footers
    if sorts:
        return _by_last(_kept_by_sort(rows, keys, kept), later, [unique], many)
    live = _by_last(live, later, [keys, unique], many)
    if kept:  # these columns keep the first value a key came with
        firsts = [F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)]
        known = _sorted_if(many, later.select(*keys).distinct())
        first = rows.join(known, keys, "left_semi").groupBy(*firsts).agg(F.min_by(F.struct(*kept), NUMBER).alias("_first"))
        joined = live.join(_sorted_if(many, first), [F.col(c) == F.col(f"_key{i}") for i, c in enumerate(keys)], "left")
        chosen = {c: F.when(F.col("_first").isNotNull(), F.col("_first")[c]).otherwise(F.col(c)) for c in kept}
        live = joined.withColumns(chosen).select(*rows.columns)
    return live


def _sorted_if(many: bool, side: DataFrame) -> DataFrame:
    """A join's right side; of many rows it is sorted, not broadcast, whatever Spark takes its size for.

    Spark plans by the compressed bytes of files, which may be a hundredth of the rows' bytes in memory, and keeps to a broadcast
    when it has measured more.
    """
    return side.hint("merge") if many else side


def _by_last(live: DataFrame, later: DataFrame, groups: Sequence[Sequence[str]], many: bool) -> DataFrame:
    """The rows that no later write replaces by the columns of any group."""
    for columns in (g for g in groups if g):
        last = later.groupBy(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(columns)]).agg(F.max(NUMBER).alias("_last"))
        same = [F.col(c) == F.col(f"_key{i}") for i, c in enumerate(columns)]
        joined = live.join(_sorted_if(many, last), same, "left").where(F.coalesce("_last", NUMBER) == F.col(NUMBER))
        live = joined.drop("_last", *[f"_key{i}" for i in range(len(columns))])
    return live


def _kept_by_sort(rows: DataFrame, keys: Sequence[str], kept: Sequence[str]) -> DataFrame:
    """Each key's rows of its last write, with the first write's values in the ``kept`` columns; a NULL key replaces nothing.

    A key has a row per write, so no group is large. Keys that are UUIDs in plain writing are shuffled as their 16 bytes.
    """
    texts = [k for k in keys if isinstance(rows.schema[k].dataType, T.StringType) and k not in kept]
    packed = rows.withColumns({f"_uuid_{k}": F.when(F.col(k).rlike(_UUID), F.unhex(F.translate(k, "-", ""))) for k in texts})
    packed = packed.withColumns({k: F.when(F.col(f"_uuid_{k}").isNull(), F.col(k)) for k in texts})
    group = Window.partitionBy(*[f"_uuid_{k}" for k in texts], *keys).orderBy(NUMBER)
    group = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = packed.withColumns({"_last": F.max(NUMBER).over(group), "_first": F.first(F.struct(*kept)).over(group)})
    whole = marked.withColumns({k: F.coalesce(k, _uuid_of(F.col(f"_uuid_{k}"))) for k in texts})
    nameless = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    chosen = {c: F.when(nameless, F.col(c)).otherwise(F.col("_first")[c]) for c in kept}
    return whole.where(nameless | (F.col("_last") == F.col(NUMBER))).withColumns(chosen).select(*rows.columns)


_UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\\z"


def _uuid_of(packed: Column) -> Column:
    """The text of a packed UUID; NULL of NULL."""
    text = F.lower(F.hex(packed))  # named once: where Spark pushes a filter on keys below a shuffle, it unpacks in every place
    for at in (21, 17, 13, 9):
        text = F.overlay(text, F.lit("-"), at, 0)
    return text


def _sorts(spark: SparkSession, found: Mapping[str, str], much: float = 0.25) -> bool:
    """Whether columns keep first values and the later writes hold more than ``much`` of the first one's bytes."""
    names = committed(spark, found["folder"])
    if not found.get("insert_only") or len(names) < 2:
        return False
    return _bytes(spark, found["folder"], names[1:]) > much * _bytes(spark, found["folder"], names[:1])


def _load_dates(spark: SparkSession, found: Mapping[str, str]) -> int:
    """How many load dates the writes have."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{found['folder']}/{BATCH}=*/{LOADED}=*")
    days = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return len({d.getPath().getName() for d in days})


def _bytes(spark: SparkSession, folder: str, names: Sequence[str]) -> int:
    """Bytes of the files of some writes."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{BATCH}={n}") for n in names]
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in paths)


def append(spark: SparkSession, table: str, rows: DataFrame, name: str = "write", replay: tuple[str, int] | None = None) -> bool:
    """Commit rows as one write; returns False if this write is known already.

    ``replay`` names a stream and its micro-batch: a micro-batch that was committed before appends nothing.
    """
    found = keyed(spark, table)
    if replay:
        name, mark = f"{replay[0]}-{replay[1]}", f"done_{zlib.crc32(replay[0].encode()):08x}"
        if int(found.get(mark, -1)) >= replay[1] or any(n.split("-", 1)[1] == name for n in committed(spark, found["folder"])):
            return False
    schema = _grown(spark, table, found, rows.schema)
    number = int(found["number"]) + 1
    _set(spark, table, number=str(number))  # a write that fails wastes its number
    have = set(rows.columns)
    columns = [F.col(f.name).cast(f.dataType) if _plain(f.dataType) else F.col(f.name) for f in schema.fields if f.name in have]
    stamp = next((c for c in ("loaded_at", "staged_at") if c in have), None)
    day = F.col(stamp).cast("date") if stamp else F.lit(None).cast("date")
    out = rows.select(*columns, F.lit(number).cast("long").alias(NUMBER), day.alias(LOADED))
    out.write.mode("overwrite").option("compression", "zstd").partitionBy(LOADED).parquet(f"{found['folder']}/{BATCH}={number:020d}-{name}")
    if replay:
        _set(spark, table, **{mark: str(replay[1])})
    return True


def _plain(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType))


def merged_type(old: T.DataType, new: T.DataType) -> T.DataType:
    """The old type with the fields that only the new one has, at any depth of structs, arrays and maps."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        theirs = {f.name: f for f in new.fields}
        kept = [T.StructField(f.name, merged_type(f.dataType, theirs[f.name].dataType) if f.name in theirs else f.dataType) for f in old.fields]
        return T.StructType(kept + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in set(old.names)])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged_type(old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(old.keyType, merged_type(old.valueType, new.valueType))
    if not _plain(old) and type(old) is not type(new):
        raise ValueError(f"a column of {old.simpleString()} cannot take {new.simpleString()}")
    return old


def _grown(spark: SparkSession, table: str, found: Mapping[str, str], rows: T.StructType) -> T.StructType:
    """The table's schema with what the batch adds, at any depth; older rows read NULL there."""
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    grown = merged_type(schema, rows)
    if grown != schema:
        _set(spark, table, schema=grown.json())
        new = [f for f in grown.fields if f.name not in set(schema.names)]
        if new:
            listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    return grown


def compact_table(spark: SparkSession, table: str) -> None:
    """Write the current rows as a base into a new folder, few and even files per load date, and point the table to it."""
    found = keyed(spark, table)
    folder = f"{found['folder'].rsplit('-', 1)[0]}-{uuid.uuid4().hex[:12]}"
    rows = _current(spark, found).drop(BATCH)
    last = last_change(spark, table)
    # Rows that come out of one shuffle of them all are in even parts already: with few load dates their files are, too.
    if not (_sorts(spark, found) and _load_dates(spark, found) <= FEW_DATES):
        rows = rows.hint("rebalance", LOADED)
    rows.write.option("compression", "zstd").partitionBy(LOADED).parquet(f"{folder}/{BATCH}={last:020d}-{BASE}")
    # The property is what readers follow, and it changes last and at once.
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    _set(spark, table, folder=folder)


def upsert_table(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = (),
    insert_only: Sequence[str] = (),
    loaded_at: datetime | None = None,
    replay: tuple[str, int] | None = None,
) -> bool:
    """Insert new keys and overwrite known ones; the last row of a key in the batch counts.

    ``insert_only`` columns keep the first value of a key, now and from then on. A NULL key raises. The batch is read
    twice; one whose rows can differ between two readings must be stored first.
    """
    rows = latest_by_few(batch, list(keys), order)
    rows = rows.withColumns({k: assert_key(k, k) for k in keys})
    if loaded_at is not None:
        rows = rows.withColumn("loaded_at", instant(loaded_at))
    found = keyed(spark, table)
    known = found["insert_only"].split(",") if found.get("insert_only") else []
    if set(insert_only) - set(known):
        _set(spark, table, insert_only=",".join([*known, *[c for c in insert_only if c not in known]]))
    named = set(T.StructType.fromJson(json.loads(found["schema"])).names)
    extra = [c for c in order if isinstance(c, str) and c not in named]
    return append(spark, table, rows.drop(*extra), "upsert", replay)


def delete_insert_table(spark: SparkSession, table: str, batch: DataFrame, keys: Sequence[str]) -> bool:
    """Replace all rows of the batch's keys by the batch's rows."""
    if list(keys) != keyed(spark, table)["keys"].split(","):
        raise ValueError(f"{table} is keyed by other columns")
    return append(spark, table, batch, "replace")


def replace_children_table(
    spark: SparkSession, table: str, batch: DataFrame, parent: str, replay: tuple[str, int] | None = None
) -> bool:
    """Replace the children of the batch's parents; the table must be keyed by the parent. A child without a parent raises."""
    if [parent] != keyed(spark, table)["keys"].split(","):
        raise ValueError(f"{table} is not keyed by {parent}")
    return append(spark, table, batch.withColumn(parent, assert_key(parent, parent)), "children", replay)


def materialize(
    df: DataFrame,
    table: str,
    mode: str = "table",
    key: str | None = None,
    drop_first: bool = False,
    partition_by: Sequence[str] = (),
    buckets: int = 16,
) -> None:
    """Store a model: as a view, as a fully rewritten table, or incrementally by key.

    ``drop_first`` removes the old relation before a rebuild, for a model whose columns changed.
    A view is a session view named like the table with ``__`` for the dot.
    """
    spark = df.sparkSession
    if mode == "view":
        view = table.replace(".", "__")
        if drop_first:
            spark.sql(f"DROP VIEW IF EXISTS {view}")
        df.createOrReplaceTempView(view)
    elif mode == "table":
        if drop_first:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        writer = df.write.mode("overwrite").format("parquet")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)
    elif mode == "incremental":
        if not key:
            raise ValueError("an incremental model needs a key")
        ensure_table(spark, table, {f.name: f.dataType.simpleString() for f in df.schema.fields}, [key])
        delete_insert_table(spark, table, df, [key])
    else:
        raise ValueError(f"unknown mode {mode!r}")


def ref(spark: SparkSession, table: str) -> DataFrame:
    """A model by table name, whether it is stored or a view."""
    view = table.replace(".", "__")
    return spark.table(view) if spark.catalog.tableExists(view) else read(spark, table)
