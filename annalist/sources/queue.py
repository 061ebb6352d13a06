"""The queue of delta batches and the cursor that feeds it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.functions import add_second, as_date, has_prefix, moment
from annalist.functions.unite import as_schema, rebuild, unite, unite_structs

BATCH = "batch_date"


def append_evolving(queue: DataFrame, batch: DataFrame) -> DataFrame:
    """Append a batch whose columns, nested fields or types are others than the queue's.

    The result has the united type (``unite``) of both: what one side lacks is NULL, and a type that has changed
    becomes one that holds both.
    """
    schema = unite_structs(queue.schema, batch.schema)
    return as_schema(queue, schema).unionByName(as_schema(batch, schema))


#: column of a queue for values that its type can't hold: from the column to the value as text
RESCUED = "_rescued"


def append_to_queue(batch: DataFrame, table: str, path: str | None = None) -> None:
    """Append to the queue table, which is partitioned by batch and gains what a batch has more.

    New columns and new fields, at any depth, are added to the table's type, and a type that its files can be read as is
    widened. What the table's type can't hold is kept as text in the column ``_rescued``. No file is written again, so
    files that a history has taken in but not acknowledged stay what they are. The files lie at ``path``, or below
    the warehouse folder.
    """
    spark = batch.sparkSession
    where = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}_files"
    stored = _queue_schema(spark, table, where)
    if stored is None:
        _define_queue(spark, table, batch.schema, where)
        stored = spark.table(table).schema
    batch, schema = _fitted(batch, stored)
    if schema != stored:
        _define_queue(spark, table, schema, _location(spark, table) or where)
    columns = spark.table(table).schema
    as_schema(batch, columns).hint("rebalance", BATCH).write.insertInto(table)


def _queue_schema(spark: SparkSession, table: str, where: str) -> T.StructType | None:
    """The table's type; from its files if an earlier run was lost while it redefined the table."""
    if spark.catalog.tableExists(table):
        return spark.table(table).schema
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(where)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    schema = spark.read.option("mergeSchema", "true").parquet(where).schema
    _define_queue(spark, table, schema, where)
    return spark.table(table).schema


def _define_queue(spark: SparkSession, table: str, schema: T.StructType, where: str) -> None:
    """Define the table over its files. Only the definition is replaced, so a run that is lost here loses no row."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != BATCH)
    folder = spark._jvm.org.apache.hadoop.fs.Path(where)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}, {BATCH} DATE) USING parquet PARTITIONED BY ({BATCH}) LOCATION '{where}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")


def _location(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _fitted(batch: DataFrame, stored: T.StructType) -> tuple[DataFrame, T.StructType]:
    """The batch and a table type that fit each other; columns whose types can't be widened in place go to ``_rescued``."""
    kinds = {f.name.lower(): f.dataType for f in stored.fields}
    lost = [f for f in batch.schema.fields if f.name.lower() in kinds and not _in_place(kinds[f.name.lower()], f.dataType)]
    if lost:
        texts = [F.struct(F.lit(f.name).alias("key"), rebuild(F.col(f"`{f.name}`"), f.dataType, T.StringType()).alias("value")) for f in lost]
        casts = {f.name: _tried(F.col(f"`{f.name}`"), f.dataType, kinds[f.name.lower()]) for f in lost}
        missed = F.filter(F.array(*texts), lambda e: e["value"].isNotNull() & F.array_contains(F.col("_missed"), e["key"]))
        # of a nested value some part may not fit, so its text is kept in any case
        unfit = [
            F.when(F.col(f"`{f.name}`").isNotNull() & (F.lit(_nested(f.dataType)) | casts[f.name].isNull()), F.lit(f.name))
            for f in lost
        ]
        batch = batch.withColumn("_missed", F.array_compact(F.array(*unfit)))
        kept = F.when(F.size("_missed") > 0, F.map_from_entries(missed))
        before = [F.col(RESCUED)] if RESCUED in batch.columns else []
        both = F.map_concat(*[F.coalesce(m, F.create_map().cast("map<string,string>")) for m in (*before, kept)])
        batch = batch.withColumn(RESCUED, F.when(F.size(both) > 0, both)).withColumns(casts).drop("_missed")
    return batch, unite_structs(stored, batch.schema)


def _nested(t: T.DataType) -> bool:
    return isinstance(t, (T.StructType, T.ArrayType, T.MapType))


def _tried(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """As much of a value as the type can hold."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        mine = {f.name.lower(): f for f in have.fields}
        own = [(f, mine.get(f.name.lower())) for f in want.fields]
        none = lambda f: F.lit(None).cast(f.dataType)
        fields = [(none(f) if o is None else _tried(value[o.name], o.dataType, f.dataType)).alias(f.name) for f, o in own]
        return F.when(value.isNotNull(), F.struct(*fields)).cast(want)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda v: _tried(v, have.elementType, want.elementType))
    if isinstance(want, T.StringType):
        return rebuild(value, have, want)
    return F.lit(None).cast(want) if _nested(have) or _nested(want) else value.try_cast(want)


#: what parquet files of one type can be read as besides it
_WIDENED: dict[type, tuple[type, ...]] = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampNTZType,),
}


def _in_place(stored: T.DataType, given: T.DataType) -> bool:
    """Whether files of the stored type can be read as the united type of both."""
    if isinstance(stored, T.StructType) and isinstance(given, T.StructType):
        theirs = {f.name.lower(): f.dataType for f in given.fields}
        return all(_in_place(f.dataType, theirs.get(f.name.lower(), f.dataType)) for f in stored.fields)
    if isinstance(stored, T.ArrayType) and isinstance(given, T.ArrayType):
        return _in_place(stored.elementType, given.elementType)
    if isinstance(stored, T.MapType) and isinstance(given, T.MapType):
        return stored.keyType == given.keyType and _in_place(stored.valueType, given.valueType)
    united = unite(stored, given)
    return united == stored or type(united) in _WIDENED.get(type(stored), ())


def incremental_slice(
    df: DataFrame, ts: str, cursor: dt.datetime | str, code: str, prefixes: Sequence[str], n: int = 2
) -> DataFrame:
    """Rows treated since the cursor (inclusive) whose code starts with one of the prefixes."""
    since = moment(cursor).cast(df.schema[ts].dataType)
    return df.filter((F.col(ts) >= since) & has_prefix(code, prefixes, n))


def next_cursor(df: DataFrame, ts: str, old_cursor: dt.datetime | str) -> DataFrame:
    """One second after the last treatment; an empty batch keeps the old cursor.

    The time may be text, as in a raw batch; text that is no time does not count.
    """
    last = F.max(F.col(ts).try_cast("timestamp_ntz"))
    return df.agg(F.coalesce(add_second(last), moment(old_cursor)).alias("cursor"))


def pending_batches(queue: DataFrame) -> DataFrame:
    """Batches waiting in the queue, oldest first."""
    return queue.select(BATCH).distinct().orderBy(BATCH)


def read_batch(queue: DataFrame, batch_date: dt.date | str | Column) -> DataFrame:
    """One batch; on a partitioned queue only its partition is read."""
    return queue.filter(F.col(BATCH) == _date(batch_date))


def ack_batch(queue: DataFrame, batch_date: dt.date | str | Column) -> DataFrame:
    """The queue without a batch that has been applied."""
    return queue.filter(F.col(BATCH) != _date(batch_date))


def ack_in_table(spark: SparkSession, table: str, batch_date: dt.date) -> None:
    """Drop an applied batch's partition from the queue table, files included."""
    ack_files(spark, table, queued_files(spark, table).filter(F.col(BATCH) == _date(batch_date)))
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BATCH} = DATE'{batch_date.isoformat()}')")


def queued_files(spark: SparkSession, table: str) -> DataFrame:
    """Rows ``(file, batch_date)``: the files the queue consists of now."""
    return spark.table(table).select(F.col("_metadata.file_path").alias("file"), BATCH).distinct()


def read_files(spark: SparkSession, table: str, files: DataFrame) -> DataFrame:
    """The queue's rows in the listed files only, whatever has arrived since."""
    rows = spark.table(table).withColumn("_file", F.col("_metadata.file_path"))
    return rows.join(files.select(F.col("file").alias("_file")), "_file", "left_semi").drop("_file")


def ack_files(spark: SparkSession, table: str, files: DataFrame) -> None:
    """Take the listed files off the queue. Rows that came later, to the same batch too, stay in it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for row in files.select("file").distinct().toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["file"]))
        path.getFileSystem(conf).delete(path, False)
    spark.catalog.refreshTable(table)


def _date(batch_date: dt.date | str | Column) -> Column:
    return F.lit(batch_date).cast("date") if isinstance(batch_date, str) else as_date(batch_date)
