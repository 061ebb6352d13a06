"""Reading source files and staging intermediate tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.functions import as_date, let, rescued
from annalist.spec import ColumnSpec, TableSpec


def read_text_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read a headered CSV as text. ``columns`` are all columns, in file order."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read newline-delimited JSON with a given schema; nothing is inferred."""
    return spark.read.schema(schema).json(path)


def scan_typed(raw: DataFrame, specs: Sequence[ColumnSpec], rescue: str | None = None) -> DataFrame:
    """Project the given columns and cast them; text that does not parse becomes NULL.

    ``rescue`` names a column that keeps such text, by column.
    """
    typed = {c.name: F.col(c.name).try_cast(c.dtype) for c in specs}
    more = [rescued({n: (F.col(n), v) for n, v in typed.items()}).alias(rescue)] if rescue else []
    return raw.select(*[v.alias(n) for n, v in typed.items()], *more)


def scan_projected(raw: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep the given columns uncast; the file reader skips the others."""
    return raw.select(*cols)


def stage_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table and go on from the files, as a restart point."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Rewrite a catalog table, its schema included."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def comment_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Attach the registry's descriptions; they are stored with a saved table."""
    comments = {c.name: c.comment for c in spec.columns}
    return df.select(
        *[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c) for c in df.columns]
    )


def describe_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and description, with the row count."""
    described = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.lit(f.metadata.get("comment", "")).alias("comment"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.inline(described))


def nested_delta_schema(spec: TableSpec) -> T.StructType:
    """Schema of a nested delta record: address struct and array of periods."""
    text = T.StringType()
    address = [c for c in spec.fixed if c != spec.created_on]
    period = [spec.effective_from, spec.effective_to, *spec.source_tracked]
    flat = [c for c in spec.tracked if c not in spec.source_tracked]
    return T.StructType(
        [
            T.StructField(spec.key, text),
            T.StructField(spec.created_on, text),
            T.StructField(spec.treated_at, text),
            *[T.StructField(c, spec.column(c).dtype) for c in flat],
            T.StructField(spec.nested_address, T.StructType([T.StructField(c, text) for c in address])),
            T.StructField(
                spec.nested_periods,
                T.ArrayType(T.StructType([T.StructField(c, text) for c in period])),
            ),
        ]
    )


def ingest_nested_json(
    raw: DataFrame,
    schema: T.StructType,
    batch_date: dt.date | F.Column | str,
    corrupt: str | None = None,
    extra: str | None = None,
) -> DataFrame:
    """Parse JSON lines (column ``value``) and tag them with their batch.

    Lines that are not JSON give a record of NULLs, as the permissive file reader does; with ``corrupt``, the
    name of a column more, they are kept there. ``extra`` names a column that keeps the fields the schema
    does not know, as text, by name or, inside structs and arrays, by path (``address.floor``, ``periods[1].note``).
    """
    fields, options = schema, {}
    if corrupt:
        fields = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        options = {"columnNameOfCorruptRecord": corrupt}
    columns = [F.from_json("value", fields, options).alias("record"), as_date(batch_date).alias("batch_date")]
    if extra:
        rest = _unknown(F.col("value"), schema, F.lit(""))
        columns.append(let(rest, lambda r: F.when(F.size(r) > 0, F.map_from_entries(r))).alias(extra))
    return raw.select(*columns).select("record.*", "batch_date", *([extra] if extra else []))


_ENTRIES = "array<struct<key: string, value: string>>"


def _unknown(text: F.Column, kind: T.DataType, path: F.Column) -> F.Column:
    """Entries of the fields in a JSON text that a type does not know, at any depth."""
    none = F.array().cast(_ENTRIES)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        elements = F.from_json(text, "array<string>")
        inside = F.transform(
            elements, lambda e, i: _unknown(e, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))
        )
        return F.coalesce(F.flatten(inside), none)
    if not isinstance(kind, T.StructType):
        return none
    dot = F.when(path == "", path).otherwise(F.concat(path, F.lit(".")))
    known = [f.name for f in kind.fields]

    def entries(every: F.Column) -> F.Column:
        here = F.transform(
            F.map_entries(F.map_filter(every, lambda k, _: ~k.isin(*known))),
            lambda e: F.struct(F.concat(dot, e["key"]).alias("key"), e["value"].alias("value")),
        )
        parts = [F.coalesce(here, none)]
        for f in kind.fields:
            if isinstance(f.dataType, (T.StructType, T.ArrayType)):
                parts.append(_unknown(every[f.name], f.dataType, F.concat(dot, F.lit(f.name))))
        return F.concat(*parts)

    # the text is parsed once, and not again for each nested field
    return let(F.from_json(text, "map<string, string>"), entries)
