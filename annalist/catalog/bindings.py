"""The supplied tables read as a registry: stock, period history, delta batches, history table.

An order day of a customer is a period of an establishment; a user's last event of a
day is a record of that day's delta batch. ``oracles.py`` states the same rules in SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annalist.functions import moment, prefix
from annalist.operators.joins import history_semi
from annalist.operators.rows import multi_period_keys
from annalist.operators.scd2 import scd2_initial
from annalist.plans.ingestion import regional_stock
from annalist.session import materialize
from annalist.sources.files import scan_typed
from annalist.spec import ESTABLISHMENTS as SPEC

REGION = tuple(f"{d:02d}" for d in range(12))
LOAD_DATE = dt.date(2001, 7, 1)
CHANGE_DATE = dt.date(2001, 7, 15)
SPINE_START, SPINE_END = dt.date(1995, 1, 1), dt.date(2001, 9, 10)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pad(c: Column | str, n: int) -> Column:
    return F.lpad((F.col(c) if isinstance(c, str) else c).cast("string"), n, "0")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def order_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per period of a customer, with the customer's totals.

    The orders of a day are reduced to the first one before the shuffle, so a customer's
    window holds at most one row per calendar day. For every fourth customer all days are one
    period: from the first day on, with the values of the last and the total of all prices.
    """
    orders = table(spark, sf_dir, "orders")
    first = F.min(F.struct("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))
    days = (
        orders.groupBy(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("date").alias("d"))
        .agg(first.alias("o"))
    )
    customer = Window.partitionBy("k")
    all_days = days.select(
        "k",
        "d",
        F.when(F.col("o.o_orderstatus") == "F", "F").otherwise("A").alias("state"),
        F.col("o.o_totalprice").alias("price"),
        F.col("o.o_orderpriority").alias("activity"),
        F.lead("d").over(customer.orderBy("d")).alias("d_end"),
        F.min("d").over(customer).alias("first_d"),
        F.max("d").over(customer).alias("last_d"),
        F.count("*").over(customer).alias("n"),
        F.round(F.sum("o.o_totalprice").over(customer), 2).alias("total"),
    )
    single = F.col("k") % 4 == 0
    is_last = F.col("d") == F.col("last_d")
    return all_days.filter(~single | is_last).withColumns(
        {
            "is_last": is_last,
            "d": F.when(single, F.col("first_d")).otherwise(F.col("d")),
            "price": F.when(single, F.col("total")).otherwise(F.col("price")),
            "n": F.when(single, 1).otherwise(F.col("n")),
        }
    ).drop("total")


def _employer(price: Column | str, limit: int) -> Column:
    return F.when((F.col(price) if isinstance(price, str) else price) > limit, "O").otherwise("N")


def stock_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The present row of every customer as text, as a registry file has it."""
    last = staged(spark, sf_dir, "periods").filter("is_last")
    joined = last.join(table(spark, sf_dir, "customer"), F.col("k") == F.col("c_custkey"))
    area = F.concat(_pad("c_nationkey", 2), _pad(F.col("k") % 1000, 3))
    treated = F.least(
        F.date_add("last_d", (F.col("k") % 400 - 200).cast("int")).cast("timestamp_ntz")
        + F.make_dt_interval(hours=(F.col("k") % 24).cast("int")),
        moment("2001-06-01"),
    )
    negative = F.col("c_acctbal") < 0
    columns = {
        "siret": _pad("k", 14),
        "dateCreationEtablissement": _text("first_d"),
        "etatAdministratifEtablissement": F.col("state"),
        "activitePrincipaleEtablissement": F.col("activity"),
        "activitePrincipaleNAF25Etablissement": F.concat("activity", F.lit("X")),
        "caractereEmployeurEtablissement": _employer("price", 150000),
        "trancheEffectifsEtablissement": _text(F.floor(F.col("price") / 50000)),
        "etablissementSiege": _text(F.col("k") % 2 == 0),
        "codePostalEtablissement": F.concat(prefix(area), F.lit("000")),
        "codeCommuneEtablissement": area,
        "libelleCommuneEtablissement": F.concat(F.lit("Commune "), area),
        "coordonneeLambertAbscisseEtablissement": F.when(negative, "[ND]").otherwise(_text("c_acctbal")),
        "coordonneeLambertOrdonneeEtablissement": F.when(negative, "[ND]").otherwise(_text(F.col("c_acctbal") * 2)),
        "nombrePeriodesEtablissement": _text("n"),
        "dateDernierTraitementEtablissement": _text(treated),
        "dateDebut": _text("d"),
    }
    return joined.select(*[c.alias(n) for n, c in columns.items()])


def full_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed stock of all customers."""
    return scan_typed(stock_text(spark, sf_dir), SPEC.source_columns)


def history_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All periods of all customers as text, with columns that are not needed."""
    p = staged(spark, sf_dir, "periods")
    return p.select(
        _pad("k", 14).alias("siret"),
        _text("d").alias("dateDebut"),
        _text(F.when(F.col("n") > 1, F.col("d_end"))).alias("dateFin"),
        F.col("state").alias("etatAdministratifEtablissement"),
        F.col("activity").alias("activitePrincipaleEtablissement"),
        _employer("price", 150000).alias("caractereEmployeurEtablissement"),
        _text("n").alias("nombrePeriodes"),
        _text("price").alias("montant"),
    )


def delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of every user and day, flat, tagged with the day as its batch."""
    events = table(spark, sf_dir, "events")
    last = F.max(F.struct("ts", "event_id", "event_type", "value"))
    days = events.groupBy(F.col("user_id").alias("u"), F.col("ts").cast("date").alias("day")).agg(last.alias("e"))
    moved = F.col("e.value") > 250
    area = F.concat(_pad(F.col("u") % 12, 2), _pad((F.col("u") + F.when(moved, 1).otherwise(0)) % 1000, 3))
    columns = {
        "siret": _pad("u", 14),
        "dateCreationEtablissement": F.date_add(F.lit(dt.date(2019, 1, 1)), (F.col("u") % 365).cast("int")),
        "etatAdministratifEtablissement": F.when(F.col("e.event_type") == "error", "F").otherwise("A"),
        "activitePrincipaleEtablissement": F.col("e.event_type"),
        "activitePrincipaleNAF25Etablissement": F.concat("e.event_type", F.lit("X")),
        "caractereEmployeurEtablissement": _employer(F.col("e.value"), 100),
        "trancheEffectifsEtablissement": _text(F.floor(F.col("e.value") / 50)),
        "etablissementSiege": F.col("u") % 2 == 0,
        "codePostalEtablissement": F.concat(prefix(area), F.lit("000")),
        "codeCommuneEtablissement": area,
        "libelleCommuneEtablissement": F.concat(F.lit("Commune "), area),
        "coordonneeLambertAbscisseEtablissement": (F.col("u") * 10).cast("double"),
        "coordonneeLambertOrdonneeEtablissement": (F.col("u") * 20).cast("double"),
        "dateDernierTraitementEtablissement": F.col("e.ts"),
        "dateDebut": F.col("day"),
        "batch_date": F.col("day"),
    }
    return days.select(*[c.alias(n) for n, c in columns.items()])


def delta_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delta as nested JSON lines (``value``), one closed and one open period each, with ``day``."""
    flat = delta(spark, sf_dir)
    day = F.col("dateDebut")
    from_address = [c for c in SPEC.fixed if c != SPEC.created_on]
    past = F.struct(
        _text(F.date_sub(day, 7)).alias("dateDebut"),
        _text(day).alias("dateFin"),
        *[F.lit("-").alias(c) for c in SPEC.source_tracked],
    )
    present = F.struct(
        _text(day).alias("dateDebut"),
        F.lit(None).cast("string").alias("dateFin"),
        *[F.col(c) for c in SPEC.source_tracked],
    )
    record = F.struct(
        "siret",
        _text("dateCreationEtablissement").alias("dateCreationEtablissement"),
        _text("dateDernierTraitementEtablissement").alias("dateDernierTraitementEtablissement"),
        *[c for c in SPEC.tracked if c not in SPEC.source_tracked],
        F.struct(*[_text(c).alias(c) for c in from_address]).alias("adresseEtablissement"),
        F.array(past, present).alias("periodesEtablissement"),
    )
    return flat.select(F.to_json(record).alias("value"), F.col("batch_date").alias("day"))


def change_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch against the order-based history, with every kind of change.

    All customers are in it. By key: changed activity (5), changed
    state (7), employer unknown (11), renamed municipality (4), coordinate withheld (13), a
    change dated on the cap (17). Customers outside the region are new.
    """
    k = F.col("siret").cast("bigint")
    on_cap = k % 17 == 0
    activity = F.when(k % 5 == 0, "9-REVISED").otherwise(F.col("activitePrincipaleEtablissement"))
    state = F.col("etatAdministratifEtablissement")
    label = F.col("libelleCommuneEtablissement")
    x = F.col("coordonneeLambertAbscisseEtablissement")
    treated = F.date_add(F.lit(dt.date(2001, 6, 20)), (k % 20).cast("int")).cast("timestamp_ntz")
    changed = {
        "activitePrincipaleEtablissement": activity,
        "activitePrincipaleNAF25Etablissement": F.concat(activity, F.lit("X")),
        "etatAdministratifEtablissement": F.when(
            k % 7 == 0, F.when(state == "A", "F").otherwise("A")
        ).otherwise(state),
        "caractereEmployeurEtablissement": F.when(k % 11 != 0, F.col("caractereEmployeurEtablissement")),
        "libelleCommuneEtablissement": F.when(k % 4 == 1, F.concat(label, F.lit(" BIS"))).otherwise(label),
        "coordonneeLambertAbscisseEtablissement": F.when(k % 13 != 0, x),
        "dateDernierTraitementEtablissement": F.when(
            on_cap, moment("2001-06-01")
        ).otherwise(treated + F.make_dt_interval(hours=(k % 24).cast("int"))),
        "dateDebut": F.when(on_cap, F.lit(dt.date(2001, 5, 15))).otherwise(
            F.date_add(F.lit(dt.date(2001, 6, 25)), (k % 10).cast("int"))
        ),
    }
    return staged(spark, sf_dir, "full_stock").withColumns(changed).drop(SPEC.period_count)


# --- tables that the registry keeps as files, written once per application --------------


def _build_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regional_stock(staged(spark, sf_dir, "full_stock"), REGION)


def _build_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["siret", "dateDebut", "dateFin", *SPEC.source_tracked]
    return history_semi(
        history_text(spark, sf_dir).select(*wanted), multi_period_keys(staged(spark, sf_dir, "stock")), SPEC.key
    )


def _build_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_initial(staged(spark, sf_dir, "stock"), staged(spark, sf_dir, "history"), LOAD_DATE)


def _build_everywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history table of the customers of all nations, without the region's filter."""
    everyone = staged(spark, sf_dir, "full_stock")
    wanted = ["siret", "dateDebut", "dateFin", *SPEC.source_tracked]
    past = history_semi(history_text(spark, sf_dir).select(*wanted), multi_period_keys(everyone), SPEC.key)
    return scd2_initial(everyone, past, LOAD_DATE)


_BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "periods": order_periods,  # stock and history are both made of it
    "full_stock": full_stock,
    "stock": _build_stock,
    "history": _build_history,
    "silver": _build_silver,
    "everywhere": _build_everywhere,
    "delta": delta,
}
_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as parquet in the shared folder; the delta is partitioned by batch."""
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _STAGED:
        parts = (SPEC.batch_date,) if name == "delta" else ()
        _STAGED[at] = materialize(_BUILDERS[name](spark, sf_dir), name, parts)
    return _STAGED[at]


def fresh_name(prefix_: str) -> str:
    """A catalog name no other run has used."""
    return f"{prefix_}_{uuid.uuid4().hex}"
