"""One query per operator, each over whole tables. Keys equal those of ``oracles.py``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.catalog import bindings as B
from annalist.functions import add_second, as_date, month_floor, prefix
from annalist.operators import asof as A
from annalist.operators import difference as X
from annalist.operators import joins as J
from annalist.operators import quality as Q
from annalist.operators import rows as R
from annalist.operators import scd2 as S
from annalist.operators import trend_sums as D
from annalist.operators import trends as T
from annalist.plans import ingestion, publish, replay, tiers, versions
from annalist.plans import trends as follow
from annalist.session import materialize, new_path
from annalist.sources import chunks, files, queue
from annalist.spec import ESTABLISHMENTS as SPEC

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

CURSOR = dt.datetime(2024, 1, 11, 12, 0, 0)
READ_DAY, AS_OF = dt.date(2024, 1, 15), dt.date(2000, 3, 1)
BOUNDS = T.spine_bounds(B.SPINE_START, B.SPINE_END)
GROUP = ["month", "ape_code", "department"]


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


stock = partial(B.staged, name="stock")
history = partial(B.staged, name="history")
silver = partial(B.staged, name="silver")
everywhere = partial(B.staged, name="everywhere")
delta = partial(B.staged, name="delta")


def spine(spark: SparkSession) -> DataFrame:
    return T.calendar_spine(spark, B.SPINE_START, B.SPINE_END)


# --- sources, sinks, queue ------------------------------------------------------------


@query
def scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = B.stock_text(spark, sf_dir)
    k = F.col("siret").cast("bigint")
    garbled = raw.withColumns(
        {
            "dateDebut": F.when(k % 50 == 7, "n/a").otherwise(F.col("dateDebut")),
            "dateDernierTraitementEtablissement": F.when(k % 40 == 3, "?").otherwise(
                F.col("dateDernierTraitementEtablissement")
            ),
            "etablissementSiege": F.when(k % 30 == 1, "oui").otherwise(F.col("etablissementSiege")),
        }
    )
    return files.scan_typed(garbled, SPEC.source_columns)


def _garbled_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("siret").cast("bigint")
    return B.stock_text(spark, sf_dir).withColumns(
        {
            "dateDebut": F.when(k % 50 == 7, "n/a").otherwise(F.col("dateDebut")),
            "etablissementSiege": F.when(k % 30 == 1, "oui").otherwise(F.col("etablissementSiege")),
        }
    )


def _rescued(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stock and delta with the text of what did not cast."""
    stock_rows = files.scan_typed(_garbled_stock(spark, sf_dir), SPEC.source_columns, queue.RESCUED)
    nested = files.ingest_nested_json(B.delta_json(spark, sf_dir), files.nested_delta_schema(SPEC), F.col("day"))
    treated = F.when(F.col("siret").cast("bigint") % 10 == 0, "soon").otherwise(F.col(SPEC.treated_at))
    return stock_rows, R.flatten_nested(nested.withColumn(SPEC.treated_at, treated), rescue=queue.RESCUED)


@query
def rescued_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row and column of every value that did not cast, with its text."""
    stock_rows, records = _rescued(spark, sf_dir)
    day = F.lit(None).cast("date").alias("batch_date")
    found = R.rescued_texts(stock_rows, queue.RESCUED, "siret", day)
    return found.unionByName(R.rescued_texts(records, queue.RESCUED, "siret", "batch_date"))


@query
def check_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 5 % of a column may fail to cast."""
    return Q.check_rescued(_rescued(spark, sf_dir)[0], queue.RESCUED, 0.05)


@query
def scan_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.scan_projected(
        B.history_text(spark, sf_dir), ["siret", "dateDebut", "dateFin", *SPEC.source_tracked]
    )


@query
def stage_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.stage_parquet(stock(spark, sf_dir), new_path(spark, "staged"))


@query
def ingest_nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested delta lines, plus the events' own JSON column parsed the same way."""
    nested = files.ingest_nested_json(
        B.delta_json(spark, sf_dir), files.nested_delta_schema(SPEC), F.col("day")
    )
    return nested.select(
        "siret",
        "dateCreationEtablissement",
        "etablissementSiege",
        F.col("adresseEtablissement.codeCommuneEtablissement").alias("commune"),
        F.size("periodesEtablissement").alias("n_periods"),
        F.col("periodesEtablissement")[0]["dateFin"].alias("first_end"),
        F.col("periodesEtablissement")[1]["activitePrincipaleEtablissement"].alias("activity"),
        "batch_date",
    )


@query
def append_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = B.table(spark, sf_dir, "events").withColumn("batch_date", F.col("ts").cast("date"))
    early = events.filter(F.col("batch_date") < "2024-01-16").select("event_id", "user_id", "value", "batch_date")
    late = events.filter(F.col("batch_date") >= "2024-01-16").select("event_id", "event_type", "value", "batch_date")
    return queue.append_evolving(early, late)


@query
def append_evolving_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches in one queue: a struct and an array's struct gain a field, a number widens, another becomes text."""
    events = B.table(spark, sf_dir, "events").withColumn("batch_date", F.col("ts").cast("date"))
    early = events.filter(F.col("batch_date") < "2024-01-16").select(
        "event_id",
        F.struct(F.col("user_id").alias("id")).alias("who"),
        F.array(F.struct(F.col("event_type").alias("kind"))).alias("steps"),
        (F.col("event_id") % 100).cast("int").alias("size"),
        (F.col("event_id") % 7).alias("code"),
        "batch_date",
    )
    step = lambda kind, at: F.struct(kind.alias("kind"), at.alias("at"))
    late = events.filter(F.col("batch_date") >= "2024-01-16").select(
        "event_id",
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name")).alias("who"),
        F.array(step(F.col("event_type"), F.col("event_id")), step(F.lit("end"), F.lit(-1).cast("bigint"))).alias("steps"),
        (F.col("event_id") * 1_000_000_000_000).alias("size"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("c"), F.col("event_type"))).otherwise("12").alias("code"),
        "batch_date",
    )
    name = B.fresh_name("evolving")
    for batch in (early, late, early.filter("event_id % 10 = 0")):
        queue.append_to_queue(batch, name, new_path(spark, name))
    return spark.table(name).select(
        "event_id",
        F.col("who.id").alias("who"),
        F.col("who.name").alias("name"),
        F.size("steps").alias("n_steps"),
        F.get("steps", F.lit(0))["kind"].alias("kind"),
        F.get("steps", F.lit(0))["at"].alias("at_event"),
        "size",
        "code",
        F.element_at(queue.RESCUED, "code").alias("rescued"),
        "batch_date",
    )


@query
def ingest_unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delta lines with a field more in the record, in its address, and in its first period."""
    lines = B.delta_json(spark, sf_dir)
    more = F.regexp_replace("value", r"^\{", '{"owner":{"since":2001},')
    more = F.regexp_replace(more, r'"adresseEtablissement":\{', '"adresseEtablissement":{"floor":"3",')
    more = F.regexp_replace(more, r'"periodesEtablissement":\[\{', '"periodesEtablissement":[{"note":"n",')
    found = files.ingest_nested_json(
        lines.withColumn("value", more), files.nested_delta_schema(SPEC), F.col("day"), extra=ingestion.EXTRA
    )
    extra = lambda k: F.element_at(ingestion.EXTRA, k)
    return found.select(
        "siret",
        "batch_date",
        extra("owner").alias("owner"),
        extra("adresseEtablissement.floor").alias("floor"),
        extra("periodesEtablissement[0].note").alias("note"),
        F.size(ingestion.EXTRA).alias("n"),
        F.col("adresseEtablissement.codeCommuneEtablissement").alias("commune"),
    )


@query
def overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = B.fresh_name("silver")
    return files.overwrite_table(silver(spark, sf_dir), name, new_path(spark, name))


@query
def comment_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.describe_columns(files.comment_columns(silver(spark, sf_dir), SPEC))


@query
def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.incremental_slice(
        B.table(spark, sf_dir, "events"), "ts", CURSOR, "event_type", ("cl", "pu", "er")
    )


@query
def next_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = B.table(spark, sf_dir, "events")
    none = events.filter("ts > timestamp_ntz'2030-01-01'")
    return (
        queue.next_cursor(events, "ts", CURSOR)
        .withColumn("batch", F.lit("all"))
        .unionByName(queue.next_cursor(none, "ts", CURSOR).withColumn("batch", F.lit("none")))
    )


@query
def plan_range_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a type, here every one of 'error', are a part of their own."""
    events = B.table(spark, sf_dir, "events")
    part = F.when(F.col("event_type") != "error", F.col("event_type"))
    return chunks.plan_range_chunks(
        events.withColumn("event_type", part), "event_type", "ts", dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), 200
    )


@query
def pending_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.pending_batches(delta(spark, sf_dir))


@query
def read_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue.read_batch(delta(spark, sf_dir), READ_DAY)


@query
def ack_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = queue.ack_batch(delta(spark, sf_dir), READ_DAY)
    return left.groupBy("batch_date").agg(F.count("*").alias("n"), F.count_distinct("siret").alias("entities"))


@query
def bootstrap_or_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw text and JSON lines to the history: first load, then thirty nested batches."""
    name, queue_name = B.fresh_name("history"), B.fresh_name("queue")
    root = new_path(spark, "published")
    present, past = ingestion.prepare_sources(
        B.stock_text(spark, sf_dir), B.history_text(spark, sf_dir), B.REGION, root
    )
    lines = B.delta_json(spark, sf_dir)
    ingestion.enqueue_batch(lines, queue_name, F.col("day"), CURSOR, path=new_path(spark, queue_name))
    return ingestion.bootstrap_or_incremental(
        spark, name, root, present, past, queue_name, B.LOAD_DATE, buckets=8, reader=R.flatten_nested, tiered=True
    )


# --- projections and filters ----------------------------------------------------------


@query
def drop_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    everyone = B.staged(spark, sf_dir, "full_stock")
    sparse = everyone.withColumn(SPEC.area, F.when(F.col("siret").cast("bigint") % 10 != 3, F.col(SPEC.area)))
    return R.drop_null_key(sparse, SPEC.area).select("siret", SPEC.area, SPEC.state)


@query
def region_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.region_filter(B.staged(spark, sf_dir, "full_stock"), SPEC.area, B.REGION)


@query
def multi_period_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.multi_period_keys(B.staged(spark, sf_dir, "full_stock"))


@query
def single_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.single_period(B.staged(spark, sf_dir, "full_stock"))


@query
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = B.delta_json(spark, sf_dir)
    return R.flatten_nested(files.ingest_nested_json(lines, files.nested_delta_schema(SPEC), F.col("day")))


@query
def active_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' order days as arrays of periods; every other one's last period is closed too."""
    days = B.order_periods(spark, sf_dir)
    closed = F.when(F.col("k") % 2 == 0, F.coalesce("d_end", F.date_add("d", 30))).otherwise(F.col("d_end"))
    # an array holds at most one period per calendar day
    arrays = days.groupBy("k").agg(
        F.sort_array(F.collect_list(F.struct("d", closed.alias("d_end"), "activity"))).alias("periods")
    )
    found = R.active_period(arrays, "periods", "d_end")
    return found.select(
        "k",
        F.size("periods").cast("bigint").alias("n_periods"),
        F.col("active_period.d").alias("active_since"),
        F.col("active_period.activity").alias("activity"),
    )


@query
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = delta(spark, sf_dir)
    return R.dedup_exact(records.unionByName(records))


@query
def open_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.open_rows(silver(spark, sf_dir))


@query
def current_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.current_snapshot(silver(spark, sf_dir))


@query
def conditional_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed columns of the open rows take the batch's values where the entity has a period of 'F'."""
    joined = J.batch_vs_open(B.change_batch(spark, sf_dir), silver(spark, sf_dir))
    both = joined.select("incoming", (F.col("incoming")[SPEC.state] == "F").alias("flag"), "current.*")
    done = R.conditional_overwrite(
        both.filter(F.col("siret").isNotNull()), "flag", {c: F.col("incoming")[c] for c in SPEC.fixed}
    )
    return done.select("siret", "flag", *SPEC.fixed)


# --- joins ------------------------------------------------------------------------------


@query
def history_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.history_semi(
        B.history_text(spark, sf_dir).select("siret", "dateDebut", "dateFin", *SPEC.source_tracked),
        R.multi_period_keys(stock(spark, sf_dir)),
    )


@query
def enrich_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.enrich_history(
        history(spark, sf_dir), stock(spark, sf_dir), SPEC.key, [*SPEC.source_current_only, SPEC.created_on]
    )


@query
def batch_vs_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = J.batch_vs_open(B.change_batch(spark, sf_dir), silver(spark, sf_dir))
    return joined.select(
        "siret",
        F.col("incoming")[SPEC.sector].alias("new_activity"),
        F.col("current")[SPEC.sector].alias("old_activity"),
        F.col("incoming.dateDebut").alias("effective"),
        F.col("current.start_at").alias("open_since"),
    )


@query
def affected_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.affected_history(silver(spark, sf_dir), B.change_batch(spark, sf_dir))


@query
def batch_to_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = J.batch_to_history(B.change_batch(spark, sf_dir), silver(spark, sf_dir))
    return joined.select(
        "siret",
        F.col("incoming")[SPEC.state].alias("new_state"),
        F.col("current")[SPEC.state].alias("old_state"),
        F.col("current.start_at").alias("start_at"),
        F.col("current.end_at").alias("end_at"),
    )


@query
def interval_active_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join has a row per period and month by definition, so its query counts them."""
    joined = J.interval_active_join(silver(spark, sf_dir), spine(spark))
    return joined.groupBy("month", SPEC.sector, prefix(SPEC.area).alias("department")).agg(
        F.count("*").alias("n"), F.count_distinct("siret").alias("entities"), F.min("start_at").alias("first_start")
    )


@query
def dense_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.dense_grid(silver(spark, sf_dir), spine(spark), T.default_dims())


@query
def zero_filled_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    scd = silver(spark, sf_dir)
    measures = {"nb_creations": T.nb_creations(scd), "nb_closures": T.nb_closures(scd)}
    return J.zero_filled_star_join(J.dense_grid(scd, spine(spark), T.default_dims()), measures, GROUP)


@query
def snapshot_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history before and after a batch."""
    batch, before = B.change_batch(spark, sf_dir), silver(spark, sf_dir)
    after = materialize(S.scd2_apply(before, S.scd2_target(batch, before, B.CHANGE_DATE), batch), "after")
    found = X.snapshot_difference(before, after, [SPEC.key, SPEC.start])
    return found.withColumn("columns", F.concat_ws(",", "columns"))


@query
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open rows with a later closing batch as updates, and copies under other keys as inserts."""
    scd = silver(spark, sf_dir)
    updates = R.open_rows(scd).withColumn(SPEC.batch_created, as_date(B.CHANGE_DATE))
    inserts = updates.withColumn("siret", F.concat(F.lit("N"), "siret"))
    return J.merge_upsert(scd, updates.unionByName(inserts), [SPEC.key, SPEC.start])


# --- aggregations -------------------------------------------------------------------------


@query
def max_treated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.max_treated(stock(spark, sf_dir))


@query
def expected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole stock as it is, and with counters that are missing, no numbers, or too high."""
    whole = stock(spark, sf_dir)
    everything = S.scd2_initial(whole, history(spark, sf_dir), B.LOAD_DATE, keep_collapsed=True)
    k, n = F.col("siret").cast("bigint"), F.col(SPEC.period_count)
    spoilt = F.when(k % 10 == 1, F.lit(None)).when(k % 10 == 2, "two").when(k % 10 == 3, (n.cast("int") + 1).cast("string"))
    bad = whole.withColumn(SPEC.period_count, F.when(k % 10 <= 3, F.when(k % 10 > 0, spoilt).otherwise(n)).otherwise(n))
    return S.expected_rows(whole, everything).withColumn("table", F.lit("stock")).unionByName(
        S.expected_rows(bad, everything).withColumn("table", F.lit("spoilt"))
    )


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = B.table(spark, sf_dir, "orders")
    return Q.duplicate_keys(
        orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("order_day")), ["o_custkey", "order_day"]
    )


@query
def nb_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.nb_active(silver(spark, sf_dir), bounds=BOUNDS)


@query
def nb_creations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.nb_creations(silver(spark, sf_dir))


@query
def nb_closures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.nb_closures(silver(spark, sf_dir))


@query
def nb_reopenings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.nb_reopenings(silver(spark, sf_dir))


@query
def sector_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.sector_trends(silver(spark, sf_dir), B.SPINE_START, B.SPINE_END)


@query
def sector_trends_everywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers of all nations; the other trend queries are about the region that is loaded."""
    return T.sector_trends(everywhere(spark, sf_dir), B.SPINE_START, B.SPINE_END)


@query
def regional_activity_everywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.regional_activity(sector_trends_everywhere(spark, sf_dir))


@query
def current_snapshot_everywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.current_snapshot(everywhere(spark, sf_dir))


@query
def sector_trends_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closures and reopenings counted only where the state changes."""
    return T.sector_trends(silver(spark, sf_dir), B.SPINE_START, B.SPINE_END, transitions_only=True)


@query
def differential_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published sums, changed by what a batch did to the entities in it, read as trends."""
    batch, before = B.change_batch(spark, sf_dir), silver(spark, sf_dir)
    after = materialize(S.scd2_apply(before, S.scd2_target(batch, before, B.CHANGE_DATE), batch), "after")
    published = materialize(D.trend_sums(before), "sums")
    change = D.trend_changes(before, after, batch.select(SPEC.key))
    return D.trends_from_sums(D.add_sums(published, change), B.SPINE_START, B.SPINE_END)


@query
def refreshed_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published sums that follow a history in tiers: made from the whole once, then changed by two runs and a merge."""
    suffix, root = B.fresh_name(""), new_path(spark, "published")
    name, sums = f"history{suffix}", f"sums{suffix}"
    tiers.publish_tiers(silver(spark, sf_dir), name, root, buckets=8)
    follow.refresh_trend_sums(spark, name, sums, root)
    batches, early = delta(spark, sf_dir), F.dayofmonth("batch_date") <= 15
    for part in (early, ~early):
        tiers.publish_applied(spark, name, root, versions.newest(spark, name, root), batches.filter(part), buckets=8)
        found = follow.refresh_trend_sums(spark, name, sums, root)
    return D.trends_from_sums(found, B.SPINE_START, dt.date(2024, 2, 10))


# --- windows, scores, order, set operations ---------------------------------------------


@query
def net_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.net_growth(sector_trends(spark, sf_dir)).select(*GROUP, "net_growth")


@query
def dynamism_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.dynamism_score(sector_trends(spark, sf_dir)).select(*GROUP, "dynamism_score")


@query
def regional_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.regional_activity(sector_trends(spark, sf_dir))


@query
def ordered_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.ordered_output(sector_trends(spark, sf_dir), GROUP)


@query
def union_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    scd = silver(spark, sf_dir)
    still_open = R.open_rows(scd).select("siret", F.col("start_at").alias("day"), F.lit("open").alias("event"))
    ended = scd.filter("end_at IS NOT NULL").select("siret", F.col("end_at").alias("day"), F.lit("end").alias("event"))
    return still_open.unionByName(ended)


@query
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.distinct_pairs(silver(spark, sf_dir), [SPEC.sector, SPEC.area])


# --- scalar functions, each over a whole table --------------------------------------------


@query
def fn_greatest_least(spark: SparkSession, sf_dir: str) -> DataFrame:
    scd = silver(spark, sf_dir)
    return scd.select(
        "siret",
        "start_at",
        F.greatest("start_at", "end_at", "batch_closed").alias("latest"),
        F.least("end_at", "batch_closed").alias("earliest"),
    )


@query
def fn_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = B.stock_text(spark, sf_dir)
    text = F.col("coordonneeLambertAbscisseEtablissement")
    return raw.select(
        "siret",
        text.try_cast("double").alias("as_double"),
        text.try_cast("date").alias("as_date"),
        F.col("dateDebut").try_cast("date").alias("start_date"),
        F.col("dateDernierTraitementEtablissement").try_cast("timestamp_ntz").alias("treated"),
        F.col("etablissementSiege").try_cast("boolean").alias("head_office"),
        F.col("libelleCommuneEtablissement").try_cast("int").alias("label_as_int"),
    )


@query
def fn_cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = B.table(spark, sf_dir, "events")
    return events.select(
        "event_id", as_date("ts").alias("day"), as_date(F.col("ts").cast("string")).alias("day_from_text")
    )


@query
def fn_month_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = B.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", month_floor("o_orderdate").alias("month"))


@query
def fn_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = B.table(spark, sf_dir, "customer")
    return customers.select(
        "c_custkey", prefix("c_mktsegment").alias("two"), prefix("c_name", 5).alias("five")
    )


@query
def fn_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    scd = silver(spark, sf_dir)
    x = F.col("coordonneeLambertAbscisseEtablissement")
    return scd.select("siret", "start_at", F.coalesce(x, F.lit(0.0)).alias("x"), F.coalesce("end_at", "start_at").alias("day"))


@query
def fn_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = B.table(spark, sf_dir, "orders")
    size = F.when(F.col("o_totalprice") > 300000, "large").when(F.col("o_totalprice") > 100000, "medium")
    return orders.select("o_orderkey", size.alias("size"), size.otherwise("small").alias("size_or_small"))


@query
def fn_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = B.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.round(F.col("o_totalprice") / 7, 2).alias("share"))


@query
def fn_interval_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = B.table(spark, sf_dir, "events")
    return events.select(
        "event_id", add_second("ts").alias("next"), add_second(as_date("ts")).alias("day_and_second")
    )


@query
def fn_isin(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = B.table(spark, sf_dir, "customer")
    return customers.select(
        "c_custkey", F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("chosen")
    )


@query
def fn_isnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).select(
        "siret", "start_at", F.col("end_at").isNull().alias("is_open"), F.col("batch_closed").isNotNull().alias("was_closed")
    )


@query
def fn_array_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days per customer above a price, by a lambda on structs."""
    days = B.order_periods(spark, sf_dir)
    arrays = days.groupBy("k").agg(F.collect_list(F.struct("d", "price")).alias("periods"))
    dear = F.filter("periods", lambda p: p["price"] > 250000)
    return arrays.select(
        "k",
        F.size("periods").cast("bigint").alias("n"),
        F.size(dear).cast("bigint").alias("n_dear"),
        F.array_max(F.transform(dear, lambda p: p["d"])).alias("last_dear"),
    )


@query
def fn_null_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock(spark, sf_dir).select(
        "siret", F.lit(None).cast("date").alias("end_at"), as_date(B.LOAD_DATE).alias("batch_created")
    )


@query
def calendar_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per month over the months the orders span, without the last one, 0 included."""
    orders = B.table(spark, sf_dir, "orders")
    first, last = orders.agg(F.min(as_date("o_orderdate")), F.max(as_date("o_orderdate"))).first()  # one row
    per_month = orders.groupBy(month_floor("o_orderdate").alias("month_start")).agg(F.count("*").alias("n"))
    months = T.calendar_spine(spark, first, last)
    return months.join(per_month, "month_start", "left").withColumn("n", F.coalesce("n", F.lit(0)))


# --- type-2 history -------------------------------------------------------------------------


@query
def scd2_initial_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = stock(spark, sf_dir)
    return S.scd2_initial_single(whole, S.max_treated(whole), B.LOAD_DATE)


@query
def scd2_initial_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = stock(spark, sf_dir)
    return S.scd2_initial_multi(whole, history(spark, sf_dir), S.max_treated(whole), B.LOAD_DATE)


@query
def scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scd2_initial(stock(spark, sf_dir), history(spark, sf_dir), B.LOAD_DATE)


def _with_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.batch_vs_open(B.change_batch(spark, sf_dir), silver(spark, sf_dir))


@query
def detect_significant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.detect_significant(_with_open(spark, sf_dir)).select("siret", "has_significant_change")


@query
def detect_significant_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.detect_significant(_with_open(spark, sf_dir), null_safe=True)
    return found.select("siret", "has_significant_change")


@query
def detect_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.detect_fixed(_with_open(spark, sf_dir)).select("siret", "has_fixed_change")


@query
def detect_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.detect_new(_with_open(spark, sf_dir)).select("siret", "is_new")


@query
def change_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _with_open(spark, sf_dir)
    both = S.change_boundary(joined).withColumnRenamed("boundary", "later")
    return S.change_boundary(both, S.EFFECTIVE_FIRST).select("siret", "later", F.col("boundary").alias("effective_first"))


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.reconcile(B.change_batch(spark, sf_dir), silver(spark, sf_dir))


@query
def scd2_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scd2_close(_reconciled(spark, sf_dir), B.CHANGE_DATE)


@query
def scd2_open_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scd2_open_new(_reconciled(spark, sf_dir), B.CHANGE_DATE)


@query
def scd2_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scd2_insert(_reconciled(spark, sf_dir), B.CHANGE_DATE)


@query
def scd2_fix_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scd2_fix_history(_reconciled(spark, sf_dir))


@query
def scd2_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scd2_target(B.change_batch(spark, sf_dir), silver(spark, sf_dir), B.CHANGE_DATE)


@query
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.scd2_apply(silver(spark, sf_dir), scd2_target(spark, sf_dir), B.change_batch(spark, sf_dir))


@query
def scd2_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty daily batches onto the whole history."""
    return replay.scd2_replay(silver(spark, sf_dir), delta(spark, sf_dir))


@query
def two_tier_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history in tiers; the batches in three runs, of which the second is followed by a merge of all its parts."""
    name, root = B.fresh_name("tiers"), new_path(spark, "published")
    tiers.publish_tiers(silver(spark, sf_dir), name, root, buckets=8)
    batches, day = delta(spark, sf_dir), F.dayofmonth("batch_date")
    for run, part in enumerate((day <= 10, (day > 10) & (day <= 20), day > 20)):
        tiers.publish_applied(spark, name, root, versions.newest(spark, name, root), batches.filter(part), buckets=8)
        if run == 1:
            tiers.fold_in(spark, name, root, buckets=8, fixes=True)
    return spark.table(name)


@query
def state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.state_as_of(silver(spark, sf_dir), AS_OF)


@query
def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the state its customer was in, up to a month before or after it."""
    orders = B.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lpad(F.col("o_custkey").cast("string"), 14, "0").alias("siret"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 61 - 30).cast("int")).alias("day"),
    )
    found = A.as_of(orders, silver(spark, sf_dir), "day")
    return found.select(
        "o_orderkey", "siret", "day", F.col("period.start_at").alias("since"), F.col("period.end_at").alias("until"),
        F.col("period.activitePrincipaleEtablissement").alias("activity"),
    )


# --- quality and publishing -----------------------------------------------------------------


@query
def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch has one record per entity; the orders have several per customer and day."""
    orders = B.table(spark, sf_dir, "orders").withColumn("day", as_date("o_orderdate"))
    return Q.check_unique(B.change_batch(spark, sf_dir), [SPEC.key], "batch").unionByName(
        Q.check_unique(orders, ["o_custkey", "day"], "orders")
    )


@query
def check_no_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join with the open rows keeps the batch's rows; the join with all periods does not."""
    batch, scd = B.change_batch(spark, sf_dir), silver(spark, sf_dir)
    return Q.check_no_fanout(J.batch_vs_open(batch, scd), batch).withColumn("join", F.lit("open")).unionByName(
        Q.check_no_fanout(J.batch_to_history(batch, scd), batch).withColumn("join", F.lit("all"))
    )


@query
def check_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history is in order; moved back by its own length it is not."""
    scd = silver(spark, sf_dir)
    moved = scd.withColumn("end_at", F.when(F.col("siret").cast("bigint") % 3 == 0, F.date_sub("start_at", 1)).otherwise(F.col("end_at")))
    return Q.check_intervals(scd).withColumn("table", F.lit("history")).unionByName(
        Q.check_intervals(moved).withColumn("table", F.lit("moved"))
    )


@query
def check_no_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history has no overlap; with every end moved a day later it has."""
    scd = silver(spark, sf_dir)
    later = scd.withColumn("end_at", F.date_add("end_at", 1))
    return Q.check_no_overlap(scd).withColumn("table", F.lit("history")).unionByName(
        Q.check_no_overlap(later).withColumn("table", F.lit("later"))
    )


@query
def check_open_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete after the batch; before it the new entities have no open row."""
    batch, scd = B.change_batch(spark, sf_dir), silver(spark, sf_dir)
    target = scd2_target(spark, sf_dir)
    return Q.check_open_coverage(target, batch).withColumn("table", F.lit("after")).unionByName(
        Q.check_open_coverage(scd, batch).withColumn("table", F.lit("before"))
    )


@query
def check_row_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced after the batch; the untouched rows alone are not."""
    batch, scd = B.change_batch(spark, sf_dir), silver(spark, sf_dir)
    joined, rows = S.detect_changes(J.batch_vs_open(batch, scd)), J.affected_history(scd, batch)
    target = scd2_target(spark, sf_dir)
    return Q.check_row_balance(target, batch, rows, joined).withColumn("table", F.lit("after")).unionByName(
        Q.check_row_balance(rows, batch, rows, joined).withColumn("table", F.lit("before"))
    )


@query
def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.batch_report(B.change_batch(spark, sf_dir), silver(spark, sf_dir), B.CHANGE_DATE)


@query
def publish_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three models; the second reads the first's published table."""
    scd = silver(spark, sf_dir)
    suffix = B.fresh_name("")
    trends, activity, snapshot = (n + suffix for n in ("trends", "activity", "snapshot"))
    done = publish.publish_models(
        spark,
        {
            activity: T.regional_activity,
            trends: lambda: T.sector_trends(scd, B.SPINE_START, B.SPINE_END),
            snapshot: lambda: R.current_snapshot(scd),
        },
        {activity: [trends]},
        new_path(spark, "published"),
    )
    states = done.select(F.substring_index("model", "_", 1).alias("model"), "status", "n_rows")
    # what was published, as one list of entries
    entries = [
        spark.table(activity).select(
            F.lit("activity").alias("model"),
            F.concat_ws("|", F.col("month").cast("string"), "ape_code", "department").alias("entry"),
            F.concat_ws("|", "nb_active", F.coalesce(F.col("net_growth").cast("string"), F.lit("-"))).alias("content"),
        ),
        spark.table(trends).select(
            F.lit("trends").alias("model"),
            F.concat_ws("|", F.col("month").cast("string"), "ape_code", "department").alias("entry"),
            F.concat_ws("|", "nb_active", "nb_creations", "nb_closures", "nb_reopenings").alias("content"),
        ),
        spark.table(snapshot).select(
            F.lit("snapshot").alias("model"), F.col("siret").alias("entry"), F.col("start_at").cast("string").alias("content")
        ),
    ]
    return entries[0].unionByName(entries[1]).unionByName(entries[2]).join(states, "model")
