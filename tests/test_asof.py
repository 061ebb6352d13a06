"""As-of join against looking at every period; rescued values."""

import datetime as dt

from conftest import SMALL, rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annalist.functions import rescued
from annalist.operators import rows as R
from annalist.operators.asof import as_of
from annalist.operators.quality import check_rescued
from annalist.sources import files
from annalist.spec import ESTABLISHMENTS

_day = st.dates(dt.date(2000, 1, 1), dt.date(2000, 1, 12))
_period = st.fixed_dictionaries(
    {"id": st.sampled_from(["a", "b"]), "size": st.sampled_from(["1", None]), "start_at": _day, "end_at": st.one_of(st.none(), _day)}
)
_probe = st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), _day))


@settings(max_examples=8, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(_period, max_size=8), st.lists(_probe, max_size=12))
def test_as_of_equals_looking_at_every_period(spark, history, periods, probes):
    """Overlaps, equal starts, repeated probes and NULLs are among them."""
    scd = history(*periods) if periods else history({"id": "x", "start_at": "2000-01-01"})
    df = spark.createDataFrame([(i, k, d) for i, (k, d) in enumerate(probes + probes[:2])], "n int, id string, on date")
    got = {r.n: r.period for r in as_of(df, scd, "on", SMALL).collect()}
    assert len(got) == len(probes) + len(probes[:2])
    far = dt.date(9999, 1, 1)
    for i, (k, d) in enumerate(probes + probes[:2]):
        started = [p for p in periods if d is not None and p["id"] == k and p["start_at"] <= d]
        if not started:
            assert got[i] is None
            continue
        start, end = max((p["start_at"], p["end_at"] or far) for p in started)
        if end <= d:
            assert got[i] is None
        else:
            assert (got[i].start_at, got[i].end_at or far) == (start, end)


def test_as_of_one_day_is_the_state_on_it(spark, history):
    scd = history(
        {"id": "a", "size": "1", "start_at": "2000-01-01", "end_at": "2000-02-01"},
        {"id": "a", "size": "2", "start_at": "2000-02-01"},
        {"id": "b", "start_at": "2000-03-01"},
    )
    day = dt.date(2000, 2, 1)
    probes = spark.createDataFrame([("a", "left", day), ("b", "right", day)], "id string, period_of string, on date")
    found = as_of(probes, scd, "on", SMALL)
    assert found.columns == ["id", "period_of", "on", "period"]
    assert rows(found.filter("period IS NOT NULL"), "id", "period.size") == rows(R.state_as_of(scd, day, SMALL), "id", "size")


def test_a_hot_entity_is_sorted_by_its_days(spark, history):
    probes = spark.range(30000).selectExpr("'a' AS id", "date_add(DATE'2000-01-01', int(id % 20)) AS on")
    found = as_of(probes, history({"id": "a", "start_at": "2000-01-11"}), "on", SMALL)
    assert found.filter("period IS NOT NULL").count() == 15000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("Aggregate [id")  # distinct before the sort


def test_rescued_values(spark):
    df = spark.sql("SELECT * FROM VALUES ('1', 'x', NULL), ('2', '3', map('a', 'first', 'old', 'o')), (NULL, NULL, NULL) AS t(a, b, r)")
    casts = {c: (F.col(c), F.col(c).try_cast("int")) for c in ("a", "b")}
    assert [r[0] for r in df.select(rescued(casts)).collect()] == [{"b": "x"}, None, None]
    casts["a"] = (F.col("a"), F.lit(None).cast("int"))
    got = [r[0] for r in df.select(rescued(casts, F.col("r"))).collect()]
    assert got == [{"a": "1", "b": "x"}, {"a": "first", "old": "o"}, None]
    report = check_rescued(df.select(rescued(casts, F.col("r")).alias("r")), "r", 0.5)
    assert rows(report) == [("rescued:a", 2, False), ("rescued:b", 1, True), ("rescued:old", 1, True)]


def test_flatten_rescues_at_any_depth(spark):
    spec = ESTABLISHMENTS
    record = "'1' AS siret, 'bad' AS dateCreationEtablissement, '2001-08-01T10:00:00' AS dateDernierTraitementEtablissement"
    df = spark.sql(f"SELECT {record}, named_struct('coordonneeLambertAbscisseEtablissement', '[ND]') AS adresseEtablissement,"
                   " array(named_struct('dateDebut', 'never', 'dateFin', string(NULL))) AS periodesEtablissement")
    for c in spec.fixed:
        if c not in ("coordonneeLambertAbscisseEtablissement", spec.created_on):
            df = df.withColumn(spec.nested_address, F.col(spec.nested_address).withField(c, F.lit(None).cast("string")))
    state, sector, employer = spec.source_tracked
    df = df.withColumn(
        spec.nested_periods,
        F.transform(spec.nested_periods, lambda p: p.withField(state, F.lit("A")).withField(sector, F.lit("x")).withField(employer, F.lit("N"))),
    )
    for c in [c for c in spec.tracked if c not in spec.source_tracked]:
        df = df.withColumn(c, F.lit(None).cast(spec.column(c).dtype))
    assert R.flatten_nested(df, rescue="_r").first()["_r"] == {
        "dateCreationEtablissement": "bad", "coordonneeLambertAbscisseEtablissement": "[ND]", "dateDebut": "never"}
    assert "_r" not in R.flatten_nested(df).columns


def test_rescued_texts_parse_a_record_once(spark):
    lines = spark.createDataFrame(
        [('{"siret":"1","dateCreationEtablissement":"bad","periodesEtablissement":[{"dateDebut":"never"}]}',), ('{"siret":"2"}',), (None,)],
        "value string",
    )
    nested = files.ingest_nested_json(lines, files.nested_delta_schema(ESTABLISHMENTS), dt.date(2001, 8, 1))
    found = R.rescued_texts(R.flatten_nested(nested, rescue="_r"), "_r", "siret", "batch_date")
    assert found.columns == ["siret", "batch_date", "column", "text"]
    day = dt.date(2001, 8, 1)
    assert sorted(found.collect()) == [("1", day, "dateCreationEtablissement", "bad"), ("1", day, "dateDebut", "never")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
