"""Types that hold two types, queues whose batches change shape, and the difference of two snapshots."""

import datetime as dt
import json

import pytest
from conftest import SMALL, rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.functions.unite import as_schema, rebuild, unite
from annalist.operators import difference as X
from annalist.operators import trend_sums as D
from annalist.session import new_path
from annalist.sources import files, queue
from annalist.spec import ESTABLISHMENTS

_ATOMS = [T.IntegerType(), T.LongType(), T.ShortType(), T.DoubleType(), T.FloatType(), T.StringType(), T.DateType(),
          T.TimestampNTZType(), T.BooleanType(), T.DecimalType(12, 2), T.NullType()]
_types = st.recursive(
    st.sampled_from(_ATOMS),
    lambda inner: st.one_of(
        inner.map(T.ArrayType),
        inner.map(lambda t: T.MapType(T.StringType(), t)),
        st.dictionaries(st.sampled_from("abc"), inner, min_size=1).map(
            lambda d: T.StructType([T.StructField(n, t) for n, t in d.items()])
        ),
    ),
    max_leaves=6,
)


def plain(t):
    """A type without order of fields, case and nullability."""
    if isinstance(t, T.StructType):
        return {f.name.lower(): plain(f.dataType) for f in t.fields}
    if isinstance(t, T.ArrayType):
        return [plain(t.elementType)]
    if isinstance(t, T.MapType):
        return ("map", plain(t.valueType))
    return t.simpleString()


@settings(max_examples=300, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(_types, _types, _types)
def test_unite_is_a_join(a, b, c):
    """Commutative, idempotent, and an upper bound."""
    ab = unite(a, b)
    assert plain(unite(a, a)) == plain(a) and plain(ab) == plain(unite(b, a))
    assert plain(unite(ab, a)) == plain(ab) == plain(unite(ab, b))
    assert plain(unite(T.NullType(), c)) == plain(c)


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("int", "bigint", "bigint"),
        ("int", "double", "double"),
        ("bigint", "double", "string"),  # neither holds all of the other
        ("smallint", "float", "float"),
        ("int", "float", "double"),
        ("decimal(10,2)", "int", "decimal(12,2)"),
        ("decimal(38,0)", "decimal(10,5)", "string"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("boolean", "int", "string"),
        ("struct<a:int>", "struct<A:bigint,b:string>", "struct<a:bigint,b:string>"),
        ("array<struct<a:int>>", "array<struct<b:date>>", "array<struct<a:int,b:date>>"),
        ("struct<a:int>", "string", "string"),
        ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
    ],
)
def test_unite_cases(spark, a, b, both):
    x, y, z = (spark.sql(f"SELECT CAST(NULL AS {t}) AS c").schema["c"].dataType for t in (a, b, both))
    assert plain(unite(x, y)) == plain(z)


def test_rebuilt_values(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (named_struct('a', 1, 'l', array(named_struct('x', 'p'), NULL))), (NULL) AS t(s)"
    )
    want = spark.sql("SELECT CAST(NULL AS struct<b: date, a: bigint, l: array<struct<y: int, x: string>>>) AS s").schema
    out = [r.s for r in as_schema(df, want).collect()]
    assert out[1] is None
    assert out[0].asDict(True) == {"b": None, "a": 1, "l": [{"y": None, "x": "p"}, None]}
    text = df.select(rebuild(F.col("s"), df.schema["s"].dataType, T.StringType()).alias("s")).first().s
    assert json.loads(text) == {"a": 1, "l": [{"x": "p"}, None]}


@pytest.mark.parametrize("stored", [True, False])
def test_batches_of_other_shapes(spark, stored):
    """A struct gains a field, an array's struct gains a field, a number widens, and a column goes: nothing is lost."""
    first = spark.sql(
        "SELECT 'a' AS id, named_struct('x', 1) AS s, array(named_struct('k', 'p')) AS l, 7 AS n, 'old' AS gone, DATE'2024-01-01' AS batch_date"
    )
    second = spark.sql(
        "SELECT 'b' AS id, named_struct('y', 'new', 'x', 2L) AS s, array(named_struct('k', 'q', 'm', 1.5D), NULL) AS l,"
        " 5000000000L AS n, map('u', 1) AS more, DATE'2024-01-02' AS batch_date"
    )
    if stored:
        name = "shapes_queue"
        for batch in (first, second, first):
            queue.append_to_queue(batch, name, new_path(spark, name))
        table = spark.table(name)
    else:
        table = queue.append_evolving(queue.append_evolving(first, second), first)
    got = sorted((r.asDict(True) for r in table.collect()), key=lambda r: r["id"])
    a = {"id": "a", "s": {"x": 1, "y": None}, "l": [{"k": "p", "m": None}], "n": 7, "gone": "old", "more": None, "batch_date": dt.date(2024, 1, 1)}
    b = {"id": "b", "s": {"x": 2, "y": "new"}, "l": [{"k": "q", "m": 1.5}, None], "n": 5 * 10**9, "gone": None, "more": {"u": 1}, "batch_date": dt.date(2024, 1, 2)}
    assert got == [a, a, b]


def test_what_a_queue_can_not_hold_is_rescued(spark):
    name = "rescue_queue"
    queue.append_to_queue(spark.sql("SELECT 1L AS id, 5 AS n, named_struct('x', 1) AS s, 'w' AS t, DATE'2024-01-01' AS batch_date"), name)
    files_before = set(spark.table(name).inputFiles())
    odd = spark.sql(
        "SELECT * FROM VALUES (2L, '12', named_struct('x', 'q', 'z', 3), named_struct('u', 1), DATE'2024-01-02'),"
        " (3L, 'many', NULL, NULL, DATE'2024-01-02') AS v(id, n, s, t, batch_date)"
    )
    queue.append_to_queue(odd, name)
    got = {r.id: r.asDict(True) for r in spark.table(name).collect()}
    assert got[1]["n"] == 5 and got[1]["s"]["x"] == 1 and got[1][queue.RESCUED] is None
    assert got[2]["n"] == 12 and got[2]["t"] == '{"u":1}'
    assert json.loads(got[2][queue.RESCUED]["s"]) == {"x": "q", "z": 3}
    assert got[3]["n"] is None and got[3][queue.RESCUED] == {"n": "many"}
    assert files_before <= set(spark.table(name).inputFiles())  # no file was written again


def test_a_queue_lost_while_it_was_redefined(spark):
    name, path = "lost_queue", new_path(spark, "lost_queue")
    row = "SELECT {} AS id, named_struct('x', 1{}) AS s, DATE'2024-01-01' AS batch_date"
    queue.append_to_queue(spark.sql(row.format(1, "")), name, path)
    spark.sql(f"DROP TABLE {name}")
    queue.append_to_queue(spark.sql(row.format(2, ", 'y', 2")), name, path)
    assert rows(spark.table(name), "id", "s.x", "s.y") == [(1, 1, None), (2, 1, 2)]


def test_unknown_fields_at_any_depth(spark):
    schema = T.StructType.fromDDL("a string, s struct<x: string, in: struct<y: string>>, l array<struct<k: string>>")
    lines = [
        {"a": "1", "s": {"x": "2", "in": {"y": "3"}}, "l": [{"k": "4"}]},
        {"a": "1", "new": {"p": [1]}, "s": {"z": 5, "in": {"w": None, "v": "6"}}, "l": [{"k": "4"}, {"n": 7, "k": "8"}, None]},
        {"s": None, "l": None},
        {"s": "no struct", "l": {"no": "array"}},
    ]
    raw = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(lines)], "i int, value string")
    extra = {r.i: r._extra for r in files.ingest_nested_json(raw, schema, dt.date(2024, 1, 1), extra="_extra").select("_extra").withColumn("i", F.monotonically_increasing_id()).collect()}
    found = [v for v in extra.values() if v]
    assert found[0] == {"new": '{"p":[1]}', "s.z": "5", "s.in.w": None, "s.in.v": "6", "l[1].n": "7"}
    assert len(found) == 1


def brute_difference(before, after):
    def by_key(table):
        out = {}
        for k, *v in table:
            out.setdefault(k, []).append(tuple(v))
        return out

    a, b, out = by_key(before), by_key(after), []
    for k in set(a) | set(b):
        gone, come = list(a.get(k, [])), list(b.get(k, []))
        for v in list(gone):
            if v in come:
                gone.remove(v)
                come.remove(v)
        if len(gone) == len(come) == 1:
            names = [c for c, x, y in zip("vw", gone[0], come[0], strict=True) if x != y]
            out.append((k, "changed", names, 1))
        else:
            out += [(k, c, [], len(g)) for c, g in (("removed", gone), ("added", come)) if g]
    return sorted(out, key=repr)


_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([1, 2, None]), st.sampled_from(["x", None])), max_size=8)


@settings(max_examples=8, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(_rows, _rows)
def test_difference_equals_brute_force(spark, before, after):
    a, b = (spark.createDataFrame(t, "k string, v int, w string") for t in (before, after))
    found = X.snapshot_difference(a, b, ["k"])
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_difference(before, after)
    assert rows(X.check_difference(a, b, found)) == [("row_balance", 0, True)]
    short = found.filter("change != 'added'")
    lost = sum(n for _, c, _, n in brute_difference(before, after) if c == "added")
    assert rows(X.check_difference(a, b, short), "n_bad") == [(lost,)]


def test_difference_feeds_the_trends(history):
    """Without knowing the batch: the entities that differ are found by comparing the snapshots."""
    old = history(*[{"id": i, "sector": "s1", "start_at": "2000-01-01"} for i in "abc"])
    new = old.withColumn("sector", F.when(F.col("id") == "b", "s2").otherwise(F.col("sector")))
    found = X.snapshot_difference(old, new, ["id", "start_at"])
    assert rows(found, "id", "change", "columns") == [("b", "changed", ["sector"])]
    change = D.trend_changes(old, new, X.touched_keys(found, "id"), spec=SMALL)
    assert rows(D.add_sums(D.trend_sums(old, spec=SMALL), change)) == rows(D.trend_sums(new, spec=SMALL))
    with pytest.raises(ValueError, match="different columns"):
        X.snapshot_difference(old, new.drop("area"), ["id"])


def test_unknown_fields_are_found_in_one_parse_of_each_text(spark):
    lines = ['{"siret":"1","new":2,"adresseEtablissement":{"floor":"3"},"periodesEtablissement":[{"note":"n"},{"note":null}]}', "{}", "no", None]
    raw = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    found = files.ingest_nested_json(raw, files.nested_delta_schema(ESTABLISHMENTS), dt.date(2024, 1, 1), extra="_extra")
    more = {"new": "2", "adresseEtablissement.floor": "3", "periodesEtablissement[0].note": "n", "periodesEtablissement[1].note": None}
    assert [r._extra for r in found.select("_extra").collect()] == [more, None, None, None]
    # the record, and in search of unknown fields: the record, its address, the list of periods, a period
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 5
