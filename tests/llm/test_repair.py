"""Conversation repair against a table of all states, SQL, and hand-made faults."""

import random

import duckdb
import pyarrow as pa
import pytest

from annalist.llm import queries as Q
from annalist.llm import repair
from annalist.llm.repair import cheapest_edits, damage, repair_plans, repair_report, repaired_rows

SCHEMA = "conv_id long, turn long, role string, text string"


def least_of_all(codes):
    """Cost and letters of the least edits by keeping, per row and last role, the least pair."""
    due = {0: 2, 1: 2, 2: 3, 3: 2}

    def with_inserts(found):
        found = dict(found)
        for _ in range(3):
            for q, (c, a) in list(found.items()):
                found[due[q]] = min(found.get(due[q], (10**9, "")), (c + 5, a + "I"))
        return found

    best = {0: (0, "")}
    for code in codes:
        role, must_go, cut, after = code >> 2, code & 2, code & 1, {}
        for q, (c, a) in with_inserts(best).items():
            moves = [(2, "D", q)]
            if not must_go:
                moves.append((1 + 5 * cut, "R", due[q]))
                if role == due[q] or (role == 1 and q == 0):
                    moves.append((5 * cut, "K", role))
            for step, letter, to in moves:
                after[to] = min(after.get(to, (10**9, "")), (c + step, a + letter))
        best = after
    best = with_inserts(best)
    return min(best[q] for q in (0, 3) if q in best)


def test_search_finds_the_least_cost_and_letters():
    rng = random.Random(5)
    for _ in range(1500):
        flags = rng.choice([(0,), (0, 0, 1), (0, 1, 2), (0, 2)])
        codes = bytes(4 * rng.choice([0, 1, 2, 2, 3, 3]) + rng.choice(flags) for _ in range(rng.randrange(25)))
        assert cheapest_edits(codes) == least_of_all(codes)


def test_long_conversations_take_time_in_proportion():
    rng = random.Random(6)
    codes = bytes(4 * rng.choice([1, 2, 2, 3, 3]) + rng.choice([0, 0, 0, 1, 2]) for _ in range(20_000))
    cost, audit = cheapest_edits(codes)
    assert cost == least_of_all(codes)[0] and len(audit.replace("I", "")) == 20_000


ODD = [
    (None, 0, "user", "Of nobody?"),
    (None, 1, "assistant", "No."),
    (1, None, "user", "First."),
    (1, None, "assistant", "also first."),
    (1, 9, "assistant", None),
    (2, 0, None, "x."),
    (2, 1, "", "y."),
    (2, 2, "User", "z!"),
    (3, 5, "user", ""),
    (3, 5, "user", " \t\n"),
    (4, 0, "system", "Rules."),
    (4, 1, "user", "a?"),
    (4, 1, "user", "a?"),
    (4, 1, "assistant", "b"),
    (4, 3, "assistant", "b"),
    (4, 30, "tool", "é. "),
    (5, 0, "user", "v\x0bw." * 3000),
    *[(6, i, ["user", "assistant"][i % 3 == 1], f"t{i % 7}.") for i in range(300)],
    *[(7 + i // 3, i % 3, ["system", "user", "assistant"][i % 3], f"hello {i}.") for i in range(240)],
]


def test_query_equals_its_twin_on_odd_rows(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "1 AS cost", "'x' AS audit", "true AS blank").write.parquet(f"{folder}/conversations.parquet")
    got = Q.queries()["op11_conversation_repair"](spark, folder)
    con = duckdb.connect()
    con.register("conversations", pa.table({c: list(v) for c, v in zip(["conv_id", "turn", "role", "text"], zip(*ODD, strict=True), strict=True)}))
    wanted = con.sql(Q.oracle_sql()["op11_conversation_repair"])
    assert got.columns == wanted.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted.fetchall()))


def test_faults_and_repaired_rows(spark):
    rows = [
        (1, 1, "user", "One."),
        (1, 2, "user", "Two."),
        (1, 3, "assistant", " "),
        (1, 7, "user", "One."),
        (1, 8, "assistant", "cut off"),
        (2, 1, "user", "gone"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "conv_id = 2 AS absent")
    plans = repair_plans(df).orderBy("conv_id").collect()
    assert tuple(plans[0]) == (1, 3, 1, 1, 1, 1, 7, "KRDDD")
    assert tuple(plans[1]) == (2, 0, 0, 0, 0, 0, 0, "")
    out = repaired_rows(df, repair_plans(df)).orderBy("position").collect()
    assert [tuple(r) for r in out] == [(1, 0, "K", "user", "One."), (1, 1, "R", "assistant", "Two.")]
    report = {r.conv_id: r.repaired_sha256 for r in repair_report(df).collect()}
    assert report[2] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair_report(damage(none)).count() == 0


@pytest.mark.parametrize("kind", range(5))
def test_every_kind_of_damage(spark, kind):
    import zlib

    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:3".encode()) % 20 == kind)
    got = [tuple(r) for r in damage(spark.createDataFrame([(conv, 3, "assistant", "A. b?")], SCHEMA)).collect()]
    row = (conv, 3, "assistant", "A. b?", False)
    wanted = {0: [row[:4] + (True,)], 1: [row[:3] + ("", False)], 2: [row[:3] + ("A b", False)], 3: [row, row]}
    assert got == wanted.get(kind, [(conv, 3, "user", "A. b?", False)])
    assert repair.INSERT == 5
