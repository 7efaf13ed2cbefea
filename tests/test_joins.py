import random
import time

import pytest

from gaugeworks.operators import asof_lookback, exclude, expand_dotted, first_match, names_at
from gaugeworks.settings import SEED_RULES
from gaugeworks.sources import in_databases
from tests.conftest import d, rows, t

RULES = "class_id int, priority int, program_like string, workload_category string, notes string"


def test_asof_takes_the_newest_row_old_enough(spark):
    columns = "k string, day date, kb long"
    current = spark.createDataFrame([("a", d("2024-03-31"), 90), ("b", d("2024-03-31"), 1)], columns)
    history = spark.createDataFrame(
        [
            ("a", d("2024-01-01"), 10),
            ("a", d("2024-03-01"), 50),  # exactly 30 days before
            ("a", d("2024-03-02"), 60),  # 29 days before
            ("b", d("2024-03-30"), 2),
        ],
        columns,
    )
    got = asof_lookback(current, history, ["k"], "day", 30, ["kb"])
    assert rows(got) == {
        ("a", d("2024-03-31"), 90, d("2024-03-01"), 50),
        ("b", d("2024-03-31"), 1, None, None),
    }


def test_asof_against_brute_force(spark):
    rng = random.Random(5)
    data = [(f"k{k}", d("2024-01-01").fromordinal(738000 + n), rng.randrange(100))
            for k in range(6) for n in rng.sample(range(60), 20)]
    df = spark.createDataFrame(data, "k string, day date, kb long")
    expected = set()
    for k, day, kb in data:
        old = [(p[1], p[2]) for p in data if p[0] == k and (day - p[1]).days >= 7]
        expected.add((k, day, kb, *(max(old) if old else (None, None))))
    assert rows(asof_lookback(df, df, ["k"], "day", 7, ["kb"])) == expected


def classify(spark, programs, rules, **options):
    df = spark.createDataFrame([(p,) for p in programs], "program string")
    return {r.program: r.label for r in first_match(df, rules, "program", "label", "Unknown", **options).collect()}


def test_seed_rules(spark):
    got = classify(
        spark,
        ["SSIS-Nightly", "x Tableau y", "Microsoft Power BI", "pgbench", None, ".Net SqlClient ODBC", "sqlcmd"],
        SEED_RULES,
    )
    assert got == {
        "SSIS-Nightly": "ETL/SSIS",
        "x Tableau y": "BI/Tableau",
        "Microsoft Power BI": "BI/Power BI",
        "pgbench": "Unknown",
        None: "Unknown",
        ".Net SqlClient ODBC": "App (generic)",
        "sqlcmd": "Admin/CLI",
    }


def test_priority_wins_then_class_id_and_case(spark):
    rules = spark.createDataFrame(
        [(5, 20, "A%", "late", None), (3, 10, "ab%", "early", None), (2, 10, "%b", "first", None)], RULES
    )
    got = classify(spark, ["ab", "abc", "axx", "zzz"], rules)
    assert got == {"ab": "first", "abc": "early", "axx": "late", "zzz": "Unknown"}
    assert classify(spark, ["axx", "Axx"], rules, case_sensitive=True) == {"axx": "Unknown", "Axx": "late"}


def test_no_rules(spark):
    assert classify(spark, ["a"], []) == {"a": "Unknown"}


@pytest.mark.parametrize(
    "name, expected",
    [("dbo.Orders", {"dbo", "dbo.Orders"}), ("dbo.Orders.IX", {"dbo", "dbo.Orders", "dbo.Orders.IX"}), ("x", {"x"})],
)
def test_expand_dotted(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string")
    assert {r.p for r in expand_dotted(df, "n", "p").collect()} == expected


def test_expand_dotted_matches_the_prefix_condition(spark):
    names = ["a.b", "a.b.c", "a.bc.d", "a.b.c.d", "ab", "a_b.c", "a..b"]
    tables = ["a.b", "a.b.c", "a", "a_b", "a.", "zz"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    right = spark.createDataFrame([(x,) for x in tables], "p string")
    got = rows(expand_dotted(df, "n", "p").join(right, "p").select("n", "p"))
    assert got == {(n, x) for n in names for x in tables if n == x or n.startswith(x + ".")}


def test_exclude_list_and_table_agree(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "w string")
    listed = spark.createDataFrame([("a",), ("a",)], "x string")
    assert rows(exclude(df, "w", ["a"])) == rows(exclude(df, "w", listed)) == {("b",), (None,)}
    assert exclude(df, "w", []).count() == 3


def test_asof_is_linear_in_one_key(spark):
    days = spark.range(50_000).selectExpr("'k' k", "date_add(date'1900-01-01', cast(id as int)) day", "id kb")
    start = time.perf_counter()
    got = asof_lookback(days, days, ["k"], "day", 30, ["kb"]).where("prior_kb is not null and prior_kb != kb - 30").count()
    assert got == 0 and time.perf_counter() - start < 20


def test_asof_ties_and_null_keys(spark):
    now = spark.createDataFrame([("a", d("2024-02-01"), 5), (None, d("2024-02-01"), 6)], "k string, day date, kb long")
    old = spark.createDataFrame([("a", d("2024-01-02"), 1), ("a", d("2024-01-02"), 9), (None, d("2024-01-01"), 3)], "k string, day date, kb long")
    assert rows(asof_lookback(now, old, ["k"], "day", 30, ["kb"]).select("kb", "prior_kb")) == {(5, 9), (6, None)}


@pytest.mark.parametrize("as_table", [False, True])
def test_pattern_language(spark, as_table):
    rules = [(1, 1, "CORP\\app%", "slash", None), (2, 2, "a[_]b", "literal", None), (3, 3, "x[a-c]y", "class", None), (4, 4, "n[^0-9]%", "not", None), (5, 5, "p.q_", "dot", None)]
    programs = ["corp\\app 1", "a_b", "axb", "xby", "xdy", "nz", "n1", "p.qz", "pxqz", None]
    table = spark.createDataFrame(rules, "class_id int, priority int, program_like string, workload_category string, notes string") if as_table else rules
    assert classify(spark, programs, table) == {
        "corp\\app 1": "slash", "a_b": "literal", "axb": "Unknown", "xby": "class", "xdy": "Unknown", "nz": "not", "n1": "Unknown",
        "p.qz": "dot", "pxqz": "Unknown", None: "Unknown",
    }


def test_names_as_of_the_poll(spark):
    names = spark.createDataFrame(
        [("i", 5, "old", t(f"2024-05-01 0{h}:00:00")) for h in (1, 1, 2, 3)] + [("i", 5, "new", t(f"2024-05-01 0{h}:00:00")) for h in (4, 5)],
        "source_instance string, database_id int, name string, snapshot_time_utc timestamp",
    )
    polls = [("i", k, t(f"2024-05-01 0{h}:30:00")) for k, h in [(5, 0), (5, 2), (5, 3), (5, 4), (5, 9), (6, 2), (None, 2)]]
    df = spark.createDataFrame(polls, "source_instance string, database_id int, snapshot_time_utc timestamp")
    key = ["source_instance", "database_id"]
    got = names_at(df, names, key, {"database_name": "name"})
    assert sorted((r.database_id or 0, r.snapshot_time_utc.hour, r.database_name) for r in got.collect()) == [
        (0, 2, None), (5, 0, "old"), (5, 2, "old"), (5, 3, "old"), (5, 4, "new"), (5, 9, "new"), (6, 2, None)]
    assert names_at(df, names, key, {"database_name": "name"}, "inner").count() == 5
    current = names.where("name = 'new'").drop("snapshot_time_utc").distinct()
    assert names_at(df, current, key, {"database_name": "name"}).where("database_name = 'new'").count() == 5


def test_databases_by_instance_and_poll(spark):
    columns = "source_instance string, snapshot_time_utc timestamp, database_id int, name string, state_desc string"
    one, two = t("2024-05-01 01:00:00"), t("2024-05-01 02:00:00")
    listed = spark.createDataFrame(
        [("i", one, 5, "a", "ONLINE"), ("i", two, 5, "a", "OFFLINE"), ("j", one, 5, "a", "ONLINE"), ("j", one, 6, "b", "ONLINE"), ("i", one, 1, "m", "ONLINE")], columns)
    df = spark.createDataFrame(
        [(i, at, n) for i in "ij" for at in (one, two) for n in "abm"], "source_instance string, snapshot_time_utc timestamp, database_name string")
    assert rows(in_databases(df, databases=listed)) == {("i", one, "a"), *[("j", at, n) for at in (one, two) for n in "ab"]}
    assert rows(in_databases(df, {"j": ["b"]}, listed)) == {("i", one, "a"), ("j", one, "b"), ("j", two, "b")}
    assert in_databases(df, ["a"]).count() == 4
