import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gaugeworks.schemas import TABLES
from gaugeworks.session import SHUFFLE_CLEANUP, checkpoint_dir, scratch_path
from gaugeworks.sources import FactTable, fact_table
from tests.conftest import d, rows, t


@pytest.fixture
def cpu(spark, tmp_path):
    return FactTable(spark, TABLES["fact_cpu"], str(tmp_path / "fact_cpu"))


def batch(spark, *data):
    full = [("i", t(at), pct, 0, 100 - pct) for at, pct in data]
    return spark.createDataFrame(full, TABLES["fact_cpu"].columns)


def content(table):
    return {(r.sample_time_utc, r.sql_cpu_pct) for r in table.read().collect()}


def test_reading_before_the_first_write(cpu):
    assert cpu.read().count() == 0 and cpu.read().columns == TABLES["fact_cpu"].names


def test_upsert_inserts_replaces_and_replays(spark, cpu):
    cpu.upsert(batch(spark, ("2024-05-01 10:00:00", 1), ("2024-05-02 10:00:00", 2)))
    fix = batch(spark, ("2024-05-02 10:00:00", 20), ("2024-05-02 11:00:00", 3), ("2024-05-03 00:00:00", 4))
    expected = {
        (t("2024-05-01 10:00:00"), 1), (t("2024-05-02 10:00:00"), 20), (t("2024-05-02 11:00:00"), 3),
        (t("2024-05-03 00:00:00"), 4),
    }
    for _ in range(3):
        cpu.upsert(fix)
        assert content(cpu) == expected and cpu.read().count() == 4


def test_untouched_days_are_not_rewritten(spark, cpu, tmp_path):
    cpu.upsert(batch(spark, ("2024-05-01 10:00:00", 1), ("2024-05-02 10:00:00", 2)))
    before = sorted(p.name for p in (tmp_path / "fact_cpu" / "day=2024-05-01").glob("*.parquet"))
    cpu.upsert(batch(spark, ("2024-05-02 10:00:00", 5)))
    after = sorted(p.name for p in (tmp_path / "fact_cpu" / "day=2024-05-01").glob("*.parquet"))
    assert before == after


def test_last_row_of_a_batch_wins(spark, cpu):
    data = batch(spark, ("2024-05-01 10:00:00", 1)).withColumn("n", F.lit(2)).unionByName(
        batch(spark, ("2024-05-01 10:00:00", 9)).withColumn("n", F.lit(1))
    )
    cpu.upsert(data, ["n"])
    assert content(cpu) == {(t("2024-05-01 10:00:00"), 1)}


def test_empty_batch(spark, cpu):
    assert cpu.upsert(batch(spark).limit(0)).count() == 0
    assert cpu.read().count() == 0


def test_null_key_parts_match(spark, tmp_path):
    table = FactTable(spark, TABLES["fact_session_sample"], str(tmp_path / "s"))
    for requests in [1, 2]:
        row = ("i", t("2024-05-01 10:00:00"), "u", None, None, "db", requests, 0, 0)
        table.upsert(spark.createDataFrame([row], TABLES["fact_session_sample"].columns))
    assert [r.active_requests for r in table.read().collect()] == [2]


def test_read_bounds_prune_partitions(spark, cpu):
    cpu.upsert(batch(spark, ("2024-05-01 10:00:00", 1), ("2024-05-02 10:00:00", 2), ("2024-05-03 10:00:00", 3)))
    df = cpu.read(since=d("2024-05-02"), until=d("2024-05-02"))
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_purge_is_strict_and_splits_the_boundary_day(spark, cpu):
    cpu.upsert(batch(spark, *[(f"2024-05-0{n} {h}:00:00", n) for n in range(1, 6) for h in ["06", "12", "18"]]))
    dropped = cpu.purge(t("2024-05-06 12:00:00"), days=3)
    assert dropped == ["day=2024-05-01", "day=2024-05-02"]
    kept = {at for at, _ in content(cpu)}
    assert min(kept) == t("2024-05-03 12:00:00") and len(kept) == 8
    assert cpu.purge(t("2024-05-06 12:00:00"), days=3) == []


def test_purge_drops_an_emptied_boundary_day(spark, cpu):
    cpu.upsert(batch(spark, ("2024-05-01 06:00:00", 1), ("2024-05-02 06:00:00", 2)))
    assert cpu.purge(t("2024-05-02 12:00:00"), days=1) == ["day=2024-05-01"]
    assert content(cpu) == {(t("2024-05-02 06:00:00"), 2)}


def test_purge_of_date_tables_keeps_the_cut_day(spark, tmp_path):
    table = FactTable(spark, TABLES["fact_health"], str(tmp_path / "h"))
    data = [("i", d(f"2024-05-0{n}"), "db", None, None, "FULL", "ONLINE", 0) for n in range(1, 5)]
    table.upsert(spark.createDataFrame(data, TABLES["fact_health"].columns))
    table.purge(t("2024-05-04 18:00:00"), days=2)
    assert {r.snapshot_date for r in table.read().collect()} == {d("2024-05-02"), d("2024-05-03"), d("2024-05-04")}


def test_purge_uses_the_tables_own_retention(spark, cpu):
    cpu.upsert(batch(spark, ("2024-03-01 00:00:00", 1), ("2024-05-01 00:00:00", 2)))
    cpu.purge(t("2024-05-02 00:00:00"))
    assert content(cpu) == {(t("2024-05-01 00:00:00"), 2)}


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert scratch_path(spark, "x").startswith(checkpoint_dir(spark))
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "/shared"}[key]))
    assert checkpoint_dir(named) == "/shared"
    assert scratch_path(named, "x") != scratch_path(named, "x")


def test_date_filters_prune_partitions(spark, tmp_path):
    table = FactTable(spark, TABLES["fact_health"], str(tmp_path / "h"))
    data = [("i", d(f"2024-05-0{n}"), "db", None, None, "FULL", "ONLINE", 0) for n in range(1, 5)]
    table.upsert(spark.createDataFrame(data, TABLES["fact_health"].columns))
    df = table.read().where(F.col("snapshot_date") >= F.lit(d("2024-05-03")))
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_staged_copies_can_be_discarded(spark, cpu):
    written = cpu.upsert(batch(spark, ("2024-05-01 10:00:00", 1)))
    staged = written.inputFiles()
    assert staged
    cpu.discard_staged()
    with pytest.raises(Exception):
        spark.read.parquet(*staged).count()
    assert content(cpu) == {(t("2024-05-01 10:00:00"), 1)}


def test_rows_without_a_time_are_set_aside_one_by_one(spark, cpu):
    undated = [("i", None, 1, 0, 9), ("i", None, 1, 0, 9)]
    rows_ = [*undated, ("i", t("2024-05-01 10:00:00"), 5, 0, 95)]
    written = cpu.upsert(spark.createDataFrame(rows_, TABLES["fact_cpu"].columns))
    assert written.count() == 1 and content(cpu) == {(t("2024-05-01 10:00:00"), 5)}
    assert spark.read.parquet(cpu.undated_path).count() == 2


def test_the_last_by_sequence_wins_not_the_largest(spark, cpu):
    polls = [("i", t("2024-05-01 10:00:00"), pct, 0, 0, n) for n, pct in enumerate((90, 10))]
    cpu.upsert(spark.createDataFrame(polls, TABLES["fact_cpu"].columns + ", polled int"), ["polled"])
    assert content(cpu) == {(t("2024-05-01 10:00:00"), 10)}


def shuffle_bytes(spark, most, seconds=10):
    """Bytes of shuffle files that the session holds; those of ended queries may go a moment later."""
    until = time.monotonic() + seconds
    while True:
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        held = sum(f.length() for f in (files.apply(n) for n in range(files.size())) if f.getName().startswith("shuffle_"))
        if held <= most or time.monotonic() > until:
            return held
        time.sleep(0.2)


def sixty_days(spark, pct="id % 60", rows=6000):
    at = "timestamp_seconds(1704067200 + (id % 60) * 86400 + id div 60) AS sample_time_utc"
    columns = ["'i' AS source_instance", at, f"CAST({pct} AS SHORT) AS sql_cpu_pct", "0S AS other_cpu_pct", "0S AS idle_pct"]
    return spark.range(rows).selectExpr(*columns).repartition(5)


def test_writes_leave_no_shuffle_files(spark, cpu):
    """Over many writes they would add up to several times the table."""
    before = shuffle_bytes(spark, 0, seconds=0)
    cpu.upsert(sixty_days(spark))
    cpu.upsert(sixty_days(spark, "1"))
    cpu.discard_staged()
    room = before + 10_000  # a task that ends after its query leaves a file without rows
    assert shuffle_bytes(spark, room) <= room
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    assert cpu.read().count() == 6000 and cpu.read().agg(F.sum("sql_cpu_pct")).first()[0] == 6000


def test_new_days_are_not_compared(spark, cpu, monkeypatch):
    cpu.upsert(batch(spark, ("2024-05-01 10:00:00", 1)))
    asked = []
    monkeypatch.setattr(cpu, "_load", lambda: asked.append(1))
    cpu.upsert(batch(spark, ("2024-05-02 10:00:00", 2), ("2024-05-03 10:00:00", 3)))
    monkeypatch.undo()
    assert not asked and content(cpu) == {(t(f"2024-05-0{n} 10:00:00"), n) for n in (1, 2, 3)}


def test_a_write_over_many_days_goes_by_pieces(spark, cpu, monkeypatch):
    """What is shuffled on the way into the table, and a rewritten copy, are parts of the batch."""
    monkeypatch.setattr(fact_table, "PIECE_BYTES", 1)
    monkeypatch.setattr(fact_table, "PIECES", 4)
    put, days, copies = cpu._put, [], []

    def watched(rows, mode):
        days.append((mode, rows.select("day").distinct().count()))
        copies.append(len(cpu._staged))
        put(rows, mode)

    monkeypatch.setattr(cpu, "_put", watched)
    cpu.upsert(sixty_days(spark))
    assert sum(n for _, n in days) == 60 and max(n for _, n in days) <= 16 and {mode for mode, _ in days} == {"append"}
    days.clear()
    fix = sixty_days(spark, "100", 3000).where("sample_time_utc < '2024-02-01'")
    cpu.upsert(fix)
    assert sum(n for _, n in days) == 31 and max(n for _, n in days) <= 9 and {mode for mode, _ in days} == {"overwrite"}
    assert max(copies) == 3 and len(cpu._staged) == 2  # each rewritten copy goes before the next piece
    assert cpu.read().count() == 6000 and cpu.read().where("sql_cpu_pct = 100").count() == fix.count()


def test_rows_that_share_a_key_are_settled_in_their_piece(spark, cpu, monkeypatch):
    monkeypatch.setattr(fact_table, "PIECE_BYTES", 1)
    monkeypatch.setattr(fact_table, "PIECES", 4)
    twice = sixty_days(spark, "1").withColumn("n", F.lit(2)).unionByName(sixty_days(spark, "2").withColumn("n", F.lit(1)))
    undated = spark.sql("SELECT 'i' source_instance, TIMESTAMP(NULL) sample_time_utc, 5S sql_cpu_pct, 0S other_cpu_pct, 0S idle_pct, 3 n")
    written = cpu.upsert(twice.unionByName(undated).unionByName(undated), ["n"])
    assert written.columns == TABLES["fact_cpu"].names and written.count() == 6000
    for found in (written, cpu.read()):
        assert [tuple(r) for r in found.groupBy("sql_cpu_pct").count().collect()] == [(1, 6000)]
    assert spark.read.parquet(cpu.undated_path).count() == 2 and len(cpu._staged) == 1
    assert spark.read.parquet(cpu.undated_path).columns == TABLES["fact_cpu"].names


def test_pieces_are_runs_of_whole_days():
    days = [d(f"2024-05-{n:02d}") for n in range(1, 31)]
    assert fact_table.PIECES == 16 and fact_table.pieces({}) == [] and fact_table.pieces(dict.fromkeys(days, 1.0)) == [days]  # few bytes go at once
    large = fact_table.PIECE_BYTES * 40.0
    cut = fact_table.pieces({day: large if n == 5 else large / 40 for n, day in enumerate(days)})
    assert [day for run in cut for day in run] == days and [days[5]] in cut and max(map(len, cut)) <= 5
