from gaugeworks.plans.jobs import Store
from gaugeworks.plans.views import LIVE, Views
from gaugeworks.schemas import TABLES
from tests.conftest import d, t

AS_OF = t("2024-06-30 12:30:00")


def cpu(spark, *data):
    return spark.createDataFrame([("i", t(time), *rest) for time, *rest in data], TABLES["fact_cpu"].columns)


def seen(spark):
    return {(str(r.sample_time_utc), r.sql_cpu_pct) for r in spark.sql("SELECT * FROM rpt_cpu_timeline").collect()}


def test_report_views_follow_upserts_and_purges(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    views = Views(store, lambda: AS_OF)
    assert len(views.refresh()) == 16
    assert seen(spark) == set()
    table = store.table("fact_cpu")
    table.upsert(cpu(spark, ("2024-06-28 10:00:00", 10, 0, 90)))
    assert seen(spark) == {("2024-06-28 10:00:00", 10)}
    table.upsert(cpu(spark, ("2024-06-28 10:00:00", 20, 0, 80), ("2024-06-30 10:00:00", 30, 0, 70)))  # rewrites a day
    assert seen(spark) == {("2024-06-28 10:00:00", 20), ("2024-06-30 10:00:00", 30)}
    table.append(cpu(spark, ("2024-06-30 11:00:00", 40, 0, 60)))
    assert len(seen(spark)) == 3
    table.purge(AS_OF, days=1)
    assert len(seen(spark)) == 2
    views.close()


def test_writes_of_others_are_seen_by_sql(spark, tmp_path):
    views = Views(Store(spark, str(tmp_path)), lambda: AS_OF)
    Store(spark, str(tmp_path)).table("fact_cpu").upsert(cpu(spark, ("2024-06-28 10:00:00", 10, 0, 90)))
    assert views.sql("SELECT * FROM rpt_cpu_timeline").count() == 1


def test_bounds_prune_days(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.table("fact_cpu").upsert(cpu(spark, ("2024-06-28 10:00:00", 10, 0, 90), ("2024-06-30 10:00:00", 30, 0, 70)))
    views = Views(store, lambda: AS_OF, since=d("2024-06-29"))
    rows = views.sql("SELECT * FROM rpt_cpu_timeline")
    assert rows.count() == 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and ">= 2024-06-29" in plan


def test_live_views_read_what_has_landed(spark, tmp_path):
    grants = "source_instance string, snapshot_time_utc timestamp, scheduler_id int, current_tasks_count int, " \
        "runnable_tasks_count int, work_queue_count int, pending_disk_io_count int"
    raw = {"schedulers": [("i", AS_OF, 1, 2, 3, 4, 5)]}
    store = Store(spark, str(tmp_path))
    name, (tables, build) = "cpu_schedulers", LIVE["cpu_schedulers"]
    assert len(LIVE) == 8
    frame = lambda table: spark.createDataFrame(raw[table], grants)
    one = {name: (tables, build)}
    views = Views(store, lambda: AS_OF, raw=frame)
    others = {k: v for k, v in LIVE.items() if k != name}
    for k in others:
        del LIVE[k]
    try:
        assert f"live_{name}" in views.refresh()
        raw["schedulers"].append(("i", AS_OF, 2, 2, 3, 4, 5))
        assert views.sql(f"SELECT * FROM live_{name}").count() == 2
    finally:
        LIVE.clear()
        LIVE.update({**one, **others})
