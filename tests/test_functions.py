import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from gaugeworks.functions import scalar
from tests.conftest import t


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_hour_boundaries_count_clock_hours(spark):
    for a, b, expected in [
        ("2024-01-01 00:59:00", "2024-01-01 02:01:00", 2),
        ("2024-01-01 00:00:00", "2024-01-01 00:59:59", 0),
        ("2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
    ]:
        assert value(spark, scalar.hour_boundaries(F.lit(t(a)), F.lit(t(b)))) == expected


def test_statement_slice(spark):
    text = F.lit("select 1; select 22")

    def cut(start, end):
        return value(spark, scalar.statement_slice(text, F.lit(start), F.lit(end)))

    assert cut(0, -1) == "select 1; select 22"
    assert cut(20, -1) == "select 22"
    assert cut(0, 14) == "select 1"


def test_attribution_hash_keeps_places_of_missing_names(spark):
    got = value(spark, scalar.attribution_hash(F.lit("u"), F.lit(None).cast("string"), F.lit("h"), F.lit("ä")))
    assert bytes(got) == hashlib.sha256("u||h|ä".encode("utf-16-le")).digest()


def test_agent_timestamp(spark):
    assert value(spark, scalar.agent_timestamp(F.lit(20240131), F.lit(70509))) == t("2024-01-31 07:05:09")
    assert value(spark, scalar.agent_timestamp(F.lit(0), F.lit(0))) is None


def test_means_truncate_before_the_unit_change(spark):
    mean = scalar.micros_to_ms(scalar.truncated_mean(F.lit(10_009).cast("long"), F.lit(2).cast("long")))
    assert value(spark, mean) == Decimal("5.00")
    assert value(spark, scalar.truncated_mean(F.lit(5).cast("long"), F.lit(0).cast("long"))) is None


def test_safe_ratio(spark):
    for n, d, expected in [(1, 3, 0.333333), (1, 0, None), (1, -2, None), (None, 2, None)]:
        assert value(spark, scalar.safe_ratio(F.lit(n).cast("long"), F.lit(d).cast("long"))) == expected


def test_wait_categories(spark):
    expected = {
        "LCK_M_S": "Lock",
        "LCKXM_S": "Other",
        "CXCONSUMER": "Parallelism",
        "PAGEIOLATCH_EX": "IO",
        "BACKUPIO": "IO",
        "CMEMTHREAD": "Memory",
        "NET_WAITFOR_PACKET": "Network",
        "THREADPOOL": "CPU",
        "TRACEWRITE": "Other",
    }
    df = spark.createDataFrame([(w,) for w in expected], "w string")
    assert {r.w: r.c for r in df.select("w", scalar.wait_category(F.col("w")).alias("c")).collect()} == expected


def test_hash_is_null_free_for_null_names(spark):
    row = spark.range(1).select(scalar.attribution_hash(*[F.lit(None).cast("string")] * 4).alias("h")).first()
    assert bytes(row.h) == hashlib.sha256("|||".encode("utf-16-le")).digest()
