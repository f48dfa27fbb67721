"""Sessions whose tasks keep their size as the input grows."""

from __future__ import annotations

from estrella.plans import QUERIES
from estrella.session import INPUT_BYTES, TASK_BYTES, sized_session
from estrella.sources.tables import stored_bytes

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARTITIONS = "spark.sql.shuffle.partitions"


def test_partitions_follow_the_input(spark):
    given = int(spark.conf.get(PARTITIONS))
    small, large = sized_session(spark, 1), sized_session(spark, 1000 * INPUT_BYTES + 1)
    assert int(small.conf.get(PARTITIONS)) == given
    assert int(large.conf.get(PARTITIONS)) == max(given, 1001)
    assert small.conf.get(ADVISORY) == f"{TASK_BYTES}b"
    assert int(spark.conf.get(PARTITIONS)) == given


def test_smaller_sizes_and_other_settings_stay(spark):
    before = spark.conf.get(ADVISORY)
    spark.conf.set(ADVISORY, "1m")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        sized = sized_session(spark, 1)
        assert sized.conf.get(ADVISORY) == f"{1 << 20}b"
        assert sized.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set(ADVISORY, before)


def test_registered_queries_run_in_a_sized_session(spark, tmp_path):
    spark.range(10).selectExpr(
        "cast(id as int) as n_nationkey", "'x' as n_name", "cast(0 as int) as n_regionkey"
    ).write.parquet(str(tmp_path / "nation.parquet"))
    assert stored_bytes(spark, str(tmp_path)) > 0
    assert stored_bytes(spark, str(tmp_path / "none")) == 0
    out = QUERIES["distinct_rows"](spark, _customers(spark, tmp_path))
    assert out.sparkSession.conf.get(ADVISORY) == f"{TASK_BYTES}b"
    assert out.count() == 2


def _customers(spark, folder) -> str:
    spark.sql(
        "select * from values (1L, 'a', 1, 0.0d, 'm'), (2L, 'b', 1, 0.0d, 'm'), (7L, 'c', 1, 0.0d, 'm') "
        "as t(c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)"
    ).write.parquet(str(folder / "customer.parquet"))
    return str(folder)
