from __future__ import annotations

from telemetry_lake.session import sized_for, work_dir


def test_sizes():
    small, large = sized_for(1 << 20), sized_for(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert 37_000 < int(large["spark.sql.shuffle.partitions"]) < 37_500


def test_work_folders_are_new_and_shared(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or first.startswith(base)
