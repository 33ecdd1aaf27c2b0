"""Scratch tables and the number of shuffle tasks."""

import os

import pytest
from pyspark.sql import functions as F

from mercadal.functions.scalars import half_up
from mercadal.session import (
    TASK_BYTES,
    local_table,
    materialize,
    scratch_root,
    scratch_scope,
    shuffle_partitions,
    size_shuffles,
)


def names(spark):
    root = scratch_root(spark).removeprefix("file:")
    return set(os.listdir(root))


def test_scratch_scope_deletes_only_its_own_tables(spark):
    kept = materialize(spark.range(3), "kept")
    before = names(spark)
    with scratch_scope(spark):
        assert materialize(spark.range(5), "gone").count() == 5
        assert names(spark) != before
    assert names(spark) == before and kept.count() == 3
    with pytest.raises(ValueError), scratch_scope(spark):
        materialize(spark.range(5), "gone")
        raise ValueError
    assert names(spark) == before


def test_shuffle_tasks_grow_with_the_input(spark, tmp_path):
    assert shuffle_partitions(0) == 1
    assert shuffle_partitions(100 * TASK_BYTES + 1, 8) == 101
    assert shuffle_partitions(100 << 40, 200) == (100 << 40) // TASK_BYTES
    was = spark.conf.get("spark.sql.shuffle.partitions")
    (tmp_path / "feed.csv").write_text("a,b\n")
    assert size_shuffles(spark, str(tmp_path), str(tmp_path / "*.csv"), str(tmp_path / "none")) == int(was)
    assert spark.conf.get("spark.sql.shuffle.partitions") == was


def test_rounding_is_one_step(spark):
    cases = [(0.124999999, 0.12), (0.125, 0.13), (2.675, 2.68), (-0.125, -0.13), (1e31, 1e31), (None, None)]
    rows = local_table(spark, [(i, v) for i, (v, _) in enumerate(cases)], "i int, v double")
    got = [r.r for r in rows.select("i", half_up(F.col("v"), 2).alias("r")).orderBy("i").collect()]
    assert got == [wanted for _, wanted in cases]
