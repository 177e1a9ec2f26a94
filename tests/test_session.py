from __future__ import annotations

from types import SimpleNamespace

import pytest

from meterloom.session import (
    CHECKPOINT_DIR,
    INFERENCE,
    scratch_folder,
    shuffle_partitions_for,
    size_shuffles,
    text_partition_values,
)


def test_shuffle_partitions_fill_whole_waves():
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(100 << 40, 4_000) % 4_000 == 0
    assert shuffle_partitions_for(100 << 40, 4_000) >= (100 << 40) // (128 << 20)


def test_shuffles_are_sized_by_the_input(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.range(10).write.parquet(str(tmp_path / "t"))
    try:
        assert size_shuffles(spark, str(tmp_path / "t")) == spark.sparkContext.defaultParallelism
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scratch_is_in_the_shared_folder(spark, tmp_path):
    """The setting is fixed when a cluster starts, so a stand-in carries it here."""
    context = spark.sparkContext
    cluster = SimpleNamespace(conf={CHECKPOINT_DIR: f"{tmp_path}/"}, sparkContext=context)
    made = {scratch_folder(cluster, "x") for _ in range(2)}
    assert len(made) == 2 and all(path.startswith(f"{tmp_path}/meterloom-x-") for path in made)
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")
    bare = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        scratch_folder(bare, "x")


def test_partition_values_stay_text_whatever_the_session(spark, tmp_path):
    spark.range(1).selectExpr("id", "'007' AS b").write.partitionBy("b").parquet(str(tmp_path / "t"))
    spark.conf.set(INFERENCE, "true")
    try:
        with text_partition_values(spark):
            table = spark.read.parquet(str(tmp_path / "t"))
        assert spark.conf.get(INFERENCE) == "true"
    finally:
        spark.conf.set(INFERENCE, "false")
    assert table.first()["b"] == "007"
