"""Spreading scans, measured by their bytes and partitions."""

import pytest

from conftest import SF
from corpusloom.session import spread


def test_small_scan_is_spread(spark, documents):
    cores = spark.sparkContext.defaultParallelism
    assert documents.rdd.getNumPartitions() < cores
    dealt = spread(documents)
    assert dealt.rdd.getNumPartitions() == cores
    assert sorted(dealt.collect(), key=repr) == sorted(documents.collect(), key=repr)


def test_large_scan_stays(documents):
    assert spread(documents, max_bytes=1) is documents


@pytest.mark.parametrize("more", [0, 3])
def test_scan_with_a_partition_for_each_core_stays(spark, more):
    wide = spark.range(100).repartition(spark.sparkContext.defaultParallelism + more)
    assert spread(wide) is wide


def test_empty_scan(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id is null")
    assert spread(empty).count() == 0
