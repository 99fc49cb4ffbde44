"""Results do not depend on how the input is split: the same rows laid out as
16 shuffled part files (many scan tasks, as on a cluster) give exactly the
same output as the single-file table, for every registered query."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from roadpulse.plans import registry
from tests.conftest import SF001
from tests.oracle_check import canon

registry.load_all()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def split_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("split"))
    for table, key in (("events", "event_id"), ("lineitem", "l_orderkey")):
        (spark.read.parquet(f"{SF001}/{table}.parquet").repartition(16, F.xxhash64(key))
              .write.mode("overwrite").parquet(os.path.join(d, f"{table}.parquet")))
    return d


def rows(df):
    return canon(df.columns, [tuple(r) for r in df.collect()])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result_when_split(spark, split_dir, name):
    whole = QUERIES[name](spark, SF001)
    split = QUERIES[name](spark, split_dir)
    assert split.rdd.getNumPartitions() >= 1
    a, b = rows(whole), rows(split)
    assert a == b
