"""Results must not depend on the physical plan: the same queries with every
join forced to a shuffle join and AQE skew splitting made aggressive give
the same rows as the default (broadcast-heavy) plans."""

import pytest

from scorecast import registry as entry
from conftest import SF_SMALL

KEYS = ["usage_results_by_client", "detail_star_join", "standards_summary", "standards_by_demographic",
        "cluster_ratio", "status_matrix", "benchmarks_by_client_total"]

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.shuffle.partitions": "7",
}


@pytest.mark.parametrize("key", KEYS)
def test_same_rows_under_shuffle_joins(spark, key):
    fn = entry.queries()[key]
    base = sorted(map(repr, fn(spark, SF_SMALL).collect()))
    old = {k: spark.conf.get(k, None) for k in FORCED}
    try:
        for k, v in FORCED.items():
            spark.conf.set(k, v)
        forced = sorted(map(repr, fn(spark, SF_SMALL).collect()))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert forced == base
