"""The general operators over empty, null and noisy tables, and with other partition counts."""

import pytest

from pairloom.plans import catalog, general
from tests import edges


@pytest.fixture(scope="module", params=["empty", "null", "noisy"])
def folder(request, spark, sf, tmp_path_factory):
    return request.param, edges.make(spark, sf, tmp_path_factory.mktemp(request.param), request.param)


@pytest.mark.parametrize("name", sorted(general.QUERIES))
def test_edges(spark, folder, name):
    kind, path = folder
    n = general.QUERIES[name](spark, path).count()
    assert n > 0 if kind == "noisy" else n == 0 or (kind == "null" and name in ("p2_table",))


@pytest.mark.parametrize("name", ["p3_found", "p5_found", "shard_assignment", "style_quota", "diverse_sample_round_robin", "qa_ranked", "resting_on"])
def test_partition_counts_change_nothing(spark, sf, name, rows):
    got = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(rows(catalog.QUERIES[name](spark, sf)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]
