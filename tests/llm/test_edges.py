"""The operators for language-model data over empty, null and noisy tables, and with other partition counts."""

import pytest

from pairloom.llm import queries
from tests import edges

#: Queries that have a row per row of their table, or per target, whatever the table holds.
PER_ROW = {"p7_ids", "p7_counts", "p4_kept", "p6_splits", "p6_shares", "p1_shares", "p1_token_shares"}


@pytest.fixture(scope="module", params=["empty", "null", "noisy"])
def folder(request, spark, sf, tmp_path_factory):
    return request.param, edges.make(spark, sf, tmp_path_factory.mktemp(request.param), request.param)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_edges(spark, folder, name):
    kind, path = folder
    n = queries.QUERIES[name](spark, path).count()
    if kind == "noisy":
        assert n > 0
    elif name not in PER_ROW:
        assert n == 0


@pytest.mark.parametrize("name", ["p1_mix", "p4_found", "p6_found", "p6_splits", "p8_found", "p9_found"])
def test_partition_counts_change_nothing(spark, sf, name, rows):
    got = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(rows(queries.QUERIES[name](spark, sf)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]
