"""Joins over boxes at size: nothing that grows with the boxes goes through the driver."""

import pytest

from pairloom.operators import spatial
from pairloom.plans import catalog

BOX = "scene int, obj int, lo_x int, lo_y int, lo_z int, hi_x int, hi_y int, hi_z int"


def _plan(spark, sf, name):
    return catalog.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["aabb_contacts_new", "support_candidates", "resting_on", "carried_follow", "support_penetration"])
def test_boxes_are_not_broadcast(spark, sf, name):
    plan = _plan(spark, sf, name)
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_a_support_is_copied_to_four_cells_at_most(spark):
    df = spark.createDataFrame([(0, i, i * 900, 0, 0, i * 900 + 400 * (i % 3 + 1), 400 * (i % 3 + 1), 300) for i in range(40)], BOX)
    reach = 3500
    assert spatial._near(df, "b", 2 * reach, reach).groupBy("b").count().agg({"count": "max"}).first()[0] <= 4
    near = lambda a, b: (2 * a[2] + 400 * (a[1] % 3 + 1) - 2 * b[2] - 400 * (b[1] % 3 + 1)) ** 2 + (400 * (a[1] % 3 - b[1] % 3)) ** 2 <= 4 * reach * reach
    made = [tuple(r) for r in df.collect()]
    want = {(a[1], b[1]) for a in made for b in made if a[1] != b[1] and 5 * (b[1] % 3 + 1) * 400 >= 7 * (a[1] % 3 + 1) * 400 + 500 and near(a, b)}
    got = [(r.obj, r.support) for cell in (100, 1000, 50_000) for r in spatial.supports(df, cell, ground=0, low=80, high=1400, margin=50, reach=reach, raised=150).collect()]
    assert want and set(got) == want and len(got) == 3 * len(want)


def test_penetration_has_every_object_once(spark, rows):
    made = [(0, 1, 0, 0, 0, 1000, 1000, 300), (0, 2, 100, 100, 250, 300, 300, 400), (0, 2, 100, 100, 200, 300, 300, 400), (0, 3, None, 0, 250, 10, 10, 400), (0, 4, 100, 100, None, 300, 300, 400), (None, 5, 100, 100, 250, 300, 300, 400), (None, 5, 100, 100, 250, 300, 300, 400)]
    got = rows(spatial.penetration(spark.createDataFrame(made, BOX), 100, 20))
    assert got == [(0, 1, 0), (0, 2, 100), (0, 3, 0), (0, 4, 0), (None, 5, 0)]
