"""Exact search over cells: equal to reading everything, without reading everything."""

import numpy as np
import pytest

from paperloom.operators import cell_bounds, ivf, knn


def frame(spark, rows, key):
    return spark.createDataFrame([(i, None if r is None else [float(x) for x in r]) for i, r in rows], f"{key} bigint, embedding array<float>")


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    centres = np.eye(6)
    rows = [(i, centres[i % 6] + rng.normal(scale=0.1, size=6)) for i in range(240)]
    rows += [(300, np.zeros(6)), (301, None), (302, rows[5][1]), (303, rows[5][1])]
    vectors, path = frame(spark, rows, "pmid"), str(tmp_path_factory.mktemp("cells") / "index")
    cell_bounds.write_index(vectors, centres, path, files_per_cell=2)
    asked = [(i, centres[i % 6] + rng.normal(scale=0.1, size=6)) for i in range(9)] + [(9, np.zeros(6)), (10, rows[5][1]), (11, rng.normal(size=6))]
    return vectors, frame(spark, asked, "query_id"), path


def found(df):
    return [(r.query_id, r.pmid, r["rank"], str(r.distance)) for r in df.orderBy("query_id", "rank").collect()]


@pytest.mark.parametrize("k", [1, 3, 60, 239, 400])
def test_equal_to_the_full_search(spark, clustered, k):
    vectors, queries, path = clustered
    assert found(cell_bounds.search(spark, path, queries, k)) == found(knn.nearest(vectors, queries, k))


def test_small_blocks(spark, clustered, monkeypatch):
    vectors, queries, path = clustered
    monkeypatch.setattr(cell_bounds, "MAX_CHOICES", 20)
    assert found(cell_bounds.search(spark, path, queries, 4)) == found(knn.nearest(vectors, queries, 4))


def test_cells_out_of_reach_are_not_read(spark, clustered):
    _, queries, path = clustered
    near = queries.filter("query_id < 6")
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    # The neighbours of a query within a tight cell are found there; the plan has no cell left to read.
    assert f"{path}/cells" not in plan_of(cell_bounds.search(spark, path, near, 3))
    assert f"{path}/cells" in plan_of(cell_bounds.search(spark, path, near, 60))
    cells = cell_bounds.CellBounds(spark, path)
    block = next(knn.query_blocks(near, 3))
    one = ivf.probed_candidates(cells.index, block, np.array([0]), np.array([2]), 6, 3)
    assert "PartitionFilters: [isnotnull(cell" in plan_of(one) and {r.pmid % 6 for r in one.collect()} == {2}
    angles = cells.angles(block)
    first = cells.nearest_cells(angles, 3)
    assert (first.sum(axis=1) == 1).all()
    assert not (cells.may_hold(angles, np.full(6, 0.05)) & ~first).any()
    assert cells.may_hold(angles, np.full(6, np.inf)).all()


def test_wide_cells_and_a_centre_without_direction(spark, tmp_path):
    rng = np.random.default_rng(4)
    vectors, queries = frame(spark, enumerate(rng.normal(size=(200, 3))), "pmid"), frame(spark, enumerate(rng.normal(size=(8, 3))), "query_id")
    centres = np.vstack([knn.unit_rows(rng.normal(size=(9, 3))), np.zeros((1, 3))])
    cell_bounds.write_index(vectors, centres, str(tmp_path / "index"), files_per_cell=1)
    assert found(cell_bounds.search(spark, str(tmp_path / "index"), queries, 7)) == found(knn.nearest(vectors, queries, 7))


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "index")
    vectors, queries = frame(spark, [(1, [1, 0])], "pmid"), frame(spark, [(1, [1, 0])], "query_id")
    cell_bounds.write_index(vectors.limit(0), np.eye(2), path)
    assert cell_bounds.search(spark, path, queries, 3).count() == 0
    assert cell_bounds.search(spark, path, queries.limit(0), 3).count() == 0
