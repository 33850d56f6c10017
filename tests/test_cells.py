"""The cell index finds what a scan of all vectors finds, and opens fewer files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftwork.operators import cells as C
from weftwork.operators import embeddings as E


def vectors(spark, spread, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + spread * draw.normal(size=16)).tolist()) for i in range(600)]
    rows += [(900 + i, rows[5][1]) for i in range(30)] + [(1000, None), (1001, []), (1002, [0.0] * 16)]
    return rows, spark.createDataFrame(rows, "token long, vec array<double>")


@pytest.mark.parametrize("spread,cells", [(0.15, 40), (3.0, 20), (0.15, 1)])
def test_search_is_exact(spark, tmp_path, spread, cells):
    rows, model = vectors(spark, spread)
    index = C.build_cells(model, str(tmp_path / "cells"), cells)
    assert index.sizes.sum() == 630
    queries = {"a": rows[5][1], "b": rows[100][1], "c": [float(-x) for x in rows[7][1]], "d": [1.0] + [0.0] * 15}
    for n, exclude in ((1, None), (10, {"a": [5, 900], "b": [100]}), (1000, None)):
        got = [tuple(r)[:2] + (round(r["similarity"], 9), r["rank"]) for r in index.search(queries, n, exclude).orderBy("query", "rank").collect()]
        want = [tuple(r)[:2] + (round(r["similarity"], 9), r["rank"]) for r in E.nearest(model, queries, n, exclude).orderBy("query", "rank").collect()]
        assert got == want


def test_far_cells_are_not_opened(spark, tmp_path, monkeypatch):
    rows, model = vectors(spark, 0.1)
    index = C.build_cells(model.coalesce(1), str(tmp_path / "cells"), 60)
    read, files = C.CellIndex.read, []

    def counted(self, cells):
        found = read(self, cells)
        files.append({r[0] for r in found.select(F.input_file_name()).distinct().collect()})
        return found

    monkeypatch.setattr(C.CellIndex, "read", counted)
    found = index.search({"q": rows[3][1]}, 5)
    assert [r["token"] for r in found.orderBy("rank").collect()][0] == 3
    assert len(index.cells) > 40 and 0 < len(files[-1]) < len(index.cells) / 2  # one file a cell


def test_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([(1, None), (2, [0.0])], "token long, vec array<double>")
    assert C.build_cells(empty, str(tmp_path / "cells"), 4).search({"q": [1.0]}, 3).collect() == []
    for wrong in (0, C.MOST_CELLS + 1):
        with pytest.raises(ValueError):
            C.build_cells(empty, str(tmp_path / "other"), wrong)
