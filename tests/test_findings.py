"""Queries against their SQL on tables that the given sizes don't show: larger lattices, other sums."""

import re

import duckdb
import pytest

from gridprep.operators import cells, graph
from gridprep.plans import ORACLE, QUERIES
from gridprep.sources import cellgrid


def same_as_sql(spark, folder, name):
    c = duckdb.connect()
    for f in folder.glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df, cursor = QUERIES[name](spark, str(folder)), c.execute(ORACLE[name])
    cols = [x[0] for x in cursor.description]
    got, want = sorted(map(tuple, df.select(*cols).collect()), key=repr), sorted(cursor.fetchall(), key=repr)
    assert got == want
    return got


@pytest.mark.parametrize("total", [15300431, 6 * 15300431, 1000003, 7])
def test_sums_at_the_limit(spark, tmp_path, total):
    """A loss of just a millionth is kept or not as doubles round, which depends on the sum."""
    duckdb.sql(f"COPY (SELECT CAST(i AS BIGINT) AS l_orderkey, CAST(CASE i WHEN 0 THEN {total} - 3 ELSE 1 END AS DOUBLE) AS l_quantity FROM range(4) t(i)) TO '{tmp_path}/lineitem.parquet'")
    assert len(same_as_sql(spark, tmp_path, "a22_sum_check")) == 3


def customers(folder, n):
    """A lattice of n cells, 50 in a row."""
    duckdb.sql(f"COPY (SELECT CAST(i AS BIGINT) AS c_custkey, CAST(i % 25 AS INT) AS c_nationkey, 'X' AS c_mktsegment, CAST((i * 37) % 999 AS DOUBLE) AS c_acctbal FROM range({n}) t(i)) TO '{folder}/customer.parquet'")


@pytest.mark.parametrize("n", [0, 1, 50, 15_001, 20_000])
def test_cells_of_a_lattice_of_any_height(spark, tmp_path, n):
    """Cells beyond row 299 have a row, too."""
    customers(tmp_path, n)
    assert len(same_as_sql(spark, tmp_path, "p02_to_cell")) == n


@pytest.mark.parametrize("n", [1, 50, 20_000, 80_000])
def test_scalar_of_a_lattice_of_any_height(spark, tmp_path, n):
    customers(tmp_path, n)
    assert same_as_sql(spark, tmp_path, "p08_pick_scalar") == [(100, True)]


def test_scalar_of_several_coordinates(spark):
    """Both coordinates count: for being whole, and for their size."""
    pick = lambda *rows: tuple(cells.pick_scalar(spark.createDataFrame(rows, "lon double, lat double"), ["lon", "lat"]).first())
    assert pick((179.75, 0.5), (-3.0, 74.75)) == (100, True)
    assert pick((179.75, 0.125)) == (100, False)
    assert pick((1.5, 825.25)) == (10, False)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_in_tasks_of_bounded_work(spark, tmp_path, monkeypatch):
    """No side of the radius join nor the labels are broadcast; its tasks are as many as the comparisons need."""
    customers(tmp_path, 400)
    monkeypatch.setattr(graph, "COMPARED", 500)
    df = QUERIES["r05_best_neighbour"](spark, str(tmp_path))
    assert "BroadcastHashJoin" not in plan(df) and max(map(int, re.findall(r"(\d+)\), REPARTITION_BY_NUM", plan(df)))) > 20
    assert {r["cell"] for r in df.collect()} == set(range(400))
    assert "BroadcastHashJoin" not in plan(QUERIES["j09_exclude_related"](spark, str(tmp_path)))


@pytest.mark.parametrize("dense", [7, 10**9])
def test_crowds_on_either_side(spark, dense):
    """A crowd on the left that meets few on the right is cut, too."""
    many = spark.range(200).selectExpr("id cell", "10 + id * 1e-5 lon", "50e0 lat", "id * 2 mine")
    few = spark.createDataFrame([(1, 10.0, 50.0, "a"), (2, 80.0, 50.0, "b")], "other long, lon double, lat double, name string")
    got = graph.radius_join(many, few, 1000.0, dense=dense, left_more=["mine"], right_more=["name"])
    assert got.columns == ["cell", "other", "distance", "mine", "name"]
    assert sorted((r.cell, r.other, r.mine, r.name) for r in got.collect()) == [(i, 1, 2 * i, "a") for i in range(200)]


def test_places_without_broadcasts(spark, tmp_path, monkeypatch):
    customers(tmp_path, 120)
    monkeypatch.setattr(cellgrid, "SORTED", 50)
    df = QUERIES["o03_file_order"](spark, str(tmp_path))
    assert "Broadcast" not in plan(df) and plan(df).count(", 15), REPARTITION_BY_NUM") == 2
    same_as_sql(spark, tmp_path, "o03_file_order")


def test_small_partitions_stay_few(tmp_path, monkeypatch):
    """However large a file is, a small size of partitions makes no more than MANY of them."""
    h = {"name": "LPJTEST", "version": 3, "order": 1, "firstyear": 1990, "nyear": 2, "firstcell": 0, "ncell": 3000, "nbands": 3, "cellsize_lon": 0.5, "cellsize_lat": 0.5, "scalar": 1.0, "datatype": 1, "endian": "<"}
    (tmp_path / "a.bin").write_bytes(cellgrid.make_header(h) + bytes(2 * 3000 * 3 * 2))
    reader = cellgrid.CellGridReader({"path": str(tmp_path), "partition_values": "9"})
    slices = reader.partitions()
    assert 400 < len(slices) <= cellgrid.MANY + 2
    assert [(y, c + k) for s in slices for y, c, n in s.runs for k in range(n)] == [(y, c) for y in (1990, 1991) for c in range(3000)]
    monkeypatch.setattr(cellgrid, "PARTITION", 12)
    assert len(cellgrid.CellGridReader({"path": str(tmp_path), "partition_values": "9"}).partitions()) == 1500
