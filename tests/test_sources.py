"""Round trips on files that the tests write."""

import struct

import numpy as np
import pytest

from gridprep.functions.geo import GridSpec
from gridprep.sources import cellgrid, text_files
from gridprep.streaming.ingest import ingest_years


@pytest.mark.parametrize("version", [1, 2, 3])
@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("datatype", [0, 1, 2, 3, 4])
def test_cellgrid_headers(spark, tmp_path, version, order, datatype):
    if version < 3 and datatype != 1:
        pytest.skip("older headers have short values")
    cellgrid.register(spark)
    h = {"name": "LPJTEST", "version": version, "order": 1, "firstyear": 1999, "nyear": 2, "firstcell": 5, "ncell": 3, "nbands": 2, "cellsize_lon": 0.5, "cellsize_lat": 0.25, "scalar": 0.5, "datatype": datatype, "endian": order}
    values = np.arange(12) % 100
    path = tmp_path / "a.bin"
    path.write_bytes(cellgrid.make_header(h) + values.astype(order + cellgrid.TYPES[datatype]).tobytes())
    rows = spark.read.format("cellgrid").load(str(tmp_path)).orderBy("year", "cell", "band").collect()
    scale = 0.5 if version > 1 else 1.0
    assert [(r.year, r.cell, r.band, r.value) for r in rows] == [(1999 + i // 6, 5 + i % 6 // 2, i % 2, v * scale) for i, v in enumerate(values)]
    assert spark.read.format("cellgrid").option("from_year", "2000").load(str(path)).count() == 6


def test_cellgrid_write(spark, tmp_path):
    cellgrid.register(spark)
    rows = [(2000 + y, c, b, (y * 100 + c * 10 + b) * 0.1) for y in range(2) for c in range(7) for b in range(3)]
    df = spark.createDataFrame(rows[::-1], "year int, cell long, band int, value double")
    path = str(tmp_path / "out.bin")
    write = lambda mode: cellgrid.write_cellgrid(df, path, mode, 3, datatype="1", scalar="0.1")
    write("append")
    again = spark.read.format("cellgrid").load(path).orderBy("year", "cell", "band").collect()
    assert [(r.year, r.cell, r.band) for r in again] == [r[:3] for r in rows]
    assert [r.value for r in again] == pytest.approx([r[3] for r in rows], abs=1e-5)
    with pytest.raises(Exception, match="out.bin"):
        write("append")
    write("overwrite")
    assert [f.name for f in tmp_path.iterdir()] == ["out.bin"]
    whole = cellgrid.read_whole_files(spark, path)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, again))
    # every run of cells as a file of its own
    folder = str(tmp_path / "parts")
    for _ in range(2):
        cellgrid.prepare(df, 3).write.format("cellgrid").option("datatype", "1").option("scalar", "0.1").mode("overwrite").save(folder)
        assert sorted(map(tuple, spark.read.format("cellgrid").load(f"file://{folder}").collect())) == sorted(map(tuple, again))
    with pytest.raises(Exception, match="not every band"):
        cellgrid.write_cellgrid(df.filter("cell <> 3 or year <> 2001"), str(tmp_path / "gap.bin"))
    with pytest.raises(Exception, match="repeat"):
        cellgrid.write_cellgrid(df.union(df.limit(1)), str(tmp_path / "twice.bin"))
    truncated = (tmp_path / "out.bin").read_bytes()[:-1]
    (tmp_path / "bad.bin").write_bytes(truncated)
    with pytest.raises(Exception, match="bytes"):
        spark.read.format("cellgrid").load(str(tmp_path / "bad.bin")).count()


def test_header_probe():
    assert struct.unpack("<i", struct.pack("<i", 3))[0] == 3
    h = {"name": "LPJ_X", "version": 3, "order": 1, "firstyear": 0, "nyear": 0, "firstcell": 0, "ncell": 0, "nbands": 0, "cellsize_lon": 0.5, "cellsize_lat": 0.5, "scalar": 1.0, "datatype": 2}
    assert cellgrid.read_header(cellgrid.make_header(h | {"endian": ">"}))["endian"] == ">"
    with pytest.raises(ValueError):
        cellgrid.read_header(b"XYZ")


def test_csv_keeps_namibia(spark, tmp_path):
    df = spark.createDataFrame([("NA", 1.5), ("DE", None)], "code string, v double")
    text_files.write_csv(df, str(tmp_path / "c"))
    assert {(r.code, r.v) for r in text_files.read_csv(spark, str(tmp_path / "c"), "code string, v double").collect()} == {("NA", 1.5), ("DE", None)}


def test_ascii_grids(spark, tmp_path):
    (tmp_path / "x_1700AD.asc").write_text("ncols 3\nnrows 2\nxllcorner 0\nyllcorner 0\ncellsize 1\nNODATA_value -1\n1 2 -1\n4 5.5 6\n")
    (tmp_path / "x_300BC.asc").write_text("1 2 3\n4 5 -9999\n")
    spec = GridSpec(0, 2, 1, 1, 3, 2)
    rows = {(r.year, r.gcol, r.grow): r.value for r in text_files.read_ascii_grids(spark, str(tmp_path), spec).collect()}
    assert rows[1700, 2, 0] is None and rows[1700, 1, 1] == 5.5 and rows[-300, 2, 1] is None and rows[-300, 0, 0] == 1 and len(rows) == 12
    with pytest.raises(Exception, match="values, not"):
        text_files.read_ascii_grids(spark, str(tmp_path), GridSpec(0, 2, 1, 1, 4, 2)).collect()


def test_calendar(spark, tmp_path):
    (tmp_path / "cal.txt").write_text("header line\n 1 2 2  10.5 3 9  4.5 11 2\n1 3 1 7 1 12\n\n")
    crops = spark.createDataFrame([(2, "rice"), (3, "maize")], "idx int, crop string")
    assert {(r.unit, r.crop, r.area) for r in text_files.read_calendar(spark, str(tmp_path), crops).collect()} == {(1, "rice", 15.0), (1, "maize", 7.0)}


def test_footnotes(spark):
    rows = [("1", "wheat", "5", "x", "[1]"), ("2", "rice", "6", "x", "[2,3]"), ("3", "rye", "7", "x", None), ("[1] Reference area | half the country", None, None, None, None), ("[2] observation | old", None, None, None, None), ("[3] other | really maize", None, None, None, None), ("total", None, None, None, None)]
    flat = spark.createDataFrame(rows, "id string, crop string, v string, u string, marks string")
    data, notes = text_files.split_footnotes(flat, ["id", "crop", "v", "u"], "id")
    assert data.count() == 3 and notes.count() == 3
    rules = spark.createDataFrame([("other", "really maize", "keep", "maize")], "kind string, text string, action string, crop string")
    assert {(r.id, r.crop) for r in text_files.apply_footnote_rules(data, notes, rules).collect()} == {("2", "maize"), ("3", "rye")}
    assert {r.id for r in text_files.apply_footnote_rules(data, notes).collect()} == {"2", "3"}


def test_raster_table(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, None)], "cell long, v int")
    assert text_files.write_raster_table(df, str(tmp_path / "r"), "v") == "byte"
    assert {(r.cell, r.v) for r in spark.read.parquet(str(tmp_path / "r")).collect()} == {(1, 5), (2, -99)}
    assert text_files.choose_integer(df.selectExpr("v * 100 as v"), "v") == "short"
    assert text_files.choose_integer(df.filter("false"), "v") == "byte"


def test_years_are_appended_once(spark, tmp_path):
    path = str(tmp_path / "t")
    wanted = spark.createDataFrame([(2000,), (2001,)], "year int")
    assert text_files.pending_years(spark, path, wanted).count() == 2
    text_files.append_years(spark.createDataFrame([(2000, 1), (2000, 2)], "year int, v int"), path)
    text_files.append_years(spark.createDataFrame([(2000, 7)], "year int, v int"), path)
    assert [r.v for r in spark.read.parquet(path).collect()] == [7]
    assert [r.year for r in text_files.pending_years(spark, path, wanted).collect()] == [2001]


def test_ingest_twice(spark, tmp_path):
    src, dst, cp = (str(tmp_path / x) for x in ("src", "dst", "cp"))
    spark.createDataFrame([(2000, 1)], "year int, v int").write.parquet(src)
    run = lambda: ingest_years(spark, src, dst, cp, "year int, v int")
    run()
    run()
    spark.createDataFrame([(2001, 5), (2000, 9)], "year int, v int").write.mode("append").parquet(src)
    run()
    assert {(r.year, r.v) for r in spark.read.parquet(dst).collect()} == {(2000, 9), (2001, 5)}


def _two_years(tmp_path, name="a.bin", firstyear=1999):
    h = {"name": "LPJTEST", "version": 3, "order": 1, "firstyear": firstyear, "nyear": 3, "firstcell": 5, "ncell": 10, "nbands": 4, "cellsize_lon": 0.5, "cellsize_lat": 0.5, "scalar": 1.0, "datatype": 3, "endian": "<"}
    (tmp_path / name).write_bytes(cellgrid.make_header(h) + np.arange(120, dtype="<f4").tobytes())
    return [(firstyear + i // 40, 5 + i % 40 // 4, i % 4, float(i)) for i in range(120)]


@pytest.mark.parametrize("condition", ["year = 2000", "year = 2000 and band = 3", "cell between 7 and 9", "cell in (5, 14, 99) and year in (1999, 2001)", "cell > 20", "band > 3", "value < 30 and year <> 1999", "year >= 2000 and year < 2001 and band <= 1 and cell < 7", "year = 1999 or cell = 6"])
def test_pushed_filters(spark, tmp_path, condition):
    rows = _two_years(tmp_path)
    cellgrid.register(spark)
    df = spark.read.format("cellgrid").option("partition_values", "12").load(str(tmp_path))
    want = spark.createDataFrame(rows, cellgrid.SCHEMA).filter(condition)
    assert sorted(map(tuple, df.filter(condition).collect())) == sorted(map(tuple, want.collect()))


def test_only_wanted_bytes_are_read(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, StringContains

    _two_years(tmp_path)
    reader = cellgrid.CellGridReader({"path": str(tmp_path), "partition_values": "8"})
    other = StringContains(("year",), "x")
    assert list(reader.pushFilters([EqualTo(("year",), 2000), GreaterThanOrEqual(("cell",), 11), EqualTo(("band",), 1), other])) == [other]
    slices = reader.partitions()
    assert [s.runs for s in slices] == [[(2000, 6, 2)], [(2000, 8, 2)]]
    assert [b.num_rows for s in slices for b in reader.read(s)] == [2, 2]


def test_small_years_share_a_partition(tmp_path):
    _two_years(tmp_path)
    assert len(cellgrid.CellGridReader({"path": str(tmp_path)}).partitions()) == 1
    assert len(cellgrid.CellGridReader({"path": str(tmp_path), "partition_values": "40"}).partitions()) == 3


def test_stream_of_native_files(spark, tmp_path):
    cellgrid.register(spark)
    src, dst, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    src.mkdir()
    first = _two_years(src, "a.bin")
    run = lambda: ingest_years(spark, str(src), dst, log, None, kind="cellgrid")
    run()
    read = lambda: sorted((r.year, r.cell, r.band, r.value) for r in spark.read.parquet(dst).collect())
    assert read() == first
    second = _two_years(src, "b.bin", 2010)
    run()
    run()
    assert read() == sorted(first + second)
    # a file is its name and time: the offset names what changed lately, and knows the rest by its age
    stream = cellgrid.CellGridStream({"path": str(src), "grace": "3600"})
    now = stream.latestOffset()
    assert len(stream.partitions(stream.initialOffset(), now)) == 2 and stream.partitions(now, now) == []
