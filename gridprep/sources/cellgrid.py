"""A Spark data source for native cell-band-year files.

``spark.read.format("cellgrid").load(folder)`` gives year, cell, band, value; ``write_cellgrid`` writes them. Paths may be
local or those of a shared store (s3, gs, abfss, hdfs) that pyarrow opens; ``read_whole_files`` takes any path of Spark's.
``spark.readStream.format("cellgrid").load(folder)`` gives the rows of files as they arrive. Filters on year, cell and band
reach the source: other years and cells aren't read, other bands, which lie between, don't become rows.
A file is a header (a name starting with LPJ; version; order, firstyear, nyear, firstcell, ncell, nbands; from version 2
cell size and scalar; from version 3 the cell size in latitude and the data type) and values year by year, cell by cell,
band by band. Byte order shows in the version's low byte.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan,
    LessThanOrEqual, WriterCommitMessage,
)

#: Data type codes of version 3, and the values each version leaves out.
TYPES = {0: "i1", 1: "i2", 2: "i4", 3: "f4", 4: "f8"}
DEFAULTS = {"cellsize_lon": 0.5, "scalar": 1.0, "datatype": 1}
#: Values that are read at once, values that one input partition holds at most, and partitions of a file that a smaller size
#: asked for may make: a task costs as much as some ten thousand values.
SLICE, PARTITION, MANY = 1_000_000, 4_000_000, 512
#: Rows that a task sorts before it writes them, about.
SORTED = 1_000_000
SCHEMA = "year int, cell bigint, band int, value double"
#: With the option ``places``: where a value stands in its file, counted in values.
PLACED = SCHEMA + ", place bigint"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    scheme, _, rest = path.partition("://")
    if not rest:
        return pafs.LocalFileSystem(), path.removeprefix("file:")
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def read_header(data: bytes) -> dict:
    """The header's fields, its length and byte order."""
    name_end = next((k for k in range(3, min(len(data), 40)) if not (65 <= data[k] <= 90 or 97 <= data[k] <= 122 or data[k] == 95)), 3)
    if data[:3] != b"LPJ":
        raise ValueError("no LPJ header")
    name, at = data[:name_end].decode("ascii"), name_end
    order = "<" if struct.unpack_from("<i", data, at)[0] & 0xFF and struct.unpack_from("<i", data, at)[0] < 1 << 16 else ">"
    fields = ("version", "order", "firstyear", "nyear", "firstcell", "ncell", "nbands")
    h = dict(zip(fields, struct.unpack_from(f"{order}7i", data, at), strict=True)) | DEFAULTS | {"name": name, "endian": order}
    at += 28
    if h["version"] >= 2:
        h["cellsize_lon"], h["scalar"] = struct.unpack_from(f"{order}2f", data, at)
        at += 8
    h["cellsize_lat"] = h["cellsize_lon"]
    if h["version"] >= 3:
        h["cellsize_lat"], h["datatype"] = struct.unpack_from(f"{order}fi", data, at)
        at += 8
    return h | {"length": at}


def make_header(h: dict) -> bytes:
    """The bytes of a header of h['version'], in h['endian'] byte order."""
    o = h.get("endian", "<")
    out = h["name"].encode("ascii") + struct.pack(f"{o}7i", *(h[k] for k in ("version", "order", "firstyear", "nyear", "firstcell", "ncell", "nbands")))
    if h["version"] >= 2:
        out += struct.pack(f"{o}2f", h["cellsize_lon"], h["scalar"])
    if h["version"] >= 3:
        out += struct.pack(f"{o}fi", h["cellsize_lat"], h["datatype"])
    return out


class Slice(InputPartition):
    """Some cells of some years of a file: ``runs`` of (year, first cell, cells), cells from the file's first."""

    def __init__(self, path: str, header: dict, runs: list[tuple[int, int, int]]) -> None:
        super().__init__((path, runs))
        self.path, self.header, self.runs = path, header, runs


class Wanted:
    """What filters ask for of a column of whole numbers: a range, and a set of values if there is one."""

    def __init__(self) -> None:
        self.low, self.high, self.values = -(1 << 63), (1 << 63) - 1, None

    def add(self, f: Filter) -> bool:
        """Takes a filter up; false if it isn't one that it can answer for."""
        value = getattr(f, "value", None)
        if isinstance(f, IsNotNull):
            return True
        if isinstance(f, In):
            if not all(isinstance(v, int) for v in value):
                return False
            self.values = set(value) if self.values is None else self.values & set(value)
            return True
        if not isinstance(value, int):
            return False
        if isinstance(f, EqualTo):
            self.low, self.high = max(self.low, value), min(self.high, value)
        elif isinstance(f, GreaterThan):
            self.low = max(self.low, value + 1)
        elif isinstance(f, GreaterThanOrEqual):
            self.low = max(self.low, value)
        elif isinstance(f, LessThan):
            self.high = min(self.high, value - 1)
        elif isinstance(f, LessThanOrEqual):
            self.high = min(self.high, value)
        else:
            return False
        return True

    def range(self, low: int, high: int) -> tuple[int, int]:
        """Where in low ... high the wanted ones begin and end; the end lies before the beginning if there are none."""
        inside = [v for v in self.values or () if max(low, self.low) <= v <= min(high, self.high)]
        if self.values is not None:
            return (min(inside), max(inside)) if inside else (0, -1)
        return max(low, self.low), min(high, self.high)

    def has(self, x: np.ndarray) -> np.ndarray:
        found = (x >= self.low) & (x <= self.high)
        return found if self.values is None else found & np.isin(x, list(self.values))


def _values(data: bytes, h: dict, year: int, first: int, n: int, wanted: dict[str, Wanted] | None = None, places: bool = False) -> pa.RecordBatch:
    """The rows of n cells of a year, from the ``first`` of the file on; of these those that are ``wanted``."""
    kind = np.dtype(h["endian"] + TYPES[h["datatype"]])
    values = np.frombuffer(data, kind).astype(np.float64) * (h["scalar"] if kind.kind == "i" or h["scalar"] != 1 else 1.0)
    cell = np.repeat(np.arange(first, first + n, dtype=np.int64) + h["firstcell"], h["nbands"])
    band = np.tile(np.arange(h["nbands"], dtype=np.int32), n)
    place = (((year - h["firstyear"]) * h["ncell"] + first) * h["nbands"] + np.arange(len(values))).astype(np.int64) if places else None
    columns = [np.full(len(values), year, np.int32), cell, band, values] + [place] * places
    if wanted:
        keep = np.flatnonzero(wanted["cell"].has(cell) & wanted["band"].has(band))
        columns = [c[keep] for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["year", "cell", "band", "value", "place"][: len(columns)])


def _slices(h: dict, year: int, begin: int = 0, cells: int | None = None) -> Iterator[tuple[int, int, int, int]]:
    """(first cell, cells, place and number of bytes) of slices of a year, or of some of its cells."""
    item = np.dtype(TYPES[h["datatype"]]).itemsize * h["nbands"]
    step = max(1, SLICE // max(1, h["nbands"]))
    end = h["ncell"] if cells is None else begin + cells
    for first in range(begin, end, step):
        n = min(step, end - first)
        yield first, n, h["length"] + ((year - h["firstyear"]) * h["ncell"] + first) * item, n * item


def _checked(h: dict, path: str, size: int, datatype: str | None) -> dict:
    if datatype is not None and h["version"] < 3:
        h["datatype"] = int(datatype)
    want = h["length"] + np.dtype(TYPES[h["datatype"]]).itemsize * h["nyear"] * h["ncell"] * h["nbands"]
    if size != want:
        raise ValueError(f"{path} has {size} bytes, not {want}")
    return h


class CellGridReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        # a file without a type in its header may have one given
        self.datatype = options.get("datatype")
        self.places = options.get("places") == "true"
        self.most = int(options.get("partition_values", PARTITION))
        self.wanted = {c: Wanted() for c in ("year", "cell", "band")}
        for option, kind in (("from_year", GreaterThanOrEqual), ("to_year", LessThanOrEqual)):
            if option in options:
                self.wanted["year"].add(kind(("year",), int(options[option])))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            column = getattr(f, "attribute", ("",))
            if len(column) != 1 or column[0] not in self.wanted or not self.wanted[column[0]].add(f):
                yield f

    def files(self) -> list[pafs.FileInfo]:
        store, root = _store(self.path)
        info = store.get_file_info(root)
        if info.type == pafs.FileType.File:
            return [info]
        return sorted((f for f in store.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.type == pafs.FileType.File and not f.base_name.startswith((".", "_"))), key=lambda f: f.path)

    def slices(self, file: pafs.FileInfo) -> list[InputPartition]:
        """The wanted cells and years of a file in partitions of bounded size; small years share one."""
        with _store(self.path)[0].open_input_file(file.path) as f:
            h = _checked(read_header(f.read(100)), file.path, file.size, self.datatype)
        first, last = self.wanted["cell"].range(h["firstcell"], h["firstcell"] + h["ncell"] - 1)
        years = np.arange(h["firstyear"], h["firstyear"] + h["nyear"])
        band, band_end = self.wanted["band"].range(0, h["nbands"] - 1)
        if last < first or band_end < band:
            return []
        out: list[InputPartition] = []
        runs, held = [], 0
        own = years[self.wanted["year"].has(years)].tolist()
        # partitions smaller than PARTITION grow with the file, so that their number doesn't
        share = -(-len(own) * (last - first + 1) * h["nbands"] // MANY)
        step = max(1, max(self.most, min(share, PARTITION)) // max(1, h["nbands"]))
        for year in own:
            for begin in range(first - h["firstcell"], last - h["firstcell"] + 1, step):
                n = min(step, last - h["firstcell"] + 1 - begin)
                if runs and held + n > step:
                    out.append(Slice(file.path, h, runs))
                    runs, held = [], 0
                runs.append((year, begin, n))
                held += n
        return [*out, Slice(file.path, h, runs)] if runs else out

    def partitions(self) -> list[InputPartition]:
        files = self.files()
        if not files:
            raise FileNotFoundError(self.path)
        # no partition at all would be a scan of unknown kind: one without runs gives no rows
        return [s for file in files for s in self.slices(file)] or [Slice(files[0].path, {}, [])]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if not partition.runs:
            return
        with _store(self.path)[0].open_input_file(partition.path) as f:
            for year, begin, cells in partition.runs:
                for first, n, at, size in _slices(partition.header, year, begin, cells):
                    yield _values(f.read_at(size, at), partition.header, year, first, n, self.wanted, self.places)


class CellGridStream(DataSourceStreamReader):
    """Files as they arrive. A file is its name and time of change: one that is delivered again is read again.

    The offset names the files that changed within ``grace`` seconds (option; an hour) of the newest one, and that time:
    so its size is bounded by what arrives in that time. A file that arrives with an older time is taken for seen.
    """

    def __init__(self, options: dict) -> None:
        self.reader = CellGridReader(options)
        self.grace = int(float(options.get("grace", 3600)) * 1e9)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"newest": 0, "seen": []}

    def latestOffset(self) -> dict:  # noqa: N802
        files = [(f.base_name, f.mtime_ns) for f in self.reader.files()]
        newest = max((t for _, t in files), default=0)
        return {"newest": newest, "seen": sorted(f"{name}@{t}" for name, t in files if t >= newest - self.grace)}

    def _in(self, offset: dict):
        seen, old = set(offset["seen"]), offset["newest"] - self.grace
        return lambda f: f.mtime_ns < old or f"{f.base_name}@{f.mtime_ns}" in seen

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before, now = self._in(start), self._in(end)
        return [s for f in self.reader.files() if now(f) and not before(f) for s in self.reader.slices(f)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return self.reader.read(partition)


def read_whole_files(spark, path: str, datatype: str | None = None):
    """The same rows by Spark's own file reader, from any path that it can open; files of up to 2 GB."""
    from pyspark.sql import functions as F

    def parse(batches):
        for batch in batches:
            for name, data in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                view = memoryview(data.as_buffer())
                h = _checked(read_header(bytes(view[:100])), name, len(view), datatype)
                for year in range(h["firstyear"], h["firstyear"] + h["nyear"]):
                    for first, n, at, size in _slices(h, year):
                        yield _values(view[at : at + size], h, year, first, n)

    return spark.read.format("binaryFile").load(path).select(F.col("path"), F.col("content")).mapInArrow(parse, SCHEMA)


class Part(WriterCommitMessage):
    def __init__(self, rows: int, files: list[str]) -> None:
        self.rows, self.files = rows, files


class CellGridWriter(DataSourceArrowWriter):
    """With the extent given (write_cellgrid does so) every task writes its values at their place in one file of known
    size, and the commit only renames it. Without, or with ``files`` set, every run of cells of a year that a task holds is
    a file of its own in a folder, with its own header: the way for stores without writing at a place.

    Rows must be sorted by year, cell and band within the tasks, and no year and cell split between tasks (see prepare).
    """

    EXTENT = ("firstyear", "nyear", "firstcell", "ncell", "nbands")

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.run = options["path"], uuid.uuid4().hex
        self.one = all(k in options for k in self.EXTENT) and options.get("files") != "true"
        store, root = _store(self.path)
        if self.one and not isinstance(store, pafs.LocalFileSystem):
            raise ValueError(f"{self.path}: a store without writing at a place; set the option files")
        if store.get_file_info(root).type != pafs.FileType.NotFound:
            if not overwrite:
                raise FileExistsError(root)
        self.header = {"name": options.get("header_name", "LPJGRID"), "version": int(options.get("header_version", 3)), "order": int(options.get("order", 1)), "cellsize_lon": float(options.get("cellsize_lon", 0.5)), "scalar": float(options.get("scalar", 1)), "datatype": int(options.get("datatype", 3)), "endian": options.get("endian", "<")}
        self.header["cellsize_lat"] = float(options.get("cellsize_lat", self.header["cellsize_lon"]))
        self.header |= {k: int(options[k]) for k in self.EXTENT if k in options}
        self.kind = np.dtype(self.header["endian"] + TYPES[self.header["datatype"] if self.header["version"] >= 3 else DEFAULTS["datatype"]])
        self.root = root
        if self.one:
            head = make_header(self.header)
            size = self.header["nyear"] * self.header["ncell"] * self.header["nbands"] * self.kind.itemsize
            with open(f"{root}.{self.run}", "wb") as f:
                f.write(head)
                f.truncate(len(head) + size)

    def _bytes(self, x: np.ndarray) -> bytes:
        if self.kind.kind == "i":
            x = np.rint(x / self.header["scalar"])
        elif self.header["scalar"] != 1:
            x = x / self.header["scalar"]
        return x.astype(self.kind).tobytes()

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        if self.one:
            return self._placed(batches)
        rows, files, held = 0, [], []
        for batch in batches:
            columns = [batch[c].to_numpy(zero_copy_only=False) for c in ("year", "cell", "band", "value")]
            rows += batch.num_rows
            held.append(columns)
            if sum(len(c[0]) for c in held) >= SLICE:
                held = self._own_files(held, files, False)
        self._own_files(held, files, True)
        return Part(rows, files)

    def _placed(self, batches: Iterator[pa.RecordBatch]) -> Part:
        h, head, rows, last = self.header, len(make_header(self.header)), 0, -1
        with open(f"{self.root}.{self.run}", "r+b") as f:
            for batch in batches:
                year, cell, band = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("year", "cell", "band"))
                if not len(year):
                    continue
                at = ((year - h["firstyear"]) * h["ncell"] + cell - h["firstcell"]) * h["nbands"] + band
                step = np.diff(at, prepend=last)
                if (step <= 0).any() or (band < 0).any() or (band >= h["nbands"]).any():
                    raise ValueError("rows that repeat, or aren't in the order of year, cell and band")
                raw, rows, last = self._bytes(batch["value"].to_numpy(zero_copy_only=False)), rows + len(at), int(at[-1])
                runs = np.append(np.flatnonzero(np.concatenate(([True], step[1:] != 1))), len(at))
                for a, b in zip(runs, runs[1:], strict=False):
                    f.seek(head + int(at[a]) * self.kind.itemsize)
                    f.write(raw[a * self.kind.itemsize : b * self.kind.itemsize])
        return Part(rows, [])

    def _own_files(self, held: list, files: list[str], every: bool) -> list:
        """Writes the runs of whole cells and returns what may still go on."""
        if not held:
            return []
        year, cell, band, value = (np.concatenate(c) for c in zip(*held, strict=True))
        end = len(year) if every else int(np.flatnonzero((cell != cell[-1]) | (year != year[-1]))[-1]) + 1 if (cell != cell[-1]).any() or (year != year[-1]).any() else 0
        new_cell = np.concatenate(([True], (cell[1:] != cell[:-1]) | (year[1:] != year[:-1])))[:end]
        starts = np.flatnonzero(new_cell)
        # a run ends where the year changes or a cell is left out
        gap = np.concatenate(([True], (year[starts][1:] != year[starts][:-1]) | (cell[starts][1:] != cell[starts][:-1] + 1)))
        runs = np.append(starts[gap], end)
        store, root = _store(self.path)
        store.create_dir(root)
        for a, b in zip(runs, runs[1:], strict=False):
            bands = int(band[a:b].max()) + 1
            n = int(cell[b - 1] - cell[a]) + 1
            if b - a != n * bands or (band[a:b] != np.tile(np.arange(bands), n)[: b - a]).any():
                raise ValueError("the rows aren't every band of every cell")
            name = f"{root}/{self.run}-{uuid.uuid4().hex}.bin"
            with store.open_output_stream(name) as f:
                f.write(make_header(self.header | {"firstyear": int(year[a]), "nyear": 1, "firstcell": int(cell[a]), "ncell": n, "nbands": bands}))
                f.write(self._bytes(value[a:b]))
            files.append(name)
        return [[c[end:] for c in (year, cell, band, value)]] if end < len(year) else []

    def commit(self, messages: list) -> None:
        store, root = _store(self.path)
        if self.one:
            rows = sum(m.rows for m in messages if m)
            want = self.header["nyear"] * self.header["ncell"] * self.header["nbands"]
            if rows != want:
                self.abort(messages)
                raise ValueError(f"{rows} rows, not {want}: not every band of every cell of every year")
            store.move(f"{root}.{self.run}", root)
            return
        # files of an earlier run give way
        keep = {f for m in messages if m for f in m.files}
        for f in store.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if f.path not in keep and f.type == pafs.FileType.File:
                store.delete_file(f.path)

    def abort(self, messages: list) -> None:
        store, root = _store(self.path)
        for f in [f"{root}.{self.run}"] if self.one else [f for m in messages if m for f in m.files]:
            if store.get_file_info(f).type == pafs.FileType.File:
                store.delete_file(f)


class CellGridSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cellgrid"

    def schema(self) -> str:
        return PLACED if self.options.get("places") == "true" else SCHEMA

    def reader(self, schema) -> CellGridReader:
        return CellGridReader(dict(self.options))

    def streamReader(self, schema) -> CellGridStream:  # noqa: N802
        return CellGridStream(dict(self.options))

    def writer(self, schema, overwrite: bool) -> CellGridWriter:
        return CellGridWriter(dict(self.options), overwrite)


def prepare(df, partitions: int | None = None):
    """Rows dealt by ranges of year and cell and sorted, as the writer wants them."""
    own = df.selectExpr("cast(year as int) year", "cast(cell as bigint) cell", "cast(band as int) band", "cast(value as double) value")
    dealt = own.repartitionByRange(partitions, "year", "cell") if partitions else own.repartitionByRange("year", "cell")
    return dealt.sortWithinPartitions("year", "cell", "band")


def write_cellgrid(df, path: str, mode: str = "append", partitions: int | None = None, **options: str) -> None:
    """Writes every band of every cell of every year as one file; its extent and the number of its tasks
    (unless given) come from one aggregate over the rows."""
    from pyspark.sql import functions as F

    register(df.sparkSession)
    x = df.agg(F.min(F.col("year").cast("int")).alias("y0"), F.max(F.col("year").cast("int")).alias("y1"), F.min(F.col("cell").cast("long")).alias("c0"), F.max(F.col("cell").cast("long")).alias("c1"), F.max(F.col("band").cast("int")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    if x["y0"] is None:
        raise ValueError("no rows to write")
    extent = {"firstyear": x["y0"], "nyear": x["y1"] - x["y0"] + 1, "firstcell": x["c0"], "ncell": x["c1"] - x["c0"] + 1, "nbands": x["b"] + 1}
    own = prepare(df, partitions or -(-x["n"] // SORTED))
    own.write.format("cellgrid").options(**(options | {k: str(v) for k, v in extent.items()})).mode(mode).save(path)


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CellGridSource)
