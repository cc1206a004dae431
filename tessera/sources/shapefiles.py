"""Polygons of shapefiles as a data source of Spark: record ranges are read by tasks of their own, and boxes are filtered before shapes are decoded."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

#: Bytes of shapes that one task reads.
RANGE_BYTES = 16 << 20
BOX = ("x0", "y0", "x1", "y1")
_POLYGONS = (5, 15, 25)
_TESTS = {GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, EqualTo: lambda a, b: a == b}


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _exists(uri: str) -> bool:
    where, path = _open(uri)
    return where.get_file_info(path).type == fs.FileType.File


def _read(uri: str, at: int = 0, size: int | None = None) -> bytes:
    where, path = _open(uri)
    with where.open_input_file(path) as f:
        f.seek(at)
        return f.read(size)


def rings_of(body: bytes) -> list[list[tuple[float, float]]]:
    """The rings of a polygon's record, without the repeated first point."""
    parts, points = struct.unpack_from("<ii", body, 36)
    begins = [*struct.unpack_from(f"<{parts}i", body, 44), points]
    flat = struct.unpack_from(f"<{2 * points}d", body, 44 + 4 * parts)
    out = []
    for a, b in zip(begins, begins[1:], strict=False):
        ring = list(zip(flat[2 * a : 2 * b : 2], flat[2 * a + 1 : 2 * b : 2], strict=True))
        out.append(ring[:-1] if len(ring) > 1 and ring[0] == ring[-1] else ring)
    return out


@dataclass
class Table:
    """The layout of a .dbf file: where records begin, how long they are, and each field's place and width in one."""

    head: int
    width: int
    fields: dict[str, tuple[int, int]] = field(default_factory=dict)

    @classmethod
    def of(cls, uri: str) -> Table:
        head, width = struct.unpack_from("<HH", _read(uri, 8, 4))
        raw, out, place = _read(uri, 0, head), cls(head, width), 1
        at = 32
        while raw[at] != 0x0D:
            out.fields[raw[at : at + 11].split(b"\0")[0].decode("ascii")] = (place, raw[at + 16])
            place += raw[at + 16]
            at += 32
        return out


@dataclass
class Records(InputPartition):
    """A range of records: the number of the first, and the places and lengths of their shapes."""

    file: str = ""
    first: int = 0
    places: list[tuple[int, int]] = field(default_factory=list)
    table: Table | None = None


class ShapefileReader(DataSourceReader):
    def __init__(self, paths: list[str], schema: StructType, encoding: str, range_bytes: int):
        self.paths, self.encoding, self.range_bytes = paths, encoding, range_bytes
        self.names = schema.names
        self.tests: list[tuple[int, type, float]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of a side of the box with a number are tested on the record's head; all others are left to Spark."""
        for f in filters:
            if type(f) in _TESTS and f.attribute[0] in BOX and isinstance(f.value, (int, float)):
                self.tests.append((BOX.index(f.attribute[0]), type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[Records]:
        """Ranges of records by the index of each file; a file without an index is walked once for its places."""
        out = []
        for file in self.paths:
            base = file.removesuffix(".shp")
            if _exists(f"{base}.shx"):
                raw = _read(f"{base}.shx", 100)
                places = [(2 * a, 2 * n) for a, n in struct.iter_unpack(">ii", raw[: len(raw) // 8 * 8])]
            else:
                places = list(self._walk(file))
            table = Table.of(f"{base}.dbf")
            if missing := [n for n in self.names if n not in ("ord", "rings", *BOX) and n not in table.fields]:
                raise KeyError(f"missing fields: {', '.join(missing)}")
            first, size = 0, 0
            for i, (_, n) in enumerate(places):
                size += n
                if size >= self.range_bytes or i == len(places) - 1:
                    out.append(Records(file, first, places[first : i + 1], table))
                    first, size = i + 1, 0
        return out or [Records()]

    @staticmethod
    def _walk(file: str) -> Iterator[tuple[int, int]]:
        where, path = _open(file)
        with where.open_input_file(path) as f:
            at, end = 100, f.size()
            while at + 8 <= end:
                f.seek(at + 4)
                n = 2 * struct.unpack(">i", f.read(4))[0]
                yield at, n
                at += 8 + n

    def read(self, partition: Records) -> Iterator[tuple]:
        if not partition.places:
            return
        table, names = partition.table, self.names
        rows = _read(partition.file.removesuffix(".shp") + ".dbf", table.head + partition.first * table.width, table.width * len(partition.places))
        begin = partition.places[0][0]
        shapes = _read(partition.file, begin, partition.places[-1][0] + 8 + partition.places[-1][1] - begin)
        for i, (at, n) in enumerate(partition.places):
            body = shapes[at + 8 - begin : at + 8 - begin + n]
            kind = struct.unpack_from("<i", body)[0]
            if kind == 0:
                continue
            if kind not in _POLYGONS:
                raise ValueError(f"shape type {kind} is no polygon")
            box = struct.unpack_from("<4d", body, 4)
            if not all(_TESTS[test](box[side], value) for side, test, value in self.tests):
                continue
            known = {"ord": partition.first + i, **dict(zip(BOX, box, strict=True))}
            if "rings" in names:
                known["rings"] = [[(x, y) for x, y in ring] for ring in rings_of(body)]
            for name, (place, size) in table.fields.items():
                if name in names:
                    cell = rows[i * table.width + place : i * table.width + place + size]
                    known[name] = cell.decode(self.encoding, "replace").strip("\0 ") or None
            yield tuple(known[n] for n in names)


class ShapefileSource(DataSource):
    """format("polygons"): options files (parted by new lines), needed (attributes, parted by new lines), encoding, rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "polygons"

    def schema(self) -> str:
        needed = [n for n in self.options.get("needed", "").split("\n") if n]
        return ", ".join(["ord long", *[f"`{n}` string" for n in needed], "rings array<array<struct<x: double, y: double>>>", *[f"{c} double" for c in BOX]])

    def reader(self, schema: StructType) -> ShapefileReader:
        return ShapefileReader(self.options["files"].split("\n"), schema, self.options.get("encoding", "utf-8"), int(self.options.get("rangeBytes", RANGE_BYTES)))


def geographic(uri: str) -> bool:
    """Whether a file's places are longitudes and latitudes, by the description beside it; so they are taken to be where there is none."""
    prj = uri.removesuffix(".shp") + ".prj"
    return not _exists(prj) or not _read(prj).lstrip().upper().startswith(b"PROJ")


def polygons(spark: SparkSession, paths: Sequence[str], needed: Sequence[str], any_system: bool = False, encoding: str = "utf-8", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """ord, the needed attributes, rings (arrays of x, y) and the box x0, y0, x1, y1 of the records of shapefiles; null shapes are left out.

    ord counts the records of a file. Files in a projected system are refused unless
    any_system is set: their numbers are no longitudes and latitudes.
    """
    for path in paths:
        if not any_system and not geographic(path):
            raise ValueError(f"{path} is in a projected system; convert it to longitudes and latitudes first")
    spark.dataSource.register(ShapefileSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("polygons").option("files", "\n".join(paths)).option("needed", "\n".join(needed)).option("encoding", encoding).option("rangeBytes", str(range_bytes)).load()


def shapefile(spark: SparkSession, path: str, needed: Sequence[str]) -> DataFrame:
    """ord, the needed attributes and rings of one shapefile."""
    return polygons(spark, [path], needed).select("ord", *[f"`{c}`" for c in needed], "rings")


# -- writing ---------------------------------------------------------------------------
def polygon_record(rings: Sequence[Sequence[tuple[float, float]]]) -> bytes:
    """The content of a polygon's record; rings are closed."""
    closed = [[*r, r[0]] for r in rings]
    points = [p for r in closed for p in r]
    starts = [sum(len(r) for r in closed[:i]) for i in range(len(closed))]
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return struct.pack("<i4dii", 5, min(xs), min(ys), max(xs), max(ys), len(closed), len(points)) + struct.pack(f"<{len(starts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)


def shapefile_bytes(records: Sequence[tuple[dict[str, str], Sequence[Sequence[tuple[float, float]]]]], widths: dict[str, int]) -> dict[str, bytes]:
    """The .shp, .shx and .dbf files of (attributes, rings) records; attributes are cut to their widths."""
    body, index, at = [], [], 100
    for i, (_, rings) in enumerate(records):
        content = polygon_record(rings)
        body.append(struct.pack(">ii", i + 1, len(content) // 2) + content)
        index.append(struct.pack(">ii", at // 2, len(content) // 2))
        at += 8 + len(content)
    head = lambda size: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<ii8d", 1000, 5, *([0.0] * 8))
    table = struct.pack("<BBBBIHH20x", 3, 0, 0, 0, len(records), 33 + 32 * len(widths), 1 + sum(widths.values()))
    table += b"".join(n.encode("ascii").ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([w]) + b"\0" * 15 for n, w in widths.items()) + b"\r"
    rows = b"".join(b" " + b"".join(str(a.get(n) or "").encode()[:w].ljust(w) for n, w in widths.items()) for a, _ in records)
    return {"shp": head(at) + b"".join(body), "shx": head(100 + 8 * len(index)) + b"".join(index), "dbf": table + rows}


def write_shapefiles(df: DataFrame, path: str, widths: dict[str, int], rings: str = "rings") -> list[str]:
    """A shapefile for each partition of df, named after the task's attempt below path; the names of those that count."""
    import pyarrow as pa
    from pyspark import TaskContext

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = [({n: r[n] for n in widths}, [[(p["x"], p["y"]) for p in ring] for ring in r[rings]]) for b in batches for r in b.to_pylist()]
        if not records:
            return
        base = f"{path}/part-{TaskContext.get().taskAttemptId()}"
        where, place = _open(base)
        where.create_dir(place.rpartition("/")[0], recursive=True)
        for kind, data in shapefile_bytes(records, widths).items():
            with where.open_output_stream(f"{place}.{kind}") as f:
                f.write(data)
        yield pa.RecordBatch.from_arrays([pa.array([f"{base}.shp"])], names=["file"])

    return sorted(r["file"] for r in df.select(*[f"`{n}`" for n in widths], rings).mapInArrow(write, "file string").collect())  # one for each partition
