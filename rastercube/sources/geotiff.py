"""GeoTIFF rasters as DataFrames: files come through Spark's binary reader, so any file system will do."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from xml.sax.saxutils import escape, unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Field types of the TIFF 6.0 format: struct code of a value.
_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
#: Tags of the TIFF and GeoTIFF formats.
_WIDTH, _HEIGHT, _BITS, _COMPRESSION, _STRIPS, _SAMPLES, _ROWS, _STRIP_BYTES, _PLANAR, _PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
_TILE_W, _TILE_H, _TILES, _TILE_BYTES, _FORMAT, _SCALE, _TIE, _GEO_KEYS, _METADATA, _NODATA = 322, 323, 324, 325, 339, 33550, 33922, 34735, 42112, 42113


class RasterError(ValueError):
    pass


@dataclass(frozen=True)
class Grid:
    """What must agree among files. transform is affine: (a, b, c, d, e, f), rounded to ten places."""

    width: int
    height: int
    count: int
    crs: str | None
    transform: tuple[float, ...]
    dtype: str
    descriptions: tuple[str | None, ...]
    nodata: float | None = None


class Tiff:
    """The first image of a classic or big TIFF held in memory."""

    def __init__(self, data: bytes | memoryview):
        self.data = memoryview(data)
        order = {b"II": "<", b"MM": ">"}.get(bytes(self.data[:2]))
        if order is None:
            raise RasterError("not a TIFF")
        self.order = order
        big = struct.unpack_from(order + "H", self.data, 2)[0] == 43
        at = struct.unpack_from(order + ("Q" if big else "I"), self.data, 8 if big else 4)[0]
        n = struct.unpack_from(order + ("Q" if big else "H"), self.data, at)[0]
        at += 8 if big else 2
        self.tags: dict[int, tuple | bytes] = {}
        for i in range(n):
            place = at + i * (20 if big else 12)
            tag, kind = struct.unpack_from(order + "HH", self.data, place)
            count = struct.unpack_from(order + ("Q" if big else "I"), self.data, place + 4)[0]
            if kind not in _TYPES:
                continue
            code = _TYPES[kind]
            size = struct.calcsize("<" + code) * count
            value = place + (12 if big else 8)
            if size > (8 if big else 4):
                value = struct.unpack_from(order + ("Q" if big else "I"), self.data, value)[0]
            self.tags[tag] = bytes(self.data[value : value + size]) if kind == 2 else struct.unpack_from(order + code * count, self.data, value)

    def one(self, tag: int, default=None):
        v = self.tags.get(tag)
        return default if v is None else v[0]

    def grid(self) -> Grid:
        count = self.one(_SAMPLES, 1)
        scale, tie = self.tags.get(_SCALE, (1.0, 1.0, 0.0)), self.tags.get(_TIE, (0.0,) * 6)
        transform = (scale[0], 0.0, tie[3] - tie[0] * scale[0], 0.0, -scale[1], tie[4] + tie[1] * scale[1])
        keys = self.tags.get(_GEO_KEYS, ())
        codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
        code = codes.get(3072) or codes.get(2048)  # projected, else geographic
        names: list[str | None] = [None] * count
        for i, name in re.findall(r'<Item name="DESCRIPTION" sample="(\d+)"[^>]*>([^<]*)</Item>', self.text(_METADATA)):
            names[int(i)] = unescape(name)
        nodata = self.text(_NODATA).strip("\0 ")
        return Grid(self.one(_WIDTH), self.one(_HEIGHT), count, f"EPSG:{code}" if code else None, tuple(round(x, 10) for x in transform), self.dtype().name, tuple(names), float(nodata) if nodata else None)

    def items(self) -> dict[str, str]:
        """The file's own tags: metadata items that belong to no band."""
        return {unescape(k): unescape(v) for k, v in re.findall(r'<Item name="([^"]*)">([^<]*)</Item>', self.text(_METADATA))}

    def text(self, tag: int) -> str:
        v = self.tags.get(tag, b"")
        return v.decode("utf-8", "replace") if isinstance(v, bytes) else ""

    def dtype(self) -> np.dtype:
        kind = {1: "u", 2: "i", 3: "f"}[self.one(_FORMAT, 1)]
        return np.dtype(f"{self.order}{kind}{self.one(_BITS, 8) // 8}")

    def blocks(self, bands: list[int] | None = None) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(band, row, col, values) of the strips or tiles, one at a time; only those bands' where planes are apart."""
        w, h, n, dt = self.one(_WIDTH), self.one(_HEIGHT), self.one(_SAMPLES, 1), self.dtype()
        tiled = _TILES in self.tags
        bw, bh = (self.one(_TILE_W), self.one(_TILE_H)) if tiled else (w, min(h, self.one(_ROWS, h)))
        offsets, sizes = (self.tags[_TILES], self.tags[_TILE_BYTES]) if tiled else (self.tags[_STRIPS], self.tags[_STRIP_BYTES])
        across, down = -(-w // bw), -(-h // bh)
        apart = self.one(_PLANAR, 1) == 2 and n > 1
        wanted = range(n) if bands is None else bands
        for k, (at, size) in enumerate(zip(offsets, sizes, strict=True)):
            plane, k = divmod(k, across * down)
            if apart and plane not in wanted:
                continue
            r, c = k // across * bh, k % across * bw
            rows = bh if tiled else min(bh, h - r)
            per = 1 if apart or n == 1 else n
            raw = _inflate(self.data[at : at + size], self.one(_COMPRESSION, 1))
            v = np.frombuffer(raw, dt, rows * bw * per).reshape(rows, bw, per)
            if self.one(_PREDICTOR, 1) == 2:
                v = np.cumsum(v, axis=1, dtype=dt)
            elif self.one(_PREDICTOR, 1) != 1:
                raise RasterError("this predictor isn't supported")
            v = v[: h - r, : w - c]
            for b in [plane] if apart else wanted:
                yield b, r, c, v[:, :, 0 if per == 1 else b]


def _inflate(data: memoryview, method: int) -> bytes:
    if method == 1:
        return bytes(data)
    if method in (8, 32946):
        return zlib.decompress(data)
    if method == 5:
        return lzw(data)
    raise RasterError(f"compression {method} isn't supported")


def lzw(data: bytes | memoryview) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, highest bit first; 256 clears the table, 257 ends."""
    out, table = [], [bytes([i]) for i in range(256)] + [b"", b""]
    bits, width, have, at = 0, 9, 0, 0
    last = None
    while True:
        while have < width and at < len(data):
            bits = (bits << 8) | data[at]
            have += 8
            at += 1
        if have < width:
            break
        have -= width
        code = bits >> have
        bits &= (1 << have) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = table[:258], 9, None
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        out.append(entry)
        if last is not None:
            table.append(last + entry[:1])
        last = entry
        if len(table) >= (1 << width) - 1 and width < 12:
            width += 1
    return b"".join(out)


def write(planes: np.ndarray, transform: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0), names: list[str] | None = None, epsg: int | None = None, nodata: float | None = None, tags: dict[str, str] | None = None) -> bytes:
    """A deflated TIFF of planes (band, row, col), one strip a plane, with band names, tags and georeference."""
    n, h, w = planes.shape
    dt = planes.dtype.newbyteorder("<")
    strips = [zlib.compress(planes[b].astype(dt).tobytes()) for b in range(n)]
    fmt = {"u": 1, "i": 2, "f": 3}[planes.dtype.kind]
    own = "".join(f'<Item name="{escape(k)}">{escape(str(v))}</Item>' for k, v in (tags or {}).items())
    meta = "<GDALMetadata>" + own + "".join(f'<Item name="DESCRIPTION" sample="{i}" role="description">{escape(x)}</Item>' for i, x in enumerate(names or [])) + "</GDALMetadata>\0"
    entries = [(_WIDTH, "I", [w]), (_HEIGHT, "I", [h]), (_BITS, "H", [dt.itemsize * 8] * n), (_COMPRESSION, "H", [8]), (262, "H", [1]), (_STRIPS, "I", None), (_SAMPLES, "H", [n]), (_ROWS, "I", [h]), (_STRIP_BYTES, "I", [len(s) for s in strips]), (_PLANAR, "H", [2]), (_FORMAT, "H", [fmt] * n)]
    entries += [(_SCALE, "d", [transform[0], -transform[4], 0.0]), (_TIE, "d", [0.0, 0.0, 0.0, transform[2], transform[5], 0.0])]
    if epsg:
        entries.append((_GEO_KEYS, "H", [1, 1, 0, 2, 1024, 0, 1, 1, 3072, 0, 1, epsg]))
    if names or tags:
        entries.append((_METADATA, "s", meta.encode()))
    if nodata is not None:
        entries.append((_NODATA, "s", f"{nodata}\0".encode()))
    codes = {"H": 3, "I": 4, "d": 12, "s": 2}
    head, extra = 8 + 2 + 12 * len(entries) + 4, b""
    sizes = [len(v) if c == "s" else struct.calcsize("<" + c) * (n if v is None else len(v)) for _, c, v in entries]
    first = head + sum(x + x % 2 for x in sizes if x > 4)
    offsets = [first + sum(len(s) for s in strips[:i]) for i in range(n)]
    out = struct.pack("<2sHIH", b"II", 42, 8, len(entries))
    for (tag, c, v), size in zip(entries, sizes, strict=True):
        v = offsets if v is None else v
        raw = v if c == "s" else struct.pack("<" + c * len(v), *v)
        if size <= 4:
            place = raw.ljust(4, b"\0")
        else:
            place = struct.pack("<I", head + len(extra))
            extra += raw + b"\0" * (size % 2)
        out += struct.pack("<HHI", tag, codes[c], len(v)) + place
    return out + struct.pack("<I", 0) + extra + b"".join(strips)


def metadata(files: DataFrame) -> DataFrame:
    """path and the grid's fields of raster files (path, content), for catalog.require_one_grid."""
    kind = "path string, width int, height int, count int, crs string, transform array<double>, dtype string, descriptions array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("count", pa.int32()), ("crs", pa.string()), ("transform", pa.list_(pa.float64())), ("dtype", pa.string()), ("descriptions", pa.list_(pa.string()))])
        for b in batches:
            for path, content in zip(b.column(0), b.column(1), strict=True):
                g = Tiff(content.as_buffer()).grid()
                yield pa.RecordBatch.from_pylist([{"path": path.as_py(), "width": g.width, "height": g.height, "count": g.count, "crs": g.crs, "transform": list(g.transform), "dtype": g.dtype, "descriptions": list(g.descriptions)}], schema)

    return files.select("path", "content").mapInArrow(run, kind)


def tags(files: DataFrame) -> DataFrame:
    """path, name and value of the tags of raster files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(p.as_py(), k, v) for p, c in zip(b.column(0), b.column(1), strict=True) for k, v in Tiff(c.as_buffer()).items().items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*out, strict=True) if out else ([], [], []))], ["path", "name", "value"])

    return files.select("path", "content").mapInArrow(run, "path string, name string, value string")


def reference_grid(files: DataFrame) -> Grid:
    """The grid of the one raster that others are brought onto; none, or one without CRS, is an error."""
    rows = metadata(files).limit(2).collect()
    if len(rows) != 1:
        raise RasterError("no reference grid" if not rows else "more than one reference grid")
    g = rows[0]
    if g["crs"] is None:
        raise RasterError(f"{g['path']} has no CRS")
    return Grid(g["width"], g["height"], g["count"], g["crs"], tuple(g["transform"]), g["dtype"], tuple(g["descriptions"]))


def planes(files: DataFrame, bands: list[int] | None = None) -> DataFrame:
    """path, band, row, col, value (double; null where not finite or nodata) of every pixel, long.

    A task decodes one strip or tile at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0), b.column(1), strict=True):
                t = Tiff(content.as_buffer())
                nodata = t.grid().nodata
                for band, r, c, v in t.blocks(bands):
                    x = v.astype(np.float64).ravel()
                    bad = ~np.isfinite(x)
                    if nodata is not None:
                        bad |= x == nodata
                    rows, cols = np.divmod(np.arange(x.size, dtype=np.int32), np.int32(v.shape[1]))
                    yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * x.size, pa.string()), pa.array(np.full(x.size, band, np.int32)), pa.array(rows + np.int32(r)), pa.array(cols + np.int32(c)), pa.array(x, mask=bad)], ["path", "band", "row", "col", "value"])

    return files.select("path", "content").mapInArrow(run, "path string, band int, row int, col int, value double")


def files(spark: SparkSession, folder: str, pattern: str = "*.tif") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", "content")


def cube(catalogue: DataFrame, rasters: DataFrame, bands: list[str], wanted: list[str] | None = None) -> DataFrame:
    """month_idx, row, col and a column a band, from a catalogue (month_idx, path) and files (path, content)."""
    wanted = wanted or bands
    long = planes(rasters, [bands.index(b) for b in wanted])
    at = F.col("band")
    wide = long.groupBy("path", "row", "col").agg(*[F.max(F.when(at == bands.index(b), F.col("value"))).alias(b) for b in wanted])
    return wide.join(F.broadcast(catalogue.select("path", "month_idx")), "path").select("month_idx", "row", "col", *wanted)  # a row a month


def land_cover(rasters: DataFrame, nodata: int = 0) -> DataFrame:
    """row, col, class of a categorical raster's first band; cells of nodata have no row."""
    cells = planes(rasters, [0]).filter(F.col("value").isNotNull() & (F.col("value") != nodata))
    return cells.select("row", "col", F.col("value").cast("int").alias("class"))


def save(cells: DataFrame, path: str, height: int, width: int, bands: list[str], kind: str = "float32", transform: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0), epsg: int | None = None, nodata: float | None = None, overwrite: bool = False, tags: dict[str, str] | None = None) -> None:
    """One GeoTIFF under path from cells (row, col, bands); absent cells are nodata (0 for masks, else NaN).

    A raster of the grid's size is put together by one task, as one file of its kind holds it;
    Spark's committed writer stores it, so any file system will do. The file's last byte is a line
    feed behind the image, which TIFF readers don't look at.
    """
    empty = nodata if nodata is not None else (np.nan if np.dtype(kind).kind == "f" else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.full((len(bands), height, width), empty, kind)
        for b in batches:
            at = b.column(0).to_numpy(), b.column(1).to_numpy()
            for k in range(len(bands)):
                v = b.column(2 + k).to_numpy(zero_copy_only=False)
                x[k][at] = np.where(np.isnan(v), empty, v)
        yield pa.RecordBatch.from_arrays([pa.array([write(x, transform, bands, epsg, nodata, tags)], pa.binary())], ["data"])

    rows = cells.select(F.col("row").cast("int"), F.col("col").cast("int"), *[F.col(b).cast("double").alias(b) for b in bands])
    one = rows.coalesce(1).mapInArrow(run, "data binary").select(F.col("data").cast("string").alias("value"))
    one.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "none").text(path)
