"""A Spark data source over tiled TIFF files that reads only the bytes of the blocks which a query asks for, and a writer of such files."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from emberline.schema import BLOCK_SIZE

SCHEMA = "path string, epsg int, min_x double, max_y double, res_x double, res_y double, width int, height int, br int, bc int, x0 int, y0 int, x1 int, y1 int, pixels array<int>, bytes_read long"
#: Bytes read at once at the start of a file; its directory mostly lies there.
HEAD = 1 << 14
# Fixed values of the format: tags, sizes of field types, compressions, the key of a projected system's EPSG code.
_WIDTH, _HEIGHT, _BITS, _COMPRESSION, _SAMPLES, _PREDICTOR, _TILE_WIDTH, _TILE_HEIGHT, _OFFSETS, _COUNTS, _FORMAT = 256, 257, 258, 259, 277, 317, 322, 323, 324, 325, 339
_SCALE, _TIEPOINT, _GEO_KEYS = 33550, 33922, 34735
_TYPES = {1: "B", 2: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 12: "d", 16: "Q"}
_PLAIN, _DEFLATE, _OLD_DEFLATE = 1, 8, 32946
_PROJECTED = 3072


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if ":/" in path else f"file://{path}")


class TiledRaster:
    """One band in tiles, uncompressed or deflated, of 8 or 16 bits. ``bytes_read`` counts what was read of the file."""

    def __init__(self, path: str):
        store, name = _store(path)
        self.file = store.open_input_file(name)
        self.size, self.bytes_read = self.file.size(), 0
        self.head = self._read(0, min(HEAD, self.size))
        self.order = {b"II": "<", b"MM": ">"}.get(self.head[:2])
        if self.order is None or self._unpack("H", self.head[2:4])[0] != 42:
            raise ValueError(f"{path}: not a TIFF file")
        self.tags = self._directory(self._unpack("I", self.head[4:8])[0])
        one = lambda tag, default=None: self.tags.get(tag, (default,))[0]
        self.width, self.height = one(_WIDTH), one(_HEIGHT)
        self.tile = (one(_TILE_WIDTH), one(_TILE_HEIGHT))
        self.bits, self.compression, self.predictor = one(_BITS, 1), one(_COMPRESSION, _PLAIN), one(_PREDICTOR, 1)
        if self.tile[0] is None or one(_SAMPLES, 1) != 1 or one(_FORMAT, 1) != 1 or self.bits not in (8, 16) or self.compression not in (_PLAIN, _DEFLATE, _OLD_DEFLATE) or self.predictor not in (1, 2):
            raise ValueError(f"{path}: only single bands of 8 or 16 bits in plain or deflated tiles are read")
        scale, tie = self.tags.get(_SCALE, (1.0, 1.0)), self.tags.get(_TIEPOINT, (0.0,) * 6)
        self.res_x, self.res_y = scale[0], scale[1]
        self.min_x, self.max_y = tie[3] - tie[0] * self.res_x, tie[4] + tie[1] * self.res_y
        keys = self.tags.get(_GEO_KEYS, ())
        self.epsg = next((keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i] == _PROJECTED), 0)

    def _unpack(self, kind: str, raw: bytes) -> tuple:
        return struct.unpack(self.order + kind * (len(raw) // struct.calcsize("=" + kind)), raw)

    def _read(self, at: int, n: int) -> bytes:
        self.bytes_read += n
        return self.file.read_at(n, at)

    def _range(self, at: int, n: int) -> bytes:
        return self.head[at : at + n] if at + n <= len(self.head) else self._read(at, n)

    def _directory(self, at: int) -> dict[int, tuple]:
        count = self._unpack("H", self._range(at, 2))[0]
        raw, tags = self._range(at + 2, 12 * count), {}
        for i in range(count):
            entry = raw[12 * i : 12 * i + 12]
            tag, kind = self._unpack("H", entry[:4])
            n = self._unpack("I", entry[4:8])[0]
            if kind not in _TYPES:
                continue
            size = n * struct.calcsize("=" + _TYPES[kind])
            tags[tag] = self._unpack(_TYPES[kind], entry[8 : 8 + size] if size <= 4 else self._range(self._unpack("I", entry[8:12])[0], size))
        return tags

    def window(self, x0: int, y0: int, x1: int, y1: int) -> np.ndarray:
        """Pixels from (x0, y0) up to (x1, y1), which lie in the image; only the tiles that the window touches are read."""
        tw, th = self.tile
        across = -(-self.width // tw)
        out = np.zeros((y1 - y0, x1 - x0), np.int32)
        kind = np.dtype(f"{self.order}u{self.bits // 8}")
        for ty in range(y0 // th, -(-y1 // th)):
            for tx in range(x0 // tw, -(-x1 // tw)):
                n = ty * across + tx
                at, size = self.tags[_OFFSETS][n], self.tags[_COUNTS][n]
                if not size:
                    continue  # a tile without bytes is empty
                raw = self._read(at, size)
                raw = raw if self.compression == _PLAIN else zlib.decompress(raw)
                tile = np.frombuffer(raw, kind, tw * th).reshape(th, tw)
                if self.predictor == 2:
                    tile = np.cumsum(tile, axis=1, dtype=np.uint64) % (1 << self.bits)
                a, b, c, d = max(x0, tx * tw), max(y0, ty * th), min(x1, tx * tw + tw), min(y1, ty * th + th)
                out[b - y0 : d - y0, a - x0 : c - x0] = tile[b - ty * th : d - ty * th, a - tx * tw : c - tx * tw]
        return out


def encoded(pixels: np.ndarray, tile: int = 256, deflate: bool = True, epsg: int = 0, min_x: float = 0.0, max_y: float = 0.0, res: float = 1.0) -> bytes:
    """A band of 16 bits as a tiled TIFF file; ``tile`` is a multiple of 16."""
    height, width = pixels.shape
    down, across = -(-height // tile), -(-width // tile)
    whole = np.zeros((down * tile, across * tile), "<u2")
    whole[:height, :width] = pixels
    tiles = [whole[y * tile : (y + 1) * tile, x * tile : (x + 1) * tile].tobytes() for y in range(down) for x in range(across)]
    tiles = [zlib.compress(t) for t in tiles] if deflate else tiles
    n = len(tiles)
    fields = {
        _WIDTH: ("I", (width,)), _HEIGHT: ("I", (height,)), _BITS: ("H", (16,)), _COMPRESSION: ("H", (_DEFLATE if deflate else _PLAIN,)), 262: ("H", (1,)), _SAMPLES: ("H", (1,)),
        _TILE_WIDTH: ("I", (tile,)), _TILE_HEIGHT: ("I", (tile,)), _OFFSETS: ("I", (0,) * n), _COUNTS: ("I", tuple(map(len, tiles))), _FORMAT: ("H", (1,)),
        _SCALE: ("d", (res, res, 0.0)), _TIEPOINT: ("d", (0.0, 0.0, 0.0, min_x, max_y, 0.0)), _GEO_KEYS: ("H", (1, 1, 0, 1, _PROJECTED, 0, 1, epsg)),
    }
    end = 8 + 2 + 12 * len(fields) + 4
    size = lambda kind, values: struct.calcsize("=" + kind) * len(values)
    data_at = end + sum(size(*f) for f in fields.values() if size(*f) > 4)
    starts = data_at + np.cumsum([0, *map(len, tiles[:-1])])
    fields[_OFFSETS] = ("I", tuple(int(s) for s in starts))
    number = {kind: code for code, kind in _TYPES.items() if code != 2}
    entries, more = b"", b""
    for tag in sorted(fields):
        kind, values = fields[tag]
        raw = struct.pack("<" + kind * len(values), *values)
        if len(raw) > 4:
            entries += struct.pack("<HHII", tag, number[kind], len(values), end + len(more))
            more += raw
        else:
            entries += struct.pack("<HHI", tag, number[kind], len(values)) + raw.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(fields)) + entries + b"\0\0\0\0" + more + b"".join(tiles)


@dataclass
class BlockRow(InputPartition):
    """A row of blocks of one file; it is read by one task, a block at a time."""

    path: str
    br: int


class TiledRasters(DataSource):
    """``spark.read.format("tiled_raster").load(file or folder)``: the blocks of each .tif file, row by row.

    Options: block (pixels a side), overlap (pixels that blocks reach into their neighbours). Conditions on br, bc, x0, y0,
    x1 and y1 are pushed down, so blocks that don't meet them aren't read. bytes_read is what a task had read of the file
    up to and with the block: directory and the tiles that the task's blocks touch, no more.
    """

    @classmethod
    def name(cls) -> str:
        return "tiled_raster"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.block, self.overlap = options["path"], int(options.get("block", BLOCK_SIZE)), int(options.get("overlap", 0))
        self.limits: list[tuple[str, str, int]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        kinds = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in kinds and f.attribute[0] in ("br", "bc", "x0", "y0", "x1", "y1") and isinstance(f.value, int):
                self.limits.append((f.attribute[0], kinds[type(f)], f.value))
            else:
                yield f

    def _meets(self, **known: int) -> bool:
        test = {"=": lambda a, b: a == b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}
        return all(test[kind](known[name], value) for name, kind, value in self.limits if name in known)

    def _span(self, n: int, size: int) -> tuple[int, int]:
        return max(0, n * self.block - self.overlap), min(size, (n + 1) * self.block + self.overlap)

    def partitions(self) -> list[BlockRow]:
        store, name = _store(self.path)
        root = self.path.rstrip("/")
        if store.get_file_info(name).type == fs.FileType.Directory:
            found = store.get_file_info(fs.FileSelector(name, recursive=True))
            paths = [root + f.path[len(name.rstrip("/")) :] for f in found if f.path.lower().endswith((".tif", ".tiff"))]
        else:
            paths = [root]
        out = []
        for path in sorted(paths):
            height = TiledRaster(path).height
            for br in range(-(-height // self.block)):
                y0, y1 = self._span(br, height)
                if self._meets(br=br, y0=y0, y1=y1):
                    out.append(BlockRow(path, br))
        return out or [BlockRow("", -1)]

    def read(self, partition: BlockRow) -> Iterator[tuple]:
        if partition.br < 0:
            return
        r = TiledRaster(partition.path)
        y0, y1 = self._span(partition.br, r.height)
        for bc in range(-(-r.width // self.block)):
            x0, x1 = self._span(bc, r.width)
            if self._meets(bc=bc, x0=x0, x1=x1):
                pixels = r.window(x0, y0, x1, y1).ravel()
                values = (partition.path, r.epsg, r.min_x, r.max_y, r.res_x, r.res_y, r.width, r.height, partition.br, bc, x0, y0, x1, y1)
                kinds = [pa.string(), pa.int32(), *[pa.float64()] * 4, *[pa.int32()] * 8]
                listed = pa.ListArray.from_arrays(pa.array([0, len(pixels)], pa.int32()), pa.array(pixels))
                names = [c.split()[0] for c in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([*(pa.array([v], k) for v, k in zip(values, kinds)), listed, pa.array([r.bytes_read], pa.int64())], names=names)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, with its filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TiledRasters)
