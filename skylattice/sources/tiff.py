"""Baseline TIFF with the tags that place a raster on the ground.

Reads strips (not tiles), uncompressed or deflate, both byte orders, samples
interleaved or in planes, of the closed list of sample types.  Writes
little-endian deflate strips, interleaved.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field
from xml.sax.saxutils import escape, unescape

import numpy as np

#: Field sizes by TIFF type, and the tags used here; fixed values of the format.
FIELD = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q")}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 339
SCALE, TIE, CRS_TEXT, METADATA, NODATA_TEXT = 33550, 33922, 34737, 42112, 42113
#: (sample format, bits) of the sample types.
SAMPLE = {"uint8": (1, 8), "uint16": (1, 16), "uint32": (1, 32), "int16": (2, 16), "int32": (2, 32), "float32": (3, 32), "float64": (3, 64)}
STRIP_BYTES = 1 << 20


@dataclass
class Raster:
    """Metadata of a raster. rows is its height and columns its width."""

    columns: int
    rows: int
    bands: int
    dtype: str
    geo: tuple[float, float, float, float, float, float] = (0.0, 1.0, 0.0, 0.0, 0.0, -1.0)
    crs: str = ""
    descriptions: list[str] = field(default_factory=list)
    nodata: float | None = None
    order: str = "<"
    compression: int = 8
    planar: int = 1
    strip_rows: int = 1
    offsets: list[int] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)


def reader(data: bytes | Callable[[int, int], bytes]) -> Callable[[int, int], bytes]:
    """read(place, length) over bytes, or a function that reads so from a file."""
    return data if callable(data) else lambda at, n: data[at : at + n]


def header(data: bytes | Callable[[int, int], bytes]) -> Raster:
    """The metadata of a file, of which only the bytes of the directory are read."""
    read = reader(data)
    start = read(0, 8)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    if order is None or struct.unpack_from(order + "H", start, 2)[0] != 42:
        raise ValueError("not a baseline TIFF file")
    at = struct.unpack_from(order + "I", start, 4)[0]
    entries = read(at + 2, 12 * struct.unpack(order + "H", read(at, 2))[0])
    tags: dict[int, object] = {}
    for k in range(len(entries) // 12):
        tag, kind, n = struct.unpack_from(order + "HHI", entries, 12 * k)
        if kind not in FIELD:
            continue
        size, code = FIELD[kind]
        raw = entries[12 * k + 8 : 12 * k + 12] if size * n <= 4 else read(struct.unpack_from(order + "I", entries, 12 * k + 8)[0], size * n)
        tags[tag] = raw[:n].rstrip(b"\0").decode("utf-8", "replace") if code == "s" else list(struct.unpack_from(f"{order}{n}{code}", raw))
    one = lambda tag, default: tags.get(tag, [default])[0]
    bits, form = one(BITS, 1), one(FORMAT, 1)
    dtype = next((d for d, x in SAMPLE.items() if x == (form, bits)), None)
    if dtype is None or OFFSETS not in tags:
        raise ValueError(f"sample format {form} of {bits} bits, or a layout without strips, is not supported")
    geo = Raster.geo
    if SCALE in tags and TIE in tags:
        (dx, dy, _), (i, j, _, x, y, _) = tags[SCALE][:3], tags[TIE][:6]
        geo = (x - i * dx, dx, 0.0, y + j * dy, 0.0, -dy)
    bands = one(SAMPLES, 1)
    names = dict((int(k), unescape(v)) for k, v in re.findall(r'<Item name="DESCRIPTION" sample="(\d+)"[^>]*>([^<]*)</Item>', str(tags.get(METADATA, ""))))
    nodata = str(tags.get(NODATA_TEXT, "")).strip()
    return Raster(one(WIDTH, 0), one(HEIGHT, 0), bands, dtype, geo, str(tags.get(CRS_TEXT, "")).rstrip("|"), [names.get(k, "") for k in range(bands)], float(nodata) if nodata else None, order, one(COMPRESSION, 1), one(PLANAR, 1), min(one(ROWS, 1 << 30), one(HEIGHT, 0)), tags[OFFSETS], tags[COUNTS])


def read_rows(data: bytes | Callable[[int, int], bytes], r: Raster, first: int, last: int, bands: list[int] | None = None) -> np.ndarray:
    """Rows first to last (not included) as bands x rows x columns: only the strips that hold them are read and unpacked."""
    read = reader(data)
    if r.compression not in (1, 8, 32946):
        raise ValueError(f"compression {r.compression} is not supported")
    wanted = list(range(r.bands)) if bands is None else bands
    kind = np.dtype(r.dtype).newbyteorder(r.order)
    per_plane = -(-r.rows // r.strip_rows)
    out = np.empty((len(wanted), last - first, r.columns), r.dtype)
    for s in range(first // r.strip_rows, -(-last // r.strip_rows)):
        top = s * r.strip_rows
        n = min(r.strip_rows, r.rows - top)
        a, b = max(first, top), min(last, top + n)

        def strip(k: int) -> np.ndarray:
            raw = read(r.offsets[k], r.counts[k])
            return np.frombuffer(raw if r.compression == 1 else zlib.decompress(raw), kind)

        if r.planar == 1:
            whole = strip(s)[: n * r.columns * r.bands].reshape(n, r.columns, r.bands)
            out[:, a - first : b - first] = np.moveaxis(whole[a - top : b - top][..., wanted], 2, 0)
        else:
            for k, band in enumerate(wanted):
                out[k, a - first : b - first] = strip(band * per_plane + s)[: n * r.columns].reshape(n, r.columns)[a - top : b - top]
    return out


def write(array: np.ndarray, geo: tuple = Raster.geo, crs: str = "", descriptions: list[str] | None = None, nodata: float | None = None) -> bytes:
    """A file of an array of rows x columns or bands x rows x columns."""
    if array.ndim == 2:
        array = array[None]
    if array.ndim != 3 or array.dtype.name not in SAMPLE:
        raise ValueError("a raster is an array of 2 or 3 dimensions of a supported sample type")
    bands, rows, columns = array.shape
    form, bits = SAMPLE[array.dtype.name]
    step = max(1, STRIP_BYTES // max(1, columns * bands * bits // 8))
    pixels = np.moveaxis(array, 0, 2).astype(array.dtype.newbyteorder("<"))
    strips = [zlib.compress(pixels[i : i + step].tobytes(), 6) for i in range(0, rows, step)]
    tags: list[tuple[int, int, bytes, int]] = []

    def add(tag: int, kind: int, values) -> None:
        code = FIELD[kind][1]
        raw = values.encode() + b"\0" if code == "s" else struct.pack(f"<{len(values)}{code}", *values)
        tags.append((tag, kind, raw, len(raw) // FIELD[kind][0]))

    for tag, value in ((WIDTH, columns), (HEIGHT, rows), (ROWS, step)):
        add(tag, 4, [value])
    for tag, values in ((BITS, [bits] * bands), (COMPRESSION, [8]), (PHOTOMETRIC, [1]), (SAMPLES, [bands]), (PLANAR, [1]), (FORMAT, [form] * bands)):
        add(tag, 3, values)
    add(OFFSETS, 4, [0] * len(strips))
    add(COUNTS, 4, [len(s) for s in strips])
    add(SCALE, 12, [geo[1], -geo[5], 0.0])
    add(TIE, 12, [0.0, 0.0, 0.0, geo[0], geo[3], 0.0])
    if crs:
        add(CRS_TEXT, 2, crs + "|")
    if descriptions and bands > 1:  # a single band has no description
        add(METADATA, 2, "<GDALMetadata>" + "".join(f'<Item name="DESCRIPTION" sample="{k}" role="description">{escape(d)}</Item>' for k, d in enumerate(descriptions)) + "</GDALMetadata>")
    if nodata is not None:
        add(NODATA_TEXT, 2, f"{nodata:g}")
    tags.sort()
    end = 8 + 2 + 12 * len(tags) + 4
    extra = sum(len(raw) + len(raw) % 2 for _, _, raw, _ in tags if len(raw) > 4)
    at, offsets = end + extra, []
    for s in strips:
        offsets.append(at)
        at += len(s)
    head, tail = struct.pack("<2sHI", b"II", 42, 8) + struct.pack("<H", len(tags)), b""
    for tag, kind, raw, n in tags:
        if tag == OFFSETS:
            raw = struct.pack(f"<{len(offsets)}I", *offsets)
        if len(raw) <= 4:
            head += struct.pack("<HHI", tag, kind, n) + raw.ljust(4, b"\0")
        else:
            head += struct.pack("<HHII", tag, kind, n, end + len(tail))
            tail += raw + b"\0" * (len(raw) % 2)
    return head + struct.pack("<I", 0) + tail + b"".join(strips)
