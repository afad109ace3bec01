"""Baseline JPEG columns: dimensions, DC-only luminance thumbnails and their hashes.

The decoder parses the markers, Huffman-decodes the scan and keeps the DC coefficient of each
luminance block, which is eight times the block's mean: a thumbnail of an eighth of the
size, without any inverse transform. AC coefficients are decoded only as far as needed to skip them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Typical Huffman tables (Annex K of the JPEG standard): codes of each length, then symbols.
_DC = (bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]), bytes(range(12)))
_AC_SYMBOLS = bytes.fromhex(
    "01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282090a161718191a25262728292a3435363738393a434445464748494a535455565758595a636465666768696a737475767778797a838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3c4c5c6c7c8c9cad2d3d4d5d6d7d8d9dae1e2e3e4e5e6e7e8e9eaf1f2f3f4f5f6f7f8f9fa"
)
_AC = (bytes([0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125]), _AC_SYMBOLS)
_ZIGZAG = [0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28, 35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63]


class BadJpeg(ValueError):
    """Why bytes aren't a baseline JPEG that can be read."""


def _codes(counts: bytes, symbols: bytes) -> list[tuple[int, int, int]]:
    """Code, its length and its symbol, in order."""
    out, code, k = [], 0, 0
    for length in range(1, 17):
        for _ in range(counts[length - 1]):
            if code >> length or k >= len(symbols):
                raise BadJpeg("Huffman table")
            out.append((code, length, symbols[k]))
            code, k = code + 1, k + 1
        code <<= 1
    return out


@lru_cache(maxsize=64)
def _table(counts: bytes, symbols: bytes) -> list[int]:
    """For each 16 bits ahead: length << 8 | symbol of the code that they begin with; 0 where there is none."""
    t = np.zeros(1 << 16, np.int64)
    for code, length, symbol in _codes(counts, symbols):
        t[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
    return t.tolist()


def _segments(raw: bytes) -> Iterator[tuple[int, bytes, int]]:
    """Marker, its content and where it ends, over all scans; what is entropy-coded is passed over."""
    if raw[:2] != b"\xff\xd8":
        raise BadJpeg("no JPEG")
    at = 2
    while True:
        while at < len(raw) and raw[at] == 0xFF and at + 1 < len(raw) and raw[at + 1] == 0xFF:
            at += 1
        if at + 4 > len(raw) or raw[at] != 0xFF:
            raise BadJpeg("cut off")
        marker, size = raw[at + 1], int.from_bytes(raw[at + 2 : at + 4], "big")
        if size < 2 or at + 2 + size > len(raw):
            raise BadJpeg("cut off")
        yield marker, raw[at + 4 : at + 2 + size], at + 2 + size
        at += 2 + size
        while marker == 0xDA:
            at = raw.find(b"\xff", at)
            if at < 0 or at + 1 >= len(raw):
                raise BadJpeg("scan")
            if raw[at + 1] and not 0xD0 <= raw[at + 1] <= 0xD7 and raw[at + 1] != 0xFF:
                break
            at += 1 + (raw[at + 1] != 0xFF)
        if marker == 0xDA and raw[at + 1] == 0xD9:
            raise BadJpeg("scan")


def _intervals(raw: bytes, at: int) -> list[bytes]:
    """Entropy-coded bytes of each restart interval, without stuffing."""
    out, begin = [], at
    while True:
        at = raw.find(b"\xff", at)
        if at < 0 or at + 1 >= len(raw):
            raise BadJpeg("no end")
        if raw[at + 1] == 0:
            at += 2
        elif raw[at + 1] == 0xFF:
            at += 1
        else:
            out.append(raw[begin:at].replace(b"\xff\x00", b"\xff"))
            if not 0xD0 <= raw[at + 1] <= 0xD7:
                return out
            at += 2
            begin = at


#: Bytes of a scan that are laid out at once, and more of them than a block can have.
_AHEAD, _BLOCK = 1 << 16, 512


def _windows(part: bytes, base: int) -> list[int]:
    """The 32 bits that begin with each byte from base on, as far as the next blocks reach."""
    b = np.frombuffer(part, np.uint8, min(_AHEAD + _BLOCK, len(part) - base), base).astype(np.int64)
    return ((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]).tolist()


def decode_dc(raw: bytes) -> tuple[int, int, int, np.ndarray]:
    """Width, height, components and thumbnail (rows of blocks of luminance means, 0 to 255) of a baseline JPEG.

    The first scan that has the first component is read: one of all components, interleaved, or its own.
    """
    quant: dict[int, int] = {}
    huffman: dict[int, list[int]] = {}
    frame, interval, scan, start = None, 0, b"", 0
    for marker, body, end in _segments(raw):
        if marker == 0xDB:
            at = 0
            while at < len(body):
                wide = body[at] >> 4
                if at + 1 + (64 << wide) > len(body):
                    raise BadJpeg("quantisation table")
                quant[body[at] & 15] = int.from_bytes(body[at + 1 : at + 2 + wide], "big")
                at += 1 + (64 << wide)
        elif marker == 0xC4:
            at = 0
            while at < len(body):
                counts = body[at + 1 : at + 17]
                total = sum(counts)
                if len(counts) < 16 or at + 17 + total > len(body):
                    raise BadJpeg("Huffman table")
                huffman[body[at]] = _table(counts, body[at + 17 : at + 17 + total])
                at += 17 + total
        elif marker == 0xC0:
            if len(body) < 6 or len(body) < 6 + 3 * body[5] or body[0] != 8:
                raise BadJpeg("frame")
            height, width = struct.unpack(">HH", body[1:5])
            frame = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5])]
            if not width or not height or not frame or any(not 1 <= h <= 4 or not 1 <= v <= 4 for _, h, v, _ in frame):
                raise BadJpeg("frame")
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise BadJpeg("not baseline")
        elif marker == 0xDD:
            interval = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            if frame is None or not body or len(body) < 1 + 2 * body[0] + 3:
                raise BadJpeg("scan")
            if frame[0][0] in body[1 : 1 + 2 * body[0] : 2]:
                scan, start = body, end
                break
    hmax, vmax = max(f[1] for f in frame), max(f[2] for f in frame)
    _, wide, tall, table = frame[0]
    rows, cols = -(-height * tall // (8 * vmax)), -(-width * wide // (8 * hmax))
    by_id = {f[0]: f for f in frame}
    own = [(scan[1 + 2 * i], scan[2 + 2 * i]) for i in range(scan[0])]
    if any(ident not in by_id for ident, _ in own):
        raise BadJpeg("scan")
    if len(own) == 1:  # a component of its own comes block by block
        wide = tall = 1
        across, down = cols, rows
    else:
        across, down = -(-width // (8 * hmax)), -(-height // (8 * vmax))
    plan: list[tuple[int, list[int], list[int]]] = []  # 0 for the first component, DC and AC table of each block of a unit
    for c, (ident, which) in enumerate(own):
        dc, ac = huffman.get(which >> 4), huffman.get(16 | which & 15)
        if dc is None or ac is None:
            raise BadJpeg("table missing")
        plan += [(0 if ident == frame[0][0] else c + 1, dc, ac)] * (1 if len(own) == 1 else by_id[ident][1] * by_id[ident][2])
    found: list[int] = []
    units, done = across * down, 0
    for part in _intervals(raw, start):
        part += bytes(8)
        bits, p, base = 8 * (len(part) - 8), 0, 0
        window = _windows(part, 0)
        last = [0] * (len(own) + 1)
        for _ in range(min(interval or units, units - done)):
            for c, dc, ac in plan:
                if p >> 3 >= _AHEAD:
                    base, bits, p = base + (p >> 3), bits - (p >> 3 << 3), p & 7
                    window = _windows(part, base)
                e = dc[window[p >> 3] >> (16 - (p & 7)) & 0xFFFF]
                size = e & 255
                if not e or size > 11:
                    raise BadJpeg("code")
                p += e >> 8
                if p + size > bits:
                    raise BadJpeg("cut off")
                if size:
                    v = window[p >> 3] >> (32 - (p & 7) - size) & ((1 << size) - 1)
                    last[c] += v if v >> (size - 1) else v - (1 << size) + 1
                    p += size
                if not c:
                    found.append(last[0])
                k = 1
                while k < 64:
                    e = ac[window[p >> 3] >> (16 - (p & 7)) & 0xFFFF]
                    if not e:
                        raise BadJpeg("code")
                    symbol = e & 255
                    p += (e >> 8) + (symbol & 15)
                    if p > bits:
                        raise BadJpeg("cut off")
                    if symbol & 15:
                        k += (symbol >> 4) + 1
                    elif symbol == 0xF0:
                        k += 16
                    else:
                        break
            done += 1
    if done < units:
        raise BadJpeg("cut off")
    if table not in quant:
        raise BadJpeg("table missing")
    grid = np.array(found, np.int64).reshape(down, across, tall, wide).transpose(0, 2, 1, 3).reshape(down * tall, across * wide)
    return width, height, len(frame), np.clip(np.floor(grid[:rows, :cols] * quant[table] / 8 + 128.5), 0, 255).astype(np.uint8)


def _resize(thumb: np.ndarray, rows: int, cols: int) -> np.ndarray:
    """Means of the cells of a grid laid over thumb; cells take part of a pixel in proportion."""

    def weights(n: int, m: int) -> np.ndarray:
        edge = np.arange(m + 1) * n / m
        pixel = np.arange(n)
        return np.clip(np.minimum(edge[1:, None], pixel + 1) - np.maximum(edge[:-1, None], pixel), 0, None) * m / n

    return weights(thumb.shape[0], rows) @ thumb.astype(float) @ weights(thumb.shape[1], cols).T


def thumb_hash(thumb: np.ndarray) -> int:
    """64 bits: whether each cell of an 8 by 9 grid is brighter than the next; near for near images."""
    g = np.round(_resize(thumb, 8, 9), 6)
    bits = np.packbits((g[:, 1:] > g[:, :-1]).ravel())
    return int(bits.view(">i8")[0])


_SCHEMA = "width int, height int, components int, thumb_width int, thumb_height int, thumb binary, thumb_hash long, error string"


def with_thumbnails(df: DataFrame, id_col: str = "id", image_col: str = "image") -> DataFrame:
    """One row for each row of df: id_col, width, height, components, thumb_width, thumb_height, thumb (luminance, row by row), thumb_hash and error.

    What isn't a complete baseline JPEG (progressive ones, other bytes, an empty image) has a reason in
    error and null elsewhere; a null image has null everywhere. Ids may be null or repeat; rows
    are handled each on its own; an empty table gives an empty one; other columns are ignored.
    Images of any size are read whole; of a scan, a part is laid out at a time.
    """
    kind = df.schema[id_col].dataType.simpleString()
    src = df.select(F.col(id_col).alias("id"), F.col(image_col).alias("image"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["width", "height", "components", "thumb_width", "thumb_height", "thumb", "thumb_hash", "error"]
        kinds = [pa.int32()] * 5 + [pa.binary(), pa.int64(), pa.string()]
        for batch in batches:
            rows: list[tuple] = []
            for raw in batch.column(1).to_pylist():
                if raw is None:
                    rows.append((None,) * 8)
                    continue
                try:
                    width, height, components, thumb = decode_dc(raw)
                    rows.append((width, height, components, thumb.shape[1], thumb.shape[0], thumb.tobytes(), thumb_hash(thumb), None))
                except BadJpeg as e:
                    rows.append((None,) * 7 + (str(e),))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], ["id", *names])

    return src.mapInArrow(run, f"id {kind}, {_SCHEMA}").withColumnRenamed("id", id_col)


@lru_cache(maxsize=4)
def _encoder_tables() -> tuple[dict[int, tuple[int, int]], dict[int, tuple[int, int]]]:
    return {s: (c, n) for c, n, s in _codes(*_DC)}, {s: (c, n) for c, n, s in _codes(*_AC)}


def encode(blocks: list[np.ndarray], width: int, height: int, sampling: list[tuple[int, int]], quant: np.ndarray, interval: int = 0) -> bytes:
    """A baseline JPEG of quantised coefficients.

    blocks has, for each component, an array (rows of blocks, columns, 64) in natural order,
    which covers whole units. It serves to make images where a table has none.
    """
    dc, ac = _encoder_tables()
    hmax, vmax = max(s[0] for s in sampling), max(s[1] for s in sampling)
    across, down = -(-width // (8 * hmax)), -(-height // (8 * vmax))
    n = len(blocks)
    out = bytearray(b"\xff\xd8\xff\xdb\x00\x43\x00" + bytes(int(quant[i]) for i in _ZIGZAG))
    out += b"\xff\xc0" + struct.pack(">HBHHB", 8 + 3 * n, 8, height, width, n) + b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v) in enumerate(sampling))
    for k, (counts, symbols) in ((0x00, _DC), (0x10, _AC)):
        out += b"\xff\xc4" + struct.pack(">HB", 19 + len(symbols), k) + counts + symbols
    if interval:
        out += b"\xff\xdd\x00\x04" + struct.pack(">H", interval)
    out += b"\xff\xda" + struct.pack(">HB", 6 + 2 * n, n) + b"".join(bytes([i + 1, 0]) for i in range(n)) + b"\x00\x3f\x00"
    value = bits = 0
    last = [0] * n

    def flush() -> None:
        nonlocal value, bits
        pad = -bits % 8
        out.extend(((value << pad) | ((1 << pad) - 1)).to_bytes((bits + pad) // 8, "big").replace(b"\xff", b"\xff\x00"))
        value = bits = 0

    coded = [c[..., _ZIGZAG].tolist() for c in blocks]
    for unit in range(across * down):
        if interval and unit and unit % interval == 0:
            flush()
            out += bytes([0xFF, 0xD0 + (unit // interval - 1) % 8])
            last = [0] * n
        y, x = divmod(unit, across)
        for c, (h, v) in enumerate(sampling if n > 1 else [(1, 1)]):
            for j in range(v):
                for i in range(h):
                    block = coded[c][y * v + j][x * h + i]
                    diff, last[c] = block[0] - last[c], block[0]
                    size = abs(diff).bit_length()
                    code, length = dc[size]
                    value = (value << length | code) << size | (diff if diff >= 0 else diff + (1 << size) - 1)
                    bits += length + size
                    zeros = 0
                    for w in block[1:]:
                        if not w:
                            zeros += 1
                            continue
                        while zeros > 15:
                            code, length = ac[0xF0]
                            value, bits, zeros = value << length | code, bits + length, zeros - 16
                        size = abs(w).bit_length()
                        code, length = ac[zeros << 4 | size]
                        value = (value << length | code) << size | (w if w > 0 else w + (1 << size) - 1)
                        bits, zeros = bits + length + size, 0
                    if zeros:
                        code, length = ac[0]
                        value, bits = value << length | code, bits + length
    flush()
    return bytes(out + b"\xff\xd9")


#: Luminance steps for a unit of a vector's component, in render.
_GAIN = 400


def render(vector: np.ndarray, kind: int) -> bytes:
    """An image of 64 by 64 pixels, a block for each of a vector's 64 components: grey, 4:4:4, 4:2:0 or grey with restarts."""
    v = np.zeros(64)
    v[: min(64, len(vector))] = np.nan_to_num(vector[:64])
    luma = np.zeros((8, 8, 64), np.int64)
    luma[..., 0] = np.clip(np.round(v * _GAIN), -127, 127).reshape(8, 8)
    luma[..., 1] = np.round(v * 20).reshape(8, 8)
    luma[..., 40] = np.arange(64).reshape(8, 8) % 3 - 1
    quant = np.full(64, 8)
    if kind == 0 or kind == 3:
        return encode([luma], 64, 64, [(1, 1)], quant, interval=5 if kind else 0)
    if kind == 1:
        return encode([luma, luma // 2, -luma // 3], 64, 64, [(1, 1)] * 3, quant)
    return encode([luma, luma[::2, ::2] // 2, luma[1::2, 1::2] // 3], 64, 64, [(2, 2), (1, 1), (1, 1)], quant)


def rendered(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A JPEG for every vector: id_col and image. The driver's tables have no media, so this makes them, the same on every run. A null vector gives a null image."""
    kind = vectors.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            images = [None if v is None else render(np.array(v, float), (i or 0) % 4) for i, v in zip(ids, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(images, pa.binary())], ["id", "image"])

    return vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).mapInArrow(run, f"id {kind}, image binary").withColumnRenamed("id", id_col)
