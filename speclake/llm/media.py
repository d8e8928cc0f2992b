"""Media columns: payloads as progressive JPEG coefficients, read back scan by scan, inverse-transformed to RGB tensors."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A unit of payload: two macroblocks of 4:2:0 side by side, each block with 48 of its 63 AC coefficients.
UNIT, USED = 576, 48
#: Units an image: its height, 16 rows a unit, must fit in 16 bits, and a component's blocks in one end-of-band run.
TALL = 4000
#: Components as (id, blocks across and down a macroblock).
PARTS = ((1, 2, 2), (2, 1, 1), (3, 1, 1))


def _zigzag() -> list[int]:
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return [r * 8 + c for r, c in cells]


ZIGZAG = np.array(_zigzag())


def _inverse() -> np.ndarray:
    """Matrix from 64 coefficients in zigzag order to 64 samples."""
    u, x = np.arange(8)[:, None], np.arange(8)[None, :]
    basis = np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(0.125), 0.5)
    return np.einsum("ux,vy->uvxy", basis, basis).reshape(64, 64)[ZIGZAG].astype(np.float32)


INVERSE = _inverse()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _table(kind: int, slot: int, codes: list[tuple[int, int]]) -> bytes:
    """A Huffman table segment from (length, symbol), shortest first."""
    lengths = bytes(sum(n == k for n, _ in codes) for k in range(1, 17))
    return _segment(0xC4, bytes([kind << 4 | slot]) + lengths + bytes(s for _, s in codes))


def _scan(parts: list[int], table: int, first: int, last: int, high: int, low: int, data: bytes) -> bytes:
    head = bytes([len(parts)]) + b"".join(bytes([p, table]) for p in parts) + bytes([first, last, high << 4 | low])
    return _segment(0xDA, head) + data.replace(b"\xff", b"\xff\x00")


def encode(payload: bytes) -> bytes:
    """A progressive JPEG (4:2:0, 32 pixels wide) that holds a payload of whole units, 1 to ``TALL``, in its AC coefficients.

    A byte b becomes the coefficient b where b is over 127, else b - 255: eight magnitude bits always.
    Scans: DC (all zero); per component two bands of the upper seven bits; per component one
    refinement of the last bit. All coefficients of the bands take one-bit codes.
    """
    units = len(payload) // UNIT
    blocks = np.frombuffer(payload, np.uint8).reshape(units, 12, USED)
    of = {1: blocks[:, :8].reshape(-1, USED), 2: blocks[:, 8:10].reshape(-1, USED), 3: blocks[:, 10:].reshape(-1, USED)}
    frame = struct.pack(">BHHB", 8, units * 16, 32, 3) + b"".join(bytes([i, h << 4 | v, 0]) for i, h, v in PARTS)
    out = [b"\xff\xd8", _segment(0xDB, bytes([0]) + bytes([1] * 64)), _segment(0xC2, frame)]
    out += [_table(0, 0, [(1, 0)]), _table(1, 0, [(1, 7)]), _table(1, 1, [(16 - r, r << 4) for r in range(14, -1, -1)])]
    bits = units * 12
    out.append(_scan([1, 2, 3], 0, 0, 0, 0, 0, bytes(bits // 8) + (bytes([0xFF >> bits % 8]) if bits % 8 else b"")))
    for part, values in of.items():
        # Seven magnitude bits after a code of one zero bit fill a byte; of negative numbers the complement, as the sign is in the upper bit.
        upper = (values >> 1 & 0x7F).astype(np.uint8)
        out += [_scan([part], 0, a, b, 0, 1, upper[:, a - 1 : b].tobytes()) for a, b in ((1, 24), (25, USED))]
    for part, values in of.items():
        run = len(values).bit_length() - 1
        code = (((1 << 15 - run) - 2) << run | len(values) - (1 << run)) if run < 14 else len(values) - (1 << run)
        last = np.where(values > 127, values, ~values) & 1
        out.append(_scan([part], 1, 1, USED, 1, 0, struct.pack(">H", code) + np.packbits(last.astype(np.uint8)).tobytes()))
    return b"".join(out) + b"\xff\xd9"


class Bits:
    def __init__(self, data: bytes):
        self.data, self.at, self.size = int.from_bytes(data, "big") if len(data) < 4096 else None, 0, len(data) * 8
        self.raw = np.unpackbits(np.frombuffer(data, np.uint8)) if self.data is None else None

    def take(self, n: int) -> int:
        self.at += n
        if self.data is None:
            return int("".join(map(str, self.raw[self.at - n : self.at])) or "0", 2)
        return self.data >> self.size - self.at & (1 << n) - 1

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.take(1)
            if (n, code) in codes:
                return codes[n, code]
        raise ValueError("no such code")


def _extend(bits: int, size: int) -> int:
    return bits if not size or bits >> size - 1 else bits - (1 << size) + 1


class Frame:
    """Coefficient arrays of a progressive JPEG, filled scan by scan."""

    def __init__(self, height: int, width: int, parts: list[tuple[int, int, int]]):
        self.height, self.width = height, width
        self.hmax, self.vmax = max(h for _, h, _ in parts), max(v for _, _, v in parts)
        self.across, self.down = -(-width // (8 * self.hmax)), -(-height // (8 * self.vmax))
        self.parts = {i: (h, v) for i, h, v in parts}
        self.coefficients = {i: np.zeros((self.down * v, self.across * h, 64), np.int16) for i, h, v in parts}

    def size(self, part: int) -> tuple[int, int]:
        """Block rows and columns of a component that scans of it alone hold."""
        h, v = self.parts[part]
        return -(-(-(-self.height * v // self.vmax)) // 8), -(-(-(-self.width * h // self.hmax)) // 8)

    def dc(self, ids: list[int], codes: list[dict], high: int, low: int, data: bytes) -> None:
        bits, before = Bits(data), dict.fromkeys(ids, 0)
        if not high and all(c == {(1, 0): 0} for c in codes):
            return  # every difference is zero
        for row in range(self.down if len(ids) > 1 else self.size(ids[0])[0]):
            for col in range(self.across if len(ids) > 1 else self.size(ids[0])[1]):
                for part, code in zip(ids, codes, strict=True):
                    h, v = self.parts[part] if len(ids) > 1 else (1, 1)
                    for y in range(v):
                        for x in range(h):
                            block = self.coefficients[part][row * v + y, col * h + x]
                            if high:
                                block[0] |= bits.take(1) << low
                            else:
                                size = bits.symbol(code)
                                before[part] += _extend(bits.take(size), size)
                                block[0] = before[part] << low

    def ac(self, part: int, codes: dict, a: int, b: int, high: int, low: int, data: bytes) -> None:
        rows, cols = self.size(part)
        band = self.coefficients[part][:rows, :cols, a : b + 1]
        if not high and list(codes) == [(1, 0)] and 0 < codes[1, 0] < 16:
            self._even(band, codes[1, 0], low, data)
        elif high and band.all() and self._corrections(band, codes, low, data):
            return
        else:
            self._any(band, codes, high, low, data)

    def _even(self, band: np.ndarray, size: int, low: int, data: bytes) -> None:
        """A first scan whose table has one symbol: no runs, and as many bits for every coefficient."""
        bits = np.unpackbits(np.frombuffer(data, np.uint8))[: band.size * (size + 1)] if size != 7 else None
        if bits is None:
            value = np.frombuffer(data, np.uint8)[: band.size].astype(np.int16)
        else:
            value = (bits.reshape(-1, size + 1)[:, 1:] @ (1 << np.arange(size - 1, -1, -1))).astype(np.int16)
        value = np.where(value >> size - 1, value, value - (1 << size) + 1)
        band[...] = (np.sign(value) * (np.abs(value) << low)).reshape(band.shape)

    def _corrections(self, band: np.ndarray, codes: dict, low: int, data: bytes) -> bool:
        """A refinement where no coefficient is zero and one end-of-band run covers all blocks: correction bits only."""
        bits = Bits(data[:4])
        symbol = bits.symbol(codes)
        run = symbol >> 4
        blocks = band.shape[0] * band.shape[1]
        if symbol & 15 or run > 14 or (1 << run) + bits.take(run) != blocks:
            return False
        more = np.unpackbits(np.frombuffer(data, np.uint8)[bits.at // 8 :])[bits.at % 8 :][: band.size].astype(np.int16).reshape(band.shape)
        band += np.sign(band) * (more << low)
        return True

    def _any(self, band: np.ndarray, codes: dict, high: int, low: int, data: bytes) -> None:
        bits, run, one = Bits(data), 0, 1 << low

        def correct(block: np.ndarray, k: int) -> None:
            if bits.take(1) and not abs(int(block[k])) & one:
                block[k] += one if block[k] > 0 else -one

        for block in (band[y, x] for y in range(band.shape[0]) for x in range(band.shape[1])):
            k, n = 0, len(block)
            while k < n and not run:
                symbol = bits.symbol(codes)
                skip, size = symbol >> 4, symbol & 15
                if not size and skip < 15:
                    run = (1 << skip) + bits.take(skip)
                    break
                value = 0
                if size:
                    value = _extend(bits.take(size), size) * one
                if not high:
                    k += skip
                    if size:
                        block[k] = value
                    k += 1
                    continue
                while k < n:
                    if block[k]:
                        correct(block, k)
                    elif not skip:
                        block[k] = value
                        k += 1
                        break
                    else:
                        skip -= 1
                    k += 1
            if run:
                if high:
                    for j in range(k, n):
                        if block[j]:
                            correct(block, j)
                run -= 1

    def rgb(self, tables: dict[int, np.ndarray], of: dict[int, int]) -> np.ndarray:
        """Height x width x 3 bytes: inverse transform, chroma repeated to full resolution, colours converted."""
        planes = []
        for part, (h, v) in self.parts.items():
            c = self.coefficients[part]
            flat = (c.reshape(-1, 64) * tables[of[part]]).astype(np.float32) @ INVERSE + 128
            plane = np.clip(np.rint(flat), 0, 255).reshape(c.shape[0], c.shape[1], 8, 8).transpose(0, 2, 1, 3).reshape(c.shape[0] * 8, -1)
            planes.append(plane.repeat(self.vmax // v, axis=0).repeat(self.hmax // h, axis=1)[: self.height, : self.width])
        if len(planes) == 1:
            return planes[0].astype(np.uint8)[:, :, None].repeat(3, axis=2)
        y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
        colours = np.stack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], axis=2)
        return np.clip(np.rint(colours), 0, 255).astype(np.uint8)


def decode(image: bytes) -> tuple[Frame, np.ndarray]:
    """The coefficient arrays and the RGB tensor of a progressive JPEG (Huffman, eight bits, no restarts)."""
    at, codes, tables, of, frame = 2, {}, {}, {}, None
    while image[at + 1] != 0xD9:
        marker, length = image[at + 1], int.from_bytes(image[at + 2 : at + 4], "big")
        body = image[at + 4 : at + 2 + length]
        at += 2 + length
        if marker == 0xDB:
            while body:
                wide = 2 if body[0] >> 4 else 1
                tables[body[0] & 15] = np.frombuffer(body[1 : 1 + 64 * wide], ">u2" if wide == 2 else np.uint8).astype(np.int32)
                body = body[1 + 64 * wide :]
        elif marker == 0xC2:
            _, height, width, n = struct.unpack(">BHHB", body[:6])
            parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15) for i in range(n)]
            of = {body[6 + 3 * i]: body[8 + 3 * i] for i in range(n)}
            frame = Frame(height, width, parts)
        elif marker == 0xC4:
            while body:
                code, k, found = 0, 17, {}
                for n in range(1, 17):
                    for _ in range(body[n]):
                        found[n, code] = body[k]
                        code, k = code + 1, k + 1
                    code <<= 1
                codes[body[0] >> 4, body[0] & 15] = found
                body = body[k:]
        elif marker == 0xDA:
            n = body[0]
            ids, chosen = [body[1 + 2 * i] for i in range(n)], [body[2 + 2 * i] for i in range(n)]
            a, b, high, low = body[1 + 2 * n], body[2 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15
            end = at
            while image[(end := image.index(b"\xff", end)) + 1] == 0:
                end += 2
            data = image[at:end].replace(b"\xff\x00", b"\xff")
            at = end
            if a == 0:
                frame.dc(ids, [codes.get((0, c >> 4)) for c in chosen], high, low, data)
            else:
                frame.ac(ids[0], codes[1, chosen[0] & 15], a, b, high, low, data)
    return frame, frame.rgb(tables, of)


def padded(data: bytes) -> bytes:
    """``data`` and bytes 255 up to a positive multiple of a unit."""
    return data + b"\xff" * (max(1, -(-len(data) // UNIT)) * UNIT - len(data))


def stored(payload: bytes) -> Iterator[bytes]:
    """A payload of whole units as one image or, if long, several, made one at a time."""
    return (encode(payload[k : k + UNIT * TALL]) for k in range(0, len(payload), UNIT * TALL))


def read_back(frame: Frame) -> bytes:
    """The payload that ``encode`` put into the coefficients."""
    units = frame.height // 16
    blocks = np.concatenate([frame.coefficients[i].reshape(units, -1, 64)[:, :, 1 : 1 + USED] for i in (1, 2, 3)], axis=1)
    return np.where(blocks > 0, blocks, blocks + 255).astype(np.uint8).tobytes()


class Features:
    """Rows, columns, and per colour the mean and mean square of the values of tensors seen one after another, as text."""

    def __init__(self) -> None:
        self.rows, self.columns = 0, 0
        self.sums, self.squares = np.zeros(3, np.int64), np.zeros(3, np.int64)

    def add(self, tensor: np.ndarray) -> None:
        self.rows, self.columns = self.rows + tensor.shape[0], tensor.shape[1]
        self.sums += tensor.sum(axis=(0, 1), dtype=np.int64)
        self.squares += (tensor.astype(np.int32) ** 2).sum(axis=(0, 1), dtype=np.int64)

    def __str__(self) -> str:
        n = self.rows * self.columns
        return f"{self.rows}x{self.columns}x3;" + ",".join(f"{s / n:.2f}" for s in self.sums) + ";" + ",".join(f"{s / n:.1f}" for s in self.squares)


MEDIA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def store_media(docs: DataFrame, tensors: bool = False) -> DataFrame:
    """Stores every whole text as progressive JPEG, reads it back and describes it.

    ``docs``: doc_id, text. Returns the columns of ``MEDIA``; with ``tensors`` also media (array of
    binary: the images) and rgb (array of binary: their full-resolution tensors, row by row, 32 x 3
    bytes a row). Texts longer than ``TALL`` units take several images, of which one and its tensor are in memory at a time, but for ``tensors``.
    Null and empty texts are one unit of padding; repeated rows stay; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 200 if tensors else 2000):
                part = batch.slice(k, 200 if tensors else 2000)
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    data = text.as_py() or b""
                    payload, whole, described = hashlib.sha256(), hashlib.sha256(), Features()
                    size = length = 0
                    images, kept, tail = [], [], b""
                    for image in stored(padded(data)):
                        frame, rgb = decode(image)
                        read = read_back(frame)
                        payload.update(read)
                        whole.update(image)
                        size, length, tail = size + len(image), length + len(read), read[-32:]
                        described.add(rgb)
                        if tensors:
                            images.append(image)
                            kept.append(rgb.tobytes())
                    rows.append((doc, len(data), length, payload.hexdigest(), zlib.crc32(tail), size, whole.hexdigest(), str(described), *([images, kept] if tensors else [])))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), *([pa.list_(pa.binary())] * 2 if tensors else [])]
                names = [x.split()[0] for x in MEDIA.split(", ")] + (["media", "rgb"] if tensors else [])
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, MEDIA + (", media array<binary>, rgb array<binary>" if tensors else ""))
