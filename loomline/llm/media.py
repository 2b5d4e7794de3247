"""Media columns: progressive JPEG in numpy.

Reading: the scans of a progressive file, by spectral selection and successive approximation, add up in coefficient
arrays, one a component; an inverse cosine transform in numpy gives planes, chroma is upsampled, and the result is a
full-resolution RGB tensor. Any 8-bit Huffman-coded progressive file of one or three components is read, with restarts and
any whole sampling ratios. Scans whose codes all have one length, and refinements under an end-of-band run, are read as arrays;
other scans symbol by symbol.

Storing bytes without loss: JPEG's own unit is the quantised coefficient. A byte b is the coefficient b for b >= 128
and b - 255 else, the 256 values that need eight magnitude bits, and b is just these bits. Blocks of 64 bytes fill a 4:2:0
image of 16 x 16 pixel units, its height first; a comment holds their number.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import id_and_text, text_slices

BLOCK = 64
#: Units of 16 pixels that a side may have.
MOST_UNITS = 4095
LONGEST_RUN = 32767
#: Bytes of tensors that go to the JVM at a time, but for a larger one.
TENSOR_BYTES = 8 << 20


@lru_cache(maxsize=1)
def zigzag() -> np.ndarray:
    """The row-major place of the k-th coefficient."""
    return np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))


@lru_cache(maxsize=1)
def _inverse_transform() -> np.ndarray:
    """64 x 64: coefficients in zigzag order to pixels."""
    x, u = np.arange(8)[:, None], np.arange(8)[None, :]
    one = np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, np.sqrt(1 / 8), 0.5)
    return np.kron(one, one)[:, zigzag()].T.astype(np.float32)


@lru_cache(maxsize=64)
def _codes(counts: bytes, symbols: bytes) -> dict[str, int]:
    """Canonical Huffman codes, as strings of bits."""
    out, code, i = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out[format(code, f"0{length}b")] = symbols[i]
            code, i = code + 1, i + 1
        code <<= 1
    return out


def _bits(data: bytes) -> str:
    return format(int.from_bytes(data, "big"), f"0{len(data) * 8}b") if data else ""


class _Reader:
    """Symbols and bits of one entropy-coded segment."""

    def __init__(self, data: bytes, codes: dict[str, int] | None):
        self.bits, self.at, self.codes = _bits(data), 0, codes or {}
        self.lengths = sorted({len(c) for c in self.codes})

    def symbol(self) -> int:
        for n in self.lengths:
            if (s := self.codes.get(self.bits[self.at : self.at + n])) is not None:
                self.at += n
                return s
        raise ValueError("not a Huffman code, or the segment ends early")

    def number(self, n: int) -> int:
        if not n:
            return 0
        self.at += n
        return int(self.bits[self.at - n : self.at], 2)

    def signed(self, n: int) -> int:
        x = self.number(n)
        return x if not n or x >> (n - 1) else x - (1 << n) + 1


class Component:
    def __init__(self, h: int, v: int, table: int):
        self.h, self.v, self.table = h, v, table
        self.coefficients = np.zeros((0, 64), np.int16)
        self.wide = self.high = self.used_wide = self.used_high = 0

    def rows(self) -> np.ndarray:
        """Blocks in a scan of this component alone, without those that only pad the image."""
        return _rows(self.used_high, self.used_wide, self.wide)


@lru_cache(maxsize=512)
def _rows(high: int, used: int, wide: int) -> np.ndarray:
    return (np.arange(high)[:, None] * wide + np.arange(used)).ravel()


@lru_cache(maxsize=512)
def _units(across: int, down: int, h: int, v: int) -> np.ndarray:
    y = np.arange(down)[:, None, None, None] * v + np.arange(v)[:, None]
    x = np.arange(across)[None, :, None, None] * h + np.arange(h)
    return (y * (across * h) + x).reshape(across * down, h * v)


@lru_cache(maxsize=512)
def _all_units(across: int, down: int, sampling: tuple[tuple[int, int], ...]) -> np.ndarray:
    """Units x blocks of a unit, in a scan of several components."""
    return np.concatenate([_units(across, down, h, v) for h, v in sampling], axis=1)


def _range(blocks: np.ndarray) -> np.ndarray | slice:
    """Blocks in a row as a slice, which numpy reads without a copy."""
    return slice(int(blocks[0]), int(blocks[-1]) + 1) if len(blocks) and blocks[-1] - blocks[0] + 1 == len(blocks) else blocks


class Image:
    def __init__(self) -> None:
        self.width = self.height = 0
        self.components: dict[int, Component] = {}
        self.quantisers: dict[int, np.ndarray] = {}
        self.comment = b""

    def tensor(self) -> np.ndarray:
        """height x width x 3, unsigned bytes."""
        most_h, most_v = max(c.h for c in self.components.values()), max(c.v for c in self.components.values())

        def upsampled(c: Component, plane: np.ndarray) -> np.ndarray:
            if most_v // c.v > 1:
                plane = plane.repeat(most_v // c.v, axis=0)
            if most_h // c.h > 1:
                plane = plane.repeat(most_h // c.h, axis=1)
            return plane[: self.height, : self.width]

        planes = []
        for c in self.components.values():
            pixels = (c.coefficients * self.quantisers[c.table].astype(np.float32)) @ _inverse_transform()
            np.clip(pixels, -128, 127, out=pixels)
            planes.append(pixels.reshape(c.high, c.wide, 8, 8).transpose(0, 2, 1, 3).reshape(c.high * 8, c.wide * 8))
        first, *chroma = self.components.values()
        y = upsampled(first, planes[0]) + 128
        if not chroma:
            return np.repeat(np.rint(y).astype(np.uint8)[:, :, None], 3, axis=2)
        blue, red = (upsampled(c, p) for c, p in zip(chroma, planes[1:], strict=True)) if chroma[0].h != chroma[1].h or chroma[0].v != chroma[1].v else planes[1:]
        out = np.empty((3, self.height, self.width), np.uint8)
        for i, shift in enumerate((1.402 * red, -0.344136 * blue - 0.714136 * red, 1.772 * blue)):
            plane = y + (upsampled(chroma[0], shift) if shift.shape != y.shape else shift)
            np.rint(plane, out=plane)
            np.clip(plane, 0, 255, out=plane)
            out[i] = plane
        return out.transpose(1, 2, 0)


@lru_cache(maxsize=64)
def _byte_values(code: str, low: int) -> np.ndarray:
    """The coefficient that each byte stands for if it is this code and then magnitude bits; for other bytes, the lowest number."""
    size = 8 - len(code)
    read = np.arange(256, dtype=np.int16)
    bits = read & ((1 << size) - 1)
    return np.where(read >> size == int(code, 2), np.where(bits >> (size - 1), bits, bits - (1 << size) + 1) << low, np.iinfo(np.int16).min).astype(np.int16)


def _first_scan_at_once(segment: bytes, codes: dict[str, int], n: int, low: int) -> np.ndarray | None:
    """n coefficients whose codes are all one and the same, or None."""
    head = _bits(segment[:2])
    found = next(((c, s) for c, s in codes.items() if head.startswith(c)), None)
    if not found or found[1] >> 4 or not found[1] & 15:
        return None
    code, size = found[0], found[1] & 15
    stride = len(code) + size
    if n * stride > len(segment) * 8:
        return None
    if stride == 8:
        values = _byte_values(code, low)[np.frombuffer(segment, np.uint8, n)]
        return None if values.min() == np.iinfo(np.int16).min else values
    elif stride <= 16:
        table = np.unpackbits(np.frombuffer(segment, np.uint8), count=n * stride).reshape(n, stride)
        wide = np.zeros((n, 16), np.uint8)
        wide[:, 16 - stride :] = table
        read = np.packbits(wide, axis=1).view(">u2").ravel().astype(np.int32)
    else:
        return None
    if ((read >> size) != int(code, 2)).any():
        return None
    read &= (1 << size) - 1
    return np.where(read >> (size - 1), read, read - (1 << size) + 1) << low


def _first_ac(c: Component, blocks: np.ndarray, segment: bytes, codes: dict[str, int], lo: int, hi: int, low: int) -> None:
    band = hi - lo + 1
    at_once = _first_scan_at_once(segment, codes, len(blocks) * band, low)
    if at_once is not None:
        c.coefficients[_range(blocks), lo : hi + 1] = at_once.reshape(-1, band)
        return
    read, skip = _Reader(segment, codes), 0
    for b in blocks.tolist():
        if skip:
            skip -= 1
            continue
        k = lo
        while k <= hi:
            run, size = divmod(read.symbol(), 16)
            if size:
                k += run
                c.coefficients[b, k] = read.signed(size) * (1 << low)
                k += 1
            elif run == 15:
                k += 16
            else:
                skip = (1 << run) + read.number(run) - 1
                break


def _refined(values: np.ndarray, bits: np.ndarray, low: int) -> np.ndarray:
    """values with a correction bit added to each that is not zero, in order."""
    if bits.size == values.size:
        return values + np.sign(values) * (bits.reshape(values.shape).astype(np.int16) << low)
    out = values.copy()
    at = np.nonzero(values)
    out[at] += np.sign(values[at]) * (bits.astype(np.int16) << low)
    return out


def _refine_ac(c: Component, blocks: np.ndarray, segment: bytes, codes: dict[str, int], lo: int, hi: int, low: int) -> None:
    bits = np.unpackbits(np.frombuffer(segment, np.uint8))
    read, i = _Reader(segment[:8], codes), 0
    head = read.symbol()
    if head & 15 or head >> 4 == 15 or len(blocks) > (1 << (head >> 4)) + read.number(head >> 4):  # else one run has it all
        read = _Reader(segment, codes)
    else:
        read.at = 0
    while i < len(blocks):
        b, k = blocks[i], lo
        while k <= hi:
            run, size = divmod(read.symbol(), 16)
            if not size and run < 15:  # the rest of this block and of the next ones holds correction bits only
                many = (1 << run) + read.number(run)
                if k > lo:
                    v = c.coefficients[b, k : hi + 1]
                    n = int(np.count_nonzero(v))
                    c.coefficients[b, k : hi + 1] = _refined(v, bits[read.at : read.at + n], low)
                    read.at += n
                whole = _range(blocks[i + (k > lo) : i + many])
                v = c.coefficients[whole, lo : hi + 1]
                n = int(np.count_nonzero(v))
                c.coefficients[whole, lo : hi + 1] = _refined(v, bits[read.at : read.at + n], low)
                read.at += n
                i += many - 1
                break
            new = (1 << low) * (1 if read.number(1) else -1) if size else 0
            while k <= hi:
                v = c.coefficients[b, k]
                if v:
                    if read.number(1):
                        c.coefficients[b, k] += (1 << low) * (1 if v > 0 else -1)
                elif run:
                    run -= 1
                else:
                    c.coefficients[b, k] = new
                    k += 1
                    break
                k += 1
        i += 1


_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")


def read_progressive(data: bytes) -> Image:
    """Parse a progressive file and add up its scans. Raises ValueError for other files."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    image, codes, interval, at = Image(), {}, 0, 2
    across = down = 0
    while data[at + 1] != 0xD9:
        kind, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if kind == 0xFE:
            image.comment = body
        elif kind == 0xDB:
            while body:
                wide = body[0] >> 4
                n = 64 * (1 + wide)
                image.quantisers[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.int32)
                body = body[1 + n :]
        elif kind == 0xC4:
            while body:
                counts = body[1:17]
                codes[body[0]] = _codes(counts, body[17 : 17 + sum(counts)])
                body = body[17 + sum(counts) :]
        elif kind == 0xDD:
            interval = int.from_bytes(body, "big")
        elif kind == 0xC2:
            image.height, image.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            for i in range(body[5]):
                key, hv, table = body[6 + 3 * i : 9 + 3 * i]
                image.components[key] = Component(hv >> 4, hv & 15, table)
            most_h, most_v = max(c.h for c in image.components.values()), max(c.v for c in image.components.values())
            across, down = -(-image.width // (8 * most_h)), -(-image.height // (8 * most_v))
            for c in image.components.values():
                c.wide, c.high = across * c.h, down * c.v
                c.used_wide, c.used_high = -(-(-(-image.width * c.h // most_h)) // 8), -(-(-(-image.height * c.v // most_v)) // 8)
                c.coefficients = np.zeros((c.wide * c.high, 64), np.int16)
        elif kind == 0xDA:
            scan = [(image.components[body[1 + 2 * i]], body[2 + 2 * i]) for i in range(body[0])]
            lo, hi, approx = body[-3:]
            end = _MARKER.search(data, at)
            if not end:
                raise ValueError("a scan doesn't end")
            segments = [s.replace(b"\xff\x00", b"\xff") for s in _RESTART.split(data[at : end.start()])]
            at = end.start()
            _scan(scan, segments, codes, lo, hi, approx >> 4, approx & 15, interval, across, down)
        elif kind in (0xC0, 0xC1, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB):
            raise ValueError("not a Huffman-coded progressive file")
    return image


def _scan(scan: list[tuple[Component, int]], segments: list[bytes], codes: dict[int, dict[str, int]], lo: int, hi: int, high: int, low: int, interval: int, across: int, down: int) -> None:
    if len(scan) == 1:
        units = scan[0][0].rows()[:, None]
        owners = [0]
    else:
        units = _all_units(across, down, tuple((c.h, c.v) for c, _ in scan))
        owners = [i for i, (c, _) in enumerate(scan) for _ in range(c.h * c.v)]
    step = interval or len(units)
    for n, segment in enumerate(segments):
        part = units[n * step : (n + 1) * step]
        if lo:
            c, tables = scan[0]
            (_refine_ac if high else _first_ac)(c, part[:, 0], segment, codes[0x10 | tables & 15], lo, hi, low)
        elif high:
            bits = np.unpackbits(np.frombuffer(segment, np.uint8))[: part.size].reshape(part.shape).astype(np.int16) << low
            for j, owner in enumerate(owners):
                scan[owner][0].coefficients[part[:, j], 0] |= bits[:, j]
        else:
            values = _first_dc(_bits(segment), [codes[t >> 4] for _, t in scan], owners, len(part))
            for j, owner in enumerate(owners):
                scan[owner][0].coefficients[part[:, j], 0] = values[:, j] << low


def _first_dc(bits: str, codes: list[dict[str, int]], owners: list[int], units: int) -> np.ndarray:
    """units x owners: running sums of each component's differences."""
    lengths = [sorted({len(c) for c in x}) for x in codes]
    at, sums, out = 0, [0] * len(codes), []
    for _ in range(units):
        for owner in owners:
            known = codes[owner]
            for n in lengths[owner]:
                if (size := known.get(bits[at : at + n])) is not None:
                    break
            else:
                raise ValueError("not a Huffman code, or the segment ends early")
            at += n
            if size:
                x = int(bits[at : at + size], 2)
                at += size
                sums[owner] += x if x >> (size - 1) else x - (1 << size) + 1
            out.append(sums[owner])
    return np.array(out, np.int16).reshape(units, len(owners))


def _segment(kind: int, body: bytes) -> bytes:
    return bytes([0xFF, kind]) + (len(body) + 2).to_bytes(2, "big") + body


def _packed(bits: str) -> bytes:
    bits += "1" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\x00")


#: Sizes 0 to 8 of DC differences, as codes of four bits; one AC symbol, seven bits after no zero; runs of 2^0 to 2^14 blocks.
_TABLES = _segment(0xC4, bytes([0x00, 0, 0, 0, 9, *[0] * 12, *range(9)])) + _segment(0xC4, bytes([0x10, 1, *[0] * 15, 0x07])) + _segment(0xC4, bytes([0x11, 0, 0, 0, 15, *[0] * 12, *(n << 4 for n in range(15))]))
_START = b"\xff\xd8" + _segment(0xDB, bytes([0, *[1] * 64]))
#: The code and bits of each DC difference from -255 to 255.
_STEPS = [format(n, "04b") + (format(d if d > 0 else d + (1 << n) - 1, f"0{n}b") if n else "") for d in range(-255, 256) for n in [abs(d).bit_length()]]


def _scan_head(parts: list[int], table: int, lo: int, hi: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([len(parts), *(x for p in parts for x in (p, table)), lo, hi, high << 4 | low]))


def store_payload(payload: np.ndarray) -> bytes:
    """A progressive file that holds the payload (a positive multiple of 64 bytes) in its coefficients."""
    blocks = len(payload) // BLOCK
    units = -(-blocks // 6)
    across = -(-units // MOST_UNITS)
    down = -(-units // across)
    full = np.zeros((6 * across * down, BLOCK), np.uint8)
    full[:blocks] = payload.reshape(-1, BLOCK)
    n = across * down
    parts = {1: slice(0, 4 * n), 2: slice(4 * n, 5 * n), 3: slice(5 * n, 6 * n)}
    halves, odd = full >> 1, (full & 1) ^ (full < 128)
    frame = bytes([8, *(16 * down).to_bytes(2, "big"), *(16 * across).to_bytes(2, "big"), 3, 1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    out = [_START, _segment(0xFE, b"blocks=%d" % blocks), _segment(0xC2, frame), _TABLES]

    first = np.empty((n, 6), np.int16)  # of each unit, its blocks' first bytes
    first[:, :4] = full[parts[1], 0][_units(across, down, 2, 2)]
    first[:, 4], first[:, 5] = full[parts[2], 0], full[parts[3], 0]
    value = np.where(first >= 128, first, first - 255)
    half = value >> 1
    steps = half + 255
    steps[:, 1:4] -= half[:, :3]
    steps[1:, 0] -= half[:-1, 3]
    steps[1:, 4:] -= half[:-1, 4:]
    out += [_scan_head([1, 2, 3], 0x00, 0, 0, 0, 1), _packed("".join([_STEPS[d] for d in steps.ravel().tolist()]))]
    for key, lo, hi in ((1, 1, 5), (2, 1, 63), (3, 1, 63), (1, 6, 63)):
        out += [_scan_head([key], 0x00, lo, hi, 0, 1), halves[parts[key], lo : hi + 1].tobytes()]  # a code of one zero bit and seven bits: one byte
    out += [_scan_head([1, 2, 3], 0x00, 0, 0, 1, 0), np.packbits((value & 1).astype(np.uint8).ravel()).tobytes().replace(b"\xff", b"\xff\x00")]
    for key, own in parts.items():
        low_bits = odd[own, 1:]
        packed = []
        for i in range(0, len(low_bits), LONGEST_RUN):
            run = low_bits[i : i + LONGEST_RUN]
            power = len(run).bit_length() - 1
            head = format(power, "04b") + (format(len(run) - (1 << power), f"0{power}b") if power else "")
            packed += [np.frombuffer(head.encode(), np.uint8) - 48, run.ravel()]
        packed.append(np.ones(-sum(map(len, packed)) % 8, np.uint8))
        every = np.concatenate(packed)
        out += [_scan_head([key], 0x01, 1, 63, 1, 0), np.packbits(every).tobytes().replace(b"\xff", b"\xff\x00")]
    return b"".join([*out, b"\xff\xd9"])


def payload_of(image: Image) -> np.ndarray:
    """The bytes that store_payload put into the coefficients."""
    blocks = int(image.comment.removeprefix(b"blocks="))
    values = np.concatenate([c.coefficients for c in image.components.values()])[:blocks]
    return np.where(values > 0, values, values + np.int16(255)).astype(np.uint8).ravel()


def to_payload(text: np.ndarray) -> np.ndarray:
    """Zero bytes up to a positive multiple of 64."""
    out = np.zeros(max(1, -(-len(text) // BLOCK)) * BLOCK, np.uint8)
    out[: len(text)] = text
    return out


def stored_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each whole text (null: empty) as a progressive JPEG."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_slices(batch):
                media = [store_payload(to_payload(data[a:b])) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return id_and_text(docs).mapInArrow(store, "doc_id long, n_bytes long, media binary")


def decoded(media: DataFrame) -> DataFrame:
    """media (doc_id, n_bytes, media: progressive files) with payload (the bytes that store_payload put in, null in other files), height, width and rgb: the
    full-resolution tensor's unsigned bytes, row by row, three a pixel. Null media give nulls; equal files equal rows."""
    names = ["doc_id", "n_bytes", "media", "payload", "height", "width", "rgb"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal rows, size
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows, size = [], 0
            return out

        for batch in batches:
            for doc_id, n, data in zip(*(batch.column(c).to_pylist() for c in names[:3]), strict=True):
                if data is None:
                    rows.append((doc_id, n, None, None, None, None, None))
                    continue
                image = read_progressive(data)
                payload = payload_of(image).tobytes() if image.comment.startswith(b"blocks=") else None
                rgb = image.tensor()
                rows.append((doc_id, n, data, payload, image.height, image.width, rgb.tobytes()))
                size += rgb.nbytes
                if size > TENSOR_BYTES:
                    yield flush()
        if rows:
            yield flush()

    return media.select(*names[:3]).mapInArrow(decode, "doc_id long, n_bytes long, media binary, payload binary, height int, width int, rgb binary")


def _feature(rgb: np.ndarray, height: int, width: int) -> str:
    sums = rgb.reshape(-1, 3).sum(axis=0, dtype=np.int64)
    return f"{height}x{width} rgb " + " ".join(f"{int(x) / (height * width):.3f}" for x in sums)


def media_digests(media: DataFrame) -> DataFrame:
    """What media_features() says of decoded(media), made where the files are read back: no payload or tensor leaves the task."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, n, data in zip(batch.column("doc_id").to_pylist(), batch.column("n_bytes").to_pylist(), batch.column("media"), strict=True):
                data = data.as_py()
                if data is None:
                    rows.append((doc_id, n, *[None] * 6))
                    continue
                image = read_progressive(data)
                payload = payload_of(image).tobytes() if image.comment.startswith(b"blocks=") else None
                of_payload = (None, None, None) if payload is None else (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]))
                rows.append((doc_id, n, *of_payload, len(data), hashlib.sha256(data).hexdigest(), _feature(image.tensor(), image.height, image.width)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(digest, schema)


def channel_means(tensors: DataFrame) -> DataFrame:
    """tensors (as from decoded) with feature, the image's size and the means of the RGB tensor's channels, in place of rgb; null where rgb is."""
    keep = ["doc_id", "n_bytes", "media", "payload"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for high, wide, rgb in zip(batch.column("height").to_pylist(), batch.column("width").to_pylist(), batch.column("rgb"), strict=True):
                if high is None:
                    out.append(None)
                    continue
                out.append(_feature(np.frombuffer(rgb.as_buffer(), np.uint8), high, wide))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out, pa.string())], [*keep, "feature"])

    return tensors.mapInArrow(add, "doc_id long, n_bytes long, media binary, payload binary, feature string")


def media_features(tensors: DataFrame) -> DataFrame:
    """Digests of decoded(): doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature (see channel_means).

    Equal texts give equal values; an empty table an empty result.
    """
    return channel_means(tensors).select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -BLOCK, BLOCK)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
