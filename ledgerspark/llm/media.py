"""Media columns: progressive JPEG, read and written in numpy.

The reader accumulates spectral-selection and successive-approximation scans into coefficient arrays, inverse-
transforms blocks, upsamples chroma and gives full-resolution RGB. It decodes any Huffman-coded progressive
stream of 8-bit samples with whole sampling ratios bit by bit; scans whose table leaves every coefficient one code of
one length, as the writer makes them, are decoded as arrays.

The writer stores a byte string without loss: the format's unit is the quantised coefficient, one per byte. Byte b
is the coefficient of size 8 whose magnitude bits are b (128 to 255, or -255 to -128), so a coefficient is never 0.
Scans: DC with a restart after each block; AC without the lowest bit, luma in two spectral bands; AC refinements.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerspark.llm.arrow import append, pick

UNIT = 64
MCU_BLOCKS = 6
MCU_BYTES = MCU_BLOCKS * UNIT
#: Bands (first, last coefficient) of the first AC scans by component; one refinement of all AC follows each.
BANDS = {1: ((1, 5), (6, 63)), 2: ((1, 63),), 3: ((1, 63),)}
LONGEST_RUN = (1 << 15) - 1


def _zigzag() -> np.ndarray:
    """Natural index (8 * row + column) of each zigzag place."""
    cells = [(r, c) for r in range(8) for c in range(8)]
    cells.sort(key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([8 * r + c for r, c in cells])


ZIGZAG = _zigzag()
_K = np.arange(8)
BASIS = (np.where(_K == 0, np.sqrt(0.125), 0.5)[:, None] * np.cos((2 * _K[None, :] + 1) * _K[:, None] * np.pi / 16)).astype(np.float32)


@dataclass
class Component:
    ident: int
    across: int
    down: int
    quant: int
    wide: int = 0
    high: int = 0
    padded: int = 0
    coef: np.ndarray = field(default_factory=lambda: np.zeros((0, 64), np.int32))


@dataclass
class Image:
    """Coefficients by component (blocks in raster order, zigzag places), RGB tensor (height, width, 3), comments."""

    width: int
    height: int
    components: list[Component]
    rgb: np.ndarray | None
    comments: list[bytes]


# --- writing -------------------------------------------------------------------------------------------------


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _stuffed(data: np.ndarray) -> bytes:
    at = np.flatnonzero(data == 0xFF)
    return (np.insert(data, at + 1, 0) if len(at) else data).tobytes()


def _table(kind: int, ident: int, counts: dict[int, int], symbols: bytes) -> bytes:
    return bytes([kind << 4 | ident]) + bytes(counts.get(k, 0) for k in range(1, 17)) + symbols


def _grid(mcus: int) -> tuple[int, int]:
    """MCUs across and down: about 64 across until the height is at its limit."""
    down = -(-mcus // 64)
    if down > 4095:
        down = -(-mcus // 4095)
    return -(-mcus // down), down


def _scan(ident: int, table: int, first: int, last: int, high: int, low: int, data: bytes) -> bytes:
    return _segment(0xDA, bytes([1, ident, table, first, last, high << 4 | low])) + data


def _dc_data(units: np.ndarray) -> bytes:
    """An 8-bit code and the magnitude byte per block, with a restart marker between blocks."""
    n = len(units)
    out = np.zeros((n, 5), np.uint8)
    out[:, 1] = units[:, 0]
    out[:, 3] = 0xFF
    out[:, 4] = 0xD0 + np.arange(n) % 8
    keep = np.ones((n, 5), bool)
    keep[:, 2] = out[:, 1] == 0xFF
    keep[-1, 3:] = False
    return out[keep].tobytes()


def _refinement_data(units: np.ndarray) -> bytes:
    """End-of-band runs over all blocks (a 4-bit code, the run's low bits), each followed by the blocks' lowest bits."""
    low = (units[:, 1:] & 1) ^ (units[:, 1:] < 128)
    bits, at = [], 0
    while at < len(units):
        run = min(LONGEST_RUN, len(units) - at)
        size = run.bit_length() - 1
        head = size << size | (run - (1 << size))
        bits.append(np.array([head >> k & 1 for k in range(size + 3, -1, -1)], np.uint8))
        bits.append(low[at : at + run].ravel())
        at += run
    every = np.concatenate(bits).astype(np.uint8)
    return _stuffed(np.packbits(np.concatenate([every, np.ones(-len(every) % 8, np.uint8)])))


_HEAD_TABLES = _segment(0xDB, bytes([0]) + b"\x01" * 64)
_CODES = _segment(0xC4, _table(0, 0, {8: 1}, b"\x08") + _table(1, 0, {1: 1}, b"\x07") + _table(1, 1, {4: 15}, bytes(n << 4 for n in range(15))))


def store(payload: bytes) -> bytes:
    """A progressive JPEG that holds ``payload`` (a positive multiple of UNIT bytes) in its coefficients."""
    if not payload or len(payload) % UNIT:
        raise ValueError("payload must be a positive multiple of 64 bytes")
    across, down = _grid(-(-len(payload) // MCU_BYTES))
    units = np.zeros(across * down * MCU_BYTES, np.uint8)
    units[: len(payload)] = np.frombuffer(payload, np.uint8)
    units = units.reshape(-1, UNIT)
    n = across * down
    parts = {1: units[: 4 * n], 2: units[4 * n : 5 * n], 3: units[5 * n :]}
    frame = struct.pack(">BHHB", 8, 16 * down, 16 * across, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    out = [b"\xff\xd8", _segment(0xFE, b"payload " + struct.pack(">Q", len(payload))), _HEAD_TABLES, _segment(0xC2, frame), _CODES, _segment(0xDD, b"\x00\x01")]
    for ident, own in parts.items():
        out.append(_scan(ident, 0, 0, 0, 0, 0, _dc_data(own)))
    out.append(_segment(0xDD, b"\x00\x00"))
    for ident, own in parts.items():
        for first, last in BANDS[ident]:
            out.append(_scan(ident, 0, first, last, 0, 1, np.right_shift(own[:, first : last + 1], 1).tobytes()))
        out.append(_scan(ident, 1, 1, 63, 1, 0, _refinement_data(own)))
    out.append(b"\xff\xd9")
    return b"".join(out)


# --- reading -------------------------------------------------------------------------------------------------


class _Bits:
    """Bits of one restart interval, most significant first; ones are read past its end."""

    def __init__(self, data: np.ndarray):
        self.bits = np.unpackbits(data).tolist()
        self.at = 0

    def take(self, n: int) -> int:
        value = 0
        for _ in range(n):
            value = value << 1 | (self.bits[self.at] if self.at < len(self.bits) else 1)
            self.at += 1
        return value

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.take(1)
            if (n, code) in codes:
                return codes[n, code]
        raise ValueError("no such code")


def _extend(value: int, size: int) -> int:
    return value if not size or value >> (size - 1) else value - (1 << size) + 1


def _codes(counts: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    found, code, at = {}, 0, 0
    for n, k in enumerate(counts, 1):
        for _ in range(k):
            found[n, code] = symbols[at]
            code, at = code + 1, at + 1
        code <<= 1
    return found


def _intervals(raw: np.ndarray) -> list[np.ndarray]:
    """Entropy-coded data without stuffing, by restart interval."""
    at = np.flatnonzero(raw[:-1] == 0xFF)
    restart = at[raw[at + 1] != 0]
    found, start = [], 0
    for stop in [*restart, len(raw)]:
        part = raw[start:stop]
        stuffed = np.flatnonzero(part[:-1] == 0xFF) + 1
        found.append(np.delete(part, stuffed) if len(stuffed) else part)
        start = stop + 2
    return found


@dataclass
class _Scan:
    parts: list[tuple[Component, dict, dict]]
    first: int
    last: int
    high: int
    low: int
    restart: int


def _dc_array(scan: _Scan, raw: np.ndarray) -> bool:
    """One component, a restart after each block, one code of 8 bits for size 8."""
    (part, codes, _), = scan.parts
    if scan.restart != 1 or scan.high or codes != {(8, 0): 8}:
        return False
    marks = np.zeros(len(raw), bool)
    at = np.flatnonzero(raw[:-1] == 0xFF)
    follow = raw[at + 1]
    marks[at + 1] = True
    marks[at[follow != 0]] = True
    clean = raw[~marks]
    n = part.wide * part.high
    if len(clean) != 2 * n:
        return False
    b = clean[1::2].astype(np.int32)
    part.coef[_own_blocks(part), 0] = np.where(b >= 128, b, b - 255) << scan.low
    return True


def _ac_array(scan: _Scan, raw: np.ndarray) -> bool:
    """One code of one bit for a coefficient of size 7 with no zeros before it: a byte per coefficient."""
    (part, _, codes), = scan.parts
    width, n = scan.last - scan.first + 1, part.wide * part.high
    if scan.restart or scan.high or codes != {(1, 0): 7} or len(raw) != n * width:
        return False
    b = raw.astype(np.int32).reshape(n, width)
    part.coef[_own_blocks(part), scan.first : scan.last + 1] = np.where(b >= 64, b, b - 127) * (1 << scan.low)
    return True


def _refine_array(scan: _Scan, raw: np.ndarray) -> bool:
    """All coefficients of the band are known not to be 0, and codes are 4-bit ends of band: runs of correction bits."""
    (part, _, codes), = scan.parts
    width, n = scan.last - scan.first + 1, part.wide * part.high
    if scan.restart or scan.high != scan.low + 1 or codes != {(4, k): k << 4 for k in range(15)}:
        return False
    rows = _own_blocks(part)
    band = part.coef[rows, scan.first : scan.last + 1]
    if not band.all():
        return False
    bits = np.unpackbits(_intervals(raw)[0])
    step, at, done = np.empty((n, width), np.int32), 0, 0
    while done < n:
        size = int(bits[at : at + 4] @ (8, 4, 2, 1))
        run = 1
        for k in range(size):
            run = run << 1 | int(bits[at + 4 + k])
        at += 4 + size
        step[done : done + run] = bits[at : at + run * width].reshape(run, width)
        at, done = at + run * width, done + run
    part.coef[rows, scan.first : scan.last + 1] = band + np.sign(band) * (step << scan.low)
    return True


def _own_blocks(part: Component) -> np.ndarray | slice:
    """Rows of a component's blocks without those that only fill up its MCUs."""
    if part.padded == part.wide:
        return slice(0, part.wide * part.high)
    return (np.arange(part.high)[:, None] * part.padded + np.arange(part.wide)).ravel()


def _units(scan: _Scan, across: int, down: int) -> list[list[tuple[int, int]]]:
    """(part, block) in the scan's order, by MCU."""
    if len(scan.parts) == 1:
        part = scan.parts[0][0]
        return [[(0, r * part.padded + c)] for r in range(part.high) for c in range(part.wide)]
    return [[(k, (y * p.down + r) * p.padded + x * p.across + c) for k, (p, _, _) in enumerate(scan.parts) for r in range(p.down) for c in range(p.across)] for y in range(down) for x in range(across)]


def _bit_by_bit(scan: _Scan, raw: np.ndarray, across: int, down: int) -> None:
    """Any progressive scan."""
    mcus = _units(scan, across, down)
    step = scan.restart or max(1, len(mcus))
    pieces = _intervals(raw)
    for k in range(0, len(mcus), step):
        bits = _Bits(pieces[k // step])
        before, run = [0] * len(scan.parts), 0
        for p, block in (u for mcu in mcus[k : k + step] for u in mcu):
            part, dc, ac = scan.parts[p]
            own = part.coef[block]
            if scan.first == 0:
                if scan.high:
                    own[0] |= bits.take(1) << scan.low
                else:
                    size = bits.symbol(dc)
                    before[p] += _extend(bits.take(size), size)
                    own[0] = before[p] << scan.low
            elif scan.high:
                run = _refine_block(own, scan, bits, ac, run)
            else:
                run = _first_block(own, scan, bits, ac, run)


def _first_block(own: np.ndarray, scan: _Scan, bits: _Bits, codes: dict, run: int) -> int:
    if run:
        return run - 1
    k = scan.first
    while k <= scan.last:
        zeros, size = divmod(bits.symbol(codes), 16)
        if size:
            k += zeros
            value = _extend(bits.take(size), size)
            own[k] = (abs(value) << scan.low) * (1 if value > 0 else -1)
            k += 1
        elif zeros == 15:
            k += 16
        else:
            return (1 << zeros) + bits.take(zeros) - 1
    return 0


def _refine_block(own: np.ndarray, scan: _Scan, bits: _Bits, codes: dict, run: int) -> int:
    def correct(k: int) -> None:
        if bits.take(1):
            own[k] += (1 << scan.low) * (1 if own[k] > 0 else -1)

    k = scan.first
    while k <= scan.last and not run:
        zeros, size = divmod(bits.symbol(codes), 16)
        new = 0
        if size:
            new = (1 if bits.take(1) else -1) << scan.low
        elif zeros < 15:
            run = (1 << zeros) + bits.take(zeros)
            break
        while k <= scan.last:
            if own[k]:
                correct(k)
            elif zeros:
                zeros -= 1
            else:
                if new:
                    own[k] = new
                k += 1
                break
            k += 1
    if run:
        for j in range(k, scan.last + 1):
            if own[j]:
                correct(j)
        return run - 1
    return 0


def read(data: bytes, pixels: bool = True, arrays: bool = True) -> Image:
    """Decode a progressive JPEG; ``arrays=False`` decodes every scan bit by bit."""
    raw = np.frombuffer(data, np.uint8)
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG stream")
    quants: dict[int, np.ndarray] = {}
    codes: dict[int, dict] = {}
    parts: dict[int, Component] = {}
    comments, restart, width, height, across, down = [], 0, 0, 0, 0, 0
    at = 2
    while data[at + 1] != 0xD9:
        marker, length = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body, at = data[at + 4 : at + 2 + length], at + 2 + length
        if marker == 0xFE:
            comments.append(body)
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quants[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.float32)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                codes[body[0]] = _codes(body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            restart = int.from_bytes(body, "big")
        elif marker == 0xC2:
            _, height, width, n = struct.unpack(">BHHB", body[:6])
            for k in range(n):
                ident, sampling, quant = body[6 + 3 * k : 9 + 3 * k]
                parts[ident] = Component(ident, sampling >> 4, sampling & 15, quant)
            most = max(p.across for p in parts.values()), max(p.down for p in parts.values())
            across, down = -(-width // (8 * most[0])), -(-height // (8 * most[1]))
            for p in parts.values():
                p.wide, p.high = -(-width * p.across // (8 * most[0])), -(-height * p.down // (8 * most[1]))
                p.padded = across * p.across
                p.coef = np.zeros((p.padded * down * p.down, 64), np.int32)
        elif marker == 0xDA:
            n = body[0]
            own = [(parts[body[1 + 2 * k]], codes.get(body[2 + 2 * k] >> 4, {}), codes.get(16 | body[2 + 2 * k] & 15, {})) for k in range(n)]
            first, last, approx = body[1 + 2 * n : 4 + 2 * n]
            scan = _Scan(own, first, last, approx >> 4, approx & 15, restart)
            stop = at
            while True:
                stop = data.index(b"\xff", stop)
                if data[stop + 1] and not 0xD0 <= data[stop + 1] <= 0xD7:
                    break
                stop += 2
            entropy = raw[at:stop]
            quick = _dc_array if first == 0 else _refine_array if scan.high else _ac_array
            if not (arrays and n == 1 and quick(scan, entropy)):
                _bit_by_bit(scan, entropy, across, down)
            at = stop
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("only progressive Huffman streams are read")
    image = Image(width, height, list(parts.values()), None, comments)
    if pixels:
        image.rgb = _rgb(image, quants)
    return image


def _plane(part: Component, quant: np.ndarray) -> np.ndarray:
    """Samples of a component: dequantised, inverse-transformed, level-shifted, clipped."""
    natural = np.empty(part.coef.shape, np.float32)
    natural[:, ZIGZAG] = part.coef * quant
    blocks = BASIS.T @ natural.reshape(-1, 8, 8) @ BASIS
    blocks += 128.5
    np.clip(blocks, 0, 255, out=blocks)
    rows = len(blocks) // part.padded
    return blocks.astype(np.uint8).reshape(rows, part.padded, 8, 8).swapaxes(1, 2).reshape(8 * rows, 8 * part.padded)


def _rgb(image: Image, quants: dict[int, np.ndarray]) -> np.ndarray:
    across, down = max(p.across for p in image.components), max(p.down for p in image.components)
    planes = []
    for p in image.components:
        plane = _plane(p, quants[p.quant])
        planes.append(np.repeat(np.repeat(plane, down // p.down, 0), across // p.across, 1)[: image.height, : image.width])
    if len(planes) == 1:
        return np.repeat(planes[0][:, :, None], 3, 2)
    y, cb, cr = (x.astype(np.float32) for x in planes)
    cb -= 128
    cr -= 128
    out = np.empty((*y.shape, 3), np.uint8)
    for k, plane in enumerate((y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb)):
        plane += 0.5
        out[:, :, k] = np.clip(plane, 0, 255, out=plane)
    return out


def payload_of(image: Image) -> bytes:
    """The bytes that store() put into an image's coefficients."""
    marks = [c for c in image.comments if c.startswith(b"payload ")]
    if not marks:
        raise ValueError("no payload is marked")
    length = struct.unpack(">Q", marks[0][8:16])[0]
    units = np.concatenate([p.coef[_own_blocks(p)].ravel() for p in image.components])
    return np.where(units > 0, units, units + 255).astype(np.uint8)[:length].tobytes()


def padded(text: bytes) -> bytes:
    """With bytes 0 up to a positive multiple of UNIT."""
    return text + b"\0" * (-len(text) % UNIT if text else UNIT)


def feature(rgb: np.ndarray) -> str:
    """Means of the three channels and the share of samples in each quarter of the range."""
    flat = rgb.reshape(-1, 3)
    means = flat.sum(0, dtype=np.int64) / len(flat)
    shares = np.bincount(rgb.ravel() >> 6, minlength=4) / rgb.size
    return ",".join(f"{x:.4f}" for x in (*means, *shares))


def media_columns(docs: DataFrame, text_col: str = "text", tensors: bool = True) -> DataFrame:
    """``docs`` with what storing each text as a progressive JPEG gives (input columns of these names are replaced).

    ``n_bytes, payload_bytes long, payload_sha256 string, tail_crc32 long`` (of the payload read back from the
    stored bytes), ``media_bytes long, media_sha256, feature string``, of the decoded tensor ``height, width long, rgb_sha256
    string`` (of its bytes, row-major height x width x 3), and with ``tensors`` also ``media binary, rgb binary``. A null text is an empty one, whose payload is
    64 zeros. Equal texts get equal values. A text is one image, so up to about 6 GB.
    """
    kinds = [("n_bytes", T.LongType()), ("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType()), ("height", T.LongType()), ("width", T.LongType()), ("rgb_sha256", T.StringType())]
    if tensors:
        kinds += [("media", T.BinaryType()), ("rgb", T.BinaryType())]

    def compute(batch: pa.RecordBatch) -> list:
        out: list[list] = [[] for _ in kinds]
        for value in pick(batch, text_col):
            text = (value.as_py() or "").encode()
            media = store(padded(text))
            image = read(media)
            payload = payload_of(image)
            row = [len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), feature(image.rgb), image.height, image.width, hashlib.sha256(image.rgb).hexdigest()]
            if tensors:
                row += [media, image.rgb.tobytes()]
            for column, x in zip(out, row, strict=True):
                column.append(x)
        return out

    return append(docs, [T.StructField(n, k) for n, k in kinds], compute)
