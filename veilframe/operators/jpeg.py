"""Redaction of baseline JPEG frames without decoding them to pixels.

Blocks that touch a masked pixel become black: their DC jumps to black and their AC
is empty. All other blocks keep their coefficients bit by bit; only a DC difference
after a redacted block is coded anew. So nothing outside the mask loses quality, and
the tables of the file stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Marker codes.
SOI, EOI, SOS, DQT, DHT, DRI, SOF0, APP14 = 0xD8, 0xD9, 0xDA, 0xDB, 0xC4, 0xDD, 0xC0, 0xEE
OTHER_FRAMES = (*range(0xC1, 0xC4), *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0))


class JpegError(ValueError):
    """Not a baseline file that can be redacted."""


@dataclass
class Component:
    ident: int
    h: int
    v: int
    quant: int
    dc: int = 0
    ac: int = 0


@dataclass
class Image:
    """Parsed headers; head is all bytes up to the entropy-coded data."""

    rows: int = 0
    cols: int = 0
    components: list[Component] = field(default_factory=list)
    quant: dict[int, int] = field(default_factory=dict)  # first (DC) entry of each table
    decode: dict[tuple[int, int], dict[tuple[int, int], int]] = field(default_factory=dict)
    encode: dict[tuple[int, int], dict[int, tuple[int, int]]] = field(default_factory=dict)
    restart: int = 0
    adobe: int | None = None
    head: bytes = b""
    scan: bytes = b""


def parse(data: bytes) -> Image:
    """Headers and the one scan of a baseline file."""
    if data[:2] != bytes([0xFF, SOI]):
        raise JpegError("no start of image")
    image, at = Image(), 2
    while True:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise JpegError("broken segments")
        code, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if code in OTHER_FRAMES:
            raise JpegError("not baseline")
        if code == SOF0:
            if body[0] != 8:
                raise JpegError("not 8 bits")
            image.rows, image.cols = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            image.components = [Component(body[i], body[i + 1] >> 4, body[i + 1] & 15, body[i + 2]) for i in range(6, 6 + 3 * body[5], 3)]
        elif code == DQT:
            while body:
                if body[0] >> 4:
                    raise JpegError("16-bit quantisation")
                image.quant[body[0] & 15] = body[1]
                body = body[65:]
        elif code == DHT:
            while body:
                counts = body[1:17]
                symbols = body[17 : 17 + sum(counts)]
                _table(image, (body[0] >> 4, body[0] & 15), counts, symbols)
                body = body[17 + sum(counts) :]
        elif code == DRI:
            image.restart = int.from_bytes(body[:2], "big")
        elif code == APP14 and body[:5] == b"Adobe":
            image.adobe = body[11]
        elif code == SOS:
            if not image.components or body[0] != len(image.components):
                raise JpegError("not one interleaved scan")
            for k in range(body[0]):
                part = next(c for c in image.components if c.ident == body[1 + 2 * k])
                part.dc, part.ac = body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15
            image.head, image.scan = data[:at], data[at:]
            return image


def _table(image: Image, key: tuple[int, int], counts: bytes, symbols: bytes) -> None:
    """Canonical codes: (length, code) to symbol, and back."""
    code, k, to, back = 0, 0, {}, {}
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            to[length, code] = symbols[k]
            back[symbols[k]] = (length, code)
            code, k = code + 1, k + 1
        code <<= 1
    image.decode[key], image.encode[key] = to, back


def segments(scan: bytes) -> list[bytes]:
    """Entropy-coded data between restart markers, without stuffing."""
    out, last, at = [], 0, 0
    while True:
        at = scan.find(b"\xff", at)
        if at < 0 or at + 1 >= len(scan):
            raise JpegError("no end of image")
        if scan[at + 1] == 0:
            at += 2
        elif 0xD0 <= scan[at + 1] <= 0xD7:
            out.append(scan[last:at].replace(b"\xff\x00", b"\xff"))
            at = last = at + 2
        else:
            out.append(scan[last:at].replace(b"\xff\x00", b"\xff"))
            return out


class Bits:
    """Reads codes from a segment kept as one text of 0 and 1."""

    def __init__(self, data: bytes):
        self.text = bin(int.from_bytes(b"\x01" + data, "big"))[3:]
        self.at = 0

    def code(self, table: dict[tuple[int, int], int]) -> int:
        value = 0
        for length in range(1, 17):
            if self.at >= len(self.text):
                raise JpegError("data end early")
            value = value << 1 | (self.text[self.at] == "1")
            self.at += 1
            if (length, value) in table:
                return table[length, value]
        raise JpegError("unknown code")

    def number(self, size: int) -> int:
        """A signed value of a size category."""
        if not size:
            return 0
        value = int(self.text[self.at : self.at + size], 2)
        self.at += size
        return value if value >> (size - 1) else value - (1 << size) + 1


def _skip_ac(bits: Bits, table: dict[tuple[int, int], int]) -> str:
    """The bits of a block's AC part, as they are."""
    start, k = bits.at, 1
    while k < 64:
        symbol = bits.code(table)
        if not symbol & 15:
            if symbol != 0xF0:
                break
            k += 16
            continue
        bits.at += symbol & 15
        k += (symbol >> 4) + 1
    return bits.text[start : bits.at]


def _code_text(table: dict[int, tuple[int, int]], symbol: int) -> str:
    if symbol not in table:
        raise JpegError(f"the file's table has no code for {symbol}")
    length, code = table[symbol]
    return format(code, f"0{length}b")


def _difference(table: dict[int, tuple[int, int]], value: int) -> str:
    size = abs(value).bit_length()
    text = _code_text(table, size)
    return text + (format(value if value > 0 else value + (1 << size) - 1, f"0{size}b") if size else "")


def block_plan(image: Image, keep: np.ndarray) -> list[list[tuple[int, bool]]]:
    """For each MCU its blocks: (component number, whether it touches a masked pixel)."""
    top_h, top_v = max(c.h for c in image.components), max(c.v for c in image.components)
    single = len(image.components) == 1
    if single:
        top_h = top_v = 1
    across, down = -(-image.cols // (8 * top_h)), -(-image.rows // (8 * top_v))
    hidden = np.zeros((down * 8 * top_v, across * 8 * top_h), bool)
    hidden[: image.rows, : image.cols] = keep[: image.rows, : image.cols] == 0
    plan: list[list[tuple[int, bool]]] = [[] for _ in range(across * down)]
    for number, c in enumerate(image.components):
        h, v = (1, 1) if single else (c.h, c.v)
        high, wide = 8 * top_v // v, 8 * top_h // h
        touched = hidden.reshape(down * v, high, across * h, wide).any(axis=(1, 3))
        for y in range(down):
            for x in range(across):
                plan[y * across + x] += [(number, bool(touched[y * v + j, x * h + i])) for j in range(v) for i in range(h)]
    return plan


def redact(data: bytes, keep: np.ndarray) -> bytes:
    """The file with every block black that touches a pixel where keep is 0."""
    image = parse(data)
    if keep.shape[0] < image.rows or keep.shape[1] < image.cols:
        raise JpegError("the mask is smaller than the frame")
    plan = block_plan(image, keep)
    rgb = len(image.components) == 3 and (image.adobe == 0 or bytes(c.ident for c in image.components) == b"RGB")
    black = [round(-1024 / image.quant[c.quant]) if n == 0 or rgb else 0 for n, c in enumerate(image.components)]
    step = image.restart or len(plan)
    parts = segments(image.scan)
    if len(parts) != -(-len(plan) // step):
        raise JpegError("restart intervals do not match the frame")
    out = bytearray(image.head)
    for k, part in enumerate(parts):
        bits, text = Bits(part), []
        old, new = [0] * len(black), [0] * len(black)
        for mcu in plan[k * step : (k + 1) * step]:
            for n, hide in mcu:
                c = image.components[n]
                old[n] += bits.number(bits.code(image.decode[0, c.dc]))
                rest = _skip_ac(bits, image.decode[1, c.ac])
                value = black[n] if hide else old[n]
                text += [_difference(image.encode[0, c.dc], value - new[n]), _code_text(image.encode[1, c.ac], 0) if hide else rest]
                new[n] = value
        joined = "".join(text)
        joined += "1" * (-len(joined) % 8)
        out += int("1" + joined, 2).to_bytes(len(joined) // 8 + 1, "big")[1:].replace(b"\xff", b"\xff\x00")
        out += bytes([0xFF, 0xD0 + k % 8]) if k + 1 < len(parts) else bytes([0xFF, EOI])
    return bytes(out)


def redact_frames(df: DataFrame, frame: str = "frame", boxes: str = "boxes", error: str = "jpeg_error") -> DataFrame:
    """df with its JPEG frames redacted by their boxes; a frame that cannot be is null, with the reason beside it."""
    from pyspark.sql.types import StringType, StructField, StructType

    from .pixels import keep_mask

    schema = StructType([*df.schema.fields, StructField(error, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                part = batch.slice(at, 16)
                place = part.schema.get_field_index(frame)
                out, errors = [], []
                for raw, found in zip(part.column(place).to_pylist(), part.column(part.schema.get_field_index(boxes)).to_pylist(), strict=True):
                    try:
                        image = parse(raw or b"")
                        mask = keep_mask(image.rows, image.cols, [(b["keep"], b["x0"], b["y0"], b["x1"], b["y1"]) for b in found or []])
                        out.append(redact(raw, mask))
                        errors.append(None)
                    except JpegError as e:
                        out.append(None)
                        errors.append(str(e))
                part = part.set_column(place, frame, pa.array(out, pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(errors, pa.string())], [*part.schema.names, error])

    return df.mapInArrow(run, schema)
