"""Compressed-domain redaction, on files made by a small encoder with tables made by rule."""

import numpy as np
import pytest

from veilframe.operators import jpeg as J

QUANT = 4


def tables():
    dc = bytes([0] * 3 + [12] + [0] * 12) + bytes(range(12))  # twelve codes of four bits
    ac = [0, 0xF0] + [r << 4 | s for r in range(16) for s in range(1, 11)]
    return dc, bytes([0] * 8 + [len(ac)] + [0] * 7) + bytes(ac)  # codes of nine bits


def encode(planes, sampling, restart=0, ids=None):
    """planes: coefficient blocks (rows, cols, 64) of each component; sampling: (h, v) of each."""
    dc, ac = tables()
    seg = lambda code, body: bytes([0xFF, code]) + (len(body) + 2).to_bytes(2, "big") + body
    top_h, top_v = max(h for h, _ in sampling), max(v for _, v in sampling)
    single = len(planes) == 1
    mcu_rows, mcu_cols = planes[0].shape[0] // (1 if single else sampling[0][1]), planes[0].shape[1] // (1 if single else sampling[0][0])
    rows, cols = mcu_rows * 8 * (1 if single else top_v), mcu_cols * 8 * (1 if single else top_h)
    ids = ids or list(range(1, len(planes) + 1))
    head = b"\xff\xd8" + seg(0xDB, bytes([0]) + bytes([QUANT] * 64))
    head += seg(0xC0, bytes([8]) + rows.to_bytes(2, "big") + cols.to_bytes(2, "big") + bytes([len(planes)]) + b"".join(bytes([i, h << 4 | v, 0]) for i, (h, v) in zip(ids, sampling)))
    head += seg(0xC4, bytes([0]) + dc) + seg(0xC4, bytes([0x10]) + ac)
    if restart:
        head += seg(0xDD, restart.to_bytes(2, "big"))
    head += seg(0xDA, bytes([len(planes)]) + b"".join(bytes([i, 0]) for i in ids) + bytes([0, 63, 0]))
    image = J.parse(head)
    out, text, last, done = bytearray(head), [], [0] * len(planes), 0

    def flush(tail):
        joined = "".join(text)
        joined += "1" * (-len(joined) % 8)
        out.extend(int("1" + joined, 2).to_bytes(len(joined) // 8 + 1, "big")[1:].replace(b"\xff", b"\xff\x00") + bytes([0xFF, tail]))
        text.clear()

    total = mcu_rows * mcu_cols
    for m in range(total):
        for n, plane in enumerate(planes):
            h, v = (1, 1) if single else sampling[n]
            for j in range(v):
                for i in range(h):
                    block = plane[m // mcu_cols * v + j, m % mcu_cols * h + i]
                    text.append(J._difference(image.encode[0, 0], int(block[0]) - last[n]))
                    last[n], run = int(block[0]), 0
                    for k in range(1, 64):
                        if not block[k]:
                            run += 1
                            continue
                        while run > 15:
                            text.append(J._code_text(image.encode[1, 0], 0xF0))
                            run -= 16
                        size = abs(int(block[k])).bit_length()
                        value = int(block[k]) if block[k] > 0 else int(block[k]) + (1 << size) - 1
                        text.append(J._code_text(image.encode[1, 0], run << 4 | size) + format(value, f"0{size}b"))
                        run = 0
                    if run:
                        text.append(J._code_text(image.encode[1, 0], 0))
        if restart and (m + 1) % restart == 0 and m + 1 < total:
            flush(0xD0 + done % 8)
            done, last = done + 1, [0] * len(planes)
    flush(0xD9)
    return bytes(out), rows, cols


def decode(data):
    """Coefficient blocks in scan order: (component, 64 values)."""
    image = J.parse(data)
    plan = J.block_plan(image, np.ones((image.rows, image.cols), np.uint8))
    step, out = image.restart or len(plan), []
    for k, part in enumerate(J.segments(image.scan)):
        bits, last = J.Bits(part), [0] * len(image.components)
        for mcu in plan[k * step : (k + 1) * step]:
            for n, _ in mcu:
                block = np.zeros(64, int)
                last[n] += bits.number(bits.code(image.decode[0, 0]))
                block[0], at = last[n], 1
                while at < 64:
                    s = bits.code(image.decode[1, 0])
                    if not s & 15:
                        if s != 0xF0:
                            break
                        at += 16
                        continue
                    at += s >> 4
                    block[at] = bits.number(s & 15)
                    at += 1
                out.append((n, block))
    return out


@pytest.mark.parametrize("sampling,restart", [([(1, 1)], 0), ([(1, 1)] * 3, 0), ([(2, 2), (1, 1), (1, 1)], 0), ([(2, 1), (1, 1), (1, 1)], 3), ([(1, 1)], 2)])
def test_only_touched_blocks_change(sampling, restart):
    rng = np.random.default_rng(1)
    planes = []
    for h, v in sampling:
        p = np.where(rng.random((3 * v, 4 * h, 64)) < 0.1, rng.integers(-30, 31, (3 * v, 4 * h, 64)), 0)
        p[..., 0] = rng.integers(-200, 200, p.shape[:2])
        planes.append(p)
    data, rows, cols = encode(planes, sampling, restart)
    keep = np.ones((rows, cols), np.uint8)
    assert J.redact(data, keep) == data  # nothing to hide: not a bit changes
    keep[2:9, 5:20] = 0
    out = J.redact(data, keep)
    plan = [b for mcu in J.block_plan(J.parse(data), keep) for b in mcu]
    assert any(hide for _, hide in plan) and not all(hide for _, hide in plan)
    for (n, hide), (_, before), (_, after) in zip(plan, decode(data), decode(out), strict=True):
        if hide:
            assert after[0] == (-256 if n == 0 else 0) and not after[1:].any()
        else:
            assert (before == after).all()


def test_rgb_is_black_in_all_components():
    planes = [np.zeros((2, 2, 64), int) for _ in range(3)]
    data, rows, cols = encode(planes, [(1, 1)] * 3, ids=list(b"RGB"))
    assert {b[0] for _, b in decode(J.redact(data, np.zeros((rows, cols), np.uint8)))} == {-256}


@pytest.mark.parametrize("data", [b"", b"\xff\xd8\xff", b"\xff\xd8\xff\xc2\x00\x08" + b"\0" * 6])
def test_refuses_other_files(data):
    with pytest.raises(J.JpegError):
        J.redact(data, np.ones((1, 1), np.uint8))


def test_frames(spark):
    data, rows, cols = encode([np.full((2, 2, 64), 1)], [(1, 1)])
    df = spark.createDataFrame([(data, [(0, 0, 0, 8, 8)]), (b"no", [])], "frame binary, boxes array<struct<keep:int,x0:int,y0:int,x1:int,y1:int>>")
    from veilframe.operators.jpeg import redact_frames

    good, bad = redact_frames(df).collect()
    assert good["jpeg_error"] is None and [b[0] for _, b in decode(bytes(good["frame"]))][:2] == [-256, 1]
    assert bad["frame"] is None and bad["jpeg_error"]
