"""PNG files with the standard library only: all kinds are read; 8-bit gray, RGB and RGBA are written."""

from __future__ import annotations

import struct
import zlib

import numpy as np

_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
_KINDS = {1: 0, 3: 2, 4: 6}
# First row and column, row and column steps of the seven passes of an interlaced file.
_PASSES = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(raster: np.ndarray) -> bytes:
    """A uint8 raster of shape (h, w), (h, w, 3) or (h, w, 4) as PNG bytes."""
    pixels = raster[..., None] if raster.ndim == 2 else raster
    h, w, c = pixels.shape
    rows = np.zeros((h, 1 + w * c), np.uint8)
    rows[:, 1:] = pixels.reshape(h, w * c)
    head = struct.pack(">IIBBBBB", w, h, 8, _KINDS[c], 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + _chunk(b"IEND", b"")


def decode(data: bytes) -> np.ndarray:
    """PNG bytes as a uint8 raster of shape (h, w), (h, w, 2), (h, w, 3) or (h, w, 4); ValueError for anything else.

    Any bit depth, palettes (as RGB, as RGBA if any entry is transparent) and
    interlaced files.  Of 16 bits the upper 8 are kept, fewer than 8 are spread
    over the whole range.
    """
    if data[:8] != _SIGNATURE:
        raise ValueError("not a PNG file")
    at, parts, head, palette, clear = 8, [], None, None, None
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        at += 12 + n
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"tRNS":
            clear = np.frombuffer(body, np.uint8)
        elif kind == b"IDAT":
            parts.append(body)
        elif kind == b"IEND":
            break
    if head is None or head[2] not in (1, 2, 4, 8, 16) or head[3] not in _CHANNELS or head[6] > 1 or head[3] == 3 and palette is None:
        raise ValueError("unsupported PNG file")
    w, h, depth, colour, _, _, interlaced = head
    c = _CHANNELS[colour]
    raw = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8)
    if not interlaced:
        samples, _ = _samples(raw, h, w, depth, c)
    else:
        samples = np.zeros((h, w, c), np.uint16 if depth == 16 else np.uint8)
        for y0, x0, dy, dx in _PASSES:
            rows, columns = len(range(y0, h, dy)), len(range(x0, w, dx))
            if rows and columns:
                samples[y0::dy, x0::dx], used = _samples(raw, rows, columns, depth, c)
                raw = raw[used:]
    if colour == 3:
        indexes = np.minimum(samples[..., 0], len(palette) - 1)
        if clear is None:
            return palette[indexes]
        alpha = np.full(len(palette), 255, np.uint8)
        alpha[: len(clear)] = clear[: len(palette)]
        return np.concatenate([palette[indexes], alpha[indexes][..., None]], axis=2)
    if depth == 16:
        samples = (samples >> 8).astype(np.uint8)
    elif depth < 8:
        samples = samples * np.uint8(255 // ((1 << depth) - 1))
    return samples[..., 0] if c == 1 else samples


def _samples(raw: np.ndarray, h: int, w: int, depth: int, c: int) -> tuple[np.ndarray, int]:
    """(samples of shape (h, w, c), bytes used) of one filtered image at the start of ``raw``."""
    line = (w * c * depth + 7) // 8
    step = max(1, c * depth // 8)
    used = h * (1 + line)
    rows = raw[:used].reshape(h, 1 + line)
    plain = _unfiltered(rows[:, 0], rows[:, 1:], step)
    if depth == 16:
        plain = plain.reshape(h, -1, 2).astype(np.uint16)
        plain = (plain[..., 0] << 8) | plain[..., 1]
    elif depth < 8:
        bits = np.unpackbits(plain, axis=1).reshape(h, -1, depth)
        plain = bits @ (1 << np.arange(depth - 1, -1, -1)).astype(np.uint8)
    return plain[:, : w * c].reshape(h, w, c), used


def _unfiltered(kinds: np.ndarray, rows: np.ndarray, step: int) -> np.ndarray:
    """Undo the row filters; ``step`` is the distance in bytes to the sample on the left."""
    if kinds.max(initial=0) > 4:
        raise ValueError("unknown PNG filter")
    h, line = rows.shape
    cells = -(-line // step)
    padded = np.zeros((h, cells * step), np.uint8)
    padded[:, :line] = rows
    values = padded.reshape(h, cells, step)
    if not np.isin(kinds, (3, 4)).any():
        out = values.copy()
        for y in range(h):
            if kinds[y] == 1:
                out[y] = np.cumsum(values[y], axis=0, dtype=np.uint8)
            elif kinds[y] == 2 and y:
                out[y] += out[y - 1]
        return out.reshape(h, -1)[:, :line]
    # a sample needs those on its left, above and above left: all samples with one y + x at a time.
    # made[d, y + 1] is the sample of row y and column d - y
    made = np.zeros((h + cells, h + 1, step), np.uint8)
    flat = values.reshape(h * cells, step)
    for d in range(h + cells - 1):
        first, last = max(0, d - cells + 1), min(h - 1, d)
        span = slice(first, last + 1)
        left = made[d - 1, first + 1 : last + 2].astype(np.int16) if d else np.zeros((last - first + 1, step), np.int16)
        up = made[d - 1, span].astype(np.int16) if d else left
        corner = made[d - 2, span].astype(np.int16) if d > 1 else np.zeros_like(left)
        kind = kinds[span, None]
        a, b = np.abs(up - corner), np.abs(left - corner)
        c = np.abs(left + up - 2 * corner)
        nearest = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        guess = np.select([kind == 1, kind == 2, kind == 3, kind == 4], [left, up, (left + up) >> 1, nearest], 0)
        at = np.arange(first, last + 1)
        made[d, first + 1 : last + 2] = (flat[at * (cells - 1) + d] + guess).astype(np.uint8)
    out = np.empty((h, cells, step), np.uint8)
    for y in range(h):
        out[y] = made[y : y + cells, y + 1]
    return out.reshape(h, -1)[:, :line]
