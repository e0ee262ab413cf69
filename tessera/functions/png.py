"""PNG images as numpy arrays: a decoder and an encoder for eight bits a sample, without interlacing."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
# fixed values: samples of a pixel by colour type (gray, RGB, palette, gray with alpha, RGBA)
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def chunks(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(kind, data) of each chunk up to the end mark."""
    if not content.startswith(SIGNATURE):
        raise ValueError("not a PNG image")
    at = len(SIGNATURE)
    while at + 12 <= len(content):
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        yield kind, content[at + 8 : at + 8 + size]
        at += 12 + size
        if kind == b"IEND":
            return


def _unfiltered(data: np.ndarray, rows: int, width: int, step: int) -> np.ndarray:
    """Undo the row filters. Two of the five run along the row, sample by sample."""
    out = np.zeros((rows, width), np.uint8)
    above = np.zeros(width, np.uint8)
    for r in range(rows):
        kind, line = data[r, 0], data[r, 1:]
        if kind == 1:
            line = np.cumsum(line.reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
        elif kind == 2:
            line = line + above
        elif kind in (3, 4):
            line, up = line.astype(int).tolist(), above.astype(int).tolist()
            for k in range(width):
                left, corner = (line[k - step], up[k - step]) if k >= step else (0, 0)
                if kind == 3:
                    guess = (left + up[k]) // 2
                else:
                    p = left + up[k] - corner
                    guess = min((abs(p - left), 0, left), (abs(p - up[k]), 1, up[k]), (abs(p - corner), 2, corner))[2]
                line[k] = (line[k] + guess) & 255
            line = np.asarray(line, np.uint8)
        elif kind:
            raise ValueError(f"unknown filter {kind}")
        out[r] = above = line
    return out


def decode(content: bytes) -> np.ndarray:
    """(height, width, bands) of an image; a palette becomes RGB."""
    found: dict[bytes, bytes] = {}
    for kind, data in chunks(content):
        found[kind] = found.get(kind, b"") + data if kind == b"IDAT" else data
    width, height, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", found[b"IHDR"])
    if depth != 8 or interlaced or colour not in SAMPLES:
        raise ValueError("only eight bits a sample without interlacing")
    bands = SAMPLES[colour]
    raw = np.frombuffer(zlib.decompress(found[b"IDAT"]), np.uint8).reshape(height, width * bands + 1)
    pixels = _unfiltered(raw, height, width * bands, bands).reshape(height, width, bands)
    return np.frombuffer(found[b"PLTE"], np.uint8).reshape(-1, 3)[pixels[..., 0]] if colour == 3 else pixels


def encode(pixels: np.ndarray, texts: dict[str, str] | None = None) -> bytes:
    """An image of one to four bands, with texts beside it."""
    height, width, bands = pixels.shape
    colour = next(c for c, n in SAMPLES.items() if n == bands and c != 3)
    raw = np.zeros((height, width * bands + 1), np.uint8)
    raw[:, 1:] = pixels.reshape(height, -1)
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    noted = b"".join(part(b"iTXt", f"{k}\0\0\0\0\0{v}".encode()) for k, v in (texts or {}).items())
    return SIGNATURE + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)) + noted + part(b"IDAT", zlib.compress(raw.tobytes())) + part(b"IEND", b"")
