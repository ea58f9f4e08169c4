"""PNG files of 8-bit grey, RGB and RGBA images, with nothing but zlib."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Fixed values of the format: the signature, and the colour types by their number of channels.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
COLOUR_TYPES = {1: 0, 2: 4, 3: 2, 4: 6}


def _part(name: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))


def encode(image: np.ndarray, level: int = 1) -> bytes:
    """A file of a height x width x channels array of bytes."""
    height, width, channels = image.shape
    if channels not in COLOUR_TYPES:
        raise ValueError(f"{channels} channels")
    lines = np.zeros((height, 1 + width * channels), np.uint8)
    lines[:, 1:] = np.ascontiguousarray(image, np.uint8).reshape(height, -1)
    head = struct.pack(">IIBBBBB", width, height, 8, COLOUR_TYPES[channels], 0, 0, 0)
    return SIGNATURE + _part(b"IHDR", head) + _part(b"IDAT", zlib.compress(lines.tobytes(), level)) + _part(b"IEND", b"")


def _paeth(left: int, up: int, corner: int) -> int:
    guess = left + up - corner
    return min((abs(guess - left), 0, left), (abs(guess - up), 1, up), (abs(guess - corner), 2, corner))[2]


def decode(data: bytes) -> np.ndarray:
    """The image of a file; ValueError for anything but a whole 8-bit PNG without interlacing."""
    if not data.startswith(SIGNATURE):
        raise ValueError("no PNG file")
    at, parts = len(SIGNATURE), {b"IHDR": b"", b"IDAT": b"", b"IEND": None}
    while at + 12 <= len(data):
        (size,), name = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + size]
        if struct.pack(">I", zlib.crc32(name + body)) != data[at + 8 + size : at + 12 + size]:
            raise ValueError("damaged PNG file")
        if name in parts:
            parts[name] = (parts[name] or b"") + body
        at += 12 + size
    if len(parts[b"IHDR"]) != 13 or parts[b"IEND"] is None:
        raise ValueError("cut PNG file")
    width, height, bits, colour, _, _, interlaced = struct.unpack(">IIBBBBB", parts[b"IHDR"])
    channels = {v: k for k, v in COLOUR_TYPES.items()}.get(colour)
    if bits != 8 or channels is None or interlaced:
        raise ValueError("kind of PNG file that is not read")
    try:
        raw = zlib.decompress(parts[b"IDAT"])
    except zlib.error as e:
        raise ValueError("damaged PNG file") from e
    if len(raw) != height * (1 + width * channels):
        raise ValueError("cut PNG file")
    lines = np.frombuffer(raw, np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width * channels), np.uint8)
    for y in range(height):
        kind, line = lines[y, 0], lines[y, 1:]
        above = out[y - 1] if y else np.zeros_like(line)
        if kind == 0:
            out[y] = line
        elif kind == 1:
            out[y] = np.cumsum(line.reshape(width, channels), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            out[y] = line + above
        elif kind in (3, 4):
            row, up = [0] * channels + line.tolist(), [0] * channels + above.tolist()
            for x in range(channels, len(row)):
                left = row[x - channels]
                row[x] = (row[x] + ((left + up[x]) // 2 if kind == 3 else _paeth(left, up[x], up[x - channels]))) & 255
            out[y] = row[channels:]
        else:
            raise ValueError("unknown filter in a PNG file")
    return out.reshape(height, width, channels)
