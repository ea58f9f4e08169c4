"""Decoded images: struct of height, width, channels and row-major uint8 data.

Every function is a vectorised pandas UDF on a batch of such structs.  Encoded
files stay opaque bytes until a decoder is plugged in with ``decoded``; that of PNG is ``png.decode``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import png

IMAGE = "height int, width int, channels int, data binary"


def _array(row) -> np.ndarray:
    return np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], row["channels"])


def _struct(a: np.ndarray) -> dict:
    return {"height": a.shape[0], "width": a.shape[1], "channels": a.shape[2], "data": np.ascontiguousarray(a, np.uint8).tobytes()}


def mapped(fn: Callable[[np.ndarray], np.ndarray]):
    """A column function of ``fn`` on height x width x channels arrays; null stays null."""

    @F.pandas_udf(IMAGE)
    def run(images: pd.DataFrame) -> pd.DataFrame:
        out = [_struct(fn(_array(r))) if r["data"] is not None else dict.fromkeys(("height", "width", "channels", "data")) for r in images.to_dict("records")]
        return pd.DataFrame(out, columns=["height", "width", "channels", "data"])

    return run


def decoded(decode: Callable[[bytes], np.ndarray]):
    """A column function from file bytes to images, with any decoder."""

    @F.pandas_udf(IMAGE)
    def run(files: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_struct(decode(b)) for b in files], columns=["height", "width", "channels", "data"])

    return run


def decoded_or_null(decode: Callable[[bytes], np.ndarray]):
    """As ``decoded``; null for a null and for bytes that the decoder rejects by a ValueError."""

    @F.pandas_udf(IMAGE)
    def run(files: pd.Series) -> pd.DataFrame:
        out = []
        for b in files:
            try:
                out.append(dict.fromkeys(("height", "width", "channels", "data")) if b is None else _struct(decode(bytes(b))))
            except ValueError:
                out.append(dict.fromkeys(("height", "width", "channels", "data")))
        return pd.DataFrame(out, columns=["height", "width", "channels", "data"])

    return run


def encoded(images: Column, level: int = 1) -> Column:
    """PNG files of images; null stays null."""

    @F.pandas_udf("binary")
    def run(im: pd.DataFrame) -> pd.Series:
        return pd.Series([None if r["data"] is None else png.encode(_array(r), level) for r in im.to_dict("records")], dtype=object)

    return run(images)


def from_vector(v: Column, height: int, width: int, channels: int = 1) -> Column:
    """Floats in [0, 1] as an image."""

    @F.pandas_udf(IMAGE)
    def run(values: pd.Series) -> pd.DataFrame:
        rows = [_struct(np.clip(np.rint(np.asarray(x, float) * 255), 0, 255).reshape(height, width, channels)) for x in values]
        return pd.DataFrame(rows, columns=["height", "width", "channels", "data"])

    return run(v)


def channel_last(a: np.ndarray) -> np.ndarray:
    """From channels first, if that is what it is."""
    return np.moveaxis(a, 0, -1) if a.shape[0] in (1, 3) and a.shape[-1] not in (1, 3) else a


def resized(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, sampled at pixel centres."""
    ys = np.clip((np.arange(height) + 0.5) * a.shape[0] / height - 0.5, 0, a.shape[0] - 1)
    xs = np.clip((np.arange(width) + 0.5) * a.shape[1] / width - 0.5, 0, a.shape[1] - 1)
    y0, x0 = np.floor(ys).astype(int), np.floor(xs).astype(int)
    y1, x1 = np.minimum(y0 + 1, a.shape[0] - 1), np.minimum(x0 + 1, a.shape[1] - 1)
    wy, wx = (ys - y0)[:, None, None], (xs - x0)[None, :, None]
    f = a.astype(float)
    top, low = f[y0][:, x0] * (1 - wx) + f[y0][:, x1] * wx, f[y1][:, x0] * (1 - wx) + f[y1][:, x1] * wx
    return np.rint(top * (1 - wy) + low * wy).astype(np.uint8)


def resize_with_pad(height: int, width: int):
    """Fit inside height x width, ratio kept, black borders."""

    def fn(a: np.ndarray) -> np.ndarray:
        k = min(height / a.shape[0], width / a.shape[1])
        small = resized(a, max(1, int(a.shape[0] * k)), max(1, int(a.shape[1] * k)))
        out = np.zeros((height, width, a.shape[2]), np.uint8)
        y, x = (height - small.shape[0]) // 2, (width - small.shape[1]) // 2
        out[y : y + small.shape[0], x : x + small.shape[1]] = small
        return out

    return mapped(fn)


def crop(top: int, left: int, height: int, width: int):
    return mapped(lambda a: a[top : top + height, left : left + width])


def random_crop(images: Column, key: Column, height: int, width: int, seed: int) -> Column:
    """A crop whose place is fixed by a seeded hash of the key."""

    @F.pandas_udf(IMAGE)
    def run(im: pd.DataFrame, place: pd.Series) -> pd.DataFrame:
        out = []
        for r, p in zip(im.to_dict("records"), place):
            a = _array(r)
            y, x = p % (a.shape[0] - height + 1), (p // 65_536) % (a.shape[1] - width + 1)
            out.append(_struct(a[y : y + height, x : x + width]))
        return pd.DataFrame(out, columns=["height", "width", "channels", "data"])

    return run(images, F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 40)))


def jitter(images: Column, key: Column, seed: int, brightness: float = 0.2, contrast: float = 0.2) -> Column:
    """Brightness and contrast, fixed by a seeded hash of the key."""

    @F.pandas_udf(IMAGE)
    def run(im: pd.DataFrame, place: pd.Series) -> pd.DataFrame:
        out = []
        for r, p in zip(im.to_dict("records"), place):
            rnd = np.random.default_rng(int(p))
            a = _array(r).astype(float) * rnd.uniform(1 - brightness, 1 + brightness)
            a = (a - a.mean()) * rnd.uniform(1 - contrast, 1 + contrast) + a.mean()
            out.append(_struct(np.clip(np.rint(a), 0, 255)))
        return pd.DataFrame(out, columns=["height", "width", "channels", "data"])

    return run(images, F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 40)))


def to_float():
    """Channels first, in [0, 1], flattened."""

    @F.pandas_udf("array<float>")
    def run(images: pd.DataFrame) -> pd.Series:
        return pd.Series([np.moveaxis(_array(r), -1, 0).ravel().astype(np.float32) / 255 for r in images.to_dict("records")])

    return run


def empty(share: float = 0.99, dark: int = 20, bright: int | None = 230):
    """``black`` or ``white`` if more than ``share`` of the pixels are so in all channels, else null.

    Depth has its own ``dark`` and no white: ``bright`` is None.  Without an image null.
    """

    @F.pandas_udf("string")
    def run(images: pd.DataFrame) -> pd.Series:
        out = []
        for r in images.to_dict("records"):
            if r["data"] is None:
                out.append(None)
                continue
            a = _array(r)
            black, white = (a.max(axis=2) <= dark).mean(), 0.0 if bright is None else (a.min(axis=2) >= bright).mean()
            out.append("black" if black > share else "white" if white > share else None)
        return pd.Series(out, dtype=object)

    return run
