"""Messages of robot topics in their wire form (CDR, little-endian): joint states and compressed images."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

JOINTS = "sec int, nanosec long, frame_id string, name array<string>, position array<double>, velocity array<double>, effort array<double>"
IMAGE = "sec int, nanosec long, frame_id string, format string, data binary"


class _Reader:
    def __init__(self, data: bytes) -> None:
        if len(data) < 4 or data[1] not in (0, 1):
            raise ValueError("no CDR message")
        self.data, self.at, self.order = data[4:], 0, "<" if data[1] == 1 else ">"

    def number(self, kind: str) -> int:
        size = struct.calcsize(kind)
        self.at += -self.at % size
        (value,) = struct.unpack_from(self.order + kind, self.data, self.at)
        self.at += size
        return value

    def text(self) -> str:
        n = self.number("I")
        self.at += n
        return self.data[self.at - n : self.at - 1].decode()

    def doubles(self) -> list[float]:
        n = self.number("I")
        self.at += -self.at % 8 if n else 0
        self.at += 8 * n
        return list(struct.unpack_from(f"{self.order}{n}d", self.data, self.at - 8 * n))

    def blob(self) -> bytes:
        n = self.number("I")
        self.at += n
        return self.data[self.at - n : self.at]


class _Writer:
    def __init__(self) -> None:
        self.out = bytearray()

    def number(self, kind: str, value) -> "_Writer":
        self.out += bytes(-len(self.out) % struct.calcsize(kind)) + struct.pack("<" + kind, value)
        return self

    def text(self, value: str) -> "_Writer":
        data = value.encode() + b"\0"
        self.number("I", len(data)).out += data
        return self

    def doubles(self, values) -> "_Writer":
        self.number("I", len(values))
        if len(values):
            self.out += bytes(-len(self.out) % 8) + struct.pack(f"<{len(values)}d", *values)
        return self

    def done(self) -> bytes:
        return b"\x00\x01\x00\x00" + bytes(self.out)


def joints_of(data: bytes) -> dict:
    r = _Reader(data)
    out = {"sec": r.number("i"), "nanosec": r.number("I"), "frame_id": r.text()}
    out["name"] = [r.text() for _ in range(r.number("I"))]
    return out | {k: r.doubles() for k in ("position", "velocity", "effort")}


def joints_message(sec: int, nanosec: int, frame_id: str, name, position, velocity=(), effort=()) -> bytes:
    w = _Writer().number("i", sec).number("I", nanosec).text(frame_id).number("I", len(name))
    for n in name:
        w.text(n)
    return w.doubles(position).doubles(velocity).doubles(effort).done()


def image_of(data: bytes) -> dict:
    r = _Reader(data)
    return {"sec": r.number("i"), "nanosec": r.number("I"), "frame_id": r.text(), "format": r.text(), "data": r.blob()}


def image_message(sec: int, nanosec: int, frame_id: str, format: str, data: bytes) -> bytes:
    w = _Writer().number("i", sec).number("I", nanosec).text(frame_id).text(format).number("I", len(data))
    w.out += data
    return w.done()


def joint_state(data: Column | str) -> Column:
    """Fields of joint-state messages."""

    def run(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([joints_of(d) for d in data], columns=["sec", "nanosec", "frame_id", "name", "position", "velocity", "effort"])

    return F.pandas_udf(run, JOINTS)(data)


def compressed_image(data: Column | str) -> Column:
    """Fields of compressed-image messages."""

    def run(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([image_of(d) for d in data], columns=["sec", "nanosec", "frame_id", "format", "data"])

    return F.pandas_udf(run, IMAGE)(data)


def joint_state_message(ns: Column | str, frame_id: Column, name: Column, position: Column) -> Column:
    """Joint-state messages of a stamp in nanoseconds, names and positions."""

    def run(ns: pd.Series, frame_id: pd.Series, name: pd.Series, position: pd.Series) -> pd.Series:
        return pd.Series([joints_message(t // 1_000_000_000, t % 1_000_000_000, f, n, p) for t, f, n, p in zip(ns.tolist(), frame_id, name, position)])

    return F.pandas_udf(run, "binary")(ns, frame_id, name, position)


def stamp_ns(message: Column, received_ns: Column, cutoff_sec: float) -> Column:
    """The message's own stamp if it is later than the cutoff, else when it was received."""
    own = message["sec"].cast("long") * 1_000_000_000 + message["nanosec"]
    return F.when(message["sec"] + message["nanosec"] / 1e9 > cutoff_sec, own).otherwise(received_ns)
