"""Strings, times and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    """Microseconds of a timestamp, with or without a zone (the session's is UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def half_even(x: Column, digits: int = 0) -> Column:
    return F.bround(x, digits)


def ns_string(ns: Column) -> Column:
    """seconds.nanoseconds, the latter in nine digits."""
    return F.concat(F.floor(ns / F.lit(1_000_000_000)).cast("string"), F.lit("."), F.lpad(F.pmod(ns, F.lit(1_000_000_000)).cast("string"), 9, "0"))


def stamp_to_ns(sec: Column, nanosec: Column) -> Column:
    return sec.cast("long") * 1_000_000_000 + nanosec.cast("long")


def stamp_to_sec(sec: Column, nanosec: Column) -> Column:
    return sec + nanosec * 1e-9


def clock_to_sec(s: Column) -> Column:
    """MM:SS, or a bare number of seconds."""
    p = F.split(s, ":")
    return F.when(F.size(p) == 2, F.get(p, F.lit(0)).cast("int") * 60 + F.get(p, F.lit(1)).cast("int")).otherwise(s.cast("int"))


def manifest_time(s: Column, zone: str | None = None, add_seconds: Column | None = None) -> Column:
    """``Y-m-d H:M:S`` as ISO text ending in .000Z.

    As recorded the clock time is only relabelled; with ``zone`` it is
    converted to UTC.
    """
    t = F.to_timestamp(s, "yyyy-MM-dd HH:mm:ss")
    if zone:
        t = F.to_utc_timestamp(t, zone)
    if add_seconds is not None:
        t = F.timestamp_micros(F.unix_micros(t) + (add_seconds * 1_000_000).cast("long"))
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'.000Z'")


def human_size(n: Column) -> Column:
    """Bytes in G or MB to a tenth, ties to the even one as C's printf has them (Java's takes the greater one); null stays null."""
    gb, mb = n / float(1 << 30), n / float(1 << 20)
    return F.when(gb >= 1, F.format_string("%.1fG", half_even(gb, 1))).when(n.isNotNull(), F.format_string("%.1fMB", half_even(mb, 1)))


def chunk_name(episode: Column, size: int = 1000) -> Column:
    return F.format_string("chunk-%03d", F.floor(episode / size))


def task_of_path(path: Column, robot: str) -> Column:
    """Words of the dotted part behind ``robot``, without its first and last two; else ``todo``."""
    dots = F.split(F.get(F.split(path, robot, 2), F.lit(1)), r"\.")
    return F.when(path.contains(robot) & (F.size(dots) > 3), F.array_join(F.slice(dots, 2, F.greatest(F.size(dots) - 3, F.lit(0))), " ")).otherwise(F.lit("todo"))


def clean_prompt(s: Column) -> Column:
    return F.translate(F.trim(s), "_\n", "  ")


def prompt_with_state(prompt: Column, bins: Column) -> Column:
    return F.concat(F.lit("Task: "), clean_prompt(F.lower(prompt)), F.lit(", State: "), F.array_join(F.transform(bins, lambda b: b.cast("string")), " "), F.lit(";\n"))


def strip_prefix(name: str, prefixes: list[str]) -> str:
    """The first prefix that matches is taken off."""
    return next((name[len(p) :] for p in prefixes if name.startswith(p)), name)


def motor_faults(codes: Column, names: dict[int, str]) -> tuple[Column, Column]:
    """Whether any of the first 14 codes is not 0, and their text."""
    first = F.slice(codes, 1, 14)
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    text = F.transform(first, lambda c, i: F.concat(F.lit("motor "), i.cast("string"), F.lit(": "), F.coalesce(known[c], F.concat(F.lit("code "), c.cast("string")))))
    return F.exists(first, lambda c: c != 0), F.array_join(F.filter(text, lambda t, i: F.get(first, i) != 0), "; ")
