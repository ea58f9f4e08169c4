"""Declared features and Spark schemas."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALARS = {"float32": T.FloatType(), "float64": T.DoubleType(), "int64": T.LongType(), "int32": T.IntegerType(), "bool": T.BooleanType(), "uint8": T.ShortType(), "string": T.StringType()}
IMAGE = T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())])
BASE = {"timestamp": ("float32", (1,)), "frame_index": ("int64", (1,)), "episode_index": ("int64", (1,)), "index": ("int64", (1,)), "task_index": ("int64", (1,))}


def field(name: str, dtype: str, shape: tuple[int, ...], names=None) -> T.StructField | None:
    """A scalar for shape (1,), nested arrays up to five deep, a struct for images, nothing for videos."""
    if "/" in name:
        raise ValueError(f"'/' is not allowed in the feature name {name!r}")
    if dtype == "video":
        return None
    if dtype == "image":
        kind: T.DataType = IMAGE
    elif dtype not in SCALARS or len(shape) > 5:
        raise ValueError(f"feature {name!r}: {dtype} {shape} has no column type")
    else:
        kind = SCALARS[dtype]
        for _ in range(0 if tuple(shape) == (1,) else len(shape)):
            kind = T.ArrayType(kind)
    return T.StructField(name, kind, True, {"dtype": dtype, "shape": list(shape), "names": list(names or [])})


def struct(features: dict[str, tuple]) -> T.StructType:
    return T.StructType([f for n, spec in ({k: v for k, v in BASE.items()} | features).items() if (f := field(n, *spec))])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns and types as declared; a missing or extra one is an error."""
    if missing := set(schema.names) - set(df.columns):
        raise ValueError(f"missing features: {sorted(missing)}")
    if extra := set(df.columns) - set(schema.names):
        raise ValueError(f"extra features: {sorted(extra)}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields))


def kinds(schema: T.StructType) -> dict[str, str]:
    """visual, state, environment, action or other, by type and name."""
    out = {}
    for f in schema.fields:
        if f.metadata.get("dtype") in ("image", "video"):
            out[f.name] = "visual"
        elif f.name == "observation.environment_state":
            out[f.name] = "environment"
        else:
            out[f.name] = "state" if f.name.startswith("observation") else "action" if f.name.startswith("action") else "other"
    return out


def flatten(schema: T.StructType, sep: str = "/", parent: str = "") -> list[tuple[str, str]]:
    """(path, column expression) of every leaf of nested structs."""
    out = []
    for f in schema.fields:
        path = f"{parent}.`{f.name}`" if parent else f"`{f.name}`"
        out += flatten(f.dataType, sep, path) if isinstance(f.dataType, T.StructType) else [(path.replace("`", "").replace(".", sep), path)]
    return out


def flattened(df: DataFrame, sep: str = "/") -> DataFrame:
    return df.select(*(F.col(path).alias(name) for name, path in flatten(df.schema, sep)))


def unflattened(df: DataFrame, sep: str = "/") -> DataFrame:
    """Columns named a/b/c as nested structs."""

    def build(names: list[tuple[list[str], str]]) -> list[Column]:
        heads = dict.fromkeys(p[0] for p, _ in names)
        out = []
        for h in heads:
            inside = [(p[1:], c) for p, c in names if p[0] == h]
            out.append((F.struct(*build(inside)) if inside[0][0] else F.col(f"`{inside[0][1]}`")).alias(h))
        return out

    return df.select(*build([(c.split(sep), c) for c in df.columns]))


def repack(df: DataFrame, structure: dict) -> DataFrame:
    """New nested columns from the paths of others."""

    def build(value) -> Column:
        return F.struct(*(build(v).alias(k) for k, v in value.items())) if isinstance(value, dict) else F.col(value.replace("/", "."))

    return df.select(*(build(v).alias(k) for k, v in structure.items()))


def rename_by_patterns(names: Iterable[str], patterns: dict[str, str | None]) -> dict[str, str]:
    """The first pattern that matches a whole name renames it, or drops it if it has no target.

    Two names that become one are an error, and so is a name that is a leaf and a node at once.
    """
    out: dict[str, str] = {}
    for name in names:
        new: str | None = name
        for pattern, target in patterns.items():
            if re.fullmatch(pattern, name):
                new = None if target is None else re.sub(pattern, target, name, count=1)
                break
        if new is None:
            continue
        if new in out.values():
            raise ValueError(f"two columns become {new!r}")
        out[name] = new
    for a in out.values():
        if any(b.startswith(a + "/") for b in out.values()):
            raise ValueError(f"{a!r} is a leaf and a node")
    return out


def renamed(df: DataFrame, patterns: dict[str, str | None]) -> DataFrame:
    return df.select(*(F.col(f"`{a}`").alias(b) for a, b in rename_by_patterns(df.columns, patterns).items()))


def select_matching(df: DataFrame, patterns: list[str]) -> DataFrame:
    return df.select(*(f"`{c}`" for c in df.columns if any(re.search(p, c) for p in patterns)))


def without_strings(df: DataFrame) -> DataFrame:
    return df.select(*(f"`{c}`" for c, t in df.dtypes if t != "string"))


def apply_to(df: DataFrame, selector: dict[str, Callable[[Column], Column]], strict: bool = False) -> DataFrame:
    if strict and (bad := set(selector) - set(df.columns)):
        raise ValueError(f"no such columns: {sorted(bad)}")
    return df.withColumns({c: fn(F.col(c)) for c, fn in selector.items() if c in df.columns})


def safe_version(wanted: str, there: list[str]) -> str:
    """The wanted version, else the highest minor one of its major at or below it."""
    parse = lambda v: tuple(int(x) for x in v.lstrip("v").split("."))
    want, have = parse(wanted), {parse(v): v for v in there}
    if want in have:
        return have[want]
    if fits := [v for v in have if v[0] == want[0] and v <= want]:
        return have[max(fits)]
    if have and max(have)[0] < want[0]:
        raise ValueError(f"the data are too old for {wanted}; convert them first")
    raise ValueError(f"the data are too new for {wanted}; there are {sorted(there)}")


def merge_features(*parts: dict[str, dict]) -> dict[str, dict]:
    """Features of several sources as one: names of vectors of the same key are put one after another, without repeats."""
    out: dict[str, dict] = {}
    for part in parts:
        for key, spec in part.items():
            names = spec.get("names")
            if key not in out or not isinstance(names, list) or len(spec.get("shape", ())) != 1:
                out[key] = dict(spec)
                continue
            if out[key].get("dtype") != spec.get("dtype"):
                raise ValueError(f"feature {key!r} is {out[key].get('dtype')} and {spec.get('dtype')}")
            both = list(dict.fromkeys([*out[key]["names"], *names]))
            out[key] = out[key] | {"names": both, "shape": (len(both),)}
    return out


def lists_as_sequences(features):
    """Stored feature types with the older name of the list type put in place of the newer, at any depth."""
    if isinstance(features, dict):
        return {k: "Sequence" if k == "_type" and v == "List" else lists_as_sequences(v) for k, v in features.items()}
    return [lists_as_sequences(x) for x in features] if isinstance(features, list) else features


def camera_shapes(features: dict[str, dict]) -> tuple[dict[str, tuple], str]:
    """Shape of every camera, and how they are stored; cameras stored in different ways are an error."""
    cameras = {k: f for k, f in features.items() if f.get("dtype") in ("image", "video")}
    stored = {f["dtype"] for f in cameras.values()}
    if len(stored) != 1:
        raise ValueError(f"cameras are stored as {sorted(stored) or 'nothing'}; one way is needed")
    return {k: tuple(f["shape"]) for k, f in cameras.items()}, stored.pop()


def empty(spark, features: dict[str, tuple]) -> DataFrame:
    """A data set of the declared features, without a frame."""
    return spark.createDataFrame([], struct(features))


def unwrapped(df: DataFrame, *columns: str) -> DataFrame:
    """Columns of arrays of one array without the outer one; others stay as they are."""
    kinds_ = dict(df.dtypes)
    return df.withColumns({c: F.flatten(c) for c in columns if kinds_[c].startswith("array<array<")})
