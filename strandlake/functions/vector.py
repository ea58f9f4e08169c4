"""Element-wise functions of array columns, all on the JVM side.

Arrays keep float32 on disk; arithmetic is done in double.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(a: Column) -> Column:
    return a.cast("array<double>")


def literal(values: Sequence[float]) -> Column:
    return F.array(*(F.lit(float(v)) for v in values))


def zip2(a: Column, b: Column, fn: Callable[[Column, Column], Column]) -> Column:
    return F.zip_with(a, b, fn)


def zip3(a: Column, b: Column, c: Column, fn: Callable[[Column, Column, Column], Column]) -> Column:
    """Element by element over three arrays, as long as the first."""
    return F.transform(a, lambda x, i: fn(x, F.get(b, i), F.get(c, i)))


def add(a: Column, b: Column) -> Column:
    return zip2(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    return zip2(a, b, lambda x, y: x - y)


def scale(a: Column, k: float) -> Column:
    return F.transform(a, lambda x: x * k)


def clip(a: Column, low: float | Sequence[float], high: float | Sequence[float]) -> Column:
    """Clamp to one range, or to a range of its own for each element."""
    lo = (lambda i: F.lit(float(low))) if isinstance(low, (int, float)) else (lambda i: F.get(literal(low), i))
    hi = (lambda i: F.lit(float(high))) if isinstance(high, (int, float)) else (lambda i: F.get(literal(high), i))
    return F.transform(a, lambda x, i: F.greatest(lo(i), F.least(hi(i), x)))


def clip_dual_arm(a: Column) -> Column:
    """16 elements: joints to +-(pi - 0.001), grippers (8th and 16th) to [0, 70]."""
    joint = 3.141592653589793 - 1e-3
    low, high = [0.0 if i in (7, 15) else -joint for i in range(16)], [70.0 if i in (7, 15) else joint for i in range(16)]
    return clip(a, low, high)


def outliers_to_zero(a: Column, limit: float = 3.141592653589793) -> Column:
    return F.transform(a, lambda x: F.when(F.abs(x) > limit, F.lit(0.0)).otherwise(x))


def pad_to(a: Column, n: int, value: float = 0.0) -> Column:
    """Right padding; a longer array stays as it is."""
    return F.concat(a, F.array_repeat(F.lit(value), F.greatest(F.lit(n) - F.size(a), F.lit(0))))


def every_kth(a: Column, k: int) -> Column:
    return F.filter(a, lambda x, i: i % k == 0)


def bool_mask(*runs: int) -> list[bool]:
    """+n gives n times true, -n gives n times false."""
    return [n > 0 for n in runs for _ in range(abs(n))]


def masked(mask: Sequence[bool]) -> Column:
    return F.array(*map(F.lit, mask))


def delta_actions(actions: Column, state: Column, mask: Sequence[bool]) -> Column:
    """Each step of ``actions`` (array of arrays) less the state, where the mask holds."""
    return _shift(actions, state, mask, -1.0)


def absolute_actions(actions: Column, state: Column, mask: Sequence[bool]) -> Column:
    """Inverse of ``delta_actions``."""
    return _shift(actions, state, mask, 1.0)


def _shift(actions: Column, state: Column, mask: Sequence[bool], sign: float) -> Column:
    m = masked(mask)
    return F.transform(actions, lambda step: F.transform(step, lambda x, i: F.when(F.coalesce(F.get(m, i), F.lit(False)), x + sign * F.get(state, i)).otherwise(x)))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def distance(a: Column, b: Column) -> Column:
    return norm(subtract(a, b))


def similar(a: Column, b: Column, atol: float = 1.0) -> Column:
    return distance(a, b) < atol


def largest_change(a: Column, b: Column, per_element: Column | None = None) -> Column:
    """Greatest absolute difference, divided by a scale of each element if given."""
    d = zip2(a, b, lambda x, y: F.abs(x - y))
    return F.array_max(d if per_element is None else zip2(d, per_element, lambda x, s: x / s))


def within(a: Column, value: Column | float, eps: float = 1e-6) -> Column:
    """Membership of a float up to ``eps``."""
    return F.exists(a, lambda x: F.abs(x - value) <= eps)


def has_nan(a: Column) -> Column:
    return F.exists(doubles(a), lambda x: F.isnan(x))


def digitize(a: Column, bins: int = 256) -> Column:
    """Bin of each value among ``bins`` equal ones over [-1, 1]; below -1 gives -1, above stays in the last."""
    return F.transform(a, lambda x: F.greatest(F.lit(-1), F.least(F.lit(bins - 1), F.floor((x + 1) * (bins / 2)).cast("int"))))


def undigitize(tokens: Column, horizon: int, dim: int, bins: int = 256) -> Column:
    """Values of tokens as ``horizon`` vectors of ``dim``; all zeros if there are too few."""
    flat = F.transform(tokens, lambda t: t / float(bins) * 2 - 1)
    rows = F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), lambda i: F.slice(flat, i * dim + 1, dim))
    zeros = F.array_repeat(F.array_repeat(F.lit(0.0), dim), horizon)
    return F.when(F.size(tokens) >= horizon * dim, rows).otherwise(zeros)


def tokens_with_mask(tokens: Column, length: int, pad: int = 0) -> tuple[Column, Column]:
    """Cut or right-pad to ``length``, and which are real."""
    n = F.least(F.size(tokens), F.lit(length))
    cut = F.slice(tokens, 1, length)
    fill = F.greatest(F.lit(length) - n, F.lit(0))
    return F.concat(cut, F.array_repeat(F.lit(pad), fill)), F.concat(F.array_repeat(F.lit(True), n), F.array_repeat(F.lit(False), fill))


def interpolate(a: Column, b: Column, n: int) -> Column:
    """``n`` vectors from a to b, both ends included."""
    if n == 1:
        return F.array(a)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: zip2(a, b, lambda x, y: x + (y - x) * (i / float(n - 1))))


def smoothstep(u: Column) -> Column:
    return 3 * u * u - 2 * u * u * u


def dual_arm_state(left: Column, right: Column) -> Column:
    """Seven joints and the opening (9th element, over 100) of each arm."""
    one = lambda a: F.concat(F.slice(a, 1, 7), F.array(F.element_at(a, 9) / 100.0))
    return F.concat(one(doubles(left)), one(doubles(right))).cast("array<float>")


def gripper_value(binary: Column, opening: Column, mode: str) -> Column:
    if mode == "open_value":
        return opening / 100.0
    if mode == "bin":
        return binary
    raise ValueError(f"unknown gripper mode {mode!r}: open_value or bin")


def dual_arm_action(left: Column, right: Column, mode: str = "open_value") -> Column:
    one = lambda a: F.concat(F.slice(a, 1, 7), F.array(gripper_value(F.element_at(a, 8), F.element_at(a, 9), mode)))
    return F.concat(one(doubles(left)), one(doubles(right))).cast("array<float>")


def dual_arm_vectors(left: Column, right: Column, mode: str = "open_value") -> tuple[Column, Column]:
    """State and action, null where an arm has fewer than nine elements."""
    ok = (F.size(left) >= 9) & (F.size(right) >= 9)
    return F.when(ok, dual_arm_state(left, right)), F.when(ok, dual_arm_action(left, right, mode))


def scatter(parts: dict[str, Column], layout: dict[str, tuple[int, int]], dim: int) -> Column:
    """Place each named vector at its (offset, length) of a vector of ``dim``; gaps are zero."""
    out = [F.lit(0.0)] * dim
    for name, (offset, length) in layout.items():
        for i in range(length):
            out[offset + i] = F.coalesce(F.get(doubles(parts[name]), F.lit(i)), F.lit(0.0))
    return F.array(*out)


def named(a: Column, names: Sequence[str]) -> list[Column]:
    """One column for each element."""
    return [F.get(a, F.lit(i)).alias(n) for i, n in enumerate(names)]


def flip(a: Column, signs: Sequence[float]) -> Column:
    return zip2(a, literal(signs), lambda x, s: x * s)


def rescale_gripper(x: Column, floor: float, span: float, top: float = 70.0) -> Column:
    """clip((100 x - floor) * top / span, 0, top)."""
    return F.greatest(F.lit(0.0), F.least(F.lit(top), (x * 100 - floor) * top / span))


def align_gripper_chunk(chunk: Column, current: Column) -> Column:
    """Shift a chunk so that it starts at the current value; clip to [0.25, 1]."""
    return F.transform(chunk, lambda x: F.greatest(F.lit(0.25), F.least(F.lit(1.0), x - F.get(chunk, F.lit(0)) + current)))


def small_to_zero(x: Column, least: float = 2.0, raw: bool = False) -> Column:
    """Values under ``least`` become 0; raw values are divided by 100 first, as recorded consumers expect."""
    v = x / 100.0 if raw else x
    return F.when(v < least, F.lit(0.0)).otherwise(v)


def time_chunk(start: Column, dt: float, first_step: Column, chunk: Column) -> Column:
    """Array of (timestamp, timestep, action) of a chunk's steps."""
    return F.transform(chunk, lambda a, i: F.struct((start + i * dt).alias("timestamp"), (first_step + i).alias("timestep"), a.alias("action")))


def gripper_penalty(action: Column, position: Column, penalty: float = -0.01, top: float = 100.0) -> Column:
    """``penalty`` for closing what is closed or opening what is open; both are on the scale that ends at ``top``.  Null without one of them."""
    p, a = position / top, action / top
    penal = F.when(((p < 0.5) & (a > 0.5)) | ((p > 0.75) & (a < 0.5)), F.lit(penalty)).otherwise(F.lit(0.0))
    return F.when(position.isNotNull() & action.isNotNull(), penal)


def delta_to_action(delta: Column, position_scale: float = 1.0, threshold: float = 1e-3) -> tuple[Column, Column]:
    """Whether a motion is over the noise, and the scaled motion."""
    return norm(delta) > threshold, scale(delta, position_scale)


def spread(i: Column, n: Column, k: Column) -> Column:
    """Position i of k that are spread evenly over 0 .. n - 1, both ends included: i times the step as a double, the last one exact."""
    return F.when((i == k - 1) & (k > 1), (n - 1).cast("double")).otherwise(i * ((n - 1) / F.greatest(k - 1, F.lit(1))))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def batched(a: Column) -> Column:
    """One more dimension in front."""
    return F.array(a)


def unbatched(a: Column) -> Column:
    """Without a leading dimension of length one; others stay null."""
    return F.when(F.size(a) == 1, F.get(a, F.lit(0)))


def scaled_clip(a: Column, keep: Sequence[int], scaled: Sequence[int], by: float = 1000.0) -> Column:
    """Some elements as they are, then others divided and clipped to [0, 1]."""
    own = [F.get(a, F.lit(i)) for i in keep]
    return F.array(*own, *(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.get(a, F.lit(i)) / by)) for i in scaled))
