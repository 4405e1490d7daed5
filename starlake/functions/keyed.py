"""Deterministic keyed column functions (FN1-FN16).

Every draw is a pure function of stable key columns plus a salt, so results do
not depend on partitioning, task order or retries (a lost executor recomputes
exactly the same values). No ``rand()``, ``uuid()`` or
``monotonically_increasing_id()`` anywhere.

Two hash families:

* ``"md5"`` (default): ``md5(concat_ws('|', keys..., salt))``. Portable: any SQL
  engine with ``md5`` reproduces the same draws, which is what lets the DuckDB
  oracle check every derived fact value by value.
* ``"murmur3"``: the name that callers know for Spark's ``xxhash64``; cheaper per row, Spark-only.

Nulls are keys like any other: they have a text of their own, so (null, 5) and (5, null) differ.

Draws are exact decimals (``u`` has 6 decimal places, 1e6 buckets), so every
comparison and affine transform is exact in any engine.
"""
from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIFORM_BUCKETS = 1_000_000
_SEP = "|"

Family = str  # "md5" | "murmur3"


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def _texts(keys) -> list[Column]:
    """The keys' texts; a null's is ``(null)``."""
    return [F.coalesce(_col(k).cast("string"), F.lit("(null)")) for k in keys]


def _marked(keys) -> list[Column]:
    """The keys and whether each is null, for a hash that passes over nulls."""
    return [x for k in keys for x in (_col(k), _col(k).isNull())]


def dec(value, precision: int = 18, scale: int | None = None) -> Column:
    """Decimal literal (never a double)."""
    d = Decimal(str(value))
    if scale is None:
        scale = max(0, -d.as_tuple().exponent)
    return F.lit(d).cast(f"decimal({precision},{scale})")


def hash_bits(*keys, salt: str, family: Family = "md5") -> Column:
    """Non-negative 32-bit (md5) or signed 64-bit (murmur3) hash of keys + salt."""
    if family == "md5":
        text = F.concat_ws(_SEP, *_texts(keys), F.lit(str(salt)))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    if family == "murmur3":
        return F.xxhash64(*_marked(keys), F.lit(str(salt)))
    raise ValueError(f"unknown hash family {family!r}")


def key_text(*keys) -> Column:
    """The text of the keys that a digest is made of; texts of parts of the keys joined by ``|`` are the text of all."""
    return F.concat_ws(_SEP, *_texts(keys))


def millionths(digest: Column) -> list[Column]:
    """The four draws that the 128 bits of a digest hold, in millionths; two share a conversion."""
    out = []
    for at in (1, 17):
        half = F.conv(F.substring(digest, at, 16), 16, -10).cast("long")  # 64 bits as a signed number
        out += [F.shiftrightunsigned(half, 32), half.bitwiseAND(F.lit(0xFFFFFFFF))]
    return [F.pmod(bits, F.lit(UNIFORM_BUCKETS).cast("long")) for bits in out]


def uniform_slice(*keys, salt: str, part: int) -> Column:
    """FN1 from one digest: draw ``part`` (0 to 3) of the four that 128 bits hold. Draws of the same keys and salt share
    the digest, so a row of many draws hashes once."""
    b = millionths(F.md5(key_text(*keys, F.lit(str(salt)))))[part]
    return (b.cast("decimal(7,0)") * dec("0.000001")).cast("decimal(7,6)")


def bucket(*keys, salt: str, n: int, family: Family = "md5") -> Column:
    """Integer in [0, n)."""
    return F.pmod(hash_bits(*keys, salt=salt, family=family), F.lit(int(n)).cast("long"))


def uniform(*keys, salt: str, family: Family = "md5") -> Column:
    """FN1: uniform draw in [0, 1) as DECIMAL(7,6) (1e6 buckets)."""
    b = bucket(*keys, salt=salt, n=UNIFORM_BUCKETS, family=family)
    return (b.cast("decimal(7,0)") * dec("0.000001")).cast("decimal(7,6)")


def bounded_int(*keys, salt: str, lo: int, hi: int, family: Family = "md5") -> Column:
    """FN2: integer in the inclusive range [lo, hi]."""
    span = int(hi) - int(lo) + 1
    return (bucket(*keys, salt=salt, n=span, family=family) + F.lit(int(lo))).cast("int")


def bounded_by(*keys, salt: str, upper: Column, family: Family = "md5") -> Column:
    """Integer in [1, upper] for a per-row positive integer bound (e.g. quantity)."""
    return (F.pmod(hash_bits(*keys, salt=salt, family=family), upper.cast("long")) + F.lit(1)).cast("int")


def pick(values: Sequence[str], *keys, salt: str, family: Family = "md5") -> Column:
    """FN4/FN5: uniform pick from a literal pool (repeat an entry to weight it)."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, bounded_int(*keys, salt=salt, lo=1, hi=len(values), family=family))


def threshold(cum: int, total: int) -> Decimal:
    """Cumulative-weight threshold, rounded half-up to the draw's 6 decimals."""
    from decimal import ROUND_HALF_UP
    return (Decimal(cum) / Decimal(total)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)


def cap1(x: Column) -> Column:
    """Capitalise a single token (first letter upper, rest lower)."""
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))


def weighted_pick(u: Column, values: Sequence, weights: Sequence[int]) -> Column:
    """FN6/FN7: map one uniform draw to a value by cumulative integer weights.

    Thresholds are exact decimals, so the mapping is identical in any engine.
    """
    total = sum(weights)
    if len(values) != len(weights) or total <= 0:
        raise ValueError("values and positive weights must align")
    expr = None
    cum = 0
    for v, w in zip(values[:-1], weights[:-1]):
        cum += w
        cond = u < dec(threshold(cum, total), 10, 6)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    last = F.lit(values[-1])
    return last if expr is None else expr.otherwise(last)


def bernoulli(u: Column, p) -> Column:
    """FN11: ``u < p`` with ``p`` an exact decimal."""
    return u < dec(p, 10, 6)


def nullable(u: Column, p_null, value: Column, dtype: str = "string") -> Column:
    """FN11: ``value`` except null with probability ``p_null``."""
    return F.when(bernoulli(u, p_null), F.lit(None).cast(dtype)).otherwise(value)


def affine(u: Column, lo, hi, scale: int = 6) -> Column:
    """FN13: ``lo + u * (hi - lo)`` exactly (jitter factors such as 0.95-1.05)."""
    lo_d, hi_d = Decimal(str(lo)), Decimal(str(hi))
    return (dec(lo_d, 12, scale) + u * dec(hi_d - lo_d, 12, scale)).cast(f"decimal(18,{scale})")


def rank_pick(u: Column, n: int) -> Column:
    """FN10: uniform rank in 1..n."""
    return (F.floor(u * F.lit(int(n))) + F.lit(1)).cast("long")


def long_tail_rank(u: Column, n: int) -> Column:
    """FN9: long-tail rank ``floor(u^3 * n) + 1`` (biased to low ranks), exact."""
    return (F.floor(u * u * u * F.lit(int(n))) + F.lit(1)).cast("long")


def percent_flag(*keys, salt: str, pct: int, family: Family = "md5") -> Column:
    """FN12: ``pmod(hash, 100) < pct`` without ``abs`` (ANSI-safe)."""
    return bucket(*keys, salt=salt, n=100, family=family) < F.lit(int(pct))


def id64(*keys, tag: str, family: Family = "md5") -> Column:
    """FN14: non-negative 60-bit (md5) or 64-bit (murmur3) id from keys + tag."""
    if family == "md5":
        text = F.concat_ws(_SEP, *_texts(keys), F.lit(str(tag)))
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return F.xxhash64(*_marked(keys), F.lit(str(tag)))


def id128(*keys, tag: str) -> Column:
    """FN14: the full 128-bit digest of keys + tag as 32 hexadecimal digits (safe as a primary key).

    Each key stands in it with its length, or as ``null``: keys that differ in any place have different texts."""
    texts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("null")) for t in (_col(k).cast("string") for k in keys)]
    return F.md5(F.concat_ws(_SEP, *texts, F.lit(str(tag))))


def yyyymmdd(d: Column) -> Column:
    """SC9: date -> ``yyyymmdd`` long key."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("long")


def sk_to_date(sk: Column) -> Column:
    """SC9: ``yyyymmdd`` long key -> date."""
    return F.to_date(sk.cast("string"), "yyyyMMdd")


def shifted_date_sk(d: Column, lag_days: Column, max_date: Column) -> Column:
    """FN3: date key of ``d + lag`` clamped to the calendar end (keeps RI)."""
    return yyyymmdd(F.least(F.date_add(d, lag_days), max_date))


def safe_ratio(num: Column, den: Column) -> Column:
    """FN16: ``num / den`` as double, null when ``den`` is 0 or null (ANSI-safe)."""
    return F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))


def round2(x: Column) -> Column:
    """FN15: money rounding on exact decimals (half away from zero in any engine)."""
    return F.round(x, 2).cast("decimal(18,2)")
