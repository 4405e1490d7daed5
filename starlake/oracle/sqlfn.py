"""DuckDB SQL spellings of the portable keyed functions (oracle side only).

These mirror ``starlake.functions.keyed`` (md5 family) so that an independent
engine recomputes every drawn attribute from the same keys.
"""
from __future__ import annotations

from typing import Sequence

from ..functions.keyed import threshold


def _keys(keys: Sequence[str], salt: str) -> str:
    parts = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '(null)')" for k in keys)
    return f"concat_ws('|', {parts}, '{salt}')"


def bits(keys: Sequence[str], salt: str) -> str:
    return f"CAST('0x' || substr(md5({_keys(keys, salt)}), 1, 8) AS BIGINT)"


def bucket(keys: Sequence[str], salt: str, n: int) -> str:
    return f"({bits(keys, salt)} % {int(n)})"


def u(keys: Sequence[str], salt: str) -> str:
    return f"CAST({bucket(keys, salt, 1_000_000)} * 0.000001 AS DECIMAL(7,6))"


def u_part(keys: Sequence[str], salt: str, part: int) -> str:
    bits_ = f"CAST('0x' || substr(md5({_keys(keys, salt)}), {8 * part + 1}, 8) AS BIGINT)"
    return f"CAST(({bits_} % 1000000) * 0.000001 AS DECIMAL(7,6))"


def bnd(keys: Sequence[str], salt: str, lo: int, hi: int) -> str:
    return f"CAST({bucket(keys, salt, hi - lo + 1)} + {int(lo)} AS INTEGER)"


def bounded_by(keys: Sequence[str], salt: str, upper: str) -> str:
    return f"CAST(({bits(keys, salt)} % CAST({upper} AS BIGINT)) + 1 AS INTEGER)"


def pick(values: Sequence[str], keys: Sequence[str], salt: str) -> str:
    arr = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"[{arr}][{bnd(keys, salt, 1, len(values))}]"


def pct(keys: Sequence[str], salt: str, p: int) -> str:
    return f"({bucket(keys, salt, 100)} < {int(p)})"


def weighted(u_sql: str, values: Sequence[str], weights: Sequence[int]) -> str:
    total = sum(weights)
    parts, cum = [], 0
    for v, w in zip(values[:-1], weights[:-1]):
        cum += w
        t = threshold(cum, total)
        parts.append(f"WHEN {u_sql} < {t} THEN '{v}'")
    return f"(CASE {' '.join(parts)} ELSE '{values[-1]}' END)"


def id64(keys: Sequence[str], tag: str) -> str:
    return f"CAST('0x' || substr(md5({_keys(keys, tag)}), 1, 15) AS BIGINT)"


def id128(keys: Sequence[str], tag: str) -> str:
    parts = ", ".join(f"coalesce(length(CAST({k} AS VARCHAR)) || ':' || CAST({k} AS VARCHAR), 'null')" for k in keys)
    return f"md5(concat_ws('|', {parts}, '{tag}'))"


def sk(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS BIGINT)"


def cap1(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"
