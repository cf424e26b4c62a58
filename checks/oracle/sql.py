"""Small SQL text helpers for the DuckDB side."""

from __future__ import annotations

from checks.adapters import bronze_cte

AS_OF = "DATE '2001-09-01'"
_CASTS = {"f": "DOUBLE", "i": "BIGINT", "s": "VARCHAR"}
_DELIMS = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def final(spec: str, source: str) -> str:
    """``SELECT`` of the columns in ``spec``; ``:f :i :s`` ask for double, bigint, text."""
    items = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        items.append(f"CAST({name} AS {_CASTS[kind]}) AS {name}" if kind else name)
    return f"SELECT {', '.join(items)} FROM {source}"


def with_(ctes: dict[str, str], select: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes.items()) + f"\n{select}"


def bronze(*tables: str) -> dict[str, str]:
    return {f"b_{t}": bronze_cte(t) for t in tables}


def title(x: str) -> str:
    words = f"regexp_extract_all(lower({x}), '[^{_DELIMS}]+|[{_DELIMS}]+')"
    parts = f"list_transform({words}, lambda w: upper(w[1]) || w[2:])"
    return f"CASE WHEN {x} = '' THEN '' ELSE list_aggregate({parts}, 'string_agg', '') END"


def ttitle(x: str) -> str:
    return title(f"trim({x})")


def boolean(x: str) -> str:
    s = f"lower(trim(CAST({x} AS VARCHAR)))"
    return (
        f"CASE WHEN {s} IN ('true','t','yes','y','on','1') THEN TRUE "
        f"WHEN {s} IN ('false','f','no','n','off','0') THEN FALSE END"
    )


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def dt(x: str) -> str:
    return f"TRY_CAST({x} AS DATE)"


def tm(x: str) -> str:
    return f"strftime(TRY_CAST('1970-01-01 ' || {x} AS TIMESTAMP), '%H:%M:%S')"


def hr(x: str) -> str:
    return f"hour(TRY_CAST('1970-01-01 ' || {x} AS TIMESTAMP))"


def r2(x: str) -> str:
    """Round half away from zero; the nudge undoes binary error in exact decimal halves."""
    return f"round(({x}) + sign({x}) * 1e-9, 2)"


def ratio(a: str, b: str) -> str:
    return r2(f"CAST({a} AS DOUBLE) / nullif({b}, 0)")


def pct(a: str, b: str) -> str:
    return r2(f"CAST({a} AS DOUBLE) * 100 / nullif({b}, 0)")


def least(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN least({a}, {b}) END"


def latest(source: str, key: str, by: str = "ts") -> str:
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {by} DESC NULLS FIRST) = 1"
    )
