"""Small SQL pieces shared by the SQL twins (DuckDB dialect)."""

from __future__ import annotations


def nd(expr: str) -> str:
    """Normalized domain of an SQL expression."""
    host = (f"split_part(split_part(regexp_replace(regexp_replace(lower(trim(coalesce({expr}, ''))), "
            r"'^https?://', ''), '^www\.', ''), '/', 1), ':', 1)")
    rx = r"[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+"
    return f"CASE WHEN regexp_full_match({host}, '{rx}') THEN {host} END"


def sp(expr: str) -> str:
    """Whitespace collapsed and trimmed."""
    return rf"trim(regexp_replace(replace(coalesce({expr}, ''), chr(160), ' '), '\s+', ' ', 'g'))"


def strip(expr: str) -> str:
    """All whitespace removed at both ends."""
    return rf"regexp_replace({expr}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')"


def quoted(terms) -> str:
    return "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in terms) + "]"


def hits(expr: str, terms) -> str:
    """List of the terms found in an SQL text."""
    return f"list_filter({quoted(terms)}, lambda t: contains(lower(coalesce({expr}, '')), lower(t)))"


def rnd(expr: str, digits: int) -> str:
    scale = 10 ** digits
    return f"floor(({expr}) * {scale}.0::DOUBLE + 0.5) / {scale}.0::DOUBLE"


def rate(part: str, whole: str, scale: float = 1.0) -> str:
    return (f"CASE WHEN {whole} = 0 THEN 0.0::DOUBLE ELSE ({part})::DOUBLE / ({whole})::DOUBLE "
            f"* {float(scale)}::DOUBLE END")


def bucket(expr: str) -> str:
    return (f"CASE WHEN {expr} IS NULL THEN NULL WHEN {expr} = 0 THEN '0' WHEN {expr} <= 2 THEN '1-2' "
            f"WHEN {expr} <= 10 THEN '3-10' WHEN {expr} <= 50 THEN '11-50' ELSE '50+' END")
