"""Column rules: first-match tables, count buckets, bands and rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The empty bucket is labelled, and 50 still belongs to 11-50.
COUNT_BUCKETS = ((0, "0"), (2, "1-2"), (10, "3-10"), (50, "11-50"))
COUNT_BUCKET_ABOVE = "50+"

# Team-size routes, a different cut from the count buckets.
TEAM_ROUTES = ((1, "0-1"), (5, "2-5"), (15, "6-15"), (50, "16-50"))
TEAM_ROUTE_ABOVE = "50+"

# Percent bands, upper bounds exclusive except where said.
BOUNCE_BANDS = ((1.0, "excellent"), (2.0, "normal"), (3.0, "yellow"), (5.0, "red"))
PLACEMENT_BANDS = ((90.0, "great"), (80.0, "acceptable"), (70.0, "yellow"))

# Seniority spellings and the level they stand for.
SENIORITY_ALIASES = {
    "c-suite": "C-Team", "c-level": "C-Team", "executive": "C-Team",
    "vice president": "VP", "svp": "VP", "evp": "VP",
}


def first_match(rules: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """Value of the first rule whose condition holds."""
    out = default
    for condition, value in reversed(rules):
        out = F.when(condition, value).otherwise(out)
    return out


def upper_bound_label(col: Column, bounds: Sequence[tuple[float, str]], above: str) -> Column:
    """Label of the first inclusive upper bound; null stays null."""
    rules = [(col <= limit, F.lit(label)) for limit, label in bounds]
    return F.when(col.isNotNull(), first_match(rules, F.lit(above)))


def count_bucket(col: Column) -> Column:
    return upper_bound_label(col, COUNT_BUCKETS, COUNT_BUCKET_ABOVE)


def team_route(col: Column) -> Column:
    return upper_bound_label(col, TEAM_ROUTES, TEAM_ROUTE_ABOVE)


def bounce_band(pct: Column) -> Column:
    """<1 excellent, <2 normal, <=3 yellow, <=5 red, above stop."""
    return F.when(pct < 1, "excellent").when(pct < 2, "normal").when(pct <= 3, "yellow") \
            .when(pct <= 5, "red").when(pct > 5, "stop")


def placement_band(pct: Column) -> Column:
    """>90 great, >=80 acceptable, >=70 yellow, below red."""
    return F.when(pct > 90, "great").when(pct >= 80, "acceptable").when(pct >= 70, "yellow") \
            .when(pct < 70, "red")


def seniority_alias(col: Column) -> Column:
    rules = [(F.lower(col) == k, F.lit(v)) for k, v in SENIORITY_ALIASES.items()]
    return first_match(rules, col)


def round_half_up(col: Column, digits: int = 0) -> Column:
    """Rounds halves towards plus infinity, as the reports do."""
    scale = 10 ** digits
    rounded = F.floor(col * F.lit(float(scale)) + F.lit(0.5))
    return rounded.cast("bigint") if digits == 0 else rounded / F.lit(float(scale))


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """part / whole × scale, 0 when the whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(
        part.cast("double") / whole.cast("double") * F.lit(float(scale)))


def is_true(col: Column) -> Column:
    return F.coalesce(col, F.lit(False))
