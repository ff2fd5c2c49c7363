"""Column helpers that derive keys: domains, ids, hashes, numbers, dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadgrid.functions.text import fold_accents, normalize_space

# Fixed value: what counts as a valid normalized domain.
DOMAIN_PATTERN = r"^[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)+$"

# Midpoint of each headcount range label.
HEADCOUNT_MIDPOINTS = {
    "1-10": 5, "11-50": 30, "51-200": 125, "201-500": 350,
    "501-1000": 750, "1001-5000": 3000, "5001-10000": 7500, "10001+": 15000,
}


def norm_domain(col: Column) -> Column:
    """Lower-case host without scheme, www, path and port; null unless it is a domain."""
    bare = F.regexp_replace(F.lower(F.trim(F.coalesce(col, F.lit("")))), r"^https?://", "")
    bare = F.regexp_replace(bare, r"^www\.", "")
    host = F.split_part(F.split_part(bare, F.lit("/"), F.lit(1)), F.lit(":"), F.lit(1))
    return F.when(host.rlike(DOMAIN_PATTERN), host)


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``norm_domain`` callable from SQL; it is inlined by the optimizer."""
    pattern = DOMAIN_PATTERN.replace("\\", "\\\\")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION norm_domain(d STRING) RETURNS STRING RETURN
        SELECT CASE WHEN x RLIKE '{pattern}' THEN x END FROM (SELECT split_part(split_part(
            regexp_replace(regexp_replace(lower(trim(coalesce(d, ''))), '^https?://', ''),
                           '^www\\\\.', ''), '/', 1), ':', 1) AS x)""")


def domain_from_website(col: Column) -> Column:
    """Host of a website address, lower case, without www; null for a broken address."""
    text = normalize_space(col)
    url = F.when(F.contains(text, F.lit("://")), text).otherwise(F.concat(F.lit("https://"), text))
    host = F.regexp_extract(
        url, r"^[^:/?#]+://(?:[^/?#]*@)?(?:\[([^\]]*)\]|([^/?#:\[\]]*))(?::\d*)?(?:[/?#].*)?$", 2)
    return F.nullif(F.regexp_replace(F.lower(host), r"^www\.", ""), F.lit(""))


def clean_domain(col: Column) -> Column:
    """Lower case, no scheme, www or path. No validity check."""
    bare = F.regexp_replace(F.lower(col), r"^https?://", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"^www\.", ""), r"(?s)/.*$", ""))


def email_domain(col: Column) -> Column:
    """Text after the first @ in lower case; null without an @."""
    return F.when(F.contains(col, F.lit("@")),
                  F.lower(F.substr(col, F.locate("@", col) + 1)))


def safe_int(col: Column) -> Column:
    """First run of digits (thousands commas allowed) as a number, else null."""
    digits = F.regexp_extract(F.coalesce(col.cast("string"), F.lit("")), r"\d[\d,]*", 0)
    return F.replace(digits, F.lit(",")).try_cast("bigint")


def normalize_timestamp(col: Column) -> Column:
    """A bare date becomes midnight UTC; other text is kept; blank becomes null."""
    text = normalize_space(col)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(text, F.lit("T00:00:00+00:00"))) \
            .otherwise(F.nullif(text, F.lit("")))


def parse_timestamp(col: Column) -> Column:
    """ISO text (``Z`` allowed) to a timestamp; anything else is null."""
    return F.try_to_timestamp(normalize_space(col))


def country_code_from_address(col: Column) -> Column:
    """``addressCountry`` of a JSON object in upper case (``to_json`` of a struct). A hint, never the headquarters."""
    code = F.get_json_object(col, "$.addressCountry")
    return F.nullif(F.upper(normalize_space(code)), F.lit(""))


def content_hash(col: Column) -> Column:
    return F.sha2(F.coalesce(col, F.lit("")), 256)


def surrogate_id(source_id: Column, url: Column, title: Column, company: Column,
                 text: Column) -> Column:
    """The source id, or ``hash:`` plus 24 hex digits of the posting's own fields."""
    basis = F.concat_ws("|", F.coalesce(url, F.lit("")), normalize_space(title),
                        normalize_space(company), F.substring(F.coalesce(text, F.lit("")), 1, 500))
    return F.coalesce(F.nullif(normalize_space(source_id), F.lit("")),
                      F.concat(F.lit("hash:"), F.substring(F.sha2(basis, 256), 1, 24)))


def parse_category(col: Column) -> Column:
    """JSON object text to a map; anything else becomes an empty map."""
    parsed = F.from_json(col, "map<string,string>")
    return F.coalesce(F.when(F.ltrim(col).startswith("{"), parsed),
                      F.create_map().cast("map<string,string>"))


def coalesce_meta(col: Column, keys: Sequence[str]) -> Column:
    """First non-blank value among several map keys."""
    return F.coalesce(*[F.nullif(F.element_at(col, F.lit(k)), F.lit("")) for k in keys])


def headcount_midpoint(col: Column) -> Column:
    """Range label to midpoint; unknown labels are null."""
    pairs = [F.lit(v) for item in HEADCOUNT_MIDPOINTS.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), col)


def top_key(col: Column) -> Column:
    """Key with the highest value; the smaller key wins a tie."""
    entries = F.map_entries(col)
    best = F.array_max(F.transform(entries, lambda e: e["value"]))
    tied = F.filter(entries, lambda e: e["value"] == best)
    return F.array_min(F.transform(tied, lambda e: e["key"]))


def name_key(col: Column) -> Column:
    """Company-name key: folded accents, letters and digits only, single blanks."""
    return F.nullif(F.trim(F.regexp_replace(fold_accents(normalize_space(col)),
                                            r"[^a-z0-9]+", " ")), F.lit(""))


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970 of a time column; wall-clock times are read as UTC. No session setting matters."""
    kind = dict(df.dtypes)[col]
    if kind == "string":  # a provider's text is the same everywhere
        return F.col(col)
    if kind == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(col))
    return F.unix_micros(F.col(col).cast("timestamp"))


def send_key(workspace: Column, lead: Column, campaign: Column, step: Column, sent_micros: Column) -> Column:
    """Deterministic id of one send, so that a repeated load adds nothing; the time as ``epoch_micros``."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (workspace, lead, campaign, step, sent_micros)]
    return F.sha2(F.concat_ws("|", *parts), 256)
