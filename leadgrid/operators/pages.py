"""Crawled pages: lines, evidence, categories, links, context and its quality gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadgrid.functions.bands import is_true, ratio
from leadgrid.functions.text import any_term, normalize_space, pattern_labels
from leadgrid.operators.grouping import best_k_per_key, best_per_key

IMAGE = r"!\[([^\]]*)\]\(([^)\s]*)\)"
LINK = r"(?:^|[^!])\[([^\]]+)\]\(([^)\s]*)\)"
# Query parameters that only track visitors, and file types that are no pages.
TRACKING = ("utm_[^=&#]*", "_ga", "gclid", "fbclid")
ASSET = r"(?i)\.(?:svg|png|jpe?g|gif|webp|css|js|ico|zip|mp4)(?:[?#]|$)"
# Menu and form labels in the languages of the crawled sites; callers may pass their own.
NOISE = ("inicio", "home", "menu", "menú", "nombre", "mensaje", "enviar", "name", "message", "send",
         "submit", "search", "buscar", "login", "leer más", "read more")
PROOF = ("caso", "case", "client", "portfolio", "portafolio", "testimonial", "customer")
LEGAL = ("privacidad", "privacy", "legal", "aviso", "terms", "cookies")
MIN_PROFILE_CHARS = 300
IMAGE_LABEL = "Image: "


# --- gates and keys ----------------------------------------------------------------

def profileable(clean_text: Column) -> Column:
    """Null when the text can be profiled, else the reason why not."""
    n = F.length(F.trim(F.coalesce(clean_text, F.lit(""))))
    return F.when(n == 0, "no_clean_text").when(n < MIN_PROFILE_CHARS, "thin_text")


def page_categories(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Labels of the rule patterns that the text satisfies."""
    return pattern_labels(text, rules)


def crawl_is_enough(ok: Column, clean_text: Column, categories: Column) -> Column:
    """Good crawl, enough text, and both an offer and an audience."""
    return is_true(ok) & profileable(clean_text).isNull() & is_true(F.array_contains(categories, "offer")) \
        & is_true(F.array_contains(categories, "audience"))


def same_page_key(url: Column, tracking: Sequence[str] = TRACKING) -> Column:
    """Address without tracking parameters and fragment."""
    bare = F.regexp_replace(url, r"#.*$", "")
    bare = F.regexp_replace(bare, r"([?&])(?:" + "|".join(tracking) + r")=[^&#]*", "$1")
    bare = F.regexp_replace(F.regexp_replace(bare, r"&{2,}", "&"), r"\?&+", "?")
    return F.regexp_replace(bare, r"[?&]+$", "")


def distinct_pages(pages: DataFrame, url: str, order: str, tracking: Sequence[str] = TRACKING) -> DataFrame:
    """First page of those that differ only by tracking parameters."""
    keyed = pages.withColumn("page_key", same_page_key(F.col(url), tracking))
    return best_per_key(keyed, ["page_key"], [F.asc(order)])


def internal_proof_links(links: Column, host: Column, k: int, proof: Sequence[str] = PROOF) -> Column:
    """Best ``k`` links of an array of (href, text): same host, no files, proof pages first."""
    def local(link: Column) -> Column:
        href = F.lower(link["href"])
        target = F.regexp_replace(F.regexp_extract(href, r"^https?://([^/?#:]+)", 1), r"^www\.", "")
        return ((target == F.lower(host)) | href.startswith("/")) & ~href.rlike(ASSET)
    kept = F.filter(links, local)
    scored = F.transform(kept, lambda x, i: F.struct(
        F.when(any_term(F.concat(x["href"], F.lit(" "), x["text"]), proof), 0).otherwise(1).alias("rank"),
        i.alias("place"), x["href"].alias("href")))
    return F.slice(F.array_distinct(F.transform(F.sort_array(scored), lambda x: x["href"])), 1, k)


# --- lines ----------------------------------------------------------------------------

def page_markdown(html: Column) -> Column:
    """Plain line form of simple HTML: images and links in brackets, block tags end a line.

    Attributes may come in any order and either quotes; an image needs no caption.
    """
    md = F.regexp_replace(html, r"(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>|<!--.*?-->", " ")
    md = F.regexp_replace(md, r"\s+", " ")
    md = F.regexp_replace(md, r"(?i)\b(src|alt|href)\s*=\s*'([^'<>]*)'", '$1="$2"')
    md = F.regexp_replace(md, r"(?i)<img[^>]*alt=\"([^\"]*)\"[^>]*src=\"([^\" ]*)\"[^>]*>", "![$1]($2)")
    md = F.regexp_replace(md, r"(?i)<img[^>]*src=\"([^\" ]*)\"[^>]*alt=\"([^\"]*)\"[^>]*>", "![$2]($1)")
    md = F.regexp_replace(md, r"(?i)<img[^>]*src=\"([^\" ]*)\"[^>]*>", "![]($1)")
    # Inline markup goes first, so that a link's text is plain.
    md = F.regexp_replace(md, r"(?i)</?(b|strong|i|em|u|span|small|font|mark)(\s[^>]*)?>", " ")
    md = F.regexp_replace(md, r"(?i)<a [^>]*href=\"([^\" ]*)\"[^>]*>([^<]*)</a>", "[$2]($1)")
    md = F.regexp_replace(md, r"(?i)</?(p|div|li|ul|ol|h[1-6]|tr|table|article|section|nav|footer|header|title|br|body|head)[^>]*>", "\n")
    return F.regexp_replace(md, r"<[^>]+>", " ")


def evidence_links(markdown: Column, proof: Sequence[str] = PROOF) -> Column:
    """Struct of all images (alt, url) and of the links that prove work done (text, url)."""
    text = F.coalesce(markdown, F.lit(""))

    def pairs(pattern: str, label: str) -> Column:
        return F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias(label),
                            F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("url"))
    links = F.filter(pairs(LINK, "text"), lambda x: any_term(F.concat(x["text"], F.lit(" "), x["url"]), proof)
                     | F.lower(x["url"]).rlike(r"\.pdf(?:[?#]|$)"))
    return F.struct(pairs(IMAGE, "alt").alias("visual_assets"), links.alias("evidence_links"))


def visible_line(line: Column) -> Column:
    """What a reader sees of a line: image captions, link text, mail addresses, no markup."""
    out = F.regexp_replace(line, IMAGE, IMAGE_LABEL + "$1 ")
    out = F.regexp_replace(out, r"\[([^\]]*)\]\(mailto:([^)?\s]*)[^)]*\)", "$1 $2")
    out = F.regexp_replace(out, r"\[([^\]]*)\]\([^)]*\)", "$1")
    return normalize_space(F.regexp_replace(out, r"^[\s#>*]+|[*_`]{2,}", " "))


def page_lines(pages: DataFrame, site: str, page: str, markdown: str, noise: Sequence[str] = NOISE,
               legal: Sequence[str] = LEGAL, path: str = "path") -> DataFrame:
    """Useful lines as rows: blank, menu and form lines dropped, short facts kept."""
    lines = pages.select(site, page, any_term(F.col(path), legal).alias("is_legal"),
                         F.posexplode_outer(F.split(F.coalesce(markdown, F.lit("")), r"\r?\n")).alias("pos", "_raw"))
    seen = lines.withColumn("line", visible_line(F.col("_raw"))).drop("_raw")
    is_image = F.col("line").startswith(IMAGE_LABEL.strip())
    empty_image = is_image & (F.length("line") <= len(IMAGE_LABEL.strip()))
    return seen.where((F.col("line") != "") & ~F.lower("line").isin(*noise) & ~empty_image) \
               .withColumn("is_image", is_image)


def clean_page_lines(lines: DataFrame, site: str, page: str, budget: int = 10_000, legal_chars: int = 2_000,
                     images: int = 5, useful: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """One context text per site: every line once, the useful ones first, within ``budget``.

    Legal pages get at most ``legal_chars`` and images at most ``images`` lines. A line takes
    at least two characters with its line end, so ``budget / 2`` lines always suffice: a site
    of any size is cut to that bound exactly, in parallel, before anything is gathered.
    """
    hit = F.size(pattern_labels(F.col("line"), useful)) > 0 if useful else F.lit(False)
    rank = F.when(F.col("is_legal"), 2).when(hit, 0).otherwise(1)
    place = F.struct(rank.alias("rank"), F.col(page).alias("page"), F.col("pos"))
    firsts = lines.groupBy(site, F.lower("line").alias("_k")).agg(
        F.min(F.struct(place.alias("place"), "line", "is_legal", "is_image")).alias("_f")) \
        .select(site, "_f.place", "_f.line", "_f.is_legal", "_f.is_image")
    order = [F.asc("place"), F.asc("line")]
    # One ranking within the three classes of lines, each cut by its own limit.
    classed = firsts.withColumn("_class", F.when(F.col("is_image"), "image").when(F.col("is_legal"), "legal").otherwise("main"))
    ranked = best_k_per_key(classed, [site, "_class"], order, budget // 2, rank_as="_n")
    size = F.length("line") + 1
    within = Window.partitionBy(site, "_class").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranked.withColumn("_used", F.sum(size).over(within)).where(
        ((F.col("_class") != "image") | (F.col("_n") <= images)) & ((F.col("_class") != "legal") | (F.col("_used") <= legal_chars)))
    # At most budget lines per site are left, so the running sum and the list are bounded.
    whole = Window.partitionBy(site).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    fit = rows.withColumn("_used", F.sum(size).over(whole)).where(F.col("_used") <= budget)
    return fit.groupBy(site).agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("_l")) \
        .select(site, F.array_join(F.transform("_l", lambda x: x["line"]), "\n").alias("clean_text"),
                F.size("_l").alias("n_lines"))


# --- measures --------------------------------------------------------------------------

def size_percentiles(df: DataFrame, keys: Sequence[str], length: Column) -> DataFrame:
    """Exact median, p90 and maximum of a length.

    Lengths are counted first: the percentile runs over a histogram, never over rows.
    """
    hist = df.groupBy(*keys, length.alias("_len")).agg(F.count(F.lit(1)).alias("_n"))
    return hist.groupBy(*keys).agg(
        F.sum("_n").alias("n"), F.expr("percentile(_len, 0.5, _n)").alias("median"),
        F.expr("percentile(_len, 0.9, _n)").alias("p90"), F.max("_len").alias("largest"))


def recall(found: Column, expected: Column) -> Column:
    """Share of the expected distinct items that were found; 1 when nothing is expected."""
    expected = F.array_distinct(expected)
    return F.when(F.size(expected) == 0, F.lit(1.0)).otherwise(
        ratio(F.size(F.array_intersect(expected, found)), F.size(expected)))


def recall_gate(df: DataFrame, entity_recall: Column, signal_recall: Column,
                min_entity: float = 0.995, min_signal: float = 0.98) -> DataFrame:
    """Mean recall of entities and signals after cleaning, and whether both gates hold."""
    out = df.agg(F.count(F.lit(1)).alias("pages"), F.avg(entity_recall).alias("entity_recall"),
                 F.avg(signal_recall).alias("signal_recall"))
    return out.withColumn("passed", (F.col("entity_recall") >= min_entity) & (F.col("signal_recall") >= min_signal))
