"""Fields from landed result pages (HTML text columns), as native regex expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolith.functions import text
from ferrolith.operators.selection import first_per_group

# Markers of the result pages.
MISSING_DESCRIPTION = "Description introuvable (Bloqué ?)"
CARD_MARK = 'data-testid="property-card"'


def first_match(html: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, NULL when absent or empty."""
    return F.nullif(F.regexp_extract(html, pattern, group), F.lit(""))


def tag_text(html: Column, tag: str) -> Column:
    return first_match(html, rf"(?s)<{tag}[^>]*>(.*?)</{tag}>")


def meta_content(html: Column, name: str) -> Column:
    return first_match(html, rf'<meta[^>]*name="{name}"[^>]*content="([^"]*)"')


def first_link(html: Column) -> Column:
    return first_match(html, r'<a[^>]*href="([^"]*)"')


def visible_text(html: Column) -> Column:
    """Text of a fragment: tags become spaces, runs of white space one space."""
    return F.trim(F.regexp_replace(text.strip_tags(html, " "), r"\s+", " "))


def description(html: Column, blocks: list[str], limit: int = 500) -> Column:
    """First block pattern that matches, else the meta description; shortened, or a fixed note when none."""
    found = [visible_text(first_match(html, pattern)) for pattern in blocks]
    whole = text.first_filled(*found, meta_content(html, "description"))
    return F.coalesce(text.shorten(whole, limit), F.lit(MISSING_DESCRIPTION))


def element_text(html: Column, tag: str, test_id: str) -> Column:
    """Text directly after the opening tag of the element with this test id."""
    return first_match(html, rf'<{tag}[^>]*data-testid="{test_id}"[^>]*>([^<]*)')


def listings(pages: DataFrame, page_id: str, city_id: str, city: str, html: str, base_url: str,
             per_city: int = 20) -> DataFrame:
    """One row per listing card of a landed result page, the first ``per_city`` cards of each city."""
    cards = pages.select(
        page_id, city_id, city, F.posexplode(F.split(F.col(html), CARD_MARK)).alias("place", "card")
    ).filter(F.col("place") > 0)
    kept = first_per_group(cards, [city_id], [page_id, "place"], per_city, "rank")
    card = F.col("card")
    price = element_text(card, "span", "price-and-discounted-price")
    score = first_match(card, r'data-testid="review-score"[^>]*>\s*<div[^>]*>([^<]*)')
    link = first_match(card, r'<a[^>]*data-testid="title-link"[^>]*href="([^"]*)"')
    return kept.select(
        F.col(city_id).alias("id_ville"), F.col(city).alias("ville"),
        element_text(card, "div", "title").alias("nom_hotel"), text.absolute_url(link, base_url).alias("url"),
        text.comma_to_point(score).alias("score"), text.digits_only(price).alias("prix"), "rank")
