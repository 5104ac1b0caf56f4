"""Rental listings from CSV exports and stored result pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.listings import parse_listing_detail

# Class tokens of listing cards, and the text shown for a missing piece.
CARD_CLASS = "placard"
CARD_FIELDS = {
    "Title": ("property-title", "No title"),
    "Price": ("property-pricing", "No price"),
    "Address": ("property-address", "No address"),
    "Beds": ("property-beds", "No beds info"),
}
LINK_CLASS, NO_LINK = "property-link", "No link"
# Beginnings of the second site's class names.
CARD_PREFIX = "ListItemFull_listItemFull"
ADDRESS_PREFIX, PRICE_PREFIX, DETAIL_PREFIX = "ListItemFull_address", "ListItemFull_price", "ListItemFull_info"

SITE_SCHEMAS = {
    "apartments.com": "Title string, Price string, Address string, Beds string, URL string",
    "padmapper.com": "address string, price string, bedrooms string, area string, url string",
    "craigslist": "Title string, Price double, Bedrooms double, Location string, URL string, Apartment_Name string",
}


def read_listings(spark: SparkSession, path: str, site: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(SITE_SCHEMAS[site]).csv(path)


def _tag(token: str, prefix: bool = False) -> str:
    """A pattern of any opening tag with that class token, wherever the attribute stands; with ``prefix`` any token that begins so."""
    rest = r"[^\"'\s]*" if prefix else ""
    return rf"<[A-Za-z][^<>]*\sclass\s*=\s*[\"'](?:[^\"'<>]*\s)?{token}{rest}(?:\s[^\"'<>]*)?[\"'][^<>]*>"


def _cards(pages: DataFrame, page_id: str, html: str, tag: str) -> DataFrame:
    """One row per card of each page: what follows the card's tag up to the next card."""
    pieces = F.split(html, tag, -1)
    return pages.select(page_id, F.posexplode(F.slice(pieces, F.lit(2), F.size(pieces))).alias("card", "_html"))


def _text(tag: str, missing: str) -> Column:
    """The first text behind a tag, tags between left out."""
    found = F.trim(F.regexp_extract("_html", tag + r"(?:\s*<[^>]*>)*([^<]*)", 1))
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(missing))


def _href(tag: Column, missing: str) -> Column:
    return F.coalesce(F.nullif(F.trim(F.regexp_extract(tag, r"\shref\s*=\s*[\"']([^\"']*)", 1)), F.lit("")), F.lit(missing))


def extract_cards(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """One row per listing card of each stored page of the first site, in page order."""
    fields = [_text(_tag(css), missing).alias(name) for name, (css, missing) in CARD_FIELDS.items()]
    link = _href(F.regexp_extract("_html", _tag(LINK_CLASS), 0), NO_LINK).alias("URL")
    return _cards(pages, page_id, html, _tag(CARD_CLASS)).select(page_id, "card", *fields, link)


def extract_wide_cards(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """One row per listing card of the second site: address, link, price and the detail line; missing pieces are empty."""
    link = F.regexp_extract("_html", _tag(ADDRESS_PREFIX, True) + r"[^<]*(<a\s[^>]*>)", 1)
    detail = parse_listing_detail(_text(_tag(DETAIL_PREFIX, True), ""))
    return _cards(pages, page_id, html, _tag(CARD_PREFIX, True)).select(
        page_id, "card", _text(_tag(ADDRESS_PREFIX, True), "").alias("address"), _text(_tag(PRICE_PREFIX, True), "").alias("price"),
        detail["bedrooms"].alias("bedrooms"), detail["area"].alias("area"), _href(link, "").alias("url"),
    )
