"""Rental listings: one schema, ranges, fills, union, enrichment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.listings import fill_rent_by_beds, parse_numeric_range, zip_code
from ..operators.order_stats import exact_percentiles
from ..operators.rows import top_per_group

LISTING_CAP = 400
# Names of one site's columns in the common schema.
RENAMES = {
    "padmapper.com": {"address": "Title", "price": "Price", "bedrooms": "Beds", "area": "Address", "url": "URL"},
    "craigslist": {"Bedrooms": "Beds", "Location": "Address"},
}
COLUMNS = ["Source", "Title", "Address", "URL", "Price", "Beds", "price_min", "price_max", "beds_min", "beds_max"]


def standardise(listings: DataFrame, site: str) -> DataFrame:
    renamed = listings.withColumnsRenamed(RENAMES.get(site, {}))
    return renamed.withColumn("Source", F.lit(site))


def with_ranges(listings: DataFrame) -> DataFrame:
    parsed = listings.withColumns(
        {
            "_price": parse_numeric_range(F.col("Price"), is_price=True),
            "_beds": parse_numeric_range(F.col("Beds"), is_price=False),
        }
    )
    return parsed.withColumns(
        {
            "price_min": F.col("_price.low"), "price_max": F.col("_price.high"),
            "beds_min": F.col("_beds.low"), "beds_max": F.col("_beds.high"),
        }
    ).drop("_price", "_beds")


def fill_beds(listings: DataFrame) -> DataFrame:
    lowest = F.coalesce("beds_min", F.lit(1.0))
    return listings.withColumns({"beds_min": lowest, "beds_max": F.coalesce(F.col("beds_max"), lowest)})


def fill_prices_by_beds(listings: DataFrame) -> DataFrame:
    """Runs before the beds are filled, so a listing of unknown size gets the general rent."""
    beds = F.col("beds_min")
    return listings.withColumns({c: fill_rent_by_beds(F.col(c), beds) for c in ("price_min", "price_max")})


def fill_prices_by_median(listings: DataFrame) -> DataFrame:
    """Missing prices take their column's median; both medians come from one pass."""
    columns = ("price_min", "price_max")
    prices = listings.select(*columns).unpivot([], list(columns), "_column", "_price")
    medians = exact_percentiles(prices, F.col("_price"), {"median": 0.5}, ["_column"]).agg(
        F.struct(*[F.max(F.when(F.col("_column") == c, F.col("median"))).alias(c) for c in columns]).alias("medians")
    ).scalar()
    return listings.withColumns({c: F.coalesce(F.col(c), medians[c]) for c in columns})


def merge_sites(by_beds: DataFrame, by_median: DataFrame, *, site_by_beds: str, site_by_median: str) -> DataFrame:
    """The cleaned union of two sites, each with its own price fill."""
    first = fill_beds(fill_prices_by_beds(with_ranges(standardise(by_beds, site_by_beds))))
    second = fill_beds(fill_prices_by_median(with_ranges(standardise(by_median, site_by_median))))
    return listing_union([first, second]).select(*COLUMNS)


def listing_union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def listing_cap(listings: DataFrame, arrival: str, cap: int = LISTING_CAP) -> DataFrame:
    """The first ``cap`` listings of each site in order of arrival."""
    return top_per_group(listings, ["Source"], [F.col(arrival)], cap)


def enrich_with_income(listings: DataFrame, income: DataFrame) -> DataFrame:
    """Median income by ZIP code. ``income(zip, median_income)`` has one row per ZIP."""
    return listings.withColumn("zip", zip_code(F.col("Address"))).join(income, "zip", "left")
