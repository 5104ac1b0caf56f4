"""Rental listings: scans, cleaning, fills, union, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.listings import parse_listing_detail, parse_numeric_range
from ledgerloom.operators import profile
from ledgerloom.operators.rows import keep_first_by_key
from ledgerloom.plans import listings
from ledgerloom.session import shared_dir
from ledgerloom.sources import listings as pages

from .registry import query

APARTMENTS, PADMAPPER = "apartments.com", "padmapper.com"

PAD_COLUMNS = "'padmapper.com' AS \"Source\", address AS \"Title\", area AS \"Address\", url AS \"URL\", price AS \"Price\", bedrooms AS \"Beds\""
RENT = "CASE beds_min WHEN 1 THEN 1220.0 WHEN 2 THEN 1460.0 ELSE 1375.0 END"


@query(
    "listing_html_extract",
    r"""WITH p AS (SELECT page_id, url, length(html) AS size, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title FROM pages)
        SELECT page_id, 0 AS card, coalesce(nullif(trim(title), ''), 'No title') AS "Title", '$' || size AS "Price",
               page_id || ' Oak St' AS "Address", '2 Beds' AS "Beds", url AS "URL" FROM p
        UNION ALL SELECT page_id, 1, 'No title', '$' || length(url), 'No address', 'No beds info', 'No link' FROM p""",
)
def listing_html_extract(frames):
    return pages.extract_cards(frames.listing_pages, "page_id", "html")


@query(
    "listing_wide_html_extract",
    """SELECT page_id, 0 AS card, page_id || ' Elm St' AS address, '$' || length(url) AS price, '1–2' AS bedrooms, 'Area ' || (page_id % 9) AS area, url FROM pages
       UNION ALL SELECT page_id, 1, '', '', '', 'House', '' FROM pages""",
)
def listing_wide_html_extract(frames):
    return pages.extract_wide_cards(frames.wide_listing_pages, "page_id", "html")


@query("listing_csv_scan", '''SELECT "Title", nullif("Price", '') AS "Price", "Address", "Beds", "URL" FROM apartments''')
def listing_csv_scan(frames):
    """The first site's listings written as CSV and read back; commas inside texts are quoted."""
    path = shared_dir(frames.spark, "listings")
    frames.apartments.drop("arrival").write.option("header", True).option("escape", '"').csv(path)
    return pages.read_listings(frames.spark, path, APARTMENTS)


@query("listing_schema_standardise", f"SELECT {PAD_COLUMNS} FROM padmapper")
def listing_schema_standardise(frames):
    return listings.standardise(frames.padmapper, PADMAPPER)


@query(
    "parse_numeric_range",
    """SELECT "URL" AS url, price_min, price_max, beds_min, beds_max FROM apartments_ranged
       UNION ALL SELECT url, price_min, price_max, beds_min, beds_max FROM padmapper_ranged""",
)
def parse_numeric_range_both(frames):
    first = frames.apartments.select("URL", "Price", "Beds")
    second = frames.padmapper.select(F.col("url").alias("URL"), F.col("price").alias("Price"), F.col("bedrooms").alias("Beds"))
    price, beds = parse_numeric_range(F.col("Price")), parse_numeric_range(F.col("Beds"), is_price=False)
    return first.unionByName(second).select(
        F.col("URL").alias("url"),
        price["low"].alias("price_min"), price["high"].alias("price_max"),
        beds["low"].alias("beds_min"), beds["high"].alias("beds_max"),
    )


DETAIL = "^(.*?)Bedrooms?.*·(.*)"


@query(
    "parse_listing_detail",
    f"""SELECT listing_id,
               CASE WHEN regexp_matches(detail, '{DETAIL}') THEN trim(regexp_extract(detail, '{DETAIL}', 1))
                    WHEN contains(detail, 'Studio') AND contains(detail, '·') THEN trim(replace(split_part(detail, '·', 1), 'Apartment', ''))
                    ELSE '' END AS bedrooms,
               CASE WHEN regexp_matches(detail, '{DETAIL}') THEN trim(regexp_extract(detail, '{DETAIL}', 2))
                    WHEN contains(detail, 'Studio') AND contains(detail, '·') THEN trim(split_part(detail, '·', 2)) ELSE trim(detail) END AS area
        FROM listing_details""",
)
def parse_detail(frames):
    return frames.listing_details.select("listing_id", parse_listing_detail(F.col("detail")).alias("d")).select("listing_id", "d.*")


@query(
    "fill_rent_by_beds",
    f"SELECT arrival, coalesce(price_min, {RENT}) AS price_min, coalesce(price_max, {RENT}) AS price_max FROM apartments_ranged",
)
def fill_rent_by_beds(frames):
    return listings.fill_prices_by_beds(listings.with_ranges(frames.apartments)).select("arrival", "price_min", "price_max")


MEDIANS = "(SELECT quantile_cont(price_min, 0.5) AS m1, quantile_cont(price_max, 0.5) AS m2 FROM padmapper_ranged)"


@query(
    "fill_median",
    f"SELECT url, coalesce(price_min, m1) AS price_min, coalesce(price_max, m2) AS price_max FROM padmapper_ranged, {MEDIANS}",
)
def fill_median(frames):
    ranged = listings.with_ranges(listings.standardise(frames.padmapper, PADMAPPER))
    return listings.fill_prices_by_median(ranged).select(F.col("URL").alias("url"), "price_min", "price_max")


@query(
    "fill_beds",
    "SELECT arrival, coalesce(beds_min, 1) AS beds_min, coalesce(beds_max, beds_min, 1) AS beds_max FROM apartments_ranged",
)
def fill_beds(frames):
    return listings.fill_beds(listings.with_ranges(frames.apartments)).select("arrival", "beds_min", "beds_max")


MERGED = f"""
    SELECT 'apartments.com' AS "Source", "Title", "Address", "URL", "Price", "Beds", coalesce(price_min, {RENT}) AS price_min,
           coalesce(price_max, {RENT}) AS price_max, coalesce(beds_min, 1) AS beds_min, coalesce(beds_max, beds_min, 1) AS beds_max
    FROM apartments_ranged
    UNION ALL SELECT {PAD_COLUMNS}, coalesce(price_min, m1), coalesce(price_max, m2), coalesce(beds_min, 1), coalesce(beds_max, beds_min, 1)
    FROM padmapper_ranged, {MEDIANS}"""


@query("listing_union", MERGED)
def listing_union(frames):
    return listings.merge_sites(
        frames.apartments, frames.padmapper, site_by_beds=APARTMENTS, site_by_median=PADMAPPER
    )


@query(
    "listing_null_counts",
    f"""WITH m AS ({MERGED}), c AS (SELECT count(*) FILTER ("Price" IS NULL) AS p, count(*) FILTER ("Beds" IS NULL) AS b FROM m)
        SELECT column_name, CASE column_name WHEN 'Price' THEN p WHEN 'Beds' THEN b ELSE 0 END AS null_count,
               CASE column_name WHEN 'Price' THEN p WHEN 'Beds' THEN b ELSE 0 END > 0 AS has_nulls, p + b AS total_null_cells
        FROM c, (SELECT unnest(['Source', 'Title', 'Address', 'URL', 'Price', 'Beds', 'price_min', 'price_max', 'beds_min', 'beds_max']) AS column_name)""",
)
def listing_null_counts(frames):
    return profile.null_counts(listing_union(frames))


@query(
    "listing_cap",
    """WITH l AS (SELECT 'apartments.com' AS "Source", "URL", arrival FROM apartments
                  UNION ALL SELECT 'padmapper.com', url, CAST(replace(url, 'https://p.example/', '') AS BIGINT) FROM padmapper)
       SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY "Source" ORDER BY arrival) <= 400""",
)
def listing_cap(frames):
    first = frames.apartments.select(F.lit(APARTMENTS).alias("Source"), "URL", "arrival")
    arrival = F.replace(F.col("url"), F.lit("https://p.example/"), F.lit("")).cast("bigint")
    second = frames.padmapper.select(F.lit(PADMAPPER).alias("Source"), F.col("url").alias("URL"), arrival.alias("arrival"))
    return listings.listing_cap(listings.listing_union([first, second]), "arrival")


@query(
    "listing_income_enrich",
    f"""SELECT "Source", "URL", zip, median_income FROM (SELECT *, regexp_extract("Address", '([0-9]{{5}})$', 1) AS zip FROM ({MERGED}))
        LEFT JOIN income USING (zip)""",
)
def listing_income_enrich(frames):
    return listings.enrich_with_income(listing_union(frames), frames.income).select("Source", "URL", "zip", "median_income")


@query(
    "listing_address_dedupe",
    """WITH l AS (SELECT 'padmapper.com' AS "Source", address AS "Title", url AS "URL", CAST(replace(url, 'https://p.example/', '') AS BIGINT) AS n FROM padmapper
                  UNION ALL SELECT 'apartments.com', "Address", "URL", arrival FROM apartments)
       SELECT "Source", "Title", "URL" FROM l QUALIFY row_number() OVER (PARTITION BY "Source", "Title" ORDER BY n) = 1""",
)
def listing_address_dedupe(frames):
    """One listing per site and address, the first to arrive."""
    arrival = F.replace(F.col("URL"), F.lit("https://p.example/"), F.lit("")).cast("bigint")
    second = listings.standardise(frames.padmapper, PADMAPPER).select("Source", "Title", "URL", arrival.alias("arrival"))
    first = frames.apartments.select(F.lit(APARTMENTS).alias("Source"), F.col("Address").alias("Title"), "URL", "arrival")
    return keep_first_by_key(second.unionByName(first), ["Source", "Title"], [F.col("arrival")]).select("Source", "Title", "URL")
