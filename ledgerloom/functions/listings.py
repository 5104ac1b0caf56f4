"""Rental listing text: prices, bedrooms, details."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Usual rents by bedrooms, and the rest.
RENT_BY_BEDS = {1: 1220.0, 2: 1460.0}
RENT_OTHERWISE = 1375.0
EN_DASH = "–"
MIDDLE_DOT = "·"


def _plain_number(text: Column) -> Column:
    """A number, or null; the words nan and inf do not count as numbers."""
    return F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$"), text.try_cast("double"))


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cleaned(text: Column, is_price: bool) -> Column:
    cleaned = F.lower(F.trim(text))
    if is_price:
        cleaned = F.regexp_replace(cleaned, r"[$,]", "")
    cleaned = F.regexp_replace(cleaned, "beds|bed", "")
    return F.regexp_replace(F.replace(cleaned, F.lit("studio"), F.lit("0")), " ", "")


def parse_numeric_range(text: Column, is_price: bool = True) -> Column:
    """``struct(low, high)`` from ``$1,200 – $1,500`` or ``Studio – 2 Beds``; both or none.

    Split at the first en dash, else at the first hyphen; without either the one number
    is both ends.
    """

    def sides(cleaned: Column) -> Column:
        dash = F.when(F.contains(cleaned, F.lit(EN_DASH)), EN_DASH).otherwise("-")
        return F.transform(F.split(cleaned, dash, 2), _plain_number)

    def ends(numbers: Column) -> Column:
        low, high = F.get(numbers, F.lit(0)), F.element_at(numbers, -1)
        both = low.isNotNull() & high.isNotNull()
        return F.struct(F.when(both, low).alias("low"), F.when(both, high).alias("high"))

    return _bound(_bound(_cleaned(text, is_price), sides), ends)


def parse_listing_detail(text: Column) -> Column:
    """``struct(bedrooms, area)`` from a detail line such as ``1–2 Bedrooms ... · Area``."""
    pattern = f"^(.*?)Bedrooms?.*{MIDDLE_DOT}(.*)"
    has_beds = text.rlike(pattern)
    studio = F.contains(text, F.lit("Studio")) & F.contains(text, F.lit(MIDDLE_DOT))
    parts = F.split(text, MIDDLE_DOT)
    studio_beds = F.trim(F.replace(F.get(parts, F.lit(0)), F.lit("Apartment"), F.lit("")))
    bedrooms = (
        F.when(has_beds, F.trim(F.regexp_extract(text, pattern, 1)))
        .when(studio, studio_beds)
        .otherwise("")
    )
    area = (
        F.when(has_beds, F.trim(F.regexp_extract(text, pattern, 2)))
        .when(studio, F.trim(F.get(parts, F.lit(1))))
        .otherwise(F.trim(text))
    )
    return F.struct(bedrooms.alias("bedrooms"), area.alias("area"))


def fill_rent_by_beds(price: Column, beds: Column) -> Column:
    usual = F
    for count, rent in RENT_BY_BEDS.items():
        usual = usual.when(beds == count, rent)
    return F.coalesce(price, usual.otherwise(RENT_OTHERWISE))


def zip_code(address: Column) -> Column:
    """The last five-digit group of an address, or null."""
    return F.nullif(F.regexp_extract(address, r"^.*\b([0-9]{5})\b", 1), F.lit(""))
