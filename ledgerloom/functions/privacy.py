"""De-identification rules for text, ages, dates and regions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Replacement tokens.
EMAIL_TOKEN = "[EMAIL REMOVED]"
URL_TOKEN = "[URL REMOVED]"
IP_TOKEN = "[IP REMOVED]"
PHONE_TOKEN = "[PHONE REMOVED]"

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
URL = r"https?://[^ \t\r\n<>\"]+"
IP = r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"
PHONE = r"(\+[0-9]{1,3}[ .-]?)?(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}\b"
REDACTIONS = ((EMAIL, EMAIL_TOKEN), (URL, URL_TOKEN), (IP, IP_TOKEN), (PHONE, PHONE_TOKEN))

# What a text must have for any rule to be tried.
HINT = r"@|https?://|[0-9]\.[0-9]|[0-9]{3}"

SMALL_REGION_LIMIT = 20_000
OLDEST_SHOWN_AGE = 89


def redact_text(text: Column) -> Column:
    """Replace mail addresses, links, IP addresses and phone or fax numbers."""
    clean = text
    for pattern, token in REDACTIONS:
        clean = F.regexp_replace(clean, pattern, token)
    return F.when(text.rlike(HINT), clean).otherwise(text)


def generalise_zip(zip_code: Column, region_population: Column) -> Column:
    """Three digits, or ``000`` where the region is small or its size unknown."""
    small = region_population.isNull() | (region_population < SMALL_REGION_LIMIT)
    return F.when(zip_code.isNull(), None).when(small, "000").otherwise(F.left(zip_code, F.lit(3)))


def age_band(age: Column) -> Column:
    return F.when(age > OLDEST_SHOWN_AGE, "90+").otherwise(age.cast("string"))
