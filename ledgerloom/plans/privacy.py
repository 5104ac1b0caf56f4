"""De-identification of whole tables by a column policy."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import person_token
from ..functions.privacy import OLDEST_SHOWN_AGE, age_band, generalise_zip

# Columns that must not leave the source.
DIRECT_IDENTIFIERS = (
    "first", "last", "prefix", "suffix", "maiden", "name", "drivers", "passport", "payer", "plan",
    "provider", "organization", "appointment", "city", "address", "lat", "lon",
)


def drop_identifiers(df: DataFrame, policy: Iterable[str] = DIRECT_IDENTIFIERS) -> DataFrame:
    barred = {name.lower() for name in policy}
    return df.drop(*[c for c in df.columns if c.lower() in barred])


def generalise(people: DataFrame, populations: DataFrame, as_of_year: int) -> DataFrame:
    """ZIP, birth date and age in their coarse form; ages in the open band show no birth year.

    ``people(person_id, zip, birth_date)``, ``populations(zip_3digit, population)``. All other
    dates of ``people`` become years; other columns stay.
    """
    keyed = people.withColumn("zip_3digit", F.left("zip", F.lit(3)))
    joined = keyed.join(populations, "zip_3digit", "left")
    age = F.lit(as_of_year) - F.year("birth_date")
    rest = generalise_dates(people.drop("person_id", "zip", "birth_date")).columns
    return generalise_dates(joined, keep=["birth_date"]).select(
        "person_id",
        generalise_zip(F.col("zip"), F.col("population")).alias("zip_3digit"),
        F.when(age <= OLDEST_SHOWN_AGE, F.year("birth_date")).alias("birth_year"),
        age_band(age).alias("age_band"),
        *rest,
    )


def generalise_dates(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Every date and time column gives way to its year, ``<name>_year``, but for those kept."""
    dated = {f.name for f in df.schema.fields if f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz")} - set(keep)
    return df.select(*[F.year(c).alias(f"{c}_year") if c in dated else F.col(c) for c in df.columns])


def tokenise_columns(df: DataFrame, identifiers: Iterable[str], salt: str) -> DataFrame:
    """Account, record and other numbers give way to tokens, ``<name>_token``; each column has a salt of its own."""
    named = set(identifiers)
    return df.select(*[person_token(F.col(c), f"{salt}|{c}|").alias(f"{c}_token") if c in named else F.col(c) for c in df.columns])


def tokenise(df: DataFrame, identifier: str, salt: str) -> DataFrame:
    """The identifier gives way to its token, the same one in every table."""
    return df.withColumn("patient_token", person_token(F.col(identifier), salt)).drop(identifier)


def token_map(df: DataFrame, identifier: str, salt: str) -> DataFrame:
    """Identifier and token, one row each: for a restricted store of its own."""
    return df.select(identifier).distinct().withColumn("patient_token", person_token(F.col(identifier), salt))
