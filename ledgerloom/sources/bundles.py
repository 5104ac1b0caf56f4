"""Clinical JSON bundles: one file per row, then one row per resource.

A bundle is parsed once. Its resources come out as ``VARIANT``, whatever their type, and are written so
when landed by type; the parsers take fields out of them without parsing again. A resource that repeats a
key cannot be read; its bundle is reported by ``quarantined_bundles``.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.dates import date_prefix, duration_hours
from ..functions.keys import strip_reference

BUNDLE_SCHEMA = "resourceType string, id string, entry array<struct<resource variant>>"
CODING = "array<struct<system string, code string, display string>>"
CODED = f"struct<coding {CODING}>"
REFERENCE = "struct<reference string>"
PATIENT_SCHEMA = f"""
    id string, gender string, birthDate string, deceasedBoolean boolean, deceasedDateTime string,
    maritalStatus {CODED}, communication array<struct<language {CODED}>>,
    address array<struct<state string, postalCode string>>,
    extension array<struct<url string,
        extension array<struct<valueCoding struct<display string>, valueString string>>>>"""
ENCOUNTER_SCHEMA = f"""
    id string, status string, class struct<code string, display string>, type array<{CODED}>,
    period struct<start string, `end` string>, reasonCode array<{CODED}>,
    subject {REFERENCE}, serviceProvider {REFERENCE}"""
CONDITION_SCHEMA = f"""
    id string, code {CODED}, clinicalStatus {CODED}, verificationStatus {CODED}, category array<{CODED}>,
    onsetDateTime string, abatementDateTime string, subject {REFERENCE}, encounter {REFERENCE}"""
CLAIM_SCHEMA = f"""
    id string, status string, created string, patient {REFERENCE},
    item array<struct<encounter array<{REFERENCE}>>>,
    total array<struct<amount struct<value string>>>, payment struct<amount struct<value string>>"""
SOURCE_TAG = "FHIR_R4"
#: Parquet for rows that are written once and hold much alike text: prefixes are shared, and pages long enough for that.
COMPACT = {
    "compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.writer.version": "v2",
    "parquet.page.size": str(8 << 20), "parquet.page.row.count.limit": "1000000",
}


def read_bundles(
    spark: SparkSession, path: str, modified_after: datetime | str | None = None, one_per_file: bool = True, glob: str = "*.json"
) -> DataFrame:
    """``(file, modified, value)`` for every bundle below ``path``, optionally only of newer files; bulk exports hold one per line.

    Files are chosen before they are read: by the second for a text, exactly for a moment.
    """
    reader = spark.read.option("pathGlobFilter", glob)
    if isinstance(modified_after, str):
        reader = reader.option("modifiedAfter", modified_after)
    texts, meta = reader.text(path, wholetext=one_per_file), F.col("_metadata")
    if isinstance(modified_after, datetime):
        texts = texts.where(meta["file_modification_time"] > F.lit(modified_after))
    return texts.select(meta["file_path"].alias("file"), meta["file_modification_time"].alias("modified"), "value")


def _parsed(df: DataFrame, text: str, schema: str, name: str, *kept: str) -> DataFrame:
    """``text`` parsed once into ``name``.

    The parse is generated, not projected: filters on its fields then stay above it,
    where a projection would be copied into each of them and parsed again.
    """
    return df.select(*kept, F.explode_outer(F.array(F.from_json(text, schema))).alias(name))


def bundle_entries(bundles: DataFrame) -> DataFrame:
    """``(file, bundle_id, resource)`` for every entry of every bundle, the resource as ``VARIANT``."""
    opened = _parsed(bundles, "value", BUNDLE_SCHEMA, "bundle", "file").where(F.col("bundle.resourceType") == "Bundle")
    entries = opened.select("file", F.col("bundle.id").alias("bundle_id"), F.explode_outer("bundle.entry.resource").alias("resource"))
    return entries.where(F.col("resource").isNotNull() & ~F.is_variant_null("resource"))


def _kind() -> Column:
    return F.try_variant_get("resource", "$.resourceType", "string")


def bundle_resources(bundles: DataFrame) -> DataFrame:
    """``(file, bundle_id, resource_type, resource)`` of all resources, whatever their type."""
    return bundle_entries(bundles).select("file", "bundle_id", _kind().alias("resource_type"), "resource")


#: What JSON may say without quotes and a ``VARIANT`` gives as a text.
BARE_WORDS = ("true", "false", "null", "NaN", "Infinity", "INF")


def _may_hold(text: Column, kinds: Collection[str]) -> Column:
    """False only for texts that hold no resource of these types, whatever else they are.

    A type is a JSON string, so its name stands in the text between quotes, or with an escape: a backslash.
    """
    if not all(kind.isalpha() and kind.isascii() and kind not in BARE_WORDS for kind in kinds):
        return F.lit(True)
    words = [*(f'"{kind}"' for kind in kinds), "\\", *(f"'{kind}'" for kind in kinds)]
    return reduce(Column.__or__, [F.contains(text, F.lit(word)) for word in words])


def land_by_type(bundles: DataFrame, path: str, mode: str = "error", kinds: Collection[str] | None = None) -> None:
    """Write the resources of all bundles as ``VARIANT`` in folders by type, so each bundle is parsed once for all parsers.

    Bundles that arrive in loads are landed with the mode ``append``. Where only some types are wanted, ``kinds`` names them;
    a bundle is then searched for their names before it is parsed.
    """
    if kinds is not None:
        bundles = bundles.where(_may_hold(F.col("value"), kinds))
    found = bundle_resources(bundles)
    found = found.where(F.col("resource_type").isNotNull() if kinds is None else F.col("resource_type").isin(*kinds))
    found.write.mode(mode).options(**COMPACT).partitionBy("resource_type").parquet(path)


LANDED_SCHEMA = "file string, bundle_id string, resource variant, resource_type string"


def landed_entries(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """``(file, bundle_id, resource)`` of one type from its folder."""
    return spark.read.schema(LANDED_SCHEMA).parquet(path).where(F.col("resource_type") == kind).select("file", "bundle_id", "resource")


def quarantined_bundles(bundles: DataFrame) -> DataFrame:
    """Files that the resource scan passes over, or of which it passes over an entry, with the reason."""
    kind, entries = F.col("bundle.resourceType"), F.col("bundle.entry")
    reason = (
        F.when(kind.isNull(), "unreadable")
        .when(kind != "Bundle", "not_a_bundle")
        .when(entries.isNull() | (F.size(entries) == 0), "no_entries")
        .when(F.exists(entries, lambda e: e["resource"].isNull()), "entry_without_resource")
    )
    opened = _parsed(bundles, "value", BUNDLE_SCHEMA, "bundle", "file")
    return opened.select("file", reason.alias("reason")).where(F.col("reason").isNotNull())


def _typed(entries: DataFrame, kind: str, schema: str) -> DataFrame:
    """The fields of the resources of one type; a field of another kind than the schema's is null.

    Resources given as JSON text are parsed first. Fields are taken one by one, so a scan of landed resources
    reads the columns of those that are used and does not put whole resources together.
    """
    if entries.schema["resource"].dataType.simpleString() == "string":
        entries = entries.select(F.explode(F.array(F.try_parse_json("resource"))).alias("resource"))
    fields = StructType.fromDDL(schema).fields
    return entries.where(_kind() == kind).select(
        *[F.try_variant_get("resource", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in fields]
    )


def first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def first_coding(coded: Column, field: str) -> Column:
    """A field of the first coding; null when there is none."""
    return first(coded["coding"])[field]


def coding_of_system(coded: Column, needle: str) -> Column:
    """The first coding whose system contains ``needle``, in any case."""
    return first(F.filter(coded["coding"], lambda c: F.contains(F.lower(c["system"]), F.lit(needle))))


def _us_core(extensions: Column, needle: str) -> Column:
    inner = first(first(F.filter(extensions, lambda e: F.contains(e["url"], F.lit(needle))))["extension"])
    return F.coalesce(F.nullif(inner["valueCoding"]["display"], F.lit("")), inner["valueString"])


def parse_patients(entries: DataFrame) -> DataFrame:
    r = _typed(entries, "Patient", PATIENT_SCHEMA)
    address = first(F.col("address"))
    deceased = F.col("deceasedDateTime").isNotNull() | F.coalesce("deceasedBoolean", F.lit(False))
    return r.select(
        F.col("id").alias("fhir_patient_id"),
        F.lit("Patient").alias("fhir_resource"),
        "gender",
        F.nullif(F.left("birthDate", F.lit(4)), F.lit("")).alias("birth_year"),
        deceased.cast("int").alias("deceased"),
        first_coding(F.col("maritalStatus"), "code").alias("marital_status"),
        first_coding(first(F.col("communication"))["language"], "code").alias("language"),
        _us_core(F.col("extension"), "us-core-race").alias("race"),
        _us_core(F.col("extension"), "us-core-ethnicity").alias("ethnicity"),
        address["state"].alias("state"),
        F.nullif(F.left(address["postalCode"], F.lit(3)), F.lit("")).alias("zip_3digit"),
        F.lit(SOURCE_TAG).alias("data_source"),
    )


def parse_encounters(entries: DataFrame) -> DataFrame:
    r = _typed(entries, "Encounter", ENCOUNTER_SCHEMA)
    start, end = F.col("period.start"), F.col("period.end")
    kind, reason = first(F.col("type")), first(F.col("reasonCode"))
    return r.select(
        F.col("id").alias("fhir_encounter_id"),
        F.lit("Encounter").alias("fhir_resource"),
        strip_reference(F.col("subject.reference")).alias("fhir_patient_id"),
        "status",
        F.col("class.code").alias("class_code"),
        F.col("class.display").alias("class_display"),
        first_coding(kind, "code").alias("encounter_type_code"),
        first_coding(kind, "display").alias("encounter_type"),
        date_prefix(start).alias("start_date"),
        date_prefix(end).alias("end_date"),
        duration_hours(start, end).alias("duration_hrs"),
        first_coding(reason, "code").alias("reason_code"),
        first_coding(reason, "display").alias("reason_display"),
        strip_reference(F.col("serviceProvider.reference")).alias("service_provider"),
        F.lit(SOURCE_TAG).alias("data_source"),
    )


def parse_conditions(entries: DataFrame) -> DataFrame:
    r = _typed(entries, "Condition", CONDITION_SCHEMA)
    snomed, icd = coding_of_system(F.col("code"), "snomed"), coding_of_system(F.col("code"), "icd")
    return r.select(
        F.col("id").alias("fhir_condition_id"),
        F.lit("Condition").alias("fhir_resource"),
        strip_reference(F.col("subject.reference")).alias("fhir_patient_id"),
        strip_reference(F.col("encounter.reference")).alias("fhir_encounter_id"),
        snomed["code"].alias("snomed_code"),
        snomed["display"].alias("snomed_display"),
        icd["code"].alias("icd_code"),
        icd["display"].alias("icd_display"),
        first_coding(F.col("clinicalStatus"), "code").alias("clinical_status"),
        first_coding(F.col("verificationStatus"), "code").alias("verification_status"),
        first_coding(first(F.col("category")), "code").alias("category"),
        date_prefix(F.col("onsetDateTime")).alias("onset_date"),
        date_prefix(F.col("abatementDateTime")).alias("abatement_date"),
        F.lit(SOURCE_TAG).alias("data_source"),
    )


def parse_claims(entries: DataFrame) -> DataFrame:
    r = _typed(entries, "ExplanationOfBenefit", CLAIM_SCHEMA)

    def amount(value: Column) -> Column:
        return F.coalesce(value.try_cast("double"), F.lit(0.0))

    return r.select(
        F.col("id").alias("claim_id"),
        strip_reference(F.col("patient.reference")).alias("patient_id"),
        strip_reference(first(first(F.col("item"))["encounter"])["reference"]).alias("encounter_id"),
        amount(first(F.col("total"))["amount"]["value"]).alias("total_cost"),
        amount(F.col("payment.amount.value")).alias("payment_amount"),
        "status",
        "created",
    )
