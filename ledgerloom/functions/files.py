"""File names, kinds, sizes and storage paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DEFAULT_FOLDERS = ("Default_Dataset", "")
# Shown label per array type, first match wins.
DTYPE_LABELS = (
    ("('real','<f8')", "Complex128"),
    ("complex", "Complex128"),
    ("int64", "Integer (64-bit)"),
    ("int32", "Integer (32-bit)"),
    ("float64", "Float (64-bit)"),
    ("float32", "Float (32-bit)"),
    ("object", "String / Object"),
)
# Point-cloud type letters.
POINT_TYPES = {"I": "Integer", "U": "Unsigned Integer", "F": "Float"}


def file_extension(name: Column) -> Column:
    last = F.lower(F.substring_index(name, ".", -1))
    return F.when(F.contains(name, F.lit(".")), last).otherwise("unknown")


def detect_modality(name: Column) -> Column:
    lower = F.lower(name)
    suffix = F.substring_index(lower, ".", -1)
    return (
        F.when(suffix.isin("pcd", "las", "laz"), "lidar")
        .when(suffix == "bin", "radar")
        .when(F.contains(lower, F.lit("channel")) | F.contains(lower, F.lit("csi")), "wifi")
        .when(suffix == "csv", "tabular")
        .when(suffix == "mat", "matlab")
        .otherwise("unknown")
    )


def classify_legacy_file(name: Column) -> Column:
    return (
        F.when(file_extension(name) == "csv", "csv")
        .when(F.contains(name, F.lit("channels")), "channels")
        .when(F.contains(name, F.lit("timestamps")), "timestamps")
        .otherwise("mat")
    )


def owner_slug(full_name: Column, email: Column) -> Column:
    """First word of the name, letters and digits only; without a name the mail prefix."""
    words = F.split(F.trim(full_name), r"\s+")
    from_name = F.regexp_replace(F.lower(F.get(words, F.lit(0))), r"[^\p{L}\p{N}]", "")
    from_mail = F.replace(F.lower(F.substring_index(email, "@", 1)), F.lit("."), F.lit("_"))
    return F.when(F.trim(full_name) != "", from_name).otherwise(from_mail)


def safe_name(name: Column) -> Column:
    """A storage-safe file name: blanks and slashes to ``_``, odd characters dropped."""
    spaced = F.regexp_replace(F.regexp_replace(name, r"[/\\]+", " "), r"\s+", "_")
    kept = F.regexp_replace(spaced, r"[^A-Za-z0-9_.-]", "")
    return F.regexp_replace(kept, r"^[._]+|[._]+$", "")


def dataset_folder(dataset: Column) -> Column:
    """Null for the default dataset, else its storage-safe name."""
    is_default = dataset.isNull() | dataset.isin(*DEFAULT_FOLDERS)
    return F.when(~is_default, safe_name(dataset))


def object_path(owner: Column, dataset: Column, name: Column) -> Column:
    """``owner[/folder]/file``; ``concat_ws`` leaves the folder out when it is null."""
    return F.concat_ws("/", owner, dataset_folder(dataset), safe_name(name))


def human_size(size: Column) -> Column:
    def scaled(divisor: int, places: int, unit: str) -> Column:
        exact = size.cast("decimal(28,8)") / F.lit(divisor).cast("decimal(10,0)")
        return F.concat(F.round(exact, places).cast(f"decimal(28,{places})").cast("string"), F.lit(unit))

    return (
        F.when(size.isNull() | (size == 0), "0 B")
        .when(size < 1024, F.concat(size.cast("string"), F.lit(" B")))
        .when(size < 1048576, scaled(1024, 1, " KB"))
        .otherwise(scaled(1048576, 2, " MB"))
    )


def clean_dtype(dtype: Column) -> Column:
    label = F
    for needle, shown in DTYPE_LABELS:
        label = label.when(F.contains(dtype, F.lit(needle)), shown)
    return label.otherwise(dtype)


def point_dtype(letter: Column, size: Column) -> Column:
    """``Float (4 bytes)`` from a point-cloud type letter and size."""
    shown = F
    for short, long in POINT_TYPES.items():
        shown = shown.when(letter == short, long)
    return F.concat(
        shown.otherwise(F.coalesce(letter, F.lit("Unknown"))),
        F.lit(" ("), F.coalesce(size, F.lit("Unknown")), F.lit(" bytes)"),
    )


def has_numeric_owner(path: Column) -> Column:
    """Paths stored under a numeric user id instead of a name."""
    return F.get(F.split(path, "/"), F.lit(0)).rlike("^[0-9]+$")
