"""Edge values of the column functions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, files, geo, keys, listings, numbers, privacy
from ledgerloom.functions.gaze import gaze_decision
from ledgerloom.functions.sql import register_sql_functions
from ledgerloom.operators.profile import names_a_time
from ledgerloom.plans.omop import gender_concept, race_concept


@pytest.mark.parametrize("text", ["abc", "x-1", "None", "", "é", "0" * 300])
def test_hash_key_matches_python(value_of, text):
    expected = int(hashlib.sha256(text.encode()).hexdigest(), 16)
    assert value_of(keys.hash_mod_key(F.lit(text))) == expected % 10**9
    assert value_of(keys.wide_hash_key(F.lit(text))) == int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)


def test_hash_key_known_values_and_null(value_of):
    assert value_of(keys.hash_mod_key(F.lit("abc"))) == 817089965
    assert value_of(keys.hash_mod_key(F.lit("x-1"))) == 603316785
    assert value_of(keys.hash_mod_key(F.lit(None).cast("string"))) is None
    with pytest.raises(ValueError):
        keys.hash_mod_key(F.lit("a"), 2**32)


@pytest.mark.parametrize(
    "reference, expected",
    [("urn:uuid:a", "a"), ("Patient/a", "a"), ("Encounter/a", "a"), ("Organization/a", "Organization/a"), ("a", "a"), ("", None), (None, None)],
)
def test_references(value_of, reference, expected):
    assert value_of(keys.strip_reference(F.lit(reference).cast("string"))) == expected


@pytest.mark.parametrize("gender, code, legacy", [("male", 8507, 8507), ("Female", 8532, 8507), ("unknown", 0, 0), (None, 0, 0)])
def test_gender(value_of, gender, code, legacy):
    assert value_of(gender_concept(F.lit(gender).cast("string"))) == code
    assert value_of(gender_concept(F.lit(gender).cast("string"), legacy=True)) == legacy


@pytest.mark.parametrize("race, code", [("Black or African American", 8516), ("ASIAN", 8515), ("White", 8527), ("Other", 0), (None, 0)])
def test_race(value_of, race, code):
    assert value_of(race_concept(F.lit(race).cast("string"))) == code


def test_ratios(value_of):
    assert value_of(numbers.ratio_pct(F.lit(1), F.lit(0))) is None
    assert value_of(numbers.ratio_pct(F.lit(1), F.lit(None).cast("int"))) is None
    assert value_of(numbers.ratio_pct(F.lit(1), F.lit(3))) == 33.3
    assert value_of(numbers.finite(F.lit(float("nan")))) is None
    assert value_of(numbers.finite(F.lit(float("inf")))) is None
    assert value_of(numbers.finite(F.lit(1.5))) == 1.5


def test_duration_with_and_without_zone_and_bad_text(value_of):
    hours = lambda a, b, **options: value_of(dates.duration_hours(F.lit(a), F.lit(b), **options))
    assert hours("2020-01-01T23:00:00-05:00", "2020-01-02T01:20:00Z", wall_clock=True) == 2.33
    assert hours("2020-03-07T23:00:00-05:00", "2020-03-08T04:00:00-04:00") == 4.0
    assert hours("2020-01-01T23:00:00", None) is None
    assert hours("soon", "2020-01-02T01:20:00") is None


@pytest.mark.parametrize("days, label", [(1, "0-7 days"), (7, "0-7 days"), (8, "8-14 days"), (14, "8-14 days"), (15, "15-21 days"), (21, "15-21 days"), (22, "22-30 days"), (30, "22-30 days")])
def test_window_labels(value_of, days, label):
    assert value_of(dates.readmit_window_label(F.lit(days))) == label


@pytest.mark.parametrize(
    "text, is_price, expected",
    [
        ("$1,200", True, (1200, 1200)), ("$1,200 – $1,500", True, (1200, 1500)), ("1200-1500", True, (1200, 1500)),
        ("Studio – 2 Beds", False, (0, 2)), ("3 Beds", False, (3, 3)), ("$1,200+", True, (None, None)),
        ("Call for Rent", True, (None, None)), ("No price", True, (None, None)), ("", True, (None, None)),
        (None, True, (None, None)), ("nan", True, (None, None)), ("inf", True, (None, None)), ("1-2–3", False, (None, None)),
        ("1.5 - .5e1", False, (1.5, 5)), ("5-", True, (None, None)),
    ],
)
def test_price_and_bed_ranges(value_of, text, is_price, expected):
    found = value_of(listings.parse_numeric_range(F.lit(text).cast("string"), is_price))
    assert (found.low, found.high) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1–2 Bedrooms Apartments · Area, City", ("1–2", "Area, City")), ("Studio Apartment · Area", ("Studio", "Area")),
        ("House", ("", "House")), ("3 Bedroom Condo · A · B", ("3", "B")),
    ],
)
def test_listing_details(value_of, text, expected):
    assert tuple(value_of(listings.parse_listing_detail(F.lit(text)))) == expected


def test_rent_fill(value_of):
    filled = lambda beds: value_of(listings.fill_rent_by_beds(F.lit(None).cast("double"), F.lit(beds).cast("double")))
    assert [filled(b) for b in (1, 2, 3, None)] == [1220, 1460, 1375, 1375]
    assert value_of(listings.fill_rent_by_beds(F.lit(900.0), F.lit(1.0))) == 900
    assert value_of(listings.zip_code(F.lit("12345 Main St, Buffalo NY 14201"))) == "14201"
    assert value_of(listings.zip_code(F.lit("Main St"))) is None


@pytest.mark.parametrize(
    "lat, lon, reason",
    [
        ("0", "0", "null_island"), ("0", "10", "ok"), ("90", "180", "ok"), ("90.0000001", "0", "out_of_bounds"), ("NaN", "1", "not_a_number"),
        ("Infinity", "1", "out_of_bounds"), ("1e1", "2", "ok"), (" 42.5 ", "1", "ok"), ("", "1", "empty"), (None, "1", "empty"), ("x", "1", "not_a_number"),
    ],
)
def test_positions(value_of, lat, lon, reason):
    assert value_of(geo.gps_reason(F.lit(lat).cast("string"), F.lit(lon).cast("string"))) == reason


def test_position_rounding_and_fence(value_of):
    assert value_of(geo.gps_normalise(F.lit("-78.8784005"))) == -78.8784
    assert value_of(geo.gps_normalise(F.lit("42.1234567"))) == 42.123457
    fence = geo.Fence(south=40, north=45, west=-80, east=-70)
    assert value_of(geo.gps_reason(F.lit("50"), F.lit("-75"), fence)) == "outside_fence"


@pytest.mark.parametrize(
    "name, extension, modality",
    [
        ("README", "unknown", "unknown"), ("A.CSV", "csv", "tabular"), ("a.b.csv", "csv", "tabular"), ("channels_1.mat", "mat", "wifi"),
        ("csi.bin", "bin", "radar"), (".hidden", "hidden", "unknown"), ("x.las", "las", "lidar"), ("x.mat", "mat", "matlab"),
    ],
)
def test_file_kinds(value_of, name, extension, modality):
    assert value_of(files.file_extension(F.lit(name))) == extension
    assert value_of(files.detect_modality(F.lit(name))) == modality


def test_owner_and_path(value_of):
    slug = lambda name, mail: value_of(files.owner_slug(F.lit(name).cast("string"), F.lit(mail)))
    assert slug("  Zoë-Ann Miller ", "z@x") == "zoëann"
    assert slug(None, "Ann.Lee@x.org") == "ann_lee"
    assert slug("  ", "Ann.Lee@x.org") == "ann_lee"
    path = lambda folder: value_of(files.object_path(F.lit("ann"), F.lit(folder).cast("string"), F.lit("../my file?.csv")))
    assert path("radar 0") == "ann/radar_0/my_file.csv"
    assert path("Default_Dataset") == path(None) == path("") == "ann/my_file.csv"
    assert value_of(files.has_numeric_owner(F.lit("1/Default_Dataset/x.csv"))) is True
    assert value_of(files.has_numeric_owner(F.lit("ann1/x.csv"))) is False


@pytest.mark.parametrize("size, shown", [(0, "0 B"), (None, "0 B"), (1023, "1023 B"), (1024, "1.0 KB"), (1536, "1.5 KB"), (1048576, "1.00 MB"), (5_500_000, "5.25 MB")])
def test_sizes(value_of, size, shown):
    assert value_of(files.human_size(F.lit(size).cast("bigint"))) == shown


def test_time_names(value_of):
    assert not value_of(names_a_time(F.lit("items")))
    assert value_of(names_a_time(F.lit("time_ms")))
    assert value_of(dates.short_time(F.lit("2024-01-01T08:30:59"))) == "2024-01-01 08:30"
    assert value_of(dates.short_time(F.lit(None).cast("string"))) == "Unknown Time"


def test_redaction(value_of):
    text = "Mail a.b@x.org or http://x.org/?q=1 now, call (716) 555-0100 or fax 716.555.0199, host 10.0.0.1"
    assert value_of(privacy.redact_text(F.lit(text))) == (
        "Mail [EMAIL REMOVED] or [URL REMOVED] now, call [PHONE REMOVED] or fax [PHONE REMOVED], host [IP REMOVED]"
    )
    inside = value_of(privacy.redact_text(F.lit("see http://x.org/u/c@d.org.")))
    assert "@" not in inside and "x.org" not in inside
    assert value_of(privacy.age_band(F.lit(89))) == "89"
    assert value_of(privacy.age_band(F.lit(90))) == "90+"
    zips = [value_of(privacy.generalise_zip(F.lit("14201"), F.lit(n).cast("int"))) for n in (19_999, 20_000, None)]
    assert zips == ["000", "142", "000"]


@pytest.mark.parametrize(
    "zones, action",
    [((0, 0, 5, 0, 0, 0), "right"), ((5, 0, 0, 0, 0, 0), "left"), ((0, 5, 0, 3, 1, 1), "front"), ((0, 5, 0, 1, 3, 1), "stop"),
     ((0, 5, 0, 1, 1, 3), "back"), ((0, 5, 0, 2, 2, 1), None), ((3, 3, 0, 0, 0, 0), None), ((0, 0, 0, 0, 0, 0), None)],
)
def test_gaze(value_of, zones, action):
    assert value_of(gaze_decision(*map(F.lit, zones))) == action


def test_sql_functions_agree(spark):
    register_sql_functions(spark)
    texts = ["abc", "$1,200 – $1,500", "Studio – 2 Beds", "1200-1500", "nan", "$1,200+", "", None, "3 Beds"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(
        "t", F.expr("hash_mod_key(t)").alias("h"), F.expr("parse_numeric_range(t, true)").alias("p"), F.expr("parse_numeric_range(t, false)").alias("b"),
        keys.hash_mod_key(F.col("t")).alias("h2"), listings.parse_numeric_range(F.col("t")).alias("p2"),
        listings.parse_numeric_range(F.col("t"), is_price=False).alias("b2"),
    )
    for r in got.collect():
        assert (r.h, r.p, r.b) == (r.h2, r.p2, r.b2), r.t
    points = spark.createDataFrame([("0", "0"), ("x", "1"), ("", "1"), (None, "1"), ("91", "0"), (" 42 ", "1"), ("NaN", "2")], "a string, b string")
    for r in points.select(F.expr("gps_reason(a, b)").alias("x"), geo.gps_reason(F.col("a"), F.col("b")).alias("y")).collect():
        assert r.x == r.y
