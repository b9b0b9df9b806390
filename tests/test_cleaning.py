import pytest
from pyspark.sql import functions as F

from ledgerline.functions import numbers, rules, text
from ledgerline.operators import clean, enrich, staging

RAW = (
    "Product string, Currency string, Price string, Total string, Quantity string, "
    "InvDate string, Country string, source_sheet string, Customer string"
)


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(
        [
            ("DS923+", "USD", "500", "1000", "2", "2024-01-15", "Atlantis", "2024", "A"),
            ("(old) RS1221+", "EUR", "800", "3200", "4", "2024-02-20", "Atlantis", "2024", "B"),
            ("HAT5300-8T", "XXX", "200", "200", "1", "2024-03-10", "Mu", "2024", "C"),
            ("C2 Backup Business 1T", None, "10", "120", "12", "bad date", "Lemuria", "2024-S", "D"),
        ],
        RAW,
    )


def values(df, column):
    return {r["Customer"]: r[column] for r in df.collect()}


def test_end_to_end(spark, raw):
    regions = spark.createDataFrame([("Atlantis", "West"), ("Mu", "East")], "Country string, Region string")
    bays = spark.createDataFrame([("RS1221+", 4)], "Product string, Bays int")
    out = clean.clean_sales(raw, country_regions=regions, device_bays=bays)
    assert out.count() == 4
    assert values(out, "Type") == {"A": "SERVER", "B": "SERVER", "C": "DRIVE", "D": "C2-SAAS"}
    assert values(out, "sub_cat") == {
        "A": "SVR-DT-DS-T2", "B": "SVR-RM-GP-T1", "C": "DRV-HD-T2", "D": "C2-BACKUP-1T-BUSINESS",
    }
    assert values(out, "total_bays") == {"A": None, "B": 16, "C": None, "D": None}
    assert values(out, "total_cap")["C"] == 8000
    # The unmapped country takes the most frequent region.
    assert values(out, "Region") == {"A": "West", "B": "West", "C": "East", "D": "West"}
    assert values(out, "Year") == {"A": 2024, "B": 2024, "C": 2024, "D": None}


def test_unknown_currency_takes_the_mean_rate(spark):
    df = spark.createDataFrame([("USD",), ("EUR",), ("XXX",), (None,)], "c string")
    rates = [float(r[0]) for r in df.select(numbers.exchange_rate(F.col("c"))).collect()]
    assert rates == [1.0, 1.05, 0.54354, 0.54354]


def test_null_tokens_match_inside_a_cell_unless_strict(spark):
    df = spark.createDataFrame([("Annulled Ltd",), ("NULL",), (" \t",), (" ok ",), ("null",)], "Customer string")
    loose = [r[0] for r in clean.normalise_missing(df).collect()]
    strict = [r[0] for r in clean.normalise_missing(df, strict=True).collect()]
    assert loose == [None, None, None, "ok", None]
    assert strict == ["Annulled Ltd", None, None, "ok", None]


def test_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("nan",), ("-2",), (None,)], "v string")
    assert [r[0] for r in df.select(numbers.to_number(F.col("v"))).collect()] == [1.5, None, None, -2.0, None]
    clipped = clean.coerce_numbers(df, ["v"]).select(numbers.clip_negative(F.col("v")))
    assert [r[0] for r in clipped.collect()] == [1.5, None, None, 0.0, None]


def test_negative_rows_go_and_missing_stay(spark):
    df = spark.createDataFrame([(1.0, 1.0), (-1.0, 1.0), (None, 1.0), (1.0, -1.0)], "Quantity double, Total double")
    kept = clean.fill_quantity(clean.drop_negative(df))
    assert sorted(r.Quantity for r in kept.collect()) == [0.0, 1.0]


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert sorted(r.c for r in clean.fill_mode(df, "c").collect()) == ["a", "a", "a", "b", "b"]
    empty = spark.createDataFrame([(None,)], "c string")
    assert clean.fill_mode(empty, "c").collect()[0].c is None


def test_group_mode(spark):
    df = spark.createDataFrame(
        [("x", "W"), ("x", "W"), ("x", "E"), ("x", None), ("y", None), (None, None)], "Country string, Region string"
    )
    out = clean.fill_group_mode(df, "Country", "Region")
    got = sorted((r.Country or "", r.Region or "") for r in out.collect())
    assert got == [("", ""), ("x", "E"), ("x", "W"), ("x", "W"), ("x", "W"), ("y", "")]


CASES = {
    # name: (category, sub-category)
    "": ("Other", ""),
    "DS920+": ("SERVER", "SVR-DT-DS-T2"),
    "ds3622xs+": ("SERVER", "SVR-DT-DS-T3"),
    "DS 920": ("Other", "Other"),
    "RS3621xs+": ("SERVER", "SVR-RM-GP-T3"),
    "RS2821RP+": ("SERVER", "SVR-RM-GP-T2"),
    "RX1222sas": ("SERVER", "SVR-RM-GX-T4"),
    "RX1217RP": ("SERVER", "SVR-RM-GX-T3"),
    "RX6022sas": ("SERVER", "SVR-RM-GX-T5"),
    "SA6400": ("SERVER", "SVR-RM-GP-T5"),
    "FS3600": ("SERVER", "SVR-RM-FS-T2"),
    "HAS5300-16T": ("DRIVE", "DRV-HD-T3"),
    "SAT5200-480G": ("DRIVE", "DRV-SD-T2"),
    "E10G22-T1-Mini": ("SVR-ACC", "Other"),
    "D4ES01-8G": ("SVR-ACC", "Memory"),
    "EW201": ("SVR-EXW", "Other"),
    "Device License X 8": ("SURVEILLANCE", "SVS-Lx8"),
    "Device License X 1": ("SURVEILLANCE", "SVS-Lx1"),
    "Surveillance Basic": ("SURVEILLANCE", "SVS-C2-T1"),
    "RT6600ax": ("DLG", "RT-AX"),
    "MR2200ac": ("DLG", "RT-AC"),
    "BDS70-1T": ("DLG", "BE-D"),
    "MailPlus 5": ("DSMLICENSE", "DSMLICENSE"),
    "C2 Object 2T Adv": ("C2-SAAS", "C2-OBJECT-2T-ADVANCED"),
    "C2 Storage Basic 100G": ("C2-HYBRID", "C2-STORAGE-100G-BASIC"),
    "Some Insight": ("C2-HYBRID", ""),
    "Cable": ("Other", "Other"),
}


def test_classification(spark):
    df = spark.createDataFrame([(n,) for n in CASES], "Product string")
    got = {r.Product: (r.Type, r.sub_cat) for r in clean.classify(df).collect()}
    assert got == CASES


def test_capacity_counts_in_thousands_only_at_the_end(spark):
    df = spark.createDataFrame(
        [("ABC-8T", "DRIVE"), ("ABC-8T (bulk)", "DRIVE"), ("ABC-480G", "DRIVE"), ("ABC-8T", "SERVER"), ("abc", "DRIVE")],
        "p string, t string",
    )
    got = [r[0] for r in df.select(rules.drive_capacity(F.col("p"), F.col("t"))).collect()]
    assert got == [8000, 8, 480, None, None]


def test_family_and_code(spark):
    df = spark.createDataFrame([("c2 object x", "C2-a--P"), (None, None)], "p string, c string")
    parts = [text.code_part(F.col("c"), n) for n in (2, 3, 4)]
    got = [tuple(r) for r in df.select(text.service_family(F.col("p")), *parts).collect()]
    assert got == [("C2 Storage/Object", "A", "UNKNOWN", "P"), ("Other", "UNKNOWN", "UNKNOWN", "UNKNOWN")]


def test_lookup_must_have_its_columns(spark, raw):
    with pytest.raises(ValueError, match="Region"):
        enrich.map_region(raw, spark.createDataFrame([("x",)], "Country string"))


def test_staging_rejects_impossible_dates_and_keeps_odd_numbers_null(spark):
    rows = [("2024-13-45", "i", "p", "1", "2"), ("2024-01-05", " ", "p", "1e3", "-4"), ("2024-01-05", " ", " ", "1", "2")]
    raw = spark.createDataFrame(
        [(*r, "s") for r in rows], "InvDate string, ItemCode string, Product string, Quantity string, Total string, source_sheet string"
    )
    out = staging.stage_sales(raw).collect()
    assert len(out) == 1
    assert (out[0].sku, out[0].item_code, out[0].quantity, float(out[0].revenue)) == ("p", None, None, 0.0)
    assert staging.empty_staging(spark).columns == staging.stage_sales(raw).columns


def test_defaults_and_headers(spark):
    df = spark.createDataFrame([(None, None, "p")], " ShipTo string, ItemCode string, Product string".strip())
    row = clean.fill_defaults(df).collect()[0]
    assert (row.ShipTo, row.ItemCode) == ("UNKNOWN", "p")
    padded = df.toDF(" ShipTo ", "ItemCode", "Product ")
    assert clean.trim_headers(padded).columns == ["ShipTo", "ItemCode", "Product"]
    keyed = clean.synthetic_order_key(df, ["Product"])
    assert keyed.collect()[0].PI == "order_p"
    assert clean.default_region(df).collect()[0].Region == "Unknown"
