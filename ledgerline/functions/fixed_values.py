"""Fixed values.

Everything here is a constant that decides results: word lists, rule tables,
labels, formats and defaults. They are stated as plain text and in the order in
which they apply. Code that uses them lives in the other modules.
"""

from __future__ import annotations

from typing import NamedTuple

# --- cleaning ---------------------------------------------------------------

NULL_TOKENS = ("NULL", "null")
TRIM_COLUMNS = (
    "Customer", "Product", "Type", "sub_cat", "ItemCode", "DeliveryFrom", "ShipTo", "Currency",
)
NUMERIC_COLUMNS = ("Total", "Price", "Quantity")
CRITICAL_COLUMNS = ("Customer", "Product", "Total")
LOW_VALUE_COLUMNS = ("Comments", "Unit")
UNKNOWN_DESTINATION = "UNKNOWN"
UNSPECIFIED_SKU = "UNSPECIFIED"
EMPTY_SHEET_NAME = "worksheet"

EXPORT_COLUMNS = (
    "PI", "Customer", "ItemCode", "Product", "source_sheet", "Quantity", "usd_adjusted_price",
    "usd_adjusted_total", "InvDate", "Country", "Type", "sub_cat", "Year", "Region",
)

# Currency units to one US dollar.
EXCHANGE_RATES = {"AUD": "0.63", "EUR": "1.05", "JPY": "0.0067", "TWD": "0.031", "USD": "1.00"}

# --- product classification ---------------------------------------------------


class Rule(NamedTuple):
    """``label`` applies when the name starts with one of ``starts`` or holds one
    of ``contains``; with ``both`` it must do both."""

    label: str
    starts: tuple[str, ...] = ()
    contains: tuple[str, ...] = ()
    both: bool = False
    category: str | None = None


DRIVE = ("HAT", "HAS", "SNV", "SAT5")
SERVER = ("DS", "DX", "RS", "RX", "SA", "HD", "FS", "FX", "UC")
ACCESSORY = ("D4", "E10", "E25", "RAM", "M2D", "RKS", "RKM", "BST", "QLE")
CAMERA = ("NVR", "DVA", "VS", "BC", "TC", "CC")
ROUTER = ("BDS", "WRX", "RT", "MR")
LICENSE_WORDS = ("VMM", "MAILPLUS", "PRESTO", "DSM", "ACTIVE_INSIGHT", "ACTIVE-INSIGHT", "SOS")
SAAS_WORDS = (
    "OBJECT", "IDENTITY", "BACKUP", "TRANSFER", "PASSWORD", "STORAGE_BUSINESS", "STORAGE_PERSONAL",
)

# Matched in this order against the upper-case name.
CATEGORY_RULES = (
    Rule("DRIVE", DRIVE),
    Rule("Other", SERVER, (" ", "_"), both=True),
    Rule("SERVER", SERVER),
    Rule("SVR-ACC", ACCESSORY, ("ADAPTER",)),
    Rule("SVR-EXW", ("EW",), ("EXTENDED WARRANTY",)),
    Rule("SURVEILLANCE", CAMERA, ("SURVEILLANCE", "DEVICE LICENSE")),
    Rule("DLG", ROUTER),
    Rule("DSMLICENSE", (), LICENSE_WORDS),
    Rule("C2-SAAS", ("C2",), SAAS_WORDS, both=True),
    Rule("C2-HYBRID", (), ("INSIGHT",)),
    Rule("C2-HYBRID", ("C2",), ("STORAGE",), both=True),
)
DEFAULT_CATEGORY = "Other"

# Whole names (lower case) that are "Other" whatever their category is.
OTHER_NAMES = (
    "m2d20 adapter card", "e10g22-t1-mini", "rks-02", "e10m20-t1", "e25g21-f2", "e10g18-t1",
    "e10g21-f2", "ew202", "ewplus-2y-online", "rkm114", "e10g18-t2", "m2d18 adapter card",
    "rks-01", "adapter 65w_2", "ew201 virtual", "ew202 virtual", "adapter 100w_2",
    "adapter 120w_1", "adapter 60w_1", "adapter 90w_1", "60w adapter level vi_ea10681n-120",
    "adapter 42w_1_au", "60w adapter level vi_kpl-060f-vi", "ew201", "adapter 36w set", "rks-03",
    "adapter 30w set", "adapter 24w set", "adapter 48w/50w_1", "adapter 42w_1_uk",
    "rks-02 carton box", "rks-02 epe holder set", "e10m20-t1 pcba", "m2d20 adapter card pcba",
    "e10g22-t1-mini pcba", "adapter 24w_1_us", "adapter usb3.2 type-c to type-a",
    "e10g18-t1 rubber pad", "partition adapter beedrive bds70 v1.0",
    "e10g18-t2 card low profile bkt", "e10g18-t2 card standard bkt",
    "e10g18-t1/ e10m20-t1 card standard bkt", "adapter 42w_1_eu", "e25g30-f2", "adapter 42w set",
    "e10g30-t2", "adapter 100w", "accessory box adapter 100w_2 / 120w_1 v1.0",
    "accessory box adapter 65w_2 v1.0", "bst150-4t", "qle2692",
    "active insight premium early bird", "active insight premium",
)

# Matched in this order against the lower-case name, within the category given.
SUBCATEGORY_RULES = (
    Rule("DRV-HD-T3", ("has",), category="DRIVE"),
    Rule("DRV-HD-T2", ("hat53",), category="DRIVE"),
    Rule("DRV-HD-T1", ("hat",), category="DRIVE"),
    Rule("DRV-SD-T2", ("sat",), category="DRIVE"),
    Rule("DRV-SD-T1", ("snv",), category="DRIVE"),
    Rule("SVR-DT-DS-T3", ("ds",), ("xs", "fs1018", "ds24"), True, "SERVER"),
    Rule("SVR-DT-DS-T2", ("ds",), ("+", "ds620slim"), True, "SERVER"),
    Rule("SVR-DT-DS-T1", ("ds",), category="SERVER"),
    Rule("SVR-DT-DX-T3", ("dx12",), category="SERVER"),
    Rule("SVR-DT-DX-T2", ("dx5",), category="SERVER"),
    Rule("SVR-RM-GP-T5", ("sa", "hd"), ("6400", "6500"), True, "SERVER"),
    Rule("SVR-RM-GP-T4", ("sa", "uc"), category="SERVER"),
    Rule("SVR-RM-GP-T3", ("rs",), ("xs+",), True, "SERVER"),
    Rule("SVR-RM-GP-T2", ("rs",), ("xs", "rpxs", "rs28", "rs24"), True, "SERVER"),
    Rule("SVR-RM-GP-T1", ("rs",), category="SERVER"),
    Rule("SVR-RM-GX-T5", (), ("rx60",), category="SERVER"),
    Rule("SVR-RM-GX-T4", ("rxd",), category="SERVER"),
    Rule("SVR-RM-GX-T4", ("rx",), ("sas",), True, "SERVER"),
    Rule("SVR-RM-GX-T3", ("rx12",), ("rp",), True, "SERVER"),
    Rule("SVR-RM-GX-T2", ("rx",), category="SERVER"),
    Rule("SVR-RM-FS-T3", ("fs",), ("6400",), True, "SERVER"),
    Rule("SVR-RM-FS-T2", ("fs",), ("34", "36"), True, "SERVER"),
    Rule("SVR-RM-FS-T1", ("fs",), category="SERVER"),
    Rule("SVR-RM-FX-T2", ("fx",), category="SERVER"),
    Rule("SVS-DT-DVA", ("dva",), category="SURVEILLANCE"),
    Rule("SVS-DT-OT", ("nvr",), category="SURVEILLANCE"),
    Rule("SVS-DT-VS", ("vs",), category="SURVEILLANCE"),
    Rule("SVS-CAM", ("bc", "tc"), category="SURVEILLANCE"),
    Rule("SVS-Lx8", (), ("device license&8",), category="SURVEILLANCE"),
    Rule("SVS-Lx4", (), ("device license&4",), category="SURVEILLANCE"),
    Rule("SVS-Lx1", (), ("device license&1",), category="SURVEILLANCE"),
    Rule("SVS-C2-T1", (), ("surveillance&basic",), category="SURVEILLANCE"),
    Rule("SVS-C2-T2", (), ("surveillance",), category="SURVEILLANCE"),
    Rule("RT-AX", ("rt66", "wrx"), category="DLG"),
    Rule("RT-AC", ("rt26", "mr", "rt19"), category="DLG"),
    Rule("BE-D", ("",), category="DLG"),
    Rule("DSMLICENSE", ("",), category="DSMLICENSE"),
    Rule("Other", ("",), category="Other"),
    Rule("Memory", ("d4", "ram", "ddr")),
)
SERVICE_CATEGORIES = ("C2-SAAS", "C2-HYBRID")
SERVICE_MARK = "C2"
# First token found (upper case) gives the part of the service code.
SERVICE_TYPES = ("STORAGE", "BACKUP", "IDENTITY", "OBJECT", "PASSWORD", "TRANSFER")
SERVICE_CAPACITIES = ("1T", "100G", "500G", "2T", "5T")
SERVICE_PLANS = (
    ("BASIC", "BASIC"), ("INDIVIDUAL", "INDIVIDUAL"), ("BUSINESS", "BUSINESS"),
    ("ADV", "ADVANCED"), ("ENTERPRISE", "ENTERPRISE"), ("PROFESSIONAL", "PROFESSIONAL"),
)
UNKNOWN_PART = "UNKNOWN"

CAPACITY_CATEGORY = "DRIVE"
CAPACITY_NAME = r"^[A-Z0-9]+-[0-9]+[GT](\s*\(.*\))?$"
CAPACITY_DIGITS = r"^[^-]*-(\d+)"
CAPACITY_UNIT = "GB"

# --- subscriptions -----------------------------------------------------------

SUBSCRIPTION_PREFIX = "C2-"
SUBSCRIPTION_WORDS = (
    r"\bC2\b", r"\bC2 ", "C2-", "C2_", "Active Insight", "ActiveProtect",
    r"\bC2 Storage\b", r"\bC2 Backup\b", r"\bC2 Password\b", r"\bC2 Transfer\b", r"\bC2 Object\b",
)
# Words joined by & must all occur in the lower-case name. First match wins.
FAMILY_RULES = (
    ("Active Insight", ("active insight",)),
    ("ActiveProtect", ("activeprotect", "active protect")),
    ("C2 Password", ("c2 password",)),
    ("C2 Backup", ("c2 backup",)),
    ("C2 Storage/Object", ("c2 storage", "object&c2")),
    ("C2 Transfer", ("c2 transfer",)),
    ("C2 (Other)", ("c2",)),
)
DEFAULT_FAMILY = "Other"

TIER_1, TIER_1_RANKS = "Tier 1 - Top 5", 5
TIER_2, TIER_2_RANKS = "Tier 2 - Top 20", 20
TIER_3 = "Tier 3 - Long Tail"

# --- time series and forecasts -------------------------------------------------

FOCUS_PREFIX = "SVR-RM"
FOCUS_PRODUCTS = ("SVR-DT-DS-T1", "SVR-DT-DS-T2", "SVR-DT-DS-T3")
DATE_CANDIDATES = (
    "invoice_date", "Invoice Date", "PI Date", "Date", "sale_date", "OrderDate", "order_date",
)
HOLDOUT_START = "2024-10-01"
HORIZON_MONTHS = 3
ROLLING_WINDOW = 3
SEASON = 12
MIN_SEASONAL_MONTHS = 24
MIN_TRAIN_MONTHS = 12
MIN_SEARCH_MONTHS = 15
CONFIDENCE_Z = 1.959963984540054  # two-sided 95 %
HIGH_CONFIDENCE, HIGH_CONFIDENCE_MAPE = "High Confidence", 20
MODERATE_CONFIDENCE, MODERATE_CONFIDENCE_MAPE = "Moderate Confidence", 50
LOW_CONFIDENCE = "Low Confidence"

HISTORY_DATE_NAMES = ("Month", "Date", "Transaction Date")
HISTORY_SKU_NAMES = ("Product", "SKU", "Sku")
HISTORY_QUANTITY_NAMES = ("Received Qty", "Quantity", "Qty")
HISTORY_REVENUE_NAMES = ("Total", "Revenue")
HISTORY_CHANNELS = (("im_", "IM"),)
HISTORY_DEFAULT_CHANNEL = "TDBS"

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_START = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"
# Other dates of hand-kept files, in the order in which they are tried; months before days.
DATE_FORMATS = ("yyyy/MM/dd", "MM/dd/yyyy", "dd-MMM-yyyy", "yyyyMMdd")
# What every text that fits a format looks like. Texts of other shapes never reach its parser, which fails slowly.
DATE_SHAPES = {
    "yyyy/MM/dd": r"^[+-]?\d+/\d{2}/\d{2}$",
    "MM/dd/yyyy": r"^\d{2}/\d{2}/[+-]?\d+$",
    "dd-MMM-yyyy": r"^\d{2}-.+-[+-]?\d+$",
    "yyyyMMdd": r"^[+-]?\d+$",
}
PLAIN_NUMBER = r"^-?\d+(?:\.\d+)?$"

FORECAST_MART = (
    "forecast_run_id string, cohort string, model_name string, model_version string, sku string, "
    "channel string, sale_month date, forecast_date date, forecast_quantity double, "
    "forecast_revenue double, actual_quantity double, actual_revenue double, product_name string, "
    "product_type string, product_subcategory string, forecast_revenue_lower double, "
    "forecast_revenue_upper double, created_at timestamp"
)
STAGING = (
    "sale_date date, item_code string, product_name string, sku string, channel string, "
    "quantity decimal(28,8), revenue decimal(28,8)"
)
