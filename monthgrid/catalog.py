"""Series catalog, domain specifications and bronze schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The 17 published series (column, series id, unit, provider).
PUBLISHED_SERIES = [
    ("wti_price", "PET.RWTC.M", "Dollars per Barrel", "EIA_API"),
    ("brent_price", "PET.RBRTE.M", "Dollars per Barrel", "EIA_API"),
    ("oil_production", "PET.MCRFPUS2.M", "Thousand Barrels per Day", "EIA_API"),
    ("crude_imports", "PET.MCRIMUS2.M", "Thousand Barrels per Day", "EIA_API"),
    ("refinery_util", "PET.MOPUEUS2.M", "Percent", "EIA_API"),
    ("gasoline_stocks", "PET.MGFSTUS1.M", "Thousand Barrels", "EIA_API"),
    ("distillate_stocks", "PET.MDISTUS1.M", "Thousand Barrels", "EIA_API"),
    ("henry_hub_price", "NG.RNGWHHD.M", "Dollars per MMBtu", "EIA_API"),
    ("gas_storage", "NG.NW2_EPG0_SWO_R48_BCF.M", "Million Cubic Feet", "EIA_API"),
    ("gas_production", "NG.N9010US2.M", "Billion Cubic Feet", "EIA_API"),
    ("hdd", "STEO.ZWHDPUS.M", "Degree Days", "EIA_STEO"),
    ("cdd", "STEO.ZWCDPUS.M", "Degree Days", "EIA_STEO"),
    ("opec_spare", "STEO.COPS_OPEC.M", "Million Barrels per Day", "EIA_STEO"),
    ("global_inv", "STEO.PASXPUS.M", "Million Barrels", "EIA_STEO"),
    ("dollar_index", "DTWEXBGS", "Index", "FRED_API"),
    ("industrial_production", "INDPRO", "Index", "FRED_API"),
    ("treasury_10y", "DGS10", "Percent", "FRED_API"),
]

# Sane range of each single-series table (both ends allowed).
PUBLISHED_RANGES = {
    "crude_imports": (0, 50_000),
    "refinery_util": (0, 100),
    "gasoline_stocks": (0, 500_000),
    "distillate_stocks": (0, 500_000),
    "hdd": (0, 2_000),
    "cdd": (0, 2_000),
    "opec_spare": (-1, 15),
    "global_inv": (0, 5_000),
    "dollar_index": (50, 200),
    "industrial_production": (50, 150),
    "treasury_10y": (-2, 20),
}

FEATURE_COLUMNS = [name for name, *_ in PUBLISHED_SERIES]

BRONZE_SCHEMA = T.StructType([
    T.StructField("series_id", T.StringType()),
    T.StructField("series_name", T.StringType()),
    T.StructField("period", T.DateType()),
    T.StructField("value", T.DecimalType(12, 4)),
    T.StructField("unit", T.StringType()),
    T.StructField("provider", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("raw_response", T.StringType()),
])


@dataclass(frozen=True)
class Domain:
    """How the series of one domain become the columns of its monthly table."""

    columns: dict[str, str]  # output column -> series_id
    price: str  # column the monthly change and the outlier flag are taken of
    change: str  # name of the monthly change column
    spread: tuple[str, str] | None = None  # (minuend, subtrahend) of ``price_spread``
    min_value: float = 0.0


PUBLISHED_OIL = Domain(
    columns={"wti_price": "PET.RWTC.M", "brent_price": "PET.RBRTE.M", "us_production": "PET.MCRFPUS2.M"},
    price="wti_price", change="wti_mom_change", spread=("brent_price", "wti_price"))
PUBLISHED_GAS = Domain(
    columns={"henry_hub_price": "NG.RNGWHHD.M", "us_storage_bcf": "NG.NW2_EPG0_SWO_R48_BCF.M",
             "us_production": "NG.N9010US2.M"},
    price="henry_hub_price", change="price_mom_change")


@dataclass(frozen=True)
class RangeRule:
    """Values of one series must lie in [low, high]; no rows of the series passes as skipped."""

    expectation: str
    series_id: str
    low: float
    high: float
    label: str


@dataclass(frozen=True)
class Suite:
    """Rules of one domain's bronze quality suite."""

    name: str
    valid_series: tuple[str, ...]
    ranges: tuple[RangeRule, ...]
    min_date: str
    min_rows: int = 100
    max_null_pct: float = 5.0
    not_negative: tuple[tuple[str, str], ...] = field(default=())  # (expectation, series_id)


# Bounds of the two bronze suites.
PETROLEUM_SUITE = Suite(
    name="petroleum_suite",
    valid_series=("PET.RWTC.M", "PET.RBRTE.M", "PET.MCRFPUS2.M"),
    ranges=(RangeRule("expect_wti_price_in_range", "PET.RWTC.M", 0.0, 200.0, "WTI"),
            RangeRule("expect_brent_price_in_range", "PET.RBRTE.M", 0.0, 200.0, "Brent")),
    min_date="1986-01-01")
GAS_SUITE = Suite(
    name="gas_suite",
    valid_series=("NG.RNGWHHD.M", "NG.NW2_EPG0_SWO_R48_BCF.M", "NG.N9010US2.M"),
    ranges=(RangeRule("expect_henry_hub_price_in_range", "NG.RNGWHHD.M", 0.0, 25.0, "Henry Hub"),
            RangeRule("expect_storage_in_range", "NG.NW2_EPG0_SWO_R48_BCF.M", 0.0, 5_000_000.0, "storage")),
    min_date="1993-01-01",
    not_negative=(("expect_henry_hub_not_negative", "NG.RNGWHHD.M"),))

# Run name -> series whose rows it loaded.
RUN_DEFINITIONS = {
    "exogenous_petroleum_ingestion": ("crude_imports", "refinery_util", "gasoline_stocks", "distillate_stocks"),
    "fred_macro_ingestion": ("dollar_index", "industrial_production", "treasury_10y"),
    "steo_weather_ingestion": ("hdd", "cdd"),
    "supply_signals_ingestion": ("opec_spare", "global_inv"),
}

MIN_GATE_RATE = 80.0
