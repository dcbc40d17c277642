"""Table schemas, keys and fixed value lists."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, TEXT, DOUBLE = T.LongType(), T.StringType(), T.DoubleType()
FLAG, DAY, STAMP = T.BooleanType(), T.DateType(), T.TimestampNTZType()


def _struct(required: dict, optional: dict) -> T.StructType:
    fields = [T.StructField(n, t, False) for n, t in required.items()]
    return T.StructType(fields + [T.StructField(n, t, True) for n, t in optional.items()])


# Field names of the landed records, per column of the fact table.
RECORD_FIELDS = {
    "country_code": "countryCode",
    "country_name": "countryName",
    "short_name": "shortName",
    "iso_alpha2": "isoa2",
    "year": "year",
    "record_type": "record",
    "crop_land": "cropLand",
    "grazing_land": "grazingLand",
    "forest_land": "forestLand",
    "fishing_ground": "fishingGround",
    "builtup_land": "builtupLand",
    "carbon": "carbon",
    "value": "value",
    "score": "score",
}

COUNTRY_FIELDS = {
    "country_code": "countryCode",
    "country_name": "countryName",
    "short_name": "shortName",
    "iso_alpha2": "isoa2",
    "version": "version",
    "score": "score",
}

LAND_COLUMNS = ["crop_land", "grazing_land", "forest_land", "fishing_ground", "builtup_land"]
MEASURES = LAND_COLUMNS + ["carbon", "value"]

FACT_KEY = ["country_code", "year", "record_type"]
MART_KEY = ["country_code", "year"]
PERF_KEY = ["fund_code", "market_date", "return_type"]

FACT = _struct(
    {"country_code": LONG, "country_name": TEXT, "year": LONG, "record_type": TEXT},
    {
        "iso_alpha2": TEXT,
        "short_name": TEXT,
        "record_type_description": TEXT,
        **{m: DOUBLE for m in ["value", "carbon"] + LAND_COLUMNS},
        "score": TEXT,
        "extracted_at": STAMP,
        "transformed_at": STAMP,
    },
)

COUNTRIES = _struct(
    {"country_code": LONG, "country_name": TEXT},
    {"iso_alpha2": TEXT, "short_name": TEXT, "version": TEXT, "score": TEXT, "extracted_at": STAMP},
)

RECORD_TYPES = _struct(
    {"record_type": TEXT},
    {"description": TEXT, "category": TEXT, "is_per_capita": FLAG, "unit": TEXT},
)

# Landing table: declared loosely, since misfits are split off later.
RAW = _struct(
    {},
    {
        "_loaded_at": STAMP,
        "_source_file": TEXT,
        "_row_number": LONG,
        "country_code": LONG,
        "country_name": TEXT,
        "short_name": TEXT,
        "iso_alpha2": TEXT,
        "year": LONG,
        "record_type": TEXT,
        **{m: DOUBLE for m in MEASURES},
        "score": TEXT,
        "carbon_pct_of_total": DOUBLE,
        "extracted_at": STAMP,
        "transformed_at": STAMP,
    },
)

STAGING = _struct(
    {"country_code": LONG, "year": LONG, "record_type": TEXT},
    {
        "country_name": TEXT,
        "short_name": TEXT,
        "iso_alpha2": TEXT,
        **{m: DOUBLE for m in MEASURES},
        "score": TEXT,
        "carbon_pct_of_total": DOUBLE,
        "record_type_description": TEXT,
        "extracted_at": STAMP,
        "transformed_at": STAMP,
        "_loaded_at": STAMP,
        "_updated_at": STAMP,
        "_source_file": TEXT,
    },
)

# Mart metrics as the largest measure of the record types whose name contains all
# the parts, or is the one given: metric -> (measure, parts, exact name).
TYPE_METRICS = {
    "total_ecological_footprint": ("value", ["EFConsTot"], "EFCtot"),
    "carbon_footprint": ("carbon", ["Carbon"], "EFCcarb"),
    "total_biocapacity": ("value", ["BiocapTot"], "BioCaptot"),
    "footprint_per_capita": ("value", ["PerCap", "EF"], None),
    "carbon_per_capita": ("value", ["CarbonPerCap"], "EFCcarbPerCap"),
    "biocapacity_per_capita": ("value", ["BiocapPerCap"], "BioCaptotPerCap"),
}

# Mart metrics that are the largest value of a column over all types.
COLUMN_METRICS = {
    "carbon_percentage": "carbon_pct_of_total",
    "cropland_footprint": "crop_land",
    "grazing_footprint": "grazing_land",
    "forest_footprint": "forest_land",
    "fishing_footprint": "fishing_ground",
    "builtup_footprint": "builtup_land",
}

# Footprint less biocapacity: positive is a deficit, negative a reserve.
DEFICIT = "ecological_deficit"
DEFICIT_OF = ("total_ecological_footprint", "total_biocapacity")

MART_METRICS = [*TYPE_METRICS, DEFICIT, *COLUMN_METRICS]
VIEW_METRICS = [
    "total_ecological_footprint", "carbon_footprint", "total_biocapacity", DEFICIT,
    "carbon_percentage",
]

MART = _struct(
    {"country_code": LONG, "year": LONG},
    {
        "country_name": TEXT,
        "iso_alpha2": TEXT,
        **{m: DOUBLE for m in MART_METRICS},
        "_updated_at": STAMP,
    },
)

CALENDAR = _struct(
    {"date": DAY},
    {
        "day_of_week": T.IntegerType(),
        "text_day_of_week": TEXT,
        "text_month_of_year": TEXT,
        "is_holiday": FLAG,
        "is_working_day": FLAG,
    },
)

PERF_DAILY = _struct(
    {"fund_code": TEXT, "market_date": DAY, "return_type": TEXT}, {"daily_return": DOUBLE}
)

RUN_LOG = _struct(
    {"log_timestamp": STAMP, "run_id": TEXT, "stage": TEXT, "status": TEXT},
    {
        "records_processed": LONG,
        "execution_time_ms": LONG,
        "source_file": TEXT,
        "error_message": TEXT,
        "metadata": T.MapType(TEXT, TEXT),
    },
)

STATE = _struct({"job": TEXT, "recorded_at": STAMP}, {"last_year": LONG, "last_load_id": TEXT})

QUALITY_METRICS = _struct(
    {"table_name": TEXT, "metric_name": TEXT},
    {
        "metric_value": DOUBLE,
        "threshold": DOUBLE,
        "status": TEXT,
        "details": TEXT,
        "check_timestamp": STAMP,
    },
)

# Record types the quality checks accept, in four families.
VALID_RECORD_TYPES = [
    "EFConsTotGHA", "EFProdTotGHA", "EFImportsTotGHA", "EFExportsTotGHA", "EFConsPerCap",
    "EFProdPerCap", "EFImportsPerCap", "EFExportsPerCap", "BiocapTotGHA", "BiocapPerCap",
    "AreaTotHA", "AreaPerCap", "Population", "GDP-PPP", "GDP-USD", "HDI", "Earths", "EFCtot",
    "EFCcrop", "EFCgraz", "EFCfrst", "EFCfish", "EFCbult", "EFCcarb", "BioCaptot", "BioCapcrop",
    "BioCapgraz", "BioCapfrst", "BioCapfish", "BioCapbult", "EFCtotPerCap", "EFCcropPerCap",
    "EFCgrazPerCap", "EFCfrstPerCap", "EFCfishPerCap", "EFCbultPerCap", "EFCcarbPerCap",
    "BioCaptotPerCap", "BioCapcropPerCap", "BioCapgrazPerCap", "BioCapfrstPerCap",
    "BioCapfishPerCap", "BioCapbultPerCap",
]

VALID_CATEGORIES = ["ecological_footprint", "biocapacity"]

# Reference rows of the record type table
# (record_type, description, category, is_per_capita, unit).
RECORD_TYPE_ROWS = [
    ("EFConsTotGHA", "Total Ecological Footprint of Consumption", "ecological_footprint", False, "global hectares"),
    ("EFConsCropLandGHA", "Cropland Footprint", "ecological_footprint", False, "global hectares"),
    ("EFConsGrazLandGHA", "Grazing Land Footprint", "ecological_footprint", False, "global hectares"),
    ("EFConsForestLandGHA", "Forest Product Footprint", "ecological_footprint", False, "global hectares"),
    ("EFConsFishSeaGHA", "Fishing Ground Footprint", "ecological_footprint", False, "global hectares"),
    ("EFConsBuiltLandGHA", "Built-up Land Footprint", "ecological_footprint", False, "global hectares"),
    ("EFConsCarbonGHA", "Carbon Footprint", "ecological_footprint", False, "global hectares"),
    ("BiocapTotGHA", "Total Biocapacity", "biocapacity", False, "global hectares"),
    ("BiocapCropLandGHA", "Cropland Biocapacity", "biocapacity", False, "global hectares"),
    ("BiocapGrazLandGHA", "Grazing Land Biocapacity", "biocapacity", False, "global hectares"),
    ("BiocapForestLandGHA", "Forest Biocapacity", "biocapacity", False, "global hectares"),
    ("BiocapFishSeaGHA", "Fishing Ground Biocapacity", "biocapacity", False, "global hectares"),
    ("BiocapBuiltLandGHA", "Built-up Land Biocapacity", "biocapacity", False, "global hectares"),
    ("EFConsPerCap", "Ecological Footprint per Capita", "ecological_footprint", True, "gha per person"),
    ("BiocapPerCap", "Biocapacity per Capita", "biocapacity", True, "gha per person"),
]

# Years accepted by the checks, and days a zone is kept. Staged and transformed copies
# are processed ones.
YEAR_MIN, YEAR_MAX = 1960, 2030
RETENTION_DAYS = {"raw": 90, "processed": 30, "staged": 30, "transformed": 30, "failed": 180}
