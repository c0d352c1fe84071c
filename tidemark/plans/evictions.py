"""The eviction and census datasets and the table made from them."""

from __future__ import annotations

from pyspark.sql.types import StructType

from tidemark.plans.spec import Dataset, LoadSpec, Lookup

# Dataset, table and column names and types of the published tables.
MAIN_NAME = "evictions"
REFERENCE_NAME = "census_data"
TARGET_NAME = "evictions"

MAIN_SCHEMA = (
    StructType()
    .add("bbl", "long")
    .add("census_tract", "long")
    .add("council_district", "long")
    .add("latitude", "double")
    .add("eviction_possession", "string")
    .add("nta", "string")
    .add("docket_number", "long")
    .add("ejectment", "string")
    .add("longitude", "double")
    .add("court_index_number", "string")
    .add("borough", "string")
    .add("residential_commercial_ind", "string")
    .add("marshal_last_name", "string")
    .add("bin", "long")
    .add("community_board", "long")
    .add("marshal_first_name", "string")
    .add("executed_date", "timestamp", True, {"comment": "bq-datetime"})
    .add("eviction_zip", "long")
    .add("eviction_apt_num", "string")
    .add("eviction_address", "string")
)

REFERENCE_SCHEMA = (
    StructType()
    .add("total_population_change_2000_2010_number", "long")
    .add("total_population_2010_number", "long")
    .add("total_population_2000_number", "long")
    .add("geographic_area_neighborhood_tabulation_area_nta_name", "string")
    .add("geographic_area_2010_census_fips_county_code", "long")
    .add("geographic_area_neighborhood_tabulation_area_nta_code", "string")
    .add("total_population_change_2000_2010_percent", "double")
    .add("geographic_area_borough", "string")
)

TARGET_COLUMNS = (
    "court_index_number",
    "docket_number",
    "ejectment",
    "eviction_possession",
    "eviction_zip",
    "eviction_apt_num",
    "eviction_address",
    "bbl",
    "census_tract",
    "nta",
    "council_district",
    "borough",
    "community_board",
    "bin",
    "residential_commercial_ind",
    "latitude",
    "longitude",
    "marshal_first_name",
    "marshal_last_name",
    "executed_date",
)

KEYS = ("executed_date", "docket_number", "court_index_number")
LOOKUP = Lookup(
    column="nta",
    reference_name="geographic_area_neighborhood_tabulation_area_nta_name",
    reference_value="total_population_2010_number",
    value_field="population",
)
# Never updated after insert.
KEEP_TARGET = ("eviction_possession",)


def evictions_spec(
    main_reader: dict[str, str], reference_reader: dict[str, str], **options
) -> LoadSpec:
    """The load of these datasets, read with the given ``paged`` options."""
    settings = {"keep_target": KEEP_TARGET, **options}
    return LoadSpec(
        main=Dataset(MAIN_NAME, MAIN_SCHEMA, main_reader),
        reference=Dataset(REFERENCE_NAME, REFERENCE_SCHEMA, reference_reader),
        lookup=LOOKUP,
        target_name=TARGET_NAME,
        target_columns=TARGET_COLUMNS,
        keys=KEYS,
        **settings,
    )
