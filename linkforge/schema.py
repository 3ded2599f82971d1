"""Record layout of the registration snapshots and of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the source layout) -------------------------
# 0-based field position in a pipe-delimited snapshot line -> column name.
SOURCE_POSITIONS = [
    (0, "uei"), (3, "cage_code"), (5, "extract_code"), (7, "initial_reg_date"),
    (8, "expiration_date"), (9, "last_update_date"), (10, "activation_date"),
    (11, "legal_name"), (12, "dba_name"), (13, "division_name"),
    (14, "division_number"), (15, "phys_addr1"), (16, "phys_addr2"),
    (17, "phys_city"), (18, "phys_state"), (19, "phys_zip"), (20, "phys_zip4"),
    (21, "phys_country"), (22, "phys_congress"), (26, "entity_url"),
    (27, "entity_structure"), (28, "state_of_incorp"), (29, "country_of_incorp"),
    (31, "bus_type_string"), (32, "primary_naics"), (34, "naics_string"),
    (46, "gov_poc_first"), (48, "gov_poc_last"), (90, "elec_poc_first"),
    (92, "elec_poc_last"), (115, "exclusion_flag"), (121, "evs_source"),
]
# A line needs at least this many fields to be a record.
MIN_FIELDS = 122
# Column order of the stored registrations table.
REGISTRATION_COLUMNS = [
    "uei", "snapshot_date", "cage_code", "legal_name", "dba_name", "division_name",
    "division_number", "phys_addr1", "phys_addr2", "phys_city", "phys_state",
    "phys_zip", "phys_zip4", "phys_country", "phys_congress", "entity_url",
    "entity_structure", "state_of_incorp", "country_of_incorp", "bus_type_string",
    "primary_naics", "naics_string", "extract_code", "initial_reg_date",
    "expiration_date", "last_update_date", "activation_date", "gov_poc_first",
    "gov_poc_last", "elec_poc_first", "elec_poc_last", "exclusion_flag",
    "evs_source", "name_norm", "zip5", "name_first4", "source_file",
]
# Fields shown by the entity card, in order.
ENTITY_CARD_FIELDS = [
    "uei", "legal_name", "dba_name", "phys_addr1", "phys_city", "phys_state",
    "zip5", "cage_code", "entity_url", "primary_naics", "entity_structure",
    "initial_reg_date", "gov_poc_first", "gov_poc_last",
]
# -------------------------------------------------------------------------

REGISTRATION_SCHEMA = T.StructType(
    [T.StructField(c, T.DateType() if c == "snapshot_date" else T.StringType(), True)
     for c in REGISTRATION_COLUMNS]
)

# Columns the linkage stage reads; projecting them early keeps the cached
# link input narrow (the stored table has 37 columns).
LINK_COLUMNS = [
    "uei", "legal_name", "name_norm", "name_first4", "dba_name", "phys_city",
    "zip5", "phys_state", "entity_url", "primary_naics", "gov_poc_last",
    "cage_code", "entity_structure",
]
