"""Fixed values that must equal the reference's for identical results.

All lookup tables below are stated plainly, in natural order, and are kept
together here on purpose; nothing else in the package hard-codes them.
"""
from __future__ import annotations

# --- fixed values: country dimension (statistics-office code, name) --------
# The 27 member-state codes in alphabetical order with their English names.
COUNTRY_NAMES: dict[str, str] = {
    "AT": "Austria", "BE": "Belgium", "BG": "Bulgaria", "CY": "Cyprus",
    "CZ": "Czechia", "DE": "Germany", "DK": "Denmark", "EE": "Estonia",
    "EL": "Greece", "ES": "Spain", "FI": "Finland", "FR": "France",
    "HR": "Croatia", "HU": "Hungary", "IE": "Ireland", "IT": "Italy",
    "LT": "Lithuania", "LU": "Luxembourg", "LV": "Latvia", "MT": "Malta",
    "NL": "Netherlands", "PL": "Poland", "PT": "Portugal", "RO": "Romania",
    "SE": "Sweden", "SI": "Slovenia", "SK": "Slovakia",
}

# --- fixed values: statistics-office code -> ISO 3166-1 alpha-2 -----------
# Only Greece differs.
CODE_TO_ISO2: dict[str, str] = {"EL": "GR"}

# --- fixed values: ISO 3166-1 alpha-3 per statistics-office code -----------
# (public ISO 3166 codes; Greece is keyed by its office code EL -> GRC)
CODE_TO_ISO3: dict[str, str] = {
    "AT": "AUT", "BE": "BEL", "BG": "BGR", "CY": "CYP", "CZ": "CZE",
    "DE": "DEU", "DK": "DNK", "EE": "EST", "EL": "GRC", "ES": "ESP",
    "FI": "FIN", "FR": "FRA", "HR": "HRV", "HU": "HUN", "IE": "IRL",
    "IT": "ITA", "LT": "LTU", "LU": "LUX", "LV": "LVA", "MT": "MLT",
    "NL": "NLD", "PL": "POL", "PT": "PRT", "RO": "ROU", "SE": "SWE",
    "SI": "SVN", "SK": "SVK",
}

# --- fixed values: default extraction scope (18 countries, config order) ---
SCOPE_COUNTRIES: list[str] = [
    "DE", "FR", "IT", "ES", "PL", "NL", "BE", "SE", "AT",
    "PT", "FI", "IE", "CZ", "RO", "HU", "DK", "EL", "SK",
]

# --- fixed values: dataset names and their extraction slices ---------------
GDP = "gdp_annual"
UNEMPLOYMENT = "unemployment_annual"
ENERGY = "energy_intensity"
INFLATION = "inflation_annual"
DATASETS: list[str] = [GDP, UNEMPLOYMENT, ENERGY, INFLATION]

# dataset -> fixed column values of its extraction slice
DATASET_SLICES: dict[str, dict[str, str]] = {
    GDP: {"unit": "CP_MEUR", "indicator": "B1GQ"},
    UNEMPLOYMENT: {"unit": "PC_ACT", "age_group": "Y15-74", "sex": "T"},
    ENERGY: {"unit": "KGOE_TEUR"},
    INFLATION: {"unit": "RCH_A_AVG"},
}

# --- fixed values: thresholds and defaults ---------------------------------
ZSCORE_THRESHOLD = 2.0          # alert when |z| is strictly greater
SEVERITY_HIGH = 4.0             # |z| >= 4  -> HIGH
SEVERITY_MEDIUM = 3.0           # |z| >= 3  -> MEDIUM, else LOW
TOP_ANOMALIES_PER_TABLE = 200
BAND_HIGH = 70.0                # score band (table): >= 70 top, >= 40 middle
BAND_MID = 40.0
TIER_HIGH = 70.0                # tier (radar): > 70 Strong, > 40 Moderate
TIER_MID = 40.0
NEUTRAL_SCORE = 50.0            # score when min-max is undefined
FULL_PIPELINE_MARKER = "full_pipeline"
FULL_PIPELINE_EVENT = "panel_full_pipeline"   # event name for "all tables loaded"
WATERMARK = "5 minutes"
OUT_OF_ORDERNESS = "30 seconds"   # record stream: how late a record may come
WINDOW = "10 minutes"
TRIGGER = "60 seconds"
RECENT_ALERTS_LIMIT = 50
YEAR_MIN_DEFAULT = 2000
YEAR_MAX_DEFAULT = 2030
