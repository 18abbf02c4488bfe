"""Values of the data contract."""

from __future__ import annotations

# The two literals of the `source` column.
BULK_SOURCE = "kaggle"
API_SOURCE = "rentcast"

# The endpoint recorded in an API envelope and the page size of that API.
API_ENDPOINT = "listings/sale"
PAGE_SIZE = 500

# State names and their two-letter codes.
STATE_CODES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR",
    "California": "CA", "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE",
    "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID",
    "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS",
    "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD",
    "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS",
    "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV",
    "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY",
    "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK",
    "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC",
    "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX", "Utah": "UT",
    "Vermont": "VT", "Virginia": "VA", "Washington": "WA", "West Virginia": "WV",
    "Wisconsin": "WI", "Wyoming": "WY",
}

# Street suffixes and their short forms, in the order they apply.
STREET_SUFFIXES = [
    ("Street", "St"),
    ("Avenue", "Ave"),
    ("Boulevard", "Blvd"),
    ("Drive", "Dr"),
    ("Road", "Rd"),
    ("Lane", "Ln"),
    ("Court", "Ct"),
]

# The property-type lookup table.
PROPERTY_TYPES = [
    (1, "studio"),
    (2, "single_family"),
    (3, "multi_family"),
    (4, "condo"),
    (5, "townhouse"),
    (6, "unknown"),
]
UNKNOWN_TYPE = "unknown"

# API property labels that have a type of their own.
API_PROPERTY_LABELS = [
    ("Single Family", "single_family"),
    ("Condo", "condo"),
    ("Townhouse", "townhouse"),
    ("Multi-Family", "multi_family"),
]

# Cleaning limits and the continental bounding box in degrees.
MAX_PRICE = 100_000_000
MAX_BED = 20
LATITUDE_RANGE = (24.0, 49.5)
LONGITUDE_RANGE = (-125.0, -66.0)

LOCATION_KEY = ["city", "state", "zip_code"]

# The characters Unicode calls White_Space.
WHITE_SPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
