"""Dimension tables: states, regions, FIPS codes, modes, commodities, centroids.

All dimensions are tiny and of fixed size, so joins against them are
explicit broadcasts. The literal values below must equal the published
source data (state names, FIPS codes, SCTG labels, mode labels, region
lists, route centroids), so they are kept verbatim.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the published code lists; natural order)
# ---------------------------------------------------------------------------

STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas",
    "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho",
    "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas",
    "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma",
    "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah",
    "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia",
    "WI": "Wisconsin", "WY": "Wyoming",
}

STATE_FIPS = {
    1: "AL", 2: "AK", 4: "AZ", 5: "AR", 6: "CA", 8: "CO", 9: "CT", 10: "DE",
    11: "DC", 12: "FL", 13: "GA", 15: "HI", 16: "ID", 17: "IL", 18: "IN", 19: "IA",
    20: "KS", 21: "KY", 22: "LA", 23: "ME", 24: "MD", 25: "MA", 26: "MI", 27: "MN",
    28: "MS", 29: "MO", 30: "MT", 31: "NE", 32: "NV", 33: "NH", 34: "NJ", 35: "NM",
    36: "NY", 37: "NC", 38: "ND", 39: "OH", 40: "OK", 41: "OR", 42: "PA", 44: "RI",
    45: "SC", 46: "SD", 47: "TN", 48: "TX", 49: "UT", 50: "VT", 51: "VA", 53: "WA",
    54: "WV", 55: "WI", 56: "WY",
}

SCTG_NAMES = {
    1: "Animals & Fish", 2: "Grains", 3: "Other Ag", 4: "Basic Food", 5: "Milled Food",
    6: "Alcoholic Beverages", 7: "Tobacco", 8: "Building Stone", 9: "Nonmetallic Minerals",
    10: "Metallic Ores", 11: "Crude Petroleum", 12: "Gravel & Sand",
    13: "Phosphate Fertilizers", 14: "Basic Chemicals", 15: "Pharmaceuticals",
    16: "Fertilizer Mixes", 17: "Plastic Products", 18: "Logs & Wood",
    19: "Wood Products", 20: "Pulp & Paper", 21: "Paper Articles",
    22: "Printed Products", 23: "Textiles & Leather", 24: "Nonmetal Mineral Products",
    25: "Base Metal Products", 26: "Machinery", 27: "Electronic Equipment",
    28: "Motor Vehicles", 29: "Transport Equipment", 30: "Precision Instruments",
    31: "Furniture", 32: "Misc. Products", 33: "Waste & Scrap", 34: "Mixed Freight",
    35: "Unknown", 36: "Other", 37: "Tobacco (seperate)",
    38: "Alcohol (seperate)", 39: "Fish (seperate)", 40: "Vegetable Oils",
    41: "Meat", 42: "Live Animals",
}

MODE_NAMES = {1: "Truck", 2: "Rail", 3: "Water", 4: "Air", 5: "Pipeline", 6: "Other",
              7: "Multiple", 8: "Parcel"}

# Census regions as used by the feature code (DC counted in the South).
REGIONS = {
    "Northeast": ["CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"],
    "Midwest": ["IL", "IN", "MI", "OH", "WI", "IA", "KS", "MN", "MO", "NE", "ND", "SD"],
    "South": ["DE", "FL", "GA", "MD", "NC", "SC", "VA", "DC", "WV", "AL", "KY", "MS",
              "TN", "AR", "LA", "OK", "TX"],
    "West": ["AZ", "CO", "ID", "MT", "NV", "NM", "UT", "WY", "AK", "CA", "HI", "OR", "WA"],
}

# Route centroids (lat, lon) used for great-circle fallback distances.
ROUTE_CENTERS = {
    "AL": (32.8, -86.9), "AK": (61.4, -152.5), "AZ": (34.0, -111.7), "AR": (34.8, -92.4),
    "CA": (36.1, -119.7), "CO": (39.0, -105.5), "CT": (41.6, -72.7), "DE": (39.0, -75.5),
    "FL": (27.8, -81.4), "GA": (32.6, -83.4), "HI": (19.7, -155.5), "ID": (44.4, -114.7),
    "IL": (40.0, -89.4), "IN": (39.8, -86.1), "IA": (42.0, -93.4), "KS": (38.5, -98.4),
    "KY": (37.5, -84.7), "LA": (30.9, -91.7), "ME": (45.3, -69.4), "MD": (39.0, -76.7),
    "MA": (42.4, -72.7), "MI": (44.3, -85.6), "MN": (46.1, -94.3), "MS": (32.8, -89.8),
    "MO": (38.5, -92.5), "MT": (47.0, -109.7), "NE": (41.5, -99.6), "NV": (38.5, -117.1),
    "NH": (43.6, -71.6), "NJ": (40.3, -74.5), "NM": (34.4, -106.1), "NY": (42.8, -75.0),
    "NC": (35.6, -79.4), "ND": (47.4, -100.4), "OH": (40.3, -82.8), "OK": (35.6, -97.1),
    "OR": (43.8, -120.6), "PA": (41.0, -77.7), "RI": (41.6, -71.5), "SC": (33.9, -80.9),
    "SD": (44.3, -100.2), "TN": (35.9, -86.5), "TX": (31.5, -99.4), "UT": (39.3, -111.7),
    "VT": (44.1, -72.7), "VA": (37.6, -78.4), "WA": (47.3, -120.4), "WV": (38.6, -80.6),
    "WI": (44.6, -89.9), "WY": (42.9, -107.5), "DC": (38.9, -77.0),
}

# Representative city per state (weather lookups).
STATE_CITIES = {
    "AL": "Birmingham", "AK": "Anchorage", "AZ": "Phoenix", "AR": "Little Rock",
    "CA": "Los Angeles", "CO": "Denver", "CT": "Hartford", "DE": "Wilmington",
    "FL": "Miami", "GA": "Atlanta", "HI": "Honolulu", "ID": "Boise",
    "IL": "Chicago", "IN": "Indianapolis", "IA": "Des Moines", "KS": "Wichita",
    "KY": "Louisville", "LA": "New Orleans", "ME": "Portland", "MD": "Baltimore",
    "MA": "Boston", "MI": "Detroit", "MN": "Minneapolis", "MS": "Jackson",
    "MO": "Kansas City", "MT": "Billings", "NE": "Omaha", "NV": "Las Vegas",
    "NH": "Manchester", "NJ": "Newark", "NM": "Albuquerque", "NY": "New York",
    "NC": "Charlotte", "ND": "Fargo", "OH": "Columbus", "OK": "Oklahoma City",
    "OR": "Portland", "PA": "Philadelphia", "RI": "Providence", "SC": "Columbia",
    "SD": "Sioux Falls", "TN": "Memphis", "TX": "Houston", "UT": "Salt Lake City",
    "VT": "Burlington", "VA": "Virginia Beach", "WA": "Seattle", "WV": "Charleston",
    "WI": "Milwaukee", "WY": "Cheyenne",
}

# State coordinates (lat, lon) of the state lookup (weather fallback); these
# differ from the route centroids above and are used only by the lookups.
STATE_COORDINATES = {
    "AL": (32.8067, -86.7113), "AK": (64.2008, -152.2782), "AZ": (33.7298, -111.4312),
    "AR": (34.9697, -92.3731), "CA": (36.1163, -119.6674), "CO": (39.0598, -105.3111),
    "CT": (41.5978, -72.7554), "DE": (39.3185, -75.5244), "FL": (27.9947, -81.7603),
    "GA": (33.0406, -83.6431), "HI": (21.0943, -157.4983), "ID": (44.2405, -114.2430),
    "IL": (40.3495, -88.9861), "IN": (39.8494, -86.2583), "IA": (42.0115, -93.2105),
    "KS": (38.5266, -96.7265), "KY": (37.6681, -84.6701), "LA": (31.1695, -91.8749),
    "ME": (44.6939, -69.3819), "MD": (39.0639, -76.8021), "MA": (42.2352, -71.0275),
    "MI": (43.3266, -84.5361), "MN": (45.6945, -93.9196), "MS": (32.7416, -89.6787),
    "MO": (38.4561, -92.2884), "MT": (46.9219, -103.6006), "NE": (41.4925, -99.9018),
    "NV": (38.8026, -116.4194), "NH": (43.4525, -71.3127), "NJ": (40.2206, -74.7597),
    "NM": (34.5199, -105.8701), "NY": (42.1657, -74.9481), "NC": (35.6301, -79.8064),
    "ND": (47.5289, -99.784), "OH": (40.3888, -82.7649), "OK": (35.5653, -96.9289),
    "OR": (43.8041, -120.5542), "PA": (40.5908, -77.2098), "RI": (41.6809, -71.5118),
    "SC": (34.0007, -81.1637), "SD": (44.2998, -99.4388), "TN": (35.7478, -86.6923),
    "TX": (31.9686, -99.9018), "UT": (39.3210, -111.0937), "VT": (44.0459, -72.7107),
    "VA": (37.4316, -78.6569), "WA": (47.4009, -121.4905), "WV": (38.5976, -80.4549),
    "WI": (44.2685, -89.6165), "WY": (42.7559, -107.3025),
}

# Fuel price API: product code -> fuel type, and state -> area code.
EIA_PRODUCTS = {"EPM0R": "regular", "EPM0M": "mid_grade", "EPM0P": "premium", "EPD2D": "diesel"}
EIA_STATE_AREAS = {"CA": "SCA", "CO": "SCO", "MA": "SMA", "NY": "SNY", "TX": "STX"}

# Truck-rate regions -> comma-joined state codes (None: keep null).
RATE_REGIONS = {
    "CALIFORNIA": "CA", "ARIZONA": "AZ", "FLORIDA": "FL",
    "TEXAS": "TX", "NEW YORK": "NY", "GREAT LAKES": "IL,IN,MI,OH,WI",
    "SOUTHEAST": "GA,NC,SC,AL,MS,TN", "PNW": "OR,WA,ID,MT",
    "MID-ATLANTIC": "PA,NJ,MD,DE,VA,WV", "OTHER": None,
}

# Cost model constants: miles per gallon, driver $/hour, maintenance $/mile,
# free-flow speed (mph), default diesel price ($/gal), earth radius (miles).
TRUCK_MPG = 6.5
DRIVER_RATE = 35.0
MAINTENANCE_PER_MI = 0.15
SPEED_BASELINE = 55.0
DEFAULT_DIESEL = 3.50
EARTH_RADIUS_MI = 3959.0

# ---------------------------------------------------------------------------
# DataFrame forms
# ---------------------------------------------------------------------------


def states_dim(spark: SparkSession) -> DataFrame:
    """One row per state code: code, name, upper-case name, region, is_state."""
    region_of = {code: r for r, codes in REGIONS.items() for code in codes}
    rows = [(c, n, n.upper(), region_of.get(c, "Other"), True, STATE_CITIES.get(c))
            for c, n in STATE_NAMES.items()]
    rows.append(("DC", "District of Columbia", "DISTRICT OF COLUMBIA", "South", False, None))
    schema = "code string, name string, name_upper string, region string, is_state boolean, city string"
    return spark.createDataFrame(rows, schema)


def fips_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATE_FIPS.items()), "fips int, code string")


def sctg_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SCTG_NAMES.items()), "sctg2 int, commodity string")


def mode_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MODE_NAMES.items()), "dms_mode int, mode string")


def centers_dim(spark: SparkSession) -> DataFrame:
    rows = [(c, float(lat), float(lon)) for c, (lat, lon) in ROUTE_CENTERS.items()]
    return spark.createDataFrame(rows, "code string, lat double, lon double")


def state_index_dim(spark: SparkSession) -> DataFrame:
    """k (0..49, in the order above), code, name: binds a numeric key to a state."""
    rows = [(i, c, n) for i, (c, n) in enumerate(STATE_NAMES.items())]
    return spark.createDataFrame(rows, "k int, code string, name string")


def state_index_sql() -> str:
    """The same 50-row table as SQL VALUES (for oracle queries)."""
    vals = ", ".join(f"({i}, '{c}', '{n}')" for i, (c, n) in enumerate(STATE_NAMES.items()))
    return f"st AS (SELECT * FROM (VALUES {vals}) AS t(k, code, name))"


def state_coords_dim(spark: SparkSession) -> DataFrame:
    rows = [(c, float(lat), float(lon)) for c, (lat, lon) in STATE_COORDINATES.items()]
    return spark.createDataFrame(rows, "code string, lat double, lon double")
