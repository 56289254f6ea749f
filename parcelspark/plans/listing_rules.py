"""Values and keyword tables of the listing feature set."""

from __future__ import annotations

from datetime import date

from parcelspark.sources.schemas import EXTERIOR_BOOLEANS, INTERIOR_BOOLEANS

# Postal codes known to be wrong.
BAD_POSTCODES = [
    "FL", "RI 02", "GA", "125L7", "Ludow", "al", "4817-", "Selec", "1260.", "ia", "na48", "javas", "AL", "3399.",
    "4834-", "ny", "RI", "783.8", "7784-", "_4807", "The 7", "Drive", "167-3", "`80`7", "321y6", "Al", "Other", "TX",
    "5233+", "-",
]

# Categories, statuses and subtypes that select the listings.
PROPERTY_TYPES = ["residential", "residential income", "common interest", "residental"]
RENTAL_CATEGORIES = ["For Rent", "Rent", "Rented/Leased"]
SOLD_STATUSES = ["sold", "off market"]
OPEN_STATUSES = ["active", "pending"]
SUBTYPES = {
    "houses": ["single family detached"],
    "condos": ["condominium", "townhouse", "apartment", "single family attached", "duplex", "triplex", "quadruplex",
               "stock cooperative", "adult community", "vacation home"],
}

# Bounds.
PRICE_FLOOR = {"houses": 65000, "condos": 55000}
PRICE_CEILING = 4000000
FIRST_LISTING = date(2013, 1, 1)
FIRST_CLOSING = date(2019, 1, 1)
OLDEST_YEAR_BUILT = 1800
ROOMS_BELOW = 10
LIVING_AREA = (0, 10000)
LOT_ACRES = (0, 20)
DEMOGRAPHIC_BOUNDS = {
    "landarea": (None, 1000),
    "waterarea": (None, 50),
    "population_density": (None, 150000),
    "population_grow": (-1000, 10000),
    "population_estimate": (-750, 8000),
}
INCREMENT_MONTHS = 3
SAMPLED_SHARE = {"houses": 0.25}

# Paths of the zero/one flags that come from stored booleans.
BOOLEAN_PATHS = {
    "garage": "building_structure.has_garage",
    "parking": "building_structure.has_parking",
    "is_new_construction": "building_structure.is_new_construction",
    **{n: f"building_structure.interior_features.{n}" for n in INTERIOR_BOOLEANS},
    **{n: f"building_structure.exterior_features.{n}" for n in EXTERIOR_BOOLEANS},
}

# Keywords. Any one of the words sets the flag.
ROOF_WORDS = {
    "shingle_roof_type": ["shingle", "shngl"],
    "tile_roof_type": ["tile"],
    "composition_roof_type": ["comp"],
    "asphalt_roof_type": ["asphalt"],
    "fiberglass_roof_type": ["glass", "fiberglass"],
    "metal_roof_type": ["metal", "aluminum"],
    "architectural_roof_type": ["architec"],
    "pitched_roof_type": ["pitched"],
    "flat_roof_type": ["flat"],
    "concrete_roof_type": ["concrete"],
    "slate_roof_type": ["slate"],
    "wood_roof_type": ["wood", "shake"],
}
WATER_NONE_WORDS = ["none"]
PUBLIC_WATER_WORDS = ["public", "city", "community", "municipal", "county", "connected", "lake", "river", "central",
                      "hcud"]
PUBLIC_WATER_UNLESS = ["not connected"]
WATER_WORDS = {"private_water": ["private", "water company"], "culinary_water": ["culinary"]}
WELL_WATER = {"water_source": ["well", "irrigation", "cistern"], "utilities": ["community well"]}
NOT_CONNECTED_WATER = {
    "water_source": ["not connected", "notconnected", "water at street"],
    "utilities": ["water: not connected", "water not connected", "water not available", "water: not available",
                  "waternotavailable"],
}
UTILITY_WORDS = {"underground_utilities": ["underground"]}
SEWER_NEGATIVES = ["sewer not", "sewer: not", "sewernot"]
GAS_NEGATIVES = ["gasnot", "gas not", "gas: not "]
PARKING_NONE_WORDS = ["no", "none", "features: none"]
PARKING_NEGATABLE = {
    "attached_parking": ("attached", ["attached: no", "attached:no", "attached, no", "attached no"]),
    "detached_parking": ("detached", ["detached: no", "detached:no", "detached, no", "detached no"]),
    "garage_parking": ("garage", ["no garage", "non garage", "nogarage", "garage no", "garage: no"]),
}
PARKING_WORDS = {
    "two_car_parking": ["2", "two"],
    "street_parking": ["street", "parking lot", "parking pad", "paved"],
    "door_opener_parking": ["door opener", "dooropener"],
    "guest_parking": ["guest"],
    "driveway_parking": ["driveway"],
    "carport_parking": ["carport"],
    "assigned_parking": ["assigned"],
}
MATERIAL_WORDS = {
    "vinyl_materials": ["vinyl"],
    "brick_materials": ["brick"],
    "aluminum_materials": ["aluminum"],
    "wood_materials": ["wood", "stick"],
    "frame_materials": ["frame"],
    "stucco_materials": ["stucco"],
    "site_built_materials": ["site built"],
    "block_materials": ["block"],
    "concrete_materials": ["concrete"],
    "cement_materials": ["cement"],
    "stone_materials": ["stone"],
}
FLOOR_WORDS = {
    "carpet_floorings": ["carpet"],
    "vinyl_floorings": ["vinyl"],
    "laminate_floorings": ["laminate"],
    "tile_floorings": ["tile"],
    "hardwood_floorings": ["hardwood"],
    "linoleum_floorings": ["linoleum"],
    "ceramic_floorings": ["ceramic"],
}
WOOD_FLOOR = (["wood"], ["hardwood"])

# School levels and the level codes that serve each; public schools only.
SCHOOL_LEVELS = {
    "elem": ["P", "PM", "E", "O", "PMH"],
    "middle": ["M", "PM", "MH", "O", "PMH", "S"],
    "high": ["H", "MH", "O", "PMH", "S"],
}
PUBLIC_SCHOOL = "PUB"
SCHOOL_MEASURES = ["pup_teach", "pov_lev", "pctile_y1"]
SCHOOL_COLUMNS = [f"{level}_{m}" for level in SCHOOL_LEVELS for m in ["distance", *SCHOOL_MEASURES]]

TEXT_COLUMNS = ["roof_types", "utilities", "water_source", "parking_features", "construction_materials", "flooring"]
ECONOMY_COLUMNS = ["state_population", "annual_temperature", "tornado_index", "unemployment_rate", "case_shiller",
                   "home_price_index", "mortgage"]
