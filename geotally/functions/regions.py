"""Column functions and joins for region identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Postal code, fips code and name of the states and territories.
STATES = [
    ("AL", "01", "Alabama"), ("AK", "02", "Alaska"), ("AZ", "04", "Arizona"), ("AR", "05", "Arkansas"),
    ("CA", "06", "California"), ("CO", "08", "Colorado"), ("CT", "09", "Connecticut"), ("DE", "10", "Delaware"),
    ("DC", "11", "District of Columbia"), ("FL", "12", "Florida"), ("GA", "13", "Georgia"), ("HI", "15", "Hawaii"),
    ("ID", "16", "Idaho"), ("IL", "17", "Illinois"), ("IN", "18", "Indiana"), ("IA", "19", "Iowa"),
    ("KS", "20", "Kansas"), ("KY", "21", "Kentucky"), ("LA", "22", "Louisiana"), ("ME", "23", "Maine"),
    ("MD", "24", "Maryland"), ("MA", "25", "Massachusetts"), ("MI", "26", "Michigan"), ("MN", "27", "Minnesota"),
    ("MS", "28", "Mississippi"), ("MO", "29", "Missouri"), ("MT", "30", "Montana"), ("NE", "31", "Nebraska"),
    ("NV", "32", "Nevada"), ("NH", "33", "New Hampshire"), ("NJ", "34", "New Jersey"), ("NM", "35", "New Mexico"),
    ("NY", "36", "New York"), ("NC", "37", "North Carolina"), ("ND", "38", "North Dakota"), ("OH", "39", "Ohio"),
    ("OK", "40", "Oklahoma"), ("OR", "41", "Oregon"), ("PA", "42", "Pennsylvania"), ("RI", "44", "Rhode Island"),
    ("SC", "45", "South Carolina"), ("SD", "46", "South Dakota"), ("TN", "47", "Tennessee"), ("TX", "48", "Texas"),
    ("UT", "49", "Utah"), ("VT", "50", "Vermont"), ("VA", "51", "Virginia"), ("WA", "53", "Washington"),
    ("WV", "54", "West Virginia"), ("WI", "55", "Wisconsin"), ("WY", "56", "Wyoming"), ("AS", "60", "American Samoa"),
    ("GU", "66", "Guam"), ("MP", "69", "Northern Mariana Islands"), ("PR", "72", "Puerto Rico"),
    ("VI", "78", "Virgin Islands"),
]


def _lookup(pairs, key: Column) -> Column:
    """Value of a literal map; written as one SQL expression, which is cheap to build."""
    entries = ", ".join(f"'{k}', '{v}'" for k, v in pairs)
    return F.try_element_at(F.expr(f"map({entries})"), key)


def state_code_of_fips(fips: Column) -> Column:
    """Two-letter code of the state that a state, county or place fips lies in."""
    return _lookup([(f, c) for c, f, _ in STATES], F.substring(fips, 1, 2))


def state_fips_of_code(code: Column) -> Column:
    return _lookup([(c, f) for c, f, _ in STATES], code)


def state_code_of_name(name: Column) -> Column:
    return _lookup([(n, c) for c, _, n in STATES], name)


def state_name_of_code(code: Column) -> Column:
    return _lookup([(c, n) for c, _, n in STATES], code)


def is_unknown_county(fips: Column) -> Column:
    return fips.endswith("999")


def pad(text: Column, width: int) -> Column:
    """Zeros in front up to the width; longer text stays as it is."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def fips_from_int(number: Column) -> Column:
    text = number.cast("string")
    return F.when(number == 0, "0").when(number < 100, pad(text, 2)).otherwise(pad(text, 5))


def cbsa_location_id(code: Column) -> Column:
    return F.concat(F.lit("iso1:us#cbsa:"), code)


def hsa_location_id(code: Column) -> Column:
    return F.concat(F.lit("iso1:us#hsa:"), code)


def hsa_code(number: Column) -> Column:
    return pad(number.cast("int").cast("string"), 3)


def state_location_id(code: Column) -> Column:
    return F.concat(F.lit("iso1:us#iso2:us-"), F.lower(code))


def location_level(location_id: Column) -> Column:
    """Aggregation level read off the shape of the id; NULL when the shape is unknown."""
    digits = F.length(F.regexp_extract(location_id, r"^iso1:us#.*fips:(\d+)$", 1))
    return (
        F.when(digits == 2, "state")
        .when(digits == 3, "hsa")
        .when(digits == 5, "county")
        .when(digits == 7, "place")
        .when(location_id.rlike(r"^iso1:us#iso2:us-..$"), "state")
        .when(location_id.rlike(r"^iso1:us#cbsa:\d+$"), "cbsa")
        .when(location_id.rlike(r"^iso1:\w\w$"), "country")
        .when(location_id.rlike(r"^iso1:us#hsa:\d+$"), "hsa")
    )


def parent_state_location_id(location_id: Column) -> Column:
    """State id of a county or place id that carries its state."""
    return F.nullif(F.regexp_extract(location_id, r"^(iso1:us#iso2:us-..)#fips:\d+$", 1), F.lit(""))


def fips_to_location_id(df: DataFrame, geo: DataFrame, fips: str = "fips") -> DataFrame:
    """Add location_id; an unknown fips gets the fallback id."""
    ids = geo.filter("fips is not null").select(F.col("fips").alias(fips), F.col("location_id").alias("_id"))
    return (
        df.join(ids, fips, "left")
        .withColumn("location_id", F.coalesce("_id", F.concat(F.lit("iso1:us#fips:"), fips)))
        .drop("_id")
    )


def location_id_to_fips(df: DataFrame, geo: DataFrame) -> DataFrame:
    return df.join(geo.select("location_id", "fips"), "location_id", "left")
