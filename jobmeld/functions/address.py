"""Address text to street, ward, district, province.

The names that count as a unit come from an `admin_units(level, name, parent)` table, so a new
administrative map is a new table, not new code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions.binding import detached
from jobmeld.functions.text import squeeze, trim_ws

# Words and abbreviations written before a unit's name
UNIT_WORDS = [
    "thành phố",
    "tỉnh",
    "tp.",
    "tp",
    "quận",
    "huyện",
    "thị xã",
    "thị trấn",
    "phường",
    "xã",
    "q.",
    "p.",
]
# a word needs a blank after it, an abbreviation with a dot does not
_UNIT = (
    r"(?iu)^(?:(?:"
    + "|".join(w for w in UNIT_WORDS if not w.endswith("."))
    + r")\s+|(?:"
    + "|".join(w.replace(".", r"\.") for w in UNIT_WORDS if w.endswith("."))
    + r")\s*)"
)


def unit_key(col: Column) -> Column:
    """A unit's name without its kind, lower case, single-blanked."""
    return F.lower(F.regexp_replace(F.trim(squeeze(col)), _UNIT, ""))


def folded_units(units: DataFrame) -> DataFrame:
    """One row per province: key, name, its districts with their wards, and the wards directly below it.

    Units without a province stand in a row with a blank key and no name. A row grows with the units of its
    province only.
    """
    key = unit_key(F.col("name"))
    in_province, in_district = (F.coalesce(unit_key(F.col(c)), F.lit("")) for c in ("province", "district"))
    level = F.col("level")
    known = units.select(
        "level", "name", key.alias("key"),
        F.when(level == "province", key).otherwise(in_province).alias("_key"),
        F.when(level == "district", key).when(level == "ward", in_district).otherwise("").alias("at"),
        # what stands below a unit of its own level is none of that level
        F.when(level == "province", F.concat(in_province, in_district) == "").when(level == "district", in_district == "")
        .otherwise(level == "ward").alias("good"),
    )
    one = known.filter("good").groupBy("_key", "at", "level", "key").agg(F.min("name").alias("name"))

    def name_of(kind: str) -> Column:
        return F.min(F.when(F.col("level") == kind, F.col("name")))

    wards = F.map_from_entries(F.collect_list(F.when(F.col("level") == "ward", F.struct("key", "name"))))
    places = one.groupBy("_key", "at").agg(name_of("province").alias("province"), name_of("district").alias("name"), wards.alias("wards"))
    district = F.when(F.col("name").isNotNull(), F.struct("at", F.struct("name", "wards")))
    return places.groupBy("_key").agg(
        F.min("province").alias("_province"),
        F.map_from_entries(F.collect_list(district)).alias("_districts"),
        F.first(F.when(F.col("at") == "", F.col("wards")), ignorenulls=True).alias("_wards"),
    )


def split_address(df: DataFrame, address: str, units: DataFrame, out: str = "addr") -> DataFrame:
    """Add `out` = struct(street, ward, district, province) (NRM4).

    `units` has columns level ("province", "district", "ward"), name, district, province; the last
    two name the units above. Parts are read from the right. A part is taken as a unit only when
    the table knows it at that level below the units already found, and what is left over is the
    street. A ward may stand directly below a province. Names come out as `units` spells them.

    One join by province brings all units below it as maps, in which the other parts are looked up within the row.
    """
    folded = folded_units(units)
    parts = F.filter(F.transform(F.split(F.col(address), ","), trim_ws), lambda p: p != "")
    parts = F.coalesce(parts, F.array().cast("array<string>"))
    work = df.select("*", parts.alias("_parts"))
    # the last three parts can be units
    last = F.transform(F.reverse(F.slice("_parts", F.greatest(F.size("_parts") - 2, F.lit(1)), F.lit(3))), unit_key)
    work = work.select("*", last.alias("_last"))
    table = folded.filter("_key <> ''").select(detached(F.col("_key")).alias("_key"), "_province", "_districts", "_wards")
    work = work.join(table, F.get("_last", F.lit(0)) == F.col("_key"), "left")

    found = F.col("_province").isNotNull()
    # of units that no province holds there is one row at most
    loose = folded.filter("_key = ''").agg(F.first(F.struct("_districts", "_wards")).alias("_loose")).scalar()
    work = work.select("*", F.when(~found, loose).alias("_loose"), found.cast("int").alias("_used"))
    district = F.try_element_at(F.coalesce("_districts", F.col("_loose")["_districts"]), F.get("_last", "_used"))
    work = work.select("*", district.alias("_district"))
    work = work.withColumn("_used", F.col("_used") + F.col("_district").isNotNull().cast("int"))
    own_wards = F.coalesce("_wards", F.col("_loose")["_wards"])
    wards = F.when(F.col("_district").isNotNull(), F.col("_district")["wards"]).otherwise(own_wards)
    work = work.select("*", F.try_element_at(wards, F.get("_last", "_used")).alias("_ward"))
    used = F.col("_used") + F.col("_ward").isNotNull().cast("int")
    street = F.array_join(F.slice("_parts", F.lit(1), F.size("_parts") - used), ", ")
    return work.select(
        *df.columns,
        F.struct(
            F.nullif(street, F.lit("")).alias("street"),
            F.col("_ward").alias("ward"),
            F.col("_district")["name"].alias("district"),
            F.col("_province").alias("province"),
        ).alias(out),
    )


def address_part(addr: Column, part: str = "full") -> Column:
    """One part of a split address, the whole struct for "full", null for an unknown name."""
    if part == "full":
        return addr
    if part in ("street", "ward", "district", "province"):
        return addr[part]
    return F.lit(None).cast("string")
