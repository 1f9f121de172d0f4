"""Raw tables to curated tables. Each function names the raw tables it takes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perron.functions.casts import to_decimal, to_float
from perron.functions.text import first_token, last_segment, occurrences, prefixed_key, without_spaces
from perron.model.tables import CURATED, RAW
from perron.operators.aggregates import distinct_rows, first_per_key, rounded_mean
from perron.operators.joins import HOT_ROWS, sized_join
from perron.operators.projection import conform, default_flags, project, without_token

# Stop numbers of the home country begin here, and keys of stops begin like this.
STOP_PREFIX = "ch:1:sloid:"
STOP_OFFSET = 8_500_000

TRAFFIC = ("daily", "wday", "holiday")


def transport(raw_transport: DataFrame) -> DataFrame:
    renamed = raw_transport.withColumnRenamed("operator_short_name", "operator_abbr")
    return conform(renamed, CURATED["curated_transport"])


def accessibility(
    raw_accessibility_1: DataFrame,
    raw_accessibility_2: DataFrame,
    raw_toilets: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Access by vehicle, joined in full to the platforms, with the toilets of each place.

    The key is that of the access table alone: a platform without an entry there has a NULL key.
    """
    platforms = raw_accessibility_2.withColumnRenamed("sloid", "platform_sloid")
    merged = sized_join(
        raw_accessibility_1, platforms, "sloid", "platform_sloid", "full", hot_rows=hot_rows
    ).drop("platform_sloid")
    toilets = distinct_rows(
        raw_toilets,
        F.col("parent_sloid").alias("toilet_sloid"),
        F.col("designation").alias("toilet_designation"),
        F.col("wheelchair_accessibility").alias("toilet_wheelchair_access"),
    )
    joined = sized_join(
        merged, toilets, "sloid", "toilet_sloid", "left", left_like=raw_accessibility_1, hot_rows=hot_rows
    )
    return conform(joined, CURATED["curated_accessibility"])


def vehicles(raw_transport_subtypes: DataFrame) -> DataFrame:
    """Open flags become false; of alternatives `a OR b` the first is kept."""
    mode = F.col("ref_netex_transportsubmode")
    first = F.when(mode.like("%OR%"), first_token(mode, " ")).otherwise(mode)
    flagged = default_flags(raw_transport_subtypes, "international", "public_use")
    return conform(
        flagged.withColumn("ref_netex_transportsubmode", first), CURATED["curated_vehicles"]
    )


def transport_types(raw_transport_types: DataFrame) -> DataFrame:
    flagged = default_flags(raw_transport_types, "international").drop("ch")
    return conform(flagged, CURATED["curated_transport_types"])


def line_data(raw_line_data: DataFrame, dedupe: bool = False, trim: bool = False) -> DataFrame:
    """Ends and number of stops between, from descriptions like `A - B - C`.

    Other descriptions give the text `None` and 0. `dedupe` keeps one line per id, `trim` takes the
    blank off the last stop; neither is done by default.
    """
    description, separator = F.col("description"), " -"
    several = description.like("%" + separator + " %")
    lines = raw_line_data.withColumnRenamed("swisslinenumber", "swiss_line_number").withColumns(
        {
            "departure_station": F.when(several, first_token(description, separator)).otherwise("None"),
            "final_destination": F.when(several, last_segment(description, separator, trim)).otherwise("None"),
            "midstation_count": F.when(several, occurrences(description, separator) - 1).otherwise(0),
        }
    )
    lines = conform(lines, CURATED["curated_line_data"])
    return first_per_key(lines, "line_id", ["slnid"]) if dedupe else lines


def business_types(raw_operators: DataFrame) -> DataFrame:
    """Types that stand alone; lists of ids and missing ids are left out."""
    columns = ["business_type_id", "business_type_de", "business_type_fr", "business_type_it"]
    single = without_token(raw_operators, "business_type_id", ",")
    return conform(distinct_rows(single, *columns), CURATED["curated_business_types"])


def operators(raw_operators: DataFrame) -> DataFrame:
    """The first of several business types, and the description where a company has no name."""
    columns = ["sboid", "said", "abbreviation", "company_name", "description", "status", "business_type_id"]
    unique = distinct_rows(raw_operators, *columns)
    filled = unique.withColumns(
        {
            "business_type_id": first_token(F.col("business_type_id"), ","),
            "company_name": F.coalesce("company_name", "description"),
        }
    )
    return conform(filled, CURATED["curated_operators"])


def municipality_data(raw_stop_data: DataFrame) -> DataFrame:
    return conform(
        distinct_rows(raw_stop_data, "municipality_id", "municipality"),
        CURATED["curated_municipality_data"],
    )


def stop_data(
    raw_stop_data: DataFrame,
    raw_occupancy_data: DataFrame,
    prefix: str = STOP_PREFIX,
    offset: int = STOP_OFFSET,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Stops with every abbreviation known for them.

    Both sides are made distinct before the join. Its result is then distinct too, which saves
    shuffling the joined rows once more.
    """
    stops = project(
        raw_stop_data,
        [
            "stop_id", "stop_short_num", "stop_control_num", "stop_name", "stop_city",
            "municipality_id", "canton_id", "coord_e", "coord_n", "altitude",
        ],
        {"stop_city": "city"},
    ).withColumns(
        {
            "coord_e": to_float(without_spaces(F.col("coord_e"))),
            "coord_n": to_float(without_spaces(F.col("coord_n"))),
        }
    )
    abbreviations = distinct_rows(
        raw_occupancy_data, F.col("stop_id").alias("occupied_stop_id"), "stop_abbr"
    )
    joined = sized_join(
        stops.distinct(), abbreviations, "stop_id", "occupied_stop_id", "left",
        left_like=raw_stop_data, hot_rows=hot_rows,
    )
    keyed = joined.withColumn("sloid", prefixed_key(prefix, F.col("stop_id"), offset))
    return conform(keyed, CURATED["curated_stop_data"])


def occupancy(
    raw_occupancy_data: DataFrame, current: int = 2022, base: int = 2018, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Traffic of one year and its difference to a base year, for stops counted in both.

    Rows that occur several times in a year are all paired.
    """

    def year(value: int, names: str) -> DataFrame:
        return raw_occupancy_data.where(F.col("year") == value).select(
            F.col("stop_id").alias(names.format("stop_id")),
            *[
                to_decimal(without_spaces(F.col(f"avg_{kind}_traffic")), 38, 0).alias(names.format(kind))
                for kind in TRAFFIC
            ],
        )

    pairs = sized_join(
        year(current, "now_{}"), year(base, "then_{}"), "now_stop_id", "then_stop_id", "inner",
        hot_rows=hot_rows,
    )
    values = {f"avg_{kind}_traffic": F.col(f"now_{kind}") for kind in TRAFFIC}
    changes = {f"{kind}_odds_2018": F.col(f"now_{kind}") - F.col(f"then_{kind}") for kind in TRAFFIC}
    named = pairs.withColumns({"stop_id": F.col("now_stop_id"), **values, **changes})
    return conform(named, CURATED["curated_occupancy"])


def parking(
    raw_parking_data: DataFrame,
    raw_bike_parking_data: DataFrame,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Car parks with the mean capacity of the bike parks at the same stop; others are left out."""
    bikes = rounded_mean(raw_bike_parking_data, "stop_id", "capacity", "capacity_bike")
    cars = conform(raw_parking_data, RAW["raw_parking_data"]).distinct()
    joined = sized_join(
        cars, bikes.withColumnRenamed("stop_id", "bike_stop_id"), "stop_id", "bike_stop_id", how,
        unique_right=True, measure=False, left_like=raw_parking_data, hot_rows=hot_rows,
    )
    return conform(joined, CURATED["curated_parking"])


# Each curated table with its function and the raw tables that go into it.
BUILDERS = {
    "curated_transport": (transport, ["raw_transport"]),
    "curated_accessibility": (accessibility, ["raw_accessibility_1", "raw_accessibility_2", "raw_toilets"]),
    "curated_vehicles": (vehicles, ["raw_transport_subtypes"]),
    "curated_transport_types": (transport_types, ["raw_transport_types"]),
    "curated_line_data": (line_data, ["raw_line_data"]),
    "curated_operators": (operators, ["raw_operators"]),
    "curated_business_types": (business_types, ["raw_operators"]),
    "curated_municipality_data": (municipality_data, ["raw_stop_data"]),
    "curated_stop_data": (stop_data, ["raw_stop_data", "raw_occupancy_data"]),
    "curated_occupancy": (occupancy, ["raw_occupancy_data"]),
    "curated_parking": (parking, ["raw_parking_data", "raw_bike_parking_data"]),
}
