"""Column lists of the raw, curated and consumption tables.

A raw column is one line `<file column> <name> <kind>`; the kinds are explained in
`perron.functions.casts.KINDS`. Curated and consumption tables are plain DDL strings.
Identifiers, counts and whole prices are BIGINT: values are read as DECIMAL(38,0), rounded half up,
and one that does not fit a BIGINT sends its row to the rejects instead of being lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from perron.functions.casts import KINDS, kind_type


@dataclass(frozen=True)
class Field:
    """One column of a delimited file: where it stands, what it is called, how it is read."""

    ordinal: int
    name: str
    kind: str

    @property
    def type(self) -> str:
        return kind_type(self.kind)

    @property
    def pattern(self) -> str | None:
        return KINDS[self.kind].pattern if self.kind in KINDS else None


def fields(text: str) -> list[Field]:
    """Parse the `<file column> <name> <kind>` lines of one table."""
    rows = [line.split() for line in text.strip().splitlines()]
    return [Field(int(ordinal), name, kind) for ordinal, name, kind in rows]


def ddl(columns: list[Field]) -> str:
    return ", ".join(f"{f.name} {f.type}" for f in columns)


# File positions, names and types of the raw tables.
TRANSPORT = fields("""
    1  date                       day
    2  trip_id                    text
    3  operator_id                text
    4  operator_short_name        text
    5  operator_name              text
    6  vehicle_type               text
    8  line_id                    text
    9  circuit_id                 text
    10 vehicle_id                 text
    11 additional_trip            flag
    12 was_cancelled              flag
    13 stop_id                    whole
    14 stop_name                  text
    15 arrival_time               minute
    16 arrival_prognose           second
    17 arrival_prognose_status    text
    18 departure_time             minute
    19 departure_prognose         second
    20 departure_prognose_status  text
    21 transit                    flag
""")
LINE_DATA = fields("""
    1  slnid            text
    4  swisslinenumber  text
    5  status           text
    6  line_type        text
    7  payment_type     text
    8  line_id          text
    9  sboid            text
    18 description      text
    19 comment          text
""")
OPERATORS = fields("""
    1  sboid                text
    2  said                 text
    5  organisation_number  whole
    6  status               text
    7  description_de       text
    10 description          text
    11 abbreviation_de      text
    14 abbreviation         text
    15 business_type_id     text
    16 business_type_de     text
    17 business_type_it     text
    18 business_type_fr     text
    20 company_id           text
    21 company_name         text
""")
STOP_DATA = fields("""
    1  stop_id           whole
    2  land_num          whole
    3  stop_short_num    whole
    4  stop_control_num  whole
    5  stop_name         text
    15 vehicle_type      text
    17 organisation_id   text
    20 stop_city         text
    21 municipality_id   whole
    22 municipality      text
    23 canton_id         text
    24 coord_e           text
    25 coord_n           text
    26 altitude          text
""")
ACCESSIBILITY_1 = fields("""
    15 sloid                   text
    3  t_autonomy              flag
    4  t_ramp                  flag
    5  t_advance_registration  flag
    6  t_no_access             flag
    7  t_no_info               flag
    8  o_autonomy              flag
    9  o_ramp                  flag
    10 o_advance_registration  flag
    11 o_no_access             flag
    12 o_no_info               flag
    13 t_spare_transport       flag
    14 o_spare_transport       flag
    16 platform                text
""")
ACCESSIBILITY_2 = fields("""
    1  sloid                   text
    2  parent_sloid            text
    10 height                  decimal(5,1)
    12 inclination             decimal(3,1)
    14 info_type               text
    18 tactile_systems         text
    19 access_type             text
    20 wheelchair_area_length  decimal(10,1)
    21 wheelchair_area_width   decimal(10,1)
""")
TOILETS = fields("""
    1  sloid                     text
    2  parent_sloid              text
    4  designation               text
    6  wheelchair_accessibility  text
""")
TRANSPORT_SUBTYPES = fields("""
    1  vehicle_id                    text
    2  vehicle_type_de               text
    5  vehicle_type                  text
    6  transport_type_id             text
    8  international                 flag
    9  public_use                    flag
    12 ref_netex_transportsubmode    text
    13 ref_netex_productcategoryref  text
""")
TRANSPORT_TYPES = fields("""
    1  transport_type_id  text
    2  transport_type_de  text
    5  transport_type     text
    6  ch                 flag
    7  international      flag
    10 ref_netex          text
""")
OCCUPANCY_DATA = fields("""
    1 stop_abbr            text
    2 stop_id              whole
    3 stop_name            text
    4 canton_id            text
    5 station_owner_id     text
    6 year                 year
    7 avg_daily_traffic    text
    8 avg_wday_traffic     text
    9 avg_holiday_traffic  text
""")

# Paths below one feature of the parking documents. DAYS_OPEN is the length of its array.
PARKING_PATHS = {
    "stop_id": "$.properties.uic",
    "min_duration": "$.properties.pricingModel.minimumDuration",
    "max_duration": "$.properties.pricingModel.maximumDuration",
    "max_day_price": "$.properties.pricingModel.maximumDayPrice",
    "price": "$.properties.pricingModel.priceSegments[0].price",
    "monthly_price": "$.properties.pricingModel.monthlyTicketPrice",
    "yearly_price": "$.properties.pricingModel.yearlyTicketPrice",
    "days_open": "$.properties.operationTime.daysOfWeek",
    "capacity_standard": "$.properties.capacities[0].total",
    "capacity_disabled": "$.properties.capacities[1].total",
    "capacity_reservable": "$.properties.capacities[2].total",
    "capacity_charging": "$.properties.capacities[3].total",
}
BIKE_PARKING_PATHS = {
    "stop_id": "$.properties.stopPlaceUic",
    "capacity": "$.properties.capacity",
}

RAW = {
    "raw_transport": "id bigint, " + ddl(TRANSPORT),
    "raw_line_data": ddl(LINE_DATA),
    "raw_operators": ddl(OPERATORS),
    "raw_stop_data": ddl(STOP_DATA),
    "raw_accessibility_1": ddl(ACCESSIBILITY_1),
    "raw_accessibility_2": ddl(ACCESSIBILITY_2),
    "raw_toilets": ddl(TOILETS),
    "raw_transport_subtypes": ddl(TRANSPORT_SUBTYPES),
    "raw_transport_types": ddl(TRANSPORT_TYPES),
    "raw_occupancy_data": ddl(OCCUPANCY_DATA),
    "raw_json_parking": "json_data variant",
    "raw_json_bike_parking": "json_data variant",
    "raw_parking_data": ", ".join(f"{name} bigint" for name in PARKING_PATHS),
    "raw_bike_parking_data": ", ".join(f"{name} bigint" for name in BIKE_PARKING_PATHS),
}

# Names and types of the curated tables.
CURATED = {
    "curated_transport": """
        id bigint, date date, trip_id string, operator_abbr string, line_id string, circuit_id string,
        vehicle_id string, additional_trip boolean, was_cancelled boolean, stop_id bigint,
        arrival_time timestamp_ntz, arrival_prognose timestamp_ntz, arrival_prognose_status string,
        departure_time timestamp_ntz, departure_prognose timestamp_ntz,
        departure_prognose_status string, transit boolean""",
    "curated_accessibility": """
        sloid string, t_autonomy boolean, t_ramp boolean, t_advance_registration boolean,
        t_no_access boolean, t_no_info boolean, o_autonomy boolean, o_ramp boolean,
        o_advance_registration boolean, o_no_access boolean, o_no_info boolean,
        t_spare_transport boolean, o_spare_transport boolean, platform string, parent_sloid string,
        height decimal(5,1), inclination decimal(3,1), info_type string, tactile_systems string,
        access_type string, wheelchair_area_length decimal(10,1), wheelchair_area_width decimal(10,1),
        toilet_designation string, toilet_wheelchair_access string""",
    "curated_vehicles": """
        vehicle_id string, vehicle_type_de string, vehicle_type string, transport_type_id string,
        international boolean, public_use boolean, ref_netex_transportsubmode string,
        ref_netex_productcategoryref string""",
    "curated_transport_types": """
        transport_type_id string, transport_type_de string, transport_type string,
        international boolean, ref_netex string""",
    "curated_line_data": """
        slnid string, swiss_line_number string, status string, line_type string, payment_type string,
        line_id string, sboid string, departure_station string, final_destination string,
        midstation_count bigint, description string""",
    "curated_operators": """
        sboid string, said string, abbreviation string, company_name string, description string,
        status string, business_type_id string""",
    "curated_business_types": """
        business_type_id string, business_type_de string, business_type_fr string,
        business_type_it string""",
    "curated_municipality_data": "municipality_id bigint, municipality string",
    "curated_stop_data": """
        stop_id bigint, stop_short_num bigint, stop_control_num bigint, stop_abbr string,
        stop_name string, city string, municipality_id bigint, canton_id string, coord_e double,
        coord_n double, altitude string, sloid string""",
    "curated_occupancy": """
        stop_id bigint, avg_daily_traffic decimal(38,0), avg_wday_traffic decimal(38,0),
        avg_holiday_traffic decimal(38,0), daily_odds_2018 decimal(38,0),
        wday_odds_2018 decimal(38,0), holiday_odds_2018 decimal(38,0)""",
    "curated_parking": """
        stop_id bigint, min_duration bigint, max_duration bigint, max_day_price bigint, price bigint,
        monthly_price bigint, yearly_price bigint, days_open bigint, capacity_standard bigint,
        capacity_disabled bigint, capacity_reservable bigint, capacity_charging bigint,
        capacity_bike bigint""",
}

# A published table has the columns of its curated source; two dimensions gain a usage count.
CONSUMPTION = {
    "transport_fact": CURATED["curated_transport"],
    "accessibility_dim": CURATED["curated_accessibility"],
    "vehicles_dim": CURATED["curated_vehicles"] + ", vehicle_trips_count bigint",
    "transport_types_dim": CURATED["curated_transport_types"],
    "lines_dim": CURATED["curated_line_data"],
    "operators_dim": CURATED["curated_operators"] + ", trips_count bigint",
    "business_types_dim": CURATED["curated_business_types"],
    "municipality_dim": CURATED["curated_municipality_data"],
    "stops_dim": CURATED["curated_stop_data"],
    "occupancy_dim": CURATED["curated_occupancy"],
    "parking_dim": CURATED["curated_parking"],
}

# Declared keys of the published tables.
PRIMARY_KEYS = {
    "transport_fact": "id",
    "accessibility_dim": "sloid",
    "vehicles_dim": "vehicle_id",
    "transport_types_dim": "transport_type_id",
    "lines_dim": "line_id",
    "operators_dim": "abbreviation",
    "business_types_dim": "business_type_id",
    "municipality_dim": "municipality_id",
    "stops_dim": "stop_id",
    "occupancy_dim": "stop_id",
    "parking_dim": "stop_id",
}
UNIQUE_KEYS = {"operators_dim": "sboid", "stops_dim": "sloid"}
FOREIGN_KEYS = [
    ("transport_fact", "vehicle_id", "vehicles_dim", "vehicle_id"),
    ("transport_fact", "operator_abbr", "operators_dim", "abbreviation"),
    ("transport_fact", "line_id", "lines_dim", "line_id"),
    ("transport_fact", "stop_id", "stops_dim", "stop_id"),
    ("vehicles_dim", "transport_type_id", "transport_types_dim", "transport_type_id"),
    ("operators_dim", "business_type_id", "business_types_dim", "business_type_id"),
    ("stops_dim", "sloid", "accessibility_dim", "sloid"),
    ("stops_dim", "municipality_id", "municipality_dim", "municipality_id"),
    ("stops_dim", "stop_id", "occupancy_dim", "stop_id"),
    ("stops_dim", "stop_id", "parking_dim", "stop_id"),
]
