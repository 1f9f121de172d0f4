"""Raw-layer frames derived from the check tables, and landing files written from them.

Each frame has the columns of its raw table and the odd cases that the curated layer handles: NULL
keys, repeated rows, several entries per key, lists of ids, alternatives, open flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.functions.casts import KINDS
from perron.model.datasets import BY_TABLE, Delimited, Document
from perron.model.tables import RAW
from perron.operators.projection import conform
from perron.session import scratch
from perron.sources.delimited import FORMAT
from perron.sources.files import landed

STOP_BASE = 8_500_000
FEATURES_PER_DOCUMENT = 500
# Landing files are packed ones of a bounded number of rows: one is read by one task.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "100000"}


class Shapes:
    """Raw tables by name, each built from one table in `folder`."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def __getitem__(self, raw_table: str) -> DataFrame:
        return conform(getattr(self, raw_table)(), RAW[raw_table])

    def raw_transport(self) -> DataFrame:
        shipped = F.col("l_shipdate")
        arrival = shipped + F.make_dt_interval(mins=F.col("l_quantity").cast("int"))
        departure = arrival + F.make_dt_interval(mins=F.lit(2))

        def later(moment: Column, seconds: int) -> Column:
            return moment + F.make_dt_interval(secs=(F.col("l_linenumber") * seconds).cast("decimal(18,6)"))

        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            shipped.cast("date").alias("date"),
            _text("T", "l_orderkey").alias("trip_id"),
            _text("85:", "l_suppkey").alias("operator_id"),
            F.when(F.col("l_suppkey") % 10 != 0, _text("OP", "l_suppkey")).alias("operator_short_name"),
            _text("Operator ", "l_suppkey").alias("operator_name"),
            F.col("l_linestatus").alias("vehicle_type"),
            _text("L", "l_orderkey").alias("line_id"),
            _text("C", "l_linenumber").alias("circuit_id"),
            _text("V", "l_partkey").alias("vehicle_id"),
            (F.col("l_returnflag") == "A").alias("additional_trip"),
            (F.col("l_returnflag") == "R").alias("was_cancelled"),
            (F.col("l_suppkey") + STOP_BASE).alias("stop_id"),
            F.concat(F.lit('Stop; "'), F.col("l_suppkey").cast("string"), F.lit('"')).alias("stop_name"),
            arrival.alias("arrival_time"),
            F.when(F.col("l_linenumber") != 1, later(arrival, 7)).alias("arrival_prognose"),
            F.when(F.col("l_tax") > 0.04, "REAL").otherwise("UNKNOWN").alias("arrival_prognose_status"),
            departure.alias("departure_time"),
            later(departure, 11).alias("departure_prognose"),
            F.col("l_returnflag").alias("departure_prognose_status"),
            (F.col("l_discount") >= 0.05).alias("transit"),
        )

    def raw_line_data(self) -> DataFrame:
        key = F.col("o_orderkey")
        name = key.cast("string")
        description = (
            F.when(key % 6 == 0, F.concat(F.lit("A"), name, F.lit(" - B"), name))
            .when(key % 6 == 1, F.concat(F.lit("A - B"), name, F.lit(" - C")))
            .when(key % 6 == 2, F.col("o_orderpriority"))
            .when(key % 6 == 3, F.concat(F.lit("A -B"), name))
            .when(key % 6 == 5, F.concat(F.lit("A -B"), name, F.lit(" - C")))
        )
        return self.table("orders").select(
            _text("ch:1:slnid:", "o_orderkey").alias("slnid"),
            F.col("o_custkey").cast("string").alias("swisslinenumber"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("line_type"),
            F.concat(F.lit("P"), (key % 3).cast("string")).alias("payment_type"),
            F.when(key % 17 != 0, _text("L", "o_orderkey")).alias("line_id"),
            F.concat(F.lit("ch:1:sboid:"), (F.col("o_custkey") % 100).cast("string")).alias("sboid"),
            description.alias("description"),
            F.lit("x").alias("comment"),
        )

    def raw_operators(self) -> DataFrame:
        key, nation = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
        kind = F.when(key % 4 == 0, "10,20").when(key % 4 == 1, nation).when(key % 4 == 3, "20")

        def title(prefix: str) -> Column:
            return F.concat(F.lit(prefix), kind)

        rows = self.table("supplier").select(
            _text("ch:1:sboid:", "s_suppkey").alias("sboid"),
            F.concat(F.lit("S"), (key % 100).cast("string")).alias("said"),
            key.alias("organisation_number"),
            F.lit("VALIDATED").alias("status"),
            F.concat(F.lit("DE "), F.col("s_name")).alias("description_de"),
            F.col("s_name").alias("description"),
            _text("OP", "s_suppkey").alias("abbreviation_de"),
            F.when(key % 25 != 4, _text("OP", "s_suppkey")).alias("abbreviation"),
            kind.alias("business_type_id"),
            title("Typ ").alias("business_type_de"),
            title("Tipo ").alias("business_type_it"),
            title("Type ").alias("business_type_fr"),
            _text("CH", "s_suppkey").alias("company_id"),
            F.when(key % 3 != 0, _text("Company ", "s_suppkey")).alias("company_name"),
        )
        return rows.unionByName(rows)

    def raw_stop_data(self) -> DataFrame:
        key, nation = F.col("c_custkey"), F.col("c_nationkey")

        def rows(customers: DataFrame, gap: str) -> DataFrame:
            east = F.concat(F.lit("2" + gap), (key + 600000).cast("string"), F.lit(".5"))
            return customers.select(
                F.when(key % 50 != 7, key + STOP_BASE).alias("stop_id"),
                F.lit(85).alias("land_num"),
                key.alias("stop_short_num"),
                (key % 10).alias("stop_control_num"),
                F.col("c_name").alias("stop_name"),
                F.col("c_mktsegment").alias("vehicle_type"),
                _text("O", "c_nationkey").alias("organisation_id"),
                F.col("c_mktsegment").alias("stop_city"),
                F.when(nation != 3, nation).alias("municipality_id"),
                _text("M", "c_nationkey").alias("municipality"),
                F.concat(F.lit("K"), (nation % 5).cast("string")).alias("canton_id"),
                F.when(key % 40 == 1, "n/a").otherwise(east).alias("coord_e"),
                F.concat(F.lit("1" + gap), (key + 200000).cast("string")).alias("coord_n"),
                (key % 900).cast("string").alias("altitude"),
            )

        customers = self.table("customer")
        return rows(customers, " ").unionByName(rows(customers, ""))

    def raw_accessibility_1(self) -> DataFrame:
        key = F.col("c_custkey")
        flags = [
            "t_autonomy", "t_ramp", "t_advance_registration", "t_no_access", "t_no_info",
            "o_autonomy", "o_ramp", "o_advance_registration", "o_no_access", "o_no_info",
            "t_spare_transport", "o_spare_transport",
        ]
        return self.table("customer").select(
            F.when(key % 30 != 1, _text("ch:1:sloid:", "c_custkey")).alias("sloid"),
            *[(key % (i + 2) == 0).alias(name) for i, name in enumerate(flags)],
            F.concat(F.lit("P"), (key % 4).cast("string")).alias("platform"),
        )

    def raw_accessibility_2(self) -> DataFrame:
        # The keys begin later and end later than those of the access table.
        key, size = F.col("p_partkey"), F.col("p_size")
        return self.table("part").select(
            F.concat(F.lit("ch:1:sloid:"), (key + 50).cast("string")).alias("sloid"),
            F.concat(F.lit("ch:1:sloid:"), (key % 100).cast("string")).alias("parent_sloid"),
            F.concat(size.cast("string"), F.lit(".5")).cast("decimal(5,1)").alias("height"),
            F.concat((size % 10).cast("string"), F.lit(".2")).cast("decimal(3,1)").alias("inclination"),
            F.col("p_type").alias("info_type"),
            F.col("p_brand").alias("tactile_systems"),
            F.col("p_name").alias("access_type"),
            size.cast("decimal(10,1)").alias("wheelchair_area_length"),
            F.when(size % 7 != 0, size + 1).cast("decimal(10,1)").alias("wheelchair_area_width"),
        )

    def raw_toilets(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            _text("W", "s_suppkey").alias("sloid"),
            F.concat(F.lit("ch:1:sloid:"), F.floor(key / 3).cast("string")).alias("parent_sloid"),
            F.concat(F.lit("D"), (key % 2).cast("string")).alias("designation"),
            F.when(F.col("s_nationkey") % 2 == 0, "YES").otherwise("NO").alias("wheelchair_accessibility"),
        )

    def raw_transport_subtypes(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            F.when(key % 40 != 5, _text("V", "p_partkey")).alias("vehicle_id"),
            F.concat(F.lit("DE "), F.col("p_type")).alias("vehicle_type_de"),
            F.col("p_type").alias("vehicle_type"),
            F.concat(F.lit("T"), (key % 50).cast("string")).alias("transport_type_id"),
            F.when(key % 3 != 0, key % 3 == 1).alias("international"),
            F.when(key % 4 != 0, key % 4 == 2).alias("public_use"),
            F.when(key % 5 == 0, F.concat(F.lit("rail OR "), F.col("p_type")))
            .otherwise(F.col("p_name")).alias("ref_netex_transportsubmode"),
            F.col("p_brand").alias("ref_netex_productcategoryref"),
        )

    def raw_transport_types(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            F.when(key % 20 != 6, _text("T", "s_suppkey")).alias("transport_type_id"),
            F.concat(F.lit("DE "), F.col("s_name")).alias("transport_type_de"),
            F.col("s_name").alias("transport_type"),
            (key % 2 == 0).alias("ch"),
            F.when(key % 3 != 0, key % 3 == 1).alias("international"),
            _text("N", "s_nationkey").alias("ref_netex"),
        )

    def raw_occupancy_data(self) -> DataFrame:
        key, stop = F.col("o_orderkey"), F.col("o_custkey")

        def thousands(of: int) -> Column:
            return F.concat((key % of + 1).cast("string"), F.lit(" "), F.lpad((stop % 1000).cast("string"), 3, "0"))

        return self.table("orders").select(
            F.concat(F.lit("A"), (key % 3).cast("string")).alias("stop_abbr"),
            (stop + STOP_BASE).alias("stop_id"),
            _text("Stop ", "o_custkey").alias("stop_name"),
            F.concat(F.lit("K"), (stop % 5).cast("string")).alias("canton_id"),
            F.col("o_orderstatus").alias("station_owner_id"),
            F.year("o_orderdate").alias("year"),
            thousands(90).alias("avg_daily_traffic"),
            thousands(80).alias("avg_wday_traffic"),
            F.when(key % 25 == 0, "<50").otherwise(thousands(70)).alias("avg_holiday_traffic"),
        )

    def raw_parking_data(self) -> DataFrame:
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        priced = key % 4 != 0
        return self.table("customer").select(
            (key + STOP_BASE).alias("stop_id"),
            F.when(priced, key % 5).alias("min_duration"),
            F.when(priced, key % 5 + 24).alias("max_duration"),
            F.when(priced, nation + 3).alias("max_day_price"),
            F.when(priced, nation + 1).alias("price"),
            F.when(priced, nation * 10).alias("monthly_price"),
            F.when(priced, nation * 100).alias("yearly_price"),
            F.lit(2).alias("days_open"),
            nation.alias("capacity_standard"),
            (nation + 1).alias("capacity_disabled"),
            F.when(key % 2 == 0, nation + 2).alias("capacity_reservable"),
            F.lit(None).alias("capacity_charging"),
        )

    def raw_bike_parking_data(self) -> DataFrame:
        return self.table("part").select(
            (F.floor(F.col("p_partkey") / 2) + STOP_BASE).alias("stop_id"),
            F.col("p_size").alias("capacity"),
        )

    def land(self, raw_table: str) -> tuple[Delimited | Document, str]:
        """Write a raw table as the files it comes from; its dataset and the folder."""
        dataset, folder = BY_TABLE[raw_table], scratch(self.spark, raw_table)
        if isinstance(dataset, Document):
            write_documents(_FEATURES[raw_table](self), "key", f"{folder}/{dataset.folder}")
        else:
            bad = _BAD_CELLS.get(raw_table, {})
            write_cells(self[raw_table], dataset, f"{folder}/{dataset.folder}", bad, PACKED)
        return dataset, folder

    def parking_features(self) -> DataFrame:
        """A price of half a unit below the expected one, which reading rounds up. Nation 7 has durations that are no number."""
        key, nation = F.col("c_custkey"), F.col("c_nationkey")

        def total(value: Column) -> Column:
            return F.struct(value.alias("total"))

        pricing = F.struct(
            (key % 5).alias("minimumDuration"),
            F.when(nation == 7, "many").otherwise((key % 5 + 24).cast("string")).alias("maximumDuration"),
            (nation + F.lit(2.5)).alias("maximumDayPrice"),
            F.array(F.struct((nation + F.lit(1.25)).alias("price"))).alias("priceSegments"),
            (nation * 10).alias("monthlyTicketPrice"),
            (nation * 100).alias("yearlyTicketPrice"),
        )
        capacities = F.when(key % 2 == 0, F.array(total(nation), total(nation + 1), total(nation + 2))).otherwise(
            F.array(total(nation), total(nation + 1))
        )
        properties = F.struct(
            (key + STOP_BASE).alias("uic"),
            F.when(key % 4 != 0, pricing).alias("pricingModel"),
            F.struct(F.array(F.lit("MON"), F.lit("TUE")).alias("daysOfWeek")).alias("operationTime"),
            capacities.alias("capacities"),
        )
        return self.table("customer").select(key.alias("key"), F.struct(properties.alias("properties")).alias("feature"))

    def bike_features(self) -> DataFrame:
        """Size 13 is landed as a text that is no number."""
        properties = F.struct(
            (F.floor(F.col("p_partkey") / 2) + STOP_BASE).cast("string").alias("stopPlaceUic"),
            F.when(F.col("p_size") == 13, "13x").otherwise(F.col("p_size").cast("string")).alias("capacity"),
        )
        return self.table("part").select(
            F.col("p_partkey").alias("key"), F.struct(properties.alias("properties")).alias("feature")
        )


_FEATURES = {"raw_parking_data": Shapes.parking_features, "raw_bike_parking_data": Shapes.bike_features}

# Cells that are spoilt on the way to a landing file: the rows concerned must become rejects.
_BAD_CELLS = {
    "raw_transport": {
        "transit": ("minute(arrival_time) = 13", "maybe"),
        "date": ("minute(arrival_time) = 17", "31.02.1999"),
    },
    "raw_operators": {"organisation_number": ("business_type_id = '20'", "n/a")},
    "raw_stop_data": {"land_num": ("vehicle_type = 'MACHINERY'", "CH")},
    "raw_accessibility_2": {"inclination": ("wheelchair_area_length = 50", "100")},
    "raw_occupancy_data": {"year": ("station_owner_id = 'P'", "20222")},
    "raw_transport_types": {"ch": ("ref_netex = 'N7'", "ja")},
}


def _text(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def write_cells(frame: DataFrame, dataset: Delimited, folder: str, bad: dict, options: dict[str, str] | None = None) -> None:
    """Write a frame as `;` separated files with its columns at the positions of the dataset."""
    by_position = {f.ordinal: f for f in dataset.columns}

    def cell(position: int) -> Column:
        if position not in by_position:
            return F.lit("-")
        field = by_position[position]
        pattern = KINDS[field.kind].pattern if field.kind in KINDS else None
        value = F.date_format(field.name, pattern) if pattern else F.col(field.name).cast("string")
        if field.name in bad:
            condition, text = bad[field.name]
            value = F.when(F.expr(condition), text).otherwise(value)
        return value

    last = max(by_position)
    cells = frame.select(*[cell(i).alias(f"c{i}") for i in range(1, last + 1)])
    written = {"sep": FORMAT["sep"], "header": "true", "quote": '"', "escape": '"', **(options or {})}
    cells.write.options(**written).csv(folder, mode="append")


def write_documents(features: DataFrame, key: str, folder: str) -> None:
    """Write features as documents of a bounded number of features, one document per line."""
    document = F.struct(F.collect_list("feature").alias("features"))
    lines = features.groupBy(F.floor(F.col(key) / FEATURES_PER_DOCUMENT)).agg(F.to_json(document).alias("value"))
    lines.select("value").write.text(folder)


def rename_parts(spark: SparkSession, folder: str, names: str) -> None:
    """Moves the files that Spark wrote to a folder to names of our own, `<names>0.csv` and so on, over what lies there."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    for number, path in enumerate(sorted(landed(spark, folder))):
        target = files.Path(f"{names}{number}.csv")
        system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(target.getParent())
        system.delete(target, False)
        system.rename(files.Path(path), target)


def write_one_document(features: DataFrame, key: str, folder: str) -> None:
    """Write features as one document in one file, a line for each, in the order of their keys."""
    first = features.agg(F.min(key).alias("first"))
    lines = features.join(F.broadcast(first)).select(
        F.lit(1).alias("place"), key,
        F.concat(F.when(F.col(key) == F.col("first"), "").otherwise(", "), F.to_json("feature")).alias("value"),
    )
    around = features.sparkSession.createDataFrame(
        [(0, None, '{"type": "FeatureCollection", "links": [{"features": [{}]}], "features": ['), (2, None, ']}')],
        f"place int, {key} bigint, value string",
    )
    lines.unionByName(around).repartition(1).sortWithinPartitions("place", key).select("value").write.text(folder)
