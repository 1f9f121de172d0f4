"""Every operator as a query over the check tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perron.bindings.shapes import Shapes, rename_parts, write_cells, write_documents, write_one_document
from perron.functions import casts, nested, text
from perron.model.datasets import Delimited
from perron.model.tables import CONSUMPTION, CURATED, Field, fields
from perron.operators import aggregates, keys, projection, quality
from perron.operators.joins import sized_join, star_join
from perron.operators.summaries import settled
from perron.plans import consumption, curated
from perron.plans.raw import load_dataset
from perron.plans.refresh import DIMENSIONS, publish_star
from perron.session import scratch
from perron.sinks.warehouse import Tables, Warehouse
from perron.sources.delimited import positional_copy
from perron.sources.documents import flatten_features, read_documents
from perron.sources.rejects import SOURCE, accepted, rejects
from perron.streaming.pickup import pick_up

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Shapes], DataFrame]) -> Callable[[Shapes], DataFrame]:
    """Register a function of the check tables under its name."""
    QUERIES[build.__name__] = lambda spark, folder: build(Shapes(spark, folder))
    return build


def scratch_warehouse(spark: SparkSession, name: str) -> Warehouse:
    root = scratch(spark, name)
    return Warehouse(spark, root, prefix=f"{name}_{root[-32:]}_")


# Joins and counts


@query
def star_join_revenue(t: Shapes) -> DataFrame:
    """Line items with all that surrounds them, by region and brand."""
    return revenue_by(t, "r_name", "p_brand")


def revenue_by(t: Shapes, *groups: str) -> DataFrame:
    regions = t.table("region").select("r_regionkey", "r_name")
    nations = star_join(t.table("nation").select("n_nationkey", "n_regionkey"), [("n_regionkey", regions, "r_regionkey")])
    # What joins give is computed once, and what is known of it since then lays out the joins above.
    nations, of_nations = settled(nations.select("n_nationkey", "r_name"), "nations", "n_nationkey")
    customers = star_join(
        t.table("customer").select("c_custkey", "c_nationkey"), [("c_nationkey", nations, "n_nationkey", of_nations)]
    )
    customers, of_customers = settled(customers.select("c_custkey", "r_name"), "customers", "c_custkey")
    # Orders meet customers first, so that the fact meets only keys of its own.
    orders = star_join(
        t.table("orders").select("o_orderkey", "o_custkey"), [("o_custkey", customers, "c_custkey", of_customers)]
    )
    orders, of_orders = settled(orders.select("o_orderkey", "r_name"), "orders", "o_orderkey")
    price = F.col("l_extendedprice").cast("decimal(12,2)") * (
        F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
    ).cast("decimal(4,2)")
    flat = star_join(
        t.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", price.alias("price")),
        [
            ("l_partkey", t.table("part").select("p_partkey", "p_brand"), "p_partkey"),
            ("l_suppkey", t.table("supplier").select("s_suppkey", "s_nationkey"), "s_suppkey"),
            ("l_orderkey", orders, "o_orderkey", of_orders),
        ],
    )
    return flat.groupBy(*groups).agg(
        F.sum("price").cast("decimal(38,4)").alias("revenue"),
        F.count(F.lit(1)).alias("lines"),
        F.count("s_nationkey").alias("supplied_lines"),
    )


@query
def dim_with_count(t: Shapes) -> DataFrame:
    urgent = t.table("orders").where(F.col("o_orderpriority") == "1-URGENT")
    return aggregates.dim_with_count(
        t.table("customer").select("c_custkey", "c_name"), "c_custkey", urgent, "o_custkey", "urgent_orders"
    )


@query
def full_outer_left_key(t: Shapes) -> DataFrame:
    return _customers_and_suppliers(t)


def _customers_and_suppliers(t: Shapes) -> DataFrame:
    suppliers = t.table("supplier").select((F.col("s_suppkey") * 20).alias("s_key"), "s_name")
    customers = t.table("customer").select("c_custkey", "c_name")
    return sized_join(customers, suppliers, "c_custkey", "s_key", "full").drop("s_key")


@query
def na_drop_key(t: Shapes) -> DataFrame:
    return projection.drop_null_keys(_customers_and_suppliers(t), "c_custkey")


@query
def default_flag(t: Shapes) -> DataFrame:
    """A flag and a name that an absent partner leaves open."""
    suppliers = t.table("supplier").select(
        (F.col("s_suppkey") * 20).alias("s_key"), "s_name", (F.col("s_acctbal") > 5000).alias("rich")
    )
    customers = t.table("customer").select("c_custkey", "c_name")
    joined = sized_join(customers, suppliers, "c_custkey", "s_key", "left")
    return projection.default_flags(joined, "rich").select(
        "c_custkey", "rich", F.coalesce("s_name", "c_name").alias("name")
    )


@query
def year_delta(t: Shapes) -> DataFrame:
    """Orders of a customer in one year and the change to another, for customers with both."""

    def year(value: str, key: str, name: str) -> DataFrame:
        orders = t.table("orders").where(F.year("o_orderdate") == value)
        return aggregates.count_per_key(orders.select(F.col("o_custkey").alias(key)), key, name)

    both = sized_join(
        year("1998", "o_custkey", "orders_1998"), year("1996", "base_key", "orders_1996"),
        "o_custkey", "base_key", "inner", unique_left=True, unique_right=True, measure=False,
    )
    return both.select(
        "o_custkey", "orders_1998", (F.col("orders_1998") - F.col("orders_1996")).alias("change")
    )


@query
def join_rounded_mean(t: Shapes) -> DataFrame:
    """Distinct rows with a rounded mean per key."""
    means = aggregates.rounded_mean(
        t.table("lineitem").select(F.col("l_partkey").alias("mean_key"), "l_quantity"),
        "mean_key", "l_quantity", "mean_quantity",
    )
    parts = aggregates.distinct_rows(t.table("part"), "p_partkey", "p_brand", "p_size")
    return sized_join(
        parts, means, "p_partkey", "mean_key", "inner", unique_right=True, measure=False
    ).drop("mean_key")


# Aggregates, distinct rows, keys


@query
def avg_round(t: Shapes) -> DataFrame:
    units = t.table("orders").select("o_custkey", F.floor("o_totalprice").alias("units"))
    return aggregates.rounded_mean(units, "o_custkey", "units", "mean_price")


@query
def distinct_pairs(t: Shapes) -> DataFrame:
    return aggregates.distinct_rows(t.table("customer"), "c_nationkey", "c_mktsegment")


@query
def dedupe_first(t: Shapes) -> DataFrame:
    """The first order of each customer."""
    orders = t.table("orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return aggregates.first_per_key(orders, "o_custkey", ["o_orderdate", "o_orderkey"])


@query
def surrogate_key(t: Shapes) -> DataFrame:
    orders = t.table("orders").select("o_orderkey", "o_custkey")
    return keys.with_dense_id(orders, "row_id", ["o_orderkey"])


@query
def unique_row_id(t: Shapes) -> DataFrame:
    """The ids of the shuffle-free key: all different, none below the start."""
    with_id = keys.with_row_id(t.table("orders").select("o_orderkey"), "row_id", start=100)
    return with_id.agg(
        F.count("row_id").alias("rows"),
        F.countDistinct("row_id").alias("ids"),
        (F.min("row_id") >= 100).alias("from_start"),
    )


@query
def pk_dupes(t: Shapes) -> DataFrame:
    return quality.pk_violations(t.table("lineitem").select("l_orderkey"), "l_orderkey")


@query
def fk_orphans(t: Shapes) -> DataFrame:
    lines = t.table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    closed = t.table("orders").where(F.col("o_orderstatus") != "P")
    return quality.fk_orphans(lines, "l_orderkey", closed, "o_orderkey")


# Projections, filters, scalar functions


@query
def project_rename(t: Shapes) -> DataFrame:
    return projection.project(t.table("events"), ["event_id", "event_type", "user_id"], {"event_type": "kind"})


@query
def by_name_conform(t: Shapes) -> DataFrame:
    shuffled = t.table("orders").select("o_orderpriority", "o_custkey", "o_orderkey", "o_orderstatus")
    return projection.conform(shuffled, "o_orderkey bigint, o_custkey string, o_orderpriority string")


@query
def not_contains(t: Shapes) -> DataFrame:
    return projection.without_token(t.table("part").select("p_partkey", "p_name"), "p_name", "small")


@query
def first_last_token(t: Shapes) -> DataFrame:
    name = F.col("p_name")
    return t.table("part").select(
        "p_partkey",
        text.first_token(name, " ").alias("first"),
        text.last_segment(name, " ").alias("last"),
        text.occurrences(name, " ").cast("bigint").alias("blanks"),
    )


@query
def document_tokens(t: Shapes) -> DataFrame:
    """The same on long texts, all of them whole."""
    body = F.col("text")
    return t.table("documents").select(
        "doc_id",
        text.first_token(body, ". ").alias("first"),
        F.length(text.last_segment(body, ". ")).cast("bigint").alias("last_length"),
        text.occurrences(body, ". ").cast("bigint").alias("sentences"),
        F.length(text.without_spaces(body)).cast("bigint").alias("letters"),
    )


@query
def round_cast(t: Shapes) -> DataFrame:
    price = F.col("o_totalprice").cast("string")
    return t.table("orders").select(
        "o_orderkey",
        casts.to_decimal(price, 38, 0).alias("price"),
        casts.to_whole(price).alias("units"),
        casts.to_decimal(price, 5, 1).alias("small_price"),
        casts.to_whole(F.col("o_orderpriority")).alias("nothing"),
    )


@query
def space_strip_cast(t: Shapes) -> DataFrame:
    size = F.col("p_size").cast("string")
    spaced = text.without_spaces(F.concat(size, F.lit(" "), size))
    return t.table("part").select(
        "p_partkey",
        casts.to_decimal(spaced, 38, 0).alias("size_twice"),
        casts.to_float(F.concat(spaced, F.lit(".5"))).alias("coordinate"),
        casts.to_float(F.col("p_name")).alias("nothing"),
    )


@query
def key_compose(t: Shapes) -> DataFrame:
    return t.table("supplier").select(
        "s_suppkey", text.prefixed_key("ch:1:sloid:", F.col("s_suppkey"), 50).alias("sloid")
    )


@query
def parse_ts(t: Shapes) -> DataFrame:
    def written(pattern: str) -> Column:
        return F.date_format("ts", pattern)

    return t.table("events").select(
        "event_id",
        casts.to_day(written("dd.MM.yyyy")).alias("day"),
        casts.to_minute(written("dd.MM.yyyy HH:mm")).alias("minute"),
        casts.to_second(written("dd.MM.yyyy HH:mm:ss")).alias("second"),
        casts.to_minute(written("dd.MM.yyyy HH:mm:ss")).alias("wrong_format"),
        casts.to_day(written("31.MM.yyyy")).alias("last_of_month"),
    )


@query
def parse_flag(t: Shapes) -> DataFrame:
    words = {0: "on", 1: "Off", 2: "YES", 3: "n", 4: "1", 5: "false", 6: "T", 7: "maybe"}
    word = F.element_at(F.array(*[F.lit(w) for w in words.values()]), (F.col("event_id") % 8 + 1).cast("int"))
    return t.table("events").select("event_id", casts.to_flag(word).alias("flag"))


# Arrays and documents


@query
def json_path(t: Shapes) -> DataFrame:
    return t.table("events").select(
        "event_id",
        nested.whole_at(F.try_parse_json("props"), "$.k").alias("k"),
        nested.whole_at(F.try_parse_json("props"), "$.missing[0].k").alias("missing"),
    )


@query
def flatten_array(t: Shapes) -> DataFrame:
    return nested.explode_array(t.table("embeddings").select("vec_id", "embedding"), "embedding", "pos", "value")


@query
def array_get(t: Shapes) -> DataFrame:
    return t.table("embeddings").select(
        "vec_id",
        nested.element("embedding", 0).alias("first"),
        nested.element("embedding", 100000).alias("beyond"),
        F.array_size("embedding").cast("bigint").alias("size"),
    )


@query
def json_document(t: Shapes) -> DataFrame:
    """Documents written from parts, read back and flattened."""
    folder = scratch(t.spark, "json-document")
    write_documents(_part_features(t), "key", folder)
    return flatten_features(accepted(read_documents(t.spark, folder, "lines")), _PART_PATHS, sizes=("tags",))


@query
def json_one_document(t: Shapes) -> DataFrame:
    """All parts in one document over many lines, read in splits."""
    folder = scratch(t.spark, "json-one-document")
    write_one_document(_part_features(t), "key", folder)
    return flatten_features(accepted(read_documents(t.spark, folder, split_from=0)), _PART_PATHS, sizes=("tags",))


_PART_PATHS = {
    "id": "$.properties.id",
    "price": "$.properties.price",
    "size": "$.properties.capacities[0].total",
    "other_size": "$.properties.capacities[1].total",
    "tags": "$.properties.tags",
}


def _part_features(t: Shapes) -> DataFrame:
    properties = F.struct(
        F.col("p_partkey").alias("id"),
        F.col("p_retailprice").alias("price"),
        F.array(F.struct(F.col("p_size").alias("total"))).alias("capacities"),
        F.array("p_brand", "p_type").alias("tags"),
    )
    return t.table("part").select(
        F.col("p_partkey").alias("key"), F.struct(properties.alias("properties")).alias("feature")
    )


# Landing files


def _order_columns() -> list[Field]:
    return fields("""
        1 o_orderkey       whole
        3 o_orderdate      minute
        4 o_orderpriority  text
        6 priority_number  whole
    """)


def _orders(t: Shapes) -> DataFrame:
    return t.table("orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority",
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("priority_number"),
    )


def _priorities(t: Shapes) -> DataFrame:
    columns = fields("1 o_orderkey whole\n2 priority whole")
    cells = t.table("orders").select(
        F.col("o_orderkey").cast("string").alias("c1"),
        F.when(F.col("o_orderstatus") == "F", F.substring("o_orderpriority", 1, 1))
        .otherwise(F.col("o_orderpriority")).alias("c2"),
        F.lit("orders").alias(SOURCE),
    )
    return positional_copy(cells, columns)


@query
def reject_rows(t: Shapes) -> DataFrame:
    """Orders whose priority is no number, told by the columns at fault."""
    return rejects(_priorities(t)).select(
        SOURCE, F.array_join("reasons", ",").alias("reasons"), F.array_join("cells", "|").alias("cells")
    )


@query
def accept_rows(t: Shapes) -> DataFrame:
    return accepted(_priorities(t))


@query
def file_pickup(t: Shapes) -> DataFrame:
    """Orders land as files, and a streaming run replaces the table by them."""
    root = scratch(t.spark, "pickup")
    dataset = Delimited("raw_orders", "daily", _order_columns())
    write_cells(_orders(t), dataset, f"{root}/landing/daily", {})
    warehouse = scratch_warehouse(t.spark, "pickup")
    pick_up(warehouse, dataset, f"{root}/landing")
    return warehouse.read("raw", dataset.table)


@query
def file_versions(t: Shapes) -> DataFrame:
    """Three weeks of orders land under the same file names: every new content is picked up, once."""
    root, dataset = scratch(t.spark, "versions"), Delimited("raw_orders", "daily", _order_columns())
    warehouse = scratch_warehouse(t.spark, "versions")
    loads = []
    for week, part in enumerate((F.col("priority_number") <= 2, F.col("priority_number") > 2, F.lit(True)), 1):
        write_cells(_orders(t).where(part), dataset, f"{root}/{week}", {})
        rename_parts(t.spark, f"{root}/{week}", f"{root}/landing/daily/stops-")
        news = [pick_up(warehouse, dataset, f"{root}/landing") for _ in range(2)]
        told = warehouse.read("raw", dataset.table).agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys")).first()
        loads.append((week, *news, told["rows"], told["keys"]))
    return t.spark.createDataFrame(loads, "week int, loaded boolean, loaded_again boolean, rows bigint, keys bigint")


@query
def two_days(t: Shapes) -> DataFrame:
    """Two days of orders land in one folder, each loaded and purged: the second day alone is left."""
    root, dataset = scratch(t.spark, "days"), Delimited("raw_orders", "daily", _order_columns())
    warehouse = scratch_warehouse(t.spark, "days")
    for day in (F.col("priority_number") <= 2, F.col("priority_number") > 2):
        write_cells(_orders(t).where(day), dataset, f"{root}/landing/daily", {})
        load_dataset(warehouse, dataset, f"{root}/landing", purge=True)
    return warehouse.read("raw", dataset.table)


@query
def ids_over_reloads(t: Shapes) -> DataFrame:
    """Three loads of orders under ids, the second without an accepted row: rows, distinct ids, whether they are new."""
    root, dataset = scratch(t.spark, "ids"), Delimited("raw_orders", "daily", _order_columns(), id_column="id")
    warehouse = scratch_warehouse(t.spark, "ids")
    loads, last = [], F.lit(0)
    for number, bad in enumerate(({}, {"o_orderkey": ("true", "none")}, {}), 1):
        write_cells(_orders(t), dataset, f"{root}/{number}/daily", bad)
        load_dataset(warehouse, dataset, f"{root}/{number}")
        told = warehouse.read("raw", dataset.table).agg(
            F.lit(number).cast("bigint").alias("load"), F.count("id").alias("rows"), F.count_distinct("id").alias("ids"),
            (F.min("id") > last).alias("all_new"), F.max("id").alias("last"),
        ).first()
        last = F.lit(told["last"] or 0) if told["rows"] else last
        loads.append(tuple(told)[:4])
    return t.spark.createDataFrame(loads, "load bigint, rows bigint, ids bigint, all_new boolean")


@query
def load_rejects(t: Shapes) -> DataFrame:
    """What the loader of transport rejects, by the columns at fault."""
    dataset, landing = t.land("raw_transport")
    warehouse = scratch_warehouse(t.spark, "rejected")
    load_dataset(warehouse, dataset, landing)
    found = warehouse.rejects("raw", dataset.table)
    return found.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count(F.lit(1)).alias("rows"))


@query
def snapshot_replace(t: Shapes) -> DataFrame:
    """A table is written, replaced by a part of itself, and appended to."""
    warehouse = scratch_warehouse(t.spark, "snapshot")
    schema = "o_orderkey bigint, o_orderpriority string, o_orderstatus string"
    warehouse.replace("curated", "orders", t.table("orders"), schema)
    current = warehouse.read("curated", "orders")
    warehouse.replace("curated", "orders", current.where(F.col("o_orderstatus") != "P"), schema)
    late = t.table("orders").where((F.col("o_orderstatus") == "P") & F.col("o_orderpriority").like("1%"))
    warehouse.append("curated", "orders", late, schema)
    return warehouse.read("curated", "orders")


@query
def sql_scan(t: Shapes) -> DataFrame:
    """A table of the warehouse by name, in SQL."""
    warehouse = scratch_warehouse(t.spark, "sql")
    warehouse.replace("curated", "orders", t.table("orders"), "o_orderkey bigint, o_custkey bigint, o_orderdate date")
    return t.spark.sql(
        f"select o_custkey, max(o_orderdate) as last_order from {warehouse.name('curated', 'orders')} "
        "where year(o_orderdate) = '1998' group by o_custkey"
    )


def _loader(raw_table: str) -> Query:
    """A raw table written to landing files, some cells spoilt, and loaded from them."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        dataset, landing = Shapes(spark, folder).land(raw_table)
        warehouse = scratch_warehouse(spark, "loaded")
        load_dataset(warehouse, dataset, landing)
        # Ids depend on the files and are left out of the comparison.
        return warehouse.read("raw", raw_table).drop("id")

    return run


for _table in (
    "raw_transport", "raw_line_data", "raw_operators", "raw_stop_data", "raw_accessibility_1",
    "raw_accessibility_2", "raw_toilets", "raw_parking_data", "raw_bike_parking_data",
    "raw_transport_subtypes", "raw_transport_types", "raw_occupancy_data",
):
    QUERIES["load_" + _table.removeprefix("raw_")] = _loader(_table)


# Curated and published tables

# The check tables hold orders of 1995 to 2001.
_YEARS = {"current": 1998, "base": 1996}


def curate(t: Shapes, table: str, **options) -> DataFrame:
    build, sources = curated.BUILDERS[table]
    if table == "curated_occupancy":
        options = {**_YEARS, **options}
    return build(*[t[source] for source in sources], **options)


def fact(t: Shapes) -> DataFrame:
    return consumption.transport_fact(curate(t, "curated_transport"))


def published(t: Shapes, *dimensions: str) -> Tables:
    """The fact and some dimensions as tables, which is how they are read in use."""
    warehouse = scratch_warehouse(t.spark, "star")
    publish_star(warehouse, lambda table: curate(t, table), dimensions)
    return warehouse.released("consumption", ["transport_fact", *dimensions])


@query
def star_releases(t: Shapes) -> DataFrame:
    """Two releases of the star and one that fails after the fact: calls and counted calls per operator are of the second."""
    warehouse = scratch_warehouse(t.spark, "releases")
    running = curate(t, "curated_transport").where("not was_cancelled")

    def source(table: str) -> DataFrame:
        return running if table == "curated_transport" else curate(t, table)

    publish_star(warehouse, lambda table: curate(t, table), ["operators_dim"])
    publish_star(warehouse, source, ["operators_dim"])

    def lost(table: str) -> DataFrame:
        if table == "curated_operators":
            raise LookupError(table)
        return source(table).where("transit")

    try:
        publish_star(warehouse, lost, ["operators_dim"])
    except LookupError:
        pass
    star = warehouse.released("consumption", ["transport_fact", "operators_dim"])
    calls = aggregates.count_per_key(star["transport_fact"].select("operator_abbr"), "operator_abbr", "calls")
    counted = star["operators_dim"].select("abbreviation", "trips_count").distinct()
    return sized_join(calls, counted, "operator_abbr", "abbreviation", "inner", unique_left=True).drop("abbreviation")


for _table in CURATED:
    QUERIES[_table] = lambda spark, folder, _table=_table: curate(Shapes(spark, folder), _table)

def _dimension(spark: SparkSession, folder: str, table: str) -> DataFrame:
    t = Shapes(spark, folder)
    return consumption.dimension(table, lambda name: curate(t, name), fact(t))


for _table in DIMENSIONS:
    QUERIES[_table] = lambda spark, folder, _table=_table: _dimension(spark, folder, _table)


@query
def transport_fact(t: Shapes) -> DataFrame:
    """The fact less its id, which depends on the files."""
    return fact(t).drop("id")


@query
def curated_line_data_deduped(t: Shapes) -> DataFrame:
    """One line per key, for twice as many lines as there are keys."""
    lines = t["raw_line_data"].withColumn("line_id", F.expr("concat('L', cast(substring(slnid, 12) as bigint) div 2)"))
    return curated.line_data(lines, dedupe=True, trim=True)


@query
def constraint_violations(t: Shapes) -> DataFrame:
    """All declared keys of the published tables; those of the fact by its tally."""
    star = published(t, *DIMENSIONS)
    return consumption.violations(star, star.tallies)


def _in_two_parts(t: Shapes, *dimensions: str) -> Tables:
    """The star with the calls before 1998, to which the others are added by a second release."""
    warehouse, calls = scratch_warehouse(t.spark, "parts"), curate(t, "curated_transport")
    early = F.coalesce(F.col("date") < "1998-01-01", F.lit(False))
    for part in (early, ~early):
        publish_star(
            warehouse,
            lambda table: calls.where(part) if table == "curated_transport" else curate(t, table),
            dimensions,
            add=True,
        )
    return warehouse.released("consumption", ["transport_fact", *dimensions])


@query
def violations_after_addition(t: Shapes) -> DataFrame:
    """As `constraint_violations`, after an addition to the fact, which is not read: the tallies of both parts are."""
    star = _in_two_parts(t, *DIMENSIONS)
    return consumption.violations(star, star.tallies)


@query
def calls_after_addition(t: Shapes) -> DataFrame:
    """Vehicles and their calls after an addition, counted by the tallies of both parts."""
    return _in_two_parts(t, "vehicles_dim")["vehicles_dim"]


@query
def calls_of_a_month(t: Shapes) -> DataFrame:
    """Stop calls per day and operator in one month of the published fact, which lies in ranges of days."""
    calls = published(t)["transport_fact"].where("date between date'1998-03-01' and date'1998-03-31'")
    return calls.groupBy("date", "operator_abbr").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if("was_cancelled").alias("cancelled")
    )


@query
def calls_by_surroundings(t: Shapes) -> DataFrame:
    """Stop calls counted by what the dimensions around them say."""
    tables = published(
        t, "operators_dim", "business_types_dim", "vehicles_dim", "transport_types_dim", "stops_dim",
        "municipality_dim", "parking_dim",
    )
    flat = consumption.flat_view(
        tables,
        {
            "business_types_dim": ["business_type_de"],
            "transport_types_dim": ["international"],
            "municipality_dim": ["municipality"],
            "parking_dim": ["capacity_bike"],
        },
        tables.known,
    )
    return flat.groupBy(
        F.col("business_types_dim_business_type_de").alias("business_type"),
        F.col("transport_types_dim_international").alias("international"),
        F.col("municipality_dim_municipality").alias("municipality"),
    ).agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if("was_cancelled").alias("cancelled"),
        F.sum("parking_dim_capacity_bike").alias("bike_places"),
    )
