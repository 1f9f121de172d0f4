"""ANSI SQL for each query, written independently of the DataFrame code, for a comparison on whole tables."""

from __future__ import annotations

import re

from perron.model.tables import CONSUMPTION, FOREIGN_KEYS, PRIMARY_KEYS, UNIQUE_KEYS

# The raw-layer frames of `shapes`, in SQL.
RAW = {
    "raw_transport": """
        select l_orderkey * 10 + l_linenumber as id, l_shipdate::date as date, 'T' || l_orderkey as trip_id,
          '85:' || l_suppkey as operator_id,
          case when l_suppkey % 10 <> 0 then 'OP' || l_suppkey end as operator_short_name,
          'Operator ' || l_suppkey as operator_name, l_linestatus as vehicle_type, 'L' || l_orderkey as line_id,
          'C' || l_linenumber as circuit_id, 'V' || l_partkey as vehicle_id, l_returnflag = 'A' as additional_trip,
          l_returnflag = 'R' as was_cancelled, 8500000 + l_suppkey as stop_id,
          'Stop; "' || l_suppkey || '"' as stop_name, arrival as arrival_time,
          case when l_linenumber <> 1 then arrival + to_seconds(l_linenumber * 7) end as arrival_prognose,
          case when l_tax > 0.04 then 'REAL' else 'UNKNOWN' end as arrival_prognose_status,
          arrival + interval 2 minute as departure_time,
          arrival + interval 2 minute + to_seconds(l_linenumber * 11) as departure_prognose,
          l_returnflag as departure_prognose_status, l_discount >= 0.05 as transit
        from (select *, l_shipdate + to_minutes(cast(l_quantity as bigint)) as arrival from lineitem)""",
    "raw_line_data": """
        select 'ch:1:slnid:' || o_orderkey as slnid, o_custkey::varchar as swisslinenumber, o_orderstatus as status,
          o_orderpriority as line_type, 'P' || (o_orderkey % 3) as payment_type,
          case when o_orderkey % 17 <> 0 then 'L' || o_orderkey end as line_id,
          'ch:1:sboid:' || (o_custkey % 100) as sboid,
          case o_orderkey % 6 when 0 then 'A' || o_orderkey || ' - B' || o_orderkey
            when 1 then 'A - B' || o_orderkey || ' - C' when 2 then o_orderpriority
            when 3 then 'A -B' || o_orderkey when 5 then 'A -B' || o_orderkey || ' - C' end as description,
          'x' as comment
        from orders""",
    "raw_operators": """
        select 'ch:1:sboid:' || s_suppkey as sboid, 'S' || (s_suppkey % 100) as said,
          s_suppkey as organisation_number, 'VALIDATED' as status, 'DE ' || s_name as description_de,
          s_name as description, 'OP' || s_suppkey as abbreviation_de,
          case when s_suppkey % 25 <> 4 then 'OP' || s_suppkey end as abbreviation, kind as business_type_id,
          'Typ ' || kind as business_type_de, 'Tipo ' || kind as business_type_it,
          'Type ' || kind as business_type_fr, 'CH' || s_suppkey as company_id,
          case when s_suppkey % 3 <> 0 then 'Company ' || s_suppkey end as company_name
        from (select *, case s_suppkey % 4 when 0 then '10,20' when 1 then s_nationkey::varchar when 3 then '20' end
              as kind from supplier), range(2) twice(copy)""",
    "raw_stop_data": """
        select case when c_custkey % 50 <> 7 then 8500000 + c_custkey end as stop_id, 85::bigint as land_num,
          c_custkey as stop_short_num, c_custkey % 10 as stop_control_num, c_name as stop_name,
          c_mktsegment as vehicle_type, 'O' || c_nationkey as organisation_id, c_mktsegment as stop_city,
          case when c_nationkey <> 3 then c_nationkey::bigint end as municipality_id,
          'M' || c_nationkey as municipality, 'K' || (c_nationkey % 5) as canton_id,
          case when c_custkey % 40 = 1 then 'n/a' else '2' || gap || (600000 + c_custkey) || '.5' end as coord_e,
          '1' || gap || (200000 + c_custkey) as coord_n, (c_custkey % 900)::varchar as altitude
        from (select *, case copy when 0 then ' ' else '' end as gap from customer, range(2) twice(copy))""",
    "raw_accessibility_1": """
        select case when c_custkey % 30 <> 1 then 'ch:1:sloid:' || c_custkey end as sloid,
          c_custkey % 2 = 0 as t_autonomy, c_custkey % 3 = 0 as t_ramp, c_custkey % 4 = 0 as t_advance_registration,
          c_custkey % 5 = 0 as t_no_access, c_custkey % 6 = 0 as t_no_info, c_custkey % 7 = 0 as o_autonomy,
          c_custkey % 8 = 0 as o_ramp, c_custkey % 9 = 0 as o_advance_registration,
          c_custkey % 10 = 0 as o_no_access, c_custkey % 11 = 0 as o_no_info,
          c_custkey % 12 = 0 as t_spare_transport, c_custkey % 13 = 0 as o_spare_transport,
          'P' || (c_custkey % 4) as platform
        from customer""",
    "raw_accessibility_2": """
        select 'ch:1:sloid:' || (p_partkey + 50) as sloid, 'ch:1:sloid:' || (p_partkey % 100) as parent_sloid,
          (p_size + 0.5)::decimal(5,1) as height, (p_size % 10 + 0.2)::decimal(3,1) as inclination,
          p_type as info_type, p_brand as tactile_systems, p_name as access_type,
          p_size::decimal(10,1) as wheelchair_area_length,
          case when p_size % 7 <> 0 then (p_size + 1)::decimal(10,1) end as wheelchair_area_width
        from part""",
    "raw_toilets": """
        select 'W' || s_suppkey as sloid, 'ch:1:sloid:' || (s_suppkey // 3) as parent_sloid,
          'D' || (s_suppkey % 2) as designation,
          case when s_nationkey % 2 = 0 then 'YES' else 'NO' end as wheelchair_accessibility
        from supplier""",
    "raw_transport_subtypes": """
        select case when p_partkey % 40 <> 5 then 'V' || p_partkey end as vehicle_id,
          'DE ' || p_type as vehicle_type_de, p_type as vehicle_type, 'T' || (p_partkey % 50) as transport_type_id,
          case p_partkey % 3 when 1 then true when 2 then false end as international,
          case when p_partkey % 4 <> 0 then p_partkey % 4 = 2 end as public_use,
          case when p_partkey % 5 = 0 then 'rail OR ' || p_type else p_name end as ref_netex_transportsubmode,
          p_brand as ref_netex_productcategoryref
        from part""",
    "raw_transport_types": """
        select case when s_suppkey % 20 <> 6 then 'T' || s_suppkey end as transport_type_id,
          'DE ' || s_name as transport_type_de, s_name as transport_type, s_suppkey % 2 = 0 as ch,
          case s_suppkey % 3 when 1 then true when 2 then false end as international,
          'N' || s_nationkey as ref_netex
        from supplier""",
    "raw_occupancy_data": """
        select 'A' || (o_orderkey % 3) as stop_abbr, 8500000 + o_custkey as stop_id, 'Stop ' || o_custkey as stop_name,
          'K' || (o_custkey % 5) as canton_id, o_orderstatus as station_owner_id, year(o_orderdate)::int as year,
          (o_orderkey % 90 + 1) || ' ' || tail as avg_daily_traffic,
          (o_orderkey % 80 + 1) || ' ' || tail as avg_wday_traffic,
          case when o_orderkey % 25 = 0 then '<50' else (o_orderkey % 70 + 1) || ' ' || tail end as avg_holiday_traffic
        from (select *, lpad((o_custkey % 1000)::varchar, 3, '0') as tail from orders)""",
    "raw_parking_data": """
        select 8500000 + c_custkey as stop_id, case when priced then c_custkey % 5 end as min_duration,
          case when priced then c_custkey % 5 + 24 end as max_duration,
          case when priced then c_nationkey + 3 end::bigint as max_day_price,
          case when priced then c_nationkey + 1 end::bigint as price,
          case when priced then c_nationkey * 10 end::bigint as monthly_price,
          case when priced then c_nationkey * 100 end::bigint as yearly_price, 2::bigint as days_open,
          c_nationkey::bigint as capacity_standard, (c_nationkey + 1)::bigint as capacity_disabled,
          case when c_custkey % 2 = 0 then c_nationkey + 2 end::bigint as capacity_reservable,
          null::bigint as capacity_charging
        from (select *, c_custkey % 4 <> 0 as priced from customer)""",
    "raw_bike_parking_data": "select 8500000 + p_partkey // 2 as stop_id, p_size::bigint as capacity from part",
}

# Which rows the spoilt cells and numbers of the landing files leave.
LOADED = {
    "raw_transport": "minute(arrival_time) not in (13, 17)",
    "raw_operators": "business_type_id is distinct from '20'",
    "raw_stop_data": "vehicle_type <> 'MACHINERY'",
    "raw_accessibility_2": "wheelchair_area_length <> 50",
    "raw_occupancy_data": "station_owner_id <> 'P'",
    "raw_transport_types": "ref_netex <> 'N7'",
    "raw_parking_data": "min_duration is null or capacity_standard <> 7",
    "raw_bike_parking_data": "capacity <> 13",
}

_TRAFFIC = "try_cast(replace({0}.avg_{1}_traffic, ' ', '') as decimal(38,0))"


def _occupancy() -> str:
    columns = []
    for kind in ("daily", "wday", "holiday"):
        now, then = _TRAFFIC.format("a", kind), _TRAFFIC.format("b", kind)
        columns.append(f"{now} as avg_{kind}_traffic, ({now} - {then})::decimal(38,0) as {kind}_odds_2018")
    return (
        f"select a.stop_id, {', '.join(columns)} from raw_occupancy_data a, raw_occupancy_data b "
        "where a.stop_id = b.stop_id and a.year = 1998 and b.year = 1996"
    )


CURATED = {
    "curated_transport": """
        select operator_short_name as operator_abbr,
          * exclude (operator_id, operator_short_name, operator_name, vehicle_type, stop_name)
        from raw_transport""",
    "curated_accessibility": """
        select a.*, b.* exclude (sloid), t.designation as toilet_designation,
          t.wheelchair_accessibility as toilet_wheelchair_access
        from raw_accessibility_1 a full join raw_accessibility_2 b on a.sloid = b.sloid
        left join (select parent_sloid as place, designation, wheelchair_accessibility from raw_toilets group by all) t
          on t.place = a.sloid""",
    "curated_vehicles": """
        select * replace (ifnull(international, false) as international, ifnull(public_use, false) as public_use,
          case when contains(ref_netex_transportsubmode, 'OR') then split_part(ref_netex_transportsubmode, ' ', 1)
            else ref_netex_transportsubmode end as ref_netex_transportsubmode)
        from raw_transport_subtypes""",
    "curated_transport_types": """
        select * exclude (ch) replace (ifnull(international, false) as international) from raw_transport_types""",
    "curated_line_data": """
        select slnid, swisslinenumber as swiss_line_number, status, line_type, payment_type, line_id, sboid,
          case when several then split_part(description, ' -', 1) else 'None' end as departure_station,
          case when several then split_part(description, ' -', -1) else 'None' end as final_destination,
          case when several then len(string_split(description, ' -')) - 2 else 0 end::bigint as midstation_count,
          description
        from (select *, ifnull(contains(description, ' - '), false) as several from raw_line_data)""",
    "curated_operators": """
        select sboid, said, abbreviation, ifnull(company_name, description) as company_name, description, status,
          regexp_extract(business_type_id, '^[^,]*') as business_type_id
        from (select sboid, said, abbreviation, company_name, description, status, business_type_id
              from raw_operators group by all)""",
    "curated_business_types": """
        select business_type_id, business_type_de, business_type_fr, business_type_it from raw_operators
        where strpos(business_type_id, ',') = 0 group by all""",
    "curated_municipality_data": "select municipality_id, municipality from raw_stop_data group by all",
    "curated_stop_data": """
        select distinct s.stop_id, stop_short_num, stop_control_num, o.stop_abbr, s.stop_name, stop_city as city,
          municipality_id, s.canton_id, try_cast(replace(coord_e, ' ', '') as double) as coord_e,
          try_cast(replace(coord_n, ' ', '') as double) as coord_n, altitude,
          'ch:1:sloid:' || (s.stop_id - 8500000) as sloid
        from raw_stop_data s left join raw_occupancy_data o using (stop_id)""",
    "curated_occupancy": _occupancy(),
    "curated_parking": """
        select distinct p.*, b.capacity_bike
        from raw_parking_data p, (select stop_id, round(avg(capacity))::bigint as capacity_bike
                                  from raw_bike_parking_data group by stop_id) b
        where p.stop_id = b.stop_id""",
}

PUBLISHED = {
    "transport_fact": "select * exclude (id) from curated_transport",
    "accessibility_dim": "select * from curated_accessibility where sloid is not null",
    "business_types_dim": "select * from curated_business_types where business_type_id is not null",
    "lines_dim": "select * from curated_line_data where line_id is not null",
    "municipality_dim": "select * from curated_municipality_data where municipality_id is not null",
    "occupancy_dim": "select * from curated_occupancy where stop_id is not null",
    "parking_dim": "select * from curated_parking where stop_id is not null",
    "stops_dim": "select * from curated_stop_data where stop_id is not null",
    "transport_types_dim": "select * from curated_transport_types where transport_type_id is not null",
    "operators_dim": """
        select c.*, n.trips_count from curated_operators c
        left join (select operator_abbr, count(*) as trips_count from transport_fact group by 1) n
          on n.operator_abbr = c.abbreviation""",
    "vehicles_dim": """
        select c.*, n.calls as vehicle_trips_count from curated_vehicles c
        left join (select vehicle_id, count(*) as calls from transport_fact group by 1) n
          on n.vehicle_id = c.vehicle_id
        where c.vehicle_id is not null""",
}

_CTES = {**RAW, **CURATED, **PUBLISHED}


def with_tables(sql: str) -> str:
    """Put the tables that a statement mentions in front of it."""
    needed: dict[str, str] = {}

    def add(text: str) -> None:
        for name in re.findall(r"\w+", text):
            if name in _CTES and name not in needed:
                add(_CTES[name])
                needed[name] = _CTES[name]

    add(sql)
    if not needed:
        return sql
    return "with " + ",\n".join(f"{name} as ({body})" for name, body in needed.items()) + "\n" + sql


def _violations() -> str:
    parts = []
    for kind, declared in (("primary", PRIMARY_KEYS), ("unique", UNIQUE_KEYS)):
        for table, key in declared.items():
            if (table, key) == ("transport_fact", "id"):
                found = "select 1 as n where false"
            else:
                null_clash = f"{key} is null or" if kind == "primary" else f"{key} is not null and"
                found = f"select count(*) as n from {table} group by {key} having {null_clash} count(*) > 1"
            parts.append(_line(kind, f"{table}.{key}", found))
    for table, key, parent, parent_key in FOREIGN_KEYS:
        found = (
            f"select count(*) as n from {table} c where {key} is not null and not exists "
            f"(select 1 from {parent} p where p.{parent_key} = c.{key}) group by {key}"
        )
        parts.append(_line("foreign", f"{table}.{key} -> {parent}.{parent_key}", found))
    return "\nunion all\n".join(parts)


def _line(kind: str, target: str, found: str) -> str:
    return (
        f"select '{kind}' as kind, '{target}' as target, count(*) as bad_keys, "
        f"coalesce(sum(n), 0)::bigint as bad_rows from ({found})"
    )


SQL = {
    "star_join_revenue": """
        select r_name, p_brand,
          sum(l_extendedprice::decimal(12,2) * (1 - l_discount::decimal(4,2))::decimal(4,2))::decimal(38,4) as revenue,
          count(*) as lines, count(s_nationkey) as supplied_lines
        from lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey
        left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey
        left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey
        group by r_name, p_brand""",
    "dim_with_count": """
        select c_custkey, c_name, urgent_orders from customer left join
          (select o_custkey, count(*) as urgent_orders from orders where o_orderpriority = '1-URGENT' group by 1)
          on o_custkey = c_custkey""",
    "full_outer_left_key": "select c_custkey, c_name, s_name from customer full join supplier on c_custkey = s_suppkey * 20",
    "na_drop_key": "select c_custkey, c_name, s_name from customer left join supplier on c_custkey = s_suppkey * 20",
    "default_flag": """
        select c_custkey, coalesce(s_acctbal > 5000, false) as rich, coalesce(s_name, c_name) as name
        from customer left join supplier on c_custkey = s_suppkey * 20""",
    "year_delta": """
        select o_custkey, count(*) filter (year(o_orderdate) = 1998) as orders_1998,
          count(*) filter (year(o_orderdate) = 1998) - count(*) filter (year(o_orderdate) = 1996) as change
        from orders group by o_custkey
        having count(*) filter (year(o_orderdate) = 1998) > 0 and count(*) filter (year(o_orderdate) = 1996) > 0""",
    "join_rounded_mean": """
        select distinct p_partkey, p_brand, p_size, mean_quantity from part join
          (select l_partkey, round(avg(l_quantity))::bigint as mean_quantity from lineitem group by 1)
          on l_partkey = p_partkey""",
    "avg_round": "select o_custkey, round(avg(floor(o_totalprice)))::bigint as mean_price from orders group by o_custkey",
    "distinct_pairs": "select c_nationkey, c_mktsegment from customer group by all",
    "dedupe_first": """
        select o_custkey, o_orderdate, o_orderkey, o_totalprice from orders
        qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1""",
    "surrogate_key": "select row_number() over (order by o_orderkey)::bigint as row_id, o_orderkey, o_custkey from orders",
    "unique_row_id": "select count(*) as rows, count(distinct o_orderkey) as ids, true as from_start from orders",
    "pk_dupes": "select l_orderkey, count(*) as rows from lineitem group by l_orderkey having count(*) > 1",
    "fk_orphans": """
        select l_orderkey, l_partkey, l_linenumber from lineitem
        where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')""",
    "project_rename": "select event_id, event_type as kind, user_id from events",
    "by_name_conform": "select o_orderkey, o_custkey::varchar as o_custkey, o_orderpriority from orders",
    "not_contains": "select p_partkey, p_name from part where p_name not like '%small%'",
    "first_last_token": """
        select p_partkey, split_part(p_name, ' ', 1) as first, split_part(p_name, ' ', -1) as last,
          (len(p_name) - len(replace(p_name, ' ', '')))::bigint as blanks
        from part""",
    "document_tokens": """
        select doc_id, split_part(text, '. ', 1) as first, length(split_part(text, '. ', -1))::bigint as last_length,
          (len(string_split(text, '. ')) - 1)::bigint as sentences,
          length(replace(text, ' ', ''))::bigint as letters
        from documents""",
    "round_cast": """
        select o_orderkey, cast(o_totalprice::varchar as decimal(38,0)) as price,
          cast(o_totalprice::varchar as decimal(38,0))::bigint as units,
          try_cast(o_totalprice::varchar as decimal(5,1)) as small_price, null::bigint as nothing
        from orders""",
    "space_strip_cast": """
        select p_partkey, (p_size::varchar || p_size)::decimal(38,0) as size_twice,
          (p_size::varchar || p_size || '.5')::double as coordinate, null::double as nothing
        from part""",
    "key_compose": "select s_suppkey, 'ch:1:sloid:' || (s_suppkey - 50) as sloid from supplier",
    "parse_ts": """
        select event_id, ts::date as day, date_trunc('minute', ts) as minute, date_trunc('second', ts) as second,
          null::timestamp as wrong_format,
          case when day(last_day(ts)) = 31 then last_day(ts) end as last_of_month
        from events""",
    "parse_flag": """
        select event_id, case when event_id % 8 in (0, 2, 4, 6) then true when event_id % 8 <> 7 then false end as flag
        from events""",
    "json_path": """
        select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, null::bigint as missing from events""",
    "flatten_array": """
        select vec_id, (i - 1)::int as pos, embedding[i] as value
        from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as i from embeddings)""",
    "array_get": """
        select vec_id, embedding[1] as first, embedding[100001] as beyond, len(embedding)::bigint as size from embeddings""",
    "json_document": """
        select p_partkey as id, cast(cast(p_retailprice as varchar) as decimal(38,0))::bigint as price,
          p_size::bigint as size, null::bigint as other_size, 2::bigint as tags
        from part""",
    "json_one_document": """
        select p_partkey as id, cast(cast(p_retailprice as varchar) as decimal(38,0))::bigint as price,
          p_size::bigint as size, null::bigint as other_size, 2::bigint as tags
        from part""",
    "reject_rows": """
        select 'orders' as source_file, 'priority' as reasons, o_orderkey || '|' || o_orderpriority as cells
        from orders where o_orderstatus <> 'F'""",
    "accept_rows": """
        select o_orderkey, left(o_orderpriority, 1)::bigint as priority from orders where o_orderstatus = 'F'""",
    "file_pickup": """
        select o_orderkey, date_trunc('minute', o_orderdate) as o_orderdate, o_orderpriority,
          left(o_orderpriority, 1)::bigint as priority_number
        from orders""",
    "two_days": """
        select o_orderkey, date_trunc('minute', o_orderdate) as o_orderdate, o_orderpriority,
          left(o_orderpriority, 1)::bigint as priority_number
        from orders where left(o_orderpriority, 1)::bigint > 2""",
    "file_versions": """
        select week::int as week, true as loaded, false as loaded_again, count(*) as rows, sum(o_orderkey)::bigint as keys
        from (values (1, 0, 2), (2, 3, 9), (3, 0, 9)) weeks(week, low, high)
        join orders on left(o_orderpriority, 1)::bigint between low and high group by all""",
    "star_releases": """
        select operator_abbr, count(*) as calls, count(*) as trips_count from transport_fact
        where not was_cancelled and operator_abbr in (select abbreviation from curated_operators) group by all""",
    "ids_over_reloads": """
        select n::bigint as load, case when n = 2 then 0 else (select count(*) from orders) end::bigint as rows,
          case when n = 2 then 0 else (select count(*) from orders) end::bigint as ids,
          case when n <> 2 then true end as all_new
        from (values (1), (2), (3)) loads(n)""",
    "load_rejects": """
        select case when minute(arrival_time) = 13 then 'transit' else 'date' end as reasons, count(*) as rows
        from raw_transport where minute(arrival_time) in (13, 17) group by 1""",
    "snapshot_replace": """
        select o_orderkey, o_orderpriority, o_orderstatus from orders
        where o_orderstatus <> 'P' or o_orderpriority = '1-URGENT'""",
    "sql_scan": """
        select o_custkey, max(o_orderdate)::date as last_order from orders where year(o_orderdate) = 1998
        group by o_custkey""",
    "curated_line_data_deduped": """
        select * replace (trim(final_destination) as final_destination)
        from (select * replace ('L' || (substr(slnid, 12)::bigint // 2) as line_id) from curated_line_data)
        qualify row_number() over (partition by line_id order by slnid) = 1""",
    "calls_of_a_month": """
        select date, operator_abbr, count(*) as calls, count(*) filter (was_cancelled) as cancelled from transport_fact
        where date between date '1998-03-01' and date '1998-03-31' group by all""",
    "calls_by_surroundings": """
        select business_type_de as business_type, t.international, m.municipality, count(*) as calls,
          count(*) filter (f.was_cancelled) as cancelled, sum(p.capacity_bike)::bigint as bike_places
        from transport_fact f left join operators_dim o on o.abbreviation = f.operator_abbr
        left join business_types_dim b on b.business_type_id = o.business_type_id
        left join vehicles_dim v on v.vehicle_id = f.vehicle_id
        left join transport_types_dim t on t.transport_type_id = v.transport_type_id
        left join stops_dim s on s.stop_id = f.stop_id
        left join municipality_dim m on m.municipality_id = s.municipality_id
        left join parking_dim p on p.stop_id = s.stop_id
        group by all""",
    "constraint_violations": _violations(),
    "violations_after_addition": _violations(),
    "calls_after_addition": "select * from vehicles_dim",
    **{
        "load_" + table.removeprefix("raw_"):
            f"select * {'exclude (id)' if table == 'raw_transport' else ''} from {table} where {LOADED.get(table, 'true')}"
        for table in RAW
    },
    **{table: f"select * from {table}" for table in (*CURATED, *CONSUMPTION)},
}

ORACLE = {name: with_tables(sql.strip()) for name, sql in SQL.items()}
