"""Reading files, writing snapshots, picking up arrivals."""

import gzip
import json
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

import landing
from conftest import rows
from perron.model.datasets import BY_TABLE, DATASETS, Delimited
from perron.model.tables import RAW, fields
from perron.plans.curated import accessibility, line_data, occupancy, parking, stop_data
from perron.plans.raw import load_dataset
from perron.sinks.warehouse import Conflict, Warehouse
from perron.sources.collections import _pieces, split_documents
from perron.sources.delimited import broken_files, positional_copy, read_delimited
from perron.sources.documents import _feature_documents, check_features, flatten_features, read_documents
from perron.sources.files import create_new, literal
from perron.sources.rejects import accepted, rejects
from perron.streaming.pickup import pick_up, pick_up_all

COLUMNS = fields("1 a whole\n3 b text\n4 c flag")


@contextmanager
def conf(spark, key, value):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    yield
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def copy(spark, folder, multi_line=None, columns=COLUMNS):
    return positional_copy(read_delimited(spark, [str(folder)], columns, multi_line), columns)


def read(spark, folder, content, multi_line=None):
    (folder / "f.csv").write_text(content)
    return copy(spark, folder, multi_line)


def test_positions_and_ragged_rows(spark, tmp_path):
    got = read(spark, tmp_path, "h1;h2;h3;h4\n1;skip;x;on;more;cells\n2;skip\n3;;;\n")
    assert rows(accepted(got)) == [(1, "x", True), (2, None, None), (3, None, None)]
    assert rejects(got).isEmpty()


def test_header_names_do_not_matter(spark, tmp_path):
    assert rows(accepted(read(spark, tmp_path, "c;b;a;x\n1;2;3;1\n"))) == [(1, "3", True)]


def test_empty_quoted_and_null_mark(spark, tmp_path):
    got = read(spark, tmp_path, 'h\n1;;"";\n2;;\\N;\n3;; blank ;\n"";;quoted empty number;\n')
    assert rows(accepted(got)) == [(1, "", None), (2, None, None), (3, " blank ", None)]
    assert rows(rejects(got), "reasons", "cells") == [(["a"], ["", "quoted empty number", None])]


def test_quotes_delimiters_and_line_breaks(spark, tmp_path):
    text = 'h\n1;;"a;b ""c""\nd";1\n2;;plain;0\n'
    got = read(spark, tmp_path, text)
    assert len(broken_files(spark, [str(tmp_path)])) == 1
    assert rows(accepted(got)) == [(1, 'a;b "c"\nd', True), (2, "plain", False)]


def test_whole_lines_are_read_in_splits(spark, tmp_path):
    got = read(spark, tmp_path, 'h\n1;;"a;b ""c""";1\n')
    assert broken_files(spark, [str(tmp_path)]) == []
    assert rows(accepted(got)) == [(1, 'a;b "c"', True)]
    assert rows(accepted(got)) == rows(accepted(read(spark, tmp_path, 'h\n1;;"a;b ""c""";1\n', multi_line=True)))


def test_only_files_with_line_breaks_are_read_unsplit(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("h\n1;;x;\n")
    (tmp_path / "odd name %20ü.csv").write_text('h\n2;;"y\nz";\n')
    (tmp_path / "other name.csv").write_text('h\n3;;"a ""b""";\n')
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as out:
        out.write('h\n4;;"p\nq";\n')
    assert len(broken_files(spark, [str(tmp_path)])) == 2
    assert rows(accepted(copy(spark, tmp_path)), "a", "b") == [(1, "x"), (2, "y\nz"), (3, 'a "b"'), (4, "p\nq")]


@pytest.mark.parametrize("strays", [(2,), (2, 900), (1, 2, 3)])
def test_a_stray_quote_takes_no_other_row(spark, tmp_path, strays):
    lines = [f'{i};;"two;' if i in strays else f"{i};;x{i};" for i in range(1, 1001)]
    got = read(spark, tmp_path, "h;h;h;h\n" + "\n".join(lines) + "\n")
    assert accepted(got).count() == 1000 - len(strays)
    assert rows(rejects(got), "reasons", "cells") == [(["open_quote"], [str(i), "two;", None]) for i in strays]


def test_a_break_between_even_counts_of_quotes(spark, tmp_path):
    got = read(spark, tmp_path, 'h\n1;Foo"Bar;"two\nlines";\n2;Baz"Qux;y;1\n')
    assert rows(accepted(got)) == [(1, "two\nlines", None), (2, "y", True)]


def test_stray_quotes_between_cells_with_line_breaks(spark, tmp_path):
    text = 'h\n1;;"a\n\n""b"" c";on\n2;;"stray;\n3;;"p\nq";off\n4;;plain;\n5;;"last'
    got = read(spark, tmp_path, text)
    assert rows(accepted(got)) == [(1, 'a\n\n"b" c', True), (3, "p\nq", False), (4, "plain", None)]
    assert sorted(r["cells"][0] for r in rejects(got).collect()) == ["2", "5"]


def test_files_with_line_breaks_are_read_in_splits(spark, tmp_path):
    wanted, text = [], 'h;"two\nlines";h;h\n'
    for i in range(400):
        cell = [f"x{i}", f"a{i}\nb", f'p{i}""\n\nq', f"long{i}\n" * 9][i % 4]
        text += f'{i};;"{cell}";1\n' if i % 4 else f"{i};;{cell};1\n"
        wanted.append((i, cell.replace('""', '"'), True))
    with conf(spark, "spark.sql.files.maxPartitionBytes", "700"), conf(spark, "spark.sql.files.openCostInBytes", "1"):
        got = read(spark, tmp_path, text)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        assert sorted(rows(accepted(got))) == wanted and rejects(got).isEmpty()


def test_several_reasons(spark, tmp_path):
    got = read(spark, tmp_path, "h\nx;;t;perhaps\n")
    assert rows(rejects(got), "reasons", "cells") == [(["a", "c"], ["x", "t", "perhaps"])]
    assert rejects(got).first()["source_file"].endswith("f.csv")


def test_gzip_and_several_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\n1;;x;\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as out:
        out.write("h\n2;;y;\n")
    got = copy(spark, tmp_path)
    assert rows(accepted(got), "a") == [(1,), (2,)]


def test_only_text_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\nx\n")
    columns = fields("1 a text")
    got = copy(spark, tmp_path, columns=columns)
    assert rows(accepted(got)) == [("x",)] and rejects(got).isEmpty()


DOCUMENTS = {
    "plain": ('{"features": [{"v": 1}]}', [1]),
    "spread": ('{\n "features": [\n  {"v": 1},\n  {"v": 2}\n ]\n}\n', [1, 2]),
    "array": ('[{"features": [{"v": 1}]}, {"features": [{"v": 2}]}]', [1, 2]),
    "lines": ('{"features": [{"v": 1}]}\n\n{"features": [{"v": 2}]}\n', [1, 2]),
    "nested array": ('[[{"features": [{"v": 1}]}]]', []),
    "array of lines": ('[\n{"features": [{"v": 1}]},\n{"features": [{"v": 2}]}\n]', [1, 2]),
    "empty": ('{"features": []}', []),
    "other": ('{"x": 1}', []),
    "byte order mark": ('\ufeff{"features": [{"v": 1}]}', [1]),
    "nothing": ("", []),
}


@pytest.mark.parametrize("case", DOCUMENTS)
def test_documents(spark, tmp_path, case):
    content, values = DOCUMENTS[case]
    (tmp_path / "d.json").write_text(content)
    documents = read_documents(spark, str(tmp_path))
    got = flatten_features(accepted(documents), {"v": "$.v"})
    assert [r[0] for r in rows(got)] == values and rejects(documents).isEmpty()


def test_gzip_documents(spark, tmp_path):
    with gzip.open(tmp_path / "d.json.gz", "wt") as out:
        out.write('{\n"features": [{"v": 5}]}')
    assert rows(flatten_features(accepted(read_documents(spark, str(tmp_path))), {"v": "$.v"})) == [(5,)]


def test_byte_order_mark_before_the_header(spark, tmp_path):
    assert rows(accepted(read(spark, tmp_path, "\ufeffh\n1;;x;\n"))) == [(1, "x", None)]


def test_windows_line_ends(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(b"h;h;h;h\r\n1;;x;on\r\n2;;y;off\r\n")
    for multi_line in (True, False, None):
        assert rows(accepted(copy(spark, tmp_path, multi_line))) == [(1, "x", True), (2, "y", False)]


def test_broken_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"features": [')
    (tmp_path / "b.json").write_text('{"features": [{"v": 1}]}\nnot json\n')
    documents = read_documents(spark, str(tmp_path))
    assert rows(flatten_features(accepted(documents), {"v": "$.v"})) == [(1,)]
    assert rows(rejects(documents), "reasons", "cells") == [
        (["json_data"], ["not json"]), (["json_data"], ['{"features": ['])]


def test_nothing_after_a_document_is_lost(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n"features": []}\n{\n"features": [{"v": 2}]}')
    documents = read_documents(spark, str(tmp_path))
    assert accepted(documents).isEmpty() and rejects(documents).count() == 1


def test_document_per_line(spark, tmp_path):
    lines = [json.dumps({"features": [{"v": i}]}) for i in range(20)]
    (tmp_path / "a.json").write_text("\n".join([*lines, "oops", '[{"features": [{"v": 99}]}]']))
    documents = read_documents(spark, str(tmp_path), "lines")
    got = flatten_features(accepted(documents), {"v": "$.v"})
    assert sorted(r[0] for r in got.collect()) == [*range(20), 99]
    assert rows(rejects(documents), "cells") == [(["oops"],)]


def test_document_too_large_for_one_variant(spark, tmp_path):
    pad = "x" * (1 << 20)
    features = [json.dumps({"v": i, "pad": pad}) for i in range(143)]
    (tmp_path / "a.json").write_text('{\n"features": [' + ",\n".join(features) + "]}")
    got = flatten_features(accepted(read_documents(spark, str(tmp_path))), {"v": "$.v"})
    assert sorted(r[0] for r in got.collect()) == list(range(143))


def test_documents_by_feature(spark):
    texts = {
        '{"features": [{"v": 1}, {"v": 2}]}': 2, '[{"features": [{"v": 1}]}, {"x": 1}, {"features": [{"v": 2}]}]': 2,
        '\ufeff {"features": []}': 0, '{"features": [': None, '{"features": []} x': None, "no": None,
    }
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = frame.select("t", F.size(_feature_documents(F.col("t"))).alias("n")).collect()
    assert {r["t"]: None if r["n"] in (None, -1) else r["n"] for r in got} == texts


def test_features_with_text_for_numbers(spark, tmp_path):
    content = [{"a": "85x", "b": 1}, {"a": "85", "b": None}, {"b": "many"}, {"a": 1.5, "l": [1]}, {"a": {}, "b": []}]
    (tmp_path / "a.json").write_text(json.dumps({"features": content}))
    paths = {"a": "$.a", "b": "$.b", "n": "$.l"}
    got = check_features(accepted(read_documents(spark, str(tmp_path))), paths, ("n",), "staged")
    assert rows(accepted(got)) == [(2, None, 1), (85, None, None)]
    assert sorted((r["source_file"], r["reasons"], json.loads(r["cells"][0])) for r in rejects(got).collect()) == [
        ("staged", ["a"], content[0]), ("staged", ["a", "b"], content[4]), ("staged", ["b"], content[2])]


def test_registry():
    assert {f: len(d) for f, d in DATASETS.items()} == {"daily": 1, "weekly": 6, "monthly": 4, "yearly": 1}
    assert set(BY_TABLE) <= set(RAW)


# Snapshots


def test_replace_reads_its_own_table(spark, warehouse):
    warehouse.replace("raw", "t", spark.range(10), "id bigint")
    warehouse.replace("raw", "t", warehouse.read("raw", "t").where("id < 4"), "id bigint")
    assert warehouse.read("raw", "t").count() == 4


def test_failed_load_leaves_the_old_snapshot(spark, warehouse):
    warehouse.replace("raw", "t", spark.range(3), "id bigint")
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        warehouse.replace("raw", "t", bad, "id bigint")
    assert warehouse.read("raw", "t").count() == 3
    warehouse.replace("raw", "t", spark.range(7), "id bigint")
    assert warehouse.read("raw", "t").count() == 7


def test_ids_go_on_after_loads_without_rows(spark, warehouse):
    assert warehouse.next_id("raw", "t", "id") == 1
    for count, wanted in ((3, 1), (0, 4), (0, 4), (2, 4), (0, 6)):
        first = warehouse.next_id("raw", "t", "id")
        assert first == wanted
        warehouse.replace("raw", "t", spark.range(first, first + count), "id bigint", first)


def test_both_sides_of_a_checked_read_are_written_unsorted(spark, warehouse):
    frame = spark.range(100).selectExpr("id", "id % 2 = 0 as rejected").where("id > 3")
    frame.write.partitionBy("rejected").saveAsTable(warehouse.name("raw", "sorted_or_not"))
    spark.sql(f"create table {warehouse.name('raw', 'other')} (id bigint, rejected boolean) using parquet partitioned by (rejected)")
    frame.createOrReplaceTempView("both_sides")
    plan = spark.sql(f"explain insert into {warehouse.name('raw', 'other')} select * from both_sides").first()[0]
    assert "Sort" not in plan and warehouse.read("raw", "sorted_or_not").count() == 96


def test_append(spark, warehouse):
    warehouse.append("raw", "t", spark.range(3), "id bigint")
    spark.range(9).write.saveAsTable(warehouse.name("raw", f"t__{10**19}"))  # written, never published
    warehouse.append("raw", "t", spark.range(2), "id bigint")
    assert warehouse.read("raw", "t").count() == 5


def test_append_shows_all_or_nothing(spark, warehouse):
    warehouse.replace("raw", "t", spark.range(3), "id bigint", 7)
    for wrong in range(2):
        with pytest.raises(Exception):
            warehouse.append("raw", "t", spark.range(9).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), "id bigint")
    assert warehouse.read("raw", "t").count() == 3
    warehouse.append("raw", "t", spark.range(1), "id bigint")
    assert warehouse.read("raw", "t").count() == 4 and warehouse.next_id("raw", "t", "id") == 7
    warehouse.replace("raw", "t", spark.range(2), "id bigint")
    assert warehouse.read("raw", "t").count() == 2


def test_many_additions_become_one_snapshot(spark, warehouse, monkeypatch):
    monkeypatch.setattr("perron.sinks.warehouse.PARTS", 3)
    for i in range(8):
        warehouse.append("raw", "t", spark.range(i, i + 1), "id bigint")
        assert [r[0] for r in rows(warehouse.read("raw", "t"))] == list(range(i + 1))
    assert len(warehouse._named("raw", "t")) < 4


def test_table_and_rejects_are_switched_at_once(spark, warehouse, tmp_path):
    schema = "a bigint, b string, c boolean"
    for day in ("one", "two"):
        (tmp_path / day).mkdir()
    warehouse.replace_checked("raw", "t", read(spark, tmp_path / "one", "h\n1;;x;\nbad;;y;\n"), schema)
    looked_at = [warehouse._text("raw", name) for name in ("t", "t_rejects")]
    warehouse.replace_checked("raw", "t", read(spark, tmp_path / "two", "h\n2;;x;\n3;;y;\n"), schema, 5)
    assert looked_at == [warehouse._text("raw", name) for name in ("t", "t_rejects")]
    assert rows(warehouse.read("raw", "t"), "a") == [(2,), (3,)] and warehouse.rejects("raw", "t").isEmpty()
    assert warehouse.next_id("raw", "t", "a") == 5
    warehouse.replace("raw", "t", spark.createDataFrame([(9, "z", None)], schema), schema)
    assert rows(warehouse.read("raw", "t"), "a") == [(9,)] and not warehouse.exists("raw", "t_rejects")


def test_append_to_a_checked_table(spark, warehouse, tmp_path):
    checked = read(spark, tmp_path, "h\n1;;x;\nbad;;y;\n")
    schema = "a bigint, b string, c boolean"
    warehouse.replace_checked("raw", "t", checked, schema)
    more = spark.createDataFrame([("z", 5)], "b string, a bigint").withColumn("c", F.lit(True))
    warehouse.append("raw", "t", more, schema)
    assert rows(warehouse.read("raw", "t")) == [(1, "x", None), (5, "z", True)]
    assert warehouse.rejects("raw", "t").count() == 1


def test_columns_are_matched_by_name(spark, warehouse):
    frame = spark.createDataFrame([("name", "abbr")], "stop_name string, stop_abbr string")
    warehouse.replace("raw", "t", frame, "stop_abbr string, stop_name string")
    assert warehouse.read("raw", "t").first().asDict() == {"stop_abbr": "abbr", "stop_name": "name"}


# Arrivals


def test_pickup_equals_batch(spark, warehouse, tmp_path):
    files = landing.write(tmp_path / "landing", ["daily"])
    dataset = BY_TABLE["raw_transport"]
    load_dataset(warehouse, dataset, files)
    batch, bad = rows(warehouse.read("raw", dataset.table).drop("id")), warehouse.rejects("raw", dataset.table).count()
    assert pick_up(warehouse, dataset, files)
    assert rows(warehouse.read("raw", dataset.table).drop("id")) == batch
    assert warehouse.rejects("raw", dataset.table).count() == bad


def test_pickup_loads_each_file_once(spark, warehouse, tmp_path):
    dataset = Delimited("raw_small", "in", COLUMNS)
    folder, done = tmp_path / "in", tmp_path / "done"
    folder.mkdir()

    def run():
        return pick_up(warehouse, dataset, str(tmp_path), str(done))

    (folder / "1.csv").write_text("h\n1;;x;\n2;;x;\n")
    assert run() and not run()
    assert rows(warehouse.read("raw", "raw_small"), "a") == [(1,), (2,)]
    (folder / "2.csv").write_text("h\n3;;x;\n")
    assert run()
    assert rows(warehouse.read("raw", "raw_small"), "a") == [(3,)]
    (folder / "3.csv").write_text("h\n4;;x;\n")
    assert run()
    assert rows(warehouse.read("raw", "raw_small"), "a") == [(4,)]
    assert {path.name.split("-")[1] for path in done.rglob("*.csv")} == {"1.csv", "2.csv", "3.csv"} and not list(folder.glob("*.csv"))


def test_pickup_of_a_frequency(spark, warehouse, tmp_path):
    files = landing.write(tmp_path / "landing")
    assert pick_up_all(warehouse, files, "monthly") == [d.table for d in DATASETS["monthly"]]
    assert pick_up_all(warehouse, files, "monthly") == []
    assert warehouse.read("raw", "raw_bike_parking_data").count() == 5
    assert warehouse.read("raw", "raw_parking_data").count() == 3


# Options of the curated tables


def test_line_options(spark):
    lines = spark.createDataFrame(
        [("s2", "L1", "A - B"), ("s1", "L1", "C - D - E"), ("s3", None, "F")], "slnid string, line_id string, description string")
    for name in ("swisslinenumber", "status", "line_type", "payment_type", "sboid"):
        lines = lines.withColumn(name, F.lit("x"))
    assert line_data(lines).count() == 3
    assert rows(line_data(lines, dedupe=True, trim=True), "slnid", "final_destination") == [("s1", "E"), ("s3", "None")]


def test_hot_keys_do_not_change_curated_tables(spark, warehouse, tmp_path):
    files = landing.write(tmp_path / "landing")
    names = ("raw_accessibility_1", "raw_accessibility_2", "raw_toilets", "raw_stop_data", "raw_occupancy_data",
             "raw_parking_data", "raw_bike_parking_data")
    for name in names:
        load_dataset(warehouse, BY_TABLE[name], files)
    raw = {name: warehouse.read("raw", name) for name in names}
    plans = {
        accessibility: names[:3], stop_data: names[3:5], occupancy: names[4:5], parking: names[5:],
    }
    usual = {build: rows(build(*[raw[n] for n in used])) for build, used in plans.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for build, used in plans.items():
            assert rows(build(*[raw[n] for n in used], hot_rows=0.5)) == usual[build]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parking_keeps_all_on_request(spark):
    cars = spark.createDataFrame([(1,), (2,)], "stop_id bigint")
    for name in [c.split()[0] for c in RAW["raw_parking_data"].split(", ")][1:]:
        cars = cars.withColumn(name, F.lit(None).cast("bigint"))
    bikes = spark.createDataFrame([(1, 4), (1, 5)], "stop_id bigint, capacity bigint")
    assert rows(parking(cars, bikes), "stop_id", "capacity_bike") == [(1, 5)]
    assert rows(parking(cars, bikes, how="left"), "stop_id", "capacity_bike") == [(1, 5), (2, None)]


def test_names_are_taken_as_they_stand(spark, warehouse, tmp_path):
    dataset = Delimited("raw_x", "in", fields("1 a text\n2 b int"))
    folder = tmp_path / "landing" / "in"
    folder.mkdir(parents=True)
    (folder / "b[2].csv").write_text("a;b\nx;1\n")
    (folder / "b2.csv").write_text("a;b\ny;2\n")
    assert pick_up(warehouse, dataset, str(tmp_path / "landing"))
    assert rows(warehouse.read("raw", "raw_x")) == [("x", 1), ("y", 2)]
    (folder / "c*.csv").write_text('a;b\n"z\nz";3\n')
    assert pick_up(warehouse, dataset, str(tmp_path / "landing"))
    assert rows(warehouse.read("raw", "raw_x")) == [("z\nz", 3)]


def test_a_lost_publish_does_not_cost_the_snapshot_in_use(spark, warehouse):
    def load(n):
        warehouse.replace("raw", "t", spark.range(n).toDF("a"), "a bigint")

    load(1)
    (first,) = warehouse._named("raw", "t")
    orphan = warehouse._write("raw", "t", spark.range(2).toDF("a"))
    load(3)
    assert warehouse.read("raw", "t").count() == 3
    assert first in warehouse._snapshots("raw", "t") and orphan not in warehouse._snapshots("raw", "t")


def test_loaded_files_are_purged(spark, warehouse, tmp_path):
    dataset = Delimited("raw_days", "daily", fields("1 a whole\n2 b text"))
    folder = tmp_path / "daily"
    folder.mkdir()
    (folder / "day[1].csv").write_text("h;h\n1;x\n")
    load_dataset(warehouse, dataset, str(tmp_path), purge=True)
    assert rows(warehouse.read("raw", "raw_days")) == [(1, "x")] and not list(folder.glob("*.csv"))
    load_dataset(warehouse, dataset, str(tmp_path), purge=True)
    assert rows(warehouse.read("raw", "raw_days")) == [(1, "x")]
    (folder / "day2.csv").write_text("h;h\n2;y\n")
    load_dataset(warehouse, dataset, str(tmp_path), purge=True)
    assert rows(warehouse.read("raw", "raw_days")) == [(2, "y")] and not list(folder.glob("*.csv"))


def test_a_failed_load_purges_nothing(spark, warehouse, tmp_path, monkeypatch):
    dataset = Delimited("raw_days", "daily", fields("1 a whole\n2 b text"))
    (tmp_path / "daily").mkdir()
    (tmp_path / "daily" / "a.csv").write_text("h;h\n1;x\n")
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_view", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_dataset(warehouse, dataset, str(tmp_path), purge=True)
    assert (tmp_path / "daily" / "a.csv").exists()
    assert pick_up(warehouse, dataset, str(tmp_path), purge=True)
    assert rows(warehouse.read("raw", "raw_days")) == [(1, "x")] and not (tmp_path / "daily" / "a.csv").exists()
    assert not pick_up(warehouse, dataset, str(tmp_path), purge=True)


def small(warehouse):
    return rows(warehouse.read("raw", "raw_small"), "a")


def test_new_content_under_an_old_name(spark, warehouse, tmp_path):
    dataset, folder = Delimited("raw_small", "in", COLUMNS), tmp_path / "in"
    folder.mkdir()
    for week in (1, 2, 3):
        (folder / "stops.csv").write_text(f"h\n{week};;x;\n" + f"{week};;y;\n" * week)
        assert pick_up(warehouse, dataset, str(tmp_path)) and not pick_up(warehouse, dataset, str(tmp_path))
        assert small(warehouse) == [(week,)] * (week + 1)
    # Only the file as it lies there now is remembered.
    assert warehouse.files("raw", "raw_small").count() == 1
    (folder / "stops.csv").unlink()
    assert not pick_up(warehouse, dataset, str(tmp_path), purge=True) and small(warehouse) == [(3,)] * 4


def test_a_kill_between_publish_and_purge(spark, warehouse, tmp_path, monkeypatch):
    dataset, folder = Delimited("raw_small", "in", COLUMNS), tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("h\n1;;x;\n")
    with monkeypatch.context() as patch:
        patch.setattr("perron.streaming.pickup.clear", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pick_up(warehouse, dataset, str(tmp_path), purge=True)
    snapshots = warehouse.version("raw", "raw_small")
    assert (folder / "a.csv").exists() and small(warehouse) == [(1,)]
    assert not pick_up(warehouse, dataset, str(tmp_path), purge=True)
    assert warehouse.version("raw", "raw_small") == snapshots and not (folder / "a.csv").exists()


def test_a_kill_before_the_publish_takes_nothing(spark, warehouse, tmp_path, monkeypatch):
    dataset, folder = Delimited("raw_small", "in", COLUMNS), tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("h\n1;;x;\n")
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_view", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pick_up(warehouse, dataset, str(tmp_path), purge=True)
    assert (folder / "a.csv").exists() and warehouse.files("raw", "raw_small").count() == 0
    assert pick_up(warehouse, dataset, str(tmp_path), purge=True) and small(warehouse) == [(1,)]


def test_a_file_that_changes_while_it_is_loaded_stays(spark, warehouse, tmp_path, monkeypatch):
    from perron.streaming import pickup

    dataset, folder = Delimited("raw_small", "in", COLUMNS), tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("h\n1;;x;\n")
    load = pickup.load_files

    def slow(*args, **options):
        load(*args, **options)
        (folder / "a.csv").write_text("h\n2;;x;\n3;;x;\n")

    with monkeypatch.context() as patch:
        patch.setattr(pickup, "load_files", slow)
        assert pick_up(warehouse, dataset, str(tmp_path), purge=True)
    assert (folder / "a.csv").exists() and small(warehouse) == [(1,)]
    assert pick_up(warehouse, dataset, str(tmp_path), purge=True) and small(warehouse) == [(2,), (3,)]


def test_batch_loads_and_additions_keep_what_was_taken(spark, warehouse, tmp_path):
    dataset, folder = Delimited("raw_small", "in", COLUMNS), tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("h\n1;;x;\n")
    assert pick_up(warehouse, dataset, str(tmp_path))
    load_dataset(warehouse, dataset, str(tmp_path))
    warehouse.append("raw", "raw_small", warehouse.read("raw", "raw_small"), dataset.schema)
    assert small(warehouse) == [(1,), (1,)] and not pick_up(warehouse, dataset, str(tmp_path))


def test_a_folder_that_is_not_there(spark, warehouse, tmp_path):
    assert not pick_up(warehouse, Delimited("raw_small", "none", COLUMNS), str(tmp_path), purge=True)


def test_purge_of_a_frequency(spark, warehouse, tmp_path):
    files = landing.write(tmp_path / "landing")
    assert len(pick_up_all(warehouse, files, "monthly", purge=True)) == 4
    assert not [p for p in (tmp_path / "landing" / "monthly").rglob("*.*") if p.suffix in (".csv", ".json")]


# Loads of one table at the same time


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a bigint")


@pytest.mark.parametrize("second", ["replace", "append"])
def test_one_of_two_interleaved_loads_wins(spark, warehouse, second):
    """The first has written its snapshot, the second publishes, then the first wants to publish."""
    warehouse.replace("raw", "t", numbers(spark, 0), "a bigint")
    with pytest.raises(Conflict):
        with warehouse._load("raw", "t", None) as (snapshot, publish):
            warehouse._write("raw", "t", numbers(spark, 1), snapshot=snapshot)
            getattr(warehouse, second)("raw", "t", numbers(spark, 2), "a bigint")
            # The winner has dropped nothing of the load in flight.
            assert rows(warehouse.read("raw", snapshot)) == [(1,)]
            publish(lambda: None)
    assert rows(warehouse.read("raw", "t")) == ([(2,)] if second == "replace" else [(0,), (2,)])
    # The loser has left nothing, and may try again.
    assert not warehouse.exists("raw", snapshot)
    warehouse.replace("raw", "t", numbers(spark, 3), "a bigint")
    assert rows(warehouse.read("raw", "t")) == [(3,)]


def test_a_load_that_began_before_another_is_told(spark, warehouse):
    warehouse.replace("raw", "t", numbers(spark, 0), "a bigint")
    since = warehouse.version("raw", "t")
    warehouse.append("raw", "t", numbers(spark, 1), "a bigint")
    with pytest.raises(Conflict):
        warehouse.append("raw", "t", numbers(spark, 2), "a bigint", since=since)
    assert rows(warehouse.read("raw", "t")) == [(0,), (1,)]


def test_loads_at_once_lose_no_row(spark, warehouse):
    """Additions from several threads, each tried again until it is published."""
    warehouse.replace("raw", "t", numbers(spark, 0), "a bigint")

    def add(value):
        while True:
            try:
                return warehouse.append("raw", "t", numbers(spark, value), "a bigint")
            except Conflict:
                pass

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(1, 7)))
    assert rows(warehouse.read("raw", "t")) == [(n,) for n in range(7)]


def test_claims_of_killed_loads_run_out(spark, warehouse, monkeypatch):
    snapshot = warehouse._claim("raw", "t")
    warehouse._write("raw", "t", numbers(spark, 1), snapshot=snapshot)
    warehouse.replace("raw", "t", numbers(spark, 2), "a bigint")
    assert warehouse.exists("raw", snapshot)
    monkeypatch.setattr("perron.sinks.warehouse.CLAIMED", 0)
    warehouse.replace("raw", "t", numbers(spark, 3), "a bigint")
    assert not warehouse.exists("raw", snapshot)


def test_the_lock_of_a_killed_load_is_broken(spark, warehouse, monkeypatch):
    monkeypatch.setattr("perron.sinks.warehouse.LOCKED", -1)
    create_new(spark, warehouse._claims("raw") + "_locks/t.lock")
    warehouse.replace("raw", "t", numbers(spark, 2), "a bigint")
    assert rows(warehouse.read("raw", "t")) == [(2,)]


# Releases


def star(warehouse):
    """Each table's number, by single reads, by SQL and as a release: they must be the same."""
    tables = ["fact", "dim_a", "dim_b"]
    single = [warehouse.read("consumption", t).first()["a"] for t in tables]
    both = warehouse.spark.sql("select " + ", ".join(f"(select max(a) from {warehouse.name('consumption', t)})" for t in tables))
    assert single == list(both.first()) == [f.first()["a"] for f in warehouse.released("consumption", tables).values()]
    return single


def publish(warehouse, number, tables=("fact", "dim_a", "dim_b"), fail=None):
    with warehouse.release("consumption", list(tables)) as release:
        for place, table in enumerate(tables):
            if place == fail:
                raise ZeroDivisionError
            release.write(table, numbers(warehouse.spark, number), "a bigint")
        if fail == len(tables):
            raise ZeroDivisionError


def test_a_release_is_seen_at_once(spark, warehouse, monkeypatch):
    publish(warehouse, 1)
    assert star(warehouse) == [1, 1, 1]
    publish(warehouse, 2)
    assert star(warehouse) == [2, 2, 2]
    for fail in range(4):
        with pytest.raises(ZeroDivisionError):
            publish(warehouse, 3, fail=fail)
        assert star(warehouse) == [2, 2, 2]
    # A failure at any of the switches: each view names what it shows in the next release, then one row is switched.
    view = Warehouse._view
    for good in range(4):
        calls = iter([True] * good)
        with monkeypatch.context() as patch:
            patch.setattr(Warehouse, "_view", lambda *a: view(*a) if next(calls, False) else 1 / 0)
            with pytest.raises(ZeroDivisionError):
                publish(warehouse, 4)
        assert star(warehouse) == [2, 2, 2]
    publish(warehouse, 5)
    assert star(warehouse) == [5, 5, 5]
    names = [r["tableName"] for r in spark.sql(f"show tables in {warehouse.database('consumption')}").collect()]
    assert sum("__" in n for n in names) == 6


def test_a_release_of_some_tables(spark, warehouse):
    warehouse.replace("consumption", "dim_b", numbers(spark, 7), "a bigint")
    publish(warehouse, 1, ("fact", "dim_a"))
    assert star(warehouse) == [1, 1, 7]
    publish(warehouse, 2)
    assert star(warehouse) == [2, 2, 2]
    publish(warehouse, 3, ("fact",))
    publish(warehouse, 4, ("fact", "dim_a"))
    assert star(warehouse) == [4, 4, 2]
    warehouse.replace("consumption", "dim_b", numbers(spark, 8), "a bigint")
    assert star(warehouse) == [4, 4, 8]
    publish(warehouse, 5)
    assert star(warehouse) == [5, 5, 5]


def test_one_release_reads_one_snapshot(spark, warehouse):
    publish(warehouse, 1)
    publish(warehouse, 2)
    plan = warehouse.read("consumption", "fact")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Filter" not in plan.replace("Filters", "")


def test_one_of_two_releases_wins(spark, warehouse):
    publish(warehouse, 1)
    with pytest.raises(Conflict):
        with warehouse.release("consumption", ["fact"]) as release:
            release.write("fact", numbers(spark, 3), "a bigint")
            publish(warehouse, 2)
    assert star(warehouse) == [2, 2, 2]
    before = warehouse.released("consumption", ["fact", "dim_a"])
    publish(warehouse, 4)
    assert [f.first()["a"] for f in before.values()] == [2, 2] and star(warehouse) == [4, 4, 4]


# One document read by many tasks

PROPERTIES = ['a}b', "x{", '"q"', "back\\", "[[", '\\"}', "é}", '],"features":[', ""]
FEATURES = [
    {"type": "Feature", "properties": {"uic": i, "name": PROPERTIES[i % 9], "features": [1, {"features": [2]}], "in": [{"b": [{"c": i}]}]}}
    for i in range(150)
]
COLLECTION = {"type": "FeatureCollection", "crs": {"n": {"features": []}}, "links": [{"a": 1}, {"b": "]"}], "features": FEATURES,
              "after": {"x": [{"y": 1}], "features": [3]}, "more": [{"z": "}"}]}
PATHS = {"uic": "$.properties.uic", "c": "$.properties.in[0].b[0].c"}
FLAT = json.dumps(COLLECTION)
READ_SPLIT = {
    "pretty": json.dumps(COLLECTION, indent=2), "flat": FLAT, "list": json.dumps([COLLECTION], indent=1) + "\n",
    "mark": "﻿" + json.dumps(COLLECTION, ensure_ascii=False), "blanks": FLAT + " \r\n\t", "dense": FLAT.replace(" ", ""),
    "one": json.dumps({"features": FEATURES[:1]}), "empty_objects": json.dumps({"features": [{}, {}]}),
}
READ_WHOLE = {
    "cut": FLAT[:-1], "two": json.dumps([COLLECTION, COLLECTION]), "no_comma": FLAT.replace('}, {"type"', '} {"type"', 1),
    "comma": FLAT.replace('"features": [{"type"', '"features": [, {"type"', 1), "lines": FLAT + "\n" + FLAT, "none": '{"features": []}',
    "other": '{"a": 1}', "numbers": '{"features": [1, 2]}', "trailing": FLAT + " x", "twice": FLAT[:-1] + ', "features": [{"a": 1}]}',
    "mixed": '{"features": [{"a": 1}, 2]}', "quote": FLAT.replace("FeatureC", 'Feature"C'), "nothing": "", "word": "no json",
}


@contextmanager
def short_splits(spark, size):
    with conf(spark, "spark.sql.files.maxPartitionBytes", str(size)), conf(spark, "spark.sql.files.openCostInBytes", "1"):
        yield


def test_one_document_in_splits(spark, tmp_path):
    for name, text in {**READ_SPLIT, **READ_WHOLE}.items():
        (tmp_path / f"{name}[1].json").write_text(text, encoding="utf-8")

    def told(**options):
        read = read_documents(spark, str(tmp_path), **options)
        return rows(flatten_features(accepted(read), PATHS)), rejects(read).count()

    expected = told(split_from=1 << 30)
    with short_splits(spark, 1500):
        _, others = split_documents(spark, [literal(str(path)) for path in tmp_path.iterdir()])
        assert {unquote(uri).rsplit("/", 1)[1] for uri in others} == {f"{name}[1].json" for name in READ_WHOLE if READ_WHOLE[name]}
        assert told(split_from=0) == expected
    assert expected[0].count((149, 149)) >= len(READ_SPLIT) - 2 and expected[1] > 5


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "a.json").write_text(READ_SPLIT["dense"])
    (tmp_path / "b.json").write_text(json.dumps({"features": FEATURES[:2]}))
    with short_splits(spark, 1500):
        read_by = _pieces(spark, [str(tmp_path / "a.json")]).groupBy(F.spark_partition_id()).count().collect()
        assert len(read_by) > 10 and max(r["count"] for r in read_by) < 150
        # The setting decides which files are split: one of the two is.
        documents = read_documents(spark, str(tmp_path))
        assert documents.count() == 150 + 1 and flatten_features(accepted(documents), PATHS).count() == 152


def test_lines_that_end_within_quotes_by_one_look(spark):
    """The look that finds files agrees with the state of quotes, on all lines of few signs."""
    from itertools import product

    from perron.sources import delimited

    lines = ["".join(signs) for n in range(9) for signs in product('";a', repeat=n)] + ['"a' + ';"b"' * 5000, 'x;' * 5000 + '"\x01']
    found = spark.createDataFrame([(line,) for line in lines], "value string").select(
        F.col("value").rlike(delimited._OPEN_LINE).alias("now"),
        delimited._ends_open(delimited._single_quotes(F.col("value"))).alias("then"),
    )
    assert found.where("now").count() > 1000 and found.where("now <> then").count() == 0


def test_landing_files_are_packed_and_bounded(spark, tmp_path):
    from perron.bindings import shapes
    from perron.sources.files import landed

    columns = fields("1 n whole")
    shapes.write_cells(
        spark.range(250_000).coalesce(1).select(F.col("id").alias("n")), Delimited("raw_n", "n", columns), str(tmp_path / "n"), {},
        shapes.PACKED,
    )
    paths = [path for path in landed(spark, str(tmp_path / "n")) if "part-" in path]
    assert len(paths) == 3 and all(path.endswith(".csv.gz") for path in paths)
    got = accepted(positional_copy(read_delimited(spark, [str(tmp_path / "n")], columns), columns))
    assert got.agg(F.count("n"), F.sum("n")).first() == (250_000, 31_249_875_000)
