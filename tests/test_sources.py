import json

import pytest

from secflow.plans.tables import frame
from secflow.sources import readers, rules, sinks

SF = "/root/testdata/sf0.001"


def test_rule_predicates_reach_the_scan(spark, tmp_path):
    table = spark.createDataFrame(
        [(str(i), "n", "d", "t", "1", i % 2, "a") for i in range(6)],
        "recordid string, multieventname string, eventdesc string, multieventtype string, eventlevel string, status int, advice string")
    table.write.parquet(str(tmp_path / "t_siem_medefine"))
    loaded = rules.load_rules(spark, "composite_def", folder=str(tmp_path))
    assert sorted(r.recordid for r in loaded.collect()) == ["1", "3", "5"]
    assert "EqualTo(status,1)" in loaded._jdf.queryExecution().executedPlan().toString()
    assert {"record_id", "name", "event_level", "status"} <= set(rules.operator_columns(loaded).columns)


def test_every_rule_set_reads_its_columns(spark):
    for name, spec in rules.RULE_SETS.items():
        extra = {"is_inner", "is_use", "status"} - set(spec.columns)
        table = spark.createDataFrame([tuple("1" for _ in (*spec.columns, *extra))], [*spec.columns, *extra])
        assert rules.select_rules(table, name).columns == list(spec.columns)


def test_sub_rules_come_ordered(spark):
    table = spark.createDataFrame(
        [("1", "d", 0, "T_SIEM_MEDETAIL4", 1), ("2", "d", 0, "T_SIEM_MEDETAIL", 1), ("3", "d", 0, "T", 0)],
        "recordid string, medefineid string, op int, objtable string, status int")
    assert [r.recordid for r in rules.select_rules(table, "composite_sub").collect()] == ["2", "1"]


def test_snapshot_versions(spark, tmp_path):
    folder = str(tmp_path / "rules")
    first = spark.createDataFrame([("a", None, 1)], "id string, note string, n int")
    rules.write_snapshot({"r": first}, folder, 1)
    assert rules.read_snapshot(spark, folder, "r").collect() == [("a", "", "1")]
    rules.write_snapshot({"r": first.union(first)}, folder, 2)
    assert rules.latest_version(spark, folder) == 2 and rules.read_snapshot(spark, folder, "r").count() == 2
    # an unfinished version has no completion mark and stays invisible
    first.write.parquet(f"{folder}/version=3/r")
    assert rules.latest_version(spark, folder) == 2


def test_json_docs_round_trip(spark):
    frame_ = spark.createDataFrame([("a", None, 1)], "ID string, note string, n int")
    doc = rules.snapshot_docs(frame_, "set").first()
    assert (doc.rule_set, json.loads(doc.doc)) == ("set", {"id": "a", "note": "", "n": "1"})
    back = rules.rules_from_json(rules.snapshot_docs(frame_, "set"), ["id", "n"]).first()
    assert (back.id, back.n) == ("a", "1")


def test_outer_joins_reduce_to_inner(spark):
    f = lambda n: frame(spark, SF, n)
    for df in (rules.log_regex_by_device(f("store_regex"), f("store_lib"), f("store_asset"), f("store_asset_ip")),
               rules.builtin_event_rules(f("store_event_def"), f("store_event_field"))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "RightOuter" not in plan and "LeftOuter" not in plan


def test_files_and_queries(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("a~b\nc\n")
    lines = readers.text_lines(spark, str(tmp_path / "lines.txt"))
    assert [r.value for r in lines.collect()] == ["a~b", "c"]
    assert readers.query_logs(lines, "select value from {original_log} where value = 'c'").count() == 1
    flows = frame(spark, SF, "netflow")
    sinks.write_table(flows, str(tmp_path / "flows"), partition_by=["proto"])
    read = readers.netflow_table(spark, str(tmp_path / "flows"), "1997-01-01 00:00:00", "1998-01-01 00:00:00")
    assert read.count() == readers.in_time_range(flows, "1997-01-01 00:00:00", "1998-01-01 00:00:00").count() > 0
    assert "GreaterThanOrEqual(record_time" in read._jdf.queryExecution().executedPlan().toString()
    frame(spark, SF, "app_flow").write.parquet(str(tmp_path / "apps"))
    assert readers.app_flow_table(spark, str(tmp_path / "apps")).count() == frame(spark, SF, "app_flow").count()


def test_batches_overwrite_themselves(spark, tmp_path):
    rows = spark.range(5)
    for _ in range(2):
        sinks.write_batch(rows, str(tmp_path / "out"), 3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.kafka_stream(spark, "host:1", "topic", 10)
