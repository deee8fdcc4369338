"""The rule suites."""

from tidewell.operators.quality import SUITES, Rule, check_rules, gate_summary, run_gate


def test_each_kind_of_rule(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 9.0), (None, None), (None, 5.0), (None, 6.0), ("b", 5.0)], "id string, v double")
    rules = [Rule("not_null", "id"), Rule("between", "v", 2, 8), Rule("unique", "id"), Rule("not_null", "v")]
    got = [(r.rule_no, r.expectation, r.passed, r.details) for r in check_rules(df, "t", rules).orderBy("rule_no").collect()]
    assert got == [
        (1, "column 'id' to not be null", False, "3 null values found"),
        (2, "column 'v' to be between 2 and 8", False, "2 out-of-range values"),
        (3, "column 'id' to be unique", False, "3 duplicates found"),
        (4, "column 'v' to not be null", False, "1 null values found"),
    ]


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "id string, v double")
    rules = [Rule("not_null", "id"), Rule("between", "v", 2, 8), Rule("unique", "id")]
    assert [(r.passed, r.details) for r in check_rules(df, "t", rules).collect()] == [(True, "OK")] * 3


def test_suites_hold_twenty_rules():
    assert {name: len(rules) for name, rules in SUITES.items()} == {
        "hrv_readings": 7,
        "sleep_records": 7,
        "activity_records": 6,
    }


def test_gate_opens_only_when_every_rule_passes(spark):
    good = spark.sql("select 'r' as record_id, 'u' as user_id, 100 as steps, 90D as avg_hr_bpm, 120D as peak_hr_bpm")
    bad = good.unionByName(good)
    only = {"activity_records": SUITES["activity_records"]}
    open_ = gate_summary(run_gate({"activity_records": good}, only)).first()
    assert (open_.rules_passed, open_.rules_total, open_.pass_rate_pct, open_.overall_passed) == (6, 6, 100.0, True)
    shut = gate_summary(run_gate({"activity_records": bad}, only)).first()
    assert (shut.rules_passed, shut.pass_rate_pct, shut.overall_passed) == (5, 83.3, False)


def test_missing_feed_is_skipped(spark):
    good = spark.sql("select 'r' as record_id, 'u' as user_id, 100 as steps, 90D as avg_hr_bpm, 120D as peak_hr_bpm")
    assert {r.table_name for r in run_gate({"activity_records": good}).collect()} == {"activity_records"}
