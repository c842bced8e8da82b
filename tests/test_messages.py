"""Decoding, rules, features and scores on single records."""

import json

from pyspark.sql import functions as F

from martweave import fixed_values as V
from martweave.functions.messages import dead_letters, parse_transactions, valid_rows
from martweave.functions.risk import feature_columns, with_risk_score, with_rule_flags
from martweave.plans.commerce import routed

BASE = {
    "transaction_id": "t1", "company_id": "company_0001", "company_name": "Acme", "company_size_tier": "smb",
    "vendor_id": "vendor_0001", "vendor_name": "V", "vendor_category": "travel", "vendor_risk_tier": "low",
    "amount_usd": 500.0, "currency": "USD", "payment_method": "card", "department": "IT",
    "timestamp": "2024-03-13T10:30:00+00:00", "baseline_monthly_spend": 50000.0, "is_anomaly": False, "anomaly_type": None,
}


def text(**changes):
    return json.dumps({k: v for k, v in {**BASE, **changes}.items() if v != "DROP"})


def parse(spark, *texts):
    return parse_transactions(spark.createDataFrame([(t,) for t in texts], "value string"))


SOUND = [
    (text(), 500.0, 50000.0),
    (text(amount_usd="1234.56"), 1234.56, 50000.0),
    (text(baseline_monthly_spend="75000"), 500.0, 75000.0),
    (text(amount_usd="1_000"), 1000.0, 50000.0),
    (text(amount_usd=" 7.5e2 "), 750.0, 50000.0),
    (text(amount_usd=True), 1.0, 50000.0),
    (text(company_id=None), 500.0, 50000.0),
    (text(extra={"deep": [1, {"a": 2}]}), 500.0, 50000.0),
    ("  " + text() + " ", 500.0, 50000.0),
]


def test_sound_messages(spark):
    parsed = parse(spark, *[raw for raw, _, _ in SOUND]).collect()
    got = {r.raw_message: (r.error, r.amount_usd, r.baseline_monthly_spend) for r in parsed}
    assert got == {raw: (None, amount, baseline) for raw, amount, baseline in SOUND}


def test_null_value_is_present(spark):
    assert valid_rows(parse(spark, text(company_id=None))).first().company_id is None


REFUSED = [
    (text(amount_usd="DROP"), "Missing required fields: amount_usd"),
    (text(vendor_id="DROP", company_id="DROP"), "Missing required fields: company_id, vendor_id"),
    ("not json", "invalid JSON"),
    ("", "invalid JSON"),
    ("[1, 2]", "not a JSON object"),
    ('"text"', "not a JSON object"),
    ("5", "not a JSON object"),
    (text() + " junk", "invalid JSON"),
    (text() + "]", "invalid JSON"),
    (text() + "] [", "invalid JSON"),
    (text() + "}", "invalid JSON"),
    (text() + "," + text(), "invalid JSON"),
    (text(amount_usd="abc"), "could not convert amount_usd to float: 'abc'"),
    (text(amount_usd="12d"), "could not convert amount_usd to float: '12d'"),
    (text(amount_usd="1__0"), "could not convert amount_usd to float: '1__0'"),
    (text(amount_usd=None), "not a number: amount_usd is null"),
    (text(baseline_monthly_spend=[1]), "could not convert baseline_monthly_spend to float: '[1]'"),
    (text(amount_usd="true"), "could not convert amount_usd to float: 'true'"),
]


def test_refused_messages(spark):
    parsed = parse(spark, *[raw for raw, _ in REFUSED])
    assert {r.raw_message: r.error for r in dead_letters(parsed).collect()} == dict(REFUSED)
    assert valid_rows(parsed).count() == 0


RULE_CASES = [
    ({}, (False, False, False, False, 0)),
    ({"amount_usd": 10000}, (True, False, False, True, 2)),
    ({"amount_usd": 2499}, (False, False, False, False, 0)),
    ({"amount_usd": 2500}, (False, False, False, False, 0)),
    ({"amount_usd": 2501}, (True, False, False, False, 1)),
    ({"baseline_monthly_spend": 0, "amount_usd": 9e9 + 1}, (False, False, False, False, 0)),
    ({"vendor_risk_tier": "high", "amount_usd": 6000, "baseline_monthly_spend": 1e7}, (False, True, False, True, 2)),
    ({"vendor_risk_tier": "high", "amount_usd": 5000, "baseline_monthly_spend": 1e7}, (False, False, False, True, 1)),
    ({"vendor_risk_tier": "high", "amount_usd": 100}, (False, False, False, False, 0)),
    ({"timestamp": "2024-03-13T03:15:00+00:00"}, (False, False, True, False, 1)),
    ({"timestamp": "2024-03-13T03:15:00+05:30"}, (False, False, True, False, 1)),
    ({"timestamp": "2024-03-13T04:59:59Z"}, (False, False, True, False, 1)),
    ({"timestamp": "2024-03-13T05:00:00Z"}, (False, False, False, False, 0)),
    ({"timestamp": "2024-03-13"}, (False, False, True, False, 1)),
    ({"timestamp": "at night"}, (False, False, False, False, 0)),
    ({"amount_usd": 10001}, (True, False, False, False, 1)),
    ({"amount_usd": 4000, "baseline_monthly_spend": 1e7}, (False, False, False, False, 0)),
]


def test_rules(spark):
    texts = [text(transaction_id=str(i), **changes) for i, (changes, _) in enumerate(RULE_CASES)]
    names = [*[name for name, _ in V.ALERT_REASONS], "rule_flag_count"]
    rows = with_rule_flags(valid_rows(parse(spark, *texts))).collect()
    got = {int(r.transaction_id): tuple(r[n] for n in names) for r in rows}
    assert got == {i: expected for i, (_, expected) in enumerate(RULE_CASES)}


# raw score, rules fired -> model score, rule part, final score, flag
SCORE_CASES = [
    (-0.5, 0, 1.0, 0.0, 1.0, True),
    (-0.9, 0, 1.0, 0.0, 1.0, True),
    (0.1, 0, 0.0, 0.0, 0.0, False),
    (0.4, 0, 0.0, 0.0, 0.0, False),
    (0.05, 0, 0.0833, 0.0, 0.0833, False),
    (-0.45, 0, 0.9167, 0.0, 0.9167, True),
    (0.0, 2, 0.1667, 0.4, 0.5667, True),
    (0.0, 5, 0.1667, 0.4, 0.5667, True),
    (-0.5, 5, 1.0, 0.4, 1.0, True),
    (None, 1, 0.0, 0.2, 0.2, False),
]


def test_risk_score(spark):
    rows = [(i, case[0], case[1]) for i, case in enumerate(SCORE_CASES)]
    scored = with_risk_score(spark.createDataFrame(rows, "i int, ml_raw_score double, rule_flag_count int")).collect()
    got = {r.i: (r.ml_anomaly_score, r.rule_contribution, r.final_risk_score, r.risk_flag) for r in scored}
    assert got == {i: case[2:] for i, case in enumerate(SCORE_CASES)}


def test_features(spark):
    rows = valid_rows(parse(spark, text(timestamp="2024-03-10T23:05:00-08:00", vendor_risk_tier="high", amount_usd=0)))
    row = rows.select(*[c.alias(n) for n, c in feature_columns().items()]).first()
    assert list(row) == [0.0, 0.0, 0.0, 23.0, 6.0, 1.0, 1.0, 1.0]
    unknown = valid_rows(parse(spark, text(vendor_category="gardening", baseline_monthly_spend=0)))
    row = unknown.select(*[c.alias(n) for n, c in feature_columns().items()]).first()
    assert row.vendor_category_encoded == 0.0 and row.amount_to_baseline_ratio == 0.0


EVENT = {"type": "page_view", "user_id": "u", "session_id": "s", "timestamp": "2024-01-01T00:00:00Z"}
ORDER = {
    "order_id": "o", "user_id": "u", "items": [{"product_id": "p"}], "totals": {"total": 0}, "status": "paid",
    "created_at": "2024-01-01",
}


def reasons(spark, records):
    """Reason per (topic, document) record, in the order given."""
    rows = [(i, topic, json.dumps(doc)) for i, (topic, doc) in enumerate(records)]
    df = spark.createDataFrame(rows, "i int, topic string, value string")
    return [r.reason for r in sorted(routed(df).collect(), key=lambda r: r.i)]


def test_event_empty_fields(spark):
    cases = [(field, empty) for field in V.EVENT_REQUIRED for empty in ["DROP", None, "", 0, False, [], {}, 0.0]]
    docs = [("events", {k: v for k, v in {**EVENT, field: empty}.items() if v != "DROP"}) for field, empty in cases]
    assert reasons(spark, docs) == [f"missing required field: '{field}'" for field, _ in cases]


TOPIC_CASES = [
    ("events", EVENT, None),
    ("events", {**EVENT, "user_id": "0"}, None),
    ("events", {**EVENT, "user_id": "false"}, None),
    ("events", {**EVENT, "session_id": 7}, None),
    ("events", {**EVENT, "type": "tap"}, "invalid event type: 'tap'"),
    ("events", {**EVENT, "timestamp": "2024-1-1"}, "unparseable timestamp: '2024-1-1'"),
    ("events", {**EVENT, "timestamp": "2024-02-30T00:00:00"}, "unparseable timestamp: '2024-02-30T00:00:00'"),
    ("orders", ORDER, None),
    ("orders", {**ORDER, "items": []}, "missing required field: 'items'"),
    ("orders", {**ORDER, "items": "x"}, "items must be a non-empty list"),
    ("orders", {**ORDER, "totals": {}}, "missing required field: 'totals'"),
    ("orders", {**ORDER, "totals": {"subtotal": 1}}, "order total must be non-negative"),
    ("orders", {**ORDER, "totals": {"total": -1}}, "order total must be non-negative"),
    ("orders", {**ORDER, "status": "lost"}, "invalid order status: 'lost'"),
    ("clicks", EVENT, "unexpected topic: clicks"),
]


def test_topic_reasons(spark):
    assert reasons(spark, [(topic, doc) for topic, doc, _ in TOPIC_CASES]) == [expected for _, _, expected in TOPIC_CASES]


def test_decoding_is_not_repeated_by_filters(spark):
    """A filter on the error must not multiply the parse in the plan."""
    rows = valid_rows(parse(spark, text())).filter(F.col("amount_usd") > 1)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") <= 6
