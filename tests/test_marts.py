"""Marts on small hand-made inputs: the cases the given tables do not have."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martweave.plans import bank, commerce, customers, hotel, marketplace, spend, university, velocity

DAY = dt.date(2024, 1, 10)


def test_order_without_items_and_delivery_status(spark):
    schema = (
        "order_id int, customer_id int, order_status string, purchase_date date, approved_date date, "
        "delivered_carrier_date date, delivered_customer_date date, estimated_delivery_date date"
    )
    rows = [
        (1, 1, "delivered", DAY, DAY, DAY, DAY, DAY),
        (2, 1, "delivered", DAY, DAY, DAY, DAY + dt.timedelta(1), DAY),
        (3, 1, "shipped", DAY, None, None, None, DAY),
        (4, 1, "delivered", DAY, DAY, DAY, DAY, None),
    ]
    rollup = spark.createDataFrame(
        [(1, 5.0, 1.0, 6.0, 1, 1, 2)],
        "order_id int, total_items_price double, total_freight_value double, total_order_item_value double, "
        "unique_products_count bigint, unique_sellers_count bigint, total_items_count bigint",
    )
    got = {r.order_id: r for r in marketplace.order_facts(spark.createDataFrame(rows, schema), rollup).collect()}
    assert [got[i].delivery_performance_status for i in (1, 2, 3, 4)] == [
        "On Time / Early", "Delayed", "In Progress / Unfulfilled", "Delayed",
    ]
    assert got[1].total_items_count == 2 and got[2].total_items_price == 0.0
    assert got[2].delivery_delta_vs_estimated_days == 1 and got[3].estimated_delivery_duration_days is None


def test_attribution_repeats_order_totals(spark):
    orders = spark.createDataFrame([(1, 7, "delivered", DAY)], "order_id int, customer_id int, order_status string, purchase_date date")
    items = spark.createDataFrame(
        [(1, 1, 10, 100, 5.0, 1.0), (1, 2, 11, 100, 6.0, 1.0), (1, 3, 12, 101, 7.0, 1.0)],
        "order_id int, order_item_id int, product_id int, seller_id int, price double, freight_value double",
    )
    sellers = spark.createDataFrame(
        [(100, "email", "d", "r", True, "c", "s")],
        "seller_id int, marketing_channel string, sales_developer_id string, sales_representative_id string, "
        "is_funnel_acquired boolean, city string, state string",
    )
    got = sorted(marketplace.seller_attribution(orders, items, sellers).collect(), key=lambda r: r.seller_id)
    assert [(r.seller_id, r.attributed_revenue, r.total_items_count) for r in got] == [(100, 18.0, 3), (101, 18.0, 3)]
    assert got[1].marketing_channel is None


def test_attribution_reads_items_once(spark):
    from martweave.catalog import marketplace as registered

    plan = registered.attribution(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem") == 1


def test_late_cancellation_boundaries(spark):
    schema = (
        "hotel_id string, hotel string, is_canceled string, leadtime_days int, arrival_date date, reservation_status string, "
        "reservation_status_update_date date, deposit_type string, average_daily_rate double, total_stay_nights int, "
        "estimated_revenue double, market_segment string, distribution_channel string, customer_type string, "
        "reserved_room_type string, assigned_room_type string, previous_cancellations int"
    )

    def booking(days_left, canceled="TRUE", deposit="No Deposit"):
        updated = None if days_left is None else DAY - dt.timedelta(days_left)
        return ("H", "City Hotel", canceled, 9, DAY, "x", updated, deposit, 10.0, 2, 20.0, "m", "d", "c", "A", "A", 0)

    rows = [booking(6), booking(7), booking(-2), booking(None), booking(3, "FALSE", None)]
    got = hotel.cancellation_details(spark.createDataFrame(rows, schema)).collect()
    assert [r.is_late_cancellation for r in got] == [True, False, True, False, False]
    assert got[4].deposit_cancellation_outcome == "Retained - No Deposit" and got[4].revenue_lost == 0
    assert got[0].days_to_cancellation == 3 and got[0].booking_date == DAY - dt.timedelta(9)

    analysis = hotel.cancellation_analysis(hotel.cancellation_details(spark.createDataFrame(rows, schema))).collect()
    known = [r for r in analysis if r.deposit_type is not None]
    unknown = [r for r in analysis if r.deposit_type is None]
    assert len(known) == 1 and known[0].total_cancellations == 4 and known[0].late_cancellation_count == 2
    assert len(unknown) == 1 and unknown[0].deposit_cancellation_outcome is None and unknown[0].total_bookings == 1


def test_hot_group_analysis_is_one_scan(spark):
    from martweave.catalog import hotel as registered

    df = hotel.cancellation_analysis(registered.details(spark, "/root/testdata/sf0.001"))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_rolling_average_counts_rows(spark):
    days = [DAY + dt.timedelta(i * 3) for i in range(9)]
    daily = spark.createDataFrame([("c", d, Decimal(100 if i < 8 else 1000)) for i, d in enumerate(days)], "company_id string, transaction_date date, total_amount_usd decimal(38,9)")
    got = spend.company_spend_summary(daily).collect()
    last = max(got, key=lambda r: r.transaction_date)
    assert float(last.rolling_7d_avg_spend) == pytest.approx((6 * 100 + 1000) / 7) and last.is_unusual_spend_day
    assert not min(got, key=lambda r: r.transaction_date).is_unusual_spend_day


def test_alert_reason(spark):
    from martweave.functions.text import alert_reason

    schema = "rule_spend_spike boolean, rule_high_risk_vendor boolean, rule_off_hours boolean, rule_round_amount boolean, any_rule_triggered boolean, ml_anomaly_score double"
    rows = [(True, False, True, False, True, 0.9), (False,) * 5 + (0.41,), (False,) * 5 + (0.4,)]
    got = [r.a for r in spark.createDataFrame(rows, schema).select(alert_reason().alias("a")).collect()]
    assert got == ["spend spike; off-hours transaction;", "ML anomaly (no rule triggered);", ""]


def test_retrain(spark):
    rows = spark.range(500).select(F.lit("2024-01-02T00:00:00+00:00").alias("timestamp"))
    assert spend.retrain_decision(rows, "2024-01-01").first().retrain_triggered
    few = spend.retrain_decision(rows.limit(499), "2024-01-01").first()
    assert not few.retrain_triggered and few.reason.startswith("Only 499 new transactions")
    audit = spend.audit_entry(spend.retrain_decision(rows, "2024-01-01"), F.lit("2024-02-01 10:00:00").cast("timestamp"))
    assert spend.last_retrain(audit) == "2024-02-01T10:00:00+00:00"
    assert spend.last_retrain(audit.limit(0)) == spend.last_retrain(None) == "2000-01-01T00:00:00+00:00"


ACCOUNTS = [
    ("A", "USD", 1000, 100), ("B", "USD", 1000, 100), ("E", "EUR", 1000, 100), ("M", "USD", 0, 0), ("N", "EUR", 0, 0), ("G", "GBP", 1000, 0),
]


def post(spark, *requests):
    accounts = spark.createDataFrame(
        [(a, c, Decimal(b), Decimal(m)) for a, c, b, m in ACCOUNTS],
        "account_id string, currency string, current_balance decimal(18,2), minimum_balance decimal(18,2)",
    )
    rates = spark.createDataFrame([("USD/EUR", 0.95), ("EUR/USD", 1.05)], "currency_pair string, exchange_rate double")
    schema = (
        "seq bigint, transaction_type string, primary_account_id string, secondary_account_id string, "
        "merchant_account_id string, amount decimal(18,2), charge decimal(18,2), timestamp timestamp"
    )
    rows = [(i, t, p, s, m, Decimal(str(a)), Decimal("1.00"), dt.datetime(2024, 1, 1)) for i, (t, p, s, m, a) in enumerate(requests)]
    return accounts, rates, spark.createDataFrame(rows, schema)


CASES = [
    # type, primary, secondary, merchant, amount -> status, stored amount, currency, legs
    (("deposit", "A", "B", "M", 50), ("success", 50, "USD", {"A": 50})),
    (("withdrawal", "A", "B", "M", 899), ("success", 899, "USD", {"A": -900})),
    (("withdrawal", "A", "B", "M", 899.01), ("failed", 899.01, "USD", {})),
    (("purchase", "A", "B", "M", 100), ("success", 100, "USD", {"A": -101, "M": 100})),
    (("POS", "A", "B", "N", 100), ("success", 105, "USD", {"A": -106, "N": 100})),
    (("payment", "E", "B", "M", 100), ("success", 95, "EUR", {"E": -96, "M": 100})),
    (("payment", "E", "B", "M", 2000), ("failed", 1900, "EUR", {})),
    (("cheque deposit", "A", "E", "M", 100), ("success", 100, "EUR", {"E": -101, "A": 105})),
    (("cheque deposit", "A", "B", "M", 100), ("success", 100, "USD", {"B": -101, "A": 100})),
    (("cheque withdrawal", "A", "E", "M", 100), ("success", 100, "EUR", {"E": -101})),
    (("transfer", "A", "E", "M", 100), ("success", 95, "EUR", {"A": -101, "E": 95})),
    (("transfer", "A", "B", "M", 100), ("success", 100, "USD", {"A": -101, "B": 100})),
    (("transfer", "A", "E", "M", 900), ("failed", 900, "USD", {})),
    (("transfer", "A", "G", "M", 5000), ("failed", 5000, "USD", {})),
]


# unknown accounts, missing rates, a type that is not posted
NO_ROW = [
    ("transfer", "A", "nobody", "M", 1), ("deposit", "nobody", "B", "M", 1), ("transfer", "A", "G", "M", 1),
    ("purchase", "G", "B", "M", 1), ("purchase", "A", "B", "nobody", 1), ("charge", "A", "B", "M", 1),
]


def test_posting(spark):
    accounts, rates, requests = post(spark, *[request for request, _ in CASES], *NO_ROW)
    posted = bank.post(requests, accounts, rates)
    moved = {}
    for leg in bank.legs(posted).collect():
        moved.setdefault(leg.seq, {})[leg.account_id] = float(leg.signed_amount)
    rows = posted.collect()
    got = {r.seq: (r.status, float(r.amount), r.currency, moved.get(r.seq, {})) for r in rows}
    assert got == {i: expected for i, (_, expected) in enumerate(CASES)}
    assert all((r.reason is None) == (r.status == "success") for r in rows)


def test_ordered_posting_and_conservation(spark):
    many = [("transfer", "A", "B", "M", 300)] * 4 + [("withdrawal", "B", "A", "M", 50), ("deposit", "A", "B", "M", 10)]
    accounts, rates, requests = post(spark, *many)
    ordered = bank.post_in_order(requests, accounts, rates)
    status = {r.seq: r.status for r in ordered.collect()}
    assert status == {0: "success", 1: "success", 2: "failed", 3: "failed", 4: "success", 5: "success"}
    assert {r.status for r in bank.post(requests, accounts, rates).collect()} == {"success"}
    moved = float(bank.legs(ordered).agg(F.sum("signed_amount")).first()[0])
    assert moved == 10 - 50 - 3 * 1.0
    balance = {r.account_id: float(r.new_balance) for r in bank.balances(accounts, bank.legs(ordered)).collect()}
    assert balance["A"] == 1000 - 2 * 301 + 10 and balance["M"] == 0
    running = {(r.account_id, r.seq): float(r.balance_after) for r in bank.running_balances(accounts, bank.legs(ordered)).collect()}
    assert running[("A", 0)] == 699 and running[("A", 5)] == balance["A"]


def test_transaction_numbers_continue(spark):
    accounts, rates, requests = post(spark, ("deposit", "A", "B", "M", 1), ("deposit", "A", "B", "M", 2))
    stored = bank.stored_rows(bank.post(requests, accounts, rates))
    assert sorted(r.transaction_id for r in stored.collect()) == ["TX000000001", "TX000000002"]
    assert bank.last_transaction_number(stored) == 2 and bank.last_transaction_number(stored.limit(0)) == 0


def test_customer_incremental(spark, folder):
    schema = "order_id int, customer_id int, order_date string, amount double, order_status string"
    first = spark.createDataFrame([(1, 1, "2024-01-01", 1.005, "completed"), (2, 1, "2024-01-02", 2.0, "pending")], schema)
    assert customers.load_orders(first, folder + "/t").count() == 2
    later = spark.createDataFrame([(3, 1, "2024-01-02", 1.0, "pending"), (4, 1, "2024-01-03", 1.0, "pending")], schema)
    assert {r.order_id for r in customers.load_orders(later, folder + "/t").collect()} == {1, 2, 4}


def test_nested_product_update(spark):
    products = spark.createDataFrame(
        [("s1", {"views_7d": 9, "purchases_7d": 9, "conversion_rate": 0.9}), ("s2", None)],
        "sku string, stats struct<views_7d: int, purchases_7d: int, conversion_rate: double>",
    )
    stats = spark.createDataFrame([("s2", 0, 3, 0.0), ("zz", 1, 1, 1.0)], "product_id string, views_7d bigint, purchases_7d bigint, conversion_rate double")
    got = {r.sku: r.stats for r in commerce.update_product_stats(products, stats).collect()}
    assert got["s1"].views_7d == 9 and got["s2"].purchases_7d == 3 and set(got) == {"s1", "s2"}


def test_enrichment_leaves_missing_sources_alone(spark):
    events = spark.createDataFrame([("page_view", None), ("page_view", ("1.2.3.4", "", "FR"))], "type string, metadata struct<ip: string, user_agent: string, country: string>")
    full = events.select("type", F.col("metadata").cast("struct<ip: string, user_agent: string, country: string>").alias("metadata"))
    rows = full.select(
        "type",
        F.when(F.col("metadata").isNotNull(), F.struct(
            F.col("metadata.ip").alias("ip"), F.col("metadata.user_agent").alias("user_agent"), F.col("metadata.country").alias("country"),
            F.lit(None).cast("string").alias("country_code"), F.lit(None).cast("string").alias("city"),
            F.lit(None).cast("string").alias("device_type"), F.lit(None).cast("string").alias("browser"),
        )).alias("metadata"),
    )
    got = commerce.enrich_events(rows).collect()
    assert got[0].metadata is not None and got[0].metadata.device_type is None
    assert got[1].metadata.country == "FR" and got[1].metadata.browser is None


def test_course_slots(spark):
    courses = spark.createDataFrame([(f"a{i}", i, "big") for i in range(25)] + [(f"b{i}", i, "small") for i in range(6)], "course_code string, course_no int, department string")
    got = {r.course_code: (r.type, r.year, r.semester) for r in university.course_slots(courses, [F.col("course_no")]).collect()}
    assert [got[f"a{i}"][1:] for i in range(6)] == [(1, 1)] * 4 + [(1, 2)] * 2
    assert got["a17"] == ("Compulsory", 3, 2) and got["a18"] == ("Elective", None, None) and got["b5"] == ("Compulsory", 1, 2)


def test_gpa_without_credits(spark):
    transcript = spark.createDataFrame([("s", "c0", 4.0), ("t", "c0", 4.0), ("t", "c3", 2.0), ("t", "gone", 0.0)], "student_id string, course string, grade_point double")
    courses = spark.createDataFrame([("c0", 0), ("c3", 3)], "course_code string, credits int")
    assert {r.student_id: r.gpa for r in university.gpa(transcript, courses).collect()} == {"t": 2.0}


def test_velocity_across_blocks(spark):
    base = dt.datetime(2024, 1, 1, 0, 50)
    stamps = [base + dt.timedelta(minutes=m) for m in (0, 5, 9, 10, 11, 40)]
    df = spark.createDataFrame([("c", i, s) for i, s in enumerate(stamps)], "company string, id int, at timestamp")
    got = {r.id: r.recent_count for r in velocity.velocity(df, "company", "at", 2, 10).collect()}
    expected = {i: n for i, s in enumerate(stamps) if (n := sum(s - dt.timedelta(minutes=10) <= o <= s for o in stamps)) > 2}
    assert got == expected and expected


def test_member_pages_keep_all(spark):
    members = spark.createDataFrame([("d", i, f"e{i}") for i in range(25)], "g string, no bigint, id string")
    got = sorted(university.member_pages(members, "g", "no", "id", 10).collect(), key=lambda r: r.page_no)
    assert [m for r in got for m in r.members] == [f"e{i}" for i in range(25)] and [r.member_count for r in got] == [10, 10, 5]


def test_declared_tests_score_a_transaction_once(spark, monkeypatch):
    """All models of a suite read scores that were written once; each queries its rows once."""
    from conftest import SMALL
    from martweave.catalog import declared, spend

    calls = []
    score, asked = spend.P.score_transactions, []
    monkeypatch.setattr(spend.P, "score_transactions", lambda rows: calls.append(1) or score(rows))
    queries = {n: lambda s, f, n=n, q=q: asked.append(n) or q(s, f) for n, q in spend.catalog.queries.items()}
    monkeypatch.setattr(spend.catalog, "queries", queries)
    got = declared.catalog.queries["declared_spend"](spark, SMALL)
    assert len(calls) == 1 and len(asked) == len(set(asked)) == len({m[0] for m in declared.SPEND.values()})
    assert got.count() == sum(len(m[1]) + len(m[2]) + len(m[3]) for m in declared.SPEND.values())
    spend.scored(spark, SMALL)
    assert len(calls) == 2


def test_all_suites_share_the_scores(spark, monkeypatch):
    from conftest import SMALL
    from martweave.catalog import declared, spend

    found = []

    def suite(spark, folder):
        with spend.scored_once():
            found.append(spend.scored(spark, folder))
        return spark.createDataFrame([(True,)], "success boolean")

    monkeypatch.setattr(declared, "_SUITES", {"a": suite, "b": suite})
    assert declared.catalog.queries["quality_overall"](spark, SMALL).first().checks == 2
    assert found[0] is found[1]


def test_suites_build_the_order_facts_once(spark, monkeypatch):
    """All suites of the marketplace read item totals, order facts, leads and sellers that were written once."""
    from conftest import SMALL
    from martweave.catalog import declared, marketplace

    calls = []
    for name in ("order_items_rollup", "order_facts", "closed_leads", "seller_dimension"):
        build = getattr(marketplace.M, name)
        monkeypatch.setattr(marketplace.M, name, lambda *rows, n=name, b=build: calls.append(n) or b(*rows))
    suites = {n: declared._SUITES[n] for n in ("quality_fct_orders", "quality_dim_sellers", "declared_marketplace")}
    monkeypatch.setattr(declared, "_SUITES", suites)
    got = declared.catalog.queries["quality_overall"](spark, SMALL).first()
    assert sorted(calls) == ["closed_leads", "order_facts", "order_items_rollup", "seller_dimension"]
    plain = [suite(spark, SMALL).collect() for suite in suites.values()]
    assert got.checks == sum(len(rows) for rows in plain)
    assert got.failed_checks == sum(not r.success for rows in plain for r in rows)
