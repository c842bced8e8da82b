"""Registered queries that write a table and read it back, and array expressions over course lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays
from ..plans import bank as K
from ..plans import customers as C
from ..plans import spend as P
from ..session import run_folder
from ..sources import readers, sinks
from ..sources.tables import table
from . import bank, spend
from . import standins as S
from .common import Catalog, big, dbl, plain
from .customers import _ORDERS_SQL, MARK

catalog = Catalog()

SEED_SQL = """select 'H' || s_suppkey hotel_id, case when s_suppkey % 3 = 0 then 'Resort Hotel' else 'City Hotel' end hotel_type,
  s_name hotel_name, 'R' || s_nationkey region, case when s_suppkey % 7 = 0 then null else 'N' || s_nationkey end country,
  s_suppkey % 4 = 0 is_active from supplier"""


def _seed_file(spark, folder) -> str:
    supplier = table(spark, folder, "supplier")
    rows = supplier.select(
        F.concat(F.lit("H"), F.col("s_suppkey").cast("string")).alias("hotel_id"),
        F.when(F.col("s_suppkey") % 3 == 0, "Resort Hotel").otherwise("City Hotel").alias("hotel_type"),
        F.col("s_name").alias("hotel_name"),
        F.concat(F.lit("R"), F.col("s_nationkey").cast("string")).alias("region"),
        F.when(F.col("s_suppkey") % 7 != 0, F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))).alias("country"),
        (F.col("s_suppkey") % 4 == 0).alias("is_active"),
    )
    place = run_folder(spark, "seed")
    rows.write.csv(place, header=True)
    return place


@catalog.add("csv_seed", SEED_SQL)
def _(spark, folder):
    """A seed file with a header read with its schema."""
    return plain(readers.csv_seed(spark, _seed_file(spark, folder), readers.HOTEL_SEED_SCHEMA))


@catalog.add("csv_text_rows", f"select hotel_id, cast(is_active as varchar) is_active from ({SEED_SQL})")
def _(spark, folder):
    """The same file read as text, its columns to be converted by the caller."""
    columns = ["hotel_id", "hotel_type", "hotel_name", "region", "country", "is_active"]
    return plain(readers.csv_text_rows(spark, _seed_file(spark, folder), columns).select("hotel_id", "is_active"))


@catalog.add(
    "json_rates",
    """select n_name || '/USD' currency_pair, n_nationkey / 8.0::double exchange_rate, '2024-01-02 00:00:00.000000' "timestamp" from nation""",
)
def _(spark, folder):
    """A rates file that holds one array of objects."""
    nation = table(spark, folder, "nation")
    rate = F.struct(
        F.concat("n_name", F.lit("/USD")).alias("currency_pair"), (F.col("n_nationkey") / 8.0).cast("double").alias("rate")
    )
    place = run_folder(spark, "rates")
    nation.agg(F.to_json(F.collect_list(rate)).alias("value")).write.text(place)
    return plain(readers.exchange_rates(spark, place, "2024-01-02 00:00:00"))


@catalog.add(
    "json_rate_files",
    f"""select o_custkey customer_id, 'C' || o_custkey || '/USD' currency_pair, o_custkey / 8.0::double exchange_rate,
    {big('count(*)')} orders, {dbl('sum(cast(o_totalprice as decimal(18,2)))')} total,
    {dbl('sum(cast(o_totalprice as decimal(18,2)))')} * (o_custkey / 8.0::double) total_usd
    from orders where o_custkey in (select c_custkey from customer) group by o_custkey""",
)
def _(spark, folder):
    """Totals of customers, each in a currency of its own, by rates kept in many files of one array each."""
    rates = table(spark, folder, "customer").select(
        F.format_string("C%d/USD", "c_custkey").alias("currency_pair"), (F.col("c_custkey") / 8.0).cast("double").alias("rate")
    )
    place = run_folder(spark, "rate_files")
    sinks.json_arrays(rates, place, "currency_pair")
    quoted = readers.exchange_rates(spark, place, "2024-01-02 00:00:00").drop("timestamp")
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    totals = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(amount).cast("double").alias("total")
    )
    priced = totals.withColumn("currency_pair", F.format_string("C%d/USD", "customer_id")).join(quoted, "currency_pair")
    return plain(
        priced.select(
            "customer_id", "currency_pair", "exchange_rate", "orders", "total", (F.col("total") * F.col("exchange_rate")).alias("total_usd")
        )
    )


@catalog.add("rebuilt_customers", "select c_custkey customer_id, c_mktsegment segment, c_acctbal balance from customer")
def _(spark, folder):
    """A table rebuilt twice, partitioned by a column, and read through a view."""
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    place = run_folder(spark, "rebuilt")
    sinks.rebuild(rows.where("customer_id % 2 = 0"), place, "segment")
    view = sinks.as_view(sinks.rebuild(rows, place, "segment"), "rebuilt_customers")
    return plain(view.sparkSession.table("rebuilt_customers").select("customer_id", "segment", "balance"))


@catalog.add(
    "appended_orders",
    f"""select order_id, customer_id, cast(order_date as varchar) order_date, {dbl('order_amount')} order_amount, order_status
    from {_ORDERS_SQL} where order_date <= date '{MARK}' or order_date > (select max(order_date) from {_ORDERS_SQL} where order_date <= date '{MARK}')""",
)
def _(spark, folder):
    """A first run up to a date and a second one with everything: only newer orders are added."""
    raw, place = S.CUSTOMER_ORDERS.frame(spark, folder), run_folder(spark, "appended")
    C.load_orders(raw.filter(F.col("order_date") <= F.lit(MARK).cast("timestamp")), place)
    return plain(C.load_orders(raw, place))


@catalog.add(
    "retrain_audit",
    f"""with d as ({spend.catalog.checks['retrain_decision_first_run']}), n as ({spend._decision_sql('2024-01-05T00:00:00')})
    select '2024-01-05 00:00:00.000000' triggered_at, retrain_triggered, reason, new_transaction_count from d
    union all select '2024-02-05 00:00:00.000000', retrain_triggered, reason, new_transaction_count from n""",
)
def _(spark, folder):
    """Two decisions in a row, the second counting from the first one's entry in the audit log."""
    rows, place = spend.transactions(spark, folder), run_folder(spark, "audit")
    for now in ("2024-01-05 00:00:00", "2024-02-05 00:00:00"):
        since = P.last_retrain(sinks.stored_or_none(spark, place))
        sinks.append(P.audit_entry(P.retrain_decision(rows, since), F.lit(now).cast("timestamp")), place)
    return plain(spark.read.parquet(place))


@catalog.add(
    "transaction_ids_continued",
    bank.catalog.checks["transaction_ids"].replace("(500 +", "(500 + (select count(*) from ledger) +").replace(
        "select 'TX'", f"with ledger as ({bank.catalog.checks['ledger_post']}) select 'TX'", 1
    ),
)
def _(spark, folder):
    """Ids that go on after the highest one already stored."""
    posted = bank.posted(spark, folder)
    stored = K.stored_rows(posted, last_number=500)
    return plain(K.stored_rows(posted, last_number=K.last_transaction_number(stored)))


_LISTS_SQL = f"(select student_id, list_sort(list_distinct(list(course))) c from {S.TRANSCRIPT.sql} group by student_id)"


@catalog.add(
    "course_lists",
    f"""select student_id, array_to_string(list_append(c, 'C1'), ',') pushed,
    array_to_string(if(list_contains(c, 'C1'), c, list_append(c, 'C1')), ',') added,
    array_to_string(list_filter(c, lambda x: x <> c[1] and x <> 'C2'), ',') pulled, c[2] second_course, array_to_string(c[1:2], ',') first_two,
    list_contains(c, 'C3') has_c3, array_to_string(list_sort(list_filter(['C1', 'C2', 'C3'], lambda x: not list_contains(c, x))), ',') missing
    from {_LISTS_SQL}""",
)
def _(spark, folder):
    """Array expressions over each student's courses."""
    marks = S.TRANSCRIPT.frame(spark, folder)
    lists = marks.groupBy("student_id").agg(F.array_sort(F.collect_set("course")).alias("c"))
    return plain(
        lists.select(
            "student_id",
            arrays.push("c", F.lit("C1")).alias("pushed"),
            arrays.add_to_set("c", F.lit("C1")).alias("added"),
            arrays.pull("c", F.array(F.col("c")[0], F.lit("C2"))).alias("pulled"),
            arrays.nth("c", 1).alias("second_course"),
            arrays.first_n("c", 2).alias("first_two"),
            arrays.contains("c", F.lit("C3")).alias("has_c3"),
            arrays.missing_names(["C3", "C1", "C2"], "c").alias("missing"),
        )
    )
