"""Registered queries: the data tests declared with every model, and the schemas of the bank's documents."""

from __future__ import annotations

from .. import fixed_values as V
from ..operators import quality as Q
from ..session import pin
from . import customers, marketplace, spend
from . import standins as S
from .common import Catalog, nth_sql, plain, quoted, shared_rows
from .quality import SIZES, STATUSES, TIERS, _rowwise

catalog = Catalog()

ITEM_TOTALS = [
    "total_items_price",
    "total_freight_value",
    "total_order_item_value",
    "unique_products_count",
    "unique_sellers_count",
    "total_items_count",
]

# model: (query with its rows, columns that must be filled, unique columns, accepted values)
MARKETPLACE = {
    "closed_leads": (
        "closed_leads",
        ["marketing_qualified_lead_id", "marketing_channel", "is_won_deal"],
        ["marketing_qualified_lead_id"],
        {},
    ),
    "order_items_rollup": ("order_items_rollup", ["order_id", *ITEM_TOTALS], ["order_id"], {}),
    "dim_sellers": ("dim_sellers", ["seller_id", "marketing_channel", "is_funnel_acquired"], ["seller_id"], {}),
    "fct_orders": (
        "fct_orders",
        [
            "order_id",
            "customer_id",
            "order_status",
            "purchase_date",
            "estimated_delivery_date",
            *ITEM_TOTALS,
            "delivery_performance_status",
        ],
        ["order_id"],
        {"delivery_performance_status": STATUSES},
    ),
    "b2b2c_attribution": (
        "b2b2c_attribution",
        [
            "order_id",
            "customer_id",
            "seller_id",
            "order_status",
            "purchase_date",
            "marketing_channel",
            "is_funnel_acquired",
            "attributed_revenue",
            "attributed_freight",
            "attributed_total_value",
            "total_items_count",
        ],
        [],
        {},
    ),
}
SPEND = {
    "scored_source": (
        "staged_transactions",
        ["transaction_id", "company_id", "amount_usd", "final_risk_score", "risk_flag"],
        ["transaction_id"],
        {},
    ),
    "window_source": ("spend_windows_5m", ["company_id", "window_start", "window_end", "transaction_count"], [], {}),
    "staged_transactions": (
        "staged_transactions",
        ["transaction_id", "company_id", "vendor_id", "amount_usd", "vendor_risk_tier", "final_risk_score", "risk_flag"],
        ["transaction_id"],
        {"vendor_risk_tier": TIERS, "company_size_tier": SIZES},
    ),
    "staged_spend_windows": (
        "staged_spend_windows",
        ["company_id", "window_start", "transaction_count", "total_amount_usd"],
        [],
        {},
    ),
    "transactions_enriched": (
        "transactions_enriched",
        ["transaction_id", "risk_tier"],
        ["transaction_id"],
        {"risk_tier": TIERS},
    ),
    "company_daily_spend": (
        "company_daily_spend",
        ["transaction_date", "company_id", "transaction_count", "total_amount_usd"],
        [],
        {},
    ),
    "fct_transactions": (
        "fct_transactions",
        [
            "transaction_id",
            "company_id",
            "vendor_id",
            "transacted_at",
            "amount_usd",
            "risk_tier",
            "final_risk_score",
            "risk_flag",
        ],
        ["transaction_id"],
        {"risk_tier": TIERS},
    ),
    "fraud_alerts": (
        "fraud_alerts",
        ["transaction_id", "company_id", "alert_reason", "final_risk_score"],
        ["transaction_id"],
        {},
    ),
    "company_spend_summary": (
        "company_spend_summary",
        ["transaction_date", "company_id", "total_amount_usd", "risk_flagged_count"],
        [],
        {},
    ),
    "vendor_risk": ("vendor_risk", ["vendor_id", "observed_risk_label"], ["vendor_id"], {"observed_risk_label": TIERS}),
}
CUSTOMERS = {
    "customer_source": ("staged_customers", ["customer_id"], ["customer_id"], {}),
    "order_source": ("staged_customer_orders", ["order_id", "customer_id"], ["order_id"], {}),
    "staged_customers": ("staged_customers", ["customer_id"], ["customer_id"], {}),
}


def _sql(models: dict, checks: dict[str, str]) -> str:
    parts = []
    for name, (query, filled, unique, accepted) in models.items():
        rows = [_rowwise(name, "not_null", c, f"{c} is not null") for c in filled]
        rows += [
            _rowwise(name, "accepted_values", c, f"{c} in ({quoted(values)})", f"{c} is not null") for c, values in accepted.items()
        ]
        rows += [
            f"select '{name}', 'unique', '{c}', cast(count(*) as double), count(*), count(*) = 0 "
            f"from (select {c} from t where {c} is not null group by 1 having count(*) > 1)"
            for c in unique
        ]
        parts.append(f"select * from (with t as ({checks[query]}) " + " union all ".join(rows) + ")")
    return " union all ".join(parts)


# made row by row from rows that all suites share, so reading them again costs little
_FROM_SHARED = {
    "closed_leads",
    "order_items_rollup",
    "dim_sellers",
    "fct_orders",
    "staged_transactions",
    "transactions_enriched",
    "fct_transactions",
    "fraud_alerts",
}


def _results(models: dict, queries: dict, spark, folder):
    """One aggregate per model for all its row tests, and one per unique column.

    Models of one query share its rows, which are written once where more than one test reads
    them, with the tested columns only, unless they are read off `shared` rows.
    """
    tested: dict[str, list] = {}
    for query, filled, unique, accepted in models.values():
        tested.setdefault(query, []).append([*unique, *filled, *accepted])
    passes = {q: sum(1 + len(m[2]) for m in models.values() if m[0] == q) for q in tested}
    rows = {}
    for query, columns in tested.items():
        rows[query] = queries[query](spark, folder).select(*dict.fromkeys(c for some in columns for c in some))
        if passes[query] > 1 and query not in _FROM_SHARED:
            rows[query] = pin(rows[query], "declared")
    parts = []
    for name, (query, filled, unique, accepted) in models.items():
        tests = [*[Q.not_null(c) for c in filled], *[Q.accepted_values(c, values) for c, values in accepted.items()]]
        parts += [Q.run_rowwise(name, rows[query], tests), *[Q.run_unique(name, rows[query], c) for c in unique]]
    return plain(Q.union_results(parts))


for _name, _models, _part in [
    ("declared_marketplace", MARKETPLACE, marketplace),
    ("declared_spend", SPEND, spend),
    ("declared_customers", CUSTOMERS, customers),
]:

    @catalog.add(_name, _sql(_models, _part.catalog.checks))
    def _(spark, folder, models=_models, part=_part):
        with shared_rows():
            return _results(models, part.catalog.queries, spark, folder)


# --- documents of the bank -----------------------------------------------------------------------

_PEOPLE = {"account_holder_name": "c_name", "account_type": nth_sql("c_custkey % 5", [*V.ACCOUNT_TYPES, "joint"]), "bank_id": "c_nationkey"}
_SHOPS = {"account_holder_name": "s_name", "account_type": nth_sql("s_suppkey % 4", V.ACCOUNT_TYPES), "bank_id": "s_nationkey"}
ACCOUNTS = [
    S.Standin("customer", {**S.ACCOUNTS_C.columns, **_PEOPLE}),
    S.Standin("supplier", {**S.ACCOUNTS_M.columns, **_SHOPS}),
]
MERCHANTS = S.Standin(
    "supplier",
    {
        "merchant_id": "s_suppkey",
        "merchant_name": "case when s_suppkey % 40 = 3 then null else s_name end",
        "merchant_type": nth_sql("s_suppkey % 7", [*V.MERCHANT_KINDS, "kiosk"]),
        "currency": S.ACCOUNTS_M.columns["currency"],
        "account_id": S.ACCOUNTS_M.columns["account_id"],
    },
)
BANKS = S.Standin(
    "nation",
    {
        "bank_id": "n_nationkey",
        "bank_name": "n_name",
        "country": "n_name",
        "transfer_fee": "cast(n_nationkey - 2 as double)",
        "minimum_balance": "cast(n_regionkey as double)",
    },
)
RATES = S.Standin(
    "nation",
    {
        "currency_pair": "n_name || '/USD'",
        "exchange_rate": "cast(n_nationkey as double) / 8",
        "quoted_at": "case when n_nationkey = 4 then null else n_name end",
    },
)
# table: (required, whole numbers, numbers, accepted values, columns of at least 0)
DOCUMENTS = {
    "accounts": (
        ["account_id", "account_holder_name", "account_type", "current_balance", "minimum_balance", "bank_id", "currency"],
        ["bank_id"],
        ["current_balance", "minimum_balance"],
        {"account_type": V.ACCOUNT_TYPES},
        ["current_balance", "minimum_balance"],
    ),
    "merchants": (
        ["merchant_id", "merchant_name", "merchant_type", "currency", "account_id"],
        ["merchant_id", "account_id"],
        [],
        {"merchant_type": V.MERCHANT_KINDS},
        [],
    ),
    "banks": (
        ["bank_id", "bank_name", "country", "transfer_fee", "minimum_balance"],
        ["bank_id"],
        ["transfer_fee", "minimum_balance"],
        {},
        ["transfer_fee", "minimum_balance"],
    ),
    "exchange": (["currency_pair", "exchange_rate", "quoted_at"], [], ["exchange_rate"], {}, ["exchange_rate"]),
}
SOURCES = {"accounts": ACCOUNTS, "merchants": [MERCHANTS], "banks": [BANKS], "exchange": [RATES]}


def _document_sql() -> str:
    parts = []
    for name, (required, whole, numbers, accepted, minimum) in DOCUMENTS.items():
        source = " union all by name ".join(f"select * from {s.sql}" for s in SOURCES[name])
        rows = [_rowwise(name, "required", c, f"{c} is not null") for c in required]
        for kind, columns in (("int", whole), ("double", numbers)):
            rows += [
                _rowwise(name, f"type_{kind}", c, f"try_cast(cast({c} as varchar) as {kind}) is not null", f"{c} is not null")
                for c in columns
            ]
        rows += [_rowwise(name, "accepted_values", c, f"{c} in ({quoted(v)})", f"{c} is not null") for c, v in accepted.items()]
        rows += [_rowwise(name, "minimum", c, f"{c} >= 0", f"{c} is not null") for c in minimum]
        parts.append(f"select * from (with t as ({source}) " + " union all ".join(rows) + ")")
    return " union all ".join(parts)


@catalog.add("document_schemas", _document_sql())
def _(spark, folder):
    """Accounts of customers and merchants, merchants, banks and rates against their document schemas."""
    results = []
    for name, (required, whole, numbers, accepted, minimum) in DOCUMENTS.items():
        first, *rest = [s.frame(spark, folder) for s in SOURCES[name]]
        columns = [c for c in first.columns if all(c in r.columns for r in rest)]
        rows = first.select(*columns)
        for other in rest:
            rows = rows.unionByName(other.select(*columns))
        tests = [
            *[Q.required(c) for c in required],
            *[Q.has_type(c, "int") for c in whole],
            *[Q.has_type(c, "double") for c in numbers],
            *[Q.accepted_values(c, values) for c, values in accepted.items()],
            *[Q.minimum(c, 0) for c in minimum],
        ]
        results.append(Q.run_rowwise(name, rows, tests))
    return plain(Q.union_results(results))


# --- all suites --------------------------------------------------------------------------------------


def _all_suites() -> dict:
    from . import quality

    named = {
        n: f for n, f in quality.catalog.queries.items() if n.startswith("quality_") or n in ("schema_violations", "event_value_sets")
    }
    return {**named, **catalog.queries}


_SUITES = _all_suites()


def _suite_checks() -> str:
    from . import quality

    checks = {**quality.catalog.checks, **catalog.checks}
    return " union all ".join(f"select * from ({checks[n]})" for n in _SUITES)


@catalog.add(
    "quality_overall",
    f"""select bool_and(success) success, count(*) filter (not success) failed_checks, count(*) checks
    from ({_suite_checks()})""",
)
def _(spark, folder):
    """One verdict over all suites."""
    with shared_rows():
        return plain(Q.overall(Q.union_results([suite(spark, folder) for suite in _SUITES.values()])))
