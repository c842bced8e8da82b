"""Posting of requested bank transactions: funds, conversion, stored rows, ledger legs, balances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..operators.funds import accept_chained, accept_in_order
from ..operators.running import next_ids, running_sums
from ..session import pin

MONEY = "decimal(28,6)"


def _kind(*names: str) -> Column:
    return F.col("transaction_type").isin(*names)


def _parties(requests: DataFrame) -> DataFrame:
    """Which account pays and which receives, by type.  Types outside the list are not posted."""
    primary, secondary, merchant = (
        F.col("primary_account_id"), F.col("secondary_account_id"), F.col("merchant_account_id"),
    )
    debit = F.when(_kind("withdrawal", "transfer", *V.MERCHANT_TYPES), primary).when(
        _kind("cheque deposit", "cheque withdrawal"), secondary
    )
    credit = (
        F.when(_kind("deposit", "cheque deposit"), primary)
        .when(_kind(*V.MERCHANT_TYPES), merchant)
        .when(_kind("transfer"), secondary)
    )
    return requests.filter(_kind(*V.LEDGER_TYPES)).select(
        "seq",
        "transaction_type",
        "timestamp",
        F.col("amount").cast(MONEY).alias("amount"),
        F.when(_kind("deposit"), F.lit(0)).otherwise(F.col("charge")).cast(MONEY).alias("charge"),
        debit.alias("debit_id"),
        credit.alias("credit_id"),
    )


def _account_side(accounts: DataFrame, side: str) -> DataFrame:
    return accounts.select(
        F.col("account_id").alias(f"{side}_id"),
        F.col("currency").alias(f"{side}_currency"),
        F.col("current_balance").cast(MONEY).alias(f"{side}_balance"),
        F.col("minimum_balance").cast(MONEY).alias(f"{side}_minimum"),
        F.lit(True).alias(f"{side}_known"),
    )


def funds_cover(balance: Column, amount: Column, charge: Column, minimum_balance: Column) -> Column:
    """Whether the account keeps its minimum; reaching it exactly is allowed."""
    return balance - amount - charge >= minimum_balance


def prepare(requests: DataFrame, accounts: DataFrame, rates: DataFrame) -> DataFrame:
    """Requests with both accounts, the conversion rate and the amounts either side would book.

    Requests naming an unknown account are dropped, as is a merchant payment without a
    rate; a missing rate for the other types matters only once funds are found.
    """
    rows = (
        _parties(requests)
        .join(_account_side(accounts, "debit"), "debit_id", "left")
        .join(_account_side(accounts, "credit").drop("credit_balance", "credit_minimum"), "credit_id", "left")
    )
    found = (F.col("debit_id").isNull() | F.col("debit_known")) & (F.col("credit_id").isNull() | F.col("credit_known"))
    merchant = _kind(*V.MERCHANT_TYPES)
    converted = (F.col("debit_currency") != F.col("credit_currency")) & _kind(
        "transfer", "cheque deposit", *V.MERCHANT_TYPES
    )
    pair = F.when(merchant, F.concat_ws("/", "credit_currency", "debit_currency")).otherwise(
        F.concat_ws("/", "debit_currency", "credit_currency")
    )
    quoted = rates.select(
        F.col("currency_pair").alias("_pair"), F.col("exchange_rate").cast("decimal(12,6)").alias("_rate")
    )
    rows = (
        rows.filter(F.coalesce(found, F.lit(False)))
        .withColumn("_pair", F.when(F.coalesce(converted, F.lit(False)), pair))
        .join(quoted, "_pair", "left")
        .withColumn("_rate", F.when(F.col("_pair").isNull(), F.lit(1).cast("decimal(12,6)")).otherwise(F.col("_rate")))
    )
    exchanged = (F.col("amount") * F.col("_rate")).cast(MONEY)
    return rows.filter(~merchant | F.col("_rate").isNotNull()).select(
        "seq",
        "transaction_type",
        "timestamp",
        "amount",
        "charge",
        "debit_id",
        "credit_id",
        "debit_currency",
        "credit_currency",
        "debit_balance",
        "debit_minimum",
        F.when(F.col("debit_id").isNotNull(), F.when(merchant, exchanged).otherwise(F.col("amount"))).alias(
            "debit_amount"
        ),
        F.when(F.col("credit_id").isNotNull(), F.when(merchant, F.col("amount")).otherwise(exchanged)).alias(
            "credit_amount"
        ),
        F.col("_rate").isNotNull().alias("has_rate"),
    )


def _posted(prepared: DataFrame, funded: Column) -> DataFrame:
    """Stored rows.  A transfer is stored converted in the receiver's currency when it succeeds."""
    ok = F.col("debit_id").isNull() | funded
    transfer_done = _kind("transfer") & F.col("_ok")
    merchant = _kind(*V.MERCHANT_TYPES)
    return (
        prepared.withColumn("_ok", ok)
        .filter(~F.col("_ok") | F.col("has_rate"))
        .select(
            "seq",
            "transaction_type",
            F.when(merchant, F.col("debit_amount"))
            .when(transfer_done, F.col("credit_amount"))
            .otherwise(F.col("amount"))
            .alias("amount"),
            "charge",
            F.when(transfer_done | _kind("deposit"), F.col("credit_currency"))
            .otherwise(F.col("debit_currency"))
            .alias("currency"),
            F.coalesce("debit_id", F.lit(V.EXTERNAL_PARTY)).alias("sender_account_id"),
            F.when(_kind("withdrawal"), F.lit(V.NO_PARTY))
            .otherwise(F.coalesce("credit_id", F.lit(V.EXTERNAL_PARTY)))
            .alias("receiver_account_id"),
            "timestamp",
            F.when(F.col("_ok"), F.lit("success")).otherwise(F.lit("failed")).alias("status"),
            F.when(~F.col("_ok"), F.lit(V.FAIL_REASON)).alias("reason"),
            "debit_id",
            "credit_id",
            "debit_amount",
            "credit_amount",
        )
    )


BOOKING_DETAIL = ["debit_id", "credit_id", "debit_amount", "credit_amount"]


def post(requests: DataFrame, accounts: DataFrame, rates: DataFrame) -> DataFrame:
    """Every request checked against the stored balance, whatever else is requested in the batch."""
    prepared = prepare(requests, accounts, rates)
    funded = funds_cover(F.col("debit_balance"), F.col("debit_amount"), F.col("charge"), F.col("debit_minimum"))
    return _posted(prepared, funded)


def post_in_order(requests: DataFrame, accounts: DataFrame, rates: DataFrame) -> DataFrame:
    """Requests of an account checked one after the other, each accepted debit lowering the
    funds of later ones.  Credits of the batch count from the next batch on."""
    # the check reads the prepared requests several times: join accounts and rates once
    prepared = pin(prepare(requests, accounts, rates), "requests")
    unit = F.lit(1_000_000)
    debits = prepared.filter(F.col("debit_id").isNotNull()).select(
        F.col("debit_id").alias("account_id"),
        "seq",
        ((F.col("debit_amount") + F.col("charge")) * unit).cast("bigint").alias("debit"),
        ((F.col("debit_balance") - F.col("debit_minimum")) * unit).cast("bigint").alias("funds"),
    )
    verdicts = accept_in_order(debits).select("seq", F.col("accepted").alias("_accepted"))
    return _posted(prepared.join(verdicts, "seq", "left"), F.coalesce("_accepted", F.lit(False)))


def post_chained(requests: DataFrame, accounts: DataFrame, rates: DataFrame) -> DataFrame:
    """Requests handled one after the other in `seq` order: both balances of a request are written
    before the next one is checked, so deposits and transfers of the batch can be spent."""
    prepared = pin(prepare(requests, accounts, rates), "requests")
    unit = F.lit(1_000_000)

    def smallest(amount: Column) -> Column:
        return (amount * unit).cast("bigint")

    # a request without a rate moves nothing, whether it is refused or cannot be converted
    moves = F.when(F.col("has_rate"), F.lit(1)).otherwise(F.lit(0))
    need = smallest(F.col("debit_amount") + F.col("charge"))
    into = F.when(F.col("has_rate"), smallest(F.col("credit_amount"))).otherwise(F.lit(0))
    asked = prepared.select("seq", "debit_id", "credit_id", need.alias("need"), (need * moves).alias("out"), into.alias("into"))
    funds = accounts.select(
        "account_id",
        smallest(F.col("current_balance").cast(MONEY) - F.col("minimum_balance").cast(MONEY)).alias("funds"),
    )
    verdicts = accept_chained(asked, funds).select("seq", F.col("accepted").alias("_accepted"))
    return _posted(prepared.join(verdicts, "seq", "left"), F.coalesce("_accepted", F.lit(False)))


def stored_rows(posted: DataFrame, last_number: int = 0) -> DataFrame:
    """Posted rows as stored, with ids continuing after `last_number`."""
    # numbering reads its input twice
    numbered = next_ids(pin(posted, "posted"), ["seq"], F.lit(last_number), "TX", 9, "transaction_id")
    return numbered.select(
        "transaction_id",
        "transaction_type",
        "amount",
        "charge",
        "currency",
        "sender_account_id",
        "receiver_account_id",
        "timestamp",
        "status",
        "reason",
    )


def last_transaction_number(stored: DataFrame) -> int:
    """Highest number among stored ids, 0 when there are none."""
    number = F.regexp_replace("transaction_id", "^TX", "").cast("bigint")
    return stored.agg(F.coalesce(F.max(number), F.lit(0)).alias("n")).first()["n"]


def legs(posted: DataFrame) -> DataFrame:
    """Signed account movements of the successful rows: one or two per row."""
    both = F.array_compact(
        F.array(
            F.when(
                F.col("debit_id").isNotNull(),
                F.struct(
                    F.col("debit_id").alias("account_id"),
                    (-(F.col("debit_amount") + F.col("charge"))).cast(MONEY).alias("signed_amount"),
                ),
            ),
            F.when(
                F.col("credit_id").isNotNull(),
                F.struct(
                    F.col("credit_id").alias("account_id"), F.col("credit_amount").alias("signed_amount")
                ),
            ),
        )
    )
    return posted.filter(F.col("status") == "success").select("seq", F.inline(both))


def balances(accounts: DataFrame, movements: DataFrame) -> DataFrame:
    """Accounts with the net movement and the new balance."""
    net = movements.groupBy("account_id").agg(F.sum("signed_amount").alias("net_change"))
    change = F.coalesce(F.col("net_change"), F.lit(0)).cast(MONEY)
    return accounts.join(net, "account_id", "left").select(
        "account_id",
        "currency",
        "current_balance",
        change.alias("net_change"),
        (F.col("current_balance").cast(MONEY) + change).alias("new_balance"),
    )


def running_balances(accounts: DataFrame, movements: DataFrame) -> DataFrame:
    """Balance after each movement, in request order, for accounts of any size."""
    # a running sum reads its input twice
    running = running_sums(pin(movements, "movements"), ["account_id"], ["seq"], {"_moved": F.col("signed_amount")})
    start = accounts.select("account_id", F.col("current_balance").cast(MONEY).alias("_start"))
    return running.join(start, "account_id", "inner").select(
        "account_id",
        "seq",
        "signed_amount",
        (F.col("_start") + F.col("_moved")).cast(MONEY).alias("balance_after"),
    )
