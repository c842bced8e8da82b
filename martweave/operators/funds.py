"""Order-dependent funds check: each accepted debit lowers what later debits may use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .running import CHUNK_WIDTH, running_sums


def accept_in_order(debits: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """(account_id, seq, accepted) for `debits`(account_id, seq, debit, funds).

    `debit` and `funds` are integers in the smallest unit; `funds` is the balance above the
    minimum before the first row; `seq` is unique.  A debit is accepted if what earlier
    accepted debits left covers it.  A debit that is null or not positive is no debit: it is
    refused and changes nothing.

    All accounts are decided together in rounds, whatever their size.  In a round with funds
    A, a debit of at most A/2 is small.  Small debits are covered as long as their running sum
    stays within A/2; a larger one is covered only if it fits in A less the small ones before
    it.  The round ends for an account at the first row that is a covered large debit or takes
    the small sum beyond A/2: up to and including that row everything is decided, and at most
    half of A is left.  So there are at most as many rounds as the largest balance has bits,
    and one more; each is a chunked running sum plus a minimum per account.  Rows above the
    remaining funds are refused at once.
    """
    rows = debits.select("account_id", "seq", "debit", "funds")
    open_rows = pin(rows, "funds-open")
    top = open_rows.agg(F.max("funds")).first()[0] or 0
    decided = []
    for _ in range(int(top).bit_length() + 1):
        payable = F.coalesce((F.col("debit") > 0) & (F.col("debit") <= F.col("funds")), F.lit(False))
        fits = open_rows.filter(payable)
        decided.append(open_rows.filter(~payable).select("account_id", "seq", F.lit(False).alias("accepted")))
        small = F.col("debit") * 2 <= F.col("funds")
        walked = running_sums(
            fits.withColumn("_small", small),
            ["account_id"],
            ["seq"],
            {"_sum": F.when(F.col("_small"), F.col("debit")).otherwise(F.lit(0))},
            width,
        )
        covered = F.col("_small") | (F.col("debit") + F.col("_sum") <= F.col("funds"))
        ends = (~F.col("_small") & covered) | (F.col("_small") & (F.col("_sum") * 2 > F.col("funds")))
        walked = pin(walked.withColumn("_covered", covered).withColumn("_ends", ends), "funds-round")
        stops = walked.groupBy("account_id").agg(
            F.min(F.when(F.col("_ends"), F.col("seq"))).alias("_stop"),
            F.min_by(
                F.col("funds") - F.col("_sum") - F.when(F.col("_small"), F.lit(0)).otherwise(F.col("debit")),
                F.when(F.col("_ends"), F.col("seq")),
            ).alias("_left"),
        )
        # this round's verdicts and the next one's rows (twice) are read from here: the rows meet their stops once
        in_round = F.col("_stop").isNull() | (F.col("seq") <= F.col("_stop"))
        marked = pin(
            walked.join(stops, "account_id").select(
                "account_id", "seq", "debit", "_covered", F.col("_left").alias("funds"), in_round.alias("_decided")
            ),
            "funds-marked",
        )
        decided.append(
            marked.filter("_decided").select("account_id", "seq", F.col("_covered").alias("accepted"))
        )
        open_rows = marked.filter("not _decided").select("account_id", "seq", "debit", "funds")
        if open_rows.isEmpty():
            break
    else:
        if not open_rows.isEmpty():
            raise RuntimeError("more rounds than the largest balance has bits")
    result = decided[0]
    for part in decided[1:]:
        result = result.unionByName(part)
    return result


_OPENING = -(1 << 62)


def _opening_legs(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        "account_id",
        F.lit(_OPENING).cast("bigint").alias("seq"),
        F.lit(0).alias("side"),
        F.lit(None).cast("bigint").alias("need"),
        F.col("funds").alias("gain"),
        F.lit(True).alias("known"),
    )


def _legs(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Movements of the accounts that pay at all: the opening funds, then both sides of every request.

    Credits of an account that never pays decide nothing and are left out.
    """
    sound = requests.filter(F.col("debit_id").isNull() | F.col("need").isNotNull())
    paying = sound.filter(F.col("debit_id").isNotNull())
    out = paying.select(
        F.col("debit_id").alias("account_id"), "seq", F.lit(0).alias("side"), "need", (-F.col("out")).alias("gain"),
        F.lit(None).cast("boolean").alias("known"),
    )
    into = sound.filter(F.col("credit_id").isNotNull() & (F.col("into") > 0)).select(
        F.col("credit_id").alias("account_id"), "seq", F.lit(1).alias("side"), F.lit(None).cast("bigint").alias("need"),
        F.col("into").alias("gain"), F.when(F.col("debit_id").isNull(), F.lit(True)).alias("known"),
    )
    payers = paying.select(F.col("debit_id").alias("account_id")).distinct()
    return out.unionByName(into.unionByName(_opening_legs(accounts)).join(payers, "account_id", "left_semi"))


def _verdicts(legs: DataFrame, width: int) -> DataFrame:
    """(seq, accepted) of the open debits that one round decides."""
    gain, is_open = F.col("gain"), F.col("known").isNull()
    settled = F.coalesce(F.col("known"), F.lit(False))

    def where(condition: Column) -> Column:
        return F.when(condition, gain).otherwise(F.lit(0))

    # bounds: no open debit and every open credit goes through, and the reverse
    sums = {"_sure": where(settled), "_least": where(is_open & (gain < 0)), "_most": where(is_open & (gain > 0))}
    bounded = running_sums(legs, ["account_id"], ["seq", "side"], sums, width)
    sure = F.col("_sure") - where(settled)
    lowest = sure + F.col("_least") - sums["_least"]
    highest = sure + F.col("_most")
    is_debit = is_open & F.col("need").isNotNull()
    bounded = bounded.select(
        *legs.columns,
        F.when(is_debit & (F.col("need") <= lowest), F.lit(True)).when(is_debit & (F.col("need") > highest), F.lit(False)).alias("_sound"),
        (F.col("need") * 2 <= sure).alias("_small"),
    )
    bounded = pin(bounded, "funds-bounds")

    # a guess: small debits go through, large ones do not; it holds up to the first that checks otherwise
    guess = F.coalesce("known", "_sound", F.when(is_debit, F.col("_small")), F.lit(False))
    walked = running_sums(bounded, ["account_id"], ["seq", "side"], {"_after": where(guess)}, width)
    checked = F.col("need") <= F.col("_after") - where(guess)
    walked = pin(
        walked.select("account_id", "seq", "need", "known", "_sound", checked.alias("_checked"), (is_debit & (checked != guess)).alias("_ends")),
        "funds-guess",
    )
    stops = walked.groupBy("account_id").agg(
        F.min(F.when(F.col("_ends"), F.col("seq"))).alias("_wrong"),
        F.min(F.when(is_open & F.col("need").isNull(), F.col("seq"))).alias("_credit"),
    )
    reached = F.coalesce(F.col("seq") <= F.col("_wrong"), F.lit(True)) & F.coalesce(F.col("seq") <= F.col("_credit"), F.lit(True))
    decided = walked.filter(is_debit).join(stops, "account_id")
    accepted = F.coalesce("_sound", F.when(reached, F.col("_checked")))
    return decided.select("seq", accepted.alias("accepted")).filter(F.col("accepted").isNotNull())


def _folded(legs: DataFrame) -> DataFrame:
    """The legs of accounts with open debits; what lies before an account's first open leg becomes one.

    Legs and placed legs are each read twice, so both are written once, joins and all.
    """
    legs = pin(legs, "funds-told")
    is_open = F.col("known").isNull()
    firsts = legs.groupBy("account_id").agg(
        F.min(F.when(is_open, F.col("seq"))).alias("_first"),
        F.max(F.when(is_open & F.col("need").isNotNull(), F.col("seq"))).alias("_last"),
    )
    # credits after the last open debit of an account are read by nobody
    placed = legs.join(firsts.filter(F.col("_last").isNotNull()), "account_id").filter(F.col("seq") <= F.col("_last"))
    placed = pin(placed.drop("_last"), "funds-placed")
    before = F.col("seq") < F.col("_first")
    opening = (
        placed.filter(before & F.col("known")).groupBy("account_id").agg(F.sum("gain").alias("funds"))
    )
    rest = placed.filter(~before & F.coalesce(F.col("known"), F.lit(True))).select(*legs.columns)
    return rest.unionByName(_opening_legs(opening))


def accept_chained(requests: DataFrame, accounts: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """(seq, accepted) for every request with a payer, as if all were handled one after the other.

    `requests`: `seq` (unique, integer), `debit_id` and `credit_id` (null: outside the bank), `need`
    (funds the payer must hold), `out` and `into` (what moves if accepted), integers in the smallest
    unit, not negative.  `accounts`: `account_id`, `funds` above the minimum.  An accepted request
    raises the funds of its payee for all later requests (of a request to oneself, `out` counts
    before `into`), and a payee's credit may decide whether
    it can pay a third account: requests are decided in rounds over all accounts at once.

    In a round an open debit is decided if the bounds of its payer's funds say so: it is covered
    even if every earlier open debit goes through and no open credit does, or is not covered even
    the other way round.  Besides, up to an account's first open credit, debits of at most half the
    known funds are guessed to go through and larger ones not to; everything up to and including
    the first debit where the guess and the funds disagree is decided by the funds.  An account
    without credits has at most half its funds left after such a row, so it is done in as many
    rounds as its funds have bits, however many requests it has.  The earliest open request is
    decided in every round, so rounds end; they follow the longest chain of requests that the
    bounds leave open.

    A request whose `need` is null is given no verdict and moves nothing.

    A round is two chunked running sums and a join by `seq`; settled legs before an account's first
    open one are folded into one, and accounts without open debits leave.
    """
    legs = pin(_folded(_legs(requests, accounts)), "funds-legs")
    decided = []
    while not legs.isEmpty():
        verdicts = pin(_verdicts(legs, width), "funds-verdicts")
        if verdicts.isEmpty():
            raise RuntimeError("no request could be decided: seq must be unique and amounts not null")
        decided.append(verdicts)
        told = legs.join(verdicts, "seq", "left").withColumn("known", F.coalesce("known", "accepted")).drop("accepted")
        legs = pin(_folded(told.select(*legs.columns)), "funds-legs")
    result = requests.sparkSession.createDataFrame([], "seq bigint, accepted boolean")
    for part in decided:
        result = result.unionByName(part)
    return result
