"""The ledger in its true order against a loop over the requests."""

import random

import pytest

from martweave.operators import funds as funds_module
from martweave.operators.funds import accept_chained

REQUEST = "seq long, debit_id string, credit_id string, need long, out long, into long"


def in_turn(requests, accounts):
    left, verdicts = dict(accounts), {}
    for seq, payer, payee, need, out, into in sorted(requests):
        ok = payer is None or (need is not None and need <= left[payer])
        if payer is not None and need is not None:
            verdicts[seq] = ok
        if ok:
            if payer is not None:
                left[payer] -= out or 0
            if payee in left:
                left[payee] += into or 0
    return verdicts


def decided(spark, requests, accounts, **options):
    asked = spark.createDataFrame(requests, REQUEST).repartition(3)
    given = spark.createDataFrame(accounts, "account_id string, funds long")
    rows = accept_chained(asked, given, **options).collect()
    got = {r.seq: r.accepted for r in rows}
    assert len(got) == len(rows)
    return got


def drawn(seed, size, accounts, hot=0.0):
    rng = random.Random(seed)
    names = [f"a{i}" for i in range(accounts)]
    rows = []
    for n in range(size):
        one, other = (names[0] if rng.random() < hot else rng.choice(names)), rng.choice(names)
        amount = rng.randint(0, 300)
        kind = rng.choice("dwttt")
        if kind == "d":
            rows.append((n * 7, None, one, None, None, amount))
        else:
            moved = amount if rng.random() < 0.9 else 0  # no rate: asked, not moved
            rows.append((n * 7, one, other if kind == "t" else None, amount + 1, moved and moved + 1, moved if kind == "t" else None))
    return rows, [(x, rng.randint(-50, 400)) for x in names]


@pytest.mark.parametrize("seed", range(2))
def test_many_accounts(spark, seed):
    requests, accounts = drawn(seed, 50, 8)
    assert decided(spark, requests, accounts, width=64 if seed % 2 else 65536) == in_turn(requests, accounts)


def test_hot_account_and_self_payments(spark):
    requests, accounts = drawn(11, 80, 5, hot=0.5)
    requests += [(5000 + i, "a1", "a1", 40, 40, 39) for i in range(4)]
    assert decided(spark, requests, accounts, width=128) == in_turn(requests, accounts)


def rounds_of(monkeypatch):
    count = []
    real = funds_module._verdicts
    monkeypatch.setattr(funds_module, "_verdicts", lambda *a: count.append(1) or real(*a))
    return count


def test_rounds_of_a_hot_account_follow_its_funds(spark, monkeypatch):
    """Debits that alternate between tiny and just too large, thousands of them on one account."""
    rounds = rounds_of(monkeypatch)
    requests = [(i, "hot", None, 1 if i % 2 else 3000 - i, 1 if i % 2 else 3000 - i, None) for i in range(3000)]
    assert decided(spark, requests, [("hot", 2900)]) == in_turn(requests, [("hot", 2900)])
    assert len(rounds) <= (2900).bit_length() + 1


def test_a_funded_hot_account_takes_one_round(spark, monkeypatch):
    rounds = rounds_of(monkeypatch)
    requests = [(i, "hot", f"to{i % 5}", 5, 5, 5) for i in range(2000)] + [(9000 + i, f"to{i}", "hot", 1000, 1000, 1000) for i in range(5)]
    accounts = [("hot", 10**6), *[(f"to{i}", 0) for i in range(5)]]
    assert decided(spark, requests, accounts) == in_turn(requests, accounts)
    assert len(rounds) <= 2


def test_money_that_is_passed_on(spark):
    """Each account can pay the next only because it was paid first."""
    chain = [(i, f"c{i}", f"c{i + 1}", 10, 10, 10) for i in range(4)]
    accounts = [("c0", 10), *[(f"c{i}", 0) for i in range(1, 5)]]
    assert all(decided(spark, chain, accounts).values())
    assert not any(decided(spark, chain[1:], accounts).values())


def test_nothing_to_decide(spark):
    assert decided(spark, [], [("a", 1)]) == {}
    assert decided(spark, [(1, None, "a", None, None, 5), (2, "a", None, None, None, None)], [("a", 1)]) == {}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rounds_read_what_is_written_and_join_nothing_again(spark):
    """Rows meet the stops of a round, and legs their verdicts, in one join that is written."""
    debits = spark.createDataFrame([(i % 3, i, 40 + i, 200) for i in range(30)], "account_id long, seq long, debit long, funds long")
    verdicts = funds_module.accept_in_order(debits)
    assert "Join" not in _plan(verdicts) and verdicts.count() == 30
    legs = spark.createDataFrame(
        [("a", 1, 0, None, 50, True), ("a", 2, 0, 20, -20, None), ("a", 3, 1, None, 5, True)],
        "account_id string, seq long, side int, need long, gain long, known boolean",
    )
    folded = funds_module._folded(legs)
    assert "Join" not in _plan(folded)
    assert {(r.seq, r.gain, r.known) for r in folded.collect()} == {(funds_module._OPENING, 50, True), (2, -20, None)}
