"""Spread operators against plain loops, with one key holding a large share of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from martweave.operators import quality as Q
from martweave.operators.distinct import with_distinct_counts
from martweave.operators.funds import accept_in_order
from martweave.operators.matching import match_by_rank
from martweave.operators.ranges import range_lookup
from martweave.operators.ranking import page, page_after, page_totals, top_per_group
from martweave.operators.running import next_ids, numbered_by_content, ranked, running_sums
from martweave.operators.upsert import Bucket, directories, merge_upsert, read_stored, store_upsert


@pytest.fixture(scope="module")
def skewed():
    pick = random.Random(5)
    keys = ["hot" if pick.random() < 0.4 else None if pick.random() < 0.1 else f"k{pick.randrange(30)}" for _ in range(3000)]
    return [(k, seq * 3, pick.randrange(1, 500)) for seq, k in enumerate(keys)]


@pytest.mark.parametrize("width", [1, 100, 10**9])
def test_running_sums(spark, skewed, width):
    df = spark.createDataFrame(skewed, "k string, seq bigint, v bigint")
    totals, counts, expected = {}, {}, set()
    for k, seq, v in skewed:
        totals[k] = totals.get(k, 0) + v
        counts[k] = counts.get(k, 0) + 1
        expected.add((k, seq, totals[k], counts[k]))
    got = running_sums(df, ["k"], ["seq"], {"total": F.col("v"), "n": F.lit(1)}, width)
    assert {(r.k, r.seq, r.total, r.n) for r in got.collect()} == expected


def test_ranked_with_ties_on_chunk_column(spark):
    df = spark.createDataFrame([(i // 4, i) for i in range(100)], "room bigint, bed bigint")
    got = ranked(df, [], ["room", "bed"], "r", width=3).collect()
    assert all(row.r == row.bed + 1 for row in got) and len(got) == 100


def test_numbered_by_content(spark):
    rows = [(random.Random(i).randrange(20), f"v{i % 7}") for i in range(2000)]
    got = numbered_by_content(spark.createDataFrame(rows, "a int, b string").repartition(5), ["a", "b"], "n").collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.n)] == sorted(rows)
    assert sorted(r.n for r in got) == list(range(1, 2001))


def test_next_ids(spark):
    df = spark.createDataFrame([(7,), (3,), (900,)], "seq bigint")
    got = {r.seq: r.id for r in next_ids(df, ["seq"], F.lit(998), "TX", 3, "id", width=5).collect()}
    assert got == {3: "TX999", 7: "TX1000", 900: "TX1001"}


def test_match_by_rank_is_first_fit(spark):
    pick = random.Random(3)
    seekers = [(i, pick.choice("ab")) for i in range(200)]
    rooms = [(i, pick.choice("ab"), pick.randrange(4)) for i in range(60)]
    left = {r: c for r, _, c in rooms}
    expected = {}
    for seeker, kind in seekers:
        fit = next((r for r, k, _ in rooms if k == kind and left[r] > 0), None)
        if fit is not None:
            left[fit] -= 1
        expected[seeker] = fit
    beds = [(r, k, b) for r, k, c in rooms for b in range(c)]
    got = match_by_rank(
        spark.createDataFrame(seekers, "s bigint, kind string"), spark.createDataFrame(beds, "room bigint, kind string, bed int"),
        ["kind"], ["s"], ["room", "bed"], ["room"],
    )
    assert {r.s: r.room for r in got.collect()} == expected


@pytest.mark.parametrize("salts", [1, 3])
def test_range_lookup(spark, salts):
    ranges = [(0, 99, "a"), (100, 100, "b"), (300, 5000, "c")]
    values = [0, 50, 99, 100, 101, 299, 300, 4999, 5000, 5001, None]
    expected = {(v, next((n for lo, hi, n in ranges if v is not None and lo <= v <= hi), None)) for v in values}
    got = range_lookup(
        spark.createDataFrame([(v,) for v in values], "v bigint"), spark.createDataFrame(ranges, "lo bigint, hi bigint, name string"),
        "v", "lo", "hi", ["name"], block=64, salts=salts,
    )
    assert {(r.v, r.name) for r in got.collect()} == expected and got.count() == len(values)


def test_wide_ranges_touch_few_blocks(spark):
    ranges = [(0, 10, "a"), (1000, 2**60, "wide"), (2**60 + 1, 2**60 + 70_000, "b"), (-500, -1, "below")]
    values = [0, 10, 11, 999, 1000, 2**40 + 3, 2**60, 2**60 + 1, 2**60 + 70_000, 2**60 + 70_001, -500, -501, -1, 2**62]
    got = range_lookup(
        spark.createDataFrame([(v,) for v in values], "v bigint"), spark.createDataFrame(ranges, "lo bigint, hi bigint, name string"),
        "v", "lo", "hi", ["name"], block=64,
    )
    expected = {(v, next((n for lo, hi, n in ranges if lo <= v <= hi), None)) for v in values}
    assert {(r.v, r.name) for r in got.collect()} == expected and got.count() == len(values)
    none = range_lookup(spark.range(3), spark.createDataFrame([], "lo bigint, hi bigint, name string"), "id", "lo", "hi", ["name"])
    assert [r.name for r in none.collect()] == [None] * 3


def test_distinct_counts_without_expand(spark):
    rows = [(1, "a", "x", 2), (1, "a", "y", 3), (1, "b", "x", 4), (2, None, "x", 1), (2, None, None, 1), (None, "a", "x", 5)]
    df = spark.createDataFrame(rows, "g int, p string, s string, v int")
    got = with_distinct_counts(df, ["g"], {"ps": "p", "ss": "s"}, {"_v": F.sum("v")}, {"v": F.sum("_v")})
    assert {tuple(r) for r in got.collect()} == {(1, 2, 2, 9), (2, 0, 1, 2), (None, 1, 1, 5)}
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def loop_accept(rows):
    left, verdicts = {}, {}
    for account, seq, debit, funds in sorted(rows, key=lambda r: r[1]):
        left.setdefault(account, funds)
        verdicts[(account, seq)] = debit <= left[account]
        if verdicts[(account, seq)]:
            left[account] -= debit
    return verdicts


@pytest.mark.parametrize("seed", [0, 1])
def test_accept_in_order(spark, seed):
    pick = random.Random(seed)
    funds = {f"a{i}": pick.choice([0, -5, 3, 100, 10_000, 10**7]) for i in range(12)}
    funds["hot"] = 200_000
    rows = []
    for seq in range(600):
        account = "hot" if pick.random() < 0.4 else pick.choice(list(funds))
        debit = int(10 ** pick.uniform(0, 5)) + 1
        rows.append((account, seq, debit, funds[account]))
    df = spark.createDataFrame(rows, "account_id string, seq bigint, debit bigint, funds bigint")
    got = accept_in_order(df, width=37)
    assert {(r.account_id, r.seq): r.accepted for r in got.collect()} == loop_accept(rows)


def test_accept_in_order_decides_every_row(spark):
    rows = [("a", i, 1, 10) for i in range(50)] + [("b", 100, 7, 6), ("b", 101, 6, 6), ("b", 102, 1, 6)]
    df = spark.createDataFrame(rows, "account_id string, seq bigint, debit bigint, funds bigint")
    got = accept_in_order(df, 4).collect()
    assert {(r.account_id, r.seq): r.accepted for r in got} == loop_accept(rows) and len(got) == len(rows)


def test_what_is_no_debit_is_refused_and_changes_nothing(spark):
    rows = [("a", 1, 0, 0), ("a", 2, -5, 0), ("a", 3, 3, 0), ("b", 1, None, 9), ("b", 2, 9, 9), ("b", 3, 1, 9), ("c", 1, 1, None)]
    df = spark.createDataFrame(rows, "account_id string, seq bigint, debit bigint, funds bigint")
    got = accept_in_order(df).collect()
    assert {(r.account_id, r.seq) for r in got if r.accepted} == {("b", 2)} and len(got) == len(rows)


DOC = "id string, a int, b string, present array<string>, pos bigint"


def apply_docs(state, docs):
    state = {k: dict(v) for k, v in state.items()}
    for doc_id, a, b, present, _ in sorted(docs, key=lambda d: d[4]):
        row = state.setdefault(doc_id, {"a": None, "b": None})
        row.update({f: v for f, v in (("a", a), ("b", b)) if f in present})
    return {k: (v["a"], v["b"]) for k, v in state.items()}


def test_merge_upsert_applies_in_order(spark):
    state = {"x": {"a": 1, "b": "old"}, "y": {"a": 2, "b": "keep"}}
    docs = [
        ("x", 5, None, ["a"], 1), ("x", None, "new", ["a", "b"], 2), ("z", 9, None, ["a"], 3), ("x", None, "newest", ["b"], 4),
    ]
    current = spark.createDataFrame([(k, v["a"], v["b"]) for k, v in state.items()], "id string, a int, b string")
    got = merge_upsert(current, spark.createDataFrame(docs, DOC), "id", "pos", "present").collect()
    assert {r.id: (r.a, r.b) for r in got} == apply_docs(state, docs)


def test_upsert_without_order_and_with_equal_orders(spark):
    current = spark.createDataFrame([("x", 1, "old")], "id string, a int, b string")
    docs = [("x", 7, None, ["a"], None), ("y", 8, "only", ["a", "b"], None), ("z", 1, "p", ["a", "b"], 4), ("z", 2, None, ["a", "b"], 4)]
    got = merge_upsert(current, spark.createDataFrame(docs, DOC), "id", "pos", "present").collect()
    assert {r.id: (r.a, r.b) for r in got} == {"x": (7, "old"), "y": (8, "only"), "z": (2, "p")}
    docs.append(("x", 5, None, ["a"], 0))
    got = merge_upsert(current, spark.createDataFrame(docs, DOC), "id", "pos", "present").where("id = 'x'").first()
    assert got.a == 5


def test_store_upsert(spark, folder):
    place, schema = f"{folder}/t", "id string, a int, b string"
    assert read_stored(spark, place, schema).count() == 0
    one = [(f"x{i}", i, "p", ["a", "b"], i) for i in range(20)]
    two = [("x1", 2, None, ["a"], 30), ("y", 3, None, ["a"], 31)]
    three = [("y", None, "q", ["b"], 40)]
    for batch in (one, two, two, three):  # one batch is run again
        store_upsert(spark.createDataFrame(batch, DOC), place, schema, "id", "pos", "present", buckets=4)
    store_upsert(spark.createDataFrame([], DOC), place, schema, "id", "pos", "present", buckets=4)
    got = {r.id: (r.a, r.b) for r in read_stored(spark, place, schema).collect()}
    assert got == apply_docs({}, one + two + three)


def _folders(spark, place):
    kept = directories(spark, place)
    return {b.name: b.written for b in kept[max(kept)] if b.rows}


def test_buckets_split_as_the_table_grows(spark, folder):
    place, schema = f"{folder}/grown", "id string, a int, b string"
    told, counts = [], []
    for batch in range(4):
        docs = [(f"k{i}", i * 10 + batch, None, ["a"], batch) for i in range(batch * 40, batch * 40 + 80)]
        told += docs
        store_upsert(spark.createDataFrame(docs, DOC), place, schema, "id", "pos", "present", bucket_rows=25)
        kept = directories(spark, place)
        state = kept[max(kept)]
        counts.append(len(state))
        # the buckets cover every hash once, none is beyond its bound, and their sizes are right
        assert sum(2.0**-b.depth for b in state) == 1 and max(b.rows for b in state) <= 25
        assert sum(b.rows for b in state) == len({d[0] for d in told}) and len(kept) <= 2
        assert {r.id: (r.a, r.b) for r in read_stored(spark, place, schema).collect()} == apply_docs({}, told)
    assert counts[0] >= 4 and counts[-1] > counts[0]


def test_a_batch_writes_only_buckets_it_touches(spark, folder):
    place, schema = f"{folder}/touched", "id string, a int, b string"
    docs = [(f"k{i}", i, "p", ["a", "b"], 0) for i in range(200)] + [(None, 5, "q", ["a"], 0)]
    store_upsert(spark.createDataFrame(docs, DOC), place, schema, "id", "pos", "present", buckets=16)
    before = _folders(spark, place)
    earlier = read_stored(spark, place, schema)
    store_upsert(spark.createDataFrame([("k7", 70, None, ["a"], 1)], DOC), place, schema, "id", "pos", "present")
    after = _folders(spark, place)
    assert len(before) == 16 and [n for n in after if after[n] != before[n]] == [n for n in after if after[n] == 2]
    assert list(after.values()).count(2) == 1
    # the state before the batch is still readable as it was
    assert earlier.where("id = 'k7'").first().a == 7 and earlier.count() == 201
    assert read_stored(spark, place, schema).where("id = 'k7'").first().a == 70


def test_a_batch_that_dies_before_its_directory_leaves_the_table(spark, folder, monkeypatch):
    place, schema = f"{folder}/died", "id string, a int, b string"
    first = spark.createDataFrame([(f"k{i}", i, "p", ["a", "b"], 0) for i in range(50)], DOC)
    second = spark.createDataFrame([(f"k{i}", -i, None, ["a"], 1) for i in range(60)], DOC)
    store_upsert(first, place, schema, "id", "pos", "present", bucket_rows=20)
    rows = sorted(read_stored(spark, place, schema).collect())
    with monkeypatch.context() as broken:
        # the second batch writes its folders and fails where it makes its directory
        broken.setattr(Bucket, "_replace", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store_upsert(second, place, schema, "id", "pos", "present", bucket_rows=20)
    assert sorted(read_stored(spark, place, schema).collect()) == rows
    store_upsert(second, place, schema, "id", "pos", "present", bucket_rows=20)
    got = {r.id: (r.a, r.b) for r in read_stored(spark, place, schema).collect()}
    assert got == {f"k{i}": (-i, "p" if i < 50 else None) for i in range(60)}


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    got = top_per_group(df, ["g"], [F.desc("id")], 2)
    assert {r.id for r in got.collect()} == {999, 998, 997, 996, 995, 994}
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_pages(spark):
    df = spark.range(25)
    assert [r.id for r in page(df, ["id"], 3, 10).collect()] == [20, 21, 22, 23, 24]
    assert page(df, ["id"], 4, 10).count() == 0
    assert page_totals(df, 10).first().total_pages == 3


def test_pages_go_on_from_the_last_key(spark):
    rows = [(a, b) for a in (None, "x", "y") for b in (None, 1, 2)]
    df = spark.createDataFrame(rows, "a string, b int").repartition(3)
    seen, last = [], None
    while got := page_after(df, ["a", "b"], last, 2).collect():
        seen += [tuple(r) for r in got]
        last = tuple(got[-1])
    assert seen == rows


def test_quality_verdicts(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (2, None, -1.0)], "k int, s string, v double")
    checks = [
        Q.not_null("s"), Q.not_null_proportion("s", 0.6), Q.accepted_values("s", ["a"]), Q.accepted_values("s", ["a"], mostly=0.5),
        Q.between("v", 0, 10), Q.row_count_between(1, 3), Q.mean_between("v", 1, 3), Q.pair_at_least("v", "k", mostly=0.5), Q.minimum("v", -1),
    ]
    got = [(r.unexpected, r.success) for r in Q.run_rowwise("t", df, checks).collect()]
    assert got == [(1, False), (1, True), (1, False), (1, True), (1, False), (0, True), (0, True), (1, True), (0, True)]
    assert Q.run_unique("t", df, "k").first().unexpected == 1
    assert Q.run_unique_proportion("t", df, "k", 1.0, 1.0).first().success is False
    assert Q.run_relationship("t", df, "k", spark.createDataFrame([(1,)], "id int"), "id").first().unexpected == 1
    assert Q.run_singular("none", df.filter("k > 5")).first().success is True
    empty = Q.run_rowwise("t", df.filter("k > 5"), [Q.not_null("s"), Q.mean_between("v", 0, 1)]).collect()
    assert [r.success for r in empty] == [True, False]
    assert Q.duplicate_keys(df, ["k"]).collect()[0].rows == 2


def test_one_scan_per_rowwise_suite(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    results = Q.run_rowwise("orders", df, [Q.not_null("o_orderkey"), Q.between("o_totalprice", 0), Q.row_count_between(0, 10**9)])
    assert results._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
