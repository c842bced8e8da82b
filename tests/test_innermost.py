"""Nested and overlapping ranges against a scan of all of them."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from martweave.functions.addresses import address_key
from martweave.operators.innermost import innermost

ROWS, RANGES = "id int, v long, label string", "s long, e long, name string, n int"


def brute(value, ranges):
    if value is None:
        return None, None
    held = [(-s, e, name or "", name, n) for s, e, name, n in ranges if s is not None and e is not None and s <= value <= e]
    return min(held, key=lambda r: (r[0], r[1], r[2], r[4]))[3:] if held else (None, None)


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 4), (3, 7), (4, 40)])
def test_equals_a_scan(spark, seed, parts):
    draw = random.Random(seed)
    ranges = [(s, s + draw.choice([0, 3, 40, 400, -1]), f"r{i}", i) for i in range(120) for s in [draw.randrange(-500, 500)]]
    ranges += [(-10_000, 10_000, "all", 0), (5, 5, "twin", 1), (5, 5, "twin", 0), (None, 4, "x", 0), (3, None, "y", 0)]
    # one value has a third of all rows
    values = [draw.choice([5, draw.randrange(-700, 700), draw.choice([None, -(2**63), 2**63 - 1, 10_000])]) for _ in range(300)]
    rows = [(i, v, f"l{i}") for i, v in enumerate(values)] * 2
    got = innermost(spark.createDataFrame(rows, ROWS), spark.createDataFrame(ranges, RANGES), "v", "s", "e", ["name", "n"], parts)
    assert got.columns == ["id", "v", "label", "name", "n"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((*r, *brute(r[1], ranges)) for r in rows), key=str)


def test_empty_sides(spark):
    rows, ranges = spark.createDataFrame([(1, 5, "a"), (2, None, "b")], ROWS), spark.createDataFrame([(1, 9, "r", 0)], RANGES)
    assert innermost(rows, ranges.limit(0), "v", "s", "e", ["name"]).where("name is null").count() == 2
    assert innermost(rows.limit(0), ranges, "v", "s", "e", ["name"]).count() == 0
    assert {r.id: r.name for r in innermost(rows, ranges, "v", "s", "e", ["name"]).collect()} == {1: "r", 2: None}


ADDRESSES = [
    "0.0.0.0", "255.255.255.255", "10.1.2.3", "::", "::1", "1::", "2001:db8::ff00:42:8329", "2001:0DB8:0:0:1:0:0:1", "::ffff:1.2.3.4",
    "64:ff9b::192.0.2.33", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "fe80::", " 8.8.8.8 ",
]
NONE = ["", "x", "1.2.3", "1.2.3.256", "01.2.3.4", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "12345::", "1:2:3:4:5:6:7:8::", ":::", "::1.2.3", "1.2.3.4::", None]


def test_address_keys(spark):
    df = spark.createDataFrame([(a,) for a in ADDRESSES + NONE], "a string").select("a", address_key("a").alias("k"))
    got = {r.a: r.k and bytes(r.k) for r in df.collect()}
    for text in ADDRESSES:
        ip = ipaddress.ip_address(text.strip())
        assert got[text] == (ip.packed if ip.version == 6 else b"\0" * 10 + b"\xff\xff" + ip.packed), text
    assert {a: got[a] for a in NONE} == dict.fromkeys(NONE)


def test_nested_networks(spark):
    nets = ["10.0.0.0/8", "10.1.0.0/16", "10.1.2.0/24", "2001:db8::/32", "2001:db8:1::/48", "::/0"]
    data = [(str(n[0]), str(n[-1]), text) for text in nets for n in [ipaddress.ip_network(text)]]
    ranges = spark.createDataFrame(data, "a string, b string, net string").select(address_key("a").alias("s"), address_key("b").alias("e"), "net")
    asked = {"10.1.2.9": "10.1.2.0/24", "10.1.3.0": "10.1.0.0/16", "10.200.0.1": "10.0.0.0/8", "2001:db8:1::5": "2001:db8:1::/48", "2001:db8:2::": "2001:db8::/32", "9.9.9.9": "::/0", "no": None}
    rows = spark.createDataFrame([(a,) for a in asked], "a string").withColumn("k", address_key("a"))
    assert {r.a: r.net for r in innermost(rows, ranges, "k", "s", "e", ["net"], 3).collect()} == asked
