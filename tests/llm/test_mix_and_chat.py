import hashlib
import math

import pytest
from pyspark.sql import functions as F

from martweave.llm import chat, mixing, places

from .conftest import blank_words, rows


def brute_targets(sizes, weights, share=1.5, most=2.0):
    """Deals the words out by weight; what a full source cannot take is dealt out again."""
    total, target = share * sum(sizes), [0.0] * len(sizes)
    full = set()
    while True:
        left = total - sum(most * sizes[i] for i in full)
        rest = [i for i in range(len(sizes)) if i not in full]
        if not rest:
            break
        level = left / sum(weights[i] for i in rest)
        more = {i for i in rest if weights[i] * level >= most * sizes[i]}
        if not more:
            for i in rest:
                target[i] = weights[i] * level
            break
        full |= more
    for i in full:
        target[i] = most * sizes[i]
    return target


def test_odd_rows(odd):
    docs = rows()
    names = sorted({r[3] for r in docs if r[3] is not None}) + [None]
    sizes = [sum(len(blank_words(r[1])) for r in docs if r[3] == n) for n in names]
    targets = dict(zip(names, brute_targets(sizes, [3.0, 1.0, 2.0, 3.0])))
    done = mixing.mix(odd).collect()
    assert len(done) == len(docs)
    for r in done:
        assert r["size"] == len(blank_words(r.text))
        assert r.source_size == dict(zip(names, sizes))[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
    for name, size in zip(names, sizes):
        expected = targets[name] / size if size else 0.0
        copies = [r.copies for r in done if r.source == name]
        offset = int(hashlib.md5(f"5:{'=' + name if name else ''}".encode()).hexdigest()[:8], 16) / 2**32
        assert sum(copies) == math.floor(len(copies) * expected + offset) - math.floor(offset)
    again = mixing.mix(odd.repartition(5)).collect()
    assert sorted((str(r.doc_id), str(r.text), r.copies) for r in again) == sorted((str(r.doc_id), str(r.text), r.copies) for r in done)


def test_copies_follow_the_running_sum(spark):
    df = spark.createDataFrame([(i, "w " * (i % 7 + 1), f"s{i % 2}") for i in range(200)], "doc_id long, text string, source string")
    done = mixing.mix(df, weights=(1, 3)).collect()
    for source in ("s0", "s1"):
        own = sorted((r for r in done if r.source == source), key=lambda r: (-r["size"], r.doc_id))
        offset = int(hashlib.md5(f"5:={source}".encode()).hexdigest()[:8], 16) / 2**32
        expected, total = own[0].target / own[0].source_size, 0
        for n, r in enumerate(own):
            assert r.copies == math.floor((n + 1) * expected + offset) - math.floor(n * expected + offset)
            total += r.taken
        assert abs(total - own[0].target) <= 14


def test_emitted_rows_are_the_copies_drawn(odd, nothing):
    drawn = mixing.mix(odd).collect()
    rows = mixing.mix_rows(odd)
    assert rows.columns == [*odd.columns, "copy"]
    got = rows.collect()
    for key in {(r.doc_id, r.text) for r in drawn}:
        copies = [r.copies for r in drawn if (r.doc_id, r.text) == key]
        assert sorted(r["copy"] for r in got if (r.doc_id, r.text) == key) == sorted(
            n for c in copies for n in range(1, c + 1)
        )
    assert mixing.mix_rows(nothing).collect() == []


def test_one_row_for_a_third_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(mixing, "_STRETCH", 7, raising=False)
    rows = [(1, "a b c", "x")] * 100 + [(i, f"w{i} " * (i % 5), "xy"[i % 2]) for i in range(2, 202)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    want = sorted((*r[:3], n) for r in mixing.mix(df).select("doc_id", "text", "source", "copies").collect() for n in range(1, r.copies + 1))
    mixed = mixing.mix_rows(df)
    assert sorted(tuple(r) for r in mixed.select("doc_id", "text", "source", "copy").collect()) == want
    # no task holds all equal rows: neither numbered by a window nor gathered in an array
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [row_number" not in plan and "collect_list" not in plan


def test_targets_stop_at_what_a_source_has(spark):
    sizes, weights = [10, 10_000, 500, 0, 77], [3.0, 1.0, 2.0, 3.0, 1.0]
    df = spark.createDataFrame(list(zip(sizes, weights)), "size long, weight double")
    got = sorted((r["size"], r.target) for r in mixing.with_targets(df, 1.5, 2.0).collect())
    assert got == [(s, pytest.approx(t)) for s, t in sorted(zip(sizes, brute_targets(sizes, weights)))]


def test_no_rows_to_mix(nothing):
    assert mixing.mix(nothing).collect() == []


TURNS = [
    (1, 0, "system", "Be kind. <|im_end|>"),
    (1, 1, "ann", "Hi"),
    (1, 2, "bob", None),
    (1, 3, "ann", "x" * 50_000),
    (1, 3, "cy", "same number"),
    (1, None, "bob", "first"),
    (1, 4, None, "who?"),
    (1, 5, " ", ""),
    (2, 0, "user", "q"),
    (2, 1, "assistant", "a\n"),
    (2, 1, "assistant", "a\n"),
    (3, 0, "system", "alone"),
    (None, 0, "user", "no id"),
]


def test_every_participant_has_a_rendering(spark):
    df = spark.createDataFrame([(*t, "c") for t in TURNS], "conv_id long, turn long, role string, text string, segment string")
    done = chat.rotated(df.repartition(3)).collect()
    people = {(r.conv_id, r.participant) for r in done}
    assert people == {(1, "ann"), (1, "bob"), (1, "cy"), (2, "user"), (2, "assistant"), (None, "user")}
    for conv, person in people:
        own = [t for t in TURNS if t[0] == conv]
        own.sort(key=lambda t: (t[1] is not None, t[1] or 0, bool((t[2] or "").strip()), t[2] or "", t[3] or ""))
        text, learned = "", []
        for _, _, role, said in own:
            speaker = role if (role or "").strip() else None
            kind = "system" if speaker == "system" else "assistant" if speaker == person else "user"
            text += f"<|im_start|>{kind}" + (f" name={speaker or 'unknown'}" if kind == "user" else "") + "\n"
            begin = len(text)
            text += (said or "").replace("<|", "< |") + "<|im_end|>"
            if kind == "assistant":
                learned.append((begin, len(text)))
            text += "\n"
        parts = sorted((r for r in done if (r.conv_id, r.participant) == (conv, person)), key=lambda r: r.start)
        assert "".join(r.segment for r in parts) == text
        assert [r.start for r in parts] == [sum(len(x.segment) for x in parts[:n]) for n in range(len(parts))]
        assert [(r.learn_from, r.learn_to) for r in parts if r.learn_from is not None] == learned


def test_one_conversation_and_one_turn_number_for_all(spark, monkeypatch):
    """Rows without id and number, a third of them equal, are cut into blocks all the same."""
    monkeypatch.setattr(places, "BLOCK", 32)
    said = [(None, None, "ab"[i % 2], "same" if i % 3 else "x" * (i % 11)) for i in range(600)]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").repartition(5)
    done = chat.rotated(df).collect()
    for person in "ab":
        parts = sorted((r for r in done if r.participant == person), key=lambda r: r.start)
        want = []
        for _, _, role, text in sorted(said, key=lambda t: (t[2], t[3])):
            head = "<|im_start|>assistant\n" if role == person else f"<|im_start|>user name={role}\n"
            want.append(head + text + "<|im_end|>\n")
        assert [r.segment for r in parts] == want
        assert [r.start for r in parts] == [sum(map(len, want[:n])) for n in range(len(want))]
    # the largest window of rows is a block
    rows = places.in_order(df, ["text"], "probe").withColumn("block", F.floor(F.col(places.PLACE) / places.BLOCK))
    assert rows.groupBy(places.FILE, "block").count().agg(F.max("count")).first()[0] <= 32


def test_no_turns(spark):
    assert chat.rotated(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).collect() == []
