import random

from martweave.llm import scan, sketch, substring_dedup

from .conftest import DOCS, blank_words, rows


def expected(pairs, length):
    least = {}
    for i, text in pairs:
        w = blank_words(text)
        for p in range(len(w) - length + 1):
            key = tuple(w[p : p + length])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    result = []
    for i, text in pairs:
        w = blank_words(text)
        gone = set()
        for p in range(len(w) - length + 1):
            if i is not None and least[tuple(w[p : p + length])] < i:
                gone |= set(range(p, p + length))
        result.append((i, len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone)))
    return sorted(result, key=str)


def found(df, **options):
    done = substring_dedup.remove_repeats(df, **options)
    return sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in done.collect()], key=str)


def test_odd_rows(odd):
    assert found(odd) == expected([r[:2] for r in rows()], 50)


def test_other_columns_pass_through(odd):
    done = substring_dedup.remove_repeats(odd)
    assert done.columns == [c for c in odd.columns if c != "n_words"] + ["n_words", "n_removed", "kept_text"]
    assert {r._doc for r in done.collect()} == {"d"}


def test_no_rows(nothing):
    assert found(nothing) == []


def test_short_windows_over_random_words(spark):
    random.seed(3)
    pairs = [(i, " ".join(random.choices("ab", k=random.randrange(0, 40)))) for i in range(120)]
    df = spark.createDataFrame([(i, t) for i, t in pairs], "doc_id long, text string").repartition(5)
    assert found(df, length=6, gram=3) == expected(pairs, 6)
    assert found(df, length=1, gram=1) == expected(pairs, 1)


def test_a_full_sketch_changes_nothing(odd, monkeypatch):
    monkeypatch.setattr(sketch, "reached", lambda planes, keys, bits: keys == keys)
    assert found(odd) == expected([r[:2] for r in rows()], 50)


def test_blocks_do_not_change_words():
    import pyarrow as pa

    texts = pa.array([None, "a b", "", "long " * 1000, " x"])
    whole = [
        data[s:e].tobytes()
        for _, _, data, off in scan.blocks(texts, 1 << 20)
        for found in [scan.words(data, off, scan.BLANK_SEPARATED)]
        for s, e in zip(found.start, found.stop)
    ]
    small = [
        data[s:e].tobytes()
        for _, _, data, off in scan.blocks(texts, 3)
        for found in [scan.words(data, off, scan.BLANK_SEPARATED)]
        for s, e in zip(found.start, found.stop)
    ]
    assert whole == small == [b"a", b"b"] + [b"long"] * 1000 + [b"x"]


def test_sketch_never_underestimates(spark):
    import numpy as np

    df = spark.createDataFrame([(i % 700,) for i in range(1000)], "key long").repartition(7)

    def keys(batch):
        for key in batch.column("key").to_pylist():
            yield np.array([key], np.uint64)

    planes = sketch.build(df, keys, 18)
    every = np.arange(2000, dtype=np.uint64)
    flags = sketch.reached(planes, every, 18)
    assert flags[:300].all()  # held twice
    assert flags[300:].mean() < 0.05


def test_sketch_width_is_bounded():
    assert sketch.bits_for(0) == sketch.MIN_BITS
    assert sketch.bits_for(1 << 60) == sketch.MAX_BITS


def test_schema_of_fixture(odd):
    assert odd.schema.simpleString().replace("bigint", "long").startswith("struct<doc_id:long,text:string")
    assert DOCS.startswith("doc_id")
