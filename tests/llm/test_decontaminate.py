from martweave.llm import decontaminate

from .conftest import folded_words, rows, words

ITEMS = [
    (1, words(0, 60, "s")[:120]),
    (2, "short TEXT"),
    (3, "one two three"),
    (4, None),
    (5, " .,; "),
    (None, "x x"),
    (6, "x x x x x x x x x x x"),
    (6, "é ß ñ"),
    (7, f"lead in {words(120, 131)} and out again"),
]


def expected(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = folded_words(text)
        size = min(window, len(w))
        for p in range(len(w) - size + 1) if size and item is not None else ():
            windows.setdefault(tuple(w[p : p + size]), set()).add(str(item))
    result = []
    for i, text in docs:
        w, hit, names = folded_words(text), set(), set()
        for size in {len(x) for x in windows}:
            for p in range(len(w) - size + 1):
                if tuple(w[p : p + size]) in windows:
                    hit |= set(range(p, p + size))
                    names |= windows[tuple(w[p : p + size])]
        result.append((i, len(w), len(hit), sorted(names)))
    return sorted(result, key=str)


def found(docs, items):
    done = decontaminate.occurrences(docs.drop("n_words"), items).collect()
    return sorted(
        [(r._doc.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), list(r["items"])) for r in done], key=str
    )


def test_odd_rows(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert found(odd, items) == expected([r[:2] for r in rows()], ITEMS)


def test_clean_drops_what_is_hit(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = decontaminate.clean(odd, items)
    assert left.columns == odd.columns
    want = [r[0] for r, e in zip(rows(), [expected([r[:2]], ITEMS)[0] for r in rows()]) if not e[2]]
    assert sorted([r.doc_id for r in left.collect()], key=str) == sorted(want, key=str)


def test_no_rows(spark, odd, nothing):
    items = spark.createDataFrame([], "item_id long, text string")
    assert found(nothing, items) == []
    assert all(hit == 0 and not names for _, _, hit, names in found(odd, items))


def test_spans_are_merged(spark):
    docs = spark.createDataFrame([(1, f"a b {words(0, 25)} c {words(3, 15)}")], "doc_id long, text string")
    items = spark.createDataFrame([("i", words(0, 25))], "item_id string, text string")
    row = decontaminate.occurrences(docs, items).first()
    assert [(s.start, s.stop) for s in row.spans] == [(2, 27), (28, 40)]
