"""Plain measures and cross-document lines against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from martweave.llm import line_quality as lq
from martweave.llm import scan

from .conftest import blank_words

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")


def measures(text):
    text = text or ""
    ws = blank_words(text)
    windows = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    inside = {j for i in range(len(ws) - 7) if windows[tuple(ws[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if blank_words(x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def normal(line):
    return " ".join(blank_words(line)).translate(FOLD)


def verdicts(rows, documents, share):
    """(id, measures, base_failed, n_left, removed lines, kept) of (id, text, host)."""
    held, sizes = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        whole = normal((text or "").replace("\n", " "))
        for line in (text or "").split("\n"):
            if blank_words(line):
                held[host, normal(line)].add(whole)
                sizes[host].add(whole)
    often = {k for k, v in held.items() if len(v) > documents and len(v) > share * len(sizes[k[0]])}
    done = []
    for i, text, host in rows:
        m = measures(text)
        gone = [at for at, x in enumerate((text or "").split("\n")) if (host, normal(x)) in often]
        left = m[0] - sum(len(blank_words((text or "").split("\n")[at])) for at in gone)
        failed = m[0] < 20 or 100 * m[4] > 30 * m[0]
        done.append((i, m, failed, left, gone, not failed and left >= 20 and left >= 0.5 * m[0]))
    return sorted(done, key=str)


def of_row(r):
    return r.doc_id, tuple(r[m] for m in lq.MEASURES), r.base_failed, r.n_left, r.removed_lines, r.kept


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é#$\n\t1A", max_size=80), min_size=1, max_size=6))
def test_measures_of_any_block(texts):
    data, off = scan.column_bytes(pa.array(texts))
    found, (lines, _, words, at), _ = lq.measure(data, off)
    assert [tuple(int(found[m][i]) for m in lq.MEASURES) for i in range(len(texts))] == [measures(t) for t in texts]
    places = [[k for k, x in enumerate(t.split("\n")) if blank_words(x)] for t in texts]
    assert lines.tolist() == [len(p) for p in places] and at.tolist() == sum(places, [])
    assert words.sum() == np.sum([len(blank_words(t)) for t in texts])


def corpus(odd):
    extra = [(100 + i, f"Shared LINE number 4{i % 7}\n" + " ".join(f"own{i}x{j}" for j in range(25 if i % 3 else 9)) + "\nother\n", f"src{i % 2}") for i in range(40)]
    extra += [(200 + i, "copied text\n" + " ".join(f"c{j}" for j in range(30)), None) for i in range(30)]  # one document by content
    extra += [(None, " ".join(["a b c d e f g h"] * 9), None), (300, "\n\n", "src0"), (301, "x\r\ny\r\nx\r\n", "")]
    return [(r.doc_id, r.text, r.source) for r in odd.collect()] + extra


def test_verdicts_on_odd_rows(spark, odd):
    rows = corpus(odd)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS kept", "'x' AS _lines", "2 AS line").repartition(5)
    for documents, share in ((3, 0.05), (0, 0.0), (10, 0.01)):
        got = lq.judge(docs, line_documents=documents, line_share=share)
        assert got.columns == ["doc_id", "text", "source", "_lines", "line", *lq.ADDED]
        assert sorted(map(of_row, got.collect()), key=str) == verdicts(rows, documents, share)


def test_copies_are_one_document(spark):
    rows = [(i, "the very same line\nand " + "word " * 30, "h") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert lq.judge(docs).where("size(removed_lines) > 0").isEmpty()


def test_clean_cuts_lines_and_keeps_columns(spark, odd):
    rows = corpus(odd)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = lq.clean(docs, line_documents=3, line_share=0.05)
    want = []
    for row in rows:
        (one,) = [v for v in verdicts(rows, 3, 0.05) if v[0] == row[0] and v[1] == measures(row[1])][:1]
        if one[5]:
            want.append((row[0], "\n".join(x for at, x in enumerate(row[1].split("\n")) if at not in one[4]), row[2]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and got.columns == docs.columns
    assert any(text not in [r[1] for r in rows] for _, text, _ in want)


def test_empty_table(spark, nothing):
    assert lq.judge(nothing).count() == 0 and lq.clean(nothing).columns == nothing.columns
