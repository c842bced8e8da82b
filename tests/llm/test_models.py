"""Language, toxicity and license operators."""

import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from martweave.llm import language, licenses, scan, toxicity

from .conftest import folded_words

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def brute_bits(counts, labels, text, order=3):
    """Code length of a text in each language, byte by byte."""
    result = {}
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    for label in labels:
        bits = 0.0
        for i, byte in enumerate(raw):
            before = (b" " * order + raw[:i])[-order:]
            for k in range(order, -1, -1):
                context = before[len(before) - k :]
                seen = counts.get((label, context), {})
                if seen:
                    total, kinds = sum(seen.values()), len(seen)
                    if byte in seen:
                        bits += math.log2((total + kinds) / seen[byte])
                        break
                    bits += math.log2((total + kinds) / kinds)
            else:
                bits += 8
        result[label] = bits
    return result


def test_code_lengths_match_byte_by_byte_coding():
    texts = [("a", "the cat sat"), ("a", "THE hat"), ("b", "der Hut täte"), ("b", "ä")]
    counts, table = {}, []
    for label, text in texts:
        raw = b"   " + bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
        for k in range(4):
            for i in range(3, len(raw)):
                counts.setdefault((label, raw[i - k : i]), {}).setdefault(raw[i], 0)
                counts[label, raw[i - k : i]][raw[i]] += 1
                gram = int.from_bytes(raw[i - k : i + 1], "big")
                table.append((label, k, gram, 1))
    frame = pd.DataFrame(table, columns=["label", "k", "gram", "n"]).groupby(["label", "k", "gram"], as_index=False).sum()
    model = language.model_of(frame)
    tests = ["the hat", "täte der", "", "zzz", "T", "xä the", "q" * 50]
    data = np.frombuffer("".join(tests).encode(), np.uint8)
    off = np.concatenate(([0], np.cumsum([len(t.encode()) for t in tests])))
    bits = language.text_lengths(model, data, off, language._slots(model.grams[-1]))
    for text, got in zip(tests, bits):
        want = brute_bits(counts, model.labels, text)
        assert got == pytest.approx([want[x] for x in model.labels], rel=1e-4, abs=1e-3)


def test_language_held_out_accuracy(docs):
    model = language.fit(docs.where(language.learnable()))
    held = language.predict(docs.where(~language.learnable()), model).select("lang", "lang_pred", "score").collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_language_counts_every_gram_of_the_sample(spark):
    random = np.random.default_rng(3)
    texts = ["".join(map(chr, random.integers(0x4E00, 0x9FFF, 20_000))) for _ in range(2)]
    model = language.fit(spark.createDataFrame([(i, "zh", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string"))
    raw = [b"   " + t.encode() for t in texts]
    for k in range(4):
        want = {r[i - k : i + 1] for r in raw for i in range(3, len(r))}
        assert len(model.grams[k]) == len(want)
    assert len(model.grams[3]) > 60_000


def test_language_odd_rows(odd, nothing):
    model = language.fit(odd.where(language.learnable()))
    done = language.predict(odd, model).collect()
    assert {r.lang_pred for r in done if not re.search(r"[^\W\d_]", r.text or "")} == {"und"}
    assert {r.lang_pred for r in done if re.search(r"[^\W\d_]", r.text or "")} == {"en"}
    assert language.predict(nothing, model).collect() == []
    untaught = language.fit(nothing)
    assert {r.lang_pred for r in language.predict(odd, untaught).collect()} == {"und"}


def test_language_counts_do_not_use_held_out_rows(spark):
    rows = [(i, "aaa" if i % 2 else "bbb", "x" if i % 2 else "y") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert df.where(language.learnable()).count() < 50
    model = language.fit(df.where(language.learnable()))
    assert model.labels == ["x", "y"]


def brute_subwords(text):
    rows = []
    for w in folded_words(text):
        raw = b"<" + w.encode() + b">"
        for size in toxicity.SIZES:
            for i in range(len(raw) - size + 1):
                gram = int.from_bytes(raw[i : i + size], "little") + (size << 56)
                rows.append(int(scan.mix(np.array([gram], np.uint64))[0]) >> (64 - toxicity.BITS))
        rows.append(scan.text_hash(w) >> (64 - toxicity.BITS))
    return sorted(rows)


def test_subwords():
    texts = ["Hello, idiot! é", "", "a", "ab cd"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    rows, owner = toxicity._subwords(data, off)
    for n, text in enumerate(texts):
        assert sorted(rows[owner == n].tolist()) == brute_subwords(text)


def test_toxicity_held_out(spark, docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.fit(docs, labels.where(language.learnable()))
    again = toxicity.fit(docs.repartition(5), labels.where(language.learnable()).repartition(3))
    assert np.array_equal(model.weight, again.weight)
    held = toxicity.score(docs, model).join(labels.where(~language.learnable()), "doc_id").select("score", "toxic").collect()
    scores, toxic = np.array([r.score for r in held]), np.array([r.toxic for r in held])
    better = (scores[toxic == 1][:, None] > scores[toxic == 0][None]).mean()
    assert better > 0.85


def test_misspelt_words_share_subwords(spark):
    clean = "the river runs along green banks under old stone bridges".split()
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = " ".join(clean[(i + k) % len(clean)] for k in range(8)) + (" disgusting" if bad else " interesting")
        rows.append((i, text))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    test = spark.createDataFrame([(1, "the river disgustng banks"), (2, "the river runs banks")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(test, model).collect()}
    assert got[1] > 0.5 > got[2]


def test_toxicity_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (2, 0), (99, 1), (4, 0)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    done = toxicity.score(odd, model).collect()
    assert all(0 <= r.score <= 1 for r in done) and len(done) == odd.count()
    assert len({r.score for r in done if not folded_words(r.text)}) == 1
    assert toxicity.score(nothing, model).collect() == []
    one_class = toxicity.fit(odd, labels.where("toxic = 0"))
    assert {r.score < 0.5 for r in toxicity.score(odd, one_class).collect()} == {True}
    assert toxicity.fit(nothing, labels).bias < 0


def brute_base(text):
    w = folded_words(text)
    starts, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    ends = (min(starts), max(starts)) if starts else (None, None)
    return (len(w), len(starts), *ends, ",".join(sorted(labels)))


def test_license_base_columns(docs, odd, nothing):
    for df in (docs, odd.drop("n_words"), nothing.drop("n_words")):
        for r in licenses.scan_licenses(df).collect():
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(r.text)
            assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
            assert 0 <= r.score <= 1


def test_license_notices(spark):
    lgpl = next(n for label, n, _ in licenses.NOTICES if label == "lgpl")
    mit = licenses.NOTICES[1][1]
    rows = [
        (1, "filler " * 2000 + lgpl.title() + " more text" * 500),
        (2, mit.replace("documentation", "docs")),
        (3, "permission is hereby granted free of charge, and nothing else of it"),
        (4, "Licensed under CC BY-NC 4.0."),
        (5, "mit license"),
        (6, " ".join(reversed(mit.split()))),
    ]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "gpl,lgpl" and got[1].score == 1.0
    assert got[2].labels == "mit" and 0.9 < got[2].score < 1
    assert got[3].labels == "" and got[3].score == 0
    assert got[4].labels == "cc-by-nc" and got[4].base_labels == ""
    assert got[5].labels == "mit" and got[5].score == 0.5
    assert got[6].labels == ""


def test_license_notices_side_by_side(spark):
    """Each template is found beside each other one, however rare the words of the other are."""
    phrases = {n: p for _, n, p in licenses.NOTICES}
    pairs = [(a, b) for a in phrases for b in phrases if a != b]
    rows = [(i, f"{a} and then x {b}.") for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    label = {n: x for x, n, _ in licenses.NOTICES}
    missed = []
    for r in licenses.scan_licenses(df).collect():
        assert r.score == 1.0
        missed += [(r.doc_id, n) for n in pairs[r.doc_id] if label[n] not in r.labels.split(",")]
    assert missed == []


def test_license_key_phrase_many_times(spark):
    key = "all rights " * 3000 + "reserved "
    rows = [(1, key + licenses.NOTICES[1][1]), (2, "reserved " * 5000), (3, "rights reserved all")]
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "mit,proprietary", 2: "", 3: ""}


def test_learnable_is_the_stated_split(spark):
    import zlib

    df = spark.range(200).select(F.col("id").alias("doc_id")).withColumn("ok", language.learnable())
    assert all(r.ok == (zlib.crc32(str(r.doc_id).encode()) % 5 != 0) for r in df.collect())


def found_by_trying(text, idf):
    """Every template at every place of the file."""
    w, best = folded_words(text), {}
    for label, notice, phrases in licenses.NOTICES:
        n = notice.split()
        must = {f" {notice} "[: f" {notice} ".find(f" {p} ")].count(" ") + i: x for p in phrases for i, x in enumerate(p.split())}
        for start in range(-len(n), len(w)):
            def here(i, start=start):
                return w[start + i] if 0 <= start + i < len(w) else None

            if all(here(i) == x for i, x in must.items()):
                share = sum(idf[x] for i, x in enumerate(n) if here(i) == x) / sum(idf[x] for x in n)
                if share >= licenses.COVER:
                    best[label] = max(best.get(label, 0), share)
    return best


def test_license_labels_and_scores_by_trying_all(spark):
    texts = [f"{a} and then {b}" for _, a, _ in licenses.NOTICES[::3] for _, b, _ in licenses.NOTICES[1::4]]
    texts += [n.replace(" the ", " a ") for _, n, _ in licenses.NOTICES] + [" ".join(n.split()[4:]) for _, n, _ in licenses.NOTICES]
    texts += ["mit license", "the " * 50, "", "reserved all rights all rights reserved"]
    held = {}
    for t in texts:
        for x in set(folded_words(t)):
            held[x] = held.get(x, 0) + 1
    idf = {x: math.log1p(len(texts) / (1 + held.get(x, 0))) for _, n, _ in licenses.NOTICES for x in n.split()}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan_licenses(df).collect():
        want = found_by_trying(r.text, idf)
        base = set(filter(None, r.base_labels.split(",")))
        assert r.labels == ",".join(sorted(base | set(want)))
        assert math.isclose(r.score, max([*want.values(), 0.5 if base else 0.0]), rel_tol=1e-9)


def test_license_rare_words_leave_few_templates_to_compare():
    index = licenses.index_of()
    idf = licenses.rarities(np.ones(len(index.vocabulary)), 100)
    everything = np.arange(len(index.templates))
    (_, mit, _) = licenses.NOTICES[1]
    shuffled = " ".join(sorted(" ".join(n for _, n, _ in licenses.NOTICES).split()))

    def run(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return licenses.align(index, idf, licenses._numbered(index, data, np.array([0, len(data)]))[1], everything)

    # the file holds every word of every template, but only one template stands there
    found, compared = run(f"{shuffled} {mit}")
    assert list(found) == [1] and compared < len(everything) / 2


def test_license_rarity_counts(spark):
    """The same file gets another score where its words are common."""
    isc = next(n for label, n, _ in licenses.NOTICES if label == "isc")
    damaged = isc.replace("copies", "papers")
    others = [isc.split("copies")[0]] * 30

    def score(rest):
        df = spark.createDataFrame(list(enumerate([damaged, *rest])), "doc_id long, text string")
        return licenses.scan_licenses(df).where("doc_id = 0").first().score

    assert score(others) < score(["copies"] * 30)
