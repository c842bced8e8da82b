"""The registered queries against their SQL, and the pipeline stage by stage."""

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from martweave.llm import language, mixing
from martweave.llm.queries import CHECKS, QUERIES

from .conftest import blank_words, folded_words
from .test_decontaminate import expected as benchmark_hits
from .test_simhash import groups, print_of
from .test_substring_dedup import expected as without_repeats

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_against_sql(spark, duck, name):
    _, count, text = compare(spark, duck, SMALL, name)
    assert not text and count


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in CHECKS])
def test_query_has_a_row_per_input_row(spark, name):
    done = QUERIES[name](spark, SMALL)
    if name not in ("op3_nearest_neighbours", "op12_whitening"):
        assert done.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert done.schema.fieldNames()[0] in ("doc_id", "query_id", "vec_id")


def test_there_is_one_query_per_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    """Each stage against a plain version of itself on what its predecessor kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame(
        [(900003, "".join(chr(0x4E00 + 37 * i % 9000) for i in range(400)), None, "src0", 400), (900001, "12 34 !!", None, "src0", 8), (900002, None, "en", None, 0), (None, "the of and to in was for that", "en", "src1", 29)],
        docs.schema,
    )
    docs = docs.unionByName(odd)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "simhash", "substrings", "benchmark", "mix"]

    first = stages["language"](spark, docs, SMALL)
    assert first.columns == docs.columns
    model = language.fit(docs.where(language.learnable()))
    refused = language.predict(docs, model).where("lang_pred = 'und' or (bits_per_byte - 8) * octet_length(text) > 64")
    assert {r.doc_id for r in refused.select("doc_id").collect()} == {900001, 900002, 900003}
    assert first.count() == docs.count() - 3

    rows = first.collect()
    root = groups([print_of(r.text) for r in rows], 3)
    best = {}
    for r, top in zip(rows, root):
        best.setdefault(top, []).append(r.doc_id)
    want = sorted(min((i for i in ids if i is not None), default=-1) for ids in best.values())
    second = stages["simhash"](spark, first, SMALL)
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in second.collect()) == want

    pairs = [(r.doc_id, r.text) for r in second.collect()]
    third = stages["substrings"](spark, second, SMALL)
    left = []
    for (i, text), (_, n, gone, rest) in zip(sorted(pairs, key=str), without_repeats(pairs, 50)):
        del i, text
        if gone == 0 or gone < n:
            left.append(rest)
    assert sorted(" ".join(blank_words(r.text)) for r in third.collect()) == sorted(left)
    assert all(r.n_chars == len(r.text) for r in third.collect() if r.doc_id is not None)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in third.collect()}
    hits = {i for i, _, n, _ in benchmark_hits(list(texts.items()), items) if n}
    fourth = stages["benchmark"](spark, third, SMALL)
    assert {r.doc_id for r in fourth.collect()} == set(texts) - hits
    assert all(folded_words(r.text) for r in fourth.collect())

    last = stages["mix"](spark, fourth, SMALL)
    copies = {r.doc_id: r.copies for r in mixing.mix(fourth).collect()}
    got = {r.doc_id: r.n for r in last.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == {i: n for i, n in copies.items() if n}


def test_pipeline_runs_whole(spark):
    done = corpus_pipeline.run(spark, SMALL)
    assert done.count() > 0 and done.columns[-1] == "copy"
