"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from martweave.llm import variants as va


def words_of(rows):
    """Words and counts of (id, text), as the contract states them."""
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            total[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected(words):
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    best = {w: min(xs, key=lambda x: (-words[x], x)) for w, xs in near.items() if xs}
    form = {w: x for w, x in best.items() if words[x] >= 2 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items())


def spelled(seed, size, letters="aeélnrstÿ"):
    """Texts of words that chain into one another, with hot words."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 8))) for _ in range(12)]
    texts = []
    for i in range(size):
        ws = []
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(stems[: rng.randint(1, 12)])
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                at = rng.randrange(len(w))
                w = rng.choice((w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:]))
            ws.append(w.upper() if rng.random() < 0.1 else w)
        texts.append((i, " ,-\n"[rng.randrange(4)].join(ws)))
    return texts


@pytest.mark.parametrize("symbols", [2, 8, 90])
def test_all_columns(spark, symbols):
    rows = spelled(symbols, 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = va.variants(va.vocabulary(docs), symbols)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = expected(words_of(rows))
    assert sorted(map(tuple, got.collect())) == want
    assert any(r[1] and r[2] != r[1] for r in want)  # chains of more than one step


def test_vocabulary_of_odd_texts(spark, odd, monkeypatch):
    long = " ".join(f"wörd{'abcdefghij'[i % 10]}" for i in range(20_000))
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    rows += [(500, long), (501, "É" * 5 + " ÉÉÉÉÉ éÉÉÉÉ × ÷÷÷÷÷÷ ſtrange Straße Straße Straße"), (None, "Straße")] + [(502, "again and again")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "'x' AS _text")
    for piece, held in ((va.PIECE, va.HELD), (50, 3)):
        monkeypatch.setattr(va, "PIECE", piece)
        monkeypatch.setattr(va, "HELD", held)
        got = {r.word: r.n for r in va.vocabulary(docs).collect()}
        assert got == words_of(rows)


def test_thinning_happens(spark):
    rows = [(i, "letters " * 3) for i in range(400)]
    got = {r.word: r.n for r in va.vocabulary(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == words_of(rows) and len(got) > 1


def test_neighbourhood_is_full():
    near = va.neighbourhood("abab", "abc")
    everything = {w for n in range(3, 6) for w in _strings("abc", n)}
    assert near == {w for w in everything if w == "abab" or one_edit(w, "abab")}


def _strings(letters, n):
    return [""] if not n else [x + y for x in letters for y in _strings(letters, n - 1)]


def test_symbols_follow_the_vocabulary(spark, monkeypatch):
    alike = "".join([x for x in va.LETTERS if va.symbol_of(x, va.SYMBOLS[0]) == va.symbol_of("a", va.SYMBOLS[0])][:5])
    monkeypatch.setattr(va, "CLASS", 500)
    few = spark.createDataFrame([("words", 3), ("other", 4)], "word string, n long")
    crowd = spark.createDataFrame([("".join(x), 3) for x in _strings(alike, 5)], "word string, n long")
    assert va._choice(few) == va.SYMBOLS[0] < va._choice(crowd)
    assert len({va.symbol_of(x, va.SYMBOLS[-1]) for x in va.LETTERS}) == len(va.LETTERS)


def test_no_words(spark, nothing):
    assert va.variants(va.vocabulary(nothing)).collect() == []
