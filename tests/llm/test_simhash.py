import numpy as np
import xxhash

from martweave.llm import simhash
from martweave.llm.components import components

from .conftest import blank_words, rows


def print_of(text, size=3):
    low = (text or "").encode().lower().decode()
    w = blank_words(low)
    shingles = [" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(marks, radius):
    """Root index of each mark, by comparing all pairs."""
    root = list(range(len(marks)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(marks)):
        for j in range(i + 1, len(marks)):
            if (marks[i] ^ marks[j]).bit_count() <= radius:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(marks))]


def test_odd_rows(odd):
    done = simhash.near_duplicates(odd).collect()
    marks = [print_of(r.text) for r in done]
    assert [r.fingerprint for r in done] == [f"{m:016x}" for m in marks]
    root = groups(marks, 3)
    for r, top in zip(done, root):
        ids = [x.doc_id for x, t in zip(done, root) if t == top and x.doc_id is not None]
        assert r.component_id == min(ids)
    firsts = [root[n] for n, r in enumerate(done) if r.is_first]
    assert sorted(firsts) == sorted(set(root))


    chosen = simhash.one_per_group(odd)
    assert chosen.columns == odd.columns
    firsts = [(r.doc_id, r.text) for r in done if r.is_first]
    assert sorted(firsts, key=str) == sorted([(r.doc_id, r.text) for r in chosen.collect()], key=str)


def test_no_rows(nothing):
    assert simhash.near_duplicates(nothing).collect() == []
    assert simhash.one_per_group(nothing).collect() == []


def near_marks(n, seed):
    random = np.random.default_rng(seed)
    centres = random.integers(0, 1 << 63, n // 10, dtype=np.uint64)
    flips = np.uint64(1) << random.integers(0, 64, (n, 4)).astype(np.uint64)
    marks = random.choice(centres, n)
    for k in range(4):
        marks = np.where(random.random(n) < 0.6, marks ^ flips[:, k], marks)
    return np.unique(marks)


def test_bit_sliced_pairs_are_all_pairs():
    for radius in (0, 1, 2, 3):
        marks = near_marks(700, radius)
        got = {(int(a), int(b)) for i, j in simhash.close_pairs(marks, radius) for a, b in zip(i, j)}
        apart = np.bitwise_count(marks[:, None] ^ marks[None])
        want = {(int(a), int(b)) for a, b in zip(*np.nonzero(apart <= radius)) if a < b}
        assert got == want


def test_groups_with_split_buckets(spark):
    marks = near_marks(900, 9).view(np.int64).tolist()
    df = spark.createDataFrame([(m, n) for n, m in enumerate(marks)], "_mark long, _id long")
    for part in (8192, 5):
        links = components(simhash.links(df, 3, part))
        root = {r.node: r.root for r in links.collect()}
        got = {}
        for m in marks:
            got.setdefault(root.get(m, m), set()).add(m)
        want = {}
        for m, top in zip(marks, groups([m % (1 << 64) for m in marks], 3)):
            want.setdefault(top, set()).add(m)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (7, 6)], "a long, b long")
    found = components(edges).collect()
    assert len(found) == 61 and len({r.root for r in found}) == 1
    assert components(edges.where("a < 0")).collect() == []


def test_long_text_counts_like_its_parts():
    text = "x y z " * 60_000
    assert simhash.fingerprint(simhash._shingle_hashes(text.encode(), 3)) == print_of("x y z " * 60_000)


def test_one_row_for_a_third_of_the_table(spark):
    rows = [(1, "a b c d e f g")] * 100 + [(i, " ".join(f"{i}w{j}" for j in range(30))) for i in range(2, 202)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    chosen = simhash.one_per_group(df)
    assert sorted(tuple(r) for r in chosen.collect()) == sorted(set(rows))
    assert "Window [row_number" not in chosen._jdf.queryExecution().optimizedPlan().toString()
