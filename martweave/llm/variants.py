"""Spelling variants: words of the corpus grouped under their more frequent near spellings.

*Words.*  Maximal runs of the letters `[A-Za-z]` and U+00C0 to U+00FF, A-Z as a-z.  Where 97
divides the crc32 of `<id>:<run>`, the run loses one letter (`_thinned`).  A word counts from
`MIN_LETTERS` code points and `MIN_COUNT` occurrences in the whole corpus on.  Counts are combined
within a task, up to `HELD` distinct runs at a time, before they are shuffled.

*Reduced alphabet.*  Every letter is hashed to one of a few symbols.  Words one edit apart have
reduced words at most one edit apart.  The full one-edit neighbourhood of every distinct reduced
word (itself, deletions, replacements, insertions) is generated and joined with the reduced
vocabulary; as the relation is symmetric, neighbours that sort before the word are left to the
other side.  Each pair of reduced words that meets is joined with the words behind both, and a
pair counts if the original strings are exactly one edit apart.

The number of symbols follows from the vocabulary: the least of `SYMBOLS` at which words that
reduce alike are few (`CROWD` pairs a word at most, `CLASS` words in one class).  With the last
choice no two letters share a symbol, so a class holds one word and nothing can crowd.  The
choice moves work between the two joins and changes no result.

*Forms.*  A word's form is its near word of largest count (of equally frequent ones the smallest)
if that is at least `RATIO` times its own.  Counts grow along forms, so they end in a root, found
by pointer doubling.

Null and empty texts have no words; a null id counts as an empty text in `<id>:<run>`.  Repeated
rows count as often as they occur.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import forget, kept

MIN_LETTERS = 5
MIN_COUNT = 3
RATIO = 2
THINNING = 97
HELD = 200_000
PIECE = 1 << 20
SYMBOLS = (8, 16, 32, 90)
CROWD = 16
CLASS = 4096

LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)]))
_NAMES = "".join(map(chr, [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]))
_RUN = re.compile(f"[a-z{chr(0xC0)}-{chr(0xFF)}]+")
_GAP = re.compile(f"[^a-zA-Z{chr(0xC0)}-{chr(0xFF)}]")


def _pieces(text: str):
    """The text with A-Z as a-z, in pieces cut between runs."""
    low = 0
    while low < len(text):
        gap = _GAP.search(text, low + PIECE) if low + PIECE < len(text) else None
        high = gap.start() if gap else len(text)
        # on bytes only A-Z are folded
        yield text[low:high].encode().lower().decode()
        low = high


def _thinned(run: str, seed: int) -> str:
    """The run, less one letter where `THINNING` divides its checksum after `<id>:`."""
    checksum = zlib.crc32(run.encode(), seed)
    if checksum % THINNING:
        return run
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def _batch(counts: dict) -> pa.RecordBatch:
    columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def _count(batches):
    counts: dict = {}
    for batch in batches:
        for name, text in zip(batch.column("_id"), batch.column("_text")):
            seed = zlib.crc32(f"{name.as_py() or ''}:".encode())
            for piece in _pieces(text.as_py()):
                for run, n in Counter(_RUN.findall(piece)).items():
                    word = _thinned(run, seed)
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > HELD:
                    yield _batch(counts)
                    counts = {}
    if counts:
        yield _batch(counts)


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(`word`, `n`) of the words of all texts that are long and frequent enough."""
    texts = docs.select(F.col(f"`{id_column}`").cast("string").alias("_id"), F.col(f"`{text_column}`").alias("_text"))
    counted = texts.where("_text is not null").mapInArrow(_count, "word string, n long")
    long_enough = counted.where(F.char_length("word") >= MIN_LETTERS)
    return long_enough.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def symbol_of(letter: str, symbols: int) -> str:
    """The symbol of a letter: a hash, or the letter's own place where there is one for each."""
    at = LETTERS.index(letter) if symbols >= len(LETTERS) else zlib.crc32(f"letter {letter}".encode()) % symbols
    return _NAMES[at]


def reduced(word: Column, symbols: int) -> Column:
    return F.translate(word, LETTERS, "".join(symbol_of(x, symbols) for x in LETTERS))


def neighbourhood(word: str, symbols: str) -> set[str]:
    """All strings over the symbols at most one edit from `word`."""
    near = {word}
    for i in range(len(word) + 1):
        head, tail = word[:i], word[i:]
        near.update([head + x + tail for x in symbols])
        if tail:
            near.add(head + tail[1:])
            near.update([head + x + tail[1:] for x in symbols])
    return near


def _around(symbols: str):
    def task(batches):
        for batch in batches:
            codes = batch.column("_code").to_pylist()
            for low in range(0, len(codes), 512):
                own, near = [], []
                for code in codes[low : low + 512]:
                    later = [x for x in neighbourhood(code, symbols) if x >= code]
                    own += [code] * len(later)
                    near += later
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array(near, pa.string())], names=["_code", "_near"])

    return task


def _choice(words: DataFrame) -> int:
    """The least number of symbols at which few words reduce alike."""
    for symbols in SYMBOLS[:-1]:
        classes = words.groupBy(reduced(F.col("word"), symbols)).count()
        crowd = classes.agg(
            F.sum(F.col("count").cast("double") ** 2).alias("pairs"), F.sum("count").alias("words"), F.max("count").alias("most")
        ).first()
        if not crowd.words or (crowd.pairs <= CROWD * crowd.words and crowd.most <= CLASS):
            return symbols
    return SYMBOLS[-1]


def near_pairs(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """(`a`, `n_a`, `b`, `n_b`): every unordered pair of words exactly one edit apart, once."""
    symbols = symbols or _choice(words)
    coded = words.select("word", "n", reduced(F.col("word"), symbols).alias("_code"))
    # a small table makes many neighbours: its tasks are not to be merged by their input
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    codes = coded.select("_code").distinct()
    names = "".join(sorted({symbol_of(x, symbols) for x in LETTERS}))
    around = codes.repartition(tasks, "_code").mapInArrow(_around(names), "_code string, _near string")
    met = around.join(codes.select(F.col("_code").alias("_near")), "_near")
    left = coded.select("_code", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = coded.select(F.col("_code").alias("_near"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    # within a class each pair is met from both sides
    once = (F.col("_code") < F.col("_near")) | (F.col("a") < F.col("b"))
    pairs = met.join(left, "_code").join(right, "_near").where(once)
    return pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b")


def _rooted(forms: DataFrame) -> DataFrame:
    """(`word`, `root`) for every word that has a form."""
    steps = kept(forms.where("form is not null").select("word", F.col("form").alias("root")), "steps")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        doubled = kept(
            steps.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "steps",
        )
        forget(steps)
        steps = doubled.drop("_moved")
        steps.kept_path = doubled.kept_path
        if doubled.where("_moved").isEmpty():
            return steps


def variants(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """A row per word of a vocabulary (`word`, `n`): its near words, form and root."""
    words = kept(words, "words")
    pairs = near_pairs(words, symbols)
    both = F.inline(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n")),
            F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n")),
        )
    )
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("near"))).alias("_best")
    near = pairs.select(both).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    strong = -F.col("_best.less") >= RATIO * F.col("n")
    forms = kept(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("_best.near")).alias("form"),
            F.when(strong, -F.col("_best.less")).alias("form_n"),
        ),
        "forms",
    )
    forget(words)
    return forms.join(_rooted(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
