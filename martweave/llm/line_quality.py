"""Quality rules: plain measures of a text, and lines that too many documents of a host share.

*Measures* come from one pass over the words of a text (`measure`): symbols, repeated lines,
words inside repeated windows.

*Cross-document lines.*  A line is normalised (A-Z as a-z, every digit as 0, words joined by
one space) and hashed to 64 bits.  Per host the documents that hold it are counted; documents
of equal normalised words are one document, so copies do not make their own lines common.  A
line held by more than `LINE_DOCUMENTS` documents and by more than `LINE_SHARE` of the host's
documents is removed.  A document that keeps fewer than `MIN_WORDS` words or less than
`LEFT_SHARE` of its words is depleted and rejected.

A hot line is counted from distinct (host, line, document) rows, combined before each shuffle;
a hot host is only ever a part of the key.  The lines above the limits are joined back without
a forced broadcast.

Null and empty texts have no words, fail the base rules and hold no lines.  A null host is a
host of its own.  Repeated rows are judged alike, one result each, and count as one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scan
from .store import KEYS, doc_field, kept, packed, row_keys, unpacked

MIN_WORDS = 20
REPEATED_PERCENT = 30
WINDOW = 8
LINE_DOCUMENTS = 10
LINE_SHARE = 0.01
LEFT_SHARE = 0.5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ADDED = (*MEASURES, "base_failed", "n_left", "removed_lines", "kept")

_U = np.uint64
_ODD = _U(0xD6E8FEB86659FD93)
_NEWLINE = 0x0A
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_NORMAL = scan.LOWER.copy()
_NORMAL[0x30:0x3A] = 0x30
_LAYOUT = "_doc {doc}, _host string, _copy long, _lines array<struct<line:long,words:long,at:long>>, " + ", ".join(
    f"{m} long" for m in MEASURES
)


def _before(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place."""
    return np.concatenate(([0], np.cumsum(flags)))


def _repeats(owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Per element the number of its (owner, key) group's elements."""
    own = scan.mix(keys + (owner.astype(_U) + _U(1)) * _ODD)
    _, group, sizes = np.unique(own, return_inverse=True, return_counts=True)
    return sizes[group]


def _repeated_words(hashes: np.ndarray, first: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Per text the words inside windows that the text holds more than once."""
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) >= WINDOW:
        windows = scan.Prefix(hashes).every(WINDOW)
        whole = np.flatnonzero(owner[: len(windows)] == owner[WINDOW - 1 :])
        often = whole[_repeats(owner[whole], windows[whole]) > 1]
        np.add.at(covered, often, 1)
        np.add.at(covered, often + WINDOW, -1)
    return np.diff(_before(np.cumsum(covered)[:-1] > 0)[first])


def measure(data: np.ndarray, off: np.ndarray) -> tuple[dict, tuple, np.ndarray]:
    """Measures of the texts of a block, their lines and a key of each text's normalised words.

    The lines are (number of lines per text, hash, words, place among the text's lines).
    """
    found = scan.words(data, off, scan.BLANK_SEPARATED)
    first, owner = found.first, scan.owners(found.first)
    raw, normal = scan.Prefix(scan.byte_values(0, False)[data]), scan.Prefix(scan.byte_values(0, False)[_NORMAL][data])
    lengths = (found.stop - found.start).astype(_U) * _ODD
    hashes = scan.mix(raw.span(found.start, found.stop) + lengths)
    folded = scan.Prefix(scan.mix(normal.span(found.start, found.stop) + lengths))

    chars = _before(((data & 0xC0) != 0x80) & scan.BLANK_SEPARATED[data])
    symbols, newlines = _before(_SYMBOLS[data]), _before(data == _NEWLINE)

    # lines that hold a word, by their first word
    line_of_word = newlines[found.start]
    opens = np.ones(len(line_of_word), bool)
    opens[1:] = (line_of_word[1:] != line_of_word[:-1]) | (owner[1:] != owner[:-1])
    low = np.flatnonzero(opens)
    high = np.append(low[1:], len(line_of_word)) if len(low) else low
    text = owner[low]
    ends = np.append(np.flatnonzero(data == _NEWLINE), len(data))
    breaks = np.concatenate(([-1], ends))
    number = line_of_word[low]
    start, stop = np.maximum(breaks[number] + 1, off[text]), np.minimum(ends[number], off[text + 1])
    whole = scan.mix(raw.span(start, stop) + (stop - start).astype(_U) * _ODD)
    lines = np.bincount(text, minlength=len(off) - 1)
    firsts = np.zeros(len(low), bool)
    firsts[np.unique(scan.mix(whole + (text.astype(_U) + _U(1)) * _ODD), return_index=True)[1]] = True
    measures = {
        "n_words": np.diff(first),
        "word_chars": np.diff(chars[off]),
        "n_symbols": np.diff(symbols[off]),
        "n_dup_lines": lines - np.bincount(text[firsts], minlength=len(off) - 1),
        "n_repeat_words": _repeated_words(hashes, first, owner),
    }
    line_hash = scan.mix(folded.span(low, high) + (high - low).astype(_U) * _ODD)
    copy = scan.mix(folded.span(first[:-1], first[1:]) + np.diff(first).astype(_U) * _ODD)
    return measures, (lines, line_hash, high - low, number - newlines[off[text]]), copy


def _task(batches):
    for batch in batches:
        docs, hosts = batch.column("_doc"), batch.column("_host")
        for low, high, data, off in scan.blocks(batch.column("_text")):
            measures, (lines, line, words, at), copy = measure(data, off)
            entries = pa.StructArray.from_arrays(
                [pa.array(line.view(np.int64)), pa.array(words.astype(np.int64)), pa.array(at.astype(np.int64))],
                names=["line", "words", "at"],
            )
            columns = [
                docs.slice(low, high - low),
                hosts.slice(low, high - low),
                pa.array(copy.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(_before(lines).astype(np.int32)), entries),
                *[pa.array(measures[m].astype(np.int64)) for m in MEASURES],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["_doc", "_host", "_copy", "_lines", *MEASURES])


def _frequent(lines: DataFrame, documents: int, share: float) -> DataFrame:
    """(`_host`, `line`) of the lines above both limits."""
    counted = lines.groupBy("_host", "line").agg(F.countDistinct("_copy").alias("_n")).where(F.col("_n") > documents)
    sizes = lines.groupBy("_host").agg(F.countDistinct("_copy").alias("_documents"))
    return counted.join(sizes, "_host").where(F.col("_n") > share * F.col("_documents")).select("_host", "line")


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


def judge(
    docs: DataFrame,
    text_column: str = "text",
    host_column: str = "source",
    carry: list[str] | None = None,
    line_documents: int = LINE_DOCUMENTS,
    line_share: float = LINE_SHARE,
    left_share: float = LEFT_SHARE,
) -> DataFrame:
    """`docs` (or its columns `carry`) with the columns `ADDED`, which replace those of the same name.

    `removed_lines` are the places (from 0, of the text split at line feeds) of the lines above
    the limits, `n_left` the words outside them, `kept` the verdict.
    """
    wanted = docs.select(*[f"`{c}`" for c in carry or docs.columns])
    # the mark before a host's name keeps a null host apart from every other
    host = F.coalesce(F.concat(F.lit("="), doc_field(host_column).cast("string")), F.lit(""))
    both = packed(docs).select("_doc", host.alias("_host"), doc_field(text_column).alias("_text"))
    both = both.withColumn("_doc", F.struct(*[doc_field(c).alias(c) for c in wanted.columns]))
    layout = _LAYOUT.format(doc=both.schema["_doc"].dataType.simpleString())
    # the row numbers are fixed by being written
    measured = kept(both.mapInArrow(_task, layout).withColumn("_row", F.monotonically_increasing_id()), "measured")
    lines = measured.select("_row", "_host", "_copy", F.inline("_lines"))
    removed = (
        lines.drop("_copy").join(_frequent(lines, line_documents, line_share), ["_host", "line"])
        .groupBy("_row")
        .agg(F.sum("words").alias("_gone"), F.sort_array(F.collect_list("at")).alias("removed_lines"))
    )
    judged = (
        measured.drop("_lines", "_host", "_copy").join(removed, "_row", "left")
        .withColumn("n_left", F.col("n_words") - F.coalesce("_gone", F.lit(0)))
        .withColumn("base_failed", _base_failed())
    )
    left = (F.col("n_left") >= MIN_WORDS) & (F.col("n_left") >= left_share * F.col("n_words"))
    judged = judged.withColumn("kept", ~F.col("base_failed") & left).withColumn(
        "removed_lines", F.coalesce("removed_lines", F.array().cast("array<bigint>"))
    )
    return unpacked(judged, wanted, *ADDED)


def _cut(batches):
    for batch in batches:
        texts, gone = batch.column("_text").to_pylist(), batch.column("_removed").to_pylist()
        for nth, places in enumerate(gone):
            if places:
                away = set(places)
                texts[nth] = "\n".join([x for i, x in enumerate(texts[nth].split("\n")) if i not in away])
        columns = [batch.column("_doc"), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["_doc", "_text"])


def clean(docs: DataFrame, text_column: str = "text", host_column: str = "source", **limits) -> DataFrame:
    """The rows of `docs` that are kept, their texts without the lines above the limits."""
    narrow = docs.select(
        *row_keys([F.col(f"`{c}`") for c in docs.columns]),
        F.col(f"`{host_column}`").alias("_host_name"),
        F.col(f"`{text_column}`").alias("_text"),
    )
    judged = judge(narrow, "_text", "_host_name", carry=list(KEYS), **limits).where("kept")
    verdicts = judged.groupBy(*KEYS).agg(F.first("removed_lines").alias("_removed"))
    rows = packed(docs).select("_doc", *row_keys([doc_field(c) for c in docs.columns]))
    joined = rows.join(verdicts, list(KEYS)).select("_doc", "_removed", doc_field(text_column).alias("_text"))
    layout = joined.select("_doc", "_text").schema
    cut = joined.mapInArrow(_cut, layout)
    texts = {text_column: F.col("_text")}
    return cut.select(*[texts.get(c, doc_field(c)).alias(c) for c in docs.columns])


def digest(judged: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return judged.select(
        "doc_id", *MEASURES, "base_failed", "n_left", F.size("removed_lines").cast("long").alias("n_removed_lines"), "kept"
    )
