"""Small tables with nulls, empty and very long texts, ties, repeated rows and clashing columns."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _doc string, _id long, score string, n_words string"


def words(low, high, stem="w"):
    return " ".join(f"{stem}{i}" for i in range(low, high))


def rows():
    shared = words(0, 60, "s")
    texts = [
        (1, f"{words(0, 30)} {shared} {words(30, 40)}"),
        (2, f"{shared} tail"),
        (3, f"head\t{shared}\n{words(100, 170)}"),
        (4, f"{words(100, 170)} end"),
        (5, None),
        (6, ""),
        (7, " \n "),
        (8, "x " * 30_000),  # very long, one word over and over
        (9, "short text"),
        (9, "short text"),  # the same row twice
        (10, words(100, 170) + " " + words(100, 170)),
        (11, f"{shared} tail"),
        (None, f"{shared} tail"),
        (None, None),
        (12, "é ß ñ — ünïcode " * 20),
        (13, "ONE two Three"),
        (14, "one TWO three"),
        (2, f"other text of the same id {shared}"),
    ]
    return [(i, t, "en" if i else None, f"src{(i or 0) % 3}" if i != 4 else None, len(t or ""), "d", 7, "s", "n") for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


BLANK = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def blank_words(text):
    return BLANK.findall(text or "")


def folded_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
