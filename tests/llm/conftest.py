from __future__ import annotations

import re

import pytest

from docroll.llm.ship import ship

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, `_doc_key` string, shard string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship(spark)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str) -> str:
    return text.translate({i: i + 32 for i in range(65, 91)})


PASSAGE = " ".join(f"shared{i} passage{i * 7 % 13}" for i in range(40))
LINE = "A line that many documents have in common, word for word, as it is."


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, a long text, ties, repeated
    rows, near copies, and columns whose names clash with internal ones."""
    base = " ".join(f"w{i}" for i in range(120))
    rows = [
        (1, base, "en", "a", 5), (2, base, "en", "a", 5), (3, base.replace("w60", "other"), "en", "b", 5),
        (4, base.replace("w5 ", "x5 ").replace("w100", "y"), "de", None, 1),
        (5, "", "en", "a", 0), (6, None, None, None, None), (None, "no id here but some words to read", "en", "c", 3),
        (7, " \t\n ", "fr", "b", 4), (8, "short", "fr", "b", 5), (9, "short", "fr", "é", 5), (10, "SHORT", "fr", "z", 5),
        (11, "\n".join([LINE, "own line eleven", PASSAGE, LINE.upper(), ""]), "en", "a", 9),
        (12, "before " + PASSAGE + " behind\n" + LINE + "  ", "en", "a", 9),
        (13, "q" * 1500 + "\n" + LINE, "en", "\U0001f600", 9), (14, "äöü " * 700 + " " + PASSAGE, "de", "b", 9),
        (15, "long " + " ".join(f"tok{i % 977} {i}" for i in range(9000)), "en", "b", 9), (16, None, "en", "d", 2),
        (17, "word " * 300 + PASSAGE, "en", "d", 2), (18, "\x00\x01 odd \x7f bytes", "es", "d", 2),
    ]
    rows += [(20 + i, f"{LINE}\nnumber {i} has its own words {i * 31}\n{base if i % 3 == 0 else ''}", "es", "hot", 9) for i in range(24)]
    rows += [rows[0], rows[0], rows[3]]  # repeated rows
    return [(*r, 7, "x", "y") for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
