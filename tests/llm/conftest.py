import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, fp long, row long, "
    "score double, key string, taken string, src int, words string"
)
CLASH = (1, 2, 3, 0.5, "k", "t", 7, "w")
SYLLABLES = "an be co du el fi go hu in ja ke lo mu na or pi qu ra so tu".split()


def sentence(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def sentence_of():
    return sentence


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty, blank and very long texts,
    repeated rows, and extra columns whose names the operators use."""
    rng = random.Random(3)
    base = [sentence(rng, rng.randint(5, 120)) for _ in range(40)]
    rows = [(k, t, ("aa", "bb", None)[k % 3], ("s1", "s2", "é", None)[k % 4], len(t)) for k, t in enumerate(base)]
    rows += [(100, None, None, None, None), (101, "", "aa", "s1", 0), (102, " \t\n ", "bb", "s2", 4), (103, "123 456 !!", "aa", "s1", 10)]
    rows += [(104, sentence(rng, 60_000), "aa", "s1", 1), (None, base[0], None, "s1", 2), (None, None, None, None, None)]
    rows += [rows[5], rows[5], (105, base[5], "bb", "s2", 9), (-7, "x" * 200_000, None, "s3", 3), (106, "ünïcödé 漢字 😀 text", "bb", None, 5)]
    return spark.createDataFrame([r + CLASH for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
