import os
import random

import pytest

from brute import LONG

SF_SMALL = os.environ.get("TABULON_TEST_SF", "/root/testdata/sf0.001")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, row long, k1 long, rejected boolean, pii_kinds string, length int"


@pytest.fixture(scope="session")
def hostile(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and columns named like the operators' own."""
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["of", "the", "stone", "river", "door", "Seven", "light,"]) for _ in range(r.choice([3, 40, 120]))), "en") for i in range(30)]
    rows += [(100, None, "en"), (101, "", "en"), (102, " \n\t ", None), (103, LONG, "en"), (104, LONG, None), (None, "no id here", "en"),
             (None, None, None), (None, "no id here", "en"), (105, "12 34 --", "de"), (106, "😀 naïve ́ text\x00with\x1fmarks", "fr")]
    rows += [rows[0], rows[0], (107, rows[5][1] + " and more", "en"), (0, "another text under a used id", "en")]
    return spark.createDataFrame([(i, t, lang, None, None if t is None else len(t), 1, 2, 3, False, "x", 4) for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
