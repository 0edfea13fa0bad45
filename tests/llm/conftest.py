import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textloom.session import ship  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


def _odd():
    """Nulls, empty, short, equal, nearly equal and very long texts, with columns named like the operators' own."""
    base = " ".join(f"Word{i % 37}x{i}" for i in range(120))
    near = base.replace("Word5x5 ", "other ")
    shared = " ".join(f"passage{i}" for i in range(40))
    texts = [None, "", " \n\t", "one two", "ONE  two", "One\ntwo", base, base, near, "start " + shared + " end é",
             "another " + shared + " tail ü", "a " * 300, "b " * 300, "é" * 400, "line one\nline one\n\nline one\n$ # *",
             " ".join(f"long{i % 5000}" for i in range(20_000)), "x" * 70_000, base + " " + base]
    return [(i, t, ["s0", "s1", None][i % 3], 7, "n", b"k") for i, t in enumerate(texts)]


ODD_SCHEMA = "doc_id bigint, text string, source string, shard int, kept string, ids binary"


@pytest.fixture(scope="session")
def odd(llm):
    return llm.createDataFrame(_odd(), ODD_SCHEMA)


@pytest.fixture(scope="session")
def none(llm):
    return llm.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    return [(r[0], r[1]) for r in _odd()]


@pytest.fixture(scope="session")
def documents(llm):
    return llm.read.parquet(f"{SF}/documents.parquet")
