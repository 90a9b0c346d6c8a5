import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
SF_BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from turnfold.session import local_session

    session = local_session(cores=8, shuffle_partitions=8)
    yield session


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Rows with nulls in any column, empty, short, long, repeated and tied
    texts, and columns whose names clash with the operators' own."""
    long_text = " ".join(f"word{i % 977} runs{i % 31}" for i in range(30_000))
    texts = [None, "", " \n\t ", "one", "one two", "one two three", "One TWO three", "a b c d e f g h", "a b c d e f g h",
             "éàü ñ 日本", "12345 !!! ###", long_text, long_text, "line\nline\nline\n", "x" * 5000, "    \x1c"]
    rows = [(i if i != 4 else 3, t, ["en", "fr", None][i % 3], ["s", None, "t"][i % 3], None if i == 5 else len(t or ""),
             f"n{i}", i, None if i % 2 else "v") for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, "no key here", "en", None, 1, None, 2, "w")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, node string, size int, root string")


@pytest.fixture(scope="session")
def no_rows(odd_rows):
    return odd_rows.limit(0)
