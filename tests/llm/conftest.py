import random

import pytest

from quotelake.llm import common

# Column names that the operators use inside.
CLASHES = ["row", "n", "shard", "cls", "anchor", "score", "kept", "component", "keep_id", "digest", "rid", "grp", "batch"]


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    common._importable(spark)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def edge_rows():
    """Nulls, empties, ties, repeated rows, copies, near copies and one long text."""
    rng = random.Random(5)
    base = words(rng, 120)
    changed = base.split()
    changed[7] = "other"
    far = base.split()
    for at in range(0, 120, 4):
        far[at] = f"far{at}"
    long = " ".join([words(rng, 3000, 5000)] * 2)
    texts = [
        None, "", "   \t\n ", "!!! ... 123", "one", "One two", "ONE TWO", "a b c d", "A  B\nC d", base, base.upper(), base,
        " ".join(changed), " ".join(far), long, long + " end", "x" * 1500, "é ü ñ 日本 語", "tail \n", words(rng, 90),
    ]
    rows = [(i, t, ("en", "de", None)[i % 3], f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, "null id", "en", "s", 7), (None, None, None, None, None), (3, "another text", "de", "s", 1)]
    return rows


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(*r, *["clash"] * len(CLASHES)) for r in edge_rows()]
    return spark.createDataFrame(rows, SCHEMA + "".join(f", `{c}` string" for c in CLASHES)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
