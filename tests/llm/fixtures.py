import random

import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return " ".join("w" + str(draw.randrange(vocabulary)) + draw.choice(["", ".", ",", ""]) for _ in range(n))


def edge_rows():
    """Nulls in any column, empty, blank and long texts, copies, near copies, repeated rows."""
    base = prose(1, 300)
    words = base.split()
    near = " ".join([*words[:150], "changed", *words[151:]])
    far = " ".join([*words[:150], *prose(2, 150).split()])
    texts = [
        (0, base), (1, base.upper()), (2, near), (3, far), (4, None), (5, ""), (6, "  \n\t "), (7, "one two"), (8, "One  two"),
        (9, "one"), (10, prose(3, 40_000, 5000)), (11, base + " " + base), (None, base), (None, None), (12, prose(4, 60)),
        (12, prose(4, 60)), (13, "a " * 200), (14, "é ñ ß 你好 ▁ x\u0000y"), (15, prose(5, 35)), (16, prose(5, 35) + " end"),
    ]
    sources = ["a", "b", None, "c"]
    return [(i, t, "en" if k % 3 else None, sources[k % 4], len(t) if t else None) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCUMENT)


@pytest.fixture(scope="session")
def clashing(edge):
    """With columns named like those that the operators make."""
    from pyspark.sql import functions as F

    made = "size key row block score taken copies threshold n component label shard text_a ids decoded value".split()
    return edge.withColumns({name: F.lit(f"mine {name}") for name in made})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENT)
