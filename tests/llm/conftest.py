import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside, as extra columns of their input.
CLASHES = ("id", "key", "cls", "n", "kind", "gram", "size", "shard", "slot", "copy", "score", "predicted", "pii", "part",
           "base", "items", "spans", "n_words", "n_hit", "rank", "label", "lang_pred", "rate", "low", "marks", "version")


def prose(seed: int, n: int, pool: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and long texts, copies, near copies, repeated rows, odd characters."""
    base, other = prose(1, 120), prose(2, 90)
    near = base.split()
    near[60] = "changed"
    long = prose(3, 30_000, 5000)
    rows = [
        (1, base), (2, base), (3, " ".join(near)), (4, other), (5, other.upper()), (6, None), (7, ""), (8, " \n\t "),
        (9, "one two"), (10, "One two"), (11, "one two"), (12, long), (13, long + " tail"), (14, prose(4, 13)),
        (15, prose(5, 20) + " " + prose(4, 13) + " " + prose(6, 20)), (16, "a a a a a a a a a a a a a a a a a a a a"),
        (17, "b a a a a a a a a a a a a a a a a c"), (18, "é 😀 naïve ß mail a@b.co, 10.0.0.1 +1 (555) 123-4567 4539148803436467"),
        (19, "\x00\x1f odd \x7f bytes"), (20, base + "\n" + other),
    ]
    return [(i, t, "en" if i % 2 else None, "hot" if i % 3 else None, len(t) if t else None) for i, t in rows]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The edge rows, one of them twice, with extra columns of clashing names."""
    df = spark.createDataFrame([*edge_rows, edge_rows[0]], DOCS)
    for name in CLASHES:
        df = df.withColumn(name, df.n_chars.cast("string"))
    return df


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
