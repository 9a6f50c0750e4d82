import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, stem: str = "w") -> str:
    draw = random.Random(seed)
    return " ".join(f"{stem}{draw.randrange(4000)}" for _ in range(n))


AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "src1", 0),
    (3, " \t\n ", "en", "", 4),
    (4, "One", "en", "src2", 3),
    (5, "\u0000 \U0001F600 ßİ ퟿", "de", "src2", 8),
    (6, words(6, 120), "en", "src3", None),
    (6, words(6, 120), "en", "src3", None),          # a repeated row
    (7, words(6, 120).upper(), "en", "src11", None),  # an equal text but for case
    (8, words(6, 120) + " tail", None, "src12", None),
    (None, words(6, 120), "fr", "src4", None),
    (None, None, None, None, None),
    (9, "x" * 200_000, "en", "src5", 200_000),
    (10, words(10, 30_000), "en", "src6", None),
    (11, "\n" * 5000, "en", "src7", None),
]


@pytest.fixture
def docs_of(spark):
    """A documents frame from (doc_id, text[, lang, source]) rows."""
    def make(rows):
        return spark.createDataFrame([(*r, *(None,) * (5 - len(r)))[:5] for r in rows], SCHEMA)
    return make


@pytest.fixture
def awkward(spark, docs_of):
    """Nulls, empty and very long texts, repeated rows and columns whose names clash with those that operators use."""
    df = docs_of(AWKWARD)
    for name in ("file", "row", "digest", "normal", "kept", "class", "node", "places", "whole", "marked", "n_removed", "key", "label",
                 "score", "lang_pred", "domain", "tokens", "mix_copies", "pos", "seed", "a", "b", "item_id", "_metadata"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


@pytest.fixture
def nothing(docs_of):
    return docs_of([])


@pytest.fixture
def on_disk(tmp_path):
    """A frame as a Parquet table that queries and streams can read."""
    def write(df, name="documents"):
        path = f"{tmp_path}/{name}.parquet"
        df.coalesce(2).write.mode("overwrite").parquet(path)
        return path
    return write
