import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, `_salt` int, words string"


@pytest.fixture
def documents(spark):
    """A table of documents with columns whose names operators might use themselves."""

    def build(texts, ids=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["s"] * len(texts) if sources is None else sources
        rows = [(i, t, None, s, None, "k", 1, "w") for i, t, s in zip(ids, texts, sources)]
        return spark.createDataFrame(rows, SCHEMA)

    return build


def prose(pick, count, words=None):
    """Invented words; ``words`` limits the vocabulary."""
    letters = "abcdefghiklmnoprstu"
    made = words or ["".join(pick.choice(letters) for _ in range(pick.randint(3, 7))) for _ in range(4000)]
    return " ".join(pick.choice(made) for _ in range(count))
