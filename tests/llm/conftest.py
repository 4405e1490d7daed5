import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents-like table from {doc_id: text} or a list of pairs, with columns that clash with internal names."""
    def make(rows, **extra):
        pairs = list(rows.items()) if isinstance(rows, dict) else list(rows)
        names = {"fp": "int", "key": "string", "role": "string", "length": "int", "blob": "string", "_row": "int", **extra}
        return spark.createDataFrame([(i, t, *[None] * len(names)) for i, t in pairs],
                                     "doc_id long, text string, " + ", ".join(f"`{k}` {v}" for k, v in names.items()))

    return make
