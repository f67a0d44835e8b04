import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from texts or (id, text) pairs, with columns that operators might clash with."""

    def make(texts, extra: bool = False):
        rows = [item if isinstance(item, tuple) else (i, item) for i, item in enumerate(texts)]
        full = [(i, text, "en", f"src{(i or 0) % 3}", len(text or "")) for i, text in rows]
        df = spark.createDataFrame(full, DOCUMENT)
        if extra:
            for name in ("n", "key", "shard", "slot", "label", "node", "body", "rank", "kept", "seeds", "score", "rep"):
                df = df.selectExpr("*", f"'mine' AS {name}")
        return df

    return make
