import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table shaped like documents, with clashing and null columns."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        schema = T.StructType.fromDDL("doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, id bigint, root bigint, score string")
        return spark.createDataFrame([(i, t, None, "s", len(t or ""), None, 7, None, "x") for i, t in zip(ids, texts, strict=True)], schema)

    return make


#: Null, empty, blank and odd texts that no operator may trip over.
ODD = [None, "", " \n\t ", "a", "\n\n", "é日本 🙂", "x" * 70_000, "the " * 20_000, "token=" + "=" * 500]
