import pytest

from stratalake.llm.common import ship_library

#: Column names that operators use inside.
CLASHING = ("key", "rank", "part", "cls", "bucket", "root", "size", "source_size", "weight", "target", "answers", "text_hash", "id", "bands", "n")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_library(spark)


@pytest.fixture
def documents(spark):
    """Makes a table of documents with extra columns whose names could clash."""

    def make(rows, schema="doc_id long, text string, source string"):
        width = len(schema.split(","))
        full = [tuple(r) + (None,) * (width - len(r)) for r in rows]
        extra = ", ".join(f"{c} string" for c in CLASHING)
        return spark.createDataFrame([r + ("x",) * len(CLASHING) for r in full], f"{schema}, {extra}")

    return make


#: Null and empty texts, white space, a long text, repeated rows, null ids.
LONG = " ".join(f"word{i % 977} part{i % 1013}" for i in range(60_000))
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "One two"),
    (5, LONG),
    (6, "Ärger über ½ €   😀 ende"),
    (7, "copy of a row"),
    (7, "copy of a row"),
    (None, "no id here"),
    (None, None),
]
