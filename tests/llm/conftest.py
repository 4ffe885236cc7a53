import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from awkward_rows import AWKWARD  # noqa: E402

from tillsight.llm.shipping import ship  # noqa: E402


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


#: Columns with the names that operators use inside.
EXTRA = {
    name: "x" for name in (
        "_lost", "_kept", "_of", "row", "lost", "line", "node", "key", "bucket", "score", "tree",
        "n_tokens", "token_ids", "trusted", "component", "lang", "a.b",
    )
}


@pytest.fixture
def documents(spark):
    """Makes a table of (doc_id, text) with columns of clashing names, over several partitions."""

    def make(rows, partitions=3):
        kinds = "doc_id bigint, text string, " + ", ".join(f"`{name}` string" for name in EXTRA)
        table = spark.createDataFrame([(*row, *EXTRA.values()) for row in rows], kinds)
        return table.repartition(partitions)

    return make


@pytest.fixture
def awkward(documents):
    return documents(AWKWARD)
