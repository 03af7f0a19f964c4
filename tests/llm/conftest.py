import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text), with columns of names that operators use themselves."""

    def make(rows, extra=True):
        full = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            df = df.selectExpr(
                "*", "'x' AS score", "1 AS page", "2 AS class", "3 AS token", "4 AS text_key",
                "5 AS text_hash", "6 AS id", "'y' AS row", "7 AS n", "8 AS kept_id", "9 AS bad_id",
            )
        return df.repartition(3)

    return make


SENTENCES = [
    "the river runs past the old mill and the bridge near town",
    "a quiet engine hums under the floor of the long grey hall",
    "seven lamps burn along the wall while rain falls on the roof",
    "every ledger keeps a line for the names of those who left",
    "small boats cross the bay at dawn with nets and baskets",
    "the teacher wrote three words on the board and waited there",
    "cold wind moves over the fields and bends the tall dry grass",
    "two brothers built a shed from planks they found by the road",
]


@pytest.fixture
def sentences():
    return SENTENCES
