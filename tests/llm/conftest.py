import pytest


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use themselves."""

    def make(rows, partitions=3):
        extra = "text_hash string, line_no string, fp string, component_id string, score string, tokens string, others string, n_chars long"
        full = [(i, t, "en", "src", "x", "y", "z", "c", "s", "t", "o", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, {extra}").repartition(partitions)

    return make
