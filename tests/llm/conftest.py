import pytest

from parcelion.llm.queries import QUERIES


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Writes tables for the queries: ``tables(documents=[...], ...)`` gives a folder."""

    schemas = {
        "documents": "doc_id long, text string, lang string, source string, n_chars long, label string, rank int, n_words long, "
                     "node long, n_lines long, position long, contamination string, component_id long, h long",
        "benchmark": "item_id long, text string, label string",
        "labels": "doc_id long, quality int, toxic int, lang string",
        "conversations": "conv_id long, turn long, role string, text string, conv long",
        "embeddings": "vec_id long, embedding array<float>, label int, cells int, dims int",
    }

    def write(**rows):
        folder = str(tmp_path_factory.mktemp("tables"))
        for name, schema in schemas.items():
            width = schema.count(",") + 1
            full = [tuple(row) + (None,) * (width - len(row)) for row in rows.get(name, [])]
            spark.createDataFrame(full, schema).write.parquet(f"{folder}/{name}.parquet")
        return folder

    return write


@pytest.fixture(scope="session")
def query(spark):
    """Rows of a registered query as dictionaries."""

    def run(name, folder):
        return [row.asDict(recursive=True) for row in QUERIES[name](spark, folder).collect()]

    return run
