from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """``docs([(id, text), ...])``: a table with the columns of documents."""

    def build(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def store(spark, docs, tmp_path_factory):
    """``store(documents=rows, labels=(schema, rows))``: a folder of tables that queries read."""

    def build(**tables):
        folder = tmp_path_factory.mktemp("tables")
        for name, content in tables.items():
            df = docs(content) if isinstance(content, list) else spark.createDataFrame(content[1], content[0])
            df.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return build


#: Rows that every operator has to take: NULLs, empty and long texts, ties and repeated rows.
ODD_ROWS = [
    (None, "a text without an id"), (0, None), (1, ""), (2, " \n\t "), (3, "x" * 70_000), (4, "word " * 30_000),
    (5, "Some Text"), (6, "some text"), (6, "some text"), (7, "Åß é́   <|endoftext|> \U0001f600"), (8, None),
]
