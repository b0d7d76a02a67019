"""Ids that are no numbers, and extra columns with the names that operators use inside."""

from __future__ import annotations

import numpy as np

from tidemark.llm import decontaminate, exact_dedup, packed_ids, packing, quality
from tidemark.session import scratch_path

SCHEMA = "name string, text string, sha string, maybe int, rank int, tie int, own int, mark int, id int, score double, x string, trusted int"
ROWS = [("b", "Some text here", *[None] * 10), ("a", "some text here", "s", 1, 2, 3, 4, 5, 6, 0.5, "x", 1), (None, None, *[None] * 10)]


def test_exact_copies(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = exact_dedup.drop_copies(df, id_col="name")
    assert kept.columns == df.columns and sorted(str(r.name) for r in kept.select("name").collect()) == ["None", "b"]
    groups = exact_dedup.exact_groups(df, id_col="name").collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in groups) == [("None", "None", 1), ("a", "b", 2), ("b", "b", 2)]


def test_ids_of_texts_are_hashed(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    packed = packing.pack(df, id_col="name").collect()
    folder = scratch_path(spark, "packed")
    read = packed_ids.read_ids(spark, folder, packed_ids.write_ids(df, folder, id_col="name")).collect()
    hashes = {r[0] for r in df.selectExpr("xxhash64(name) as h").where("name is not null").collect()}
    assert {r.doc_id for r in packed} == {r.doc_id for r in read} == hashes | {None}


def test_stages_keep_the_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    labels = spark.createDataFrame([("a", 1, 0), ("b", 0, 0)], "name string, quality int, toxic int").withColumnRenamed("name", "doc_id")
    assert quality.keep_good(df, labels, id_col="name").columns == df.columns
    bench = spark.createDataFrame([("k", "some text here", 1)], "item string, text string, name int")
    clean = decontaminate.drop_contaminated(df, bench, item_id="item")
    assert clean.columns == df.columns and [r.name for r in clean.collect()] == [None]


def test_the_slope_follows_the_clipped_risk(spark, docs):
    """Where the negative part is cut off, fitting still lowers the risk, and the scores stay finite."""
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"word{k}" for k in rng.integers(0, 50, 40)) if i % 2 else "!! ?? " * 20) for i in range(60)]
    df = docs(rows)
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    model, table = quality.train(df, labels)
    for prior in (0.5, 0.9, 0.97):
        fitted = quality.fit(table, prior)
        assert np.isfinite(fitted.weights).all()
        x = np.array([r.x for r in table.where("trusted").select("x").collect()]) if isinstance(table.first().x, list) else None
        if x is not None:
            assert fitted.score(x).mean() > 0.5
