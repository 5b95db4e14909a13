"""Rows that must not grow with the square of a group, bounds on labels, wide totals, clashing names."""

from __future__ import annotations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import SF_SMALL, awkward, empty, labels, rows, small  # noqa: F401
from pyspark.sql import functions as F

from tripmart.llm import lm, sigtree
from tripmart.llm.labelled import training_rows
from tripmart.llm.mixing import mixed_documents
from tripmart.llm.packed import open_up, squeeze, squeeze_sorted
from tripmart.llm.sigtree import linked_documents, one_of_each_group


def near_copies(spark, n):
    """Texts of 120 words of which each has one word of its own; every two are linked."""
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(words[:60] + [f"own{i}"] + words[60:]) for i in range(n)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("n", [200, 400, 800])
def test_links_of_a_large_group_travel_as_a_forest(spark, monkeypatch, n):
    seen = []
    whole = sigtree.components

    def watched(links, about):
        seen.append(links.count())
        return whole(links, about)

    monkeypatch.setattr(sigtree, "components", watched)
    monkeypatch.setattr(sigtree, "PART_ROWS", 128)
    found = linked_documents(near_copies(spark, n)).collect()
    assert {(r["component_id"], r["n_links"]) for r in found} == {(0, n - 1)}
    parts = -(-n // 128) + 1
    assert seen[0] < n * parts  # not n * (n - 1) / 2


@pytest.mark.parametrize("name", ["awkward", "small", "empty"])
@pytest.mark.parametrize("cell", [sigtree.CELL, 3])
def test_links_equal_their_sql(request, name, cell):
    df = request.getfixturevalue(name)
    connection = duckdb.connect()
    connection.register("documents", df.select("doc_id", "text").toArrow())
    expected = sorted(connection.sql(sigtree.SQL).fetchall(), key=str)
    found = linked_documents(df, cell).select("doc_id", "n_shingles", "component_id", "n_links")
    assert sorted(map(tuple, found.collect()), key=str) == expected


def test_every_pair_has_one_tree_however_trees_are_dealt(spark, small, monkeypatch):
    whole = rows(linked_documents(small))
    monkeypatch.setattr(sigtree, "TOGETHER", 3)
    monkeypatch.setattr(sigtree, "PART_ROWS", 2)
    monkeypatch.setattr(sigtree, "BROADCAST_IDS", 0)
    assert rows(linked_documents(small)) == whole


def test_labels_without_documents_do_not_thin_those_with(spark):
    documents = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    many = spark.range(200_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    learnt = training_rows(documents, many, "toxic", 4, 2, 16_000, 1)
    usable = many.filter("doc_id < 500 AND crc32(cast(doc_id AS string)) % 4 <> 2").count()
    assert learnt.count() == usable


def test_an_id_on_many_rows_is_learnt_from_once(spark):
    documents = spark.range(5000).select(F.lit(6).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    one = spark.createDataFrame([(6, 1)], "doc_id long, toxic int")
    first = training_rows(documents, one, "toxic", 4, 2, 10, 1).collect()
    assert len(first) == 1
    assert training_rows(documents.repartition(3), one, "toxic", 4, 2, 10, 1).collect() == first


def test_totals_beyond_32_bits(spark):
    """Two chunks that each have a word 2.5 thousand million times."""
    keys, counts = np.array([5], np.uint64), np.array([2_500_000_000], "<i8")
    asked = [(c, 0, 1, 1, squeeze_sorted(keys), squeeze(counts)) for c in (0, 1)]
    frame = spark.createDataFrame(asked, "chunk long, bucket int, length int, n long, keys binary, counts binary")

    class Texts:
        """Stands for packed texts whose chunks have asked already."""

        def groupBy(self, *_):
            return self

        def applyInArrow(self, *_):
            return frame

    answers = lm._answers(Texts(), 1, 2, 1).collect()
    assert [open_up(r["counts"], "<i8", 1)[0] for r in answers if r["chunk"] >= 0] == [5_000_000_000] * 2
    assert [r["n"] for r in answers if r["chunk"] < 0] == [5_000_000_000]


HELPERS = ["row", "id", "hash", "origin", "whole", "parts", "rows", "cut", "kept_id", "kept_hash", "worded", "root"]
OLD_HELPERS = ["id_", "source_", "hash_", "whole_", "parts_", "rows_", "cut_", "key_id_", "key_text_", "kept_id_", "kept_text_"]


def test_columns_named_like_helpers_pass_unchanged(spark, small):
    named = small.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id")) for c in (*HELPERS, *OLD_HELPERS, "a.b c")})
    for operator in (mixed_documents, one_of_each_group):
        plain, found = operator(small), operator(named)
        assert found.columns == named.columns
        assert rows(found.select(*small.columns)) == rows(plain)
        wrong = " OR ".join(f"`{c}` <> concat('{c}:', doc_id)" for c in (*HELPERS, *OLD_HELPERS, "a.b c"))
        assert not found.filter(wrong).take(1)
