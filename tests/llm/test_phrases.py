"""Phrase mining against SQL and plain Python."""

from __future__ import annotations

import re
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import SF_SMALL, awkward, empty, labels, rows, small  # noqa: F401
from pyspark.sql import functions as F

from tripmart.llm import phrases
from tripmart.llm.phrases import FOLDED, collocations, mine, words_of

ODD = [
    ("a b a b a b, a b; a b! c\td  e", "x"),
    ("A b A B.\x0ba b\x0c\ra b é É é É é É", None),
    ("a a a a a a a a a a", "x"),
    (" ,.; \t\n", "x"),
    ("", "x"),
    (None, "x"),
    ("a b a b a b, a b; a b! c\td  e", "y"),
    ("   x y z x y z x y z x y z   ", "und"),
]


def expected(df, least):
    connection = duckdb.connect()
    connection.register("documents", df.select("text", "lang").toArrow())
    return sorted(connection.sql(phrases.SQL.replace("f >= 30", f"f >= {least}")).fetchall())


@pytest.mark.parametrize("name, least", [("awkward", 2), ("small", 5), ("small", 30), ("empty", 2)])
def test_phrases_equal_their_sql(request, name, least):
    df = request.getfixturevalue(name)
    assert sorted(map(tuple, collocations(df, least=least).collect())) == expected(df, least)


def test_odd_pieces_and_more_chunks(spark):
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(ODD * 3)], "doc_id long, text string, lang string")
    found = sorted(map(tuple, collocations(df.repartition(5), least=2).collect()))
    assert found and found == expected(df, 2)
    hot = df.withColumns({"n": F.lit(1), "phrase": F.lit("x"), "a": F.lit(1), "chunk": F.lit(7), "word": F.lit("w")})
    assert sorted(map(tuple, collocations(hot, least=2).collect())) == found


def test_the_first_of_each_language(spark, small):
    whole = collocations(small, least=5).collect()
    some = collocations(small, top=3, least=5).collect()
    assert sorted(map(tuple, some)) == sorted(tuple(r) for r in whole if r["rank"] <= 3)


def test_a_phrase_covers_those_inside_it(spark):
    df = spark.createDataFrame([("a b c d. a b c d. a b c d. a b", "x")], "text string, lang string")
    found = {r["phrase"]: (r["a"], r["l"], r["r"], r["score"]) for r in mine(df, least=3).collect()}
    assert found == {"a b c d": (3, 4, 3, 857142), "a b": (4, 4, 4, 1000000)}


@pytest.mark.parametrize("size", [7, 64, 1 << 22])
def test_slices_keep_places(monkeypatch, size):
    monkeypatch.setattr(phrases, "SLICE", size)
    text = ("one two, three four five. six " * 20 + "a b c d e f g h i j k l") * 2
    found = Counter()
    last = None
    for places, words in words_of(text.encode().translate(FOLDED)):
        for place, word in zip(places.tolist(), words.to_pylist(), strict=True):
            if last and place == last[0] + 1:
                found[last[1], word] += 1
            assert not last or place > last[0]
            last = place, word
    pieces = [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n-\r]", text)]
    assert found == Counter(pair for p in pieces for pair in zip(p, p[1:]))


def test_scores_pass_64_bits(spark):
    """Counts so large that a score's product does not fit."""
    kind = "size int, id long, a long, lang string, phrase string, first array<long>, last array<long>, inside array<struct<size: int, id: long>>"
    n = 4 * 10**18
    df = spark.createDataFrame([(2, 1, n, "x", "a b", [n + 1, n], [n + 2, n], [])], kind)
    r = phrases._scored(df, 2_000_000, 80).first()
    assert r["score"] == 2_000_000 * n // (2 * n + 3) and (r["l"], r["r"]) == (n + 1, n + 2)
    covers = spark.createDataFrame([(3, 2, n, "x", "a b c", [n] * 3, [n] * 3, [(2, 1)])], kind)
    assert [x["phrase"] for x in phrases._scored(df.union(covers), 2_000_000, 80).collect()] == ["a b c"]


def test_a_chunk_takes_bounded_memory():
    """Of one Python worker, of which an executor has one for each core."""
    source, n, words = np.random.default_rng(1), phrases.CHUNK_WORDS, phrases.CHUNK_WORDS // 16
    names = pa.array([f"w{i}" for i in range(words)])
    chunk = phrases._Chunk(0)
    for lang in "abcd":
        chunk.add(lang, np.arange(n // 4), names.take(pa.array(source.integers(0, words, n // 4))))
    tracemalloc.start()
    rows = pa.Table.from_batches(list(chunk.rows()))
    first = tracemalloc.get_traced_memory()[1]
    own = int(max(phrases.open_up(rows["groups"][0].as_py(), "<i4", n))) + 1
    frequent = pa.table({"chunk": [0] * own, "group": list(range(own)), "id": list(range(own))})
    relation = rows.slice(0, 1).select(["chunk", "n", "places", "groups"])
    tracemalloc.reset_peak()
    longer = phrases._extended(frequent, relation)
    second = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert longer["n"][0].as_py() == n - 4
    assert max(first, second) < 144 << 20, (first >> 20, second >> 20)
