"""Mixing, sharding, joins, classifiers, top-k and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_fixtures import SF_SMALL, awkward, empty, labels, rows, small  # noqa: F401
from pyspark.sql import functions as F
from test_text_operators import WORD, texts, words

import corpus_pipeline
from tripmart.llm import mixing, segments, sigtree
from tripmart.llm.common import running_totals
from tripmart.llm.components import components
from tripmart.llm.mixing import mix, mixed_documents, targets
from tripmart.llm.quality import good_documents, score_quality
from tripmart.llm.segments import top_k
from tripmart.llm.sharding import longest_first, shard_documents
from tripmart.llm.sigtree import Tree, bitmap, dual_traversal, linked_documents, one_of_each_group, prefix, similar_groups, similar_pairs
from tripmart.llm.toxicity import harmless_documents, score_toxicity


def test_running_totals(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 13).alias("v"))
    total, expected = 0, []
    for k, v in sorted(map(tuple, df.collect())):
        expected.append((k, v, total))
        total += v
    assert rows(running_totals(df, [F.col("k")], total=F.col("v"))) == sorted(expected, key=repr)


# Mixing


@pytest.mark.parametrize("name", ["awkward", "small", "empty"])
def test_the_mix_equals_its_sql(request, name):
    df = request.getfixturevalue(name)
    found = mix(df)
    connection = duckdb.connect()
    connection.register("documents", df.select("doc_id", "text", "source").toArrow())
    expected = connection.sql(mixing.SQL).fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    for source in {r["source"] for r in found.collect()}:
        own = [r for r in found.collect() if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5
        assert all(r["taken"] <= 3 * r["size"] for r in own)


def test_targets_share_what_a_limit_leaves(spark):
    sources = spark.createDataFrame([("sa", 10), ("sb", 1000), ("sc", 500), ("sd", 0)], "src string, source_size long")
    found = {r["src"]: r["target"] for r in targets(sources).collect()}
    assert found["sa"] == 30 and found["sd"] == 0
    assert found["sb"] / found["sc"] == pytest.approx(2) and sum(found.values()) == pytest.approx(1510)


@pytest.mark.parametrize("name", ["awkward", "small", "empty"])
def test_mixed_documents_have_the_words_taken(request, name):
    df = request.getfixturevalue(name)
    mixed = mixed_documents(df)
    assert mixed.columns == df.columns
    by_source = lambda pairs: Counter({k: v for k, v in pairs if v})
    taken, got = defaultdict(int), defaultdict(int)
    for r in mix(df).collect():
        taken[r["source"]] += r["taken"]
    originals = {t for _, t in texts(df)}
    for r in mixed.collect():
        got[r["source"]] += len(WORD.findall(r["text"]))
        assert r["text"] in originals or any(t and t.startswith(r["text"]) for t in originals)
    assert by_source(got.items()) == by_source(taken.items())


# Sharding


def test_the_heap_is_longest_first():
    rng = random.Random(4)
    sizes = [(f"g{i}", rng.randrange(1, 500)) for i in range(300)]
    loads = [0] * 7
    expected = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        shard = loads.index(min(loads))
        loads[shard] += size
        expected.append((name, shard))
    assert longest_first(sizes, 7) == expected


@pytest.mark.parametrize("name", ["awkward", "small", "empty"])
def test_shards(request, name):
    df = request.getfixturevalue(name)
    found = shard_documents(df).collect()
    expected = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts(df)), key=str)
    assert sorted((tuple(r)[:3] for r in found), key=str) == expected
    assert {(r["law"], r["grown_shard"]) for r in found} <= {("bytes", None)}
    loads, slots, group = Counter(), defaultdict(list), {}
    for r in found:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        group.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in group.values()) and set(loads) <= set(range(40))
    if name == "small":
        largest = max(Counter((t or "") for _, t in texts(df)).items(), key=lambda x: len(x[0]) * x[1])
        assert max(loads.values()) <= sum(loads.values()) / 40 + (len(largest[0].encode()) + 16) * largest[1]
    assert sorted(map(tuple, shard_documents(df).collect()), key=str) == sorted(map(tuple, found), key=str)


# Components and the join


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (7, 9000)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), 600).collect()}
    assert len({found[i] for i in range(301)} | {found[9000]}) == 1
    assert len({found[1000 + i] for i in range(200)}) == 1 and found[0] != found[1000]
    assert components(spark.createDataFrame([], "a long, b long"), 0).count() == 0


def brute_groups(documents):
    own = []
    for i, t in documents:
        w = words(t)
        own.append((i, {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    parent = list(range(len(own)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(own)):
        for b in range(a):
            both = len(own[a][1] & own[b][1])
            if both and 100 * both >= 80 * (len(own[a][1]) + len(own[b][1]) - both):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(own):
        if i is not None:
            root = find(k)
            least[root] = min(i, least.get(root, i))
    return sorted(((i, len(s), least.get(find(k), i)) for k, (i, s) in enumerate(own)), key=str)


@pytest.fixture(scope="module")
def copies(spark):
    """A text with many near copies, some near each other only, beside texts that share a passage."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    made = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        made.append((i, " ".join(w)))
    passage = " ".join(f"p{i}" for i in range(60))
    made += [(100 + i, passage + " " + " ".join(f"o{i}x{j}" for j in range(rng.choice([3, 10, 16, 60])))) for i in range(40)]
    return spark.createDataFrame(made, "doc_id long, text string")


@pytest.mark.parametrize("name", ["awkward", "small", "empty", "copies"])
@pytest.mark.parametrize("limits", [{}, {"cell": 4, "per_document": 1}])
def test_groups_are_those_of_all_links(request, monkeypatch, name, limits):
    df = request.getfixturevalue(name)
    if limits:
        monkeypatch.setattr(sigtree, "TOGETHER", 30)
        monkeypatch.setattr(sigtree, "BROADCAST_IDS", 3)
    found = similar_groups(df, **limits)
    assert sorted(map(tuple, found.collect()), key=str) == brute_groups(texts(df))


def brute_links(documents):
    own = []
    for i, t in documents:
        w = words(t)
        own.append((i, frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()))
    linked = lambda a, b: bool(a & b) and 100 * len(a & b) >= 80 * len(a | b)
    n = [sum(linked(s, o) for _, o in own) - bool(s) for _, s in own]
    pairs = Counter()
    for a in {s for _, s in own}:
        for b in {s for _, s in own}:
            if a != b and linked(a, b):
                pairs[tuple(sorted((min((i for i, s in own if s == x and i is not None), default=None) for x in (a, b)), key=str))] += 1
    return n, {p: k // 2 for p, k in pairs.items()}


@pytest.mark.parametrize("name", ["awkward", "small", "empty", "copies"])
@pytest.mark.parametrize("limits", [{}, {"cell": 4}])
def test_links_inside_groups_are_counted_and_returned(request, monkeypatch, name, limits):
    df = request.getfixturevalue(name)
    if limits:
        monkeypatch.setattr(sigtree, "TOGETHER", 30)
        monkeypatch.setattr(sigtree, "PART_ROWS", 7)
    n, pairs = brute_links(texts(df))
    expected = sorted(((i, k) for (i, _), k in zip(texts(df), n, strict=True)), key=str)
    found = linked_documents(df, **limits)
    assert sorted(((r["doc_id"], r["n_links"]) for r in found.collect()), key=str) == expected
    assert sorted((tuple(r)[:3] for r in found.collect()), key=str) == brute_groups(texts(df))
    got = Counter(tuple(sorted((r["first_a"], r["first_b"]), key=str)) for r in similar_pairs(df, **limits).collect())
    assert got == pairs and (name != "copies" or len(pairs) > 400)


def test_one_of_each_group(awkward, small, empty):
    for df in (awkward, small, empty):
        groups = brute_groups(texts(df))
        kept = one_of_each_group(df)
        assert kept.columns == df.columns
        left = Counter(r["doc_id"] for r in kept.collect())
        for i, n, least in groups:
            assert left[i] >= (least == i or n == 0)
            assert i is None or n == 0 or least == i or i == 7 or left[i] == 0
        assert all(r["doc_id"] != 2 for r in kept.collect()) or df is not awkward


def test_the_tree_loses_no_similar_pair():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = []
    for _ in range(120):
        n = int(rng.integers(20, 300))
        own = base[:n].copy()
        changed = rng.random(n) < rng.choice([0.0, 0.05, 0.3])
        own[changed] = rng.integers(0, 2**63, changed.sum()).astype(np.uint64)
        sets.append(np.unique(own))
    sizes = np.array([len(s) for s in sets])
    maps = np.frombuffer(b"".join(bitmap(s[:0], 1) or b"" for s in sets[:0]), np.uint64)
    found = sigtree.candidates([bitmap(s, sigtree.WIDE) for s in sets], sizes, np.arange(len(sets)))
    pairs = {tuple(sorted(p)) for p in zip(*(f.tolist() for f in found), strict=True)}
    similar = set()
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (sizes[a] + sizes[b] - both):
                similar.add((b, a))
    assert similar <= pairs and len(pairs) < len(sets) ** 2 / 4 and not len(maps)
    one_class = sigtree.candidates([bitmap(s, sigtree.WIDE) for s in sets], sizes, np.zeros(len(sets), np.int64))
    assert not len(one_class[0])
    tree = Tree(np.zeros((1, 4), np.uint64), np.ones(1, np.int64), np.zeros(1, np.int64))
    assert [len(x) for x in dual_traversal(tree, tree)] == [0, 0]


def test_similar_sets_share_a_prefix_shingle():
    rng = np.random.default_rng(6)
    counters = rng.integers(0, 50, sigtree.COUNTERS).astype(np.uint32)
    for n in range(1, 120):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: -(n // 9) or None], rng.integers(0, 2**63, n // 9).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert len(np.intersect1d(prefix(a, counters), prefix(b, counters)))


# Classifiers


@pytest.fixture(scope="module")
def more(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize(
    ("score", "label", "folds", "held", "least"), [(score_quality, "quality", 3, 1, 0.95), (score_toxicity, "toxic", 4, 2, 0.9)]
)
def test_held_out_accuracy(more, score, label, folds, held, least):
    found = score(*more)
    known = {r["doc_id"]: r[label] for r in more[1].collect()}
    scored = found.collect()
    assert len(scored) == more[0].count() and all(0 <= r["score"] <= 1 for r in scored)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held) for r in scored)
    out = [r for r in scored if r["held_out"] and r["doc_id"] in known]
    assert sum(r["predicted"] == known[r["doc_id"]] for r in out) >= least * len(out)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, score(*more).collect()))


@pytest.mark.parametrize(("score", "label"), [(score_quality, "quality"), (score_toxicity, "toxic")])
def test_labels_of_held_out_rows_change_nothing(more, score, label):
    documents, labels = more
    folds, held = (3, 1) if label == "quality" else (4, 2)
    turned = labels.withColumn(
        label, F.when(F.crc32(F.col("doc_id").cast("string")) % folds == held, 1 - F.col(label)).otherwise(F.col(label))
    )
    assert rows(score(documents, labels)) == rows(score(documents, turned))


@pytest.mark.parametrize("score", [score_quality, score_toxicity])
def test_awkward_documents_and_labels(spark, awkward, empty, labels, score):
    known = [(1, 1, 0), (3, 0, 1), (9, 0, 1), (10, 1, 0), (None, 1, 1), (7, None, None), (7, 1, 0), (7, 0, 1)]
    few = spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    for own in (few, few.limit(0), labels):
        found = score(awkward, own).collect()
        assert len(found) == awkward.count() and all(0 <= r["score"] <= 1 for r in found)
        assert len({r["score"] for r in found if r["doc_id"] in (4, 5)}) == 1
    assert {r["score"] for r in score(awkward, few.limit(0)).collect()} == {0.5}
    assert score(empty, few).count() == 0


def test_filters_keep_what_the_scores_say(small, labels):
    good = {r["doc_id"] for r in score_quality(small, labels).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in good_documents(small, labels).collect()} == good
    harmless = {r["doc_id"] for r in score_toxicity(small, labels).filter("predicted = 0").collect()}
    kept = harmless_documents(small, labels)
    assert {r["doc_id"] for r in kept.collect()} == harmless and kept.columns == small.columns


# Top-k


def brute_top(vectors, k=5, step=50, scale=256):
    usable = [
        (i, [int(np.floor(scale * np.float64(x))) for x in v])
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, v in {(i, tuple(v)) for i, v in usable if i % step == 0}:
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in usable if j != i and len(w) == len(v)]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [1024, 7])
def test_top_k_with_ties_copies_and_bad_vectors(spark, monkeypatch, block):
    rng = np.random.default_rng(7)
    vectors = [(i, rng.normal(0, 0.2, 10).astype(np.float32).tolist()) for i in range(300)]
    vectors += [(1000 + i, vectors[50][1]) for i in range(40)] + [(50, vectors[50][1]), (2000, vectors[50][1])]
    nan, inf = float("nan"), float("inf")
    vectors += [(3000, None), (3050, [nan] * 10), (3100, [inf] + [0.0] * 9), (3150, [None] + [0.0] * 9), (None, [0.1] * 10)]
    vectors += [(4000, []), (4001, []), (4050, [0.5, 0.5]), (4051, [0.5, -0.5]), (4100, [1e6] * 10), (4101, [-1e6] * 10)]
    monkeypatch.setattr(segments, "BLOCK", block)
    monkeypatch.setattr(segments, "CELL", 64)
    monkeypatch.setattr(segments, "SEED", 5)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    assert sorted(map(tuple, top_k(df).collect())) == brute_top(df.select("vec_id", "embedding").collect())
    assert top_k(df.limit(0)).count() == 0


def test_bounds_are_never_below_the_product():
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(50, 37)), rng.normal(size=(60, 37))
    for n in segments._levels(37):
        assert (segments._statistics(a, n) @ segments._statistics(b, n).T >= a @ b.T - 1e-9).all()


# Pipeline


def test_the_pipeline_against_its_parts(spark, small, labels):
    found = corpus_pipeline.run(spark, SF_SMALL).collect()
    good = [r for r in score_quality(small, labels).collect() if r["predicted"] == 1]
    docs = small.filter(F.col("doc_id").isin([r["doc_id"] for r in good]))
    calm = [r["doc_id"] for r in score_toxicity(docs, labels).collect() if r["predicted"] == 0]
    docs = docs.filter(F.col("doc_id").isin(calm))
    kept = [i for i, n, least in brute_groups(texts(docs)) if least == i or not n]
    docs = docs.filter(F.col("doc_id").isin(kept))
    from public_tokenizers import path
    from tokenizers import Tokenizer

    own, expected = Tokenizer.from_file(path("word_bpe_49k.json")), []
    text_of = dict(texts(docs))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in mix(docs).collect():
        whole = r["epochs"] + (r["extra"] == r["size"] > 0)
        cuts = [None] * whole + ([r["extra"]] if 0 < r["extra"] < r["size"] else [])
        for cut in cuts:
            text = text_of[r["doc_id"]]
            text = text if cut is None else text[: [m.end() for m in WORD.finditer(text)][cut - 1]]
            ids = own.encode(text, add_special_tokens=False).ids
            expected.append((r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(own.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, found)) == sorted(expected) and len(found) > 50


def test_stages_keep_columns_and_take_awkward_rows(spark, awkward, empty, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 1), (9, 0, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for documents in (awkward, empty):
        docs = documents
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == documents.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
