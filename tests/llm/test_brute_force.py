"""Operators that SQL cannot express, against plain loops."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from llm_fixtures import SF_SMALL, awkward, empty, labels, rows, small  # noqa: F401
from pyspark.sql import functions as F

from tripmart.llm import lm, quality, segments, toxicity
from tripmart.llm.labelled import training_rows
from tripmart.llm.quality import score_quality
from tripmart.llm.segments import top_k
from tripmart.llm.sharding import longest_first, shard_documents
from tripmart.llm.syncmers import fingerprints
from tripmart.llm.toxicity import score_toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
TWO_64 = 1 << 64


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


# Toxicity


def plain_grams(text):
    """Hashes of 3 to 6 characters, each from the characters alone."""
    text = " " + " ".join(re.split(r"[ \t-\r]+", text.translate(UPPER).strip(" \t\n\r\x0b\x0c"))) + " "
    found = set()
    for n in (3, 4, 5, 6):
        for i in range(len(text) - n + 1):
            h = 0
            for c in text[i : i + n]:
                h = (h * 0x100000001B3 + ord(c) + 1) % TWO_64
            found.add((h * 0x9E3779B97F4A7C15 % TWO_64) >> 44)
    return found


def test_features_ratios_fit_and_scores_of_toxicity(spark, small, labels):
    train = training_rows(small, labels, "toxic", 4, 2, 16_000, 6)
    model = toxicity.fit(train)
    learnt = [(plain_grams(r["text"]), r["label"]) for r in train.collect()]
    known = {r["doc_id"] for r in labels.filter("toxic IS NOT NULL").collect()}
    assert len(learnt) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in texts(small) if i in known)
    seen = (Counter(), Counter())
    sizes = Counter(label for _, label in learnt)
    for found, label in learnt:
        seen[label].update(found)
    apart, ratios = {}, {}
    for f in seen[0].keys() | seen[1].keys():
        if seen[0][f] + seen[1][f] >= 5:
            one, zero = ((seen[x][f] + 1) / (sizes[x] + 2) for x in (1, 0))
            ratios[f] = math.log(one / zero)
            apart[f] = ratios[f] * (one - zero)
    chosen = sorted(apart, key=lambda f: (-round(apart[f], 12), f))[: toxicity.FEATURES]
    least = apart[chosen[-1]]
    kept = {int(f) for f in np.flatnonzero(model.weights)}
    assert kept <= {f for f in apart if apart[f] >= least - 1e-9}
    # The fit is where the slope of the penalised loss is zero in every weight.
    margin = lambda found: model.intercept + sum(model.weights[f] for f in found)
    slope, level = defaultdict(float), 0.0
    for found, label in learnt:
        error = 1 / (1 + math.exp(-margin(found))) - label
        level += error
        for f in found & kept:
            slope[f] += error * ratios[f]
    worst = max(abs(slope[f] + toxicity.PENALTY * model.weights[f] / ratios[f]) for f in kept if ratios[f])
    assert abs(level) < 0.02 * len(learnt) and worst < 0.05 * len(learnt)
    scores = {r["doc_id"]: r["score"] for r in score_toxicity(small, labels).collect()}
    for i, text in texts(small):
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-margin(plain_grams(text)))), abs=1e-6)


@pytest.mark.parametrize("text", ["", " ", "a", "ab", "Ärger ÄB\tç\n\n日本語 x", "ab cd " * 40])
def test_grams_are_characters_and_slices_lose_none(monkeypatch, text):
    assert set(toxicity.grams(text).tolist()) == plain_grams(text)
    monkeypatch.setattr(toxicity, "SLICE", 7)
    assert set(toxicity.grams(text).tolist()) == plain_grams(text)


# Quality


def test_votes_for_all_documents_against_a_full_sort(small, labels):
    model = quality.fit(training_rows(small, labels, "quality", 3, 1, 6000, 8))
    scores = {r["doc_id"]: r["score"] for r in score_quality(small, labels).collect()}
    checked = 0
    for i, text in texts(small):
        own = quality.terms(text).astype(np.float64) @ model.directions.astype(np.float64)
        own /= max(np.linalg.norm(own), 1e-9)
        near = sorted(((float(v @ own), y) for v, y in zip(model.vectors.astype(np.float64), model.labels, strict=True)), reverse=True)
        if near[14][0] - near[15][0] < 1e-5:  # which of equals votes is open
            continue
        votes = [(max(c, 0), y) for c, y in near[:15]]
        checked += 1
        assert scores[i] == pytest.approx(sum(c * y for c, y in votes) / sum(c for c, _ in votes), abs=1e-3)
    assert checked > 150


# Fingerprints


def hash_of(*longs):
    seed = 42
    for x in longs:
        seed = xxhash.xxh64_intdigest(int(x).to_bytes(8, "little", signed=True), seed)
        seed = seed - TWO_64 if seed >= 1 << 63 else seed
        found, seed = seed, seed % TWO_64
    return found


def plain_anchors(text):
    """Closed syncmers by a loop over all k-mers: eight words, of whose seven pairs the least hash is at an edge."""
    words = WORD.findall(text.translate(UPPER))
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    hashes = [h - TWO_64 if h >= 1 << 63 else h for h in hashes]
    pairs = [hash_of(a, b) for a, b in zip(hashes, hashes[1:])]
    found = []
    for i in range(len(words) - 7):
        inner = pairs[i : i + 7]
        if min(inner) in (inner[0], inner[-1]):
            found.append((i, hash_of(*inner[::2])))
    return found or ([(0, hash_of(*hashes))] if hashes else [])


@pytest.mark.parametrize("name", ["awkward", "small"])
def test_anchors_are_those_of_a_plain_loop(request, name):
    df = request.getfixturevalue(name).select("doc_id", "text").dropDuplicates()
    own = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=str)
    expected = sorted((str(i), [tuple(a) for a in plain_anchors(t)]) for i, t in own)
    found = sorted((str(r["doc_id"]), [tuple(a) for a in r["anchors"]]) for r in fingerprints(df).collect())
    assert found == expected


# Sharding


def test_the_whole_assignment_is_longest_first(small):
    groups, sizes = defaultdict(int), {}
    for _, text in texts(small):
        groups[hashlib.md5(text.encode()).hexdigest()] += len(text.encode()) + 16
        sizes[zlib.crc32(text.encode())] = hashlib.md5(text.encode()).hexdigest()
    assert min(groups.values()) * 40 * 1000 >= sum(groups.values())  # every group is placed on its own here
    expected = dict(longest_first(list(groups.items()), 40))
    for r in shard_documents(small).collect():
        assert r["shard"] == expected[sizes[r["text_crc32"]]]


# Language model


def test_weights_are_those_of_expectation_maximisation(small, monkeypatch):
    learnt = []
    whole = lm._learn
    monkeypatch.setattr(lm, "_learn", lambda *a: learnt.append(whole(*a)) or learnt[0])
    lm.score_documents(small, order=2).count()
    begin, end = object(), object()
    ones, twos, vocabulary, held = Counter(), Counter(), set(), []
    documents = 0
    for i, text in texts(small):
        crc = zlib.crc32(str(i).encode())
        if crc % 7 == 2:
            continue
        tokens = [*WORD.findall(text.translate(UPPER)), end]
        pairs = list(zip([begin, *tokens], tokens))
        vocabulary.update(tokens)
        if crc // 7 % 8 == 0:
            held += pairs
            continue
        documents += 1
        ones.update(tokens)
        twos.update(pairs)
    total = sum(ones.values())
    weights = {b: ([1 / 2, 1 / 2, 0.0] if b == 0 else [1 / 3] * 3) for b in range(33)}
    before = None
    for _ in range(lm.ROUNDS):
        sums, loss = {b: [0.0] * 3 for b in weights}, 0.0
        for context, token in held:
            n = documents if context is begin else ones[context]
            bucket = 1 + min(n.bit_length() - 1, 31) if n else 0
            shares = [1 / (len(vocabulary) + 1), ones[token] / total, twos[context, token] / n if n else 0.0]
            parts = [w * s for w, s in zip(weights[bucket], shares)]
            loss -= math.log(sum(parts))
            for o in range(3):
                sums[bucket][o] += parts[o] / sum(parts)
        for b, own in sums.items():
            if sum(own):
                weights[b] = [x / sum(own) for x in own]
        if before is not None and before - loss < lm.TOLERANCE * abs(before):
            break
        before = loss
    for b, own in weights.items():
        assert learnt[0][b].tolist() == pytest.approx(own, abs=2e-3)


# Top-k


def test_a_task_keeps_few_blocks_of_queries(spark, monkeypatch):
    """Many blocks of queries, met again and again in one task: the same answers with one block held."""
    vectors = np.random.default_rng(2).normal(0, 0.2, (400, 6)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    expected = rows(top_k(df, query_step=2))
    monkeypatch.setattr(segments, "HELD", 2)
    held, most = [], []
    table = segments._Best

    class Watched(table):
        def __init__(self, *args):
            super().__init__(*args)
            held.append(self)

        def rows(self):
            most.append(len(held))
            held.remove(self)
            return super().rows()

    monkeypatch.setattr(segments, "_Best", Watched)
    packed = "dim int, block long, ids binary, vectors binary"
    monkeypatch.setattr(segments, "BLOCK", 20)
    ours = df.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"))
    blocks = [b for batch in ours.toArrow().to_batches() for b in segments._pack(iter([batch]))]
    assert packed and len(blocks) == 20

    def met():
        import pyarrow as pa

        for left in blocks:
            for right in blocks:
                names = ["dim", "ids", "vectors"]
                columns = [left.column(n) for n in names] + [right.column(n) for n in names[1:]]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "q_ids", "q_vectors"])

    found = defaultdict(set)
    for batch in segments._score(met(), 5):
        for r in batch.to_pylist():
            found[r["query_id"]].add((-r["score"], r["vec_id"]))
    assert max(most) <= 3 and not held
    got = [(q, n, i, -s) for q, best in found.items() if q % 2 == 0 for n, (s, i) in enumerate(sorted(best)[:5], 1)]
    assert sorted(got, key=repr) == expected
