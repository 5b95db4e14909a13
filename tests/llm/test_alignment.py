"""Tokenizer alignment against plain Python."""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF_SMALL, awkward, empty, labels, rows, small  # noqa: F401
from pyspark.sql import functions as F

from tripmart.llm import alignment
from tripmart.llm.alignment import FIRST, RANKS, SECOND, Alignment, Csr, align, pair, products, spellings


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public_tokenizers.path(FIRST))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(SECOND))


def signs():
    """Byte of each sign, as the byte-level format has it."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    found, n = {chr(b): b for b in plain}, 0
    for b in range(256):
        if b not in plain:
            found[chr(256 + n)] = b
            n += 1
    return found


def spans(tokens):
    found, at = [], 0
    for i, t in tokens:
        found.append((i, at, at + len(t)))
        at += len(t)
    return found


def brute(texts, libraries):
    """A row for each text, all by loops over tokens."""
    first, second = libraries
    sign, documents = signs(), []
    for text in texts:
        a, b = [], []
        if text:
            ids = first.encode(" " + text, add_special_tokens=False).ids
            a = [(i, bytes(sign[c] for c in first.id_to_token(i))) for i in ids]
            for i in second.encode(text):
                piece = second.id_to_piece(i)
                b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
            whole = (" " + text).encode()
            if any(b"".join(t for _, t in side) != whole for side in (a, b)):
                a, b = [], []
        a, b = spans(a), spans(b)
        links, at = [], 0
        for i, s, e in a:  # along both sides
            while b[at][2] <= s:
                at += 1
            links += [(i, j) for j, t, f in itertools.takewhile(lambda x, e=e: x[1] < e, itertools.islice(b, at, None))]
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, shared = [], 0
        at_a = at_b = 0
        for cut in cuts:
            own = [[], []]
            while at_a < len(a) and a[at_a][2] <= cut:
                own[0].append(a[at_a][0])
                at_a += 1
            while at_b < len(b) and b[at_b][2] <= cut:
                own[1].append(b[at_b][0])
                at_b += 1
            groups.append("|".join(",".join(map(str, side)) for side in own))
            shared += len(own[0]) * len(own[1])
        documents.append((a, b, groups, links, shared))
    counts = Counter(link for *_, links, _ in documents for link in set(links))
    highest = defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    return [
        (
            len(a), len(b), len(groups), len(links), sum(counts[x] == highest[x[0]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "", shared,
        )
        for a, b, groups, links, shared in documents
    ]


ODD = [" ", "\n\n", "▁", "a▁b", "<unk> <s> </s> <0x41>", "<|endoftext|>x", "\u0000", "  two  spaces ", "ﬁne №", "naïve café", "中文 字 符", "x" * 50]


@pytest.mark.parametrize("name", ["awkward", "small", "empty"])
def test_alignment_equals_loops(request, spark, libraries, name):
    df = request.getfixturevalue(name).select("doc_id", "text")
    if name == "awkward":
        df = df.union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string"))
    held = df.collect()
    wanted = brute([r["text"] or "" for r in held], libraries)
    expected = sorted(((r["doc_id"], *w) for r, w in zip(held, wanted, strict=True)), key=repr)
    assert rows(align(df.repartition(3))) == expected


def test_clashing_columns(spark, awkward):
    named = awkward.withColumns({c: F.lit("x") for c in ("place", "pair", "total", "best", "width", "a")})
    assert rows(align(named)) == rows(align(awkward.select("doc_id", "text")))


def test_parts_and_slices_change_nothing(monkeypatch, small):
    own = pair(FIRST, SECOND, RANKS)
    slow = pair(FIRST, SECOND, None)
    texts = [r["text"] for r in small.select("text").limit(60).collect()] + ODD
    whole = own.encode(texts)
    for encode in (slow.encode, lambda t: (monkeypatch.setattr(alignment, "PART", 50), own.encode(t))[1]):
        for x, y in zip(whole, encode(texts), strict=True):
            assert (x is None) == (y is None)
            assert x is None or all((p == q).all() for p, q in zip(x, y, strict=True))
    tokens = [t for t in whole if t is not None]
    plain = Alignment(tokens, own.lengths)
    links, shared = plain.overlaps(), {p for a, b in plain.shared_groups() for p in zip(a.tolist(), b.tolist())}
    monkeypatch.setattr(alignment, "SLICE", 10)
    assert all((x == y).all() for x, y in zip(links, plain.overlaps(), strict=True))
    assert {p for a, b in plain.shared_groups() for p in zip(a.tolist(), b.tolist())} == shared
    assert set(zip(links[0].tolist(), links[1].tolist())) <= shared


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 6)), max_size=8), st.lists(st.sets(st.integers(0, 5)), min_size=7, max_size=7), st.integers(1, 20))
def test_products_equal_dense_ones(left, right, block):
    def csr(sets, width):
        columns = [c for s in sets for c in sorted(s)]
        return Csr(np.cumsum([0, *map(len, sets)]), np.array(columns, np.int64), width)

    def dense(m):
        found = np.zeros((len(m.starts) - 1, m.width), np.int64)
        for i in range(len(found)):
            found[i, m.columns[m.starts[i] : m.starts[i + 1]]] = 1
        return found

    a, b = csr(left, 7), csr(right, 6)
    assert (dense(b.transposed()) == dense(b).T).all()
    found = np.zeros((len(left), 6), np.int64)
    for i, j, n in products(a, b, block):
        assert (found[i, j] == 0).all()
        found[i, j] = n
    assert (found == dense(a) @ dense(b)).all()


def test_spellings():
    assert spellings(2).tolist() == ["0,", "0|", "0;", "1,", "1|", "1;"]
