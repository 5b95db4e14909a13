"""Alignment of two tokenizers by products of token-byte incidence matrices."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import ship, text_of
from tripmart.llm.packed import open_up, squeeze
from tripmart.llm.tables import Stages
from tripmart.llm.tokens import PLAIN, file_of

FIRST, SECOND, RANKS = "byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"
#: Links of a chunk, about, and bytes of text that are multiplied at once.
CHUNK_LINKS, SLICE = 1 << 22, 1 << 20
#: Code points of a text that are encoded at once.
PART = 1 << 16
#: Products of a block of rows.
PRODUCTS = 1 << 21
#: Where both tokenizers begin anew: a single space between two letters.
SEAM = re.compile(r"(?<=[a-z]) (?=[a-z])")


@dataclass
class Csr:
    """A matrix of zeros and ones, or of counts: for each row the columns that are not zero, row after row."""

    starts: np.ndarray
    columns: np.ndarray
    width: int
    values: np.ndarray | None = None

    @classmethod
    def of_ranges(cls, ends: np.ndarray, width: int) -> Csr:
        """Row i has the columns from the end of row i - 1 to its own end: a token and its bytes."""
        return cls(np.concatenate([[0], ends]), np.arange(width), width)

    @classmethod
    def of_groups(cls, groups: np.ndarray, width: int) -> Csr:
        """Row i has the one column `groups[i]`: a token and its group."""
        return cls(np.arange(len(groups) + 1), groups, width)

    def transposed(self) -> Csr:
        """Rows for columns; the columns of each row ascend, as rows are gone through in order."""
        order = np.argsort(self.columns, kind="stable")
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        counts = np.bincount(self.columns, minlength=self.width)
        return Csr(np.concatenate([[0], np.cumsum(counts)]), rows[order], len(self.starts) - 1)


def products(a: Csr, b: Csr, block: int = PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The product of two matrices of zeros and ones, by blocks of rows: row, column and value of what is not zero.

    As Gustavson has it: row i of the product is the sum of the rows k of `b` for
    which `a` has an entry (i, k). Rows of a block are summed together. A block
    has up to `block` products, or one row.
    """
    n = np.diff(b.starts)[a.columns]
    before = np.concatenate([[0], np.cumsum(n)])
    row_before = before[a.starts]
    first, rows = 0, len(a.starts) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(row_before, row_before[first] + block, "right")) - 1)
        entries = slice(a.starts[first], a.starts[last])
        own, k = n[entries], a.columns[entries]
        row = np.repeat(np.repeat(np.arange(first, last), np.diff(a.starts[first : last + 1])), own)
        at = np.arange(len(row)) - np.repeat(before[entries] - row_before[first], own)
        key = row * b.width + b.columns[np.repeat(b.starts[k], own) + at]
        if (np.diff(key) < 0).any():
            key = np.sort(key)
        new = np.flatnonzero(np.diff(key, prepend=-1))
        yield key[new] // b.width, key[new] % b.width, np.diff(np.append(new, len(key)))
        first = last


class Pair:
    """Two tokenizers, and the bytes of every token of either."""

    def __init__(self, first: str, second: str, ranks: str | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(file_of(first))
        self.slow.no_truncation()
        self.slow.no_padding()
        self.slow.encode_special_tokens = True
        signs = _byte_signs()
        size = self.slow.get_vocab_size(with_added_tokens=True)
        entries = [self.slow.id_to_token(i) or "" for i in range(size)]
        self.first = [bytes(signs[c] for c in t) if all(c in signs for c in t) else t.encode() for t in entries]
        self.fast = None
        if ranks:
            import base64

            import tiktoken
            from public_tokenizers import PATTERN

            with open(file_of(ranks), "rb") as lines:
                table = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=file_of(second))
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.second = [
            bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(names)
        ]
        # Seams are right for the second only if none of its pieces goes on after a space.
        self.seams = not any("▁" in p.lstrip("▁") for p in names)
        self.lengths = [np.array([len(t) for t in side], np.int64) for side in (self.first, self.second)]

    def parts(self, text: str) -> list[str]:
        """A long text in parts that can be encoded apart, each without the space before it."""
        found, start = [], 0
        while self.seams and len(text) - start > PART:
            seam = SEAM.search(text, start + PART)
            if not seam:
                break
            found.append(text[start : seam.start()])
            start = seam.end()
        return [*found, text[start:]]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids by both, of the text with a space before it; None where the tokens' bytes are not that text's."""
        cut = [self.parts(t) for t in texts]
        flat = [p for parts in cut for p in parts]
        second = self.pieces.encode(flat, num_threads=1)
        fast = [bool(self.fast and PLAIN.fullmatch(p)) for p in flat]
        slow = [" " + p for p, f in zip(flat, fast, strict=True) if not f]
        rest = iter(self.slow.encode_batch_fast(slow, add_special_tokens=False)) if slow else iter(())
        first = [self.fast.encode_ordinary(" " + p) if f else next(rest).ids for p, f in zip(flat, fast, strict=True)]
        found, at = [], 0
        for text, parts in zip(texts, cut, strict=True):
            a = [i for p in first[at : at + len(parts)] for i in p] if len(parts) > 1 else first[at]
            b = [i for p in second[at : at + len(parts)] for i in p] if len(parts) > 1 else second[at]
            at += len(parts)
            whole = b" " + text.encode()
            same = text and b"".join(map(self.first.__getitem__, a)) == whole
            same = same and b"".join(map(self.second.__getitem__, b)) == whole
            found.append((np.array(a, np.int64), np.array(b, np.int64)) if same else None)
        return found


def _byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable ones themselves, the others in turn."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in plain]
    return signs | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def pair(first: str, second: str, ranks: str | None) -> Pair:
    return Pair(first, second, ranks)


class Alignment:
    """Tokens, groups and links of texts that follow each other; every text has both kinds of tokens."""

    def __init__(self, tokens: list[tuple[np.ndarray, np.ndarray]], lengths: list[np.ndarray]) -> None:
        empty = [np.empty(0, np.int64)]
        self.ids = [np.concatenate([t[side] for t in tokens] or empty) for side in (0, 1)]
        self.ends = [np.cumsum(lengths[side][self.ids[side]]) for side in (0, 1)]
        self.bounds = [np.cumsum([0, *(len(t[side]) for t in tokens)]) for side in (0, 1)]
        self.cuts = np.intersect1d(*self.ends, assume_unique=True)
        self.groups = [np.searchsorted(self.cuts, ends) for ends in self.ends]
        text_ends = self.ends[0][self.bounds[0][1:] - 1] if tokens else empty[0]
        self.group_bounds = np.concatenate([[0], np.searchsorted(self.cuts, text_ends) + 1])

    def _slices(self) -> Iterator[tuple[slice, slice, int, int]]:
        """Runs of whole groups of about SLICE bytes: their tokens of either side, the first byte, the first group."""
        first, start = 0, 0
        while first < len(self.cuts):
            last = max(first + 1, int(np.searchsorted(self.cuts, start + SLICE)))
            own = [slice(*np.searchsorted(groups, [first, last])) for groups in self.groups]
            yield own[0], own[1], start, first
            start, first = int(self.cuts[last - 1]), last

    def overlaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links: places of the tokens of either side that have bytes in common, and how many; A times B transposed."""
        found = []
        for a, b, start, _ in self._slices():
            width = int(self.ends[0][a.stop - 1]) - start
            left, right = (Csr.of_ranges(self.ends[s][own] - start, width) for s, own in ((0, a), (1, b)))
            found += [(a.start + i, b.start + j, n) for i, j, n in products(left, right.transposed())]
        return tuple(np.concatenate([f[x] for f in found] or [np.empty(0, np.int64)]) for x in range(3))

    def shared_groups(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links of all tokens of either side that are in one group, by blocks; token-group incidences multiplied."""
        for a, b, _, first in self._slices():
            width = int(self.groups[0][a.stop - 1]) + 1 - first
            left, right = (Csr.of_groups(self.groups[s][own] - first, width) for s, own in ((0, a), (1, b)))
            for i, j, _ in products(left, right.transposed()):
                yield a.start + i, b.start + j

    def spelled(self, names: list[np.ndarray]) -> list[str]:
        """The groups of each text as text: ids of either side by commas, sides by a bar, groups by semicolons.

        `names` has three names for each id of either side, followed by what stands after it.
        """
        last = [np.append(groups[1:] != groups[:-1], True)[: len(groups)] for groups in self.groups]
        kind = [np.where(last[0], 1, 0), np.where(last[1], 2, 0)]
        places = np.concatenate([2 * self.groups[0], 2 * self.groups[1] + 1])
        spelled = np.concatenate([names[s][3 * self.ids[s] + kind[s]] for s in (0, 1)])
        spelled = spelled[np.argsort(places, kind="stable")].tolist()
        ends = (self.bounds[0] + self.bounds[1]).tolist()
        return ["".join(spelled[s:e])[:-1] for s, e in zip(ends[:-1], ends[1:], strict=True)]


def spellings(size: int) -> np.ndarray:
    """Three names for each id: with a comma, a bar and a semicolon after it."""
    return np.array([f"{i}{after}" for i in range(size) for after in ",|;"], object)


def align(
    documents: DataFrame, first: str = FIRST, second: str = SECOND, ranks: str | None = RANKS
) -> DataFrame:
    """How the tokens of two vocabularies lie over each other, by document.

    A text with a space before it is encoded by the byte-level vocabulary `first`
    (A), and the text by the piece vocabulary `second` (B), which puts the space
    there itself; special tokens' strings are plain text. Byte offsets at which
    tokens of both end cut the tokens into groups. With the token-byte incidence
    matrices A and B in compressed rows, the entries of A times B transposed are
    the links: pairs of tokens that overlap, with the bytes they share. In the
    same way token-group incidences give the pairs that share a group.

    Documents are aligned in chunks, which are staged: for each document its
    distinct pairs of ids and how often it links them. In how many documents of
    the corpus a pair of ids is linked is a total over the chunks' distinct
    pairs; a pair that every document has is a row for each chunk. Totals and
    the highest one of each A id go back to the chunks.

    Returns `doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256, n_group_links`: tokens; groups; links; links whose pair has
    the highest count of all pairs with its A id; the counts of all links added
    up; the digest of the groups' ids; pairs of tokens that share a group.

    Texts that are null or empty, or that the tokens of A or B do not spell byte
    for byte, have no tokens: zeros, and '' for the digest. Null and repeated ids
    and repeated rows are documents of their own. An empty table gives no rows.
    A long text is encoded in parts and multiplied in slices; its ids and links
    are held by one task, some hundred bytes for each token.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(documents["doc_id"].cast("long").alias("doc_id"), text_of(documents).alias("text"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pair(first, second, ranks)
        width = len(own.second)
        names = [spellings(len(own.first)), spellings(width)]
        chunk = _Chunk(TaskContext.get().partitionId() << 32)
        for batch in batches:
            tokens = own.encode(batch.column(1).to_pylist())
            chunk.add(batch.column(0).to_pylist(), tokens, own.lengths, names, width)
            if chunk.links >= CHUNK_LINKS:
                yield chunk.row()
                chunk = _Chunk(chunk.name + 1)
        if chunk.columns["doc_id"]:
            yield chunk.row()

    stages = Stages(spark)
    staged = stages.stage(rows.mapInArrow(chunks, _CHUNK))
    pairs = staged.select("chunk", "width", F.posexplode(F.arrays_zip("pair", "documents")))
    pairs = pairs.select("chunk", "width", F.col("pos").alias("place"), "col.*")
    total = F.sum("documents").over(Window.partitionBy("pair"))
    totals = stages.stage(
        pairs.select("chunk", "place", F.expr("pair div width").alias("a"), total.alias("total"))
    )
    best = totals.groupBy("a").agg(F.max("total").alias("best"))
    if len(pair(first, second, ranks).first) <= MOST_IDS:
        best = F.broadcast(best)  # a row for each id of the vocabulary, at most
    answers = totals.join(best, "a").select("chunk", "place", "total", (F.col("total") == F.col("best")).alias("best"))
    return answers.groupBy("chunk").cogroup(staged.drop("pair", "documents").groupBy("chunk")).applyInArrow(_summed, _RESULT)


#: Ids of a vocabulary whose highest counts are broadcast, at most.
MOST_IDS = 1 << 20

_LISTS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "n_pairs")
_CHUNK = (
    "chunk long, width long, "
    + ", ".join(f"{c} array<long>" for c in _LISTS)
    + ", groups_sha256 array<string>, n long, places binary, times binary, pair array<long>, documents array<long>"
)
_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
    " groups_sha256 string, n_group_links long"
)


class _Chunk:
    """Aligned documents of a task, until they have enough links."""

    def __init__(self, name: int) -> None:
        self.name, self.links, self.width = name, 0, 1
        self.columns: dict[str, list] = {c: [] for c in (*_LISTS, "groups_sha256")}
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, ids: list, tokens: list, lengths: list[np.ndarray], names: list[np.ndarray], width: int) -> None:
        self.width = width
        some = [t for t in tokens if t is not None]
        found = Alignment(some, lengths)
        left, right, _ = found.overlaps()
        of_text = np.searchsorted(found.bounds[0], left, "right") - 1
        pairs = found.ids[0][left] * width + found.ids[1][right]
        order = np.lexsort((pairs, of_text))
        of_text, pairs = of_text[order], pairs[order]
        new = np.flatnonzero((np.diff(of_text, prepend=-1) != 0) | (np.diff(pairs, prepend=-1) != 0))
        self.pairs.append(pairs[new])
        self.times.append(np.diff(np.append(new, len(pairs))))
        self.links += len(left)
        in_groups = np.zeros(len(some), np.int64)
        for a, _ in found.shared_groups():
            in_groups += np.bincount(np.searchsorted(found.bounds[0], a, "right") - 1, minlength=len(some))
        values = {
            "n_a": np.diff(found.bounds[0]),
            "n_b": np.diff(found.bounds[1]),
            "n_groups": np.diff(found.group_bounds),
            "n_links": np.bincount(of_text, minlength=len(some)),
            "n_group_links": in_groups,
            "n_pairs": np.bincount(of_text[new], minlength=len(some)),
        }
        digests = [hashlib.sha256(s.encode()).hexdigest() for s in found.spelled(names)]
        there = np.array([t is not None for t in tokens], bool)
        for column, own in values.items():
            whole = np.zeros(len(tokens), np.int64)
            whole[there] = own
            self.columns[column] += whole.tolist()
        rest = iter(digests)
        self.columns["groups_sha256"] += [next(rest) if t else "" for t in there.tolist()]
        self.columns["doc_id"] += ids

    def row(self) -> pa.RecordBatch:
        pairs = np.concatenate(self.pairs)
        distinct, places, documents = np.unique(pairs, return_inverse=True, return_counts=True)
        longs = lambda v: pa.array([v], pa.list_(pa.int64()))
        values = {
            "chunk": pa.array([self.name], pa.int64()),
            "width": pa.array([self.width], pa.int64()),
            **{c: longs(self.columns[c]) for c in _LISTS},
            "groups_sha256": pa.array([self.columns["groups_sha256"]], pa.list_(pa.string())),
            "n": pa.array([len(pairs)], pa.int64()),
            "places": pa.array([squeeze(places.astype("<i4"))], pa.binary()),
            "times": pa.array([squeeze(np.concatenate(self.times).astype("<i4"))], pa.binary()),
            "pair": longs(distinct),
            "documents": longs(documents),
        }
        return pa.RecordBatch.from_arrays(list(values.values()), names=list(values))


def _summed(answers: pa.Table, chunk: pa.Table) -> pa.Table:
    """The documents of a chunk with what the counts of their links come to."""
    held = chunk.to_pylist()[0]
    totals = np.zeros(len(answers), np.int64)
    best = np.zeros(len(answers), np.int64)
    at = answers.column("place").to_numpy()
    totals[at] = answers.column("total").to_numpy()
    best[at] = answers.column("best").to_numpy()
    places, times = (open_up(held[c], "<i4", held["n"]).astype(np.int64) for c in ("places", "times"))
    ends = np.cumsum([0, *held["n_pairs"]])
    within = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[ends])
    columns = {c: held[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    columns |= {"n_best": within(best[places] * times), "count_sum": within(totals[places] * times)}
    columns |= {c: held[c] for c in ("groups_sha256", "n_group_links")}
    return pa.table({c: pa.array(v, pa.string() if c == "groups_sha256" else pa.int64()) for c, v in columns.items()})
