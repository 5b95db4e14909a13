"""BPE encoding and decoding over a table of distinct words."""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import ship
from tripmart.llm.packed import (
    bucket_cuts,
    chunked,
    grown,
    one_array,
    open_up,
    packed,
    shrunk,
    sizes_for,
    split_words,
    squeeze,
    unpacked,
    word_hashes,
)
from tripmart.llm.tokens import file_of

VOCABULARY = "word_bpe_49k.json"
#: Words of one call to the library.
CALL = 8192


@lru_cache(maxsize=2)
def _tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads would also keep memory of their own
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(file_of(vocabulary))
    own.no_truncation()
    own.no_padding()
    return own


@lru_cache(maxsize=2)
def _pieces(vocabulary: str) -> np.ndarray:
    """The piece of every id."""
    table = _tokenizer(vocabulary)
    return np.array([table.id_to_token(i) or "" for i in range(table.get_vocab_size())], object)


def _in_order(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The order of words by hash, then by themselves, and the sorted hashes."""
    hashes = word_hashes(words)
    order = np.argsort(hashes, kind="stable")
    if len(hashes) and (np.diff(hashes[order]) == 0).any():
        texts = words.to_pylist()
        order = np.array(sorted(range(len(texts)), key=lambda i: (hashes[i], texts[i])), np.int64)
    return order, hashes[order]


def encode_and_decode(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Encode every whole text to ids, and decode the ids to text, as the vocabulary's library does.

    The vocabulary must be one whose tokens never span white space, like those
    with word ends: then a text's ids are those of its words, one after the
    other, and its special strings are inside words. Decoding puts the pieces of
    the ids one after the other with a space between.

    Texts are split into words, chunk by chunk. The distinct words of a chunk go
    to the buckets of the word table, where each distinct word of all chunks is
    encoded once; ids come back to the chunks in the same order, where they are
    joined to the words by position, and to their pieces by id. A word that
    makes up a third of all text is one row of a chunk.

    Returns `doc_id, ids (array of int), decoded`.

    Null and empty texts have no ids and decode to an empty text. Null ids and
    repeated rows are documents like others. An empty table gives no rows.
    """
    ship(documents.sparkSession)
    chunks, buckets = sizes_for(documents)
    texts = packed(chunked(documents, chunks))

    def ask(group: pa.Table) -> pa.Table:
        chunk, group = group.column("chunk")[0].as_py(), unpacked(group)
        _, _, words = split_words(one_array(group.column("text")), lower=False)
        words = words.filter(pc.not_equal(words, "")) if len(words) else words
        order, hashes = _in_order(words)
        cuts, own = bucket_cuts(hashes, buckets), words.take(pa.array(order)).to_pylist()
        full = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
        lists = ["\n".join(own[cuts[b] : cuts[b + 1]]).encode() for b in full]
        return pa.table(
            {
                "chunk": pa.array([chunk] * len(full), pa.int64()),
                "bucket": pa.array(full, pa.int32()),
                "size": pa.array([len(x) for x in lists], pa.int64()),
                "words": pa.array([shrunk(x) for x in lists], pa.binary()),
            }
        )

    def answer(group: pa.Table) -> pa.Table:
        own, places, asked = _tokenizer(vocabulary), {}, []
        for size, words in zip(group.column("size").to_pylist(), group.column("words").to_pylist(), strict=True):
            listed = grown(words, size).decode().split("\n")
            asked.append(np.fromiter((places.setdefault(w, len(places)) for w in listed), np.int64, len(listed)))
        distinct, found = list(places), []
        for at in range(0, len(distinct), CALL):
            found += [e.ids for e in own.encode_batch_fast(distinct[at : at + CALL], add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        starts = np.cumsum(lengths) - lengths
        rows = []
        for own_words in asked:
            n = lengths[own_words]
            at = np.repeat(starts[own_words] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            rows.append((len(n), squeeze(n.astype("<u4")), int(n.sum()), squeeze(ids[at])))
        return pa.table(
            {
                "chunk": group.column("chunk"),
                "bucket": group.column("bucket"),
                "n": pa.array([r[0] for r in rows], pa.int64()),
                "lengths": pa.array([r[1] for r in rows], pa.binary()),
                "n_ids": pa.array([r[2] for r in rows], pa.int64()),
                "ids": pa.array([r[3] for r in rows], pa.binary()),
            }
        )

    def join_back(answers: pa.Table, group: pa.Table) -> pa.Table:
        group = unpacked(group)
        rows = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
        none = [np.empty(0, np.uint32)]
        lengths = np.concatenate(none + [open_up(r["lengths"], "<u4", r["n"]) for r in rows]).astype(np.int64)
        ids = np.concatenate(none + [open_up(r["ids"], "<u4", r["n_ids"]) for r in rows])
        places, starts, words = split_words(one_array(group.column("text")), lower=False)
        kept = np.flatnonzero(pc.not_equal(words, "").to_numpy(zero_copy_only=False)) if len(words) else places
        order, _ = _in_order(words.take(pa.array(kept)))
        rank = np.zeros(len(words), np.int64)
        rank[kept[order]] = np.arange(len(kept))
        at = rank[places]  # of each word, its place in the chunk's answers
        n, first = lengths[at], (np.cumsum(lengths) - lengths)[at]
        before = np.concatenate([[0], np.cumsum(n)])
        flat = ids[np.repeat(first - before[:-1], n) + np.arange(before[-1])]
        bounds = before[starts]
        pieces = _pieces(vocabulary)
        named, ends = pieces[ids], np.cumsum(lengths)
        spelt = [" ".join(named[e - k : e]) if k else None for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
        spelt = np.array([*spelt, None], object)[:-1]
        silent = not lengths.all()
        decoded = []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            own = spelt[at[s:e]].tolist()
            decoded.append(" ".join([w for w in own if w is not None] if silent else own))
        return pa.table(
            {
                "doc_id": group.column("doc_id"),
                "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype(np.int32))),
                "decoded": pa.array(decoded, pa.string()),
            }
        )

    asked = texts.groupBy("chunk").applyInArrow(ask, "chunk long, bucket int, size long, words binary")
    answered = asked.groupBy("bucket").applyInArrow(
        answer, "chunk long, bucket int, n long, lengths binary, n_ids long, ids binary"
    )
    both = answered.groupBy("chunk").cogroup(texts.groupBy("chunk"))
    return both.applyInArrow(join_back, "doc_id long, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256` of encoded documents."""
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
