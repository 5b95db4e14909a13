"""Token counts; huge documents by overlapping chunks that are spliced at stable boundaries."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import ship, stage, text_of

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
LIMIT = 512
#: Code points: documents above HUGE are cut into chunks; neighbours share at first OVERLAP.
HUGE, CHUNK, OVERLAP = 32_768, 16_384, 256
#: Each time that chunks cannot be aligned, documents are cut anew with so many times the overlap.
WIDER = 8
#: Characters that both tokenizer libraries are known to split alike: ASCII and Latin letters and signs.
PLAIN = re.compile("[\t\n\r -~¡-¬®-ɏ]*")


def file_of(name: str) -> str:
    """A vocabulary file: a path, or the name of one that is installed with the tokenizers."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Counter:
    """Counts a text's tokens, and finds where they begin, as the vocabulary's own library does.

    The rank file holds the same vocabulary for a faster library. It serves
    texts of plain characters without special tokens, for which both split and
    merge alike; all others go to the vocabulary's library.
    """

    def __init__(self, vocabulary: str, ranks: str | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(file_of(vocabulary))
        self.slow.no_truncation()
        self.slow.no_padding()
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken
            from public_tokenizers import PATTERN

            with open(file_of(ranks), "rb") as lines:
                table = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
            self.lengths = np.zeros(max(table.values()) + 1, np.int64)
            for token, i in table.items():
                self.lengths[i] = len(token)

    def is_fast(self, text: str) -> bool:
        return bool(self.fast and PLAIN.fullmatch(text)) and not any(s in text for s in self.special)

    def counts(self, texts: list[str]) -> list[int]:
        fast = [self.is_fast(t) for t in texts]
        slow = [t for t, f in zip(texts, fast, strict=True) if not f]
        rest = iter(self.slow.encode_batch_fast(slow, add_special_tokens=False)) if slow else iter(())
        return [
            len(self.fast.encode_ordinary(t)) if f else len(next(rest).ids) for t, f in zip(texts, fast, strict=True)
        ]

    def ends(self, text: str) -> np.ndarray:
        """After each token, the code points of the text so far; a token that ends inside one counts it whole."""
        if not self.is_fast(text):
            found = self.slow.encode(text, add_special_tokens=False)
            return np.array([end for _, end in found.offsets], np.int64)
        data = np.frombuffer(text.encode(), np.uint8)
        points = np.cumsum((data & 0xC0) != 0x80)
        return points[np.cumsum(self.lengths[self.fast.encode_ordinary(text)]) - 1]


@lru_cache(maxsize=4)
def counter(vocabulary: str, ranks: str | None) -> Counter:
    return Counter(vocabulary, ranks)


def count_tokens(
    documents: DataFrame,
    vocabulary: str = VOCABULARY,
    ranks: str | None = RANKS,
    limit: int = LIMIT,
    huge: int = HUGE,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """The tokens of every document, without added ones; special strings in texts are special tokens.

    Texts of up to `huge` code points are counted in place. Others are cut into
    chunks that overlap and are dealt out, so the chunks of one document are
    encoded by many tasks. Two neighbours are spliced at a place inside their
    overlap where both have a token boundary and a space follows a letter or
    digit. There the split into words begins anew whatever stands before or
    after, so both chunks have the document's own tokens from that place on, or
    up to it. If an overlap has no such place, the document is cut again with an
    overlap eight times as wide, at last in one piece.

    Returns `doc_id, n_bytes, n_tokens, over_limit` (more than `limit` tokens).

    Null text counts as empty and has no tokens. Null and repeated ids are
    documents like others. An empty table gives no rows.
    """
    ship(documents.sparkSession)
    text = text_of(documents)
    rows = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary, ranks)
        for batch in batches:
            n = own.counts(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    schema = "doc_id long, n_bytes long, n_tokens long"
    counted = rows.filter(F.length("text") <= huge).mapInArrow(count, schema)
    large = stage(rows.filter(F.length("text") > huge).withColumn("row", F.monotonically_increasing_id()))
    while True:
        tried = stage(_spliced(large, vocabulary, ranks, chunk, overlap))
        counted = counted.union(tried.filter("aligned").select("doc_id", "n_bytes", "n_tokens"))
        failed = tried.filter("not aligned").select("row")
        if not failed.take(1):
            break
        large = stage(large.join(failed, "row", "left_semi"))
        overlap *= WIDER
        chunk = max(chunk, 2 * overlap)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def chunks_of(n: int, chunk: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Start and end of each chunk; each but the last reaches `overlap` into the next."""
    starts = range(0, max(1, n), chunk)
    for start in starts:
        yield start, min(n, start + chunk + overlap)


def stable(text: str, start: int, ends: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """(place, tokens before it) of the chunk's token boundaries in low..high at which a space follows a word."""
    found = []
    first, last = np.searchsorted(ends, [low - start, high - start])
    for i in range(first, last):
        at = int(ends[i])
        whole = i + 1 == len(ends) or ends[i + 1] > at  # not a token that ends inside a code point
        if whole and 0 < at < len(text) and text[at] == " " and text[at - 1].isalnum():
            found.append((start + at, i + 1))
    return found


def _spliced(large: DataFrame, vocabulary: str, ranks: str | None, chunk: int, overlap: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                spans = list(chunks_of(len(text), chunk, overlap))
                for at in range(0, len(spans), 64):
                    part = spans[at : at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row] * len(part), pa.int64()),
                            pa.array([s for s, _ in part], pa.int64()),
                            pa.array([text[s:e] for s, e in part], pa.string()),
                        ],
                        names=["row", "start", "text"],
                    )

    places = "array<struct<place: long, before: long>>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary, ranks)
        kind = pa.list_(pa.struct([("place", pa.int64()), ("before", pa.int64())]))
        for batch in batches:
            totals, heads, tails = [], [], []
            for start, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                ends = own.ends(text)
                totals.append(len(ends))
                for to, low in ((heads, start), (tails, start + chunk)):
                    found = stable(text, start, ends, low, low + overlap)
                    to.append([{"place": p, "before": b} for p, b in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(totals, pa.int64()),
                    pa.array(heads, kind),
                    pa.array(tails, kind),
                ],
                names=["row", "start", "total", "head", "tail"],
            )

    pieces = large.select("row", "text").mapInArrow(cut, "row long, start long, text string")
    pieces = pieces.repartition(F.col("row"), F.col("start"))
    encoded = pieces.mapInArrow(encode, f"row long, start long, total long, head {places}, tail {places}")
    along = Window.partitionBy("row").orderBy("start")
    common: Callable = lambda t, h: F.exists(h, lambda x: x["place"] == t["place"])
    joint = F.get(F.filter("tail", lambda t: common(t, F.col("next_head"))), 0)
    seams = (
        encoded.withColumn("next_head", F.lead("head").over(along))
        .withColumn("joint", joint)
        .withColumn("met", F.lag("joint").over(along))
        .withColumn("first", F.lag("start").over(along).isNull())
    )
    begun = F.get(F.filter("head", lambda h: h["place"] == F.col("met")["place"]), 0)
    last = F.col("next_head").isNull()
    begin = F.when(F.col("first"), 0).otherwise(begun["before"])
    end = F.when(last, F.col("total")).otherwise(F.col("joint")["before"])
    sums = (
        seams.withColumns({"tokens": end - begin, "good": last | F.col("joint").isNotNull()})
        .groupBy("row")
        .agg(F.sum("tokens").alias("n_tokens"), F.min("good").alias("aligned"))
    )
    return large.select("row", "doc_id", "n_bytes").join(sums, "row")
