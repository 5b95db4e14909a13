"""Document fingerprints from closed syncmers, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import BLANK, lower_ascii, running_totals, stage, text_of

#: Words of a k-mer, and of the inner substrings whose least hash is looked for.
K, S = 8, 2
#: Most anchors in a fingerprint: no bound, it has every distinct one.
SKETCH = None


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add `out`, the text's closed syncmers: array of (place, hash), by place.

    A k-mer is eight consecutive words, A to Z in lower case; inside it lie seven
    pairs of neighbouring words. It is an anchor if the least hash among these
    pairs belongs to the first or the last of them. Whether it is one depends on
    its own words alone, so a passage has the same anchors in any document, and
    equal hashes in two documents mark places that match. A text with words but
    without such a k-mer has one anchor, its whole sequence of words; a text
    without words has none.
    """
    inner = K - S
    words = F.filter(F.split(lower_ascii(F.col(text)), BLANK), lambda w: w != "")
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("hashes_") - S), lambda i: F.xxhash64(F.get("hashes_", i), F.get("hashes_", i + 1))
    )
    found = F.filter(
        F.sequence(F.lit(0), F.size("hashes_") - K),
        lambda i: F.least(F.get("pairs_", i), F.get("pairs_", i + inner))
        == F.least(*[F.get("pairs_", i + j) for j in range(inner + 1)]),
    )
    anchor = lambda i: F.struct(
        i.alias("place"), F.xxhash64(*[F.get("pairs_", i + j) for j in range(0, inner + 1, S)]).alias("hash")
    )
    whole = F.array(F.struct(F.lit(0).alias("place"), F.xxhash64("hashes_").alias("hash")))
    none = F.filter(whole, lambda _: F.lit(False))
    return (
        df.withColumn("hashes_", F.transform(words, lambda w: F.xxhash64(w)))
        .withColumn("pairs_", F.when(F.size("hashes_") >= K, pairs))
        .withColumn("found_", F.when(F.size("hashes_") >= K, found))
        .withColumn(
            out,
            F.when(F.size("found_") > 0, F.transform("found_", anchor)).when(F.size("hashes_") > 0, whole).otherwise(none),
        )
        .drop("hashes_", "pairs_", "found_")
    )


def sketch(anchors: Column) -> Column:
    """The distinct anchors' hashes, all of them, cut to their upper 32 bits, sorted: array of int."""
    hashes = F.transform(anchors, lambda a: F.shiftright(a["hash"], 32).cast("int"))
    return F.array_sort(F.array_distinct(hashes))


def written(sketched: Column) -> Column:
    """A sketch as text: eight hexadecimal digits for each anchor."""
    digits = lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")
    return F.array_join(F.transform(sketched, digits), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two documents' distinct anchors, from their sketches.

    Two empty sketches are alike (1), an empty and another are not (0).
    """
    both = F.size(F.array_intersect(a, b))
    of = F.size(a) + F.size(b) - both
    return F.when(of == 0, F.lit(1.0)).otherwise(both / of)


def fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprint every document and its edited text, and compare.

    A document's next one is the next by falling id (null ids last, equal ids
    by a hash of the text); after the last comes the first. The edited text is
    the document with its last floor(n/2) code points replaced by the first as
    many of the next, or all if it has fewer.

    Returns `doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_anchors, anchors`. A fingerprint has every distinct
    anchor, and `near_*` compare all of them; `anchors` are the document's own
    with their places, as of `with_anchors`.

    Null text counts as empty. Rows that repeat both id and text count as one
    document, and its result is repeated as often. A single document is its own
    next. An empty table gives no rows.

    The order is found on ids alone. The text is shuffled once by id, then only
    as much of it as the document before needs goes there, with the sketch. A
    document's own anchors are made again there, which takes
    less disk than sending them.
    """
    text = text_of(documents)
    base = documents.select(
        F.coalesce(documents["doc_id"].cast("long"), F.lit(-(1 << 63))).alias("id_"),
        documents["doc_id"].isNull().alias("null_"),
        F.xxhash64(text).alias("hash_"),
        text.alias("text_"),
    )
    key = ["id_", "null_", "hash_"]
    ids = base.groupBy(*key).agg(F.first(F.length("text_")).cast("long").alias("n_"), F.count("*").alias("copies_"))
    order = [F.col("null_"), F.col("id_").desc(), F.col("hash_")]
    n = base.count()
    placed = stage(running_totals(ids, order, n, place_=F.lit(1)), n)
    seen = placed.agg(F.count("*").alias("n"), F.max("copies_").alias("copies")).first()
    after = F.when(F.col("place_") == seen["n"] - 1, 0).otherwise(F.col("place_") + 1)
    reader = placed.select(
        after.alias("place_"), *[F.col(c).alias(f"to_{c}") for c in key], F.floor(F.col("n_") / 2).alias("half_")
    )
    links = placed.join(reader, "place_").drop("place_")
    own = base.join(links, key)
    if (seen["copies"] or 1) > 1:
        own = own.dropDuplicates(key)
    given = with_anchors(own, "text_", "anchors_").select(
        *[F.col(f"to_{c}").alias(c) for c in key],
        F.expr("substring(text_, 1, cast(half_ as int))").alias("head_"),
        sketch(F.col("anchors_")).alias("next_"),
    )
    kept = F.expr("substring(text_, 1, cast(n_ - floor(n_ / 2) as int))")
    both = own.select(*key, "text_", "n_", "copies_").join(given, key).withColumn("edited_", F.concat(kept, "head_"))
    edited = with_anchors(both, "text_", "anchors").withColumn("sketch_", sketch(F.col("anchors")))
    edited = with_anchors(edited, "edited_", "anchors_").withColumn("edited_sketch_", sketch(F.col("anchors_")))
    result = edited.withColumn("copy_", F.explode(F.sequence(F.lit(1), F.col("copies_"))))
    return result.select(
        F.when(~F.col("null_"), F.col("id_")).alias("doc_id"),
        F.col("n_").alias("n_chars"),
        F.sha2(F.col("edited_").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("sketch_")).alias("fingerprint"),
        written(F.col("edited_sketch_")).alias("edited_fingerprint"),
        likeness(F.col("sketch_"), F.col("edited_sketch_")).alias("near_edited"),
        likeness(F.col("sketch_"), F.col("next_")).alias("near_next"),
        F.size("anchors").cast("long").alias("n_anchors"),
        "anchors",
    )
