"""Mixing sources to target weights by hash-random keys and distributed prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import BLANK, WORD, running_totals, stage, text_of
from tripmart.llm.rows import whole_row

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Words to take of each source, and where it begins in the order of sources.

    `sources` has `src` and `source_size`. Sources in the order of `src` get
    the weights in turn. Together they take as many words as there are; none
    takes more than `max_epochs` times its size, and what goes beyond is shared
    among the others by weight. With sources sorted by size over weight, those
    at their limit are a prefix, so the share of one unit of weight follows from
    prefix sums: the first source whose limit is not below the share that it
    and all later sources would have.

    Adds `weight`, `target` (double) and `base` (words of all sources before).
    """
    placed = running_totals(sources, [F.col("src")], place=F.lit(1), base=F.col("source_size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = stage(
        placed.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int"))).drop("place")
    )
    totals = weighed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    words, all_weights = totals["words"] or 0, totals["weights"] or 0
    limit = F.col("source_size") * max_epochs
    level = limit / F.col("weight")
    sorted_ = running_totals(weighed, [level, F.col("src")], full=limit, light=F.col("weight"))
    share = (F.lit(words) - F.col("full")).cast("double") / (F.lit(all_weights) - F.col("light")).cast("double")
    unit = sorted_.filter(share <= level).agg(F.min(F.struct(F.col("light"), share.alias("share"))).alias("m")).first()
    per_weight = unit["m"]["share"] if unit["m"] is not None else 0.0
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(per_weight))
    return weighed.withColumn("target", target)


def mix(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 0
) -> DataFrame:
    """The words that the mix takes of each document, without the `text_hash` of `shares`."""
    return shares(documents, weights, max_epochs, seed).drop("text_hash")


def mixed_documents(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 0
) -> DataFrame:
    """The mix itself: documents, all columns, once for each time that they are taken whole.

    A document at which a budget is cut comes once more with its text up to the
    cut; its `n_chars`, if there is such a column, is that of the shorter text.
    Rows with the same id, source and text take part together.
    """
    words = shares(documents, weights, max_epochs, seed)
    whole = F.col("epochs") + F.when(F.col("extra") == F.col("size"), 1).otherwise(0)
    part = F.when((F.col("extra") > 0) & (F.col("extra") < F.col("size")), F.col("extra"))
    taken = words.filter("taken > 0").groupBy("doc_id", "source", "text_hash")
    taken = stage(taken.agg(F.sum(whole).cast("int").alias("whole"), F.collect_list(part).alias("parts"), F.count("*").alias("rows")))
    text, source = text_of(documents), documents["source"].cast("string")
    rows = documents.select(  # the document's columns in one struct, where no name can clash
        whole_row(documents).alias("row"),
        documents["doc_id"].alias("id"),
        source.alias("origin"),
        F.xxhash64(text).alias("hash"),
    )
    if taken.filter("rows > 1").take(1):
        rows = rows.dropDuplicates(["id", "origin", "hash"])
    same = (
        rows["id"].eqNullSafe(taken["doc_id"])
        & rows["origin"].eqNullSafe(taken["source"])
        & (rows["hash"] == taken["text_hash"])
    )
    copies = F.concat(F.array_repeat(F.lit(None).cast("long"), F.col("whole")), F.col("parts"))
    some = rows.join(taken, same).select("row", F.explode(copies).alias("cut"))
    worded = F.regexp_extract_all(F.col("row")["text"], F.lit(f"{BLANK[:-1]}*{WORD}"), F.lit(0))
    cut = F.array_join(F.slice(worded, 1, F.col("cut").cast("int")), "")
    some = some.withColumn("text", F.when(F.col("cut").isNull(), F.col("row")["text"]).otherwise(cut))
    changed = {"text": F.col("text")}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        kept = F.when(F.col("cut").isNull(), F.col("row")["n_chars"])
        changed["n_chars"] = kept.otherwise(F.length("text")).cast(kind)
    return some.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in documents.columns])


def shares(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 0
) -> DataFrame:
    """How many words of each document the mix takes.

    A document's size is its number of words. Documents get a key from a hash of
    `seed` and their id, and are range-sorted by source and key; the words before
    a document in its source are a distributed prefix sum. A source's budget is
    its target, rounded. Whole epochs are taken of every document; what is left
    of the budget is cut off the sorted documents at that very word, so at most
    one document of a source is taken in part.

    Returns `doc_id, source, size, source_size, target, epochs, extra, taken,
    text_hash`:
    `taken = epochs * size + extra`, with `extra` words from the document's start.

    Null text has size 0, a null source is a source of its own (the last), a null
    id is keyed like the text "null". Rows that repeat an id are documents of
    their own; they share a key and are ordered by size and a hash of the text. A document without
    words, or a source of them, is taken 0 times. An empty table gives no rows.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(documents["doc_id"].cast("string"), F.lit("null"))))
    source = documents["source"].cast("string")
    sizes = stage(
        documents.select(
            documents["doc_id"],
            F.when(source.isNull(), "t").otherwise(F.concat(F.lit("s"), source)).alias("src"),
            F.regexp_count(text_of(documents), F.lit(WORD)).cast("long").alias("size"),
            F.conv(F.substring(key, 1, 8), 16, 10).cast("long").alias("key"),
            F.xxhash64(text_of(documents)).alias("text_hash"),
        )
    )
    sources = targets(sizes.groupBy("src").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    n = sizes.count()
    order = [F.col("src"), F.col("key"), F.col("doc_id"), F.col("size"), F.col("text_hash")]
    placed = running_totals(sizes, order, n, before=F.col("size")).join(sources, "src")
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = F.col("budget") - F.col("epochs") * F.col("source_size") - (F.col("before") - F.col("base"))
    return (
        placed.withColumns({"budget": budget, "epochs": epochs})
        .withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), rest)))
        .select(
            "doc_id",
            F.when(F.col("src") != "t", F.expr("substring(src, 2)")).alias("source"),
            "size",
            "source_size",
            "target",
            "epochs",
            "extra",
            (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"),
            "text_hash",
        )
    )


SQL = """
WITH sizes AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS src,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) AS key
  FROM documents),
sources AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY src),
weighed AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY src) - 1) % 3] AS weight FROM sources),
shares AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) / weight AS level,
    CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS DOUBLE)
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS share
  FROM weighed
  WINDOW w AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
unit AS (SELECT first(share ORDER BY level, src) AS share FROM shares WHERE share <= level),
budgets AS (
  SELECT src, source_size, least(CAST(3 * source_size AS DOUBLE), weight * (SELECT share FROM unit)) AS target
  FROM weighed),
placed AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget, coalesce(sum(size) OVER (
    PARTITION BY src ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes JOIN budgets USING (src)),
counted AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, CASE WHEN src <> 't' THEN substr(src, 2) END AS source, size, source_size, target, epochs,
  CAST(greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS extra,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM counted
"""
