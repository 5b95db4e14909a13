"""Collocations of two to four words, mined with sorted occurrence relations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import ship, text_of
from tripmart.llm.packed import one_array, open_up, squeeze
from tripmart.llm.tables import Stages

LEAST, LONGEST = 30, 4
SCALE, COVER = 2_000_000, 80
TOP = 2000
UNKNOWN = "und"

#: What ends a piece, and what stands between words inside one.
SEPARATORS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Bytes as they are looked at: A to Z in lower case, one byte for all separators and one for all blanks.
FOLDED = bytes(
    ord("\n") if b in SEPARATORS else ord(" ") if b in BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
#: Occurrences of a chunk, about, and bytes of text that are split at once. A join of a chunk takes some fifty
#: bytes for each occurrence, and every core of an executor has a worker beside the JVM.
CHUNK_WORDS, SLICE = 1 << 21, 1 << 20
#: Words times languages of a chunk that are numbered by a table.
DENSE = 1 << 21
#: Groups in a row of the table that has them.
GROUPS = 1 << 13
#: Bits of an id for the place of a group in its chunk, and for the place of a chunk in its task.
GROUP_BITS, CHUNK_BITS = 29, 14
#: Bits of a tally for the count.
TIMES_BITS = 34


def words_of(text: bytes) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Slices of a folded text: the place of each word, and the words.

    Places of neighbours in a piece differ by one, all others by more. Slices end at separators.
    """
    start = base = 0
    while start < len(text):
        end = min(len(text), start + SLICE)
        if end < len(text):
            cut = text.rfind(b"\n", start, end)
            cut = cut if cut >= start else text.find(b"\n", end)
            end = len(text) if cut < 0 else cut + 1
        data = np.frombuffer(text, np.uint8, end - start, start)
        separator = data == ord("\n")
        inside = ~(separator | (data == ord(" ")))
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        at = np.flatnonzero(first)
        offsets = np.append((np.cumsum(inside, dtype=np.int32) - 1)[at], inside.sum()).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[inside].tobytes())]
        pieces = np.cumsum(separator, dtype=np.int32)
        yield base + pieces[at] + np.arange(len(at)), pa.Array.from_buffers(pa.string(), len(at), buffers)
        base += int(pieces[-1]) + len(at) + 1
        start = end


def mine(
    documents: DataFrame, least: int = LEAST, longest: int = LONGEST, scale: int = SCALE, cover: int = COVER
) -> DataFrame:
    """Phrases of 2 to `longest` words that occur `least` times or more, by how much their parts belong together.

    Texts, A to Z in lower case, are split into pieces at `. , ; : ! ?` and line
    ends (line feed to return), pieces into words at spaces and tabs. Everything
    is counted for each language. A phrase's count is that of all its
    occurrences within pieces, overlapping ones included.

    The relation of occurrences (chunk, place, group) is kept sorted by place,
    in chunks, as a table. For each length:

    1. Group-count: every chunk has one row for each of its groups, with its
       count; totals are taken over all chunks. A hot group is a row for each chunk.
    2. Semi-join: the rows of groups below `least` go, in the same pass, as they
       lie sorted beside their total; the others go back to their chunks.
    3. Merge-join: occurrences of frequent groups at neighbouring places of a
       piece, in order, are the occurrences of the next length. Both parts of a
       longer group are frequent, so no frequent group is missed.

    A phrase cut after its first k words has l and r occurrences of its parts,
    and the score floor(scale * a / (l + r)); the cut with the lowest score
    counts, the first of these. Arithmetic is exact. A phrase goes if a longer
    frequent one, of up to `longest` words, that holds its words in a row occurs
    `cover` percent as often or more.

    Returns `lang, phrase, size, a, l, r, n, score`; `n` are the words of the
    language. The result is read from tables that are deleted when Python ends.

    Null text counts as empty, a null language is `und`. Null and repeated ids
    and repeated rows are documents like others. An empty table gives no rows. A
    task holds one slice of text, 1 MB or a longer piece, with some thirty bytes
    for each of its bytes, and one chunk.
    """
    spark = documents.sparkSession
    ship(spark)
    texts = documents.select(F.coalesce(documents["lang"].cast("string"), F.lit(UNKNOWN)).alias("lang"), text_of(documents).alias("text"))
    stages = Stages(spark)
    relation = stages.stage(texts.mapInArrow(_occurrences, _FIRST))
    sizes = relation.select(F.explode(F.arrays_zip("of_lang", "of_words"))).select("col.*")
    sizes = stages.stage(sizes.groupBy(F.col("of_lang").alias("lang")).agg(F.sum("of_words").alias("n")))
    groups = relation.filter("start IS NOT NULL")
    groups = groups.select("chunk", "start", F.posexplode(F.arrays_zip("lang", "word", "times")))
    tally = F.shiftleft(F.col("start") + F.col("pos"), TIMES_BITS).bitwiseOR(F.col("col.times")).alias("tally")
    groups = groups.select("chunk", tally, "col.lang", "col.word")
    levels = []
    for size in range(1, longest + 1):
        keys = ["lang", "word"] if size == 1 else ["left", "right"]
        frequent = stages.stage(_frequent(groups, keys, least))
        levels.append(stages.stage(frequent.filter(F.col("id") == _own()).drop("chunk", "group")))
        if size == longest:
            break
        relation, before = stages.stage(
            frequent.select("chunk", "group", "id")
            .groupBy("chunk")
            .cogroup(relation.filter("n IS NOT NULL").select("chunk", "n", "places", "groups").groupBy("chunk"))
            .applyInArrow(_extended, _NEXT)
        ), (relation, frequent)
        stages.drop(*before)
        groups = relation.mapInArrow(_tallies, "chunk long, tally long, left long, right long")
    phrases = _phrases(levels)
    kept = stages.stage(_scored(phrases, scale, cover).join(F.broadcast(sizes), "lang"))
    stages.drop(relation, frequent, *levels, sizes)
    return kept.select("lang", "phrase", "size", "a", "l", "r", "n", "score")


def collocations(documents: DataFrame, top: int = TOP, **more: int) -> DataFrame:
    """The first `top` phrases of each language by score, count and phrase: `lang, rank, phrase, a, l, r, n, score`.

    See `mine` for phrases, scores and awkward rows. Each language is first cut
    to `top` in many parts, so that the last sort is of bounded size.
    """
    found = mine(documents, **more)
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts)).alias("part")
    some = found.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = some.filter(F.col("rank") <= top).withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _own() -> Column:
    """A number that only one group of one chunk has."""
    return F.shiftleft("chunk", GROUP_BITS).bitwiseOR(F.col("group"))


def _frequent(groups: DataFrame, keys: list[str], least: int) -> DataFrame:
    """The chunks' rows of groups that occur often enough, with an id for each group.

    The total `a` and the keys are given in one row of each group, that of its
    id. Group and count are one number, `tally`, while rows are exchanged.
    """
    alike = Window.partitionBy(*keys)
    held = groups.repartition(*keys).withColumns(
        {
            "group": F.shiftright("tally", TIMES_BITS),
            "times": F.col("tally").bitwiseAND(F.lit((1 << TIMES_BITS) - 1)),
        }
    )
    held = held.withColumn("own", _own())
    totals = held.withColumns({"a": F.sum("times").over(alike), "id": F.min("own").over(alike)})
    first = F.col("id") == F.col("own")
    named = [F.when(first, F.col(c)).alias(c) for c in ("a", *keys)]
    return totals.filter(F.col("a") >= least).select("chunk", "group", "id", *named)


_FIRST = (
    "chunk long, n long, places binary, groups binary, of_lang array<string>, of_words array<long>,"
    " start long, lang array<string>, word array<string>, times array<long>"
)
_NEXT = "chunk long, n long, places binary, groups binary, size long, left binary, right binary, times binary"


def _rows(schema: str, relation: dict, groups: dict[str, pa.Array]) -> pa.Table:
    """A row with the occurrences of a chunk, and rows that have its groups, GROUPS each."""
    n = len(groups["times"])
    starts = range(0, n, GROUPS)
    columns = {}
    for field in schema.split(", "):
        name, kind = field.split()
        if name in groups:
            offsets = pa.array([0, 0, *[min(n, s + GROUPS) for s in starts]], pa.int32())
            columns[name] = pa.ListArray.from_arrays(offsets, groups[name])
        elif name in ("chunk", "start"):
            own = [relation["chunk"]] * (1 + len(starts)) if name == "chunk" else [None, *starts]
            columns[name] = pa.array(own, pa.int64())
        else:
            kinds = {"long": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
            columns[name] = pa.array([relation[name], *[None] * len(starts)], kinds.get(kind, pa.list_(pa.int64())))
    return pa.table(columns)


class _Chunk:
    """Occurrences of a task's texts, until there are enough for a row of the relation."""

    def __init__(self, name: int) -> None:
        self.name, self.n, self.base = name, 0, 0
        self.places: list[np.ndarray] = []
        self.words: list[pa.DictionaryArray] = []
        self.langs: list[str] = []

    def add(self, lang: str, places: np.ndarray, words: pa.Array) -> None:
        if not len(words):
            return
        self.places.append(self.base + places)
        self.words.append(words.dictionary_encode())
        self.langs.append(lang)
        self.n += len(words)
        self.base += int(places[-1]) + 2

    def rows(self) -> Iterator[pa.RecordBatch]:
        words = pa.chunked_array(self.words).unify_dictionaries()
        names, own = np.unique(np.array(self.langs, object), return_inverse=True)
        dictionary = words.chunk(0).dictionary
        sizes = [len(c) for c in words.chunks]
        keys = np.repeat(own * len(dictionary), sizes)
        keys += np.concatenate([c.indices.to_numpy() for c in words.chunks])
        if len(names) * len(dictionary) <= DENSE:  # numbered without sorting
            times = np.bincount(keys, minlength=len(names) * len(dictionary))
            groups = (np.cumsum(times > 0, dtype="<i4") - 1)[keys]
            keys = np.flatnonzero(times)
            times = times[keys]
        else:
            keys, groups, times = np.unique(keys, return_inverse=True, return_counts=True)
        held = pa.array(names.tolist(), pa.string())
        relation = {
            "chunk": self.name,
            "n": self.n,
            "places": _packed(np.concatenate(self.places)),
            "groups": squeeze(groups.astype("<i4", copy=False)),
            "of_lang": names.tolist(),
            "of_words": np.bincount(own, sizes).astype(np.int64).tolist(),
        }
        whole = {
            "lang": held.take(pa.array(keys // len(dictionary))),
            "word": dictionary.take(pa.array(keys % len(dictionary))),
            "times": pa.array(times, pa.int64()),
        }
        table = _rows(_FIRST, relation, whole)
        for at in range(0, len(table), 8):
            yield from table.slice(at, 8).combine_chunks().to_batches()


def _packed(places: np.ndarray) -> bytes:
    return squeeze(np.diff(places, prepend=0).astype("<i8"))


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of occurrences of words, with the words and how often the chunk has them."""
    task, chunks = TaskContext.get().partitionId(), 0
    chunk = _Chunk(task << CHUNK_BITS)
    for batch in batches:
        langs = one_array(pa.chunked_array([batch.column(0)])).dictionary_encode()
        own = langs.indices.to_numpy()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column(1).take(pa.array(np.flatnonzero(own == code)))
            for places, words in words_of("\n".join(texts.to_pylist()).encode().translate(FOLDED)):
                chunk.add(lang, places, words)
                if chunk.n >= CHUNK_WORDS:
                    yield from chunk.rows()
                    chunks += 1
                    if chunks >> CHUNK_BITS:
                        raise OverflowError("too much text for one task; make the input's partitions smaller")
                    chunk = _Chunk(task << CHUNK_BITS | chunks)
    if chunk.n:
        yield from chunk.rows()


def _extended(frequent: pa.Table, relation: pa.Table) -> pa.Table:
    """Semi-join and merge-join of a chunk: the occurrences of the next length, with its groups and their counts."""
    if not len(relation) or not len(frequent):
        return _NEXT_TABLE.empty_table()
    held = relation.to_pylist()[0]
    places = np.cumsum(open_up(held["places"], "<i8", held["n"]))
    groups = open_up(held["groups"], "<i4", held["n"])
    ids = np.full(max(int(groups.max()), int(max(frequent.column("group").to_numpy()))) + 1, -1, np.int64)
    ids[frequent.column("group").to_numpy()] = frequent.column("id").to_numpy()
    kept = (ids >= 0)[groups]
    places, groups = places[kept], groups[kept]
    beside = np.diff(places) == 1
    n = int(beside.sum())
    if not n:
        return _NEXT_TABLE.empty_table()
    relation = {"chunk": held["chunk"], "n": n, "places": _packed(places[:-1][beside])}
    del places, kept
    keys = groups[:-1][beside].astype(np.int64)
    keys *= len(ids)
    keys += groups[1:][beside]
    del groups, beside
    order = np.argsort(keys)  # what np.unique does, in less memory
    keys = keys[order]
    first = np.append(True, keys[1:] != keys[:-1])
    own = np.empty(n, "<i4")
    own[order] = np.cumsum(first, dtype="<i4") - 1
    del order
    relation["groups"] = squeeze(own)
    del own
    keys = keys[first]
    times = np.diff(np.flatnonzero(first), append=n)
    relation |= {"size": len(keys), "left": squeeze(ids[keys // len(ids)]), "right": squeeze(ids[keys % len(ids)])}
    relation["times"] = squeeze(times.astype("<i4"))
    return pa.Table.from_pylist([relation], _NEXT_TABLE)


_NEXT_TABLE = pa.schema([(f.split()[0], {"long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in _NEXT.split(", ")])


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each group of a chunk: its place in the chunk with its count in one number, and its parts."""
    for batch in batches:
        for row in batch.to_pylist():
            size = row["size"]
            left, right = (open_up(row[side], "<i8", size) for side in ("left", "right"))
            times = open_up(row["times"], "<i4", size).astype(np.int64)
            tally = np.arange(size) << TIMES_BITS | times
            for at in range(0, size, 8 * GROUPS):
                some = [pa.array(x[at : at + 8 * GROUPS]) for x in (tally, left, right)]
                chunk = pa.array(np.full(len(some[0]), row["chunk"]))
                yield pa.RecordBatch.from_arrays([chunk, *some], names=["chunk", "tally", "left", "right"])


def _phrases(levels: list[DataFrame]) -> DataFrame:
    """Frequent phrases of two words and more, with the counts of their beginnings and ends, and the phrases in them.

    `first` has the counts of the first 1, 2 ... words, `last` of the last 1, 2 ...
    words, `inside` the shorter phrases that lie in a row, each as size and id.
    """
    nothing = F.array().cast("array<struct<size: int, id: long>>")
    known = levels[0].select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("end"), F.array("a").alias("first"),
        F.array("a").alias("last"), nothing.alias("inside"),
    )
    found = []
    for size, level in enumerate(levels[1:], 2):
        left = known.select(F.col("id").alias("left"), "lang", "phrase", "first", F.col("inside").alias("in_left"))
        right = known.select(F.col("id").alias("right"), "end", "last", F.col("inside").alias("in_right"))
        part = lambda c, size=size: F.struct(F.lit(size - 1).alias("size"), F.col(c).alias("id"))
        parts = F.array(part("left"), part("right")) if size > 2 else nothing
        known = level.join(left, "left").join(right, "right").select(
            "id",
            "lang",
            F.concat_ws(" ", "phrase", "end").alias("phrase"),
            "end",
            F.concat("first", F.array("a")).alias("first"),
            F.concat("last", F.array("a")).alias("last"),
            F.array_distinct(F.concat("in_left", "in_right", parts)).alias("inside"),
        )
        found.append(known.select(F.lit(size).alias("size"), "*", F.element_at("first", -1).alias("a")).drop("end"))
    return _united(found)


def _united(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _scored(phrases: DataFrame, scale: int, cover: int) -> DataFrame:
    """Phrases that no longer one covers, with the cut that has the lowest score."""
    longer = phrases.select("a", F.explode("inside").alias("part"))
    longer = longer.groupBy("part.size", "part.id").agg(F.max("a").alias("most"))
    big = "decimal(20,0)"
    covered = F.expr(f"100 * cast(most AS {big}) >= {cover} * cast(a AS {big})")
    free = phrases.join(longer, ["size", "id"], "left").filter(~F.coalesce(covered, F.lit(False)))
    cut = F.expr(
        f"""array_min(transform(sequence(1, size - 1), k -> named_struct(
          'score', {scale} * cast(a AS {big}) div (cast(first[k - 1] AS {big}) + cast(last[size - k - 1] AS {big})),
          'k', k, 'l', first[k - 1], 'r', last[size - k - 1])))"""
    )
    scored = free.withColumn("cut", cut)
    return scored.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (
  SELECT row_number() OVER () AS row, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
places AS (SELECT row, lang, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM words),
rows AS (
  SELECT lang, w, lead(w) OVER o AS x, lead(w, 2) OVER o AS y, lead(w, 3) OVER o AS z FROM places
  WINDOW o AS (PARTITION BY row ORDER BY i)),
grams AS (
  SELECT lang, [w] AS p FROM rows UNION ALL SELECT lang, [w, x] FROM rows WHERE x IS NOT NULL
  UNION ALL SELECT lang, [w, x, y] FROM rows WHERE y IS NOT NULL
  UNION ALL SELECT lang, [w, x, y, z] FROM rows WHERE z IS NOT NULL),
counts AS MATERIALIZED (SELECT lang, p, [lang] || p AS q, count(*) AS f FROM grams GROUP BY lang, p),
candidates AS (SELECT * FROM counts WHERE f >= 30 AND len(p) > 1),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, k, x.f AS l, y.f AS r,
    CAST(CAST(2000000 AS HUGEINT) * c.f // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) c
  JOIN counts x ON x.q = [c.lang] || c.p[1 : k] JOIN counts y ON y.q = [c.lang] || c.p[k + 1 :]),
lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
longer AS (
  SELECT lang, p[i : i + k - 1] AS p, max(f) AS most FROM (
    SELECT lang, p, f, k, unnest(range(1, len(p) - k + 2)) AS i FROM candidates, range(2, 4) t(k) WHERE len(p) > k)
  GROUP BY lang, p[i : i + k - 1]),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
    array_to_string(p, ' ') AS phrase, a, l, r, n, score
  FROM lowest LEFT JOIN longer USING (lang, p) JOIN sizes USING (lang)
  WHERE most IS NULL OR CAST(100 AS HUGEINT) * most < CAST(80 AS HUGEINT) * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
