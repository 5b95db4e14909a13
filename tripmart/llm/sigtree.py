"""Join of documents by Jaccard similarity of word shingles, with signature trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import WORD, ship, stage, text_bytes, text_of
from tripmart.llm.components import components
from tripmart.llm.lm import MIX
from tripmart.llm.packed import bucket_cuts, one_array, open_sorted, open_up, split_words, squeeze, squeeze_sorted, word_hashes
from tripmart.llm.rows import unwrapped, whole_row

WORDS, SIMILARITY = 5, 80
#: Counters of the table that tells rare shingles from common ones, and the rows it travels in.
COUNTERS, SLICES = 1 << 20, 16
#: Bytes of text for each bucket of the inverted lists.
BUCKET_BYTES = 16 << 20
#: A shingle that more documents may have is dealt into cells of so many.
CELL = 1 << 15
#: Prefix entries of one flush of a task.
FLUSH = 1 << 20
#: Documents of a leaf of the tree, and children of a node.
LEAF, FANOUT = 16, 8
#: Candidates for each document of a list in the first round; each later round takes sixteen times as many.
CANDIDATES, MORE = 64, 16
#: Rows of the lists with one centre that may be looked at together.
TOGETHER = 1 << 20
#: Rows, and bytes of sets, of a part of a tree in the search for all links; every two parts meet in a task.
PART_ROWS, PART_BYTES = 1 << 10, 4 << 20
#: Bits of a bitmap for each shingle, at least: of all documents', and of those in trees, whose levels use a quarter.
NARROW, WIDE, QUARTER = 2, 16, 4
#: Narrow rows that take as much room in a file as a set or a bitmap.
WIDE_ROWS = 25
#: Up to so many ids are broadcast to pick the documents whose sets are needed; more are joined.
BROADCAST_IDS = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX[1]
        x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def ordered(keys: np.ndarray) -> np.ndarray:
    """Unsigned keys as signed numbers of the same order."""
    return (keys ^ np.uint64(1 << 63)).view(np.int64)


def shingle_sets(texts: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of `size` words; of all words if it has fewer."""
    places, starts, words = split_words(texts, lower=True)
    hashes = word_hashes(words)[places] if len(places) else np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        rolling = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
        for j in range(size):
            rolling = mixed((rolling + hashes[j : len(hashes) - size + 1 + j]) * MIX[0]) if len(rolling) else rolling
        sets = []
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if end - start >= size:
                sets.append(np.unique(rolling[start : end - size + 1]))
                continue
            whole = np.full(min(1, end - start), end - start, np.uint64)
            for word in hashes[start:end]:
                whole = mixed((whole + word) * MIX[0])
            sets.append(whole)
    return sets


def set_id(found: np.ndarray) -> int:
    """A name that equal sets share."""
    with np.errstate(over="ignore"):
        total = mixed(found + MIX[0]).sum(dtype=np.uint64) * MIX[1] + np.uint64(len(found))
    return int(mixed(np.array([total]))[0].astype(np.int64))


def bitmap(found: np.ndarray, share: int) -> bytes:
    """A bit for each hash, in a map of at least `share` bits for each of them, a power of two."""
    width = max(64 * QUARTER, 1 << (share * len(found) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(found & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(maps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps of fewer 64-bit words: the upper half is laid over the lower one."""
    while maps.shape[1] > words:
        half = maps.shape[1] // 2
        maps = maps[:, :half] | maps[:, half:]
    return maps


class Tree:
    """A hierarchy over documents: a node has its documents' bitmaps or-ed together and the range of their sizes."""

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, classes: np.ndarray) -> None:
        slack = sizes - _bits(maps)
        self.levels = [(maps, sizes, sizes, slack, classes)]
        width = LEAF
        while len(self.levels[-1][0]) > 1:
            maps, low, high, slack, classes = self.levels[-1]
            cuts = np.arange(0, len(maps), width)
            same = np.minimum.reduceat(classes, cuts) == np.maximum.reduceat(classes, cuts)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, cuts, axis=0),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                    np.maximum.reduceat(slack, cuts),
                    np.where(same, classes[cuts], -1),
                )
            )
            width = FANOUT

    def level(self, n: int) -> tuple[np.ndarray, ...]:
        """A level by its height; above the root it is the root again."""
        return self.levels[min(n, len(self.levels) - 1)]

    def children(self, nodes: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray]:
        """Children of nodes at a height, one level down, and which node each is of."""
        if height >= len(self.levels):
            return nodes, np.arange(len(nodes))
        width = LEAF if height == 1 else FANOUT
        first = nodes * width
        n = np.minimum(width, len(self.levels[height - 1][0]) - first)
        own = np.repeat(np.arange(len(nodes)), n)
        return first[own] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), own


def dual_traversal(a: Tree, b: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of documents, one of each tree, of different classes, that may be similar enough.

    Both trees are gone down together. A pair of nodes is left out if all their
    documents are of one class, if no two sizes fit, or if their bitmaps have too
    few bits in common: two documents share at most as many shingles as bits,
    plus those of either that share a bit with another. With one tree on both
    sides each pair comes once.
    """
    height = max(len(a.levels), len(b.levels)) - 1
    left, right = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        left, right = _kept(a.level(height), b.level(height), left, right)
        if height == 0:
            if a is b:
                different = left < right
                left, right = left[different], right[different]
            return left, right
        below, own = a.children(left, height)
        right = right[own]
        beside, own = b.children(right, height)
        left, right = below[own], beside
        height -= 1
        if a is b:
            once = left <= right
            left, right = left[once], right[once]


def _may_meet(a: tuple, b: tuple, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    maps_a, low_a, high_a, slack_a, class_a = (x[left] for x in a)
    maps_b, low_b, high_b, slack_b, class_b = (x[right] for x in b)
    common = _bits(maps_a & maps_b) + np.minimum(slack_a, slack_b)
    common = np.minimum(common, np.minimum(high_a, high_b))
    enough = (100 + SIMILARITY) * common >= SIMILARITY * (low_a + low_b)
    sizes = (100 * high_a >= SIMILARITY * low_b) & (100 * high_b >= SIMILARITY * low_a)
    return enough & sizes & ((class_a != class_b) | (class_a < 0))


def candidates(maps: list[bytes], sizes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in a list that may be similar and are of different classes.

    Documents are put into trees by the width of their bitmaps. Similar ones
    differ by a quarter in size, so by one width at most; the wider is folded.
    Trees have bitmaps folded to a quarter; pairs that they leave are held
    against each other by whole bitmaps.
    """
    widths = np.array([len(m) for m in maps]) // 8
    _, named = np.unique(classes, return_inverse=True)
    layers, found = {}, []
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        own = own[np.lexsort((sizes[own], named[own]))]
        wide = np.frombuffer(b"".join(maps[i] for i in own), np.uint64).reshape(len(own), width)
        layers[width] = own, wide
        for other in (width, width // 2):
            if other in layers:
                less, theirs = layers[other]
                pairs = _pairs(theirs, sizes[less], named[less], folded(wide, other), sizes[own], named[own], other == width)
                found.append((less[pairs[0]], own[pairs[1]]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _pairs(maps_a, sizes_a, classes_a, maps_b, sizes_b, classes_b, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in either of two lists of documents with bitmaps of one width."""
    less = max(1, maps_a.shape[1] // QUARTER)
    a = Tree(folded(maps_a, less), sizes_a, classes_a)
    b = a if same else Tree(folded(maps_b, less), sizes_b, classes_b)
    left, right = dual_traversal(a, b)
    leaf = lambda maps, sizes, classes: (maps, sizes, sizes, sizes - _bits(maps), classes)
    return _kept(leaf(maps_a, sizes_a, classes_a), leaf(maps_b, sizes_b, classes_b), left, right)


def _bits(maps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(maps).sum(axis=1, dtype=np.int64)


def _kept(a: tuple, b: tuple, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of nodes that may meet, looked at some at a time."""
    some = max(1, (1 << 21) // max(1, a[0].shape[1]))
    kept = [_may_meet(a, b, left[at : at + some], right[at : at + some]) for at in range(0, len(left), some)]
    kept = np.concatenate(kept) if kept else np.empty(0, bool)
    return left[kept], right[kept]


def similar_groups(documents: DataFrame, cell: int = CELL, per_document: int = CANDIDATES) -> DataFrame:
    """The group of every document: `doc_id, n_shingles, component_id`; see `grouped`."""
    return grouped(documents, cell, per_document).select("doc_id", "n_shingles", "component_id")


def one_of_each_group(documents: DataFrame) -> DataFrame:
    """The documents, all columns, without those that have a smaller one in their group.

    The one with the smallest id stays (null ids last, equal ids by a hash of
    the text). Documents without words are in no group, and all stay.
    """
    text = text_of(documents)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = grouped(documents).filter("root is not null").groupBy("root").agg(F.min(place).alias("kept"))
    kept = stage(kept.select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.text_hash").alias("kept_hash")))
    rows = documents.select(  # the document's columns in one struct, where no name can clash
        whole_row(documents).alias("row"),
        documents["doc_id"].cast("long").alias("id"),
        F.xxhash64(text).alias("hash"),
        F.coalesce(text.rlike(WORD), F.lit(False)).alias("worded"),
    )
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash"))
    found = rows.filter("worded").join(kept, same, "left_semi")
    if rows.groupBy("id", "hash").count().filter("count > 1").take(1):
        found = found.dropDuplicates(["id", "hash"])
    return unwrapped(found.union(rows.filter("not worded")), documents.columns)


def grouped(documents: DataFrame, cell: int = CELL, per_document: int = CANDIDATES) -> DataFrame:
    """Group documents that are linked by equal or nearly equal sets of word shingles.

    A document's set has the distinct shingles of five words, A to Z in lower
    case; with one to four words, the whole sequence; without words nothing.
    Documents are linked if the sets' intersection has at least 80 % of their
    union. No candidate is dropped anywhere, so every document ends in the
    component that all links together give.

    1. Equal sets are one class from here on.
    2. If two sets are linked, they share one of the rarest fifth of their
       shingles, in any common order. Rarity comes from a table of counters of
       fixed size. Classes meet in one inverted list for each of these shingles;
       a list that may be longer than `cell` is dealt into pairs of cells.
    3. Every class of a list is compared with the one that is in most lists, the
       likely origin of copies: bitmaps and sizes first, then whole sets. Links
       are contracted to components.
    4. Lists that still have several components are put together by the class
       that they were compared with, unless that gives too many rows, and get a
       signature tree, whose dual traversal leaves the pairs of different
       components that may be similar; these are compared by whole sets. A class
       brings at most `per_document` candidates a tree and round; rounds with
       more follow until none is left over.

    Returns `doc_id, text_hash, n_shingles, root, component_id`: the size of the
    set, a name of the component, null for documents without words, and the
    smallest id that links lead to, the document itself included.

    Null and empty texts have size 0 and are linked with nothing. Rows with a
    null id take part, but give no component its id. Rows that repeat an id are
    documents of their own. An empty table gives no rows.
    """
    rows, described, classes, lists, centres, links = _starred(documents, cell)
    n = classes.count()
    rest = lists.filter(F.size("members") > 2)
    while True:
        roots = components(links, n)
        pairs, left_over = _tree_pairs(rows, rest, centres, classes, roots, per_document, n)
        found = _verified(rows, classes, pairs, n)
        if found.take(1):
            links = links.union(found)
            roots = components(links, n)
        if not left_over:
            break
        per_document *= MORE
    return _named(described, classes, roots)


def similar_pairs(documents: DataFrame, cell: int = CELL) -> DataFrame:
    """Every link between two different sets, once: `a, b` (names of the sets), `first_a, first_b` (their smallest ids).

    Equal sets are one class; see `grouped` for sets and links. The result grows
    with the square of a group whose sets are all linked.
    """
    rows, _, classes, shared, lists = _listed(documents, cell)
    links = _tree_links(rows, lists, classes, shared, cell, classes.count(), pairs=True)
    first = lambda end: classes.select(F.col("set").alias(end), F.col("first_id").alias(f"first_{end}"))
    return links.join(first("a"), "a").join(first("b"), "b").select("a", "b", "first_a", "first_b")


def linked_documents(documents: DataFrame, cell: int = CELL) -> DataFrame:
    """The group of every document and its links: `doc_id, n_shingles, component_id, n_links`.

    Groups are those of `grouped`. `n_links` is how many other documents a
    document is linked with, those with an equal set included; 0 for documents
    without words. Every pair of different sets that may be linked is compared,
    also inside a group, but links are not written out: each unit of the search
    returns, for its classes, a spanning forest and the number of linked documents.
    """
    rows, described, classes, shared, lists = _listed(documents, cell)
    n = classes.count()
    found = _tree_links(rows, lists, classes, shared, cell, n, pairs=False)
    forest = found.select(F.col("set").alias("a"), F.col("root").alias("b"))
    grouped_ = _named(described, classes, components(forest, n), "set")
    others = found.groupBy("set").agg(F.sum("others").alias("others"))
    counts = classes.join(others, "set", "left").select(
        "set", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links")
    )
    return grouped_.join(counts, "set", "left").select(
        "doc_id", "n_shingles", "component_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links")
    )


def _starred(documents: DataFrame, cell: int) -> tuple[DataFrame, ...]:
    """Steps 1 to 3 of `grouped`: rows, described rows, classes, lists, their centres, and the links with centres."""
    rows, described, classes, _, lists = _listed(documents, cell)
    centres = _centres(lists)
    stars = lists.select("list", F.explode("members").alias("a")).join(centres, "list")
    stars = stars.select("a", F.col("centre").alias("b")).filter("a <> b").distinct()
    links = _verified(rows, classes, stars, classes.count())
    return rows, described, classes, lists, centres, links


def _listed(documents: DataFrame, cell: int) -> tuple:
    """Steps 1 and 2 of `grouped`: rows, described rows, classes, the broadcast counters, lists."""
    spark = documents.sparkSession
    ship(spark)
    text = text_of(documents)
    rows = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")
    )
    kinds = "doc_id long, text_hash long, n long, set long, map binary, slice int, counts binary"
    read = stage(rows.mapInArrow(_describe, kinds))
    described = read.filter("slice is null").select("doc_id", "text_hash", "n", "set", "map")
    classes = described.filter("n > 0").groupBy("set")
    classes = stage(classes.agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("map").alias("map"), F.count("*").alias("copies")))
    counters = _counters(read.filter("slice is not null").select("slice", "counts"))
    shared = spark.sparkContext.broadcast(counters)
    buckets = max(1, -(-text_bytes(documents) // BUCKET_BYTES))
    lists = stage(_lists(rows, shared, buckets, cell))
    return rows, described, classes, shared, lists


def _named(described: DataFrame, classes: DataFrame, roots: DataFrame, *more: str) -> DataFrame:
    """Every document with its component, and the columns `more`."""
    named = classes.join(roots, classes["set"] == roots["node"], "left").select(
        "set", F.coalesce("root", "set").alias("root"), "first_id"
    )
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = named.join(least, "root").select("set", "root", "component_id")
    return described.join(ids, "set", "left").select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        "root",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        *more,
    )


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's size, set and bitmap; then how many documents of the task have a shingle of each counter."""
    counts = np.zeros(COUNTERS, np.uint32)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("set", pa.int64()), ("map", pa.binary())]
        + [("slice", pa.int32()), ("counts", pa.binary())]
    )
    for batch in batches:
        sets = shingle_sets(batch.column(1))
        counts += np.bincount(
            (np.concatenate([*sets, np.empty(0, np.uint64)]) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS
        ).astype(np.uint32)
        n = len(sets)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([bitmap(s, NARROW) if len(s) else None for s in sets], pa.binary()),
                pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.binary()),
            ],
            schema=schema,
        )
    for i, part in enumerate(np.split(counts, SLICES)):
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(1, schema.field(j).type) for j in range(5)), pa.array([i], pa.int32()), pa.array([squeeze(part)])],
            schema=schema,
        )


def _counters(parts: DataFrame) -> np.ndarray:
    """The counters of all tasks added up; they have a fixed size."""
    size = COUNTERS // SLICES

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(size, np.uint64)
        for counts in group.column("counts").to_pylist():
            total += open_up(counts, "<u4", size)
        total = np.minimum(total, np.uint64(2**32 - 1)).astype("<u4")
        return pa.table({"slice": group.column("slice")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    counted = np.zeros((SLICES, size), np.uint32)
    for row in parts.groupBy("slice").applyInArrow(add, "slice int, counts binary").collect():
        counted[row["slice"]] = np.frombuffer(row["counts"], "<u4")
    return counted.ravel()


def prefix(found: np.ndarray, counters: np.ndarray) -> np.ndarray:
    """The rarest shingles of a set, so many that a linked set has one of them among its own rarest."""
    n = len(found) - (SIMILARITY * len(found) + 99) // 100 + 1
    rarity = counters[(found & np.uint64(COUNTERS - 1)).astype(np.int64)]
    return found[np.lexsort((found, rarity))[:n]]


def _lists(rows: DataFrame, shared, buckets: int, cell: int) -> DataFrame:
    """`list, members, times, rep`: the classes that share a shingle of their prefixes.

    `times` tells how many shingles (or cells of them) have this list, `rep` is the least of these.
    """

    def flush(tokens: list[np.ndarray], sets: list[int]) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate(tokens)
        own = np.repeat(np.array(sets, np.int64), [len(t) for t in tokens])
        keys, own = _dealt(keys, own, shared.value, cell)
        order = np.argsort(keys)
        keys, own = keys[order], own[order]
        cuts = bucket_cuts(keys, buckets)
        full = np.flatnonzero(np.diff(cuts))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(full, pa.int64()),
                pa.array([cuts[b + 1] - cuts[b] for b in full], pa.int64()),
                pa.array([squeeze_sorted(keys[cuts[b] : cuts[b + 1]]) for b in full], pa.binary()),
                pa.array([squeeze(own[cuts[b] : cuts[b + 1]]) for b in full], pa.binary()),
            ],
            names=["bucket", "n", "keys", "sets"],
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        tokens: list[np.ndarray] = []
        sets: list[int] = []
        entries = 0
        for batch in batches:
            for found in shingle_sets(batch.column(0)):
                if not len(found) or (name := set_id(found)) in seen:
                    continue
                seen.add(name)
                tokens.append(prefix(found, shared.value))
                sets.append(name)
                entries += len(tokens[-1])
                if entries >= FLUSH:
                    yield from flush(tokens, sets)
                    tokens, sets, entries = [], [], 0
        if tokens:
            yield from flush(tokens, sets)

    def meet(group: pa.Table) -> pa.Table:
        sent = group.to_pylist()
        keys = np.concatenate([open_sorted(r["keys"], r["n"]) for r in sent])
        sets = np.concatenate([open_up(r["sets"], "<i8", r["n"]) for r in sent])
        order = np.lexsort((sets, keys))
        keys, sets = keys[order], sets[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])
        keys, sets = keys[new], sets[new]
        starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1)))
        n = np.diff(np.append(starts, len(keys)))
        with np.errstate(over="ignore"):
            names = np.add.reduceat(mixed(sets.view(np.uint64) + MIX[0]), starts) * MIX[1] + n.astype(np.uint64)
        several = np.flatnonzero(n > 1)
        _, first, times = np.unique(names[several], return_index=True, return_counts=True)
        kept = several[first]
        at = np.repeat(starts[kept] - (np.cumsum(n[kept]) - n[kept]), n[kept]) + np.arange(n[kept].sum())
        bounds = np.concatenate([[0], np.cumsum(n[kept])])
        members = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sets[at], pa.int64()))
        reps = ordered(keys[starts[kept]])  # keys ascend, so the first that has a list is the least
        return pa.table(
            {"list": pa.array(names[kept].view(np.int64)), "members": members, "times": pa.array(times), "rep": pa.array(reps)}
        )

    sent = rows.select("text").mapInArrow(send, "bucket long, n long, keys binary, sets binary")
    met = sent.groupBy("bucket").applyInArrow(meet, "list long, members array<long>, times long, rep long")
    return met.groupBy("list").agg(
        F.first("members").alias("members"), F.sum("times").alias("times"), F.min("rep").alias("rep")
    )


def _centres(lists: DataFrame) -> DataFrame:
    """`list, centre`: the class of each list that shares most shingles with others."""
    members = lists.select("list", "times", F.explode("members").alias("a"))
    shared = members.groupBy("a").agg(F.sum("times").alias("weight"))
    first = members.join(shared, "a").groupBy("list").agg(F.max(F.struct("weight", "a")).alias("first"))
    return stage(first.select("list", F.col("first.a").alias("centre")))


def _dealt(keys: np.ndarray, sets: np.ndarray, counters: np.ndarray, cell: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of shingles that more than `cell` documents may have go to pairs of cells: every two sets meet in one."""
    often = counters[(keys & np.uint64(COUNTERS - 1)).astype(np.int64)]
    hot = np.flatnonzero(often > cell)
    if not len(hot):
        return keys, sets
    cool = np.setdiff1d(np.arange(len(keys)), hot, assume_unique=True)
    parts = -(-often[hot].astype(np.int64) // cell)
    own = (mixed(sets[hot].view(np.uint64) + MIX[2]) % parts.astype(np.uint64)).astype(np.int64)
    at = np.repeat(np.arange(len(hot)), parts)
    other = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
    low, high = np.minimum(own[at], other), np.maximum(own[at], other)
    with np.errstate(over="ignore"):
        cells = mixed(keys[hot][at] + mixed((low * (1 << 32) + high + 1).astype(np.uint64)))
    return np.concatenate([keys[cool], cells]), np.concatenate([sets[cool], sets[hot][at]])


def _verified(rows: DataFrame, classes: DataFrame, pairs: DataFrame, about: int) -> DataFrame:
    """The pairs (`a, b`) of linked classes: first by bitmaps and sizes, then by whole sets."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for n_a, map_a, n_b, map_b in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                width = min(len(map_a), len(map_b)) // 8
                a, b = (folded(np.frombuffer(m, np.uint64)[None], width) for m in (map_a, map_b))
                bits = [np.bitwise_count(m).sum() for m in (a, b, a & b)]
                common = min(bits[2] + min(n_a - bits[0], n_b - bits[1]), n_a, n_b)
                kept.append(bool((100 + SIMILARITY) * common >= SIMILARITY * (n_a + n_b)))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(kept, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"]
            )

    def side(df: DataFrame, end: str) -> DataFrame:
        return df.select(F.col("set").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in df.columns if c != "set"])

    known = classes.select("set", "n", "map")
    fitting = pairs.join(side(known, "a"), "a").join(side(known, "b"), "b")
    fitting = fitting.filter((100 * F.col("n_a") >= SIMILARITY * F.col("n_b")) & (100 * F.col("n_b") >= SIMILARITY * F.col("n_a")))
    left = fitting.select("a", "b", "n_a", "map_a", "n_b", "map_b").mapInArrow(possible, "a long, b long")
    left = stage(left.distinct(), about)
    if not left.take(1):
        return left
    needed = left.select(F.col("a").alias("set")).union(left.select(F.col("b").alias("set"))).distinct()
    needed = stage(needed.join(classes, "set").select("set", "first_id"), about)
    sets = _sets(rows, needed, "found")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for n_a, set_a, n_b, set_b in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                both = n_a + n_b - len(np.union1d(open_sorted(set_a, n_a), open_sorted(set_b, n_b)))
                kept.append(100 * both >= SIMILARITY * (n_a + n_b - both))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(kept, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"]
            )

    whole = left.join(side(sets, "a"), "a").join(side(sets, "b"), "b")
    links = whole.select("a", "b", "n_a", "found_a", "n_b", "found_b").mapInArrow(linked, "a long, b long")
    return stage(links.distinct(), about)


def _sets(rows: DataFrame, needed: DataFrame, what: str) -> DataFrame:
    """`set, n` of the needed classes with the whole set (`found`) or a wide bitmap (`map`), made again from a document."""
    ids = needed.select(F.col("first_id").alias("doc_id")).distinct()
    n = ids.count()
    if n <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    some = rows.join(ids, rows["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for s in shingle_sets(batch.column(0)) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_id(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([squeeze_sorted(s) if what == "found" else bitmap(s, WIDE) for s in sets], pa.binary()),
                ],
                names=["set", "n", what],
            )

    made = some.select("text").mapInArrow(make, f"set long, n long, {what} binary")
    return stage(made.join(needed.select("set"), "set", "left_semi").dropDuplicates(["set"]), WIDE_ROWS * n)


def _tree_pairs(
    rows: DataFrame,
    lists: DataFrame,
    centres: DataFrame,
    classes: DataFrame,
    roots: DataFrame,
    per_document: int,
    about: int,
) -> tuple[DataFrame, bool]:
    """Candidates of the lists with several components, and whether some were left over."""
    members = lists.select("list", F.explode("members").alias("set"))
    rooted = members.join(roots, members["set"] == roots["node"], "left").select(
        "list", "set", F.coalesce("root", "set").alias("root")
    )
    several = rooted.groupBy("list").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    counted = rooted.groupBy("list").agg(F.count("*").alias("rows")).join(several.select("list"), "list")
    counted = stage(counted.join(centres, "list"), about)
    large = counted.groupBy("centre").agg(F.sum("rows").alias("all")).filter(F.col("all") > TOGETHER)
    key = F.when(F.col("all").isNull(), F.col("centre")).otherwise(F.col("list")).alias("tree")
    trees = counted.join(large, "centre", "left").select("list", key)
    together = stage(rooted.join(trees, "list").select("tree", "set", "root").distinct(), about)
    needed = stage(together.select("set").distinct().join(classes, "set").select("set", "first_id"), about)
    maps = _sets(rows, needed, "map")
    dealt = together.join(maps, "set").select("tree", "set", "root", "n", "map")
    dealt = dealt.repartition("tree").sortWithinPartitions("tree", "set")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = pa.concat_tables([held, pa.table(batch)]) if held is not None else pa.table(batch)
            names = held.column("tree").to_numpy()
            done = int(np.searchsorted(names != names[-1], False)) if len(names) else 0
            if done:
                yield from _search(held.slice(0, done), per_document)
                held = held.slice(done)
        if held is not None and len(held):
            yield from _search(held, per_document)

    found = dealt.mapInArrow(search, "a long, b long, more boolean")
    found = stage(found.groupBy("a", "b").agg(F.max("more").alias("more")), about)
    return found.select("a", "b"), bool(found.filter("more").take(1))


def _search(table: pa.Table, per_document: int) -> Iterator[pa.RecordBatch]:
    """Candidates of whole lists, which follow each other in the table."""
    table = table.combine_chunks()
    names = table.column("tree").to_numpy()
    cuts = np.append(np.flatnonzero(np.diff(names, prepend=names[:1] - 1)), len(names))
    sets, roots, sizes = (table.column(c).to_numpy() for c in ("set", "root", "n"))
    maps = table.column("map").to_pylist()
    for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        left, right = candidates(maps[start:end], sizes[start:end], roots[start:end])
        if not len(left):
            continue
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        runs = np.flatnonzero(np.diff(left, prepend=-1))
        place = np.arange(len(left)) - np.repeat(runs, np.diff(np.append(runs, len(left))))
        kept = place < per_document
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(sets[start + left[kept]], pa.int64()),
                pa.array(sets[start + right[kept]], pa.int64()),
                pa.array(np.full(kept.sum(), not kept.all())),
            ],
            names=["a", "b", "more"],
        )


def _tree_links(
    rows: DataFrame, lists: DataFrame, classes: DataFrame, shared, cell: int, about: int, pairs: bool
) -> DataFrame:
    """What signature trees over all lists find: links (`a, b`), or for each class `set, root, others`.

    Lists with one centre form a tree, unless that gives too many rows. A tree
    is dealt into parts of bounded rows and bytes, and every two parts meet in
    one unit, each part with itself too. Narrow bitmaps leave the classes that
    may have a link in their unit; their sets are sent there, and what wide
    bitmaps leave of the pairs is compared by whole sets.

    Two classes may meet in several trees. The pair belongs to the tree that has
    the list of the least key that both prefixes hold. Both sets are at hand in
    a unit, and its rows carry the least keys of their lists, so a unit knows its
    own pairs. Of these it returns, without `pairs`, a spanning forest (`root` is
    a class that links of the unit lead to) and how many documents each class is
    linked with. That is a row for each class and unit, however many links.
    """
    of_list = lists.join(_centres(lists), "list")
    large = of_list.groupBy("centre").agg(F.sum(F.size("members")).alias("all")).filter(F.col("all") > TOGETHER)
    large = F.broadcast(large.select("centre", F.lit(True).alias("alone")))  # a row for 2^20 rows, at most
    key = F.when(F.col("alone"), F.col("list")).otherwise(F.col("centre")).alias("tree")
    members = of_list.join(large, "centre", "left").select(key, "rep", F.explode("members").alias("set"))
    together = stage(members.groupBy("tree", "set").agg(F.collect_list("rep").alias("reps")), about)
    known = classes.select("set", "n", "map", "copies")
    sizes = together.select("tree", "set").join(known.select("set", "n"), "set").groupBy("tree")
    sizes = sizes.agg(F.count("*").alias("rows"), F.sum(8 * F.col("n")).alias("bytes"))
    parts = F.ceil(F.greatest(F.col("rows") / PART_ROWS, F.col("bytes") / PART_BYTES))
    wide = stage(sizes.select("tree", parts.alias("parts")).filter("parts > 1"), about)
    wide = F.broadcast(wide) if wide.count() <= BROADCAST_IDS else wide
    met = together.join(wide, "tree", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    met = met.withColumn("own", F.pmod(F.xxhash64("set", "tree"), "parts"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    unit = ["tree", "low", "high"]
    met = met.select(
        "tree", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "set", "reps"
    )

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(*unit).sortWithinPartitions(*unit, "n", "set")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _units(batches, unit):
            if len(own) < 2:
                continue
            left, right = candidates(own.column("map").to_pylist(), own.column("n").to_numpy(), _sides(own))
            kept = np.unique(np.concatenate([left, right]))
            if len(kept):
                yield from own.select([*unit, "own", "set", "reps", "copies"]).take(pa.array(kept)).to_batches()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _units(batches, unit):
            n, names = own.column("n").to_numpy(), own.column("set").to_numpy()
            sets = [open_sorted(s, k) for s, k in zip(own.column("found").to_pylist(), n.tolist(), strict=True)]
            left, right = candidates([bitmap(s, WIDE) for s in sets], n, _sides(own))
            both = _shared(sets, left, right)
            kept = 100 * both >= SIMILARITY * (n[left] + n[right] - both)
            left, right = left[kept], right[kept]
            if not len(left):
                continue
            met_at = _least_common([_keys(s, shared.value, cell) for s in sets], left, right)
            mine = np.isin(met_at, one_array(own.column("reps")).flatten().to_numpy())
            left, right = left[mine], right[mine]
            if pairs:
                a, b = names[left], names[right]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
                continue
            copies = own.column("copies").to_numpy()
            others = np.zeros(len(own), np.int64)
            np.add.at(others, left, copies[right])
            np.add.at(others, right, copies[left])
            some = np.unique(np.concatenate([left, right]))
            roots = names[_roots(len(own), left, right)[some]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[some]), pa.array(roots), pa.array(others[some])], names=["set", "root", "others"]
            )

    kinds = "tree long, low long, high long, own long, set long, reps array<long>, copies long"
    some = dealt(met.join(known, "set")).select(*unit, "own", "set", "n", "map", "reps", "copies").mapInArrow(near, kinds)
    some = stage(some, about)
    needed = stage(some.select("set").distinct().join(classes, "set").select("set", "first_id"), about)
    sets = _sets(rows, needed, "found")
    whole = dealt(some.join(sets, "set")).select(*unit, "own", "set", "n", "found", "reps", "copies")
    return stage(whole.mapInArrow(linked, "a long, b long" if pairs else "set long, root long, others long"))


def _keys(found: np.ndarray, counters: np.ndarray, cell: int) -> np.ndarray:
    """The keys of the lists that a set is in, ordered as `rep` is."""
    keys = prefix(found, counters)
    return ordered(_dealt(keys, np.full(len(keys), set_id(found), np.int64), counters, cell)[0])


def _least_common(keys: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least key that both of each pair have; linked pairs have one."""
    distinct, codes = np.unique(np.concatenate(keys), return_inverse=True)
    sizes = np.array([len(k) for k in keys])
    codes = np.split(codes, np.cumsum(sizes)[:-1])
    none = len(distinct)
    seen = np.full(none, none, np.int64)
    least = np.empty(len(left), np.int64)
    for own, at in _by_left(left):
        seen[codes[own]] = codes[own]
        theirs = right[at]
        starts = np.cumsum(sizes[theirs]) - sizes[theirs]
        least[at] = np.minimum.reduceat(seen[np.concatenate([codes[i] for i in theirs.tolist()])], starts)
        seen[codes[own]] = none
    return distinct[least]


def _by_left(left: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each left place, and where its pairs are."""
    order = np.argsort(left, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(left[order], prepend=-1)), len(order))
    for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(left[order[start]]), order[start:end]


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n places the least place that links lead to."""
    roots = np.arange(n)
    while True:
        least = np.minimum(roots[left], roots[right])
        new = roots.copy()
        np.minimum.at(new, roots[left], least)
        np.minimum.at(new, roots[right], least)
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def _units(batches: Iterator[pa.RecordBatch], unit: list[str]) -> Iterator[pa.Table]:
    """The rows of each unit, which follow each other in the batches."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in unit])
        cuts = [0, *(1 + np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0))).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            name = tuple(names[:, start].tolist())
            if held and name != last:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(pa.table(batch.slice(start, end - start)))
            last = name
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _sides(own: pa.Table) -> np.ndarray:
    """Classes that keep pairs of one part out where two parts meet, and keep all pairs where a part meets itself."""
    if own.column("low")[0] == own.column("high")[0]:
        return np.arange(len(own))
    return own.column("own").to_numpy()


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many hashes the two sets of each pair have in common."""
    both = np.zeros(len(left), np.int64)
    if not len(left):
        return both
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    codes = np.split(codes, np.cumsum(sizes)[:-1])
    seen = np.zeros(1 + max(int(c.max()) for c in codes), np.int32)
    for own, at in _by_left(left):
        theirs = right[at]
        seen[codes[own]] = 1
        starts = np.cumsum(sizes[theirs]) - sizes[theirs]
        both[at] = np.add.reduceat(seen[np.concatenate([codes[i] for i in theirs.tolist()])], starts)
        seen[codes[own]] = 0
    return both


SQL = r"""
WITH RECURSIVE tokens AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE
    list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM tokens),
classes AS (
  SELECT row_number() OVER () AS class, s, len(s) AS n, count(*) AS copies, min(doc_id) AS first_id
  FROM (SELECT row, doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT class, n, unnest(s) AS shingle FROM classes),
links AS (
  SELECT a.class AS a, b.class AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.class <> b.class
  AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT class AS a, class AS b FROM classes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS class, min(first_id) AS component_id FROM reach JOIN classes ON reach.b = class GROUP BY reach.a),
others AS (SELECT a AS class, sum(copies) AS others FROM links JOIN classes ON b = class GROUP BY a)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  CAST(coalesce(copies - 1 + coalesce(others, 0), 0) AS BIGINT) AS n_links
FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s LEFT JOIN least USING (class) LEFT JOIN others USING (class)
"""
