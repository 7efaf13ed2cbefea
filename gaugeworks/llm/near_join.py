"""Jaccard self-join of documents on word shingles, through a MinHash LSH forest and exact verification.

Documents with equal shingle sets form a class, and only classes are compared. Each tree of the forest is a prefix trie over its own
hash values. Matched prefixes start at full depth and are shortened until a pair at the threshold meets in some tree
with the target probability; the rule depends on the threshold alone, so that it holds at every size. A trie node is then a group of
classes that share a prefix.

A pair is verified in the first tree where it meets, so nothing is counted twice and no pair is ever written: a task
returns one row per class, with the number of its links and the least class that it reaches. Nodes in which each pair has met before
are passed over. Large nodes are cut into blocks by the order of their classes, and each two blocks are one task's work.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import map_texts, words_of, written
from gaugeworks.llm.components import components

SHINGLE, THRESHOLD, TREES, DEPTH, RECALL = 5, 0.8, 24, 10, 0.9999
#: Classes and shingles of a block. Two blocks are in memory at once.
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 400_000
REMEMBERED = 300_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def matched_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix by which pairs at the threshold still meet with the wanted probability; refused where none does."""
    while depth and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    if not depth:
        raise ValueError(f"{trees} trees cannot find pairs at {threshold} with probability {recall}: add trees")
    return depth


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word) >> 1
        return value


_hashes = _WordHashes()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of `size` words; fewer words, but not none, are one run."""
    words = words_of(text)
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    one = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(one))
    if not width:
        return one
    out = one[: len(one) - width + 1].copy()
    for k in range(1, width):
        out *= MIX
        out ^= out >> np.uint64(31)
        out += one[k : len(one) - width + 1 + k]
    out *= MIX
    out ^= out >> np.uint64(29)
    return np.unique(out)


def class_of(shingle_set: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingle_set.tobytes()) if len(shingle_set) else None


class Forest:
    """Node keys of shingle sets: for each tree, a hash of the matched prefix."""

    def __init__(self, trees: int, depth: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.trees, self.depth = trees, depth
        self.flip = rng.integers(0, 1 << 63, trees * depth, dtype=np.int64).astype(np.uint64)
        self.factor = rng.integers(0, 1 << 63, trees * depth, dtype=np.int64).astype(np.uint64) | np.uint64(1)

    def keys(self, shingle_set: np.ndarray) -> np.ndarray:
        least = np.full(self.trees * self.depth, np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(shingle_set), 256):
            least = np.minimum(least, ((shingle_set[i : i + 256, None] ^ self.flip) * self.factor).min(axis=0))
        out = np.zeros(self.trees, np.uint64)
        for level in least.reshape(self.trees, self.depth).T:
            out = (out ^ (level >> np.uint64(7)) ^ level) * MIX
        return out.view(np.int64)


def signatures(docs: DataFrame, size: int, trees: int, depth: int) -> DataFrame:
    """doc_id, fp (a hash of the text), cls (of the shingle set; null without words), n_shingles, keys."""

    def make():  # noqa: ANN202
        forest = Forest(trees, depth)

        def run(texts: list[str | None]) -> list[list]:
            out: list[list] = [[], [], []]
            for t in texts:
                s = shingles(t, size)
                for column, value in zip(out, (class_of(s), len(s), forest.keys(s) if len(s) else None), strict=True):
                    column.append(value)
            return out

        run.clear = _hashes.clear
        return run

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("fp"), "text")
    return map_texts(rows, ["doc_id", "fp"], "cls binary, n_shingles int, keys array<long>", make)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    def make():  # noqa: ANN202
        def run(texts: list[str | None]) -> list[list]:
            sets = [shingles(t, size) for t in texts]
            return [[class_of(s) for s in sets], [s.tobytes() for s in sets]]

        run.clear = _hashes.clear
        return run

    return map_texts(docs, [], "cls binary, shingles binary", make)


def shared(left: list[np.ndarray], right: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of the intersections of each left set with each right one."""
    if len(left) == len(right) == 1:
        return np.array([[len(np.intersect1d(left[0], right[0], assume_unique=True))]])
    both = [np.concatenate(x) for x in (left, right)]
    owner = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    common = np.intersect1d(*both)
    out = np.zeros((len(left), len(right)), np.float32)
    spot = [np.searchsorted(common, x) for x in both]
    held = [(s < len(common)) & (common[np.minimum(s, len(common) - 1)] == x) if len(common) else np.zeros(len(x), bool) for s, x in zip(spot, both, strict=True)]
    for i in range(0, len(common), columns):
        side = []
        for s, h, o, n in zip(spot, held, owner, (len(left), len(right)), strict=True):
            here = h & (s >= i) & (s < i + columns)
            grid = np.zeros((n, min(columns, len(common) - i)), np.float32)
            grid[o[here], s[here] - i] = 1
            side.append(grid)
        out += side[0] @ side[1].T
    return np.rint(out).astype(np.int64)


def _verified(threshold: float):  # noqa: ANN202
    need = Fraction(str(threshold))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        tree, lo, hi = int(frame["tree"].iloc[0]), frame["lo"].iloc[0], frame["hi"].iloc[0]
        frame = frame.sort_values("cls", ignore_index=True)
        one = np.flatnonzero(frame["block"] == lo)
        two = one if lo == hi else np.flatnonzero(frame["block"] == hi)
        keys = np.array(frame["keys"].tolist()).reshape(len(frame), -1)
        sizes = frame["n_shingles"].to_numpy(np.int64)
        total = sizes[one][:, None] + sizes[two]
        # |A and B| is at most the smaller size
        open_ = np.minimum(sizes[one][:, None], sizes[two]) * (need.numerator + need.denominator) >= need.numerator * total
        for t in range(tree):
            open_ &= keys[one, t][:, None] != keys[two, t]
        if lo == hi:
            open_ &= np.arange(len(one))[:, None] < np.arange(len(two))
        rows, cols = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
        empty = pd.DataFrame({"cls": [], "links": [], "root": []})
        if not len(rows):
            return empty
        sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        common = shared([sets[i] for i in one[rows]], [sets[i] for i in two[cols]])
        at = np.ix_(rows, cols)
        good = open_[at] & (common * (need.numerator + need.denominator) >= need.numerator * total[at])
        a, b = np.nonzero(good)
        if not len(a):
            return empty
        a, b = one[rows][a], two[cols][b]
        copies = frame["copies"].to_numpy(np.int64)
        links = np.bincount(a, copies[b], len(frame)) + np.bincount(b, copies[a], len(frame))
        root = np.arange(len(frame))
        while True:  # the least class that links reach; rows are sorted by class
            before = root.copy()
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            root = root[root]
            if (root == before).all():
                break
        linked = np.flatnonzero(links)
        return pd.DataFrame({"cls": frame["cls"].iloc[linked].tolist(), "links": links[linked].astype(np.int64), "root": frame["cls"].iloc[root[linked]].tolist()})

    return run


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL
) -> DataFrame:
    """One row per document: doc_id, fp, class_id, copy_id, n_copies, n_links.

    Two documents are linked if the Jaccard similarity of their shingle sets reaches the threshold. class_id is the least doc_id that
    links lead to, copy_id the least among documents of the same shingle set (n_copies of them), n_links the number of other
    documents linked to this one. Null, empty and wordless texts link to nothing: their class is their own doc_id. Repeated rows are
    documents of their own. Rows without a doc_id take part, and name a class only where no other row does (as null).
    """
    depth = matched_depth(threshold, trees, depth, recall)
    rows = written(signatures(docs, shingle, trees, depth), "signatures")
    classes = written(
        rows.where("cls is not null").groupBy("cls").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
            F.coalesce(F.min_by("fp", "doc_id"), F.min("fp")).alias("fp"),
            F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"),
        ),
        "classes",
    )
    leaves = classes.select("cls", "n_shingles", F.posexplode("keys").alias("tree", "key"))
    nodes = leaves.groupBy("tree", "key").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("size")).where("m > 1")
    members = written(
        leaves.drop("n_shingles").join(nodes, ["tree", "key"]).join(classes.select("cls", "keys"), "cls"), "members"
    )
    # a node whose classes all share an earlier node has no new pair
    ends = [f(F.col("keys")[t]).alias(f"{f.__name__}{t}") for t in range(trees - 1) for f in (F.min, F.max)]
    met = reduce(lambda x, y: x | y, [(F.col("tree") > t) & (F.col(f"min{t}") == F.col(f"max{t}")) for t in range(trees - 1)])
    fresh = members.groupBy("tree", "key").agg(*ends).where(~met).select("tree", "key")
    parts = F.greatest(F.ceil(F.col("m") / BLOCK_CLASSES), F.ceil(F.col("size") / BLOCK_SHINGLES))
    # a class is one row with all its places up to the join with its shingles, and only then a row per cell
    places = written(
        members.join(fresh, ["tree", "key"])
        .withColumn("parts", parts.cast("long"))
        .withColumn("block", F.pmod(F.xxhash64("cls"), "parts"))
        .groupBy("cls").agg(F.collect_list(F.struct("tree", "key", "parts", "block")).alias("places")),
        "places",
    )
    wanted = places.select("cls").join(classes, "cls").select("rep", F.col("fp").alias("rep_fp"))
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("fp"), "text")
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("fp") == F.col("rep_fp")), "left_semi")
    sets = _sets(texts, shingle).dropDuplicates(["cls"])
    whole = places.join(classes.select("cls", "copies", "n_shingles", "keys"), "cls").join(sets, "cls")
    full = (
        whole.select("cls", "copies", "n_shingles", "keys", "shingles", F.inline("places"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
        .drop("parts", "other")
    )
    found = written(
        full.groupBy("tree", "key", "lo", "hi").applyInPandas(_verified(threshold), "cls binary, links long, root binary"), "links"
    )
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cls")
    linked = roots.join(links, "cls").join(classes.select("cls", "rep"), "cls")
    group = linked.groupBy("root").agg(F.min("rep").alias("class_id"))
    linked = linked.join(group, "root").select("cls", "class_id", "links")
    named = classes.select("cls", "rep", "copies").join(linked, "cls", "left").select(
        "cls", F.coalesce("class_id", "rep").alias("class_id"), F.col("rep").alias("copy_id"), F.col("copies").alias("n_copies"), "links"
    )
    return rows.select("doc_id", "fp", "cls").join(named, "cls", "left").select(
        "doc_id", "fp",
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("n_copies", F.lit(1)) - 1).alias("n_links"),
    )


def keep_one(docs: DataFrame, **options: float) -> DataFrame:
    """The documents without near duplicates: of each class the one with the least doc_id stays, once, with its own columns.

    Wordless documents all stay, except that rows equal in doc_id and text count once.
    """
    kept = near_duplicates(docs, **options).where("doc_id <=> class_id").select(F.col("doc_id").alias("__id"), F.col("fp").alias("__fp")).distinct()
    rows = docs.withColumn("__fp", F.xxhash64("text"))
    same = F.col("l.__fp").eqNullSafe(F.col("r.__fp")) & F.col("l.doc_id").cast("long").eqNullSafe(F.col("r.__id"))
    return rows.alias("l").join(kept.alias("r"), same, "left_semi").dropDuplicates(["doc_id", "__fp"]).select(docs.columns)
