"""Benchmark decontamination through suffix arrays of the training documents.

Each task takes its documents in shards, turns their words into numbers of the benchmark's vocabulary, and sorts the suffixes that can
hold a match into a suffix array. Every suffix of every benchmark item is looked up there by binary search; the interval it finds
is all its verbatim occurrences, which are then followed to their full length. Words that the benchmark lacks end a match, so suffixes
that start with too few consecutive benchmark word pairs are left out of the array: they could not be found anyway.

The benchmark is read in blocks of bounded size, one pass over the documents each, and never as a whole. Documents are not shuffled.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import map_texts, words_of, written
from gaugeworks.llm.token_files import batches

WINDOW = 10
BLOCK_BYTES = 8 << 20
SPANS = "array<struct<start:int,end:int>>"
MATCHES = "array<struct<item_id:string,doc_start:int,item_start:int,length:int>>"


class Tests:
    """A block of benchmark items, ready for lookups."""

    def __init__(self, items: list[tuple[str, str | None]], window: int) -> None:
        words = [(item, words_of(text)) for item, text in items]
        words = [(item, w) for item, w in words if w]
        self.items = [item for item, _ in words]
        self.window = window
        self.number: dict[bytes, int] = {}
        self.texts = [np.array([self.number.setdefault(x, len(self.number) + 1) for x in w], np.int64) for _, w in words]
        size = len(self.number) + 1
        self.size = size
        pairs = [t[:-1] * size + t[1:] for t in self.texts]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
        # words that must follow each other before a suffix can match: the window, or a short item that starts with its first word
        self.need = np.full(size, window, np.int64)
        self.need[0] = 1 << 40
        where: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
        for n, t in enumerate(self.texts):
            depth = min(window, len(t))
            self.need[t[0]] = min(self.need[t[0]], depth)
            for j in range(len(t) - depth + 1):
                where.setdefault((depth, t[j : j + depth].astype(">u4").tobytes()), []).append((n, j))
        self.depth = np.array([d for d, _ in where], np.int64)
        self.places = list(where.values())
        blank = 4 * window
        self.low = np.array([k.ljust(blank, b"\x00") for _, k in where], f"V{blank}")
        self.high = np.array([k.ljust(blank, b"\xff") for _, k in where], f"V{blank}")

    def lookup(self, docs: list[list[bytes]]) -> dict[int, tuple[list, list]]:
        """By the documents' place in the list: spans of hit words, and the longest match with each item."""
        get, zero = self.number.get, itertools.repeat(0)
        parts, starts, at = [], [], 0
        for w in docs:
            starts.append(at)
            parts.append(np.fromiter(map(get, w, zero), np.int64, len(w)))
            at += len(w) + 1
        if not len(self.pairs) and not len(self.depth):
            return {}
        text = np.zeros(at + self.window, np.int64)
        for s, p in zip(starts, parts, strict=True):
            text[s : s + len(p)] = p
        known = np.flatnonzero(text)
        code = text[known] * self.size + text[known + 1]  # the text ends in zeros
        spot = np.minimum(np.searchsorted(self.pairs, code), max(len(self.pairs) - 1, 0))
        linked = (self.pairs[spot] == code) & (text[known + 1] > 0) if len(self.pairs) else np.zeros(len(known), bool)
        broken = np.append(known[~linked], len(text))
        follow = broken[np.searchsorted(broken, known)] - known + 1
        suffix = known[follow >= self.need[text[known]]]
        if not len(suffix):
            return {}
        keys = text[suffix[:, None] + np.arange(self.window)].astype(">u4")
        # behind the end of a document nothing counts
        keys[np.cumsum(keys == 0, axis=1) > 0] = 0
        keys = np.ascontiguousarray(keys).view(f"V{4 * self.window}").ravel()
        order = _order(keys)
        array, keys = suffix[order], keys[order]
        first, last = _search(keys, self.low, "left"), _search(keys, self.high, "right")
        found = np.flatnonzero(last > first)
        if not len(found):
            return {}
        count = last[found] - first[found]
        test = np.repeat(found, count)
        place = array[np.repeat(first[found] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        doc = np.searchsorted(starts, place, side="right") - 1
        by_doc = np.argsort(doc, kind="stable")
        test, place, doc = test[by_doc], place[by_doc], doc[by_doc]
        edges = np.flatnonzero(np.diff(doc, prepend=-1))
        out = {}
        for a, b in zip(edges, np.append(edges[1:], len(doc)), strict=True):
            n = int(doc[a])
            out[n] = self._of_document(place[a:b] - starts[n], test[a:b])
        return out

    def _of_document(self, place: np.ndarray, test: np.ndarray) -> tuple[list, list]:
        spans = merge([(int(p), int(p + d)) for p, d in zip(place, self.depth[test], strict=True)])
        # occurrences on one diagonal that follow each other word by word are one longer match
        best: dict[str, tuple[int, int, int]] = {}
        open_at: dict[tuple[int, int], tuple[int, int]] = {}
        for i in np.argsort(place, kind="stable"):
            p, depth = int(place[i]), int(self.depth[test[i]])
            for n, j in self.places[test[i]]:
                start, end = open_at.get((n, p - j), (p, -1))
                start = start if end == p + depth - 1 else p
                open_at[n, p - j] = start, p + depth
                length, item = p + depth - start, self.items[n]
                if item not in best or length > best[item][2]:
                    best[item] = start, start - (p - j), length
        return spans, [(item, *m) for item, m in sorted(best.items())]


def _order(keys: np.ndarray) -> np.ndarray:
    return np.argsort(keys.view(f"S{keys.dtype.itemsize}"), kind="stable")


def _search(keys: np.ndarray, tests: np.ndarray, side: str) -> np.ndarray:
    """Binary search for all tests at once."""
    size = keys.dtype.itemsize
    return np.searchsorted(keys.view(f"S{size}"), tests.view(f"S{size}"), side=side)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans' union, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, str | None]]]:
    """Benchmark items in blocks of about so many bytes; one block is on the driver at a time."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1] or "")
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep: Sequence[str] | None = None
) -> DataFrame:
    """The documents with n_words, n_hit, matches (the longest with each item, and where), item_ids and contaminated.

    A word is hit inside any occurrence of `window` consecutive words of an item; an item of fewer words, but not none,
    counts whole. Null and empty texts have no words and no hits; items without words match nothing; repeated items count under each of
    their ids once; rows without an item_id are left out. Every input row stays, with the columns of `keep` (all by default); columns of the
    same names as new ones are replaced.
    """
    docs = docs.drop("n_words", "spans", "matches", "n_hit", "item_ids", "contaminated")
    out = docs.withColumns({"spans": F.expr(f"cast(array() as {SPANS})"), "matches": F.expr(f"cast(array() as {MATCHES})")})
    pending = None
    for block in itertools.chain(blocks(benchmark.where("item_id is not null"), block_bytes), [None]):
        if pending is not None and block is not None:  # each pass sees one block in memory
            out, pending = written(_passed(out, docs.columns, pending, window), "decontaminate"), None
        pending = block if block is not None else pending
    out = _passed(out, docs.columns if keep is None else keep, pending or [], window)
    width = F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"])
    return (
        out.withColumn("n_hit", width.cast("long"))
        .withColumn("item_ids", F.sort_array(F.array_distinct(F.col("matches.item_id"))))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def _passed(docs: DataFrame, keep: Sequence[str], block: list, window: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)
    return map_texts(docs, keep, f"n_words long, spans {SPANS}, matches {MATCHES}", _pass(sent, window), also=("spans", "matches"))


def _pass(sent, window: int):  # noqa: ANN001, ANN202
    def make():  # noqa: ANN202
        tests = Tests(sent.value, window)
        names = ("item_id", "doc_start", "item_start", "length")

        def run(texts: list[str | None], spans: list[list], matches: list[list]) -> list[list]:
            texts, n_words = [t or "" for t in texts], []
            for a, b in batches(texts, 4_000_000):
                docs = [words_of(t) for t in texts[a:b]]
                n_words += map(len, docs)
                for n, (new, longest) in tests.lookup(docs).items():
                    old = [(s["start"], s["end"]) for s in spans[a + n]]
                    spans[a + n] = [{"start": s, "end": e} for s, e in merge(old + new)]
                    matches[a + n] = matches[a + n] + [dict(zip(names, m, strict=True)) for m in longest]
            return [n_words, spans, matches]

        return run

    return make


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without a window of any benchmark item, with their own columns."""
    return find_matches(docs, benchmark, window).where("not contaminated").select(docs.columns)
