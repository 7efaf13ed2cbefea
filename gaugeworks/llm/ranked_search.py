"""Ranked lexical search over a blocked index: each term's posting list is cut into blocks of similar documents.

A shard is some thousand documents of one task. In each shard the posting list of a term is clustered: a document goes to the most similar of
a few documents of the list (by random projections of their impact vectors), and a cluster is a block. A block stores the greatest
impact in it of every coordinate that a bound can ask for: terms that share a query with the list's term, and are not rarer than it (a
document that also holds a rarer term of the query is found in that term's list). The sum of a query's weights times these maxima
bounds the score of what only this list finds, so a block is skipped exactly when its bound lies below a score that `top`
documents reach. Impacts, weights and scores are integers, so bounds and scores compare without rounding.

Queries come in blocks of bounded size, each against all documents. A first pass over the index finds, per query, a score that `top`
documents of some shard reach; the second skips by it and returns the shard's best documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.llm.common import map_texts, words_of, written

TOP = 50
#: Documents and cells (documents x terms) of a shard, documents a block has on average, width of the projections.
SHARD_DOCS, SHARD_CELLS, BLOCK_DOCS, SKETCH = 2048, 1 << 23, 48, 24
#: Characters of queries that are searched in one pass.
QUERY_CHARS = 8 << 20
SHARD_SCHEMA = (
    "doc_ids array<long>, present binary, row_ends binary, row_terms binary, impacts binary, "
    "list_terms binary, block_lists binary, block_ends binary, postings binary, maxima binary"
)
HIT_SCHEMA = "query int, doc_id long, score long"


class Queries:
    """A block of queries: terms get numbers, and later weights and their order from rare to common."""

    def __init__(self, texts: list[str | None]) -> None:
        sets = [set(words_of(t)) for t in texts]
        self.names = sorted(set().union(*sets))
        number = {t: i for i, t in enumerate(self.names)}
        self.terms = [np.array(sorted(number[t] for t in s), np.int64) for s in sets]

    def weigh(self, frequencies: dict[int, int], documents: int) -> None:
        df = np.array([frequencies.get(i, 0) for i in range(len(self.names))], np.int64)
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * f + 1))) for f in df.tolist()], np.int64)
        self.place = np.empty(len(df), np.int64)
        self.place[np.argsort(df, kind="stable")] = np.arange(len(df))  # rarest first
        self.terms = [t[np.argsort(self.place[t])] for t in self.terms]
        asked: dict[int, list[np.ndarray]] = {}
        for terms in self.terms:
            for i, t in enumerate(terms.tolist()):
                asked.setdefault(t, []).append(terms[i:])
        #: For each term the coordinates of its summaries, rarest (itself) first.
        self.coordinates = {t: (u := np.unique(np.concatenate(parts)))[np.argsort(self.place[u])] for t, parts in asked.items()}


def vectors(docs: DataFrame, names: list[bytes]) -> DataFrame:
    """doc_id, n (all terms of the text), and the numbers and counts of the terms that some query holds. Null texts have none."""
    sent = docs.sparkSession.sparkContext.broadcast(names)  # of one block of queries

    def make() -> Callable:
        number = {t: i for i, t in enumerate(sent.value)}

        def run(texts: list[str | None]) -> list[list]:
            out: list[list] = [[], [], []]
            for text in texts:
                words = words_of(text)
                counts = Counter(words)
                held = sorted((number[t], counts[t]) for t in counts.keys() & number.keys())
                out[0].append(len(words))
                out[1].append([t for t, _ in held])
                out[2].append([c for _, c in held])
            return out

        return run

    return map_texts(docs.select(F.col("doc_id").cast("long"), "text"), ["doc_id"], "n long, terms array<int>, counts array<int>", make)


def impacts_of(counts: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What an occurrence count is worth in a document of n terms, before the term's weight."""
    m = np.array([50 + 50 * x * documents // total for x in n.tolist()], np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 20 * m)


def build_shard(queries: Queries, ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> dict[str, np.ndarray]:
    """Blocks and summaries of documents given as sparse rows (ends of rows, term numbers, impacts)."""
    present, column = np.unique(terms, return_inverse=True)
    counts = np.diff(ends, prepend=0)
    rows = np.repeat(np.arange(len(ends)), counts)
    dense = np.zeros((len(ends), len(present)), np.int32)
    dense[rows, column] = impacts
    weighted = dense * queries.weight[present].astype(np.float32)
    sketch = weighted @ np.random.default_rng(11).standard_normal((len(queries.names), SKETCH), np.float32)[present]
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
    by_term = np.argsort(column, kind="stable")
    lists = np.split(rows[by_term], np.cumsum(np.bincount(column, minlength=len(present)))[:-1])
    at = np.full(len(queries.names), -1, np.int64)
    at[present] = np.arange(len(present))
    block_lists, block_sizes, postings, maxima = [], [], [], []
    for i, docs in enumerate(lists):
        parts = -(-len(docs) // BLOCK_DOCS)
        if parts > 1:
            centres = docs[np.linspace(0, len(docs) - 1, parts).astype(int)]
            nearest = np.argmax(sketch[docs] @ sketch[centres].T, axis=1)
            order = np.argsort(nearest, kind="stable")
            docs, sizes = docs[order], np.bincount(nearest, minlength=parts)
            sizes = sizes[sizes > 0]
        else:
            sizes = np.array([len(docs)])
        columns = at[queries.coordinates[int(present[i])]]
        held = dense[docs[:, None], columns[columns >= 0]]
        block_lists += [i] * len(sizes)
        block_sizes.append(sizes)
        postings.append(docs)
        maxima.append(np.maximum.reduceat(held, np.cumsum(sizes) - sizes, axis=0).ravel())
    return {
        "present": present.astype("<i4"), "row_ends": ends.astype("<i4"), "row_terms": terms.astype("<i4"), "impacts": impacts.astype("<i4"),
        "list_terms": present.astype("<i4"), "block_lists": np.array(block_lists, "<i4"),
        "block_ends": np.cumsum(np.concatenate(block_sizes)).astype("<i4"), "postings": np.concatenate(postings).astype("<i4"),
        "maxima": np.concatenate(maxima).astype("<i4"),
    }


def _shards(sent, documents: int, total: int):  # noqa: ANN001, ANN202
    names = [c.split()[0] for c in SHARD_SCHEMA.split(", ")]
    kinds = [pa.list_(pa.int64()), *[pa.binary()] * (len(names) - 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        held: list[tuple] = []
        seen: set[int] = set()

        def shard() -> pa.RecordBatch:
            sizes = np.array([len(t) for _, _, t, _ in held])
            counts = np.concatenate([c for *_, c in held]).astype(np.int64)
            n = np.repeat([n for _, n, _, _ in held], sizes)
            made = build_shard(queries, np.cumsum(sizes), np.concatenate([t for _, _, t, _ in held]), impacts_of(counts, n, documents, total))
            values = [[d for d, *_ in held], *(made[c].tobytes() for c in names[1:])]
            held.clear()
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            lists = [batch.column(c) for c in ("terms", "counts")]
            offsets = lists[0].offsets.to_numpy()
            terms, counts = (x.values.to_numpy() for x in lists)
            for doc_id, n, a, b in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), offsets, offsets[1:], strict=False):
                if a < b:
                    held.append((doc_id, n, terms[a:b], counts[a:b]))
                    seen.update(terms[a:b].tolist())
                    if len(held) >= SHARD_DOCS or len(held) * len(seen) >= SHARD_CELLS:
                        yield shard()
        if held:
            yield shard()

    return run


class Shard:
    """A stored shard, ready to answer a block of queries."""

    def __init__(self, row: dict, queries: Queries) -> None:
        self.queries, self.doc_ids = queries, row["doc_ids"]
        read = {k: np.frombuffer(v, "<i4") for k, v in row.items() if k != "doc_ids"}
        self.row_ends, self.row_terms, self.impacts = read["row_ends"].astype(np.int64), read["row_terms"], read["impacts"].astype(np.int64)
        self.postings, self.block_ends = read["postings"], read["block_ends"]
        n_blocks = np.bincount(read["block_lists"], minlength=len(read["list_terms"]))
        self.list_of = {t: i for i, t in enumerate(read["list_terms"].tolist())}
        self.first_block = np.cumsum(n_blocks) - n_blocks
        self.summaries, start, absent = [], 0, np.ones(len(queries.names), bool)
        absent[read["present"]] = False
        for t, n in zip(read["list_terms"].tolist(), n_blocks.tolist(), strict=True):
            columns = queries.coordinates[t]
            columns = columns[~absent[columns]]
            end = start + n * len(columns)
            self.summaries.append((columns, read["maxima"][start:end].reshape(n, len(columns))))
            start = end
        self.evaluated = self.skipped = 0

    def bounds(self, query: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks that the query's terms lead to, and their bounds, greatest bound first."""
        queries, blocks, bounds = self.queries, [], []
        terms = queries.terms[query]
        for i, t in enumerate(terms.tolist()):
            if t not in self.list_of:
                continue
            k = self.list_of[t]
            columns, maxima = self.summaries[k]
            spot = np.searchsorted(queries.place[columns], queries.place[terms[i:]])
            spot_ok = spot < len(columns)
            spot_ok[spot_ok] = columns[spot[spot_ok]] == terms[i:][spot_ok]
            picked = spot[spot_ok]
            bounds.append(maxima[:, picked].astype(np.int64) @ queries.weight[columns[picked]])
            blocks.append(self.first_block[k] + np.arange(len(maxima)))
        if not blocks:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        block, bound = np.concatenate(blocks), np.concatenate(bounds)
        order = np.argsort(-bound, kind="stable")
        return block[order], bound[order]

    def scores(self, query: int, docs: np.ndarray) -> np.ndarray:
        starts = np.where(docs > 0, self.row_ends[docs - 1], 0)
        sizes = self.row_ends[docs] - starts
        cell = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        worth = np.zeros(len(self.queries.names), np.int64)
        worth[self.queries.terms[query]] = self.queries.weight[self.queries.terms[query]]
        return np.add.reduceat(worth[self.row_terms[cell]] * self.impacts[cell], np.cumsum(sizes) - sizes)

    def search(self, query: int, top: int, floor: int, enough: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The best documents (row numbers) with their scores, at least `floor`; with `enough`, of the first blocks that hold `top` ones."""
        block, bound = self.bounds(query)
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        seen = np.zeros(len(self.doc_ids), bool)
        at, step = 0, 4
        while at < len(block) and bound[at] >= max(floor, 1):
            some = block[at : at + step][bound[at : at + step] >= max(floor, 1)]
            self.evaluated += len(some)
            found = np.concatenate([self.postings[self.block_ends[b - 1] if b else 0 : self.block_ends[b]] for b in some.tolist()])
            found = np.unique(found[~seen[found]])
            if len(found):
                seen[found] = True
                docs, scores = np.concatenate([docs, found]), np.concatenate([scores, self.scores(query, found)])
                good = scores >= max(floor, 1)
                docs, scores = docs[good], scores[good]
                if len(scores) >= top:
                    floor = max(floor, int(np.partition(scores, -top)[-top]))
                    if enough:
                        break
            at, step = at + step, min(step * 2, 64)
        self.skipped += max(0, len(block) - at)
        good = scores >= max(floor, 1)
        return docs[good], scores[good]


def _answers(sent, floors: dict[int, int] | None, top: int):  # noqa: ANN001, ANN202
    """Without floors: per query a score that `top` documents of the shard reach. With them: the shard's documents that reach them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.slice(i, 1).to_pylist()[0], queries)
                number, ids, values = [], [], []
                for q in range(len(queries.terms)):
                    docs, scores = shard.search(q, top, 0 if floors is None else floors.get(q, 0), enough=floors is None)
                    if floors is None:
                        docs, scores = (docs[:1], np.partition(scores, -top)[-top :][:1]) if len(scores) >= top else (docs[:0], scores[:0])
                    elif len(scores) > top:
                        ids_of = np.array([np.iinfo(np.int64).max if shard.doc_ids[d] is None else shard.doc_ids[d] for d in docs.tolist()])
                        missing = np.array([shard.doc_ids[d] is None for d in docs.tolist()])
                        best = np.lexsort((missing, ids_of, -scores))[:top]
                        docs, scores = docs[best], scores[best]
                    number += [q] * len(docs)
                    ids += [shard.doc_ids[d] for d in docs.tolist()]
                    values += scores.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(ids, pa.int64()), pa.array(values, pa.int64())], names=["query", "doc_id", "score"])

    return run


def _block(docs: DataFrame, items: list[tuple], schema: StructType, top: int) -> DataFrame:
    """Ranks for one block of queries."""
    spark = docs.sparkSession
    context = spark.sparkContext
    queries = Queries([text for _, text in items])
    found = written(vectors(docs, queries.names), "term-counts")
    size = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    # no more rows than the block has terms
    frequencies = {r.t: r["count"] for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
    queries.weigh(frequencies, size[0])
    sent = context.broadcast(queries)
    index = written(found.mapInArrow(_shards(sent, *size), SHARD_SCHEMA), "search-index")
    floors = {r.query: r.score for r in index.mapInArrow(_answers(sent, None, top), HIT_SCHEMA).groupBy("query").agg(F.max("score").alias("score")).collect()}
    hits = index.mapInArrow(_answers(sent, floors, top), HIT_SCHEMA)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    named = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], StructType([*StructType.fromDDL("query int").fields, schema["item_id"]]))
    return best.join(named, "query").select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, query_chars: int = QUERY_CHARS) -> DataFrame:
    """For each item its `top` best documents with a score above 0: item_id, rank, doc_id, score.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. Equal scores go by doc_id, rows without one last. Null and
    empty texts have no terms: such documents count nowhere and such items get no rows. Repeated documents are ranked each; repeated
    items, also ones without an id, are answered each. Other columns are ignored.
    """
    schema = items.select("item_id", "text").schema
    done, held, size = [], [], 0
    for item, text in items.select("item_id", "text").where("text is not null").toLocalIterator():
        held.append((item, text))
        size += len(text)
        if size >= query_chars:
            done.append(written(_block(docs, held, schema, top), "ranks"))
            held, size = [], 0
    if held:
        done.append(_block(docs, held, schema, top))
    if not done:
        return docs.sparkSession.createDataFrame([], StructType([schema["item_id"], *StructType.fromDDL("rank int, doc_id long, score long").fields]))
    return reduce(DataFrame.unionByName, done)
