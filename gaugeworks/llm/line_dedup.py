"""Line dedup by sorted hashes: bitmaps of the lines to keep instead of texts.

Each counted line becomes (128-bit hash of its key, doc_id, position). Rows are range-partitioned and sorted in that order, so a task
streams each key's occurrences in a row, the first document first, and names the lines of every later document. A very frequent key
spans several ranges: the document that leads a range cannot tell whether an earlier range holds the key too, so its lines of that key
wait for the ranges' edges (at most two rows per range), whose least document decides. What is returned per document is a bitmap of the
lines to keep, as run lengths; texts are cut by it where someone needs them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.llm.common import map_texts, slices, written

MIN_CHARS = 10
#: White space of the contract, as characters.
SPACE = " \t\n\v\f\r"
#: Rows of the streaming pass: a line to drop, one that waits for the edges, an edge.
DROP, WAIT, EDGE = 0, 1, 2
KEYED = "h1 long, h2 long, doc_id long, fp long, pos int"
STREAMED = "kind int, h1 long, h2 long, doc_id long, fp long, pos int"


def key_of(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """What lines are compared by; None where the line is too short to count."""
    line = line.strip(SPACE)
    return line.encode("utf-8", "surrogatepass").lower() if len(line) >= min_chars else None


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row for each line that counts: hash, doc_id, fp (a hash of the text, for rows that share a doc_id), position."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("fp"), "text").where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", 4 << 20)):
            digests, positions, counts = [], [], []
            for text in batch.column("text").to_pylist():
                before = len(digests)
                for i, line in enumerate(text.split("\n")):
                    key = key_of(line, min_chars)
                    if key is not None:
                        digests.append(xxhash.xxh3_128_digest(key))
                        positions.append(i)
                counts.append(len(digests) - before)
            both = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            row = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column("doc_id").take(row), batch.column("fp").take(row),
                 pa.array(positions, pa.int32())],
                names=["h1", "h2", "doc_id", "fp", "pos"],
            )

    return rows.mapInArrow(run, KEYED)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of sorted rows: what it can decide alone, what waits, and its edges. State: one key and its first document here."""
    schema = pa.schema([("kind", pa.int32()), *[(n, pa.int64()) for n in ("h1", "h2", "doc_id", "fp")], ("pos", pa.int32())])
    lead = key = first = None  # keys of the range's first and current group; the latter's first document (null flag, id)

    def edge(at: tuple[int, int], doc: tuple[bool, int]) -> pa.RecordBatch:
        values = [EDGE, *at, None if doc[0] else doc[1], None, None]
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, values, strict=True))], schema=schema)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        h1, h2, fp, pos = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "fp", "pos"))
        missing = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        doc = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
        new = np.ones(n, bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        goes_on = key is not None and (h1[0], h2[0]) == key
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # row at which each row's group starts in this batch
        head_doc, head_missing = doc[start], missing[start]
        if goes_on:
            here = start == 0
            head_doc, head_missing = np.where(here, first[1], head_doc), np.where(here, first[0], head_missing)
        if lead is None:
            lead = (int(h1[0]), int(h2[0]))
            yield edge(lead, (bool(missing[0]), int(doc[0])))
        later = (doc != head_doc) | (missing != head_missing)
        waits = ~later & (h1 == lead[0]) & (h2 == lead[1])
        taken = np.flatnonzero(later | waits)
        if len(taken):
            held = waits[taken]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(held, WAIT, DROP).astype(np.int32)), pa.array(h1[taken], mask=~held), pa.array(h2[taken], mask=~held),
                 pa.array(doc[taken], mask=missing[taken]), pa.array(fp[taken]), pa.array(pos[taken])],
                schema=schema,
            )
        key, first = (int(h1[-1]), int(h2[-1])), (bool(head_missing[-1]), int(head_doc[-1]))
    if key is not None and key != lead:
        yield edge(key, first)


def to_runs(dropped: np.ndarray) -> bytes:
    """Run lengths of a bitmap (kept, dropped, kept, ...), seven bits a byte; lines behind the last run are kept."""
    breaks = np.flatnonzero(np.diff(dropped) != 1)
    starts = dropped[np.concatenate([[0], breaks + 1])] if len(dropped) else dropped
    ends = dropped[np.concatenate([breaks, [len(dropped) - 1]])] + 1 if len(dropped) else dropped
    out = bytearray()
    at = 0
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        for n in (a - at, b - a):
            while n > 127:
                out.append(n & 127 | 128)
                n >>= 7
            out.append(n)
        at = b
    return bytes(out)


def from_runs(runs: bytes, n_lines: int) -> np.ndarray:
    """Whether each line is kept."""
    keep = np.ones(n_lines, bool)
    at, value, shift, dropping = 0, 0, 0, False
    for byte in runs:
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            if dropping:
                keep[at : at + value] = False
            at, value, shift, dropping = at + value, 0, 0, not dropping
    return keep


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, fp, n_dropped and bitmap (run lengths, see `to_runs`) of each document that loses lines.

    A line's key is the line without white space at both ends, A-Z lower-cased; keys of at least `min_chars` characters that at least two
    documents hold stay only in the least doc_id, there in all their lines. Rows of one doc_id are one document for this rule,
    whatever their texts, and so are all rows without a doc_id, which come after every other. Null and empty texts hold no key. Other
    columns are ignored. Keys are compared by 128-bit hashes.
    """
    keyed = written(hashed_lines(docs, min_chars), "hashed-lines")  # the range bounds are drawn from it, and then it is sorted
    order = ["h1", "h2", F.col("doc_id").asc_nulls_last(), "pos"]
    streamed = written(keyed.repartitionByRange(*order[:3]).sortWithinPartitions(*order).mapInArrow(_streamed, STREAMED), "line-runs")
    # at most two edges per range
    edges = streamed.where(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.min("doc_id").alias("least"))
    waiting = streamed.where(F.col("kind") == WAIT).join(F.broadcast(edges), ["h1", "h2"])
    settled = waiting.where(F.col("least").isNotNull() & ~F.col("least").eqNullSafe(F.col("doc_id")))
    dropped = streamed.where(F.col("kind") == DROP).select("doc_id", "fp", "pos").unionByName(settled.select("doc_id", "fp", "pos"))
    lines = dropped.groupBy("doc_id", "fp").agg(F.sort_array(F.collect_set("pos")).alias("lines"))
    schema = StructType([lines.schema["doc_id"], lines.schema["fp"], *StructType.fromDDL("n_dropped long, bitmap binary")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            positions = [np.asarray(x, np.int64) for x in batch.column("lines").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("fp"), pa.array([len(p) for p in positions], pa.int64()),
                 pa.array([to_runs(p) for p in positions], pa.binary())],
                names=schema.names,
            )

    return lines.mapInArrow(run, schema)


def cut_texts(docs: DataFrame, bitmaps: DataFrame, keep: list[str], added: str, make: Callable[[str, int], list]) -> DataFrame:
    """The kept columns, and what `make(kept text, number of lines before, number dropped)` gives for each row. A null text is one empty line."""
    rows = docs.withColumn("__fp", F.xxhash64("text")).alias("d")
    marks = bitmaps.select(F.col("doc_id").alias("__id"), F.col("fp").alias("__with"), F.col("bitmap").alias("__bitmap"), F.col("n_dropped").alias("__n"))
    met = rows.join(marks, F.col("d.doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__fp") == F.col("__with")), "left")

    width = len(StructType.fromDDL(added))

    def run_rows() -> Callable:
        def run(texts: list[str | None], runs: list[bytes | None]) -> list[list]:
            out = []
            for text, bitmap in zip(texts, runs, strict=True):
                text = text or ""
                n = text.count("\n") + 1
                lost = 0
                if bitmap:
                    kept = from_runs(bitmap, n)
                    lost = n - int(kept.sum())
                    text = "\n".join([line for line, stays in zip(text.split("\n"), kept.tolist(), strict=True) if stays])
                out.append(make(text, n, lost))
            return [list(c) for c in zip(*out, strict=True)] or [[]] * width

        return run

    return map_texts(met, keep, added, run_rows, also=["__bitmap"])


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with their other lines, joined by line feeds; columns as before."""
    cut = cut_texts(docs, keep_bitmaps(docs, min_chars), [c for c in docs.columns if c != "text"], "text string", lambda text, n, lost: [text])
    return cut.select(docs.columns)
