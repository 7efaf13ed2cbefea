"""Token ids of documents in files of word-aligned blocks (Simple-8b).

A 64-bit word starts with a four-bit selector; the other 60 bits hold as many ids as the selector says, all of one width.
Two selectors are special: a run (one value, many times) and an escape, whose payload points into the chunk's list of values
of more than 60 bits. Every block of 512 ids starts on a new word, and the chunk stores the first word of each block, so that
blocks decode independently and without a loop over ids.

A file is a Parquet part that Spark's committer writes, so a lost executor leaves no half file. Its rows are chunks of whole
documents in ascending doc_id order; shards are numbered in that order too.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import Words, byte_characters, settle, slices

BLOCK = 512
CHUNK_IDS = 1 << 19
#: Bytes of words that a worker remembers at most.
REMEMBERED = 80 << 20

#: Selector: ids in a word, bits of an id. Fixed values of the format; 0 is the escape, 1 the run.
ESCAPE, RUN = 0, 1
LAYOUT = {
    2: (60, 1), 3: (30, 2), 4: (20, 3), 5: (15, 4), 6: (12, 5), 7: (10, 6), 8: (8, 7),
    9: (7, 8), 10: (6, 10), 11: (5, 12), 12: (4, 15), 13: (3, 20), 14: (2, 30), 15: (1, 60),
}
#: Punctuation that is a token of its own behind a letter or digit (an apostrophe may start a suffix).
MARKS = b",.!?;:#*$%&"
ENDS = {bytes([b]) for b in MARKS}
#: Bytes of texts that are encoded together.
SLICE_BYTES = 6 << 20
RUN_BITS = 10  # a run never leaves its block
WIDE = np.uint64(1) << np.uint64(60)
WIDTHS = np.array([1 << bits for _, bits in LAYOUT.values()], np.uint64)
SMALL_WIDTHS = np.searchsorted(WIDTHS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)

CHUNK_SCHEMA = (
    "shard int, chunk int, first_id long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, "
    "words binary, block_words binary, escapes binary"
)
READ_SCHEMA = "doc_id long, shard int, offset long, n_tokens long, ids_crc32 long"


def width_of(values: np.ndarray) -> np.ndarray:
    """The index of the narrowest layout that holds each value; their number where none does."""
    if int(values.max()) < len(SMALL_WIDTHS):
        return SMALL_WIDTHS[values.astype(np.int64)]
    return np.searchsorted(WIDTHS, values, side="right")


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block, and escaped values of a sequence of unsigned ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    lanes = -(-n // BLOCK)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint64)
    values = np.zeros((lanes, BLOCK), np.uint64)
    values.ravel()[:n] = ids
    end = np.full(lanes, BLOCK)
    end[-1] = n - (lanes - 1) * BLOCK
    at = np.arange(BLOCK, dtype=np.int16)
    left = (end[:, None] - at).astype(np.int16)

    # zeros behind a block's end fit anywhere, and are wide enough that no word reaches the next block
    stride = BLOCK + 64
    widths = np.zeros((lanes, stride), np.uint8)
    widths[:, :BLOCK] = width_of(values)
    all_fit = int(widths.max()) + 2  # the narrowest selector that suits every value
    take = np.full((lanes, stride), LAYOUT[all_fit][0] if all_fit in LAYOUT else 1, np.int16)
    chosen = np.full((lanes, stride), all_fit if all_fit in LAYOUT else ESCAPE, np.uint8)
    for selector in sorted((s for s in LAYOUT if s < all_fit), reverse=True):  # widest first, so that words with more ids overwrite
        count = LAYOUT[selector][0]
        fits = np.flatnonzero(widths.ravel() <= selector - 2)
        first = fits[: max(0, len(fits) - count + 1)]
        first = first[fits[count - 1 :] - first == count - 1]
        chosen.ravel()[first] = selector
        take.ravel()[first] = count
    take, chosen = take[:, :BLOCK], chosen[:, :BLOCK]
    take = np.minimum(take, np.maximum(left, 1))
    same = np.zeros((lanes, BLOCK), bool)
    same[:, :-1] = values[:, 1:] == values[:, :-1]
    run = np.minimum(np.minimum.accumulate(np.where(same, np.int16(BLOCK), at)[:, ::-1], axis=1)[:, ::-1] - at + 1, left)
    long_run = (run > take) & (values < (np.uint64(1) << np.uint64(60 - RUN_BITS)))
    chosen[long_run], take[long_run] = RUN, run[long_run]

    lane, pos = np.arange(lanes), np.zeros(lanes, np.int64)
    lane_parts, pos_parts = [], []
    while len(lane):  # one word of every block at a time
        lane_parts.append(lane)
        pos_parts.append(pos)
        pos = pos + take[lane, pos]
        more = pos < end[lane]
        lane, pos = lane[more], pos[more]
    lane, pos = np.concatenate(lane_parts), np.concatenate(pos_parts)
    order = np.argsort(lane, kind="stable")
    lane, pos = lane[order], pos[order]

    selector = chosen[lane, pos]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s, (count, bits) in LAYOUT.items():
        here = np.flatnonzero(selector == s)
        if len(here):
            cell = pos[here, None] + np.arange(count)
            inside = cell < end[lane[here], None]
            picked = np.where(inside, values[lane[here, None], np.minimum(cell, BLOCK - 1)], np.uint64(0))
            words[here] |= np.bitwise_or.reduce(picked << (np.arange(count, dtype=np.uint64) * np.uint64(bits)), axis=1)
    runs = selector == RUN
    words[runs] |= (values[lane[runs], pos[runs]] << np.uint64(RUN_BITS)) | take[lane[runs], pos[runs]].astype(np.uint64)
    escaped = selector == ESCAPE
    words[escaped] |= np.arange(escaped.sum(), dtype=np.uint64)
    return words, np.searchsorted(lane, np.arange(lanes)).astype(np.uint32), values[lane[escaped], pos[escaped]]


def unpack(words: np.ndarray, block_words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ids again, all blocks at once."""
    out = np.empty(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    body = words & (WIDE - np.uint64(1))
    counts = np.array([1, 0, *(LAYOUT[s][0] for s in range(2, 16))])[selector]
    runs = selector == RUN
    counts[runs] = (body[runs] & np.uint64((1 << RUN_BITS) - 1)).astype(np.int64)
    block = np.repeat(np.arange(len(block_words)), np.diff(np.append(block_words.astype(np.int64), len(words))))
    before = np.cumsum(counts) - counts
    start = block * BLOCK + before - before[block_words.astype(np.int64)][block]
    end = np.minimum((block + 1) * BLOCK, n)
    for s, (count, bits) in LAYOUT.items():
        here = np.flatnonzero(selector == s)
        if len(here):
            cell = start[here, None] + np.arange(count)
            picked = (body[here, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(bits))) & np.uint64((1 << bits) - 1)
            inside = cell < end[here, None]
            out[cell[inside]] = picked[inside]
    here = np.flatnonzero(runs)
    if len(here):
        size = counts[here]
        cell = np.repeat(start[here] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out[cell] = np.repeat(body[here] >> np.uint64(RUN_BITS), size)
    here = np.flatnonzero(selector == ESCAPE)
    out[start[here]] = escapes[body[here].astype(np.int64)]
    return out


def parts_at_white_space(path: str) -> bool:
    """Whether the file's normaliser and pre-tokenizer are those for which pieces between white space encode alone."""
    import json

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    steps = (told.get("normalizer") or {}).get("normalizers") or []
    splits = (told.get("pre_tokenizer") or {}).get("pretokenizers") or []
    letters = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    return (
        [x.get("type") for x in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1].get("pattern") == {"Regex": r"\s+"}
        and [x.get("type") for x in splits] == ["Split", "ByteLevel"]
        and splits[0].get("pattern") == {"Regex": letters}
        and told["model"].get("end_of_word_suffix") == "</w>"
    )


Encode = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def whole_encoder(tokenizer) -> Encode:  # noqa: ANN001
    """Ids of all texts, one behind the other, and how many each has; for any tokenizer."""

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        got = [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        return np.concatenate([*got, np.empty(0, np.uint32)]), np.array([len(e) for e in got], np.int64)

    return encode


@lru_cache(maxsize=2)
def word_encoder(path: str, specials_as_text: bool) -> Encode:
    """Ids of all texts, one behind the other, and how many each has.

    Where the tokenizer's pattern never crosses white space and its normaliser never joins across it, texts are parted at ASCII white
    space, a batch's distinct pieces are encoded once and remembered, and ids are gathered by piece numbers. Special tokens hold no white
    space either. Other tokenizers encode whole texts.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = specials_as_text
    if not parts_at_white_space(path):
        return whole_encoder(tokenizer)
    model, as_characters = tokenizer.model, str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
    held = {"words": Words()}

    def normal(piece: bytes) -> str:
        """What the tokenizer's normaliser makes of it: a letter may become one with a mark behind it."""
        return unicodedata.normalize("NFC", piece.decode()).lower()

    def one_by_one(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got))

    def simple(piece: bytes) -> bool:
        """Letters only, which the normaliser leaves alone: the model's own word."""
        if piece.isascii():
            return piece.isalpha()
        text = piece.decode()
        return text.isalpha() and max(text) < "\u0250" and text == normal(piece)

    def of_model(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = [[t.id for t in model.tokenize(p.decode("latin-1").translate(as_characters))] for p in pieces]
        return np.fromiter(chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got))

    def learn(words: Words, pieces: list[bytes]) -> None:
        """A letter or digit never merges with the punctuation that ends its piece."""
        marked = [(p, p.rstrip(MARKS)) for p in pieces if p[-1:] in ENDS]
        tails = [(p, h) for p, h in marked if h and (h[-1:].isalnum() or h[-1] > 127 and normal(h)[-1].isalnum())]
        split = {p for p, _ in tails}
        fresh = {p for p in pieces if p not in split}
        fresh.update(x for p, h in tails for x in (h, p[len(h) :]))
        fresh = [p for p in fresh if p not in words.number]
        plain = [p for p in fresh if simple(p)]
        words.add(plain, *of_model(plain))
        taken = set(plain)
        other = [p for p in fresh if p not in taken]
        for i in range(0, len(other), 4096):
            words.add(other[i : i + 4096], *one_by_one(other[i : i + 4096]))
        if tails:
            words.join([p for p, _ in tails], [[h, p[len(h) :]] for p, h in tails])

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string())  # a copy: ascii_lower misreads slices
        pieces = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))  # special tokens keep their case
        coded = pieces.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
        words = held["words"] = held["words"].within(REMEMBERED)
        found = list(map(words.number.get, distinct))
        new = [p for p, n in zip(distinct, found, strict=True) if n is None]
        if new:
            learn(words, new)
            found = [words.number[p] if n is None else n for p, n in zip(distinct, found, strict=True)]
        numbers = np.array(found, np.int64)
        ids, sizes = words.ids(numbers[coded.indices.to_numpy()])
        before = np.concatenate([[0], np.cumsum(sizes)])
        offsets = pieces.offsets.to_numpy()
        return ids, before[offsets[1:] - offsets[0]] - before[offsets[:-1] - offsets[0]]

    return encode


def batches(texts: list[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters, so that memory follows neither the batch nor the partition."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, specials_as_text: bool = False) -> None:
    """Encodes whole texts and writes them in ascending doc_id order.

    A null text counts as empty and holds the end id alone. Rows without a doc_id come first; rows of one doc_id follow
    each other in the order of their texts. Columns other than doc_id and text are ignored.
    """
    schema = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                        *[(c, pa.binary()) for c in ("words", "block_words", "escapes")]])

    def chunks(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = word_encoder(tokenizer, specials_as_text), TaskContext.get().partitionId()
        state = {"chunk": 0, "first": 0, "size": 0}
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def chunk() -> pa.RecordBatch:
            ids = np.concatenate([i for *_, i in held])
            words, block_words, escapes = pack(ids)
            row = [
                shard, state["chunk"], state["first"], len(ids), pa.concat_arrays([d for d, *_ in held]), np.concatenate([n for _, n, _ in held]),
                words.astype("<u8").tobytes(), block_words.astype("<u4").tobytes(), escapes.astype("<u8").tobytes(),
            ]
            state.update(chunk=state["chunk"] + 1, first=state["first"] + len(ids), size=0)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in (part for whole in batches_ for part in slices(whole, "text", SLICE_BYTES)):
            ids, counts = encode(batch.column("text"))
            counts = counts + 1
            stops = np.cumsum(counts)
            ended = np.full(stops[-1], end_id, np.uint32)
            inside = np.ones(len(ended), bool)
            inside[stops - 1] = False
            ended[inside] = ids
            start = 0
            while start < len(counts):  # whole documents until the chunk is full
                before = int(stops[start - 1]) if start else 0
                stop = min(len(counts), int(np.searchsorted(stops, before + CHUNK_IDS - state["size"])) + 1)
                held.append((batch.column("doc_id").slice(start, stop - start), counts[start:stop], ended[before : stops[stop - 1]]))
                state["size"] += int(stops[stop - 1]) - before
                if state["size"] >= CHUNK_IDS:
                    yield chunk()
                start = stop
        if held:
            yield chunk()
        settle()

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(chunks, CHUNK_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Chunks decode on their own; the ids before a shard come from one small row per shard.
    """

    def decode(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 1) for whole in batches_ for i in range(whole.num_rows)):
            row = {c: batch.column(c)[0] for c in batch.schema.names}
            n, first, shard = (row[c].as_py() for c in ("n_ids", "first_id", "shard"))
            ids = unpack(*(np.frombuffer(row[c].as_py(), kind) for c, kind in (("words", "<u8"), ("block_words", "<u4"), ("escapes", "<u8"))), n)
            lengths = row["lengths"].values.to_numpy()
            ends = np.cumsum(lengths)
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
            columns = [row["doc_ids"].values, np.full(len(ends), shard, np.int32), first + ends - lengths, lengths, np.array(crc, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in READ_SCHEMA.split(", ")])

    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = shards.select(
        "shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    # a row per shard file: the driver lists as many files anyway
    return (
        chunks.mapInArrow(decode, READ_SCHEMA)
        .join(F.broadcast(before), "shard")
        .select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
    )
