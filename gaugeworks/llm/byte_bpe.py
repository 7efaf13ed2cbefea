"""Byte-level BPE by a sentencepiece model that is written from the rank file alone.

Each vocabulary entry becomes a piece: its bytes mapped one by one to printable characters, scored with its negative rank, so
that the best-scored merge is the lowest-ranked one. The normaliser is the identity, no white space is added, removed or escaped.
Texts are parted by the tokenizer's pattern first; parts never merge. Decoding maps ids to pieces and pieces to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from gaugeworks.llm.common import Words, byte_characters, map_texts, ragged

#: Bytes of words that a worker remembers at most; ids whose strings are made at once.
REMEMBERED, DIGEST_IDS = 48 << 20, 1 << 17
#: Bytes of texts that are encoded together.
SLICE_BYTES = 2 << 20
SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float | bool) -> bytes:
    """A protobuf field: varint for integers, fixed32 for floats, length-delimited otherwise."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value if value >= 0 else value + (1 << 64))
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: ids are ranks, and one unknown piece follows them."""
    chars = byte_characters()
    by_rank = sorted(ranks, key=ranks.get)
    if [ranks[p] for p in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    # pieces: 1 text, 2 score, 3 type (1 normal, 2 unknown)
    out = [
        _field(1, _field(1, "".join(chars[b] for b in piece).encode()) + _field(2, -float(rank)) + _field(3, 1))
        for rank, piece in enumerate(by_rank)
    ]
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    # trainer: 3 model type (2 is BPE), 4 vocabulary size, 40 to 43 ids of unknown, begin, end, padding
    trainer = _field(3, 2) + _field(4, len(out)) + _field(40, len(by_rank)) + b"".join(_field(n, -1) for n in (41, 42, 43))
    # normaliser: 1 name, 3 dummy prefix, 4 extra white space removed, 5 white space escaped
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join([*out, _field(2, trainer), _field(3, normaliser)])


class Codec:
    """Encodes and decodes texts; remembers the ids of words it has seen, up to a bound in bytes."""

    def __init__(self, rank_path: str, pattern: str) -> None:
        import regex
        import sentencepiece

        ranks = read_ranks(rank_path)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.parts = regex.compile(pattern).findall
        chars = byte_characters()
        self.translate = str.maketrans({chr(b): c for b, c in enumerate(chars)})
        back = {c: b for b, c in enumerate(chars)}
        self.pieces = Table([bytes(back[c] for c in self.processor.id_to_piece(i)) for i in range(len(ranks))])
        self.decimals = Table([b"%d " % i for i in range(len(ranks))])
        self.words = Words()

    def clear(self) -> None:
        self.words = Words()

    def _encode_new(self, parts: list[str]) -> None:
        for i in range(0, len(parts), 8192):
            some = parts[i : i + 8192]
            got = self.processor.encode([p.encode().decode("latin-1").translate(self.translate) for p in some], num_threads=1)
            self.words.add(some, np.fromiter(chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got)))

    def _learn(self, words: list[str]) -> None:
        """New words: one part of letters, a space before it or not, or else parted by the pattern and put together from their parts."""
        number = self.words.number
        plain, parted, parts = [], [], []
        for w in words:
            if (w[1:] if w[0] == " " else w).isalpha():
                plain.append(w)
            else:
                found = self.parts(w)
                if len(found) == 1:
                    plain.append(w)
                else:
                    parted.append(w)
                    parts.append(found)
        self._encode_new([p for p in dict.fromkeys(chain(plain, *parts)) if p not in number])
        self.words.join(parted, parts)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of words, learned where they are new."""
        found = list(map(self.words.number.get, words))
        new = [w for w, n in zip(words, found, strict=True) if n is None and w]
        if new:
            self._learn(list(dict.fromkeys(new)))
        if None in found:
            if "" not in self.words.number:
                self.words.add([""], np.empty(0, np.uint32), np.zeros(1, np.int64))
            found = [self.words.number[w] if n is None else n for w, n in zip(words, found, strict=True)]
        return np.array(found, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and how many each has.

        Where all white space of a text is single spaces and line feeds inside it, a part always ends before a space, and the space belongs to
        what follows: such texts are cut there, and a batch's distinct words are looked up once. Other texts are parted whole.
        """
        self.words = self.words.within(REMEMBERED)
        cut = [len(t.split()) == t.count(" ") + t.count("\n") + 1 for t in texts]
        split = pc.split_pattern(pa.array([t if c else "" for t, c in zip(texts, cut, strict=True)], pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        distinct, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        offsets = split.offsets.to_numpy()
        numbers = self.numbers([" " + w for w in distinct])[at]
        heads = [distinct[i] for i in at[offsets[:-1]]]
        numbers[offsets[:-1]] = self.numbers(heads)
        sizes = self.words.sizes[numbers]
        counts = np.add.reduceat(sizes, offsets[:-1]) if len(texts) else np.empty(0, np.int64)
        ids = self.words.ids(numbers)[0]
        whole = [i for i, (t, c) in enumerate(zip(texts, cut, strict=True)) if t and not c]
        if whole:
            some = np.split(ids, np.cumsum(counts)[:-1])
            for i in whole:
                some[i] = self.words.ids(self.numbers(self.parts(texts[i])))[0]
                counts[i] = len(some[i])
            ids = np.concatenate(some)
        return ids, counts

    def decode(self, ids: np.ndarray) -> bytes:
        return self.pieces.of(np.asarray(ids, np.int64)).tobytes()


class Table:
    """Byte strings by id, side by side."""

    def __init__(self, strings: list[bytes]) -> None:
        self.pool = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def of(self, ids: np.ndarray) -> np.ndarray:
        return ragged(self.pool, self.starts[ids], self.sizes[ids])

    def digests(self, ids: np.ndarray, counts: np.ndarray, last: int) -> list[str]:
        """sha256 of each sequence's strings without the last so many bytes; many short sequences, or a part of a long one, at a time."""
        out, stops = [], np.cumsum(counts)
        start = 0
        while start < len(counts):
            before = int(stops[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(stops, before + DIGEST_IDS, side="right")))
            if stop == start + 1:
                digest, held = hashlib.sha256(), b""
                for a in range(before, int(stops[start]), DIGEST_IDS):
                    digest.update(held)
                    held = self.of(ids[a : min(a + DIGEST_IDS, int(stops[start]))]).tobytes()
                digest.update(held[: max(0, len(held) - last)])
                out.append(digest.hexdigest())
            else:
                some = ids[before : int(stops[stop - 1])]
                raw = memoryview(self.of(some).tobytes())
                ends = np.concatenate([[0], np.cumsum(self.sizes[some])])[stops[start:stop] - before].tolist()
                a = 0
                for b in ends:
                    out.append(hashlib.sha256(raw[a : max(a, b - last)]).hexdigest())
                    a = b
            start = stop
        return out


@lru_cache(maxsize=2)
def codec(rank_path: str, pattern: str) -> Codec:
    return Codec(rank_path, pattern)


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, keep: Sequence[str] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """The kept columns with n_tokens, ids_sha256 and decoded_sha256 (of the bytes that decoding gives), and the ids if asked for.

    A null text counts as empty: no ids. Every row gives one row, repeated ones too.
    """
    def make():  # noqa: ANN202
        tool = codec(rank_path, pattern)

        def run(texts: list[str | None]) -> list[list]:
            ids, counts = tool.encode([t or "" for t in texts])
            ids = ids.astype(np.int64)
            out = [counts, tool.decimals.digests(ids, counts, 1), tool.pieces.digests(ids, counts, 0)]
            return [*out, np.split(ids.astype(np.int32), np.cumsum(counts)[:-1])] if with_ids and len(counts) else [*out, *[[]] * with_ids]

        run.clear = tool.clear
        return run

    return map_texts(docs, keep, SCHEMA + ", ids array<int>" * with_ids, make, slice_bytes=SLICE_BYTES)


def decode_ids(rank_path: str, pattern: str) -> Callable[[list[int]], bytes]:
    """Bytes of a list of ids."""
    return lambda ids: codec(rank_path, pattern).decode(np.array(ids, np.int64))
