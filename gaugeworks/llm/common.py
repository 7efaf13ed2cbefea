"""What the operators share: words, hold-out, the shared folder, rows through Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from gaugeworks.session import scratch_path

#: Bytes of words: digits, letters (capitals lowered) and everything outside ASCII; all others part words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a text, as UTF-8. A null text has none."""
    return text.encode("utf-8", "replace").translate(WORD_BYTES).split() if text else []


def byte_characters() -> list[str]:
    """A character for each byte: itself where printable, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def held_out(key: str = "doc_id") -> Column:
    """One row in five, by the checksum of its id; rows without an id are never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, read back: lineage is cut, and lost executors lose nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in parts of about `size` bytes of a text column; a longer text is a part of its own."""
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(total):
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + size, side="right")))
        yield batch.slice(start, end - start)
        start = end


def ragged(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices of a pool, one behind the other."""
    ends = np.cumsum(sizes)
    return pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Words:
    """Ids of words: a number for each word, all their ids in one array, and how often each was asked for."""

    def __init__(self) -> None:
        self.number: dict = {}
        self.uses = np.zeros(1 << 14, np.int64)
        self.starts, self.sizes, self.pool = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64), np.empty(1 << 16, np.uint32)
        self.used = self.key_bytes = 0

    def held(self) -> int:
        """About how many bytes all this takes."""
        return 180 * len(self.number) + 2 * self.key_bytes + 8 * self.used

    @staticmethod
    def _with(array: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
        if at + len(values) > len(array):
            array = np.concatenate([array, np.empty(max(len(array), len(values)), array.dtype)])
        array[at : at + len(values)] = values
        return array

    def add(self, words: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        """New words (none twice) with their ids, one word's behind the other's."""
        n = len(self.number)
        self.starts = self._with(self.starts, n, self.used + np.cumsum(sizes) - sizes)
        self.sizes = self._with(self.sizes, n, sizes)
        self.uses = self._with(self.uses, n, np.zeros(len(sizes), np.int64))
        self.pool = self._with(self.pool, self.used, ids)
        self.used += len(ids)
        self.key_bytes += sum(map(len, words))
        self.number.update(zip(words, range(n, n + len(words)), strict=True))

    def join(self, words: list, parts: list[list]) -> None:
        """New words, each put together from words that are known."""
        flat = [self.number[p] for some in parts for p in some]
        ids, sizes = self.ids(np.array(flat, np.int64))
        before = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum([len(some) for some in parts])
        self.add(words, ids, np.diff(before[ends], prepend=0) if len(ends) else ends)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their count for a sequence of words."""
        self.uses[: len(self.number)] += np.bincount(numbers, minlength=len(self.number))
        sizes = self.sizes[numbers]
        return ragged(self.pool, self.starts[numbers], sizes), sizes

    def within(self, limit: int) -> Words:
        """These words, or, where they take more than so many bytes, the more used half of those that were used again.

        Most words of a text are rare, and few make up most of it: what goes is seldom asked for.
        """
        if self.held() <= limit:
            return self
        uses = self.uses[: len(self.number)]
        chosen = np.flatnonzero(uses > max(1, np.median(uses)))
        keep = set(chosen.tolist())
        kept = Words()
        kept.add([w for w, n in self.number.items() if n in keep], *self.ids(chosen))
        kept.uses[: len(chosen)] = uses[chosen] // 2
        return kept if kept.held() <= limit // 4 * 3 else Words()


def settle(*caches: Callable[[], object]) -> None:
    """At the end of a task: workers live on, and what one operator remembers is no use to the next."""
    for clear in caches:
        clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_texts(
    docs: DataFrame,
    keep: Sequence[str],
    added: str,
    make: Callable[[], Callable],
    column: str = "text",
    also: Sequence[str] = (),
    slice_bytes: int = 4 << 20,
) -> DataFrame:
    """The kept columns, untouched, and what a function makes of whole texts, some rows at a time.

    `make()` runs once a task; what it returns takes rows' texts (and the columns of `also`), as lists, and gives a list of values
    for each column of the `added` schema; if it has an attribute `clear`, that is called when the task ends. Rows come in slices of about `slice_bytes` of text (a longer text is a slice of its own), so
    that memory follows neither the batch nor the partition. A kept column named like an added one is left out.
    """
    new = StructType.fromDDL(added)
    keep = [c for c in keep if c not in new.names]
    text = column if column in keep else "__text"
    rows = docs.select(*keep, *[F.col(column).alias(text)] * (text not in keep), *(F.col(c).alias(f"__{c}") for c in also))
    schema = StructType([rows.schema[c] for c in keep] + new.fields)
    types = [to_arrow_type(f.dataType) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in (part for whole in batches for part in slices(whole, text, slice_bytes)):
            made = work(batch.column(text).to_pylist(), *(batch.column(f"__{c}").to_pylist() for c in also))
            arrays = [pa.array(values, kind) for values, kind in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *arrays], names=schema.names)
        settle(*([work.clear] if hasattr(work, "clear") else []))

    return rows.mapInArrow(run, schema)
