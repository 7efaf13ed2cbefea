"""Language of documents and of the spans inside them.

A word's letters give the scripts it is written in, and only languages of these scripts stay candidates. Each candidate scores
the word by its byte trigrams; a Viterbi pass over the words of a document, with a penalty for each change of language, labels spans.
The document's language is the one whose spans hold most letters.

The model is a table of trigram buckets by language, summed over all training documents, so that its size follows the number of
languages only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import map_texts, slices
from gaugeworks.llm.token_files import batches

BUCKETS = 1 << 16
#: Log-likelihood that a change of language costs, and the share of a language's letters that makes a script its own.
SWITCH, SCRIPT_SHARE = 8.0, 0.01
UNKNOWN = "und"
#: Bytes of text that are split at once, and whose words a Viterbi pass takes side by side.
SLICE, SIDE_BY_SIDE = 1 << 19, 8 << 20

#: First code point and last of each script. Fixed values of the Unicode blocks; scripts not listed share one number.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "ethiopic": [(0x1200, 0x137F)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
    "hangul": [(0xAC00, 0xD7AF)],
}
OTHER_SCRIPT = len(SCRIPTS)


def _script_of_pairs() -> np.ndarray:
    """Script by the first two bytes of a letter. These two fix 64 code points; ASCII letters need one byte only."""
    out = np.full(1 << 16, OTHER_SCRIPT, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            for point in range(first, last + 1) if last < 0x80 else range(first & ~63, last + 1, 64):
                lead = chr(point).encode()
                if len(lead) == 1:
                    out[lead[0] << 8 : lead[0] + 1 << 8] = number
                elif len(lead) == 2:
                    out[lead[0] << 8 : lead[0] + 1 << 8] = number
                else:
                    out[lead[0] << 8 | lead[1]] = number
    return out


PAIRS = _script_of_pairs()
LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


@dataclass
class Words:
    """Words of many texts in flat arrays: trigram buckets of all bytes, first byte and scripts of each word, words of each text."""

    bucket: np.ndarray
    script: np.ndarray
    first: np.ndarray
    scripts: np.ndarray
    letters: np.ndarray
    counts: np.ndarray


def split(texts: list[str]) -> Words:
    raw = [f" {t.lower()} ".encode() for t in texts]
    byte = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    letter = LETTER[byte]
    spot = np.flatnonzero(letter)
    if not len(spot):
        none = np.empty(0, np.int64)
        return Words(none, none, none, none, none, np.zeros(len(texts), np.int64))
    plain = np.where(letter, byte, 32).astype(np.uint32)
    code = plain[spot - 1] << 16 | plain[spot] << 8 | plain[spot + 1]  # every text begins and ends with a space
    bucket = (code * np.uint32(2654435761)) >> np.uint32(16)
    begins = ~letter[spot - 1]
    first = np.flatnonzero(begins)
    pair = byte[spot].astype(np.int64) << 8 | byte[spot + 1]
    script = PAIRS[pair]
    lead = (byte[spot] < 128) | (byte[spot] >= 192)
    bits = np.where(lead, np.left_shift(1, script.astype(np.int64)), 0)
    scripts = np.bitwise_or.reduceat(bits, first)
    letters = np.add.reduceat(lead.astype(np.int64), first)
    text = np.searchsorted(ends, spot[first], side="right")
    return Words(bucket, np.where(lead, script, 255), first, scripts, letters, np.bincount(text, minlength=len(texts)))


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # of buckets by language
    scripts: np.ndarray  # bits of the scripts of each language
    switch: float

    def of_words(self, w: Words) -> np.ndarray:
        """Scores of words by language; languages of other scripts fall far behind, unless none is left."""
        score = np.add.reduceat(self.scores[w.bucket], w.first, axis=0) if len(w.first) else np.empty((0, len(self.languages)), np.float32)
        fits = (w.scripts[:, None] & ~self.scripts) == 0
        score[~fits & fits.any(axis=1)[:, None]] -= 1e4
        score[~fits.any(axis=1)] = 0
        return score - score.max(axis=1, keepdims=True) if len(score) else score

    def path(self, score: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Language of each word. Documents go side by side, one word of each at a time."""
        order = np.argsort(-counts, kind="stable")
        start, size = (np.cumsum(counts) - counts)[order], counts[order]
        back = np.empty(score.shape, np.int8 if len(self.languages) < 128 else np.int16)
        state = np.zeros((int((size > 0).sum()), len(self.languages)), np.float32)
        own = np.arange(len(self.languages))
        last = np.empty(len(state), np.int64)
        for t in range(int(size[0]) if len(size) else 0):
            active = int(np.searchsorted(-size, -t, side="left"))
            if active < len(state):
                last[active : len(state)] = state[active:].argmax(axis=1)
                state = state[:active]
            best = state.argmax(axis=1)
            moved = state[np.arange(active), best] - np.float32(self.switch)
            stay = state >= moved[:, None]
            here = start[:active] + t
            back[here] = np.where(stay, own, best[:, None])
            state = np.where(stay, state, moved[:, None]) + score[here]
        last[: len(state)] = state.argmax(axis=1)
        out = np.empty(len(score), back.dtype)
        now = last
        for t in range(int(size[0]) - 1 if len(size) else -1, -1, -1):
            active = int(np.searchsorted(-size, -t, side="left"))
            here = start[:active] + t
            out[here] = now[:active]
            now[:active] = back[here, now[:active]]
        return out


def train(docs: DataFrame, switch: float = SWITCH, smoothing: float = 0.5) -> Model:
    """A model of the non-null `lang` values of the documents given, from their whole texts."""

    def counts(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in (part for whole in batches_ for part in slices(whole, "text", SLICE)):
            langs, texts = (batch.column(c).to_pylist() for c in ("lang", "text"))
            for lang in set(langs):
                total = held.setdefault(lang, np.zeros(BUCKETS + 256, np.int64))
                w = split([t for x, t in zip(langs, texts, strict=True) if x == lang])
                total[:BUCKETS] += np.bincount(w.bucket, minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(w.script, minlength=256)
        for lang, total in held.items():
            bucket = np.flatnonzero(total)
            arrays = [pa.array([lang] * len(bucket)), pa.array(bucket, pa.int32()), pa.array(total[bucket], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "bucket", "n"])
        pa.default_memory_pool().release_unused()

    # at most BUCKETS + 256 rows a language
    rows = (
        docs.where("lang is not null and text is not null").select("lang", "text")
        .mapInArrow(counts, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(rows["lang"].unique())
    table = np.zeros((BUCKETS + 256, max(len(languages), 1)))
    table[rows["bucket"], [languages.index(x) for x in rows["lang"]]] = rows["n"]
    grams, letters = table[:BUCKETS] + smoothing, table[BUCKETS : BUCKETS + OTHER_SCRIPT + 1]
    scores = np.log(grams / grams.sum(axis=0)).astype(np.float32)
    share = letters / np.maximum(letters.sum(axis=0), 1)
    scripts = ((share >= SCRIPT_SHARE) * (1 << np.arange(OTHER_SCRIPT + 1))[:, None]).sum(axis=0)
    return Model(languages, scores, scripts, switch)


def identify(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), with_spans: bool = False, column: str = "text") -> DataFrame:
    """The kept columns with lang_pred, score (the share of letters in its spans), and the spans if asked for.

    Spans are runs of words of one language: first word, word behind the last, language. Null texts and texts without a letter
    are `und` with score 0, also where the model has learned no language; every row gives one row, repeated ones too.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # its size follows the number of languages
    added = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"

    def make():  # noqa: ANN202
        m: Model = sent.value
        names = [*m.languages, UNKNOWN]

        def run(texts: list[str | None]) -> list[list]:
            texts = ["" if t is None else t for t in texts]
            parts = []
            for a, b in batches(texts if m.languages else [], SLICE):
                w = split(texts[a:b])
                parts.append((m.of_words(w), w.letters.astype(np.int32), w.counts))
            lang, share = np.full(len(texts), len(m.languages)), np.zeros(len(texts))
            spans: list[list] = [[] for _ in texts]
            if m.languages and texts:
                score, letter, count = (np.concatenate(x) for x in zip(*parts, strict=True))
                parts.clear()
                path = m.path(score, count)
                held = np.zeros((len(texts), len(m.languages)))
                np.add.at(held, (np.repeat(np.arange(len(texts)), count), path), letter)
                some = held.sum(axis=1) > 0
                lang[some] = held[some].argmax(axis=1)
                share[some] = held[some].max(axis=1) / held[some].sum(axis=1)
                edge = np.cumsum(count)
                for n, (a, b) in enumerate(zip(edge - count, edge, strict=True) if with_spans else ()):
                    cuts = [0, *(np.flatnonzero(np.diff(path[a:b])) + 1), b - a] if b > a else [0]
                    spans[n] = [{"start": int(x), "end": int(y), "lang": names[path[a + x]]} for x, y in zip(cuts, cuts[1:], strict=False)]
            for n in np.flatnonzero(lang < len(m.languages)):
                if not texts[n].isascii() and not any(map(str.isalpha, texts[n])):
                    lang[n], share[n], spans[n] = len(m.languages), 0.0, []
            return [[names[x] for x in lang], share, *[spans] * with_spans]

        return run

    return map_texts(docs, keep, added if with_spans else added.rpartition(", spans")[0], make, column, slice_bytes=SIDE_BY_SIDE)


def keep_known(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Documents whose language the model knows by at least that share of their letters, with their own columns."""
    renamed = docs.toDF(*(f"c_{c}" for c in docs.columns))  # no name clashes with a new one
    known = identify(renamed, model, renamed.columns, column="c_text")
    return known.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).drop("lang_pred", "score").toDF(*docs.columns)
