"""Personal data by weak supervision.

Strict patterns find e-mail and IP addresses, card and phone numbers; these spans always stay. Looser patterns propose more spans.
Labelers (pattern, checksum, gazetteer, context, shape) vote on every candidate: personal, not personal, or no opinion.
Expectation-maximisation estimates, for each kind, how often each labeler is right, from the counts of vote patterns alone, and
gives each pattern a probability. A logistic classifier of the candidates' features is then trained on these probabilities; a proposed
span is added if the classifier is sure enough and no strict span of its kind overlaps it.

Texts are read once. Votes and features are few and discrete, so that the models are fitted to counts over all candidates
whose number does not grow with the corpus.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import map_texts, written

KINDS = ("email", "ip", "card", "phone")
#: Probability from which a proposed span is added.
SURE = 0.9

#: Strict patterns. Fixed values of the contract. Those of e-mail and IP addresses take a whole run of their first characters whether or not
#: the rest follows (group 1): no start inside the run fits where its beginning does not, so long runs are read once.
STRICT = {
    "email": re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?"),
    "ip": re.compile(r"[0-9]++((?:\.[0-9]++){3})?"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: Looser ones, which only propose.
LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]++( ?(?:\(at\)|\[at\]|\{at\}| at ) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]++)+)?"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[.\x20/-]{1,3}[0-9]{4}){2}[.\x20/-]{1,3}[0-9]{2,4}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\([0-9]{2,4}\) ?|00[0-9]{1,3}[ -]|0[0-9]{2,4}[ /-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])"),
}
#: What a text must hold for the patterns to be worth trying.
HINTS = {"email": re.compile(r"@|\b[aA][tT]\b"), "number": re.compile(r"[0-9]"), "colon": re.compile(r"[0-9A-Fa-f]:[0-9A-Fa-f]")}
#: Words that speak for each kind when they stand shortly before a span.
CUES = {
    "email": re.compile(r"\b(?:e-?mails?|mail|contact|correo|courriel|write to|kontakt)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|adresse|ping|login from)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|karte|tarjeta|carte|payment)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telefon|mobile|call|fax|tél|teléfono|handy|whatsapp)\b", re.I),
}
#: Words that speak against any kind there.
COUNTER = re.compile(r"\b(?:version|isbn|issn|doi|order|invoice|page|section|figure|token|serial|part no)\b", re.I)
#: Gazetteer: top-level domains, first digits of card issuers, private and special networks, trunk prefixes.
DOMAINS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "nl", "eu", "us", "ch", "at"}
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "35", "30", "36", "38")
NETWORKS = ("0.", "127.", "255.")
LABELERS = ("pattern", "checksum", "gazetteer", "context", "shape")
NEAR = 40


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def strict_ok(kind: str, span: str) -> bool:
    """What a strict match must pass besides its pattern."""
    if kind == "ip":
        return all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in span.split("."))
    if kind == "email":
        return True
    digits = "".join(c for c in span if "0" <= c <= "9")
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15


def votes(kind: str, span: str, before: str, strict: bool) -> tuple[int, ...]:
    """A vote of each labeler: 1 personal, -1 not, 0 no opinion."""
    digits = "".join(c for c in span if "0" <= c <= "9")
    checksum = shape = gazetteer = 0
    if kind == "email":
        parts = re.split(r"[.\s()\[\]]+", span.lower())
        gazetteer = 1 if parts[-1] in DOMAINS else 0  # a short list: what it lacks may be a domain too
        shape = -1 if len(span) > 80 else 1
    elif kind == "ip":
        gazetteer = -1 if span.startswith(NETWORKS) else 0
        shape = 1 if ":" in span or all(p == (p.lstrip("0") or "0") for p in span.split(".")) else -1
    elif kind == "card":
        checksum = 1 if luhn(digits) else -1
        gazetteer = 1 if digits.startswith(ISSUERS) else -1
        shape = 1 if 14 <= len(digits) <= 19 else -1
    else:
        gazetteer = 1 if span.startswith(("+", "00", "0", "(")) else -1
        shape = 1 if 10 <= len(digits) <= 15 else -1
    context = 1 if CUES[kind].search(before) else -1 if COUNTER.search(before) else 0
    return (1 if strict else -1), checksum, gazetteer, context, shape


class Spans:
    """Spans that follow each other without overlap."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def add(self, start: int, end: int) -> None:
        self.starts.append(start)
        self.ends.append(end)

    def meet(self, start: int, end: int) -> bool:
        last = bisect_left(self.starts, end) - 1
        return last >= 0 and self.ends[last] > start

    def all(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, self.ends, strict=True))


def _matches(pattern: re.Pattern, text: str) -> Iterator[re.Match]:
    return (m for m in pattern.finditer(text) if not pattern.groups or m.lastindex)


def candidates(text: str) -> list[tuple[str, int, int, bool, str]]:
    """Strict spans that pass, and proposed ones: kind, start, end, strict, votes as text.

    Strict matches are the leftmost of their kind that do not overlap; a match that fails its test is dropped, and its characters are not
    searched again, but its span is proposed.
    """
    out = []
    number, mail, colon = HINTS["number"].search(text), HINTS["email"].search(text), HINTS["colon"].search(text)
    for kind in KINDS:
        if not (mail if kind == "email" else number or (kind == "ip" and colon)):
            continue
        own, failed, loose = Spans(), Spans(), []
        if kind != "email" or "@" in text:
            for m in _matches(STRICT[kind], text):
                if strict_ok(kind, m[0]):
                    own.add(*m.span())
                elif kind == "card" and 13 <= sum(c.isdigit() for c in m[0]) <= 19:
                    failed.add(*m.span())
        if kind != "ip" or colon:
            loose = [m.span() for m in _matches(LOOSE[kind], text)]
        found = [(a, b, True) for a, b in own.all()] + [(a, b, False) for a, b in failed.all()]
        found += [(a, b, False) for a, b in loose if not own.meet(a, b) and not failed.meet(a, b)]
        for a, b, good in found:
            vote = votes(kind, text[a:b], text[max(0, a - NEAR) : a], good)
            out.append((kind, a, b, good, ",".join(map(str, vote))))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[1], order[s[0]], s[2]))


def estimate(patterns: dict[tuple[int, ...], int], rounds: int = 200) -> dict[tuple[int, ...], float]:
    """Probability that candidates of each vote pattern are personal, by expectation-maximisation over the labelers' reliabilities.

    A labeler without opinion says nothing. It starts from the majority of votes, and counts are smoothed by one, so that every
    pattern gets a value, also where a labeler never votes.
    """
    if not patterns:
        return {}
    vote = np.array(list(patterns))
    n = np.array(list(patterns.values()), float)
    p = 1 / (1 + np.exp(-vote.sum(axis=1)))
    for _ in range(rounds):
        share = (n @ p + 1) / (n.sum() + 2)
        says = [[(((n * w) @ (vote == v)) + (2 if good else 1)) / ((n * w) @ (vote != 0) + 3) for v, good in ((1, pos), (-1, not pos))] for w, pos in ((p, True), (1 - p, False))]
        odds = np.log(share / (1 - share)) + ((vote == 1) * np.log(says[0][0] / says[1][0]) + (vote == -1) * np.log(says[0][1] / says[1][1])).sum(axis=1)
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return dict(zip(patterns, p.tolist(), strict=True))


@dataclass
class SpanClassifier:
    """A logistic model of votes, by kind."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def features(vote: Sequence[int]) -> np.ndarray:
        v = np.array(vote)
        return np.concatenate([[1.0], v == 1, v == -1])

    def score(self, kind: str, vote: Sequence[int]) -> float:
        return float(1 / (1 + np.exp(-(self.features(vote) @ self.weights[kind])))) if kind in self.weights else 0.0


def fit(counts: dict[tuple[str, tuple[int, ...]], int], penalty: float = 1.0) -> SpanClassifier:
    """The classifier, from the number of candidates of each kind and vote pattern."""
    weights = {}
    for kind in KINDS:
        patterns = {v: n for (k, v), n in counts.items() if k == kind}
        soft = estimate(patterns)
        if not soft:
            continue
        x = np.array([SpanClassifier.features(v) for v in patterns])
        n, y = np.array(list(patterns.values()), float), np.array([soft[v] for v in patterns])
        w = np.zeros(x.shape[1])
        for _ in range(50):  # Newton steps
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (n * (y - p)) - penalty * w)
            w = w + step
            if np.abs(step).max() < 1e-8:
                break
        weights[kind] = w
    return SpanClassifier(weights)


FOUND = "array<struct<kind:string,start:int,end:int,strict:boolean,votes:string>>"


def find_spans(docs: DataFrame, keep: Sequence[str] = ("doc_id",), sure: float = SURE, column: str = "text") -> DataFrame:
    """The kept columns with `found`: kind, start, end (behind the last code point), strict, votes and score of each span, in order.

    Null and empty texts have none; texts are taken whole, and every row gives one row, repeated ones too. The models are fitted to the
    candidates of these documents.
    """

    def make() -> Callable:
        return lambda texts: [[[dict(zip(("kind", "start", "end", "strict", "votes"), s, strict=True)) for s in candidates(t)] if t else [] for t in texts]]

    keep = [c for c in keep if c != "found"]
    rows = written(map_texts(docs, keep, f"found {FOUND}", make, column), "spans")
    # at most 3 to the number of labelers rows a kind
    counted = rows.select(F.explode("found").alias("s")).groupBy("s.kind", "s.votes").count().collect()
    model = fit({(r[0], tuple(map(int, r[1].split(",")))): r[2] for r in counted})
    scores = [(F.lit(f"{r[0]} {r[1]}"), F.lit(model.score(r[0], tuple(map(int, r[1].split(",")))))) for r in counted]
    table = F.create_map(*[x for pair in scores for x in pair]) if scores else F.expr("map('', 0D)")
    scored = F.transform("found", lambda s: s.withField("score", F.element_at(table, F.concat_ws(" ", s["kind"], s["votes"]))))
    return rows.withColumn("found", F.filter(scored, lambda s: s["strict"] | (s["score"] >= sure)))


def redact(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """The documents with every span replaced by its kind in brackets, and n_chars, where it is a column, set to the new length.

    Overlapping spans of several kinds become one, named by the first.
    """
    columns = docs.columns
    plain = docs.toDF(*(f"c_{c}" for c in columns))  # no name clashes with a new one

    def masked(text: str | None, found: list[dict]) -> str | None:
        if not found:
            return text
        out, at = [], 0
        for s in found:
            if s["start"] >= at:
                out += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
            at = max(at, s["end"])
        return "".join([*out, text[at:]])

    def make() -> Callable:
        return lambda texts, found: [[masked(t, f) for t, f in zip(texts, found, strict=True)]]

    spans = find_spans(plain, plain.columns, sure, "c_text")
    new = map_texts(spans, [f"c_{c}" for c in columns], "new_text string", make, "c_text", ("found",))
    new = new.withColumn("c_text", F.col("new_text"))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        new = new.withColumn("c_n_chars", F.when(F.col("new_text").isNull(), F.col("c_n_chars")).otherwise(F.length("new_text")).cast(kind))
    return new.select(*(F.col(f"c_{c}").alias(c) for c in columns))
