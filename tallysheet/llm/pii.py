"""Personal data: pattern matches, and further spans by a semi-Markov conditional random field.

The base spans are pattern matches for each kind. A semi-Markov CRF then reads the runs of tokens
that could hold such data (tokens with a digit, an at sign or a written one), scores whole candidate segments
by features of the segment (its length, digits, separators, shape and the word in front) and chooses
boundaries and kinds jointly by dynamic programming over segments of bounded length. It is trained on
a bounded sample of documents, with the base spans as labels. From these it would learn the patterns only,
so it also sees them written in ways that the patterns miss: separators in brackets, numbers without their
plus sign, other separators. Segments that overlap no base span are added; base spans stay.

Cases: null text is empty. Whole texts and segments of any length are read, in time linear in the text. Repeated
rows give repeated results; ids are not looked at. Base spans may overlap each other; added ones overlap
none, and of equally good segmentations the one with the later, shorter and first-listed kind is taken. An
empty table gives an empty result, by a model without weights, which adds nothing. Columns that have the
name of a column added here are replaced.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.llm.tables import without

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, end, kind

# The base patterns. A quantifier that never gives back what it took (++) changes no
# match here and keeps long runs of digits linear, as does not starting inside such a run.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at sign; so every character is looked at once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind. A match that fails its check is dropped."""
    spans = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        parts = m[0].split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
            spans.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NO_DIGITS.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NO_DIGITS.sub("", m[0])) <= 15:
                spans.append((m.start(), m.end(), 3))
    return sorted(spans, key=lambda s: (s[0], s[2]))


@dataclass(frozen=True)
class Training:
    """Bounds of the training sample and of the model."""

    docs: int = 20_000
    runs: int = 4_000
    # Longer runs are not in the sample.
    run_tokens: int = 40
    run_chars: int = 1_600
    # How often a run with base spans is seen with spans that the patterns miss.
    variants: int = 3
    epochs: int = 4
    rate: float = 0.3
    decay: float = 1e-4
    # Most tokens of a segment, and the score margin over "no data" from which one is added.
    segment_tokens: int = 6
    margin: float = 2.0


DEFAULT = Training()
_MARKED = re.compile(r"(?:[0-9@]|[(\[{](?i:at)[)\]}])\S*")
_EDGE = "\"'“”‘’,;:!?<>[]{}|*#&$%="
_AT = re.compile(r"@|[(\[{](?i:at)[)\]}]")
_RUNS = re.compile(r"[0-9]+|[^\W\d_]+")


@dataclass(frozen=True)
class Run:
    """Neighbouring tokens with a digit or an at sign: their bounds in the text, without punctuation
    around them, and the word in front, on the same line."""

    tokens: list[tuple[int, int]]
    before: str


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in _EDGE:
        a += 1
    while b > a and (text[b - 1] in _EDGE or text[b - 1] == "."):
        b -= 1
    return a, b


def candidate_runs(text: str) -> Iterator[Run]:
    """Runs in order. Tokens are separated by white space; one space joins tokens to a run."""
    tokens: list[tuple[int, int]] = []
    before, done = "", 0
    for m in _MARKED.finditer(text):
        a = m.start()
        while a > done and not text[a - 1].isspace():
            a -= 1
        if tokens and not (a == done + 1 and text[done] == " "):
            yield Run(tokens, before)
            tokens = []
        if not tokens:
            before = text[done:a].rpartition("\n")[2].rstrip().rpartition(" ")[2].lower()
        done = m.end()
        tokens.append(_trimmed(text, a, done))
    if tokens:
        yield Run(tokens, before)


def segment_features(segment: str, before: str, tokens: int) -> list[str] | None:
    """Features of a whole candidate segment; None if it can hold no personal data at all."""
    digits = _NO_DIGITS.sub("", segment)
    at = _AT.search(segment)
    if not at and len(digits) < 7 and segment.count(".") < 3:
        return None
    shape = _RUNS.sub(lambda m: f"N{len(m[0])}" if m[0].isdigit() else "a", segment)
    coarse = _RUNS.sub(lambda m: "N" if m[0].isdigit() else "a", segment)
    marks = "".join(sorted({c for c in segment if not c.isalnum()}))
    octets = re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", segment) is not None
    return [
        "bias",
        f"shape={shape}",
        f"coarse={coarse}",
        f"digits={min(len(digits), 20)}",
        f"marks={marks}",
        f"first={segment[:1] if not segment[:1].isalnum() else 'x'}",
        f"tokens={tokens}",
        f"before={before}",
        f"luhn={14 <= len(digits) <= 19 and luhn(digits)}",
        f"octets={octets and all(int(p) <= 255 for p in segment.split('.'))}",
        f"address={at is not None and '.' in segment[at.end() :]}",
    ]


def _segments(text: str, run: Run, longest: int) -> Iterator[tuple[int, int, list[str]]]:
    """(first token, token after the last, features) of the candidate segments of a run."""
    for j in range(1, len(run.tokens) + 1):
        for i in range(max(0, j - longest), j):
            segment = text[run.tokens[i][0] : run.tokens[j - 1][1]]
            features = segment_features(segment, run.before if i == 0 else "", j - i)
            if features:
                yield i, j, features


def decode(text: str, run: Run, weights: Sequence[dict[str, float]], training: Training = DEFAULT) -> list[Span]:
    """The best segmentation of a run; a token outside any segment scores 0."""
    n = len(run.tokens)
    ending: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]
    for i, j, features in _segments(text, run, training.segment_tokens):
        for kind, w in enumerate(weights):
            score = sum([w.get(f, 0.0) for f in features])
            if score >= training.margin:
                ending[j].append((i, kind, score))
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for i, kind, score in ending[j]:
            if best[i] + score > best[j]:
                best[j], back[j] = best[i] + score, (i, kind)
    spans, j = [], n
    while j:
        if back[j] is None:
            j -= 1
        else:
            i, kind = back[j]
            spans.append((run.tokens[i][0], run.tokens[j - 1][1], kind))
            j = i
    return spans[::-1]


def _gold(run: Run, spans: list[Span]) -> list[tuple[int, int, int]] | None:
    """Base spans as segments of the run; None if one is not made of whole tokens."""
    a, b = run.tokens[0][0], run.tokens[-1][1]
    first = {t[0]: i for i, t in enumerate(run.tokens)}
    last = {t[1]: i + 1 for i, t in enumerate(run.tokens)}
    out, done = [], -1
    for s, e, kind in spans:
        if e <= a or s >= b or s < done:
            continue
        if s not in first or e not in last:
            return None
        out.append((first[s], last[e], kind))
        done = e
    return out


def train(examples: Sequence[tuple[str, list[Span]]], training: Training = DEFAULT) -> list[dict[str, float]]:
    """Weights for each kind, from (text of a run, its base spans): stochastic gradient on the log
    likelihood of the labelled segmentation, expectations by forward and backward sums."""
    weights: list[dict[str, float]] = [{} for _ in KINDS]
    prepared = []
    for text, spans in examples:
        for run in candidate_runs(text):
            gold = _gold(run, spans)
            segments = list(_segments(text, run, training.segment_tokens)) if gold is not None else []
            if segments:
                prepared.append((len(run.tokens), segments, set(gold)))
    for epoch in range(training.epochs):
        rate = training.rate / (1 + epoch)
        for n, segments, gold in prepared:
            scored = [
                (i, j, kind, features, sum([w.get(f, 0.0) for f in features]))
                for i, j, features in segments
                for kind, w in enumerate(weights)
            ]
            ahead = np.full(n + 1, -np.inf)
            behind = np.full(n + 1, -np.inf)
            ahead[0] = behind[n] = 0.0
            by_end: list[list] = [[] for _ in range(n + 1)]
            by_start: list[list] = [[] for _ in range(n + 1)]
            for x in scored:
                by_end[x[1]].append(x)
                by_start[x[0]].append(x)
            for j in range(1, n + 1):
                ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[x[0]] + x[4] for x in by_end[j])])
            for i in range(n - 1, -1, -1):
                behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[x[1]] + x[4] for x in by_start[i])])
            for i, j, kind, features, score in scored:
                expected = np.exp(min(0.0, ahead[i] + score + behind[j] - ahead[n]))
                step = rate * (((i, j, kind) in gold) - expected)
                if abs(step) > 1e-4:
                    w = weights[kind]
                    for f in features:
                        w[f] = w.get(f, 0.0) * (1 - training.decay) + step
    return weights


def variants(kind: int, value: str) -> list[str]:
    """Ways to write a base span that the patterns miss."""
    digits = _NO_DIGITS.sub("", value)
    fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
    local, _, domain = value.rpartition("@")
    found = (
        [f"{local}{at}{domain}" for at in ("[@]", "(@)", "(at)", "[at]")] + [value.replace(".", dot) for dot in ("[.]", "(.)")],
        [value.replace(".", dot) for dot in ("[.]", "(.)", ". ")],
        [mark.join(fours) for mark in (".", "_", "/")],
        ["00" + value[1:], value[1:], re.sub(r"[ -]+", "/", value), re.sub(r"[ -]+", "/", value[1:])],
    )[kind]
    return [v for v in dict.fromkeys(found) if v != value and not base_spans(v)]


def rewritten(text: str, spans: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]] | None:
    """``text`` with about two of three spans in a form that the patterns miss, and where the spans are
    then; None if spans overlap or none has such a form."""
    out, moved, done, changed = "", [], 0, False
    for a, b, kind in spans:
        if a < done:
            return None
        out += text[done:a]
        value, forms = text[a:b], variants(kind, text[a:b])
        if forms and rng.random() < 2 / 3:
            value, changed = forms[rng.integers(len(forms))], True
        moved.append((len(out), len(out) + len(value), kind))
        out, done = out + value, b
    return (out + text[done:], moved) if changed else None


def examples_of(runs: Sequence[str], training: Training = DEFAULT) -> list[tuple[str, list[Span]]]:
    """Labelled runs: each with its base spans, and again with spans rewritten."""
    out = []
    for run in runs:
        spans = base_spans(run)
        out.append((run, spans))
        rng = np.random.default_rng(zlib.crc32(run.encode()))
        for _ in range(training.variants if spans else 0):
            if found := rewritten(run, spans, rng):
                out.append(found)
    return out


def learn(docs: DataFrame, text: str = "text", training: Training = DEFAULT) -> list[dict[str, float]]:
    """Train on the runs of a bounded sample: documents by hash of their text, about ``training.docs``
    of them, and of their runs the ``training.runs`` with the least hash."""
    n = docs.count()
    share = min(1.0, training.docs / n) if n else 1.0
    sample = docs.select(F.col(text).alias("text")).where(
        F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1_000_003)) < F.lit(int(share * 1_000_003))
    )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(0).to_pylist():
                for run in candidate_runs(t or ""):
                    a, b = run.tokens[0][0], run.tokens[-1][1]
                    if len(run.tokens) <= training.run_tokens and len(run.before) + b - a <= training.run_chars:
                        out.append(f"{run.before} {t[a:b]}")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["run"])

    found = sample.mapInArrow(runs, "run string").distinct().orderBy(F.xxhash64("run"), "run").limit(training.runs)
    return train(examples_of([r["run"] for r in found.collect()], training), training)


def find_spans(text: str, weights: Sequence[dict[str, float]], training: Training = DEFAULT) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a whole text."""
    base = base_spans(text)
    spans = list(base)
    if any(weights):
        # Base spans joined where they overlap, so that one look finds the only one that a span could meet.
        starts: list[int] = []
        ends: list[int] = []
        for a, b, _ in base:
            if ends and a < ends[-1]:
                ends[-1] = max(ends[-1], b)
            else:
                starts.append(a)
                ends.append(b)
        for run in candidate_runs(text):
            for a, b, kind in decode(text, run, weights, training):
                at = bisect_left(starts, b) - 1
                if at < 0 or ends[at] <= a:
                    spans.append((a, b, kind))
    return base, sorted(spans, key=lambda s: (s[0], s[2], s[1]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in angle brackets; of overlapping spans, the first."""
    out, done = [], 0
    for a, b, kind in spans:
        if a >= done:
            out += [text[done:a], f"<{KINDS[kind]}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


FOUND = (*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "masked_text")


def find_personal_data(
    docs: DataFrame, text: str = "text", training: Training = DEFAULT, with_masked: bool = False
) -> DataFrame:
    """``docs`` with a count for each kind (base spans), a digest of the base spans, all spans, and the
    masked text if wanted. The model (some hundred kB) is broadcast."""
    docs = without(docs, FOUND)
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, text, training))
    names = FOUND if with_masked else FOUND[:-1]
    kinds = [T.LongType()] * len(KINDS) + [T.StringType()] * (len(names) - len(KINDS))
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, names, kinds)])
    at = docs.columns.index(text)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans, texts = [], [], []
            for t in batch.column(at).to_pylist():
                base, every = find_spans(t or "", weights, training)
                for k, column in enumerate(counts):
                    column.append(sum(s[2] == k for s in base))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(every))
                if with_masked:
                    texts.append(None if t is None else masked(t, every))
            added = [pa.array(c, pa.int64()) for c in counts] + [pa.array(x, pa.string()) for x in (digests, spans)]
            if with_masked:
                added.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema.fieldNames())

    return docs.mapInArrow(found, schema)
