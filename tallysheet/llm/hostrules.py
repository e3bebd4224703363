"""Quality rules with host verdicts.

Every document is measured once (word counts, repeated windows, repeated lines, symbols). Rule
failures are counted per host (any column, e.g. the domain or the source), and each host's failure
rate is shrunk towards the corpus rate with a beta prior fitted to all hosts by moments. A host is
``trusted``, ``suspect`` or ``rejected`` by its shrunk rate, and that verdict comes back to its
documents: suspect hosts are held to stricter limits, documents of rejected hosts go.

Cases: null text has no words and fails the base rule. Texts of any length are measured whole. A null host is a
host of its own. Repeated rows count each time, ids are not looked at. Empty tables give empty results. Columns of the input that have the name of a
column added here are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallysheet.llm.tables import WORD_SEPARATORS, free_name, stored, without, words

# Fixed values of the base rule.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class HostRules:
    """Limits of the document rules and of the host verdicts."""

    min_words: int = 20
    max_repeat_percent: int = 30
    # Symbols and repeated lines for each 100 words; characters for each word.
    max_symbol_percent: int = 30
    max_dup_line_percent: int = 10
    min_word_chars: float = 2.0
    max_word_chars: float = 20.0
    # The same for documents of suspect hosts.
    strict_symbol_percent: int = 10
    strict_dup_line_percent: int = 5
    # Shrunk failure rates from which a host is suspect or rejected.
    suspect_rate: float = 0.5
    rejected_rate: float = 0.9
    # Hosts up to this many are broadcast; more take a shuffle join.
    broadcast_hosts: int = 50_000


DEFAULT = HostRules()


def repeated_words(tokens: list[bytes], window: int = WINDOW) -> int:
    """Words lying in a window of ``window`` words that is found twice or more in the text.

    Exact: windows get equal numbers only if they are equal, by numbering pairs of equal halves
    (the window must be a power of two).
    """
    n = len(tokens)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in tokens), np.int64, n)
    if len(seen) == n:
        return 0
    width = 1
    while width < window:
        pairs = ids[:-width] * (ids.max() + 1) + ids[width:]
        values, ids = np.unique(pairs, return_inverse=True)
        if len(values) == len(ids):
            return 0
        width *= 2
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def measure_text(text: str | None) -> tuple[int, int, int, int, int]:
    """The values of ``MEASURES`` for one text."""
    text = text or ""
    tokens = words(text)
    chars = len(text) - sum(map(text.count, WORD_SEPARATORS))
    lines: set[str] = set()
    repeats = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in lines:
                repeats += 1
            elif line.strip(WORD_SEPARATORS):
                lines.add(line)
    return len(tokens), chars, sum(map(text.count, SYMBOLS)), repeats, repeated_words(tokens)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures of every whole text."""
    docs = without(docs, MEASURES)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(m, T.LongType()) for m in MEASURES)])
    at = docs.columns.index(text)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure_text(t) for t in batch.column(at).to_pylist()]
            values = np.array(found, np.int64).reshape(len(found), len(MEASURES))
            columns = [*batch.columns, *(pa.array(values[:, i]) for i in range(len(MEASURES)))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *MEASURES])

    return docs.mapInArrow(measured, schema)


def base_failed(rules: HostRules = DEFAULT) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )


def _soft_failed(rules: HostRules, symbols: int, dup_lines: int) -> Column:
    n = F.col("n_words")
    return (
        (100 * F.col("n_symbols") > symbols * n)
        | (100 * F.col("n_dup_lines") > dup_lines * n)
        | (F.col("word_chars") < rules.min_word_chars * n)
        | (F.col("word_chars") > rules.max_word_chars * n)
    )


def host_verdicts(measured: DataFrame, host: str = "source", rules: HostRules = DEFAULT) -> DataFrame:
    """One row for each host: documents, failures, shrunk rate and verdict.

    The prior Beta(a, b) has the mean of the corpus and the spread of the host rates: with m the
    overall rate and v the variance of host rates beyond binomial noise, a + b = m(1 - m) / v - 1.
    Without any such spread every host has the corpus rate. Sums are of integers, or of doubles that
    are rounded afterwards, so that reruns agree.
    """
    failed = base_failed(rules) | _soft_failed(rules, rules.max_symbol_percent, rules.max_dup_line_percent)
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(failed.cast("long")).alias("host_failures")
    )
    return verdicts(hosts, rules)


def verdicts(hosts: DataFrame, rules: HostRules = DEFAULT) -> DataFrame:
    """``hosts`` (with ``host_docs`` and ``host_failures``) with ``host_rate`` and ``host_verdict``. Squares are
    of doubles: a host may have any number of documents."""
    n, k = F.col("host_docs"), F.col("host_failures")
    corpus = hosts.agg(
        F.sum(n).alias("docs"),
        F.sum(k).alias("failures"),
        F.count(F.lit(1)).alias("hosts"),
        F.sum(k.cast("double") * k / n).alias("squares"),
        F.sum(n.cast("double") * n).alias("sizes"),
    ).first()
    prior, mean = _beta_prior(corpus)
    rate = (
        F.lit(mean) if prior is None else (k + F.lit(prior * mean)) / (n + F.lit(prior))
    )
    return hosts.withColumn("host_rate", F.round(rate, 9)).withColumn(
        "host_verdict",
        F.when(F.col("host_rate") >= rules.rejected_rate, "rejected")
        .when(F.col("host_rate") >= rules.suspect_rate, "suspect")
        .otherwise("trusted"),
    )


def _beta_prior(corpus) -> tuple[float | None, float]:
    """(a + b, mean); None for a + b where the host rates do not differ beyond chance."""
    if not corpus["docs"]:
        return None, 0.0
    docs, hosts = corpus["docs"], corpus["hosts"]
    mean = corpus["failures"] / docs
    noise = mean * (1 - mean)
    between = corpus["squares"] - docs * mean * mean - (hosts - 1) * noise
    room = docs - corpus["sizes"] / docs
    if noise <= 0 or room <= 0 or between <= 0:
        return None, mean
    return max(noise * room / between - 1, 1e-6), mean


ADDED = ("base_failed", "kept", "host_docs", "host_failures", "host_rate", "host_verdict")


def judge(docs: DataFrame, host: str = "source", text: str = "text", rules: HostRules = DEFAULT) -> DataFrame:
    """``docs`` with the measures, ``base_failed``, the host columns and ``kept``."""
    return judge_measured(measure(without(docs, ADDED), text), host, rules)


def judge_measured(measured: DataFrame, host: str = "source", rules: HostRules = DEFAULT) -> DataFrame:
    """``judge`` for measured documents, which need no text any more.

    They are stored once; hosts are aggregated from them (partial counts first, so that a hot host
    is a few rows) and joined back.
    """
    measured = stored(without(measured, ADDED), "measured")
    hosts = stored(host_verdicts(measured, host, rules), "hosts")
    if hosts.count() <= rules.broadcast_hosts:
        hosts = F.broadcast(hosts)
    key = free_name(measured.columns, "host")
    hosts = hosts.withColumnRenamed("host", key)
    joined = measured.join(hosts, measured[host].eqNullSafe(hosts[key]), "left")
    joined = joined.drop(hosts[key])
    trusted = ~_soft_failed(rules, rules.max_symbol_percent, rules.max_dup_line_percent)
    suspect = ~_soft_failed(rules, rules.strict_symbol_percent, rules.strict_dup_line_percent)
    return joined.withColumn("base_failed", base_failed(rules)).withColumn(
        "kept",
        ~F.col("base_failed")
        & F.when(F.col("host_verdict") == "trusted", trusted)
        .when(F.col("host_verdict") == "suspect", suspect)
        .otherwise(F.lit(False)),
    )
