"""Host-level quality rules (operator 3).

Every document is measured by document rules.  Failures are then counted by
host (the document's domain; here ``source``), each host's failure rate is
shrunk towards the rate of all hosts by a beta prior fitted to the hosts'
rates by moments, and the verdict on the host goes back to its documents: a
document is kept unless it fails a base rule, or its host is rejected (the
shrunk rate is above ``max_rate``) and the document breaks one of the stricter
rules that hold for rejected hosts: symbols over 10 % of its word characters,
words in repeated windows over 30 % of its words, repeated lines over 30 % of its
lines.  So a good document of a bad host stays.

Defined cases: a null text has no words and fails; a null host is a host of
its own; rows are judged one by one, so repeated rows and ids give a row each;
an empty table gives an empty result; columns beyond the named ones are not
read (``measure``) or are passed through (``filter_documents``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import need
from dosecast.session import materialize

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SYMBOLS = "#*$%&|<>"
MAX_HOST_RATE = 0.5
# Stricter rules for documents of a rejected host, in percent.
STRICT_SYMBOLS, STRICT_REPEATS, STRICT_LINES = 10, 30, 30


def repeat_words(words: list[bytes], size: int = 3) -> int:
    """Words that lie in a ``size``-word window found at least twice, the first occurrence included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    key = ids[:n]
    for k in range(1, size):         # windows numbered anew at each step, so the numbers stay small
        key = key * len(number) + ids[k:k + n]
        if k < size - 1:
            key = np.unique(key, return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    hit = np.zeros(len(words), bool)
    for k in range(size):
        hit[k:k + n] |= again
    return int(hit.sum())


def measures(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = text.encode()
    words = raw.split()              # bytes split at U+0020 and U+0009 to U+000D only
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    return (len(words), len(text) - sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")),
            sum(map(text.count, SYMBOLS)), dup, repeat_words(words), dup + len(seen))


def measured(batches):
    """Arrow batches with a ``text`` column: the measures are appended."""
    for b in batches:
        at = b.schema.get_field_index("text")
        for k in range(0, b.num_rows, 1024):
            part = b.slice(k, 1024)
            rows = [measures(t) for t in part.column(at).to_pylist()]
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*part.schema.names, *MEASURES])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def strict_failed() -> Column:
    return (base_failed() | (100 * F.col("n_symbols") > STRICT_SYMBOLS * F.col("word_chars"))
            | (100 * F.col("n_repeat_words") > STRICT_REPEATS * F.col("n_words"))
            | (100 * F.col("n_dup_lines") > STRICT_LINES * F.col("n_lines")))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures, base_failed and strict_failed appended; column names as c0, c1, ..., in
    the order of ``docs.columns``, but for ``text``."""
    names = [c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]
    first = docs.toDF(*names)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in first.schema.fields] + [f"{m} long" for m in MEASURES])
    return first.mapInArrow(measured, schema).withColumn("base_failed", base_failed()).withColumn("strict_failed", strict_failed())


def host_verdicts(measured_docs: DataFrame, host: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, n_failed, shrunk rate, rejected.  The prior's mean m is the rate of all documents; its
    strength comes from the moments of the hosts' rates: with m(1-m) = v, spread s and the mean of 1/n as r,
    strength = (v - s) / (s - v r), infinite (every host gets the common rate) when hosts differ by less
    than chance."""
    hosts = measured_docs.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    # One row of sums reaches the driver.
    m = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"), F.sum(rate * rate * F.col("n_docs")).alias("q"),
                  F.count(F.lit(1)).alias("h")).first()
    mean, strength = prior(m["n"] or 0, m["f"] or 0, m["q"] or 0.0, m["h"])
    shrunk = (F.lit(mean) if strength is None
              else (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength))
    return (hosts.withColumn("shrunk_rate", shrunk.cast("double"))
                 .withColumn("rejected", F.col("shrunk_rate") > max_rate))


def prior(n: int, failed: int, squares: float, hosts: int) -> tuple[float, float | None]:
    """Mean and strength (alpha + beta) of the beta prior; None: no more spread than chance."""
    if not n or hosts < 2:
        return (failed / n if n else 0.0), None
    mean = failed / n
    v, spread, r = mean * (1 - mean), squares / n - mean * mean, hosts / n
    if v <= 0 or spread <= v * r:
        return mean, None
    return mean, max(1e-6, (v - spread) / (spread - v * r))


def judge(measured_docs: DataFrame, host: str, verdicts: DataFrame) -> DataFrame:
    """``measured_docs`` with ``host_rate``, ``host_rejected`` and ``kept``."""
    v = verdicts.select(F.col("host").alias("_host"), F.col("shrunk_rate").alias("host_rate"), F.col("rejected").alias("host_rejected"))
    return (measured_docs.join(v, F.col(host).eqNullSafe(F.col("_host")), "left").drop("_host")
            .withColumn("kept", ~F.col("base_failed") & ~(F.col("host_rejected") & F.col("strict_failed"))))


def _measured_table(docs: DataFrame) -> DataFrame:
    """Id, host and measures of every document as a written table (without texts): two passes read it."""
    return materialize(measure(docs).drop("text"), "quality")


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, base_failed, kept, host_rate, host_rejected."""
    m = _measured_table(need(docs, "doc_id", "source", "text")).withColumnsRenamed({"c0": "doc_id", "c1": "source"})
    # A written table: Spark knows its size when it chooses the join.
    v = materialize(host_verdicts(m, "source"), "hosts")
    return judge(m, "source", v).select("doc_id", *MEASURES, "base_failed", "kept", "host_rate", "host_rejected")


def filter_documents(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that are kept, with all their columns.  Texts are measured a second time for the
    filter, which costs less than a written copy or a shuffle of them."""
    v = materialize(host_verdicts(_measured_table(need(docs, host, "text")), "c0"), "hosts")
    own = [c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]
    kept = judge(measure(docs), own[docs.columns.index(host)], v).where("kept")
    return kept.select(*[F.col(n).alias(c) for n, c in zip(own, docs.columns)])
