"""Personal data and terms that give it away (operator 5).

Base spans are e-mail addresses, IP numbers, payment cards and phone numbers.
On top, information-theoretic sanitisation: for a protected entity e (one such
value) and a term t, the corpus tells how much t reveals of e.  With N
documents, n_e that hold e, n_t that hold t, and n_te that hold t within
``REACH`` words of e on a line,

    disclosure(t, e) = log2(n_te N / (n_t n_e)) / log2(N / n_e),

the share of e's information that seeing t gives (1: t occurs with e only).
Pairs met in at least ``SUPPORT`` documents whose disclosure reaches
``THRESHOLD`` are disclosing.  The window serves to find pairs only: every
occurrence of a disclosing term outside base spans, in whichever document and
with or without the entity, becomes a span of kind ``term``.  Sanitising
replaces base spans by their kind, generalises terms that are numbers to ``#``
signs and removes other terms.

One pass over the texts writes base spans, context terms and term counts
together; aggregations and equi-joins of 64-bit hashes give the disclosing
terms.  A second pass finds their occurrences: a bit table of fixed size
(``BITS`` places by term hash) lets every disclosing term pass and holds most
others back, and an equi-join with the terms leaves the true ones, so the
table's size bears on time only.

Defined cases: a null text is an empty one; rows are searched one by one, so
repeated rows and ids give a row each and each counts as a document; an empty
table gives an empty result; columns beyond ``doc_id`` and ``text`` are not
read (``personal_data``) or are passed through (``sanitise``).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import ROW, need, row_key, sealed, unsealed
from dosecast.session import materialize

KINDS = ("email", "ip", "card", "phone")
REACH = 8
SUPPORT = 2
THRESHOLD = 0.9
BITS = 1 << 26
_FLUSH = 300_000

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does: what fails there fails inside the run too.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_TERM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_OUTSIDE = {*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)}
_TO_SPACE = bytes(0x20 if b in _OUTSIDE else b for b in range(256))
_UPPER = {c: c + 32 for c in range(0x41, 0x5B)}

FOUND = pa.schema([
    *[(k, pa.int64()) for k in ROW], ("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base", pa.string()),
    ("entities", pa.list_(pa.int64())),
    ("near", pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64())]))),
    ("term", pa.int64()), ("n_docs", pa.int64())])
FOUND_SQL = ("row1 long, row2 long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, entities array<long>, "
             "near array<struct<entity:long,term:long>>, term long, n_docs long")
PLACES = pa.schema([*[(k, pa.int64()) for k in ROW], ("term", pa.int64()), ("first", pa.list_(pa.int32())), ("last", pa.list_(pa.int32()))])
PLACES_SQL = "row1 long, row2 long, term long, first array<int>, last array<int>"


def emails(text: str) -> list[tuple[int, int]]:
    """Each address is met at its ``@``: the local part is all that can stand before it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def at_most_255(digits: str) -> bool:
    digits = digits.lstrip("0")         # of any length
    return len(digits) < 4 and int(digits or "0") <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        if "." in text:
            out += [("ip", *m.span()) for m in _IP.finditer(text) if all(at_most_255(p) for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(d) <= 19 and luhn(d):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def _hash(kind: str, value: bytes) -> int:
    x = xxhash.xxh64_intdigest(kind.encode() + b":" + value)
    return x - (1 << 64) if x >> 63 else x


def _inside(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts of the spans, ascending, and the furthest end up to each: spans of two kinds can overlap."""
    inside = sorted((a, b) for _, a, b in spans)
    return [a for a, _ in inside], list(accumulate((b for _, b in inside), max))


def near_terms(text: str, spans: list[tuple[str, int, int]], reach: int = REACH) -> list[dict]:
    """Terms within ``reach`` words of an entity on its line, outside all base spans; once for each entity value."""
    out, (starts, ends) = set(), _inside(spans)
    low = text.translate(_UPPER)
    back = low[::-1]
    begin, end = 0, -1                      # the line of the last span: most lines are asked for many times
    for kind, a, b in spans:
        entity = _hash(kind, text[a:b].lower().encode())
        if not begin <= a <= b <= end:
            begin, end = text.rfind("\n", 0, a) + 1, text.find("\n", b)
            end = len(text) if end < 0 else end
        # Outward from the entity, word by word; a word that runs into it is part of no context.
        n, joins = len(low), [k for k in (a, b) if 0 < k < len(low) and _TERM.match(low[k - 1]) and _TERM.match(low[k])]
        before = [(n - m.end(), n - m.start()) for m in islice(_TERM.finditer(back, n - a, n - begin), reach + (a in joins))]
        after = [m.span() for m in islice(_TERM.finditer(low, b, end), reach + (b in joins))]
        for x, y in before[a in joins:] + after[b in joins:]:
            k = bisect_left(starts, y)
            if not k or ends[k - 1] <= x:
                out.add((entity, _hash("term", low[x:y].encode())))
    return [{"entity": e, "term": t} for e, t in sorted(out)]


def scan(batches):
    """Rows of both kinds: one for each document, and counts of documents by term."""
    counts: dict[bytes, int] = {}

    def term_rows():
        for k in range(0, len(counts), 50_000):
            some = list(counts.items())[k:k + 50_000]
            yield pa.RecordBatch.from_pylist([{"term": _hash("term", w), "n_docs": n} for w, n in some], schema=FOUND)
        counts.clear()

    for b in batches:
        for k in range(0, b.num_rows, 512):
            part, rows = b.slice(k, 512), []
            for doc, text, row1, row2 in zip(*(c.to_pylist() for c in part.columns)):
                text = text or ""
                spans = base_spans(text)
                rows.append({"row1": row1, "row2": row2, "doc_id": doc, **{f"n_{x}": sum(s[0] == x for s in spans) for x in KINDS},
                             "base": ",".join(f"{x}:{a}:{z}" for x, a, z in spans),
                             "entities": sorted({_hash(x, text[a:z].lower().encode()) for x, a, z in spans}),
                             "near": near_terms(text, spans) if spans else []})
                for w in set(text.encode().lower().translate(_TO_SPACE).split()):
                    counts[w] = counts.get(w, 0) + 1
            yield pa.RecordBatch.from_pylist(rows, schema=FOUND)
            if len(counts) > _FLUSH:
                yield from term_rows()
    yield from term_rows()


def occurrences(bits):
    """Places, by row and term, of the terms that the bit table (a broadcast of bytes) lets pass."""
    def run(batches):
        table, known = bits.value, {}

        def passes(w: bytes) -> int | None:
            t = _hash("term", w)
            return t if table[(t & (BITS - 1)) >> 3] >> (t & 7) & 1 else None

        for b in batches:
            for k in range(0, b.num_rows, 512):
                rows = []
                for text, row1, row2 in zip(*(c.to_pylist() for c in b.slice(k, 512).columns)):
                    if not text:
                        continue
                    words = set(text.encode().lower().translate(_TO_SPACE).split())
                    if len(known) > _FLUSH:
                        known.clear()
                    for w in words:
                        if w not in known:
                            known[w] = passes(w)
                    want = {w.decode(): known[w] for w in words if known[w] is not None}
                    if want:
                        rows += [{"row1": row1, "row2": row2, "term": t, "first": [x for x, _ in at], "last": [y for _, y in at]}
                                 for t, at in _places(text, want).items()]
                yield pa.RecordBatch.from_pylist(rows, schema=PLACES)
    return run


def _places(text: str, want: dict[str, int]) -> dict[int, list[tuple[int, int]]]:
    """Where the wanted terms stand outside base spans."""
    out: dict[int, list[tuple[int, int]]] = {}
    starts, ends = _inside(base_spans(text))
    for m in _TERM.finditer(text.translate(_UPPER)):
        t = want.get(m.group())
        if t is not None:
            k = bisect_left(starts, m.end())
            if not k or ends[k - 1] <= m.start():
                out.setdefault(t, []).append(m.span())
    return out


def bit_table(terms: DataFrame) -> bytes:
    """The places ``term & (BITS - 1)`` of all terms as bits; at most BITS / 64 words reach the driver."""
    at = F.col("term").bitwiseAND(BITS - 1)
    words = terms.groupBy(F.shiftright(at, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))).alias("bits")).toArrow()
    table = np.zeros(BITS // 64, "<i8")
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table.tobytes()


def disclosing(found: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """(entity, term, disclosure) of the pairs that reach the threshold."""
    docs = found.where(F.col("row1").isNotNull())
    n = docs.count()
    n_e = docs.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    # A pair counts once a document.
    pairs = docs.select(F.explode("near").alias("p")).select("p.*")
    n_te = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te")).where(F.col("n_te") >= support)
    n_t = (found.where(F.col("row1").isNull()).groupBy("term").agg(F.sum("n_docs").alias("n_t")))
    x = n_te.join(n_e, "entity").join(n_t, "term")
    share = F.log2(F.col("n_te") * float(n) / (F.col("n_t") * F.col("n_e"))) / F.log2(float(n) / F.col("n_e"))
    return x.where(F.col("n_e") < n).withColumn("disclosure", share).where(F.col("disclosure") >= threshold).select("entity", "term", "disclosure")


def by_row(docs: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """``personal_data`` with row1, row2."""
    rows = need(docs, "doc_id", "text").select("doc_id", "text", *row_key())
    found = materialize(rows.mapInArrow(scan, FOUND_SQL), "pii")
    terms = materialize(disclosing(found, support, threshold).select("term").distinct(), "pii_terms")
    bits = docs.sparkSession.sparkContext.broadcast(bit_table(terms))
    places = rows.select("text", *ROW).mapInArrow(occurrences(bits), PLACES_SQL)
    hit = places.join(terms.hint("merge"), "term", "left_semi").select(*ROW, F.explode(F.arrays_zip("first", "last")).alias("x"))
    spans = hit.groupBy(*ROW).agg(F.array_sort(F.collect_set("x")).alias("t")).select(
        *ROW, F.concat_ws(",", F.transform("t", lambda x: F.concat(F.lit("term:"), x["first"].cast("string"), F.lit(":"), x["last"].cast("string")))).alias("terms"))
    own = found.where(F.col("row1").isNotNull()).select(*ROW, "doc_id", *[f"n_{k}" for k in KINDS], "base")
    return own.join(spans, list(ROW), "left").withColumn("terms", F.coalesce("terms", F.lit("")))


def personal_data(docs: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, counts by kind, base (spans, comma-joined), terms (spans of disclosing terms, comma-joined)."""
    return by_row(docs, support, threshold).drop(*ROW)


def digest(data: DataFrame, *more: str) -> DataFrame:
    both = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.col("terms") != "", F.col("terms")))
    return data.select(*more, "doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), both.alias("spans"))


def replaced(text: str, spans: str) -> str:
    """``text`` with the spans (``kind:start:end``, comma-joined) replaced, earlier and longer ones first."""
    cut = sorted(((int(a), -int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s)))
    out, at = [], 0
    for a, neg, kind in cut:
        b = -neg
        if a < at:
            continue
        word = text[a:b]
        out += [text[at:a], f"<{kind.upper()}>" if kind != "term" else "#" * len(word) if word.isdigit() else ""]
        at = b
    return "".join([*out, text[at:]])


def _replaced_all(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([replaced(t, s) if t and s else t for t, s in zip(texts, spans)], dtype=object)


def sanitise(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in ``text``, each row by the spans of its own
    id and text."""
    own = ("doc_id", "text")
    # Rows that agree in both have the same spans.
    found = by_row(docs, **how).dropDuplicates(list(ROW))
    spans = digest(found, *ROW).select(*ROW, F.col("spans").alias("spans_"))
    put = F.pandas_udf(_replaced_all, "string")
    d = sealed(docs, *own).select("*", *row_key()).join(spans, list(ROW), "left")
    return unsealed(d.withColumn("text", put(F.col("text"), F.col("spans_"))), docs, *own)
