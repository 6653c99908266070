"""Benchmark decontamination with an FM-index for each training shard (operator 10).

Each task cuts its documents into shards and indexes each shard's words: a
suffix array, the Burrows-Wheeler transform of the word sequence, a wavelet
matrix over it for rank queries, and suffix positions sampled along the text.
All benchmark windows are searched together: backward search narrows every
window's suffix range by one rank query a word, occurrences are located by
walking back to the next sampled position, and the spans found in a document
are merged.

A window can only occur inside a run of words that all occur in the
benchmark, so a shard's sequence holds those runs that are as long as the
shortest window; each run ends in a separator of its own.  The benchmark is the
stated query set: its windows go to every task in blocks of bounded size.  One
block is searched in the pass that returns the rows; several are searched one
after the other, each in a written job, and their spans are united by row.

Defined cases: a null text has no words; benchmark items without words have no
window; documents and items may repeat or have null ids (a null item id is
counted, and written as an empty string); an empty table of either kind gives
no hit; columns beyond the named ones are not read (``matches``) or are passed
through (``remove_spans``).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import ROW, need, row_key, sealed, unsealed
from dosecast.session import materialize

WINDOW = 10
SAMPLE = 32
BLOCK_CHARS = 16 << 20        # benchmark text in one block
SHARD_CHARS = 4 << 20         # document text in one shard
SCHEMA = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<first:int,last:int>>"

# Bytes outside words: 00-2F, 3A-60, 7B-7F (after lower-casing A-Z).
_OUTSIDE = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_TO_SPACE = bytes(0x20 if b in set(_OUTSIDE) else b for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_TO_SPACE).split()


class Phrases:
    """A block of the benchmark: its words numbered from 1, its distinct windows as rows of numbers, and
    the items of each window."""

    def __init__(self, items: list[tuple[str, str]], size: int = WINDOW):
        self.number: dict[bytes, int] = {}
        of: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            w = [self.number.setdefault(x, len(self.number) + 1) for x in split_words(text)]
            for i in range(max(1, len(w) - size + 1) if w else 0):
                of.setdefault(tuple(w[i:i + size]), set()).add(item)
        self.windows = list(of)
        self.items = [sorted(x) for x in of.values()]
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        self.shortest = int(self.lengths.min()) if self.windows else 0
        self.table = np.zeros((len(self.windows), size), np.int64)     # right-aligned: searched from the end
        for i, w in enumerate(self.windows):
            self.table[i, size - len(w):] = w


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix order of ``s`` by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    first = np.flatnonzero(np.r_[True, np.diff(rank[order]) != 0])
    rank[order] = np.repeat(first, np.diff(np.r_[first, n]))      # a rank is the place of its first suffix
    while True:
        sizes = np.diff(np.r_[first, n])
        open_at = np.flatnonzero(np.repeat(sizes > 1, sizes))     # places whose suffixes tie
        if not len(open_at):
            return order
        sub = order[open_at]
        after = sub + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        sub = sub[np.lexsort((second, rank[sub]))]
        order[open_at] = sub
        after = sub + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        new = np.r_[True, (np.diff(rank[sub]) != 0) | (np.diff(second) != 0)]
        begins = open_at[new]
        of = begins[np.cumsum(new) - 1]
        first = np.union1d(first, begins)
        rank[sub] = of
        step *= 2


class WaveletMatrix:
    """Rank queries on a sequence of numbers below 2^bits; every query takes arrays."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.levels = []
        for k in reversed(range(bits)):
            bit = (seq >> k & 1).astype(bool)
            ones = np.r_[0, np.cumsum(bit)].astype(np.int64)
            self.levels.append((k, ones, len(seq) - int(ones[-1])))
            seq = np.concatenate((seq[~bit], seq[bit]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        lo, hi = np.zeros_like(at), at
        for k, ones, zeros in self.levels:
            up = (symbol >> k & 1).astype(bool)
            lo = np.where(up, zeros + ones[lo], lo - ones[lo])
            hi = np.where(up, zeros + ones[hi], hi - ones[hi])
        return hi - lo


class FMIndex:
    """Over runs of word numbers (1 up to ``n_symbols``); separators have number 0 in the transform."""

    def __init__(self, runs: list[np.ndarray], n_symbols: int):
        length = np.array([len(r) + 1 for r in runs], np.int64)
        self.ends = np.cumsum(length)
        n = int(self.ends[-1])
        text = np.zeros(n, np.int64)
        starts = self.ends - length
        for r, at in zip(runs, starts):
            text[at:at + len(r)] = r
        self.starts = starts
        # Every separator differs from the others and sorts before the words.
        keyed = text + len(runs)
        keyed[self.ends - 1] = np.arange(len(runs))
        order = suffix_array(keyed)
        self.bwt = text[order - 1]                    # before the first position stands the last separator
        self.counts = np.r_[0, np.cumsum(np.bincount(text, minlength=n_symbols + 1))]
        self.ranks = WaveletMatrix(self.bwt, int(n_symbols).bit_length())
        # Sampled: every SAMPLE-th position and every run's first (whose predecessor is a separator).
        keep = (order % SAMPLE == 0) | (self.bwt == 0)
        self.sampled = np.where(keep, order, -1)

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of every occurrence."""
        n, size = phrases.table.shape
        lo, hi = np.zeros(n, np.int64), np.full(n, int(self.ends[-1]), np.int64)
        for k in range(size):
            word = phrases.table[:, size - 1 - k]
            go = np.flatnonzero((word > 0) & (hi > lo))
            c = word[go]
            lo[go] = self.counts[c] + self.ranks.rank(c, lo[go])
            hi[go] = self.counts[c] + self.ranks.rank(c, hi[go])
        found = np.maximum(hi - lo, 0)
        window = np.repeat(np.arange(n), found)
        row = np.repeat(lo, found) + np.arange(len(window)) - np.repeat(np.cumsum(found) - found, found)
        return window, self.locate(row)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: step to the preceding word until a sampled row is met."""
        at, steps = np.full(len(row), -1, np.int64), np.zeros(len(row), np.int64)
        left = np.arange(len(row))
        row = row.copy()
        while len(left):
            pos = self.sampled[row[left]]
            done = pos >= 0
            at[left[done]] = pos[done] + steps[left[done]]
            left = left[~done]
            c = self.bwt[row[left]]
            row[left] = self.counts[c] + self.ranks.rank(c, row[left])
            steps[left] += 1
        return at


def shard_hits(words: list[list[bytes]], phrases: Phrases) -> list[tuple[np.ndarray, set[str]]]:
    """For each document of a shard: which words are hit (a mask, empty without hit) and the items found."""
    get = phrases.number.get
    runs, doc_of, at_word = [], [], []
    for d, ws in enumerate(words):
        ids = np.array([get(w, 0) for w in ws], np.int64)
        if len(ids) < phrases.shortest or not phrases.shortest:
            continue
        known = np.diff(np.r_[0, ids > 0, 0].astype(np.int8))
        for a, b in zip(np.flatnonzero(known == 1), np.flatnonzero(known == -1)):
            if b - a >= phrases.shortest:
                runs.append(ids[a:b])
                doc_of.append(d)
                at_word.append(a)
    out: list[tuple[np.ndarray, set[str]]] = [(_NO_HIT, set()) for _ in words]
    if not runs:
        return out
    index = FMIndex(runs, len(phrases.number))
    window, pos = index.search(phrases)
    if not len(window):
        return out
    run = np.searchsorted(index.ends, pos, "right")
    doc = np.array(doc_of)[run]
    first = np.array(at_word)[run] + pos - index.starts[run]
    last = first + phrases.lengths[window]
    order = np.argsort(doc, kind="stable")
    cut = np.flatnonzero(np.r_[True, np.diff(doc[order]) != 0, True])
    for a, b in zip(cut, cut[1:]):
        some = order[a:b]
        d = int(doc[some[0]])
        cover = np.zeros(len(words[d]) + 1, np.int64)
        np.add.at(cover, first[some], 1)
        np.add.at(cover, last[some], -1)
        out[d] = (np.cumsum(cover[:-1]) > 0, {i for w in set(window[some].tolist()) for i in phrases.items[w]})
    return out


_NO_HIT = np.zeros(0, bool)


def spans_of(mask: np.ndarray) -> list[tuple[int, int]]:
    """Merged spans (first word, one past the last)."""
    edge = np.diff(np.r_[0, mask, 0].astype(np.int8))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def _shards(batch: pa.RecordBatch, column: int):
    """Consecutive parts of a batch, each of bounded text size."""
    size = np.array(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), np.int64)
    shard = (np.cumsum(size) - size) // SHARD_CHARS
    cut = np.flatnonzero(np.r_[True, np.diff(shard) != 0, True]) if len(size) else []
    for a, b in zip(cut, cut[1:]):
        yield batch.slice(int(a), int(b - a))


def benchmark_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list[DataFrame]:
    """The query set in parts of about ``block_chars`` characters each, by hash; one at least."""
    items = need(benchmark, "item_id", "text").where(F.col("text").isNotNull())
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // block_chars))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)] if n > 1 else [items]


def _sent(block: DataFrame):
    """The windows of a part of the query set as a broadcast."""
    rows = [("" if r[0] is None else str(r[0]), r[1]) for r in block.collect()]
    return block.sparkSession.sparkContext.broadcast(Phrases(rows))


def _found(blocks: list[DataFrame], docs: DataFrame) -> DataFrame:
    """row1, row2, items, spans of the rows of ``docs`` in which a window of several blocks occurs.  Each block
    is a written job of its own that gives its broadcast back, so no more than one block is held at a time,
    whatever the size of the query set."""
    rows = need(docs, "doc_id", "text").select(*row_key(), "text")
    hits = []
    for block in blocks:
        sent = _sent(block)

        def run(batches, sent=sent):
            for b in batches:
                for part in _shards(b, 2):
                    found = shard_hits([split_words(t) for t in part.column(2).to_pylist()], sent.value)
                    at = [i for i, (m, _) in enumerate(found) if len(m)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(at, pa.int64())), part.column(1).take(pa.array(at, pa.int64())),
                         pa.array([sorted(found[i][1]) for i in at], pa.list_(pa.string())),
                         pa.array([[{"first": x, "last": y} for x, y in spans_of(found[i][0])] for i in at], _SPANS)],
                        names=[*ROW, "items", "spans"])

        hits.append(materialize(rows.mapInArrow(run, "row1 long, row2 long, items array<string>, spans array<struct<first:int,last:int>>"),
                                "benchmark_hits"))
        sent.destroy()
    every = hits[0]
    for h in hits[1:]:
        every = every.unionByName(h)
    # Rows that agree in id and text have the same hits.
    return every.distinct().groupBy(*ROW).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                                   F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def union_of(spans: list[dict]) -> list[tuple[int, int]]:
    """Merged spans from sorted ones that may overlap or touch."""
    out: list[tuple[int, int]] = []
    for s in spans:
        if out and s["first"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["last"]))
        else:
            out.append((s["first"], s["last"]))
    return out


def matches(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted), spans (merged, in words) for each row of ``docs``."""
    blocks = benchmark_blocks(benchmark, block_chars)
    names = ["doc_id", "n_words", "n_hit", "items", "spans"]

    def batch(part, words, items, spans):
        return pa.RecordBatch.from_arrays(
            [part.column(0).cast(pa.int64()), pa.array([len(w) for w in words], pa.int64()),
             pa.array([sum(y - x for x, y in s) for s in spans], pa.int64()), pa.array(items, pa.list_(pa.string())),
             pa.array([[{"first": x, "last": y} for x, y in s] for s in spans], _SPANS)], names=names)

    if len(blocks) == 1:
        sent = _sent(blocks[0])

        def run(batches):
            for b in batches:
                for part in _shards(b, 1):
                    words = [split_words(t) for t in part.column(1).to_pylist()]
                    rows = shard_hits(words, sent.value)
                    yield batch(part, words, [sorted(i) for _, i in rows], [spans_of(m) for m, _ in rows])

        return need(docs, "doc_id", "text").mapInArrow(run, SCHEMA)

    def joined(batches):
        for b in batches:
            for part in _shards(b, 1):
                items, spans = part.column(2).to_pylist(), part.column(3).to_pylist()
                yield batch(part, [split_words(t) for t in part.column(1).to_pylist()], [i or [] for i in items], [union_of(s or []) for s in spans])

    rows = need(docs, "doc_id", "text").select("doc_id", "text", *row_key()).join(_found(blocks, docs), list(ROW), "left")
    return rows.select("doc_id", "text", "items", "spans").mapInArrow(joined, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    words = [m.span() for m in _WORD.finditer(text.translate(_UPPER))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:words[a][0]])
        at = words[b - 1][1]
    out.append(text[at:])
    return "".join(out)


def remove_spans(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with the occurrences of benchmark windows cut out of ``text`` (and ``n_chars``, if there,
    set to the new length); documents without a hit are as they were."""
    blocks = benchmark_blocks(benchmark, block_chars)
    own = ("doc_id", "text")
    d = sealed(docs, *own)
    at = d.columns.index("text")
    n_chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else -1
    schema, names = d.schema, d.columns

    def cut(part, spans):
        cols = list(part.columns[:len(names)])
        if any(spans):
            texts = [without_spans(t, s) if s else t for t, s in zip(cols[at].to_pylist(), spans)]
            if n_chars >= 0:
                cols[n_chars] = pa.array([len(t) if s else o for t, s, o in zip(texts, spans, cols[n_chars].to_pylist())], cols[n_chars].type)
            cols[at] = pa.array(texts, cols[at].type)
        return pa.RecordBatch.from_arrays(cols, names=names)

    if len(blocks) == 1:
        sent = _sent(blocks[0])

        def run(batches):
            for b in batches:
                for part in _shards(b, at):
                    rows = shard_hits([split_words(t) for t in part.column(at).to_pylist()], sent.value)
                    yield cut(part, [spans_of(m) if len(m) else [] for m, _ in rows])

        return unsealed(d.mapInArrow(run, schema), docs, *own)

    def joined(batches):
        for b in batches:
            for part in _shards(b, at):
                yield cut(part, [union_of(s or []) for s in part.column(len(names)).to_pylist()])

    found = _found(blocks, docs).select(*ROW, F.col("spans").alias("found_spans"))
    rows = d.select("*", *row_key()).join(found, list(ROW), "left").select(*names, "found_spans")
    return unsealed(rows.mapInArrow(joined, schema), docs, *own)
