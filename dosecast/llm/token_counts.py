"""Token counts at every prefix (operator 2).

For byte-level BPE a token sequence is the encoding of its text exactly when
every two neighbouring tokens are the encoding of their joined bytes.  So the
last token of each prefix can be found by dynamic programming: prefix ``i``
ends in the token ``t`` for which prefix ``i - len(t)`` ends in a token that
may stand before ``t``, and its count is one more than that prefix's.  The
counts of all prefixes of a text are stored as differences, one small signed
number for each code point (``prefix_deltas``); running sums answer
truncation and budget questions without encoding again.

Defined cases: a null text is an empty one (0 bytes, 0 tokens, no
differences); rows are counted one by one, so repeated rows and repeated or
null ids give one row each; columns beyond ``doc_id`` and ``text`` are not
read; special strings inside texts count as the library has them by default
(one token), while a prefix that ends inside one counts it as plain text.
"""

from __future__ import annotations

from array import array
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.llm import bpe
from dosecast.llm.common import need

SCHEMA = "doc_id long, n_bytes long, n_tokens long, delta_bytes int, prefix_deltas binary"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: visible Latin-1 characters
    stand for themselves, the others, in order, for U+0100 onward."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter(bpe.UnitTokenizer):
    """Unit values are count differences (int16) for each code point of the unit."""

    def __init__(self, spec: str):
        super().__init__(spec)
        if not self.by_unit:
            raise ValueError("prefix counts need a byte-level BPE tokenizer")
        byte_of = byte_letters()
        raw = lambda s: bytes(byte_of[c] for c in s)
        model = self.conf["model"]
        self.token = {raw(k): v for k, v in model["vocab"].items() if all(c in byte_of for c in k)}
        self.text_of = {v: k for k, v in self.token.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        # Every beginning of a token, with its id (-1: no token by itself).
        self.starts = {b[:n]: -1 for b in self.token for n in range(1, len(b))} | self.token
        self.may_follow: dict[tuple[int, int], bool] = {}

    def _merge(self, parts: list[bytes]) -> list[bytes]:
        """Plain BPE: join the neighbours of lowest rank until none can be joined."""
        while len(parts) > 1:
            best = min((self.rank.get(p, 1 << 60), p) for p in zip(parts, parts[1:]))
            if best[0] == 1 << 60:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best[1]:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _fits(self, a: int, b: int) -> bool:
        x, y = self.text_of[a], self.text_of[b]
        got = self._merge([bytes([c]) for c in x + y]) == [x, y]
        if len(self.may_follow) > 1_000_000:
            self.may_follow.clear()
        self.may_follow[(a, b)] = got
        return got

    def piece_counts(self, piece: bytes) -> list[int]:
        """Token count of every byte prefix of one piece (prefixes 1, 2, ...)."""
        starts, known, n = self.starts.get, self.may_follow.get, len(piece)
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for j in range(n):
            before, c = last[j], count[j] + 1
            for i in range(j + 1, n + 1):
                t = starts(piece[j:i])
                if t is None:           # no token starts with these bytes
                    break
                if t < 0 or last[i] >= 0:
                    continue
                if j:
                    ok = known((before, t))
                    if ok is None:
                        ok = self._fits(before, t)
                    if not ok:
                        continue
                last[i], count[i] = t, c
        if -1 in last[1:]:
            raise ValueError(f"a prefix of {piece[:40]!r} has no encoding")
        return count[1:]

    def chars(self, piece: str) -> list[int]:
        """Counts at the code-point prefixes of a piece."""
        at_byte = self.piece_counts(piece.encode())
        if len(at_byte) == len(piece):
            return at_byte
        ends = np.cumsum([len(c.encode()) for c in piece])
        return [at_byte[e - 1] for e in ends]

    def unit_counts(self, unit: str) -> list[int]:
        """Counts at the code-point prefixes of a unit, each prefix cut into pieces as if it stood alone."""
        out: list[int] = []
        base = 0
        pieces = [unit[a:b] for _, (a, b) in self.lib.pre_tokenizer.pre_tokenize_str(unit)]
        run = len(unit) - len(unit.lstrip(bpe.SPACES))
        if run > 1:
            # A prefix that ends inside the leading white space has it as one piece.
            inside = self.chars(unit[:run])
            if run == len(unit):
                return inside
            out += inside[:run]
            base = inside[run - 2]
            first = pieces[1] if pieces[0] == unit[:run - 1] else None
            if first is None:
                raise ValueError("unexpected pieces")
            skip = 1 if first[0] in bpe.SPACES and len(first) > 1 else 0
            if not skip:                      # the last white space stands alone
                base += self.chars(first)[-1]
                pieces = pieces[2:]
            else:
                inner = self.chars(first)
                out += [base + c for c in inner[1:]]
                base += inner[-1]
                pieces = pieces[2:]
        for p in pieces:
            if len(p) > 1 and p[0] == "'" and p[1] in "stmdrvl":
                # A contraction cut short is an apostrophe, then a letter.
                short = [self.chars("'")[0]]
                if len(p) > 2:
                    short.append(short[0] + self.chars(p[1])[0])
                inner = short + [self.chars(p)[-1]]
            else:
                inner = self.chars(p)
            out += [base + c for c in inner]
            base += inner[-1]
        return out

    def values(self, units: list[str]) -> list[bytes]:
        return [_differences(_counts_of(self, u)) for u in units]

    def after_a_space(self, words: list[str]) -> list[bytes]:
        return [_differences(self.piece_counts((" " + w).encode())) if w.isascii() and w.isalpha()
                else self.values([" " + w])[0]
                for w in words]

    def whole(self, text: str) -> bytes:
        return b"".join(self.values([text]))

    def special(self, text: str) -> bytes:
        """Text between special strings is cut apart first; a whole special string is one token."""
        cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)))
        out, at, total = [], 0, 0
        for m in cut.finditer(text):
            before = text[at:m.start()]
            deltas = self.segment(before) if before else b""
            out.append(deltas)
            total += int(np.frombuffer(deltas, "<i2").sum())
            # A prefix that ends inside the special string has its start as plain text after ``before``.
            tail = unit_tail(before)
            settled = total - (self.unit_counts(tail)[-1] if tail else 0)
            plain = _counts_of(self, tail + m.group())[len(tail):-1]
            counts = [total, *[settled + c for c in plain], total + 1]
            out.append(np.diff(counts).astype("<i2").tobytes())
            total += 1
            at = m.end()
        if at < len(text):
            out.append(self.segment(text[at:]))
        return b"".join(out)


_TAIL_REVERSED = regex.compile(f"[^{bpe._WS}]*[{bpe._WS}]*")


def unit_tail(text: str) -> str:
    """The last unit of a text, found from its end, once along the unit."""
    return _TAIL_REVERSED.match(text[::-1]).group()[::-1]


def _differences(counts: list[int]) -> bytes:
    return array("h", map(sub, counts, [0, *counts])).tobytes()


def _counts_of(counter: PrefixCounter, text: str) -> list[int]:
    out, base = [], 0
    for u in bpe._UNIT.findall(text):
        inner = counter.unit_counts(u)
        out += [base + c for c in inner]
        base += inner[-1]
    return out


_COUNTERS: dict[int, PrefixCounter] = {}


def _counter(spec: str) -> PrefixCounter:
    key = hash(spec)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PrefixCounter(spec)
    return _COUNTERS[key]


def prefix_table(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): bytes, tokens, and the differences of the
    counts at successive code-point prefixes (``delta_bytes`` bytes each, signed, little-endian)."""
    spec = docs.sparkSession.sparkContext.broadcast(bpe.read_spec(tokenizer_path))

    def run(batches):
        counter = _counter(spec.value)
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for at in range(0, b.num_rows, 512):
                rows = []
                for t in texts.slice(at, 512).to_pylist():
                    t = t or ""
                    d = np.frombuffer(counter.encode(t), "<i2")
                    small = d.size == 0 or (d.min() >= -128 and d.max() <= 127)
                    rows.append((len(t.encode()), int(d.sum(dtype=np.int64)), 1 if small else 2,
                                 d.astype("i1" if small else "<i2").tobytes()))
                cols = list(zip(*rows))
                part = ids.slice(at, 512)
                yield pa.RecordBatch.from_arrays(
                    [part.cast(pa.int64()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.binary())],
                    names=["doc_id", "n_bytes", "n_tokens", "delta_bytes", "prefix_deltas"])

    return need(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def prefix_counts(deltas: bytes, delta_bytes: int) -> np.ndarray:
    """Token counts of the prefixes of 1, 2, ... code points."""
    return np.cumsum(np.frombuffer(deltas, "i1" if delta_bytes == 1 else "<i2"), dtype=np.int64)


def longest_within(table: DataFrame, budget: int) -> DataFrame:
    """For each row of ``prefix_table``: the largest prefix length (code points) whose own encoding
    has at most ``budget`` tokens, and that encoding's length.  Read off the stored counts."""
    def run(batches):
        for b in batches:
            d = b.to_pydict()
            chars, tokens = [], []
            for deltas, width in zip(d["prefix_deltas"], d["delta_bytes"]):
                c = prefix_counts(deltas, width)
                fit = np.flatnonzero(c <= budget)
                chars.append(int(fit[-1]) + 1 if fit.size else 0)
                tokens.append(int(c[fit[-1]]) if fit.size else 0)
            yield pa.RecordBatch.from_arrays([pa.array(d["doc_id"], pa.int64()), pa.array(chars, pa.int64()),
                                              pa.array(tokens, pa.int64())], names=["doc_id", "n_chars", "n_tokens"])

    return need(table, "doc_id", "delta_bytes", "prefix_deltas").mapInArrow(run, "doc_id long, n_chars long, n_tokens long")


def digest(table: DataFrame, limit: int = 512) -> DataFrame:
    return table.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
