"""Byte-level BPE through the tokenizers library, with exact unit-wise reuse.

A *unit* starts at white space that follows other text and ends before the
next such place.  The byte-level pre-tokenizer never lets a piece run from
text into following white space, and what it does after such a place does not
depend on what stood before it, so a text's ids are the ids of its units one
after the other.  Texts repeat units far more often than whole texts, so each
worker keeps the encodings of the units it has met (bounded; emptied when
full) and calls the library for new ones only.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

# White space as the pre-tokenizer's \s has it (Unicode White_Space).
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_UNIT = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Letters and digits of ASCII and Latin-1.
_PLAIN_END = frozenset(c for c in map(chr, range(0x100)) if c.isalpha() or c.isascii() and c.isdigit())
_SYMBOLS = "!#$%&()*+,-./:;<=>?@[]^_`{|}~"
# Marks for ``segment``: a full stop, a comma, a line's and the text's beginning.  Texts that hold
# them take the general rule.
_STOP, _COMMA, _LINE, _FIRST = "\x02", "\x03", "\x04", "\x05"
_MARKS, _BEGINS = frozenset((_STOP, _COMMA, _LINE, _FIRST)), (_LINE, _FIRST)
_NEW_LINE, _STOP_UNIT, _COMMA_UNIT = f" {_LINE}", f" {_STOP} ", f" {_COMMA} "
_STOP_LINE, _COMMA_LINE = f" {_STOP} {_LINE}", f" {_COMMA} {_LINE}"
MAX_UNITS = 900_000

_LOADED: dict = {}


def _one_piece(word: str) -> bool:
    """Letters only, of the blocks up to Latin Extended-B."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250")


def load(spec: str, units: int | None = None):
    """The worker's one ``UnitTokenizer`` for a tokenizer definition (the JSON text)."""
    key = hash((spec, units))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = UnitTokenizer(spec, units)
    return _LOADED[key]


def read_spec(path: str, max_bytes: int = 64 << 20) -> str:
    """A tokenizer file's text, read on the driver; its size is checked because it is sent to every task."""
    if os.path.getsize(path) > max_bytes:
        raise ValueError(f"{path} is larger than {max_bytes} bytes")
    with open(path, encoding="utf-8") as f:
        return f.read()


class UnitTokenizer:
    def __init__(self, spec: str, units: int | None = None):
        self.units = units or MAX_UNITS
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_str(spec)
        conf = json.loads(spec)
        pre, model = conf.get("pre_tokenizer") or {}, conf["model"]
        self.conf = conf
        self.specials = [a["content"] for a in conf.get("added_tokens") or []]
        #: Unit-wise encoding is exact for plain byte-level BPE only; other kinds encode whole texts.
        self.by_unit = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                        and model["type"] == "BPE" and not model.get("dropout") and conf.get("normalizer") is None
                        and not model.get("ignore_merges"))
        self.size = self.lib.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.spaced = np.zeros(self.size, bool)
        self.spaced[[i for t, i in self.lib.get_vocab().items() if t[0] == "\u0120"]] = True
        self.known: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}
        self.odd: set[str] = set()          # stored words that end in neither a letter nor a digit

    # -- values of units; a subclass may give units another value than their ids --

    def values(self, units: list[str]) -> list[bytes]:
        got = self.lib.encode_batch_fast(units, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in got]

    def after_a_space(self, words: list[str]) -> list[bytes]:
        """Values of the units ``' ' + word``.  Words of letters only are one piece each, so they are
        encoded as one text and told apart by the tokens that begin with the space."""
        known = {}
        # Letters, then symbols: the symbols are a piece of their own.
        base_of = {w: w.rstrip(_SYMBOLS) for w in words if w[-1] in _SYMBOLS}
        base_of = {w: b for w, b in base_of.items() if b and _one_piece(b)}
        one = list(dict.fromkeys([*filter(_one_piece, words), *(b for b in base_of.values() if b not in self.known)]))
        if one:
            e = self.lib.encode_batch_fast([" " + " ".join(one)], add_special_tokens=False)[0]
            ids = np.array(e.ids, self.dtype)
            raw, width = ids.tobytes(), self.dtype.itemsize
            ends = [*(np.flatnonzero(self.spaced[ids]) * width).tolist(), len(raw)]
            known = {w: raw[x:y] for w, x, y in zip(one, ends[:-1], ends[1:], strict=True)}
        for w, base in base_of.items():
            known[w] = (known.get(base) or self.known[base]) + self.other(w[len(base):])
        rest = [w for w in words if w not in known]
        known.update(zip(rest, self.values([" " + w for w in rest])))
        return [known[w] for w in words]

    def whole(self, text: str) -> bytes:
        return self.values([text])[0]

    def special(self, text: str) -> bytes:
        """The value of a text that holds a special string."""
        return self.whole(text)

    def _learn(self, words: set[str]) -> None:
        """Store the values of words: units ``' ' + word``, or those that a mark says begin a line or the
        text.  A full store keeps its older half, in which the frequent units are."""
        if len(self.known) + len(words) > self.units:
            for w in list(self.known)[self.units // 2:]:
                del self.known[w]
            self.odd.intersection_update(self.known)
        new = [w for w in words if w not in self.known]
        inner = [w for w in new if w[0] not in _BEGINS]
        begin = [w for w in new if w[0] in _BEGINS]
        self.known.update(zip(inner, self.after_a_space(inner)))
        self.known.update(zip(begin, self.values(["\n" + w[1:] if w[0] == _LINE else w[1:] for w in begin])))
        self.known.update(self.fixed())
        self.odd.update(w for w in new if w[-1] not in _PLAIN_END)

    def fixed(self) -> dict[str, bytes]:
        return {_STOP: self.other("."), _COMMA: self.other(",")}

    def other(self, unit: str) -> bytes:
        got = self.others.get(unit)
        if got is None:
            if len(self.others) > self.units // 8:
                self.others.clear()
            got = self.others[unit] = self.values([unit])[0]
        return got

    def encode(self, text: str) -> bytes:
        """Little-endian ids of a whole text (no begin, end or added special tokens)."""
        if not text:
            return b""
        if any(s in text for s in self.specials):
            return self.special(text)
        if not self.by_unit:
            return self.whole(text)
        return self.segment(text)

    def segment(self, text: str) -> bytes:
        """The common case: single spaces and line breaks between words.  Marks are put in for the places
        that matter, so that one split gives all units: a full stop or comma that follows a letter or digit
        and stands before white space is a piece of its own; a word after a line break, or at the text's
        beginning, has no space before it."""
        last = text[-1]
        if last == "." or last == ",":
            text = text[:-1]
        else:
            last = ""
        if not text or text[-1] in SPACES or last and text[-1] not in _PLAIN_END or any(m in text for m in _MARKS):
            return self.irregular(text + last)
        words = (_FIRST + text.replace(".\n", _STOP_LINE).replace(",\n", _COMMA_LINE).replace("\n", _NEW_LINE)
                 .replace(". ", _STOP_UNIT).replace(", ", _COMMA_UNIT)).split(" ")
        distinct = set(words)
        new = distinct.difference(self.known)
        if new:
            if "" in new or _LINE in new or _FIRST in new or any(w[-1] in SPACES for w in new):
                return self.irregular(text + last)
            if len(self.known) + len(new) > self.units:
                new = distinct
            self._learn(new - {_STOP, _COMMA})
        vals = list(map(self.known.__getitem__, words))
        if not self.odd.isdisjoint(distinct):
            if any(b in (_STOP, _COMMA) and a[-1] not in _PLAIN_END for a, b in zip(words, words[1:])):
                return self.irregular(text + last)
        if last:
            vals.append(self.other(last))
        return b"".join(vals)

    def irregular(self, text: str) -> bytes:
        """Any text, cut into units by the general rule."""
        return b"".join(self.other(u) for u in _UNIT.findall(text))
