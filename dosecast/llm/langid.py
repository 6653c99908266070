"""Language identification with error-correcting output codes (operator 9).

Every language has a codeword.  For each bit a binary classifier over hashed
character n-grams tells the languages with a 1 from those with a 0: the
log-odds of each n-gram between the two groups, from n-gram counts of all
labelled texts that are not held out.  A text's margins are its mean log-odds;
decoding adds up each codeword's logistic losses, weighted by how well the bit
separates its groups, and takes the codeword with the least loss.  A text whose
runner-up is close is flagged as ambiguous.

Up to ``EXHAUSTIVE`` languages the code is exhaustive (every split of the
languages is a bit); above, it is the best of seeded random codes.

Training counts are sums over all texts, gathered per task and added by Spark;
the model (n-grams x languages, at most ``MAX_LANGUAGES`` languages) is bounded
and is what reaches the driver.

Defined cases: a null text, or one without a letter, gives ``und`` and score 0;
so does every text when there is nothing to learn from; a null language is not
learned; rows are predicted one by one, so repeated rows and ids give a row
each; a null id is held out as crc32 of the empty string is 0; columns beyond
``doc_id``, ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import need
from dosecast.session import materialize

BUCKETS = 1 << 14
EXHAUSTIVE = 6
MAX_LANGUAGES = 512
STEEPNESS = 8.0
AMBIGUOUS = 0.6
FOLDS = 5
_LETTER = re.compile(r"[^\W\d_]")
_PART = 1 << 18
SCHEMA = "doc_id long, lang_pred string, score double, runner_up string, ambiguous boolean"


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


_IS_LETTER = np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed 1-, 2- and 3-grams of letters; runs of other characters count as one space."""
    out = np.zeros(BUCKETS, np.int64)
    low = text.lower()
    for at in range(0, len(low), _PART):
        c = np.frombuffer((" " + low[at:at + _PART] + " ").encode("utf-32-le", "replace"), "<u4")
        letter = _IS_LETTER[c]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] = True
        c = np.where(letter, c, 32)[keep].astype(np.uint32)
        one = c * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (c[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ (c[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
        out += np.bincount(np.concatenate((one, two, three)) >> np.uint32(18), minlength=BUCKETS)
    return out


def code_matrix(k: int, seed: int = 9) -> np.ndarray:
    """k codewords of +1 and -1."""
    if k <= EXHAUSTIVE:
        bits = (1 << max(0, k - 1)) - 1
        return np.array([[1 if i == 0 or j >> (k - 1 - i) & 1 else -1 for j in range(bits)] for i in range(k)], np.int8).reshape(k, bits)
    rng, bits, best = random.Random(seed), int(np.ceil(10 * np.log2(k))), None
    for _ in range(100):
        m = np.array([[rng.choice((-1, 1)) for _ in range(bits)] for _ in range(k)], np.int8)
        if (np.abs(m.sum(0)) == k).any():
            continue
        apart = (bits - m.astype(int) @ m.T.astype(int)) // 2
        least = int(apart[~np.eye(k, dtype=bool)].min())
        if best is None or least > best[0]:
            best = (least, m)
    return best[1]


def train(docs: DataFrame, folds: int = FOLDS) -> dict:
    """The model from the rows of ``docs`` that are not held out and have a language."""
    rows = docs.where(~held_out(F.col("doc_id"), folds) & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def gather(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += ngram_counts(text)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                                             names=["lang", "gram", "n"])

    counts = (need(rows, "lang", "text").mapInArrow(gather, "lang string, gram int, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counts = materialize(counts, "langid_counts")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    got = counts.select("lang", "gram", "n").toArrow()      # at most BUCKETS rows a language
    n = np.zeros((len(langs), BUCKETS))
    lang = got.column("lang").combine_chunks().dictionary_encode()
    number = np.array([langs.index(x) for x in lang.dictionary.to_pylist()], np.int64)
    n[number[lang.indices.to_numpy()], got.column("gram").to_numpy()] = got.column("n").to_numpy()
    return model_of(langs, n)


def model_of(langs: list[str], n: np.ndarray) -> dict:
    """The classifiers of the code's bits from n-gram counts (languages x buckets)."""
    p = (n + 0.5) / (n.sum(1, keepdims=True) + 0.5 * BUCKETS)
    code = code_matrix(len(langs))
    odds = np.zeros((code.shape[1], BUCKETS), np.float32)
    weight = np.ones(code.shape[1])
    for b in range(code.shape[1]):
        one, zero = p[code[:, b] > 0].mean(0), p[code[:, b] < 0].mean(0)
        odds[b] = np.log(one / zero)
        weight[b] = ((one - zero) * odds[b]).sum()
    return {"langs": langs, "code": code.astype(np.float64), "odds": odds, "weight": weight / weight.mean() if len(weight) else weight}


def decode(model: dict, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best and second codeword and the best one's score for rows of margins."""
    loss = np.log1p(np.exp(-STEEPNESS * margins[:, None, :] * model["code"][None])) @ model["weight"]
    order = np.argsort(loss, axis=1, kind="stable")
    gain = np.exp(loss.min(1, keepdims=True) - loss)
    return order[:, 0], order[:, min(1, order.shape[1] - 1)], 1 / gain.sum(1)


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score, runner_up, ambiguous for each row of ``docs``; reads doc_id and text only."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                texts = part.column(1).to_pylist()
                good = [i for i, t in enumerate(texts) if m["langs"] and t and has_letter(t)]
                pred, score, second = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
                if good:
                    n = np.stack([ngram_counts(texts[i]) for i in good]).astype(np.float32)
                    best, next_, s = decode(m, (n @ m["odds"].T) / n.sum(1, keepdims=True))
                    for i, x, y, z in zip(good, best, next_, s):
                        pred[i], second[i], score[i] = m["langs"][x], m["langs"][y], float(z)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(second, pa.string()),
                     pa.array([s < ambiguous for s in score], pa.bool_())], names=["doc_id", "lang_pred", "score", "runner_up", "ambiguous"])

    ambiguous = AMBIGUOUS
    return need(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def has_letter(text: str) -> bool:
    # The pattern also accepts numerals that are no digits.
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def identify(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Train on the rows outside the held-out fold, predict all: doc_id, held_out, lang_pred, score, ..."""
    model = train(docs, folds)
    out = predict(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "lang_pred", "score", "runner_up", "ambiguous")
