"""Spelling variants grouped by asymmetric q-chunks (operator 12).

Words are maximal runs of letters, lower-cased, some of them misspelt on
purpose (``noise``: a given share of the runs of a document loses one code
point), counted over all texts.  Two words are near when one inserted, deleted
or replaced code point turns one into the other.

Of two words the shorter one (of equally long ones the smaller) contributes two
disjoint chunks of q = length div 2 code points, at places 0 and q; the other
contributes its positional grams of that q.  One edit breaks at most one of the
chunks, so the other is a gram of the longer word, at the chunk's place or one
beside it.  Grams further than one from both places can meet no chunk and are
not emitted.  Chunks and grams are joined by a hash of the shorter word's
length, the chunk's number and its text; the edit distance is verified in the
join's condition, so only near pairs leave it.  Keys with more than ``DENSE``
rows are dealt out over a grid of cells.

A word's form is its most frequent near word, if that is at least ``RATIO``
times as frequent; roots are found by pointer jumping (forms at least double
the count at each step, so there are no cycles and few rounds).

Defined cases: a null or empty text has no words; a null id counts as an empty
one in the noise's hash; rows are all counted, repeated ones too; a run may be
as long as its text; an empty table gives an empty result; only doc_id and text
are read, whatever other columns are called.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dosecast.llm.common import need
from dosecast.llm.dealing import dealt
from dosecast.session import materialize

MIN_LENGTH = 5
MIN_COUNT = 3
NOISE = 97                  # one in so many runs is misspelt; 0: none
RATIO = 2
DENSE = 2048
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_HELD = 200_000             # words that a task counts before it hands them on


def words_of(doc_id: int | None, text: str | None, noise: int = NOISE) -> Counter:
    """The words of one text with their counts, before any limit on length or count."""
    runs = Counter(_RUN.findall((text or "").encode().lower().decode()))      # bytes: A-Z only
    if not noise:
        return runs
    out, start = Counter(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for w, n in runs.items():
        h = zlib.crc32(w.encode(), start)
        if h % noise == 0:
            at = h % len(w)
            w = w[:at] + w[at + 1:]
        out[w] += n
    return out


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """word, n of the words with at least ``min_length`` code points and ``min_count`` occurrences."""

    def run(batches):
        def handed(c: Counter) -> pa.RecordBatch:
            kept = [(w, n) for w, n in c.items() if len(w) >= min_length]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()),
                                               pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])
        held = Counter()
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    held.update(words_of(i, t, noise))
                    if len(held) > _HELD:
                        yield handed(held)
                        held = Counter()
        yield handed(held)

    counted = need(docs, "doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _key(length: Column, chunk: int, gram: Column) -> Column:
    return F.xxhash64(length, F.lit(chunk), gram)


def chunks(words: DataFrame) -> DataFrame:
    """word, n, m (its length), key: two disjoint chunks of each word."""
    m, q = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    keys = F.array(_key(m, 0, F.substring("word", F.lit(1), q)), _key(m, 1, F.substring("word", q + 1, q)))
    return words.select("word", "n", m.alias("m"), F.explode(keys).alias("key"))


def grams(words: DataFrame) -> DataFrame:
    """word, n, m (the length of the shorter word that a gram is for), key: grams at a chunk's place or one beside it."""
    length = F.length("word")
    rows = []
    for less in (0, 1):
        m = length - less
        q = F.floor(m / 2).cast("int")
        for chunk in (0, 1):
            for shift in (-1, 0, 1):
                at = q * chunk + shift
                inside = (at >= 0) & (at + q <= length) & (m > 0)
                rows.append(F.when(inside, F.struct(m.alias("m"), _key(m, chunk, F.substring("word", at + 1, q)).alias("key"))))
    found = F.array_distinct(F.array_compact(F.array(*rows)))
    return words.select("word", "n", F.explode(found).alias("g")).select("word", "n", "g.m", "g.key")


def near_pairs(words: DataFrame, dense: int = DENSE) -> DataFrame:
    """``words`` (word, n; distinct) -> (a, n_a, b, n_b), each near pair once: a is the shorter word or, of
    equally long ones, the smaller."""
    c = chunks(words).withColumn("chunk", F.lit(True))
    g = grams(words).withColumn("chunk", F.lit(False))
    both = c.unionByName(g)
    # Keys that have a chunk and a gram of another word.
    shared = both.groupBy("key").agg(F.min("word").alias("lo"), F.max("word").alias("hi"), F.max("chunk").alias("c")).where(
        F.col("c") & (F.col("lo") < F.col("hi"))).select("key")
    rows = materialize(both.join(shared, "key", "left_semi"), "spelling_keys")
    left, right = dealt(rows, "key", "word", dense)
    a, b = left.where("chunk").alias("a"), right.where("not chunk").alias("b")
    on = ((F.col("a.key") == F.col("b.key")) & (F.col("a.cell_r") == F.col("b.cell_r")) & (F.col("a.cell_c") == F.col("b.cell_c"))
          & (F.col("a.m") == F.col("b.m"))
          & ((F.length("b.word") > F.length("a.word")) | (F.col("a.word") < F.col("b.word")))
          & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1))
    return a.join(b, on).select(F.col("a.word").alias("a"), F.col("a.n").alias("n_a"),
                                F.col("b.word").alias("b"), F.col("b.n").alias("n_b")).distinct()


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    found = words.join(best, "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    return found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                        F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """word, root of the words that have a form."""
    to = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        seen = Observation("spelling_roots")
        further = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = to.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                       F.col("next").isNotNull().alias("moved"))
        to = materialize(step, "spelling_roots", (seen, F.sum(F.col("moved").cast("long")).alias("moved")))
        if not seen.get["moved"]:
            return to.select("word", "root")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int = NOISE,
             ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words."""
    words = materialize(word_counts(docs, min_length, min_count, noise), "spelling_words")
    pairs = materialize(near_pairs(words), "spelling_pairs")
    formed = materialize(forms(words, pairs, ratio), "spelling_forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
