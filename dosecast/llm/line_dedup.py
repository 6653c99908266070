"""Line dedup by a deletion-neighbourhood join (operator 1).

Units of edit are words: two lines are near when one word inserted, deleted or
replaced turns one into the other.  One edit turns a line of one word into any
other, so lines of fewer than ``MIN_WORDS`` = 2 words count as near only when they
are equal.  A line goes when
an earlier line, by (doc_id, line number), is equal to or near it; the earliest
of a neighbourhood stays.

1. Equal lines are brought together by two 64-bit hashes of their text; the
   first occurrence stands for them.  (Lines of ``MIN_WORDS`` words that differ
   in white space only are near.)
2. A line with a near line agrees with it on its first or its second half of
   words.  Lines that share no half with another line have no near line and
   leave the search; this loses nothing and keeps the variants few.
3. The others emit one hashed key for each deleted word (the hash of what is
   left is a running xor of word-and-place hashes, so a line's keys cost its
   length) and one for the whole line.  Two lines of equal length that agree
   after deleting the same place differ by a replaced word; a line that equals
   another's variant differs by an inserted one.  By key, the earliest line is
   found by aggregation and joined back: one pair for each line and key, never
   all pairs of a group.
4. The pair's edit distance is verified on the words themselves.

Both sides of every join grow with the input, so none is a broadcast.

DataFrame functions only.  Defined cases: a null or empty text and blank lines
have no words and are never removed nor counted; a null id orders before all
others; rows are told apart by two 64-bit hashes of id and text, which also
order lines of one id and number; of rows that agree in both, one keeps its
lines (which one is not defined); an empty table gives an empty result; columns
beyond ``doc_id`` and ``text`` are not read (``kept_lines``) or are passed
through (``remove_lines``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosecast.llm.common import ROW, need, row_key, sealed, unsealed, word_list
from dosecast.session import materialize

MIN_WORDS = 2
PLACE = (*ROW, "pos")       # a line of a row


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, row1, row2, pos, line."""
    # The hashes are taken below the explode, once a row.
    d = need(docs, "doc_id", "text").select("doc_id", *row_key(), F.split(F.coalesce("text", F.lit("")), "\n").alias("parts"))
    return d.select("doc_id", *ROW, F.posexplode("parts").alias("pos", "line"))


def _halves(words: Column, n: Column) -> Column:
    """Hashes of the first and last m words, for m = n div 2 and (the same for an odd n) (n - 1) div 2."""
    def of(m: Column) -> list[Column]:
        return [F.xxhash64(F.lit(0), m, F.slice(words, F.lit(1), m)), F.xxhash64(F.lit(1), m, F.slice(words, n - m + 1, m))]
    m = F.floor(n / 2).cast("int")
    # Halves of no words are no key: lines of one word are near no other.
    return F.when((n % 2 == 1) | (m == 1), F.array(*of(m))).otherwise(F.array(*of(m), *of(m - 1)))


def distinct_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, pos, row1, row2 (of the first occurrence), halves (none for short lines) of the lines with a word."""
    x = lines(docs).withColumn("words", word_list(F.col("line"))).withColumn("n", F.size("words")).where(F.col("n") > 0)
    x = x.select(F.struct("doc_id", "pos", *ROW).alias("first"),
                 F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                 F.when(F.col("n") >= min_words, _halves(F.col("words"), F.col("n"))).alias("halves"))
    g = x.groupBy("h1", "h2").agg(F.min("first").alias("first"), F.any_value("halves").alias("halves"))
    return g.select("first.*", "halves")


def candidates(distinct: DataFrame) -> DataFrame:
    """Lines that share a half with another one: row1, row2, pos, ord (number in the order of lines, with gaps)."""
    keys = distinct.where(F.col("halves").isNotNull()).select("doc_id", *PLACE, F.explode("halves").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1).select("key")
    found = keys.join(shared.hint("merge"), "key", "left_semi").select("doc_id", *PLACE).distinct()
    return found.orderBy("doc_id", "pos", *ROW).select(*PLACE, F.monotonically_increasing_id().alias("ord"))


def variants(cand: DataFrame) -> DataFrame:
    """``cand`` (ord, n, words) -> ord, role (0: word replaced, 1: word deleted, 2: whole line), key."""
    w = cand.select("ord", "n", F.posexplode("words").alias("p", "word")).select(
        "ord", "n", "p", F.xxhash64("word", "p").alias("f"), F.xxhash64("word", F.col("p") - 1).alias("g"))
    by_line = Window.partitionBy("ord").orderBy("p")
    start, end = Window.unboundedPreceding, Window.unboundedFollowing
    w = w.select("ord", "n", "p", F.coalesce(F.bit_xor("f").over(by_line.rowsBetween(start, -1)), F.lit(0)).alias("f_before"),
                 F.bit_xor("g").over(by_line.rowsBetween(start, 0)).alias("g_until"),
                 F.bit_xor("f").over(by_line.rowsBetween(start, end)).alias("f_all"),
                 F.bit_xor("g").over(by_line.rowsBetween(start, end)).alias("g_all"))
    # What is left without word p: the words before in their places, those after moved down by one.
    left = F.col("f_before").bitwiseXOR(F.col("g_all")).bitwiseXOR(F.col("g_until"))
    row = lambda role, key: F.struct(F.lit(role).alias("role"), key.alias("key"))
    rows = F.concat(
        F.array(row(0, F.xxhash64(F.lit(0), left, "n", "p")), row(1, F.xxhash64(F.lit(1), left, F.col("n") - 1))),
        F.when(F.col("p") == 0, F.array(row(2, F.xxhash64(F.lit(1), "f_all", "n")))).otherwise(F.array().cast("array<struct<role:int,key:bigint>>")))
    return w.select("ord", F.explode(rows).alias("v")).select("ord", "v.role", "v.key")


def earlier_pairs(v: DataFrame) -> DataFrame:
    """(ord, earlier): each line with the earliest line that its key allows, where that is earlier."""
    shared = v.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.when(F.col("role") != 2, F.col("ord"))).alias("cut"),
        F.min(F.when(F.col("role") == 2, F.col("ord"))).alias("whole")).where(F.col("rows") > 1)
    other = F.when(F.col("role") == 1, F.col("whole")).otherwise(F.col("cut"))
    return (v.join(shared.hint("merge"), "key").select("ord", other.alias("earlier"))
            .where(F.col("earlier") < F.col("ord")).distinct())


def within_one(a: Column, b: Column) -> Column:
    """Word edit distance of two word lists at most 1."""
    n = F.least(F.size(a), F.size(b))
    def agree(x: Column, y: Column) -> Column:      # length of the common beginning, at most n
        place = F.array_position(F.zip_with(F.slice(x, F.lit(1), n), F.slice(y, F.lit(1), n), lambda p, q: p == q), False)
        return F.when(place == 0, n.cast("long")).otherwise(place - 1)
    left, right = agree(a, b), agree(F.reverse(a), F.reverse(b))
    return F.when(F.size(a) == F.size(b), left + right >= n - 1).when(
        F.abs(F.size(a) - F.size(b)) == 1, left + right >= n).otherwise(F.lit(False))


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """row1, row2, pos of the distinct lines that have a near earlier line."""
    want = materialize(candidates(distinct), "line_candidates")
    # Rows that agree in id and text give a line once.
    text = lines(docs).select(*PLACE, "line").join(want.hint("merge"), list(PLACE)).dropDuplicates(list(PLACE))
    cand = text.select(*PLACE, "ord", word_list(F.col("line")).alias("words"))
    cand = materialize(cand.withColumn("n", F.size("words")), "line_words")
    pairs = earlier_pairs(materialize(variants(cand), "line_variants"))
    a = cand.select("ord", *PLACE, F.col("words").alias("a"))
    b = cand.select(F.col("ord").alias("earlier"), F.col("words").alias("b"))
    return (pairs.join(a.hint("merge"), "ord").join(b.hint("merge"), "earlier")
            .where(within_one(F.col("a"), F.col("b"))).select(*PLACE).distinct())


def kept_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """row1, row2, kept (numbers of the lines that stay, ascending); rows of which no line stays are missing."""
    distinct = materialize(distinct_lines(docs, min_words), "line_distinct")
    kept = distinct.join(near_lines(docs, distinct).hint("merge"), list(PLACE), "left_anti")
    return kept.groupBy(*ROW).agg(F.sort_array(F.collect_list("pos")).alias("kept"))


def _with_kept(d: DataFrame, kept: DataFrame) -> DataFrame:
    """``d`` (with row1, row2) and kept; of rows that agree in id and text, one has lines that stay."""
    copy = F.row_number().over(Window.partitionBy(*ROW).orderBy(F.lit(0)))
    return d.join(kept.hint("merge"), list(ROW), "left").withColumn("kept", F.when(copy == 1, F.col("kept")))


def remove_lines(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``docs`` without the lines that have words and are not in ``kept``; blank lines stay."""
    own = ("doc_id", "text")
    stays = lambda line, i: ((F.size(word_list(line)) == 0)
                             | F.array_contains(F.coalesce("kept", F.array().cast("array<int>")), i))
    d = _with_kept(sealed(docs, *own).select("*", *row_key()), kept)
    return unsealed(d.withColumn("text", F.array_join(F.filter(F.split("text", "\n"), stays), "\n")), docs, *own)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (with a word), n_kept, kept_lines (numbers, comma-joined)."""
    d = need(docs, "doc_id", "text")
    n = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long")
    return _with_kept(d.select("doc_id", n.alias("n_lines"), *row_key()), kept_lines(d)).select(
        "doc_id", "n_lines", F.coalesce(F.size("kept"), F.lit(0)).cast("long").alias("n_kept"),
        F.coalesce(F.concat_ws(",", F.col("kept").cast("array<string>")), F.lit("")).alias("kept_lines"))
