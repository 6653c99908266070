"""Jaccard join of documents on word n-grams with prefix filtering (operator 11).

A document is the set of its distinct word shingles, as 64-bit hashes.
Documents with equal sets are one class, named by a hash of the set and its
size; classes link when their sets' similarity reaches the threshold.

1. One pass over the texts gives each row's class and counts all shingles in
   ``BUCKETS`` buckets by hash.  The counts are a table of fixed size, whatever
   the input.  They order the shingles, rare buckets first, ties by hash.  Any
   order is right for prefix filtering as long as it is the same everywhere, so
   a shared bucket costs candidates, never a link.
2. A second pass emits each set's prefix: in that order its first
   n - ceil(t n) + 1 shingles, of which linked sets share at least one.
   Prefix shingles of one class only leave at once.
3. The others are joined with themselves.  The join's condition holds the filters:
   length (sizes within the threshold), position (what stands behind the match
   in both sets can still make up the overlap), and suffix: the
   hash range is cut at fixed pivots into ``RANGES`` parts, and the differences
   of the sets' counts in each part add up to no more than the sets may differ
   by; nor do more of ``BITS_OF_SET`` hash classes have an odd number of members in one set
   and an even one in the other.  A match is dropped when one of the two shared prefix shingles before
   it is also a match, so near copies do not meet at each shingle.  Shingles with
   more than ``DENSE`` classes are dealt out over a grid of cells.
4. Each candidate pair is verified once, on whole sets.  The sets of candidates are
   formed anew from their texts and go to *blocks* by their smallest hash, which near copies share with the
   probability of their similarity, so a set is sent once to each pair of blocks
   in which it has candidates, not once to each pair.  Blocks hold about
   ``BLOCK`` shingles.

``Join.links`` gives all links between different sets; rows of a class are not
expanded into pairs.  Components (``digest``) need fewer: a group of g near copies
has up to g * g / 2 links.  ``Join.connecting`` verifies pairs of neighbours among each
shingle's rows first, in number as the rows, and then every candidate pair
whose classes are not connected yet, so no link between components is lost and
none within one is looked for twice.

Defined cases: a text of fewer words than a shingle has one, the whole
sequence; null and empty texts have none, link with nothing and are a component
each; rows with null or equal ids are allowed (a component's id is the smallest
non-null id in it); an empty table gives an empty result; only doc_id and text
are read, whatever other columns are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosecast.llm.common import ROW, need, row_key
from dosecast.llm.dealing import dealt
from dosecast.llm.graph import components
from dosecast.llm.pii import BITS, bit_table
from dosecast.session import materialize

SHINGLE = 4
PERCENT = 85
BUCKETS = 1 << 20
RANGES = 32
BITS_OF_SET = 256
SKETCH = ("r0", "r1", "r2", "r3", "p0", "p1", "p2", "p3")
DENSE = 2048
BLOCK = 1 << 20
_KNOWN = 100_000            # word hashes that a worker keeps
_FLUSH = 1 << 18            # shingles or words handled at once
# Odd, one for each place in a shingle.
_MULTIPLIERS = np.random.default_rng(11).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


# ------------------------------------------------------------ sets

class _Hashes(dict):
    """XXH64 of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, known: dict, shingle: int = SHINGLE) -> np.ndarray:
    """The set's hashes, ascending."""
    words = (text or "").encode().lower().split()      # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(shingle, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out += h[i:i + n] * _MULTIPLIERS[i]
    return np.unique(_mix(out))


def needed(a: Column, b: Column, percent: int = PERCENT) -> Column:
    """The smallest overlap with which sets of these sizes link."""
    return F.ceil(percent * (a + b) / (100.0 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _ranges(s: np.ndarray) -> np.ndarray:
    """Members in each of ``RANGES`` equal ranges of the hash, up to 255, one byte each."""
    return np.minimum(np.bincount((s >> np.uint64(59)).astype(np.int64), minlength=RANGES), 255).astype(np.uint8)


def _parities(s: np.ndarray) -> np.ndarray:
    """Whether each of ``BITS_OF_SET`` equal classes of the hash has an odd number of members, as bits."""
    odd = np.bincount(((s >> np.uint64(40)) & np.uint64(BITS_OF_SET - 1)).astype(np.int64), minlength=BITS_OF_SET) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def class_table(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Two kinds of rows: doc_id, row1, row2, n, node, low (the smallest hash), ``SKETCH`` (``_ranges``, ``_parities``) for each row;
    bucket, seen for each bucket that a task has met."""
    names = ["doc_id", *ROW, "n", "node", "low", *SKETCH, "bucket", "seen"]
    schema = pa.schema([(c, pa.int64()) for c in names])

    def run(batches):
        known, seen, held, waiting = _Hashes(), np.zeros(BUCKETS, np.int64), [], 0
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                own = np.zeros((3 + len(SKETCH), part.num_rows), np.int64)
                for i, t in enumerate(part.column(3).to_pylist()):
                    s = shingle_set(t, known, shingle)
                    if len(s):
                        node = _mix(_mix(s).sum(keepdims=True) + np.uint64(len(s)))
                        own[:, i] = [len(s), *node.view(np.int64), *s[:1].view(np.int64), *_ranges(s).view(np.int64), *_parities(s).view(np.int64)]
                        held.append((s & np.uint64(BUCKETS - 1)).astype(np.int64))
                        waiting += len(s)
                    if waiting > _FLUSH:
                        seen += np.bincount(np.concatenate(held), minlength=BUCKETS)
                        held, waiting = [], 0
                none = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(1), part.column(2), *map(pa.array, own), none, none], schema=schema)
        if held:
            seen += np.bincount(np.concatenate(held), minlength=BUCKETS)
        at = np.flatnonzero(seen)
        for k in range(0, len(at), 1 << 16):
            part = at[k:k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(part), pa.int64())] * (len(names) - 2) + [pa.array(part), pa.array(seen[part])], schema=schema)

    d = need(docs, "doc_id", "text").select("doc_id", *row_key(), "text")
    return d.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def bucket_counts(classes: DataFrame) -> np.ndarray:
    """``BUCKETS`` counts: a table of fixed size."""
    rows = classes.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("seen").alias("seen"))
    got = rows.select(F.col("bucket").cast("int").alias("bucket"), "seen").toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("seen").to_numpy()
    return np.minimum(out, np.iinfo(np.uint32).max).astype(np.uint32)


# ------------------------------------------------------------ candidates

def prefixes(docs: DataFrame, counts: np.ndarray, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """key, node, n, pos of each row's prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    names = ["key", "node", "n", "pos"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def run(batches):
        known, order, held, waiting = _Hashes(), shared.value, [], 0

        def batch():
            cols = [np.concatenate(c) for c in zip(*held)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for b in batches:
            for k in range(0, b.num_rows, 256):
                for t in b.slice(k, 256).column(0).to_pylist():
                    s = shingle_set(t, known, shingle)
                    n = len(s)
                    if not n:
                        continue
                    node = _mix(_mix(s).sum(keepdims=True) + np.uint64(n)).view(np.int64)
                    p = prefix_length(n, percent)
                    rare = s[np.lexsort((s, order[(s & np.uint64(BUCKETS - 1)).astype(np.int64)]))[:p]]
                    held.append((rare.view(np.int64), np.repeat(node, p), np.full(p, n), np.arange(p)))
                    waiting += p
                    if waiting > 1 << 16:
                        yield batch()
                        held, waiting = [], 0
        if held:
            yield batch()

    return need(docs, "text").mapInArrow(run, "key long, node long, n int, pos int")


def _differ(a: str, b: str) -> Column:
    """A number of members that are in one of the two sets only, at least: the differences of the range counts, and
    the classes of which one set has an odd and the other an even number."""
    total, odd = F.lit(0), F.lit(0)
    for i in range(BITS_OF_SET // 64):
        odd = odd + F.bit_count(F.col(f"{a}.p{i}").bitwiseXOR(F.col(f"{b}.p{i}")))
    for i in range(RANGES):
        byte = lambda side: F.shiftright(F.col(f"{side}.r{i // 8}"), 8 * (i % 8)).bitwiseAND(F.lit(255))  # noqa: B023, E731
        total = total + F.abs(byte(a) - byte(b))
    return F.greatest(total.cast("long"), odd.cast("long"))


def shared_rows(prefix: DataFrame, nodes: DataFrame) -> DataFrame:
    """Prefix rows of shingles that two classes share, once for each class, with ``_ranges`` and the class's shared
    shingles before (before1, before2): a written table."""
    shared = prefix.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where(
        F.col("lo") < F.col("hi")).select("key")
    rows = prefix.join(shared, "key", "left_semi").distinct()
    rows = rows.join(nodes.select("node", *SKETCH), "node")
    by = Window.partitionBy("node").orderBy("pos")
    return materialize(rows.withColumn("before1", F.lag("key", 1).over(by)).withColumn("before2", F.lag("key", 2).over(by)), "ngram_rows")


def _filters(percent: int) -> Column:
    """Length, position and suffix filter of a match of rows a and b."""
    need_ = needed(F.col("a.n"), F.col("b.n"), percent)
    rest = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))
    return ((100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")) & (rest >= need_)
            & (_differ("a", "b") <= F.col("a.n") + F.col("b.n") - 2 * need_))


def neighbours(rows: DataFrame, percent: int = PERCENT, dense: int = DENSE) -> DataFrame:
    """Candidate pairs (a, b) of a shingle's rows that are next to each other by size, and in a random order: in
    number as the rows.  A shingle with more than ``dense`` rows is cut into parts."""
    parts = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / dense).cast("long").alias("parts")).where("parts > 1")
    r = rows.join(parts, "key", "left").withColumn("part", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))))
    row = F.struct("node", "n", "pos", *SKETCH)
    found = []
    for order in (["n", "node"], [F.xxhash64("node", "key")]):
        next_ = F.lead(row).over(Window.partitionBy("key", "part").orderBy(*order))
        pair = r.select(row.alias("a"), next_.alias("b")).where(F.col("b").isNotNull() & _filters(percent))
        found.append(pair.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")))
    return found[0].unionByName(found[1]).distinct()


def candidates(rows: DataFrame, percent: int = PERCENT, dense: int = DENSE, labels: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of classes, a < b, that share a prefix shingle and pass the filters; each once.  With ``labels``
    (node, label; others are labelled by themselves): only pairs of different labels."""
    if labels is not None:
        rows = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        open_ = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where(F.col("lo") < F.col("hi")).select("key")
        rows = materialize(rows.join(open_, "key", "left_semi"), "ngram_open")
    left, right = dealt(rows, "key", "node", dense)
    a, b = left.alias("a"), right.alias("b")
    met = F.lit(False)
    for i in (1, 2):
        for j in (1, 2):
            met = met | F.coalesce(F.col(f"a.before{i}") == F.col(f"b.before{j}"), F.lit(False))
    on = ((F.col("a.key") == F.col("b.key")) & (F.col("a.cell_r") == F.col("b.cell_r")) & (F.col("a.cell_c") == F.col("b.cell_c"))
          & (F.col("a.node") < F.col("b.node")) & ~met & _filters(percent))
    if labels is not None:
        on = on & (F.col("a.label") != F.col("b.label"))
    return a.join(b, on).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


# ------------------------------------------------------------ verification

def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
             block: int = BLOCK) -> DataFrame:
    """The ``pairs`` whose sets' similarity reaches the threshold."""
    own = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    own = nodes.join(own, "node", "left_semi").select("node", "n", "low", *ROW)
    parts = own.groupBy("low").agg(F.ceil(F.sum("n") / block).alias("parts"))
    own = materialize(own.join(parts, "low").select(
        "node", *ROW, F.xxhash64("low", F.pmod(F.xxhash64("node"), F.col("parts"))).alias("block")), "ngram_blocks")
    at = own.select("node", "block")
    cells = (pairs.join(at.toDF("a", "block_a"), "a").join(at.toDF("b", "block_b"), "b")
             .select("a", "b", F.xxhash64(F.least("block_a", "block_b"), F.greatest("block_a", "block_b")).alias("cell")))
    cells = materialize(cells, "ngram_cells")
    to = cells.select(F.col("a").alias("node"), "cell").unionByName(cells.select(F.col("b").alias("node"), "cell")).distinct()
    to = to.groupBy("node").agg(F.collect_list("cell").alias("cells")).join(own.select("node", *ROW), "node")
    # Sets of candidates only: a bit table of fixed size lets all of them pass and holds most other rows back.
    bits = docs.sparkSession.sparkContext.broadcast(bit_table(own.select(F.col(ROW[0]).alias("term"))))

    def sets(batches):
        known, table = _Hashes(), np.frombuffer(bits.value, np.uint8)
        for b in batches:
            at = b.column(0).to_numpy() & (BITS - 1)
            b = b.filter(pa.array(table[at >> 3] >> (at & 7) & 1 == 1))
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                members = [shingle_set(t, known, shingle).tobytes() for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(members, pa.binary())], names=[*ROW, "members"])

    texts = need(docs, "doc_id", "text").select(*row_key(), "text")
    found = texts.mapInArrow(sets, f"{ROW[0]} long, {ROW[1]} long, members binary")
    # Rows that agree in id and text have one set.
    members = found.join(to, list(ROW)).dropDuplicates([*ROW, "node"]).select(
        F.explode("cells").alias("cell"), F.col("node").alias("a"), "members")
    none = F.lit(None).cast("long").alias("b")
    rows = members.select("cell", F.lit(0).alias("kind"), "a", none, "members").unionByName(
        cells.select("cell", F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("binary").alias("members")))

    def compare(batches):
        here, held = None, {}
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 256):
                for cell, kind, a, b, members in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns]):
                    if cell != here:
                        here, held = cell, {}
                    if kind == 0:
                        held[a] = np.frombuffer(members, np.uint64)
                        continue
                    x, y = sorted((held[a], held[b]), key=len)
                    place = np.searchsorted(y, x)
                    common = int(np.count_nonzero(y[np.minimum(place, len(y) - 1)] == x))
                    if 100 * common >= percent * (len(x) + len(y) - common):
                        out.append((a, b))
            cols = zip(*out) if out else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b"])

    return rows.repartition("cell").sortWithinPartitions("cell", "kind").mapInArrow(compare, "a long, b long")


class Join:
    """``rows``: doc_id, row1, row2, n, node of each row; ``nodes``: classes with node, n, copies, row1, row2 (of one of
    its rows); ``shared``: the prefix rows that can match."""

    def __init__(self, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT):
        self.docs, self.shingle, self.percent = docs, shingle, percent
        found = materialize(class_table(docs, shingle), "ngram_classes")
        self.rows = found.where(F.col("bucket").isNull()).drop("bucket", "seen")
        own = self.rows.where("n > 0").groupBy("node").agg(
            F.first("n").alias("n"), F.first("low").alias("low"), *[F.first(c).alias(c) for c in SKETCH],
            F.count(F.lit(1)).alias("copies"), F.min(F.struct(*ROW)).alias("row"))
        self.nodes = materialize(own.select("*", "row.*").drop("row"), "ngram_nodes")
        prefix = materialize(prefixes(docs, bucket_counts(found), shingle, percent), "ngram_prefixes")
        self.shared = shared_rows(prefix, self.nodes)

    def _verified(self, pairs: DataFrame) -> DataFrame:
        return materialize(verified(self.docs, self.nodes, pairs, self.shingle, self.percent), "ngram_links")

    def links(self) -> DataFrame:
        """All pairs (a, b) of classes that link: their number can be the square of a group's."""
        return self._verified(materialize(candidates(self.shared, self.percent), "ngram_pairs"))

    def connecting(self) -> DataFrame:
        """Links that give the same components as all of them.  Neighbours among a shingle's rows are verified
        first; then all candidates whose classes are not connected by those.  No other link can join two components."""
        near = materialize(neighbours(self.shared, self.percent), "ngram_near")
        first = self._verified(near)
        rest = candidates(self.shared, self.percent, labels=components(first)).join(near, ["a", "b"], "left_anti")
        return first.unionByName(self._verified(materialize(rest, "ngram_pairs")))


def digest(join: Join) -> DataFrame:
    """doc_id, n_shingles, component_id of each row."""
    labelled = (join.nodes.select("node").join(components(join.connecting()), "node", "left")
                .select("node", F.coalesce("label", "node").alias("label")))
    first = join.rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    labelled = labelled.join(first, "node")
    named = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_node = materialize(labelled.join(named, "label").select("node", "component_id"), "ngram_components")
    alone = F.col("n") == 0
    # Rows without words are kept apart from the classes, by a key that no class has.
    rows = join.rows.select("doc_id", "n", F.when(~alone, F.col("node")).alias("node"))
    return rows.join(by_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def counted(join: Join) -> DataFrame:
    """doc_id, n_links of each row: the rows that it links with, those of its own class included."""
    links = join.links()
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(join.nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    n = join.nodes.join(others.withColumnRenamed("a", "node"), "node", "left").select(
        "node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    rows = join.rows.select("doc_id", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    return rows.join(n, "node", "left").select("doc_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
