"""SimHash near-duplicates with pivot distance tables (operator 6).

Fingerprints: 64 majority bits of the XXH64 hashes of a text's word shingles.
Texts with equal fingerprints are one node.  For every node the Hamming
distances to ``PIVOTS`` reference fingerprints are computed once.  By the
triangle inequality two fingerprints within ``bits`` of each other differ by
at most ``bits`` in each of these distances, so a candidate pair is discarded
when any coordinate differs by more, and survivors are verified bit by bit.

Distances to random references alone make no equi-join key (they crowd around
32), so candidates come from an exact cover: the 64 bits are cut into
``bits + 2`` blocks, and fingerprints within ``bits`` agree on at least two
blocks.  Nodes are joined on each pair of blocks; the pivot test and the
verification are the join's condition, so only survivors leave the join, each
pair once (at its first pair of equal blocks).  A key with more than
``DENSE`` nodes is dealt out over a grid of cells, so that no task holds all
of it.

Defined cases: a null or empty text has fingerprint zero and links like any
other; rows with equal or null ids are allowed (a component's id is the
smallest non-null id in it); an empty table gives an empty result; columns
beyond ``doc_id`` and ``text`` are not read (``near_duplicates``) or are passed
through (``keep_one``).
"""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import ROW, need, row_key, sealed, unsealed
from dosecast.llm.graph import components
from dosecast.session import materialize

PIVOTS = 16
DENSE = 2048
SEED = 42
_CHUNK = 1 << 14


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = (text or "").encode().lower().split()      # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        to = min(n, at + _CHUNK)
        h = np.fromiter((digest(b" ".join(words[i:i + shingle]), SEED) for i in range(at, to)), np.uint64, to - at)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, *keys: str) -> DataFrame:
    """doc_id, the long columns ``keys``, fp (the 64 bits as a signed long)."""
    names = ["doc_id", *keys, "fp"]

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                fps = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], np.uint64).view(np.int64)
                own = [part.column(0).cast(pa.int64()), *part.columns[2:]]
                yield pa.RecordBatch.from_arrays([*own, pa.array(fps)], names=names)

    return need(docs, "doc_id", "text", *keys).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_references(n: int = PIVOTS, seed: int = 6) -> list[int]:
    """Reference fingerprints, drawn by a seeded generator."""
    rng = random.Random(seed)
    return [_signed(rng.getrandbits(64)) for _ in range(n)]


def pivot_table(fp: Column, n: int = PIVOTS) -> list[Column]:
    """Distances to the references, eight to a long (one byte each): columns p0, p1, ..."""
    dist = [F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("long") for p in pivot_references(n)]
    out = []
    for i in range(0, n, 8):
        packed = F.lit(0).cast("long")
        for k, d in enumerate(dist[i:i + 8]):
            packed = packed.bitwiseOR(F.shiftleft(d, 8 * k))
        out.append(packed.alias(f"p{i // 8}"))
    return out


def _near_by_pivots(a: str, b: str, bits: int, n: int = PIVOTS) -> Column:
    """No coordinate of the two distance rows differs by more than ``bits``."""
    ok = F.lit(True)
    for i in range(n):
        at = lambda side: F.shiftright(F.col(f"{side}.p{i // 8}"), 8 * (i % 8)).bitwiseAND(F.lit(127))  # noqa: B023, E731
        ok = ok & (F.abs(at(a) - at(b)) <= bits)
    return ok


def blocks(bits: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of ``bits + 2`` nearly equal blocks of the 64 bits."""
    k = bits + 2
    ends = [64 * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def links(nodes: DataFrame, bits: int = 3) -> DataFrame:
    """``nodes`` (fp, distinct) -> pairs (a, b), a < b, of fingerprints within ``bits``, each once."""
    cut = blocks(bits)
    part = lambda fp, i: F.shiftrightunsigned(fp, cut[i][0]).bitwiseAND(F.lit((1 << cut[i][1]) - 1))
    pairs = list(combinations(range(len(cut)), 2))
    fp = F.col("fp")
    keys = F.array(*[F.struct(F.lit(n).alias("k"), (F.shiftleft(part(fp, i), 32).bitwiseOR(part(fp, j))).alias("v"))
                     for n, (i, j) in enumerate(pairs)])
    rows = nodes.select(fp, *pivot_table(fp), F.explode(keys).alias("key")).select("fp", "p0", "p1", "key.k", "key.v")
    # Dense keys: side a goes to one row of a grid of cells, side b to one column.
    dense = rows.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > DENSE).select(
        "k", "v", F.ceil(F.col("n") / DENSE).cast("long").alias("side"))
    rows = rows.join(dense, ["k", "v"], "left").withColumn("side", F.coalesce("side", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("side"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("side") - 1))
    a = rows.select("*", own.alias("r"), every.alias("c")).alias("a")
    b = rows.select("*", own.alias("c"), every.alias("r")).alias("b")
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    equal = [x.bitwiseAND(F.lit(_signed(((1 << size) - 1) << at))) == 0 for at, size in cut]
    # Met at the first two equal blocks: no earlier block than the key's second is equal but its first.
    first = F.lit(True)
    for n, (i, j) in enumerate(pairs):
        for m in range(j):
            if m != i:
                first = first & ((F.col("a.k") != n) | ~equal[m])
    on = ((F.col("a.k") == F.col("b.k")) & (F.col("a.v") == F.col("b.v")) & (F.col("a.r") == F.col("b.r"))
          & (F.col("a.c") == F.col("b.c")) & (F.col("a.fp") < F.col("b.fp")) & first
          & _near_by_pivots("a", "b", bits) & (F.bit_count(x) <= bits))
    return a.join(b, on).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def _labelled(prints: DataFrame, bits: int) -> DataFrame:
    """fp, first_id, label (of the component) for each fingerprint."""
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash_nodes")
    comp = components(links(nodes.select("fp"), bits))
    return (nodes.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
            .withColumn("label", F.coalesce("label", "fp")))


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """doc_id, fp, component_id for each row of ``docs``."""
    prints = materialize(fingerprints(docs, shingle), "simhash_prints")
    labelled = _labelled(prints, bits)
    named = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_print = materialize(labelled.select("fp", "label").join(named, "label").select("fp", "component_id"), "simhash_classes")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def digest(classes: DataFrame) -> DataFrame:
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """One row of each group: the one with the smallest id, of rows that share it the first by the hashes of
    id and text.  A row without an id stays only in a group that has none, chosen by the hashes."""
    own = ("doc_id", "text")
    keyed = need(docs, *own).select(*own, *row_key())
    prints = materialize(fingerprints(keyed, shingle, *ROW), "simhash_prints")
    by_print = materialize(_labelled(prints, bits).select("fp", "label"), "simhash_classes")
    # First by fingerprint, so that copies of a text meet the join as one row.
    first = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW)).alias("first"))
    keep = first.join(by_print, "fp").groupBy("label").agg(F.min("first").alias("first")).select(
        *[F.col(f"first.{k}").alias(k) for k in ROW])
    d = sealed(docs, *own).select("*", *row_key()).join(keep, list(ROW), "left_semi")
    return unsealed(d.dropDuplicates(list(ROW)), docs, *own)
