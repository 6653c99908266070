"""Merkle dataset manifest as a persistent tree with path copying (operator 13).

Each row is a leaf: SHA-256 over its fields.  A source's leaves, in ascending
order of doc_id, are hashed in runs of ``RUN`` until one node is left, the
source's subroot; the subroots, ordered by source, are hashed alike to the
root.

The tree is built in rounds over aligned blocks of ``RUN ** DEPTH`` nodes: a
task reads a block's nodes in order and passes its top node on, so a round
shrinks the nodes 4096 times and a source of any size is spread over its
blocks.  Going down again, each block gets the path of its top node: for each
level above, the digests left and right of it in its run.  It is one row
for each block, never for each leaf.

The base tree is never changed.  A changed leaf makes a *version*: inside its
block the ancestors are copied with the new digest and all other nodes are
shared with the base; above the block the version goes on along the block's
path, again copying one node a level.  ``copied`` holds a version's own nodes,
its leaf first and its root last.  A row that was not changed is folded in the
same way from its own leaf, which checks its proof.

Defined cases: null fields hash as ``-``; a null source is a source of its own,
the first; rows without id come first in their source and count as not
tampered; rows equal in source and id are ordered by their leaves (equal leaves
are interchangeable); a lone leaf is its source's subroot, a lone subroot the
root; an empty table gives an empty result; only doc_id, source, lang, n_chars
and text are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosecast.llm.common import need
from dosecast.llm.dealing import numbered
from dosecast.session import materialize

RUN = 16
DEPTH = 3                     # levels of a block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_BATCH = 2048


def leaf_digest(text: Column | None = None) -> Column:
    """SHA-256 of a row's fields, each ``-`` or its length in bytes, a colon and its value."""
    def field(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[field(F.col(f) if f != "text" or text is None else text) for f in FIELDS]), 256)


def tampered() -> Column:
    """Rows whose text the query tampers with."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame, changed: Column | None = None, text: Column | None = None) -> DataFrame:
    """doc_id, src (the source, ``s`` before it; empty for null), leaf, new_leaf (where ``changed``: with ``text``
    for the text; else null)."""
    d = need(docs, *FIELDS)
    new = F.when(changed, leaf_digest(text)) if changed is not None else F.lit(None).cast("string")
    src = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    return d.select("doc_id", src.alias("src"), leaf_digest().alias("leaf"), new.alias("new_leaf"))


# ------------------------------------------------------------ one block

def _h(parts: str) -> str:
    return sha256(parts.encode()).hexdigest()


def height(n: int, run: int = RUN) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // run), h + 1
    return h


class Tree:
    """The nodes of an aligned block, level by level."""

    def __init__(self, digests: list[str], levels: int, run: int = RUN):
        self.run, self.levels = run, [digests]
        for _ in range(levels):
            low = self.levels[-1]
            self.levels.append([_h("".join(low[i:i + run])) for i in range(0, len(low), run)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, i: int) -> list[tuple[str, str]]:
        """The digests left and right of leaf ``i`` and of its ancestors in their runs, up to the top."""
        out = []
        for low in self.levels[:-1]:
            at = i % self.run
            run = low[i - at:i - at + self.run]
            out.append(("".join(run[:at]), "".join(run[at + 1:])))
            i //= self.run
        return out


def copies(leaf: str, path: list[tuple[str, str]]) -> list[str]:
    """A version's own nodes: the new leaf and a copy of each ancestor, up to the root; the rest is shared."""
    out = [leaf]
    for left, right in path:
        out.append(_h(left + out[-1] + right))
    return out


# ------------------------------------------------------------ rounds over blocks

def _streamed(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Groups of rows that agree in the first ``keys`` columns, which lie together."""
    rows = (r for b in batches for at in range(0, b.num_rows, _BATCH)
            for r in zip(*[c.to_pylist() for c in b.slice(at, _BATCH).columns]))
    return groupby(rows, key=lambda r: r[:keys])


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _by_block(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("src", "block").sortWithinPartitions("src", "block", *order)


def _block() -> Column:
    return F.floor(F.col("idx") / RUN ** DEPTH).cast("long").alias("block")


def next_round(nodes: DataFrame) -> DataFrame:
    """``nodes`` (src, n, idx, digest) with n > 1 -> the top nodes of their blocks, in the same columns."""
    schema = pa.schema([("src", pa.string()), ("n", pa.int64()), ("idx", pa.int64()), ("digest", pa.string())])

    def run(batches):
        def tops():
            for (src, block, n), rows in _streamed(batches, 3):
                yield src, -(-n // RUN ** DEPTH), block, Tree([r[4] for r in rows], min(DEPTH, height(n))).top
        yield from _batched(tops(), schema)

    rows = _by_block(nodes.select("src", _block(), "n", "idx", "digest"), "idx")
    return rows.mapInArrow(run, "src string, n long, idx long, digest string")


def rounds(nodes: DataFrame, name: str) -> list[DataFrame]:
    """``nodes`` and the rounds above, each a written table with the nodes of unfinished groups only, and last
    the tops (src, digest) of all groups."""
    out, tops = [], []
    while True:
        tops.append(nodes.where("n = 1").select("src", "digest"))
        nodes = nodes.where("n > 1")
        if nodes.isEmpty():
            break
        out.append(nodes)
        nodes = materialize(next_round(nodes), name)
    top = tops[0]
    for t in tops[1:]:
        top = top.unionByName(t)
    return [*out, top]


_PATH = "src string, idx long, lefts array<string>, rights array<string>, subroot string, root string"


def paths_below(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """The paths of a round's nodes from those of the nodes above them (``_PATH``); nodes of groups that end in this
    round, or have one node, take the path that ``above`` has for index 0."""
    strings = pa.list_(pa.string())
    schema = pa.schema([("src", pa.string()), ("idx", pa.int64()), ("lefts", strings), ("rights", strings),
                        ("subroot", pa.string()), ("root", pa.string())])

    def run(batches):
        def paths():
            for (src, _), rows in _streamed(batches, 2):
                up = next(rows)
                base = list(rows)
                tree = Tree([r[4] for r in base], min(DEPTH, height(base[0][5])))
                for i, r in enumerate(base):
                    own = tree.path(i)
                    yield (src, r[3], [x for x, _ in own] + up[6], [x for _, x in own] + up[7], up[8], up[9])
        yield from _batched(paths(), schema)

    return _joined(nodes, above).mapInArrow(run, _PATH)


def _joined(nodes: DataFrame, above: DataFrame, *extra: str) -> DataFrame:
    """Rows of a block behind the row of its path, sorted: src, block, kind, idx, digest, n, lefts, rights, subroot,
    root and ``extra`` columns of ``nodes``."""
    none = lambda kind: F.lit(None).cast(kind)
    low = nodes.select("src", _block(), F.lit(1).alias("kind"), "idx", "digest", "n", none("array<string>").alias("lefts"),
                       none("array<string>").alias("rights"), none("string").alias("subroot"), none("string").alias("root"), *extra)
    up = above.select("src", F.col("idx").alias("block"), F.lit(0).alias("kind"), none("long").alias("idx"),
                      none("string").alias("digest"), none("long").alias("n"), "lefts", "rights", "subroot", "root",
                      *[none(low.schema[c].dataType.simpleString()).alias(c) for c in extra])
    return _by_block(up.unionByName(low), "kind", "idx")


# ------------------------------------------------------------ the manifest

class Manifest:
    """The base tree of a table: ``leaves`` (src, doc_id, idx, n, digest, new_leaf), ``subroots`` (src, idx, digest),
    ``root`` (one row: digest; none for an empty table) and ``paths`` of the blocks of leaves."""

    def __init__(self, rows: DataFrame):
        """``rows``: as ``leaves`` returns them."""
        order = [F.col("doc_id").asc_nulls_first(), F.col("leaf")]
        own = numbered(rows, "src", order, lambda d: materialize(d, "merkle_sorted"))
        self.leaves = materialize(own.withColumnRenamed("leaf", "digest"), "merkle_leaves")
        low = rounds(self.leaves.select("src", "n", "idx", "digest"), "merkle_round")
        tops = numbered(low.pop().withColumn("all", F.lit("")), "all", [F.col("src")], lambda d: materialize(d, "merkle_tops"))
        self.subroots = materialize(tops.select("src", "n", "idx", "digest"), "merkle_subroots")
        high = rounds(self.subroots.withColumn("src", F.lit("")), "merkle_upper")
        self.root = high.pop().select("digest")
        self._rounds, self._upper = low, high

    def paths(self) -> DataFrame:
        """``_PATH`` for each block of leaves; of a source with one leaf: for that leaf."""
        empty = F.array().cast("array<string>")
        up = self.root.select(F.lit("").alias("src"), F.lit(0).cast("long").alias("idx"), empty.alias("lefts"),
                              empty.alias("rights"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
        for nodes in reversed(self._upper):
            up = materialize(paths_below(nodes, up), "merkle_paths")
        s = self.subroots.select("src", "idx", F.col("digest").alias("subroot"))
        done = up.drop("subroot", "src").join(s, "idx").select(
            "src", F.lit(0).cast("long").alias("idx"), "lefts", "rights", "subroot", "root")
        for nodes in reversed(self._rounds[1:]):
            # Groups that ended below this round keep their path.
            here = nodes.select("src").distinct()
            down = paths_below(nodes, done.join(here, "src", "left_semi"))
            done = materialize(down.unionByName(done.join(here, "src", "left_anti")), "merkle_paths")
        return done

    def versions(self) -> DataFrame:
        """For each row: doc_id, src, leaf, subroot, root, proof_sha256, changed, copied."""
        schema = pa.schema([("doc_id", pa.int64()), ("src", pa.string()), ("leaf", pa.string()), ("subroot", pa.string()),
                            ("root", pa.string()), ("proof_sha256", pa.string()), ("changed", pa.bool_()),
                            ("copied", pa.list_(pa.string()))])

        def run(batches):
            def out():
                for (src, _), rows in _streamed(batches, 2):
                    up = next(rows)
                    above = list(zip(up[6], up[7]))
                    proof_above = "".join(a + b for a, b in above)
                    base = list(rows)
                    tree = Tree([r[4] for r in base], min(DEPTH, height(base[0][5])))
                    for i, r in enumerate(base):
                        own = tree.path(i)
                        proof = _h("".join(a + b for a, b in own) + proof_above)
                        new = r[11]
                        yield (r[10], src, r[4], up[8], up[9], proof, new is not None,
                               copies(r[4] if new is None else new, own + above))
            yield from _batched(out(), schema)

        rows = _joined(self.leaves, self.paths(), "doc_id", "new_leaf")
        return rows.mapInArrow(run, "doc_id long, src string, leaf string, subroot string, root string, proof_sha256 string, "
                                    "changed boolean, copied array<string>")


def manifest(docs: DataFrame, changed: Column | None = None, text: Column | None = None) -> Manifest:
    """The manifest of ``docs``; rows where ``changed`` holds get a version in which ``text`` is their text."""
    return Manifest(leaves(docs, changed, text))


def digest(m: Manifest) -> DataFrame:
    v = m.versions()
    folded = F.element_at("copied", -1)
    return v.select("doc_id", "leaf", "subroot", "root", "proof_sha256", folded.alias("folded_root"),
                    (folded == F.col("root")).alias("verified"))
