"""Token ids as length-delimited binary records (operator 4).

File format.  A shard ``<name>.rec`` is a row of records; each is

    u64  length of the payload
    u32  masked checksum of those 8 bytes
    payload
    u32  masked checksum of the payload

all little-endian, and a payload is ``u8`` flags (1: the document has an id),
``u8`` bytes for each token id (2 or 4), ``i64`` document id (0 without one),
then the ids.  Checksums are CRC-32, rotated right by 15 bits plus a constant,
so that a checksum stored among checked data does not check itself.
``<name>.idx`` holds the byte offset of every record as ``u64``, so a training
job can read records in any order.

Shards are written in ascending document id (null first): documents are dealt
to ranges and sorted inside them, each task writes one shard under a name of
its own attempt, and the list of shards is a table that Spark commits, so that
files of lost or repeated attempts are never read.

Defined cases: a null text is an empty one (only the end id is written); rows
are written one by one, so repeated rows and ids give a record each, in the
order of id, then text; an empty table gives no shard; columns beyond
``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dosecast.llm import bpe
from dosecast.llm.common import need, partitions
from dosecast.session import scratch_path

MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
DOC = struct.Struct("<BBq")
CRC = struct.Struct("<I")
SHARDS = "shard long, path string, n_records long, n_ids long, n_bytes long"
RECORDS = "shard long, pos long, doc_id long, n_tokens long, ids binary"
READ_BYTES = 32 << 20


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, CRC.pack(masked_crc(length)), payload, CRC.pack(masked_crc(payload))))


def payload(doc: int | None, width: int, ids: bytes) -> bytes:
    return DOC.pack(doc is not None, width, doc or 0) + ids


def filesystem(path: str):
    """File system and path on it, for any address that pyarrow knows (file, hdfs, s3, gs)."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark writes it to, for the tasks' own writers."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return "file:///" + full[5:].lstrip("/") if full.startswith("file:") else full


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, units: int | None = None) -> DataFrame:
    """Encode and write ``docs`` (doc_id, text); the committed shard table (shard, path, counts)."""
    spark = docs.sparkSession
    folder = qualified(spark, folder or scratch_path(spark, f"records-{uuid.uuid4().hex}"))
    spec = spark.sparkContext.broadcast(bpe.read_spec(tokenizer_path))

    def run(batches):
        tokenizer = bpe.load(spec.value, units)
        end = np.array([end_id], tokenizer.dtype).tobytes()
        width = tokenizer.dtype.itemsize
        shard = TaskContext.get().partitionId()
        name = f"part-{shard:06d}-{TaskContext.get().taskAttemptId()}"
        fs, root = filesystem(folder)
        out, offsets, at, n_ids = None, [], 0, 0
        for b in batches:
            for k in range(0, b.num_rows, 256):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name}.rec")
                some = b.slice(k, 256).to_pydict()
                for doc, text in zip(some["doc_id"], some["text"]):
                    ids = tokenizer.encode(text or "") + end
                    rec = frame(payload(doc, width, ids))
                    offsets.append(at)
                    out.write(rec)
                    at += len(rec)
                    n_ids += len(ids) // width
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{root}/{name}.idx") as f:
                f.write(np.array(offsets, "<u8").tobytes())
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": f"{folder}/{name}", "n_records": len(offsets),
                                               "n_ids": n_ids, "n_bytes": at}],
                                             schema=pa.schema([("shard", pa.int64()), ("path", pa.string()),
                                                               ("n_records", pa.int64()), ("n_ids", pa.int64()),
                                                               ("n_bytes", pa.int64())]))

    # Ids and texts in one order: equal ids may still go to several ranges.
    dealt = (need(docs, "doc_id", "text")
             .repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    dealt.mapInArrow(run, SHARDS).write.mode("overwrite").parquet(f"{folder}/shards")
    return spark.read.schema(SHARDS).parquet(f"{folder}/shards")


def records_of(data: memoryview) -> list[tuple]:
    """(document id, ids as little-endian u32 bytes) of the records in ``data``; raises on a bad checksum."""
    out, at = [], 0
    while at < len(data):
        n, crc = HEAD.unpack_from(data, at)
        if crc != masked_crc(bytes(data[at:at + 8])):
            raise ValueError("a record's length fails its checksum")
        body = bytes(data[at + HEAD.size:at + HEAD.size + n])
        if CRC.unpack_from(data, at + HEAD.size + n)[0] != masked_crc(body):
            raise ValueError("a record fails its checksum")
        has_id, width, doc = DOC.unpack_from(body)
        ids = body[DOC.size:]
        out.append((doc if has_id else None, ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()))
        at += HEAD.size + n + CRC.size
    return out


def read_shards(shards: DataFrame, reduce_ids=None, value: str = "ids binary") -> DataFrame:
    """Every record: shard, position in it, doc_id, n_tokens and its ids (u32, little-endian), or
    ``reduce_ids(ids)`` in their place.  Blocks of records are found through the offset index."""
    field = pa.field(value.split()[0], {"binary": pa.binary(), "long": pa.int64()}[value.split()[1]])
    schema = pa.schema([("shard", pa.int64()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), field])

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                fs, path = filesystem(row["path"])
                with fs.open_input_file(f"{path}.idx") as f:
                    offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
                ends = np.append(offsets[1:], row["n_bytes"])
                with fs.open_input_file(f"{path}.rec") as f:
                    at = 0
                    while at < len(offsets):
                        to = max(at + 1, int(np.searchsorted(ends, offsets[at] + READ_BYTES, "right")))
                        recs = records_of(memoryview(f.read_at(int(ends[to - 1] - offsets[at]), int(offsets[at]))))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row["shard"]] * len(recs), pa.int64()), pa.array(range(at, to), pa.int64()),
                             pa.array([d for d, _ in recs], pa.int64()), pa.array([len(i) // 4 for _, i in recs], pa.int64()),
                             pa.array([reduce_ids(i) if reduce_ids else i for _, i in recs], field.type)], schema=schema)
                        at = to

    n = max(1, min(partitions(shards.sparkSession), 10_000))
    return shards.repartition(n).mapInArrow(run, f"shard long, pos long, doc_id long, n_tokens long, {value}")


def positions(shards: DataFrame, records: DataFrame) -> DataFrame:
    """``records`` with ``start``: the number of ids in all records before.  Shards hold whole ranges, so
    the sums run over the shard table (one row a shard) and inside each shard."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    base = shards.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    own = records.withColumn("own", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return own.join(base, "shard").withColumn("start", F.col("base") + F.col("own")).drop("base", "own")


def digest(docs: DataFrame, tokenizer_path: str, end_id: int = 2, units: int | None = None) -> DataFrame:
    """Write ``docs``, read the files back, and give each record's place, length and checksum of ids."""
    shards = write_shards(docs, tokenizer_path, end_id, units=units)
    read = read_shards(shards, zlib.crc32, "ids_crc32 long")
    return positions(shards, read).select("doc_id", "start", "n_tokens", "ids_crc32")
