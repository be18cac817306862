"""Token ids of documents in compressed, checksummed files that decode in parallel."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapstrata.llm.common import shuffle_cleanup, stored
from snapstrata.llm.pieces import PieceEncoder
from snapstrata.llm.rans import Block, FrequencyTable, decode_block, encode_block, scaled_frequencies
from snapstrata.llm.words import text_chunks
from snapstrata.session import scratch_dir
from snapstrata.sources.folders import remove

#: A block takes whole documents until it holds so many ids; a longer document is one block.
BLOCK_TOKENS = 1 << 17
END_ID = 2
#: Bytes of text encoded at once; arrays of eight bytes for each byte of text stand beside them.
TEXT_BYTES = 1 << 19

BLOCKS = (
    "part int, begin long, n long, lanes int, doc_ids array<bigint>, sizes array<bigint>, "
    "states binary, offsets array<bigint>, stream binary, checksum long"
)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of every document, where its row is read."""

    def run(batches):
        encoder = PieceEncoder.shared(tokenizer)
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column("text"), TEXT_BYTES):
                tokens, sizes = encoder.encode(data, offsets, end_id)
                kind, width = ("<u4", 4) if encoder.wide else ("<u2", 2)
                ends = np.concatenate(([0], np.cumsum(sizes))) * width
                cut = pa.Array.from_buffers(
                    pa.large_binary(), len(sizes),
                    [None, pa.py_buffer(ends.astype("<i8")), pa.py_buffer(tokens.astype(kind))],
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(sizes)), pa.array(sizes), cut.cast(pa.binary())],
                    ["doc_id", "n_tokens", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def in_order(tokens: DataFrame) -> DataFrame:
    """``tokens`` in ascending id order, each task holding a range of ids; what is sorted are ids, not texts.

    Rows with a null id come first; rows that share an id, however many, go by a hash of
    their ids and then by the ids.
    """
    keyed = tokens.withColumn("key", F.xxhash64("ids"))
    return keyed.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key", "ids").drop("key")


def _ids(raw: bytes | memoryview, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def id_counts(tokens: DataFrame) -> DataFrame:
    """``(id, n)`` over all documents, summed in the tasks first."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            column = batch.column("ids").cast(pa.large_binary())
            sizes = batch.column("n_tokens").to_numpy()
            offsets = np.frombuffer(column.buffers()[1], "<i8")[column.offset : column.offset + len(column) + 1]
            if not len(sizes):
                continue
            # All documents of a file have ids of one width.
            raw = memoryview(column.buffers()[2])[int(offsets[0]) : int(offsets[-1])]
            own = np.bincount(_ids(raw, int(sizes.sum())))
            if len(own) > len(total):
                total = np.concatenate((total, np.zeros(len(own) - len(total), np.int64)))
            total[: len(own)] += own
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], ["id", "n"])

    return tokens.select("n_tokens", "ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _table(frequencies: DataFrame) -> FrequencyTable:
    """The shared table; it has a row for each id of the vocabulary at most."""
    rows = frequencies.toArrow()
    ids, freq = rows.column("id").to_numpy(), rows.column("freq").to_numpy()
    dense = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
    dense[ids] = freq
    return FrequencyTable.of(dense)


def _blocks(ordered: DataFrame, table: FrequencyTable) -> DataFrame:
    """Coded blocks of sorted documents; a task's rows are a part, and ``begin`` counts the ids before within it.

    Places are counted by the worker that codes: a step of their own would need a second worker
    in each task, which stays afterwards with all that it comes to hold.
    """
    shared = ordered.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        table, part = shared.value, TaskContext.get().partitionId()
        docs, sizes, ids, begin, held = [], [], [], 0, 0

        def flush():
            block = encode_block(np.concatenate(ids), table)
            row = [
                [part], [begin], [block.n], [block.lanes], [list(docs)], [list(sizes)], [block.states],
                [block.offsets], [block.stream], [block.checksum()],
            ]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.int64()]
            names = [x.split(" ")[0] for x in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], names)

        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "n_tokens", "ids")]
            for doc, n, raw in zip(*columns, strict=True):
                if held >= BLOCK_TOKENS:
                    yield flush()
                    docs, sizes, ids, begin, held = [], [], [], begin + held, 0
                docs.append(doc.as_py())
                sizes.append(n.as_py())
                ids.append(_ids(raw.as_py(), sizes[-1]))
                held += sizes[-1]
        if docs:
            yield flush()

    return ordered.select("doc_id", "n_tokens", "ids").mapInArrow(run, BLOCKS)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the ids of all documents below ``path``, in ascending id order.

    ``path/table`` holds the shared frequencies, ``path/blocks`` one row for each
    block: its part and first position within that, its documents and their sizes, and the
    coded ids with checkpoints and a checksum. Parts follow each other by number. Frequencies
    count all ids of all documents. A null or empty text is its end id alone; an empty table
    gives empty files.
    """
    spark = docs.sparkSession
    tokens_path = scratch_dir(spark, "token-ids")
    tokens = stored(tokenize(docs, tokenizer, end_id), "token-ids", tokens_path)
    counted = id_counts(tokens).toArrow()
    ids = counted.column("id").to_numpy()
    dense = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
    dense[ids] = counted.column("n").to_numpy()
    freq = scaled_frequencies(dense)
    rows = pa.table({"id": pa.array(np.flatnonzero(freq).astype(np.int32)), "freq": pa.array(freq[freq > 0])})
    with shuffle_cleanup(spark):
        spark.createDataFrame(rows).coalesce(1).write.parquet(f"{path}/table")
        _blocks(in_order(tokens), FrequencyTable.of(freq)).write.parquet(f"{path}/blocks")
    remove(spark, tokens_path)


class DamagedBlock(ValueError):
    """A block's bytes do not have the checksum written with them."""


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from the files, ``ids`` as little-endian 32-bit numbers.

    Blocks decode independently of each other, and each from all its checkpoints at
    once. A block whose checksum does not fit fails the read.
    """
    table = _table(spark.read.schema("id int, freq long").parquet(f"{path}/table"))
    shared = spark.sparkContext.broadcast(table)

    def run(batches):
        table = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                get = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                block = Block(get["n"], get["lanes"], get["states"], get["offsets"], get["stream"])
                if block.checksum() != get["checksum"]:
                    raise DamagedBlock(f"block at {get['start']} of {path}")
                raw = decode_block(block, table).astype("<u4").tobytes()
                ends = np.cumsum(get["sizes"])
                sizes = np.array(get["sizes"], np.int64)
                cut = [raw[4 * (e - s) : 4 * e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(get["doc_ids"], pa.int64()), pa.array(get["start"] + ends - sizes),
                     pa.array(sizes), pa.array(cut, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range of ids: the running sum over them is small.
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    blocks = blocks.join(offsets, "part").withColumn("start", F.col("base") + F.col("begin")).drop("part", "begin", "base")
    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def id_checksums(decoded: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)``."""
    return decoded.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


