"""SentencePiece encoding and decoding through a table of distinct chunks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tidemark.llm.common import slices

#: The mark that stands for a space in pieces, as UTF-8.
MARK = "▁"
#: Bytes of text whose chunks are numbered together; a longer text is a block of its own.
BLOCK_BYTES = 16 << 20
#: Bytes of text for each bucket of the chunk table.
BUCKET_BYTES = 32 << 20
#: Blocks, on average, that one task joins with their ids; Spark writes 100,000 such groups of files at most.
TASK_BLOCKS, MOST_GROUPS = 2, 100_000
CHUNK = re.compile(rb" ((?: *[^ ]+)|(?: *\Z))")
BLOCKS = "block long, doc_ids array<long>, counts array<int>, slots binary, chunks array<struct<bucket:int,packed:binary>>"
RESULT = "doc_id long, ids array<int>, decoded string"


def pack(**columns: np.ndarray) -> bytes:
    """Arrays of numbers, of any lengths, as one compressed value."""
    lists = [pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values)) for values in columns.values()]
    batch = pa.RecordBatch.from_arrays(lists, names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(packed: bytes) -> dict[str, np.ndarray]:
    batch = pa.ipc.open_stream(packed).read_next_batch()
    return {name: batch[name].flatten().to_numpy() for name in batch.schema.names}


class Pieces:
    """A model whose pieces never cross from a character into a white-space mark behind it.

    Normalisation of such a model only writes a mark for each space and one before the text. A chunk is a run of marks with the
    characters up to the next mark. No piece, and so no merge, reaches across chunks: the ids of a text are those of its chunks.
    """

    def __init__(self, path: str | None = None) -> None:
        self.model = SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        pieces = (self.model.id_to_piece(k) for k in range(self.model.get_piece_size()))
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece in pieces):
            raise ValueError("pieces of this model cross white-space marks")
        probe = "　ﬁ  Ａ\té \n "
        if self.model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("this model normalises more than white-space marks")
        self.lone = [self.model.piece_to_id(MARK)]
        self.kind = np.uint16 if self.model.get_piece_size() <= 1 << 16 else np.int32

    @staticmethod
    def chunks(text: bytes) -> list[bytes]:
        """The text's chunks, marks as spaces, each without its first mark; none for the empty text."""
        return CHUNK.findall(b" " + text.replace(MARK.encode(), b" ")) if text else []

    def encode_chunks(self, chunks: list[bytes]) -> list[list[int]]:
        """Ids of each chunk. The library puts a mark before every text that is not empty, which is the one cut off."""
        found = self.model.encode([chunk.decode() for chunk in chunks], num_threads=1)
        return [ids or self.lone for ids in found]


@cache
def shared_pieces(path: str | None) -> Pieces:
    return Pieces(path)


def bucket_of(chunk: bytes, buckets: int) -> int:
    return xxhash.xxh32_intdigest(chunk) * buckets >> 32


def _block(number: int, doc_ids: list, texts: list[bytes], buckets: int) -> pa.RecordBatch:
    """Distinct chunks numbered by bucket and then by their bytes, packed bucket by bucket, and the numbers of all texts' chunks."""
    parts = [pa.array(Pieces.chunks(text), pa.binary()) for text in texts]
    counts = [len(part) for part in parts]
    coded = pa.chunked_array(parts, pa.binary()).combine_chunks().dictionary_encode()
    bucket = np.array([bucket_of(chunk, buckets) for chunk in coded.dictionary.to_pylist()], dtype=np.int32)
    columns = pa.table({"bucket": bucket, "chunk": coded.dictionary})
    order = pc.sort_indices(columns, sort_keys=[("bucket", "ascending"), ("chunk", "ascending")]).to_numpy()
    slot = np.empty(len(order), dtype=np.uint32)
    slot[order] = np.arange(len(order), dtype=np.uint32)
    slots = slot[coded.indices.to_numpy(zero_copy_only=False)]
    bucket, chunks = bucket[order], coded.dictionary.take(pa.array(order))
    sent = []
    for k in np.unique(bucket).tolist():
        own = chunks[np.searchsorted(bucket, k, "left") : np.searchsorted(bucket, k, "right")].to_pylist()
        lengths = np.array([len(chunk) for chunk in own], dtype=np.uint32)
        sent.append({"bucket": k, "packed": pack(lengths=lengths, data=np.frombuffer(b"".join(own), dtype=np.uint8))})
    kind = pa.struct([("bucket", pa.int32()), ("packed", pa.binary())])
    arrays = [
        pa.array([number], pa.int64()),
        pa.array([doc_ids], pa.list_(pa.int64())),
        pa.array([counts], pa.list_(pa.int32())),
        pa.array([pack(low=slots.astype(np.uint16), high=(slots >> 16).astype(np.uint16))], pa.binary()),
        pa.array([sent], pa.list_(kind)),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["block", "doc_ids", "counts", "slots", "chunks"])


def _blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """Documents in blocks of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, doc_ids, texts = None, 0, [], []
        for batch in slices(batches, 64):
            for doc_id, text, part in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), batch["part"].to_pylist()):
                text = text or b""
                number = part << 33 if number is None else number
                if texts and size + len(text) > BLOCK_BYTES:
                    yield _block(number, doc_ids, texts, buckets)
                    number, size, doc_ids, texts = number + 1, 0, [], []
                doc_ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if texts:
            yield _block(number, doc_ids, texts, buckets)

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"].cast("string").cast("binary").alias("text"),
        F.spark_partition_id().cast("long").alias("part"),
    )
    return rows.mapInArrow(run, BLOCKS)


def _stored_blocks(blocks: DataFrame, folder: str, groups: int) -> DataFrame:
    """Blocks written in groups of files by block number, so that the join with their ids moves the ids alone."""
    name = f"blocks_{uuid.uuid4().hex}"
    writer = blocks.write.option("path", f"{folder}/blocks").option("compression", "zstd")
    writer.bucketBy(groups, "block").saveAsTable(name)
    stored = blocks.sparkSession.table(name)
    blocks.sparkSession.sql(f"DROP TABLE {name}")  # the name alone; the files stay in the folder
    return stored


def _segmented(sent: DataFrame, path: str | None) -> DataFrame:
    """The chunk table, bucket by bucket: each distinct chunk is segmented once, and every block gets the ids of its chunks back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, bucket, known = shared_pieces(path), None, {}
        for batch in slices(batches, 1):
            number, block = batch["bucket"][0].as_py(), batch["block"][0].as_py()
            if number != bucket:
                bucket, known = number, {}
            packed = unpack(batch["packed"][0].as_py())
            ends = np.cumsum(packed["lengths"], dtype=np.int64).tolist()
            data = packed["data"].tobytes()
            chunks = [data[start:end] for start, end in zip([0, *ends], ends)]
            new = [chunk for chunk in chunks if chunk not in known]
            for first in range(0, len(new), 10_000):
                some = new[first : first + 10_000]
                known.update((chunk, np.array(ids, dtype=pieces.kind).tobytes()) for chunk, ids in zip(some, pieces.encode_chunks(some)))
            found = [known[chunk] for chunk in chunks]
            ids = np.frombuffer(b"".join(found), dtype=pieces.kind)
            lengths = np.array([len(own) // ids.itemsize for own in found], dtype=np.uint32)
            arrays = [pa.array([block], pa.int64()), pa.array([number], pa.int32()), pa.array([pack(lengths=lengths, ids=ids)], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "bucket", "packed"])

    return sent.mapInArrow(run, "block long, bucket int, packed binary")


def _joined(rows: DataFrame, path: str | None, end_id: bool) -> DataFrame:
    """Ids and decoded text of every document, from its slots and the ids of its block's chunks in the order of buckets."""

    def documents(batch: pa.RecordBatch, pieces: Pieces) -> Iterator[pa.RecordBatch]:
        doc_ids, counts = batch["doc_ids"].flatten(), batch["counts"].flatten().to_numpy()
        planes = unpack(batch["slots"][0].as_py())
        slots = planes["high"].astype(np.int64) << 16 | planes["low"]
        found = [unpack(packed) for packed in batch["found"].flatten().field("packed").to_pylist()]
        table = np.concatenate([np.zeros(0, pieces.kind), *(part["ids"] for part in found)])
        lengths = np.concatenate([np.zeros(0, np.int64), *(part["lengths"] for part in found)]).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        ends = np.cumsum(counts, dtype=np.int64)
        for first in range(0, len(doc_ids), 64):
            made = []
            for k in range(first, min(first + 64, len(doc_ids))):
                own = slots[ends[k] - counts[k] : ends[k]]
                size = lengths[own]
                inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                ids = table[np.repeat(starts[own], size) + inside].astype(np.int32)
                made.append(np.append(ids, np.int32(pieces.model.eos_id())) if end_id else ids)
            decoded = pieces.model.decode([ids.tolist() for ids in made], num_threads=1)
            arrays = [doc_ids[first : first + 64], pa.array(made, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared_pieces(path)
        for batch in slices(batches, 1):
            yield from documents(batch, pieces)

    return rows.select("doc_ids", "counts", "slots", "found").mapInArrow(run, RESULT)


def encode_documents(docs: DataFrame, folder: str, path: str | None = None, end_id: bool = True) -> DataFrame:
    """doc_id, ids (with the end id behind them if ``end_id``) and the decoded text of every row of ``docs`` (doc_id, text).

    Documents are stored as blocks of chunk numbers. The blocks' chunks meet in buckets of the chunk table, where each distinct chunk is
    segmented once; the ids go back to the blocks and are put in place by slot. There are as many buckets as the texts need, so a bucket
    stays small; a frequent chunk comes once from each block, so no bucket is hot.

    A null text counts as empty: it has the end id only. Repeated rows give repeated rows, a null doc_id stays null; other columns are
    ignored. A very long text is one block. An empty table gives an empty result. ``path`` is the model's file, by default that
    of the installed package on each executor; a model whose pieces cross white space is refused.
    """
    shared_pieces(path)
    size = docs.select(F.sum(F.octet_length(docs["text"].cast("string")))).first()[0] or 0
    groups = min(MOST_GROUPS, max(1, -(-size // (TASK_BLOCKS * BLOCK_BYTES))))
    buckets = max(1, -(-size // BUCKET_BYTES))
    blocks = _stored_blocks(_blocks(docs, buckets), folder, groups)
    sent = blocks.select("block", F.inline("chunks")).repartitionById(buckets, "bucket").sortWithinPartitions("bucket")
    found = F.sort_array(F.collect_list(F.struct("bucket", "packed"))).alias("found")
    per_block = _segmented(sent, path).repartition(groups, "block").groupBy("block").agg(found).hint("shuffle_hash")
    return _joined(blocks.select("block", "doc_ids", "counts", "slots").join(per_block, "block", "left"), path, end_id)
