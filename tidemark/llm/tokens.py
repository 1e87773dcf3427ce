"""Token ids of documents in wavelet-matrix shard files."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import byte_alphabet
from tidemark.llm.common import open_shared, running_total, utf8, write_shared
from tidemark.plans.storage import store

#: File format: magic, then these numbers (documents, those of them that have a doc_id, ids, width, block), then doc_ids, offsets, zeros of each plane, and per plane its ranks and its bits.
MAGIC = b"TMWM0002"
HEAD = struct.Struct("<8sQQQII")
BLOCK = 512
MANIFEST = "path string, first long, docs long, tokens long"
READ = "path string, place long, doc_id long, local_start long, n_tokens long, ids_crc32 long"
#: Pieces of text whose ids a task remembers; others are encoded anew, with the same result.
REMEMBERED = 300_000
#: Bytes of text that are encoded together.
TEXT_BYTES = 16 << 20
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


class Wavelet:
    """A sequence of ids as bit planes, the highest bit first; in each plane zeros go before ones, order kept.

    ``access``, ``count`` and ``locate`` need one rank or select per plane. Ranks are stored for every 512th bit.
    """

    def __init__(self, n: int, zeros: np.ndarray, ranks: list[np.ndarray], planes: list[np.ndarray]) -> None:
        self.n, self.zeros, self.ranks, self.planes = n, zeros, ranks, planes

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> Wavelet:
        zeros, ranks, planes = [], [], []
        ids = ids.astype(np.uint16 if width <= 16 else np.uint32)
        for level in range(width - 1, -1, -1):
            bits = ((ids >> level) & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8), dtype=np.uint8)])
            ones = np.bitwise_count(packed.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.uint64)
            planes.append(packed)
            ranks.append(np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(ones, dtype=np.uint64)]))
            zeros.append(int(len(ids) - bits.sum()))
            ids = np.concatenate([ids[~bits], ids[bits]])
        return cls(len(bits) if width else 0, np.array(zeros, dtype=np.uint64), ranks, planes)

    def _rank1(self, plane: int, at: int) -> int:
        block, rest = divmod(at, BLOCK)
        start = block * BLOCK // 8
        inside = self.planes[plane][start : start + (rest + 7) // 8].copy()
        if rest % 8:
            inside[-1] &= (1 << rest % 8) - 1
        return int(self.ranks[plane][block]) + int(np.bitwise_count(inside).sum())

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) such bit."""
        ranks = self.ranks[plane]
        below = ranks if bit else np.arange(len(ranks), dtype=np.uint64) * BLOCK - ranks
        block = int(np.searchsorted(below, k, side="right")) - 1
        start = block * BLOCK // 8
        bits = np.unpackbits(self.planes[plane][start : start + BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(below[block])])

    def access(self, at: int) -> int:
        """The id at a place."""
        value = 0
        for plane, zeros in enumerate(self.zeros.tolist()):
            bit = int(self.planes[plane][at // 8]) >> at % 8 & 1
            ones = self._rank1(plane, at)
            at = zeros + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _narrow(self, value: int, at: int) -> int:
        for plane, zeros in enumerate(self.zeros.tolist()):
            bit = value >> (len(self.planes) - 1 - plane) & 1
            ones = self._rank1(plane, at)
            at = zeros + ones if bit else at - ones
        return at

    def count(self, value: int, start: int, end: int) -> int:
        """Occurrences of an id in [start, end)."""
        return 0 if value >> len(self.planes) else self._narrow(value, end) - self._narrow(value, start)

    def locate(self, value: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id; IndexError where there are no more."""
        if k >= self.count(value, 0, self.n):
            raise IndexError(k)
        at = self._narrow(value, 0) + k
        for plane in range(len(self.planes) - 1, -1, -1):
            bit = value >> (len(self.planes) - 1 - plane) & 1
            at = self._select(plane, bit, at - int(self.zeros[plane]) if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids in order, by undoing the planes from the last: its zeros and ones go back to their places in the plane before."""
        values = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros.tolist()))):
            bits = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            before = np.empty_like(values)
            before[~bits] = values[:zeros]
            before[bits] = values[zeros:] | values.dtype.type(1 << level)
            values = before
        return values


def shard_bytes(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, width: int, nameless: int = 0) -> list[bytes]:
    """The parts of a shard file; ``nameless``: how many documents without a doc_id follow those of ``doc_ids``, as the last ones."""
    named, doc_ids = len(doc_ids), np.concatenate([doc_ids, np.zeros(nameless)]).astype(np.int64) if nameless else doc_ids
    matrix = Wavelet.build(ids, width)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    parts = [HEAD.pack(MAGIC, len(doc_ids), named, len(ids), width, BLOCK), doc_ids.astype(np.int64).tobytes(), offsets.tobytes(), matrix.zeros.tobytes()]
    parts += [x.tobytes() for plane in zip(matrix.ranks, matrix.planes) for x in plane]
    return [*parts, struct.pack("<I", zlib.crc32(b"".join(parts)))]


def read_shard(body: bytes) -> tuple[pa.Array, np.ndarray, Wavelet]:
    """Doc ids (null where a document has none), offsets and the wavelet matrix of a shard file."""
    magic, docs, named, tokens, width, block = HEAD.unpack_from(body)
    if magic != MAGIC or block != BLOCK or zlib.crc32(body[:-4]) != struct.unpack("<I", body[-4:])[0]:
        raise ValueError("not a whole shard file")
    at = HEAD.size

    def take(kind: type, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(body, dtype=kind, count=n, offset=at)
        at += found.nbytes
        return found

    doc_ids, offsets, zeros = take(np.int64, docs), take(np.int64, docs + 1), take(np.uint64, width)
    size = -(-tokens // BLOCK)
    ranks, planes = [], []
    for _ in range(width):
        ranks.append(take(np.uint64, size + 1))
        planes.append(take(np.uint8, size * BLOCK // 8))
    return pa.array(doc_ids, mask=np.arange(docs) >= named), offsets, Wavelet(tokens, zeros, ranks, planes)


class PieceCodec:
    """Ids of whole texts, equal to the library's, from remembered ids of their pieces between ASCII white space.

    The tokenizer lower-cases, composes characters, drops white space and merges within runs of letters, single digits and runs of
    marks; none of these reaches across ASCII white space, nor from an ASCII letter or digit into the ASCII marks that end a
    piece. A text that holds a special token goes to the library whole.
    """

    def __init__(self, path: str | None) -> None:
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model.tokenize
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.printable = {b: c for c, b in byte_alphabet().items()}
        self.known: dict[bytes, bytes] = {}

    def _piece(self, piece: bytes) -> bytes:
        core = piece.rstrip(MARKS)
        if core and core != piece and core[-1] in ALNUM:
            tail = piece[len(core) :]
            return (self.known.get(core) or self._piece(core)) + (self.known.get(tail) or self._piece(tail))
        text = piece.decode()
        if text.isalpha() and max(text) < "\u0250" and "\u0130" not in text:  # one run of letters in any version of Unicode
            ids = [t.id for t in self.model(text.lower().encode().decode("latin-1").translate(self.printable))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        found = np.array(ids, dtype=np.int32).tobytes()
        if len(self.known) < REMEMBERED and len(piece) <= 64:
            self.known[piece] = found
        return found

    def encode(self, text: bytes) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype=np.int32)
        pieces = text.split()
        found = list(map(self.known.get, pieces))
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = self._piece(pieces[k])
        return np.frombuffer(b"".join(found), dtype=np.int32)

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """``encode`` for several texts (null: empty), with each different piece of them looked up once."""
        bodies = utf8(texts)
        if any(s in body for body in bodies for s in self.special):
            return [self.encode(body) for body in bodies]
        pieces = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        ends = np.cumsum(pc.list_value_length(pieces).to_numpy(), dtype=np.int64)
        coded = pc.list_flatten(pieces).dictionary_encode()
        different = coded.dictionary.cast(pa.binary()).to_pylist()
        found = list(map(self.known.get, different))
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = self._piece(different[k]) if different[k] else b""
        sizes = np.array([len(ids) // 4 for ids in found], dtype=np.int64)
        lists = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]), np.frombuffer(b"".join(found), dtype=np.int32))
        before = np.concatenate([[0], np.cumsum(sizes[coded.indices.to_numpy()])])
        return np.split(lists.take(coded.indices).flatten().to_numpy(), before[ends[:-1]])


@cache
def shared_codec(path: str | None) -> PieceCodec:
    """One codec for each Python worker, so that later tasks find the pieces that earlier ones have met."""
    return PieceCodec(path)


def _by_size(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about so many bytes of text; a longer text stands with few others."""
    for batch in batches:
        part = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(), dtype=np.int64) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def write_shards(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 1, shard_tokens: int = 2_000_000) -> DataFrame:
    """Encode every document and write shard files in ascending doc_id order into ``folder``; return their manifest.

    ``docs`` has doc_id and text. A null text counts as empty and gives ``end_id`` alone; rows without a doc_id come last; rows
    with equal doc_ids or none stand in the order of their texts. A shard ends after the document with which it reaches
    ``shard_tokens``, so that a task holds one shard. ``folder`` must be shared by all executors. File names follow from the
    first doc_id and its place among equal ones, or without one from the task, so that a repeated task writes the same files again.
    Write into a new folder each time. Texts of any length are encoded whole; other columns are not read. An empty table gives no
    shard and an empty manifest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = None, TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        size = shards = 0

        def flush() -> pa.RecordBatch:
            nonlocal size, shards, doc_ids, parts
            first = f"none-{part:06d}" if doc_ids[0] is None else f"{doc_ids[0]:020d}"
            name = f"{folder}/{first}-{shards:06d}.wm"
            named = np.array([k for k in doc_ids if k is not None], dtype=np.int64)
            ids = np.concatenate(parts)
            write_shared(name, shard_bytes(named, np.array([len(p) for p in parts]), ids, width, len(doc_ids) - len(named)))
            row = [[name], [doc_ids[0]], [len(doc_ids)], [len(ids)]]
            size, shards, doc_ids, parts = 0, shards + 1, [], []
            return pa.RecordBatch.from_arrays([pa.array(row[0]), *[pa.array(c, pa.int64()) for c in row[1:]]], names=["path", "first", "docs", "tokens"])

        for batch in _by_size(batches, TEXT_BYTES):
            if codec is None:
                codec = shared_codec(path)
                width = max(codec.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id).bit_length()
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), codec.encode_all(batch["text"])):
                doc_ids.append(doc_id)
                parts.append(np.append(ids, np.int32(end_id)))
                size += len(parts[-1])
                if size >= shard_tokens:
                    yield flush()
        if doc_ids:
            yield flush()

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    # Rows without doc_id may be many: the start of their texts spreads them over the ranges.
    start = F.when(F.col("doc_id").isNull(), F.substring("text", 1, 64))
    order = F.col("doc_id").asc_nulls_last()
    ordered = texts.repartitionByRange(order, start).sortWithinPartitions(order, "text")
    return ordered.mapInArrow(run, MANIFEST)


def shard_starts(manifest: DataFrame, folder: str) -> DataFrame:
    """path and start of each shard file: how many ids all files before it hold."""
    totals = running_total(manifest.select("path", "first", "tokens"), [F.col("first").asc_nulls_last(), F.col("path")], "tokens", folder)
    return store(totals.select("path", F.col("_before").alias("start")), folder, "starts")


def read_shards(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every document of the listed shard files: its file, place in it, first id's place in it, number and CRC-32 of its ids as
    little-endian unsigned 32-bit integers, and (unless turned off) the ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["path"].to_pylist():
                with open_shared(name) as file:
                    doc_ids, offsets, matrix = read_shard(file.read())
                ids = matrix.decode().astype("<u4")
                for at in range(0, len(doc_ids), 1024):
                    some = doc_ids[at : at + 1024]
                    starts = offsets[at : at + len(some) + 1]
                    sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:])]
                    columns = [[name] * len(some), np.arange(at, at + len(some)), some, starts[:-1], np.diff(starts), sums]
                    arrays = [pa.array(c) for c in columns[:-1]] + [pa.array(sums, pa.int64())]
                    if with_ids:
                        chosen = ids[starts[0] : starts[-1]].astype(np.int32)
                        arrays.append(pa.ListArray.from_arrays(pa.array(starts - starts[0], pa.int32()), pa.array(chosen)))
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = READ + ", ids array<int>" * with_ids
    names = [part.split()[0] for part in schema.split(", ")]
    shards = manifest.count()  # one task for each file; without a number, small rows would be put into one task
    return manifest.select("path").repartition(max(1, shards), "path").mapInArrow(run, schema)
