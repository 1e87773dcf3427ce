"""Near-duplicate documents by SimHash fingerprints and meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import packed, slices, unpacked, utf8
from tidemark.llm.components import components
from tidemark.plans.storage import store

SEED = 42
BLOCKS, WIDTH = 4, 16


def simhash(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of a UTF-8 text: A-Z lower-cased, words between ASCII white space, every shingle with its repeats.

    Fewer words than a shingle make one shingle; no word gives 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    parts = map(b" ".join, zip(*[words[k:] for k in range(shingle)])) if len(words) >= shingle else iter([b" ".join(words)])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65_536):
        some = hashes[start : start + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, beside: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and SimHash (``fp``, the 64 bits as a signed long) of every row; a null or blank text has 0.

    The longs named in ``beside`` stay beside them.
    """
    names = ["doc_id", *beside]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([simhash(text, shingle) for text in utf8(batch["text"])], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], pa.array(found.view(np.int64))], names=[*names, "fp"])

    texts = docs.select(*[docs[c].cast("long").alias(c) for c in names], docs["text"].cast("string").alias("text"))
    return texts.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "fp"]))


#: Variants that one task makes of its fingerprints.
TASK_VARIANTS = 4_000_000


def _constants(rows: list[tuple[int, ...]]) -> F.Column:
    names = "xyz"
    return F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(names, row)]) for row in rows])


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _half_ball(fps: DataFrame) -> DataFrame:
    """All variants within one bit, half the radius rounded down, of the 48 bits that are left without each block of 16.

    Two fingerprints that differ in at most three bits differ in at most two of the 48 bits without a block that holds one of the
    three, so they meet in a variant. The key keeps the number of the block above the 48 bits.
    """
    rows = [(b, (1 << b * WIDTH) - 1, 0 if e is None else 1 << e) for b in range(BLOCKS) for e in (None, *range(48))]
    v = F.explode(_constants([(b << 48, low, flip) for b, low, flip in rows]))
    low = F.col("fp").bitwiseAND(F.col("v.y"))
    # What lies above the block moves down over it: clear the block and everything below, then shift by 16.
    high = F.shiftrightunsigned(F.col("fp"), WIDTH).bitwiseAND(F.bitwise_not(F.col("v.y"))).bitwiseAND(F.lit((1 << 48) - 1))
    key = high.bitwiseOR(low).bitwiseXOR(F.col("v.z")).bitwiseOR(F.col("v.x"))
    return fps.select("fp", v.alias("v")).select("fp", key.alias("key"))


def _hub_rows(fps: DataFrame) -> DataFrame:
    """Variants of whole fingerprints: near ones differ in up to one bit, far ones in two bits of the same half.

    Of three differing bits two lie in one half: flipping these on one side and the third on the other side gives a common variant.
    """
    near = [0, *[1 << b for b in range(64)]]
    far = [1 << a | 1 << b for half in (0, 32) for a in range(half, half + 32) for b in range(a + 1, half + 32)]
    v = F.explode(_constants([(_signed(m), 1) for m in near] + [(_signed(m), 0) for m in far])).alias("v")
    return fps.select("fp", v).select("fp", F.col("fp").bitwiseXOR(F.col("v.x")).alias("hub"), F.col("v.y").alias("near"))


def _spread(fps: DataFrame, variants: int) -> DataFrame:
    """Fingerprints dealt to as many tasks as their variants need; the size of the small table alone would give a few."""
    return fps.repartition(max(1, -(-fps.count() * variants // TASK_VARIANTS)))


def linked(fps: DataFrame, folder: str) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect exactly what links of at most three bits connect.

    1. Half-ball variants are shuffled, and fingerprints alone in all their buckets drop out. A bucket of two is verified at once;
       so chance collisions go.
    2. The rest emit the variants of whole fingerprints. All fingerprints within one bit of a variant lie within two of
       each other, and within three of those at two bits. So one edge from the smallest near one to each other member loses no
       connection and makes no pairs inside a bucket; each edge is verified by its bit distance.
    """
    every = Window.partitionBy("key")
    seen = _half_ball(_spread(fps, BLOCKS * 49)).select("fp", F.count("key").over(every).alias("n"), F.min("fp").over(every).alias("low"), F.max("fp").over(every).alias("high"))
    close = F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) <= 3
    colliding = store(seen.where((F.col("n") > 2) | ((F.col("n") == 2) & close)).select("fp").distinct(), folder, "colliding")
    hubs = _hub_rows(_spread(colliding, 1057))
    center = Window.partitionBy("hub")
    starred = hubs.select("fp", F.min(F.when(F.col("near") == 1, F.col("fp"))).over(center).alias("b"))
    edges = starred.where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return edges.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 3)


def near_duplicates(docs: DataFrame, folder: str, shingle: int = 3) -> DataFrame:
    """doc_id, fp and component_id of every row of ``docs`` (doc_id, text): the smallest doc_id that links can reach.

    Two documents link when their fingerprints differ in at most three bits; documents with equal fingerprints always do, those
    without words (fingerprint 0) included. Repeated rows stay and share a component. A null doc_id never names a component unless
    it has no other member. A null text has no words; texts of any length are read whole. Columns beside these two are not read. An
    empty table gives an empty result. ``folder`` is shared by all executors.
    """
    return _grouped(fingerprints(docs, shingle), folder).select("doc_id", "fp", "component_id")


def _grouped(prints: DataFrame, folder: str) -> DataFrame:
    """Every row of ``prints`` (doc_id, fp and others) with ``root``, which no two components share, and ``component_id``."""
    prints = store(prints, folder, "prints")
    classes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), folder, "classes")
    roots = store(components(linked(classes.select("fp"), folder), folder), folder, "roots")
    member = classes.join(roots.withColumnsRenamed({"node": "fp"}), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    member = store(member, folder, "member")
    least = store(member.groupBy("root").agg(F.min("first").alias("component_id")), folder, "least")
    named = store(member.join(least, "root").select("fp", "root", "component_id"), folder, "named")
    return prints.join(named, "fp")


def hex_print(fp: F.Column) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(docs: DataFrame, folder: str, shingle: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component one row, with all its columns.

    It is the one with the smallest doc_id, a null one last; among equal ones that with the smallest hash of the whole row. So the
    choice does not depend on the order of rows, and only rows that are equal in all columns can stand for each other. Rows of
    different components all stay, whether they share a doc_id or have none.
    """
    # A row's doc_id and 128 bits of hash are its key. The keys are free of nulls, so that join and removal of repeats share one
    # shuffle of the texts.
    whole = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes]
    # A hash passes over nulls: which columns have one is hashed as well.
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in docs.columns])
    keys = {"_none": F.col("doc_id").cast("long").isNull(), "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))}
    keys |= {f"_hash{k}": F.xxhash64(F.lit(k), nulls, *whole) for k in (1, 2)}
    texts = docs.select("doc_id", "text", *[keys[k].alias(k) for k in ("_hash1", "_hash2")])
    found = _grouped(fingerprints(texts, shingle, ("_hash1", "_hash2")), folder)
    key = F.struct(F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("_id"), "_hash1", "_hash2")
    chosen = found.groupBy("root").agg(F.min(key).alias("key")).select("key.*")
    rows = packed(docs, *[v.alias(k) for k, v in keys.items()])
    rows = rows.join(store(chosen, folder, "chosen"), [*keys], "left_semi").dropDuplicates([*keys])
    return unpacked(rows, docs.columns)
