"""Ranked lexical search over an index whose documents are grouped by length."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.plans.storage import store

# A term is a longest run of characters other than these ASCII ones; only A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed values of the score: the normaliser is 50 plus 50 times the length over the mean length; the term frequency saturates against 20
# normalisers in 1,000.
HALF, SCALE, TF_UNIT, NORM_UNIT = 50, 10**9, 1000, 20
#: Bytes of text in one segment of the index; a longer text is a segment of its own.
SEGMENT_BYTES = 16 << 20
#: Items searched for together in one segment.
BLOCK_ITEMS = 512
INDEX = "segment long, term string, n_docs int, ms array<long>, tfs array<long>, lengths array<int>, docs array<int>, doc_ids array<long>"
_SEPARATORS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))


def terms(text: Column) -> Column:
    """All terms of a text in order; empty for null."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """How many documents have a term, and how many terms they all have with repeats."""
    n = F.regexp_count(docs["text"].cast("string"), F.lit(TERM)).cast("long")
    documents, length = docs.select(n.alias("n")).agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    return documents, length or 0


def _segment(number: int, doc_ids: list, parts: list[pa.Array], n: int, length: int) -> pa.RecordBatch:
    """One segment: documents numbered by normaliser and doc_id, and a row of postings for each term."""
    ms = [HALF + (HALF * len(part) * n) // length for part in parts]
    order = sorted(range(len(parts)), key=lambda k: (ms[k], doc_ids[k] is None, doc_ids[k] or 0))
    parts, ms, doc_ids = ([values[k] for k in order] for values in (parts, ms, doc_ids))
    coded = pa.chunked_array(parts, pa.binary()).combine_chunks().dictionary_encode()
    size, n_terms = len(parts), len(coded.dictionary)
    doc = np.repeat(np.arange(size, dtype=np.int64), [len(part) for part in parts])
    keys, tf = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * size + doc, return_counts=True)
    code, doc = keys // size, keys % size
    strata, stratum = np.unique(np.array(ms, dtype=np.int64), return_inverse=True)
    tf_values, tf_rank = np.unique(tf, return_inverse=True)
    run = (code * len(strata) + stratum[doc]) * len(tf_values) + tf_rank
    sorting = np.argsort(run, kind="stable")
    run, code, doc = run[sorting], code[sorting], doc[sorting]
    starts = np.flatnonzero(np.diff(run, prepend=-1))
    run_code = code[starts]
    run_ends = np.searchsorted(run_code, np.arange(n_terms + 1))
    doc_ends = np.searchsorted(code, np.arange(n_terms + 1))

    def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
        found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
        return pa.concat_arrays([found, pa.array([None], pa.list_(kind))])

    columns = [
        pa.array([number] * (n_terms + 1), pa.int64()),
        pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.array([None], pa.string())]),
        pa.concat_arrays([pa.array(np.diff(doc_ends), pa.int32()), pa.array([size], pa.int32())]),
        lists(strata[run[starts] // len(tf_values) % len(strata)], run_ends, pa.int64()),
        lists(tf_values[run[starts] % len(tf_values)], run_ends, pa.int64()),
        lists(np.diff(starts, append=len(run)), run_ends, pa.int32()),
        lists(doc, doc_ends, pa.int32()),
        pa.concat_arrays([pa.nulls(n_terms, pa.list_(pa.int64())), pa.array([doc_ids], pa.list_(pa.int64()))]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["segment", "term", "n_docs", "ms", "tfs", "lengths", "docs", "doc_ids"])


def build_index(docs: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """The stored index over every row of ``docs`` (doc_id, text), and the number of documents with a term.

    A segment holds whole documents, so no posting is shuffled. Documents of equal normaliser m are a stratum: neighbours in the
    segment's numbering. Each term has one row for each segment: runs of equal m and tf with their documents. The row without a
    term lists the segment's doc_ids. Null texts and texts without terms are in no segment; null doc_ids sort last; rows that repeat are
    documents of their own. An empty table gives an empty index. A very long text is a segment of its own.
    """
    n, length = corpus_size(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, doc_ids, parts = None, 0, [], []
        for batch in slices(batches, 64):
            for doc_id, text, part in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), batch["part"].to_pylist()):
                number = part << 33 if number is None else number
                found = (text or b"").translate(_SEPARATORS).split()
                if not found:
                    continue
                if parts and size + len(text) > SEGMENT_BYTES:
                    yield from slices([_segment(number, doc_ids, parts, n, length)], 4096)
                    number, size, doc_ids, parts = number + 1, 0, [], []
                doc_ids.append(doc_id)
                parts.append(pa.array(found, pa.binary()))
                size += len(text)
        if parts:
            yield from slices([_segment(number, doc_ids, parts, n, length)], 4096)

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"].cast("string").cast("binary").alias("text"),
        F.spark_partition_id().cast("long").alias("part"),
    )
    path = f"{folder}/index"
    rows.mapInArrow(run, INDEX).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(INDEX).parquet(path), n


class _Postings:
    """The postings of one term in a segment, with the score each of them adds and the most that each stratum can add."""

    def __init__(self, weight: int, ms: np.ndarray, tfs: np.ndarray, lengths: np.ndarray, docs: np.ndarray, strata: np.ndarray) -> None:
        impact = weight * (SCALE * tfs // (TF_UNIT * tfs + NORM_UNIT * ms))  # once for each tf of a stratum
        stratum = np.searchsorted(strata, ms)
        last = np.flatnonzero(np.diff(ms, append=-1))  # a stratum's runs ascend by tf, and so by impact
        self.strata, self.most = stratum[last], impact[last]
        self.docs, self.adds, self.stratum = docs, np.repeat(impact, lengths), np.repeat(stratum, lengths)


def _best(found: list[_Postings], sizes: np.ndarray, n_docs: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that may be among the ``top`` best, with their scores: strata in the order of their bounds, while a bound can matter."""
    bounds, scores = np.zeros(len(sizes), dtype=np.int64), np.zeros(n_docs, dtype=np.int64)
    for postings in found:
        bounds[postings.strata] += postings.most
    order = np.argsort(-bounds, kind="stable")
    place, least = 0, 1
    while place < len(order) and bounds[order[place]] >= least:
        # As many strata as hold four times the wanted documents; then all whose bound reaches the score that is needed.
        enough = int(np.searchsorted(np.cumsum(sizes[order[place:]]), 4 * top)) + 1 if not place else len(order)
        able = int(np.count_nonzero(bounds[order[place:]] >= least))
        now = order[place : place + min(enough, able)]
        visit = np.zeros(len(sizes), dtype=bool)
        visit[now] = True
        for postings in found:
            inside = visit[postings.stratum]
            scores[postings.docs[inside]] += postings.adds[inside]
        place += len(now)
        if n_docs > top:
            least = max(1, int(np.partition(scores, n_docs - top)[n_docs - top]))
    hits = np.flatnonzero(scores >= least)
    return hits, scores[hits]


def _searched(postings: DataFrame, top: int) -> DataFrame:
    """The best documents of every item in every segment."""
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names = {name: table[name].to_pylist() for name in ("term", "w", "items")}
        lists = {name: [row.values for row in table[name]] for name in ("ms", "tfs", "lengths", "docs", "doc_ids")}
        rows = [k for k, term in enumerate(names["term"]) if term is not None]
        where = next(k for k, term in enumerate(names["term"]) if term is None)
        doc_ids = lists["doc_ids"][where].to_pylist()
        of = {name: {k: lists[name][k].to_numpy() for k in rows} for name in ("ms", "tfs", "lengths", "docs")}
        strata = np.unique(np.concatenate([of["ms"][k] for k in rows])) if rows else np.zeros(0, np.int64)
        seen = np.zeros(len(doc_ids), dtype=np.int64) - 1
        wanted = defaultdict(list)
        for k in rows:
            made = _Postings(names["w"][k], of["ms"][k], of["tfs"][k], of["lengths"][k], of["docs"][k], strata)
            seen[made.docs] = made.stratum
            for item in names["items"][k]:
                wanted[item].append(made)
        sizes = np.bincount(seen[seen >= 0], minlength=len(strata))
        out = []
        for item, found in wanted.items():
            hits, scores = _best(found, sizes, len(doc_ids), top)
            best = sorted((-score, doc_ids[k] is None, doc_ids[k] or 0) for k, score in zip(hits.tolist(), scores.tolist()))
            out += [(item, None if missing else doc_id, -score) for score, missing, doc_id in best[:top]]
        return pa.Table.from_arrays([pa.array(column, pa.int64()) for column in (zip(*out) if out else ([], [], []))], schema=schema)

    grouped = postings.groupBy("segment", "block")
    return grouped.applyInArrow(run, "item long, doc_id long, score long")


def search(index: DataFrame, n: int, items: DataFrame, folder: str, top: int = 50) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` best documents of every row of ``items`` (item_id, text).

    A term's weight is floor(1000 ln((2n + 2) / (2df + 1))), df the documents with the term among the n that have any. A document scores,
    for each distinct term of the item, weight times (10^9 tf) div (1000 tf + 20 m). Equal scores rank by doc_id, null last; scores of 0
    are left out. Items go through the segments in blocks. Within a segment, strata are visited in the order of the most they can
    score, and no further than that reaches the last rank; each segment hands on its best ``top``, from which the best of all are taken.

    An item whose text is null or has no term, or whose terms no document has, has no rows; neither has any item if the index is empty.
    Items that share an item_id are ranked each by itself. Other columns are ignored.
    """
    asked = items.select(items["item_id"].alias("item_id"), F.array_distinct(terms(items["text"])).alias("terms"))
    asked = store(asked.withColumn("item", F.monotonically_increasing_id()), folder, "items")
    blocks = max(1, -(-asked.count() // BLOCK_ITEMS))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")
    wanted = asked.select("item", block, F.explode("terms").alias("term")).groupBy("block", "term").agg(F.collect_list("item").alias("items"))
    lists = index.where("term is not null")
    df = lists.select("term", "n_docs").join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0 * n + 2.0)) / (2 * F.col("df") + 1))).cast("long")
    wanted = store(wanted.join(df.select("term", weight.alias("w")), "term").where("w > 0"), folder, "wanted")
    postings = lists.drop("n_docs", "doc_ids").join(wanted, "term")
    every = index.where("term is null").select("segment", "doc_ids", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    found = _searched(postings.unionByName(every, allowMissingColumns=True), top)
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ordered = F.row_number().over(by_score).alias("rank")
    best = store(found.select("item", "doc_id", "score", ordered).where(F.col("rank") <= top), folder, "best")
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

