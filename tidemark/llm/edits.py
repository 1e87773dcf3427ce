"""Document fingerprints by a randomised edit embedding."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.plans.storage import store

#: The walk's random bits repeat after so many steps; characters share them by their low byte, mixed with the high ones.
PERIOD, KINDS = 1024, 256
#: A fingerprint samples at most so many steps of the walk, all of them in shorter walks; a band has so many.
SAMPLES, BAND = 512, 6
SEED = 20_240_101


class Walk:
    """The shared random walk over characters.

    At step j the walk writes down the character it stands on and moves on to the next one if the shared random bit of (j, character)
    is set. Two texts with few edits between them write mostly the same characters at the same steps, as the walks fall
    into step again after an edit. It is run as an automaton: a state is a step's place in the period, and reading a
    character leads to the step at which the walk leaves it.
    """

    def __init__(self) -> None:
        rng = np.random.default_rng(SEED)
        moves = rng.integers(0, 2, (PERIOD, KINDS)).astype(bool)
        moves[-1] = True  # no walk waits longer than a period
        leave = np.where(moves, np.arange(PERIOD)[:, None], PERIOD)
        for step in range(PERIOD - 2, -1, -1):
            leave[step] = np.minimum(leave[step], leave[step + 1])
        following = (leave + 1) % PERIOD
        self.states: list[list] = [[] for _ in range(PERIOD)]
        for step in range(PERIOD):
            self.states[step].extend(self.states[k] for k in following[step].tolist())
            self.states[step].append(step)
        self.moves = moves
        # Level k samples one of 2^k steps among the first SAMPLES * 2^k, and takes nothing that level k - 1 does not.
        self.places = [np.arange(SAMPLES)]
        for level in range(1, 34):
            half = SAMPLES << level - 1
            kept = rng.choice(self.places[-1], SAMPLES // 2, replace=False)
            self.places.append(np.sort(np.concatenate([kept, half + rng.choice(half, SAMPLES // 2, replace=False)])))
        self.bits = rng.integers(0, 2, 1 << 16).astype(np.uint8)

    def ends(self, codes: np.ndarray, start: int = 0) -> np.ndarray:
        """For each character the first step after it, from step ``start`` on."""
        if not len(codes):
            return np.empty(0, dtype=np.int64)
        kinds = ((codes ^ codes >> 8 ^ codes >> 16) & 0xFF).astype(np.uint8).tobytes()
        found = map(itemgetter(KINDS), accumulate(kinds, getitem, initial=self.states[start % PERIOD]))
        steps = np.fromiter(found, dtype=np.int64, count=len(codes) + 1)
        gaps = np.diff(steps) % PERIOD
        gaps[gaps == 0] = PERIOD
        return start + np.cumsum(gaps)

    def level(self, length: int) -> int:
        """The first level that samples the whole of a walk of so many steps."""
        return max(0, (max(length, 1) - 1).bit_length() - (SAMPLES - 1).bit_length())

    def fingerprint(self, codes: np.ndarray, ends: np.ndarray) -> str:
        """``length:bits``: the number of steps of the walk, and a bit for each step that the walk's level samples."""
        length = int(ends[-1]) if len(ends) else 0
        steps = self.places[self.level(length)]
        steps = steps[steps < length]
        seen = codes[np.searchsorted(ends, steps, side="right")]
        return f"{length}:{np.packbits(self.bits[(seen * 0x9E37 >> 4 ^ steps) & 0xFFFF]).tobytes().hex()}"

    def compare(self, one: str, other: str) -> tuple[int, float]:
        """How many bands agree in all their sampled bits, and the verified likeness from 0 to 1.

        Compared are the steps that the level of the longer walk samples; the shorter one's level samples them too, so any two
        lengths compare alike. Bands take the steps that both walks have. A pair without a band that agrees is no candidate, and its
        likeness is 0. Sampled bits of unlike characters agree half of the time, so the share of like ones is twice the
        share of agreement less one; steps that the longer walk has alone count as unlike. Two empty texts are alike.
        """
        lengths, bits = zip(*((int(length), np.unpackbits(np.frombuffer(bytes.fromhex(packed), dtype=np.uint8))) for length, packed in (one.split(":"), other.split(":"))))
        if one == other:
            return -(-len(bits[0]) // BAND), 1.0
        steps = self.places[self.level(max(lengths))]
        both, either = np.searchsorted(steps, [min(lengths), max(lengths)]).tolist()
        found = []
        for length, own in zip(lengths, bits):
            sampled = self.places[self.level(length)]
            found.append(own[np.searchsorted(sampled, steps[:both])])
        agree = found[0] == found[1]
        # A band takes every so-manieth step, so that it samples the whole walk.
        bands = max(1, both // BAND)
        equal = sum(bool(agree[k::bands].all()) for k in range(bands)) if both else 0
        return equal, min(1.0, max(0.0, (2 * int(agree.sum()) - both) / either)) if equal else 0.0


@cache
def shared_walk() -> Walk:
    return Walk()


class Text:
    """A text with its code points, its walk and its fingerprint."""

    def __init__(self, doc_id: int | None, text: str) -> None:
        self.doc_id, self.text = doc_id, text
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.ends = shared_walk().ends(self.codes)
        self.print = shared_walk().fingerprint(self.codes, self.ends)

    def row(self, following: Text) -> tuple:
        """The result of this document, given the next one: its last third is replaced by the start of the next."""
        walk, n = shared_walk(), len(self.codes)
        keep, taken = n - n // 3, following.codes[: n // 3]
        ends = walk.ends(taken, int(self.ends[keep - 1]) if keep else 0)
        edited = walk.fingerprint(np.concatenate([self.codes[:keep], taken]), np.concatenate([self.ends[:keep], ends]))
        digest = hashlib.sha256((self.text[:keep] + following.text[: n // 3]).encode("utf-8", "surrogatepass")).hexdigest()
        edited_bands, near_edited = walk.compare(self.print, edited)
        next_bands, near_next = walk.compare(self.print, following.print)
        return self.doc_id, n, digest, self.print, edited, near_edited, near_next, edited_bands, next_bands


ROW = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
    "edited_bands": pa.int64(),
    "next_bands": pa.int64(),
}
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double, edited_bands long, next_bands long"
)


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))


def fingerprint_edits(docs: DataFrame, folder: str) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): fingerprints of its text and of its edited text, and how like they are.

    The next document is the one with the next smaller doc_id (after the last one the first); rows with equal doc_ids go in the order
    of a hash of their texts, rows without one come last. A null text counts as empty: length 0, and likeness 1 to another empty one. In a
    table of one row the row is its own next; an empty table gives an empty result. Equal texts have equal fingerprints. Texts of any
    length are walked whole. Of the columns beside these two none is read.

    Rows are sorted in ranges, also of the hash, so that many rows without a doc_id are several ranges. Each is streamed, holding two documents at a time. The first and last text of each range
    are also stored; a second pass over these alone joins the last document of a range to the first of the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                current = Text(doc_id, text or "")
                if held is None:
                    rows.append(("first", part, current.text, *[None] * len(ROW)))
                else:
                    rows.append(("whole", part, None, *held.row(current)))
                held = current
            yield _batch(rows, kinds)
        if held is not None:
            yield _batch([("last", part, held.text, held.doc_id, *[None] * (len(ROW) - 1))], kinds)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 8):
            values = zip(*[batch[c].to_pylist() for c in ("doc_id", "text", "next_text")])
            yield _batch([Text(doc_id, text).row(Text(None, following)) for doc_id, text, following in values], ROW)

    kinds = {"kind": pa.string(), "part": pa.int32(), "text": pa.string()} | ROW
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("place"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("place").asc(), F.col("text").asc()]
    ranges = texts.repartitionByRange(*order[:2]).sortWithinPartitions(*order).drop("place")
    done = store(ranges.mapInArrow(run, "kind string, part int, text string, " + SCHEMA), folder, "ranges")
    firsts = done.where("kind = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    over = Window.orderBy("part")
    following = F.coalesce(F.lead("part").over(over), F.min("part").over(Window.partitionBy()))
    follows = store(done.where("kind = 'first'").select("part", following.alias("next_part")), folder, "follows")
    lasts = done.where("kind = 'last'").select("part", "doc_id", "text").join(follows, "part").join(firsts, "next_part")
    return done.where("kind = 'whole'").select(*ROW).unionByName(lasts.select("doc_id", "text", "next_text").mapInArrow(finish, SCHEMA))
