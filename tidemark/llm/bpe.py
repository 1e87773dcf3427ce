"""Byte-pair encoding and decoding with forced-boundary splitting."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidemark.llm.common import slices, utf8

SCHEMA = "doc_id long, ids array<int>, decoded string"
#: Distinct fragments whose ids a task remembers; longer or rarer fragments are encoded anew, with the same result.
REMEMBERED = 350_000
SPACE = b" \t\n\x0b\x0c\r"
ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, as character -> byte.

    Visible Latin-1 characters stand for themselves; the other bytes take the code points from 256 on, in order.
    """
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table = {chr(b): b for b in visible}
    hidden = [b for b in range(256) if b not in visible]
    return table | {chr(256 + k): b for k, b in enumerate(hidden)}


class Codec:
    """Encodes texts by fragments between certain cuts, and decodes ids by joining the tokens' bytes.

    A byte pair that stands inside no vocabulary token can be crossed by no token, so a cut between its bytes never changes the
    result of the merges. Of these cuts those are taken at which the split into pre-tokens is certain as well, because it
    looks ahead at white space alone and treats only an apostrophe by what follows it:

    - before an ASCII white-space byte, whatever stands on the left;
    - after an ASCII letter or digit;
    - after a character from U+00C0 to U+00FF (never white space), unless an apostrophe follows.

    A text with a special token in it is encoded by the tokenizer whole.
    """

    def __init__(self, path: str | None = None) -> None:
        path = path or public_tokenizers.path("byte_bpe_50k.json")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None}))
        alphabet = byte_alphabet()
        self.token_bytes: dict[int, bytes] = {}
        within = np.zeros((256, 256), dtype=bool)
        for token, number in spec["model"]["vocab"].items():
            raw = bytes(alphabet[c] for c in token)
            self.token_bytes[number] = raw
            if len(raw) > 1:
                pairs = np.frombuffer(raw, dtype=np.uint8)
                within[pairs[:-1], pairs[1:]] = True
        for added in spec["added_tokens"]:
            self.token_bytes[added["id"]] = added["content"].encode()
        self.printable = {b: c for c, b in alphabet.items()}
        every = np.arange(256)
        self.certain = ~within & (np.isin(every, list(SPACE))[None, :] | np.isin(every, list(ALNUM))[:, None])
        self.after_latin = ~within & (every >= 0x80)[:, None] & (every != ord("'"))[None, :]
        self.split, self.tokenize = self.tokenizer.pre_tokenizer.pre_tokenize_str, self.tokenizer.model.tokenize
        self.special = [added["content"].encode() for added in spec["added_tokens"]]
        self.known: dict[bytes, bytes] = {}

    def fragments(self, text: bytes) -> list[bytes]:
        raw = np.frombuffer(text, dtype=np.uint8)
        if len(raw) < 2:
            return [text]
        cut = self.certain[raw[:-1], raw[1:]]
        latin = np.flatnonzero(raw[:-2] == 0xC3) + 1
        cut[latin[self.after_latin[raw[latin], raw[latin + 1]]]] = True
        cuts = (np.flatnonzero(cut) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]

    def _encode_fragment(self, piece: bytes) -> list[int]:
        text = piece.decode()
        core = text[1:] if text[0] == " " else text
        if core.isalpha() and max(core) < "\u0250":  # one pre-token in any version of Unicode
            return [t.id for t in self.tokenize(piece.decode("latin-1").translate(self.printable))]
        return [t.id for part, _ in self.split(text) for t in self.tokenize(part)]

    def encode(self, text: bytes) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype=np.int32)
        known, pieces = self.known, self.fragments(text) if text else []
        found = list(map(known.get, pieces))
        for k, ids in enumerate(found):
            if ids is None:
                piece = pieces[k]
                found[k] = ids = known.get(piece) or np.array(self._encode_fragment(piece), dtype=np.int32).tobytes()
                if len(known) < REMEMBERED and len(piece) <= 64:
                    known[piece] = ids
        return np.frombuffer(b"".join(found), dtype=np.int32)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", errors="replace")


@cache
def shared_codec(path: str | None) -> Codec:
    """One codec for each Python worker, so that later tasks find the fragments that earlier ones have met."""
    return Codec(path)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids and the decoded text of every row of ``docs`` (doc_id, text); other columns are ignored.

    A null text counts as empty: no ids, empty decoded text. Repeated rows give repeated rows, a null doc_id stays null. Texts of
    any length are encoded whole. An empty table gives an empty result. ``path`` is the tokenizer's file, by default that of the installed package on each executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared_codec(path)
        for batch in slices(batches, 64):
            ids = [codec.encode(text) for text in utf8(batch["text"])]
            decoded = [codec.decode(i.tolist()) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, SCHEMA)
