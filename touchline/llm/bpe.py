"""Byte-pair encoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be merged across, so it is a
certain cut. A pre-token is split at its certain cuts, every fragment is encoded on its own (and
remembered), and the ids are concatenated. Pre-tokens follow the byte-level pattern of the
tokenizer file, and added tokens are taken out of the text first, as the library does.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.remembered import Remembered
from touchline.llm.tables import mapped, slices

# Fixed value: the pre-token pattern of byte-level BPE files (public tokenizers library).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The byte each printable stand-in character of a byte-level vocabulary means."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


END_MARK = b"\n"  # stands for the end-of-word suffix; tokenizers with one drop white space


def rank_encoding(spec: dict, pattern: str = PATTERN):
    """(encoding, id_of_rank) of a BPE file: the tiktoken library's encoding, with ranks in merge
    order and pieces by ``pattern``. With an end-of-word suffix, pieces end in ``END_MARK``,
    which joins the last byte before any other merge, as the suffix is part of it."""
    import tiktoken
    to_byte, vocab = byte_alphabet(), spec["model"]["vocab"]
    suffix = spec["model"].get("end_of_word_suffix") or ""

    def raw(token: str) -> bytes:
        end = bool(suffix) and token.endswith(suffix)
        return bytes(to_byte[c] for c in token.removesuffix(suffix if end else "")) + END_MARK * end

    ranks = {bytes([b]): b for b in range(256)}
    names = {bytes([b]): c for c, b in to_byte.items()}
    if suffix:
        ranks |= {bytes([b]) + END_MARK: 256 + b for b in range(256)}
        names |= {bytes([b]) + END_MARK: c + suffix for c, b in to_byte.items()}
    base = len(ranks)
    for i, (x, y) in enumerate(spec["model"]["merges"]):
        ranks[raw(x + y)] = base + i
        names[raw(x + y)] = x + y
    if len(ranks) != base + len(spec["model"]["merges"]):
        raise ValueError("two merges make one token: ranks don't determine the merge order")
    id_of_rank = np.zeros(len(ranks), "<u4")
    for token, rank in ranks.items():
        id_of_rank[rank] = vocab.get(names[token], 0)
    encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return encoding, id_of_rank


class ForcedBoundaryBpe:
    """Encoder and decoder over a byte-level BPE tokenizer file."""

    def __init__(self, path: str, remembered: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_alphabet()
        vocab = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = {i: bytes(to_byte[c] for c in t) for t, i in vocab.items()}
        size = max([*raw, *added.values()]) + 1
        self.token_bytes = [raw.get(i, b"") for i in range(size)]
        for content, i in added.items():
            self.token_bytes[i] = content.encode()
        # A pair may be merged across only if some token holds it.
        self.inside = np.zeros((256, 256), bool)
        for token in raw.values():
            if len(token) > 1:
                b = np.frombuffer(token, np.uint8)
                self.inside[b[:-1], b[1:]] = True
        encoding, self.id_of_rank = rank_encoding(spec)
        self.merge = encoding._core_bpe.encode_single_piece
        self.added = added
        self.split_added = (regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")")
            if added else None)
        self.pretokens = regex.compile(PATTERN)
        self.words = Remembered(remembered)

    def cuts(self, data: bytes) -> np.ndarray:
        """Positions between two bytes that no token joins."""
        b = np.frombuffer(data, np.uint8)
        return np.flatnonzero(~self.inside[b[:-1], b[1:]]) + 1

    def _learn(self, words: list[str]) -> None:
        """Encode pre-tokens: cut all of them at once, then merge fragment by fragment."""
        coded = [w.encode("utf-8") for w in words]
        ends = np.cumsum([len(c) for c in coded])
        data = b"".join(coded)
        # Pre-token ends are cuts as well; fragments lie between neighbouring cuts.
        at = np.union1d(self.cuts(data), ends)
        at = [0, *at[at > 0].tolist()]
        merge = self.merge
        pieces = [merge(data[i:j]) for i, j in zip(at, at[1:])]
        ids = self.id_of_rank[np.fromiter((x for p in pieces for x in p), np.int64)].tobytes()
        offset = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        first = 4 * offset[np.searchsorted(at, np.concatenate([[0], ends]))]
        for w, i, j in zip(words, first.tolist(), first[1:].tolist()):
            self.words[w] = ids[i:j]

    def _parts(self, text: str) -> list[str]:
        """Pre-tokens of a text; added tokens stand for themselves."""
        if self.split_added is None or not any(t in text for t in self.added):
            return self.pretokens.findall(text)
        return [w for part in self.split_added.split(text) for w in (
            [part] if part in self.added else self.pretokens.findall(part))]

    def encode_packed(self, texts: list[str]) -> Iterator[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        for text in texts:
            parts = self._parts(text)
            self.words.make_room(len(parts))
            new = self.words.unknown(parts)
            for t in new.intersection(self.added):
                self.words[t] = struct.pack("<I", self.added[t])
            if new := list(new.difference(self.added)):
                self._learn(new)
            yield b"".join(map(self.words.__getitem__, parts))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(next(self.encode_packed([text])), "<u4").tolist()

    def decode(self, ids) -> str:
        """Text of ids; bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, ForcedBoundaryBpe] = {}


def loaded(path: str) -> ForcedBoundaryBpe:
    """The encoder of a file, built once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ForcedBoundaryBpe(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (array, if ``with_ids``), ids_sha256, decoded_sha256.

    ``path`` is a byte-level BPE tokenizer file present on every executor. Null and empty texts
    have no ids; null, repeated or clashing other columns don't matter; no shuffle is needed.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in slices(batches):
            counts, packed, shas, decoded = [], [], [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for data in bpe.encode_packed(texts):
                ids = np.frombuffer(data, "<u4")
                counts.append(len(ids))
                if with_ids:
                    packed.append(ids.astype(np.int32))
                shas.append(hashlib.sha256(data).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids.tolist()).encode()).hexdigest())
            cols = {"doc_id": batch.column(0), "n_tokens": pa.array(counts, pa.int64())}
            if with_ids:
                cols["ids"] = pa.array(packed, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(cols | {
                "ids_sha256": pa.array(shas, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())})

    schema = ("doc_id long, n_tokens long, " + "ids array<int>, " * with_ids
              + "ids_sha256 string, decoded_sha256 string")
    return mapped(docs.select(F.col(id_col).cast("long"), F.col(text_col)), rows, schema)
