"""Byte-level BPE with a published vocabulary: encoding by a segment tree over adjacent pair ranks, and decoding.

Each piece of text keeps a segment tree whose leaves are the ranks of its adjacent pairs. The root is the lowest
rank, the leftmost of equal ones. A merge changes three leaves, each in logarithmic time, until the root says that no
pair can be merged. A piece of n bytes so costs O(n log n), also where a text is one piece.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.textops import slices

# Fixed by the vocabulary's published format: how byte-level BPE cuts a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = 1 << 62


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, extra = [], 0
    for byte in range(256):
        letters.append(chr(byte if byte in plain else 256 + extra))
        extra += byte not in plain
    return letters


@dataclass
class Vocabulary:
    """Ids of single bytes, merges as pair -> rank and rank -> id, bytes of every id, and added tokens."""

    byte_ids: list[int]
    ranks: dict[int, int]
    merged: list[int]
    bytes_of: list[bytes]
    added: dict[str, int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        ids = described["model"]["vocab"]
        added = {token["content"]: token["id"] for token in described["added_tokens"]}
        letters = byte_letters()
        value = {letter: byte for byte, letter in enumerate(letters)}
        bytes_of = [b""] * (1 + max([*ids.values(), *added.values()]))
        for token, number in ids.items():
            bytes_of[number] = bytes(value[letter] for letter in token)
        for token, number in added.items():
            bytes_of[number] = token.encode()
        ranks, merged = {}, []
        for rank, pair in enumerate(described["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            ranks.setdefault(ids[left] << 32 | ids[right], rank)
            merged.append(ids[left + right])
        return cls([ids[letter] for letter in letters], ranks, merged, bytes_of, added)


def merge_piece(data: bytes, vocabulary: Vocabulary) -> list[int]:
    """Token ids of one piece."""
    ids = [vocabulary.byte_ids[byte] for byte in data]
    n = len(ids)
    if n < 2:
        return ids
    rank_of, merged = vocabulary.ranks.get, vocabulary.merged
    width = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [NONE] * (2 * width)
    for k in range(n - 1):
        rank = rank_of(ids[k] << 32 | ids[k + 1])
        if rank is not None:
            tree[width + k] = rank << 32 | k
    for k in range(width - 1, 0, -1):
        left, right = tree[2 * k], tree[2 * k + 1]
        tree[k] = left if left < right else right
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))

    def update(k: int, value: int) -> None:
        k += width
        tree[k] = value
        while k > 1:
            other = tree[k ^ 1]
            k >>= 1
            if other < value:
                value = other
            if tree[k] == value:
                return
            tree[k] = value

    while (least := tree[1]) != NONE:
        at = least & 0xFFFFFFFF
        gone = after[at]
        ids[at] = merged[least >> 32]
        ids[gone] = -1
        following = after[at] = after[gone]
        if gone < n - 1:
            update(gone, NONE)
        if following < n:
            before[following] = at
            rank = rank_of(ids[at] << 32 | ids[following])
            update(at, NONE if rank is None else rank << 32 | at)
        else:
            update(at, NONE)
        previous = before[at]
        if previous >= 0:
            rank = rank_of(ids[previous] << 32 | ids[at])
            update(previous, NONE if rank is None else rank << 32 | previous)
    return [number for number in ids if number >= 0]


class PieceMerger:
    """The same segment trees for many short pieces at once: one row of a NumPy array is one tree."""

    ROWS = 16_384

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        pairs = np.array(sorted(vocabulary.ranks), np.int64)
        self.pairs = np.append(pairs, NONE)
        self.ranks = np.array([*(vocabulary.ranks[pair] for pair in pairs.tolist()), 0], np.int64)
        self.merged = np.array(vocabulary.merged or [0], np.int64)
        self.byte_ids = np.array(vocabulary.byte_ids, np.int64)

    def _leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank and place of the pairs, NONE for those that do not merge; ids below 0 are no symbols."""
        key = left << 32 | right
        place = np.searchsorted(self.pairs, key)
        found = (self.pairs[place] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[place] << 32 | at, NONE)

    def _merge(self, pieces: list[bytes], width: int) -> list[bytes]:
        m = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, m)
        row = np.repeat(np.arange(m), lengths)
        column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        ids = np.full((m, width + 1), -1, np.int64)  # the last column stands for what lies beyond a piece
        ids[row, column] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.tile(np.arange(1, width + 2), (m, 1))
        after[:, width] = width
        before = np.tile(np.arange(-1, width), (m, 1))
        tree = np.full((m, 2 * width), NONE, np.int64)
        places = np.broadcast_to(np.arange(width), (m, width))
        tree[:, width:] = self._leaves(ids[:, :-1], ids[:, 1:], places)
        for k in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            root = tree[rows, 1]
            at = root & 0xFFFFFFFF
            ids[rows, at] = self.merged[root >> 32]
            gone = after[rows, at]
            ids[rows, gone] = -1
            following = after[rows, gone]
            after[rows, at] = following
            before[rows, following] = at
            tree[rows, width + gone] = NONE
            tree[rows, width + at] = self._leaves(ids[rows, at], ids[rows, following], at)
            previous = before[rows, at]
            some = np.flatnonzero(previous >= 0)
            linked, head = rows[some], previous[some]
            tree[linked, width + head] = self._leaves(ids[linked, head], ids[linked, at[some]], head)
            for owner, leaf in ((rows, gone), (rows, at), (linked, head)):
                k = (width + leaf) >> 1
                while k.size and k[0]:
                    tree[owner, k] = np.minimum(tree[owner, 2 * k], tree[owner, 2 * k + 1])
                    k = k >> 1
            rows = rows[tree[rows, 1] != NONE]
        held = ids[:, :-1] >= 0
        flat = ids[:, :-1][held].astype(np.int32).tobytes()
        ends = np.cumsum(held.sum(1)) * 4
        return [flat[begin:end] for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids of each piece as int32 bytes."""
        found: list[bytes] = [b""] * len(pieces)
        groups: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if len(piece) > 64:
                found[k] = np.array(merge_piece(piece, self.vocabulary), np.int32).tobytes()
            elif piece:
                groups.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append(k)
        for width, members in groups.items():
            for first in range(0, len(members), self.ROWS):
                part = members[first : first + self.ROWS]
                for k, ids in zip(part, self._merge([pieces[k] for k in part], width)):
                    found[k] = ids
        return found


class Kept:
    """Results by key in two generations, about `most` in each; `learn` makes the young one hold all given keys."""

    def __init__(self, most: int, compute):
        self.most, self.compute = most, compute
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, keys: set[str]) -> None:
        missing = keys.difference(self.young)
        if self.young and len(self.young) + len(missing) > self.most:
            self.old, self.young = self.young, {}
            missing = keys
        new = [key for key in missing if key not in self.old]
        self.young.update((key, self.old[key]) for key in missing if key in self.old)
        self.young.update(zip(new, self.compute(new)))


class Encoder:
    """Encodes texts; pieces and words seen lately are kept.

    A piece never spans a single space between two other characters: the space begins the next piece. Texts without
    other runs of white space are therefore cut at spaces, and only words not seen lately go through the pattern.
    """

    def __init__(self, vocabulary: Vocabulary, kept: int = 200_000):
        self.vocabulary = vocabulary
        merger = PieceMerger(vocabulary)
        self.find = regex.compile(PIECES).findall
        self.pieces = Kept(kept, lambda pieces: merger.merge([piece.encode() for piece in pieces]))
        self.words = Kept(kept, self._spaced)
        self.irregular = re.compile(r"^\s|\s\Z| \s|\s ").search
        longest = sorted(vocabulary.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def _ids(self, cut: list[list[str]]) -> list[bytes]:
        self.pieces.learn(set().union(*cut))
        look = self.pieces.young.__getitem__
        return [b"".join(map(look, pieces)) for pieces in cut]

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it."""
        return self._ids([self.find(" " + word) for word in words])

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        plain, cut, owners = [], [], []
        for k, text in enumerate(texts):
            parts = [text] if self.added is None or not self.added.search(text) else self.added.split(text)
            for n, part in enumerate(parts):
                if n % 2:
                    plain.append(None)
                    cut.append(np.int32(self.vocabulary.added[part]).tobytes())
                elif self.irregular(part):
                    plain.append(self.find(part))
                    cut.append([])
                else:
                    first, *words = part.split(" ")
                    plain.append(self.find(first))
                    cut.append(words)
                owners.append(k)
        heads = iter(self._ids([pieces for pieces in plain if pieces is not None]))
        self.words.learn(set().union(*(words for words in cut if isinstance(words, list))))
        look = self.words.young.__getitem__
        found: list[list[bytes]] = [[] for _ in texts]
        for owner, pieces, words in zip(owners, plain, cut):
            if pieces is None:
                found[owner].append(words)
            else:
                found[owner].append(next(heads))
                found[owner].append(b"".join(map(look, words)))
        return [np.frombuffer(b"".join(parts), np.int32) for parts in found]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def tokenized(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, token_ids, decoded) for every row of docs; `path` is a vocabulary file that the driver reads.

    Null text counts as empty: no ids, empty decoded text. Added tokens standing in a text get their own ids. Rows are independent, so repeated rows,
    null ids and other columns need no rule; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for first, last, _, _ in slices(batch.column(1)):
                ids = encoder.encode_all([text or "" for text in batch.column(1).slice(first, last - first).to_pylist()])
                decoded = [encoder.decode(own) for own in ids]
                ends = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=ends[1:])
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), lists, pa.array(decoded)], ["doc_id", "token_ids", "decoded"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(rows, f"doc_id {docs.schema[id_col].dataType.simpleString()}, token_ids array<int>, decoded string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row."""
    rows = tokenized(docs, path)
    listed = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
