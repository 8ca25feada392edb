"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

The BPE encoding of every prefix of a piece of text ends in exactly one token. An automaton over all token
strings lists the tokens that end at a position; a token is the last one of the prefix if it and the last
token of what comes before it are compatible: encoding the two strings together gives these two tokens
again. The last tokens of all prefixes are kept, and following them back from the end emits the ids. Pieces that a
worker doesn't remember are encoded together, prefix length by prefix length, as arrays; long ones alone.

Compatibility is read from the merges. Undo the later of the two merges at the seam, again and again: if
two tokens that then meet there have a merge of their own that comes before the one just undone, BPE would
have joined them across the seam.

Texts are cut as byte-level pre-tokenization does it; added tokens of the file are found first, as the
tokenizer does. Null texts are empty and have no ids; an id outside the vocabulary decodes to nothing;
bytes that are no UTF-8 decode to replacement characters. Other columns are carried along; one named
like a result gives way to it.
"""

from __future__ import annotations

import json
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from weftgraph.llm.words import attach

#: The pattern of byte-level pre-tokenization.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of texts whose new pieces are encoded together, and of the longest of these. No result depends on it.
TOGETHER, SHORT = 1 << 18, 64
#: No byte, as bytes are written here.
BETWEEN = "\u0100"
#: Pieces and pairs a worker remembers; beyond it those not met since the last time are forgotten. No result depends
#: on it.
REMEMBERED = 100_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable ones for themselves, the others,
    in order, for letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load(path: str) -> dict:
    """What workers need of a tokenizer file: a bounded vocabulary, read once on the driver."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    if model["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
        raise ValueError("not a byte-level BPE file")
    letters = byte_letters()
    tokens = {bytes(letters[c] for c in text): i for text, i in model["vocab"].items()}
    ids = model["vocab"]
    merges = []
    for merge in model["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        merges.append((ids[left], ids[right], ids[left + right]))
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return {"tokens": tokens, "merges": merges, "added": added}


def _as_bytes(piece: str) -> str:
    """A character per byte of UTF-8."""
    return piece if piece.isascii() else piece.encode("utf-8", "surrogatepass").decode("latin-1")


class Codec:
    """Encoder and decoder of one vocabulary, with a memory of pieces seen."""

    def __init__(self, vocabulary: dict):
        tokens = vocabulary["tokens"]
        text = {i: t for t, i in tokens.items()} | {i: t.encode() for t, i in vocabulary["added"].items()}
        # Position 0 is for ids that are not in the vocabulary.
        self.texts = pa.array([b""] + [text.get(i, b"") for i in range(max(text, default=-1) + 1)], pa.large_binary())
        # A pair of tokens is one number, and a token's merge (its rank, left and right) lies at the token's place.
        self.count = len(self.texts)
        self.rank = {a * self.count + b: r for r, (a, b, _) in reversed([*enumerate(vocabulary["merges"])])}
        self.parts: list[tuple[int, int, int]] = [(-1, 0, 0)] * self.count
        for r, (a, b, whole) in enumerate(vocabulary["merges"]):
            if self.parts[whole][0] < 0:
                self.parts[whole] = (r, a, b)
        self.part_columns = np.array(self.parts, np.int64).T.copy()
        # The last key stands for all pairs without a merge.
        self.seams = np.array([*sorted(self.rank), np.iinfo(np.int64).max])
        self.seam_ranks = np.array([*map(self.rank.get, self.seams[:-1].tolist()), len(self.rank) + 2], np.int64)
        self.lengths = [len(text.get(i, b"")) for i in range(self.count)]
        self.sizes = np.array(self.lengths, np.int64)
        self.automaton = ahocorasick.Automaton()
        for token, i in tokens.items():
            if len(token) == 1 or self.parts[i][0] >= 0:
                self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.added = vocabulary["added"]
        self.split = regex.compile(PATTERN)
        longest = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest))) if longest else None
        # Ids of pieces, four bytes each; what has not been met for long is in the second one, until that goes.
        self.pieces: dict[str, bytes] = {}
        self.pieces_before: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        key = left * self.count + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Of merges of one rank, the one further left comes first: the seam's merge loses only to a left
        merge of its own rank."""
        parts, rank, count = self.parts, self.rank, self.count
        undone, side = len(rank) + 1, 0
        (a, a_left, a_right), (b, b_left, b_right) = parts[left], parts[right]
        while True:
            seam = rank.get(left * count + right)
            if seam is not None and (seam < undone or (seam == undone and side > 0)):
                return False
            # The right part's merge is the later one when both have the same rank.
            if a > b:
                undone, side, left = a, -1, a_right
                a, a_left, a_right = parts[left]
            elif b >= 0:
                undone, side, right = b, 1, b_left
                b, b_left, b_right = parts[right]
            else:
                return True

    def all_compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``compatible`` for many pairs at once, each different one looked at once."""
        ranks, lefts, rights = self.part_columns
        keys, inverse = np.unique(left * self.count + right, return_inverse=True)
        left, right = np.divmod(keys, self.count)
        fits = np.ones(len(keys), dtype=bool)
        at = np.arange(len(keys))
        undone, side = np.full(len(keys), len(self.rank) + 1), np.zeros(len(keys), dtype=bool)
        while len(at):
            key = left * self.count + right
            place = np.searchsorted(self.seams, key)
            seam = np.where(self.seams[place] == key, self.seam_ranks[place], self.seam_ranks[-1])
            joined = (seam < undone) | ((seam == undone) & side)
            fits[at[joined]] = False
            a, b = ranks[left], ranks[right]
            go = ~joined & ((a >= 0) | (b >= 0))
            at, left, right, a, b = at[go], left[go], right[go], a[go], b[go]
            side = a <= b
            undone = np.where(side, b, a)
            left, right = np.where(side, left, rights[left]), np.where(side, lefts[right], right)
        return fits[inverse]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Exact ids of many pre-tokens, four bytes each: their prefixes of one length are looked at together."""
        if not pieces:
            return []
        data = [_as_bytes(p) for p in pieces]
        lengths = np.array([*map(len, data)])
        begin = np.cumsum(lengths + 1) - lengths - 1
        # No token holds what is between two pieces, so no match goes across.
        found = np.fromiter(chain.from_iterable(self.automaton.iter(BETWEEN.join(data))), np.int64).reshape(-1, 2)
        end, token = found.T
        depth = end - np.repeat(begin, lengths + 1)[end]
        order = np.argsort(depth, kind="stable")  # the matches at one end stay in their order, the longest first
        end, token = end[order], token[order]
        start = end - self.sizes[token]
        # last[n]: last token of the prefix up to place n. The empty ones are before the pieces, the first at the end.
        last = np.full(begin[-1] + lengths[-1] + 1, -1)
        last[begin - 1] = first = self.count
        cuts = np.searchsorted(depth[order], np.arange(lengths.max() + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            before, here = last[start[a:b]], token[a:b]
            fits = before == first
            test = np.flatnonzero((before >= 0) & ~fits)
            fits[test] = self.all_compatible(before[test], here[test])
            # Of several that fit the first one is written last.
            last[end[a:b][fits][::-1]] = here[fits][::-1]
        which, at, owners, ids = np.arange(len(pieces)), begin + lengths - 1, [], []
        while len(which):
            owners.append(which)
            ids.append(last[at])
            at = at - self.sizes[ids[-1]]
            more = at >= begin[which]
            which, at = which[more], at[more]
        owner = np.concatenate(owners[::-1])
        flat = np.concatenate(ids[::-1])[np.argsort(owner, kind="stable")].astype(np.int32).tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=len(pieces)) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def encode_piece(self, piece: str) -> list[int]:
        """Exact ids of one pre-token."""
        data = _as_bytes(piece)
        # last[n]: last token of the first n + 1 bytes. The place more, which is last[-1], is the empty prefix.
        last = [-1] * (len(data) + 1)
        last[-1] = first = self.count
        for end, token in self.automaton.iter(data):
            if last[end] < 0:
                before = last[end - self.lengths[token]]
                if before == first or (before >= 0 and self.compatible(before, token)):
                    last[end] = token
        ids, at = [], len(data) - 1
        while at >= 0:
            ids.append(last[at])
            at -= self.lengths[last[at]]
        return ids[::-1]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], np.int32).tolist()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, four bytes each."""
        out, begin, total = [], 0, 0
        for i, text in enumerate(texts):
            total += len(text)
            if total >= TOGETHER or i == len(texts) - 1:
                out += self._encode_some(texts[begin : i + 1])
                begin, total = i + 1, 0
        return out

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        """Texts as pieces, of which those that are not remembered are encoded together."""
        if len(self.pieces) >= REMEMBERED:
            self.pieces, self.pieces_before = {}, self.pieces
        pieces, before = self.pieces, self.pieces_before
        cut: list[list[str | bytes]] = [self._cut(text) for text in texts]
        new = []
        for piece in set(chain.from_iterable(cut)).difference(pieces):
            if isinstance(piece, bytes):
                pieces[piece] = piece
            elif piece in before:
                pieces[piece] = before[piece]
            else:
                new.append(piece)
        short = [p for p in new if len(p) <= SHORT]
        pieces.update(zip(short, self.encode_pieces(short)))
        long = [p for p in new if len(p) > SHORT]
        pieces.update((p, np.array(self.encode_piece(p), np.int32).tobytes()) for p in long)
        out = [b"".join(map(pieces.__getitem__, c)) for c in cut]
        for piece in long:
            del pieces[piece]
        return out

    def _cut(self, text: str) -> list[str | bytes]:
        """The pieces of a text; an added token is its id."""
        out: list[str | bytes] = []
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            out += self.split.findall(text[at : found.start()])
            out.append(np.int32(self.added[found.group()]).tobytes())
            at = found.end()
        return out + self.split.findall(text[at:]) if at else self.split.findall(text)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of lists of ids that lie one after the other: the tokens' bytes, joined."""
        known = (ids >= 0) & (ids < len(self.texts) - 1)
        joined = self.texts.take(pa.array(np.where(known, ids + 1, 0)))
        data = memoryview(joined.buffers()[2] or b"")
        at = np.frombuffer(joined.buffers()[1], np.int64, len(ids) + 1)[bounds] if len(ids) else bounds
        return [str(data[a:b], "utf-8", "replace") for a, b in zip(at[:-1], at[1:])]


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    def maker():
        codec = Codec(shared.value)

        def make(texts: pa.Array) -> list[pa.Array]:
            lists = [*codec.encode_all([t or "" for t in texts.to_pylist()])]
            ends = np.cumsum([0, *map(len, lists)]) // 4
            items = np.frombuffer(b"".join(lists), np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(items))]

        return make

    return attach(docs, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], maker)


def decode(docs: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the text of every list of ids; a null list is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(load(path))

    def maker():
        codec = Codec(shared.value)

        def make(lists: pa.Array) -> list[pa.Array]:
            ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(lists), 0).to_pylist()])
            items = pc.fill_null(lists.flatten(), -1).to_numpy()
            return [pa.array(codec.decode(items.astype(np.int64), ends.astype(np.int64)), pa.string())]

        return make

    return attach(docs, ids, [T.StructField(decoded, T.StringType())], maker)
