"""Byte-level BPE from a rank file: exact merges by longest match and backtracking.

A sequence of tokens is what the merges give exactly if every two neighbours
are *compatible*: merging their joined bytes gives the two back. So the encoder
takes the longest token at each place, found by an Aho-Corasick automaton over
bytes mapped to Latin-1, falls back to its shorter prefixes while it is not
compatible with the token before, and steps back where none is. Each place is
given up at most once, and compatibility is memoised, so the time is linear.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import Codes, ragged

GROUP_CHARS = 500_000
CACHED_PIECES = 150_000
CACHED_PAIRS = 300_000
NEVER = 1 << 62
BREAK = "Ā"  # in no Latin-1 text


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from lines of base64 and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


class ByteBpe:
    """Encoder and decoder of one vocabulary; every single byte must be a token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.parts: dict[int, tuple[int, int]] = {}  # the two tokens that merge into a token
        self.pairs: dict[int, bool] = {}
        self.shorter: dict[int, int] = {}  # the longest token that is a proper prefix
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                made = next(
                    (
                        (a, b) for i in range(1, len(token))
                        if (a := ranks.get(token[:i], NEVER)) < rank and (b := ranks.get(token[i:], NEVER)) < rank
                        and self._reachable(a) and self._reachable(b) and self._meets(a, b, rank)
                    ),
                    None,
                )
                if made is None:  # no merges lead here; only a whole piece can be this token
                    continue
                self.parts[rank] = made
            self.automaton.add_word(token.decode("latin-1")[::-1], rank)
        for token, rank in ranks.items():
            prefixes = (ranks.get(token[:i], -1) for i in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((p for p in prefixes if p >= 0 and self._reachable(p)), -1)
        self.automaton.make_automaton()
        self.pairs.clear()
        size = max(ranks.values(), default=-1) + 1
        lengths = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        self.lengths = lengths
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        self.table = np.frombuffer(b"".join(self.bytes_of.get(r, b"") for r in range(size)), np.uint8)
        self.decimal = [str(r) for r in range(size)]
        self._forget()

    def _forget(self) -> None:
        self.codes = Codes()
        self.pool, self.ends = array("i"), array("q", [0])

    def _reachable(self, token: int) -> bool:
        return token in self.parts or len(self.bytes_of[token]) == 1

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one edge of ``token`` from its byte up, each with the rank that uses it up."""
        found, used = [], NEVER
        while True:
            found.append((token, used))
            if token not in self.parts:
                return found[::-1]
            used, token = token, self.parts[token][side]

    def _meets(self, left: int, right: int, below: int = NEVER) -> bool:
        """Whether merges of rank under ``below`` turn both tokens' joined bytes into the two tokens.

        Follows the tokens that touch at the boundary in the order in which
        merges use them up. A merge over the boundary wins if its rank is below
        that of both merges inside; at the same rank the leftmost goes first.
        """
        ranks, bytes_of = self.ranks, self.bytes_of
        lefts, rights = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (a, a_used), (b, b_used) = lefts[i], rights[j]
            joined = ranks.get(bytes_of[a] + bytes_of[b], NEVER)
            if joined < min(a_used, below) and joined <= b_used:
                return False
            if a_used == b_used == NEVER:
                return True
            if a_used <= b_used:
                i += 1
            else:
                j += 1

    def _compatible(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self._meets(left, right)
        return known

    def _walk(self, longest: list[int], base: int, size: int) -> list[int]:
        """Tokens of a piece; ``longest[base - p]`` is the longest token at its place ``p``."""
        tokens: list[int] = []
        dead: set[int] = set()
        place, token, shorter, bytes_of = 0, longest[base], self.shorter, self.bytes_of
        while True:
            end = place + len(bytes_of[token])
            if end not in dead and (not tokens or self._compatible(tokens[-1], token)):
                tokens.append(token)
                if end == size:
                    return tokens
                place, token = end, longest[base - end]
                continue
            token = shorter[token]
            while token < 0:
                dead.add(place)
                token = tokens.pop()
                place -= len(bytes_of[token])
                token = shorter[token]

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces not seen before, all in one pass of the automaton."""
        raw = [p.encode() for p in pieces]
        hard = [r for r in raw if r not in self.ranks]
        joined = BREAK.join(r.decode("latin-1")[::-1] for r in hard)
        longest, last = [0] * len(joined), -1
        for end, token in self.automaton.iter(joined):
            if end != last:  # matches that end at one place come longest first
                longest[end], last = token, end
        base = -2
        for r in raw:
            whole = self.ranks.get(r)
            if whole is None:
                base += len(r) + 1
                self.pool.extend(self._walk(longest, base, len(r)))
            else:
                self.pool.append(whole)
            self.ends.append(len(self.pool))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text begins (one more than texts)."""
        if len(self.codes) > CACHED_PIECES or len(self.pool) > 8 * CACHED_PIECES:
            self._forget()
        codes, begins = self.codes.of([self.pattern.findall(t) for t in texts])
        new, self.codes.fresh = self.codes.fresh, []
        if new:
            self._learn(new)
        ends, pool = np.array(self.ends), np.array(self.pool, np.int32)
        places, stops = ragged(ends[codes], ends[codes + 1] - ends[codes])
        return pool[places], stops[begins]

    def decode(self, ids: np.ndarray, begins: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids, read from the table of tokens."""
        places, stops = ragged(self.offsets[ids], self.lengths[ids])
        flat = self.table[places].tobytes()
        at = stops[begins].tolist()
        return [flat[a:b] for a, b in zip(at, at[1:])]


_loaded: dict[tuple, ByteBpe] = {}


def _codec(ranks: dict[bytes, int], pattern: str) -> ByteBpe:
    """One codec per Python worker and vocabulary."""
    key = len(ranks), hash(frozenset(ranks.items())), pattern
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ByteBpe(ranks, pattern)
    return _loaded[key]


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > GROUP_CHARS:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def _map_texts(docs: DataFrame, path: str, pattern: str, rows: Callable, schema: str, kept: list[str]) -> DataFrame:
    """Encode the last column in groups of texts; ``rows`` makes the further columns of a group."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))  # one vocabulary file

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for a, b in _groups(texts):
                made = rows(codec, *codec.encode(texts[a:b]))
                names = [*kept, *made]
                arrays = [batch.column(i).slice(a, b - a) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*arrays, *made.values()], names=names)

    return docs.select(*kept, F.coalesce(F.col("text"), F.lit(""))).mapInArrow(per_batch, schema)


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` per row; null texts are empty and give no ids."""

    def rows(codec: ByteBpe, ids: np.ndarray, begins: np.ndarray) -> dict[str, pa.Array]:
        return {"ids": pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids))}

    return _map_texts(docs, path, pattern, rows, "doc_id bigint, ids array<int>", ["doc_id"])


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, decoded)``: the bytes of each row's ids; null ids give none."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for batch in batches:
            lists = batch.column(1)
            begins = np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))))
            decoded = codec.decode(np.asarray(lists.flatten()), begins)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(per_batch, "doc_id bigint, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: ids of each whole text and what they decode to.

    The ids are hashed as decimal numbers joined by commas. Rows come out as
    they came in, whatever their ``doc_id``.
    """

    def rows(codec: ByteBpe, ids: np.ndarray, begins: np.ndarray) -> dict[str, pa.Array]:
        decoded = codec.decode(ids, begins)
        at = begins.tolist()
        written = [",".join([codec.decimal[i] for i in ids[a:b].tolist()]) for a, b in zip(at, at[1:])]
        return {
            "n_tokens": pa.array(np.diff(begins)),
            "ids_sha256": pa.array([hashlib.sha256(w.encode()).hexdigest() for w in written]),
            "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
        }

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _map_texts(docs, path, pattern, rows, schema, ["doc_id"])
