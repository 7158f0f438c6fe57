"""Byte-level BPE: ranked merges folded over the byte arrays of distinct words, and decoding.

A text is cut at spaces that no pretoken can span, so most pieces repeat and each distinct piece of
a task is split by the pattern and merged once. The rank map is the vocabulary file itself, read on
the driver (its size is the vocabulary's, whatever the data) and sent to every task.

Defined cases: a null or empty text has no tokens and decodes to nothing; repeated rows and rows
without an id give one output row each; the length of a text is not bounded; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import functools
import gc
import hashlib
import itertools
import json
import operator
import re
import sys
import types
import zlib
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.common import map_carried, sha256

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes that a Python worker remembers pieces and words in; bounds memory, not results.
REMEMBERED = 256 << 20
#: What an entry takes beside its characters: keys, values and the slot of the dictionary.
_ENTRY, _PER_CHAR = 260, 4
#: Words folded at once, and the longest that is folded with others.
FOLDED, WIDEST = 20_000, 48
#: A space followed by a visible character always begins a new pretoken.
_CUT = re.compile(r" (?=\S)")
#: A space that ends the text or stands before other white space.
_RUN = re.compile(r" (?!\S)")
#: Marks the first piece of a text; as white space it cannot follow a cut.
FIRST = " \n"
NO_RANK = 1 << 60
_MASK, _LOW = (1 << 64) - 1, (1 << 21) - 1
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

Ranks = dict[bytes, int]


def read_ranks(path: str) -> Ranks:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_word(word: bytes, ranks: Ranks) -> list[int]:
    """Ids of one word: starting from single bytes, the adjacent pair of lowest rank is merged until
    no pair has a rank; of equal ranks the leftmost goes first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 400:
        return _merge_long(word, ranks)
    find = ranks.get
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [find(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
    while pairs:
        lowest = min(pairs)
        if lowest == NO_RANK:
            break
        at = pairs.index(lowest)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = find(parts[at] + parts[at + 1], NO_RANK)
        if at:
            pairs[at - 1] = find(parts[at - 1] + parts[at], NO_RANK)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: Ranks) -> list[int]:
    """The same merges for very long words, with a heap and linked parts: n log n steps."""
    import heapq

    n = len(word)
    end = list(range(1, n + 1))
    before, alive = list(range(-1, n - 1)), [True] * n
    heap = [(ranks[word[i : i + 2]], i, i + 1, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, at, middle, stop = heapq.heappop(heap)
        if not alive[at] or end[at] != middle or middle >= n or end[middle] != stop:
            continue
        alive[middle] = False
        end[at] = stop
        if stop < n:
            before[stop] = at
            joined = ranks.get(word[at : end[stop]])
            if joined is not None:
                heapq.heappush(heap, (joined, at, stop, end[stop]))
        if before[at] >= 0:
            prior = before[at]
            joined = ranks.get(word[prior:stop])
            if joined is not None:
                heapq.heappush(heap, (joined, prior, at, stop))
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at : end[at]]])
        at = end[at]
    return out


class RankTable:
    """The literal rank map for numpy: (left id, right id) to the id of the merged token.

    Each pair sits in one of two slots of one array, packed with its result, so a lookup is two
    gathers. Built once on the driver; its size is the vocabulary's.
    """

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self.digest = hashlib.sha256(repr(sorted(ranks.items(), key=lambda r: r[1])).encode()).hexdigest()
        self.bytes_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        if (self.bytes_ids < 0).any():
            raise ValueError("a byte-level vocabulary holds every single byte")
        packed = []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    packed.append(left << 42 | right << 21 | rank)
        self.bits = max(10, (4 * len(packed)).bit_length())
        slots = [-1] * (1 << self.bits)
        for entry in packed:
            side = 0
            while entry >= 0:
                at = self._slot_of(entry >> 21, side)
                entry, slots[at] = slots[at], entry
                if entry >= 0:
                    side = 1 - side if self._slot_of(entry >> 21, side) == at else side
        self.slots = np.array(slots, np.int64)

    def _slot_of(self, key: int, side: int) -> int:
        return (key * _MULTIPLIERS[side] & _MASK) >> (64 - self.bits)

    def _slot(self, keys: np.ndarray, side: int) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(_MULTIPLIERS[side])) >> np.uint64(64 - self.bits)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``NO_RANK`` where the pair is no token, or a side is missing (negative)."""
        keys = left << 21 | right
        one, two = self.slots[self._slot(keys, 0)], self.slots[self._slot(keys, 1)]
        found = np.where(one >> 21 == keys, one & _LOW, np.where(two >> 21 == keys, two & _LOW, NO_RANK))
        return np.where((left < 0) | (right < 0), NO_RANK, found)

    def merge_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of distinct words: the merges of all of them are folded together, one per step."""
        out: list[list[int] | None] = [[r] if (r := self.ranks.get(w)) is not None else None for w in words]
        todo = sorted((len(w), i) for i, w in enumerate(words) if out[i] is None)
        for start in range(0, len(todo), FOLDED):
            chunk = todo[start : start + FOLDED]
            longest = chunk[-1][0]
            if longest > WIDEST:
                for length, i in [c for c in chunk if c[0] > WIDEST]:
                    out[i] = merge_word(words[i], self.ranks)
                chunk = [c for c in chunk if c[0] <= WIDEST]
                longest = chunk[-1][0] if chunk else 0
            if chunk:
                self._fold([i for _, i in chunk], words, longest, out)
        return out

    def _fold(self, which: list[int], words: list[bytes], longest: int, out: list) -> None:
        width = longest + 1
        flat = np.frombuffer(b"".join([words[i].ljust(width, b"\0") for i in which]), np.uint8).reshape(-1, width)
        lengths = np.array([len(words[i]) for i in which])
        column = np.arange(width)
        ids = np.where(column < lengths[:, None], self.bytes_ids[flat], -1)
        where = np.array(which)
        pairs = self.find(ids[:, :-1], ids[:, 1:])
        while len(ids):
            at = pairs.argmin(axis=1)
            row = np.arange(len(ids))
            lowest = pairs[row, at]
            done = lowest == NO_RANK
            if done.any():
                sizes = (ids[done] >= 0).sum(axis=1).tolist()
                for i, size, values in zip(where[done].tolist(), sizes, ids[done].tolist(), strict=True):
                    out[i] = values[:size]
                keep = ~done
                ids, pairs, where, at, lowest = ids[keep], pairs[keep], where[keep], at[keep], lowest[keep]
                row = row[: len(ids)]
                if not len(ids):
                    break
            # The merged pair takes the left place; everything right of it moves up by one.
            moved = column[:-1] + (column[:-1] > at[:, None])
            ids = np.concatenate([np.take_along_axis(ids, moved, 1), np.full((len(ids), 1), -1)], axis=1)
            ids[row, at] = lowest
            pairs = np.take_along_axis(np.concatenate([pairs, np.full((len(ids), 1), NO_RANK)], axis=1), moved, 1)
            pairs[row, at] = self.find(lowest, ids[row, at + 1])
            inner = row[at > 0]
            left = at[at > 0]
            pairs[inner, left - 1] = self.find(ids[inner, left - 1], lowest[at > 0])


@contextmanager
def no_collection() -> Iterator[None]:
    """Without Python's search for cycles, which would walk through all that is remembered every time some
    thousand entries are new. What is made inside has no cycles."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


class Memory(dict):
    """A dictionary by text that forgets its older half when its estimated bytes pass ``budget``."""

    def __init__(self, budget: int):
        super().__init__()
        self.budget, self.taken = budget, 0

    def room(self, keys: list[str]) -> bool:
        """Make room for new keys; true if something was forgotten."""
        needed = len(keys) * _ENTRY + _PER_CHAR * sum(map(len, keys))
        forgotten = self.taken + needed > self.budget and len(self) > 0
        while self and self.taken + needed > self.budget:
            for key in list(itertools.islice(self, (len(self) + 1) // 2)):
                self.taken -= _ENTRY + _PER_CHAR * len(key)
                del self[key]
        self.taken += needed
        return forgotten


class Pieces(Memory):
    """What is known of each distinct piece of text. ``learn`` splits the new pieces of many texts into
    words and merges the new words together; ``keep`` turns the ids of a word into what is remembered, and
    ``joined`` makes a piece's of those of its words. Words are remembered apart, so a piece that differs
    in its punctuation merges nothing again, and a piece of one word is remembered as that word is."""

    def __init__(
        self,
        pattern: str,
        table: RankTable,
        keep: Callable[[list[int]], object],
        budget: int = REMEMBERED,
        joined: Callable[[list], object] = functools.partial(functools.reduce, operator.add),
    ):
        super().__init__(budget * 2 // 3)
        self.find, self.table, self.keep, self.joined = regex.compile(pattern).findall, table, keep, joined
        self.words = Memory(budget // 3)

    def _words(self, piece: str) -> list[str]:
        if piece.isalpha() or (piece[:1] == " " and piece[1:].isalpha()):
            return [piece]
        if (core := piece[:-1])[1:].isalpha() and piece[-1:] in ",." and (core[:1] == " " or core[:1].isalpha()):
            return [core, piece[-1]]
        return self.find(piece)

    def learn(self, pieces: set[str]) -> None:
        with no_collection():
            self._learn(pieces)

    def _learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self]
        if self.room(new):
            # What was forgotten may be asked for again.
            again = [p for p in pieces if p not in self]
            self.taken += sum(_ENTRY + _PER_CHAR * len(p) for p in again) - sum(_ENTRY + _PER_CHAR * len(p) for p in new)
            new = again
        split = [self._words(p[len(FIRST) :] if p.startswith(FIRST) else " " + p) for p in new]
        asked = set(itertools.chain.from_iterable(split))
        merged = {w: self.words[w] for w in asked if w in self.words}
        words = [w for w in asked if w not in merged]
        self.words.room(words)
        made = self.table.merge_words([w.encode("utf-8", "surrogatepass") for w in words])
        fresh = dict(zip(words, map(self.keep, made), strict=True))
        self.words.update(fresh)
        merged |= fresh
        joined = self.joined
        for piece, ws in zip(new, split, strict=True):
            self[piece] = merged[ws[0]] if len(ws) == 1 else joined([merged[w] for w in ws]) if ws else self.keep([])


def worker_pieces(name: tuple, make: Callable[[], Pieces]) -> Pieces:
    """The pieces that this Python worker knows under ``name``; tasks of one worker share them. Only one
    name is remembered, so the budget holds for the worker."""
    held = sys.modules.setdefault("_ratingloom_pieces", types.ModuleType("_ratingloom_pieces"))
    if getattr(held, "name", None) != name:
        held.name, held.pieces = name, make()
    return held.pieces


def cut_text(text: str | None) -> list[str]:
    """Pieces of a text that no pretoken spans. All but the first lack their leading space, so the
    first is marked with a form no other piece has."""
    if not text:
        return []
    pieces = _CUT.split(text) if _RUN.search(text) else text.split(" ")
    pieces[0] = FIRST + pieces[0]
    return pieces


def decode(ids: Iterator[int] | list[int], pieces: list[bytes]) -> bytes:
    """The bytes of token ids."""
    return b"".join(map(pieces.__getitem__, ids))


def pieces_by_id(ranks: Ranks) -> list[bytes]:
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        out[rank] = piece
    return out


def encode_texts(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    text_col: str = "text",
    id_col: str = "doc_id",
    carry: tuple[str, ...] = (),
    remembered: int = REMEMBERED,
    shared: bool = True,
) -> DataFrame:
    """(id_col, ids array<int>, decoded, carried columns): the token ids of every whole text, and the
    text that they decode to. ``remembered`` bounds the bytes of a worker's memory of pieces; without
    ``shared`` it ends with the task, so that what a worker runs next has its room."""
    return _encoded(df, ranks_path, pattern, text_col, id_col, "ids array<int>, decoded string", _keep_ids, _join_ids, _as_ids, carry, remembered, shared)


def _keep_ids(pieces: list[bytes], ids: list[int]) -> tuple[bytes, bytes]:
    """Ids as packed integers, a small part of what a list of them takes."""
    return array("i", ids).tobytes(), decode(ids, pieces)


def _join_ids(known: list[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
    return b"".join([packed for packed, _ in known]), b"".join([data for _, data in known])


def _as_ids(known: list[tuple[bytes, bytes]]) -> tuple:
    packed, data = _join_ids(known)
    return np.frombuffer(packed, np.intc), data.decode("utf-8", "replace")


def encode_digests(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256): ids are made, hashed and decoded in the task
    that read the text, so neither text nor ids are shuffled."""
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _encoded(df, ranks_path, pattern, text_col, id_col, schema, _keep_digest, _join_digests, _as_digest)


def _keep_digest(pieces: list[bytes], ids: list[int]) -> tuple[int, str, bytes]:
    return len(ids), ",".join(map(str, ids)), decode(ids, pieces)


def _join_digests(known: list[tuple[int, str, bytes]]) -> tuple[int, str, bytes]:
    counts, ids, data = zip(*known, strict=True)
    # The first piece of a text that begins with a space has no words.
    return sum(counts), ",".join(filter(None, ids)), b"".join(data)


def _as_digest(known: list[tuple[int, str, bytes]]) -> tuple:
    count, ids, data = _join_digests(known) if known else (0, "", b"")
    return count, sha256(ids.encode()), sha256(data)


def _encoded(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    text_col: str,
    id_col: str,
    schema: str,
    keep: Callable[[list[bytes], list[int]], object],
    joined: Callable[[list], object],
    finish: Callable[[list], tuple],
    carry: tuple[str, ...] = (),
    remembered: int = REMEMBERED,
    shared: bool = True,
) -> DataFrame:
    table = shared_table(df, ranks_path)
    return map_carried(df, id_col, text_col, carry, functools.partial(_encoder, table, pattern, keep, joined, finish, remembered, shared), schema)


def shared_table(df: DataFrame, ranks_path: str):
    """The rank table of a vocabulary, once per executor."""
    return df.sparkSession.sparkContext.broadcast(RankTable(read_ranks(ranks_path)))


def _encoder(table, pattern: str, keep: Callable, joined: Callable, finish: Callable, remembered: int, shared: bool = True) -> Callable[[list[str | None]], Iterator[tuple]]:
    def made() -> Pieces:
        pieces = pieces_by_id(table.value.ranks)
        return Pieces(pattern, table.value, functools.partial(keep, pieces), remembered, joined)

    known = worker_pieces((table.value.digest, pattern, keep.__name__, remembered), made) if shared else made()

    def apply(texts: list[str | None]) -> Iterator[tuple]:
        cuts = [cut_text(text) for text in texts]
        known.learn(set().union(*cuts))
        yield from (finish(list(map(known.__getitem__, cut))) for cut in cuts)

    return apply


def byte_lengths(ranks: Ranks) -> np.ndarray:
    return np.array([len(p) for p in pieces_by_id(ranks)], np.int64)


#: Buckets of the literal rank map of ``merge_expression``; a lookup scans one bucket.
MAP_BUCKETS = 8192


def merge_expression(word: Column, ranks: Ranks) -> Column:
    """Ids of one word as a built-in expression: higher-order functions fold the merges over the array
    of the word's bytes, with the rank map as a literal.

    A literal map is searched from its start, so the ranks lie in buckets by checksum. Bytes are
    written as hex text. For distinct words; see ``encode_texts`` for whole texts.
    """
    buckets: list[dict[str, int]] = [{} for _ in range(MAP_BUCKETS)]
    for token, rank in ranks.items():
        name = token.hex().upper()
        buckets[zlib.crc32(name.encode()) % MAP_BUCKETS][name] = rank
    literal = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")

    def rank_of(part: Column) -> Column:
        bucket = F.get(literal, F.pmod(F.crc32(part.cast("binary")), F.lit(MAP_BUCKETS)).cast("int"))
        return F.try_element_at(bucket, part)

    def step(parts: Column, _: Column) -> Column:
        n = F.size(parts)
        pairs = F.zip_with(F.slice(parts, F.lit(1), n - 1), F.slice(parts, F.lit(2), n - 1), lambda a, b: rank_of(F.concat(a, b)))
        # A lambda variable holds the ranks of the pairs, so they are looked up once per step.
        return F.transform(F.array(pairs), lambda found: _merge_lowest(parts, found))[0]

    digits = F.hex(word.cast("binary"))
    size = F.octet_length(word)
    single = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.substr(digits, 2 * i + 1, F.lit(2)))
    whole = rank_of(digits)
    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), size - 1)), single, step)
    ids = F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(folded, rank_of))
    return F.when(size > 0, ids).otherwise(F.array().cast("array<int>"))


def _merge_lowest(parts: Column, found: Column) -> Column:
    at = F.array_position(found, F.array_min(found)).cast("int")
    joined = F.array(F.concat(F.get(parts, at - 1), F.get(parts, at)))
    merged = F.concat(F.slice(parts, F.lit(1), at - 1), joined, F.slice(parts, at + 2, F.size(parts)))
    return F.when(F.array_min(found).isNull(), parts).otherwise(merged)
