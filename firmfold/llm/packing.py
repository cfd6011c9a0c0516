"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Documents are tokenised whole; only those longer than the capacity are cut, into
pieces of exactly the capacity and a last, shorter one. Pieces are dealt at random
onto shards of about ``SHARD_PIECES``, which bounds what one task holds; a shard
wastes at most its last, partly filled sequence. In each shard:

1. large pieces (over a quarter of the capacity) are sorted and cut into groups of
   equal cardinality; every length is rounded up to its group's largest,
2. the configurations of those few sizes that fit a sequence (three large pieces at
   most) enter a linear program for the fewest sequences; its whole part is taken and
   the rest filled with the fullest configurations that the remaining pieces allow,
3. the actual, shorter pieces take the places of their groups,
4. all pieces that have no place yet go, longest first, where they leave the least room
   of the actual rooms,
5. where rounding up cost more than it won, the shard is packed by step 4 alone.

Defined results: a null or empty text is one piece that holds the end token alone;
rows with repeated or null ids are packed as separate documents; an empty table
gives no piece. Only the named columns are read. Token ids equal those of the
vocabulary's own tokenizer: in texts of Latin script, what stands between blanks is
looked up in a cache that the tokenizer's merges fill, every other text goes through the
tokenizer whole.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
import zlib
from array import array
from itertools import combinations_with_replacement
from types import ModuleType
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmfold.llm.common import pick, written

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
CAPACITY = 4096
SHARD_PIECES = 8192
GROUPS = 20
_CACHE_WORDS, _CACHE_RUNS = 500_000, 250_000
_CACHE_CHARS = 64
_LATIN_END = "ɐ"

_PIECES = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


class _Memory(dict):
    """Ids by text, worked out when first asked for; emptied when full, long texts are not kept."""

    def __init__(self, find, room: int) -> None:
        self._find, self._room = find, room

    def __missing__(self, text: str) -> bytes:
        ids = self._find(text)
        if len(text) <= _CACHE_CHARS:
            if len(self) >= self._room:
                self.clear()
            self[text] = ids
        return ids


def _small_letters(kind: str) -> str:
    """Lower-case forms of the Latin characters of a Unicode kind, for use in a character class."""
    forms = {c for k in range(ord(_LATIN_END)) for c in chr(k).lower()}
    return "".join(sorted(re.escape(c) for c in forms if unicodedata.category(c).startswith(kind)))


class Encoder:
    """Token ids of a text as little-endian 32-bit numbers."""

    def __init__(self, vocabulary: str) -> None:
        import public_tokenizers
        from tokenizers import Tokenizer

        path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        self._whole = Tokenizer.from_file(path)
        # Fixed value: the vocabulary's own split of lower-cased text, here for Latin script.
        letters, numbers = _small_letters("L"), _small_letters("N")
        self._split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+").findall
        # Beyond Latin script, at separators that are blanks to some libraries only, and where
        # added tokens may stand, rules differ between libraries.
        self._foreign = re.compile(rf"[{_LATIN_END}-\U0010FFFF\x1C-\x1F]|<\|").search
        # Visible bytes stand for themselves, the others for code points from 256 on.
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in visible]
        self._bytes = {b: 256 + k for k, b in enumerate(hidden)}
        self._words = _Memory(self._merged, _CACHE_WORDS)
        # No word reaches across a blank.
        self._runs = _Memory(lambda run: b"".join(map(self._words.__getitem__, self._split(run))), _CACHE_RUNS)

    def _merged(self, word: str) -> bytes:
        raw = word.encode().decode("latin-1").translate(self._bytes)
        ids = array("I", [token.id for token in self._whole.model.tokenize(raw)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        if self._foreign(text):
            ids = self._whole.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        return b"".join(map(self._runs.__getitem__, text.lower().split()))


def _encoder(vocabulary: str) -> Encoder:
    """The worker process's encoder. Functions reach workers by value, so what is to outlive a task hangs on
    a module of the process's own; it only saves work, results do not depend on it."""
    memory = sys.modules.setdefault("_firmfold_worker_memory", ModuleType("_firmfold_worker_memory")).__dict__
    if vocabulary not in memory:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        memory[vocabulary] = Encoder(vocabulary)
    return memory[vocabulary]


def tokenised(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, with_ids: bool = False,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, ids (null unless asked for)."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(vocabulary).encode
        for batch in batches:
            rows = []
            for doc, text in zip(batch["id"], batch["text"]):
                ids = memoryview(encode(text or "") + end)
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), bytes(part) if with_ids else None))
            yield pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32", "ids"]).astype({"id": "Int64"})

    return pick(docs, id=id_col, text=text_col).mapInPandas(cut, _PIECES)


def _fewest(sizes: np.ndarray, need: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Configurations (as group numbers) with how often each is used; together they meet nearly all of the need."""
    k = len(sizes)
    configs = [c for n in (1, 2, 3) for c in combinations_with_replacement(range(k), n)
               if sum(int(sizes[g]) for g in c) <= capacity]
    matrix = np.zeros((k, len(configs)))
    for j, config in enumerate(configs):
        for g in config:
            matrix[g, j] += 1
    basis = [configs.index((g,)) for g in range(k)]
    inverse = np.eye(k)
    for _ in range(50 * k):  # simplex steps; stopping early only costs optimality
        prices = inverse.sum(axis=0)
        gain = prices @ matrix - 1
        enter = int(np.argmax(gain))
        if gain[enter] < 1e-9:
            break
        direction, level = inverse @ matrix[:, enter], inverse @ need
        ratio = np.where(direction > 1e-9, level / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(np.argmin(ratio))
        basis[leave] = enter
        inverse = np.linalg.inv(matrix[:, basis])
    used: dict[int, int] = {}
    left = need.copy()
    for j, amount in zip(basis, np.floor(inverse @ need + 1e-9).astype(int)):
        if amount > 0:
            used[j] = used.get(j, 0) + int(amount)
            left -= int(amount) * matrix[:, j].astype(int)
    filled = sizes @ matrix
    for j in np.argsort(-filled, kind="stable"):
        if filled[j] * 8 < capacity * 7:  # what is left finds its place by its actual length
            break
        mine = matrix[:, j] > 0
        times = int(min(left[mine] // matrix[mine, j].astype(int)))
        if times > 0:
            used[int(j)] = used.get(int(j), 0) + times
            left -= times * matrix[:, j].astype(int)
    return [(configs[j], times) for j, times in used.items()]


class _Rooms:
    """Open sequences of one shard; a bit per room that occurs finds the tightest fit."""

    def __init__(self, length: np.ndarray, capacity: int) -> None:
        self._length, self._capacity = length.tolist(), capacity
        self.sequence, self.offset = [-1] * len(length), [0] * len(length)
        self.room: list[int] = []

    def open(self) -> int:
        self.room.append(self._capacity)
        return len(self.room) - 1

    def put(self, item: int, at: int) -> None:
        self.sequence[item], self.offset[item] = at, self._capacity - self.room[at]
        self.room[at] -= self._length[item]

    def best_fit(self, items) -> None:
        """Each of the items where it leaves the least room."""
        by_room: list[list[int]] = [[] for _ in range(self._capacity + 1)]
        mask = 0
        for at, r in enumerate(self.room):
            by_room[r].append(at)
            mask |= 1 << r
        for item in items:
            need = self._length[item]
            fits = mask >> need
            if fits:
                r = need + (fits & -fits).bit_length() - 1
                at = by_room[r].pop()
                if not by_room[r]:
                    mask ^= 1 << r
            else:
                at = self.open()
            self.put(item, at)
            r = self.room[at]
            by_room[r].append(at)
            mask |= 1 << r


def pack_shard(length: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number (from 0) and offset of every piece of one shard."""
    rooms = _Rooms(length, capacity)
    order = np.argsort(-length, kind="stable")
    large = order[(length[order] < capacity) & (length[order] * 4 > capacity)]
    for item in order[length[order] == capacity]:
        rooms.put(item, rooms.open())
    if len(large):
        bounds = np.unique(np.linspace(0, len(large), min(groups, len(large)) + 1).astype(int))
        members = [list(large[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        sizes = np.array([length[m[0]] for m in members])
        need = np.array([len(m) for m in members])
        for config, times in _fewest(sizes, need, capacity):
            for _ in range(times):
                at = rooms.open()
                for g in config:
                    rooms.put(members[g].pop(), at)
    rooms.best_fit([item for item in order.tolist() if rooms.sequence[item] < 0])
    if len(large) and len(rooms.room) > -(-int(length.sum()) // capacity):
        plain = _Rooms(length, capacity)
        plain.best_fit(order.tolist())
        if len(plain.room) < len(rooms.room):
            rooms = plain
    return np.array(rooms.sequence, dtype=np.int64), np.array(rooms.offset, dtype=np.int64)


def packed(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a written table of pieces that has a ``length`` column."""
    shards = max(1, -(-pieces.count() // shard_pieces))
    names = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = pack_shard(rows["length"].to_numpy(), capacity)
        out = rows[names].copy()
        out["sequence_id"], out["offset"] = sequence + (int(rows["shard"].iloc[0]) << 32), offset
        return out

    return dealt.groupBy("shard").applyInPandas(pack, f"{schema}, sequence_id bigint, `offset` bigint")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    slim = tokenised(docs, capacity, vocabulary, id_col=id_col, text_col=text_col).drop("ids")
    return packed(written(slim, "pieces"), capacity).withColumnRenamed("id", id_col)


def sequences(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id, length, ids (little-endian 32-bit), parts in order."""
    whole = written(tokenised(docs, capacity, vocabulary, True, id_col, text_col), "pieces")
    part = F.struct("offset", "length", F.col("id").alias(id_col), "piece", "ids")
    rows = packed(whole, capacity).groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return rows.select("sequence_id", F.expr("cast(aggregate(parts, 0L, (n, p) -> n + p.length) as bigint)").alias("length"),
                       joined.alias("ids"), F.transform("parts", lambda p: p.dropFields("ids")).alias("parts"))
