"""Byte-level BPE over whole columns of text, in numpy (problem 7).

Method: the distinct pre-tokens of a batch become rows of padded matrices, bucketed by length. Each round every row
merges its leftmost pair of minimum rank; pair ranks come from an open-addressing hash table held in two arrays, and
only the two pairs beside a merge are looked up again. Finished rows leave the matrix (compaction). Rows longer than
``LONG`` bytes are merged one by one, all occurrences of the minimum-rank pair in a round: a merge's token can only
take part in later merges, so this gives the same ids.

A null text and an empty text both give an empty list. Strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..runtime import widen

#: Where the vocabulary file lies on every node; pass another path to use another byte-level BPE.
DEFAULT_VOCAB = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the published pre-token pattern of this vocabulary.
PRE_TOKEN = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
INF = np.iinfo(np.int32).max
LONG = 512
CHUNK_CHARS = 1_000_000
CACHE_TOKENS = 300_000


def byte_alphabet() -> dict[str, int]:
    """The printable character standing for each byte in the vocabulary file: printable Latin-1 bytes stand for
    themselves, the others follow from U+0100 in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairTable:
    """(left id, right id) -> (rank, merged id) by open addressing with linear probing."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, ids: np.ndarray):
        self.bits = max(4, int(len(keys) * 4).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, INF, np.int32)
        self.ids = np.zeros(size, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            won = np.zeros(len(slot), bool)
            won[first] = True
            won &= free
            at = slot[won]
            self.keys[at], self.ranks[at], self.ids[at] = keys[left[won]], ranks[left[won]], ids[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks (INF where there is no such pair) and merged ids."""
        slot = self._slot(keys)
        there = self.keys[slot]
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[open_]]
            open_ = open_[(there != keys[open_]) & (there != -1)]
        hit = self.keys[slot] == keys
        return np.where(hit, self.ranks[slot], INF), self.ids[slot]


class ByteBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.base = 1 << 20
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        ids = np.array([vocab[a + b] for a, b in pairs], np.int32)
        if len(np.unique(ids)) < len(ids):
            raise ValueError(f"{path}: a token has two merges; long words and short ones could then be merged in another order")
        self.table = PairTable(keys, np.arange(len(pairs), dtype=np.int32), ids)
        self.of_byte = np.zeros(256, np.int32)
        for ch, b in byte_alphabet().items():
            self.of_byte[b] = vocab[ch]
        letters = byte_alphabet()
        self.bytes_of = {i: bytes(map(letters.__getitem__, t)) for t, i in vocab.items() if all(c in letters for c in t)}
        self._forget()

    def decode(self, ids: Iterable[int]) -> str:
        """The text that gives these ids."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8")

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.sizes = np.zeros(1 << 14, np.int64)

    def _merge_long(self, raw: bytes) -> np.ndarray:
        x = self.of_byte[np.frombuffer(raw, np.uint8)].astype(np.int64)
        rank, made = self.table.find(x[:-1] * self.base + x[1:])
        while len(rank) and (low := rank.min()) != INF:
            at = np.flatnonzero(rank == low)
            if len(at) > 1 and (np.diff(at) == 1).any():  # a run of overlapping pairs: every other one, from its left
                head = np.r_[True, np.diff(at) != 1]
                begin = np.maximum.accumulate(np.where(head, at, 0))
                at = at[(at - begin) % 2 == 0]
            x[at] = made[at]
            keep = np.ones(len(x), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep)[at] - 1
            kept = np.flatnonzero(keep)
            x, rank, made = x[keep], np.append(rank, INF)[kept][:-1], np.append(made, 0)[kept][:-1]
            near = np.unique(np.r_[moved - 1, moved])
            near = near[(near >= 0) & (near < len(x) - 1)]
            rank[near], made[near] = self.table.find(x[near] * self.base + x[near + 1])
        return x.astype(np.int32)

    def _merge_rows(self, rows: list[bytes]) -> list[np.ndarray]:
        """Ids of byte strings of similar length (at least one byte each)."""
        size = np.array([len(r) for r in rows])
        width = int(size.max())
        flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
        x = self.of_byte[flat].astype(np.int64)
        out: list[np.ndarray] = [None] * len(rows)  # type: ignore[list-item]
        who = np.arange(len(rows))
        cols = np.arange(width)
        rank = np.full((len(rows), width), INF, np.int32)
        made = np.zeros((len(rows), width), np.int32)
        if width > 1:
            r, m = self.table.find((x[:, :-1] * self.base + x[:, 1:]).ravel())
            rank[:, :-1], made[:, :-1] = r.reshape(len(rows), -1), m.reshape(len(rows), -1)
            rank[cols[None, :] >= size[:, None] - 1] = INF
        while len(who):
            at = rank.argmin(axis=1)
            done = rank[np.arange(len(who)), at] == INF
            if done.any():
                for i in np.flatnonzero(done):
                    out[who[i]] = x[i, : size[i]].astype(np.int32)
                go = ~done
                who, x, rank, made, size, at = who[go], x[go], rank[go], made[go], size[go], at[go]
                if not len(who):
                    break
                width = int(size.max())
                x, rank, made, cols = x[:, :width].copy(), rank[:, :width].copy(), made[:, :width].copy(), cols[:width]
            n = np.arange(len(who))
            x[n, at] = made[n, at]
            # close the gap at ``at + 1``
            source = np.minimum(cols[None, :] + (cols[None, :] > at[:, None]), width - 1)
            x, rank, made = (np.take_along_axis(a, source, 1) for a in (x, rank, made))
            size = size - 1
            rank[n, size - 1] = INF
            rank[:, width - 1] = INF
            for p in (at - 1, at):
                ok = np.flatnonzero((p >= 0) & (p < size - 1))
                q = p[ok]
                rank[ok, q], made[ok, q] = self.table.find(x[ok, q] * self.base + x[ok, q + 1])
        return out

    def _learn(self, tokens: list[str]) -> None:
        """Encode pre-tokens not met before and keep their ids in the pool."""
        raw = [t.encode("utf-8") for t in tokens]
        ids: list[np.ndarray] = [None] * len(raw)  # type: ignore[list-item]
        size = np.array([len(r) for r in raw])
        for i in np.flatnonzero(size > LONG):
            ids[i] = self._merge_long(raw[i])
        low = 0
        for high in (2, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256, LONG):
            rows = np.flatnonzero((size > low) & (size <= high))
            step = max(1, 2_000_000 // high)
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                for i, x in zip(part, self._merge_rows([raw[i] for i in part])):
                    ids[i] = x
            low = high
        first, count = len(self.known), np.array([len(x) for x in ids])
        total = int(count.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.int32)])
        while first + len(ids) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(len(self.starts), np.int64)])
            self.sizes = np.concatenate([self.sizes, np.zeros(len(self.sizes), np.int64)])
        self.pool[self.used : self.used + total] = np.concatenate(ids)
        self.starts[first : first + len(ids)] = self.used + np.cumsum(count) - count
        self.sizes[first : first + len(ids)] = count
        self.used += total
        self.known.update(zip(tokens, range(first, first + len(ids))))

    def encode(self, texts: list[str | None], ids: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """All ids one after another (None if not wanted) and the number of ids of each text."""
        found, counts = [], []
        k = 0
        while k < len(texts):
            chars, tokens, ends = 0, [], []
            while k < len(texts) and chars < CHUNK_CHARS:
                text = texts[k]
                if text:
                    tokens += PRE_TOKEN.findall(text)
                    chars += len(text)
                ends.append(len(tokens))
                k += 1
            if len(self.known) > CACHE_TOKENS or self.used > 8 * CACHE_TOKENS:
                self._forget()
            at = list(map(self.known.get, tokens))
            if None in at:
                self._learn(list({t for t, i in zip(tokens, at) if i is None}))
                at = list(map(self.known.__getitem__, tokens))
            index = np.array(at, np.int64)
            size = self.sizes[index]
            upto = np.r_[0, np.cumsum(size)]
            counts.append(np.diff(upto[np.r_[0, np.array(ends, np.int64)]]))
            if ids:
                found.append(self.pool[np.repeat(self.starts[index] - upto[:-1], size) + np.arange(upto[-1])])
        flat = (np.concatenate(found) if found else np.zeros(0, np.int32)) if ids else None
        return flat, (np.concatenate(counts) if counts else np.zeros(0, np.int64))


_loaded: dict[str, ByteBPE] = {}


def bpe(path: str) -> ByteBPE:
    """The tokenizer of this worker; read once."""
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]


def encode_documents(df: DataFrame, id_col: str, text_col: str, vocab: str = DEFAULT_VOCAB) -> DataFrame:
    """``<id_col>, ids array<int>``: one row for each row of ``df``; no shuffle."""
    source = widen(df.select(id_col, text_col))
    schema = T.StructType([source.schema[0], T.StructField("ids", T.ArrayType(T.IntegerType()), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(vocab)
        for b in batches:
            flat, counts = model.encode(b.column(1).to_pylist())
            offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=[id_col, "ids"])

    return source.mapInArrow(run, schema)


def count_tokens(df: DataFrame, text_col: str, name: str = "n_tokens", vocab: str = DEFAULT_VOCAB) -> DataFrame:
    """``df`` without ``text_col``, with the number of its tokens as ``name`` (replacing such a column); no shuffle."""
    keep = [c for c in df.columns if c not in (text_col, name)]
    source = widen(df.select(*keep, text_col))
    schema = T.StructType([*[source.schema[c] for c in keep], T.StructField(name, T.LongType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(vocab)
        for b in batches:
            _, counts = model.encode(b.column(len(keep)).to_pylist(), ids=False)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(counts, pa.int64())], names=[*keep, name])

    return source.mapInArrow(run, schema)


def decode_documents(df: DataFrame, id_col: str, ids_col: str, name: str = "text", vocab: str = DEFAULT_VOCAB) -> DataFrame:
    """``<id_col>, <name>``: the texts of lists of ids; the empty text of an empty or null list."""
    rows = df.select(id_col, ids_col)
    schema = T.StructType([rows.schema[0], T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(vocab)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([model.decode(x or ()) for x in b.column(1).to_pylist()], pa.string())], names=[id_col, name])

    return rows.mapInArrow(run, schema)
