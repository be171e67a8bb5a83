"""Counted word n-grams: packed for the shuffle, merged by shard, kept as sorted arrays that workers map.

An n-gram is a row of n 64-bit word hashes.  Tasks count the n-grams of a
chunk of text, deal them to shards by a hash of the whole n-gram (so no word
and no context, however frequent, gathers in one shard) and send each shard
one packed block.  A shard's blocks are merged in one task; the number of
shards follows the input, so a merge holds a bounded number of n-grams.

Merged shards may be kept in the shared folder as sorted hash arrays
(``write_arrays``).  Workers map these files (``ArrayStore``) where the folder
is mounted, and read one shard at a time through pyarrow's file systems where
it is not.  A file is written under another name and then moved, so a task
that runs twice leaves the same file.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.llm.text import mix

#: N-grams of one shard, as far as the size of the texts tells (about five bytes a word).
SHARD_GRAMS = 1 << 20
#: Positions counted in one numpy step.
STEP_GRAMS = 1 << 18
#: Rows that a task gathers before it deals them out: a row repeated among them is sent once.
POOL_ROWS = 1 << 19
_Q = np.uint64(0xA24BAED4963EE407)
_KINDS = {c: np.dtype(c) for c in ("u1", "u2", "u4", "u8", "i8", "f8")}
_CODES = list(_KINDS)


def least(a: np.ndarray) -> np.ndarray:
    """The non-negative integers in the smallest unsigned type that holds them."""
    top = int(a.max()) if len(a) else 0
    return a.astype("u1" if top < 1 << 8 else "u2" if top < 1 << 16 else "u4" if top < 1 << 32 else "u8")


def dump(arrays: list[np.ndarray]) -> bytes:
    """Arrays as one block: kinds and lengths, then the data, each 8-byte aligned."""
    head = np.array([len(arrays)] + [x for a in arrays for x in (_CODES.index(a.dtype.str[1:]), len(a))], "i8")
    out = [head.tobytes()]
    for a in arrays:
        out += [a.tobytes(), b"\0" * (-a.nbytes % 8)]
    return b"".join(out)


def load(block) -> list[np.ndarray]:
    """The arrays of a block, as views of it."""
    n = int(np.frombuffer(block, "i8", 1)[0])
    head = np.frombuffer(block, "i8", 2 * n, 8).tolist()
    out, at = [], 8 + 16 * n
    for code, size in zip(head[::2], head[1::2]):
        kind = _KINDS[_CODES[code]]
        out.append(np.frombuffer(block, kind, size, at))
        at += size * kind.itemsize + -(size * kind.itemsize) % 8
    return out


def edges_of(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    new = np.ones(len(sorted_values), bool)
    new[1:] = sorted_values[1:] != sorted_values[:-1]
    return np.flatnonzero(new)


def ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in order, rank of each value)."""
    order = np.argsort(values)
    in_order = values[order]
    at = edges_of(in_order)
    out = np.empty(len(values), np.int64)
    out[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(values))))
    return in_order[at], out


def tally(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of rank columns (each under 2**21) in order: (a position of each, its count)."""
    acc, used = columns[0].astype(np.int64), 21
    for c in columns[1:]:
        if used + 21 > 63:
            acc, used = ranks(acc)[1], 21
        acc, used = (acc << 21) | c, used + 21
    order = np.argsort(acc)
    at = edges_of(acc[order])
    return order[at], np.diff(np.append(at, len(acc)))


def key(columns: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash of each row."""
    acc = np.asarray(columns[0], np.uint64)
    for c in columns[1:]:
        acc = mix(acc) * _Q + c
    return mix(acc)


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def pack(columns: list[np.ndarray], values: list[np.ndarray]) -> bytes:
    """Rows in lexicographic order as a trie: a prefix is stored once, with the number of its rows."""
    out, n = [], len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for j, c in enumerate(columns):
        new[1:] |= c[1:] != c[:-1]
        at = np.flatnonzero(new)
        out.append(np.ascontiguousarray(c[at], np.uint64))
        if j + 1 < len(columns):
            out.append(least(np.diff(np.append(at, n))))
    return dump(out + [least(v) for v in values])


def unpack(block, width: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    parts = load(block)
    columns = [np.repeat(parts[2 * j], parts[2 * j + 1]) for j in range(width - 1)] + [parts[2 * width - 2]]
    return columns, parts[2 * width - 1:]


def merge(blocks: list, width: int, how=("sum",)) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(keys, columns, values) of a shard: one row for each n-gram, in order of the key."""
    got = [unpack(b, width) for b in blocks]
    columns = [np.concatenate([g[0][j] for g in got]) for j in range(width)]
    values = [np.concatenate([g[1][j].astype(np.int64) for g in got]) for j in range(len(how))]
    return combine(columns, values, how)


def combine(columns, values, how=("sum",)):
    keys = key(columns)
    order = np.argsort(keys)
    at = edges_of(keys[order])
    reduce = {"sum": np.add, "max": np.maximum}
    out = [reduce[h].reduceat(v[order], at) if len(at) else v for h, v in zip(how, values)]
    rep = order[at]
    return keys[rep], [c[rep] for c in columns], out


def spread(columns, bits: int) -> np.ndarray:
    """Shard of each row: half of the bits follow all words but the last, the others the whole row.

    So the rows of one context share few blocks (and a packed context), yet a
    frequent context is spread over 2**(bits // 2) shards.
    """
    whole = key(columns)
    if len(columns) == 1:
        return shard_of(whole, bits)
    return shard_of(key(columns[:-1]), bits - bits // 2) << (bits // 2) | shard_of(whole, bits // 2)


def dealt(columns, values, bits: int, ordered: bool = False):
    """Yields (shard, block) of rows, each block in lexicographic order; ``ordered``: the rows are so already."""
    if not len(columns[0]):
        return
    shard = spread(columns, bits)
    order = np.argsort(shard, kind="stable") if ordered else np.lexsort([*columns[::-1], shard])
    shard = shard[order]
    at = edges_of(shard)
    for lo, hi in zip(at, np.append(at[1:], len(shard))):
        part = order[lo:hi]
        yield int(shard[lo]), pack([c[part] for c in columns], [v[part] for v in values])


def counted(codes: np.ndarray, columns_at, n: int):
    """Yields (columns, counts) of the distinct rows, STEP_GRAMS positions at a time.

    ``columns_at(lo, hi)`` gives the index into ``codes`` of each column for
    the positions lo to hi, -1 for the end mark (hash 0).
    """
    for lo in range(0, n, STEP_GRAMS):
        at = columns_at(lo, min(n, lo + STEP_GRAMS))
        first = min(int(c[c >= 0].min(initial=len(codes))) for c in at)
        last = max(int(c.max(initial=-1)) for c in at) + 1
        uniq, rank = ranks(codes[first:last]) if last > first else (codes[:0], codes[:0].astype(np.int64))
        uniq, rank = np.append(np.uint64(0), uniq), np.append(rank + 1, 0)
        cols = [rank[np.where(c >= 0, c - first, -1)] for c in at]
        rep, counts = tally(cols)
        yield [uniq[c[rep]] for c in cols], counts


class Pool:
    """Counted rows of several steps, dealt out together."""

    def __init__(self, bits: int):
        self.bits, self.parts, self.rows = bits, [], 0

    def add(self, columns, counts):
        """Yields (shard, block) once POOL_ROWS have come together."""
        self.parts.append((columns, counts))
        self.rows += len(counts)
        if self.rows >= POOL_ROWS:
            yield from self.flush()

    def flush(self):
        parts, self.parts, self.rows = self.parts, [], 0
        if len(parts) == 1:
            yield from dealt(parts[0][0], [parts[0][1]], self.bits, True)
        elif parts:
            columns = [np.concatenate(c) for c in zip(*[p[0] for p in parts])]
            counts = np.concatenate([p[1] for p in parts])
            del parts
            _, columns, values = combine(columns, [counts])
            yield from dealt(columns, values, self.bits)


def shard_bits(docs: DataFrame, text: str = "text", grams: int | None = None) -> int:
    """Bits of the shard number, from the bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(0, int(size / 5 / (grams or SHARD_GRAMS))).bit_length()


def merged(rows: DataFrame, keys: list[str], fn, unpack=None, schema: str | None = None) -> DataFrame:
    """``fn(key values..., blocks)`` gives the (key values..., block) rows of a shard; same schema out.

    ``unpack(rows)``, a table of ``schema``, gives the rows another form in the
    same task: a second Python operator would keep a second worker beside it.
    """
    schema = schema or rows.schema

    def run(table: pa.Table) -> pa.Table:
        own = [table[k][0].as_py() for k in keys]
        out = list(fn(*own, [memoryview(b.as_buffer()) for b in table["block"].combine_chunks()]))
        if unpack:
            return unpack(out)
        return pa.table({c: pa.array([r[i] for r in out], table.schema.field(c).type) for i, c in enumerate([*keys, "block"])})
    return rows.select(*keys, "block").groupBy(*keys).applyInArrow(run, schema)


def write_arrays(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """One file of arrays; written aside and moved, so repeated tasks agree."""
    store, path = pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)
    store.create_dir(path, recursive=True)
    aside = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(aside) as f:
        f.write(dump(arrays))
    store.move(aside, f"{path}/{name}")


class ArrayStore:
    """Sorted hash arrays of a folder; files ``<table>-<shard>``, the first array of each holds the keys."""

    def __init__(self, folder: str, bits: int):
        self.bits = bits
        uri = "://" in folder or folder.startswith("file:")
        self.store, self.path = pafs.FileSystem.from_uri(folder) if uri else (pafs.LocalFileSystem(), folder)
        self.mounted = isinstance(self.store, pafs.LocalFileSystem)
        self.maps: dict[str, list[np.ndarray] | None] = {}

    def open(self, table: str, shard: int) -> list[np.ndarray] | None:
        name = f"{table}-{shard}"
        if name in self.maps:
            return self.maps[name]
        if self.mounted:
            try:
                got = load(np.memmap(f"{self.path}/{name}", np.uint8, "r"))
            except FileNotFoundError:
                got = None
            self.maps[name] = got
            return got
        try:  # one shard in memory at a time
            with self.store.open_input_file(f"{self.path}/{name}") as f:
                return load(f.read())
        except FileNotFoundError:
            return None

    def lookup(self, table: str, columns: list[np.ndarray], width: int) -> list[np.ndarray]:
        """``width`` value arrays for the rows; 0 where a row is not there."""
        keys = key(columns)
        shard = spread(columns, self.bits)
        order = np.lexsort((keys, shard)) if len(columns) > 1 else np.argsort(keys)
        wanted, shard = keys[order], shard[order]
        out = [np.zeros(len(keys), np.int64) for _ in range(width)]
        at = edges_of(shard)
        for lo, hi in zip(at, np.append(at[1:], len(shard))):
            arrays = self.open(table, int(shard[lo]))
            if arrays is None or not len(arrays[0]):
                continue
            place = np.searchsorted(arrays[0], wanted[lo:hi])
            place[place == len(arrays[0])] = 0
            hit = arrays[0][place] == wanted[lo:hi]
            to, place = order[lo:hi][hit], place[hit]
            for o, values in zip(out, arrays[1:]):
                o[to] = values[place]
        return out
