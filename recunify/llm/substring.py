"""Substring dedup with prefix-partitioned groups of word suffixes.

The corpus is the set of its word suffixes, cut off at WINDOW words: deeper
tree levels can't change which windows repeat.  Steps:

1. Prefix counts.  For prefixes of 1, 2, 4, 8 and WINDOW words the suffixes are
   counted by a hash of the prefix in tables of fixed size (2**bits a level).
   A prefix with more than ``group_size`` suffixes is extended to the next
   length; the others are packed into groups of at most about ``group_size``
   suffixes.  A cell that is overfull at full depth too (on a large corpus all
   are) is cut into parts by further bits of the suffix's hash.  So prefixes
   have variable length and each group fits in memory, on any corpus.
2. Groups.  Map tasks send every suffix, as a 64-bit fingerprint of its WINDOW
   words with its document, to the group of its prefix.  Equal suffixes of a map
   batch meet there first: all but the smallest document's are repeats for sure
   and are sent on as such, the smallest goes to the group, once.  So a window
   that a third of all documents share is a few rows of its group, one a batch.
   A group sorts its fingerprints; equal ones are a node at depth WINDOW, which
   is a repeat for its documents but the smallest.  Fingerprints have no order
   of words, so shallower nodes and extensions are not looked for: longer
   repeats come from step 3.
3. The repeats go back to their documents, where overlapping windows join to
   maximal repeats, whose words are removed.  Texts travel once, compressed.

Of N windows about N**2 / 2**65 pairs are wrongly taken for equal, divided by
the number of groups; no window is ever missed.

Odd input: a null or empty text has no words, 0 removed, and the hash of the
empty text; texts shorter than WINDOW lose nothing.  A null doc_id counts as
larger than all others and equal to other nulls.  Rows with one doc_id are
parts of one document, none smaller than the other, and each gives a row; they
are brought together in one bucket of the last step.  An empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.llm.text import (cover, doc_of, mix, pick, roll_windows, slices, span_hashes, utf8,
                               window_owner, words)

WINDOW = 13
LEVELS = (1, 2, 4, 8, WINDOW)
#: Suffixes of one group: about 100 bytes each while a task works on it.
GROUP_SIZE = 2_000_000
#: log2 of the prefix table of a level; 2**bits should exceed the number of groups by far.
BITS = 14
#: Windows of a map batch, and documents of one bucket of the last step, about.
BATCH, BUCKET_DOCS = 1_000_000, 1024
NO_ID = np.iinfo(np.int64).max
_DEEPER = -1


class Suffixes:
    """The suffixes of WINDOW words of a batch: prefix hashes by level, codes, documents."""

    def __init__(self, offs: np.ndarray, data: np.ndarray):
        self.starts, self.ends, self.first = words(offs, data)
        self.word_codes = span_hashes(data, self.starts, self.ends)
        self.at = np.flatnonzero(window_owner(self.first, WINDOW))
        self.sums, acc, depth = [], None, 0
        for level in LEVELS:
            acc = roll_windows(self.word_codes, level, acc, depth)
            depth = level
            self.sums.append(acc)

    def bucket(self, level: int, bits: int, which=slice(None)) -> np.ndarray:
        return (mix(self.sums[level][self.at[which]]) >> np.uint64(64 - bits)).astype(np.int64)

    def codes(self) -> np.ndarray:
        """Fingerprints of the WINDOW words."""
        return mix(self.sums[-1][self.at])

    def docs(self) -> np.ndarray:
        return doc_of(self.first)[self.at]


def route(s: Suffixes, plan: tuple[np.ndarray, np.ndarray], bits: int) -> np.ndarray:
    """Group of every suffix by its shortest prefix that is not overfull."""
    groups, parts = plan
    out = groups[0][s.bucket(0, bits)]
    for level in range(1, len(LEVELS)):
        deeper = np.flatnonzero(out == _DEEPER)
        if not len(deeper):
            break
        cell = s.bucket(level, bits, deeper)
        out[deeper] = groups[level][cell]
        if level + 1 == len(LEVELS):
            out[deeper] += (mix(s.codes()[deeper] + np.uint64(7)) % parts[cell]).astype(np.int32)
    return out


def make_plan(counts: np.ndarray, group_size: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """((first group by level and prefix cell, parts of a cell at full depth), number of groups); _DEEPER: extend the prefix."""
    plan, groups = np.zeros(counts.shape, np.int32), 0
    parts = np.ones(counts.shape[1], np.uint64)
    for level, row in enumerate(counts):
        over = row > group_size
        filled = np.cumsum(np.where(over, 0, row)) // group_size
        plan[level] = np.where(over, _DEEPER, groups + filled)
        groups += int(filled[-1]) + 1
        if level + 1 == len(counts):
            parts = np.where(over, -(-row // group_size), 1).astype(np.uint64)
            size = np.where(over, parts.astype(np.int64), 0)
            plan[level] = np.where(over, groups + np.cumsum(size) - size, plan[level])
            groups += int(size.sum())
        if not over.any():
            break
    return (plan, parts), groups


def pack(codes: np.ndarray, docs: np.ndarray) -> bytes:
    """Sorted 64-bit codes as differences, with document numbers, in compressed byte planes."""
    gaps = np.diff(codes, prepend=np.uint64(0))
    planes = gaps.view(np.uint8).reshape(-1, 8).T.tobytes() + docs.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(12, -1)
    gaps = np.ascontiguousarray(planes[:8].T).view(np.uint64).ravel()
    return np.cumsum(gaps, dtype=np.uint64), np.ascontiguousarray(planes[8:].T).view(np.uint32).ravel()


def ids_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64) + np.uint64(99)) % np.uint64(buckets)).astype(np.int32)


def _count_prefixes(docs: DataFrame, bits: int) -> np.ndarray:
    """Suffixes by level and prefix bucket, over all documents."""
    def run(batches):
        total = np.zeros((len(LEVELS), 1 << bits), np.int64)
        for b in slices(batches, "text"):
            s = Suffixes(*utf8(b.column(1)))
            for level in range(len(LEVELS)):
                total[level] += np.bincount(s.bucket(level, bits), minlength=1 << bits)
        level, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), pa.array(bucket, pa.int32()),
                                          pa.array(total[level, bucket], pa.int64())], ["level", "bucket", "n"])
    got = (docs.mapInArrow(run, "level int, bucket int, n bigint").groupBy("level", "bucket")
           .agg(F.sum("n").alias("n")).toArrow())  # len(LEVELS) * 2**bits rows at most
    counts = np.zeros((len(LEVELS), 1 << bits), np.int64)
    counts[got["level"].to_numpy(), got["bucket"].to_numpy()] = got["n"].to_numpy()
    return counts


def _rows_of(doc: np.ndarray, code: np.ndarray, buckets: int) -> list[tuple]:
    """(bucket, documents, number of codes of each, codes) of repeats, by the bucket of their documents."""
    to = bucket_of(doc, buckets)
    order = np.lexsort((code, doc, to))
    doc, code, to = doc[order], code[order], to[order]
    edge = np.append(np.flatnonzero(np.diff(to, prepend=-1)), len(to))
    rows = []
    for a, z in zip(edge[:-1], edge[1:]):
        own, n = np.unique(doc[a:z], return_counts=True)
        rows.append((int(to[a]), own.tobytes(), n.astype(np.uint32).tobytes(), code[a:z].tobytes()))
    return rows


def _send(docs: DataFrame, plan, bits: int, buckets: int) -> DataFrame:
    """grp, ids, n, suffixes: for each map batch and group one suffix of each kind, with its smallest
    document; and what a batch knows already, as in ``_rows_of``, under -1 - bucket."""
    def flush(parts):
        codes, grp, doc = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 2))
        ids = np.concatenate([p[3] for p in parts])
        order = np.lexsort((ids[doc], codes, grp))
        codes, grp, doc = codes[order], grp[order], doc[order]
        first = np.append(True, (codes[1:] != codes[:-1]) | (grp[1:] != grp[:-1]))
        low = np.repeat(ids[doc[first]], np.diff(np.append(np.flatnonzero(first), len(codes))))
        later = ids[doc] > low
        known_doc, known_code = ids[doc[later]], codes[later]
        codes, grp, doc = codes[first], grp[first], doc[first]
        edge = np.append(np.flatnonzero(np.diff(grp, prepend=-9)), len(grp))
        blob = zstandard.ZstdCompressor(level=1).compress(ids.tobytes())
        rows = [(int(grp[a]), blob, None, pack(codes[a:z], doc[a:z])) for a, z in zip(edge[:-1], edge[1:])]
        rows += [(-1 - to, *rest) for to, *rest in _rows_of(known_doc, known_code, buckets)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                           *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)]],
                                          ["grp", "ids", "n", "suffixes"])

    def run(batches):
        parts, size, seen = [], 0, 0
        for b in slices(batches, "text"):
            s, ids = Suffixes(*utf8(b.column(1))), ids_of(b)
            parts.append((s.codes(), route(s, plan.value, bits), s.docs() + seen, ids))
            size, seen = size + len(s.at), seen + len(ids)
            if size >= BATCH:
                yield flush(parts)
                parts, size, seen = [], 0, 0
        if size:
            yield flush(parts)
    return docs.mapInArrow(run, "grp int, ids binary, n binary, suffixes binary")


def subtree_repeats(codes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, code) of the leaves below a deep node that also has a smaller document."""
    order = np.argsort(codes, kind="stable")
    codes, docs = codes[order], docs[order]
    node = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    size = np.diff(np.append(node, len(codes)))
    inner = np.repeat(size > 1, size)
    codes, docs, size = codes[inner], docs[inner], size[size > 1]
    if not len(codes):
        return docs, codes
    low = np.minimum.reduceat(docs, np.cumsum(np.append(0, size))[:-1])
    later = docs > np.repeat(low, size)
    return docs[later], codes[later]


def _subtrees(sent: DataFrame, buckets: int) -> DataFrame:
    """bucket, ids, n, codes: the repeats found in each group and those known before, as in ``_rows_of``."""
    def run(table: pa.Table) -> pa.Table:
        group = table["grp"][0].as_py()
        if group < 0:
            return pa.table([pa.array([-1 - group] * table.num_rows, pa.int32()),
                             *[table[c].cast(pa.binary()) for c in ("ids", "n", "suffixes")]], names=names)
        codes, docs = [], []
        for blob, ids in zip(table["suffixes"].to_pylist(), table["ids"].to_pylist()):
            c, d = unpack(blob)
            codes.append(c)
            docs.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(ids), np.int64)[d])
        rows = _rows_of(*subtree_repeats(np.concatenate(codes), np.concatenate(docs)), buckets)
        return pa.table([pa.array([r[0] for r in rows], pa.int32()),
                         *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)]], names=names)
    names = ["bucket", "ids", "n", "codes"]
    return sent.groupBy("grp").applyInArrow(run, "bucket int, ids binary, n binary, codes binary")


def _texts(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, rows: the documents by bucket, a compressed Arrow stream for each map batch."""
    def flush(parts):
        table = pa.Table.from_batches(parts).combine_chunks()
        to = bucket_of(np.concatenate([ids_of(p) for p in parts]), buckets)
        order = np.argsort(to, kind="stable")
        edge = np.append(np.flatnonzero(np.diff(to[order], prepend=-1)), len(to))
        names, blobs = [], []
        for a, z in zip(edge[:-1], edge[1:]):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, table.schema) as w:
                w.write_table(table.take(pa.array(order[a:z])).combine_chunks())
            names.append(int(to[order[a]]))
            blobs.append(zstandard.ZstdCompressor(level=3).compress(out.getvalue()))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())],
                                          ["bucket", "rows"])

    def run(batches):
        parts, size = [], 0
        for b in slices(batches, "text"):
            parts.append(b)
            size += b.nbytes
            if size >= 24 << 20:
                yield flush(parts)
                parts, size = [], 0
        if parts:
            yield flush(parts)
    return docs.mapInArrow(run, "bucket int, rows binary")


def _clean(batch: pa.RecordBatch, found: dict[int, np.ndarray], keep_text: bool) -> pa.RecordBatch:
    """What is left of the documents of a batch, given the codes of their repeated windows."""
    offs, data = utf8(batch.column(1))
    s, ids = Suffixes(offs, data), ids_of(batch)
    codes, doc = s.codes(), s.docs()
    own = np.sort(ids)
    own = own[np.append(True, own[1:] != own[:-1])] if len(own) else own
    salt = mix(np.arange(1, len(own) + 1, dtype=np.uint64))  # a window is looked for in its own document
    back = [mix(found[i] ^ salt[k]) for k, i in enumerate(own.tolist()) if i in found]
    back = np.concatenate(back) if back else np.zeros(0, np.uint64)
    hit = np.isin(mix(codes ^ salt[np.searchsorted(own, ids)[doc]]), back) if len(codes) else np.zeros(0, bool)
    hits = np.zeros(len(s.starts), bool)
    hits[s.at[hit]] = True
    gone = cover(hits, WINDOW)
    raw = data.tobytes()
    n, removed, sha, kept, spans = [], [], [], [], []
    for k in range(batch.num_rows):
        a, z = s.first[k], s.first[k + 1]
        mine, list_ = gone[a:z], raw[offs[k]:offs[k + 1]].split()
        edge = np.flatnonzero(np.diff(mine, prepend=False, append=False))
        left = b" ".join(compress(list_, (~mine).tolist()) if len(edge) else list_)
        n.append(len(list_))
        removed.append(int(mine.sum()))
        sha.append(hashlib.sha256(left).hexdigest())
        spans.append(edge.tolist())
        kept.append(left.decode() if keep_text else None)
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
         pa.array(spans, pa.list_(pa.int64())), *([pa.array(kept, pa.string())] if keep_text else [])],
        ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", *(["kept_text"] if keep_text else [])])


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group_size: int = GROUP_SIZE,
          bits: int = BITS, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (start, end ... of the maximal
    repeats, in words) and, if asked for, kept_text, of every document."""
    slim = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    sc = docs.sparkSession.sparkContext
    buckets = max(1, slim.count() // BUCKET_DOCS)
    counts = _count_prefixes(slim, bits)
    plan, _ = make_plan(counts, group_size)
    shared = sc.broadcast(plan)  # of fixed size
    repeats = _subtrees(_send(slim, shared, bits, buckets), buckets)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[int, list] = {}
        for ids, n, codes in zip(*[right[c].to_pylist() for c in ("ids", "n", "codes")]):
            n = np.cumsum(np.append(0, np.frombuffer(n, np.uint32)))
            flat = np.frombuffer(codes, np.uint64)
            for k, i in enumerate(np.frombuffer(ids, np.int64).tolist()):
                found.setdefault(i, []).append(flat[n[k]:n[k + 1]])
        found = {i: np.concatenate(v) for i, v in found.items()}
        out = []
        for blob in left["rows"].to_pylist():
            with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)) as r:
                out += [_clean(b, found, keep_text) for b in slices(r, "text")]
        return pa.Table.from_batches(out) if out else empty.empty_table()
    schema = ("doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans array<bigint>"
              + ", kept_text string" * keep_text)
    empty = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                       ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64()))]
                      + [("kept_text", pa.string())] * keep_text)
    return (_texts(slim, buckets).groupBy("bucket").cogroup(repeats.groupBy("bucket"))
            .applyInArrow(finish, schema))
