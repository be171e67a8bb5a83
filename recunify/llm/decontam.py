"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``WINDOW`` consecutive words of the benchmark
items; an item with fewer words, but not none, is one pattern.  Patterns of
one length m share a search.  The text is looked at in blocks of two words
(one for patterns of one word): the shift table tells how far the window can
move on because its last block stands in no pattern, or stands further left;
where the shift is 0, the bucket of that last block holds the patterns to
test, a pair of first words screens them, and direct comparison of all words
confirms.  Words are lower-cased (A-Z) maximal runs of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.

Patterns come to the driver in blocks of ``BLOCK_BYTES`` of benchmark text;
each block is broadcast (so a broadcast has a fixed bound) and searched in
its own pass over the documents; one block needs no shuffle, several are
merged by document.

Odd input: a null or empty text has no words and is not contaminated; an
item that is null or has no words never occurs; items that share a window
are all reported; repeated documents give repeated rows; with an empty
benchmark nothing is hit.  Extra columns are not looked at.
"""

from __future__ import annotations


import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.llm.text import free_name, map_slices, pick, ship_package, texts_of

WINDOW = 13
BLOCK_BYTES = 4 << 20

_fold = bytearray(b" " * 128 + bytes(range(128, 256)))
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _fold[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _fold[_c] = _c + 32
_FOLD = bytes(_fold)


def fold_words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class PatternSet:
    """Shift table and suffix buckets of the patterns of one length."""

    def __init__(self, m: int, patterns: dict[tuple, list]):
        self.m, self.block = m, min(2, m)
        self.far = m - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, dict[tuple, list]] = {}
        for p, items in patterns.items():
            for end in range(self.block, m + 1):
                key = p[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.far), m - end)
            (self.bucket.setdefault(p[m - self.block:], {}).setdefault(p[:self.block], [])).append((p, items))

    def search(self, words: list[bytes], hit) -> None:
        """Calls hit(start, items) for every occurrence."""
        m, b, far, shift = self.m, self.block, self.far, self.shift.get
        at, n = m, len(words)
        while at <= n:
            last = (words[at - 2], words[at - 1]) if b == 2 else (words[at - 1],)
            go = shift(last, far)
            if go:
                at += go
                continue
            start = at - m
            for pattern, items in self.bucket[last].get(tuple(words[start:start + b]), ()):
                if tuple(words[start:at]) == pattern:
                    hit(start, items)
            at += 1


def compile_items(items, window: int = WINDOW) -> list[PatternSet]:
    """Pattern sets of (item_id, text) pairs, one for each pattern length."""
    by_length: dict[int, dict[tuple, list]] = {}
    for item, text in items:
        w = fold_words(text or "")
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            got = by_length.setdefault(m, {}).setdefault(tuple(w[k:k + m]), [])
            if item not in got:
                got.append(item)
    return [PatternSet(m, p) for m, p in sorted(by_length.items())]


def scan(words: list[bytes], sets: list[PatternSet]) -> tuple[list[tuple[int, int]], set]:
    """Merged hit spans [start, end) of words, and the items that occur."""
    found, items = [], set()
    for s in sets:
        s.search(words, lambda start, ids, m=s.m: (found.append((start, start + m)), items.update(ids)))
    return merge_spans(found), items


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str):
    """Compiled pattern sets, one block of benchmark text at a time."""
    block, size = [], 0
    for r in pick(benchmark, item_id=item_id, text=text).toLocalIterator():
        block.append((r.item_id, r.text))
        size += len(r.text or "")
        if size >= BLOCK_BYTES:
            yield compile_items(block)
            block, size = [], 0
    yield compile_items(block)


def _pass(docs: DataFrame, sets: list[PatternSet], item_type: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(sets)  # at most BLOCK_BYTES of benchmark text
    fields = [f.name for f in docs.schema.fields if f.name != "text"]
    out = "".join(f"{f} {docs.schema[f].dataType.simpleString()}, " for f in fields)

    def run(b: pa.RecordBatch):
        n, spans, items = [], [], []
        for t in texts_of(b):
            w = fold_words(t)
            s, i = scan(w, shared.value)
            n.append(len(w))
            spans.append([x for pair in s for x in pair])
            items.append(sorted(i, key=str))
        return pa.RecordBatch.from_arrays(
            [*[b.column(b.schema.get_field_index(f)) for f in fields], pa.array(n, pa.int64()),
             pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(_arrow[item_type]))],
            [*fields, "n_words", "spans", "items"])
    return map_slices(docs, f"{out}n_words bigint, spans array<bigint>, items array<{item_type}>", run)


_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def occurrences(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, spans (start, end, start, end ... of hit words) and items of every document."""
    kind = benchmark.schema[item_id].dataType.simpleString()
    if kind not in _arrow:
        raise ValueError(f"item ids of type {kind}")
    slim = pick(docs, doc_id=doc_id, text=text)
    blocks = _blocks(benchmark, item_id, item_text)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _pass(slim, first, kind)
    return (_merged(slim, [first, second, *blocks], kind)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc_id", "n_words", "spans", "items"))


def _merged(slim: DataFrame, blocks, kind: str) -> DataFrame:
    """One row for the equal rows of ``slim`` (doc_id, row_key, copies), with what all blocks found.
    Rows are told apart by id and a hash of the text, as ids may repeat."""
    slim = slim.withColumn("row_key", F.xxhash64("text"))
    union = None
    for k, sets in enumerate(blocks):
        one = _pass(slim, sets, kind).withColumn("part", F.lit(k))
        union = one if union is None else union.unionByName(one)
    ship_package(slim.sparkSession)

    @F.udf("array<bigint>")
    def joined(lists):
        return [x for pair in merge_spans((s[i], s[i + 1]) for s in lists for i in range(0, len(s), 2)) for x in pair]
    return (union.groupBy("doc_id", "row_key", "n_words")
            .agg(F.count(F.when(F.col("part") == 0, 1)).alias("copies"),
                 joined(F.collect_set("spans")).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows, with all their columns, that are not contaminated."""
    kind = benchmark.schema[item_id].dataType.simpleString()
    blocks = _blocks(benchmark, item_id, item_text)
    first, second = next(blocks), next(blocks, None)
    if second is not None:
        found = _merged(pick(docs, doc_id=doc_id, text=text), [first, second, *blocks], kind)
        bad_id, row = free_name(docs, "bad_id"), free_name(docs, "bad_row")
        bad = verdicts(found, "row_key").filter("contaminated").select(F.col("doc_id").alias(bad_id), F.col("row_key").alias(row))
        return docs.join(bad, F.col(f"`{doc_id}`").eqNullSafe(F.col(bad_id))
                         & (F.xxhash64(F.col(f"`{text}`")) == F.col(row)), "left_anti")
    shared = docs.sparkSession.sparkContext.broadcast(first)  # at most BLOCK_BYTES of benchmark text
    at = docs.columns.index(text)
    ship_package(docs.sparkSession)

    def run(b: pa.RecordBatch):
        clean = []
        for t in b.column(at).to_pylist():
            w = fold_words(t or "")
            hit = sum(z - a for a, z in scan(w, shared.value)[0])
            clean.append(not (hit > 0 and 20 * hit >= len(w)))
        return b.filter(pa.array(clean, pa.bool_()))
    return map_slices(docs, docs.schema, run, text=text)


def hit_words(spans):
    """Number of words in the spans of ``occurrences``."""
    return F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
                       F.lit(0).cast("bigint"), lambda a, x: a + x)


def verdicts(found: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated from ``occurrences``; and columns named in ``more``."""
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return (found.withColumn("n_hit", hit_words(F.col("spans")))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), *more))
