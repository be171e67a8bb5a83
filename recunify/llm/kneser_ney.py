"""LM scoring: an interpolated modified Kneser-Ney n-gram model.

Tokens are the words of a text with A-Z in lower case and one end mark.

1. Tasks count the n-grams of the highest order (with order - 1 begin marks
   before a text), and shards of them are merged (``grams``).  A lower order's
   n-grams and their continuation counts (numbers of distinct words to the
   left) follow from the merged n-grams of the order above, and so do each
   context's sum and its numbers of n-grams seen once, twice and more often.
   Nothing is read twice; each order is one shuffle.
2. Each merge writes its part of the model to the shared folder as sorted hash
   arrays.  Only counts of counts, four numbers an order, come to the driver,
   which has the discounts from them.
3. Workers map the arrays and look the n-grams of a chunk of text up in order
   of their hashes, so the arrays are read front to back.  An n-gram's
   probability is its discounted count in its context plus the context's freed
   share times the probability one order below; the lowest order shares with
   the uniform distribution over the V known tokens and one unknown one.  An
   unseen context passes the lower order's probability on.

All counts cover all learning texts; nothing is pruned or capped.  Two n-grams
of one 64-bit hash would share a count: among N n-grams N**2 / 2**65 pairs.
``ORDER`` is 2: the table of pairs is what the disk limit holds (README).

Odd input: null and empty texts are one end mark.  Rows of one doc_id are
scored and learned from one by one.  Nothing to learn from (an empty table):
V = N = 0, every token has probability 1.  Missing counts of counts take the
usual discounts 0.5, 1 and 1.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.llm import grams
from recunify.llm.text import map_slices, pick, slices, span_hashes, utf8, words
from recunify.session import scratch_path

ORDER = 2
#: Text counted, and text scored, in one numpy step; a longer text is one step of its own.
TEXT_STEP, SCORE_STEP = 1 << 20, 1 << 21
BEGIN, END = np.uint64(0x9D5C0FB3A1E86D27), np.uint64(0x51B0C4E29F7A3D8B)
_USUAL = (0.5, 1.0, 1.5)


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the numbers that every order needs."""
    folder: str
    bits: int
    order: int
    tokens: int
    types: int
    discounts: tuple[tuple[float, float, float], ...]  # of order 1, 2 ...
    total: int  # of the lowest order's counts
    kinds: tuple[int, int, int]  # words of the lowest order counted once, twice and more often


def token_codes(column: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, targets, first): hashes with begin and end marks, the positions that
    count as tokens, and the first target of each text."""
    offs, data = utf8(column)
    capital = (data >= 65) & (data <= 90)
    if capital.any():
        data = data + np.where(capital, 32, 0).astype(np.uint8)
    starts, ends, first = words(offs, data)
    n, texts = len(starts), len(column)
    codes = np.full(n + texts * order, BEGIN, np.uint64)
    number = np.repeat(np.arange(texts), np.diff(first))
    spot = np.arange(n) + number * order + order - 1
    codes[spot] = span_hashes(data, starts, ends)
    last = first[1:] + np.arange(texts) * order + order - 1
    codes[last] = END
    targets = np.ones(len(codes), bool)
    begin = first[:-1] + np.arange(texts) * order
    for k in range(order - 1):
        targets[begin + k] = False
    return codes, np.flatnonzero(targets), first[:-1] + np.arange(texts)


def _blocks(docs: DataFrame, order: int, bits: int) -> DataFrame:
    """(tag, shard, block) of the n-grams of the highest order."""
    def out(found):
        found = list(found)
        return pa.RecordBatch.from_arrays([pa.array([order] * len(found), pa.int32()), pa.array([s for s, _ in found], pa.int32()),
                                           pa.array([b for _, b in found], pa.binary())], ["tag", "shard", "block"])

    def run(batches):
        pool = grams.Pool(bits)
        for b in slices(batches, "text", TEXT_STEP):
            codes, targets, _ = token_codes(b.column(0), order)
            for cols, n in grams.counted(codes, lambda lo, hi: [targets[lo:hi] - k for k in range(order - 1, -1, -1)],
                                         len(targets)):
                yield out(pool.add(cols, n))
        yield out(pool.flush())
    return pick(docs, text="text").mapInArrow(run, "tag int, shard int, block binary")


def _merge(level: int, order: int, bits: int, folder: str):
    """The merge of one order: writes its arrays, gives the order below, the context sums and the counts of counts."""
    def fn(tag, shard, blocks):
        if tag == 0:
            yield from ((0, shard, bytes(b)) for b in blocks)
        elif tag < 0:
            keys, _, values = grams.merge(blocks, 1, ("sum",) * 4)
            grams.write_arrays(folder, f"context{-tag}-{shard}", [keys, *map(grams.least, values)])
        else:
            raw_too = level < order
            keys, cols, values = grams.merge(blocks, level, ("sum",) * (1 + raw_too))
            seen, raw = values[0], values[-1]
            grams.write_arrays(folder, f"gram{level}-{shard}",
                               [keys, grams.least(seen), *([grams.least(raw)] if level == 1 else [])])
            counts = [int((seen == k).sum()) for k in range(1, 5)]
            yield 0, shard, ",".join(map(str, [level, *counts, len(keys), seen.sum(), raw.sum()])).encode()
            if level > 1:
                below, ones = cols[1:], np.ones(len(keys), np.int64)
                _, c, v = grams.combine(below, [ones, raw], ("sum", "sum"))
                yield from ((level - 1, s, b) for s, b in grams.dealt(c, v, bits))
                context = grams.key(cols[:-1])
                _, c, v = grams.combine([context], [seen, seen == 1, seen == 2, seen > 2], ("sum",) * 4)
                yield from ((-level, s, b) for s, b in grams.dealt(c, v, bits))
    return fn


def fit(docs: DataFrame, order: int = ORDER, text: str = "text", shard_grams: int = grams.SHARD_GRAMS) -> Model:
    """Count the texts of ``docs`` and write the model's arrays to the shared folder."""
    slim = pick(docs, text=text)
    folder = scratch_path(docs.sparkSession, "kneser-ney")
    bits = grams.shard_bits(slim, grams=shard_grams)
    rows = _blocks(slim, order, bits)
    for level in range(order, 0, -1):
        rows = grams.merged(rows, ["tag", "shard"], _merge(level, order, bits, folder))

    names = "level n1 n2 n3 n4 types seen raw".split()
    numbers = F.split(F.col("block").cast("string"), ",").cast("array<long>")
    got = {r.level: r for r in rows.filter("tag = 0").select(*[numbers[i].alias(n) for i, n in enumerate(names)])
           .groupBy("level").agg(*[F.sum(n).alias(n) for n in names[1:]]).collect()}
    if not got:
        return Model(folder, bits, order, 0, 0, (_USUAL,) * order, 0, (0, 0, 0))
    low = got[1]
    return Model(folder, bits, order, low.raw, low.types,
                 tuple(discounts(*(got[k][f"n{i}"] for i in range(1, 5))) for k in range(1, order + 1)),
                 low.seen, (low.n1, low.n2, low.types - low.n1 - low.n2))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What is taken from counts of 1, 2, and 3 or more."""
    if not (n1 and n2):
        return _USUAL
    y, n = n1 / (n1 + 2 * n2), (n1, n2, n3, n4)
    out = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else _USUAL[k - 1] for k in (1, 2, 3)]
    return tuple(d if 0 <= d <= k else _USUAL[k - 1] for k, d in enumerate(out, 1))


def _taken(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    """Discounted counts."""
    return np.maximum(counts - np.array([0.0, *d])[np.minimum(counts, 3)], 0.0)


def probabilities(codes: np.ndarray, targets: np.ndarray, model: Model, store: grams.ArrayStore):
    """(probability, count among the learning tokens) of every target."""
    uniq, rank = grams.ranks(codes[targets])
    seen, raw = store.lookup("gram1", [uniq], 2)
    p = np.full(len(uniq), 1 / (model.types + 1))
    if model.total:
        freed = sum(a * b for a, b in zip(model.discounts[0], model.kinds))
        p = (_taken(seen, model.discounts[0]) + freed * p) / model.total
    p, raw = p[rank], raw[rank]
    for k in range(2, model.order + 1):
        cols = [codes[targets - j] for j in range(k - 1, -1, -1)]
        contexts, at = grams.ranks(grams.key(cols[:-1]))
        total, one, two, more = store.lookup(f"context{k}", [contexts], 4)
        d = model.discounts[k - 1]
        freed = (d[0] * one + d[1] * two + d[2] * more)[at]
        seen, = store.lookup(f"gram{k}", cols, 1)
        total = total[at]
        p = np.where(total > 0, (_taken(seen, d) + freed * p) / np.maximum(total, 1), p)
    return p, raw


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = (), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ``keep`` (boolean columns), n_tokens, n_known, train_tokens, base_score, score, perplexity of every text."""
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", *keep, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    stores: dict[str, grams.ArrayStore] = {}

    def run(b: pa.RecordBatch):
        store = stores.setdefault(model.folder, grams.ArrayStore(model.folder, model.bits))
        codes, targets, first = token_codes(b.column(1), model.order)
        p, raw = probabilities(codes, targets, model, store)
        size = np.diff(np.append(first, len(targets)))
        total = lambda v: np.add.reduceat(v, first) if len(first) else v
        base = total(np.log10((raw + 1.0) / (model.tokens + model.types + 1.0)))
        own = total(np.log10(p))
        return pa.RecordBatch.from_arrays(
            [b.column(0), *[b.column(2 + i) for i in range(len(keep))], pa.array(size, pa.int64()),
             pa.array(total((raw > 0).astype(np.int64)), pa.int64()), pa.array([model.tokens] * len(size), pa.int64()),
             pa.array(base, pa.float64()), pa.array(own, pa.float64()), pa.array(10 ** (-own / size), pa.float64())], names)
    return map_slices(pick(docs, doc_id=doc_id, text=text, **{k: k for k in keep}),
                      f"doc_id {kind}, " + "".join(f"{k} boolean, " for k in keep)
                      + "n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double",
                      run, step=SCORE_STEP)
