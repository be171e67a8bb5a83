"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of shingles of five words; two are linked if the Jaccard
similarity of their sets is 0.8 or more.

1. One numpy pass gives each document a digest of its set and a MinHash
   signature, from which BANDS band keys are made (ROWS values each).
   Documents with equal sets are one class from here on, whatever its size.
2. Classes that share a band key meet.  Only the smallest class of a key and
   the keys' sizes are aggregated; the star edges are contracted to candidate
   components.  A pair of similarity 0.8 shares no key with probability
   (1 - 0.8**ROWS)**BANDS, about 1e-7.
3. Each class of a component comes, with signature and set, to its block of
   about BLOCK classes; large components are dealt to pairs of blocks, so no
   task holds more than two blocks.  Inside, a pair's MinHash values are
   compared STEP at a time: with m matches of k, the posterior (uniform prior)
   of similarity >= t is P(Bin(k + 1, t) <= m), and the pair goes once that is
   below TOLERANCE.  The pairs left are verified exactly on their sets.
4. A task reports link counts and a spanning forest of its links, not the
   pairs; the forests are contracted to the final classes.

Odd input: a document of one to four words has one shingle, of all its words;
one without words (null, empty) is a class of its own without links.  Rows of
one doc_id are judged by their texts; null ids link like others (a class of
nulls alone has a null class id).  Repeated rows are copies of each other and
each gives a row.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.llm.graph import components
from recunify.llm.store import split_join
from recunify.llm.text import free_name, map_slices, mix, pick, roll_windows, span_hashes, utf8, words

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 40, 5
#: Posterior below which a candidate pair is dropped, and MinHash values looked at in one step.
TOLERANCE, STEP = 1e-9, 20
#: Classes in one block of a component.
BLOCK = 1024
#: Text for one numpy step (signatures take 8 bytes a word and hash function).
TEXT_STEP = 1 << 20

_r = np.random.Generator(np.random.PCG64(31))
_A = _r.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _r.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(column: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    offs, data = utf8(column)
    starts, ends, first = words(offs, data)
    codes = span_hashes(data, starts, ends)
    rolled = mix(roll_windows(codes, k))
    out = []
    for lo, hi in zip(first[:-1], first[1:]):
        n = int(hi - lo)
        if n >= k:
            out.append(np.unique(rolled[lo:hi - k + 1]))
        elif n:  # fewer words than a shingle: all of them are one
            out.append(mix(roll_windows(codes[lo:hi], n)[:1] + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (documents x BANDS * ROWS); documents without shingles get zeros."""
    out = np.zeros((len(sets), len(_A)), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[i] for i in full])
        begin = np.cumsum([0] + [len(sets[i]) for i in full])[:-1]
        for j in range(len(_A)):
            out[full, j] = np.minimum.reduceat(((flat * _A[j] + _B[j]) >> np.uint64(32)).astype(np.uint32), begin)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature."""
    s = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), s.shape[:2])
    for k in range(ROWS):
        acc = mix(acc + s[:, :, k])
    return acc.astype(np.int64)


def digest_of(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


@lru_cache
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """For k compared values (0, STEP, 2 * STEP ...): the fewest matches at which a pair stays."""
    out = [0]
    for k in range(STEP, BANDS * ROWS + 1, STEP):
        total, m = 0.0, 0
        while True:
            total += comb(k + 1, m) * threshold ** m * (1 - threshold) ** (k + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out.append(m)
    return np.array(out)


def survivors(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Indices of the signatures that may reach the threshold with ``one``."""
    alive, got = np.arange(len(others)), np.zeros(len(others), np.int64)
    for n, least in enumerate(least_matches()[1:]):
        part = slice(n * STEP, (n + 1) * STEP)
        got = got + (others[alive, part] == one[part]).sum(1)
        stay = got >= least
        alive, got = alive[stay], got[stay]
        if not len(alive):
            break
    return alive


def block_links(sets: list[np.ndarray], sig: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Yields (i, js): the j in right linked to i in left, each pair once."""
    sizes = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    begin = np.cumsum(np.append(0, sizes))
    mark = np.zeros(int(ids.max()) + 1, bool)
    same = left is right
    for n, i in enumerate(left):
        others = right[n + 1:] if same else right
        js = others[survivors(sig[i], sig[others])] if len(others) else others
        small, large = np.minimum(sizes[js], sizes[i]), np.maximum(sizes[js], sizes[i])
        js = js[small >= THRESHOLD * large - 1e-9]
        if not len(js):
            continue
        own = ids[begin[i]:begin[i + 1]]
        mark[own] = True
        part = np.concatenate([mark[ids[begin[j]:begin[j + 1]]] for j in js])
        common = np.add.reduceat(part.astype(np.int64), np.cumsum(np.append(0, sizes[js]))[:-1])
        mark[own] = False
        union = sizes[i] + sizes[js] - common
        yield i, js[common * 5 >= union * 4] if THRESHOLD == 0.8 else js[common >= THRESHOLD * union]


def _compare(table: pa.Table) -> pa.Table:
    """Links within one block, or between two blocks, of a component."""
    lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
    digests = table["digest"].to_pylist()
    first: dict[bytes, int] = {}  # repeated rows bring a class twice
    for i, d in enumerate(digests):
        first.setdefault(d, i)
    keep = np.array(sorted(first.values()))
    raw = table["shingles"].take(pa.array(keep)).to_pylist()
    sets = [np.frombuffer(s, np.uint64) for s in raw]
    sig = np.stack([np.frombuffer(s, np.uint32) for s in table["sig"].take(pa.array(keep)).to_pylist()])
    block, copies = np.array(table["block"].to_pylist())[keep], np.array(table["copies"].to_pylist())[keep]
    digests = [digests[i] for i in keep]
    left = np.flatnonzero(block == lo)
    right = left if lo == hi else np.flatnonzero(block == hi)
    links, root = np.zeros(len(keep), np.int64), np.arange(len(keep))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i, js in block_links(sets, sig, left, right) if len(left) and len(right) else ():
        links[i] += copies[js].sum()
        links[js] += copies[i]
        for j in js:
            a, b = top(i), top(j)
            if a != b:
                root[max(a, b)] = min(a, b)
    at = np.flatnonzero(links)
    return pa.table({"digest": pa.array([digests[i] for i in at], pa.binary()),
                     "root": pa.array([digests[top(i)] for i in at], pa.binary()),
                     "links": pa.array(links[at], pa.int64())})


def _sketch(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the text), digest, keys (band keys) of every document."""
    def run(b: pa.RecordBatch):
        sets = shingle_sets(b.column(1))
        keys = band_keys(signatures(sets))
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), pa.array([digest_of(s) for s in sets], pa.binary()),
             pa.array([k if len(s) else [] for k, s in zip(keys, sets)], pa.list_(pa.int64()))],
            ["doc_id", "row", "digest", "keys"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_slices(docs, f"doc_id {kind}, row bigint, digest binary, keys array<bigint>", run, step=TEXT_STEP)


def _with_sets(rows: DataFrame) -> DataFrame:
    """comp, blocks, copies of the candidates with digest, signature and set, by their texts."""
    def run(b: pa.RecordBatch):
        sets = shingle_sets(b.column(b.schema.get_field_index("text")))
        want = b.column(b.schema.get_field_index("digest")).to_pylist()
        at = [i for i, s in enumerate(sets) if digest_of(s) == want[i]]
        sig = signatures([sets[i] for i in at])
        pos = pa.array(at, pa.int64())
        return pa.RecordBatch.from_arrays(
            [*[b.column(b.schema.get_field_index(c)).take(pos) for c in ("comp", "blocks", "copies", "digest")],
             pa.array([s.tobytes() for s in sig], pa.binary()),
             pa.array([sets[i].tobytes() for i in at], pa.binary())],
            ["comp", "blocks", "copies", "digest", "sig", "shingles"])
    return map_slices(rows, "comp bigint, blocks int, copies bigint, digest binary, sig binary, shingles binary", run,
                      step=TEXT_STEP)


def join(docs: DataFrame, stage, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its connected class), n_links (documents
    linked by a different set), n_copies (other documents with the same set)."""
    # a document is found again by its id and a hash of its text: ids may repeat or be null
    slim = pick(docs, doc_id=doc_id, text=text).withColumn("row", F.xxhash64("text"))
    sketch = stage(_sketch(slim))
    classes = stage(sketch.filter("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "row")).alias("sample"), F.count("*").alias("copies"),
        F.first("keys").alias("keys")).withColumn("node", F.xxhash64("digest")))
    bands = classes.select("node", F.explode("keys").alias("key"))
    shared = (bands.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("n"))
              .filter("n > 1").select("key", "low"))
    meet = split_join(bands, shared, "key").select(F.col("node").alias("a"), F.col("low").alias("b"))
    comps = stage(components(meet, stage))
    sizes = comps.groupBy("root").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    candidates = (split_join(classes.join(comps, "node"), sizes, "root")
                  .select(F.col("sample.doc_id").alias("sample_id"), F.col("sample.row").alias("sample_row"), "digest", "copies",
                          F.col("root").alias("comp"), "blocks"))
    # one text of each class; of equal rows the partial aggregation keeps one before the shuffle
    sets = _with_sets(slim.join(candidates, slim["doc_id"].eqNullSafe(F.col("sample_id")) & (slim["row"] == F.col("sample_row")))
                      .groupBy("digest", "comp", "blocks", "copies").agg(F.min("text").alias("text"))
                      .select("text", "comp", "blocks", "copies", "digest"))
    own = F.pmod(F.xxhash64("digest", F.lit(1)), F.col("blocks")).cast("int")
    dealt = (sets.withColumn("block", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
             .drop("other", "blocks"))
    found = stage(dealt.groupBy("comp", "lo", "hi").applyInArrow(_compare, "digest binary, root binary, links bigint"))
    links = found.groupBy("digest").agg(F.sum("links").alias("n_links"))
    final = components(found.select(F.col("digest").alias("a"), F.col("root").alias("b")), stage)
    per_set = (classes.select("digest", "first_id", "copies").join(links, "digest", "left")
               .join(final, F.col("digest") == F.col("node"), "left")
               .withColumn("class", F.coalesce("root", "digest")))
    names = per_set.groupBy("class").agg(F.min("first_id").alias("class_id"))
    per_set = split_join(per_set, names, "class").select("digest", "class_id", "copies", "n_links")
    return (sketch.select("doc_id", "digest").join(per_set, "digest", "left")
            .select("doc_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
                    .alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.coalesce(F.col("copies") - 1, F.lit(0)).cast("bigint").alias("n_copies")))


def keep_first(docs: DataFrame, stage, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are the first of their class, all columns.

    Rows of one doc_id are one document and stay or go together; of equal rows one stays.
    """
    classes = join(docs, stage, doc_id, text)
    name = free_name(docs, "first_id")
    first = classes.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias(name)).distinct()
    return (docs.join(first, F.col(f"`{doc_id}`").eqNullSafe(F.col(name)), "left_semi")
            .dropDuplicates([doc_id, text]))
