"""Spelling variants by a variable-length gram index.

Words are the distinct runs of letters of the texts (see ``vocabulary``); two
are near if one inserted, deleted or replaced letter turns one into the other.

1. Gram dictionary.  Every word, with a mark before and behind it, gives its
   grams of 2 to GRAM_MAX letters; grams are counted over the vocabulary and
   those longer than 2 stay only if they occur ``keep_from`` times: common
   grams are told apart by a longer one, rare ones stay short.  The dictionary
   lies in the shared folder as sorted arrays, which workers map (``grams``).
2. Decomposition.  At each letter the longest gram of the dictionary begins;
   grams inside an earlier one are left out.  Words of c letters compare with
   words of c and c + 1 letters, both decomposed with grams of at most
   (c + 2) // 2 letters.
3. Affected grams.  A gram [i, j] of a word can change only by an edit from
   j - max + 1 to j (to j + 1 if it could be longer).  The most grams that one
   edit affects are the word's bound B; near words share all grams but B.  The
   limit on gram lengths leaves the first or the last gram unaffected by any
   edit, so B is always less than the number of grams.
4. List merging.  By that bound near words share one of their B + 1 rarest
   grams at the same letter (one further on if an edit before it inserted one).
   Only these go to the inverted lists.  Lists are dealt to buckets and
   compared there: letters in common, then the exact test.  A list longer than
   ``block`` (counted before, the long ones again in mapped arrays) is dealt to
   pairs of its blocks.  A pair that meets in several lists counts in the first
   of them in the order of its grams, so no pairs are sent on, only the number
   of near words of a word and the best of them.

Odd input: null and empty texts have no words; a null doc_id is written as the
empty string; repeated rows count each time; an empty table gives no words.
Any length of word is handled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.llm import grams
from recunify.llm.store import split_join
from recunify.llm.text import mix, pick, ship_package
from recunify.session import scratch_path

MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2
GRAM_MIN, GRAM_MAX = 2, 7
#: A gram of more than two letters is in the dictionary if it occurs so often in the vocabulary.
KEEP_FROM = 64
#: Words of one block of a list, rows of one bucket of lists, and words decomposed in one step.
BLOCK, BUCKET_ROWS, STEP_WORDS = 1024, 1 << 18, 1 << 14
LETTERS = r"[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, every: int = 97,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: runs of letters (only A-Z in lower case), some with a planted slip.

    With h the crc32 of ``<doc_id>:<run>``, a run of which h is a multiple of
    ``every`` lacks its letter h mod its length (0: no slips).
    """
    runs = (pick(docs, id=doc_id, text=text)
            .select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"),
                    F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run"))
            .filter(F.length("run") >= min_letters)
            .select("id", F.translate("run", _UPPER, _LOWER).alias("run")))
    if every:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        runs = runs.withColumn("h", h).withColumn("at", (F.col("h") % F.length("run")).cast("int")).select(
            F.when(F.col("h") % every == 0, F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)")))
            .otherwise(F.col("run")).alias("run")).filter(F.length("run") >= min_letters)
    return runs.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def by_length(words: list[bytes]):
    """Yields (letters, positions in ``words``, marked letters: one row a word)."""
    size = np.array([len(w) for w in words], np.int64)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        m = np.empty((len(at), n + 2), np.uint8)
        m[:, 0], m[:, -1] = 1, 2
        m[:, 1:-1] = np.frombuffer(b"".join([words[i] for i in at]), np.uint8).reshape(-1, n)
        yield n, at, m


def gram_codes(m: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """For each length the grams that begin at each letter, as their letters and length."""
    out, acc = {}, m.astype(np.uint64)
    for q in range(2, min(longest, m.shape[1]) + 1):
        acc = (acc[:, :-1] << np.uint64(8)) | m[:, q - 1:]
        out[q] = acc | np.uint64(q << 56)
    return out


def decompose(codes: dict[int, np.ndarray], counts: dict[int, np.ndarray], letters: int, longest: int):
    """(place, length, code, used): a row for each word, its B + 1 rarest grams first."""
    rows, places = codes[2].shape
    size = np.zeros((rows, places), np.int64)
    code, often = np.zeros((rows, places), np.uint64), np.zeros((rows, places), np.int64)
    for q in range(2, longest + 1):
        here = np.zeros((rows, places), bool)
        here[:, :codes[q].shape[1]] = counts[q] > 0
        size[here] = q
        code[here], often[here] = codes[q][counts[q] > 0], counts[q][counts[q] > 0]
    end = np.arange(places) + size - 1
    kept = np.ones((rows, places), bool)
    kept[:, 1:] = end[:, 1:] > np.maximum.accumulate(end, axis=1)[:, :-1]
    row, place = np.nonzero(kept)
    lo = np.maximum(end[kept] - longest + 1, 0)
    hi = end[kept] + (size[kept] < longest)
    most = np.zeros(rows, np.int64)
    for last, first in ((hi, 1), (hi - 1, 0)):  # an edit at a letter; a letter inserted behind one
        change = np.zeros((rows, places + longest + 4), np.int64)
        np.add.at(change, (row, lo), 1)
        np.add.at(change, (row, last + 1), -1)
        most = np.maximum(most, np.cumsum(change, axis=1)[:, first:letters + 1].max(1))
    rare = (np.minimum(often, 2**32 - 1).astype(np.uint64) << np.uint64(32)) | (mix(code) >> np.uint64(32))
    rare[~kept] = np.uint64(2**64 - 1)
    order = np.argsort(rare, axis=1, kind="stable")[:, :int(most.max()) + 1]
    take = lambda a: np.take_along_axis(a, order, 1)
    return order, take(size), take(code), np.arange(order.shape[1]) <= most[:, None]


def _latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def _words(batches):
    for b in batches:
        for lo in range(0, b.num_rows, STEP_WORDS):
            part = b.slice(lo, STEP_WORDS)
            yield _latin(part.column(0)), part.column(1).to_numpy(zero_copy_only=False)


def _blocks(found) -> pa.RecordBatch:
    found = list(found)
    return pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())],
                                      ["shard", "block"])


def _count_keys(rows: DataFrame, keys_of, folder: str, table: str, bits: int, keep) -> None:
    """Counts the hashes that ``keys_of(words, n)`` yields; ``keep(columns, counts)`` tells what the arrays hold."""
    def run(batches):
        pool = grams.Pool(bits)
        for words, n in _words(batches):
            for values in keys_of(words, n):
                values = np.sort(values)
                at = grams.edges_of(values)
                yield _blocks(pool.add([values[at]], np.diff(np.append(at, len(values)))))
        yield _blocks(pool.flush())

    def merge(shard, blocks):
        keys, (values,), (n,) = grams.merge(blocks, 1)
        stay = keep(values, n)
        grams.write_arrays(folder, f"{table}-{shard}", [keys[stay], grams.least(n[stay])])
        return [(shard, b"")]
    grams.merged(rows.mapInArrow(run, "shard int, block binary"), ["shard"], merge).count()


def _postings(words: list[bytes], n: np.ndarray, store: grams.ArrayStore):
    """Yields (key, class, role, rank, word index, place, length, used) of the words' lists, a class at a time.

    Role 0: a word of the class; 1: it again, a letter further on; 2: a word with one letter more.
    """
    for letters, at, m in by_length(words):
        codes = gram_codes(m, GRAM_MAX)
        counts = {q: store.lookup("gram", [c.ravel()], 1)[0].reshape(c.shape) for q, c in codes.items()}
        for cls in (letters, letters - 1):
            if cls < MIN_LETTERS:
                continue
            longest = min(GRAM_MAX, (cls + 2) // 2)
            place, size, code, used = decompose(codes, counts, letters, longest)
            row, rank = np.nonzero(used)
            for role, shift in ((0, 0), (1, 1)) if cls == letters else ((2, 0),):
                key = grams.key([code[row, rank], (place[row, rank] + shift).astype(np.uint64), np.full(len(row), cls, np.uint64)])
                yield key, cls, role, rank, at[row], row, place, size, used


def near_words(vocab: DataFrame, keep_from: int = KEEP_FROM, block: int = BLOCK, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """word, n_near, form_n, form (the near word of largest n, the smallest of ties) of every word that has a near one."""
    ship_package(vocab.sparkSession)
    folder, size = scratch_path(vocab.sparkSession, "spelling"), vocab.count()
    bits = (size * 40 // grams.SHARD_GRAMS).bit_length()
    buckets = (size * 16 // bucket_rows).bit_length()
    _count_keys(vocab, lambda words, n: (np.concatenate([c.ravel() for c in gram_codes(m, GRAM_MAX).values()])
                                         for _, _, m in by_length(words)),
                folder, "gram", bits, lambda codes, n: (codes >> np.uint64(56) == GRAM_MIN) | (n >= keep_from))
    opened: dict[str, grams.ArrayStore] = {}
    store = lambda: opened.setdefault(folder, grams.ArrayStore(folder, bits))
    _count_keys(vocab, lambda words, n: (p[0] for p in _postings(words, n, store())),
                folder, "long", bits, lambda keys, n: n > block)

    def lists(batches):
        for words, n in _words(batches):
            for key, cls, role, rank, at, row, place, length, used in _postings(words, n, store()):
                parts = -(-store().lookup("long", [key], 1)[0] // block)
                side = np.zeros(len(key), np.int64)
                if (parts > 1).any():  # once for each pair of blocks
                    own = (mix(at.astype(np.uint64) ^ key) % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64)
                    times = np.maximum(parts, 1)
                    rep = np.repeat(np.arange(len(key)), times)
                    other = np.arange(len(rep)) - np.repeat(np.cumsum(times) - times, times)
                    lo, hi = np.minimum(own[rep], other), np.maximum(own[rep], other)
                    split = parts[rep] > 1
                    side = np.where(split & (lo != hi), 1 + (own[rep] > other), 0)
                    pair = grams.key([key[rep], lo.astype(np.uint64), hi.astype(np.uint64)])
                    key, rank, at, row = np.where(split, pair, key[rep]), rank[rep], at[rep], row[rep]
                shard = grams.shard_of(key, buckets)
                order = np.argsort(shard, kind="stable")
                edges = grams.edges_of(shard[order])
                out = []
                for a, b in zip(edges, np.append(edges[1:], len(order))):
                    o = order[a:b]
                    mine = used[row[o]]
                    out.append((int(shard[o[0]]), grams.dump(
                        [np.array([cls], "i8"), key[o], (role | side[o] << 2).astype("u1"), grams.least(rank[o]), grams.least(n[at[o]]),
                         grams.least(mine.sum(1)), grams.least(place[row[o]][mine]), length[row[o]][mine].astype("u1"),
                         np.frombuffer(b"".join([words[i] for i in at[o]]), np.uint8)])))
                yield _blocks(out)
    found = vocab.mapInArrow(lists, "shard int, block binary")

    def compare(table: pa.Table) -> pa.Table:
        classes: dict[int, list] = {}
        for b in table["block"].combine_chunks():
            parts = grams.load(memoryview(b.as_buffer()))
            classes.setdefault(int(parts[0][0]), []).append(parts[1:])
        out = [_near_of_class(cls, [np.concatenate(x) for x in zip(*parts)]) for cls, parts in classes.items()]
        return pa.table({name: pa.array([v for o in out for v in o[i]], kind) for i, (name, kind) in enumerate(
            (("word", pa.string()), ("found", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())))})
    return (found.groupBy("shard").applyInArrow(compare, "word string, found long, best_n long, best string")
            .groupBy("word").agg(F.sum("found").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("form_n"), F.col("b.best").alias("form")))


def _near_of_class(cls: int, parts: list[np.ndarray]):
    """(words, near words found, n of the best, the best) of one bucket's lists of one class."""
    key, role, rank, n, used, place, length, chars = parts
    side, role = role >> 2, role & 3
    letters = cls + (role == 2)
    first, start = np.cumsum(used.astype(np.int64)) - used, np.cumsum(letters) - letters
    order = np.argsort(key, kind="stable")
    run = grams.edges_of(key[order])
    sizes = np.diff(np.append(run, len(order)))
    order = order[np.repeat(sizes > 1, sizes)]  # a list of one word meets nobody
    sizes = sizes[sizes > 1]
    if not len(order):
        return [], [], [], []
    role, side, rank, n, used = role[order], side[order], rank[order].astype(np.int64), n[order].astype(np.int64), used[order].astype(np.int64)
    first, start, letters = first[order], start[order], letters[order]
    where = np.minimum(start[:, None] + np.arange(cls + 1), len(chars) - 1)
    m = np.where(np.arange(cls + 1) < letters[:, None], chars[where], 0).astype(np.uint8)
    held = np.bitwise_or.reduce(np.where(m > 0, np.uint64(1) << (m & 63).astype(np.uint64), np.uint64(0)), axis=1)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(order))  # rows of the list from here on
    alive, k, one, two = np.arange(len(order)), 0, [], []
    while True:
        k += 1
        alive = alive[left[alive] > k]
        if not len(alive):
            break
        for lo in range(0, len(alive), 1 << 16):
            a = alive[lo:lo + (1 << 16)]
            b = a + k
            ok = (side[a] == 0) | (side[a] != side[b])
            ok &= (np.bitwise_count(held[a] ^ held[b]) <= 2) & ((role[a] | role[b]) != 1) & ((role[a] & role[b]) == 0)
            a, b = a[ok], b[ok]
            cross = (role[a] == 2) | (role[b] == 2)
            same = ~cross
            hit = np.zeros(len(a), bool)
            hit[same] = (m[a[same]] != m[b[same]]).sum(1) == 1
            s, t = np.where(role[a] == 2, b, a)[cross], np.where(role[a] == 2, a, b)[cross]
            lead = np.logical_and.accumulate(m[s][:, :cls] == m[t][:, :cls], axis=1).sum(1)
            trail = np.logical_and.accumulate((m[s][:, :cls] == m[t][:, 1:])[:, ::-1], axis=1).sum(1)
            hit[cross] = lead + trail >= cls
            swap = cross & (role[a] == 2)
            one.append(np.where(swap, b, a)[hit])
            two.append(np.where(swap, a, b)[hit])
    one, two = np.concatenate(one), np.concatenate(two)  # of a pair of unequal length, one is the shorter
    if len(one):
        marked = np.zeros((len(m), cls + 3 + GRAM_MAX), np.uint8)
        marked[:, 0] = 1
        marked[:, 1:cls + 2] = m
        marked[np.arange(len(m)), letters + 1] = 2
        stay = _first_meeting(one, two, marked, role, rank, used, first, place, length)
        one, two = one[stay], two[stay]
    if not len(one):
        return [], [], [], []
    text = np.ascontiguousarray(m).view(f"S{cls + 1}").ravel()
    word, near = np.concatenate([one, two]), np.concatenate([two, one])
    ids = np.zeros(len(m), np.int64)
    some = np.unique(word)
    ids[some] = np.searchsorted(np.sort(text[some]), text[some])  # in the order of the words, equal ones alike
    order = np.lexsort((ids[near], -n[near], ids[word]))
    at = grams.edges_of(ids[word[order]])
    count = np.diff(np.append(at, len(order)))
    decode = lambda rows: [w.decode("latin-1") for w in text[rows].tolist()]
    return decode(word[order][at]), count.tolist(), n[near[order][at]].tolist(), decode(near[order][at])


def _first_meeting(one, two, marked, role, rank, used, first, place, length) -> np.ndarray:
    """True where no gram before this list's, in the order of ``one``, is a gram of both words' lists."""
    def element(rows, j):
        """(gram, place) at rank j of the rows' words; gram 0 beyond the last."""
        there = j < used[rows]
        at = np.where(there, first[rows] + j, 0)
        p, q = place[at].astype(np.int64), length[at].astype(np.int64)
        code = np.zeros(len(rows), np.uint64)
        for t in range(GRAM_MAX):
            code = np.where(t < q, (code << np.uint64(8)) | marked[rows, np.minimum(p + t, marked.shape[1] - 1)], code)
        return np.where(there, code | (q.astype(np.uint64) << np.uint64(56)), np.uint64(0)), p
    earlier = np.zeros(len(one), bool)
    top = int(used[two].max())
    theirs = [element(two, j) for j in range(top)]
    cross = role[two] == 2
    for j in range(int(rank[one].max()) + 1):
        code, p = element(one, j)
        for other, at in theirs:
            same = (code == other) & (code != 0)
            before = rank[one] > j
            earlier |= same & before & ((at == p) | (cross & (at == p + 1)))
            # the same gram stands a letter further on in this list, but had met in its own place
            earlier |= same & (rank[one] == j) & (role[one] == 1) & (at == p)
    return ~earlier


def variants(docs: DataFrame, stage, ratio: int = RATIO, doc_id: str = "doc_id", text: str = "text", **near) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary.

    A word's form is its near word of largest n, if that is ``ratio`` times
    its own or more; its root is the last of the forms' forms.
    """
    vocab = stage(vocabulary(docs, doc_id=doc_id, text=text))
    found = near_words(vocab, **near)
    rows = stage(vocab.join(found, "word", "left").withColumn("has", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
                 .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         *[F.when(F.col("has"), F.col(c)).alias(c) for c in ("form", "form_n")]))
    # a form is ``ratio`` times as frequent, so chains are short; pointers double until none moves
    roots = stage(rows.filter("form is not null").select("word", F.col("form").alias("root")))
    moved = 1
    while moved:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = stage(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                               F.col("further").isNotNull().alias("moved")))
        moved = roots.filter("moved").count()
    return (split_join(rows, roots.select("word", "root"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
