"""Phrase collocation mining on a weighted de Bruijn graph.

Texts (A-Z in lower case) are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
those at blanks and tabs into words.  Per language, nodes are the word pairs
of a piece and an edge joins the pair w1 w2 to w2 w3 for each triple w1 w2 w3.

1. Only the edges, the longest grams, are counted over the texts.  A pair at
   the end of a piece is an edge to the end mark, a last word two such steps:
   the piece-end corrections.  Tasks send an edge once a chunk of text;
   ``grams`` deals edges to shards by a hash of the whole triple, so no word
   or pair gathers in one task.
2. Shorter counts follow from flow: a pair occurs as often as its outgoing
   edges sum to (corrections included), a word as often as its pairs do.  Each
   is one merge of partial sums, not another pass over the texts.
3. Unary paths are compacted: a node whose whole flow comes by one edge and
   leaves by one edge is taken out of the graph; its count is its edge's.
   Such a pair lies in a triple just as frequent, so it is never reported, and
   edges look only their remaining end nodes up.  ``paths`` gives the
   compacted paths as such.
4. Phrases of two or three words seen ``min_count`` times or more are scored
   by their weakest cut, in exact decimal arithmetic; pairs with an edge half
   as frequent or more go; each language's best ``top`` are ranked.  Words are
   hashes until here; the texts are read once more for the spelling of those
   in the ranking.

Odd input: null and empty texts have no pieces; a null language is ``und``.
Repeated rows count each time.  An empty table gives no phrase.  Words whose
64-bit hashes are equal would be taken for one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recunify.llm import grams
from recunify.llm.store import split_join
from recunify.llm.text import pick, slices, span_hashes, utf8, words

MIN_COUNT, TOP, DROP_PERCENT = 10, 2000, 50
TEXT_STEP = 1 << 20
_CUTS = np.zeros(256, bool)
_CUTS[[*b".,;:!?", 10, 11, 12, 13]] = True
#: Bytes of a word: all but blank, tab and the cuts.
_INSIDE = ~_CUTS
_INSIDE[[0x20, 0x09]] = False
#: Kinds of result rows: triples, pairs, words, and the number of all words.
TRIPLE, PAIR, WORD, ALL = 30, 20, 10, 11
_RESULTS = (TRIPLE, PAIR, WORD, ALL)


def piece_words(column: pa.Array):
    """(bytes, starts, ends, hashes, linked): all words, and whether the next one is in the same piece."""
    offs, data = utf8(column)
    capital = (data >= 65) & (data <= 90)
    if capital.any():
        data = data + np.where(capital, 32, 0).astype(np.uint8)
    starts, ends, first = words(offs, data, _INSIDE)
    cuts = np.cumsum(_CUTS[data], dtype=np.int64)[starts] if len(starts) else starts
    linked = np.zeros(len(starts), bool)
    linked[:-1] = cuts[1:] == cuts[:-1]
    last = first[1:][np.diff(first) > 0] - 1
    linked[last] = False
    return data, starts, ends, span_hashes(data, starts, ends), linked


def _by_language(batch: pa.RecordBatch):
    """Yields (language, texts) of a batch of text, lang."""
    names = batch.column(1).fill_null("und") if batch.column(1).null_count else batch.column(1)
    codes = names.dictionary_encode()
    for i, name in enumerate(codes.dictionary.to_pylist()):
        yield name, batch.column(0).filter(pc.equal(codes.indices, i))


def _edges(docs: DataFrame, bits: int) -> DataFrame:
    """(lang, tag, shard, block) of the edges, end marks included."""
    def out(lang, found):
        found = list(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array([3] * len(found), pa.int32()),
             pa.array([s for s, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())],
            ["lang", "tag", "shard", "block"])

    def run(batches):
        pools: dict[str, grams.Pool] = {}
        for batch in slices(batches, "text", TEXT_STEP):
            for lang, texts in _by_language(batch):
                _, _, _, codes, linked = piece_words(texts)
                two = np.append(linked[:-1] & linked[1:], False)[:len(linked)]

                def at(lo, hi, linked=linked, two=two):
                    here = np.arange(lo, hi)
                    return [here, np.where(linked[lo:hi], here + 1, -1), np.where(two[lo:hi], here + 2, -1)]
                pool = pools.setdefault(lang, grams.Pool(bits))
                for cols, n in grams.counted(codes, at, len(codes)):
                    yield out(lang, pool.add(cols, n))
            if sum(p.rows for p in pools.values()) >= grams.POOL_ROWS:
                for lang, pool in pools.items():
                    yield out(lang, pool.flush())
        for lang, pool in pools.items():
            yield out(lang, pool.flush())
    return docs.mapInArrow(run, "lang string, tag int, shard int, block binary")


def _merge(level: int, bits: int, min_count: int):
    """Edges give flows of nodes, nodes those of words; frequent ones of each are results."""
    def send(lang, tag, columns, values, how):
        if len(columns[0]):
            _, c, v = grams.combine(columns, values, how)
            yield from ((lang, tag, s, b) for s, b in grams.dealt(c, v, bits))

    def result(lang, tag, shard, columns, values):
        if len(values[0]):
            yield lang, tag, shard, grams.dump([*columns, *[v.astype("i8") for v in values]])

    def fn(lang, tag, shard, blocks):
        if tag in _RESULTS:
            yield from ((lang, tag, shard, bytes(b)) for b in blocks)
        elif level == 3:
            _, (a, b, c), (n,) = grams.merge(blocks, 3)
            often = (c != 0) & (n >= min_count)
            yield from result(lang, TRIPLE, shard, [x[often] for x in (a, b, c)], [n[often]])
            peak = np.where(often, n, 0)
            none = np.zeros(int(often.sum()), np.int64)
            yield from send(lang, 2, [np.concatenate([a, b[often]]), np.concatenate([b, c[often]])],
                            [np.concatenate([n, none]), np.concatenate([peak, none]), np.concatenate([peak * 0, n[often]])],
                            ("sum", "max", "max"))
        elif level == 2:
            _, (a, b), (n, out, into) = grams.merge(blocks, 2, ("sum", "max", "max"))
            often = (b != 0) & (n >= min_count)
            yield from result(lang, PAIR, shard, [a[often], b[often]], [n[often], out[often], into[often]])
            yield from send(lang, 1, [a], [n], ("sum",))
        else:
            _, (a,), (n,) = grams.merge(blocks, 1)
            yield from result(lang, WORD, shard, [a[n >= min_count]], [n[n >= min_count]])
            yield from result(lang, ALL, shard, [], [np.array([n.sum()])])
    return fn


_COLUMNS = "lang string, tag int, w1 long, w2 long, w3 long, f long, leaves long, enters long"


def _unpacked(rows: list[tuple]) -> pa.Table:
    """The result rows: word hashes, f, and leaves and enters, the heaviest edges of a pair."""
    widths = {TRIPLE: (3, 1), PAIR: (2, 3), WORD: (1, 1), ALL: (0, 1)}
    schema = pa.schema([(c.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]])
                        for c in _COLUMNS.split(", ")])
    out = []
    for lang, tag, _, block in rows:
        parts, (k, v) = grams.load(block), widths[tag]
        n = len(parts[0])
        hashes = [pa.array(x.view("i8")) for x in parts[:k]] + [pa.nulls(n, pa.int64())] * (3 - k)
        values = [pa.array(x) for x in parts[k:]] + [pa.nulls(n, pa.int64())] * (3 - v)
        out.append(pa.table([pa.array([lang] * n, pa.string()), pa.array([tag] * n, pa.int32()), *hashes, *values], schema=schema))
    return pa.concat_tables(out) if out else schema.empty_table()


def graph(docs: DataFrame, stage, min_count: int = MIN_COUNT, text: str = "text", lang: str = "lang",
          shard_grams: int = grams.SHARD_GRAMS) -> DataFrame:
    """The frequent part of the graph, staged: lang, tag (edge, node, word or total), w1, w2, w3 (word
    hashes), f, and for a node the heaviest edges that leave and enter it."""
    slim = pick(docs, text=text, lang=lang)
    bits = grams.shard_bits(slim, grams=shard_grams)
    rows = _edges(slim, bits)
    keys = ["lang", "tag", "shard"]
    for level in (3, 2):
        rows = grams.merged(rows, keys, _merge(level, bits, min_count))
    return stage(grams.merged(rows, keys, _merge(1, bits, min_count), _unpacked, _COLUMNS))


def _unary(node: str = "f") -> str:
    return f"leaves = {node} and enters = {node}"


def paths(found: DataFrame, stage) -> DataFrame:
    """The compacted paths of a graph: lang, path (its last edge), place (edges to that last one), w1, w2, w3, f.

    Edges joined by a unary node follow each other on one path.  An edge
    points at the next one; pointers are doubled until all reach a last edge,
    so a path of n edges takes log2(n) rounds.  Edges that still have none
    after as many rounds as the graph could need lie on closed unary paths,
    and each is a path of its own.
    """
    edges = found.filter(F.col("tag") == TRIPLE).select("lang", "w1", "w2", "w3", "f").withColumn(
        "edge", F.xxhash64("lang", "w1", "w2", "w3"))
    inner = found.filter(F.col("tag") == PAIR).filter(_unary()).select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"))
    after = edges.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("edge").alias("next"))
    now = stage(edges.join(inner.join(after, ["lang", "w2", "w3"]), ["lang", "w2", "w3"], "left")
                .select("edge", "next", F.when(F.col("next").isNull(), 0).otherwise(1).alias("place")))
    open_edges, moved, rounds = now.filter("next is not null").count(), 1, 0
    while moved and 1 << rounds <= 2 * open_edges:
        ahead = now.select(F.col("edge").alias("next"), F.col("next").alias("next2"), F.col("place").alias("place2"))
        now = stage(now.join(ahead, "next", "left").select(
            "edge", F.coalesce("next2", "next").alias("next"), F.col("next2").isNotNull().alias("moved"),
            (F.col("place") + F.when(F.col("next2").isNotNull(), F.col("place2")).otherwise(0)).alias("place")))
        moved, rounds = now.filter("moved").count(), rounds + 1
    last = now.filter("next is null").select(F.col("edge").alias("next"), F.lit(True).alias("ends"))
    return (edges.join(now, "edge").join(last, "next", "left")
            .select("lang", F.when(F.col("ends"), F.col("next")).otherwise(F.col("edge")).alias("path"),
                    F.when(F.col("ends"), F.col("place")).otherwise(0).alias("place"), "w1", "w2", "w3", "f"))


def scored(found: DataFrame, drop_percent: int = DROP_PERCENT) -> DataFrame:
    """Candidates: lang, w1, w2, w3 (null for a pair), a, l, r, n, score."""
    node, word = found.filter(F.col("tag") == PAIR), found.filter(F.col("tag") == WORD).select("lang", "w1", "f")
    kept = node.filter(f"not ({_unary()})")
    pairs = (kept.filter(f"100 * greatest(leaves, enters) < {drop_percent} * f")
             .select("lang", "w1", "w2", "w3", F.col("f").alias("a"), F.col("w2").alias("last"),
                     F.lit(None).cast("long").alias("head"), F.lit(None).cast("long").alias("tail")))
    ends = lambda a, b, name: kept.select("lang", F.col("w1").alias(a), F.col("w2").alias(b), F.col("f").alias(name))
    triples = (found.filter(F.col("tag") == TRIPLE).select("lang", "w1", "w2", "w3", F.col("f").alias("a"), F.col("w3").alias("last"))
               .join(ends("w1", "w2", "head"), ["lang", "w1", "w2"], "left")
               .join(ends("w2", "w3", "tail"), ["lang", "w2", "w3"], "left")
               .select("lang", "w1", "w2", "w3", "a", "last", F.coalesce("head", "a").alias("head"),
                       F.coalesce("tail", "a").alias("tail")))
    both = pairs.unionByName(triples)
    both = both.join(word.select("lang", "w1", F.col("f").alias("one")), ["lang", "w1"])
    both = both.join(word.select("lang", F.col("w1").alias("last"), F.col("f").alias("end")), ["lang", "last"])
    total = found.filter(F.col("tag") == ALL).groupBy("lang").agg(F.sum("f").alias("n"))
    exact = lambda c: F.col(c).cast("decimal(16,0)")
    for c in ("a", "one", "end", "head", "tail"):
        both = both.withColumn(f"{c}_", exact(c))
    cut = "(1000000bd * a_ * a_) div ({} * {})"
    return (both.withColumn("rest", F.coalesce("tail", "end")).withColumn("front", F.coalesce("head", "one"))
            .withColumn("s1", F.expr(cut.format("one_", "coalesce(tail_, end_)")))
            .withColumn("s2", F.expr(cut.format("coalesce(head_, one_)", "end_")))
            .withColumn("first_cut", F.col("w3").isNull() | (F.col("s1") <= F.col("s2")))
            .select("lang", "w1", "w2", "w3", "a", F.when(F.col("first_cut"), F.col("one")).otherwise(F.col("front")).alias("l"),
                    F.when(F.col("first_cut"), F.col("rest")).otherwise(F.col("end")).alias("r"),
                    F.when(F.col("first_cut"), F.col("s1")).otherwise(F.col("s2")).alias("score"))
            .join(total, "lang"))


def _spelling(docs: DataFrame) -> DataFrame:
    """(code, word): the words of the texts, once a chunk."""
    def run(batches):
        for batch in slices(batches, "text", TEXT_STEP):
            data, starts, ends, codes, _ = piece_words(batch.column(0))
            order = np.argsort(codes)
            rep = order[grams.edges_of(codes[order])]
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[rep].view("i8")), pa.array([raw[s:e] for s, e in zip(starts[rep].tolist(), ends[rep].tolist())],
                                                           pa.binary()).cast(pa.string())], ["code", "word"])
    return docs.mapInArrow(run, "code long, word string")


def collocations(docs: DataFrame, stage, min_count: int = MIN_COUNT, top: int = TOP, drop_percent: int = DROP_PERCENT,
                 text: str = "text", lang: str = "lang", shard_grams: int = grams.SHARD_GRAMS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of each language."""
    found = graph(docs, stage, min_count, text, lang, shard_grams)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # all that tie with the last one stay until their spelling decides
    near = stage(scored(found, drop_percent).withColumn("place", F.rank().over(best)).filter(F.col("place") <= top).drop("place"))
    need = stage(near.select(F.explode(F.array("w1", "w2", "w3")).alias("code")).filter("code is not null").distinct())
    names = stage(split_join(_spelling(pick(docs, text=text)), need, "code").dropDuplicates(["code"]))
    for i in (1, 2, 3):
        near = near.join(names.select(F.col("code").alias(f"w{i}"), F.col("word").alias(f"p{i}")), f"w{i}", "left")
    phrase = near.withColumn("phrase", F.concat_ws(" ", "p1", "p2", "p3"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (phrase.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
