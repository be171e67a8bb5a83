"""Operators on counted n-grams and words, against brute force: odd rows, empty tables, sf0.01."""
import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import cases  # noqa: E402
from recunify.llm import collocations, grams, kneser_ney, langid, spelling  # noqa: E402
from recunify.llm.queries import QUERIES  # noqa: E402
from recunify.llm.store import stage  # noqa: E402


def same_scores(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, round(r[5], 6), round(r[6], 6))
    got, want = sorted((tuple(r)[:7] for r in got), key=order), sorted(want, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_kneser_ney_odd_rows(spark, order):
    docs = cases.frame(spark).withColumn("held_out", langid.held_out(F.col("doc_id"), 7, 2))
    model = kneser_ney.fit(docs.filter("not held_out"), order=order, shard_grams=1 << 10)
    got = kneser_ney.score(docs, model, keep=("held_out",)).collect()
    same_scores(got, cases.brute_kneser_ney(cases.odd_rows(), order))


def test_kneser_ney_whole_table(spark):
    got = QUERIES["op12_lm_scoring"](spark, cases.SF01).collect()
    same_scores(got, cases.brute_kneser_ney(cases.documents(), kneser_ney.ORDER))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_kneser_ney_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id bigint, text string")
    model = kneser_ney.fit(docs.filter("doc_id > 5"))
    assert [tuple(r)[:6] for r in kneser_ney.score(docs, model).orderBy("doc_id").collect()] == \
        [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert kneser_ney.score(docs.filter("doc_id > 5"), model).count() == 0


def test_kneser_ney_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "a b a c a b"), (2, "b b c")], "doc_id bigint, text string")
    model = kneser_ney.fit(docs, order=2)
    probe = spark.createDataFrame([(i, f"a {w}") for i, w in enumerate(["a", "b", "c", "other"])], "doc_id bigint, text string")
    import pyarrow as pa
    store, total = grams.ArrayStore(model.folder, model.bits), 0.0
    for w in [*"abc", "other"]:
        codes, targets, _ = kneser_ney.token_codes(pa.array([f"a {w}"]), 2)
        total += kneser_ney.probabilities(codes, targets, model, store)[0][1]
    codes, targets, _ = kneser_ney.token_codes(pa.array(["a"]), 2)
    total += kneser_ney.probabilities(codes, targets, model, store)[0][1]
    assert abs(total - 1) < 1e-9 and probe.count() == 4


def test_packed_blocks_round_trip():
    r = np.random.default_rng(4)
    codes = r.integers(1, 50, 5000, dtype=np.uint64)
    for width in (1, 2, 3, 4):
        cols, n = next(grams.counted(codes, lambda lo, hi: [np.arange(lo, hi) + k for k in range(width)], 4000))
        back, values = grams.unpack(grams.pack(cols, [n]), width)
        assert all((a == b).all() for a, b in zip(cols, back)) and (values[0] == n).all()
        blocks = [b for _, b in grams.dealt(cols, [n], 3, True)] * 2
        keys, _, total = grams.merge(blocks, width)
        assert len(keys) == len(n) and total[0].sum() == 8000 and (np.diff(keys.astype(object)) > 0).all()


@pytest.mark.parametrize("shard_grams", [grams.SHARD_GRAMS, 1 << 10])
def test_collocations_odd_rows(spark, shard_grams):
    got = collocations.collocations(cases.frame(spark), lambda df: stage(df, "test"), min_count=2, shard_grams=shard_grams)
    assert {tuple(r) for r in got.collect()} == cases.brute_collocations(cases.odd_rows(), 2)


def test_collocations_whole_table(spark):
    got = {tuple(r) for r in QUERIES["op13_collocations"](spark, cases.SF01).collect()}
    assert got and got == cases.brute_collocations(cases.documents())


def test_collocations_ties_pieces_and_languages(spark):
    rows = [(i, t, lang) for lang in ("en", None, "und") for i, t in enumerate(
        ["b a, b a. a b c d! a b c d", "A\tB  C d\nx\x0by x\x0by", "é;é é é é", "a b c d a b c d a b c d", "", None])]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id int, text string, lang string, rank string, score string")
    for top in (1, 3, 100):
        got = collocations.collocations(docs, lambda df: stage(df, "test"), min_count=2, top=top)
        assert {tuple(r) for r in got.collect()} == cases.brute_collocations(rows, 2, top)
    assert collocations.collocations(docs.filter("doc_id > 50"), lambda df: stage(df, "test")).count() == 0


def test_collocation_paths_are_compacted(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(i, passage, "en") for i in range(12)] + [(20 + i, "p q p q p q p q", "en") for i in range(12)]
    rows += [(40 + i, "w7 w8 w9 other", "en") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    keep = lambda df: stage(df, "test")
    found = collocations.graph(docs, keep)
    got = collocations.paths(found, keep).collect()
    assert len(got) == 38 + 1 + 2
    names = {r.code: r.word for r in collocations._spelling(docs.select("text")).collect()}
    chains = {}
    for r in sorted(got, key=lambda r: -r.place):
        chains.setdefault(r.path, []).append(" ".join(names[w] for w in (r.w1, r.w2, r.w3)))
    chains = sorted(chains.values(), key=len)
    # the passage breaks where another text enters (w7 w8) and leaves (w8 w9); pieces end at w8 w9 other
    assert [len(c) for c in chains][-2:] == [7, 30] and chains[-2][0] == "w0 w1 w2" and chains[-2][-1] == "w6 w7 w8"
    assert all(a.split()[1:] == b.split()[:2] for c in chains for a, b in zip(c, c[1:]))


def syllable_rows():
    r = random.Random(1)
    parts = ["ab", "cion", "tion", "er", "th", "an", "é", "ö", "x", "q"]
    rows = [(i, " ".join("".join(r.choice(parts) for _ in range(r.randrange(2, 5))) for _ in range(400))) for i in range(60)]
    return rows + [(100, " ".join(["a" * 5000] * 3 + ["a" * 5001] * 3 + ["aaaaa"] * 7 + ["aaaaaa"] * 3))]


@pytest.mark.parametrize("near", [{}, {"keep_from": 3, "block": 4, "bucket_rows": 50}])
def test_spelling_variants_odd_rows(spark, near):
    keep = lambda df: stage(df, "test")
    odd = cases.odd_rows() + [(200 + i, "Élan éLAN élan colour color colors colouR ABCDE abcde ábcde", *cases.odd_rows()[0][2:])
                              for i in range(4)]
    for rows, docs in ((odd, cases.frame(spark, odd)),
                       (syllable_rows(), spark.createDataFrame(syllable_rows(), "doc_id int, text string").repartition(3))):
        got = {tuple(r) for r in spelling.variants(docs, keep, **near).collect()}
        assert got == cases.brute_variants(cases.brute_vocabulary(rows))
    assert spelling.variants(docs.filter("doc_id > 500"), keep).count() == 0


def test_spelling_variants_whole_table(spark):
    got = {tuple(r) for r in QUERIES["op11_spelling_variants"](spark, cases.SF01).collect()}
    assert got == cases.brute_variants(cases.brute_vocabulary(cases.documents()))


def test_affected_gram_bound_leaves_a_gram():
    r = random.Random(2)
    words = ["".join(r.choice("abé") for _ in range(r.randrange(5, 14))).encode("latin-1") for _ in range(300)]
    for letters, _, m in spelling.by_length(words):
        codes = spelling.gram_codes(m, spelling.GRAM_MAX)
        counts = {q: np.where(c % np.uint64(3) == 0, 5, 1 if q == 2 else 0) for q, c in codes.items()}
        for q in range(3, max(counts) + 1):  # a gram's beginning is at least as frequent
            counts[q] = np.where(counts[q - 1][:, :counts[q].shape[1]] > 0, counts[q], 0)
        longest = min(spelling.GRAM_MAX, (letters + 2) // 2)
        place, size, _, used = spelling.decompose(codes, counts, letters, longest)
        assert (used.sum(1) >= 1).all() and (size[used] >= 2).all() and (place + size <= letters + 2)[used].all()
