"""Trained operators, the license scan and the pipeline: held-out figures, odd rows, empty tables."""
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import cases  # noqa: E402
from recunify.llm import langid, licenses, secret_scan, toxicity  # noqa: E402
from recunify.llm.queries import QUERIES  # noqa: E402


def test_language_held_out(spark):
    lang = {r[0]: r[2] for r in cases.documents()}
    rows = QUERIES["op4_language_id"](spark, cases.SF01).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (cases.crc(r.doc_id) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.99 * len(held)


def test_language_odd_rows(spark):
    docs = spark.read.parquet(f"{cases.SF01}/documents.parquet")
    model = langid.fit(docs)
    odd = cases.frame(spark)
    rows = langid.predict(odd, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in cases.odd_rows())
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {0, 1, 2, 3, 18} <= und and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert {r.lang_pred for r in rows if r.doc_id in (7, 11)} <= set(model[0])
    kept = langid.keep_known(odd, model)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        r.doc_id for r in rows if r.lang_pred != "und" and r.cosine >= langid.MIN_COSINE)
    nothing = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}
    assert langid.predict(cases.frame(spark, []), model).count() == 0


def test_the_stage_decides_by_the_prediction(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{cases.SF01}/documents.parquet")
    texts = ["qqq zzz xxx qxz", "привет как дела сегодня", "the of and to in that it", "12 34", None]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    odd = spark.createDataFrame(rows, docs.schema)
    model = langid.fit(docs)
    best = {r.doc_id: (r.lang_pred, r.cosine) for r in langid.predict(odd, model).collect()}
    assert best[0][0] != "und" and best[0][1] < langid.MIN_COSINE and best[2][1] > 0.2  # letters alone don't do
    assert [r.doc_id for r in langid.keep_known(odd, model).collect()] == [2]
    assert 2 not in {r.doc_id for r in langid.keep_known(odd, (model[0], -model[1])).collect()}  # prototypes turned round
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(odd.withColumn("doc_id", odd.doc_id - 9)),
                                                          cases.SF01).collect()}
    assert {i for i in kept if i < 0} == {-7} and len(kept) >= 0.97 * docs.count()


def test_vectors_against_plain_loops():
    import numpy as np
    r = __import__("random").Random(3)
    for text in ("Ab, ça!", "", "a", "x1y", "Straße 12 ÉTÉ", cases.random_text(r, 30)):
        want, symbols = np.zeros(langid.DIM), [0]
        for c in text:
            code = ord(c.lower()[0]) if c.isalpha() else 0
            if code or symbols[-1]:
                symbols.append(code)
        symbols += [0] if symbols[-1] else []
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            if b:
                v = [langid._letter_vector(x).astype(float) for x in (a, b, c)]
                want += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
        assert np.allclose(langid.vectors([text])[0], want)


def test_many_short_texts_take_little_memory():
    import tracemalloc
    r = __import__("random").Random(3)
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(15)) for _ in range(1 << 15)]
    langid.vectors(texts[:10])
    tracemalloc.start()
    out = langid.text_vectors(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.shape == (1 << 15, langid.DIM) and peak < 300e6


def test_sample_of_a_repeated_id_is_bounded(spark):
    df = spark.range(3000).selectExpr("7L as doc_id", "id")
    assert 10 <= langid.bounded_sample(df, 10).count() <= 20
    mixed = spark.range(3000).selectExpr("if(id % 3 = 0, 7L, id) as doc_id")
    assert 1 <= langid.bounded_sample(mixed, 100).count() <= 200


def test_long_text_is_bundled_in_parts():
    text = cases.random_text(__import__("random").Random(1), 200_000)
    whole, part = langid.text_vectors([text])[0], langid.text_vectors([text[:100_000]])[0]
    assert abs((whole ** 2).sum() - 1) < 1e-3 and whole @ part > 0.95


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op7_toxicity"](spark, sf).collect()]
    assert all(r.held_out == (cases.crc(r.doc_id) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    found = sum(r.predicted for r in held if toxic[r.doc_id])
    assert found >= 0.8 * sum(toxic[r.doc_id] for r in held)
    assert sum(r.predicted for r in held if not toxic[r.doc_id]) <= 0.02 * len(held)


def test_toxicity_calibrates_on_all_labelled_rows(spark, monkeypatch):
    docs = spark.read.parquet(f"{cases.SF01}/documents.parquet")
    labels = spark.read.parquet(f"{cases.SF01}/labels.parquet")
    seen = []
    count = toxicity.score_counts
    monkeypatch.setattr(toxicity, "score_counts", lambda *a: seen.append((a[3], count(*a))) or seen[-1][1])
    model = toxicity.fit(docs, labels, fit_rows=100)  # a sample far smaller than the table
    used, counts = seen[0]
    rest = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id not in used and r.toxic is not None}
    known = [r.doc_id for r in docs.select("doc_id").collect() if r.doc_id in rest]
    assert 0 < len(used) < 200 and sum(n for *_, n in counts) == len(known) > 300
    assert sum(n for _, _, toxic, n in counts if toxic) == sum(rest[i] for i in known)
    assert model["cuts"] == toxicity.cuts_of(counts)
    assert toxicity.cuts_of([("x", 10, 1, 12), ("x", 3, 0, 900), ("y", 5, 1, 2)]) == {"": 4.5 / 64, "x": 7 / 64}


def test_toxicity_odd_rows(spark):
    docs = spark.read.parquet(f"{cases.SF01}/documents.parquet")
    labels = spark.read.parquet(f"{cases.SF01}/labels.parquet")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(cases.frame(spark), model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in cases.odd_rows())
    assert all(0 <= r.score <= 1 for r in rows) and not any(r.predicted for r in rows if r.doc_id in (0, 1, 2, 3))
    assert toxicity.fit(docs, labels.filter("toxic = 0")) is None
    assert {r.score for r in toxicity.score(cases.frame(spark), None).collect()} == {0.0}
    assert toxicity.score(cases.frame(spark, []), model).count() == 0


def test_secret_network_finds_unlabelled_secrets(spark):
    import random
    r = random.Random(6)
    secret = lambda: "".join(r.choice("0123456789abcdef") for _ in range(40))
    number = lambda: "".join(r.choice("0123456789") for _ in range(12)) + "-order"
    rows = [(i, f"{cases.random_text(r, 10)} token = \"{secret()}\" then id{number()} end") for i in range(120)]
    net = secret_scan.fit(spark.createDataFrame(rows, "doc_id bigint, text string"))
    test = [(1, f"kept {secret()[:22]} here"), (2, f"id{number()} only")]  # too short for the hex pattern, no keyword
    got = {x.doc_id: x.spans for x in secret_scan.findings(spark.createDataFrame(test, "doc_id bigint, text string"), net).collect()}
    assert got == {1: "net:5:27", 2: ""} and net.threshold >= 0.5


def test_secret_network_by_kind(spark):
    """Recall on key formats and false alarms on look-alikes, by kind, in texts the network has not seen."""
    from recunify.llm import secret_kinds
    docs = spark.read.parquet(f"{cases.SF01}/documents.parquet")
    net = secret_scan.fit(docs)
    made = secret_kinds.examples(1400, seed=123)
    found = secret_scan.scan_texts([t for t, *_ in made], net)
    kinds = {}
    for (_, s, e, label, kind), spans in zip(made, found):
        kinds.setdefault((label, kind), []).append(any(a < e and s < b for _, a, b in spans))
    rate = {k: sum(v) / len(v) for k, v in kinds.items()}
    assert all(v >= 0.85 for (label, _), v in rate.items() if label), rate
    assert sum(map(sum, (v for (label, _), v in kinds.items() if label))) >= 0.95 * 1400
    assert all(v <= 0.15 for (label, _), v in rate.items() if not label) and rate[0, "uuid"] <= 0.05, rate
    assert sum(map(sum, (v for (label, _), v in kinds.items() if not label))) <= 0.02 * 1400
    quiet = [r.spans for r in secret_scan.findings(docs, net).collect()]
    assert sum("net:" in s for s in quiet) <= 0.02 * len(quiet)  # hardly any in documents that plant the patterns only


def test_secret_network_reads_the_whole_value():
    import numpy as np
    net = secret_scan.CharNet()
    for n in (5, 48, 49, 92, 200):
        value = "".join(chr(33 + i % 90) for i in range(n))
        pieces = net.lines(f"before {value} after", 7, 7 + n)
        assert len({len(p) for p in pieces}) == 1
        windows = {value[i:i + 5] for i in range(n - 4)}
        held = {p[24:72][i:i + 5] for p in pieces for i in range(44)}
        assert windows <= held
    a, b = "x" * 60 + "Q7" + "x" * 60, "x" * 122
    assert not np.allclose(*net.line_scores([net.lines(a, 0, 122), net.lines(b, 0, 122)]))


def test_secret_network_learns_without_long_candidates(spark):
    import random
    r = random.Random(8)
    secret = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f"{' '.join(r.choice(cases.WORDS) for _ in range(12))} token = \"{secret(40)}\" end") for i in range(120)]
    net = secret_scan.fit(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert net is not None  # these documents have no run of 16 or more but the base findings
    assert secret_scan.candidates("token=abc AKIASHORT 0a1b2c3d4e plainword", []) == [(6, 9), (10, 19), (20, 30)]
    test = [(1, f"kept {secret(22)} here, token = {secret(40)}"), (2, "alpha beta gamma")]
    got = {x.doc_id: x for x in secret_scan.findings(spark.createDataFrame(test, "doc_id bigint, text string"), net).collect()}
    assert got[1].spans.startswith("net:5:27,assign:") and len(got[1].scores) == 3 and min(got[1].scores) >= net.threshold - 1e-6
    assert got[2].spans == "" and got[2].scores == []


def test_license_notices(spark):
    mit, gpl = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0-notice"]
    text = f"Ünï first words. {mit} More text; {gpl.upper()} tail"
    changed = " ".join(w for k, w in enumerate(gpl.split()) if k != 9)
    rows = [(1, text), (2, "nothing here of that kind at all"), (3, None), (4, ""), (5, changed), (5, changed),
            (6, licenses.TEMPLATES["CC-BY-NC-4.0"]), (None, mit), (7, "MIT"), (8, (mit + " filler words ") * 3)]
    got = licenses.license_scan(spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, names string"))
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert by[1].names == ["MIT", "GPL-3.0-notice"] and by[1].coverage == [1.0, 1.0]
    assert text[by[1].starts[0]:by[1].ends[0]] == mit[:-1] and text[by[1].starts[1]:by[1].ends[1]] == gpl.upper()[:-1]
    assert by[2].n_matches == by[3].n_matches == by[4].n_matches == by[7].n_matches == 0
    assert by[5].names == ["GPL-3.0-notice"] and 0.9 < by[5].coverage[0] < 1
    assert by[6].names == ["CC-BY-NC-4.0"] and by[None].names == ["MIT"] and by[8].names == ["MIT"] * 3


def test_license_siblings_and_whole_texts(spark):
    T = licenses.TEMPLATES
    want = {"AGPL-3.0-notice": T["GPL-3.0-notice"].replace("GNU General", "GNU Affero General"),
            "LGPL-3.0-notice": T["GPL-3.0-notice"].replace("GNU General", "GNU Lesser General"),
            "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0", "GPL-2.0": T["GPL-3.0"].replace("version 3", "version 2"),
            "BSD-3-Clause-text": "(c) X. " + T["BSD-3-Clause-text"].replace("copyright holder nor", "Foo Inc. nor"),
            "BSD-2-Clause-text": "(c) X. " + T["BSD-2-Clause-text"], "MIT-text": T["MIT-text"],
            **{n: T[n] for n in T if n.endswith(("-text", "-whole"))}}
    none = ["Licensed under CC BY-XX 4.0", T["GPL-3.0-notice"].replace("GNU General", "GNU Other General"),
            T["GPL-3.0"].replace("version 3", "version 9"), T["GPL-3.0-text"][:150].replace("GNU", "GNU AFFERO")]
    rows = [*want.items(), *((f"none {i}", t) for i, t in enumerate(none))]
    got = {r.doc_id: r.names for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {**{n: [n] for n in want}, **{f"none {i}": [] for i in range(len(none))}}


def test_license_scan_finds_every_notice_of_the_table(spark):
    got = {r.doc_id: r.names for r in QUERIES["op9_license_scan"](spark, cases.SF01).collect()}
    for i, t, *_ in cases.documents():
        folded = " ".join(cases.fold(t))
        for name in ("MIT", "GPL-3.0", "Apache-2.0", "CC-BY-NC-4.0"):
            if f" {' '.join(cases.fold(licenses.TEMPLATES[name]))} " in f" {folded} ":
                assert name in got[i], (i, name)
    assert licenses.license_scan(cases.frame(spark, [])).count() == 0


@pytest.fixture(scope="module")
def brute_pipeline():
    """The exact stages by brute force over the documents that have letters."""
    import duckdb
    docs = [r for r in cases.documents() if any(c.isalpha() for c in r[1] or "")]
    classes = {k[0]: k[1] for k in cases.brute_jaccard(docs)}
    docs = [r for r in docs if classes[r[0]] == r[0]]
    items = duckdb.connect().sql(f"select item_id, text from read_parquet('{cases.SF01}/benchmark.parquet')").fetchall()
    dirty = {k[0] for k in cases.brute_decontamination(docs, items) if k[-1]}
    return {r[0]: r[1] for r in docs if r[0] not in dirty}


def test_pipeline(spark, brute_pipeline):
    import corpus_pipeline
    import sentencepiece
    from recunify.llm.queries import piece_model
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, cases.SF01).collect()}
    assert set(got) == set(brute_pipeline)
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    plain = [i for i, t in brute_pipeline.items() if not secret_scan.base_findings(t) and not secret_scan.candidates(t, [])]
    assert len(plain) > 500
    for i in plain:
        assert got[i].n_tokens == len(sp.encode(brute_pipeline[i]))
    for i, t in brute_pipeline.items():  # secrets are gone from the encoded text
        if secret_scan.base_findings(t):
            assert got[i].decoded_sha256 != cases.sha(t)


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secret_scans",
                                                      "sentencepiece"]
    for docs in (cases.frame(spark), cases.frame(spark, [])):
        for _, fn in corpus_pipeline.STAGES[:-1]:
            assert fn(spark, docs, cases.SF01).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, cases.SF01).count() == docs.count()


def test_secret_network_learns_from_every_finding(spark):
    """No example of the documents is left out of the fit and of the threshold, however many there are."""
    import numpy as np
    rows = [(i, f"see token = {i:06d}{'abcdef0123'[i % 10]} and word number{i}") for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = secret_scan.examples(docs)
    assert found.where(f"sort = {secret_scan.BASE}").count() == 10000  # with context and without; the fit kept 2,000 of 5,000
    net = secret_scan.CharNet()
    r = np.random.Generator(np.random.PCG64(1))
    z, label = np.abs(r.normal(size=(60, 48))).astype(np.float32), np.arange(60) % 2
    table = spark.createDataFrame([(int(k), True, bytearray(v.tobytes())) for k, v in zip(label, z)], "label int, back boolean, z binary")
    w = np.concatenate([net.p["out"], net.p["bias"]])
    whole = secret_scan.summed(table.repartition(7), lambda z, label: secret_scan.slopes(z, label, w))
    assert np.allclose(whole, secret_scan.slopes(z.astype(float), label, w))
    secret_scan.calibrate(net, np.zeros((0, 48)), np.zeros(0, int), table, 1.0, recall=0.9)
    scores = secret_scan.logits(z.astype(float), w)
    top = np.sort(scores[label == 1])[int((1 - 0.9) * 30)]
    below = scores[(label == 0) & (scores < top)]
    assert abs(np.log(net.threshold / (1 - net.threshold)) - (top + below.max() if len(below) else 2 * top) / 2) < 1e-6
