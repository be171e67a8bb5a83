"""Toxicity by a convolutional text classifier in numpy.

Words (folded to lower case) and their prefixes are hashed to rows of an
embedding table, whose sum is the vector of a word; filters over one, two and
three neighbouring words, max pooling over the whole text and a logistic output
give a raw score.  Training (Adagrad on batches balanced by label and language)
reads a sample of about ``fit_rows`` labelled documents, half of each label, a
fixed bound; a quarter of it is held back.  All labelled documents that were
not trained on are scored to calibrate: for each language the raw threshold
with the best F1, from counts by language, score bin and label, is moved to
THRESHOLD, so one cut serves all languages.  The language is the one that ``langid`` predicts from the text;
neither labels nor lang, source or doc_id enter a score.  Words of fewer than
MIN_DOCS training documents have the zero vector, so rare and unknown words
say nothing.

Scoring reads every whole text, whatever its length, and shuffles nothing; the
model is of fixed size and broadcast.  Calibrating shuffles an id, a language
and a score bin for every document, never a text.

Odd input: a null or empty text gets the score of a text without words; with
no labels of one kind to learn from, every score is 0; labels of unknown
documents and null labels are not learned from; repeated rows give repeated
rows (in training too); an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.llm import langid
from recunify.llm.licenses import folded, word_codes
from recunify.llm.text import map_slices, mix, pick, span_hashes, texts_of

THRESHOLD = 0.7
FIT_ROWS = 6_000
HASH_BITS, EMBED, FILTERS, WIDTHS = 20, 8, 8, (1, 2, 3)
PAD = 3
#: Bytes of the prefixes of a word that have vectors of their own.
PREFIXES = (5, 7, 9)
#: Words of fewer training documents have no vector: they could only be learned by heart.
MIN_DOCS = 3
#: Share of the words of a training text that are left out, anew each time.
DROP = 0.5
#: Positives of a language, in the part held back, from which its own threshold is taken.
OWN_THRESHOLD = 10
#: Score bins of the calibration for one unit of the raw score, which is cut off at RAW_END.
BINS, RAW_END = 64, 1000


def padded_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of every word (itself, and its prefixes where it is longer; row 0 is
    nothing), PAD empty words after each text; and where texts begin."""
    codes, first, starts, ends, _ = word_codes(column)
    data = folded(column)
    n = np.diff(first)
    begin = np.append(0, np.cumsum(n + PAD))
    ids = np.zeros((begin[-1], 1 + len(PREFIXES)), np.int32)
    at = np.arange(len(codes)) + PAD * np.repeat(np.arange(len(n)), n)
    for k, size in enumerate((None, *PREFIXES)):
        if size is not None:
            long = np.flatnonzero(ends - starts > size)
            codes = mix(span_hashes(data, starts[long], starts[long] + size) + np.uint64(size))
            at_k = at[long]
        else:
            at_k = at
        ids[at_k, k] = np.maximum(codes >> np.uint64(64 - HASH_BITS), 1)
    return ids, begin


class TextNet:
    def __init__(self, seed: int = 17):
        r = np.random.Generator(np.random.PCG64(seed))
        self.table = r.normal(0, 0.02, (1 << HASH_BITS, EMBED)).astype(np.float32)
        self.table[0] = 0
        self.w = {w: r.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.b = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = r.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)
        self.cuts: dict[str, float] = {}
        self.languages = None

    def pooled(self, ids: np.ndarray, begin: np.ndarray):
        """Max over the windows of each text, by width, and where each maximum stands."""
        values, where = [], []
        e = self.table[ids].sum(1)
        inside = np.ones(len(ids), bool)
        for k in range(1, PAD):  # windows that would reach into the next text
            inside[begin[1:] - k] = False
        at = np.flatnonzero(inside)
        starts = np.searchsorted(at, begin[:-1])
        for w in WIDTHS:
            z = sum(e[at + k] @ self.w[w][k * EMBED:(k + 1) * EMBED] for k in range(w)) + self.b[w]
            top = np.maximum.reduceat(z, starts)
            values.append(top)
            where.append((z, starts, at))
        return np.maximum(np.concatenate(values, 1), 0), where

    def raw(self, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        if len(begin) < 2:
            return np.zeros(0)
        return self.pooled(ids, begin)[0].astype(np.float64) @ self.out + float(self.bias[0])

    def fit(self, texts: list[np.ndarray], y: np.ndarray, lang: np.ndarray, steps: int = 800, batch: int = 32,
            rate: float = 0.05, seed: int = 4) -> None:
        r = np.random.Generator(np.random.PCG64(seed))
        sides = [[g for name in sorted(set(lang)) if len(g := np.flatnonzero((y == v) & (lang == name)))] for v in (0, 1)]
        square = {id(p): np.full_like(p, 1e-3) for p in (*self.w.values(), *self.b.values(), self.out, self.bias)}
        row_square = np.full(len(self.table), 1e-3, np.float32)

        def step(p, g):
            square[id(p)] += g * g
            p -= rate * g / np.sqrt(square[id(p)])
        common = np.bincount(np.concatenate([np.unique(t) for t in texts]), minlength=len(self.table)) >= MIN_DOCS
        common[0] = False
        self.table[~common] = 0
        for _ in range(steps):
            pick_ = np.array([r.choice(s[r.integers(len(s))]) for s in sides for _ in range(batch // 2)])
            ids = np.concatenate([texts[i] for i in pick_])
            ids = np.where(r.random((len(ids), 1)) < DROP, 0, ids)
            begin = np.cumsum(np.append(0, [len(texts[i]) for i in pick_]))
            z, where = self.pooled(ids, begin)
            prob = 1 / (1 + np.exp(-np.clip(z @ self.out + self.bias, -30, 30)))
            d = ((prob - y[pick_]) / batch).astype(np.float32)
            dz = np.outer(d, self.out) * (z > 0)
            rows, grads = [], []
            for n, w in enumerate(WIDTHS):
                values, starts, at = where[n]
                ends = np.append(starts[1:], len(values))
                top = np.stack([values[a:e].argmax(0) + a for a, e in zip(starts, ends)])
                dk = dz[:, n * FILTERS:(n + 1) * FILTERS]
                place = at[top][:, :, None] + np.arange(w)  # text, filter, word of the window
                seen = self.table[ids[place]].sum(3).reshape(len(pick_), FILTERS, w * EMBED)
                g_in = (dk[:, :, None] * self.w[w].T[None]).reshape(len(pick_), FILTERS, w, EMBED)
                rows.append(ids[place].ravel())
                grads.append(np.repeat(g_in.reshape(-1, EMBED), ids.shape[1], axis=0))
                step(self.w[w], np.einsum("nf,nfi->if", dk, seen))
                step(self.b[w], dk.sum(0))
            step(self.out, z.T @ d)
            step(self.bias, d.sum(keepdims=True))
            used, inverse = np.unique(np.concatenate(rows), return_inverse=True)
            g = np.zeros((len(used), EMBED), np.float32)
            np.add.at(g, inverse, np.concatenate(grads))
            g[~common[used]] = 0
            row_square[used] += (g * g).mean(1)
            self.table[used] -= rate * g / np.sqrt(row_square[used])[:, None]

    def scores(self, raw: np.ndarray, lang) -> np.ndarray:
        cut = np.array([self.cuts.get(x, self.cuts[""]) for x in lang])
        return 1 / (1 + np.exp(-np.clip(raw - cut + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))

    def slim(self) -> dict:
        """What scoring needs, with only the rows of the table that aren't zero."""
        rows = np.flatnonzero(self.table.any(1))
        return {"rows": rows.astype(np.int32), "values": self.table[rows], "w": self.w, "b": self.b, "out": self.out,
                "bias": self.bias, "cuts": self.cuts, "languages": self.languages}

    @classmethod
    def load(cls, parts: dict) -> TextNet:
        net = cls.__new__(cls)
        net.table = np.zeros((1 << HASH_BITS, EMBED), np.float32)
        net.table[parts["rows"]] = parts["values"]
        for k in ("w", "b", "out", "bias", "cuts", "languages"):
            setattr(net, k, parts[k])
        return net


def cuts_of(counts) -> dict[str, float]:
    """Raw cuts of rows (language, bin, toxic, number): for all texts ("") and for each
    language with enough documents of both labels."""
    tables: dict[str, dict[int, list[int]]] = {"": {}}
    for name, k, toxic, n in counts:
        for t in {"", name}:
            tables.setdefault(t, {}).setdefault(k, [0, 0])[toxic] += n
    sums = {name: np.array([*t.values()]).sum(0) if t else np.zeros(2) for name, t in tables.items()}
    return {name: best_cut(t) for name, t in tables.items()
            if sums[name].min() >= (OWN_THRESHOLD if name else 1)}


def best_cut(bins: dict[int, list[int]]) -> float:
    """The threshold with the best F1, in the middle of the gap between bins it falls into."""
    order = sorted(bins, reverse=True)
    misses, hits = np.cumsum([bins[k] for k in order], axis=0).T
    k = int((2 * hits / (hits + misses + hits[-1])).argmax())
    return (order[k] + order[k + 1] + 1) / 2 / BINS if k + 1 < len(order) else order[k] / BINS


_loaded: dict[int, tuple[dict, TextNet]] = {}


def _net(model: dict) -> TextNet:
    """The network of a broadcast model, loaded once in a worker."""
    if id(model) not in _loaded:
        _loaded.clear()
        _loaded[id(model)] = (model, TextNet.load(model))  # the model stays, and so its id
    return _loaded[id(model)][1]


def _predicted_language(texts: list[str], model) -> list[str]:
    names, proto = model
    if not names:
        return [langid.UNKNOWN] * len(texts)
    vec = langid.text_vectors(texts)
    return [names[i] if v else langid.UNKNOWN for i, v in zip((vec @ proto.T).argmax(1), vec.any(1))]


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> dict | None:
    """The model, learned from ``docs`` (doc_id, text, lang) joined with ``labels`` (doc_id, toxic)."""
    marked = labels.filter("toxic is not null and doc_id is not null").select("doc_id", "toxic")
    sides = [marked.filter(F.col("toxic") == v) for v in (0, 1)]
    size = [x.count() for x in sides]
    rows = langid.bounded_sample(sides[0], fit_rows // 2).unionByName(langid.bounded_sample(sides[1], fit_rows // 2))
    known = docs.filter("doc_id is not null").select("doc_id", "text", "lang").join(F.broadcast(rows), "doc_id")
    languages = langid.fit(known.select("doc_id", "text", "lang"), fit_rows)

    def run(b: pa.RecordBatch):
        flat, begin = padded_ids(b.column(0))
        return pa.RecordBatch.from_arrays(
            [pa.array([flat[a:z].tobytes() for a, z in zip(begin[:-1], begin[1:])], pa.binary()), b.column(1),
             pa.array(_predicted_language(texts_of(b), languages), pa.string()), b.column(2)],
            ["ids", "toxic", "lang", "doc_id"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = map_slices(pick(known, text="text", toxic="toxic", doc_id="doc_id"),
                      f"ids binary, toxic int, lang string, doc_id {kind}", run, step=langid.STEP)
    got = sorted((bytes(r.ids), int(r.toxic), r.lang, r.doc_id) for r in seen.collect())  # about fit_rows documents
    y = np.array([t for _, t, _, _ in got], np.int64)
    if len(set(y.tolist())) < 2:
        return None
    texts = [np.frombuffer(i, np.int32).reshape(-1, 1 + len(PREFIXES)) for i, _, _, _ in got]
    lang = np.array([x for _, _, x, _ in got])
    order = np.random.Generator(np.random.PCG64(8)).permutation(len(got))
    back, train = order[: len(order) // 4], order[len(order) // 4:]
    if min(np.bincount(y[back], minlength=2).min(), np.bincount(y[train], minlength=2).min()) == 0:
        back = train = order
    net = TextNet()
    net.languages = languages
    net.fit([texts[i] for i in train], y[train], lang[train])
    used = [] if back is train else sorted({got[i][3] for i in train})
    net.cuts = cuts_of(score_counts(docs, marked, net.slim(), used)) or {"": 0.0}
    return net.slim()


def score_counts(docs: DataFrame, marked: DataFrame, model: dict, used: list) -> list[tuple[str, int, int, int]]:
    """(language, score bin, toxic, number) of the labelled documents but those with an id in ``used``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b: pa.RecordBatch):
        net = _net(shared.value)
        raw = np.clip(net.raw(*padded_ids(b.column(1))), -RAW_END, RAW_END)
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(_predicted_language(texts_of(b), net.languages), pa.string()),
             pa.array(np.floor(raw * BINS).astype(np.int32))], ["doc_id", "lang", "bin"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    rest = docs.filter("doc_id is not null")
    if used:  # a part of the bounded sample
        trained = docs.sparkSession.createDataFrame([(i,) for i in used], f"doc_id {kind}")
        rest = rest.join(F.broadcast(trained), "doc_id", "left_anti")
    scored = map_slices(pick(rest, doc_id="doc_id", text="text"), f"doc_id {kind}, lang string, bin int", run,
                        step=langid.STEP)
    counts = scored.join(marked, "doc_id").groupBy("lang", "bin", F.col("toxic").cast("int").alias("toxic")).count()
    return [(r[0], r[1], r[2], r[3]) for r in counts.collect()]  # a row for each language, bin and label


def score(docs: DataFrame, model: dict | None, keep: tuple[str, ...] = (), doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from THRESHOLD on) of every text; ``keep`` as in langid.predict."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**HASH_BITS rows of the table

    def run(b: pa.RecordBatch):
        if shared.value is None:
            s = np.zeros(b.num_rows)
        else:
            net = _net(shared.value)
            ids, begin = padded_ids(b.column(1))
            s = net.scores(net.raw(ids, begin), _predicted_language(texts_of(b), net.languages))
        return pa.RecordBatch.from_arrays(
            [b.column(0), *[b.column(2 + i) for i in range(len(keep))], pa.array(s, pa.float64()),
             pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", *keep, "score", "predicted"])
    kind = docs.schema[doc_id].dataType.simpleString()
    return map_slices(pick(docs, doc_id=doc_id, text=text, **{k: k for k in keep}),
                      f"doc_id {kind}, " + "".join(f"{k} boolean, " for k in keep) + "score double, predicted int",
                      run, step=langid.STEP)
