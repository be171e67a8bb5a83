"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1/-1.  The vector of a letter
3-gram binds its letters: their vectors, rotated by 2, 1 and 0 places, are
multiplied.  A document bundles (sums) the vectors of its 3-grams; white
space, digits and signs are one boundary symbol.  A language's prototype is
the sum of the unit vectors of its training documents, and a document takes
the language whose prototype has the largest cosine.

Fitting is one pass of partial sums per task and a sum per (language,
dimension); only the prototypes come to the driver (languages x DIM numbers).
It reads a sample of about ``fit_rows`` labelled documents, chosen by a hash
of doc_id; prediction reads every whole text and shuffles nothing.

Odd input: a null text, or one without letters, is ``und`` with score 0; so
is every text if there was nothing to learn from.  Rows with a null language
are not learned from.  Repeated rows give repeated rows; ties go to the
language that sorts first; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.llm.text import map_slices, pick, ship_package, slices, texts_of

DIM = 512
#: Labelled documents to learn from, about; enough for prototypes of many languages.
FIT_ROWS = 20_000
#: Sharpness of the softmax over cosines that gives the score.
SHARPNESS = 20.0
#: Text bytes, and texts, for one matrix step.
STEP, STEP_TEXTS = 1 << 19, 512
#: A best cosine below that of unrelated vectors (their standard deviation) tells no language.
MIN_COSINE = DIM ** -0.5
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: its lower-case letter, or 0 if it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = ord(c.lower()[0])
    return out


@lru_cache(maxsize=20_000)
def _letter_vector(code: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([7, code])).integers(0, 2, DIM, dtype=np.int8) * 2 - 1


def _grams(texts: list[str]):
    """(document, first, middle, last) of all letter 3-grams with a letter in the middle."""
    codes = np.frombuffer("\0".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts) + 1), [len(t) + 1 for t in texts] + [1])
    letters = _letters()[codes]
    keep = letters != 0
    keep[0] = True
    keep[1:] |= letters[:-1] != 0
    s, d = letters[keep], doc[keep]
    mid = np.flatnonzero(s[1:-1] != 0) + 1 if len(s) > 2 else np.zeros(0, np.int64)
    return d[mid], s[mid - 1], s[mid], s[mid + 1]


def vectors(texts: list[str]) -> np.ndarray:
    """One bundled vector per text (zeros for a text without letters)."""
    if len(texts) > STEP_TEXTS:  # texts x different 3-grams are held at a time
        return np.concatenate([vectors(texts[i:i + STEP_TEXTS]) for i in range(0, len(texts), STEP_TEXTS)])
    out = np.zeros((len(texts), DIM), np.float32)
    d, a, b, c = _grams(texts)
    if not len(d):
        return out
    keys = a.astype(np.uint64) << np.uint64(42) | b.astype(np.uint64) << np.uint64(21) | c.astype(np.uint64)
    grams, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(d * len(grams) + at, minlength=len(texts) * len(grams))
    counts = counts.reshape(len(texts), len(grams)).astype(np.float32)
    part = [(grams >> np.uint64(k)) & np.uint64(0x1FFFFF) for k in (42, 21, 0)]
    symbols, where = np.unique(np.concatenate(part), return_inverse=True)
    table = np.stack([_letter_vector(int(s)) for s in symbols])
    where = where.reshape(3, -1)
    for lo in range(0, len(grams), 8192):  # a bounded part of the 3-grams at a time
        i = slice(lo, lo + 8192)
        bound = np.roll(table, 2, 1)[where[0, i]] * np.roll(table, 1, 1)[where[1, i]] * table[where[2, i]]
        out += counts[:, i] @ bound.astype(np.float32)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n == 0, 1, n)


def text_vectors(texts: list[str]) -> np.ndarray:
    """Unit vectors; a text longer than a step is bundled in parts."""
    if sum(map(len, texts)) <= STEP:
        return _unit(vectors(texts))
    return _unit(np.stack([sum(vectors([t[k:k + STEP]])[0] for k in range(0, max(1, len(t)), STEP)) for t in texts]))


def held_out(doc_id, parts: int, part: int):
    """True where crc32(doc_id as text) mod parts is part; a null id is in no part."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def bounded_sample(df: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """About ``rows`` of the rows, chosen by a hash of the key alone; all if there are fewer.

    Rows of one key go together; where that gives none, or more than twice as
    many (a key with most of the rows), it is any ``rows`` rows, or twice as many.
    """
    n = df.count()
    if n <= rows:
        return df
    chosen = df.filter(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(11)), F.lit(1 << 30)) < int(rows / n * (1 << 30)))
    got = chosen.count()
    return df.limit(rows) if not got else chosen.limit(2 * rows) if got > 2 * rows else chosen


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their unit prototypes; ``labelled`` has doc_id, text, lang."""
    rows = bounded_sample(labelled.filter("lang is not null and text is not null"), fit_rows)

    def sums(batches):
        total: dict[str, np.ndarray] = {}
        for b in slices(batches, "text", STEP):
            vec = text_vectors(texts_of(b))
            lang = np.array(b.column(b.schema.get_field_index("lang")).to_pylist(), object)
            for name in set(lang):
                total[name] = total.get(name, 0) + vec[lang == name].sum(0, dtype=np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                          pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))],
                                         ["lang", "total"])
    got = (pick(rows, text="text", lang="lang").mapInArrow(sums, "lang string, total array<double>")
           .select("lang", F.posexplode("total")).groupBy("lang", "pos").agg(F.sum("col").alias("v")).collect())
    names = sorted({r.lang for r in got})
    proto = np.zeros((len(names), DIM), np.float64)
    for r in got:
        proto[names.index(r.lang), r.pos] = r.v
    return names, _unit(proto).astype(np.float32)


def decide(texts: list[str], names: list[str], proto: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, cosine) of each text."""
    if not names:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    vec = text_vectors(texts)
    blank = ~vec.any(axis=1)
    cos = vec @ proto.T
    e = np.exp(SHARPNESS * (cos - cos.max(1, keepdims=True)))
    pred = [UNKNOWN if z else names[i] for z, i in zip(blank, cos.argmax(1))]
    return pred, np.where(blank, 0.0, 1 / e.sum(1)), np.where(blank, 0.0, cos.max(1))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: tuple[str, ...] = (),
            doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, cosine; ``keep`` names boolean columns of docs to hand through."""
    names, proto = model
    shared = docs.sparkSession.sparkContext.broadcast(proto)  # languages x DIM numbers

    def run(b: pa.RecordBatch):
        pred, score, cosine = decide(texts_of(b), names, shared.value)
        return pa.RecordBatch.from_arrays(
            [b.column(0), *[b.column(2 + i) for i in range(len(keep))], pa.array(pred, pa.string()),
             pa.array(score, pa.float64()), pa.array(cosine, pa.float64())],
            ["doc_id", *keep, "lang_pred", "score", "cosine"])
    kind = docs.schema[doc_id].dataType.simpleString()
    return map_slices(pick(docs, doc_id=doc_id, text=text, **{k: k for k in keep}),
                      f"doc_id {kind}, " + "".join(f"{k} boolean, " for k in keep)
                      + "lang_pred string, score double, cosine double", run, step=STEP)


def keep_known(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text",
               min_cosine: float = MIN_COSINE) -> DataFrame:
    """The rows, with all their columns, whose text has a recognised language: a
    prediction other than ``und`` that is nearer its prototype than unrelated texts are."""
    names, proto = model
    at = docs.columns.index(text)
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(proto)  # languages x DIM numbers

    def run(b: pa.RecordBatch):
        pred, _, cosine = decide([t or "" for t in b.column(at).to_pylist()], names, shared.value)
        return b.filter(pa.array([p != UNKNOWN and c >= min_cosine for p, c in zip(pred, cosine)], pa.bool_()))
    return map_slices(docs, docs.schema, run, text=text, step=STEP)
