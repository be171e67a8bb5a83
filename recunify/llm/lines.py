"""Quality rules: word and repetition statistics, and cross-document line frequency.

Every line is normalised (lower case, runs of digits to ``0``, runs of white
space to one space) and hashed; a line counts once per document, and the
documents with the line are counted per host by a partially aggregated sum.
Lines found in more than ``LIMIT`` documents of a host, however large it is, are removed: the hashes of the frequent lines of a document are joined
back to its text, and a task drops these lines and gives the text that is left
(``cleaned``).  The same task takes the base statistics of the whole text in
one numpy pass and counts the words of the cleaned one; a document that keeps
less than ``KEEP_SHARE`` of its words is depleted and rejected.

What is shuffled is one 64-bit hash per distinct line and document with the
document's key, and each text once, for the join.  The key is two 64-bit hashes
of host and text, on which a document's frequent lines depend alone, so repeated
ids are safe and rows need no number.  A frequent line is one group of the sum
(combined before the shuffle) and one row of the frequent table; both joins are
plain equi-joins that adaptive execution splits when a line or a text is hot.

Odd input: a null or empty text has no words, fails the base rules (fewer
than 10 words) and is not kept; a null host is a host of its own; repeated
rows are separate documents; an empty table gives an empty table.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.llm.store import split_join
from recunify.llm.text import (cover, doc_of, map_slices, mix, pick, roll_windows, span_hashes, texts_of, utf8,
                               window_owner, words)

#: A line is frequent on a host above this many documents.
LIMIT = 50
#: A document that keeps less than this share of its words is depleted.
KEEP_SHARE = 0.5
REPEAT_WINDOW = 5

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_SPACES = re.compile("[\x20\x09-\x0d]+")
_DIGITS = re.compile("[0-9]+")
_WHITE = " \t\n\v\f\r"


def _sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def repeated_words(codes: np.ndarray, first: np.ndarray, k: int = REPEAT_WINDOW) -> np.ndarray:
    """Per document: words inside a window of k words that its document has twice or more."""
    out = np.zeros(len(first) - 1, np.int64)
    ok = np.flatnonzero(window_owner(first, k))
    if not len(ok):
        return out
    doc = doc_of(first)
    keys = mix(roll_windows(codes, k)[ok] ^ mix(doc[ok].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    twice = np.zeros(len(s), bool)
    same = s[1:] == s[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    hits = np.zeros(len(codes), bool)
    hits[ok[order[twice]]] = True
    return np.bincount(doc[cover(hits, k)], minlength=len(out)).astype(np.int64)


def normal_line(line: str) -> str:
    return _DIGITS.sub("0", _SPACES.sub(" ", line).strip(" ").lower())


def _line_code(line: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(line.encode()) - (1 << 63)


def line_codes(text: str) -> list[tuple[str, int | None]]:
    """Every line of a text with the hash of its normal form; None for a blank line."""
    return [(x, _line_code(normal_line(x)) if x.strip(_WHITE) else None) for x in text.split("\n")]


def document_stats(batch: pa.RecordBatch):
    """The base columns of every document, n_words to n_repeat_words."""
    column = batch.column(batch.schema.get_field_index("text"))
    offs, data = utf8(column)
    starts, ends, first = words(offs, data)
    codes = span_hashes(data, starts, ends)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    chars = _sums(points[ends] - points[starts], first)
    dup = []
    for t in texts_of(batch):
        full = [x for x in t.split("\n") if x.strip(_WHITE)]
        dup.append(len(full) - len(set(full)))
    return np.diff(first), chars, _sums(_SYMBOL[data], offs), np.array(dup, np.int64), repeated_words(codes, first)


def without_lines(text: str, gone) -> str:
    """The text without the lines whose hashes are given."""
    return "\n".join(x for x, code in line_codes(text) if code not in gone)


def document_lines(docs: DataFrame) -> DataFrame:
    """host, k1, k2 and the hashes of the distinct lines of every document."""
    def run(b: pa.RecordBatch):
        codes = [list({c for _, c in line_codes(t) if c is not None}) for t in texts_of(b)]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(codes, pa.list_(pa.int64()))],
                                          ["host", "k1", "k2", "lines"])
    return map_slices(docs.select("host", "k1", "k2", "text"),
                      f"host {docs.schema['host'].dataType.simpleString()}, k1 bigint, k2 bigint, lines array<bigint>", run)


def cleaned(docs: DataFrame, stage, limit: int = LIMIT, keep_share: float = KEEP_SHARE,
            doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, the base columns, kept, words_left, depleted and clean_text (the text
    without frequent lines; a null stays), one row per document.

    ``stage(df)`` writes a table once and reads it again (the shared folder of
    the cluster); the lines' hashes are used three times and hold no texts.
    """
    keyed = pick(docs, doc_id=doc_id, host=host, text=text).withColumn("k1", F.xxhash64("host", "text")).withColumn(
        "k2", F.xxhash64(F.lit("second"), "text", "host"))
    base = stage(document_lines(keyed))
    per_line = base.select("host", F.struct("k1", "k2").alias("key"), F.explode("lines").alias("code")).withColumn(
        "line", F.xxhash64("host", "code"))
    frequent = per_line.groupBy("line").agg(F.count("*").alias("n")).filter(F.col("n") > limit).select("line")
    gone = (split_join(per_line.select("key", "code", "line"), frequent, "line", "left_semi")
            .groupBy("key").agg(F.collect_set("code").alias("gone")))
    whole = split_join(keyed.withColumn("key", F.struct("k1", "k2")).drop("k1", "k2", "host"), gone, "key", "left")

    def run(b: pa.RecordBatch):
        n, chars, symbols, dup, repeat = document_stats(b)
        texts = [t if t is None or not g else without_lines(t, set(g))
                 for t, g in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        left = np.array([len(t.encode().split()) if t else 0 for t in texts], np.int64)
        failed, depleted = (n < 10) | (100 * repeat > 20 * n), left < keep_share * n
        return pa.RecordBatch.from_arrays(
            [b.column(0), *[pa.array(x, pa.int64()) for x in (n, chars, symbols, dup, repeat)], pa.array(failed),
             pa.array(~failed & ~depleted), pa.array(left), pa.array(depleted), pa.array(texts, pa.string())], names)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "words_left", "depleted", "clean_text"]
    kinds = [docs.schema[doc_id].dataType.simpleString(), *["bigint"] * 5, "boolean", "boolean", "bigint", "boolean",
             "string"]
    return map_slices(whole.select("doc_id", "text", "gone"), ", ".join(f"{n} {k}" for n, k in zip(names, kinds)), run)


def quality(docs: DataFrame, stage, **options) -> DataFrame:
    """The columns of ``cleaned`` but the text, which they are derived from."""
    return cleaned(docs, stage, **options).drop("clean_text")
