"""Shared text helpers of the corpus operators: words, hashes, Arrow batches.

A *word* is a maximal run of bytes outside ASCII white space
(``[^\\x20\\x09-\\x0D]+``); texts are UTF-8, so the byte view splits exactly
where the character view does.  All helpers work on one Arrow record batch
at a time with numpy and keep only that batch in memory.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step looks at; long documents take more steps.
STEP_BYTES = 1 << 21
#: Rows of one step at most.
SLICE_ROWS = 1 << 15

_SPACE = np.ones(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: True for the bytes of a word.
WORD_BYTES = _SPACE

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)
_QMULT = np.uint64(0xD6E8FEB86659FD93)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_MULT**i and its inverse for i < n, modulo 2**64."""
    if len(_powers["up"]) < n:
        for name, base in (("up", _MULT), ("down", _INV)):
            steps = np.full(n, np.uint64(base), np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every output bit depends on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), which are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + STEP_BYTES, "right")))
        hi = int(ends[j - 1])
        up, down = _power_tables(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offs, data = column.buffers()
    if n == 0 or offs is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    offs = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return offs - offs[0], data


def words(offs: np.ndarray, data: np.ndarray, lut: np.ndarray = WORD_BYTES):
    """(starts, ends, first): byte spans of all words, and per document the
    index of its first word (one entry more than documents)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    inside = lut[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    end[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offs)


def roll_windows(codes: np.ndarray, depth: int, start: np.ndarray | None = None,
                 at: int = 0) -> np.ndarray:
    """Rolling polynomial sums of ``depth`` codes from each position; the last
    positions wrap to zero codes.  ``start``/``at`` continue sums of ``at`` codes."""
    acc = np.zeros(len(codes), np.uint64) if start is None else start.copy()
    for t in range(at, depth):
        acc *= _QMULT
        if t == 0:
            acc += codes
        elif t < len(codes):
            acc[:-t] += codes[t:]
    return acc


def window_owner(first: np.ndarray, k: int) -> np.ndarray:
    """True where a window of k words starts and ends in one document."""
    n = int(first[-1])
    ok = np.zeros(n, bool)
    left = np.maximum(first[1:] - k + 1, first[:-1])
    delta = np.zeros(n + 1, np.int32)
    np.add.at(delta, first[:-1], 1)
    np.add.at(delta, left, -1)
    ok[:] = np.cumsum(delta[:-1]) > 0
    return ok


def cover(hits: np.ndarray, k: int) -> np.ndarray:
    """True for the words inside a window of k words that starts at a hit."""
    n = len(hits)
    delta = np.zeros(n + k + 1, np.int32)
    at = np.flatnonzero(hits)
    delta[at] += 1
    delta[at + k] -= 1
    return np.cumsum(delta)[:n] > 0


def doc_of(first: np.ndarray) -> np.ndarray:
    """Document index of every word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def slices(batches, column: str, step: int = STEP_BYTES):
    """Record batches cut so that each has about ``step`` bytes of text, or one row."""
    for batch in batches:
        sizes = np.diff(utf8(batch.column(batch.schema.get_field_index(column)))[0])
        ends, lo = np.cumsum(sizes), 0
        while lo < batch.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = min(lo + SLICE_ROWS, max(lo + 1, int(np.searchsorted(ends, base + step, "right"))))
            yield batch.slice(lo, hi - lo)
            lo = hi


def map_slices(df: DataFrame, schema: str, fn, text: str = "text", step: int = STEP_BYTES) -> DataFrame:
    """``df.mapInArrow`` over cut batches; ``fn(batch)`` gives a record batch or None."""
    def run(batches):
        for part in slices(batches, text, step):
            out = fn(part)
            if out is not None:
                yield out
    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts as Python strings; a null counts as an empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once for each application (Spark's own file distribution)."""
    sc = spark.sparkContext
    if _shipped.get("to") == sc.applicationId:
        return
    top = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="code-"), f"{top.name}.zip")  # the driver serves it from here
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(path))
    _shipped["to"] = sc.applicationId


_shipped: dict[str, str] = {}


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the given names, whatever else the input holds.

    ``pick(df, doc_id="id", text="body")`` takes ``id`` and ``body``; extra
    columns, also ones whose names an operator uses itself, stay behind.
    """
    ship_package(df.sparkSession)
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
