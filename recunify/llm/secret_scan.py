"""Secret scan: fixed patterns, and a character convolutional network for the rest.

The patterns give the base findings (kinds assign, access, hex), which always
stay.  Every other token-like run of ``[A-Za-z0-9+/_=-]`` that meets no base
finding is a candidate: 6 or more characters with a digit, 16 or more of any
kind, a run that starts with AKIA, and a value assigned to a keyword that the
patterns reject as too short.  Base findings and candidates are scored by a
network over their characters and the characters around them: character
embeddings, two filter widths, max pooling over the whole value, a logistic
output, trained in numpy and, over the documents, by sums in Spark.

Learned from are findings with labels: the base findings (1) and ordinary words,
runs of up to 15 letters (0), of all documents, and findings made from public
key formats (1) and look-alikes such as UUIDs, order numbers, paths and dates
(0) in varied contexts (``secret_kinds``), each with its context and again with
the context blanked, so that the value itself must tell.  Other candidates of
the documents are not learned from: nobody has labelled them.  The threshold is
constrained by recall: it never exceeds the score that keeps RECALL of the
held-back positives and lies midway between it and the next negative below.
Candidates at or above it are reported as kind ``net``.

The filters are learned from the made findings.  The output layer and the
threshold come from these and from all different base findings of all documents,
and the different ones of WORDS words that each text offers: their pooled filters
are staged as a table, Newton steps sum over it, and the threshold's rank is
counted over it, by Spark.  Scanning reads every whole text and shuffles nothing.

Odd input: a null or empty text has no findings; documents without findings, or
none at all, leave the made findings to learn from; repeated rows give repeated
rows; an empty table gives an empty table.  Positions are code points, end
exclusive.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recunify.llm import secret_kinds
from recunify.llm.store import stage
from recunify.llm.text import map_slices, pick, ship_package, texts_of

KINDS = ("assign", "access", "hex", "net")
#: What all documents' examples of one label weigh together, at most, in made findings; each counts.
DOCUMENTS = 4_000
#: Made findings of each label to learn from, and kinds that only their context tells.
MADE, CONTEXT_KINDS = 6_000, ("spoken", "word")
#: Ordinary words that a text offers.
WORDS = 4
RECALL = 0.99
#: Newton steps, their pull to the first weights, the largest logit, bins of a count.
STEPS, RIDGE, FAR, BINS = 3, 5.0, 21.0, 4096

_ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = "A-Za-z0-9+/_=-"
_CANDIDATE = re.compile(f"(?<![{_RUN}])(?:(?=[A-Za-z+/_=-]*[0-9])[{_RUN}]{{6,}}|[{_RUN}]{{16,}}|AKIA[{_RUN}]*)")
_WORD = re.compile(f"(?<![{_RUN}])[A-Za-z]{{2,15}}(?![{_RUN}])")


def base_findings(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind as listed."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=place)


def place(finding):
    return finding[1], KINDS.index(finding[0]), finding[2]


def free(spans, base) -> list[tuple[int, int]]:
    """The spans, sorted and once each, that meet no base finding and no span before them."""
    out, k, taken = [], 0, sorted((s, e) for _, s, e in base)
    for s, e in sorted(set(spans)):
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if (k == len(taken) or taken[k][0] >= e) and not (out and s < out[-1][1]):
            out.append((s, e))
    return out


def candidates(text: str, base) -> list[tuple[int, int]]:
    """Spans of the runs that may be secrets and meet no base finding."""
    spans = [m.span() for m in _CANDIDATE.finditer(text)]
    spans += [m.span(1) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) < 6]
    return free(spans, base)


def ordinary_words(text: str, base, others) -> list[tuple[int, int]]:
    """Spans of at most WORDS words that are no candidates, from places that a hash of the text gives."""
    import xxhash
    if not text:
        return []
    data, out = text.encode(), []
    for k in range(WORDS):
        if m := _WORD.search(text, xxhash.xxh64_intdigest(data, k) % len(text)):
            out.append(m.span())
    return free(out, [*base, *(("net", s, e) for s, e in others)])


def value_of(text: str, finding) -> tuple[int, int]:
    """The span of the secret itself: for an assignment, what is assigned."""
    kind, s, e = finding
    return _ASSIGN.match(text, s).span(1) if kind == "assign" else (s, e)


class CharNet:
    """Embeddings, filters of two widths, max pooling, logistic output."""

    LEFT, VALUE, RIGHT = 24, 48, 8
    ALPHABET, EMBED, FILTERS, WIDTHS = 100, 8, 24, (3, 5)

    def __init__(self, seed: int = 5):
        r = np.random.Generator(np.random.PCG64(seed))
        self.p = {"embed": r.normal(0, 0.3, (self.ALPHABET, self.EMBED)),
                  "out": r.normal(0, 0.3, len(self.WIDTHS) * self.FILTERS), "bias": np.zeros(1)}
        for w in self.WIDTHS:
            self.p[f"w{w}"] = r.normal(0, (w * self.EMBED) ** -0.5, (w * self.EMBED, self.FILTERS))
            self.p[f"b{w}"] = np.zeros(self.FILTERS)
        self.threshold = 0.5

    @classmethod
    def lines(cls, text: str, start: int, end: int, context: bool = True) -> list[str]:
        """The value in pieces of VALUE characters, which overlap by the widest filter less one so
        that no filter misses a place, each with the left and the right context of the whole."""
        left = (text[max(0, start - cls.LEFT):start] if context else "").rjust(cls.LEFT)
        right = (text[end:end + cls.RIGHT] if context else "").ljust(cls.RIGHT)
        step = cls.VALUE - max(cls.WIDTHS) + 1
        return [left + text[i:min(i + cls.VALUE, end)].ljust(cls.VALUE, "\0") + right
                for i in range(start, max(start + 1, end - max(cls.WIDTHS) + 1), step)]

    @classmethod
    def line(cls, text: str, start: int, end: int, context: bool = True) -> str:
        """The first piece, which the fit learns from."""
        return cls.lines(text, start, end, context)[0]

    @classmethod
    def codes(cls, lines: list[str]) -> np.ndarray:
        codes = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(len(lines), -1)
        return np.where(codes == 0, 0, np.where((codes >= 32) & (codes < 127), codes - 30, 1))

    def forward(self, x: np.ndarray):
        e = self.p["embed"][x]
        pooled, where, seen = [], [], []
        for w in self.WIDTHS:
            v = np.lib.stride_tricks.sliding_window_view(e, w, axis=1).swapaxes(2, 3).reshape(len(x), -1, w * self.EMBED)
            h = np.maximum(v @ self.p[f"w{w}"] + self.p[f"b{w}"], 0)
            at = h.argmax(1)
            pooled.append(np.take_along_axis(h, at[:, None], 1)[:, 0])
            where.append(at)
            seen.append(v)
        z = np.concatenate(pooled, 1)
        return 1 / (1 + np.exp(-np.clip(z @ self.p["out"] + self.p["bias"], -30, 30))), z, where, seen

    def gradients(self, x, y):
        prob, z, where, seen = self.forward(x)
        d = (prob - y) / len(x)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"], g["bias"] = z.T @ d, d.sum(keepdims=True)
        dz = np.outer(d, self.p["out"]) * (z > 0)
        rows = np.arange(len(x))[:, None]
        for k, w in enumerate(self.WIDTHS):
            dk = dz[:, k * self.FILTERS:(k + 1) * self.FILTERS]
            v = seen[k][rows, where[k]]
            g[f"w{w}"] = np.einsum("nf,nfi->if", dk, v)
            g[f"b{w}"] = dk.sum(0)
            back = (dk[:, :, None] * self.p[f"w{w}"].T[None]).reshape(len(x), self.FILTERS, w, self.EMBED)
            at = where[k][:, :, None] + np.arange(w)
            np.add.at(g["embed"], x[rows[:, :, None], at], back)
        return g

    def fit(self, x, y, steps: int = 1500, batch: int = 128, rate: float = 0.005, seed: int = 3):
        """Adam on balanced batches."""
        r = np.random.Generator(np.random.PCG64(seed))
        sides = [np.flatnonzero(y == v) for v in (0, 1)]
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for t in range(1, steps + 1):
            i = np.concatenate([r.choice(s, batch // 2) for s in sides])
            for k, g in self.gradients(x[i], y[i]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        parts = [self.forward(x[i:i + 512])[0] for i in range(0, len(x), 512)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def pooled(self, lines: list[str]) -> np.ndarray:
        parts = [self.forward(self.codes(lines[i:i + 512]))[1] for i in range(0, len(lines), 512)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.p["out"])))

    def line_scores(self, values: list[list[str]]) -> np.ndarray:
        """Scores of values given as their pieces: the filters' outputs are pooled over the whole value."""
        if not values:
            return np.zeros(0)
        z = self.pooled([line for pieces in values for line in pieces])
        size = np.array([len(pieces) for pieces in values])
        z = np.maximum.reduceat(z, np.cumsum(size) - size)
        return 1 / (1 + np.exp(-np.clip(z @ self.p["out"] + self.p["bias"], -30, 30)))


#: What the examples of the documents are: base findings, ordinary words.
BASE, ORDINARY = 1, 2


def examples(docs: DataFrame) -> DataFrame:
    """sort, line: all different examples of all documents, with their context and without."""
    def gather(b: pa.RecordBatch):
        seen = set()
        for t in texts_of(b):
            base = base_findings(t)
            for sort, spans in ((BASE, [value_of(t, f) for f in base]),
                                (ORDINARY, ordinary_words(t, base, candidates(t, base)))):
                seen.update((sort, CharNet.line(t, s, e, context)) for s, e in spans for context in (True, False))
        sorts, lines = zip(*seen) if seen else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(sorts, pa.int32()), pa.array(lines, pa.string())], ["sort", "line"])
    return map_slices(pick(docs, text="text"), "sort int, line string", gather).distinct()


def features(found: DataFrame, net: CharNet) -> DataFrame:
    """label, back (held back from learning), z (the pooled filters) of each example."""
    shared = found.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        import xxhash
        for whole in batches:
            for b in (whole.slice(i, 2048) for i in range(0, whole.num_rows, 2048)):
                sorts, lines = (c.to_pylist() for c in b.columns)
                back = [xxhash.xxh64_intdigest(line.encode()) % 4 == 0 for line in lines]
                z = shared.value.pooled(lines).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(s == BASE) for s in sorts], pa.int32()), pa.array(back, pa.bool_()),
                     pa.array([r.tobytes() for r in z], pa.binary())], ["label", "back", "z"])
    return found.mapInArrow(run, "label int, back boolean, z binary")


def summed(rows: DataFrame, fn) -> np.ndarray:
    """The sum of ``fn(z, label)`` over all rows; each task sends one array of numbers."""
    def run(batches):
        total = 0
        for b in batches:
            if b.num_rows:
                total = total + fn(np.frombuffer(b"".join(b.column(1).to_pylist()), np.float32).reshape(b.num_rows, -1).astype(float),
                                   np.asarray(b.column(0)))
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])
    return sum(np.frombuffer(r[0]) for r in rows.select("label", "z").mapInArrow(run, "total binary").toLocalIterator())


def logits(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(z @ w[:-1] + w[-1], -FAR, FAR)


def slopes(z: np.ndarray, label: np.ndarray, w: np.ndarray) -> np.ndarray:
    """For each label the gradient of the loss at ``w`` and the bound of its curvature (a quarter of
    the products, which no step can overshoot), one after the other."""
    z1, p = np.column_stack([z, np.ones(len(z))]), 1 / (1 + np.exp(-logits(z, w)))
    return np.concatenate([np.concatenate([z1[k].T @ (p - label)[k], (z1[k].T @ z1[k] / 4).ravel()])
                           for k in (label == 0, label == 1)])


def learn_output(net: CharNet, z: np.ndarray, label: np.ndarray, found: DataFrame, weight: dict):
    """The logistic output by bounded Newton steps, from the made examples and all of the documents';
    both labels weigh the same."""
    w0 = w = np.concatenate([net.p["out"], net.p["bias"]])
    n, size = [np.sum(label == k) + weight[k][0] * weight[k][1] for k in (0, 1)], len(w0)
    for _ in range(STEPS):
        at = w
        parts = slopes(z, label, at).reshape(2, -1)
        if any(weight[k][1] for k in (0, 1)):
            parts = parts + summed(found, lambda z, label: slopes(z, label, at)).reshape(2, -1) * [[weight[0][0]], [weight[1][0]]]
        total = sum(part * sum(n) / (2 * k) for part, k in zip(parts, n) if k)
        w = w - np.linalg.solve(total[size:].reshape(size, size) + RIDGE * np.eye(size), total[:size] + RIDGE * (w - w0))
    net.p["out"], net.p["bias"] = w[:-1], w[-1:]


def calibrate(net: CharNet, z: np.ndarray, label: np.ndarray, found: DataFrame, weight: float, recall: float = RECALL):
    """At most the score that keeps ``recall`` of the positives, made ones and all of the
    documents': the middle (in logits) between it and the next negative below.  The score
    is found by counts over ever finer bins."""
    w = np.concatenate([net.p["out"], net.p["bias"]])
    own, yes, no = logits(z, w), found.where("label = 1"), found.where("label = 0")
    lo, width, rest = -FAR, 2 * FAR / BINS, None
    while True:
        first, step = lo, width
        ends = lambda u: np.clip(np.floor((u - first) / step), -1, BINS).astype(int)
        count = lambda u: np.bincount(ends(u) + 1, minlength=BINS + 2).astype(float)
        counts = count(own[label == 1]) + weight * summed(yes, lambda z, _: count(logits(z, w)))
        if not counts.sum():
            return
        rest = (1 - recall) * counts.sum() if rest is None else rest
        k = int(np.argmax(np.cumsum(counts) > rest))
        lo = max(lo, first + (k - 1) * step) if k <= BINS else FAR
        if width < 1e-9 or lo >= FAR:
            break
        width /= BINS
    top = lo

    def below(z, _):  # the highest negative below the score, kept as one bin of a running maximum
        u = logits(z, w)
        return u[u < top].max(initial=-np.inf)
    highest = max([below(z[label == 0], None), *largest(no, below)])
    net.threshold = float(1 / (1 + np.exp(-(top if np.isinf(highest) else (top + highest) / 2))))


def largest(rows: DataFrame, fn):
    """``fn(z, label)`` at its largest in each task."""
    def run(batches):
        best = [fn(np.frombuffer(b"".join(b.column(1).to_pylist()), np.float32).reshape(b.num_rows, -1).astype(float), None)
                for b in batches if b.num_rows]
        yield pa.RecordBatch.from_arrays([pa.array([max(best, default=-np.inf)], pa.float64())], ["best"])
    return [r[0] for r in rows.select("label", "z").mapInArrow(run, "best double").collect()]


def fit(docs: DataFrame, made: int = MADE) -> CharNet:
    """The network: its filters from made findings of known key formats and look-alikes, its
    output and threshold also from all different base findings and ordinary words of all
    documents.  Other candidates of the documents are not learned from: nobody knows what they are."""
    rows = set()
    for text, s, e, label, kind in secret_kinds.examples(made):
        # a spoken password is told by its sentence alone
        rows |= {(CharNet.line(text, s, e, context), label) for context in ((True,) if kind in CONTEXT_KINDS else (True, False))}
    rows = sorted(rows)
    x, y = CharNet.codes([line for line, _ in rows]), np.array([label for _, label in rows])
    order = np.random.Generator(np.random.PCG64(9)).permutation(len(x))
    x, y = x[order], y[order]
    back = np.arange(len(x)) % 4 == 0
    net = CharNet()
    net.fit(x[~back], y[~back])
    z = net.pooled([rows[i][0] for i in order])
    found = stage(features(examples(docs), net), "secret_features")
    n = {(r.label, r.back): r["count"] for r in found.groupBy("label", "back").count().collect()}
    # with many, the documents' examples weigh less each, but all of them count
    weight = {k: (min(1.0, DOCUMENTS / max(1, n.get((k, 0), 0) + n.get((k, 1), 0))), n.get((k, False), 0)) for k in (0, 1)}
    learn_output(net, z[~back], y[~back], found.where("not back"), weight)
    calibrate(net, z[back], y[back], found.where("back"), weight[1][0])
    return net


def scan_scored(texts: list[str], net: CharNet | None) -> list[list[tuple[tuple[str, int, int], float | None]]]:
    """All findings of each text, in order, each with its score (None without a network)."""
    found = [base_findings(t) for t in texts]
    if net is None:
        return [[(f, None) for f in x] for x in found]
    rows = [(k, f, *value_of(texts[k], f)) for k, x in enumerate(found) for f in x]
    rows += [(k, ("net", s, e), s, e) for k, t in enumerate(texts) for s, e in candidates(t, found[k])]
    scores = net.line_scores([CharNet.lines(texts[k], s, e) for k, _, s, e in rows]).tolist()
    out = [[] for _ in texts]
    for (k, f, _, _), p in zip(rows, scores):
        if f[0] != "net" or p >= net.threshold:
            out[k].append((f, p))
    return [sorted(x, key=lambda r: place(r[0])) for x in out]


def scan_texts(texts: list[str], net: CharNet | None) -> list[list[tuple[str, int, int]]]:
    """All findings of each text, in order."""
    return [[f for f, _ in x] for x in scan_scored(texts, net)]


def joined(found) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def findings(docs: DataFrame, net: CharNet | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, scores (one for each span) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(b: pa.RecordBatch):
        scored = scan_scored(texts_of(b), shared.value)
        found = [[f for f, _ in x] for x in scored]
        count = [[sum(f[0] == k for f in x) for x in found] for k in KINDS[:3]]
        base = [hashlib.sha256(joined([f for f in x if f[0] != "net"]).encode()).hexdigest() for x in found]
        return pa.RecordBatch.from_arrays(
            [b.column(0), *[pa.array(c, pa.int64()) for c in count], pa.array(base, pa.string()),
             pa.array([joined(x) for x in found], pa.string()),
             pa.array([[p if p is None else round(p, 6) for _, p in x] for x in scored], pa.list_(pa.float64()))],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "scores"])
    return map_slices(pick(docs, doc_id=doc_id, text=text),
                      f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
                      "scores array<double>",
                      run)


def redact(docs: DataFrame, net: CharNet | None, mark: str = "[REDACTED]", text: str = "text") -> DataFrame:
    """The same rows and columns, every finding in the text replaced by ``mark`` (overlaps once)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index(text)
    ship_package(docs.sparkSession)

    def run(b: pa.RecordBatch):
        texts = b.column(at).to_pylist()
        out = []
        for t, f in zip(texts, scan_texts([t or "" for t in texts], shared.value)):
            parts, last = [], 0
            for _, s, e in f:
                if s >= last:
                    parts += [t[last:s], mark]
                last = max(last, e)
            out.append("".join(parts) + t[last:] if f else t)
        columns = list(b.columns)
        columns[at] = pa.array(out, pa.string())
        return pa.RecordBatch.from_arrays(columns, schema=b.schema.set(at, pa.field(text, pa.string())))
    return map_slices(docs, docs.schema, run, text=text)
