"""Document quality from a linear-chain conditional random field over lines.

Every line is a node with two states, good and bad. Its features are shares of character classes, length, word shapes
and repetition, and the same of the lines before and after it. Forward-backward gives each line's marginal of being
good; the marginals, weighted by line length, average into the document's evidence, and a logistic curve of the
evidence's logit (fitted on documents the field was not fitted on) is the score.

Weights are fitted on a bounded sample: FIT_DOCS labelled documents picked by a hash of their ids, at most FIT_LINES
consecutive lines of each. All documents are scored whole.

Null or lineless text is scored as one empty line. Rows of labels with null labels teach nothing; if a document has
several labels, each counts; of rows with equal doc_id one text is learnt from. With no labelled rows, or one class only,
scores are the share of label 1 (0.5 if none). An empty table gives an empty result; repeated rows score alike; columns
other than doc_id and text are not looked at, whatever their names. Long texts are scored whole: a task holds a batch or one
longer text, some 3 bytes for each of its bytes and 500 for each of its lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

FIT_DOCS = 3000
FIT_LINES = 200
SLICE = 1 << 20
STEPS = 80
THRESHOLD = 0.3
#: Bound of the log-weights of moves. Lines inherit one label a document, so unbounded moves would glue all lines together.
MOVE_LIMIT = 1.0

#: Character classes by byte: the first class that lists a byte wins; the rest is "other".
_GROUPS = (b" \t\r\x0b\x0c", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".?", b"!", b",;:", b"'\"()-", b"|", b"#$%&*", b"=+<>/\\@_~^`{}[]")
_N = len(_GROUPS) + 3
_CLASS = np.full(256, len(_GROUPS), np.uint8)
for _i, _g in reversed(list(enumerate(_GROUPS))):
    _CLASS[list(_g)] = _i
_CLASS[128:192] = len(_GROUPS) + 2  # continuation bytes
_CLASS[192:] = len(_GROUPS) + 1  # first bytes of other characters
_OWN = _N + 9


def line_features(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all non-empty lines of all texts (one empty line for a text without any), line lengths, lines by text."""
    lists = pc.split_pattern(text, "\n")
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    size = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    full = size > 0
    full[offsets[:-1][np.add.reduceat(full, offsets[:-1]) == 0]] = True  # texts never split into no lines
    doc = np.repeat(np.arange(len(text)), np.diff(offsets))[full]
    lines, size = flat.filter(pa.array(full)), size[full]
    counts = np.bincount(doc, minlength=len(text))
    n = len(lines)
    raw = np.frombuffer(b"".join(lines.cast(pa.binary()).to_pylist()), np.uint8)
    cls, ends = _CLASS[raw], np.cumsum(size)
    hist = np.zeros((n, _N), np.float32)
    for a in range(0, len(raw), SLICE):  # a slice of bytes at a time bounds what a long text takes
        b = min(a + SLICE, len(raw))
        i, j = np.searchsorted(ends, a, "right"), np.searchsorted(ends, b, "left") + 1
        inside = np.minimum(ends[i:j], b) - np.maximum(ends[i:j] - size[i:j], a)
        line_of = np.repeat(np.arange(j - i, dtype=np.int64), np.maximum(inside, 0))
        hist[i:j] += np.bincount(line_of * _N + cls[a:b], minlength=(j - i) * _N).reshape(-1, _N)
    length = np.maximum(size, 1).astype(np.float32)

    words, per_line = common.space_words(lines, lower=True)
    coded = words.dictionary_encode()
    code, kinds = coded.indices.to_numpy().astype(np.int64), max(1, len(coded.dictionary))
    word_line = np.repeat(np.arange(n), per_line)
    distinct = np.bincount(np.unique(word_line * kinds + code) // kinds, minlength=n)
    in_doc = np.unique(doc[word_line] * kinds + code, return_counts=True)
    doc_words = np.bincount(doc[word_line], minlength=len(text))
    doc_rate = np.bincount(in_doc[0] // kinds, minlength=len(text)) / np.maximum(doc_words, 1)
    same = lines.dictionary_encode().indices.to_numpy().astype(np.int64)
    _, back, times = np.unique(doc * n + same, return_inverse=True, return_counts=True)

    starts = np.cumsum(size) - size
    head = np.where(size > 0, cls[np.minimum(starts, max(0, len(cls) - 1))] if len(cls) else 0, len(_GROUPS))
    tail = np.where(size > 0, cls[np.maximum(np.cumsum(size) - 1, 0)] if len(cls) else 0, len(_GROUPS))
    per_line = per_line.astype(np.float32)
    out = np.empty((n, _OWN), np.float32)
    out[:, :_N] = hist / length[:, None]
    out[:, _N:] = np.stack(
        [np.log1p(size), np.log1p(per_line), length / np.maximum(per_line, 1) / 10, distinct / np.maximum(per_line, 1), doc_rate[doc], np.minimum(times[back] - 1, 5), head == 2, tail == 4, hist[:, 2] / np.maximum(hist[:, 1] + hist[:, 2], 1)], 1
    )
    return out, size, counts


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and of the line after (zeros and a flag at the ends), and a constant."""
    ends = np.cumsum(counts)
    first, last = np.zeros(len(own), bool), np.zeros(len(own), bool)
    first[ends[counts > 0] - counts[counts > 0]] = True
    last[ends[counts > 0] - 1] = True
    before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
    before[first], after[last] = 0, 0
    return np.concatenate([own, before, after, first[:, None], last[:, None], np.ones((len(own), 1))], 1, dtype=np.float32)


def forward_backward(score: np.ndarray, move: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all chains at once: marginal of state 1 by line, expected moves (2, 2), log of each chain's normaliser.

    score: log-odds of state 1 by line; move: log-weights of moves. Chains advance together, the long ones last.
    """
    order = np.argsort(-counts, kind="stable")
    lens, starts = counts[order], (np.cumsum(counts) - counts)[order]
    alive = np.array([np.searchsorted(-lens, -t, "left") for t in range(int(lens[0]) if len(lens) else 0)], np.int64)  # chains longer than t
    node = np.ones((len(score), 2))
    top = np.maximum(score, 0)
    node[:, 0], node[:, 1] = np.exp(-top), np.exp(score - top)
    weight = np.exp(move)
    fwd, scale = np.empty_like(node), np.empty(len(node))
    for t, k in enumerate(alive):
        i = starts[:k] + t
        f = node[i] if not t else (fwd[i - 1] @ weight) * node[i]
        scale[i] = f.sum(1)
        fwd[i] = f / scale[i][:, None]
    back, moves = np.ones_like(node), np.zeros((2, 2))
    for t in range(len(alive) - 1, 0, -1):
        i = starts[: alive[t]] + t
        out = node[i] * back[i] / scale[i][:, None]
        back[i - 1] = out @ weight.T
        moves += weight * (fwd[i - 1].T @ out)
    both = fwd * back
    chain = np.repeat(np.arange(len(counts)), counts)
    return both[:, 1] / both.sum(1), moves, np.bincount(chain, np.log(scale) + top, minlength=len(counts))


@dataclass
class Field:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def evidence(self, own: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the lines' marginals of being good, as a logit, by document."""
        x = with_neighbours((own - self.mean) / self.spread, counts)
        good, _, _ = forward_backward(x @ self.weights, self.moves, counts)
        chain, w = np.repeat(np.arange(len(counts)), counts), np.maximum(size, 1)
        p = np.bincount(chain, good * w, minlength=len(counts)) / np.maximum(np.bincount(chain, w, minlength=len(counts)), 1)
        p = np.clip(p, 1e-4, 1 - 1e-4)
        return np.log(p / (1 - p))

    def score(self, own: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.evidence(own, size, counts) + self.shift, -30, 30)))


def train(own: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = STEPS, penalty: float = 1e-3) -> Field:
    """Maximum likelihood of the lines' states, each line taking its document's label, by Adam on the whole sample.

    Documents weigh alike: a chain's gradient is divided by its lines, so long documents do not outvote short ones.
    """
    mean, spread = own.mean(0), own.std(0) + 1e-3
    x = with_neighbours((own - mean) / spread, counts)
    chain = np.repeat(np.arange(len(counts)), counts)
    y, share = labels[chain].astype(np.float64), 1.0 / counts[chain]
    weights, moves = np.zeros(x.shape[1]), np.zeros((2, 2))
    theta, m, v = np.zeros(len(weights) + 4), 0.0, 0.0
    step_of = 1 / len(counts)
    pair = (np.arange(len(chain))[1:], chain[1:] == chain[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[chain][:-1][pair[1]].astype(int), labels[chain][1:][pair[1]].astype(int)), 1)
    lines = len(chain)
    for t in range(1, steps + 1):
        weights, moves = theta[:-4], theta[-4:].reshape(2, 2)
        good, expected, _ = forward_backward(x @ weights, moves, counts)
        gradient = np.concatenate([x.T @ ((y - good) * share) * step_of, ((seen - expected) / lines).ravel()]) - penalty * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta + 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        theta[-4:] = np.clip(theta[-4:], -MOVE_LIMIT, MOVE_LIMIT)
    return Field(mean, spread, theta[:-4], theta[-4:].reshape(2, 2))


def calibrate(field: Field, evidence: np.ndarray, labels: np.ndarray) -> Field:
    """Logistic curve of the evidence by Newton steps."""
    x, b = np.stack([evidence, np.ones(len(evidence))], 1), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        b = b + np.linalg.solve(hess, x.T @ (labels - p) - 1e-3 * (b - np.array([1.0, 0.0])))
    field.slope, field.shift = float(max(b[0], 1e-3)), float(b[1])
    return field


def held_out(column: str = "doc_id") -> Column:
    return common.crc_mod(column, 5) == 0


def fit(docs: DataFrame, labels: DataFrame, seed: int = 11) -> Field | float:
    """The field, from labelled documents that are not held out; a number where there is nothing to tell apart."""
    picked = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out())
    picked = picked.select("doc_id", F.col("quality").cast("int").alias("label"), F.xxhash64(F.lit(seed), "doc_id").alias("luck"))
    picked = common.table(picked.orderBy("luck", "doc_id", "label").limit(FIT_DOCS), "sample")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    # One row for each line of the sample, whatever the number of rows with its doc_id.
    rows = rows.groupBy("doc_id", "label", "luck").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.chunks(batch, "text"):
                own, _, counts = line_features(common.texts(piece.column("text")))
                matrices, lengths, ends = [], [], np.concatenate([[0], np.cumsum(counts)])
                for a, b, luck in zip(ends[:-1], ends[1:], piece.column("luck").to_pylist(), strict=True):
                    start = a + abs(luck) % max(1, b - a - FIT_LINES + 1)
                    part = own[start : min(b, start + FIT_LINES)]
                    matrices.append(part.astype("<f4").tobytes())
                    lengths.append(len(part))
                yield pa.RecordBatch.from_arrays([piece.column("luck"), piece.column("label"), pa.array(lengths, pa.int32()), pa.array(matrices, pa.binary())], ["luck", "label", "lines", "features"])

    got = sorted((r.luck, r.label, r.lines, bytes(r.features)) for r in rows.select("luck", "label", "text").transform(common.map_batches, measure, "luck long, label int, lines int, features binary").collect())
    label = np.array([r[1] for r in got], np.int64)
    if len(set(label.tolist())) < 2:
        return float(label.mean()) if len(label) else 0.5
    counts = np.array([r[2] for r in got])
    own = np.frombuffer(b"".join(r[3] for r in got), "<f4").reshape(-1, _OWN)
    size = np.expm1(own[:, _N]).round()
    doc = np.repeat(np.arange(len(counts)), counts)
    fold = np.arange(len(counts)) % 3 == 0  # a third calibrates
    if len(set(label[~fold].tolist())) < 2 or len(set(label[fold].tolist())) < 2:
        fold = np.zeros(len(counts), bool)
    field = train(own[~fold[doc]], counts[~fold], label[~fold])
    if fold.any():
        field = calibrate(field, field.evidence(own[fold[doc]], size[fold[doc]], counts[fold]), label[fold])
    return field


def score(docs: DataFrame, field: Field | float) -> DataFrame:
    """doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for piece in common.chunks(batch, "text"):
                if isinstance(model, float):
                    got = np.full(piece.num_rows, model)
                else:
                    got = model.score(*line_features(common.texts(piece.column("text"))))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(got, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.transform(common.map_batches, run, "doc_id long, score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
