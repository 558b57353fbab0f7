"""Operator 3: document quality from a linear-chain CRF over lines.

Every line of a text is a node with the label good or bad. Its potential comes
from features of the line and of its two neighbours, the edge potentials from
the pair of labels. Forward-backward gives each line's marginal probability to
be good; the marginals, weighted by line length and calibrated by a logistic
curve, are the document's score.

Only documents are labelled, so in training each line carries its document's
label, and the edges learn how labels persist. The model is fitted by gradient
ascent on a bounded sample of labelled documents; scoring is one pass over the
table without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from torque.llm.wordhash import Words, text_slices
from torque.llm.worker_memory import release

SAMPLE_DOCUMENTS = 6_000      # labelled documents that training reads at most
SAMPLE_LINES = 2_000          # of a sampled document's lines, evenly spread, at most
ROUNDS, RATE, DECAY = 250, 0.08, 1e-3
FOLDS = 5                     # crc32(id as text) mod 5 = 0 is held out
THRESHOLD = 0.3
FEATURES = ["length", "word_length", "symbols", "capitals", "digits", "marks", "lone_symbols",
            "symbol_ends", "repeats", "distinct", "stop", "short", "again", "empty"]

_SYMBOL, _MARK, _DIGIT, _UPPER, _STOP = (np.zeros(256, bool) for _ in range(5))
_SYMBOL[np.frombuffer(b"#*$%&|<>=_~^@{}[]\\", np.uint8)] = True
_MARK[np.frombuffer(b"!?;:", np.uint8)] = True
_DIGIT[48:58], _UPPER[65:91] = True, True
_STOP[np.frombuffer(b".!?\"')", np.uint8)] = True


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x features), line lengths, and line bounds of each text.

    Lines are split at \\n; an empty text is one empty line.
    """
    split = Words(column)
    data, n = split.data, len(split.data)
    sizes = np.frombuffer(column.cast(pa.large_string()).buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    text_at = sizes - sizes[0]
    breaks = np.flatnonzero(data == 10)
    # a line starts at each text's start (also of empty texts) and behind each break
    starts = np.concatenate((text_at[:-1], breaks + 1))
    owner = np.concatenate((np.arange(len(column)),
                            np.searchsorted(text_at, breaks, "right") - 1))
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(len(column) + 1))
    ends = np.empty_like(starts)
    ends[:-1] = np.where(owner[1:] == owner[:-1], starts[1:] - 1, text_at[owner[:-1] + 1])
    if len(ends):
        ends[-1] = n

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[ends] - total[starts]

    length = ends - starts
    chars = np.maximum(length, 1)
    line_of = np.searchsorted(starts, split.start, "right") - 1   # empty lines share starts
    hashes = split.hashes()
    sizes_w = split.end - split.start
    per_line = lambda w=None: np.bincount(line_of, w, minlength=len(starts))
    n_words = np.maximum(per_line(), 1)
    last, first = data[split.end - 1], data[split.start]
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    by_line = np.lexsort((hashes, line_of))
    h, ln = hashes[by_line], line_of[by_line]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (ln[1:] != ln[:-1])
    distinct = np.bincount(ln[new], minlength=len(starts))
    # a line that the same text had before
    line_hash = per_line((hashes >> np.uint64(12)).astype(np.float64)) + length
    by_text = np.lexsort((starts, line_hash, owner))
    again = np.zeros(len(starts), bool)
    again[by_text[1:]] = ((owner[by_text[1:]] == owner[by_text[:-1]])
                          & (line_hash[by_text[1:]] == line_hash[by_text[:-1]]))
    empty = per_line() == 0
    final = np.where(length > 0, data[np.maximum(ends - 1, 0)] if n else 0, 0)
    features = np.stack([
        np.log1p(length) / 6, np.minimum(per_line(sizes_w) / n_words, 30) / 10,
        np.minimum(5 * count(_SYMBOL[data]) / chars, 2), 2 * count(_UPPER[data]) / chars,
        2 * count(_DIGIT[data]) / chars, np.minimum(5 * count(_MARK[data]) / chars, 2),
        per_line((sizes_w == 1) & _SYMBOL[first]) / n_words,
        per_line(_SYMBOL[last] | _MARK[last]) / n_words, per_line(same) / n_words,
        np.where(empty, 1, distinct / n_words), _STOP[final], n_words < 4, again & ~empty, empty,
    ], axis=1).astype(np.float32)
    return features, chars, bounds


def with_neighbours(features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A line's features beside those of the lines before and after it, and a constant."""
    zero = np.zeros((1, features.shape[1]), features.dtype)
    before = np.concatenate((zero, features[:-1])) if len(features) else features
    after = np.concatenate((features[1:], zero)) if len(features) else features
    before, after = before.copy(), after.copy()
    full = bounds[1:] > bounds[:-1]
    before[bounds[:-1][full]] = 0
    after[bounds[1:][full] - 1] = 0
    return np.concatenate((features, before, after, np.ones((len(features), 1), np.float32)), 1)


def _by_position(bounds: np.ndarray):
    """Documents by falling length, and how many have a line at each position."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max(initial=0))
    alive = np.searchsorted(-sizes[order], -np.arange(1, longest + 1), "right")
    return bounds[:-1][order], sizes[order], alive


def forward_backward(node: np.ndarray, edge: np.ndarray, bounds: np.ndarray):
    """Marginals per line (n x 2), expected label pairs (2 x 2) and log-likelihood
    normaliser, for node potentials (n x 2), over all documents at once."""
    start, sizes, alive = _by_position(bounds)
    alpha, beta = np.zeros_like(node), np.zeros_like(node)
    for t, k in enumerate(alive):
        at = start[:k] + t
        if t == 0:
            alpha[at] = node[at]
        else:
            alpha[at] = node[at] + np.logaddexp.reduce(alpha[at - 1][:, :, None] + edge, axis=1)
    for t in range(len(alive) - 2, -1, -1):
        at = start[:alive[t + 1]] + t
        beta[at] = np.logaddexp.reduce(
            edge + (node[at + 1] + beta[at + 1])[:, None, :], axis=2)
    total = np.logaddexp.reduce(alpha[bounds[1:] - 1], axis=1)
    per_line = np.repeat(total, np.diff(bounds))
    marginal = np.exp(alpha + beta - per_line[:, None])
    inner = np.ones(len(node), bool)
    inner[bounds[:-1]] = False
    at = np.flatnonzero(inner)
    pair = np.exp(alpha[at - 1][:, :, None] + edge + (node[at] + beta[at])[:, None, :]
                  - per_line[at][:, None, None]).sum(axis=0)
    return marginal, pair, total


@dataclass
class Model:
    weight: np.ndarray            # node weights of "good" (bad has 0)
    edge: np.ndarray              # [label before, label], 0 bad and 1 good
    slope: float = 1.0            # calibration of the weighted marginal
    offset: float = 0.0

    def marginals(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        good = with_neighbours(features, bounds).astype(np.float64) @ self.weight
        node = np.stack((np.zeros_like(good), good), axis=1)
        return forward_backward(node, self.edge, bounds)[0][:, 1]

    def raw(self, features, chars, bounds) -> np.ndarray:
        """Log odds of the length-weighted mean marginal."""
        share = self.marginals(features, bounds)
        total = np.concatenate(([0.0], np.cumsum(share * chars)))
        size = np.concatenate(([0.0], np.cumsum(chars, dtype=np.float64)))
        mean = (total[bounds[1:]] - total[bounds[:-1]]) / (size[bounds[1:]] - size[bounds[:-1]])
        mean = np.clip(mean, 1e-4, 1 - 1e-4)
        return np.log(mean / (1 - mean))

    def scores(self, features, chars, bounds) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.raw(features, chars, bounds) + self.offset)))


def fit(features: np.ndarray, chars: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam on the whole sample.

    Documents weigh alike: a line's gradient is divided by its document's lines.
    """
    x = with_neighbours(features, bounds).astype(np.float64)
    sizes = np.diff(bounds)
    y = np.repeat(labels, sizes).astype(np.int64)
    inner = np.ones(len(x), bool)
    inner[bounds[:-1]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1], y[at]), 1.0)
    theta = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        good = x @ theta[:-4]
        marginal, pair, _ = forward_backward(
            np.stack((np.zeros_like(good), good), axis=1), theta[-4:].reshape(2, 2), bounds)
        grad = np.concatenate((x.T @ (y - marginal[:, 1]), (seen - pair).ravel()))
        grad = grad / len(x) - DECAY * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        theta = theta + RATE * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    model = Model(theta[:-4], theta[-4:].reshape(2, 2))
    raw, slope, offset = model.raw(features, chars, bounds), 1.0, 0.0
    for _ in range(50):                       # Newton steps of a ridge logistic curve
        p = 1 / (1 + np.exp(-(slope * raw + offset)))
        w = p * (1 - p) + 1e-9
        g = np.array([((labels - p) * raw).sum() - slope, (labels - p).sum() - offset])
        hess = np.array([[(w * raw * raw).sum() + 1, (w * raw).sum()],
                         [(w * raw).sum(), w.sum() + 1]])
        move = np.linalg.solve(hess, g)
        slope, offset = slope + move[0], offset + move[1]
    model.slope, model.offset = max(float(slope), 1e-3), float(offset)
    return model


def fold(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """Fit on at most ``sample`` labelled documents outside the held-out fold.

    The sample is the documents of smallest id hash, so reruns agree. Only line
    features reach the driver. An id with several labels counts as bad if
    any says so; labels without document are not used. With no labelled document
    at all the model scores everything 0.5.
    """
    chosen = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
              .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
              .filter(fold(F.col("doc_id")) != 0)
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))

    def features(batches):
        release()
        for batch in batches:
            for at, part in text_slices(batch.column(1)):
                x, chars, bounds = line_features(part)
                rows = []
                for i in range(len(part)):
                    lines = np.arange(bounds[i], bounds[i + 1])
                    if len(lines) > SAMPLE_LINES:
                        lines = lines[np.linspace(0, len(lines) - 1, SAMPLE_LINES).astype(int)]
                    rows.append((x[lines].tobytes(), chars[lines].astype(np.int64).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), batch.column(2).slice(at, len(part)),
                     pa.array([r[0] for r in rows], pa.binary()),
                     pa.array([r[1] for r in rows], pa.binary())],
                    names=["doc_id", "quality", "features", "chars"])

    picked = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
              .join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    rows = sorted(picked.mapInArrow(
        features, f"doc_id {kind}, quality int, features binary, chars binary").collect(),
        key=lambda r: (r["doc_id"], bytes(r["features"])))
    width = len(FEATURES)
    if not rows:
        return Model(np.zeros(3 * width + 1), np.zeros((2, 2)))
    x = [np.frombuffer(r["features"], np.float32).reshape(-1, width) for r in rows]
    bounds = np.concatenate(([0], np.cumsum([len(a) for a in x])))
    return fit(np.concatenate(x), np.concatenate([np.frombuffer(r["chars"], np.int64)
                                                  for r in rows]),
               bounds, np.array([1 if r["quality"] else 0 for r in rows]))


def score(docs: DataFrame, model: Model, text_col: str = "text",
          name: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the document score in column ``name``
    (which replaces a column of that name).

    Null texts count as empty: one empty line, scored like any other. An empty
    table gives an empty result. One task holds one text with its lines.
    """
    kept = [c for c in docs.columns if c != name]
    # a text travels once, within its row, and rows go back by slices: batches of whole
    # texts stay allocated in the executor's pools
    sent = [*kept, *([] if text_col in kept else [text_col])]
    place = sent.index(text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in sent]).alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        release()
        for batch in batches:
            texts = pc.fill_null(batch.column(0).field(place), "")
            for at, part in text_slices(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)),
                     pa.array(shared.value.scores(*line_features(part)))],
                    names=["row", "score"])

    schema = T.StructType().add("row", rows.schema["row"].dataType).add("score", "double")
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("score").alias(name))
