"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. The score of a labelling sums, for each line, a
linear function of the features of the line and of the lines before and after
it, and, for each two lines that follow each other, the weight of their pair of
labels. Forward-backward gives the probability that a line is good; a
document's score is the mean of these, weighted by the lengths of the lines.

Training takes documents whose label stands for all their lines. Features are
computed over whole batches of texts with array operations, and
forward-backward runs over all documents of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaydesk.llm.common import labelled_sample

FEATURES = 14
BATCH = 256


def _classes() -> np.ndarray:
    """Class of each character of the first planes: 1 space, 2 lower or uncased letter, 3 upper, 4 digit, 0 symbol."""
    out = np.zeros(0x10000, dtype=np.uint8)
    for code in range(0x10000):
        c = chr(code)
        out[code] = 1 if c.isspace() else 3 if c.isupper() else 2 if c.isalpha() else 4 if c.isnumeric() else 0
    return out


class LineReader:
    """Features of all lines of a batch of texts."""

    def __init__(self) -> None:
        self.classes = _classes()

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features by line, characters by line, and lines by text. An empty text is one empty line."""
        joined = "\n".join(texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kinds = self.classes[np.minimum(codes, 0xFFFF)]
        ends = np.flatnonzero(codes == 10)
        starts = np.concatenate([[0], ends[:-1] + 1])
        length = (ends - starts).astype(np.float64)

        def per_line(hit: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
            return (total[ends] - total[starts]).astype(np.float64)

        space, symbol = kinds == 1, kinds == 0
        begins = ~space
        begins[1:] &= space[:-1]
        closes = ~space
        closes[:-1] &= space[1:]
        words = per_line(begins)
        letters, upper, digits = per_line((kinds == 2) | (kinds == 3)), per_line(kinds == 3), per_line(kinds == 4)
        first = starts[length > 0]
        text_lines = np.zeros(len(starts), dtype=bool)
        text_lines[length > 0] = kinds[first] == 2  # the line begins with a small letter
        alike = np.zeros(len(codes), dtype=bool)
        alike[1:] = symbol[1:] & (codes[1:] == codes[:-1])
        fresh, following = self._words(codes, kinds, np.flatnonzero(begins), np.flatnonzero(closes), starts, len(starts))
        some, letters_or_one, words_or_one = np.maximum(length, 1), np.maximum(letters, 1), np.maximum(words, 1)
        features = np.stack(
            [
                np.log1p(length) / 8,
                length == 0,
                np.log1p(words) / 8,
                upper / letters_or_one,
                per_line(symbol) / some,
                digits / some,
                per_line(space) / some,
                per_line(closes & symbol) / words_or_one,
                per_line(begins & closes & symbol) / words_or_one,
                per_line(alike) / some,
                np.minimum(letters / words_or_one, 30) / 10,
                fresh / words_or_one,
                following / words_or_one,
                text_lines,
            ],
            axis=1,
        ).astype(np.float64)
        # lines of a text: one more than it has line breaks
        counts = np.array([t.count("\n") + 1 for t in texts], dtype=np.int64)
        return features, length, counts

    @staticmethod
    def _words(codes, kinds, begins, closes, starts, lines) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words of each line, and words that equal the word before them."""
        if not len(begins):
            return np.zeros(lines), np.zeros(lines)
        powers = np.cumprod(np.full(len(codes), 0x9E3779B97F4A7C15, dtype=np.uint64))
        with np.errstate(over="ignore"):
            # codes times powers of the base; the last factor takes the word's place in the batch out
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes.astype(np.uint64) * powers)])
            raw = (total[closes + 1] - total[begins]) * powers[len(codes) - 1 - closes]
        line = np.searchsorted(starts, begins, side="right") - 1
        order = np.lexsort((raw, line))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (line[order][1:] != line[order][:-1]) | (raw[order][1:] != raw[order][:-1])
        same = np.zeros(len(raw), dtype=bool)
        same[1:] = (raw[1:] == raw[:-1]) & (line[1:] == line[:-1])
        return np.bincount(line[order][new], minlength=lines), np.bincount(line[same], minlength=lines)


@dataclass
class Field:
    """Weights for the bias and the features of the line, the one before and the one after; and of label pairs."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    pairs: np.ndarray

    def potentials(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return design((features - self.mean) / self.scale, counts) @ self.weights


def design(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bias, own features, and those of the neighbours; at a document's ends these are zero."""
    ends = np.cumsum(counts)
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[ends - counts] = 0
    after[ends - 1] = 0
    return np.concatenate([np.ones((len(own), 1)), own, before, after], axis=1)


def marginals(
    good: np.ndarray, pairs: np.ndarray, counts: np.ndarray, by_document: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of good by line, sums of the pair probabilities (2 x 2), and log Z by document.

    ``good`` is each line's potential of the label good; bad has 0. The pairs
    of a document are summed with its weight ``by_document``, or 1. All
    documents take their steps together; the longer ones stay longer.
    """
    order = np.argsort(-counts, kind="stable")
    starts, sizes = (np.cumsum(counts) - counts)[order], counts[order]
    forward, backward = np.zeros((len(good), 2)), np.zeros((len(good), 2))
    forward[starts, 1] = good[starts]
    alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    for t in range(1, sizes[0]):
        at = starts[: alive[t]] + t
        paths = forward[at - 1][:, :, None] + pairs
        forward[at] = np.logaddexp(paths[:, 0], paths[:, 1])
        forward[at, 1] += good[at]
    for t in range(sizes[0] - 2, -1, -1):
        at = starts[: alive[t + 1]] + t
        ahead = backward[at + 1]
        ahead[:, 1] += good[at + 1]
        paths = pairs + ahead[:, None, :]
        backward[at] = np.logaddexp(paths[:, :, 0], paths[:, :, 1])
    ends = np.cumsum(counts) - 1
    z = np.logaddexp(forward[ends, 0], forward[ends, 1])
    by_line = np.repeat(z, counts)
    share = np.exp(forward + backward - by_line[:, None])[:, 1]
    inner = np.ones(len(good), dtype=bool)
    inner[ends] = False
    at = np.flatnonzero(inner)
    ahead = backward[at + 1]
    ahead[:, 1] += good[at + 1]
    both = np.exp(forward[at][:, :, None] + pairs + ahead[:, None, :] - by_line[at][:, None, None])
    if by_document is not None:
        both *= np.repeat(by_document, counts)[at][:, None, None]
    both = both.sum(axis=0)
    return share, both, z


def objective(
    theta: np.ndarray, x: np.ndarray, counts: np.ndarray, labels: np.ndarray, by_document: np.ndarray, ridge: float
) -> tuple[float, np.ndarray]:
    """Weighted log-likelihood of labellings that are all good or all bad, less the ridge, and its gradient.

    ``theta`` holds the weights of the columns of ``x``, then the four of label
    pairs. The log-likelihood of a document counts ``by_document`` times.
    """
    w, pairs = theta[:-4], theta[-4:].reshape(2, 2)
    good = x @ w
    share, both, z = marginals(good, pairs, counts, by_document)
    truth = np.repeat(labels, counts).astype(np.float64)
    steps = by_document * (counts - 1)
    observed = np.diag([steps[labels == 0].sum(), steps[labels == 1].sum()])
    own = np.add.reduceat(good * truth, np.cumsum(counts) - counts) + (counts - 1) * np.diag(pairs)[labels]
    value = by_document @ (own - z) - ridge / 2 * theta @ theta
    by_line = np.repeat(by_document, counts)
    return value, np.concatenate([x.T @ (by_line * (truth - share)), (observed - both).ravel()]) - ridge * theta


def train(
    features: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = 200, rate: float = 0.1, ridge: float = 1e-3
) -> Field:
    """Maximum weighted likelihood with a ridge, by Adam over all documents at once.

    Each label weighs as much as the other, and a document as much as any of
    its label: the likelihood of its labelling is taken per line.
    """
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = design((features - mean) / scale, counts)
    by_document = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) / counts
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        _, slope = objective(theta, x, counts, labels, by_document, ridge)
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Field(mean, scale, theta[:-4], theta[-4:].reshape(2, 2))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = 1500,
    lines: int = 120_000,
) -> Field | None:
    """Train on at most ``rows`` labelled documents of each label, none held out, with all their lines.

    At most ``lines`` rows of features reach the driver: documents are taken
    whole, the shorter ones first, while they fit in, and the rest is left out.
    A key that is labelled 0 and 1 gives a document of each label. None if one
    of the labels has no row.
    """
    sample = labelled_sample(docs, labels, label, rows, key, text).select("_text", "_label")
    sizes = sample.select(F.regexp_count("_text", F.lit("\n")).alias("n")).groupBy("n").count().collect()
    longest, total = 0, 0
    for size, n in sorted((r["n"] + 1, r["count"]) for r in sizes):
        total += size * n
        if total > lines:
            break
        longest = size
    sample = sample.where(F.regexp_count("_text", F.lit("\n")) < longest)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = LineReader()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                features, _, counts = reader.read(part.column(0).to_pylist())
                ends = np.cumsum(counts)
                out = [features[end - n : end].ravel() for end, n in zip(ends, counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out, pa.list_(pa.float64())), part.column(1)], ["features", "label"]
                )

    got = sample.mapInArrow(read, "features array<double>, label int").collect()
    got.sort(key=lambda r: (r["label"], r["features"]))
    truth = np.array([r["label"] for r in got])
    if len(set(truth.tolist())) < 2:
        return None
    by_document = [np.array(r["features"]).reshape(-1, FEATURES) for r in got]
    return train(np.concatenate(by_document), np.array([len(x) for x in by_document]), truth)


def quality(text: Column, field: Field | None) -> Column:
    """Struct of score (0 to 1) and lines, the probability of good of every line."""

    @F.arrow_udf("score double, lines array<double>")
    def scores(texts: pa.Array) -> pa.Array:
        reader, score, lines = LineReader(), [], []
        for at in range(0, len(texts), BATCH):
            part = [t or "" for t in texts.slice(at, BATCH).to_pylist()]
            features, length, counts = reader.read(part)
            if field is None:
                share = np.full(len(features), 0.5)
            else:
                share = marginals(field.potentials(features, counts), field.pairs, counts)[0]
            starts = np.cumsum(counts) - counts
            weight = length + 1e-9  # only empty lines: their plain mean
            score.append(np.add.reduceat(share * weight, starts) / np.add.reduceat(weight, starts))
            lines += np.split(share, starts[1:])
        return pa.StructArray.from_arrays(
            [
                pa.array(np.clip(np.concatenate(score or [np.zeros(0)]), 0, 1)),
                pa.array(lines, pa.list_(pa.float64())),
            ],
            ["score", "lines"],
        )

    return scores(text.cast("string"))


def score_documents(docs: DataFrame, field: Field | None, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with score, line_scores and predicted (1 from ``threshold`` on).

    Lines end at line feeds. A null or empty text is one empty line, whose
    score is what the field gives it. Without a trained field every score is
    0.5. Each row is scored by its whole text alone, so repeated rows score
    alike. Columns of ``docs`` with the new names are replaced; all others stay.
    """
    out = docs.withColumn("line_scores", quality(F.col(text), field))
    out = out.withColumn("score", F.col("line_scores.score")).withColumn("line_scores", F.col("line_scores.lines"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
