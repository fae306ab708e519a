"""Quality classifier: a linear-chain conditional random field over the lines of a document.

A line's measures (shares of character classes, word lengths, repetition, copies of it in its document) are cut into bins at quantiles of the learned sample. The field scores a line by the bins of
its own measures, of the line before and of the line after, and by a learned transition between good and bad lines. Forward-backward gives each line's chance of being good; a document's quality
is their mean weighted by length, and a logistic curve fitted on the sample turns it into a score.

Only documents have labels. Lines of a good document are good. Lines of a bad one begin as bad; in further rounds those that the field finds good become so, but never all: the worst one stays bad.

Learned from rows with a quality label that are not held out, by default over at most SAMPLE of them (a documented bound of the training sample, in order of a hash of their ids), of which the
tasks return measures, not texts. Labels, language, source and id are no inputs of a score. Whole texts are scored in one pass without a shuffle; a line of any length is one line.

A null text counts as empty; an empty text is one empty line and is scored as such; blank lines weigh nothing unless a document has no others. Ids that are null are held in; repeated rows each
give a row; of several labels of an id the greatest counts; without labelled rows, or with one kind of label alone, every score is the share of label 1 (0.5 without any); an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, kept, ship, text_or_empty
from .language_id import forward_backward, scaled

SAMPLE = 6000
THRESHOLD = 0.7
BINS = 8
#: Rounds in which lines of bad documents are labelled anew, steps of each fit, and the pull of weights to zero.
ROUNDS, STEPS, PULL = 3, 60, 10.0
#: Lines whose characters are looked at together.
GROUP_CHARS = 1 << 20

#: Character classes, in the order of their numbers (fixed values).
CLASSES = ("lower", "upper", "letter", "digit", "stop", "comma", "loud", "joint", "space", "symbol", "other")
#: Marks of a class each (fixed values).
MARKS = {"stop": ".…。", "comma": ",;:", "loud": "!?", "joint": "'\"()-–—’“”«»¿¡"}
MEASURES = (*CLASSES[1:], "length", "words", "word_length", "distinct", "again", "seen", "stopped", "copies")


def class_table():
    """The class number of each character of the basic plane."""
    import numpy as np

    number = {name: i for i, name in enumerate(CLASSES)}
    of = {"Ll": "lower", "Lu": "upper", "Lt": "upper", "Nd": "digit"}
    table = np.full(1 << 16, number["other"], np.uint8)
    for i in range(1 << 16):
        kind = unicodedata.category(chr(i))
        if kind in of:
            table[i] = number[of[kind]]
        elif kind[0] == "L" or kind[0] == "M":
            table[i] = number["letter"]
        elif kind[0] in "SP":
            table[i] = number["symbol"]
        elif kind[0] == "Z" or i in (9, 10, 11, 12, 13):
            table[i] = number["space"]
    for name, marks in MARKS.items():
        for c in marks:
            table[ord(c)] = number[name]
    return table


def class_counts(lines: list[str], table):
    """How many characters of each class every line has, (lines, classes); lines are taken in groups, so that one long line is the most that is held at once."""
    import numpy as np

    out, k = np.zeros((len(lines), len(CLASSES))), len(CLASSES)
    i = 0
    while i < len(lines):
        n, j = 0, i
        while j < len(lines) and (j == i or n + len(lines[j]) <= GROUP_CHARS):
            n += len(lines[j])
            j += 1
        chars = np.frombuffer("".join(lines[i:j]).encode("utf-32-le", "surrogatepass"), "<u4")
        kinds = table[np.minimum(chars, 0xFFFF)]
        owner = np.repeat(np.arange(j - i, dtype=np.int32), [len(x) for x in lines[i:j]])
        out[i:j] = np.bincount(owner * np.int32(k) + kinds, minlength=(j - i) * k).reshape(j - i, k)
        i = j
    return out


def word_measures(lines: list[str]) -> list[tuple[float, ...]]:
    """Of each line of a document: words, mean length, share of distinct words, of words that repeat the one before, of distinct words that earlier lines have, of words that end in a mark, and whether
    the line occurs twice in the document."""
    out, known, times = [], set(), {}
    for line in lines:
        times[line] = times.get(line, 0) + 1
    for line in lines:
        words = line.split()
        n = len(words)
        if not n:
            out.append((0.0,) * 7)
            continue
        own = set(words)
        again = sum(map(str.__eq__, words, words[1:]))
        stopped = sum(not w[-1].isalnum() for w in words)
        out.append((float(n), sum(map(len, words)) / n, len(own) / n, again / n, len(own & known) / len(own), stopped / n, float(times[line] > 1)))
        known |= own
    return out


def measures(texts: list[str], table):
    """(values, lengths, lines a text): the measures of all lines of some texts in turn."""
    import numpy as np

    lines: list[str] = []
    words: list[tuple[float, ...]] = []
    n_of = []
    for text in texts:
        own = text.split("\n")
        lines += own
        words += word_measures(own)
        n_of.append(len(own))
    n = np.array([len(x) for x in lines], float)
    shares = class_counts(lines, table)[:, 1:] / np.maximum(n, 1)[:, None]
    return np.column_stack([shares, np.log1p(n), np.array(words, float).reshape(-1, 7)]).astype(np.float32), n, np.array(n_of, np.int64)


def cut_points(values):
    """The inner bounds of each measure's bins: quantiles of the sample, and zero, which many lines share."""
    import numpy as np

    at = np.arange(1, BINS - 1) / (BINS - 1)
    return [np.unique(np.concatenate([[0.0], np.quantile(values[:, k], at)])).astype(np.float32) for k in range(values.shape[1])]


def binned(values, cuts, n_of):
    """Feature numbers of all lines, (lines, 3 x measures): the line's own bins, those of the line before and after it; at a document's ends a bin of its own."""
    import numpy as np

    width = BINS + 1
    own = np.stack([np.searchsorted(c, values[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    ends = np.cumsum(n_of)
    before, after = np.vstack([own[:1], own[:-1]]), np.vstack([own[1:], own[-1:]])
    before[ends - n_of] = BINS
    after[ends - 1] = BINS
    k = len(cuts)
    base = np.arange(k) * width
    return np.concatenate([own + base, before + base + k * width, after + base + 2 * k * width], axis=1)


class Field:
    """A field over bad (0) and good (1) lines: weights of features for good, transitions, start; curve: slope and offset of the score."""

    def __init__(self, cuts, weights, trans, first, curve=(1.0, 0.0)):
        self.cuts, self.weights, self.trans, self.first, self.curve = cuts, weights, trans, first, curve

    def marginals(self, features, n_of):
        """Each line's chance of being good."""
        import numpy as np

        good = self.weights[features].sum(axis=1)
        e = scaled(np.stack([np.zeros_like(good), good], axis=1))
        return forward_backward(e, np.cumsum(n_of) - n_of, n_of, np.exp(self.trans), np.exp(self.first))[0][:, 1]

    def quality(self, texts: list[str], table):
        """(mean chance of good lines by length, good lines, lines) of each text."""
        import numpy as np

        values, lengths, n_of = measures(texts, table)
        p = self.marginals(binned(values, self.cuts, n_of), n_of)
        return by_length(p, lengths, n_of), np.add.reduceat((p >= 0.5).astype(np.int64), np.cumsum(n_of) - n_of), n_of

    def score(self, quality):
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(self.curve[0] * quality + self.curve[1], -30, 30)))


def by_length(p, lengths, n_of):
    """The mean of p of each document, weighted by length; a document of blank lines weighs them alike."""
    import numpy as np

    starts = np.cumsum(n_of) - n_of
    total = np.add.reduceat(lengths, starts)
    weight = np.where(np.repeat(total, n_of) > 0, lengths, 1.0)
    return np.add.reduceat(p * weight, starts) / np.add.reduceat(weight, starts)


def fit_field(features, labels, n_of, cuts, start: Field | None = None) -> Field:
    """Gradient ascent with per-weight rates on the conditional log-likelihood of the line labels."""
    import numpy as np

    size = 3 * len(cuts) * (BINS + 1)
    field = start or Field(cuts, np.zeros(size), np.zeros((2, 2)), np.zeros(2))
    weights, trans, first = field.weights.copy(), field.trans.copy(), field.first.copy()
    starts = np.cumsum(n_of) - n_of
    inner = np.ones(len(labels), bool)
    inner[starts] = False
    into = np.flatnonzero(inner)
    seen_trans = np.zeros((2, 2))
    np.add.at(seen_trans, (labels[into - 1], labels[into]), 1)
    seen_first = np.bincount(labels[starts], minlength=2).astype(float)
    rates = [np.full_like(x, 1e-2) for x in (weights, trans, first)]
    flat, wide = features.ravel(), features.shape[1]
    for _ in range(STEPS):
        good = weights[features].sum(axis=1)
        e = scaled(np.stack([np.zeros_like(good), good], axis=1))
        factor = np.exp(trans)
        post, alpha, beta = forward_backward(e, starts, n_of, factor, np.exp(first))
        grad = np.bincount(flat, weights=np.repeat(labels - post[:, 1], wide), minlength=size) - PULL * weights
        left, right = alpha[into - 1], (e * beta)[into]
        left = left / ((left @ factor) * right).sum(axis=1, keepdims=True)
        grad_t = seen_trans - factor * (left.T @ right) - PULL * trans
        grad_f = seen_first - post[starts].sum(axis=0) - PULL * first
        for value, g, h in zip((weights, trans, first), (grad, grad_t, grad_f), rates, strict=True):
            h += g * g
            value += 0.3 * g / np.sqrt(h)
    return Field(cuts, weights, trans, first)


def fit_curve(quality, labels, steps: int = 50) -> tuple[float, float]:
    """A logistic curve of the label over the quality, drawn a little to a slope of 12 about one half, by damped Newton steps; good and bad documents weigh the same, so that a half is the middle between them."""
    import numpy as np

    x = np.stack([quality - 0.5, np.ones_like(quality)], axis=1)
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    w, prior, pull = np.array([12.0, 0.0]), np.array([12.0, 0.0]), np.array([0.5, 2.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - labels)) + pull * (w - prior)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1] - w[0] / 2)


def learn(values, lengths, n_of, labels) -> Field:
    """The field of a sample: measures of all its lines in turn, their lengths, lines a document, and a label a document."""
    import numpy as np

    cuts = cut_points(values)
    features = binned(values, cuts, n_of)
    of_doc = np.repeat(labels, n_of)
    doc = np.repeat(np.arange(len(n_of)), n_of)
    now, field = of_doc.copy(), None
    for k in range(ROUNDS):
        field = fit_field(features, now, n_of, cuts, field)
        if k + 1 == ROUNDS:
            break
        p = field.marginals(features, n_of)
        now = np.where(of_doc == 1, 1, (p >= 0.5).astype(np.int64))
        worst = np.lexsort((p, doc))[np.cumsum(n_of) - n_of]  # the line least likely good of each document
        now[worst[labels == 0]] = 0
    field.curve = fit_curve(by_length(field.marginals(features, n_of), lengths, n_of), labels)
    return field


def _measured(batches):
    """The measures of the sample's lines: a row a document."""
    import pyarrow as pa

    table = kept("classes", class_table)
    for batch in batches:
        if not batch.num_rows:
            continue
        values, lengths, n_of = measures(batch.column(0).to_pylist(), table)
        ends = n_of.cumsum()
        parts = [(values[e - n : e].tobytes(), lengths[e - n : e].tobytes()) for e, n in zip(ends.tolist(), n_of.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in parts], pa.binary()), pa.array([n for _, n in parts], pa.binary()), batch.column(1).cast(pa.int32())], ["measures", "lengths", "label"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | float:
    """The field, or a constant score where there are not both kinds of labels."""
    import numpy as np

    ids = (
        labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .filter(crc_mod("doc_id", 4) != 2).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    chosen = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(ids), "doc_id")  # `sample` ids at most
    once = chosen.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").cast("int").alias("label"))
    rows = once.select("text", "label").mapInArrow(_measured, "measures binary, lengths binary, label int").collect()  # `sample` rows at most
    rows.sort(key=lambda r: (r["label"], bytes(r["measures"])))
    y = np.array([r["label"] for r in rows], np.int64)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    values = np.concatenate([np.frombuffer(r["measures"], np.float32).reshape(-1, len(MEASURES)) for r in rows])
    lengths = [np.frombuffer(r["lengths"], np.float64) for r in rows]
    return learn(values, np.concatenate(lengths), np.array([len(x) for x in lengths], np.int64), y)


def _scored(field: Field | float):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        table = kept("classes", class_table)
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(2).to_pylist()
            if isinstance(field, Field):
                quality, good, n = field.quality(texts, table)
                score = field.score(quality)
            else:
                n = np.array([t.count("\n") + 1 for t in texts], np.int64)
                score, good = np.full(len(n), field), np.zeros_like(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array(good, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "held_out", "score", "good_lines", "n_lines"])

    return run


def line_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, good_lines, n_lines."""
    ship(docs.sparkSession)
    field = train(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod("doc_id", 4) == 2).alias("held_out"), text_or_empty().alias("text"))
    out = rows.mapInArrow(_scored(field), "doc_id long, held_out boolean, score double, good_lines long, n_lines long")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "good_lines", "n_lines")
