"""Language ID: a linear-chain conditional random field over words.

A word's features are its character n-grams of one to four letters with marks for its start and end, so affixes are among them, and the whole word as
a lexicon entry; all are hashed. Transitions are learned from sequences in which clauses of different languages follow each other. Forward-backward gives
each word's language; a document's prediction is the language of the most expected words, its score their share. A chain is a clause of up to CHAIN words; no word is left out, in learning or in labelling.

The shares of the languages sum to 1, so they say nothing about a text in none of them. The stage of the pipeline therefore asks for evidence: the share of a
text's four-letter pieces of distinct words that occur in the learned texts of any language (so mixed texts stay). What learned languages reach is measured on
documents of the sample whose pieces were left out; a text well below that, more so the fewer words it has, goes.

Learned from text and non-null lang of rows that are not held out, by default over at most SAMPLE rows (a documented bound of the training sample, in order of a hash
of their ids). Whole texts are labelled in one pass without a shuffle. A null text or one without a letter is `und` with score 0; with nothing to learn
from, all are `und`; repeated rows each give a row; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, give_back, ship

SAMPLE = 1200
UNKNOWN = "und"
BITS = 16
CHAIN = 64
#: Runs of letters, as str.isalpha has them: \w less \d and _ leaves numerals such as ½, ² or Ⅷ, which are no letters.
NUMERALS = {ord(c): "0" for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()}
NUMERAL_SET = frozenset(map(chr, NUMERALS))
WORD = re.compile(r"[^\W\d_]+")
#: Marks that end a clause (fixed values).
ENDS = (".", "!", "?", ";", ":", "\n")
WORD_OR_END = re.compile(r"[^\W\d_]+|[.!?;:\n]")
CACHE_WORDS = 300_000
#: A document is rejected by the pipeline's stage below this score.
LEAST_SCORE = 0.3
#: Pieces of words are marked in a table of 2^PIECE_BITS.
PIECE, PIECE_BITS = 4, 22
#: The evidence asked for lies SLACK under the LOW_SHARE quantile of left-out documents (clean short texts that hold secrets or mail addresses reach 0.72, noise of letters 0.25), and for n words
#: SPREADS deviations of the mean of n words lower.
FOLDS, LOW_SHARE, SLACK, SPREADS = 4, 0.005, 0.25, 3.0
#: Distinct words a document must have to be counted for the quantile.
CALIBRATE_WORDS = 20


def lowered(text: str) -> str:
    """The text in lower case, with other numerals as digits."""
    text = text.lower()
    return text if text.isascii() or NUMERAL_SET.isdisjoint(text) else text.translate(NUMERALS)


def word_features(words: list[str]):
    """(ids, starts): hashed n-gram features of all words in turn, and where each word's begin."""
    import numpy as np

    joined = "".join(f"\x02{w}\x03" for w in words)
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n_of = np.array([len(w) + 2 for w in words], dtype=np.int64)
    begin = np.cumsum(n_of) - n_of
    owner = np.repeat(np.arange(len(words)), n_of)
    size = np.uint64((1 << BITS) - 1)
    ids, own = [], []
    h = c.copy()
    for n in range(1, 5):
        if n > 1:
            h = h[: len(c) - n + 1] * np.uint64(0x100000001B3) + c[n - 1 :]
        o = owner[: len(h)]
        ok = o == owner[n - 1 :][: len(h)]
        mixed = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        ids.append(((mixed >> np.uint64(40)) & size)[ok].astype(np.int32))
        own.append(o[ok])
    # the whole word: a position-weighted sum
    place = np.arange(len(c), dtype=np.uint64) - np.repeat(begin, n_of).astype(np.uint64)
    whole = np.add.reduceat((c + np.uint64(7)) * (place * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9)), begin)
    ids.append(((whole * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) & size).astype(np.int32))
    own.append(np.arange(len(words)))
    ids, own = np.concatenate(ids), np.concatenate(own)
    by = np.argsort(own, kind="stable")
    counts = np.bincount(own, minlength=len(words))
    return ids[by], np.cumsum(counts) - counts


def pieces(words: list[str]):
    """(numbers, counts): the hashed pieces of all words in turn, and how many each has; a word of one letter is one piece."""
    import numpy as np

    joined = "".join(f"\x02{w}\x03" + "\x03" * (len(w) < PIECE - 2) for w in words)
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    size = np.array([max(len(w) + 2, PIECE) for w in words], dtype=np.int64)
    n = size - PIECE + 1
    at = np.repeat(np.cumsum(size) - size - (np.cumsum(n) - n), n) + np.arange(n.sum())
    h = np.zeros(len(at), np.uint64)
    for k in range(PIECE):
        h = h * np.uint64(0x100000001B3) + c[at + k]
    return (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PIECE_BITS)).astype(np.int64), n


def word_evidence(words: list[str], marks):
    """Of each word the pieces that are marked, and all."""
    import numpy as np

    if not words:
        return np.zeros((0, 2), np.float32)
    found, n = pieces(words)
    return np.stack([np.add.reduceat(marks[found].astype(np.float32), np.cumsum(n) - n), n.astype(np.float32)], axis=1)


def evidence(rows: list[tuple[str, str]]):
    """(marks, asked, spread): the pieces of the learned texts, the evidence asked of a long text, and a word's deviation."""
    import numpy as np

    docs = [w for text in dict.fromkeys(text for text, _ in rows) if (w := list(dict.fromkeys(WORD.findall(lowered(text)))))]  # copies would be in two folds
    made = [pieces(w)[0] for w in docs]
    seen = np.zeros(1 << PIECE_BITS, np.int32)  # folds that hold a piece
    folds = [np.unique(np.concatenate([np.zeros(0, np.int64), *made[f::FOLDS]])) for f in range(FOLDS)]
    for own in folds:
        seen[own] += 1
    share, spread = [], []
    for f, own in enumerate(folds):
        seen[own] -= 1
        marks = seen > 0
        seen[own] += 1
        for words in docs[f::FOLDS]:
            got = word_evidence(words, marks)
            spread.append(got[:, 0] / got[:, 1])
            if len(words) >= CALIBRATE_WORDS:
                share.append(got[:, 0].sum() / got[:, 1].sum())
    asked = float(np.quantile(share, LOW_SHARE)) - SLACK if share else 0.0
    return seen > 0, asked, float(np.concatenate(spread).std()) if spread else 0.0


def emissions(words: list[str], weights):
    """Log-potentials of words, (n, labels); features of a word are averaged so that length does not add certainty without end."""
    import numpy as np

    if not words:
        return np.zeros((0, weights.shape[1]), np.float32)
    ids, starts = word_features(words)
    return np.add.reduceat(weights[ids], starts, axis=0)


def scaled(potential):
    """Potentials as factors, the largest of each word 1."""
    import numpy as np

    return np.exp(np.maximum(potential - potential.max(axis=1, keepdims=True), -40)) if len(potential) else potential


def forward_backward(e, starts, lengths, trans, first):
    """(posterior, alpha, beta) of each place, for chains laid end to end; e, trans and first are factors. Each step serves all chains that are so long."""
    import numpy as np

    alpha, beta = np.empty_like(e), np.empty_like(e)
    by = np.argsort(-lengths, kind="stable")
    s, m = starts[by], lengths[by]
    live = np.searchsorted(-m, -np.arange(1, (m[0] if len(m) else 0) + 1), side="right")  # chains with more than t words
    a = None
    for t, k in enumerate(live.tolist()):
        at = s[:k] + t
        a = (first if t == 0 else a[:k] @ trans) * e[at]
        a /= a.sum(axis=1, keepdims=True)
        alpha[at] = a
    back = np.ascontiguousarray(trans.T)
    b = np.ones((0, e.shape[1]), e.dtype)
    for t in range(len(live) - 1, -1, -1):
        k, longer = live[t], len(b)
        got = np.ones((k, e.shape[1]), e.dtype)
        if longer:
            x = (e[s[:longer] + (t + 1)] * b) @ back
            got[:longer] = x / x.sum(axis=1, keepdims=True)
        beta[s[:k] + t] = got
        b = got
    post = alpha * beta
    post /= post.sum(axis=1, keepdims=True)
    return post, alpha, beta


def chains(text: str) -> list[list[str]]:
    """Clauses of a text as lists of lower-case words, none longer than CHAIN."""
    out = []
    for clause in re.split(r"[.!?;:\n]", lowered(text)):
        words = WORD.findall(clause)
        out += [words[i : i + CHAIN] for i in range(0, len(words), CHAIN)]
    return out


def fit(rows: list[tuple[str, str]], steps: int = 30):
    """(labels, weights, transitions, start) by gradient ascent with per-weight rates on the conditional log-likelihood."""
    import numpy as np

    labels = sorted({lang for _, lang in rows})
    code = {x: i for i, x in enumerate(labels)}
    rng = np.random.default_rng(7)
    parts: list[tuple[list[str], int]] = []
    for text, lang in rows:
        parts += [(words, code[lang]) for words in chains(text) if words]
    words: dict[str, int] = {}
    ids, gold, lengths = [], [], []
    order = rng.permutation(len(parts))
    i = 0
    while i < len(order):  # chains of one or two clauses: the second may be in another language
        many = 1 + int(rng.random() < 0.3)
        n = 0
        for k in order[i : i + many]:
            for w in parts[k][0]:
                ids.append(words.setdefault(w, len(words)))
                gold.append(parts[k][1])
                n += 1
        i += many
        if n:
            lengths.append(n)
    ids, gold, lengths = np.array(ids, np.int32), np.array(gold, np.int16), np.array(lengths)
    starts = np.cumsum(lengths) - lengths
    L = len(labels)
    feats, begin = word_features(list(words))
    owner = np.repeat(np.arange(len(words)), np.diff([*begin, len(feats)]))
    weights, trans, first = np.zeros((1 << BITS, L)), np.zeros((L, L)), np.zeros(L)
    seen = np.zeros((len(words), L))
    np.add.at(seen, (ids, gold), 1)
    inner = np.ones(len(ids), bool)
    inner[starts] = False
    into = np.flatnonzero(inner)
    seen_trans = np.zeros((L, L))
    np.add.at(seen_trans, (gold[into - 1], gold[into]), 1)
    seen_first = np.bincount(gold[starts], minlength=L).astype(float)
    gw, gt, gf = np.full_like(weights, 1e-2), np.full_like(trans, 1e-2), np.full_like(first, 1e-2)
    for _ in range(steps):
        e = scaled(np.add.reduceat(weights.astype(np.float32)[feats], begin, axis=0))[ids]  # 32 bits: the driver holds some arrays of all words
        post, alpha, beta = forward_backward(e, starts, lengths, np.exp(trans).astype(np.float32), np.exp(first).astype(np.float32))
        want = np.zeros((len(words), L))
        for k in range(L):
            want[:, k] = np.bincount(ids, weights=post[:, k], minlength=len(words))
        gap = seen - want
        grad = np.stack([np.bincount(feats, weights=gap[owner, k], minlength=1 << BITS) for k in range(L)], axis=1) - 0.05 * weights
        e *= beta
        del beta
        left, right, factor = alpha[into - 1], e[into], np.exp(trans).astype(np.float32)
        left /= ((left @ factor) * right).sum(axis=1, keepdims=True)  # each pair's shares add up to 1
        grad_t = seen_trans - factor * (left.T @ right) - 0.05 * trans
        grad_f = seen_first - post[starts].sum(axis=0) - 0.05 * first
        del post, alpha, e, left, right
        for value, g, h in ((weights, grad, gw), (trans, grad_t, gt), (first, grad_f, gf)):
            h += g * g
            value += 0.3 * g / np.sqrt(h)
    return labels, weights.astype(np.float32), trans, first


class _Numbers(dict):
    """Words by number, in order of appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Tagger:
    def __init__(self, labels, weights, trans, first, known=None):
        import numpy as np

        self.marks, self.asked, self.spread = known or (np.zeros(1 << PIECE_BITS, bool), 0.0, 0.0)
        self.labels, self.weights = labels, weights
        self.trans, self.first = np.exp(trans).astype(np.float32), np.exp(first).astype(np.float32)
        self._anew()

    def _anew(self) -> None:
        import numpy as np

        self.number = _Numbers({x: i for i, x in enumerate(ENDS)})
        self.table = np.ones((len(ENDS), len(self.labels)), np.float32)
        self.proof = np.zeros((len(ENDS), 2), np.float32)

    def _factors(self, words: list[str]):
        """Numbers of words, whose factors the table then holds; at CACHE_WORDS the table starts anew."""
        import itertools

        import numpy as np

        if len(self.number) > CACHE_WORDS:
            self._anew()
        had = len(self.number)
        ids = np.array(list(map(self.number.__getitem__, words)), dtype=np.int64)
        if len(self.number) > had:
            new = list(itertools.islice(reversed(self.number), len(self.number) - had))[::-1]
            self.table = np.concatenate([self.table, scaled(emissions(new, self.weights))])
            self.proof = np.concatenate([self.proof, word_evidence(new, self.marks)])
        return ids

    def texts(self, texts: list[str | None]):
        """(label or UNKNOWN, score, whether there is evidence of a learned language) of each text."""
        import numpy as np

        words, size = [], np.zeros(len(texts), np.int64)
        for d, t in enumerate(texts):
            if t:
                own = WORD_OR_END.findall(lowered(t))
                words += own
                size[d] = len(own)
        out = [(UNKNOWN, 0.0, False)] * len(texts)
        if not words or not self.labels:
            return out
        ids = self._factors(words)
        doc = np.repeat(np.arange(len(texts)), size)
        real = ids >= len(ENDS)
        clause = np.cumsum(~real) + doc  # a clause ends with a mark or its text
        ids, doc, clause = ids[real], doc[real], clause[real]
        if not len(ids):
            return out
        opens = np.flatnonzero(np.diff(clause, prepend=-1))
        place = np.arange(len(ids)) - np.repeat(opens, np.diff([*opens, len(ids)]))
        starts = np.flatnonzero(place % CHAIN == 0)
        lengths = np.diff([*starts, len(ids)])
        post, _, _ = forward_backward(self.table[ids], starts, lengths, self.trans, self.first)
        n = np.bincount(doc, minlength=len(texts))
        share = np.stack([np.bincount(doc, weights=post[:, k], minlength=len(texts)) for k in range(len(self.labels))], axis=1) / np.maximum(n, 1)[:, None]
        best = share.argmax(axis=1)
        once = np.unique(doc << 32 | ids)  # each word of a text counts once, so that one that is repeated does not decide
        of, word = once >> 32, once & 0xFFFFFFFF
        proof = np.stack([np.bincount(of, weights=self.proof[word, k], minlength=len(texts)) for k in range(2)], axis=1)
        words_of = np.bincount(of, minlength=len(texts))
        proven = proof[:, 0] / np.maximum(proof[:, 1], 1) >= self.asked - SPREADS * self.spread / np.sqrt(np.maximum(words_of, 1))
        for d in np.flatnonzero(n).tolist():
            out[d] = (self.labels[best[d]], float(min(1.0, share[d, best[d]])), bool(proven[d]))
        return out


def train(docs: DataFrame, sample: int = SAMPLE):
    """The fitted field and the evidence of its texts: (labels, weights, transitions, start, evidence)."""
    import numpy as np

    ids = (
        docs.filter("lang is not null and text is not null and doc_id is not null").select("doc_id")
        .filter(crc_mod("doc_id", 5) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    chosen = docs.select("doc_id", "text", "lang").filter("lang is not null and text is not null").join(F.broadcast(ids.distinct()), "doc_id")
    rows = chosen.groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("x")).select("x.text", "x.lang").collect()  # one row an id, `sample` at most
    rows = sorted((r[0], r[1]) for r in rows)
    if not rows or not any(WORD.search(lowered(t)) for t, _ in rows):
        return [], np.zeros((1 << BITS, 0), np.float32), np.zeros((0, 0)), np.zeros(0), None
    proof = evidence(rows)
    model = fit(rows)
    give_back()
    return *model, proof


def _labelled(tagger: Tagger, texts: list) -> list[tuple]:
    """The tagger's answers, in slices of about a million characters, or one text."""
    out, start = [], 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop] or "") < 1_000_000):
            size += len(texts[stop] or "")
            stop += 1
        out += tagger.texts(texts[start:stop])
        start = stop
    return out


def _tag(model):
    def run(batches):
        import pyarrow as pa

        tagger = Tagger(*model.value)
        for batch in batches:
            out = _labelled(tagger, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
        del tagger
        give_back()

    return run


def _keep(model, at: int, least: float):
    def run(batches):
        import pyarrow as pa

        tagger = Tagger(*model.value)
        for batch in batches:
            out = _labelled(tagger, batch.column(at).to_pylist())
            yield batch.filter(pa.array([x[0] != UNKNOWN and x[2] and x[1] >= least for x in out], pa.bool_()))
        del tagger
        give_back()

    return run


def language_id(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, sample))  # 2^16 weights a language
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod("doc_id", 5) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_tag(model), "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, sample: int = SAMPLE, least: float = LEAST_SCORE) -> DataFrame:
    """The documents with evidence of a learned language and a score of `least` or more, all columns as they were: the stage of the pipeline. A text goes to Python once."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, sample))
    return docs.mapInArrow(_keep(model, docs.columns.index("text"), least), docs.schema)
