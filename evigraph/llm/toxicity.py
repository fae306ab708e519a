"""Toxicity: a weighted finite-state pattern grammar over clauses.

A lexical step maps the words of a clause to symbols: insult, threat, target, negation, reporting verb, other, and marks its end. Four transducers are composed into
one machine that rewrites insults and threats by what stands around them in the clause: negated, reported, aimed at a target before or after (that one writes with a
delay of its reach), or plain. The machine's arcs carry the weight of what they write; a clause's weight is the sum along its path and a document's score the logistic function of the
bias and its clauses' weights. Weights are bound so that one word aimed at nobody, however often it is said, stays under the threshold in any text, while one that is aimed at somebody, or several different ones, may pass it.

The insult lexicon grows from labelled rows and the weights are fitted to them, by default over at most SAMPLE labelled rows (a documented bound of the
training sample, in order of a hash of their ids); labels, language, source and id are no inputs of a score. Whole texts are scored in one pass
without a shuffle. A null or empty text gets the score of a text without matches; ids that are null are held in; repeated rows each give a row; with no labelled
rows the weights are the priors; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, ship

SAMPLE = 6000
THRESHOLD = 0.7
#: A learned insult: in so many groups of texts at least, this share of them toxic.
LEAST_GROUPS, LEAST_SHARE = 5, 0.75
#: Learned stems: starts of so many letters, for inflected languages.
STEM_LETTERS, STEM_SHARE = (4, 5, 6), 0.95

#: Seed words (fixed values).
INSULTS = "bastard clown creep cretin disgusting dumb dumbass fool idiot idiotic idiots imbecile jerk loser losers moron moronic morons pathetic pig scum scumbag stupid trash ugly vermin worthless idiota estúpido imbécil dummkopf trottel abschaum crétin connard".split()
THREATS = "beat burn destroy hang hurt kill murder punish shoot slap stab strangle".split()
TARGETS = "you your yourself u he him she her they them their people du dich ihr sie tu vous il elle ils tú usted él ella ellos".split()
NEGATIONS = "not no never nobody neither nor isn't aren't wasn't don't doesn't didn't won't nicht kein keine nie pas jamais nunca".split()
REPORTS = "said says saying called calls calling wrote writes quoted quotes reported claimed claims according sagte sagt schrieb dit disait écrit dijo dice escribió".split()

SYMBOLS = "ihygqo"  # insult, threat, target, negation, report, other
#: What a match may become: negated, reported, aimed, plain; for insults and for threats.
KINDS = ("aimed", "plain", "reported", "negated", "threat", "idle_threat")
AIMED_KINDS = ("aimed", "threat")
#: Weights before any label is seen; a fit is drawn towards them.
PRIOR = {"bias": -4.5, "aimed": 5.8, "plain": 3.0, "reported": 0.6, "negated": 0.3, "threat": 5.6, "idle_threat": 0.4}
FEATURES = ("bias", *KINDS)
#: The most that one match which is not aimed may reach with the bias (a score of 0.6), and how many of a kind a text counts when weights are fitted.
ALONE, MOST_COUNTED = 0.4, 3
#: What one match aimed at somebody is thought to reach with the bias (a score of 0.77) before labels say otherwise.
AT_SOMEBODY = 1.2
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.!?;\n]")


class Transducer:
    """A deterministic transducer: step(state, symbol) -> (state, symbol or nothing)."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def then(self, other: Transducer) -> Transducer:
        """Composition: the other reads what this one writes."""

        def step(state, symbol):
            a, out = self.step(state[0], symbol)
            b, out = other.step(state[1], out) if out else (state[1], "")
            return (a, b), out

        return Transducer((self.start, other.start), step)

    def run(self, line: str) -> str:
        state, out = self.start, []
        for x in line:
            state, y = self.step(state, x)
            out.append(y)
        return "".join(out)

    def table(self, alphabet: str) -> dict:
        """All reachable states by number, so that running costs a lookup a word: {(state, symbol): (state, symbol)}."""
        number, todo, arcs = {self.start: 0}, [self.start], {}
        while todo:
            s = todo.pop()
            for x in alphabet:
                t, y = self.step(s, x)
                if t not in number:
                    number[t] = len(number)
                    todo.append(t)
                arcs[number[s], x] = (number[t], y)
        return arcs


def _reach(opens: str, rewrite: dict[str, str], gap: int) -> Transducer:
    """After a symbol that opens, matches within the next `gap` words are rewritten."""

    def step(state: int, symbol: str):
        if symbol in opens:
            return gap, symbol
        out = rewrite.get(symbol, symbol) if state > 0 else symbol
        return max(0, state - 1), out

    return Transducer(0, step)


def _ahead(opens: str, rewrite: dict[str, str], gap: int) -> Transducer:
    """Matches within `gap` words before a symbol that opens are rewritten: what is written waits for `gap` more symbols. The state is what waits."""

    def step(state: str, symbol: str):
        waits = "".join(rewrite.get(x, x) for x in state) if symbol in opens else state
        waits += symbol
        return (waits[1:], waits[0]) if len(waits) > gap else (waits, "")

    return Transducer("", step)


GAP = 3
#: Marks the end of a clause; GAP of them empty the machine.
END = "$"
NEGATED = _reach("g", {"i": "N", "h": "N"}, GAP)
REPORTED = Transducer(0, lambda s, x: (1, x) if x == "q" else (s, {"i": "R", "h": "R"}.get(x, x) if s else x))
AIMED = _reach("y", {"i": "T"}, GAP)
AIMED_AHEAD = _ahead("y", {"i": "T", "h": "H"}, GAP)
#: Symbols the last machine need not tell apart are one (other), which keeps its states few.
FORGET = Transducer(0, lambda s, x: (s, x if x in "ihyNRT$" else "o"))
MACHINE = NEGATED.then(REPORTED).then(AIMED).then(FORGET).then(AIMED_AHEAD)
ARCS = MACHINE.table(SYMBOLS + END)
OF_SYMBOL = {"T": "aimed", "i": "plain", "R": "reported", "N": "negated", "H": "threat", "h": "idle_threat"}


class Grammar:
    def __init__(self, insults: list[str], stems: list[str], weights: dict[str, float]):
        self.insults, self.stems, self.weights = insults, stems, weights
        self.symbol: dict[str, str] = {}
        for words, s in ((REPORTS, "q"), (NEGATIONS, "g"), (TARGETS, "y"), (THREATS, "h"), (insults, "i")):
            self.symbol |= dict.fromkeys(words, s)
        keys = sorted({*insults, *THREATS}, key=lambda w: (-len(w), w))
        begins = "|".join(map(re.escape, sorted(stems)))
        self.stem = re.compile(f"(?:{begins})") if stems else None
        self.match = re.compile(r"(?<![^\W_])(?:" + (f"(?:{begins})" + r"[^\W\d_]+|" if stems else "") + "|".join(map(re.escape, keys)) + r")(?![^\W_])")
        #: The weighted machine: (state, symbol) -> (state, kind or None, weight).
        self.arcs = {k: (t, OF_SYMBOL.get(y), weights.get(OF_SYMBOL.get(y), 0.0)) for k, (t, y) in ARCS.items()}

    def line(self, words: list[str]) -> str:
        """The symbols of a clause, its end included."""
        out = []
        for w in words:
            symbol = self.symbol.get(w, "o")
            out.append("i" if symbol == "o" and self.stem and self.stem.match(w) else symbol)
        return "".join(out) + END * GAP

    def clause(self, words: list[str], said: set[tuple[str, str]] | None = None) -> tuple[Counter, float]:
        """What the matches of one clause become, and the clause's weight. With `said`, a word that is aimed at nobody counts once in a text: it holds those that were."""
        state, found, weight = 0, Counter(), 0.0
        for at, symbol in enumerate(self.line(words), -GAP):  # the machine writes a word's symbol GAP words later
            state, kind, w = self.arcs[state, symbol]
            if not kind:
                continue
            if said is not None and kind not in AIMED_KINDS:
                if (kind, words[at]) in said:
                    continue
                said.add((kind, words[at]))
            found[kind] += 1
            weight += w
        return found, weight

    def read(self, text: str) -> tuple[Counter, float]:
        """Rewritten matches of all clauses and their weight; clauses without a match are not read further."""
        low, found, done, weight, said = text.lower(), Counter(), -1, 0.0, set()
        for m in self.match.finditer(low):
            if m.start() < done:
                continue
            start = max(low.rfind(c, 0, m.start()) for c in ".!?;\n") + 1
            end = CLAUSE_END.search(low, m.end())
            done = end.start() if end else len(low)
            own, w = self.clause(WORD.findall(low, start, done), said)
            found += own
            weight += w
        return found, weight

    def matches(self, text: str) -> Counter:
        return self.read(text)[0]

    def score(self, weight: float) -> float:
        """Of a text whose clauses weigh so much."""
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.weights["bias"] + weight))))


def features(found: Counter) -> list[float]:
    return [1.0, *(float(min(found[k], MOST_COUNTED)) for k in KINDS)]


def learn_insults(rows: list[tuple[str, int]]) -> tuple[list[str], list[str]]:
    """(words, stems) that toxic texts have and others lack. Texts that begin alike are one group, so copies count once.
    A stem is a shortest start of at least three such words."""
    seen: dict[str, list[set]] = defaultdict(lambda: [set(), set()])
    under: dict[str, set] = defaultdict(set)
    toxic_words = {w for text, toxic in rows if toxic for w in WORD.findall(text.lower()) if len(w) > 2}
    starts = {w[:n] for w in toxic_words for n in STEM_LETTERS if len(w) > n}
    for text, toxic in rows:
        words = WORD.findall(text.lower())
        group = " ".join(words[:5])
        for w in set(words):
            if w in toxic_words:
                seen[w][1 if toxic else 0].add(group)
            for n in STEM_LETTERS:
                if len(w) > n and w[:n] in starts:
                    seen[w[:n] + "*"][1 if toxic else 0].add(group)
                    if toxic:
                        under[w[:n]].add(w)
    good = {}
    base = min(0.5, max(1e-3, sum(y for _, y in rows) / max(1, len(rows))))
    proof = math.log(len(seen) + 1) + 3  # by chance, fewer than e^-3 of all candidates
    for w, (clean, toxic) in seen.items():
        n, stem = len(toxic), w.endswith("*")
        share = n / max(1, n + len(clean))
        if n < LEAST_GROUPS * (2 if stem else 1) or share < (STEM_SHARE if stem else LEAST_SHARE):
            continue
        odds = n * math.log(share / base) + (len(clean) * math.log((1 - share) / (1 - base)) if clean else 0.0)
        if odds >= proof:
            good[w] = n
    stems: list[str] = []
    for w in sorted((w[:-1] for w in good if w.endswith("*") and len(under[w[:-1]]) >= 3), key=len):
        if not any(w.startswith(x) for x in stems):
            stems.append(w)
    return sorted(w for w in good if not w.endswith("*") and not any(w.startswith(x) for x in stems)), stems


def fit_weights(x, y, steps: int = 60):
    """Logistic regression drawn towards PRIOR, by damped Newton steps. Match weights stay at or above zero and a single match that is not aimed at anybody at or below ALONE; one that is aimed is drawn to
    AT_SOMEBODY above the bias."""
    import numpy as np

    x, y = np.asarray(x, float).reshape(len(y), len(FEATURES)), np.asarray(y, float)
    prior = np.array([PRIOR[f] for f in FEATURES])
    pull = np.array([10.0, *[4.0] * len(KINDS)])
    idle = [FEATURES.index(k) for k in ("plain", "reported", "negated", "idle_threat")]
    aimed = [FEATURES.index(k) for k in AIMED_KINDS]
    w = prior.copy()
    for _ in range(steps):
        prior[aimed] = AT_SOMEBODY - w[0]
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + pull * (w - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-6)
        step = np.clip(np.linalg.solve(hess, grad), -1, 1)
        w = w - step
        w[1:] = np.maximum(w[1:], 0)
        w[idle] = np.minimum(w[idle], ALONE - w[0])
        if np.abs(step).max() < 1e-6:
            break
    return dict(zip(FEATURES, w.tolist(), strict=True))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Grammar:
    """Fit lexicon and weights on at most `sample` labelled rows that are not held out."""
    ids = (
        labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .filter(crc_mod("doc_id", 3) != 1).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    chosen = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(ids), "doc_id")
    rows = chosen.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")).select("text", "toxic").collect()  # one row an id, `sample` at most
    rows = sorted((r[0], int(r[1])) for r in rows)
    words, stems = learn_insults(rows)
    lexicon = sorted({*INSULTS, *words})
    grammar = Grammar(lexicon, stems, PRIOR)
    if not rows:
        return grammar
    weights = fit_weights([features(grammar.matches(t)) for t, _ in rows], [y for _, y in rows])
    return Grammar(lexicon, stems, weights)


def _score(insults: list[str], stems: list[str], weights: dict[str, float]):
    def run(batches):
        import pyarrow as pa

        grammar = Grammar(insults, stems, weights)
        for batch in batches:
            found = [grammar.read(t) if t else (Counter(), 0.0) for t in batch.column(2).to_pylist()]
            n = [sum(f.values()) for f, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([grammar.score(w) for _, w in found], pa.float64()), pa.array(n, pa.int64())],
                ["doc_id", "held_out", "score", "n_matches"],
            )

    return run


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_matches."""
    ship(docs.sparkSession)
    grammar = train(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod("doc_id", 3) == 1).alias("held_out"), "text")
    out = rows.mapInArrow(_score(grammar.insults, grammar.stems, grammar.weights), "doc_id long, held_out boolean, score double, n_matches long")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_matches")
