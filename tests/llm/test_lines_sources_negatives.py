"""Line quality, source divergence and hard negatives against plain versions in Python, on tables with nulls, blanks, ties, repeated rows, long texts and clashing names."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from evigraph.llm import divergence, hard_negatives, line_quality

WORDS = "the of and in er tion with from by house reason water light stone".split()


def good_line(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 20))).capitalize() + "."


def bad_line(rng):
    kind = rng.randrange(3)
    if kind == 0:
        return " | ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 15)))
    if kind == 1:
        return " ".join(rng.choice(WORDS) + "%%%" for _ in range(rng.randint(5, 15)))
    return " ".join([rng.choice(WORDS)] * rng.randint(8, 20))


@pytest.fixture(scope="module")
def quality_rows():
    rng = random.Random(5)
    rows = []
    for i in range(300):
        good = rng.random() < 0.6
        lines = [(good_line if good or rng.random() < 0.2 else bad_line)(rng) for _ in range(rng.randint(1, 8))]
        if not good:
            lines[0] = bad_line(rng)
        rows.append((i, "\n".join(lines), int(good)))
    return rows


def test_line_quality(spark, quality_rows):
    extra = [(None, "a\n\nb"), (900, None), (901, ""), (902, "\n\n"), (903, "the house " * 60000), (903, "the house " * 60000), (904, "x"), (905, "½²Ⅷ 😀\n퟿")]
    docs = spark.createDataFrame([(i, t, 1.0, True, 3) for i, t, _ in quality_rows] + [(i, t, 0.0, False, 1) for i, t in extra], "doc_id long, text string, score double, held_out boolean, label int").repartition(3)
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in quality_rows] + [(1, None, 1), (None, 0, 0), (901, None, 0)], "doc_id long, quality int, toxic int")
    got = line_quality.line_quality(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter([i for i, *_ in quality_rows] + [i for i, _ in extra])
    of = {r.doc_id: r for r in got}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [(of[i], y) for i, _, y in quality_rows if of[i].held_out]
    assert sum(r.predicted == y for r, y in held) / len(held) >= 0.93
    assert of[900].score == of[901].score and of[902].n_lines == 3 and of[900].n_lines == 1
    again = {r.doc_id: r.score for r in line_quality.line_quality(docs.repartition(7), labels).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_line_quality_without_labels(spark, quality_rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in quality_rows[:5]], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in line_quality.line_quality(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(5)], none.schema)
    assert {r.score for r in line_quality.line_quality(docs, ones).collect()} == {1.0}
    assert line_quality.line_quality(docs.limit(0), ones).count() == 0


def plain_measures(line, before, count):
    """The measures of one line, by their definitions."""
    n = max(1, len(line))
    kinds = Counter()
    import unicodedata

    for c in line:
        own = next((k for k, marks in line_quality.MARKS.items() if c in marks), None)
        g = unicodedata.category(c)
        own = own or {"Ll": "lower", "Lu": "upper", "Lt": "upper", "Nd": "digit"}.get(g)
        own = own or ("letter" if g[0] in "LM" else "symbol" if g[0] in "SP" else "space" if g[0] == "Z" or c in "\t\n\v\f\r" else "other")
        kinds["other" if ord(c) > 0xFFFF else own] += 1
    words = line.split()
    w = len(words)
    seen = set().union(*[set(x.split()) for x in before]) if before else set()
    rest = [w, sum(map(len, words)) / w, len(set(words)) / w, sum(a == b for a, b in itertools.pairwise(words)) / w, len(set(words) & seen) / len(set(words)), sum(not x[-1].isalnum() for x in words) / w, float(count > 1)] if w else [0.0] * 7
    return [kinds[k] / n for k in line_quality.CLASSES[1:]] + [math.log1p(len(line)), *rest]


def test_field_against_enumeration(quality_rows):
    import numpy as np

    table = line_quality.class_table()
    texts = [t for _, t, _ in quality_rows[:60]] + ["", "a\n\n½ Ⅷ, x!\na", "É | É%\nÉ | É%"]
    values, lengths, n_of = line_quality.measures(texts, table)
    want = []
    for t in texts:
        lines = t.split("\n")
        want += [plain_measures(x, lines[:k], lines.count(x)) for k, x in enumerate(lines)]
    assert np.allclose(values, np.array(want), atol=1e-6) and lengths.tolist() == [len(x) for t in texts for x in t.split("\n")]
    y = np.array([y for *_, y in quality_rows[:60]] + [1, 1, 0])
    field = line_quality.learn(values, lengths, n_of, y)
    features = line_quality.binned(values, field.cuts, n_of)
    p, at = field.marginals(features, n_of), 0
    for n in n_of:  # every labelling of the document's lines by its weight
        own = field.weights[features[at : at + n]].sum(axis=1)
        mass, total = np.zeros(n), 0.0
        for labelling in itertools.product((0, 1), repeat=int(n)):
            e = field.first[labelling[0]] + sum(own[k] for k in range(n) if labelling[k]) + sum(field.trans[a, b] for a, b in itertools.pairwise(labelling))
            mass += math.exp(e) * np.array(labelling)
            total += math.exp(e)
        assert np.allclose(p[at : at + n], mass / total, atol=1e-6)
        at += n


def plain_divergence(rows, least, top):
    """By the definition, with Python's integers."""
    groups, docs, times = defaultdict(set), Counter(), Counter()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        for t in found:
            times[lang, source, t] += 1
        for t in set(found):
            docs[lang, t] += 1
    out = set()
    for lang, sources in groups.items():
        kept = sorted((t for (x, t), n in docs.items() if x == lang and n >= least), key=lambda t: t.encode())
        size = {s: sum(times[lang, s, t] for t in kept) for s in sources}
        p = {(s, t): 1 + 10**9 * (times[lang, s, t] + 2) // (size[s] + 2 * len(kept)) for s in sources for t in kept}
        whole = sum(size.values())
        q = {t: 1 + 10**9 * (sum(times[lang, s, t] for s in sources) + 2) // (whole + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s, t], p[o, t]) for t in kept), o.encode(), o) for o in sources if o != s]
            out |= {(lang, s, "pair", o, -v, k) for k, (v, _, o) in enumerate(sorted(pairs), 1)}
            terms = [(-f(p[s, t], q[t]), t.encode(), t) for t in kept if times[lang, s, t] and p[s, t] > q[t]]
            out |= {(lang, s, "term", t, -v, k) for k, (v, _, t) in enumerate(sorted(terms)[:top], 1)}
    return out


@pytest.fixture(scope="module")
def term_rows():
    rng = random.Random(9)
    vocabulary = [w + x for w in ("Äpfel", "house", "the", "ﬁn", "é", "x") for x in ("", "s", "Ung", "🙂", "q")]
    rows = []
    for _ in range(500):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["a", "a", "b", "c", "Z", "é", None, "", "s9"])
        shift = hash_of(source)
        words = [vocabulary[min(len(vocabulary) - 1, int(rng.expovariate(0.25)) + shift)] for _ in range(rng.choice([0, 3, 12]))]
        rows.append((lang, source, rng.choice([" ", "1", "[", "\n"]).join(words) if words or rng.random() < 0.5 else None))
    rows += [("en", "only blanks", " 12 "), ("fr", "few", "one two"), ("fr", "none", None), ("de", "a", "LONG haus " * 40000)] + [rows[0]] * 3
    return rows


def hash_of(s):
    return zlib.crc32((s or "").encode()) % 4


@pytest.mark.parametrize(("share", "most", "terms", "side"), [(8, 64, 2048, 128), (1, 10**6, 2048, 128), (10**9, 0, 3, 2), (3, 4, 5, 3)])
def test_divergence(spark, term_rows, monkeypatch, share, most, terms, side):
    """All terms light, all heavy in tiny tiles and blocks, and both."""
    monkeypatch.setattr(divergence, "TILE_TERMS", terms)
    monkeypatch.setattr(divergence, "SIDE", side)
    tile, held = divergence._tile, side

    def small(key, table):  # workers import the module anew
        divergence.SIDE = held
        return tile(key, table)

    monkeypatch.setattr(divergence, "_tile", small) if side != 128 else None
    docs = spark.createDataFrame([(i, *r, 7, "t") for i, r in enumerate(term_rows)], "doc_id long, lang string, source string, text string, n int, term string").repartition(5)
    got = divergence.divergence(docs, 10, 10, share, most).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == plain_divergence(term_rows, 10, 10)


def test_divergence_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, source string, text string")
    assert divergence.divergence(docs).count() == 0


def test_counts_of_any_size(spark):
    df = spark.createDataFrame([(10**15, 3 * 10**15, 7)], "n long, total long, v long")
    assert df.select(divergence.share("n", "total", "v")).first()[0] == 1 + 10**9 * (10**15 + 2) // (3 * 10**15 + 14)


def plain_negatives(rows):
    """Every anchor against every row."""
    good = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(256 * y) for y in v]
        if all(abs(y) <= hard_negatives.LARGEST for y in x):
            good.append((i, x, (label + 1) % 10 if i % 7 == 0 else label))
    out = Counter()
    for a, (anchor, va, la) in enumerate(good):
        if anchor % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(va, v, strict=True)), i, label == la) for k, (i, v, label) in enumerate(good) if k != a and len(v) == len(va)]
        for s, positive, _ in sorted(x for x in scored if x[2])[:5]:
            fits = sorted(x for x in scored if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s)
            for rank, (n, i, _) in enumerate(fits[:10], 1):
                out[anchor, positive, rank, i, -s, -n] += 1
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.1, 0.4) for _ in range(6)], rng.randrange(3)) for i in range(0, 900)]
    rows += [(i, [0.5, 0.25, -0.5, 0.125, 0.0, 1.0], i % 2) for i in range(1000, 1300)]  # ties
    rows += [(1400, [0.5] * 6, 1), (1400, [0.5] * 6, 1), (1400, [0.5, 0.25, 0.5, 0.25, 0.5, 0.25], 1), (1401, [0.5] * 6, 1)]  # repeated rows, an id of two vectors
    rows += [(2000, None, 1), (2100, [0.1] * 6, None), (2200, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (2300, [float("nan")] * 6, 1), (2400, [float("inf")] * 6, 1), (None, [0.1] * 6, 1), (2500, [1e30] * 6, 1), (-100, [0.3] * 6, 0)]
    rows += [(3000, [], 1), (3001, [], 1), (3002, [], 2), (4000, [0.2, 0.1], 1), (4001, [0.2, 0.1], 1), (4002, [0.1, 0.1], 2)]  # other lengths; a positive score of 0
    df = spark.createDataFrame([(*r, 5, 0.5) for r in rows], "vec_id long, embedding array<float>, label int, key int, score double").repartition(4)
    as_read = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = Counter(map(tuple, hard_negatives.hard_negatives(df).collect()))
    assert got == plain_negatives(as_read) and len(got) > 200
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0


def test_bounds_hold_and_prune():
    import numpy as np

    rng = np.random.default_rng(3)
    exact = np.floor(256 * rng.normal(0, 0.125, (4000, 64))).astype(np.int32)
    codes, low, high = hard_negatives.approximated(exact)
    block = {"ids": np.arange(4000), "labels": np.arange(4000) % 10, "exact": exact, "codes": codes, "low": low, "high": high}
    asked = {"keys": np.arange(20), "ids": np.arange(20), "labels": np.arange(20) % 10, "exact": exact[:20], "windows": np.full((20, 5), np.iinfo(np.int64).min)}
    least, most = hard_negatives.bounds(asked["exact"], block)
    true = asked["exact"].astype(np.int64) @ exact.T.astype(np.int64)
    assert (least <= true).all() and (true <= most).all()
    _, scored = hard_negatives.nearest(block, asked)
    assert scored < 20 * 400 / 4  # of the rows of its label, under a quarter is scored
    assert hard_negatives.bounds(np.full((1, 64), 1 << 24), block | {"high": np.full((64, 32), 1 << 24)}) is None
