"""Operators that SQL cannot express, against brute force or held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from evigraph.llm import decontaminate, language_id, lm_score, toxicity

SYLLABLES = {"en": "the of and ing er th on st", "de": "der und ung sch ein lich ver zu", "fr": "le eux que oi ment ai la en"}


def invented(rng, lang, n):
    parts = SYLLABLES[lang].split()
    words = ["".join(rng.choices(parts, k=rng.choice([1, 1, 2, 3]))) for _ in range(n)]
    return " ".join(w + ("." if rng.random() < 0.1 else "") for w in words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(i, invented(rng, lang := rng.choice(list(SYLLABLES)), rng.choice([3, 20, 60])), lang, "s") for i in range(240)]
    out += [(None, "the of and", "en", None), (900, None, "en", "s"), (901, "", "de", "s"), (902, "12 -- 34", "fr", "s"), (903, "the of", None, "s"), (903, "the of", None, "s"), (904, "ünd " * 20000, "de", "s"), (905, "½ ² Ⅷ 7", "en", "s")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 5, 0.5) for r in rows], "doc_id long, text string, lang string, source string, row long, score double").repartition(3)


def held(i, n):
    return 0 if i is None else zlib.crc32(str(i).encode()) % n


def test_language(docs, rows):
    got = defaultdict(list)
    for r in language_id.language_id(docs).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    right = [got[i][0].lang_pred == lang for i, t, lang, _ in rows if i is not None and i < 240 and held(i, 5) == 0]
    assert sum(right) / len(right) > 0.95
    for i, t, *_ in rows:
        assert got[i][0].held_out == (held(i, 5) == 0)
        assert (got[i][0].lang_pred == "und") == (t is None or not any(c.isalpha() for c in t))
        assert 0 <= got[i][0].score <= 1
    kept = language_id.keep_known(docs)
    assert kept.columns == docs.columns and {900, 901, 902, 905}.isdisjoint(r.doc_id for r in kept.select("doc_id").collect())


def test_field_against_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    e, trans, first = np.exp(rng.normal(size=(4, 3))), np.exp(rng.normal(size=(3, 3))), np.exp(rng.normal(size=3))
    want = np.zeros((4, 3))
    for path in itertools.product(range(3), repeat=4):
        p = first[path[0]] * math.prod(e[t, y] for t, y in enumerate(path)) * math.prod(trans[a, b] for a, b in itertools.pairwise(path))
        for t, y in enumerate(path):
            want[t, y] += p
    post, _, _ = language_id.forward_backward(e, np.array([0]), np.array([4]), trans, first)
    assert np.allclose(post, want / want.sum(axis=1, keepdims=True))
    alone, _, _ = language_id.forward_backward(np.concatenate([e[:1], e, e[:2]]), np.array([0, 1, 5]), np.array([1, 4, 2]), trans, first)
    assert np.allclose(alone[1:5], post)


def test_toxicity(spark, docs, rows):
    rng = random.Random(5)
    made, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = invented(rng, "en", 40).split()
        if toxic:
            words[10:10] = ["you", "idiot"]
            words[30:30] = ["such", "zorgling"]
        made.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame([(i, t, 1) for i, t in made] + [(None, None, 1), (900, "", 1), (1, made[1][1], 1)], "doc_id long, text string, held_out int")
    lab = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(d, lab).collect()
    assert len(got) == 403
    for r in got:
        assert r.held_out == (held(r.doc_id, 3) == 1)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id < 400:
            assert r.predicted == int(r.doc_id % 4 == 0)
    assert toxicity.toxicity(d.limit(0), lab).count() == 0 == language_id.language_id(d.withColumn("lang", d["text"]).limit(0)).count()
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, none).count() == len(rows)


HARMLESS = ("The pig ate. The pig slept.", "These pig farms", "These tomatoes and that trash bag", "This clown act was fun.", "They burn wood in that stove.", "The clown said it. A clown! Clown, clown.")
AIMED = ("You are a pig.", "you stupid idiot", "I will kill you", "They are such losers", "what an idiot he is")


def second_score(text, grammar):
    """A plain scorer: for every listed word look around it in its clause, by the words of the grammar's rules and no machine."""
    import re

    weight, once = 0.0, set()
    for clause in re.split(r"[.!?;\n]", text.lower()):
        words = toxicity.WORD.findall(clause)
        sign = [grammar.symbol.get(w, "o") for w in words]
        for i, s in enumerate(sign):
            if s not in "ih":
                continue
            opened = [j for j in range(max(0, i - 3), i)]
            if any(sign[j] == "g" for j in opened):
                kind = "negated"
            elif "q" in sign[:i]:
                kind = "reported"
            elif s == "i" and any(sign[j] == "y" for j in opened):
                kind = "aimed"
            elif "y" in sign[i + 1 : i + 4]:
                kind = "aimed" if s == "i" else "threat"
            else:
                kind = "plain" if s == "i" else "idle_threat"
            if kind in ("aimed", "threat") or (kind, words[i]) not in once:
                once.add((kind, words[i]))
                weight += grammar.weights[kind]
    return grammar.score(weight)


def test_harmless_and_aimed_texts_and_a_second_scorer():
    rng = random.Random(4)
    texts = [f"you {w} there" for w in ("idiot", "moron", "clown")] * 12 + ["idiot and moron and scum"] * 10
    clean = [invented(rng, "en", 30) for _ in range(200)] + ["the clown act"] * 4
    fitted = toxicity.fit_weights([toxicity.features(toxicity.Grammar(toxicity.INSULTS, [], toxicity.PRIOR).matches(t)) for t in texts + clean], [1] * len(texts) + [0] * len(clean))
    for weights in (toxicity.PRIOR | {"aimed": toxicity.AT_SOMEBODY - toxicity.PRIOR["bias"], "threat": toxicity.AT_SOMEBODY - toxicity.PRIOR["bias"]}, fitted):
        g = toxicity.Grammar(toxicity.INSULTS, [], weights)
        assert all(g.score(g.read(t)[1]) < toxicity.THRESHOLD for t in HARMLESS)
        assert all(g.score(g.read(t)[1]) >= toxicity.THRESHOLD for t in AIMED)
        some = [*toxicity.INSULTS[:4], *toxicity.THREATS[:3], *toxicity.TARGETS[:4], *toxicity.NEGATIONS[:3], *toxicity.REPORTS[:3], "house", "tree", "stone", ".", "!"]
        for _ in range(400):
            t = " ".join(rng.choices(some, k=rng.randint(1, 25)))
            assert math.isclose(g.score(g.read(t)[1]), second_score(t, g), abs_tol=1e-9), t


def test_labels_override_what_is_thought_of_aimed_words():
    """Where aimed words stand in clean texts alone, their weight falls under the threshold: there is no floor."""
    aimed = [toxicity.features(Counter(aimed=1))] * 300
    w = toxicity.fit_weights(aimed + [toxicity.features(Counter())] * 300, [0] * 600)
    assert w["bias"] + w["aimed"] < 0.8


def test_grammar():
    g = toxicity.Grammar(toxicity.INSULTS, ["lowe"], toxicity.PRIOR)
    assert g.matches("You idiot.") == Counter(aimed=1)
    assert g.matches("Idiot! a pathetic one") == Counter(plain=2)
    assert g.matches("she is not an idiot") == Counter(negated=1)
    assert g.matches("he said that clown. Clown") == Counter(reported=1, plain=1)
    assert g.matches("I will kill you") == Counter(threat=1)
    assert g.matches("kill the lights; lowelich idioter") == Counter(idle_threat=1, plain=1)
    def score(text):
        return g.score(g.read(text)[1])

    assert score("You idiot") > 0.7 > score("not an idiot") > score("fine")
    for alone in ("The pig ate.", "A clown came to the circus.", "The trash was collected on Monday.", "he said that clown"):
        assert score(alone) < 0.7
    assert score("A stupid clown came. What a loser.") > 0.7


def test_weights_hold_one_untargeted_match_under_the_threshold():
    one = [[1.0, 0, 1, 0, 0, 0, 0]] * 300
    none = [[1.0, 0, 0, 0, 0, 0, 0]] * 300
    w = toxicity.fit_weights(one + none, [1] * 300 + [0] * 300)
    g = toxicity.Grammar(toxicity.INSULTS, [], w)
    assert g.score(g.read("what an idiot")[1]) < 0.7 < g.score(g.read("what an idiot, what a moron")[1])


def machine_by_hand(line):
    """The rules of the grammar, without any machine: what each match of a clause becomes."""
    out = Counter()
    for i, x in enumerate(line):
        if x not in "ih":
            continue
        before = line[max(0, i - 3) : i]
        if "g" in before:
            out["negated"] += 1
        elif "q" in line[:i]:
            out["reported"] += 1
        elif x == "i":
            out["aimed" if "y" in before or "y" in line[i + 1 : i + 4] else "plain"] += 1
        else:
            out["threat" if "y" in line[i + 1 : i + 4] else "idle_threat"] += 1
    return out


def test_composed_machine_against_its_parts_and_by_hand():
    rng = random.Random(8)
    parts = [toxicity.NEGATED, toxicity.REPORTED, toxicity.AIMED, toxicity.FORGET, toxicity.AIMED_AHEAD]
    words = {"i": "idiot", "h": "kill", "y": "you", "g": "not", "q": "said", "o": "zzz"}
    g = toxicity.Grammar(toxicity.INSULTS, [], toxicity.PRIOR)
    for _ in range(3000):
        line = "".join(rng.choices("ihygqo", weights=[3, 2, 1, 1, 1, 4], k=rng.randrange(12)))
        apart = line + toxicity.END * toxicity.GAP
        for part in parts:
            apart = part.run(apart)
        assert toxicity.MACHINE.run(line + toxicity.END * toxicity.GAP) == apart
        found, weight = g.clause([words[x] for x in line])
        assert found == machine_by_hand(line) == Counter(toxicity.OF_SYMBOL[x] for x in apart if x in toxicity.OF_SYMBOL)
        assert math.isclose(weight, sum(toxicity.PRIOR[k] * n for k, n in found.items()), abs_tol=1e-9)


def edits_anywhere(p, t):
    row = list(range(len(p) + 1))
    best = row[-1]
    for ch in t:
        new = [0]
        for j, x in enumerate(p, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != ch)))
        row = new
        best = min(best, row[-1])
    return best


def test_decontaminate(spark):
    rng = random.Random(11)
    items = [(i, invented(rng, "en", n)) for i, n in enumerate([2, 15, 30, 60, 60])] + [(90, None), (91, " .. ")]
    texts = []
    for i in range(60):
        words = invented(rng, "en", 80)
        item = items[i % 5][1]
        if i % 3 == 0:
            chars = list(item)
            for _ in range(i // 15):
                k = rng.randrange(len(chars))
                chars[k : k + 1] = rng.choice([[], ["x"], [chars[k], "y"]])
            words = words[:100] + " " + "".join(chars) + words[100:]
        texts.append((i, words))
    texts += [(None, None), (70, ""), (71, items[3][1].upper().replace(" ", " \n ")), (71, items[3][1])]
    docs = spark.createDataFrame([(*x, [1]) for x in texts], "doc_id long, text string, item_ids array<int>").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = decontaminate.Index([(i, t) for i, t in items if t])
    want = Counter()
    for i, t in texts:
        n = decontaminate._normal(t or "")
        hit = sorted({item for item, part, k, _ in index.regions if n and edits_anywhere(part, n) <= k and (len(part) >= decontaminate.Q or part in n.replace(".", " ").split())})
        want[i, tuple(hit)] += 1
    got = Counter((r.doc_id, tuple(r.item_ids)) for r in decontaminate.decontaminate(docs, bench).collect())
    assert got == want
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(n for (_, hit), n in want.items() if not hit)
    old, decontaminate.BLOCK_CHARS = decontaminate.BLOCK_CHARS, 300
    try:
        assert Counter((r.doc_id, tuple(r.item_ids)) for r in decontaminate.decontaminate(docs, bench).collect()) == want
        assert Counter(map(str, decontaminate.clean(docs, bench).collect())) == Counter(map(str, clean.collect()))
    finally:
        decontaminate.BLOCK_CHARS = old
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(texts)


def ppm_brute(train, text, order):
    """log10 probability of text and its end, context by context."""
    end = 256
    follow = defaultdict(Counter)
    for b in train:
        line = [end] * order + list(b) + [end]
        for i in range(order, len(line)):
            for k in range(order + 1):
                follow[tuple(line[i - k : i])][line[i]] += 1
    line, out = [end] * order + list(text) + [end], 0.0
    for i in range(order, len(line)):
        gone, s = set(), line[i]
        for k in range(order, -1, -1):
            have = follow.get(tuple(line[i - k : i]))
            if not have:
                continue
            left = {x: n for x, n in have.items() if x not in gone}
            if s in left:
                out += math.log10(left[s] / (sum(left.values()) + len(left)))
                break
            if left:
                out += math.log10(len(left) / (sum(left.values()) + len(left)))
            gone |= set(have)
        else:
            out += math.log10(1 / (257 - len(gone)))
    return out


@pytest.mark.parametrize("head", [5, 200_000])
def test_lm(docs, rows, monkeypatch, head):
    monkeypatch.setattr(lm_score, "HEAD_WORDS", head)
    short = docs.filter("doc_id is null or doc_id != 904")
    got = defaultdict(list)
    for r in lm_score.lm_score(short).collect():
        got[r.doc_id].append(r)
    texts = [(i, (t or "").encode()) for i, t, *_ in rows if i != 904]
    train = [b for i, b in texts if held(i, 7) != 2]
    c = Counter(w for b in train for w in [*b.lower().split(), b"\n"])
    n, v = sum(c.values()), len(c)
    for i, b in texts:
        r = got[i][0]
        words = [*b.lower().split(), b"\n"]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(words), sum(c[w] > 0 for w in words), n, held(i, 7) == 2)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
    for i, b in texts[::20] + texts[-6:]:
        assert math.isclose(got[i][0].score, ppm_brute(train, b, lm_score.ORDER), rel_tol=1e-9)


def test_lm_orders_and_empty(docs):
    small = lm_score.lm_score(docs.limit(0))
    assert small.count() == 0
    table = lm_score.counts(docs).cache()
    codes, n, order = lm_score.contexts(table, most=10)
    assert order == 1 and n.sum() == table.filter("code is not null").selectExpr("sum(n)").first()[0]
    table.unpersist()


@pytest.mark.parametrize("most", [0, 40, 2_000])
def test_lm_order_at_any_size(docs, rows, monkeypatch, most):
    monkeypatch.setattr(lm_score, "MOST_NODES", most)
    got = defaultdict(list)
    for r in lm_score.lm_score(docs.filter("doc_id is null or doc_id != 904")).collect():
        got[r.doc_id].append(r)
    texts = [(i, (t or "").encode()) for i, t, *_ in rows if i != 904]
    train = [b for i, b in texts if held(i, 7) != 2]
    for i, b in texts[::20] + texts[-6:]:
        assert math.isclose(got[i][0].score, ppm_brute(train, b, lm_score.ORDER), rel_tol=1e-9)


def test_decontaminate_in_blocks(spark, monkeypatch):
    rng = random.Random(12)
    items = [(i, invented(rng, "en", 30)) for i in range(4)]
    a, b, c = (invented(rng, "en", 30) for _ in range(3))
    texts = [(None, a), (None, f"{b} {items[0][1]} {items[3][1]}"), (7, c), (7, c), (7, f"{c} {items[2][1]}"), (7, f"{c} {items[2][1]}"), (8, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    assert len(list(decontaminate.blocks(bench))) == 4
    got = Counter((r.doc_id, r.contaminated, tuple(r.item_ids), r.best_edits) for r in decontaminate.decontaminate(docs, bench).collect())
    assert got == Counter([(None, False, (), None), (None, True, (0, 3), 0), (7, False, (), None), (7, False, (), None), (7, True, (2,), 0), (7, True, (2,), 0), (8, False, (), None)])
    kept = Counter((r.doc_id, r.text) for r in decontaminate.clean(docs, bench).collect())
    assert kept == Counter([(None, a), (7, c), (7, c), (8, None)])


def test_short_items_are_whole_words():
    index = decontaminate.Index([(1, "yes"), (2, "c++")])
    assert not index.search("yesterday all my troubles")
    assert index.search("oh yes, they did") and index.search("i like c++.")


def test_a_benchmark_passage_in_a_very_long_text():
    rng = random.Random(14)
    item = invented(rng, "en", 40)
    text = "zq xj " * 60_000 + item + " vk" * 60_000
    assert decontaminate.Index([(3, item)]).search(decontaminate._normal(text))


def test_decontaminate_at_any_alignment():
    rng = random.Random(13)
    item = decontaminate._normal(invented(rng, "en", 60))
    index = decontaminate.Index([(5, item)])
    assert len(item) > 250
    for at in range(len(item) - 51 + 1):
        assert 0 in index.search(f"{'zq ' * 30}{item[at : at + 51]}{' xj' * 30}").values()
    assert not index.search(f"{'zq ' * 30}{item[40:70]}{' xj' * 30}")
    cut = list(item[100:160])
    cut[20], cut[40] = "#", "#"
    assert index.search("zq " * 30 + "".join(cut) + " xj" * 30)


def test_stage_rejects_what_is_in_no_learned_language(spark, docs):
    rng = random.Random(17)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = [" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(40)) for _ in range(10)]
    other = "ka wiz mop rulo zej tak obu nyx fye".split()
    foreign = [" ".join("".join(rng.choices(other, k=rng.choice([1, 2, 3]))) for _ in range(40)) for _ in range(10)]
    script = ["Это предложение написано на другом языке и не должно остаться " * 3]
    mixed = [f"{invented(rng, 'en', 20)}. {invented(rng, 'de', 20)}. {invented(rng, 'fr', 20)}." for _ in range(20)]
    more = [(1000 + i, t, None, "s", 5, 0.5) for i, t in enumerate(noise + foreign + script + mixed)]
    kept = {r.doc_id for r in language_id.keep_known(docs.unionByName(spark.createDataFrame(more, docs.schema))).select("doc_id").collect()}
    assert {i for i in kept if i is not None and i >= 1000} == set(range(1021, 1041))
    assert {i for i in range(240)} <= kept
