"""Near-dedup and the pipeline against brute force."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

import corpus_pipeline
from evigraph.llm import near_dedup


def brute_classes(texts, idf):
    s = near_dedup.Shingler(idf)
    got = [(h, s.weights(h, c).astype(float)) for h, c in s.shingles(pa.array([t or "" for t in texts], pa.string()))]
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or near_dedup.similarity(got[i], got[j]) >= 0.8:
                label[find(i)] = find(j)
    out = defaultdict(set)
    for i in range(len(texts)):
        out[find(i)].add(i)
    return sorted(map(sorted, out.values()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    common = [word() for _ in range(40)]
    out = []
    for g in range(12):
        base = [word() for _ in range(120)] + common * (g % 3 == 0)
        for k in range(rng.choice([1, 2, 7])):
            w = list(base)
            for _ in range(k % 4):
                w[rng.randrange(len(w))] = word()
            out.append(" ".join(w))
    chain = [word() for _ in range(200)]
    for _ in range(8):  # each near to the next, the first not to the last
        out.append(" ".join(chain))
        chain = chain[8:] + [word() for _ in range(8)]
    out += ["one two three", "One  two three", "one two four", "", " ", "", "x " * 30000, "x " * 29000 + "y"]
    return out


@pytest.mark.parametrize("block", [2, 4, 1024])
def test_classes(spark, rows, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    docs = spark.createDataFrame([(i, t, "k", b"") for i, t in enumerate(rows)] + [(None, None, "k", b""), (3, rows[3], "k", b"")], "doc_id long, text string, label string, node binary").repartition(4)
    idf = near_dedup.idf_table(docs)
    want = brute_classes(rows, idf)
    got = near_dedup.near_dedup(docs).collect()
    assert len(got) == len(rows) + 2
    by = defaultdict(set)
    for r in got:
        if r.doc_id is not None:
            by[r.class_id].add(r.doc_id)
    assert sorted(map(sorted, by.values())) == want
    assert all(k == min(v) for k, v in by.items())
    sizes = Counter(r.class_id for r in got)
    assert all(r.class_size == sizes[r.class_id] for r in got)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(by)
    assert near_dedup.near_dedup(docs.limit(0)).count() == 0 == near_dedup.keep_one(docs.limit(0)).count()


def test_components(spark):
    rng = random.Random(2)
    links = [(bytes([a]), bytes([a + 1])) for a in range(30) if a % 11] + [(b"\x63", bytes([c])) for c in range(100, 140)]
    rng.shuffle(links)
    got = {bytes(r.node): bytes(r.label) for r in near_dedup.components(spark.createDataFrame(links, "a binary, b binary")).collect()}
    assert len(set(got.values())) == 4 and all(got[a] == got[b] for a, b in links)
    assert got[b"\x63"] == b"\x63" and got[bytes([10])] == got[bytes([2])] == bytes([1])


def test_samples_estimate_weighted_jaccard():
    import numpy as np

    rng = np.random.default_rng(4)
    h = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
    sampler, agree, true = near_dedup.Sampler(), 0, 0.0
    for k in range(40):
        a, b = rng.random(len(h)) < 0.9, rng.random(len(h)) < 0.9
        w = 1 + rng.random(len(h))
        v = np.where(rng.random(len(h)) < 0.2, 2 * w, w)
        x = np.uint64(k * 977)
        agree += (sampler.marks((h ^ x)[a], w[a]) == sampler.marks((h ^ x)[b], v[b])).mean()
        true += near_dedup.similarity((h[a], w[a]), (h[b], v[b]))
    assert abs(agree - true) / 40 < 0.06


def test_pipeline_stage_by_stage(spark, tmp_path, rows):
    import re

    rng = random.Random(9)
    parts = {"en": "the of and ing er th on st".split(), "de": "der und ung sch ein lich ver zu".split()}

    def prose(lang, n):
        return " ".join("".join(rng.choices(parts[lang], k=rng.choice([1, 2, 3]))) for _ in range(n))

    item = prose("en", 30)
    docs = []
    for i in range(60):
        lang = "en" if i % 2 else "de"
        docs.append((i, prose(lang, 80), lang, f"s{i % 3}", 1))
    docs += [(60, docs[3][1] + " ", "en", "s0", 1), (61, docs[4][1][:-4] + " zu", "de", "s1", 1), (62, docs[5][1] + " " + item, "en", "s2", 1), (63, None, "en", None, 1), (64, "123 456", "en", "s0", 1), (65, docs[7][1], "en", "s1", 1)]
    docs[6] = (6, docs[6][1][:200] + " " + item + " " + docs[6][1][200:], "de", "s0", 1)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = {d[0] for d in docs} - {63, 64}
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.materialize(stage(spark, now, str(tmp_path)))
        assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r.doc_id for r in now.collect()})
    texts = {d[0]: d[1] for d in docs}
    assert kept[0] == left
    squeezed = defaultdict(list)
    for i in left:
        squeezed[re.sub(r"\s", "", texts[i])].append((-len(texts[i]), i))
    assert kept[1] == {min(v)[1] for v in squeezed.values()}
    assert kept[2] == kept[1] - {61}
    assert kept[3] == {i for i in kept[2] if item not in texts[i]}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == kept[3]
    from tokenizers import Tokenizer

    from evigraph.llm.tokens import default_path

    coder, cover, filled = Tokenizer.from_file(default_path()), defaultdict(list), Counter()
    for r in out:
        ids = [*coder.encode(texts[r.doc_id], add_special_tokens=False).ids, 1]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.start : r.start + r.length]))
        cover[r.doc_id] += range(r.start, r.start + r.length)
        filled[r.sequence_id] += r.length
    assert all(sorted(x) == list(range(len(x))) for x in cover.values()) and all(n == 2048 or n & (n - 1) == 0 for n in filled.values())
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
