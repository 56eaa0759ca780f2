"""Language ID and the quality classifier: brute force on small inputs, held-out accuracy on tables."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from odd import no_documents, odd_documents

from sortwell.llm import langid, quality_model
from sortwell.llm.common import documents


def grams(text, bits):
    """Feature numbers of the 1- to 3-grams, one by one."""
    chars = [ord(c) if c.isalpha() else 32 for c in text.lower()]
    out = []
    for i in range(len(chars)):
        value = 0
        for n in (1, 2, 3):
            gram = chars[i : i + n]
            if len(gram) < n or any(a == b == 32 for a, b in zip(gram, gram[1:])):
                break
            value = (value * 0x01000193 + gram[-1]) & 0xFFFFFFFF
            if gram == [32]:
                continue
            mixed = ((value ^ (n * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B) & 0xFFFFFFFF
            mixed ^= mixed >> 15
            out.append(((mixed * 0xC2B2AE35) & 0xFFFFFFFF) >> (32 - bits))
    return out


def test_language_id_equals_naive_bayes_by_hand(spark, sf, monkeypatch):
    monkeypatch.setattr(langid, "WINDOW", 5000)  # several windows and pieces
    rows = [tuple(r) for r in documents(spark, sf, "doc_id", "text", "lang").limit(60).collect()]
    rows += [(900, "", "en"), (901, None, "de"), (902, "12 - 3", "en"), (903, "xyz", None),
             (904, "das ist - ein langer  text, 12 " * 500, "de")]  # several windows
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    bits = langid.BITS
    counts, n_docs = defaultdict(Counter), Counter()
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2 and text is not None and lang is not None:
            counts[lang].update(grams(text, bits))
            n_docs[lang] += 1
    found = {r.doc_id: r for r in langid.language_id(docs).collect()}
    for i, text, _ in rows:
        own = Counter(grams(text or "", bits))
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        if not own:
            assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
            continue
        logs = {
            lang: math.log(n_docs[lang] / sum(n_docs.values())) + sum(
                k * math.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * 2**bits)) for g, k in own.items()
            ) for lang, c in counts.items()
        }
        best = max(logs, key=logs.get)
        assert found[i].lang_pred == best
        assert math.isclose(found[i].score, 1 / sum(math.exp(x - logs[best]) for x in logs.values()), rel_tol=1e-6)


def test_language_id_held_out(spark, sf):
    found = langid.language_id(documents(spark, sf)).where("held_out").join(documents(spark, sf, "doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.97


def test_language_id_odd_rows(spark):
    docs = odd_documents(spark)
    found = langid.language_id(docs)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == docs.count()
    assert {r.lang_pred for r in found.where("doc_id in (6, 7, 8, 9)").collect()} == {"und"}
    assert langid.language_id(no_documents(spark)).count() == 0
    kept = langid.with_language(docs)
    assert kept.columns == docs.columns
    assert kept.where("doc_id in (6, 7, 8, 9)").count() == 0 and kept.where("doc_id = 4").count() == 1
    unlabelled = spark.createDataFrame([(1, "some words", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in langid.language_id(unlabelled).collect()] == [(1, False, "und", 0.0)]


def test_quality_held_out(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = documents(spark, sf, "doc_id", "text")
    found = quality_model.quality_scores(docs, labels).join(labels, "doc_id")
    rows = found.where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93


def test_quality_odd_rows(spark, sf):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 18)] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    found = quality_model.quality_scores(docs, labels)
    assert found.count() == docs.count()
    assert {r.score for r in found.where("doc_id in (6, 7, 8)").collect()} == {0.0}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found.collect())
    one_class = labels.where("quality = 1")
    assert {r.score for r in quality_model.quality_scores(docs, one_class).where("doc_id = 4").collect()} == {1.0}
    none = labels.where("false")
    assert {r.score for r in quality_model.quality_scores(docs, none).where("doc_id = 4").collect()} == {0.5}
    assert quality_model.quality_scores(no_documents(spark), labels).count() == 0


def test_features_do_not_depend_on_pieces(monkeypatch):
    text = "Some words Some Some words! 12\n" * 40
    seen = np.zeros(1 << 12, dtype=bool)
    whole = quality_model.features(text, seen).tolist()
    monkeypatch.setattr(quality_model, "PIECE", 64)
    assert quality_model.features(text, seen).tolist() == whole and not seen.any()


def test_dual_coordinate_descent_reaches_the_optimum(monkeypatch):
    """Against a plain subgradient method on the same objective."""
    monkeypatch.setattr(quality_model, "EPOCHS", 500)
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(80):
        y = 1.0 if i % 2 else -1.0
        own = rng.choice(20, 6, replace=False) + (10 if y > 0 else 0)
        rows.append(np.unique(own).astype(np.int32))
        labels.append(y)
    labels = np.array(labels)
    w, bias, ratio = quality_model.descend(rows, labels, 32)
    x = np.zeros((80, 33))
    for i, own in enumerate(rows):
        x[i, own] = ratio[own] / np.linalg.norm(ratio[own])
        x[i, 32] = 1

    def objective(v):
        return 0.5 * v @ v + quality_model.COST * np.maximum(0, 1 - labels * (x @ v)).sum()

    safe = np.where(ratio == 0, 1, ratio)
    mine = objective(np.append(w / safe, bias))
    v = best = np.zeros(33)
    for k in range(1, 4000):
        active = labels * (x @ v) < 1
        v = v - (v - quality_model.COST * (labels[active, None] * x[active]).sum(axis=0)) / (k + 10)
        best = min(best, v, key=objective)
    assert mine <= objective(best) * 1.003


def test_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    """One id with 400 texts and labels that repeat: at most `sample` rows reach the driver."""
    rows = [(i, f"text number {i} about some thing") for i in range(100)] + [(1, f"another text {i}") for i in range(400)]
    labels = [(i, i % 2) for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2] + [(1, 0)] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    seen = []
    plain = quality_model.descend
    monkeypatch.setattr(quality_model, "descend", lambda rows, y, width: seen.append(len(rows)) or plain(rows, y, width))
    quality_model.fit(docs, marks, sample=40, bits=12)
    assert max(seen) == 40
    quality_model.fit(docs, marks, sample=4000, bits=12)
    assert max(seen) == len({i for i, _ in labels})


def test_scores_equal_a_dense_model(spark):
    """Features by slicing, ratios by counting, the hinge loss by plain coordinate steps on a dense matrix."""
    words = {1: "good clear prose about rivers hills and towns", 0: "buy now cheap pills click win cash prize"}
    rows = [(i, " ".join(words[i % 2].split()[k % 8] for k in range(i, i + 5)) + (" both" if i % 3 else "")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, quality int")
    bits = quality_model.BITS
    fitted, slope, offset = quality_model.fit(docs, labels)
    known = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    seen = np.zeros(1 << bits, dtype=bool)
    x = np.zeros((len(known), 1 << bits), dtype=np.float32)
    for k, (_, t) in enumerate(known):
        x[k, quality_model.features(t, seen)] = 1
    y = np.array([1.0 if i % 2 else -1.0 for i, _ in known])
    p, q = 1 + x[y > 0].sum(axis=0), 1 + x[y < 0].sum(axis=0)
    ratio = np.log((p / np.abs(p).sum()) / (q / np.abs(q).sum()))
    assert np.allclose(fitted[2], ratio, atol=1e-4)
    scores = {r.doc_id: r.score for r in quality_model.quality_scores(docs, labels).collect()}
    for i, t in rows:
        found = quality_model.features(t, seen)
        margin = sum(float(fitted[0][f]) for f in found) / math.sqrt(sum(float(ratio[f]) ** 2 for f in found)) + fitted[1]
        assert abs(scores[i] - 1 / (1 + math.exp(-(slope * margin + offset)))) < 1e-3
        assert (scores[i] >= 0.5) == bool(i % 2)
