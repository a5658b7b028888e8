"""The classifier and the pipeline against plain computations over collected rows."""

import math
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import xxhash
from compare import SF_SMALL
from shipping import shipped  # noqa: F401
from tidegate.llm import quality
from tokenizers import Tokenizer


def plain_scores(docs, labels, waves=256, width=4.0, ridge=1e-3, seed=7):
    """(weights, score of a text) learned from `{id: text}` and `{id: label}`, id by id."""
    train = [k for k in sorted(labels) if k in docs and zlib.crc32(str(k).encode()) % 5]
    x = np.array([quality.statistics(docs[k]) for k in train])
    y = np.array([labels[k] for k in train], float)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread <= 1e-9] = 1.0
    draw = np.random.default_rng(seed)
    directions = draw.standard_normal((x.shape[1], waves)) / width
    phases = draw.uniform(0, 2 * math.pi, waves)

    def features(rows):
        z = np.clip((rows - mean) / spread, -8, 8)
        waves_ = math.sqrt(2 / waves) * np.cos(z @ directions + phases)
        return np.column_stack([waves_, np.ones(len(rows))])

    f = features(x)
    penalty = np.diag([ridge * len(x)] * waves + [0.0])
    weights = np.linalg.lstsq(f.T @ f + penalty + 1e-9 * np.eye(waves + 1), f.T @ y, rcond=None)[0]
    cell = np.clip((f @ weights + 1) / 3 * quality.CELLS, 0, quality.CELLS - 1).astype(int)
    seen = np.unique(cell)
    n = np.array([(cell == c).sum() for c in seen], float)
    means = np.array([y[cell == c].mean() for c in seen])
    # rising least squares by its closed form: the greatest of the least means of intervals
    part = lambda a, b: (n[a:b] * means[a:b]).sum() / n[a:b].sum()
    m = len(seen)
    least = np.array([[min((part(a, b + 1) for b in range(i, m)), default=0) if a <= i else -1.0 for a in range(m)] for i in range(m)])
    levels = least.max(axis=1)
    knots = (seen + 0.5) / quality.CELLS * 3 - 1

    def score(text):
        raw = features(np.array([quality.statistics(text)])) @ weights
        return float(np.clip(np.interp(raw, knots, levels), 0, 1)[0])

    return weights, score


def test_ridge_and_calibration_equal_the_plain_computation(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    marks = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    weights, score = plain_scores(texts, marks)
    model = quality.fit(docs.where(~quality.held_out(docs.doc_id)), labels)
    assert np.allclose(model.weights, weights, atol=1e-4)
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    for k, text in texts.items():
        assert abs(got[k].score - score(text)) < 1e-3
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0)


def _fingerprint(text):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    own = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    marks = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    texts = {r.doc_id: r.text for r in docs.collect()}
    _, score = plain_scores(texts, marks)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "simhash_near_dedup", "packing"]

    good = stages["quality_classifier"](spark, docs, SF_SMALL).cache()
    clear = {k: score(t) for k, t in texts.items() if abs(score(t) - 0.3) > 1e-3}
    kept = {r.doc_id for r in good.collect()}
    assert good.columns == docs.columns and {k for k in clear if k in kept} == {k for k, s in clear.items() if s >= 0.3}

    lines = stages["line_dedup"](spark, good, SF_SMALL).cache()
    assert lines.columns == docs.columns
    seen = set()
    for r in sorted(lines.collect(), key=lambda r: r.doc_id):
        own = (texts[r.doc_id] or "").split("\n")
        rest = r.text.split("\n") if r.text else []
        source = iter(own)
        assert all(x in source for x in rest)  # lines go, the others keep their order, and none is made
        assert r.n_chars == len(r.text or "")
        for x in rest:  # a long line stays with its first holder only
            assert len(x.split()) < 25 or x not in seen
        seen |= {x for x in own if len(x.split()) >= 25}
    assert {r.doc_id for r in lines.collect()} == kept

    first = stages["simhash_near_dedup"](spark, lines, SF_SMALL).cache()
    prints = {r.doc_id: _fingerprint(r.text) for r in lines.collect()}
    group = {k: k for k in prints}
    for _ in range(len(prints)):
        new = {a: min(group[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 4) for a in prints}
        if new == group:
            break
        group = new
    assert {r.doc_id for r in first.collect()} == set(group.values())

    packed = stages["packing"](spark, first, SF_SMALL).collect()
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {r.doc_id: [*slow.encode(r.text or "", add_special_tokens=False).ids, 1] for r in first.collect()}
    places = {}
    for r in packed:
        own = np.array(tokens[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(own.tobytes()) == r.ids_crc32 and r.doc_tokens == len(tokens[r.doc_id])
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in packed) == sum(map(len, tokens.values()))
    for spans in places.values():
        ends = np.cumsum([n for _, n in sorted(spans)])
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_the_fit_needs_no_workers_of_its_own(spark, monkeypatch):
    """Functions of an RDD run in Python workers beside those of data frames."""
    docs = spark.createDataFrame([(k, "word " * (k % 7) + "end.") for k in range(40)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality")
    monkeypatch.setattr(type(docs), "rdd", property(lambda self: pytest.fail("an RDD")))
    model = quality.fit(docs, labels)
    assert np.isfinite(model.weights).all() and np.abs(model.weights).max() > 0
