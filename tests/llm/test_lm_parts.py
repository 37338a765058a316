"""The network of ``op2`` part by part: the same slopes, probabilities and tokens."""

from collections import Counter

import numpy as np
import pytest
from helpers import ODD, alnum_words, documents

from glyphlex.llm import lm_score


def start(seed=0):
    rng = np.random.default_rng(seed)
    v = lm_score.initial(rng.integers(0, 50, 512)).astype(np.float64)
    return rng, lm_score.parts(v + rng.standard_normal(len(v)) * 0.1, 8)


def test_slopes_part_by_part(monkeypatch):
    """Parts that share contexts, texts' ends within and between them, a short last part."""
    rng, w = start()
    gap = np.zeros(lm_score.REACH, int)
    line = np.concatenate([gap, *[x for n in (1, 30, 7, 0, 64, 5) for x in (rng.integers(1, 512, n), gap)]])
    place = np.flatnonzero(line)
    d, rows, de = lm_score.slopes(w, line, place, lm_score.forward(w, line, place)[1])
    for part in (1, 7, 16, 1024):
        monkeypatch.setattr(lm_score, "PART", part)
        got, got_rows, got_de = lm_score.slopes(w, line, place)
        assert np.array_equal(got_rows, rows) and np.allclose(got_de, de, atol=1e-12)
        assert all(np.allclose(got[k], d[k], atol=1e-12) for k in d)


@pytest.mark.parametrize("shift", [0, 80, 3000, -200, -3000])
def test_softmax_beyond_the_range_of_the_exponentials(shift):
    x = np.random.default_rng(1).standard_normal((50, 40)).astype(np.float32)
    x[::2] += shift
    want = x.astype(np.float64) - x.max(axis=1, keepdims=True)
    log_sum = np.log(np.exp(want).sum(axis=1)) + x.max(axis=1)
    p, s, got = lm_score._softmax(x.copy())
    assert np.allclose(p / s[:, None], np.exp(want) / np.exp(want).sum(axis=1, keepdims=True), rtol=1e-4)
    assert np.allclose(got, log_sum, rtol=1e-5, atol=1e-4)


@pytest.mark.parametrize("n", [1, 2, 500, 5000])
def test_digests_are_found_by_their_first_bits(n):
    """Also digests that all share their first bits, and digests beyond the ends."""
    rng = np.random.default_rng(n)
    for low, high in ((0, 1 << 64), (1 << 40, (1 << 40) + 3 * n), ((1 << 64) - 2 * n - 9, 1 << 64)):
        keys = np.unique(rng.integers(low, high, n, np.uint64, endpoint=False))
        x = np.concatenate([keys, keys + np.uint64(1), rng.integers(0, 1 << 64, 200, np.uint64, endpoint=False),
                            np.array([0, (1 << 64) - 1], np.uint64)])
        want = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
        assert np.array_equal(lm_score._places_in(keys, x), want)


def test_rare_words_beside_a_vocabulary_that_grows(spark):
    """Words below OFTEN share a bucket; each counts with its own share of it."""
    def digest(w):
        return int(lm_score.Words(np.array([0, len(w)]), np.frombuffer(w.encode(), np.uint8),
                                  lm_score.NOT_ALNUM).hash[0])
    texts = [" ".join(f"word{j}" for j in range(k % 7, 600, 1 + k % 5)) for k in range(20)]
    texts += [" ".join(f"odd{j}" for j in range(k, 300, 2 + k)) for k in range(3)] + ODD
    docs = documents(spark, texts)
    counts = Counter(w for t in texts for w in alnum_words(t))
    words = lm_score.word_counts(docs)
    model = lm_score.train(docs, words=words)
    often = {digest(w) for w, n in counts.items() if n >= lm_score.OFTEN}
    assert set(model.keys.tolist()) == often and 0 < len(often) < len(counts)
    total = Counter()
    for w, n in counts.items():
        total[digest(w) % lm_score.BUCKETS] += n * (digest(w) not in often)
    rows = lm_score.score(docs, model, words=words).collect()
    assert sorted(r._row.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        n, own = model.score(lm_score.pa.array([r._row.text], lm_score.pa.string()))
        for w in alnum_words(r._row.text):
            if digest(w) not in often:
                own = own + np.log(counts[w] / (total[digest(w) % lm_score.BUCKETS] + 1))
        assert r.n_tokens == n[0] and abs(r.log_prob - own[0]) <= 1e-3 * max(1, n[0])
