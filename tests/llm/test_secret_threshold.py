import numpy as np

from tests.llm.helpers import documents
from tests.llm.test_secrets import corpus
from trajspark.llm import secret_scan


def test_threshold_covers_all_kept_out_findings(spark, monkeypatch):
    """Only the fit is sampled: the calibration counts every kept-out candidate."""
    docs, _ = corpus(600)
    trained, counted = [], []
    train, calibrate = secret_scan.train_network, secret_scan.calibrated
    monkeypatch.setattr(secret_scan, "train_network", lambda windows, labels: (
        trained.append(len(windows)), train(windows, labels, rounds=2))[1])
    monkeypatch.setattr(secret_scan, "calibrated", lambda net, raw, y, weight: (
        counted.append((sum(weight), np.dot(y, weight))), calibrate(net, raw, y, weight))[1])
    found = [(w, sort) for _, t, _ in docs for a, b in secret_scan.candidates(t)
             for sort in [secret_scan.sort_of(t, a, b, secret_scan.base_spans(t))]
             if sort is not None for w in secret_scan.windows(t, a, b)]
    secret_scan.secret_scan(documents(spark, docs), sample=40).collect()
    assert trained == [40]
    (n, true), = counted
    assert 0.2 * len(found) < n < 0.4 * len(found)      # three in ten of all, not of the sample
    assert abs(true / n - np.mean([known for _, known in found])) < 0.1


def test_counts_are_repeated_findings():
    draw = np.random.default_rng(4)
    raw, y, weight = draw.normal(0, 3, 80), draw.integers(0, 2, 80), draw.integers(1, 9, 80)
    raw = raw + 4 * y
    one = secret_scan.calibrated({}, raw, y, weight)
    many = secret_scan.calibrated({}, np.repeat(raw, weight), np.repeat(y, weight),
                                  np.ones(weight.sum()))
    assert all(np.isclose(one[k], many[k]) for k in ("slope", "shift", "threshold"))
    chance = 1 / (1 + np.exp(-(many["slope"] * raw + many["shift"])))
    true = np.repeat(chance, weight)[np.repeat(y, weight) == 1]
    assert (true >= many["threshold"]).mean() >= secret_scan.RECALL
