"""Logits worked on block by block."""

from __future__ import annotations

import numpy as np

from pulseline.llm import pseudo_likelihood as p


def test_blocks_of_logits_change_no_probability(monkeypatch):
    rng = np.random.default_rng(2)
    net = p.initial()
    row, at = p.framed([rng.integers(0, p.VOCABULARY, 300).astype(np.int32) for _ in range(9)])
    h, classes = p.forward(net, row, at)
    logs = p.log_probabilities(net, row, at)
    assert np.allclose(classes.sum(axis=1), 1, atol=1e-5) and len(h) == len(at) > p.BLOCK
    plain = h @ net["to_class"] + net["class_bias"]
    plain = np.exp(plain) / np.exp(plain).sum(axis=1, keepdims=True)
    assert np.allclose(classes, plain, atol=1e-6)
    monkeypatch.setattr(p, "BLOCK", 7)
    assert np.allclose(p.log_probabilities(net, row, at), logs, atol=1e-5)
