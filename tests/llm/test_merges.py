"""Merges of short segments in a list, against the heap that long ones use."""

from __future__ import annotations

import random

from pulseline.llm import pieces


def test_short_segments_merge_as_long_ones(monkeypatch):
    """Equal scores, characters without a piece, and lengths on both sides of the border."""
    rng = random.Random(4)
    names = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(60)} | set("ab")
    scores = {p: (float(-rng.randint(1, 6)), i) for i, p in enumerate(sorted(names))}
    merger = pieces.Merger(pieces.Vocabulary(scores, None, 99, []))
    texts = ["".join(rng.choice("abcd") for _ in range(n)) for n in range(pieces.SHORT + 3) for _ in range(20)]
    lists = [merger.parts(t) for t in texts]
    ids = [merger.ids(t) for t in texts]
    assert ["".join(p) for p in lists] == texts
    monkeypatch.setattr(pieces, "SHORT", -1)
    assert [merger.parts(t) for t in texts] == lists
    assert [merger.ids(t) for t in texts] == ids
