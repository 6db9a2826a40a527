"""Links wait in bounded numbers before they are reduced to a forest."""

from __future__ import annotations

import numpy as np

from pitfeat.llm.simhash import _Links


def test_links_are_reduced_early():
    found = _Links()
    held = 0
    for k in range(30):
        a = np.arange(20_000, dtype=np.int64)
        found.add(a, (a + k) // 2)
        held = max(held, found.n)
    assert held <= (1 << 18) + 20_000
    a, b = found.reduce()
    assert set(b.tolist()) == {0} and sorted(a.tolist()) == list(range(1, 20_000))
