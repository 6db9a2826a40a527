"""Likeness of texts on either side of 40 and 400 characters, against difflib."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pytest

from pitfeat.llm import sketch


def prose(rng: np.random.Generator, chars: int) -> str:
    out = ""
    while len(out) < chars:
        out += "".join(rng.choice(list("abcdefghij"), rng.integers(2, 7))) + rng.choice([" ", " ", " ", " ", ". "])
    return out[:chars - 1].rstrip(" .") + "z"


@pytest.mark.parametrize("limit", [40, 400])
def test_near_copies_straddle_a_former_limit(limit):
    rng = np.random.default_rng(limit)
    for _ in range(30):
        longer = prose(rng, limit + 4)
        shorter = longer[:limit - 4]
        got = sketch.likeness([sketch.digests(longer)], [sketch.digests(shorter)])[0]
        measure = SequenceMatcher(None, longer.split(), shorter.split(), autojunk=False).ratio()
        assert measure > 0.6 and got > measure - 0.3


def test_edited_text_falls_below_a_former_limit():
    rng = np.random.default_rng(5)
    for _ in range(30):
        text = prose(rng, 440)
        changed = sketch.edited(text, "short")  # 440 to 335 characters
        assert len(changed) < 400 <= len(text)
        got = sketch.likeness([sketch.digests(text)], [sketch.digests(changed)])[0]
        assert got > SequenceMatcher(None, text.split(), changed.split(), autojunk=False).ratio() - 0.15


def test_long_words_are_cut():
    text = "日本語" * 60
    got = sketch.likeness([sketch.digests(text)], [sketch.digests(text[:140])])[0]
    assert got > 0.7
