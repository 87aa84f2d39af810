"""Token ids of many texts at once equal the tokenizer's own, text by text."""

import random

import numpy as np
import pytest

from lodestrata.llm import _tokens

ODD = [
    "", "a", "don't stop 'tis", "rock'n'roll 's", "(foo) bar's_x", "ÉtÉ ß×÷a", "áb Á", "İstanbul ΣΣ", "<|endoftext|> Foo.bar", "x<|y", "123abc 4.5e-6", "你好，" * 30,
    "a b c", "≠x", "x" * 5000, "'" * 20 + "s", "\x00\x01a\x7fb", "’s don’t", "ﬁ Å ẞ", "it'S 'LL we'Re", "''''s ''t", "A" * 17 + "'s", "###'s***t",
]
POOL = "aB1'.,-éÉ́ \n<|>#s tΣ×"


@pytest.mark.parametrize("most", [2, 50, _tokens.CACHE])
def test_ids(most):
    """Also where the cache is far too small for what it meets."""
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(POOL) for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    cache = _tokens.PieceIds(_tokens.default_path(), most)
    want = [cache.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [i.tolist() for i in cache.texts([t.encode() for t in texts])] == want
    assert [i.tolist() for i in cache.texts([t.encode() for t in texts[::-1]])] == want[::-1]
    assert cache.texts([]) == []


def test_cut():
    text, number, start, end = _tokens.cut(np.array([0, 5, 6, 12]), 3)
    assert list(zip(text, number, start, end)) == [(0, 0, 0, 3), (0, 1, 3, 5), (1, 0, 5, 6), (2, 0, 6, 9), (2, 1, 9, 12)]


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(_tokens, "PART", 40)
    rng = random.Random(9)
    texts = ["".join(rng.choice(["Word", "é", " ", " ", "\n", "don't ", "<|endoftext|>", "x" * 130, "1,2 "]) for _ in range(rng.randint(0, 80))) for _ in range(60)]
    cache = _tokens.PieceIds(_tokens.default_path())
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        ids, bounds = cache.flat_texts(data, np.array([0, len(data)]))
        assert ids.tolist() == cache.tokenizer.encode(t, add_special_tokens=False).ids and bounds.tolist() == [0, len(ids)]
