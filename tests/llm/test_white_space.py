"""Long stretches of white space: exact prefix counts, and an end to the search."""

from __future__ import annotations

import random
import time

import pytest
from tokenizers import Tokenizer

from seriesmill.llm import bpe, token_counts


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(bpe.vocabulary(bpe.tokenizer_path()))


def test_prefixes_with_stretches(counter):
    tokenizer = Tokenizer.from_file(bpe.tokenizer_path())
    rng = random.Random(6)
    for _ in range(150):
        gap = "".join(rng.choice([" ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "\r"]) for _ in range(rng.randint(2, 25)))
        text = rng.choice(["", "a", "word", "12", "'s", "<|endoftext|>"]) + gap + rng.choice(["", "b", "!", "'ll", "<|endoftext|>"]) + rng.choice(["", "  \n"])
        prefixes = token_counts.Prefixes(text, counter)
        counts = [len(tokenizer.encode(text[:n], add_special_tokens=False).ids) for n in range(len(text) + 1)]
        assert [prefixes.upto(n) for n in range(len(text) + 1)] == counts, repr(text)
        for budget in (0, 1, 2, 5):
            assert prefixes.within(budget) == max(n for n, c in enumerate(counts) if c <= budget), repr(text)


@pytest.mark.parametrize("text", [" \n" * 20_000, "word " + "\t \n" * 15_000 + "end", "x" * 20_000])
def test_long_texts_end(counter, text):
    begin = time.monotonic()
    prefixes = token_counts.Prefixes(text, counter)
    kept = prefixes.within(1024)
    assert prefixes.upto(kept) <= 1024 and (kept == len(text) or prefixes.upto(kept + 1) > 1024 or text[kept].isspace())
    assert time.monotonic() - begin < 20
