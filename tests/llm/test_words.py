"""The encoder's store and cuts."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from leafline.llm import words

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_words_of_recent_texts_outlive_a_full_store(monkeypatch):
    monkeypatch.setattr(words, "KEPT", 200)
    own, asked = words.Encoder(BYTES), []
    monkeypatch.setattr(own, "parts", lambda new, parts=own.parts: asked.extend(new) or parts(new))
    for k in range(60):
        own([" ".join(["start", "often", "again", *(f"w{k}x{n}" for n in range(20))])])
        assert len(own.kept) + len(own.older) <= 200
    assert asked.count("often") == asked.count("again") == 1


def test_cuts_are_those_of_the_pattern():
    rng = random.Random(3)
    signs = [chr(c) for c in range(0x110000) if chr(c).isspace()] + ["᠎", "​", "⁠", "﻿"]
    texts = ["", " ", "a b", "a b\nc d", "a \nb", "a\n b", " a", "a "] + [f"a{s}{t}b c" for s in ["", " ", *signs] for t in ["", " "]] + ["".join(rng.choices(["a", "é", " ", "\n", *signs], [9, 3, 5, 1, *[0.01] * len(signs)], k=40)) for _ in range(500)]
    assert [words.cut(t) for t in texts] == [words._CUT.split(t) for t in texts]
    assert sum(words._UNUSUAL.search(s) is not None for s in signs) == len(signs) - 2


def test_parts_together_are_those_of_each():
    whole = Tokenizer.from_file(BYTES)
    parts = ["end.\nNext", "a\n\nb", "&&&", "<|endoftext|>", "x<|endoftext|>y", "1,2", "é é", "don't", "'s", "Ġ", "٣", "漢字"] * 20
    want = [whole.encode(f" {p}", add_special_tokens=False).ids for p in parts]
    assert [np.frombuffer(x, "<u4").tolist() for x in words.Encoder(BYTES).together(parts)] == want


def test_words_and_lines_are_those_of_the_whole_tokenizer(monkeypatch):
    monkeypatch.setattr(words, "WORDS", 3)
    rng = random.Random(5)
    ends = ["", ".", "...", ",", "!?", "\n", ".\n", "\n\n", ".\r\n", "’s", "'s", "1", "ı", "ſ", "Ā", "×", "ß"]
    parts = ["".join(rng.choice(["Und", "é", "naïve", "tionou", "ÿ", "ĿŁ", "ab", "a b"]) + rng.choice(ends) for _ in range(rng.randint(1, 4))) for _ in range(2000)]
    texts = [" ".join(rng.choices(parts, k=40)) for _ in range(100)] + ["", " ", "a"]
    whole, own, asked = Tokenizer.from_file(BYTES), words.Encoder(BYTES), []
    monkeypatch.setattr(own, "together", lambda parts, together=own.together: asked.extend(parts) or together(parts))
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own(texts)] == want
    assert words.Encoder(BYTES).counts(texts) == [len(ids) for ids in want]
    # Lines of two words go to the merges, not through the tokenizer's patterns.
    assert asked and not any(words._WORD.fullmatch(p) for p in asked) and words._WORD.fullmatch("dos.\nTrès,")
    assert [shown for shown in map(words.shown, ["é a", "Ab"])] == ["Ã©Ġa", "Ab"]
