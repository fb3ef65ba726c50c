from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from slipstream.llm import planes

PIECES = [
    "abc", "Abc", "ABC,", "abc.,!", "a", "Ää", "é", "é", "ß", "ẞ", "K", "İ", "ǅ", "µ", "ª", "Ω", "ж", "中",
    "가", "̇", "1", "09", "²", "½", "'s", "'LL", "'", "###", "_", "-", "$", "<|endoftext|>", "<|", "|>", ",", ".",
    " ", "  ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "　", "\U0002ebf0", "x" * 70,
]


@pytest.fixture(scope="module")
def encoder():
    return planes.Encoder(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_are_those_of_the_library(encoder, monkeypatch):
    draw = random.Random(3)
    texts = ["", *("".join(draw.choices(PIECES, k=draw.randint(1, 9))) for _ in range(3_000))]
    want = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
    for most in (planes.REMEMBERED, 5):
        monkeypatch.setattr(planes, "REMEMBERED", most)
        assert [np.frombuffer(c, "<u4").tolist() for c in encoder.encode(texts)] == want


def test_pieces_are_encoded_once_and_long_ones_not_kept(encoder, monkeypatch):
    # A piece that has been met costs one look at the memory, and the memory holds short pieces only.
    encoder.clear()
    text = "Once upon, a time! " + "y" * 5_000 + " upon"
    first = encoder.encode([text])
    assert {"Once", "once", "upon,", "upon", "time!"} <= set(encoder)
    assert max(map(len, encoder)) <= planes.LONGEST
    monkeypatch.setattr(planes, "_bytes", lambda ids: pytest.fail("encoded again"))
    assert encoder.encode(["time! Once upon, a time!"])[0].startswith(encoder["time!"])
