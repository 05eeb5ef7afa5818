"""The encoder against the reference library, and round trips."""

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from refinery.llm import bpe
from refinery.llm.queries import PATTERN, RANKS

ENCODER = bpe.Encoder(bpe.read_ranks(RANKS), PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def same(text):
    ids = ENCODER.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode()


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"]), max_size=80))
def test_any_text(text):
    same(text)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", "'s", " ", "  ", "\n", "\t", "\x1c", ".", ",", "12", "é", "²", "ing", "\xa0"]), max_size=25))
def test_blanks_and_marks(parts):
    same("".join(parts))


@settings(max_examples=300, deadline=None)
@given(st.text("aeinrst", max_size=60))
def test_words_without_blanks(text):
    same(text)


def test_long_words_and_full_caches(monkeypatch):
    same("a" * 20_000)
    same(("ab" * 7000) + " " + "ñ" * 9000)
    monkeypatch.setattr(bpe, "MOST_CHUNKS", 3)
    monkeypatch.setattr(bpe, "MOST_PAIRS", 3)
    same("all these words do not fit into so small a cache, and these words come again.")


def test_every_byte_must_be_a_token():
    with pytest.raises(ValueError, match="single byte"):
        bpe.Encoder({b"a": 0}, PATTERN)
