import weakref

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import encoding
from tallyloom.llm.common import keep_only
from tallyloom.llm.encoding import Encoder, encoder

PIECES = ["a", "B", "Zw", "é", " ", "  ", "\n", "\r\n", "\t", "'s", "'", "1", "²", "ß", "İ", "\x1c", "\xa0", "\x01", ",", ".", ", ", ". ", "́"]
PIECES += ["<|endoftext|>", "<|startoftext|>", "!", "漢", "ΑΣ", "\x85", "ǅ", "　", "​", "_", "क़"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@settings(max_examples=400, deadline=None)
@given(parts=st.lists(st.sampled_from(PIECES), max_size=12))
def test_ids_are_those_of_the_library(name, parts):
    own, text = encoder(public_tokenizers.path(name)), "".join(parts)
    assert np.frombuffer(own.pack(text), "<u4").tolist() == own.library.encode(text, add_special_tokens=False).ids


def test_null_is_empty():
    assert encoder(public_tokenizers.path("word_bpe_49k.json")).pack(None) == b""


NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
LETTERS = ["a", "Q", "the", "é", "e\u0301", "ß", "Σ", "ς", "İ", "ı", "ŉ", "ǅ", "ʹ", "Ж", "ԯ", "\u0530", "あ", "漢", "ᄀ", "ᅡ", "ª", "²", "½", "7"]
TAILS = [" ", " ", "\n", ",", ".", "!!", "&&&", "|", " |", "_", "'", "'s", "'t", '"', "(", "<|", "|>", "=\u0338"]


def same(own, text):
    return np.frombuffer(own.pack(text), "<u4").tolist() == own.library.encode(text, add_special_tokens=False).ids


class Counted:
    """A tokenizer that notes what passes it as a whole."""

    def __init__(self, library):
        self.library, self.seen = library, []

    def __getattr__(self, name):
        return getattr(self.library, name)

    def encode_batch_fast(self, texts, **options):
        self.seen += texts
        return self.library.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("name", NAMES)
def test_new_words_of_letters_go_to_the_model_alone(name):
    own = Encoder(public_tokenizers.path(name))
    whole, own.library = own.library, Counted(own.library)
    text = "Erstheandly tionéa, ouvier.\nЖurnal onlyorresh"
    found = np.frombuffer(own.pack(text), "<u4").tolist()
    assert own.library.seen == []
    assert found == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
def test_symbols_behind_a_word_are_encoded_once(name):
    own = Encoder(public_tokenizers.path(name))
    whole, own.library = own.library, Counted(own.library)
    text = " ".join(f"{word}!!" for word in ("one", "two", "three", "four"))
    found = np.frombuffer(own.pack(text), "<u4").tolist()
    assert own.library.seen == ["!!"]
    assert found == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=600, deadline=None)
@given(parts=st.lists(st.sampled_from(LETTERS + TAILS), max_size=14))
def test_ids_of_words_in_any_script_and_of_what_stands_behind_them(name, parts):
    assert same(encoder(public_tokenizers.path(name)), "".join(parts))


@pytest.mark.parametrize("name", NAMES)
def test_every_old_letter_within_a_word(name):
    own = Encoder(public_tokenizers.path(name))
    letters = [chr(code) for code in range(0x80, ord(encoding.OLD_LETTERS)) if chr(code).isalpha()]
    wrong = [c for c in letters if not (same(own, f"x a{c}b") and same(own, f"{c}") and same(own, f" {c}{c}, B{c}"))]
    assert len(letters) > 900 and wrong == []


@pytest.mark.parametrize("name", NAMES)
def test_ids_stay_the_same_when_pieces_are_let_go(name, monkeypatch):
    monkeypatch.setattr(encoding, "KEPT_PLAIN", 8)
    monkeypatch.setattr(encoding, "KEPT_OTHERS", 3)
    own = Encoder(public_tokenizers.path(name))
    for text in ("one two, three.\nfour five six seven", "one!! two## three%% four", "eight nine, ten eleven twelvethirteen", "one two|") * 2:
        assert same(own, text)
    assert len(own.plain) < 20 and len(own.other) < 12


def test_another_operator_frees_the_encoders():
    kept = weakref.ref(encoder(public_tokenizers.path("byte_bpe_50k.json")))
    kept().pack("a few words")
    keep_only("another")
    assert kept() is None
