"""Token ids of whole texts, exactly as the tokenizers library gives them, at the price of one encoding per distinct piece.

Pre-tokenizers never join what a safe cut separates, so the ids of a text are those of its pieces, one after the other.
Pieces repeat far more often than texts; each worker keeps the ids of those it has seen, up to a bound. New pieces of letters
alone are one pre-token each: they go to the library's model directly, all others through the whole tokenizer.
"""

from __future__ import annotations

import contextlib
import gc
import hashlib
import json
import os
import re
import string
import sys
import unicodedata
from array import array
from collections.abc import Callable
from functools import lru_cache

from tallyloom.llm.common import KEPT, keep_only

# The code points with the Unicode property White_Space, which the library's \s stands for.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
# Byte-level pre-tokenizer: a run of white space gives its last character to what follows if that is a space.
BYTE_LEVEL = re.compile(f"[{WHITE}]+(?![^{WHITE}])| ?[^{WHITE}]+|[{WHITE}]")
# White space is dropped, so any cut at a space or line end is safe.
DROPPING = re.compile("[^ \n]+")
CUT = "\x01"
MARKS = ",.\n"
MARK_PAIRS = (",,", ",.", ".,", "..", "\n\n")
TAILS = string.punctuation.replace("'", "")  # behind letters and digits these begin a pre-token, an apostrophe may not
OLD_LETTERS = "\u0530"  # below it all versions of Unicode in use agree on what is a letter
LETTER_RUN = r"|[\p{L}]+|"
KEPT_PLAIN, KEPT_OTHERS = 800_000, 200_000


class NotPlain(KeyError):
    """A piece that must not be cut off from its neighbours."""


class Pieces(dict):
    """Ids of the pieces seen so far; ``learn`` gives those of a new one."""

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__()
        self.learn = learn

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.learn(piece)
        return ids


class Letters(dict):
    """For ``str.translate``: what the library's pre-tokenizer makes of a letter or a space."""

    def __init__(self, library):
        super().__init__()
        self.library = library

    def __missing__(self, code: int) -> str:
        found = self[code] = "".join(part for part, _ in self.library.pre_tokenizer.pre_tokenize_str(chr(code)))
        return found


class Encoder:
    """Encodes text with one tokenizer file; ``pack`` gives the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = [token["content"] for token in described["added_tokens"]]
        self.cut = _safe_cut(described)
        self.model, self.letters = self.library.model, Letters(self.library)
        self.one_word = self._normal_word if self.cut is DROPPING else self._spaced_word
        if self.cut is DROPPING and not _letters_alone(described):
            self.one_word = lambda piece: None
        self.plain, self.other = Pieces(self._plain_ids), Pieces(self._other_ids)
        if self.cut:
            self._keep_marks()

    def _encode(self, text: str) -> bytes:
        return _packed(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def pack(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.cut is None or any(special in text for special in self.special):
            return self._encode(text)
        self._let_go()
        pieces = _plain_pieces(text)
        if pieces is not None:
            with contextlib.suppress(NotPlain):
                return b"".join(map(self.plain.__getitem__, pieces))
        return b"".join(map(self.other.__getitem__, _words(text) or self.cut.findall(text)))

    def _plain_ids(self, piece: str) -> bytes:
        """Ids of letters and digits behind at most one space; letters alone are one pre-token, which the model takes as it is."""
        word = self.one_word(piece)
        if word is not None:
            return _packed([token.id for token in self.model.tokenize(word)])
        if not _is_plain(piece):
            raise NotPlain(piece)
        return self._encode(piece)

    def _other_ids(self, piece: str) -> bytes:
        """Ids of any other piece: a plain one with marks behind it takes the ids of both, the rest is encoded as it is."""
        base = piece.rstrip(TAILS)
        if not base or not (base in self.plain or _is_plain(base)):
            return self._encode(piece)
        return self.plain[base] + (self.other[piece[len(base) :]] if len(base) < len(piece) else b"")

    def _spaced_word(self, piece: str) -> str | None:
        """The pre-token of a byte-level pattern that keeps the space before a run of letters; None: not one run."""
        bare = piece.removeprefix(" ")
        if not bare.isalpha():
            return None
        if bare.isascii():
            return self.letters[32] + bare if len(bare) < len(piece) else bare
        return piece.translate(self.letters) if max(bare) < OLD_LETTERS else None

    def _normal_word(self, piece: str) -> str | None:
        """The pre-token of a pattern that drops white space, after the normalizer."""
        bare = piece.removeprefix(" ")
        if not bare.isalpha():
            return None
        if bare.isascii():
            return bare.lower()
        if max(bare) >= OLD_LETTERS or not (bare := self.library.normalizer.normalize_str(bare)).isalpha():
            return None
        return bare.translate(self.letters)

    def _let_go(self) -> None:
        if len(self.plain) > KEPT_PLAIN:  # frequent words are short
            short = [(piece, ids) for piece, ids in self.plain.items() if len(piece) < 11]
            self.plain.clear()
            if len(short) <= KEPT_PLAIN // 2:
                self.plain.update(short)
            self._keep_marks()
        if len(self.other) > KEPT_OTHERS:
            self.other.clear()

    def _keep_marks(self) -> None:
        self.plain.update({"": b""} | {mark: self._encode(mark) for mark in MARKS})


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _words(text: str) -> list[str] | None:
    """A text cut before spaces and around line ends; None where white space is anything but one of them between two words."""
    words = text.split()
    gaps = text.count(" ") + text.count("\n")
    if CUT in text or len(words) != gaps + 1 or sum(map(len, words)) + gaps != len(text):
        return None
    return text.replace(" ", CUT + " ").replace("\n", CUT + "\n" + CUT).split(CUT)


def _is_plain(piece: str) -> bool:
    """Letters and digits behind at most one space, also once normalised and in lower case."""
    bare = piece.removeprefix(" ")
    return bare.isalnum() and unicodedata.normalize("NFC", bare).lower().isalnum()


def _plain_pieces(text: str) -> list[str] | None:
    """A text cut before spaces, commas, full stops and around line ends; None where that is not safe for any of the patterns.

    It is safe if all other pieces are letters and digits and no two marks follow one another.
    """
    if CUT in text or any(pair in text for pair in MARK_PAIRS):
        return None
    for mark in ",.":
        text = text.replace(mark, CUT + mark)
    return text.replace(" ", CUT + " ").replace("\n", CUT + "\n" + CUT).split(CUT)


def _safe_cut(described: dict) -> re.Pattern | None:
    """The pattern of safe pieces for the known kinds of pre-tokenizer; None: encode whole texts."""
    before, normal = described["pre_tokenizer"], described["normalizer"]
    if described["post_processor"] or not before:
        return None
    if before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and not normal:
        return BYTE_LEVEL
    if before["type"] == "Sequence" and normal and normal["type"] == "Sequence":
        split, *rest = before["pretokenizers"]
        drops = split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"] and r"^\s" in json.dumps(split["pattern"]).replace("\\\\", "\\")
        plain = {one["type"] for one in normal["normalizers"]} <= {"NFC", "Replace", "Lowercase"}
        if drops and plain and all(one["type"] == "ByteLevel" and not one["use_regex"] and not one["add_prefix_space"] for one in rest):
            return DROPPING
    return None


def _letters_alone(described: dict) -> bool:
    """Whether any run of letters is one pre-token, whose normal form is its composed lower case."""
    pattern = described["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex", "")
    steps = described["normalizer"]["normalizers"]
    spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    lower = any(step["type"] == "Lowercase" for step in steps)
    return LETTER_RUN in pattern and lower and all(step["type"] != "Replace" or step == spaces for step in steps)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, kept between tasks until another operator's begin."""
    keep_only("encoding")
    KEPT["encoding"] = _let_encoders_go
    return Encoder(path)


def _let_encoders_go() -> None:
    encoder.cache_clear()
    gc.collect()  # an encoder and its pieces refer to one another


def version_digest(path: str) -> str:
    """What token counts depend on besides the text: the bytes of the vocabulary file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()
