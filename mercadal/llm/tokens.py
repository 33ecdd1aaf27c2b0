"""Token ids of whole texts, kept small in the hands of the Python workers.

The vocabulary's normaliser and pre-tokeniser treat white space as a border, so
the ids of a text are those of its white-space separated pieces in a row. A
worker remembers the ids of words and pieces it has met: prose repeats its words.

A text of plain letters, digits, signs, blanks and line ends is lower-cased and
split here, by the vocabulary's own rule, and only words new to the worker go to
the vocabulary's BPE model; normalisation leaves such texts as they are
otherwise. Other texts (other scripts, combining marks, control characters, what
may be a special token) go piece by piece, each by the first way if it is plain
and else through the whole tokenizer.
"""

from __future__ import annotations

import os
import re

from tokenizers import Tokenizer, pre_tokenizers

REMEMBERED = 500_000
VOCABULARY = "word_bpe_49k.json"
_encoders: dict[tuple[str, bool], PieceEncoder] = {}

# lower-case letters of plain texts, and the rule of this vocabulary for them
LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
PLAIN = re.compile("[ \n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9 \n]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """How the byte-level step writes the letters beyond ASCII."""
    step = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return {c: step.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}


class Remembered(dict):
    """The values of ``find``, kept until there are too many."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, key: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[key] = self.find(key)
        return value


class PieceEncoder:
    """Ids as little-endian unsigned 16-bit numbers (the vocabulary fits)."""

    def __init__(self, path: str, plain_specials: bool):
        # a task has one core; threads of its own would only wait for each other
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        self.tokenizer.encode_special_tokens = plain_specials
        self.model, self.byte_letters = self.tokenizer.model, byte_letters()
        self.has_own_rule = os.path.basename(path) == VOCABULARY
        self.two_bytes = [i.to_bytes(2, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.words, self.pieces = Remembered(self.word), Remembered(self.piece)

    def word(self, word: str) -> bytes:
        found = self.model.tokenize(word if word.isascii() else word.translate(self.byte_letters))
        return b"".join([self.two_bytes[t.id] for t in found])

    def piece(self, piece: str) -> bytes:
        if self.is_plain(piece):
            return self.plain(piece)
        found = self.tokenizer.encode(piece, add_special_tokens=False)
        return b"".join([self.two_bytes[i] for i in found.ids])

    def is_plain(self, text: str) -> bool:
        return self.has_own_rule and PLAIN.fullmatch(text) is not None and "<|" not in text

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, PARTS.findall(text.lower())))

    def encode(self, texts: list[str]) -> list[bytes]:
        return [
            self.plain(t) if self.is_plain(t) else b"".join(map(self.pieces.__getitem__, t.replace("\n", " ").split(" ")))
            for t in texts
        ]


def encoder(path: str, plain_specials: bool = False) -> PieceEncoder:
    """One encoder per worker process. ``plain_specials``: the strings of the
    special tokens in a text are ordinary text and never give special ids."""
    key = (path, plain_specials)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, plain_specials)
    return _encoders[key]
