"""Token ids of whole texts by a public tokenizer file, as little-endian uint32 bytes.

The tokenizer lower-cases, drops white space and splits a text into pieces (letter runs,
single digits, other runs, English contractions) that its BPE encodes one by one, so
the ids of a piece never depend on its neighbours.  Ids of pieces are kept in a bounded
memo; a piece that isn't there goes through the tokenizer's own model.  Texts with
characters beyond Latin-1 are encoded by the tokenizer as a whole, since its
normalisation may then reach across characters.  Both ways give equal ids (tested).
"""

from __future__ import annotations

import os
import re

import numpy as np

TOKENIZER = "word_bpe_49k.json"
MEMO_PIECES = 100_000  # some 10 MB a worker, which stays between tasks

# fixed values: the pre-tokenizer's pattern, for lower-cased Latin-1 text
_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d"
    "|[a-zªµºß-öø-ÿ]+"
    "|[0-9²³¹¼-¾]"
    "|[^\\t-\\r \\x85\\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+"
)


def byte_letters() -> dict[int, str]:
    """The usual byte-level alphabet: printable bytes stand for themselves, the others for U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class TokenCoder:
    """Encodes texts; ``path`` is the tokenizer file (default: the public package's)."""

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = {chr(b): c for b, c in byte_letters().items()}
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        outer = self

        class Memo(dict):
            def __missing__(self, piece):
                if len(self) >= MEMO_PIECES:
                    self.clear()
                ids = self[piece] = outer.piece(piece)
                return ids

        self.memo = Memo()

    def piece(self, piece: str) -> bytes:
        letters = "".join(map(self.letters.__getitem__, piece.encode("utf-8").decode("latin-1")))
        return np.array([t.id for t in self.model.tokenize(letters)], "<u4").tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.whole(text)
        if any(s in text for s in self.specials):
            return self.whole(text)
        return b"".join(map(self.memo.__getitem__, _PIECES.findall(text.lower())))


_coders: dict[str | None, TokenCoder] = {}


def coder(path: str | None = None) -> TokenCoder:
    """One per Python worker and file."""
    if path not in _coders:
        _coders[path] = TokenCoder(path)
    return _coders[path]
