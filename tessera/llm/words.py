"""Token ids of whole texts by the tokenizers library, with a bounded memo of words.

The tokenizer normalises (NFC, lower case), cuts words by a pattern and runs its model on
each word alone.  Texts of Latin letters and marks in NFC are lower-cased and cut here by
the same pattern, and each distinct word goes through the library's model once per memo;
any other text goes through the library whole.  Both give the same ids (tested).
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

MEMO_WORDS = 300_000       # words kept per worker
MEMO_CHARS = 64            # longer ones are not kept
LATIN_END = "Ͱ"       # below it, lower-casing depends on the single character only


def _class(kind: str) -> str:
    return "".join(re.escape(c) for c in map(chr, range(ord(LATIN_END))) if unicodedata.category(c)[0] == kind)


#: Fixed value: the pre-tokenizer's pattern (contractions, letters, one digit, other marks).
_SPACE = "\t\n\x0b\x0c\r \x85\xa0"
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^{_SPACE}{_class('L')}{_class('N')}]+")

#: Fixed rule of byte-level models: printable bytes stand for themselves, others for U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_SPELLING = {b: 0x100 + i for i, b in enumerate(b for b in range(0x100) if b not in set(_PRINTED))}


class WordEncoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        if hasattr(self.model, "_resize_cache"):  # the memo below takes its place
            self.model._resize_cache(0)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}

    def _latin(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if max(text) >= LATIN_END or not unicodedata.is_normalized("NFC", text):
                return False
        return not ("<" in text and any(m in text for m in self.marks))

    def _word(self, word: str) -> bytes:
        spelt = word.encode().decode("latin-1").translate(BYTE_SPELLING)
        return array(self.code, [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        plain = [not t or self._latin(t) for t in texts]
        split = [WORDS.findall(t.lower()) if t and p else [] for t, p in zip(texts, plain)]
        seen = set().union(*split)
        missing = seen.difference(self.memo)
        if len(self.memo) + len(missing) > MEMO_WORDS:  # keep what this slice uses
            self.memo = {w: self.memo[w] for w in seen if w in self.memo}
        memo = self.memo
        for w in missing:
            memo[w] = self._word(w)
        out = [b"".join(map(memo.__getitem__, s)) if p else
               array(self.code, self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes()
               for t, s, p in zip(texts, split, plain)]
        for w in missing:
            if len(w) > MEMO_CHARS:
                del memo[w]
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; resolved where it is used."""
    import public_tokenizers
    return public_tokenizers.path(name)
