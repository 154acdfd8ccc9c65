"""Token ids of whole texts with a given tokenizer file."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable

CACHE_CHUNKS = 300_000

# Words that the normalizer leaves as they are and the pre-tokenizer does not
# cut: small letters of ASCII and Latin-1.  Of a mix of such letters and digits
# each run of letters and each digit is a word.
_WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
_MIXED = re.compile(b"[a-z0-9]+")
_PARTS = re.compile(b"[a-z]+|[0-9]")
_PROBES = ("a", "the", "walking", "caf\u00e9", "stra\u00dfe", "\u00fcber", "na\u00efve", "zzqxjk", "internationalization")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the rest numbered from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class _Memo(dict):
    """Ids of chunks, filled as chunks are asked for.  When it is full the
    older half is kept aside for one more round, so frequent chunks stay; at
    most ``2 * CACHE_CHUNKS`` are held."""

    def __init__(self, encode: Callable[[bytes], bytes]):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            # a full stop or comma after a letter or digit is a token of its own
            if chunk[-1:] in (b".", b",") and chunk[-2:-1].isalnum():
                ids = self[chunk[:-1]] + self[chunk[-1:]]
            elif not chunk.isalpha() and _MIXED.fullmatch(chunk) and len(chunk) > 1:
                ids = b"".join([self[p] for p in _PARTS.findall(chunk)])
            else:
                ids = self.encode(chunk)
        if len(self) >= CACHE_CHUNKS:
            self.older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


class WordTokenizer:
    """A lower-casing tokenizer whose pre-tokenizer breaks at blanks, line
    ends and between letters and marks.

    The ids of a text are then the ids of its blank-separated chunks, one
    after the other, so each distinct chunk is tokenized once and remembered.
    ``encode`` takes UTF-8 and gives little-endian ids of ``width`` bytes.
    """

    _made: dict[str, WordTokenizer] = {}    # one per worker process and file

    def __init__(self, file: str):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(file)
        self.width = 2 if tokenizer.get_vocab_size() <= 65536 else 4
        kind = "H" if self.width == 2 else "I"
        model, letters = tokenizer.model, _byte_letters()

        def whole(text: str) -> list[int]:
            return tokenizer.encode(text, add_special_tokens=False).ids

        def word(text: str) -> list[int]:
            return [t.id for t in model.tokenize(text if text.isascii() else "".join(letters[b] for b in text.encode()))]
        # a word goes to the model as it is where that gives the same ids
        direct = all(word(p) == whole(p) for p in _PROBES)

        def encode(chunk: bytes) -> bytes:
            text = chunk.decode("utf-8", "replace")
            return array(kind, word(text) if direct and _WORD.fullmatch(text) else whole(text)).tobytes()
        self.known = _Memo(encode)

    @classmethod
    def from_package(cls, name: str) -> Callable[[], WordTokenizer]:
        """Maker for a file of the installed tokenizer folder, found on the
        executor that runs it."""
        def make() -> WordTokenizer:
            import public_tokenizers
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # a task has one core
            file = public_tokenizers.path(name)
            if file not in WordTokenizer._made:
                WordTokenizer._made[file] = WordTokenizer(file)
            return WordTokenizer._made[file]
        return make

    def encode(self, text: bytes) -> bytes:
        # special tokens are matched before the text is lower-cased, so a text
        # that may hold one keeps its capitals here
        low = text if b"<|" in text else text.lower()
        known = self.known
        return b"".join([known[c] for c in low.replace(b"\n", b" ").split(b" ")])
