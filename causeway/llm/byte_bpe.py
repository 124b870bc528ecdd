"""Byte-level BPE by the tokenizers library with a cache of words.

The library's pre-tokenizer starts a new piece at a single blank between two
characters that are no white space, makes a single line end between such a
piece of its own, and its merges never cross pieces. So the ids of a text are
those of its words, and only words not seen before go through the library.
Everything else (runs of blanks, other white space beside a blank) stays inside
a word and is left to the library.
"""

from __future__ import annotations

import re
from itertools import compress
from operator import not_

import numpy as np
from tokenizers import Tokenizer

from .common import kept

# A blank at which any text may be cut: printable ASCII or a letter or digit on either side.
SAFE = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
# Words a worker keeps. Frequent words come early; those beyond are encoded again in each call that has them.
CACHE_WORDS = 700_000
# New words that go through the library at once.
WORDS_A_CALL = 512
# White space besides blanks and line ends.
ASCII_SPACES = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
OTHER_SPACES = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def is_plain(text: str) -> bool:
    """Is all white space single blanks and line ends, each with something else on either side?"""
    return not (text[:1] in (" ", "\n") or text[-1:] in (" ", "\n") or "  " in text or " \n" in text or "\n " in text
                or "\n\n" in text or any(c in text for c in ASCII_SPACES)
                or not text.isascii() and any(c in text for c in OTHER_SPACES))


class ByteBpe:
    """Ids as little-endian 2-byte integers."""

    def __init__(self, model: str):
        self.tokenizer = Tokenizer.from_str(model)
        size = self.tokenizer.get_vocab_size()
        if size > 1 << 16:
            raise ValueError(f"{size} ids do not fit into 2 bytes")
        self.opens = np.zeros(1 << 16, bool)  # ids whose piece begins with a blank
        for piece, i in self.tokenizer.get_vocab().items():
            self.opens[i] = piece.startswith("Ġ")
        self.line_end = int(self._ids("\n")[0])
        # By word: the ids after a blank; a word with a line end before it stands for both.
        self.known: dict[str, bytes] = {}

    @classmethod
    def shared(cls, model: str) -> ByteBpe:
        """One coder for each Python worker and model, so that later tasks find the words of earlier ones."""
        return kept(("ByteBpe", model), lambda: cls(model))

    def _plain(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _ids(self, text: str) -> np.ndarray:
        """Ids without the offsets that the library's plain call also makes."""
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2")

    def _learn(self, words: list[str], mark: str) -> None:
        """Encode new words, each after ``mark``, some to a call; the marks tell them apart again."""
        for at in range(0, len(words), WORDS_A_CALL):
            some = words[at:at + WORDS_A_CALL]
            ids = self._ids(mark + mark.join(some))
            starts = np.flatnonzero(self.opens[ids] if mark == " " else ids == self.line_end)
            keys = some if mark == " " else [mark + w for w in some]
            if len(starts) == len(some):
                data, ends = ids.tobytes(), np.append(starts[1:], len(ids))
                for k, a, b in zip(keys, (2 * starts).tolist(), (2 * ends).tolist()):
                    self.known[k] = data[a:b]
            else:  # a word with such a mark inside
                for k, w in zip(keys, some):
                    self.known[k] = self._plain(mark + w)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        units: list[str] = []
        bounds, first = [0], []
        for t in texts:
            if is_plain(t):
                units += ("\n" + t).replace("\n", " \n")[1:].split(" ") if t else []
                first.append(b"")
            else:
                head, *rest = SAFE.split(t)
                units += rest
                first.append(self._plain(head))
            bounds.append(len(units))
        known = self.known
        found = list(map(known.get, units))
        missing = list(compress(range(len(units)), map(not_, found)))
        if missing:
            new = list(dict.fromkeys(map(units.__getitem__, missing)))
            self._learn([w for w in new if w[:1] != "\n"], " ")
            self._learn([w[1:] for w in new if w[:1] == "\n"], "\n")
            for i in missing:
                found[i] = known[units[i]]
            if len(known) > CACHE_WORDS:
                for w in new:
                    del known[w]
        # A text of the plain kind began with a line end that is not its own.
        return [f + b"".join(found[a:b])[0 if f else 2:] for f, a, b in zip(first, bounds, bounds[1:])]
