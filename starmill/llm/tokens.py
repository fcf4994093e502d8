"""Token ids of whole texts with a public tokenizer, as bytes.

The tokenizer drops white space, lower-cases, and reads runs of letters, digits and marks apart,
so the ids of a text are the ids of these runs one after the other.  Runs repeat: each task keeps
the ids of the runs it has seen, in a store that is emptied when full.  Only plain text is cut
this way; a word that holds any other character goes to the tokenizer whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np

MOST_RUNS = 700_000
_CHARS_AT_ONCE = 1_000_000
# Plain text: letters that the tokenizer lower-cases as Python does, digits, marks.  No apostrophe,
# which may begin a contraction, and no "<", which may begin a special token.
_UNUSUAL = re.compile(r"[^ \t\n\rA-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:;=-@\[-`{-~]")
_OTHER = re.compile(rf"[^ \t\n\r]*{_UNUSUAL.pattern}[^ \t\n\r]*")
_RUNS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+")
_MARKS = re.compile(r"[!-&(-/:;=-@\[-`{-~]{2}")
_WORD = re.compile(r"[a-zß-öø-ÿ]+")
_APART = " . "


class Encoder:
    """Ids of texts, little-endian unsigned 32-bit."""

    def __init__(self, path: str, special: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.mark = self.tokenizer.encode(_APART, add_special_tokens=False).ids[0]
        self.known: dict[str, bytes] = {}

    def texts(self, texts: Iterable[str]) -> Iterator[bytes]:
        waiting, size = [], 0
        for text in texts:
            waiting.append(_runs(text))
            size += len(text)
            if size >= _CHARS_AT_ONCE:
                yield from self._of(waiting)
                waiting, size = [], 0
        yield from self._of(waiting)

    def _of(self, texts: list[list[str]]) -> Iterator[bytes]:
        new = set(chain.from_iterable(filterfalse(self.known.__contains__, runs) for runs in texts))
        if len(self.known) + len(new) > MOST_RUNS:
            self.known, new = {}, set(chain.from_iterable(texts))
        self._learn(new)
        for runs in texts:
            yield b"".join(map(self.known.__getitem__, runs))

    def _learn(self, new: set[str]) -> None:
        words = [run for run in new if _WORD.fullmatch(run)]
        if words:
            joined = self.tokenizer.encode_batch_fast([_APART.join(words)], add_special_tokens=False)[0].ids
            ids = np.array(joined, dtype="<u4")
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids)).tolist()
            data = ids.tobytes()
            self.known.update(
                (word, data[4 * (a + 1) : 4 * b]) for word, a, b in zip(words, [-1, *ends[:-1]], ends, strict=True)
            )
        for run in new:
            if run not in self.known:
                self.known[run] = self.whole(run)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def _runs(text: str) -> list[str]:
    if not _UNUSUAL.search(text):
        return _plain(text)
    runs, at = [], 0
    for other in _OTHER.finditer(text):
        runs += _plain(text[at : other.start()])
        runs.append(other[0])
        at = other.end()
    return runs + _plain(text[at:])


def _plain(text: str) -> list[str]:
    """Runs of plain text; without adjacent marks, words with their marks set apart are runs enough."""
    text = text.lower()
    if _MARKS.search(text):
        return _RUNS.findall(text)
    return text.replace(".", " . ").replace(",", " , ").split()


@lru_cache(maxsize=4)
def encoder(path: str, special: bool = True) -> Encoder:
    return Encoder(path, special)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_bytes(texts: Iterable[str], path: str, special: bool = True) -> Iterator[bytes]:
    """The ids of each text, little-endian unsigned 32-bit; none are added.

    With ``special`` the names of special tokens in a text become their ids, else ordinary text.
    """
    return encoder(path, special).texts(texts)
