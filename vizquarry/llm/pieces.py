"""Encoding with the tokenizers library, piece by piece, inside Spark tasks.

Byte-level BPE never merges across what its pre-tokenizer splits. A single space between two characters that are not
white space always goes to what follows, a single line end between two such characters stands alone, and a letter is
split from ASCII marks after it. A text may therefore be cut there, each distinct piece be encoded once, and
the ids be joined again. Tests hold this against whole texts.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array

import numpy as np

#: Two separators in a row, and white space other than space and line end. The last four are white space to Python
#: only; that leaves cuts out and does no harm.
_DOUBLE = ("  ", "\n\n", " \n", "\n ")
_OTHER = tuple("\t\v\f\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000\x1c\x1d\x1e\x1f") + tuple(map(chr, range(0x2000, 0x200B)))
_OTHER_ASCII = tuple(x for x in _OTHER if x.isascii())
#: Pieces that may be encoded together: no white space, and nothing that may begin a special string.
_PLAIN = re.compile(r"[^\s<]+")
#: Marks that are cut from the letter before them; an apostrophe may go with letters, the other may begin a special string.
_MARKS = "".join(x for x in map(chr, range(33, 127)) if not x.isalnum() and x not in "'<")
#: Pieces of one call, and how a byte-level vocabulary writes a space.
TOGETHER, _SPACE = 50, "\u0120"
_CUT = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")
#: Distinct pieces a worker remembers (about 220 bytes each) before it starts afresh.
MEMO = 800_000
_LOADED: dict[str, PieceEncoder] = {}


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and of the library's version: what a stored count depends on."""
    import tokenizers

    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + tokenizers.__version__.encode()).hexdigest()


def cut(text: str) -> list[str]:
    """Pieces; those after the first have lost a space before them unless they start with a line end."""
    other = _OTHER_ASCII if text.isascii() else _OTHER
    if text[:1].isspace() or text[-1:].isspace() or any(x in text for x in _DOUBLE) or any(x in text for x in other):
        return _CUT.split(text)
    return text.replace("\n", " \n").split(" ")


class PieceEncoder:
    """Ids of texts without special tokens added; special strings in a text are treated as the library does."""

    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo = memo
        #: Ids of pieces as the bytes of 32-bit integers.
        self.known: dict[str, bytes] = {}
        #: The same of the first pieces of texts, which no space precedes.
        self.firsts: dict[str, bytes] = {"": b""}
        #: Ids of runs of marks.
        self.ends: dict[str, bytes] = {}
        names = [self.tokenizer.id_to_token(k) or "" for k in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        #: Whether an id begins with a space.
        self.begins = np.array([x.startswith(_SPACE) for x in names], dtype=bool)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found: list[bytes] = []
        for at in range(0, len(texts), 10_000):
            some = self.tokenizer.encode_batch_fast(texts[at : at + 10_000], add_special_tokens=False)
            found.extend(array("I", x.ids).tobytes() for x in some)
        return found

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of plain pieces with a space before each; a piece's ids begin where an id begins with a space."""
        found: list[bytes] = []
        groups = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        for some, raw in zip(groups, self._encoded([" " + " ".join(x) for x in groups])):
            edges = np.flatnonzero(self.begins[np.frombuffer(raw, dtype=np.uint32)]) * 4
            if len(edges) == len(some) and edges[0] == 0:
                edges = [*edges.tolist(), len(raw)]
                found.extend(raw[a:b] for a, b in zip(edges, edges[1:]))
            else:  # a vocabulary of another kind
                found.extend(self._encoded([" " + x for x in some]))
        return found

    def _learn(self, missing: set[str], every: list[str]) -> None:
        """Learn the missing ones of the pieces of a text, or all of them where the memo starts afresh."""
        if len(self.known) + len(missing) > self.memo:
            self.known.clear()
            missing = set(every)
        ended = {}
        for x in missing:
            stem = x.rstrip(_MARKS)
            if len(stem) < len(x) and stem[-1:].isalpha() and "<" not in x:
                ended[x] = stem
        plain = list(missing.difference(ended).union(ended.values()).difference(self.known))
        tails = list({x[len(stem) :] for x, stem in ended.items()}.difference(self.ends))
        if tails:
            if len(self.ends) + len(tails) > self.memo:
                self.ends.clear()
                tails = list({x[len(stem) :] for x, stem in ended.items()})
            self.ends.update(zip(tails, self._encoded(tails)))
        words = list(filter(_PLAIN.fullmatch, plain))
        self.known.update(zip(words, self._spaced(words)))
        other = [x for x in plain if x not in self.known]
        self.known.update(zip(other, self._encoded([x if x[:1] == "\n" else " " + x for x in other])))
        self.known.update((x, self.known[stem] + self.ends[x[len(stem) :]]) for x, stem in ended.items())

    def _parts(self, text: str) -> list[bytes]:
        first, *rest = cut(text)
        found = list(map(self.known.get, rest))
        if None in found:
            self._learn({x for x, ids in zip(rest, found) if ids is None}, rest)
            found = list(map(self.known.__getitem__, rest))
        if first not in self.firsts:
            if len(self.firsts) >= self.memo:
                self.firsts = {"": b""}
            self.firsts[first] = self._encoded([first])[0]
        found.insert(0, self.firsts[first])
        return found

    def count(self, text: str) -> int:
        return sum(map(len, self._parts(text))) // 4

    def ids(self, text: str, end: bytes = b"") -> np.ndarray:
        """The ids of a text, and those of ``end``."""
        parts = self._parts(text)
        parts.append(end)
        return np.frombuffer(b"".join(parts), dtype=np.uint32)


def encoder(path: str) -> PieceEncoder:
    """One encoder for each worker process."""
    if path not in _LOADED:
        _LOADED[path] = PieceEncoder(path)
    return _LOADED[path]
