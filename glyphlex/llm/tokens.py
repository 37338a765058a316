"""Token identifiers by a public tokenizer file, with a word cache in each worker."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

#: Entries of a worker's cache of pieces, which beyond that keeps those of the texts at
#: hand, and of each
#: half of its cache of words: the one in use and the one before it.  Longer pieces are
#: not kept, so the caches are bounded in bytes: some 90 MB in all for usual words.
PIECES, WORDS, LONGEST = 250_000, 200_000, 64
#: Text bytes whose new words are encoded together, and words of one call.
GROUP_BYTES, JOINED = 1 << 20, 500

_SPACE = re.compile(rb"[ \t\n\r\v\f]")
#: A run of plain or Latin-1 letters, and the marks that may follow it: ASCII marks
#: without the apostrophe.
_WORD = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++\Z")
_MARKS = rb"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordEncoder:
    """Identifiers of texts as little-endian unsigned 32-bit numbers.  ``pieces`` has
    those of bytes without white space.

    For tokenizers that drop white space, lower-case, cut words from marks and mark
    the last token of a word: identifiers of a text are then those of its
    white-space-separated pieces in order, a piece of letters followed by marks is
    cut between the two, and many words may be encoded in one call.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[k for t, k in vocabulary.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """Empty the caches."""
        self.pieces: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}  # the half that was in use before

    def end_task(self) -> None:
        """Give up the pieces; the worker keeps the words, which are dear to encode."""
        self.pieces = {}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def learn(self, pieces: set[bytes]) -> None:
        """Identifiers of new pieces; new words are encoded many at a time."""
        if len(self.words) > WORDS:
            self.before, self.words = self.words, {}
        words, before, found, is_word = self.words, self.before, self.pieces, _WORD.match
        waiting, new, marks_of = [], set(), {b"": b""}
        for piece in pieces:
            word = piece.rstrip(_MARKS)
            ids = words.get(word)
            if ids is None and word in before:
                ids = words[word] = before[word]
            if ids is None and (len(piece) > LONGEST or not is_word(word)):
                found[piece] = self.whole(piece.decode())
                continue
            marks = piece[len(word):]
            if marks not in marks_of:
                marks_of[marks] = self.whole(marks.decode())
            if ids is None:
                new.add(word)
                waiting.append((piece, word, marks))
            else:
                found[piece] = ids + marks_of[marks] if marks else ids
        new = list(new)
        for k in range(0, len(new), JOINED):
            part = new[k:k + JOINED]
            got = self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)
            ids = np.array(got[0].ids, "<u4")
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * 4
            if len(ends) != len(part):
                raise ValueError("the tokenizer does not end every word with one marked token")
            raw, ends = ids.tobytes(), ends.tolist()
            words.update(zip(part, map(raw.__getitem__, map(slice, [0, *ends], ends))))
        found.update((piece, words[word] + marks_of[marks] if marks else words[word])
                     for piece, word, marks in waiting)

    def encode_all(self, texts: pa.Array):
        """(row, identifiers) of all texts in order, a long one in several parts that
        are cut at white space; null counts as empty."""
        group: list[tuple[int, bytes | list[bytes]]] = []
        held = row = 0
        for t in texts.cast(pa.large_binary()):
            b = t.as_buffer()
            text = b.to_pybytes() if b is not None else b""
            # special tokens are written in exact case, so such a text is encoded whole
            parts = [text] if b"<|" in text else (p.lower().split() for p in _parts(text))
            for part in parts:
                group.append((row, part))
                held += min(len(text), GROUP_BYTES)
                if held >= GROUP_BYTES:
                    yield from self._group(group)
                    group, held = [], 0
            row += 1
        yield from self._group(group)

    def _group(self, group: list):
        """(row, identifiers) of parts of texts, in order."""
        used = set().union(*(x for _, x in group if isinstance(x, list)))
        if len(self.pieces) > PIECES:  # those in use again stay
            self.pieces = {p: self.pieces[p] for p in used.intersection(self.pieces)}
        pieces = self.pieces
        new = used.difference(pieces)
        if new:
            self.learn(new)
        for row, x in group:
            yield row, b"".join(map(pieces.__getitem__, x)) if isinstance(x, list) else self.whole(x.decode())
        for piece in new:
            if len(piece) > LONGEST:
                del pieces[piece]


def _parts(text: bytes):
    """Pieces of about GROUP_BYTES, cut at white space (all of it is an ASCII byte)."""
    at = 0
    while len(text) - at > GROUP_BYTES:
        end = _SPACE.search(text, at + GROUP_BYTES)
        if not end:
            break
        yield text[at:end.start()]
        at = end.end()
    yield text[at:] if at else text


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
