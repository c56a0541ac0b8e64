"""Token ids of whole texts by a byte-level BPE file of the ``tokenizers``
library, fast enough for corpus passes.

BPE never merges across the pieces its splitting pattern makes, so the ids of
a text are the ids of its pieces in order. In plain text (words divided by
single spaces and line ends) every space starts a piece, so words can be
looked up one by one; each worker remembers the ids of words it has seen
(bounded), and only new words are encoded. Other texts are split by the
pattern itself; texts with characters outside the blocks where the Unicode
tables of the libraries are known to agree, or with a special token's string,
go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

import numpy as np
import regex

# The public splitting pattern of byte-level BPE, and the
# characters (Latin, Greek, Cyrillic, general punctuation) whose classes have not changed.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
UNSAFE = re.compile("[^\\x09\\x0a\\x0d\\x20-\\x7e¡-ɏΑ-ΡΣ-Ωα-ωА-я"
                    "‐-—‘-„…]")


_UINT = array("I")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level BPE files write for bytes: printable ones
    stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _merge_core(path: str):
    """A faster merger of single pieces with the file's own vocabulary, if its
    merges are ranked by id (then rank and id are the same order); else None."""
    import tiktoken
    model = json.load(open(path, encoding="utf-8"))["model"]
    vocab, letters = model.get("vocab", {}), _byte_letters()
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model.get("merges", [])]
    if not merged or None in merged or merged != sorted(merged):
        return None
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if all(c in letters for c in t)}
    ranks = {t: i for t, i in ranks.items() if len(t) == 1 or i >= merged[0]}
    if len(ranks) != len(merged) + 256:
        return None
    return tiktoken.Encoding("pieces", pat_str=PIECE.pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe


def _bytes(ids: list[int]) -> bytes:
    if sys.byteorder == "little" and _UINT.itemsize == 4:
        return array("I", ids).tobytes()
    return np.array(ids, "<u4").tobytes()


def _plain(text: str) -> bool:
    """Whether the text is words divided by single spaces and line ends."""
    return not any(s in text for s in ("  ", " \n", "\n ", "\n\n", "\t", "\r")) and text[-1:] != " "


class PieceIds(dict):
    """text -> little-endian uint32 ids, remembered for up to ``limit`` texts
    of at most 64 characters, then afresh."""

    limit = 500_000

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, text: str) -> bytes:
        ids = self.encode(text)
        if len(text) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[text] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.core = _merge_core(path)
        pieces = PieceIds(self._piece)
        self.pieces = pieces.__getitem__
        # words after a space, and at the start of a line
        self.spaced = PieceIds(lambda w: self._word(w, " " + w)).__getitem__
        self.bare = PieceIds(lambda w: self._word(w, w)).__getitem__

    def _word(self, word: str, text: str) -> bytes:
        if word.isalpha():  # one piece
            return self._piece(text)
        return b"".join(map(self.pieces, PIECE.findall(text)))

    def _piece(self, piece: str) -> bytes:
        if self.core is not None and len(piece) < 500:
            return _bytes(self.core.encode_single_piece(piece.encode()))
        return self._whole(piece)

    def _whole(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian uint32 bytes."""
        if UNSAFE.search(text) or (self.special and self.special.search(text)):
            return self._whole(text)
        if not _plain(text):
            return b"".join(map(self.pieces, PIECE.findall(text)))
        lines, spaced, bare = [], self.spaced, self.bare
        for line in text.split("\n"):
            words = line.split(" ")
            words[1:] = map(spaced, words[1:])
            words[0] = bare(words[0]) if words[0] else b""
            lines.append(b"".join(words))
        return self.pieces("\n").join(lines)

    def count(self, text: str) -> int:
        return len(self.ids(text)) // 4


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))
