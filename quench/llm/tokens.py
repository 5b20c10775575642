"""Whole-text tokenizer ids at corpus speed.

Both vocabularies split a text before BPE, and a lone space or line break always
ends a piece. Texts are therefore cut before those and the ids of each unit are
cached (bounded) as little-endian unsigned 32-bit bytes; new units are cut further
into pre-token pieces where that is safe, and the tokenizers library encodes each
new piece once while the piece cache holds it. A text in which a space or line break
touches other white space (where cutting could change pre-tokens), or that holds the string of
an added token such as ``<|endoftext|>`` (which the library gives its own id), is encoded whole.
"""

from __future__ import annotations

import os
import re
import struct
import sys
from collections.abc import Callable

import numpy as np

from quench.llm.common import sole_cache

_LETTERS = r"A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: Texts of these characters have one-to-one lower case and no composing marks.
_SAFE = re.compile(rf"[\x00-\x7f{_LETTERS}]*")
_RARE_SPACES = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c not in " \n"]
_SPACE_RUN = re.compile(r"\s[ \n]|[ \n]\s|\A ")
_WS = r" \t\n\r\f\v"
_CONTRACTION = "'s|'t|'re|'ve|'m|'ll|'d"
_PIECES = {
    "byte": re.compile(rf"{_CONTRACTION}| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_WS}{_LETTERS}0-9]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"),
    "word": re.compile(rf"{_CONTRACTION}|[{_LETTERS}]+|[0-9]|[^{_WS}{_LETTERS}0-9]+"),
}

#: Byte-level vocabularies write a byte that is no printable Latin-1 character as the next one from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class _Units(dict):
    """Ids by unit, at most ``most``; a unit that is not there is encoded as it is asked for."""

    def __init__(self, encode: Callable[[str], bytes], most: int):
        self.encode, self.most = encode, most

    def __missing__(self, unit: str) -> bytes:
        if len(self) > self.most:
            self.clear()
        ids = self[unit] = self.encode(unit)
        return ids


class Encoder:
    """``encode(texts)`` gives each text's ids as ``<u4`` bytes. ``kind``: "byte" keeps white space
    (byte_bpe files), "word" drops it and ignores case (word_bpe files)."""

    def __init__(self, path: str, kind: str, units: int = 450_000, pieces: int = 900_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind, self.most_units, self.most_pieces = kind, units, pieces
        self.units: dict[str, bytes] = _Units(self._ids_of_unit, units) if kind == "byte" else {}
        self.pieces: dict[str, bytes] = {}
        self.young: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}  # a text's first unit, which no space precedes

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of_piece(self, piece: str) -> bytes:
        """Ids of a pre-token piece (byte kind): the library's BPE model takes byte-level pieces as they are."""
        ids = self.pieces.get(piece) or self.young.get(piece)
        if ids is not None:
            return ids
        if piece.isascii() and piece.isprintable():
            ids = self._model_ids(piece.replace(" ", _BYTE_CHARS[32]))
        elif _SAFE.fullmatch(piece):
            ids = self._model_ids(piece.encode().decode("latin-1").translate(_BYTE_CHARS))
        else:
            ids = self._library([piece])[0]
        # The first pieces met are the frequent ones and stay; later ones take turns in a smaller cache.
        if len(self.pieces) < self.most_pieces:
            self.pieces[piece] = ids
        else:
            if len(self.young) > self.most_pieces // 4:
                self.young.clear()
            self.young[piece] = ids
        return ids

    def _model_ids(self, chars: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(chars)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ids_of_unit(self, part: str) -> bytes:
        unit = part if part[:1] == "\n" else " " + part
        if part.isascii() and part.isalpha():
            return self._ids_of_piece(unit)
        return b"".join(map(self._ids_of_piece, self._cut(unit)))

    def _cut(self, unit: str) -> list[str]:
        if not unit.isascii() and not _SAFE.fullmatch(unit):
            return [unit]
        return _PIECES[self.kind].findall(unit.lower() if self.kind == "word" else unit)

    def _learn(self, parts: set[str]) -> None:
        """Ids of new units (word kind): their new pieces go to the library at once."""
        cut = {p: self._cut(p) for p in parts}
        known, young = self.pieces, self.young
        new = [p for p in {p for ps in cut.values() for p in ps}.difference(known) if p not in young]
        # As in _ids_of_piece.
        if len(known) >= self.most_pieces and len(young) > self.most_pieces // 4:
            new = list({p for ps in cut.values() for p in ps}.difference(known))
            young.clear()
        target = known if len(known) < self.most_pieces else young
        for at in range(0, len(new), 4096):
            target.update(zip(new[at:at + 4096], self._library(new[at:at + 4096])))
        for u, ps in cut.items():
            self.units[u] = b"".join([known[p] if p in known else young[p] for p in ps])

    def _runs(self, text: str) -> bool:
        """Whether a space or line break touches other white space (or starts the text)."""
        if any(c in text for c in _RARE_SPACES):
            return _SPACE_RUN.search(text) is not None
        return "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] == " "

    def encode(self, text: str) -> bytes:
        if any(t in text for t in self.added):  # they cut a text anywhere
            return self._library([text])[0]
        if self.kind == "word":
            parts = text.replace("\n", " ").split(" ")
            new = set(parts).difference(self.units)
            if new:
                if len(self.units) > self.most_units:
                    self.units.clear()
                    new = set(parts)
                self._learn(new)
            return b"".join(map(self.units.__getitem__, parts))
        if self._runs(text):
            return self._library([text])[0]
        first, *parts = text.replace("\n", " \n").split(" ")
        head = self.heads.get(first)
        if head is None:
            if len(self.heads) > self.most_units // 4:
                self.heads.clear()
            head = self.heads[first] = b"".join(self._library(self._cut(first)))
        return head + b"".join(map(self.units.__getitem__, parts))


_LOADED: dict[tuple, Encoder] = {}


def encoder(path: str | None, kind: str) -> Encoder:
    """This process's encoder for a vocabulary file; None: the public file of that kind."""
    sole_cache("tokens", _LOADED.clear)
    key = (path, kind)
    if key not in _LOADED:
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path({"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}[kind])
        _LOADED[key] = Encoder(path, kind)
    return _LOADED[key]
