"""Token ids of whole texts, with a bounded memory of pieces already encoded.

The tokenizer splits a text into pieces before it merges, and merges never
cross pieces.  Texts of *plain* characters, which every version of the
Unicode tables classes alike, are split here by the published pattern's
rules on whole arrays; the tokenizers library then gives the ids of each
distinct piece once.  Any
other text, and one that holds a special token, is encoded whole by the
library.  Both ways give the library's ids.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np

from claimsmith.llm.common import start_task
from claimsmith.llm.pieces import PieceTable, piece_hashes, piece_starts

BYTE_BPE = "byte_bpe_50k.json"
MEMORY = 1 << 19
LONG = 1 << 18  # characters of a text that are split at a time
CHUNK = 1 << 18  # bytes of text that callers encode at a time

_PLAIN_CHARS = [c for c in map(chr, range(0x20, 0x234)) if unicodedata.category(c)[0] not in "CZ"]


def _class(kind: str) -> str:
    return "".join(re.escape(c) for c in _PLAIN_CHARS if unicodedata.category(c)[0] == kind)


_LETTER, _NUMBER, _SPACE = _class("L"), _class("N"), r"\t\n\r\x20"
_PLAIN = re.compile(f"[{_SPACE}{''.join(map(re.escape, _PLAIN_CHARS))}]*")
_BETWEEN = re.compile(f"(?<=[{_LETTER}]) (?=[{_LETTER}])")


def tokenizer_path(name: str = BYTE_BPE) -> str:
    """Where this machine keeps the vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_splitter() -> Callable[[str], list[str]]:
    """The published pattern, its classes written out for plain characters."""
    import public_tokenizers

    p = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{_SPACE}{_LETTER}{_NUMBER}]")
    p = p.replace(r"\p{L}", f"[{_LETTER}]").replace(r"\p{N}", f"[{_NUMBER}]").replace(r"\S", f"[^{_SPACE}]")
    return re.compile(p.replace(r"\s", f"[{_SPACE}]")).findall


def is_plain(text: str) -> bool:
    return _PLAIN.fullmatch(text) is not None


def stretches(text: str) -> Iterator[str]:
    """A plain text in stretches of about ``LONG`` characters, cut where a piece always ends."""
    lo = 0
    while len(text) - lo > 2 * LONG:
        cut = _BETWEEN.search(text, lo + LONG)
        if not cut:
            break
        yield text[lo:cut.start()]
        lo = cut.start()
    yield text[lo:] if lo else text


class Encoder:
    """``encode_many(texts)``: an id array a text, as the library gives them without added tokens."""

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path or tokenizer_path())
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        (self.line_break,) = self.library.encode("\n", add_special_tokens=False).ids
        self.known = PieceTable(self.dtype, MEMORY)

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all ids): the lines of one text, as a line break ends a piece and has an id of its own."""
        lines = [p for p in pieces if not p.isspace()]
        ids = np.array(self.library.encode_batch_fast(["\n".join(lines)], add_special_tokens=False)[0].ids, self.dtype)
        cut = np.flatnonzero(ids == self.line_break)
        lengths, ids = np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1, np.delete(ids, cut)
        if len(lines) < len(pieces):  # blanks would run into the line breaks
            rest = iter(np.split(ids, np.cumsum(lengths)[:-1]))
            each = [self._whole(p) if p.isspace() else next(rest) for p in pieces]
            lengths, ids = np.array([len(x) for x in each]), np.concatenate(each)
        if len(lengths) != len(pieces):
            raise ValueError("ids of pieces don't match the pieces")
        return lengths, ids

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        self.known.shrink()
        whole = "".join(texts)
        if not whole:
            return []
        code = np.frombuffer(whole.encode("utf-16-le"), "<u2")
        size = np.cumsum([0] + [len(t) for t in texts])
        start = piece_starts(code, size[:-1])
        h = piece_hashes(code, start)
        entry = self.known.find(h)
        unknown = np.flatnonzero(entry < 0)
        if len(unknown):
            new, at = np.unique(h[unknown], return_index=True)
            at = np.sort(unknown[at])  # in the order of the texts: common pieces come first
            stop = np.append(start[1:], len(code))
            lengths, ids = self._learn([whole[a:b] for a, b in zip(start[at].tolist(), stop[at].tolist())])
            self.known.add(h[at], lengths, ids)
            entry[unknown] = self.known.find(h[unknown])
        ids, before = self.known.ids(entry)
        cut = before[np.searchsorted(start, size)]
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids if text else [], self.dtype)

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """One array a text; callers pass about ``CHUNK`` bytes of text, or one longer text, at a time."""
        plain = [bool(t) and is_plain(t) and not any(s in t for s in self.special) for t in texts]
        short = iter(self._encode_plain([t for t, p in zip(texts, plain) if p and len(t) <= 2 * LONG]))
        out = []
        for t, p in zip(texts, plain):
            if not p:
                out.append(self._whole(t))
            elif len(t) <= 2 * LONG:
                out.append(next(short))
            else:
                out.append(np.concatenate([x for stretch in stretches(t) for x in self._encode_plain([stretch])]))
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_many([text])[0]


def encoder(path: str | None = None) -> Encoder:
    """One encoder a worker process."""
    kept = start_task("encoder")
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]
