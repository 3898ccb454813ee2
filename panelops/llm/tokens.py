"""Tokenizing whole texts with a chunk cache.

A byte-pair tokenizer splits a text into pre-tokens and merges inside each,
so the ids of a text are the ids of its chunks, as long as every chunk border
is a pre-token border. Texts repeat few chunks very often; each distinct
chunk is encoded once by the tokenizers library and looked up afterwards.
``tests/llm/test_tokens.py`` compares the ids with those of whole texts.

Borders used, around every line feed and before every plain space:

* ``word_bpe`` drops white space and never joins across it, so both are
  borders and can be dropped; it folds case, so texts in ASCII are folded first;
* ``byte_bpe`` keeps a space as the first character of the next pre-token
  (`` ?\\p{L}+`` and so on) and a line feed as a pre-token, and only runs of
  white space reach across more than one; a text with such a run is encoded
  whole.

A chunk that is new and plain (ASCII but for the apostrophe and control
characters, and the letters of Latin-1) is cut into its pre-tokens here, and
the library's model merges each of them; any other new chunk goes through the
whole tokenizer, which costs about twice as much. How the tokenizer folds
and maps a plain character is asked of the tokenizer itself.

``encode_special_tokens`` is set: the tokenizer's control strings in a text
are ordinary text.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

from panelops.llm.caches import claim, register

MAX_CACHED = 1_200_000  # about 270 MB in a worker
MAX_CHUNK = 64  # longer chunks are encoded each time, not kept

_RUN = re.compile(r"\s\s")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_OTHERS = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")  # no apostrophe


class ChunkEncoder:
    """One per Python worker and tokenizer file; memory bounded by ``max_cached``.

    The cache maps a chunk to its ids as little-endian u32 bytes.
    """

    def __init__(self, path: str, keeps_space: bool):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.model = self.tok.model
        self.keeps_space = keeps_space
        space, digits = (" ?", "[0-9]+") if keeps_space else ("", "[0-9]")
        self.plain = re.compile(f"(?:{space}[{_LETTERS}0-9{_OTHERS}]+)?")
        self.parts = re.compile(f"{space}(?:[{_LETTERS}]+|{digits}|[{_OTHERS}]+)")
        chars = [c for c in map(chr, range(256)) if self.plain.fullmatch(c)]
        self.mapped = {ord(c): self._map(c) for c in [*chars, *[" "] * keeps_space]}
        self.max_cached = MAX_CACHED
        self.cache: dict[str, bytes] = {}

    def _map(self, char: str) -> str:
        """What the model sees of a plain character."""
        norm = self.tok.normalizer
        folded = norm.normalize_str(char) if norm else char
        return "".join(part for part, _ in self.tok.pre_tokenizer.pre_tokenize_str(folded))

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4")

    def chunks(self, text: str) -> list[str] | None:
        """The chunks of ``text``; None if it is to be encoded whole."""
        if not self.keeps_space:
            folded = text.lower() if text.isascii() else text
            return folded.replace("\n", " ").split(" ")
        if _RUN.search(text) or text[:1].isspace() or text[-1:].isspace() or "\0" in text:
            return None
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def _merge(self, part: str) -> bytes:
        """Ids of a pre-token of plain characters."""
        found = self.model.tokenize(part.translate(self.mapped))
        return array("I", [t.id for t in found]).tobytes()

    def _learn(self, missing: list[str]) -> dict[str, bytes]:
        """Ids of chunks that are not cached; keeps those of usual length."""
        known: dict[str, bytes] = {}
        odd = []
        for c in missing:
            if not self.plain.fullmatch(c):
                odd.append(c)
                continue
            found = []
            for p in self.parts.findall(c):
                ids = known.get(p) or self.cache.get(p)
                if ids is None:
                    ids = known[p] = self._merge(p)
                found.append(ids)
            known[c] = b"".join(found)
        for c, e in zip(odd, self.tok.encode_batch_fast(odd, add_special_tokens=False), strict=True):
            known[c] = array("I", e.ids).tobytes()
        self.cache.update((c, i) for c, i in known.items() if len(c) <= MAX_CHUNK)
        return known

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        parts = self.chunks(text)
        if parts is None:
            return self.whole(text)
        cache = self.cache
        if len(cache) > self.max_cached:
            cache.clear()
        found = list(map(cache.get, parts))
        if None in found:
            known = self._learn([c for c, i in zip(parts, found, strict=True) if i is None])
            found = [known[c] if i is None else i for c, i in zip(parts, found, strict=True)]
        return np.frombuffer(b"".join(found), "<u4")


_ENCODERS: dict[tuple[str, bool], ChunkEncoder] = {}


def encoder(path: str, keeps_space: bool, max_cached: int = MAX_CACHED) -> ChunkEncoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = (path, keeps_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, keeps_space)
        register(f"tokens {key}", _ENCODERS[key].cache)
    claim(f"tokens {key}")
    _ENCODERS[key].max_cached = max_cached
    return _ENCODERS[key]
