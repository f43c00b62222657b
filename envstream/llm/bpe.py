"""Byte-level BPE with the tokenizers library, a text's repeated chunks encoded once.

The library's splitting rule never lets a piece go on over the beginning of a
run of white space, so a text's tokens are those of its chunks (a run of white
space and what follows), one after the other. Each worker keeps the chunks it
has met, up to ``CACHE`` of them. A new chunk of plain words (Latin letters,
punctuation behind them, single line ends between) is cut into its pieces here,
and the library's BPE model merges each word; all other chunks go through the
whole library, and special strings inside them are its to find.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from operator import attrgetter

from envstream.llm.common import cache_of

CACHE = 200_000
MODEL = "byte_bpe_50k.json"

_SPACE = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_ID = attrgetter("id")
_ODD_SPACES = re.compile(r"\s ")
#: Letters for any version of Unicode, then ASCII that is neither letter, digit nor space.
_LINE = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+)([!-/:-@\[-`{-~]*)")


def model_path(name=MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Known(dict):
    """Chunks and their ids. Full, it starts anew and takes over from the full one
    what comes again, so frequent chunks stay and memory is bounded by two of them."""

    def __init__(self, limit, encode):
        super().__init__()
        self._limit, self._encode, self._before = limit, encode, {}

    def __missing__(self, chunk):
        ids = self._before.get(chunk)
        if ids is None:
            ids = self._encode(chunk)
        if len(self) >= self._limit:
            self._before = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


class ChunkedBpe:
    def __init__(self, file: str, cache=CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self._library = Tokenizer.from_file(file)
        self._model = self._library.model
        # Chunks behind one space; others; what stands behind their words.
        self._spaced = _Known(cache, lambda c: self._encoded(" ", c))
        self._whole = _Known(cache, lambda c: self._encoded("", c))
        self._tails = _Known(cache, lambda c: self._merged(c.translate(self._bytes)))
        # A rule of splitting other than the byte-level one proves nothing.
        written = self._library.to_str()
        self._chunks = '"ByteLevel"' in written[:20_000]
        self._pieces = _splits_as_known(json.loads(written))
        byte_of = ByteLevel(add_prefix_space=False, use_regex=False)
        self._bytes = {i: byte_of.pre_tokenize_str(chr(i))[0][0]
                       for i in (10, 32, *range(0xC0, 0x250))}
        self._space = self._bytes[32]

    def _merged(self, piece):
        """The ids of one piece, written as bytes' letters."""
        return array("I", map(_ID, self._model.tokenize(piece))).tobytes()

    def _word(self, prefix, word, known):
        ids = known.get(word)
        if ids is None:
            ids = self._merged(prefix + (word if word.isascii() else word.translate(self._bytes)))
        return ids

    def _encoded(self, prefix, chunk):
        if not self._pieces or "<|" in chunk:
            return self._by_library(prefix + chunk)
        if chunk.isascii() and chunk.isalpha():  # most are, and this is the shortest way
            return self._merged(self._space + chunk if prefix else chunk)
        known, before, out = (self._spaced if prefix else self._whole), prefix, []
        for line in chunk.split("\n"):
            found = _LINE.fullmatch(line)
            if not found:
                return self._by_library(prefix + chunk)
            if out:
                out.append(self._tails["\n"])
            word, marks = found.groups()
            out.append(self._word(before and self._space, word, known))
            if marks:
                out.append(self._tails[marks])
            known, before = self._whole, ""
        return b"".join(out)

    def _by_library(self, text):
        # Its own batch call is the fast one, also for a single text.
        found, = self._library.encode_batch_fast([text], add_special_tokens=False)
        return array("I", found.ids).tobytes()

    def encode(self, texts):
        """Each text's ids as unsigned 32-bit integers of this machine, in bytes."""
        after, alone = self._spaced.__getitem__, self._whole.__getitem__
        for text in texts:
            if not self._chunks:
                yield self._by_library(text)
            elif _ODD_SPACES.search(text):
                yield b"".join(map(alone, _CHUNK.findall(text)))
            else:
                first, *rest = text.split(" ")
                yield alone(first) + b"".join(map(after, rest))


def _splits_as_known(written: dict) -> bool:
    """Whether text goes to the model unchanged, cut by the byte-level rule alone,
    and no special string could lie in a chunk without "<|"."""
    splitter, model = written.get("pre_tokenizer") or {}, written["model"]
    return (
        not written.get("normalizer")
        and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space") and model.get("type") == "BPE"
        and not model.get("dropout")
        and all("<|" in t["content"] and not t["lstrip"] for t in written["added_tokens"]))


def bpe(file: str) -> ChunkedBpe:
    models = cache_of("bpe")
    if file not in models:
        models[file] = ChunkedBpe(file)
    return models[file]
