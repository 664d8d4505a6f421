"""Byte-level BPE of whole texts at a speed that suits large inputs.

``Encoder`` gives exactly the ids of the tokenizers library. Latin texts are encoded by
tiktoken with the ranks of the same vocabulary. Other texts are cut where the library's
pre-tokenizer must cut, whatever stands around: before one space followed by a visible
character; runs of parts with other letters go to the tokenizers library itself, and so
does any text that holds a special token's string.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
from array import array

import numpy as np

_RARE_SPACE = re.compile("[^\\S\n ]")
_TWO_SPACES = ("  ", "\n\n", " \n", "\n ")
_PIECE = re.compile(r"(?= \S)")
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")
# Fixed value: the pattern of this pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same language where no two spaces stand together; without look-ahead it runs faster.
SINGLE_SPACED = r"""'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""


def default_tokenizer() -> str:
    """The public byte-level BPE vocabulary of this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: visible Latin-1 stands for itself, other bytes follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """ids(text): NumPy array of token ids; text_bytes(ids): what the library's decode gives, in UTF-8.

    With ``plain``, special tokens' strings in a text are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        spec = json.load(open(path, encoding="utf-8"))
        vocab = spec["model"]["vocab"]
        self.special = [] if plain else [t["content"] for t in spec["added_tokens"]]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        letters = byte_letters()
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for t in spec["added_tokens"]:
            self.bytes_of[t["id"]] = t["content"].encode()
        self.numbers = [str(i) for i in range(size)]
        self.full, self.single = self._ranked(spec)

    def _ranked(self, spec: dict):
        """tiktoken over the same vocabulary, if ids rise in the order of merges as its ranks must."""
        import tiktoken

        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        ids = [vocab["".join(m)] for m in pairs]
        single = [i for t, i in vocab.items() if len(t) == 1]
        pre = spec["pre_tokenizer"]
        if any(a >= b for a, b in zip(ids, ids[1:])) or (ids and max(single) > ids[0]) or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec["normalizer"]:
            return None, None
        ranks = {self.bytes_of[i]: i for i in vocab.values()}
        made = (tiktoken.Encoding("ranked", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (PATTERN, SINGLE_SPACED))
        return tuple(e._core_bpe.encode_ordinary for e in made)

    def _whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _latin(self, text: str) -> list[int]:
        spaced = any(s in text for s in _TWO_SPACES) or _RARE_SPACE.search(text)
        return (self.full if spaced else self.single)(text)

    def _runs(self, text: str):
        """Runs of parts that are all Latin or all not."""
        for other, parts in itertools.groupby(_PIECE.split(text), lambda p: bool(_BEYOND_LATIN.search(p))):
            yield other, "".join(parts)

    def encoded(self, text: str | None) -> bytes:
        """Little-endian ids; null is an empty text."""
        if not text:
            return b""
        if self.full is None or any(s in text for s in self.special):
            ids = self._whole(text)
        elif _BEYOND_LATIN.search(text):
            ids = [i for other, run in self._runs(text) for i in (self._whole if other else self._latin)(run)]
        else:
            ids = self._latin(text)
        return array(self.code, ids).tobytes()

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encoded(text), self.dtype)

    def text_bytes(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text; broken sequences become U+FFFD as in the library."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").encode()

    def decimals(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        return ",".join(map(self.numbers.__getitem__, ids.tolist())).encode()


@functools.lru_cache(2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder a Python worker."""
    return Encoder(path, plain)
