"""Token ids of whole texts inside Python tasks.

A vocabulary file of byte-level BPE gives both the reference encoder (``tokenizers``) and a faster one over
the same ranks; they return the same ids, and tests hold them together. The fast one is used for text, cut
where BPE cannot join across; what it refuses (its pattern engine has a limit on runs) goes to the other.
Control strings of the vocabulary inside a text are ordinary text. Null text has no ids.
"""

from __future__ import annotations

import json
import os
import re
from functools import cached_property, lru_cache

import numpy as np

PIECE = 1 << 16  # characters that are encoded at once, about
# Between words a blank starts a piece of its own, whatever stands before it, so a cut there changes nothing.
CUT = re.compile(r"(?<=[^\s]) (?=[^\s])")


def _bytes_of_vocabulary() -> dict[str, int]:
    """The character that stands for each byte in byte-level BPE files: printable bytes are themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts by a byte-level BPE file of ``tokenizers``."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        vocabulary, added = whole["model"]["vocab"], [t["content"] for t in whole.get("added_tokens", [])]
        self.size = 1 + max([*vocabulary.values(), *(t["id"] for t in whole.get("added_tokens", []))])
        as_byte = _bytes_of_vocabulary()
        ranks = {bytes(as_byte[c] for c in word): i for word, i in vocabulary.items() if word not in added}
        # the pattern that byte-level BPE files name by ``use_regex``
        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def exact(self):
        """The reference encoder; most tasks never load it."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        reference = Tokenizer.from_file(self.path)
        reference.encode_special_tokens = True
        return reference

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit numbers."""
        if len(text) <= PIECE:
            return self._piece(text)
        parts, start = [], 0
        while start < len(text):
            cut = CUT.search(text, start + PIECE) if start + PIECE < len(text) else None
            stop = cut.start() if cut else len(text)
            parts.append(self._piece(text[start:stop]))
            start = stop
        return np.concatenate(parts)

    def _piece(self, text: str) -> np.ndarray:
        try:
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        except BaseException as refused:  # a panic of the native library is no Exception
            if isinstance(refused, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def default_vocabulary() -> str:
    """The installed byte-level file that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
