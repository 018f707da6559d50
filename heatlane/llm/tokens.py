"""Token ids inside tasks.

A vocabulary file is a parameter; a worker process loads it once. The ids are
those of the ``tokenizers`` library for the same vocabulary: byte-level pair
merging by rank is the same computation, and several times faster here (README).
A text with a very long run of white space, on which the faster library's stack overflows, goes to ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256

#: From such a run on a text is encoded by the slower library; the other one fails at some 10^6 characters.
_LONG_GAP = re.compile(r"\s{50000}")


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of an installed public vocabulary, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoder(path: str, special: bool) -> Callable[[str], np.ndarray]:
    """Text to ids. With ``special``, the text of the special token is that
    token; otherwise it is ordinary text."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    model = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})

    def encode(text: str) -> np.ndarray:
        if len(text) >= 50_000 and _LONG_GAP.search(text):
            return np.array(slow_encoder(special).encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        if special and SPECIAL in text:
            return np.array(model.encode(text, allowed_special={SPECIAL}), dtype=np.uint32)
        return np.array(model.encode_ordinary(text), dtype=np.uint32)

    return encode


@lru_cache(maxsize=2)
def slow_encoder(special: bool, name: str = "byte_bpe_50k.json"):
    """The ``tokenizers`` library's encoder for the same vocabulary."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(vocabulary(name))
    made.encode_special_tokens = not special
    return made
