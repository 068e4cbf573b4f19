"""The public tokenizers inside tasks, and where their segmentation of a text is certain."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable

import numpy as np

SLICE_BYTES = 1 << 20  # an encoded text takes tens of times its size


def per_worker(key: tuple, make: Callable):
    """What ``make`` returns, made once in the life of a Python worker, which serves many tasks.

    Functions travel by value, so a global of this module would be made anew in every task.
    """
    state = sys.modules.setdefault("_docloom_worker", types.ModuleType("_docloom_worker")).__dict__
    if key not in state:
        state[key] = make()
    return state[key]


def load(name: str):
    """The tokenizer of a vocabulary file: a path, or the name of a file of ``public_tokenizers``."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"

    def make():
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    return per_worker(("tokenizer", name), make)


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin characters stand for their own bytes, and those from U+0100 on, in order, for the
    rest.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in own)}
    return [out[b] for b in range(256)]


def guard(tokenizer) -> int:
    """Characters before a cut within which the cut may change how the text is split.

    The pattern of the byte-level vocabulary decides a split by at most two characters beyond it,
    and a special string counts only when it is whole. A split further from the cut is certain.
    """
    longest = max((len(t.content) for t in tokenizer.get_added_tokens_decoder().values()), default=0)
    return longest + 3


def split_points(encoding) -> tuple[np.ndarray, np.ndarray]:
    """Character and token index where each piece begins that the merges never cross."""
    words = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    tokens = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
    offsets = encoding.offsets
    return np.array([offsets[i][0] for i in tokens.tolist()], np.int64), tokens
