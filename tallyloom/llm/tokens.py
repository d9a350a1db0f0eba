"""Ids of the public byte-level vocabulary.

``tokenizers`` defines the ids. Texts over the Latin range are encoded with the
same ranks by ``tiktoken``, which is several times faster; texts with other
characters, with the text of a special token or with very long words go to
``tokenizers`` itself. A test holds the two against each other.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Callable, Sequence

import numpy as np

VOCABULARY = "byte_bpe_50k"
END_ID = 0

#: Latin letters, digits, signs and plain white space, in which both libraries see one pattern.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")
_LONG = re.compile(r"[^\s]{400}|\s{400}")


def vocabulary_path(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@functools.lru_cache(maxsize=2)
def encoder(json_path: str | None = None, ranks_path: str | None = None) -> Callable[[str], Sequence[int]]:
    """A function from text to ids, one for each Python worker."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path or vocabulary_path(f"{VOCABULARY}.json"))
    with open(ranks_path or vocabulary_path(f"{VOCABULARY}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain, long, ordinary = _PLAIN.fullmatch, _LONG.search, fast.encode_ordinary

    def encode(text: str) -> Sequence[int]:
        if plain(text) and "<|" not in text and not long(text):
            return ordinary(text)
        return slow.encode(text, add_special_tokens=False).ids

    return encode


def document_ids(encode: Callable[[str], Sequence[int]], text: str | None) -> np.ndarray:
    """The ids of a document, NULL as empty, with the id 0 that ends it."""
    ids = encode(text) if text else []
    out = np.empty(len(ids) + 1, np.uint32)
    out[:-1] = ids
    out[-1] = END_ID
    return out
