"""Token ids of whole texts, for operators that pack or align tokens.

A byte-level BPE file is read once on the driver and handed to the tasks as a
plain table of byte strings. Very long texts are encoded in pieces, cut before
a single blank between two ASCII letters: there every pre-token ends, so the
ids of the pieces, one after the other, are those of the whole text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from .bpe_lexicon import PATTERN, byte_letters

PIECE = 1 << 20
SAFE_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


def word_parts(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about ``size`` characters; every piece but the first starts with a blank."""
    at = 0
    while at < len(text):
        cut = SAFE_CUT.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def byte_bpe(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(ranks, special tokens) of a byte-level BPE file whose ids follow the order of its merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    ids = [vocab[a + b] for a, b in merges]
    if any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
        raise ValueError(f"ids of {path} do not follow its merges")
    return ranks, special


def encoder(ranks: dict[bytes, int], special: dict[str, int]):
    """Encodes with the ranks; to be built in the task."""
    import tiktoken

    return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
