"""Byte-level BPE ids of whole texts.

The ids are those of the ``tokenizers`` library for ``byte_bpe_50k.json``; they are made by ``tiktoken`` from the
same vocabulary, which is several times faster, and a test holds the two against each other. As there, a text that
contains one of the vocabulary's added tokens has that token's id; ``added=False`` makes such strings ordinary text, so
that a document can't inject a control token.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from functools import cache

#: White space beside the space and the line feed; a text that has any goes through the plain encoder.
OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
#: Words that one worker remembers.
REMEMBERED = 150_000


class _Words(dict):
    """Ids (as little-endian uint32 bytes) by word with its leading space."""

    def __init__(self, encoding):
        super().__init__()
        self.plain, self.piece = encoding.encode_ordinary, encoding._core_bpe.encode_single_piece

    def __missing__(self, word: str) -> bytes:
        if (word[1:] if word[:1] == " " else word).isalpha():
            ids = array("I", self.piece(word.encode())).tobytes()
        elif word[-1:] in ",." and word[1:-1].isalpha() and (word[0] == " " or word[0].isalpha()):
            ids = self[word[:-1]] + self[word[-1]]
        else:
            ids = array("I", self.plain(word)).tobytes()
        if len(self) < REMEMBERED:
            self[word] = ids
        return ids


@cache
def _words(path: str) -> _Words:
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return _Words(tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))


@cache
def _added(path: str) -> tuple[re.Pattern | None, dict[str, bytes]]:
    """A pattern of the added tokens that the tokenizer's own file lists, and their ids."""
    with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as file:
        listed = {t["content"]: array("I", [t["id"]]).tobytes() for t in json.load(file)["added_tokens"]}
    return re.compile("(" + "|".join(map(re.escape, sorted(listed, key=len, reverse=True))) + ")") if listed else None, listed


def encode(text: str, path: str, added: bool = True) -> bytes:
    """Ids of the whole text as little-endian uint32 bytes."""
    if added:
        pattern, listed = _added(path)
        if pattern and pattern.search(text):
            return b"".join(listed[part] if part in listed else plain(part, path) for part in pattern.split(text) if part)
    return plain(text, path)


def plain(text: str, path: str) -> bytes:
    """Ids of a text without added tokens.

    A single space or line feed between two other characters always ends a pre-token, so such texts are cut there
    and each word is looked up; every other text (runs of white space, other white space) is encoded whole.
    """
    words = _words(path)
    if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or "\0" in text or any(c in text for c in OTHER_SPACE):
        return array("I", words.plain(text)).tobytes()
    return b"".join(map(words.__getitem__, text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")))
