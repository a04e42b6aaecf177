"""Token ids of whole texts from a public byte-level vocabulary.

``TokenIds`` gives exactly the ids of the vocabulary's own tokenizer (tests compare the two).  Each
text is encoded in one call; nothing is remembered between texts.
"""

from __future__ import annotations

import base64
import json
import sys
from array import array

import public_tokenizers
import tiktoken

END_OF_DOCUMENT = b"\0\0\0\0"


def _byte_of_letter() -> dict[str, int]:
    """The bytes that the letters of a byte-level vocabulary stand for.

    Printable Latin-1 bytes stand for themselves, the others for the code points from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_ranks(path: str) -> dict[bytes, int]:
    """Byte sequences and ids of a ``.tiktoken`` file or of a byte-level ``.json`` file."""
    if path.endswith(".tiktoken"):
        with open(path, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"] for t in content["added_tokens"]}
    letters = _byte_of_letter()
    return {
        bytes(letters[c] for c in token): i
        for token, i in content["model"]["vocab"].items()
        if token not in special
    }


class TokenIds:
    """Encodes texts with the vocabulary at ``path``."""

    _loaded: dict[str, TokenIds] = {}

    def __init__(self, path: str):
        self.encoding = tiktoken.Encoding(
            "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path),
            special_tokens={},
        )

    @classmethod
    def at(cls, path: str) -> TokenIds:
        """The encoder of a path, loaded once per worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers; none if null or empty."""
        if not text:
            return b""
        ids = array("I", self.encoding.encode_ordinary(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()
