"""Exact, cached encoding with a tokenizer file.

The byte-level pattern never joins a space that stands before a visible character to what is
left of it, so a text can be cut there, each part be encoded alone, and the ids be put
together again. Most parts are words that occur again and again; a bounded cache per worker
process holds them. New words in Latin letters are merged by a second library from the same
vocabulary, which is several times faster where the order of merges is that of the ids;
everything else goes through the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np

#: A cut: a space before anything but white space or the start of a special token.
_CUT = re.compile(r" (?=[^\s<])")
#: Words both libraries split by the same rule: no special tokens, Latin letters, and no white
#: space but single line ends.
_PLAIN = re.compile(r"[!-;=-~\u00c0-\u024f]+(?:\n[!-;=-~\u00c0-\u024f]+)*")
#: How byte-level vocabularies split a text before merging (a fixed value).
_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit integers.

    Two generations of at most ``capacity`` words each are cached; parts longer than
    ``longest`` characters never are.
    """

    def __init__(self, path: str, capacity: int = 100_000, longest: int = 48) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.capacity = capacity
        self.longest = longest
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._merge = self._ranked(path)

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [_CUT.split(text) for text in texts]
        heads = [self._one(p[0]) for p in parts]
        words = self._words
        extra: dict[str, bytes] = {}
        for word in {word for p in parts for word in p[1:] if word not in words}:
            ids = self._older.get(word) or self._one(" " + word)
            (words if len(word) <= self.longest else extra)[word] = ids
        out = []
        for head, p in zip(heads, parts, strict=True):
            if extra:
                ids = [words[w] if w in words else extra[w] for w in p[1:]]
            else:
                ids = [words[w] for w in p[1:]]
            out.append(head + b"".join(ids))
        if len(words) > self.capacity:
            self._older, self._words = words, {}
        return out

    def _one(self, text: str) -> bytes:
        if self._merge and _PLAIN.fullmatch(text, text[:1] == " "):
            return array("I", self._merge(text)).tobytes()
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, "<u4").tobytes()

    def _ranked(self, path: str):
        """Encoding by ranks, or None where the vocabulary is not of that kind."""
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model, before = stated["model"], stated["pre_tokenizer"] or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if (
            stated["normalizer"]
            or any(before.get(k) != v for k, v in plain.items())
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges"))
        ):
            return None
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        made = [model["vocab"]["".join(pair)] for pair in pairs]
        if any(a >= b for a, b in zip(made, made[1:], strict=False)):
            return None
        import tiktoken

        added = self.tokenizer.get_added_tokens_decoder()
        ranks = {raw: n for n, raw in enumerate(self.pieces) if n not in added}
        return tiktoken.Encoding(
            "ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    @property
    def pieces(self) -> list[bytes]:
        """The bytes each id stands for, as the tokenizer's own decoder gives them."""
        return _pieces(self)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


@lru_cache(maxsize=2)
def _pieces(encoder: Encoder) -> list[bytes]:
    # Byte-level vocabularies spell each byte as one printable character: visible Latin-1
    # characters stand for themselves, all others for 256 + their number among the others.
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    spelled = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = encoder.tokenizer.get_added_tokens_decoder()
    pieces = []
    for number in range(encoder.tokenizer.get_vocab_size(with_added_tokens=True)):
        token = encoder.tokenizer.id_to_token(number) or ""
        if number in added:
            pieces.append(token.encode())
        else:
            pieces.append(bytes(spelled[c] for c in token))
    return pieces


def decode(encoder: Encoder, ids: bytes) -> bytes:
    """UTF-8 of the decoded text; bytes that are no UTF-8 become replacement characters, as
    in the tokenizer's own decoder."""
    pieces = encoder.pieces
    raw = b"".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist()])
    return raw.decode("utf-8", "replace").encode()
