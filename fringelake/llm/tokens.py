"""Token ids of whole texts by a public tokenizer, with each distinct word encoded once per worker.

Where the file's normalizer and pattern are those of ``_KNOWN`` (checked when it is loaded), the pattern never reaches
across white space, so a text's ids are its words' ids one after another: words are found and counted in Arrow, the
tokenizers library encodes what is new, and a bounded cache keeps it. With any other file, whole texts go to the library.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa

from .common import Words, utf8

END_ID = 1
CACHE_WORDS, CACHE_BYTES = 1_000_000, 64  # parts kept, and the longest of them
STEP = 6 << 20  # bytes of text per vectorised step
_have: dict[str, "WordTokens"] = {}

# The normalizer and the pre-tokenizer that encoding word by word relies on.
_KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
# The tokenizer's pattern on lower-case ASCII: the pieces that it makes of a word.
_ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0Da-z0-9]+")
# Letters whose composed form and lower case are one character each, so a word of them is one piece.
_LATIN = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")


def _byte_level() -> dict[int, str]:
    """The character that stands for each byte: itself where it is visible, else the next one from U+0100 on."""
    seen = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_LEVEL = _byte_level()


class WordTokens:
    """Not for direct use; see ``tokens_of``."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() >= 1 << 16:
            raise ValueError("ids must fit 16 bits")
        self.size = self.tokenizer.get_vocab_size()
        self.model = self.tokenizer.model
        kind = json.loads(self.tokenizer.to_str())
        self.by_word = all(kind.get(k) == v for k, v in _KNOWN.items()) and kind["model"]["type"] == "BPE" and not kind["model"].get("dropout") and all("<|" in t["content"] for t in kind["added_tokens"])
        self.have: dict[bytes, bytes] = {}

    def of_word(self, word: bytes) -> bytes:
        """The ids of one word as 16-bit integers."""
        if not word.isascii() or b"<|" in word:  # the latter may be a special token, which the tokenizer has to find
            return self.of_part(word)
        low = word.lower()  # the tokenizer folds case itself
        if low.isalpha():
            got = self.of_part(low)
        else:
            got = b"".join([self.of_part(x.encode()) for x in _ASCII_PIECE.findall(low.decode())])
        if len(word) <= CACHE_BYTES:
            self.have[word] = got
        return got

    def of_part(self, part: bytes) -> bytes:
        got = self.have.get(part)
        if got is None:
            text = part.decode()
            if part.isascii() and part.isalpha():  # one piece of the pattern, and its own normal form
                ids = [x.id for x in self.model.tokenize(text)]
            elif _LATIN.fullmatch(text):
                ids = [x.id for x in self.model.tokenize(text.lower().encode().decode("latin-1").translate(_BYTE_LEVEL))]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            got = array("H", ids).tobytes()
            if len(part) <= CACHE_BYTES:
                self.have[part] = got
        return got

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, END_ID after each, and the texts' bounds in them."""
        if not self.by_word:
            return self.encode_whole(data, bounds)
        # case is folded first, unless that may make a special token
        special = b"<|" in data.tobytes()
        words = Words(data, bounds, lower=not special, hashes=False, fine=not special)
        ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
        plain = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words.starts), [None, pa.py_buffer(ends), pa.py_buffer(words.inner())])
        coded = plain.dictionary_encode()
        have, of_word = self.have, self.of_word
        if len(have) > CACHE_WORDS:
            have.clear()
        chars, cuts = utf8(coded.dictionary)
        chars, cuts = chars.tobytes(), cuts.tolist()
        own = [have.get(w) or of_word(w) for w in (chars[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))]
        flat = np.frombuffer(b"".join(own), np.uint16)
        size = np.fromiter(map(len, own), np.int64, len(own)) // 2
        start = np.cumsum(size) - size
        at = coded.indices.to_numpy(zero_copy_only=False)
        sizes = size[at]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = flat[np.repeat(start[at] - total[:-1], sizes) + np.arange(total[-1])]
        ends = total[words.of]  # each text's bounds without end ids
        return np.insert(ids, ends[1:], END_ID), ends + np.arange(len(ends))

    def encode_whole(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        own = [[*self.tokenizer.encode(raw[a:b].decode(), add_special_tokens=False).ids, END_ID] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        return np.array([i for ids in own for i in ids], np.uint16), np.concatenate([[0], np.cumsum([len(ids) for ids in own])]).astype(np.int64)


def tokens_of(path: str) -> WordTokens:
    """This worker's tokenizer for a vocabulary file."""
    if path not in _have:
        _have[path] = WordTokens(path)
    return _have[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
