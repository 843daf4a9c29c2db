"""Ids and bytes of public tokenizers' vocabularies, made once in each Python worker."""

from __future__ import annotations

import functools
import json

import numpy as np

#: How a byte-level vocabulary cuts text before its merges (the cut that its file names as "ByteLevel").
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else the next one from 256 on."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE vocabulary: ids of texts, bytes of ids.

    Where the merges stand in the order of the ids that they make, merging by id gives the tokenizer's own ids (the tests
    hold both against each other); other files are left to the tokenizer itself, as are texts that spell a special token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.plain_tokenizer = Tokenizer.from_file(path)
        self.plain_tokenizer.encode_special_tokens = True
        self.special = [t["content"] for t in file["added_tokens"]]
        alphabet = byte_alphabet()
        taken = {t["id"] for t in file["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in file["model"]["vocab"].items() if i not in taken}
        self.bytes_of = [b""] * (max(max(ranks.values()), *taken, 0) + 1)
        for raw, i in ranks.items():
            self.bytes_of[i] = raw
        for t in file["added_tokens"]:
            self.bytes_of[t["id"]] = t["content"].encode()
        self.merged = self._by_rank(file, ranks)

    def _by_rank(self, file: dict, ranks: dict[bytes, int]):
        import tiktoken

        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        vocab = file["model"]["vocab"]
        made = [vocab[a + b] for a, b in merges]
        cut = file["pre_tokenizer"]
        byte_level = cut and cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
        if not byte_level or file["normalizer"] or made != sorted(made) or len(made) + 256 != len(ranks) or made[0] != 256:
            return None
        return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text, special tokens' strings as their ids; unsigned 32-bit."""
        if self.merged is None or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self.merged.encode_to_numpy(text, disallowed_special=())

    def plain_ids(self, text: str) -> np.ndarray:
        """Ids of a text in which special tokens' strings are plain text."""
        if self.merged is None:
            return np.array(self.plain_tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self.merged.encode_to_numpy(text, disallowed_special=())


class Pieces:
    """A sentence-piece vocabulary with byte fallback: ids of texts, bytes of ids (U+2581 is a blank, <0xHH> a byte)."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())
        ]

    def plain_ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), "<u4")


@functools.cache
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@functools.cache
def pieces(path: str) -> Pieces:
    return Pieces(path)
