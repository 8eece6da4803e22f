"""Byte-level BPE: pieces of a text, the vocabulary, token counts of every prefix of a piece.

The tokenizer file is read where the work runs; its path is a parameter.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import regex
import tiktoken

# Fixed value: how byte-level BPE cuts a text into pieces before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = regex.compile(PATTERN)
# The same for texts without characters that the two modules class differently; several times as fast.
_FAST = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


@lru_cache(maxsize=1)
def _odd() -> re.Pattern:
    """A character that only one of the modules takes for a letter, number or space.

    Those beyond the basic plane count as odd without a look: a class of ranges is searched fast.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    odd: set[str] = set()
    for ours, theirs in ((r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d"), (r"\s", r"\s")):
        odd |= set(regex.findall(ours, every)) ^ set(re.findall(theirs, every))
    return re.compile("[" + "".join(map(re.escape, sorted(odd))) + "\U00010000-\U0010ffff]")


def split_pieces(text: str) -> list[str]:
    return (PIECES if _odd().search(text) else _FAST).findall(text)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public file of this name lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write every byte as one printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Pieces, special strings and the encoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        level, model = spec["pre_tokenizer"], spec["model"]
        if level["type"] != "ByteLevel" or level["add_prefix_space"] or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError(f"{path}: only plain byte-level BPE is supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: special strings that take in their surroundings are not supported")
        byte = _byte_of_character()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(byte[c] for c in piece) for piece, i in model["vocab"].items() if piece not in self.special}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.id_of = {b: i for i, b in self.bytes_of.items() if i not in self.special.values()}
        self.longest = max(map(len, self.id_of))
        merged = [byte_pair if isinstance(byte_pair, list) else byte_pair.split(" ") for byte_pair in model["merges"]]
        order = [model["vocab"]["".join(pair)] for pair in merged]
        if any(x >= y for x, y in zip(order, order[1:])):
            raise ValueError(f"{path}: merges must have rising ids")
        # ids in the order of merges are ranks, so this encoder merges just as the file says
        self.encoder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=self.id_of, special_tokens={})
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self._pairs: dict[int, bool] = {}

    def pieces(self, text: str) -> list[str]:
        """Pieces in order; a special string is one piece."""
        if self.split_special is None or not any(s in text for s in self.special):
            return split_pieces(text)
        made = []
        for i, part in enumerate(self.split_special.split(text)):
            made += [part] if i % 2 else split_pieces(part)
        return made

    def encode_piece(self, piece: str) -> list[int]:
        """Token ids of one piece."""
        special = self.special.get(piece)
        return [special] if special is not None else self.encoder.encode_ordinary(piece)

    def stays(self, left: int, right: int) -> bool:
        """Whether two tokens side by side are their own encoding."""
        return self.encoder._encode_single_piece(self.bytes_of[left] + self.bytes_of[right]) == [left, right]

    def prefix_counts(self, piece: bytes) -> list[int]:
        """Tokens of ``piece[:n]`` for every n from 0, by dynamic programming.

        The encoding of a prefix ends in the one token t for which the encoding of
        the rest ends in a token that t stays apart from; so each prefix needs
        the last token and the count of shorter prefixes only.
        """
        find, pairs, longest = self.id_of.get, self._pairs, self.longest
        counts, last = [0], [-1]
        for n in range(1, len(piece) + 1):
            for start in range(n - longest if n > longest else 0, n):
                token = find(piece[start:n])
                if token is None:
                    continue
                if start:
                    key = last[start] << 32 | token
                    apart = pairs.get(key)
                    if apart is None:
                        apart = pairs[key] = self.stays(last[start], token)
                    if not apart:
                        continue
                counts.append(counts[start] + 1)
                last.append(token)
                break
            else:
                raise ValueError(f"no token ends {piece[:n]!r}")
        return counts


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
