"""Token ids of whole texts by a tokenizers file.

A byte-level BPE file whose merges make tokens of rising number is the same as a table
of ranks, which tiktoken applies several times faster; its ids then are those of the
tokenizers library for every text (tests compare all characters). Any other file is
given to the tokenizers library itself. Special tokens' strings in a text are ordinary
text.
"""

import json
import os
import re
from functools import cached_property

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from tradeloom.llm.text import kept_by_worker

#: Before a space that follows a non-space character no match of the byte-level patterns crosses.
CUT = re.compile(r"(?<=\S) ")
#: The pattern that a ByteLevel pre-tokenizer applies by itself: a fixed value of the format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in such a file: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def ranks_of(file: dict) -> dict[bytes, int] | None:
    """Bytes and number of each token, if the file is byte-level BPE in the order of its numbers."""
    model, before = file["model"], file.get("pre_tokenizer") or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")
    if model["type"] != "BPE" or file.get("normalizer") or any(model.get(o) for o in options):
        return None
    if {k: before.get(k) for k in plain} != plain:
        return None
    vocabulary, letters = model["vocab"], byte_letters()
    special = {t["content"] for t in file.get("added_tokens", ())}
    ranks = {bytes(letters[c] for c in t): n for t, n in vocabulary.items() if t not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocabulary[a + b] for a, b in pairs]
    # One merge for each token of more than a byte, in the order of their numbers.
    rising = all(x < y for x, y in zip(made, made[1:])) and len(made) + 256 == len(ranks)
    return ranks if rising else None


class Encoder:
    def __init__(self, path: str):
        self.path = path
        with open(path) as file:
            ranks = ranks_of(json.load(file))
        self.fast = ranks and tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def library(self) -> Tokenizer:
        """The tokenizers library's own encoder, loaded when it is first asked."""
        tool = Tokenizer.from_file(self.path)
        tool.encode_special_tokens = True
        return tool

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if self.fast:
            found = map(self.fast.encode_ordinary, texts)
        else:
            found = (e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False))
        return [np.array(ids, "<u4").tobytes() for ids in found]


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return kept_by_worker(f"encoder:{path}", lambda: Encoder(path))


def in_parts(ids: list, texts: list[str], size: int = 2_000_000):
    """Lists of ids and texts of about ``size`` characters; a longer text comes alone."""
    at, begin = 0, 0
    for k, text in enumerate(texts):
        at += len(text)
        if at >= size:
            yield ids[begin : k + 1], texts[begin : k + 1]
            at, begin = 0, k + 1
    if begin < len(ids):
        yield ids[begin:], texts[begin:]
