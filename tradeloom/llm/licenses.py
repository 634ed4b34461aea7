"""Licence scans: an Aho-Corasick automaton over words, and licence expressions.

A text becomes its words (letters, digits and everything beyond ASCII, A-Z lowered)
with single spaces between and around them. One automaton holds all notice phrases
and identifier tags, each between spaces, so a single walk over the text finds every
place of every phrase, places that overlap included.

What follows an identifier tag and a colon is a licence expression: names joined by
``and``, ``or`` and ``with``, in brackets or not; ``with`` binds tightest, then
``and``, then ``or``. A shunting-yard parser puts it into postfix order, reading as
long as the line goes on as an expression (brackets left open are closed at its end);
evaluating it gives labels and a freedom from 0 to 1. ``and`` binds to both sides and
is as free as the less free one, ``or`` as free as the freer one, and an exception
(``with``) lies halfway between its licence and 1.

A document's score is the least freedom of all its notices and expressions: 0 without
any, 1 if everything found is in the public domain.

A null or empty text has no words, no labels and score 0. Texts of any length are
treated whole. Rows are judged one by one, so ids (null or repeated), repeated rows
and other columns change nothing; an empty table gives an empty result.
"""

import re
from itertools import islice

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.text import in_arrow, texts

#: Fixed phrases of the base rule.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notices, and the family that each names.
NOTICES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "permission is hereby granted free of charge": "mit",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0 1 0 universal": "cc0",
    "released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAGS = ("spdx license identifier", "license expression")
#: How freely a family may be used.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "isc": 0.9, "mit": 0.9, "bsd": 0.9, "bsl": 0.9, "zlib": 0.9,
    "apache": 0.85, "cc-by": 0.8, "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.3, "agpl": 0.2,
    "cc-by-nd": 0.2, "cc-by-nc": 0.15, "cc-by-nc-sa": 0.15, "cc-by-nc-nd": 0.1, "other": 0.1, "reserved": 0.05,
}
#: Names whose family is not their own beginning.
ALIASES = {"0bsd": "bsd", "gnu": "gpl", "gplv2": "gpl", "gplv3": "gpl", "expat": "mit", "cc-pddc": "public-domain"}

SEPARATORS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLON = re.compile(rb"[ \t]*[:=]")
TOKEN = re.compile(rb"[ \t]*([()]|[a-z0-9][a-z0-9.+-]*)")
BINDING = {"or": 1, "and": 2, "with": 3}


# --- expressions ---------------------------------------------------------------

def postfix(tokens) -> list[str]:
    """Shunting-yard over names, operators and brackets; stops where the expression ends."""
    out, stack, wants_name = [], [], True

    def settle_to(least: int) -> None:
        while stack and stack[-1] != "(" and BINDING[stack[-1]] >= least:
            out.append(stack.pop())

    for token in tokens:
        if wants_name:
            if token == "(":
                stack.append(token)
            elif token == ")" or token in BINDING:
                break
            else:
                out.append(token)
                wants_name = False
        elif token == ")":
            if "(" not in stack:
                break
            settle_to(0)
            stack.pop()
        elif token in BINDING:
            settle_to(BINDING[token])
            stack.append(token)
            wants_name = True
        else:
            break
    # An operator, or brackets, without a name after them are left out.
    while wants_name and stack:
        if stack.pop() in BINDING:
            break
    settle_to(0)
    while stack:
        stack.pop()
        settle_to(0)
    return out


def family(name: str) -> str:
    """The family of a licence name, by the longest family that begins it."""
    name = ALIASES.get(name, name)
    fits = [f for f in FREEDOM if name == f or name.startswith((f + "-", f + "+"))]
    return max(fits, key=len, default="other")


def evaluate(names: list[str]) -> tuple[frozenset, float] | None:
    """Labels and freedom of a postfix expression; None for an empty one."""
    stack: list = []
    for name in names:
        if name not in BINDING:
            stack.append((frozenset([family(name)]), FREEDOM[family(name)]))
            continue
        (second, free_2), (first, free_1) = stack.pop(), stack.pop()
        if name == "with":
            stack.append((first | {f"{label}-exception" for label in first}, (free_1 + 1) / 2))
        else:
            stack.append((first | second, (max if name == "or" else min)(free_1, free_2)))
    return stack[-1] if stack else None


def tokens(line: bytes, at: int):
    """Tokens of an expression from a place in a lower-cased text."""
    while found := TOKEN.match(line, at):
        yield found[1].decode().rstrip(".-")
        at = found.end()


# --- texts ---------------------------------------------------------------------

def automaton() -> "ahocorasick.Automaton":
    tool = ahocorasick.Automaton()
    for phrases, kind in ((NOTICES.items(), "notice"), (BASE.items(), "base"), (((t, None) for t in TAGS), "tag")):
        for phrase, label in phrases:
            tool.add_word(f" {phrase} ", (kind, label, len(phrase.split())))
    tool.make_automaton()
    return tool


def places(tool, text: bytes) -> tuple[int, list[tuple]]:
    """Number of words, and (kind, label, first word, words) of every phrase, by its end."""
    words = text.translate(SEPARATORS).split()
    # UTF-8 bytes beyond ASCII are parts of words, so each byte may stand for one letter.
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found, spaces, at = [], 0, 0
    for end, (kind, label, size) in tool.iter(line):
        spaces += line.count(" ", at, end + 1)
        at = end + 1
        found.append((kind, label, spaces - 1 - size, size))
    return len(words), found


def expressions(text: bytes, found: list[tuple]) -> list[tuple[int, list[str]]]:
    """(place of the tag's last word, postfix expression) of every tag with an expression."""
    ends = [first + size - 1 for kind, _, first, size in found if kind == "tag"]
    if not ends:
        return []
    text, out, seen = text.translate(LOWER), [], 0
    words = WORD.finditer(text)
    for end in ends:
        word = next(islice(words, end - seen, None))
        seen = end + 1
        colon = COLON.match(text, word.end())
        if colon and (names := postfix(tokens(text, colon.end()))):
            out.append((end, names))
    return out


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
    " notices array<struct<label:string,first_word:long,n_words:int>>, expressions array<string>"
)


def judge(tool, text: bytes) -> tuple:
    n, found = places(tool, text)
    base = [(label, first) for kind, label, first, _ in found if kind == "base"]
    notices = [(label, first, size) for kind, label, first, size in found if kind != "tag"]
    read = expressions(text, found)
    values = [evaluate(names) for _, names in read]
    labels = {label for label, _, _ in notices}.union(*(v[0] for v in values))
    free = [FREEDOM[label] for label, _, _ in notices] + [v[1] for v in values]
    starts = [first for _, first in base]
    return (
        n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for label, _ in base})),
        ",".join(sorted(labels)), min(free, default=0.0), notices, [" ".join(names) for _, names in read],
    )


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: base counts and labels, all labels, the score, every notice, and postfix expressions."""

    def rows(batches):
        tool = automaton()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch)):
                yield (doc_id, *judge(tool, text))

    return in_arrow(docs.select(F.col("doc_id").cast("long"), "text"), rows, SCHEMA)
