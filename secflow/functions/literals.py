"""Text that every match of a regex contains, and an index of rules by it."""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAM = 4  # characters of an index entry; literals shorter than this are not indexed
BUCKETS = 1 << 14
#: Every GRAM characters of a text, overlapping; found in one pass.
GRAMS = rf"(?s)(?=(.{{{GRAM}}}))"
#: Lengths of the grams by which a joined rule base meets texts; a rule takes the longest that fits.
JOIN_GRAMS = (GRAM, 2 * GRAM, 4 * GRAM)

_BREAKING = frozenset("dDsSwWhHvVRXbBAGzZtnrfae")  # escapes without arguments that are no plain character


class _Unclear(Exception):
    """A construct whose literals are not worked out."""


def required_literals(regex: str) -> list[str]:
    """Texts that every match of a Java regex contains, as far as this can tell.

    Plain characters, quoted spans, escaped punctuation and classes of one character count. What may be
    absent does not: alternatives, lookarounds, and whatever ``?``, ``*`` or ``{`` follows. Inline flags
    and escapes with arguments give none.
    """
    text = regex.strip()
    try:
        runs, end = _sequence(text, 0)
    except (_Unclear, IndexError, ValueError):
        return []
    return [r for r in runs if r] if end == len(text) else []


def _sequence(text: str, i: int) -> tuple[list[str], int]:
    """Literal runs of a sequence up to its closing bracket or the end; none if it has alternatives."""
    runs, run, either = [], "", False
    while i < len(text) and text[i] != ")":
        plain, held = "", []
        if text[i] == "(":
            held, i = _group(text, i)
        elif text.startswith("\\Q", i):
            end = text.find("\\E", i + 2)
            plain, i = (text[i + 2:], len(text)) if end < 0 else (text[i + 2:end], end + 2)
        elif text[i] == "\\":
            if text[i + 1].isalnum() and text[i + 1] not in _BREAKING:
                raise _Unclear
            plain, i = ("" if text[i + 1].isalnum() else text[i + 1]), i + 2
        elif text[i] == "[":
            plain, i = _class(text, i)
        elif text[i] == "|":
            either, i = True, i + 1
        else:
            plain, i = ("" if text[i] in ".^$" else text[i]), i + 1
        quantifier = text[i:i + 1]
        if quantifier and quantifier in "?*+{":
            if quantifier != "+":
                plain, held = plain[:-1], []
            i = text.index("}", i) + 1 if quantifier == "{" else i + 1
            i += text[i:i + 1] in ("?", "+")
            runs, run = [*runs, *held, run + plain], ""
        elif plain:
            run += plain
        else:
            runs, run = [*runs, *held, run], ""
    return ([] if either else [*runs, run]), i


def _group(text: str, i: int) -> tuple[list[str], int]:
    i, kept = i + 1, True
    if text.startswith("?", i):
        if text.startswith("?:", i):
            i += 2
        elif text.startswith("?<", i) and text[i + 2] not in "=!":
            i = text.index(">", i) + 1
        elif text[i + 1] in "=!" or text[i + 1:i + 3] in ("<=", "<!"):
            i, kept = i + (2 if text[i + 1] in "=!" else 3), False
        else:
            raise _Unclear
    runs, end = _sequence(text, i)
    if text[end] != ")":
        raise _Unclear
    return (runs if kept else []), end + 1


def _class(text: str, i: int) -> tuple[str, int]:
    """The one character of a class, or '', and the place behind it."""
    if text[i + 2] == "]" and text[i + 1] not in "^\\[]&":
        return text[i + 1], i + 3
    depth, i = 1, i + 1
    i += text[i] == "^"
    if text[i] == "]":
        i += 1
    while depth:
        if text.startswith("\\Q", i) or text.startswith("&&", i):
            raise _Unclear
        depth += (text[i] == "[") - (text[i] == "]")
        i += 2 if text[i] == "\\" else 1
    return "", i


def bucket(gram: str) -> int:
    return zlib.crc32(gram.encode()) % BUCKETS


def gram_index(required: list[list[str]]) -> tuple[list[list[int]], list[str]]:
    """Places of rules by the bucket of one gram each, and the literal that holds the gram.

    Of a rule's grams the one that fewest rules share is taken. A rule without a gram has an empty
    literal and is in no bucket.
    """
    grams = [[(t[k:k + GRAM], t) for t in texts for k in range(len(t) - GRAM + 1)] for texts in required]
    seen = Counter(g for some in grams for g in {g for g, _ in some})
    table: list[list[int]] = [[] for _ in range(BUCKETS)]
    literals = []
    for place, some in enumerate(grams):
        gram, literal = min(some, key=lambda x: (seen[x[0]], -len(x[1]), x), default=("", ""))
        literals.append(literal)
        if gram:
            table[bucket(gram)].append(place)
    return table, literals


def join_grams(texts: list[str]) -> list[str]:
    """Different grams, of the longest length that fits, of the texts a rule requires; none for short texts."""
    longest = max(map(len, texts), default=0)
    size = max((n for n in JOIN_GRAMS if n <= longest), default=0)
    return sorted({t[k:k + size] for t in texts for k in range(len(t) - size + 1)}) if size else []


def grams_of(content: Column) -> Column:
    """Different grams of a text, of every length a joined rule may take."""
    return F.array_distinct(F.concat(
        *[F.regexp_extract_all(content, F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in JOIN_GRAMS]))
