"""Named capture groups, resolved to group numbers when rules are loaded."""

from __future__ import annotations

from dataclasses import dataclass

from secflow.schemas import CAPTURES

# Separates captures in the one-pass extraction; content holding it is extracted group by group.
MARK = "\u001f"


@dataclass(frozen=True)
class CompiledPattern:
    regex: str
    count: int
    names: dict[str, int]

    @property
    def whole(self) -> str:
        """The pattern widened to the full text, so that one replace yields every capture."""
        return rf"\A(?s:.*?)(?:{self.regex})(?s:.*)\z"

    @property
    def template(self) -> str:
        """Replacement text: the captures in fixed order, empty where the rule has no such group."""
        return MARK.join(f"${self.names[n]}" if n in self.names else "" for n in CAPTURES)

    @property
    def indexes(self) -> list[int]:
        return [self.names.get(n, -1) for n in CAPTURES]


def compile_pattern(regex: str) -> CompiledPattern:
    """Number the capturing groups of a Java regex.

    Escapes, quoted spans, character classes (nested too), non-capturing groups and lookarounds
    do not count; ``(`` and ``(?<name>`` do.
    """
    text = regex.strip()
    count, names, depth, i = 0, {}, 0, 0
    while i < len(text):
        ch = text[i]
        if text.startswith("\\Q", i):
            end = text.find("\\E", i + 2)
            i = len(text) if end < 0 else end + 2
            continue
        if ch == "\\":
            i += 2
            continue
        if ch == "[":
            depth += 1
            # a bracket right after the opening (or its negation) is a literal
            j = i + 2 if text.startswith("^", i + 1) else i + 1
            i = j + 1 if text.startswith("]", j) else j
            continue
        if ch == "]" and depth:
            depth -= 1
        elif ch == "(" and not depth:
            if not text.startswith("?", i + 1):
                count += 1
            elif text.startswith("?<", i + 1) and text[i + 3:i + 4] not in ("=", "!"):
                count += 1
                names[text[i + 3:text.index(">", i)]] = count
        i += 1
    return CompiledPattern(text, count, names)
