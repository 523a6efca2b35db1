"""Necessary literals of a regular expression: strings of which every match contains one.

Only what certainly holds is used. A part that may be missing (``?``, ``*``, ``{0,..}``), a
class, a look-around or an escape with a meaning ends the run of characters; a group gives
the literals of its alternatives if each has some. Constructs that change how characters
compare or that refer back (flags, quotes, numbered references, code point escapes) give
none, and so does a pattern whose runs are all shorter than asked for."""

from __future__ import annotations

MARKS = set("\\[](){}?*+|.^$")
CLASS_ESCAPES = set("dDwWsShHvVRXbBAzZGnrtfae")


class _Unknown(Exception):
    """The pattern uses something no literal is taken from."""


def _better(a: frozenset | None, b: frozenset | None) -> frozenset | None:
    """Of two sets each of which is necessary, the one whose shortest literal is longer."""
    if a is None or b is None:
        return a or b
    rank = lambda s: (min(map(len, s)), -len(s), sorted(s))
    return max(a, b, key=rank)


class _Scan:
    def __init__(self, pattern: str):
        self.p, self.i = pattern, 0

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def alternatives(self) -> frozenset | None:
        """Up to a closing bracket or the end: one of these is in every match."""
        found = [self.sequence()]
        while self.peek() == "|":
            self.i += 1
            found.append(self.sequence())
        return None if None in found else frozenset().union(*found)

    def sequence(self) -> frozenset | None:
        best, run = None, ""

        def ended():
            nonlocal best, run
            if run:
                best = _better(best, frozenset([run]))
            run = ""

        while self.i < len(self.p) and self.peek() not in "|)":
            char, group = self.atom()
            least, most = self.quantifier()
            if char is not None and least >= 1:
                run += char
                if (least, most) != (1, 1):
                    ended()
            else:
                ended()
                if group is not None and least >= 1:
                    best = _better(best, group)
        ended()
        return best

    def atom(self) -> tuple[str | None, frozenset | None]:
        """The next atom: a character, or what a group gives, or neither."""
        c = self.peek()
        self.i += 1
        if c == "\\":
            e = self.peek()
            self.i += 1
            if e in CLASS_ESCAPES:
                return None, None
            if not e or e.isalnum():
                raise _Unknown
            return e, None
        if c == "[":
            self.skip_class()
            return None, None
        if c == "(":
            return None, self.group()
        return (None, None) if c in MARKS else (c, None)

    def group(self) -> frozenset | None:
        counts = True
        if self.peek() == "?":
            kind = self.p[self.i:self.i + 3]
            if kind[:2] == "?:":
                self.i += 2
            elif kind[:2] in ("?=", "?!") or kind in ("?<=", "?<!"):
                counts = False
                self.i += 2 if kind[:2] != "?<" else 3
            elif kind[:2] == "?<" and ">" in self.p[self.i:]:
                self.i = self.p.index(">", self.i) + 1
            else:
                raise _Unknown
        inner = self.alternatives()
        if self.peek() != ")":
            raise _Unknown
        self.i += 1
        return inner if counts else None

    def skip_class(self) -> None:
        depth = 1
        self.i += self.peek() == "^"
        self.i += self.peek() == "]"
        while depth:
            c = self.peek()
            if not c:
                raise _Unknown
            self.i += 2 if c == "\\" else 1
            depth += (c == "[") - (c == "]")

    def quantifier(self) -> tuple[int, int | None]:
        c, out = self.peek(), (1, 1)
        if c and c in "?*+":
            self.i += 1
            out = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        elif c == "{":
            end = self.p.find("}", self.i)
            low, _, high = self.p[self.i + 1:end].partition(",")
            if end < 0 or not low.isdigit():
                raise _Unknown
            out = (int(low), int(high) if high.isdigit() else int(low) if "," not in self.p[self.i:end] else None)
            self.i = end + 1
        if out != (1, 1) or c == "{":
            self.i += self.peek() in ("?", "+") and self.peek() != ""
        return out


def necessary_literals(pattern: str | None, shortest: int) -> list[str]:
    """Literals of at least ``shortest`` characters, one of which every match contains; empty
    if the pattern gives no such set."""
    if not pattern or "\\Q" in pattern:
        return []
    scan = _Scan(pattern)
    try:
        found = scan.alternatives()
    except _Unknown:
        return []
    if found is None or scan.i != len(pattern) or any(len(x) < shortest for x in found):
        return []
    return sorted(found)
