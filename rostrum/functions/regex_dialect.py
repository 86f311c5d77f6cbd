"""Python regular expressions as Java ones.

A header pattern is judged and written by users in Python's dialect and matched by the
JVM's. ``to_java`` writes a pattern anew from Python's own parse of it, in constructs that
mean the same in Java: character categories as Python defines them, groups by number,
characters by code point. What Java can't express is refused by name on the driver, before
any job. A pattern that isn't valid Python is None.
"""
from __future__ import annotations

import re
from re import _constants as C
from re import _parser

WORD = r"\p{L}\p{N}_"                                # str.isalnum and the underscore
SPACE = r"\t-\r\x{1C}-\x{20}\x{85}\p{Z}"             # str.isspace
BOUNDARY = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
NO_BOUNDARY = f"(?:(?<=[{WORD}])(?=[{WORD}])|(?<![{WORD}])(?![{WORD}]))"
ANYTHING = r"[\x{0}-\x{10FFFF}]"
ASCII_WORD, ASCII_SPACE = "a-zA-Z0-9_", r"\t-\r\x{20}"


class UnsupportedPattern(ValueError):
    """A valid Python pattern without an equivalent on the JVM."""


def _char(code: int) -> str:
    return f"\\x{{{code:X}}}"


def _case(flags: int) -> str:
    """Java's flags for letter case: with re.ASCII only ASCII letters have two."""
    return ("i-u" if flags & re.ASCII else "iu") if flags & re.IGNORECASE else "-iu"


class _Writer:
    def __init__(self, pattern: str):
        self.pattern = pattern

    def refuse(self, what: str):
        raise UnsupportedPattern(f"pattern {self.pattern!r}: {what} has no equivalent on the JVM")

    def category(self, kind, flags: int) -> str:
        """Members of a category for use inside a class; complements as a nested class."""
        plain = bool(flags & re.ASCII)
        sets = {C.CATEGORY_DIGIT: "0-9" if plain else r"\p{Nd}", C.CATEGORY_SPACE: ASCII_SPACE if plain else SPACE,
                C.CATEGORY_WORD: ASCII_WORD if plain else WORD}
        opposite = {C.CATEGORY_NOT_DIGIT: C.CATEGORY_DIGIT, C.CATEGORY_NOT_SPACE: C.CATEGORY_SPACE, C.CATEGORY_NOT_WORD: C.CATEGORY_WORD}
        if kind in opposite:
            return f"[^{sets[opposite[kind]]}]"
        if kind not in sets:
            self.refuse(str(kind))
        return sets[kind]

    def one_of(self, members, flags: int) -> str:
        negated = members and members[0][0] is C.NEGATE
        out = []
        for op, value in members[1:] if negated else members:
            if op is C.LITERAL:
                out.append(_char(value))
            elif op is C.RANGE:
                out.append(f"{_char(value[0])}-{_char(value[1])}")
            elif op is C.CATEGORY:
                out.append(self.category(value, flags))
            else:
                self.refuse(f"{op} in a character class")
        members_ = f"[{''.join(out)}]"
        # a lookahead negates the nested classes too, whatever a Java version makes of [^...[...]]
        return f"(?:(?!{members_}){ANYTHING})" if negated else members_

    def at(self, where, flags: int) -> str:
        lines, plain = bool(flags & re.MULTILINE), bool(flags & re.ASCII)
        if where in (C.AT_BOUNDARY, C.AT_NON_BOUNDARY):
            text = BOUNDARY if where is C.AT_BOUNDARY else NO_BOUNDARY
            return text.replace(WORD, ASCII_WORD) if plain else text
        known = {C.AT_BEGINNING: r"(?:\A|(?<=\n))" if lines else r"\A", C.AT_BEGINNING_STRING: r"\A",
                 C.AT_END: r"(?=\n|\z)" if lines else r"(?=\n?\z)", C.AT_END_STRING: r"\z"}
        if where not in known:
            self.refuse(str(where))
        return known[where]

    def sequence(self, items, flags: int) -> str:
        return "".join(self.item(op, value, flags) for op, value in items)

    def item(self, op, value, flags: int) -> str:
        if op is C.LITERAL:
            return _char(value)
        if op is C.NOT_LITERAL:
            return f"[^{_char(value)}]"
        if op is C.ANY:
            return ANYTHING if flags & re.DOTALL else r"[^\n]"
        if op is C.IN:
            return self.one_of(value, flags)
        if op is C.AT:
            return self.at(value, flags)
        if op is C.BRANCH:
            return "(?:" + "|".join(self.sequence(branch, flags) for branch in value[1]) + ")"
        if op is C.SUBPATTERN:
            group, more, less, inner = value
            now = (flags | more) & ~less
            text = self.sequence(inner, now)
            if group is not None:
                text = f"({text})"
            if _case(now) != _case(flags):
                return f"(?{_case(now)}:{text})"
            return text if group is not None else f"(?:{text})"
        if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            least, most, inner = value
            span = f"{{{least},{'' if most is C.MAXREPEAT else most}}}"
            return f"(?:{self.sequence(inner, flags)}){span}" + {C.MIN_REPEAT: "?", C.POSSESSIVE_REPEAT: "+"}.get(op, "")
        if op is C.ATOMIC_GROUP:
            return f"(?>{self.sequence(value, flags)})"
        if op is C.GROUPREF:
            return f"(?:\\{value})"
        if op in (C.ASSERT, C.ASSERT_NOT):
            direction, inner = value
            mark = ("<" if direction < 0 else "") + ("=" if op is C.ASSERT else "!")
            return f"(?{mark}{self.sequence(inner, flags)})"
        if op is getattr(C, "FAILURE", None):
            return "(?!)"
        if op is C.GROUPREF_EXISTS:
            self.refuse("a conditional group")
        self.refuse(str(op))


def to_java(pattern: str, ignore_case: bool = True) -> str | None:
    """The Java pattern that finds what ``re.search(pattern, text, re.I)`` finds; None where ``pattern`` isn't valid Python."""
    flags = re.IGNORECASE if ignore_case else 0
    try:
        re.compile(pattern, flags)
        tree = _parser.parse(pattern, flags)
    except (re.error, OverflowError, RecursionError):
        return None
    now = tree.state.flags
    return f"(?{_case(now)})" + _Writer(pattern).sequence(tree, now)
