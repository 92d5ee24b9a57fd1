"""Secret scans: patterns, and assignment-aware lexing.

Three patterns find assignments, access keys and long hex runs. On top of them each line that holds an assignment is lexed, and the
value is read on over line breaks, into name-literal pairs; constants are propagated through names and concatenations; a literal that reaches a sensitive name is scored
by that name and by its own strength.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.shared import whole

KINDS = ("assign", "access", "hex", "pair")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16

# Fixed values of the scoring: how telling a word of a name is, and values that stand for no secret.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "pass": 0.8, "pw": 0.8, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 0.9, "credential": 0.9,
    "credentials": 0.9, "private": 0.8, "auth": 0.7, "bearer": 0.8, "signature": 0.6, "key": 0.6, "dsn": 0.6, "salt": 0.6,
}
PLACEHOLDER = re.compile(r"(?i)^(?:change_?me|example|placeholder|todo|none|null|nil|true|false|undefined|redacted|x+|\*+|\.+|your[-_ ].*|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%)$")

MARK = re.compile(r"[=:]")
LEXEME = re.compile(
    r"""(?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
    r"""|(?P<name>[^\W\d][\w$]*(?:[.-][^\W\d][\w$]*)*)"""
    r"""|(?P<set>:=|=>|(?<![=!<>])=(?!=)|:(?!//))|(?P<plus>\+)|(?P<close>\])|(?P<open>\[)|(?P<rest>[^\s])"""
)
# A literal where a value is read: also over lines.
LITERAL = re.compile(
    r"""(?i:[rbuf]{0,2})(?:(?P<triple>\"{3}|'{3})(?P<long>(?:\\[\s\S]|(?!(?P=triple))[\s\S])*+)(?P=triple)"""
    r"""|"(?P<double>(?:[^"\\\n]|\\[\s\S])*+)"|'(?P<single>(?:[^'\\\n]|\\[\s\S])*+)'|`(?P<back>[^`]*+)`)"""
)
GAP, BREAK = re.compile(r"[^\S\n]*"), re.compile(r"(?:\s|\\\r?\n)*")
NAME = re.compile(r"[^\W\d][\w$]*(?:[.-][^\W\d][\w$]*)*")
ASSIGNED = re.compile(r"\s*(?::=|=>|=(?!=)|:(?!//))")
OWN_LINE = re.compile(r"""[^\s"'`,;(){}\[\]<>#]+(?=[^\S\n]*(?:\n|\Z))""")
KEY = re.compile(r"[\w.-]+(?::|=[^=])|[^=]*:$")
TYPE_WORDS = frozenset("str string String int integer Integer long float double bool boolean Boolean char byte bytes any Any object Object auto var let const None null Optional Final".split())
BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>#]+""")
PUT_IN = re.compile(r"\{\s*([^\W\d]\w*)\s*\}")
LOOKUP = re.compile(r"(?i)(?:env|get|property|config|setting|lookup|fetch|param|option)s?$|getenv|environ|get_?(?:env|property|config|setting|param|option)")
MEMBER = re.compile(r"\.[^\S\n]*[^\W\d][\w$]*")
CHOICE = re.compile(r"[^\S\n]*(?:\bor\b|\|\||\?\?|\?:)[^\S\n]*")
PIECE = re.compile(LITERAL.pattern + r"|(?P<call>[^\W\d][\w$]*(?:\.[^\W\d][\w$]*)*)|(?P<sign>[(),\[\]])")
OWN_TEXT = re.compile(r"(?m)^[^\S\n]*(\S+)[^\S\n]*$")
# Forms without a sign of assignment: name and literal.
ELEMENT = re.compile(r"<([^\W\d][\w.:-]*)(?:\s[^<>]*)?>\s*([^<>\s]+)\s*</\1\s*>")
DEFINED = re.compile(r"(?m)^[^\S\n]*#[^\S\n]*define[^\S\n]+([^\W\d]\w*)[^\S\n]+\"([^\"\s]+)\"")
SETTER = re.compile(r"""\bset_?([^\W\d]\w*)\([^\S\n]*["']([^"'\s]+)["'][^\S\n]*\)""")
BLOCK = re.compile(r"""(?m)^([^\S\n]*)(?:-[^\S\n]+)?["']?([\w.-]+)["']?[^\S\n]*:[^\S\n]*[|>][+-]?\d?[^\S\n]*\n((?:\1[^\S\n]+\S[^\n]*(?:\n|\Z))+)""")
NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


@dataclass(frozen=True)
class Settings:
    """least: score of a pair that counts. bits: information in a literal of full strength."""

    least: float = 0.3
    bits: float = 60.0


@dataclass(frozen=True)
class Look:
    """What the score of a text needs, whatever its length: its first and last signs, and how often each sign occurs."""

    head: str
    tail: str
    signs: Counter

    ENDS = 16

    @staticmethod
    def of(text: str) -> Look:
        return Look(text[: Look.ENDS], text[-Look.ENDS :], Counter(text))

    def __add__(self, other: Look) -> Look:
        return Look((self.head + other.head)[: Look.ENDS], (self.tail + other.tail)[-Look.ENDS :], self.signs + other.signs)

    def stand_in(self) -> str:
        """A text that is a placeholder just if the whole one is: placeholders are known by their ends, or by being one sign throughout."""
        n = self.signs.total()
        if n <= Look.ENDS:
            return self.head
        return self.head + "".join(sorted(self.signs)) + self.tail


@dataclass
class Value:
    """What a name stands for: a literal of the text (start, end), or several values joined, of which look tells the whole. told: its
    literals were found secret; asked: the weight of the most telling name that it was judged under."""

    look: Look | None
    start: int = -1
    end: int = -1
    quoted: bool = False
    parts: tuple[Value, ...] = field(default=())
    told: bool = False
    asked: float = 0.0


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, start of the value, its end) of the three patterns, each leftmost and non-overlapping."""
    found = []
    low = text.lower()
    if "pass" in low or "secret" in low or "token" in low or "api" in low:
        found += [(0, m.start(), m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(2, m.start(), m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], x[0]))


def name_weight(name: str) -> float:
    """How sensitive a name is: its most telling word, in any spelling of compound names."""
    last = name.replace("-", ".").split(".")
    words = [w.lower() for part in last for piece in part.split("_") for w in NAME_WORD.findall(piece)]
    joined = [a + b for a, b in zip(words, words[1:], strict=False)]
    return max((NAME_WEIGHTS.get(w, 0.0) for w in words + joined), default=0.0)


def strength(value: str | Look, quoted: bool, settings: Settings) -> float:
    """0 for placeholders and, unquoted, for values of one kind of character; else the information in it against `bits`."""
    look = Look.of(value) if isinstance(value, str) else value
    n = look.signs.total()
    if n < 6 or any(c.isspace() for c in look.signs) or PLACEHOLDER.match(look.stand_in()):
        return 0.0
    kinds = any(c.isdigit() for c in look.signs) + any(c.isalpha() for c in look.signs) + any(not c.isalnum() for c in look.signs)
    if not quoted and kinds < 2:
        return 0.0
    if len(look.signs) > 1 and n.bit_length() > settings.bits + 1:
        return 1.0  # n signs that are not all alike hold log2(n) bits at least
    per = -sum(k / n * math.log2(k / n) for k in look.signs.values())
    return min(1.0, per * n / settings.bits) if per else 0.0


def _lines(text: str) -> Iterator[tuple[int, int]]:
    """Bounds of the lines that hold a mark of assignment."""
    at = 0
    while m := MARK.search(text, at):
        start = text.rfind("\n", 0, m.start()) + 1
        end = text.find("\n", m.start())
        end = len(text) if end < 0 else end
        yield start, end
        at = end


def pair_spans(text: str, settings: Settings) -> list[tuple[int, int, int, int, int]]:
    """Literals that reach a sensitive name, with a score of settings.least or more. Names are settled in the order of the text."""
    known: dict[str, Value] = {}
    found: list[tuple[int, int, int, int, int]] = []
    for start, end in _lines(text):
        lexemes = [(m.lastgroup, m.start(), m.end()) for m in LEXEME.finditer(text, start, end)]
        typed = {colon: k for k in range(len(lexemes)) if (colon := _colon(text, lexemes, k))}
        names = {k: colon for colon, k in typed.items()}
        calls = Calls(text, start, end, known)
        for k, (kind, _, after) in enumerate(lexemes):
            if kind != "set" or not k or k in typed:
                continue
            target = _target(text, lexemes, names.get(k, k))
            value = _value(text, after, end, known, calls) if target else None
            if value is None:
                continue
            known[target] = value
            weight = name_weight(target)
            if weight:
                _tell(value, weight, settings, found)
    for name, places in _forms(text):
        if weight := name_weight(name):
            for start, end in places:
                _tell(Value(Look.of(text[start:end]), start, end, True), weight, settings, found)
    return sorted(set(found), key=lambda x: (x[1], x[2]))


def _colon(text: str, lexemes: list, k: int) -> int:
    """Where `name : type` before the equals sign at k has its colon; 0 if there is no type."""
    kind, start, end = lexemes[k]
    if kind != "set" or text[start:end] != "=":
        return 0
    depth, named = 0, False
    for j in range(k - 1, 0, -1):
        kind, start, end = lexemes[j]
        sign = text[start:end]
        if kind == "set":
            return j if sign == ":" and not depth and j < k - 1 and lexemes[j - 1][0] in ("name", "text") else 0
        depth += (sign in "])>") - (sign in "[(<") if kind in ("open", "close", "rest") else 0
        if depth < 0 or not depth and (kind in ("text", "plus") or kind == "rest" and sign not in "|<>()?&*!" or kind == "name" and named):
            return 0
        named = kind == "name"
    return 0


def _target(text: str, lexemes: list, k: int) -> str:
    """The name on the left of an assignment: a name, a quoted key, or a quoted subscript; never a word for a type."""
    kind, start, end = lexemes[k - 1]
    if kind == "close" and k >= 3 and lexemes[k - 3][0] == "open":
        kind, start, end = lexemes[k - 2]
    elif kind == "name" and text[start:end] in TYPE_WORDS:
        kind, start, end = lexemes[k - 2] if k >= 2 and lexemes[k - 2][0] == "name" else ("", 0, 0)
        kind = "" if text[start:end] in TYPE_WORDS else kind
    return text[start:end] if kind == "name" else text[start + 1 : end - 1] if kind == "text" else ""


def _with_names(m: re.Match, literal: Value, inner: str, known: dict[str, Value]) -> Value:
    """A literal, and the known values that an interpolation puts into it, each judged on its own."""
    opened = m[0][: m[0].index(inner)] if inner else ""
    if "f" in opened.lower() or opened.endswith("`"):
        put = tuple(known[n] for n in dict.fromkeys(PUT_IN.findall(inner)) if n in known)
        if put:
            return Value(None, quoted=True, parts=(literal, *put))
    return literal


def _literal(m: re.Match, known: dict[str, Value]) -> Value:
    """A literal; one of several lines as its lines, joined if no line has spaces."""
    group = next(g for g in ("long", "double", "single", "back") if m[g] is not None)
    inner, start = m[group], m.start(group)
    if "\n" not in inner and group != "long":
        return _with_names(m, Value(Look.of(inner), start, m.end(group), True), inner, known)
    lines = []
    for line in re.finditer(r"[^\n]+", inner):
        own = line[0].rstrip().removesuffix("\\").rstrip()
        skip = len(own) - len(own.lstrip())
        if own.strip():
            lines.append(Value(Look.of(own.strip()), start + line.start() + skip, start + line.start() + len(own), True))
    if len(lines) == 1:
        return lines[0]
    look = reduce(add, (x.look for x in lines)) if lines else Look.of("")
    return Value(None if any(c.isspace() for c in look.signs) else look, quoted=True, parts=tuple(lines))


def _value(text: str, after: int, end: int, known: dict[str, Value], calls: Calls) -> Value | None:
    """Literals and known names on the right, on the same line or after line breaks and opening brackets: joined by plus signs or side
    by side, and in brackets also one by one."""
    at, depth = BREAK.match(text, after).end(), 0
    while at < len(text) and text[at] in "([":
        depth, at = depth + 1, BREAK.match(text, at + 1).end()
    broken = at > end and not depth
    values: list[Value] = []
    parts: list[Value] = []
    joins = True
    while at < len(text):
        if m := LITERAL.match(text, at):
            one = _literal(m, known)
        elif joins and (m := NAME.match(text, at)) and m[0] in known:
            one = known[m[0]]
        else:
            break
        if (broken or not joins and "\n" in text[stop:at]) and ASSIGNED.match(text, m.end()):
            break  # the key of the next assignment
        parts.append(one)
        stop = m.end()
        at = BREAK.match(text, stop).end()
        if joins := text.startswith("+", at) and not text.startswith(("+=", "++"), at):
            at = BREAK.match(text, at + 1).end()
        elif depth and text.startswith(",", at):
            values.append(_joined(parts))
            parts, joins, at = [], True, BREAK.match(text, at + 1).end()
        elif not depth:
            beside = GAP.match(text, stop).end()
            if not (text.startswith("\\\n", beside) or beside == at):
                break
    if parts:
        values.append(_joined(parts))
    if values:
        return values[0] if len(values) == 1 else Value(None, quoted=True, parts=tuple(values))
    if not broken:
        form, value = _flowing(text, at, calls)
        if form:
            return value
        bare = BARE.match(text, at) if depth else BARE.match(text, GAP.match(text, after, end).end(), end)
    else:
        bare = OWN_LINE.match(text, at)
        bare = bare if bare and not KEY.match(bare[0]) else None
    return Value(Look.of(bare[0]), bare.start(), bare.end()) if bare else None


def _joined(parts: list[Value]) -> Value:
    if len(parts) == 1:
        return parts[0]
    look = None if any(p.look is None for p in parts) else reduce(add, (p.look for p in parts))
    return Value(look, quoted=True, parts=tuple(parts))


class Calls:
    """The brackets of a line, each with its end and the literals in it, read once when first asked for. Inner brackets are part of the outer
    ones. What a lookup is asked for, its first argument, is no value."""

    def __init__(self, text: str, start: int, end: int, known: dict[str, Value]) -> None:
        self.text, self.start, self.end, self.known = text, start, end, known
        self.closed: dict[int, tuple[int, Value | None]] | None = None

    def at(self, opener: int) -> tuple[int, Value | None] | None:
        if self.closed is None:
            self.closed = self._read()
        return self.closed.get(opener)

    def _read(self) -> dict[int, tuple[int, Value | None]]:
        closed: dict[int, tuple[int, Value | None]] = {}
        stack: list[tuple[int, bool, list[Value]]] = []
        name, first = "", True
        for m in PIECE.finditer(self.text, self.start, self.end):
            sign = m["sign"]
            if m["call"]:
                name = m["call"]
                continue
            if not sign:
                if stack and not (stack[-1][1] and first):
                    stack[-1][2].append(_literal(m, self.known))
            elif sign in "([":
                stack.append((m.start(), sign == "[" or bool(LOOKUP.search(name)), []))
                first = True
            elif sign == ",":
                first = False
            elif stack:
                opener, _, parts = stack.pop()
                value = Value(None, quoted=True, parts=tuple(parts)) if parts else None
                closed[opener] = m.end(), value
                if value and stack and not (stack[-1][1] and first):
                    stack[-1][2].append(value)
                first = False
            name = ""
        return closed


def _flowing(text: str, at: int, calls: Calls) -> tuple[bool, Value | None]:
    """Literals that reach a name through a call or as the other choice: `decode("…")`, `getenv("NAME", "…")`, `x or "…"`. Whether the right side is
    such a form, and its value."""
    end = calls.end
    m = NAME.match(text, at, end)
    if not m:
        return False, None
    found: list[Value] = []
    at, seen = m.end(), False
    while at < end and text[at] in "([":
        call = calls.at(at)
        if call is None:
            return False, None
        found += [call[1]] if call[1] else []
        at, seen = call[0], True
        while more := MEMBER.match(text, at, end):
            at = more.end()
    while other := CHOICE.match(text, at, end):
        one, seen = LITERAL.match(text, other.end(), end), True
        if not one:
            break
        found.append(_literal(one, calls.known))
        at = one.end()
    return seen, Value(None, quoted=True, parts=tuple(found)) if found else None


def _forms(text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Names and the places of their literals in forms without a sign of assignment: elements, definitions, setters, blocks of values."""
    if "</" in text:
        yield from ((m[1], [m.span(2)]) for m in ELEMENT.finditer(text))
    if "define" in text:
        yield from ((m[1], [m.span(2)]) for m in DEFINED.finditer(text))
    if "set" in text:
        yield from ((m[1], [m.span(2)]) for m in SETTER.finditer(text))
    for m in BLOCK.finditer(text):
        yield m[2], [(m.start(3) + x.start(1), m.start(3) + x.end(1)) for x in OWN_TEXT.finditer(m[3])]


def _tell(value: Value, weight: float, settings: Settings, found: list) -> None:
    """Adds the literals of a value that scores high enough; each literal is told once."""
    open_values = [(value, False)]
    while open_values:
        one, sure = open_values.pop()
        if one.told or not sure and one.asked >= weight:
            continue  # nothing new below it, for this or a less telling name
        one.asked = max(one.asked, weight)
        sure = sure or (one.look is not None and weight * strength(one.look, one.quoted, settings) >= settings.least)
        if one.parts:
            if sure or one.look is None:
                open_values += [(p, sure) for p in one.parts]
        elif sure and one.end > one.start:
            found.append((3, one.start, one.end, one.start, one.end))
        one.told = sure


def all_spans(text: str, settings: Settings) -> list[tuple[int, int, int, int, int]]:
    return sorted(base_spans(text) + pair_spans(text, settings), key=lambda x: (x[1], x[0], x[2]))


def written(spans: list[tuple[int, int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for k, start, end, _, _ in spans)


def redacted(text: str, spans: list[tuple[int, int, int, int, int]], mark: str = "<secret>") -> str:
    """The text with the values of all spans replaced; values that overlap are replaced as one."""
    out, at = [], 0
    held: list[list[int]] = []
    for start, end in sorted((s[3], s[4]) for s in spans):
        if held and start < held[-1][1]:
            held[-1][1] = max(held[-1][1], end)
        else:
            held.append([start, end])
    for start, end in held:
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def scanned(docs: DataFrame, settings: Settings | None = None, *, text_col: str = "text") -> DataFrame:
    """docs with n_assign, n_access, n_hex, n_pair, base_sha256 and spans of each whole text; a NULL text counts as empty.

    spans: kind:start:end in code points, end exclusive, by start and then kind. Columns of docs with these names are replaced.
    """
    settings = settings or Settings()

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_pair long, base_sha256 string, spans string")
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, pairs = base_spans(text), pair_spans(text, settings)
            kinds = Counter(s[0] for s in base)
            digest = hashlib.sha256(written(base).encode()).hexdigest()
            rows.append((kinds[0], kinds[1], kinds[2], len(pairs), digest, written(sorted(base + pairs, key=lambda x: (x[1], x[0], x[2])))))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_pair", "base_sha256", "spans"])

    names = ("n_assign", "n_access", "n_hex", "n_pair", "base_sha256", "spans")
    return docs.withColumn("_scan", scan(whole(docs[text_col]))).withColumns({n: F.col(f"_scan.{n}") for n in names}).drop("_scan")


def without_secrets(docs: DataFrame, settings: Settings | None = None, *, text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """docs with the value of each span replaced by `mark` in the text. A NULL text stays NULL."""
    settings = settings or Settings()

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: x if x is None else redacted(x, all_spans(x, settings), mark))

    return docs.withColumn(text_col, clean(docs[text_col]))
