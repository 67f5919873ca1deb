"""A small sandboxed template language, compiled to Python closures.

``{{ expression }}`` writes a value, ``{% for x in list %}``, ``{% if %} / {% elif %} / {% else %}`` and
``{% generation %}`` are blocks, ``{# #}`` is a comment. Expressions have strings, whole numbers, names, fields
(``m.role``, ``loop.first``), ``== != in not and or``, ``~`` for joining and ``| filter``. There are no calls, and a
field is only ever a key of a mapping, so a template reaches nothing but the values handed to it.

``compile_template`` parses to a syntax tree, folds what is constant and returns a renderer that yields
``(text, in_generation)`` pieces. A list may be any iterator: loops take one item at a time, so a conversation of any
length is rendered in the memory of one turn.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, replace
from typing import Any

MOST_DEPTH = 32
MOST_CHARS = 20_000

Scope = dict[str, Any]
Piece = tuple[str, bool]


class TemplateError(ValueError):
    """The template is not well-formed or reaches for something it isn't given."""


# --- the tree ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: Any
    name: str


@dataclass(frozen=True)
class Operation:
    sign: str
    parts: tuple


@dataclass(frozen=True)
class Filtered:
    of: Any
    name: str


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class If:
    condition: Any
    body: tuple
    otherwise: tuple


@dataclass(frozen=True)
class For:
    variable: str
    items: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- operations and filters -------------------------------------------------------------------------------------

_ESCAPED = re.compile(r"[\\<>]")
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Put a backslash before every backslash and angle bracket, so no marker can stand inside a text."""
    return _ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def _shown(value: Any) -> str:
    return "" if value is None else str(value)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}

_STRICT: dict[str, Callable[..., Any]] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: a in b,
    "~": lambda *parts: "".join(map(_shown, parts)), "not": lambda a: not a}


# --- parsing ----------------------------------------------------------------------------------------------------

_TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"""
                    r"""|(?P<sign>==|!=|[.|~()]))""", re.DOTALL)
_STRING_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        self.at, self.depth, end = 0, 0, 0
        source = source.rstrip()
        while end < len(source):
            found = _TOKEN.match(source, end)
            if not found:
                raise TemplateError(f"can't read {source[end:end + 20]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            end = found.end()

    def whole(self) -> Any:
        tree = self.any_of()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def chain(self, sign: str, below: Callable[[], Any]) -> Any:
        parts = [below()]
        while self.take(sign):
            parts.append(below())
        return parts[0] if len(parts) == 1 else Operation(sign, tuple(parts))

    def any_of(self) -> Any:
        self.depth += 1
        if self.depth > MOST_DEPTH:
            raise TemplateError("nested too deeply")
        tree = self.chain("or", lambda: self.chain("and", self.negated))
        self.depth -= 1
        return tree

    def negated(self) -> Any:
        count = 0
        while self.take("not"):
            count += 1
        tree = self.compared()
        for _ in range(count % 2 or 2 * (count > 0)):
            tree = Operation("not", (tree,))
        return tree

    def compared(self) -> Any:
        left = self.chain("~", self.filtered)
        if sign := self.take("==", "!=", "in"):
            return Operation(sign, (left, self.chain("~", self.filtered)))
        return left

    def filtered(self) -> Any:
        tree = self.primary()
        while True:
            if self.take("|"):
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                tree = Filtered(tree, name)
            elif self.take("."):
                tree = Field(tree, self.name())
            else:
                return tree

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def primary(self) -> Any:
        if self.take("("):
            tree = self.any_of()
            if not self.take(")"):
                raise TemplateError("a bracket is open")
            return tree
        if self.at == len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _STRING_ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.DOTALL))
        if kind == "number":
            return Const(int(value))
        if kind == "name" and value not in ("and", "or", "not", "in"):
            return Const(value == "true") if value in ("true", "false") else Name(value)
        raise TemplateError(f"unexpected {value!r}")


class _Blocks:
    """The blocks of a template, from its texts and tags in turn."""

    def __init__(self, source: str):
        if len(source) > MOST_CHARS:
            raise TemplateError("the template is too long")
        self.parts = [p for p in _TAG.split(source) if p and not p.startswith("{#")]
        self.at = 0

    def body(self, ends: tuple[str, ...], known: frozenset[str], depth: int = 0) -> tuple[tuple, str, str]:
        """Nodes up to a tag of ``ends``; that tag's word and what follows the word."""
        if depth > MOST_DEPTH:
            raise TemplateError("nested too deeply")
        nodes: list[Any] = []
        while self.at < len(self.parts):
            part = self.parts[self.at]
            self.at += 1
            if part.startswith("{{"):
                nodes.append(Output(self.expression(part[2:-2], known)))
            elif not part.startswith("{%"):
                nodes.append(Output(Const(part)))
            else:
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ends:
                    return tuple(nodes), word, rest
                nodes.append(self.block(word, rest, known, depth + 1))
        if "" not in ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(nodes), "", ""

    def block(self, word: str, rest: str, known: frozenset[str], depth: int) -> Any:
        if word == "if":
            return self.condition(rest, known, depth)
        if word == "generation":
            return Generation(self.body(("endgeneration",), known, depth)[0])
        if word == "for" and (found := re.fullmatch(r"\s*([A-Za-z]\w*)\s+in\s+(.+)", rest, re.DOTALL)):
            items = self.expression(found[2], known)
            return For(found[1], items, self.body(("endfor",), known | {found[1], "loop"}, depth)[0])
        raise TemplateError(f"unexpected tag {word!r}")

    def condition(self, rest: str, known: frozenset[str], depth: int) -> If:
        test = self.expression(rest, known)
        body, word, rest = self.body(("elif", "else", "endif"), known, depth)
        if word == "elif":
            return If(test, body, (self.condition(rest, known, depth + 1),))
        return If(test, body, self.body(("endif",), known, depth)[0] if word == "else" else ())

    def expression(self, source: str, known: frozenset[str]) -> Any:
        tree = _Expression(source).whole()
        for name in _names(tree):
            if name not in known:
                raise TemplateError(f"{name!r} isn't known")
        return tree


def _names(tree: Any) -> Iterator[str]:
    match tree:
        case Name(name):
            yield name
        case Field(of, _) | Filtered(of, _):
            yield from _names(of)
        case Operation(_, parts):
            for part in parts:
                yield from _names(part)


def parse(source: str, known: Iterable[str] = ("messages",)) -> tuple:
    """The syntax tree of a template that may use the names in ``known``."""
    return _Blocks(source).body(("",), frozenset(known))[0]


# --- folding ----------------------------------------------------------------------------------------------------


def fold(nodes: tuple) -> tuple:
    """The same tree with constants worked out, dead branches left out and neighbouring texts joined."""
    out: list[Any] = []
    for node in nodes:
        for new in _folded(node):
            if isinstance(new, Output) and isinstance(new.value, Const):
                new = Output(Const(_shown(new.value.value)))
                if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                    new = Output(Const(out.pop().value.value + new.value.value))
                if not new.value.value:
                    continue
            out.append(new)
    return tuple(out)


def _folded(node: Any) -> tuple:
    match node:
        case Output(value):
            return (Output(_constant(value)),)
        case If(condition, body, otherwise):
            condition = _constant(condition)
            if isinstance(condition, Const):
                return fold(body if condition.value else otherwise)
            return (If(condition, fold(body), fold(otherwise)),)
        case For():
            return (replace(node, items=_constant(node.items), body=fold(node.body)),)
        case Generation(body):
            body = fold(body)
            return (Generation(body),) if body else ()
    raise TemplateError(f"unexpected {node!r}")


def _constant(tree: Any) -> Any:
    match tree:
        case Filtered(of, name):
            of = _constant(of)
            return Const(FILTERS[name](_shown(of.value))) if isinstance(of, Const) else Filtered(of, name)
        case Field(of, name):
            return Field(_constant(of), name)
        case Operation(sign, parts):
            parts = tuple(map(_constant, parts))
            if all(isinstance(p, Const) for p in parts):
                return Const(_value(Operation(sign, parts))({}))
            if sign == "~":
                joined: list[Any] = []
                for part in parts:
                    if joined and isinstance(part, Const) and isinstance(joined[-1], Const):
                        part = Const(_shown(joined.pop().value) + _shown(part.value))
                    joined.append(part)
                parts = tuple(joined)
            return Operation(sign, parts)
    return tree


# --- closures ---------------------------------------------------------------------------------------------------


def _value(tree: Any) -> Callable[[Scope], Any]:
    match tree:
        case Const(value):
            return lambda scope: value
        case Name(name):
            return lambda scope: scope[name]
        case Field(of, name):
            inner = _value(of)

            def field(scope: Scope) -> Any:
                value = inner(scope)
                if not isinstance(value, Mapping) or name not in value:
                    raise TemplateError(f"there is no field {name!r}")
                return value[name]
            return field
        case Filtered(of, name):
            inner, chosen = _value(of), FILTERS[name]
            return lambda scope: chosen(_shown(inner(scope)))
        case Operation("and" | "or" as sign, parts):
            parts = tuple(map(_value, parts))
            every = all if sign == "and" else any
            return lambda scope: every(part(scope) for part in parts)
        case Operation(sign, parts):
            parts, done = tuple(map(_value, parts)), _STRICT[sign]
            return lambda scope: done(*(part(scope) for part in parts))
    raise TemplateError(f"unexpected {tree!r}")


def _looped(items: Iterable) -> Iterator[tuple[Any, dict[str, Any]]]:
    """Items with their ``loop`` fields; one item is read ahead to know the last."""
    index, rest = 0, iter(items)
    item = next(rest, rest)
    while item is not rest:
        following = next(rest, rest)
        index += 1
        yield item, {"index": index, "first": index == 1, "last": following is rest}
        item = following


def _renderer(nodes: tuple, generation: bool) -> Callable[[Scope], Iterator[Piece]]:
    steps = tuple(_step(node, generation) for node in nodes)

    def render(scope: Scope) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)
    return steps[0] if len(steps) == 1 else render


def _step(node: Any, generation: bool) -> Callable[[Scope], Iterator[Piece]]:
    match node:
        case Output(Const(text)):
            piece = ((text, generation),)
            return lambda scope: piece
        case Output(value):
            shown = _value(value)
            return lambda scope: ((_shown(shown(scope)), generation),)
        case If(condition, body, otherwise):
            test, yes, no = _value(condition), _renderer(body, generation), _renderer(otherwise, generation)
            return lambda scope: yes(scope) if test(scope) else no(scope)
        case Generation(body):
            return _renderer(body, True)
        case For(variable, items, body):
            listed, each = _value(items), _renderer(body, generation)

            def loop(scope: Scope) -> Iterator[Piece]:
                for item, state in _looped(listed(scope)):
                    yield from each(scope | {variable: item, "loop": state})
            return loop
    raise TemplateError(f"unexpected {node!r}")


def compile_template(source: str, known: Iterable[str] = ("messages",)) -> Callable[..., Iterator[Piece]]:
    """A renderer that takes the known names as arguments and yields ``(text, in_generation)``."""
    render = _renderer(fold(parse(source, known)), False)
    return lambda **scope: iter(render(scope))
