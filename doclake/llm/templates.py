"""A sandboxed template language: source text to a syntax tree, folded, then to Python closures.

Text with ``{{ expression }}``, ``{% for x in e %}..{% endfor %}``, ``{% if e %}..{% elif e %}..{% else %}..{% endif %}`` and
``{% generation %}..{% endgeneration %}``, which marks what a model is to learn. Expressions: string and whole-number literals,
``true false none``, names, ``a.b`` and ``a['b']`` on mappings, ``+ ~ == != < <= > >= and or not in``, brackets, and
filters ``e | name``. There are no calls, no Python attributes and no imports: a template reaches its own values only.

Rendering is a stream of parts, so that a conversation of any length is rendered in the memory of one message.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

Part = tuple[str | None, bool]  # text, and whether it lies between generation marks
CUT: Part = (None, False)  # after each round of an outermost loop; carries no text
Env = dict[str, Any]


class TemplateError(ValueError):
    """The source is not a template of this language, or an expression cannot be computed."""


# --- tree ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Binary:
    sign: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Not:
    of: Any


@dataclass(frozen=True)
class Filter:
    of: Any
    name: str


@dataclass(frozen=True)
class Output:
    of: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- parsing ------------------------------------------------------------------------------------

_TAGS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKENS = re.compile(r"""\s*(?:('(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>+~.|()\[\]]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("+", "~"))


def _tokens(source: str) -> list[tuple[str, str]]:
    found, at, source = [], 0, source.rstrip()
    while at < len(source):
        m = _TOKENS.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        kind = ("text", "number", "name", "sign")[m.lastindex - 1]
        found.append((kind, m[m.lastindex]))
        at = m.end()
    return found


class _Expression:
    def __init__(self, source: str):
        self.rest = _tokens(source)[::-1]
        self.source = source

    def peek(self) -> str | None:
        return self.rest[-1][1] if self.rest and self.rest[-1][0] != "text" else None

    def take(self, wanted: str | None = None) -> tuple[str, str]:
        if not self.rest or wanted is not None and self.peek() != wanted:
            raise TemplateError(f"expected {wanted or 'more'} in {self.source!r}")
        return self.rest.pop()

    def whole(self) -> Any:
        found = self.level(0)
        if self.rest:
            raise TemplateError(f"too much in {self.source!r}")
        return found

    def level(self, n: int) -> Any:
        if n == len(_LEVELS):
            return self.postfix()
        if _LEVELS[n] == ("not",):
            if self.peek() == "not":
                self.take()
                return Not(self.level(n))
            return self.level(n + 1)
        found = self.level(n + 1)
        while self.peek() in _LEVELS[n]:
            found = Binary(self.take()[1], found, self.level(n + 1))
        return found

    def postfix(self) -> Any:
        found = self.atom()
        while self.peek() in (".", "[", "|"):
            sign = self.take()[1]
            if sign == "[":
                found = Item(found, self.level(0))
                self.take("]")
                continue
            kind, name = self.take()
            if kind != "name":
                raise TemplateError(f"a name must follow {sign} in {self.source!r}")
            found = Filter(found, name) if sign == "|" else Item(found, Const(name))
        return found

    def atom(self) -> Any:
        kind, value = self.take()
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(value))
        if kind == "name":
            return Const({"true": True, "false": False, "none": None}[value]) if value in ("true", "false", "none") else Name(value)
        if value == "(":
            found = self.level(0)
            self.take(")")
            return found
        raise TemplateError(f"{value} is out of place in {self.source!r}")


def parse(source: str) -> tuple:
    """The tree of a template: a tuple of nodes."""
    pieces: list[tuple[str, str]] = []
    at = 0
    for m in _TAGS.finditer(source):
        pieces.append(("text", source[at : m.start()]))
        pieces.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    pieces.append(("text", source[at:]))
    body, end, _ = _body(pieces, 0)
    if end:
        raise TemplateError(f"{end} closes nothing")
    return body


def _body(pieces: list[tuple[str, str]], at: int) -> tuple[tuple, str | None, int]:
    """Nodes up to a tag that does not open one; that tag; the place after it."""
    found: list[Any] = []
    while at < len(pieces):
        kind, value = pieces[at]
        at += 1
        if kind == "text":
            if value:
                found.append(Output(Const(value)))
            continue
        if kind == "out":
            found.append(Output(_Expression(value).whole()))
            continue
        word, _, rest = value.partition(" ")
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.*)", rest.strip(), re.S)
            if not m:
                raise TemplateError(f"cannot read {value!r}")
            body, end, at = _body(pieces, at)
            found.append(For(m[1], _Expression(m[2]).whole(), body))
            _closed(end, "endfor", value)
        elif word == "generation":
            body, end, at = _body(pieces, at)
            found.append(Generation(body))
            _closed(end, "endgeneration", value)
        elif word == "if":
            branches, condition = [], rest
            while True:
                body, end, at = _body(pieces, at)
                branches.append((_Expression(condition).whole(), body))
                if not end or end == "endif":
                    break
                word, _, condition = end.partition(" ")
                if word == "else":
                    condition = "true"
                elif word != "elif":
                    break
            found.append(If(tuple(branches)))
            _closed(end, "endif", value)
        else:
            return tuple(found), value, at
    return tuple(found), None, at


def _closed(end: str | None, wanted: str, opened: str) -> None:
    if end != wanted:
        raise TemplateError(f"{opened!r} ends in {end!r}")


# --- values -------------------------------------------------------------------------------------

CONTROL = re.compile(r"\\|###|</turn>")


def escape(text: str) -> str:
    """Control strings of a chat template made harmless: a backslash before each, and before each backslash."""
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    """The text that :func:`escape` was given."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "escape_head": lambda s: escape(s).replace(":", "\\:"),
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}


def _shown(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, (str, int)):
        return str(value)
    raise TemplateError(f"a {type(value).__name__} cannot be written")


def _binary(sign: str, a: Any, b: Any) -> Any:
    try:
        match sign:
            case "==":
                return a == b
            case "!=":
                return a != b
            case "~":
                return _shown(a) + _shown(b)
            case "+" if type(a) is type(b) and isinstance(a, (str, int)):
                return a + b
            case "in" if isinstance(b, (str, list, tuple, Mapping)):
                return a in b
            case "<":
                return a < b
            case "<=":
                return a <= b
            case ">":
                return a > b
            case ">=":
                return a >= b
    except TypeError as error:
        raise TemplateError(str(error)) from None
    raise TemplateError(f"{sign} does not take these values")


def _filtered(name: str, value: Any) -> str:
    if name not in FILTERS:
        raise TemplateError(f"no filter {name}")
    return FILTERS[name](_shown(value))


# --- folding ------------------------------------------------------------------------------------


def folded(node: Any) -> Any:
    """The node with constant parts computed."""
    match node:
        case Binary(sign, left, right):
            left, right = folded(left), folded(right)
            if sign in ("and", "or") and isinstance(left, Const):
                return right if bool(left.value) == (sign == "and") else left
            if isinstance(left, Const) and isinstance(right, Const) and sign not in ("and", "or"):
                return Const(_binary(sign, left.value, right.value))
            return Binary(sign, left, right)
        case Not(of):
            of = folded(of)
            return Const(not of.value) if isinstance(of, Const) else Not(of)
        case Filter(of, name):
            of = folded(of)
            return Const(_filtered(name, of.value)) if isinstance(of, Const) else Filter(of, name)
        case Item(of, key):
            return Item(folded(of), folded(key))
    return node


def folded_body(body: Iterable[Any]) -> tuple:
    """The nodes with constants computed, branches that cannot run left out and neighbouring texts joined."""
    found: list[Any] = []
    for node in body:
        match node:
            case Output(of):
                of = folded(of)
                if isinstance(of, Const):
                    text = _shown(of.value)
                    if found and isinstance(found[-1], Output) and isinstance(found[-1].of, Const):
                        text = found.pop().of.value + text
                    new = [Output(Const(text))] if text else []
                else:
                    new = [Output(of)]
            case For(name, over, inner):
                new = [For(name, folded(over), folded_body(inner))]
            case Generation(inner):
                new = [Generation(folded_body(inner))]
            case If(branches):
                left = []
                for condition, inner in branches:
                    condition = folded(condition)
                    if isinstance(condition, Const) and not condition.value:
                        continue
                    left.append((condition, folded_body(inner)))
                    if isinstance(condition, Const):
                        break
                if left and isinstance(left[0][0], Const):
                    new = list(left[0][1])
                    if new and found and all(isinstance(x, Output) and isinstance(x.of, Const) for x in (found[-1], new[0])):
                        new[0] = Output(Const(found.pop().of.value + new[0].of.value))
                else:
                    new = [If(tuple(left))] if left else []
        found += new
    return tuple(found)


# --- closures -----------------------------------------------------------------------------------


def _value(node: Any) -> Callable[[Env], Any]:
    match node:
        case Const(value):
            return lambda env: value
        case Name(name):

            def named(env: Env) -> Any:
                if name not in env:
                    raise TemplateError(f"nothing is called {name}")
                return env[name]

            return named
        case Item(of, key):
            get, at = _value(of), _value(key)

            def item(env: Env) -> Any:
                held = get(env)
                if not isinstance(held, Mapping):
                    raise TemplateError("only mappings have items")
                return held.get(at(env))

            return item
        case Not(of):
            get = _value(of)
            return lambda env: not get(env)
        case Filter(of, name):
            get = _value(of)
            if name not in FILTERS:
                raise TemplateError(f"no filter {name}")
            return lambda env: _filtered(name, get(env))
        case Binary("and", left, right):
            a, b = _value(left), _value(right)
            return lambda env: a(env) and b(env)
        case Binary("or", left, right):
            a, b = _value(left), _value(right)
            return lambda env: a(env) or b(env)
        case Binary(sign, left, right):
            a, b = _value(left), _value(right)
            return lambda env: _binary(sign, a(env), b(env))
    raise TemplateError(f"no value: {node!r}")


def _run(body: tuple, depth: int = 0, learnt: bool = False) -> Callable[[Env], Iterator[Part]]:
    steps = [_step(node, depth, learnt) for node in body]

    def run(env: Env) -> Iterator[Part]:
        for step in steps:
            yield from step(env)

    return run


def _step(node: Any, depth: int, learnt: bool) -> Callable[[Env], Iterator[Part]]:
    match node:
        case Output(Const(value)):
            part = (value, learnt)
            return lambda env: iter((part,))
        case Output(of):
            get = _value(of)
            return lambda env: iter(((_shown(get(env)), learnt),))
        case Generation(inner):
            return _run(inner, depth, True)
        case If(branches):
            tests = [(_value(c), _run(b, depth, learnt)) for c, b in branches]

            def choose(env: Env) -> Iterator[Part]:
                for test, run in tests:
                    if test(env):
                        yield from run(env)
                        return

            return choose
        case For(name, over, inner):
            get, run = _value(over), _run(inner, depth + 1, learnt)

            def loop(env: Env) -> Iterator[Part]:
                for value in get(env):
                    yield from run({**env, name: value})
                    if depth == 0:
                        yield CUT

            return loop
    raise TemplateError(f"no statement: {node!r}")


def compiled(source: str) -> Callable[..., Iterator[Part]]:
    """A function of the template's values that streams its parts; every distinct source is checked as a whole first."""
    run = _run(folded_body(parse(source)))
    return lambda **values: run(values)
