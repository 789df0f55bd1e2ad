"""Chat formatting: a compiler for a small, sandboxed template language.

A template is parsed into a syntax tree, constant parts of the tree are folded,
and the rest becomes Python closures, which yield (text, is_generated) pieces.
Templates reach nothing but the values passed in: names, keys of mappings,
items of lists, whitelisted filters and loop counters; no attributes, calls or
imports exist. Conversations are rendered turn by turn from rows sorted inside
their partition, so memory does not follow a conversation's length.

Language: ``{{ expr }}``, ``{% if %}/{% elif %}/{% else %}/{% endif %}``,
``{% for x in list %}/{% endfor %}`` (with ``loop.index``, ``loop.index0``,
``loop.first``), ``{% set name = expr %}``, ``{% generation %}/
{% endgeneration %}``; expressions have strings, integers, true/false/none,
names, ``a.key``, ``a['key']``, ``a | filter``, ``+ ~ == != in not and or`` and
``a if b else c``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

Piece = tuple[str, bool]


class TemplateError(ValueError):
    pass


ESCAPED = re.compile(r"([\\<\[|])")
UNESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    r"""Put a backslash before each of \ < [ |, the first characters of control
    strings, so that none occurs in the result; `unescape` is its inverse."""
    return ESCAPED.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return UNESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[Any], Any]] = {
    "escape": lambda x: escape(_text(x)), "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(), "length": lambda x: len(x), "string": lambda x: _text(x),
}

_TAGS = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[.\[\]()|+~]))""", re.DOTALL)
_QUOTED = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"and", "or", "not", "in", "if", "else"}


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


# syntax tree: tuples of a kind and its parts
#   expressions: const v | name n | key a k | filter f a | bin op a b | not a | cond test a b
#   statements:  out e | if ((test, body) ...) else | for name e body | set name e | gen body


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str:
        if not self.peek(*values):
            raise TemplateError(f"expected {' or '.join(values)}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> tuple:
        tree = self.ternary()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def ternary(self) -> tuple:
        a = self.either()
        if self.peek("if"):
            self.take("if")
            test = self.either()
            self.take("else")
            return ("cond", test, a, self.ternary())
        return a

    def either(self) -> tuple:
        return self.binary(("or",), lambda: self.binary(("and",), self.negated))

    def negated(self) -> tuple:
        if self.peek("not"):
            self.take("not")
            return ("not", self.negated())
        return self.binary(("==", "!=", "in"), lambda: self.binary(("+", "~"), self.postfix))

    def binary(self, ops: tuple[str, ...], below: Callable[[], tuple]) -> tuple:
        a = below()
        while self.peek(*ops):
            a = ("bin", self.take(*ops), a, below())
        return a

    def postfix(self) -> tuple:
        a = self.primary()
        while self.peek(".", "[", "|"):
            op = self.take(".", "[", "|")
            if op == "[":
                a = ("key", a, self.ternary())
                self.take("]")
                continue
            kind, word = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or op == "|" and word not in FILTERS:
                raise TemplateError(f"unknown {'filter' if op == '|' else 'key'} {word!r}")
            self.at += 1
            a = ("filter", word, a) if op == "|" else ("key", a, ("const", word))
        return a

    def primary(self) -> tuple:
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends too early")
        kind, word = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _QUOTED.get(m[1], m[1]), word[1:-1], flags=re.DOTALL))
        if kind == "int":
            return ("const", int(word))
        if word == "(":
            a = self.ternary()
            self.take(")")
            return a
        if kind == "name" and word not in _WORDS:
            return ("const", {"true": True, "false": False, "none": None}[word.lower()]) if word.lower() in ("true", "false", "none") else ("name", word)
        raise TemplateError(f"unexpected {word!r}")


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template: a list of statements."""
    parts = _TAGS.split(source)
    tokens: list[tuple[str, str]] = []
    for i, part in enumerate(parts):
        if i % 2 == 0:
            if i and parts[i - 1][-3:-2] == "-" and not parts[i - 1].startswith("{#"):
                part = part.lstrip()
            if i + 1 < len(parts) and parts[i + 1][2:3] == "-":
                part = part.rstrip()
            if part:
                tokens.append(("text", part))
        elif part.startswith("{{"):
            tokens.append(("out", part[2:-2].strip("-").strip()))
        elif part.startswith("{%"):
            tokens.append(("tag", part[2:-2].strip("-").strip()))
    at = 0

    def block(*ends: str) -> tuple[list[tuple], str]:
        nonlocal at
        body: list[tuple] = []
        while at < len(tokens):
            kind, value = tokens[at]
            at += 1
            if kind == "text":
                body.append(("out", ("const", value)))
                continue
            if kind == "out":
                body.append(("out", _Expression(value).whole()))
                continue
            word, _, rest = value.partition(" ")
            if word in ends:
                return body, value
            if word == "if":
                arms, other = [], []
                test = _Expression(rest).whole()
                while True:
                    inner, end = block("elif", "else", "endif")
                    arms.append((test, inner))
                    if end.startswith("elif"):
                        test = _Expression(end[4:]).whole()
                        continue
                    if end == "else":
                        other, _ = block("endif")
                    break
                body.append(("if", arms, other))
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.DOTALL)
                if not m:
                    raise TemplateError(f"cannot read for {rest!r}")
                inner, _ = block("endfor")
                body.append(("for", m[1], _Expression(m[2]).whole(), inner))
            elif word == "set":
                name, eq, value = rest.partition("=")
                if not eq or not re.fullmatch(r"[A-Za-z_]\w*", name.strip()):
                    raise TemplateError(f"cannot read set {rest!r}")
                body.append(("set", name.strip(), _Expression(value).whole()))
            elif word == "generation":
                inner, _ = block("endgeneration")
                body.append(("gen", inner))
            else:
                raise TemplateError(f"unknown or misplaced tag {word!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return body, ""

    return block()[0]


def _binary(op: str, a: Any, b: Any) -> Any:
    if op == "==":
        return a == b
    if op == "!=":
        return a != b
    if op == "in":
        return a in b
    if op == "+" and isinstance(a, int) and isinstance(b, int):
        return a + b
    return _text(a) + _text(b)


def fold_expression(e: tuple) -> tuple:
    """The expression with every constant part evaluated."""
    kind = e[0]
    if kind in ("const", "name"):
        return e
    if kind == "filter":
        a = fold_expression(e[2])
        return ("const", FILTERS[e[1]](a[1])) if a[0] == "const" else ("filter", e[1], a)
    if kind == "not":
        a = fold_expression(e[1])
        return ("const", not a[1]) if a[0] == "const" else ("not", a)
    if kind == "key":
        return ("key", fold_expression(e[1]), fold_expression(e[2]))
    if kind == "cond":
        test, a, b = map(fold_expression, e[1:])
        return (a if test[1] else b) if test[0] == "const" else ("cond", test, a, b)
    op, a, b = e[1], fold_expression(e[2]), fold_expression(e[3])
    if op in ("and", "or"):
        if a[0] == "const":
            return b if bool(a[1]) == (op == "and") else a
        return ("bin", op, a, b)
    return ("const", _binary(op, a[1], b[1])) if a[0] == b[0] == "const" else ("bin", op, a, b)


def fold(body: list[tuple]) -> list[tuple]:
    """The statements with constant expressions and branches folded and
    neighbouring constant texts joined."""
    out: list[tuple] = []

    def put(s: tuple) -> None:
        if s[0] == "out" and s[1][0] == "const":
            s = ("out", ("const", _text(s[1][1])))
            if not s[1][1]:
                return
            if out and out[-1][0] == "out" and out[-1][1][0] == "const":
                out[-1] = ("out", ("const", out[-1][1][1] + s[1][1]))
                return
        out.append(s)

    for s in body:
        if s[0] == "out":
            put(("out", fold_expression(s[1])))
        elif s[0] == "set":
            put(("set", s[1], fold_expression(s[2])))
        elif s[0] == "for":
            put(("for", s[1], fold_expression(s[2]), fold(s[3])))
        elif s[0] == "gen":
            put(("gen", fold(s[1])))
        else:
            arms, other = [], fold(s[2])
            for test, inner in s[1]:
                test, inner = fold_expression(test), fold(inner)
                if test[0] != "const":
                    arms.append((test, inner))
                elif test[1]:
                    other = inner
                    break
            if arms:
                put(("if", arms, other))
            else:
                for x in other:
                    put(x)
    return out


def _compile_expression(e: tuple) -> Callable[[dict], Any]:
    kind = e[0]
    if kind == "const":
        value = e[1]
        return lambda env: value
    if kind == "name":
        name = e[1]
        return lambda env: env.get(name)
    if kind == "key":
        a, k = _compile_expression(e[1]), _compile_expression(e[2])

        def key(env: dict) -> Any:
            holder, at = a(env), k(env)
            if isinstance(holder, dict):
                return holder.get(at)
            if isinstance(holder, list) and type(at) is int and at < len(holder):
                return holder[at]
            return None
        return key
    if kind == "filter":
        f, a = FILTERS[e[1]], _compile_expression(e[2])
        return lambda env: f(a(env))
    if kind == "not":
        a = _compile_expression(e[1])
        return lambda env: not a(env)
    if kind == "cond":
        test, a, b = map(_compile_expression, e[1:])
        return lambda env: a(env) if test(env) else b(env)
    op, a, b = e[1], _compile_expression(e[2]), _compile_expression(e[3])
    if op == "and":
        return lambda env: a(env) and b(env)
    if op == "or":
        return lambda env: a(env) or b(env)
    return lambda env: _binary(op, a(env), b(env))


def _compile(body: list[tuple], generated: bool) -> Callable[[dict], Iterator[Piece]]:
    steps = [_compile_statement(s, generated) for s in body]
    if len(steps) == 1:
        return steps[0]

    def run(env: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(env)
    return run


def _compile_statement(s: tuple, generated: bool) -> Callable[[dict], Iterator[Piece]]:
    if s[0] == "out":
        value = _compile_expression(s[1])

        def out(env: dict) -> Iterator[Piece]:
            if text := _text(value(env)):
                yield text, generated
        return out
    if s[0] == "set":
        name, value = s[1], _compile_expression(s[2])

        def put(env: dict) -> Iterator[Piece]:
            env[name] = value(env)
            return iter(())
        return put
    if s[0] == "gen":
        return _compile(s[1], True)
    if s[0] == "if":
        arms = [(_compile_expression(test), _compile(inner, generated)) for test, inner in s[1]]
        other = _compile(s[2], generated)

        def branch(env: dict) -> Iterator[Piece]:
            return next((inner for test, inner in arms if test(env)), other)(env)
        return branch
    name, values, inner = s[1], _compile_expression(s[2]), _compile(s[3], generated)

    def loop(env: dict) -> Iterator[Piece]:
        items = values(env)
        if isinstance(items, (str, bytes, dict)):
            raise TemplateError("only lists can be looped over")
        for i, item in enumerate(items or ()):  # any iterator, so turns can stream
            env[name], env["loop"] = item, {"index": i + 1, "index0": i, "first": i == 0}
            yield from inner(env)
    return loop


class Template:
    """A compiled template. ``pieces(**values)`` yields (text, is_generated)."""

    def __init__(self, source: str):
        self.source, self.tree = source, fold(parse(source))
        self._run = _compile(self.tree, False)

    def pieces(self, **values: Any) -> Iterator[Piece]:
        return self._run(dict(values))

    def render(self, **values: Any) -> str:
        return "".join(text for text, _ in self.pieces(**values))

    def __reduce__(self):
        return Template, (self.source,)


#: Control strings: <|role|> opens a turn, </s> closes it; user turns stand in
#: [INST] ... [/INST]. Escaped roles and texts hold no bare < [ or |.
CHAT = Template(
    "{% for m in messages %}{{ '<|' ~ m.role | escape ~ '|>' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% elif m.role == 'user' %}{{ '[INST] ' }}{{ m.text | escape }}{{ ' [/INST]' }}"
    "{% else %}{{ m.text | escape }}{% endif %}{{ '</s>' }}{% endfor %}")

_HEAD = re.compile(r"<\|((?:[^\\|]++|\\.)*+)\|>", re.DOTALL)
_BODY = re.compile(r"(?:[^\\<\[|]++|\\.)*+", re.DOTALL)
_OPEN, _CLOSE, _END = "[INST] ", " [/INST]", "</s>"


class Reader:
    """Reads formatted conversations back, piece by piece.

    ``feed`` takes rendered pieces; whole turns are parsed as soon as their
    closing mark is there, so one turn is held at most."""

    def __init__(self) -> None:
        self.rest, self.mask = "", []
        self.turns = self.formatted_chars = self.loss_chars = 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, generated: bool) -> None:
        self.formatted_chars += len(text)
        if generated:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss_hash.update(plain.encode("utf-8", "surrogatepass"))
        self.rest += text
        if self.rest.endswith(_END):
            before = self.rest[:-len(_END)]
            if (len(before) - len(before.rstrip("\\"))) % 2 == 0:  # else the mark is escaped, part of a text
                self._turn(before)
                self.rest = ""

    def _turn(self, turn: str) -> None:
        head = _HEAD.match(turn)
        if not head:
            raise TemplateError(f"not a turn: {turn[:60]!r}")
        role, body = unescape(head[1]), turn[head.end():]
        if role == "user":
            if not (body.startswith(_OPEN) and body.endswith(_CLOSE)):
                raise TemplateError("a user turn without its marks")
            body = body[len(_OPEN):-len(_CLOSE)]
        if not _BODY.fullmatch(body):
            raise TemplateError("a bare control string inside a text")
        self.turns += 1
        self.turns_hash.update(f"{role}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))

    def result(self) -> dict[str, Any]:
        if self.rest:
            raise TemplateError(f"not a turn: {self.rest[:60]!r}")
        return {"n_turns": self.turns, "turns_sha256": self.turns_hash.hexdigest(), "loss_chars": self.loss_chars,
                "loss_sha256": self.loss_hash.hexdigest(), "formatted_chars": self.formatted_chars}


def _sorted_turns(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order; ties of a turn by role
    and text, null turns first."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, Iterator[dict]]]:
    """(conv_id, its messages) from sorted rows; messages stream."""
    from itertools import groupby

    def rows() -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True)
    for key, group in groupby(rows(), key=lambda r: r[0]):
        yield key, ({"role": r[1] or "", "text": r[2] or ""} for r in group)


def format_conversations(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, formatted text and loss_spans (start and end, in code points,
    of the generated parts) of every conversation (conv_id, turn, role, text;
    other columns are ignored). Null texts and roles are empty; rows with a
    null conv_id are one conversation; repeated rows are turns each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, messages in _groups(batches):
            parts, spans, at = [], [], 0
            for text, generated in template.pieces(messages=messages):
                if generated:
                    spans.append({"start": at, "end": at + len(text)})
                parts.append(text)
                at += len(text)
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array(["".join(parts)]), pa.array([spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["conv_id", "formatted", "loss_spans"])
    return _sorted_turns(conversations).mapInArrow(run, "conv_id bigint, formatted string, loss_spans array<struct<start: bigint, end: bigint>>")


def audit_format(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """Format every conversation and read the output back, turn by turn:
    conv_id, n_turns, turns_sha256 (role, line end, text, line end per turn),
    loss_chars, loss_sha256 (unescaped text under the loss mask),
    formatted_chars. Rules for odd rows as in `format_conversations`; no more
    than a turn is held in memory."""
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], t) for i, t in enumerate([pa.int64(), *kinds])], names=["conv_id", *names])
        for key, messages in _groups(batches):
            reader = Reader()
            for piece in template.pieces(messages=messages):
                reader.feed(*piece)
            held.append((key, *(reader.result()[n] for n in names)))
            if len(held) >= 4096:
                yield batch()
                held = []
        yield batch()

    return _sorted_turns(conversations).mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
