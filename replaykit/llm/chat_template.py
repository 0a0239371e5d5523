"""Chat formatting by compiled templates.

A small template language is parsed into a syntax tree, constants are folded, and the tree becomes nested Python closures.
It is sandboxed: values are looked up by key only, there are no calls, and filters come from a fixed table.

    {{ expression | filter }}
    {% for name in expression %} ... {% endfor %}
    {% if expression %} ... {% elif expression %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}

Expressions: literals, names, ``a.b``, ``a['b']``, ``not``, ``and``, ``or``, ``==``, ``!=``, ``in``, ``~`` (joins text).
Output inside a generation block is under the loss mask.

Texts pass through ``escape``, which leaves no character that begins a control mark, and ``unescape`` undoes it,
so the formatted text can be read back whatever the texts hold.  Conversations are rendered turn by turn from
sorted rows, so memory is bounded by the longest turn, not by the longest conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from typing import Any, NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
DEFAULT_TEMPLATE = (
    "{% for m in messages %}" + TURN + "{{ m.role | escape }}" + SAYS
    + "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    + END + "{% endfor %}"
)
Emit = Callable[[str, bool], None]


class TemplateError(ValueError):
    pass


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "<" if m[1] == "l" else m[1], text, flags=re.S)


FILTERS: dict[str, Callable[[Any], Any]] = {"escape": escape, "trim": lambda x: x.strip(), "upper": lambda x: x.upper(), "lower": lambda x: x.lower(), "length": len}


# --- syntax tree ---------------------------------------------------------------------------------------------------


class Const(NamedTuple):
    value: Any


class Name(NamedTuple):
    name: str


class Item(NamedTuple):
    of: Any
    key: Any


class Apply(NamedTuple):
    op: str
    args: tuple


class Output(NamedTuple):
    value: Any


class For(NamedTuple):
    name: str
    over: Any
    body: tuple


class If(NamedTuple):
    branches: tuple  # of (condition, body)


class Generation(NamedTuple):
    body: tuple


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[~|.\[\]()]))")
_OPERATORS: dict[str, Callable] = {
    "not": lambda a: not a,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b,
    "~": lambda a, b: str(a) + str(b),
}


class _Expression:
    """Recursive descent over one expression, weakest binding first."""

    def __init__(self, source: str):
        self.tokens: list[str] = []
        at = 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            self.tokens.append(m[0].strip())
            at = m.end()
        self.at = 0

    def parse(self) -> Any:
        out = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at]!r}")
        return out

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at] in wanted:
            self.at += 1
            return self.tokens[self.at - 1]
        return None

    def need(self, token: str) -> None:
        if not self.take(token):
            raise TemplateError(f"{token!r} is missing")

    def chain(self, part: Callable, *operators: str) -> Any:
        out = part()
        while op := self.take(*operators):
            out = Apply(op, (out, part()))
        return out

    def either(self) -> Any:
        return self.chain(self.both, "or")

    def both(self) -> Any:
        return self.chain(self.negated, "and")

    def negated(self) -> Any:
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        return self.chain(self.joined, "==", "!=", "in")

    def joined(self) -> Any:
        return self.chain(self.filtered, "~")

    def filtered(self) -> Any:
        out = self.item()
        while self.take("|"):
            name = self.word()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            out = Apply("|" + name, (out,))
        return out

    def item(self) -> Any:
        out = self.atom()
        while step := self.take(".", "["):
            if step == ".":
                out = Item(out, Const(self.word()))
            else:
                out = Item(out, self.either())
                self.need("]")
        return out

    def word(self) -> str:
        if self.at >= len(self.tokens) or not re.fullmatch(r"[A-Za-z_]\w*", self.tokens[self.at]):
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1]

    def atom(self) -> Any:
        if self.take("("):
            out = self.either()
            self.need(")")
            return out
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        token = self.tokens[self.at]
        if token[0] in "'\"":
            self.at += 1
            return Const(re.sub(r"\\(.)", r"\1", token[1:-1], flags=re.S))
        if token.isdigit():
            self.at += 1
            return Const(int(token))
        name = self.word()
        return Const({"true": True, "false": False, "none": None}[name]) if name in ("true", "false", "none") else Name(name)


def parse(template: str) -> tuple:
    """The syntax tree of a template."""
    pieces: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(template):
        pieces.append(("text", template[at : m.start()]))
        pieces.append(("output", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    pieces.append(("text", template[at:]))
    position = 0

    def body(*closers: str) -> tuple[tuple, str]:
        nonlocal position
        out = []
        while position < len(pieces):
            kind, value = pieces[position]
            position += 1
            if kind == "text":
                if value:
                    out.append(Output(Const(value)))
            elif kind == "output":
                out.append(Output(_Expression(value).parse()))
            elif value.split(" ")[0] in closers:
                return tuple(out), value
            else:
                out.append(block(value))
        if closers:
            raise TemplateError(f"{closers[-1]} is missing")
        return tuple(out), ""

    def block(tag: str) -> Any:
        if m := re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+(.+)", tag, re.S):
            return For(m[1], _Expression(m[2]).parse(), body("endfor")[0])
        if tag == "generation":
            return Generation(body("endgeneration")[0])
        if m := re.fullmatch(r"if\s+(.+)", tag, re.S):
            branches, condition = [], _Expression(m[1]).parse()
            while True:
                inner, closer = body("elif", "else", "endif")
                branches.append((condition, inner))
                if closer.startswith("elif"):
                    condition = _Expression(closer[4:]).parse()
                elif closer == "else":
                    branches.append((Const(True), body("endif")[0]))
                    return If(tuple(branches))
                else:
                    return If(tuple(branches))
        raise TemplateError(f"unknown tag {tag!r}")

    return body()[0]


# --- folding and compilation -----------------------------------------------------------------------------------------


def _apply(op: str, args: list) -> Any:
    return FILTERS[op[1:]](args[0]) if op[0] == "|" else _OPERATORS[op](*args)


def fold(node: Any) -> Any:
    """The same tree with constant parts evaluated, dead branches gone and neighbouring texts joined."""
    match node:
        case Item(of, key):
            return Item(fold(of), fold(key))
        case Apply("and" | "or" as op, (left, right)):
            left, right = fold(left), fold(right)
            if isinstance(left, Const):
                return right if bool(left.value) == (op == "and") else left
            return Apply(op, (left, right))
        case Apply(op, args):
            args = tuple(map(fold, args))
            return Const(_apply(op, [a.value for a in args])) if all(isinstance(a, Const) for a in args) else Apply(op, args)
        case Output(value):
            return Output(fold(value))
        case For(name, over, inner):
            return For(name, fold(over), fold_body(inner))
        case Generation(inner):
            return Generation(fold_body(inner))
        case If(branches):
            out = []
            for condition, inner in branches:
                condition = fold(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                out.append((condition, fold_body(inner)))
                if isinstance(condition, Const):
                    break
            return If(tuple(out))
    return node


def fold_body(body: Iterable) -> tuple:
    out: list = []
    for node in map(fold, body):
        parts = node.branches[0][1] if isinstance(node, If) and node.branches and isinstance(node.branches[0][0], Const) else (node,)
        for part in parts:
            if isinstance(part, If) and not part.branches:
                continue
            text = isinstance(part, Output) and isinstance(part.value, Const)
            if text and out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                out[-1] = Output(Const(str(out[-1].value.value) + str(part.value.value)))
            else:
                out.append(part)
    return tuple(out)


def _value(node: Any) -> Callable[[dict], Any]:
    match node:
        case Const(value):
            return lambda scope: value
        case Name(name):
            def look_up(scope: dict) -> Any:
                if name not in scope:
                    raise TemplateError(f"no value for {name!r}")
                return scope[name]

            return look_up
        case Item(of, key):
            of, key = _value(of), _value(key)

            def item(scope: dict) -> Any:
                held = of(scope)
                if not isinstance(held, (dict, list)):
                    raise TemplateError("only records and lists have items")
                return held[key(scope)]

            return item
        case Apply("and", (left, right)):
            left, right = _value(left), _value(right)
            return lambda scope: left(scope) and right(scope)
        case Apply("or", (left, right)):
            left, right = _value(left), _value(right)
            return lambda scope: left(scope) or right(scope)
        case Apply(op, args):
            parts = [_value(a) for a in args]
            run = FILTERS[op[1:]] if op[0] == "|" else _OPERATORS[op]
            return lambda scope: run(*[p(scope) for p in parts])
    raise TemplateError(f"not an expression: {node!r}")


def _statement(node: Any) -> Callable[[dict, Emit, bool], None]:
    match node:
        case Output(Const(value)):
            text = str(value)
            return lambda scope, emit, masked: emit(text, masked)
        case Output(value):
            get = _value(value)
            return lambda scope, emit, masked: emit(str(get(scope)), masked)
        case Generation(inner):
            run = _sequence(inner)
            return lambda scope, emit, masked: run(scope, emit, True)
        case For(name, over, inner):
            items, run = _value(over), _sequence(inner)

            def loop(scope: dict, emit: Emit, masked: bool) -> None:
                for item in items(scope):
                    run({**scope, name: item}, emit, masked)

            return loop
        case If(branches):
            compiled = [(_value(c), _sequence(b)) for c, b in branches]

            def choose(scope: dict, emit: Emit, masked: bool) -> None:
                for condition, run in compiled:
                    if condition(scope):
                        run(scope, emit, masked)
                        return

            return choose
    raise TemplateError(f"not a statement: {node!r}")


def _sequence(body: tuple) -> Callable[[dict, Emit, bool], None]:
    steps = [_statement(node) for node in body]

    def run(scope: dict, emit: Emit, masked: bool) -> None:
        for step in steps:
            step(scope, emit, masked)

    return run


def compile_template(template: str) -> Callable[[Iterable[dict], Emit], None]:
    """A function that renders messages (records of role and text) and hands out pieces with their loss mask."""
    run = _sequence(fold_body(parse(template)))
    return lambda messages, emit: run({"messages": messages}, emit, False)


class Formatted:
    """Formatted text as it is written, with the spans under the loss mask as offsets into the whole of it."""

    def __init__(self):
        self.pieces: list[str] = []
        self.spans: list[tuple[int, int]] = []
        self.start = self.end = 0

    def emit(self, piece: str, masked: bool) -> None:
        if masked:
            self.spans.append((self.end, self.end + len(piece)))
        self.pieces.append(piece)
        self.end += len(piece)

    def drain(self) -> tuple[str, list[tuple[int, int]]]:
        """The text since the last call and its spans; offsets go on counting."""
        out = "".join(self.pieces), self.spans
        self.pieces, self.spans, self.start = [], [], self.end
        return out


class ReadBack:
    """Reads formatted text back into turns and loss texts, and digests what it finds.

    All it is given is the output: text in consecutive parts, and the spans of each part as offsets into the whole text.
    """

    def __init__(self):
        self.rest, self.n_turns, self.n_chars, self.loss_chars = "", 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, part: str, spans: list[tuple[int, int]]) -> None:
        for a, b in spans:
            if not self.n_chars <= a <= b <= self.n_chars + len(part):
                raise ValueError("a span lies outside its part of the text")
            text = unescape(part[a - self.n_chars : b - self.n_chars])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.n_chars += len(part)
        *turns, self.rest = (self.rest + part).split(END)
        for turn in turns:
            head, text = turn.split(SAYS, 1)
            if not head.startswith(TURN):
                raise ValueError("a turn has no beginning")
            self.turns.update(f"{unescape(head[len(TURN):])}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
            self.n_turns += 1


PART_CHARS = 1 << 20
DIGEST_SCHEMA = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for rows in batches:
        ids = [None if pd.isna(x) else int(x) for x in rows["conv_id"]]
        yield from zip(ids, rows["role"], rows["text"], strict=True)


def _digest(template: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = compile_template(template)
        out = []
        for conv_id, rows in groupby(_records(batches), key=lambda r: r[0]):
            written, back = Formatted(), ReadBack()

            def emit(piece: str, masked: bool, written: Formatted = written, back: ReadBack = back) -> None:
                written.emit(piece, masked)
                if written.end - written.start >= PART_CHARS:
                    back.feed(*written.drain())

            render(({"role": role or "", "text": text or ""} for _, role, text in rows), emit)
            back.feed(*written.drain())
            if back.rest:
                raise ValueError("the output does not end with a whole turn")
            out.append((conv_id, back.n_turns, back.turns.hexdigest(), back.loss_chars, back.loss.hexdigest(), back.n_chars))
            if len(out) == 10_000:
                yield _frame(out)
                out = []
        if out:
            yield _frame(out)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in DIGEST_SCHEMA.split(", ")])
    return frame.astype({"conv_id": "Int64"})


def _render(template: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = compile_template(template)
        for conv_id, rows in groupby(_records(batches), key=lambda r: r[0]):
            written = Formatted()
            render(({"role": role or "", "text": text or ""} for _, role, text in rows), written.emit)
            text, spans = written.drain()
            yield pd.DataFrame({"conv_id": pd.array([conv_id], "Int64"), "formatted": [text], "loss_spans": [[list(s) for s in spans]]})

    return run


def _in_turn_order(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation together, by turn; rows of the same turn by role and text, null turns first."""
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def formatted(conversations: DataFrame, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """conv_id, formatted text and the spans under the loss mask.  Null role and text are empty; a null conv_id is one conversation."""
    return _in_turn_order(conversations).mapInPandas(_render(template), "conv_id bigint, formatted string, loss_spans array<array<bigint>>")


def digests(conversations: DataFrame, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """What reading the formatted text and its loss spans back gives, per conversation.

    A conversation is written and read in parts of about PART_CHARS characters, so only one turn of it must fit in memory.
    """
    return _in_turn_order(conversations).mapInPandas(_digest(template), DIGEST_SCHEMA)
