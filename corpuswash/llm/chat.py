"""Chat formatting: a sandboxed template language compiled to Python closures.

Template text holds ``{{ expression }}``, ``{% for m in messages %}``, ``{% if %} {% elif %} {% else %} {% endif %}``,
``{% set x = expression %}`` and ``{% generation %} ... {% endgeneration %}``; what is rendered between the last two is
marked for the loss.  Expressions know literals, names, ``m.role``, ``m['text']``, ``+ == != < <= > >= in not and or``,
and the filters ``escape trim upper lower``, which take all that stands left of them; everything else is refused when the template is compiled.  Constant parts
are folded.  A loop over the messages takes them one at a time, so a conversation is rendered as a stream.

``escape`` doubles backslashes and puts one after the first character of every control string, so none occurs in a
text; ``unescape`` reverses it.

Defined results: null texts and roles are empty; turns come in the order of ``turn`` (nulls first), ties by role and
text; repeated turns are turns of their own; null conversation ids form one conversation; empty tables give no rows;
extra columns are not read.
"""

from __future__ import annotations

import ast
import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswash.llm.common import id_of, prepare, slices

BOS, EOS = "<s>", "</s>"
ROLE, END_ROLE = "[ROLE]", "[/ROLE]"
CONTROL = (BOS, EOS, ROLE, END_ROLE, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TEMPLATE = (
    "{% for m in messages %}{{ '<s>' + '[ROLE]' }}{{ m.role | escape }}[/ROLE]"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</s>{% endfor %}"
)
_FIRST = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + r")(.)")
_ESCAPED = re.compile(r"\\(\\?)")
_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)


def escape(text: str) -> str:
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    return _FIRST.sub(r"\1\\", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}
Piece = tuple[str, bool]
Env = dict


class TemplateError(ValueError):
    """The template uses something outside the language."""


# ---- expressions: (closure, constant?) --------------------------------------

_COMPARE = {ast.Eq: operator.eq, ast.NotEq: operator.ne, ast.Lt: operator.lt, ast.LtE: operator.le, ast.Gt: operator.gt, ast.GtE: operator.ge, ast.In: lambda a, b: a in b, ast.NotIn: lambda a, b: a not in b}


@dataclass(frozen=True)
class Expr:
    run: Callable[[Env], object]
    fixed: bool = False


def _folded(run: Callable[[Env], object], parts: Iterable[Expr]) -> Expr:
    """Evaluate now what depends on constants only."""
    if all(p.fixed for p in parts):
        value = run({})
        return Expr(lambda env: value, True)
    return Expr(run)


def expression(source: str) -> Expr:
    try:
        return _expr(ast.parse(source.strip(), mode="eval").body)
    except SyntaxError as e:
        raise TemplateError(f"not an expression: {source!r}") from e


def _expr(node: ast.expr) -> Expr:
    match node:
        case ast.Constant(value=v) if isinstance(v, str | int | bool) or v is None:
            return Expr(lambda env: v, True)
        case ast.Name(id=name):
            return Expr(lambda env: env.get(name, ""))
        case ast.Attribute(value=inner, attr=key) | ast.Subscript(value=inner, slice=ast.Constant(value=str(key))):
            base = _expr(inner)
            return Expr(lambda env: v.get(key, "") if isinstance(v := base.run(env), dict) else "")
        case ast.BinOp(left=left, op=ast.BitOr(), right=ast.Name(id=name)) if name in FILTERS:
            inner, how = _expr(left), FILTERS[name]
            return _folded(lambda env: how(str(inner.run(env))), [inner])
        case ast.BinOp(left=left, op=ast.Add(), right=right):
            a, b = _expr(left), _expr(right)
            return _folded(lambda env: a.run(env) + b.run(env), [a, b])
        case ast.UnaryOp(op=ast.Not(), operand=inner):
            a = _expr(inner)
            return _folded(lambda env: not a.run(env), [a])
        case ast.BoolOp(op=op, values=values):
            parts = [_expr(v) for v in values]
            how = all if isinstance(op, ast.And) else any
            return _folded(lambda env: how(p.run(env) for p in parts), parts)
        case ast.Compare(left=left, ops=[op], comparators=[right]) if type(op) in _COMPARE:
            a, b, how = _expr(left), _expr(right), _COMPARE[type(op)]
            return _folded(lambda env: how(a.run(env), b.run(env)), [a, b])
    raise TemplateError(f"not allowed: {ast.unparse(node)}")


# ---- statements ---------------------------------------------------------------


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Print:
    value: Expr


@dataclass(frozen=True)
class Set:
    name: str
    value: Expr


@dataclass(frozen=True)
class For:
    name: str
    over: Expr
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple[tuple[Expr, tuple], ...]


@dataclass(frozen=True)
class Generation:
    body: tuple


def parse(source: str) -> tuple:
    """The syntax tree, with constants folded: fixed prints become text, fixed branches are decided, texts are joined."""
    tokens: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(source):
        tokens += [("text", source[at : m.start()]), ("print", m[1]) if m[1] is not None else ("tag", m[2].strip())]
        at = m.end()
    tokens.append(("text", source[at:]))
    body, rest = _block(tokens, ())
    if rest:
        raise TemplateError(f"unexpected {rest[0][1]!r}")
    return body


def _word(tag: str) -> str:
    return tag.split(None, 1)[0] if tag else ""


def _block(tokens: list[tuple[str, str]], ends: tuple[str, ...]) -> tuple[tuple, list[tuple[str, str]]]:
    body: list = []
    while tokens:
        (kind, value), tokens = tokens[0], tokens[1:]
        if kind == "text":
            body.append(Text(value))
        elif kind == "print":
            e = expression(value)
            body.append(Text(str(e.run({}))) if e.fixed else Print(e))
        elif (word := _word(value)) in ends:
            return _joined(body), [("tag", value), *tokens]
        elif word == "for" and (m := re.fullmatch(r"for\s+([A-Za-z]\w*)\s+in\s+(.+)", value, re.S)):
            inner, tokens = _block(tokens, ("endfor",))
            tokens = _closed(tokens, "for")
            body.append(For(m[1], expression(m[2]), inner))
        elif word == "if":
            branches, tag = [], value
            while _word(tag) in ("if", "elif", "else"):
                condition = Expr(lambda env: True, True) if tag == "else" else expression(tag.split(None, 1)[1] if " " in tag else "")
                inner, tokens = _block(tokens, ("elif", "else", "endif"))
                branches.append((condition, inner))
                tag, tokens = _closed_tag(tokens, "if")
            body += _decided(branches)
        elif word == "generation":
            inner, tokens = _block(tokens, ("endgeneration",))
            tokens = _closed(tokens, "generation")
            body.append(Generation(inner))
        elif word == "set" and (m := re.fullmatch(r"set\s+([A-Za-z]\w*)\s*=\s*(.+)", value, re.S)):
            body.append(Set(m[1], expression(m[2])))
        else:
            raise TemplateError(f"unknown tag {value!r}")
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return _joined(body), []


def _closed_tag(tokens: list, what: str) -> tuple[str, list]:
    if not tokens:
        raise TemplateError(f"end of {what} is missing")
    return tokens[0][1], tokens[1:]


def _closed(tokens: list, what: str) -> list:
    return _closed_tag(tokens, what)[1]


def _decided(branches: list[tuple[Expr, tuple]]) -> list:
    live = []
    for condition, inner in branches:
        if condition.fixed and not condition.run({}):
            continue
        live.append((condition, inner))
        if condition.fixed:
            break
    return list(live[0][1]) if live and live[0][0].fixed else [If(tuple(live))] if live else []


def _joined(body: list) -> tuple:
    out: list = []
    for node in body:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].value + node.value)
        elif not isinstance(node, Text) or node.value:
            out.append(node)
    return tuple(out)


def _compiled(body: tuple, marked: bool) -> Callable[[Env], Iterator[Piece]]:
    steps = [_step(node, marked) for node in body]

    def run(env: Env) -> Iterator[Piece]:
        for s in steps:
            yield from s(env)

    return run


def _step(node: object, marked: bool) -> Callable[[Env], Iterable[Piece]]:
    match node:
        case Text(value):
            fixed = ((value, marked),)
            return lambda env: fixed
        case Print(value):
            return lambda env: ((str(value.run(env)), marked),)
        case Set(name, value):

            def assign(env: Env) -> tuple:
                env[name] = value.run(env)
                return ()

            return assign
        case Generation(inner):
            return _compiled(inner, True)
        case If(branches):
            made = [(c.run, _compiled(inner, marked)) for c, inner in branches]
            return lambda env: next((run(env) for c, run in made if c(env)), ())
        case For(name, over, inner):
            run = _compiled(inner, marked)

            def loop(env: Env) -> Iterator[Piece]:
                source = iter(over.run(env) or ())
                item, i, none = next(source, loop), 0, loop
                while item is not none:
                    following = next(source, none)
                    env[name] = item
                    env["loop"] = {"index": i + 1, "index0": i, "first": i == 0, "last": following is none}
                    yield from run(env)
                    item, i = following, i + 1

            return loop
    raise TemplateError(f"unknown node {node!r}")


class Template:
    def __init__(self, source: str = TEMPLATE) -> None:
        self.tree = parse(source)
        self._run = _compiled(self.tree, False)

    def pieces(self, messages: Iterable[dict], **names: object) -> Iterator[Piece]:
        """Rendered pieces with the mark "counts for the loss"."""
        return self._run({"messages": messages, **names})

    def render(self, messages: Iterable[dict], **names: object) -> tuple[str, list[tuple[int, int]]]:
        """Text and the loss spans, in code points."""
        out, spans, at = [], [], 0
        for text, mark in self.pieces(messages, **names):
            if mark and text:
                spans = [*spans[:-1], (spans[-1][0], at + len(text))] if spans and spans[-1][1] == at else [*spans, (at, at + len(text))]
            out.append(text)
            at += len(text)
        return "".join(out), spans


class Reader:
    """Reads the turns and the loss text back from a stream of rendered pieces; holds one turn at a time."""

    def __init__(self) -> None:
        self.turns, self.loss = sha256(), sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.held, self.spans = "", []

    def feed(self, text: str, mark: bool) -> None:
        if mark:
            self.spans.append((len(self.held), len(self.held) + len(text)))
        self.held += text
        self.chars += len(text)
        if text.endswith(EOS):
            self._turn()

    def _turn(self) -> None:
        head, _, rest = self.held.removeprefix(BOS).removeprefix(ROLE).partition(END_ROLE)
        text = unescape(rest.removesuffix(EOS))
        self.turns.update(f"{unescape(head)}\n{text}\n".encode("utf-8", "surrogatepass"))
        lost = "".join(unescape(self.held[a:b]) for a, b in self.spans)
        self.loss.update(lost.encode("utf-8", "surrogatepass"))
        self.loss_chars += len(lost)
        self.n_turns += 1
        self.held, self.spans = "", []


_SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _ordered(rows: DataFrame) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    keyed = rows.select(id_of("conv_id").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text)
    return keyed.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "text", "role")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
    for whole in batches:
        for b in slices(whole):
            for c, t, r in zip(*(x.to_pylist() for x in b.columns), strict=True):
                yield c, {"role": r, "text": t}


def digests(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per conversation, read back from the rendered stream.

    SHA-256 takes its input in order, so one task reads a conversation from end to end; it holds one turn of it.
    """
    prepare(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, out = Template(template), []
        for conv, turns in groupby(_stream(batches), key=lambda x: x[0]):
            r = Reader()
            for text, mark in made.pieces(m for _, m in turns):
                r.feed(text, mark)
            out.append((conv, r.n_turns, r.turns.hexdigest(), r.loss_chars, r.loss.hexdigest(), r.chars))
            if len(out) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return _ordered(rows).mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, text, spans): the rendered conversations; one must fit into a row."""
    prepare(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Template(template)
        for conv, turns in groupby(_stream(batches), key=lambda x: x[0]):
            text, spans = made.render(m for _, m in turns)
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "text": text, "spans": [{"a": a, "b": b} for a, b in spans]}], pa.schema([("conv_id", pa.int64()), ("text", pa.string()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))]))

    return _ordered(rows).mapInArrow(run, "conv_id long, text string, spans array<struct<a:long,b:long>>")
