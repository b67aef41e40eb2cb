"""Chat formatting: a compiler for a small sandboxed template language, and rendering of conversations with it.

Language.  Text; ``{{ expr }}``; ``{% if expr %} .. {% elif expr %} .. {% else %} .. {% endif %}``;
``{% for name in expr %} .. {% endfor %}`` with ``loop.index0``, ``loop.first`` and ``loop.last``;
``{% generation %} .. {% endgeneration %}`` around what a model is trained on; ``{# comment #}``.  Expressions have
string and integer literals, true/false/none, names, ``a.b`` and ``a["b"]``, ``== != and or not in``, ``+`` and
``~``, parentheses, and the filters ``| trim | upper | lower | escape | length``.

Sandbox.  Names come from the given context only; ``.`` and ``[]`` look up keys of mappings and nothing else; there
are no calls, no attributes of Python objects, no loops other than ``for``.  An unknown name or key is none.

Compiling.  The source is parsed to a syntax tree (``Node`` tuples), constant expressions are folded and constant
branches dropped, and each node becomes a Python closure ``closure(scope) -> iterator of (text, trained)``.
Rendering is lazy: a ``for`` reads one item ahead, so a conversation of any length streams through.

Escaping.  Control strings of the template would be ambiguous inside a text, so there a backslash is put before
each backslash and before each control string; ``unescape`` drops the backslash again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import column

OPEN, CLOSE = "### ", "</turn>"
#: Strings the template uses to mark turns; inside texts they are escaped.
CONTROL = ("### System:", "### User:", "### Assistant:", "### Turn", "</turn>")
TEMPLATE = """\
{% for m in messages %}\
{% if m.role == "assistant" %}### Assistant: {% generation %}{{ m.text | escape }}{% endgeneration %}\
{% elif m.role == "user" %}### User: {{ m.text | escape }}\
{% elif m.role == "system" %}### System: {{ m.text | escape }}\
{% else %}### Turn {{ m.role | escape }}</turn>{{ m.text | escape }}\
{% endif %}</turn>{% if not loop.last %}{{ "\\n" }}{% endif %}\
{% endfor %}"""

_CONTROL = re.compile("|".join([r"\\", *map(re.escape, CONTROL)]))
_TOKEN = re.compile(r"""\s*(?:(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[-+~|.\[\]()]))""")
_PIECE = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
Node = tuple
Closure = Callable[[dict], Iterator[tuple[str, bool]]]


class TemplateError(ValueError):
    """The template is not valid in this language."""


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


# --- parsing --------------------------------------------------------------------------------------------------


def _tokens(source: str) -> list[tuple[str, Any]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"unexpected {source[at:at + 10]!r}")
        kind = m.lastgroup
        value = m.group(kind)
        if kind == "str":
            value = re.sub(r"\\(.)", lambda e: {"n": "\n", "t": "\t"}.get(e.group(1), e.group(1)), value[1:-1], flags=re.S)
        out.append((kind, int(value) if kind == "int" else value))
        at = m.end()
    return [*out, ("end", None)]


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, self.at = _tokens(source), 0

    def parse(self) -> Node:
        node = self.either()
        self.need("end", None)
        return node

    def take(self, kind: str, *values: Any) -> Any:
        k, v = self.tokens[self.at]
        if k == kind and (not values or v in values):
            self.at += 1
            return v if v is not None else True
        return None

    def need(self, kind: str, value: Any) -> None:
        if self.take(kind, *([] if value is None else [value])) is None:
            raise TemplateError(f"expected {value or kind}, found {self.tokens[self.at][1]!r}")

    def either(self) -> Node:
        node = self.both()
        while self.take("name", "or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.take("name", "and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> Node:
        return ("not", self.negated()) if self.take("name", "not") else self.compared()

    def compared(self) -> Node:
        node = self.joined()
        while True:
            if op := self.take("op", "==", "!="):
                node = (op, node, self.joined())
            elif self.take("name", "in"):
                node = ("in", node, self.joined())
            else:
                return node

    def joined(self) -> Node:
        node = self.filtered()
        while op := self.take("op", "+", "~"):
            node = (op, node, self.filtered())
        return node

    def filtered(self) -> Node:
        node = self.looked_up()
        while self.take("op", "|"):
            name = self.take("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            node = ("filter", name, node)
        return node

    def looked_up(self) -> Node:
        node = self.atom()
        while True:
            if self.take("op", "."):
                name = self.take("name")
                if not name:
                    raise TemplateError("a name must follow the dot")
                node = ("get", node, ("const", name))
            elif self.take("op", "["):
                node = ("get", node, self.either())
                self.need("op", "]")
            else:
                return node

    def atom(self) -> Node:
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind in ("str", "int"):
            return ("const", value)
        if kind == "name" and value not in ("and", "or", "in", "not"):
            fixed = {"true": True, "false": False, "none": None}
            return ("const", fixed[value]) if value in fixed else ("name", value)
        if kind == "op" and value == "(":
            node = self.either()
            self.need("op", ")")
            return node
        raise TemplateError(f"unexpected {value!r}")


FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(), "lower": lambda v: _text(v).lower(),
    "escape": lambda v: escape(_text(v)), "length": lambda v: len(v) if isinstance(v, (str, list, tuple, dict)) else 0,
}


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else {True: "true", False: "false"}[value] if isinstance(value, bool) else str(value)


def parse(source: str) -> Node:
    """Syntax tree of a template: ``("block", [nodes])``."""
    pieces = [p for p in _PIECE.split(source) if p]
    node, at = _block(pieces, 0, ())
    if at < len(pieces):
        raise TemplateError(f"unexpected {pieces[at]!r}")
    return node


def _block(pieces: list[str], at: int, ends: tuple[str, ...]) -> tuple[Node, int]:
    """Nodes up to a tag that starts with one of ``ends``."""
    nodes: list[Node] = []
    while at < len(pieces):
        p = pieces[at]
        if p.startswith("{{") and p.endswith("}}"):
            nodes.append(("print", _Expression(p[2:-2]).parse()))
        elif p.startswith("{%") and p.endswith("%}"):
            body = p[2:-2].strip()
            word = body.split(None, 1)[0] if body else ""
            if word in ends:
                return ("block", nodes), at
            node, at = _tag(word, body[len(word):], pieces, at)
            nodes.append(node)
        elif not p.startswith("{#"):
            nodes.append(("text", p))
        at += 1
    if ends:
        raise TemplateError(f"missing {' or '.join(ends)}")
    return ("block", nodes), at


def _tag(word: str, rest: str, pieces: list[str], at: int) -> tuple[Node, int]:
    """One compound tag and the position of its closing tag."""
    if word == "for":
        m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
        if not m:
            raise TemplateError(f"for needs a name and a list: {rest!r}")
        body, end = _block(pieces, at + 1, ("endfor",))
        return ("for", m.group(1), _Expression(m.group(2)).parse(), body), end
    if word == "generation":
        body, end = _block(pieces, at + 1, ("endgeneration",))
        return ("generation", body), end
    if word in ("if", "elif"):
        test = _Expression(rest).parse()
        body, end = _block(pieces, at + 1, ("elif", "else", "endif"))
        closing = pieces[end][2:-2].strip()
        if closing.startswith("elif"):
            other, end = _tag("elif", closing[4:], pieces, end)
        elif closing == "else":
            other, end = _block(pieces, end + 1, ("endif",))
        else:
            other = ("block", [])
        return ("if", test, body, other), end
    raise TemplateError(f"unknown tag {word!r}")


# --- folding --------------------------------------------------------------------------------------------------


def fold(node: Node) -> Node:
    """The tree with constant expressions evaluated, constant branches dropped and neighbouring texts joined."""
    kind = node[0]
    if kind in ("const", "name", "text"):
        return node
    if kind == "block":
        out: list[Node] = []
        for child in map(fold, node[1]):
            if child[0] == "print" and child[1][0] == "const":
                child = ("text", _text(child[1][1]))
            for c in child[1] if child[0] == "block" else [child]:
                if c == ("text", ""):
                    continue
                if c[0] == "text" and out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1] + c[1])
                else:
                    out.append(c)
        return ("block", out)
    if kind == "if":
        test, body, other = map(fold, node[1:])
        return (body if test[1] else other) if test[0] == "const" else ("if", test, body, other)
    if kind == "for":
        return ("for", node[1], fold(node[2]), fold(node[3]))
    if kind == "filter":
        inner = fold(node[2])
        return ("const", FILTERS[node[1]](inner[1])) if inner[0] == "const" else ("filter", node[1], inner)
    children = [fold(c) for c in node[1:]]
    folded = (kind, *children)
    if kind in ("print", "generation"):
        return folded
    return ("const", _evaluate(folded)({})) if all(c[0] == "const" for c in children) else folded


# --- closures -------------------------------------------------------------------------------------------------


def _evaluate(node: Node) -> Callable[[dict], Any]:
    """Closure for an expression."""
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda scope: value
    if kind == "name":
        name = node[1]
        return lambda scope: scope.get(name)
    if kind == "filter":
        apply, inner = FILTERS[node[1]], _evaluate(node[2])
        return lambda scope: apply(inner(scope))
    parts = [_evaluate(c) for c in node[1:]]
    if kind == "not":
        return lambda scope: not parts[0](scope)
    left, right = parts
    if kind == "and":
        return lambda scope: left(scope) and right(scope)
    if kind == "or":
        return lambda scope: left(scope) or right(scope)
    if kind == "==":
        return lambda scope: left(scope) == right(scope)
    if kind == "!=":
        return lambda scope: left(scope) != right(scope)
    if kind == "in":
        return lambda scope: _contains(right(scope), left(scope))
    if kind == "~":
        return lambda scope: _text(left(scope)) + _text(right(scope))
    if kind == "+":
        return lambda scope: _add(left(scope), right(scope))
    if kind == "get":
        return lambda scope: _get(left(scope), right(scope))
    raise TemplateError(f"not an expression: {kind}")


def _get(holder: Any, key: Any) -> Any:
    return holder.get(key) if isinstance(holder, dict) and isinstance(key, (str, int)) else None


def _contains(holder: Any, item: Any) -> bool:
    if isinstance(holder, str):
        return isinstance(item, str) and item in holder
    return isinstance(holder, (dict, list, tuple)) and item in holder


def _add(a: Any, b: Any) -> Any:
    return a + b if type(a) is int and type(b) is int else _text(a) + _text(b)


def _closure(node: Node, trained: bool = False) -> Closure:
    """Closure for a statement; yields ``(text, trained)`` parts."""
    kind = node[0]
    if kind == "text":
        part = (node[1], trained)
        return lambda scope: iter((part,))
    if kind == "print":
        value = _evaluate(node[1])
        return lambda scope: iter(((_text(value(scope)), trained),))
    if kind == "generation":
        return _closure(node[1], True)
    if kind == "if":
        test, body, other = _evaluate(node[1]), _closure(node[2], trained), _closure(node[3], trained)
        return lambda scope: body(scope) if test(scope) else other(scope)
    if kind == "block":
        parts = [_closure(c, trained) for c in node[1]]

        def block(scope: dict) -> Iterator[tuple[str, bool]]:
            for p in parts:
                yield from p(scope)
        return block
    if kind == "for":
        name, items, body = node[1], _evaluate(node[2]), _closure(node[3], trained)

        def loop(scope: dict) -> Iterator[tuple[str, bool]]:
            source = iter(items(scope) or ())
            ahead = next(source, _END)
            index = 0
            while ahead is not _END:
                item, ahead = ahead, next(source, _END)
                state = {"index0": index, "first": index == 0, "last": ahead is _END}
                yield from body({**scope, name: item, "loop": state})
                index += 1
        return loop
    raise TemplateError(f"not a statement: {kind}")


_END = object()


def compile_template(source: str) -> Closure:
    """``closure(context) -> iterator of (text, trained)`` for a template."""
    return _closure(fold(parse(source)))


# --- reading back ---------------------------------------------------------------------------------------------


_HEADS = {"### Assistant: ": "assistant", "### User: ": "user", "### System: ": "system"}
_PLAIN_END = re.compile(r"(?:[^\\]|\\.)*?(?=</turn>)", re.S)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    formatted = formatted.removesuffix("\n") if formatted.endswith("</turn>\n") else formatted
    for head, role in _HEADS.items():
        if formatted.startswith(head):
            return role, unescape(_closed(formatted[len(head):]))
    if not formatted.startswith("### Turn "):
        raise ValueError("not a formatted turn")
    rest = formatted[len("### Turn "):]
    role = _PLAIN_END.match(rest).group()
    return unescape(role), unescape(_closed(rest[len(role) + len(CLOSE):]))


def _closed(body: str) -> str:
    text = _PLAIN_END.match(body).group()
    if body[len(text):] != CLOSE:
        raise ValueError("a turn must end with its closing mark")
    return text


# --- rendering on Spark ---------------------------------------------------------------------------------------


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column(batch, c).to_pylist() for c in ("conv_id", "role", "text")), strict=True)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, Iterator[dict]]]:
    """Each conversation of a sorted partition as ``(conv_id, iterator of turns)``, read as it is consumed."""
    rows = _rows(batches)
    head = next(rows, None)
    while head is not None:
        conv = head[0]

        def turns() -> Iterator[dict]:
            nonlocal head
            while head is not None and head[0] == conv:
                turn = {"role": head[1] or "", "text": head[2] or ""}
                head = next(rows, None)
                yield turn

        mine = turns()
        yield conv, mine
        for _ in mine:
            pass


def _ordered(conversations: DataFrame) -> DataFrame:
    """Turns of each conversation together and in order: turn (null first), role, text."""
    t = conversations.select("conv_id", "turn", "role", "text")
    return t.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def render(conversations: DataFrame, template: str = TEMPLATE, turns_each: int = 64) -> DataFrame:
    """Formatted conversations as ``(conv_id, part, text, spans)``.

    A conversation is its parts' texts in order; a part holds the output of up to ``turns_each`` turns, so that a
    very long conversation is many rows.  ``spans``: start and end (code points of that part) of what is trained on.
    """
    compile_template(template)  # a faulty template fails here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closure = compile_template(template)
        for conv, turns in _conversations(batches):
            seen = 0

            def counted() -> Iterator[dict]:
                nonlocal seen
                for t in turns:
                    seen += 1
                    yield t

            part, texts, spans, size, due = 0, [], [], 0, turns_each
            for text, trained in closure({"messages": counted()}):
                if seen - 1 > due and texts:
                    yield _part(conv, part, texts, spans)
                    part, texts, spans, size, due = part + 1, [], [], 0, seen - 1 + turns_each
                if trained and text:
                    spans.append({"start": size, "end": size + len(text)})
                texts.append(text)
                size += len(text)
            yield _part(conv, part, texts, spans)

    return _ordered(conversations).mapInArrow(run, "conv_id long, part int, text string, spans array<struct<start:int,end:int>>")


def _part(conv: Any, part: int, texts: list[str], spans: list[dict]) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.record_batch({"conv_id": pa.array([conv], pa.int64()), "part": pa.array([part], pa.int32()),
                            "text": pa.array(["".join(texts)], pa.string()), "spans": pa.array([spans], kind)})


def digests(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Per conversation, read back from its formatted output: number of turns, digests of turns and trained text, sizes.

    Turns are read off the output's own marks (``read_turn``) and the trained text off the spans, both unescaped; a
    conversation streams through one turn at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closure = compile_template(template)
        out: dict[str, list] = {k: [] for k in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        for conv, turns in _conversations(batches):
            told, loss, n, chars, size, held = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, ""
            for text, trained in closure({"messages": turns}):
                size += len(text)
                held += text
                if trained:
                    plain = unescape(text)
                    chars += len(plain)
                    loss.update(plain.encode())
                if text.endswith(CLOSE) and not trained and _complete(held):
                    role, said = read_turn(held.lstrip("\n") if n else held)
                    told.update(f"{role}\n{said}\n".encode())
                    n, held = n + 1, ""
            if held.strip("\n"):
                raise ValueError("the output does not end with a turn")
            for k, v in zip(out, (conv, n, told.hexdigest(), chars, loss.hexdigest(), size), strict=True):
                out[k].append(v)
            if len(out["conv_id"]) >= 5000:
                yield _digest_batch(out)
                out = {k: [] for k in out}
        yield _digest_batch(out)

    return _ordered(conversations).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _complete(held: str) -> bool:
    """Whether the text is a whole turn: one closing mark, or two where the role is spelled out."""
    body = held.lstrip("\n")
    plain = re.sub(r"\\.", "", body, flags=re.S).count(CLOSE)
    return plain == (2 if body.startswith("### Turn ") else 1)


def _digest_batch(out: dict[str, list]) -> pa.RecordBatch:
    kinds = {"conv_id": pa.int64(), "n_turns": pa.int64(), "loss_chars": pa.int64(), "formatted_chars": pa.int64()}
    return pa.record_batch({k: pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()})


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations plus conversation -7, whose texts hold control strings of the template."""
    said = r"\### Assistant: </turn> ok"
    probe = conversations.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                                       "conv_id long, turn long, role string, text string")
    kept = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return kept.unionByName(probe)
