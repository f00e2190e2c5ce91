"""Conversations rendered by compiled templates, with generation spans, and read back.

A template is text with `{{ expression }}` and `{% statement %}`. Statements are for/endfor,
if/elif/else/endif, set, and generation/endgeneration, whose output is what a model learns to say.
Expressions have literals, names, attribute and item access, `~ + - * // %`, comparisons, `in`, `and`,
`or`, `not`, conditional expressions, and filters from a fixed list. There are no calls, and attributes
are looked up in mappings only: a template can't reach anything it isn't given.

A template is parsed to a syntax tree, constant parts are folded, and each node becomes a Python
closure; rendering runs closures only.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class TemplateError(ValueError):
    """The template's text isn't in the language."""


@dataclass(frozen=True)
class Node:
    """A node of the syntax tree: its kind, its value (a constant, a name or an operator), its parts."""

    kind: str
    value: object = None
    parts: tuple = ()


#: Control strings of the template and of its relatives; inside texts they are escaped.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TEMPLATE = (
    "{% for m in messages %}{{ '<|im_start|>' }}{{ m.role | escape | line }}{{ '\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}{{ '<|im_end|>' ~ '\n' }}{% endfor %}"
)
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_CODES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_BACK = {"\\": "\\", "l": "<", "b": "[", "n": "\n"}


def escape(text: str) -> str:
    """`text` without control strings: their first character and every backslash are escaped."""
    return _CONTROL.sub(lambda m: _CODES[m[0][0]] + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\([\\lbn])", lambda m: _BACK[m[1]], text)


FILTERS: dict[str, Callable[[object], object]] = {
    "escape": lambda x: escape(str(x)),
    "line": lambda x: str(x).replace("\n", "\\n"),
    "trim": lambda x: str(x).strip(),
    "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(),
    "length": len,
}
_BINARY: dict[str, Callable[[object, object], object]] = {
    "~": lambda a, b: f"{a}{b}",
    "+": operator.add,
    "-": operator.sub,
    "*": operator.mul,
    "//": operator.floordiv,
    "%": operator.mod,
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "in": lambda a, b: a in b,
}
_LEVELS = (("==", "!=", "<", "<=", ">", ">=", "in"), ("~", "+", "-"), ("*", "//", "%"))
_TOKEN = re.compile(
    r"\s*(?:(?P<number>\d+)|(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<mark>==|!=|<=|>=|//|[-~+*%<>|.()\[\]]))",
    re.S,
)
_PART = re.compile(r"\{\{(?P<say>.*?)\}\}|\{%-?(?P<do>.*?)-?%\}", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, text: str):
        self.tokens, at = [], 0
        text = text.rstrip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"unreadable: {text[at : at + 20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return text if kind in ("mark", "name") else None

    def take(self, *texts: str) -> str | None:
        text = self.peek()
        if text in texts:
            self.at += 1
            return text
        return None

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"expected {text!r}")

    def whole(self) -> Node:
        node = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def choice(self) -> Node:
        node = self.either()
        if self.take("if"):
            test = self.either()
            self.need("else")
            return Node("choice", None, (test, node, self.choice()))
        return node

    def either(self) -> Node:
        node = self.both()
        while self.take("or"):
            node = Node("or", None, (node, self.both()))
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.take("and"):
            node = Node("and", None, (node, self.negated()))
        return node

    def negated(self) -> Node:
        return Node("not", None, (self.negated(),)) if self.take("not") else self.level(0)

    def level(self, k: int) -> Node:
        if k == len(_LEVELS):
            return self.filtered()
        node = self.level(k + 1)
        while op := self.take(*_LEVELS[k]):
            node = Node("binary", op, (node, self.level(k + 1)))
        return node

    def filtered(self) -> Node:
        node = self.access()
        while self.take("|"):
            name = self.peek()
            if name not in FILTERS:
                raise TemplateError(f"no such filter: {name!r}")
            self.at += 1
            node = Node("filter", name, (node,))
        return node

    def access(self) -> Node:
        node = self.atom()
        while mark := self.take(".", "["):
            if mark == ".":
                kind, name = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
                if kind != "name":
                    raise TemplateError("a name has to follow the point")
                self.at += 1
                node = Node("item", None, (node, Node("constant", name)))
            else:
                node = Node("item", None, (node, self.choice()))
                self.need("]")
        return node

    def atom(self) -> Node:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too soon")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "number":
            return Node("constant", int(text))
        if kind == "string":
            return Node("constant", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "name":
            words = {"true": True, "false": False, "none": None}
            return Node("constant", words[text]) if text in words else Node("name", text)
        if text == "(":
            node = self.choice()
            self.need(")")
            return node
        if text == "-":
            return Node("binary", "-", (Node("constant", 0), self.access()))
        raise TemplateError(f"unexpected {text!r}")


def parse(template: str) -> Node:
    """The syntax tree of a template."""
    stack: list[list] = [["body", None, []]]  # kind, head, parts; an if has its branches as parts
    at = 0
    for m in _PART.finditer(template):
        if m.start() > at:
            stack[-1][2].append(Node("constant", template[at : m.start()]))
        at = m.end()
        if m["say"] is not None:
            stack[-1][2].append(_Expression(m["say"]).whole())
            continue
        word, _, rest = m["do"].strip().partition(" ")
        if word == "for":
            name, _, source = rest.partition(" in ")
            if not name.strip().isidentifier():
                raise TemplateError(f"not a name: {name!r}")
            stack.append(["for", (name.strip(), _Expression(source).whole()), []])
        elif word in ("if", "generation"):
            stack.append([word, _Expression(rest).whole() if word == "if" else None, []])
        elif word in ("elif", "else"):
            kind, head, parts = stack.pop()
            if kind not in ("if", "elif"):
                raise TemplateError(f"{word} without if")
            stack += [["branch", (kind, head), parts], [word, _Expression(rest).whole() if word == "elif" else Node("constant", True), []]]
        elif word == "set":
            name, _, source = rest.partition("=")
            stack[-1][2].append(Node("set", name.strip(), (_Expression(source).whole(),)))
        elif word in ("endfor", "endif", "endgeneration"):
            _close(stack, word)
        else:
            raise TemplateError(f"no such statement: {word!r}")
    if at < len(template):
        stack[-1][2].append(Node("constant", template[at:]))
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} isn't closed")
    return Node("body", None, tuple(stack[0][2]))


def _close(stack: list[list], word: str) -> None:
    """Make the innermost open block a node of what is around it."""
    kind, head, parts = stack.pop()
    body = Node("body", None, tuple(parts))
    if word == "endfor" and kind == "for":
        node = Node("for", head[0], (head[1], body))
    elif word == "endgeneration" and kind == "generation":
        node = Node("generation", None, (body,))
    elif word == "endif" and kind in ("if", "elif", "else"):
        branches = [(head, body)]
        while kind != "if":
            _, (kind, head), parts = stack.pop()
            branches.append((head, Node("body", None, tuple(parts))))
        node = Node("if", None, tuple(x for b in reversed(branches) for x in b))
    else:
        raise TemplateError(f"{word} closes {kind}")
    stack[-1][2].append(node)


def fold(node: Node) -> Node:
    """The tree with constant expressions evaluated, constant branches chosen and adjacent texts joined."""
    parts = tuple(fold(p) for p in node.parts)
    node = Node(node.kind, node.value, parts)
    constant = all(p.kind == "constant" for p in parts)
    if node.kind in ("binary", "filter", "not", "and", "or", "choice", "item") and constant:
        try:
            return Node("constant", _expression(node)({}))
        except Exception:  # left for the rendering that reaches it
            return node
    if node.kind == "if":
        kept: list[Node] = []
        for test, body in zip(parts[::2], parts[1::2]):
            if test.kind == "constant" and not test.value:
                continue
            if test.kind == "constant" and not kept:
                return body
            kept += [test, body]
            if test.kind == "constant":
                break
        return Node("if", None, tuple(kept)) if kept else Node("body")
    if node.kind == "body":
        flat: list[Node] = []
        for p in parts:
            for q in p.parts if p.kind == "body" else (p,):
                if q.kind == "constant":
                    q = Node("constant", "" if q.value is None else str(q.value))
                    if flat and flat[-1].kind == "constant":
                        q = Node("constant", flat.pop().value + q.value)
                flat.append(q)
        return Node("body", None, tuple(flat))
    return node


def _lookup(holder: object, key: object) -> object:
    if isinstance(holder, dict):
        return holder.get(key)
    if isinstance(holder, (list, str)) and isinstance(key, int):
        return holder[key] if -len(holder) <= key < len(holder) else None
    return None


def _expression(node: Node) -> Callable[[dict], object]:
    """A closure from variables to the expression's value."""
    if node.kind == "constant":
        value = node.value
        return lambda scope: value
    if node.kind == "name":
        name = node.value
        return lambda scope: scope.get(name)
    sub = [_expression(p) for p in node.parts]
    if node.kind == "filter":
        apply, (inner,) = FILTERS[node.value], sub
        return lambda scope: apply(inner(scope))
    if node.kind == "not":
        return lambda scope: not sub[0](scope)
    left, right = sub[0], sub[1]
    if node.kind == "binary":
        combine = _BINARY[node.value]
        return lambda scope: combine(left(scope), right(scope))
    if node.kind == "and":
        return lambda scope: left(scope) and right(scope)
    if node.kind == "or":
        return lambda scope: left(scope) or right(scope)
    if node.kind == "item":
        return lambda scope: _lookup(left(scope), right(scope))
    other = sub[2]
    return lambda scope: right(scope) if left(scope) else other(scope)


class _Output:
    """Rendered parts, their length so far, and the generation spans."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def say(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _statement(node: Node) -> Callable[[dict, _Output], None]:
    """A closure that renders a node."""
    if node.kind == "body":
        steps = [_statement(p) for p in node.parts]

        def body(scope: dict, out: _Output) -> None:
            for step in steps:
                step(scope, out)

        return body
    if node.kind == "for":
        name, source, inner = node.value, _expression(node.parts[0]), _statement(node.parts[1])

        def loop(scope: dict, out: _Output) -> None:
            items = source(scope) or []
            for k, item in enumerate(items):
                inner({**scope, name: item, "loop": {"index0": k, "index": k + 1, "first": k == 0, "last": k == len(items) - 1}}, out)

        return loop
    if node.kind == "if":
        branches = [(_expression(t), _statement(b)) for t, b in zip(node.parts[::2], node.parts[1::2])]

        def choose(scope: dict, out: _Output) -> None:
            for test, then in branches:
                if test(scope):
                    return then(scope, out)

        return choose
    if node.kind == "generation":
        inner = _statement(node.parts[0])

        def generation(scope: dict, out: _Output) -> None:
            begin = out.length
            inner(scope, out)
            out.spans.append((begin, out.length))

        return generation
    if node.kind == "set":
        name, value = node.value, _expression(node.parts[0])

        def assign(scope: dict, out: _Output) -> None:
            scope[name] = value(scope)

        return assign
    if node.kind == "constant":
        text = str(node.value)
        return lambda scope, out: out.say(text)
    value = _expression(node)

    def say(scope: dict, out: _Output) -> None:
        found = value(scope)
        out.say("" if found is None else str(found))

    return say


def compile_template(template: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from variables to (text, generation spans in code points)."""
    run = _statement(fold(parse(template)))

    def render(variables: dict) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        run(dict(variables), out)
        return "".join(out.parts), out.spans

    return render


_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, formatted, spans) per conversation of (conv_id, turn, role, text).

    Turns are ordered by turn (null first), equal ones by role and text. Null roles and texts are
    empty; rows without a conv_id are one conversation. Repeated rows are turns of their own. Other
    columns are ignored. A conversation is one row of the result, so all of its turns meet in one
    task; that is as long as the row itself.
    """
    compile_template(template)
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("messages"))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for batch in batches:
            made = [render({"messages": m.as_py()}) for m in batch.column("messages")]
            spans = [[{"start": s, "end": e} for s, e in found] for _, found in made]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array([t for t, _ in made], pa.string()), pa.array(spans, kind)], ["conv_id", "formatted", "spans"]
            )

    key = turns.schema["conv_id"].dataType.simpleString()
    return whole.mapInArrow(run, f"conv_id {key}, formatted string, spans array<struct<start:int,end:int>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (role, text), loss, formatted_chars) from texts that `TEMPLATE` made."""
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, loss, chars = [], [], []
            for text, spans in zip(batch.column("formatted"), batch.column("spans")):
                text = text.as_py()
                found = _TURN.findall(text)
                if sum(len(r) + len(t) + len("<|im_start|>\n<|im_end|>\n") for r, t in found) != len(text):
                    raise ValueError("a formatted text has parts outside its turns")
                turns.append([{"role": unescape(r), "text": unescape(t)} for r, t in found])
                loss.append("".join(unescape(text[s["start"] : s["end"]]) for s in spans.as_py()))
                chars.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(turns, kind), pa.array(loss, pa.string()), pa.array(chars, pa.int64())],
                ["conv_id", "turns", "loss", "formatted_chars"],
            )

    key = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(run, f"conv_id {key}, turns array<struct<role:string,text:string>>, loss string, formatted_chars bigint")


#: A conversation whose texts are control strings, formatted with all others.
PROBE_ID, PROBE_TEXT = -1, "</s>[INST] ok [/INST]"


def chat_report(conversations: DataFrame) -> DataFrame:
    """Digests of what formatted conversations say when read back; the probe conversation is added."""
    spark = conversations.sparkSession
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)], "conv_id bigint, turn bigint, role string, text string")
    turns = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    back = read_back(format_conversations(turns.unionByName(probe)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
