"""Chat formatting (operator 10): a small template language, compiled to Python closures.

Language: text, {{ expression }}, {% for x in expression %} ... {% endfor %}, {% if expression %} ... {% elif expression %}
... {% else %} ... {% endif %} and {% generation %} ... {% endgeneration %}, which marks what a model is trained on.
Expressions: names, name.field, "strings", integers, true, false, none, ==, !=, not, and, or, ~ (joins strings), brackets and
filters (value | name). It is sandboxed by what it lacks: there are no calls, no item access, no assignments; a field is
only ever looked up in a mapping, filters are a fixed set, and compiling raises TemplateError on anything else.

The syntax tree is folded (operators and filters over constants, if-branches on constants, neighbouring texts) and turned
into generator closures, so `for` consumes lazy iterables and a conversation of any length is rendered in bounded memory.

Defined cases: rows are ordered by turn, role and text, nulls first, so ties and repeated rows have one order; null roles
and texts are empty strings; rows of a null conv_id form one conversation; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The control strings of the default template. In texts they get a backslash after their first character.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}{% if m.role == 'assistant' %}<s>{{ m.role | escape }}\n{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}[INST]{{ m.role | escape }}\n{{ m.text | escape }}[/INST]{% endif %}{% endfor %}"
)
PART_CHARS = 1 << 16  # a rendered conversation is written in parts of about so many characters

_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_MARK = re.compile("|".join(map(re.escape, CONTROL)))


def escape(text: str) -> str:
    """Doubles backslashes and breaks up control strings; unescape() gives the text back."""
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


class TemplateError(ValueError):
    pass


FILTERS: dict[str, Callable] = {"escape": lambda v: escape(str(v)), "trim": lambda v: str(v).strip(), "upper": lambda v: str(v).upper(), "lower": lambda v: str(v).lower(), "length": len}

# ---- syntax tree: tuples whose first item is the kind ----
_TAG = re.compile(r"\{\{(.*?)\}\}|\{%-?\s*(.*?)\s*-?%\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[~|().]))")
_CONSTANT = {"true": True, "false": False, "none": None}
_SLASHED = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent: or, and, not, comparison, ~, filters, atom."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.tokens.append(("end", ""))
        self.at = 0

    def take(self, *wanted: str) -> str | None:
        if self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self) -> tuple:
        node = self.either()
        if self.tokens[self.at][0] != "end":
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.joined()
        while op := self.take("==", "!="):
            node = (op, node, self.joined())
        return node

    def joined(self) -> tuple:
        node = self.filtered()
        while self.take("~"):
            node = ("~", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.atom()
        while True:
            if self.take("|"):
                kind, name = self.tokens[self.at]
                if kind != "name" or name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                node = ("filter", name, node)
            elif self.take("."):
                kind, name = self.tokens[self.at]
                if kind != "name" or name.startswith("_"):
                    raise TemplateError(f"no field {name!r}")
                node = ("field", name, node)
            else:
                return node
            self.at += 1

    def atom(self) -> tuple:
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: _SLASHED.get(m[1], m[1]), text[1:-1]))
        if kind == "int":
            return ("const", int(text))
        if kind == "name" and text in _CONSTANT:
            return ("const", _CONSTANT[text])
        if kind == "name" and text not in ("or", "and", "not"):
            return ("name", text)
        if text == "(":
            node = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return node
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str) -> list:
    """The syntax tree of a template: a list of nodes."""
    root: list = []
    open_blocks: list = [("", root, None)]
    at = 0
    for m in _TAG.finditer(source):
        here = open_blocks[-1][1]
        if m.start() > at:
            here.append(("text", source[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            here.append(("out", _Expression(m[1]).whole()))
            continue
        word, _, rest = m[2].partition(" ")
        if word == "for":
            f = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
            if not f:
                raise TemplateError(f"can't read for {rest!r}")
            body: list = []
            here.append(("for", f[1], _Expression(f[2]).whole(), body))
            open_blocks.append(("for", body, None))
        elif word == "if":
            body, branches = [], []
            branches.append((_Expression(rest).whole(), body))
            here.append(("if", branches))
            open_blocks.append(("if", body, branches))
        elif word in ("elif", "else") and open_blocks[-1][0] == "if":
            body, branches = [], open_blocks[-1][2]
            branches.append((_Expression(rest).whole() if word == "elif" else ("const", True), body))
            open_blocks[-1] = ("if", body, branches)
        elif word == "generation":
            body = []
            here.append(("generation", body))
            open_blocks.append(("generation", body, None))
        elif word.startswith("end") and word[3:] == open_blocks[-1][0] and len(open_blocks) > 1:
            open_blocks.pop()
        else:
            raise TemplateError(f"unexpected tag {m[2]!r}")
    if len(open_blocks) > 1:
        raise TemplateError(f"{open_blocks[-1][0]} isn't ended")
    if at < len(source):
        root.append(("text", source[at:]))
    return root


def _fold_expression(e: tuple) -> tuple:
    if e[0] in ("const", "name"):
        return e
    parts = [_fold_expression(x) if isinstance(x, tuple) else x for x in e[1:]]
    folded = (e[0], *parts)
    if e[0] != "field" and all(not isinstance(x, tuple) or x[0] == "const" for x in parts):
        return ("const", _compile_expression(folded)({}))
    return folded


def fold(nodes: list) -> list:
    """The same tree with constants computed, constant branches resolved and neighbouring texts joined."""
    out: list = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node[0] != "text" or node[1]:
            out.append(node)

    for node in nodes:
        if node[0] == "out":
            e = _fold_expression(node[1])
            add(("text", _shown(e[1])) if e[0] == "const" else ("out", e))
        elif node[0] == "for":
            add(("for", node[1], _fold_expression(node[2]), fold(node[3])))
        elif node[0] == "generation":
            add(("generation", fold(node[1])))
        elif node[0] == "if":
            left = []
            for test, body in ((_fold_expression(t), fold(b)) for t, b in node[1]):
                if test[0] != "const":
                    left.append((test, body))
                elif test[1]:
                    left.append((test, body))
                    break
            if left and left[0][0][0] == "const":
                for x in left[0][1]:
                    add(x)
            elif left:
                add(("if", left))
        else:
            add(node)
    return out


def _shown(value) -> str:
    return "" if value is None else str(value)


def _compile_expression(e: tuple) -> Callable[[dict], object]:
    kind = e[0]
    if kind == "const":
        value = e[1]
        return lambda scope: value
    if kind == "name":
        name = e[1]
        return lambda scope: scope.get(name)
    if kind == "field":
        name, of = e[1], _compile_expression(e[2])
        return lambda scope: v.get(name) if isinstance(v := of(scope), dict) else None
    if kind == "filter":
        f, of = FILTERS[e[1]], _compile_expression(e[2])
        return lambda scope: f("" if (v := of(scope)) is None else v)
    if kind == "not":
        of = _compile_expression(e[1])
        return lambda scope: not of(scope)
    a, b = _compile_expression(e[1]), _compile_expression(e[2])
    return {
        "or": lambda scope: a(scope) or b(scope), "and": lambda scope: a(scope) and b(scope), "==": lambda scope: a(scope) == b(scope),
        "!=": lambda scope: a(scope) != b(scope), "~": lambda scope: _shown(a(scope)) + _shown(b(scope)),
    }[kind]


def _compile_nodes(nodes: list, marked: bool) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    made = [_compile_node(n, marked) for n in nodes]

    def run(scope: dict) -> Iterator[tuple[str, bool]]:
        for f in made:
            yield from f(scope)

    return made[0] if len(made) == 1 else run


def _compile_node(node: tuple, marked: bool) -> Callable[[dict], Iterator[tuple[str, bool]]]:
    if node[0] == "text":
        piece = ((node[1], marked),)
        return lambda scope: piece
    if node[0] == "out":
        of = _compile_expression(node[1])
        return lambda scope: ((_shown(of(scope)), marked),)
    if node[0] == "generation":
        return _compile_nodes(node[1], True)
    if node[0] == "if":
        branches = [(_compile_expression(t), _compile_nodes(b, marked)) for t, b in node[1]]
        return lambda scope: next((b(scope) for t, b in branches if t(scope)), ())
    name, items, body = node[1], _compile_expression(node[2]), _compile_nodes(node[3], marked)

    def loop(scope: dict) -> Iterator[tuple[str, bool]]:
        inner = dict(scope)
        for item in items(scope) or ():
            inner[name] = item
            yield from body(inner)

    return loop


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[tuple[str, bool]]]:
    """messages (lazy, mappings) -> pieces of the formatted text, each with whether it is under the loss mask."""
    run = _compile_nodes(fold(parse(source)), False)
    return lambda messages: iter(run({"messages": messages}))


def _parts(pieces: Iterable[tuple[str, bool]]) -> Iterator[tuple[str, list[int], list[int]]]:
    """(text, starts and ends of the mask within it) of about PART_CHARS; a masked stretch isn't cut."""
    text, size, starts, ends = [], 0, [], []
    for piece, marked in pieces:
        if not piece:
            continue
        if marked and ends and ends[-1] == size:
            ends[-1] += len(piece)
        else:
            if size >= PART_CHARS:
                yield "".join(text), starts, ends
                text, size, starts, ends = [], 0, [], []
            if marked:
                starts.append(size)
                ends.append(size + len(piece))
        text.append(piece)
        size += len(piece)
    yield "".join(text), starts, ends


_ROWS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("mask_starts", pa.list_(pa.int32())), ("mask_ends", pa.list_(pa.int32()))])


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """turns(conv_id, turn, role, text) -> (conv_id, part from 0, text, mask_starts, mask_ends): the formatted conversation in
    parts, in order within a partition that holds the whole conversation; offsets are within the part."""
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    compile_template(template)  # errors show here

    def each(batches):
        render = compile_template(template)
        stream = ((c, {"role": r, "text": t}) for b in batches for at in range(0, b.num_rows, 512) for c, r, t in zip(*(b.slice(at, 512).column(k).to_pylist() for k in (0, 2, 3)), strict=True))
        out: list = []
        size = 0
        for conv, messages in groupby(stream, key=lambda x: x[0]):
            for part, (text, starts, ends) in enumerate(_parts(render(m for _, m in messages))):
                out.append((conv, part, text, starts, ends))
                size += len(text)
                if size > 4 * PART_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), _ROWS.types, strict=True)], schema=_ROWS)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), _ROWS.types, strict=True)], schema=_ROWS)

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(each, "conv_id long, part long, text string, mask_starts array<int>, mask_ends array<int>")


class Reader:
    """Reads the default template's output back, part by part."""

    def __init__(self) -> None:
        self.rest, self.turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, starts: list[int], ends: list[int]) -> None:
        self.chars += len(text)
        for a, b in zip(starts, ends, strict=True):
            said = unescape(text[a:b])
            self.loss_chars += len(said)
            self.loss_hash.update(said.encode("utf-8"))
        text, opened, at = self.rest + text, None, 0
        for m in _MARK.finditer(text):
            if m[0] in ("<s>", "[INST]"):
                opened = m.end()
            elif opened is not None:
                role, _, said = text[opened : m.start()].partition("\n")
                self.turns += 1
                self.turns_hash.update(f"{unescape(role)}\n{unescape(said)}\n".encode())
                opened, at = None, m.end()
        self.rest = text[at:]


def read_back(formatted: DataFrame) -> DataFrame:
    """format_conversations()'s rows -> (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), one row per
    conversation; it must follow without an exchange, as it relies on the order of the parts."""

    def each(batches):
        stream = (row for b in batches for at in range(0, b.num_rows, 64) for row in zip(*(c.to_pylist() for c in b.slice(at, 64).columns), strict=True))
        out: list = []

        def done():
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for conv, parts in groupby(stream, key=lambda x: x[0]):
            r = Reader()
            for _, _, text, starts, ends in parts:
                r.feed(text, starts, ends)
            out.append((conv, r.turns, r.turns_hash.hexdigest(), r.loss_chars, r.loss_hash.hexdigest(), r.chars))
            if len(out) >= 5000:
                yield done()
                out.clear()
        if out:
            yield done()

    return formatted.mapInArrow(each, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
