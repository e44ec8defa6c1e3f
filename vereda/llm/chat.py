"""Chat formatting: a small sandboxed template language, compiled to Python closures.

A template is parsed into a syntax tree, constant parts are folded, and each node becomes a
closure. Rendering needs one turn at a time, so a conversation is never held as a whole:
turns are sorted within their partition and flow through the closures as pieces of text with
the spans that a model is to learn.

    {{ expr }}                     text of an expression
    {% for turn in turns %} ...    once per turn; the only loop
    {% if e %} {% elif e %} {% else %} {% endif %}
    {% generation %} ... {% endgeneration %}   marks text to learn

Expressions: 'text', numbers, true, false, turn.role, turn.text, loop.index0, loop.first,
loop.last, ==, !=, +, and, or, not, ( ), and the filters escape, trim, lower, upper. Nothing
else can be reached from a template: no attributes, calls or names of Python.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vereda.llm.common import text_of

# Control strings: each starts with a character that it has nowhere else, so no text can
# complete one across the edge of an inserted value.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[END]"]
TEMPLATE = (
    "<s>{% for turn in turns %}"
    "{% if turn.role == 'user' %}[INST] {{ turn.text | escape }} [/INST]"
    "{% elif turn.role == 'assistant' %}"
    "{% generation %}{{ turn.text | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ turn.role | escape }}[/ROLE] {{ turn.text | escape }}[END]{% endif %}"
    "{% endfor %}"
)
_CONTROL = re.compile("|".join(re.escape(word) for word in CONTROL) + r"|\\")


def escape(text: str) -> str:
    """Break every control string with a backslash after its first character; double backslashes."""
    return _CONTROL.sub(lambda found: found[0][0] + "\\" + found[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"(?s)\\(\\)|\\", lambda found: found[1] or "", text)


class TemplateError(ValueError):
    """The template is not in the language."""


_PARTS = re.compile(r"\{%(.*?)%\}|\{\{(.*?)\}\}", re.S)
_TOKEN = re.compile(
    r"\s*(?:(?P<string>'[^']*'|\"[^\"]*\")|(?P<number>\d+)|(?P<name>[A-Za-z_][\w.]*)"
    r"|(?P<sign>==|!=|[+|()]))"
)
FILTERS = {"escape": escape, "trim": str.strip, "lower": str.lower, "upper": str.upper}
NAMES = {"turn.role", "turn.text", "loop.index0", "loop.first", "loop.last"}


class _Expression:
    """Recursive descent over the tokens of one expression; gives nested tuples."""

    def __init__(self, source):
        self.tokens, at = [], 0
        while source[at:].strip():
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def parse(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def take(self, *wanted):
        if self.at < len(self.tokens) and self.tokens[self.at][1] in wanted:
            if self.tokens[self.at][0] in ("sign", "name"):
                self.at += 1
                return self.tokens[self.at - 1][1]
        return None

    def either(self):
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self):
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self):
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self):
        tree = self.joined()
        while sign := self.take("==", "!="):
            tree = (sign, tree, self.joined())
        return tree

    def joined(self):
        tree = self.filtered()
        while self.take("+"):
            tree = ("+", tree, self.filtered())
        return tree

    def filtered(self):
        tree = self.plain()
        while self.take("|"):
            kind, name = self.next()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def next(self):
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def plain(self):
        kind, value = self.next()
        if kind == "string":
            return ("constant", value[1:-1])
        if kind == "number":
            return ("constant", int(value))
        if value in ("true", "false"):
            return ("constant", value == "true")
        if kind == "name" and value in NAMES:
            return ("name", value)
        if value == "(":
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return tree
        raise TemplateError(f"unknown {value!r}")


def parse(source: str):
    """Statements of a template as nested lists of tuples."""
    words, at = [], 0
    for found in _PARTS.finditer(source):
        words.append(("text", source[at:found.start()]))
        words.append(("tag", found[1].strip()) if found[1] is not None else ("value", found[2]))
        at = found.end()
    words.append(("text", source[at:]))
    words = [word for word in words if word != ("text", "")]

    def block(place, ends, looped):
        body = []
        while place < len(words):
            kind, what = words[place]
            place += 1
            first = what.split(None, 1)[0] if kind == "tag" and what else ""
            if kind == "text":
                body.append(("text", what))
            elif kind == "value":
                body.append(("value", _Expression(what).parse()))
            elif first in ends:
                return body, place, what
            elif what.split() == ["for", "turn", "in", "turns"] and not looped:
                inner, place, _ = block(place, {"endfor"}, True)
                body.append(("for", inner))
            elif first == "generation":
                inner, place, _ = block(place, {"endgeneration"}, looped)
                body.append(("generation", inner))
            elif first == "if":
                branches, test = [], what[2:]
                while True:
                    inner, place, end = block(place, {"elif", "else", "endif"}, looped)
                    branches.append((_Expression(test).parse() if test else ("constant", True), inner))
                    if end.startswith("endif"):
                        break
                    test = end[4:] if end.startswith("elif") else None
                body.append(("if", branches))
            else:
                raise TemplateError(f"unexpected tag {what!r}")
        if ends:
            raise TemplateError(f"missing {sorted(ends)[0]}")
        return body, place, None

    return block(0, set(), False)[0]


def fold_expression(tree):
    """Replace every part without names by its value."""
    kind = tree[0]
    if kind in ("constant", "name"):
        return tree
    if kind == "filter":
        tree = (kind, tree[1], fold_expression(tree[2]))
        inner = tree[2:]
    else:
        tree = (kind, *map(fold_expression, tree[1:]))
        inner = tree[1:]
    if all(part[0] == "constant" for part in inner):
        return ("constant", compile_expression(tree)(None))
    return tree


def fold(body):
    """Constant values become text, decided branches are inlined, neighbouring texts join."""
    out = []

    def add(node):
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in body:
        if node[0] == "value":
            tree = fold_expression(node[1])
            add(("text", _shown(tree[1])) if tree[0] == "constant" else ("value", tree))
        elif node[0] == "if":
            branches, settled = [], False
            for test, inner in node[1]:
                test = fold_expression(test)
                if test[0] == "constant" and not test[1]:
                    continue
                branches.append((test, fold(inner)))
                if test[0] == "constant":
                    settled = True
                    break
            if settled and len(branches) == 1:
                for inner in branches[0][1]:
                    add(inner)
            elif branches:
                add(("if", branches))
        elif node[0] in ("for", "generation"):
            add((node[0], fold(node[1])))
        else:
            add(node)
    return out


def _shown(value):
    return str(value).lower() if isinstance(value, bool) else str(value)


def compile_expression(tree):
    """A closure from the values of a turn to the value of the expression."""
    kind = tree[0]
    if kind == "constant":
        return lambda values: tree[1]
    if kind == "name":
        return lambda values: values[tree[1]]
    if kind == "filter":
        change, inner = FILTERS[tree[1]], compile_expression(tree[2])
        return lambda values: change(_shown(inner(values)))
    parts = [compile_expression(part) for part in tree[1:]]
    if kind == "not":
        return lambda values: not parts[0](values)
    left, right = parts
    return {
        "==": lambda values: left(values) == right(values),
        "!=": lambda values: left(values) != right(values),
        "+": lambda values: _shown(left(values)) + _shown(right(values)),
        "and": lambda values: left(values) and right(values),
        "or": lambda values: left(values) or right(values),
    }[kind]


def compile_block(body):
    """A closure that appends (text, learned) pairs for the values of a turn."""
    steps = []
    for kind, part in body:
        if kind == "text":
            steps.append(lambda values, out, learned, part=part: out.append((part, learned)))
        elif kind == "value":
            show = compile_expression(part)
            steps.append(lambda values, out, learned, show=show:
                         out.append((_shown(show(values)), learned)))
        elif kind == "generation":
            inner = compile_block(part)
            steps.append(lambda values, out, learned, inner=inner: inner(values, out, True))
        elif kind == "if":
            branches = [(compile_expression(test), compile_block(inner)) for test, inner in part]

            def choose(values, out, learned, branches=branches):
                for test, inner in branches:
                    if test(values):
                        return inner(values, out, learned)

            steps.append(choose)
        else:
            raise TemplateError("a loop inside a block")

    def run(values, out, learned):
        for step in steps:
            step(values, out, learned)

    return run


class Template:
    """A compiled template: closures for what stands before, in and after the loop."""

    def __init__(self, source: str):
        body = fold(parse(source))
        loops = [place for place, node in enumerate(body) if node[0] == "for"]
        if len(loops) != 1:
            raise TemplateError("a template has one loop over the turns")
        self.before = compile_block(body[: loops[0]])
        self.each = compile_block(body[loops[0]][1])
        self.after = compile_block(body[loops[0] + 1:])

    def piece(self, role, text, index, last):
        """Text of a turn, with what precedes the first and follows the last, and its spans."""
        values = {"turn.role": role, "turn.text": text, "loop.index0": index,
                  "loop.first": index == 0, "loop.last": last}
        out = []
        if index == 0:
            self.before(values, out, False)
        self.each(values, out, False)
        if last:
            self.after(values, out, False)
        spans, at = [], 0
        for part, learned in out:
            if learned and spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(part))
            elif learned:
                spans.append((at, at + len(part)))
            at += len(part)
        return "".join(part for part, _ in out), spans


def _rows(batches, *names):
    for batch in batches:
        yield from zip(*[batch[name] for name in names])


def _chunks(rows, schema, size=2000, chars=1 << 22):
    """Record batches of limited length and text."""
    kept, weight = [], 0
    for row in rows:
        kept.append(row)
        weight += sum(len(cell) for cell in row if isinstance(cell, str))
        if len(kept) >= size or weight >= chars:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(column), field.type) for column, field in zip(zip(*kept), schema)],
                schema=schema)
            kept, weight = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(column), field.type) for column, field in zip(zip(*kept), schema)],
            schema=schema)


def format_turns(turns: DataFrame, template=TEMPLATE) -> DataFrame:
    """Pieces of formatted conversations: ``conv_id, position, last, piece, starts, ends``.

    ``turns`` has (conv_id, turn, role, text). One row per turn, in order within a partition
    that holds all turns of its conversations; the pieces of a conversation joined in order
    are its formatted text. ``starts`` and ``ends`` are code point offsets within the piece
    of the spans to learn. Turns are ordered by turn, null first, then role and text; repeated
    rows are repeated turns. Null role or text counts as empty; a null conv_id is one
    conversation. An empty table gives no rows. Only one turn is held at a time, so a
    conversation with a third of all rows costs time in one task, but no memory.
    """
    conv = dict(turns.dtypes)["conv_id"]
    rows = turns.select(
        "conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text")
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = pa.schema([
        ("conv_id", pa.string()), ("position", pa.int64()), ("last", pa.bool_()),
        ("piece", pa.string()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
    ])

    def render(batches):
        compiled = Template(template)

        def pieces():
            held, index = None, 0
            for row in _rows((batch.to_pydict() for batch in batches), "conv_id", "role", "text"):
                if held is not None:
                    last = row[0] != held[0]
                    yield held, index, last
                    index = 0 if last else index + 1
                held = row
            if held is not None:
                yield held, index, True

        def output():
            for (conv_id, role, text), index, last in pieces():
                piece, spans = compiled.piece(role, text, index, last)
                yield conv_id, index, last, piece, [a for a, _ in spans], [b for _, b in spans]

        yield from _chunks(output(), schema)

    return rows.withColumn("conv_id", F.col("conv_id").cast("string")).mapInArrow(
        render,
        "conv_id string, position bigint, last boolean, piece string, "
        "starts array<bigint>, ends array<bigint>",
    ).withColumn("conv_id", F.col("conv_id").cast(conv))


def format_conversations(turns: DataFrame, template=TEMPLATE) -> DataFrame:
    """``conv_id, formatted, starts, ends``: each conversation as one text with its spans.

    For conversations that fit in a row; see ``format_turns`` for the cases.
    """
    pieces = format_turns(turns, template).withColumn("_length", F.char_length("piece"))
    joined = pieces.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("position", "piece", "_length", "starts", "ends")))
        .alias("_pieces")
    )
    moved = (
        "flatten(transform(_pieces, (p, i) -> transform(p.{0}, s -> s + "
        "aggregate(slice(_pieces, 1, i), 0L, (n, q) -> n + q._length))))"
    )
    return joined.select(
        "conv_id", F.array_join(F.col("_pieces.piece"), "").alias("formatted"),
        F.expr(moved.format("starts")).alias("starts"), F.expr(moved.format("ends")).alias("ends"),
    )


_READ = re.compile(
    r"<s>|\[INST\] |(?P<user> \[/INST\])|(?P<assistant></s>)|\[ROLE\]|(?P<role>\[/ROLE\] )|(?P<other>\[END\])"
)


def read_piece(piece: str):
    """Role and text of the one turn in a piece written by the default template."""
    at, role = 0, None
    for mark in _READ.finditer(piece):
        if mark[0] in ("<s>", "[INST] ", "[ROLE]"):
            at = mark.end()
        elif mark["role"]:
            role, at = unescape(piece[at:mark.start()]), mark.end()
        else:
            text = unescape(piece[at:mark.start()])
            return ("user" if mark["user"] else "assistant" if mark["assistant"] else role), text
    raise ValueError("not a formatted turn")


def conversation_digests(pieces: DataFrame) -> DataFrame:
    """Digests of conversations read back from their pieces, which stay in their partitions.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """
    schema = pa.schema([
        ("conv_id", pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def digest(batches):
        def output():
            turns, loss, count, learned, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            rows = _rows((batch.to_pydict() for batch in batches),
                         "conv_id", "last", "piece", "starts", "ends")
            for conv_id, last, piece, starts, ends in rows:
                role, text = read_piece(piece)
                turns.update(f"{role}\n{text}\n".encode())
                count, chars = count + 1, chars + len(piece)
                for start, end in zip(starts, ends):
                    target = unescape(piece[start:end])
                    loss.update(target.encode())
                    learned += len(target)
                if last:
                    yield conv_id, count, turns.hexdigest(), learned, loss.hexdigest(), chars
                    turns, loss, count, learned, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

        yield from _chunks(output(), schema)

    conv = dict(pieces.dtypes)["conv_id"]
    return pieces.withColumn("conv_id", F.col("conv_id").cast("string")).mapInArrow(
        digest,
        "conv_id string, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint",
    ).withColumn("conv_id", F.col("conv_id").cast(conv))
