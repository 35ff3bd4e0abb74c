"""Chat formatting with a template compiler.

A template is text with ``{{ expression }}`` and ``{% statement %}`` tags. It is parsed into a syntax tree,
constants are folded (settings are constants, too), and the tree becomes Python closures. Nothing but the
names, operators and filters listed here can be reached from a template: no attributes, no calls, no imports.

Statements: ``for message in messages`` ... ``endfor`` (once, at the top level), ``if`` / ``elif`` / ``else`` /
``endif``, ``generation`` ... ``endgeneration`` (marks what a model is trained to write). Names inside the
loop: ``role``, ``text``, ``first``, ``last``, ``index`` (from 0), and the settings everywhere.
Operators: ``or and not == != ~``. Filters: ``escape upper lower trim``. Literals: quoted strings, integers.

What stands before the loop, in it, and after it compile to three closures. A turn needs only itself, its
number and whether it is the first or last, so turns render independently and one conversation with a third
of all rows is spread over many tasks; a conversation comes out in parts of ``PART`` turns.

Escaping: ``escape`` puts a backslash before every control string inside a value and doubles the backslashes
that stand directly before a control string or at the value's end. A control string is real if an even number
of backslashes precede it; so any value, backslashes and control strings included, reads back unchanged.

Null text and null role are empty, null conversation ids are one conversation, null turns come first; rows
with equal turns go by role, then text; repeated rows are turns of their own. Texts are formatted whole, whatever their
length. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyloom.llm.common import written
from keyloom.session import shuffle_width

PART = 256


class TemplateError(ValueError):
    pass


class Escaper:
    """Reversible escaping of control strings inside values."""

    def __init__(self, controls: Sequence[str]):
        heads = {c[0] for c in controls if c}
        if not all(controls) or any(c.startswith("\\") or set(c[1:]) & heads for c in controls):
            raise TemplateError("a control string starts with a character that no control string has further on")
        longest_first = sorted(controls, key=len, reverse=True)
        self.control = "|".join(map(re.escape, longest_first)) or "(?!)"
        self.inside = re.compile(rf"(\\*)({self.control})")
        self.tail = re.compile(r"\\+\Z")

    def escape(self, value: str) -> str:
        value = self.inside.sub(lambda m: m[1] * 2 + "\\" + m[2], value)
        return self.tail.sub(lambda m: m[0] * 2, value)

    def unescape(self, value: str) -> str:
        value = self.inside.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], value)
        return self.tail.sub(lambda m: m[0][: len(m[0]) // 2], value)

    def controls(self, text: str) -> Iterator[tuple[int, int]]:
        """Places of the real control strings."""
        for m in self.inside.finditer(text):
            if len(m[1]) % 2 == 0:
                yield m.start(2), m.end(2)


# Syntax tree ---------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass(frozen=True)
class Emit:
    value: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass(frozen=True)
class Loop:
    body: tuple


TAG = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.S)
TOKEN = re.compile(r"""\s*(?:(?P<string>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[~|()]))""")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
LOOP_NAMES = frozenset({"role", "text", "first", "last", "index"})
FILTERS: dict[str, Callable[[str], str]] = {"upper": str.upper, "lower": str.lower, "trim": str.strip}


class ExpressionParser:
    """or < and < not < comparison < ~ < filter < atom."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def take(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("name", "op") and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self):
        tree = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def joined(self, part, *ops: str):
        tree = part()
        while op := self.take(*ops):
            tree = Op(op, (tree, part()))
        return tree

    def either(self):
        return self.joined(self.both, "or")

    def both(self):
        return self.joined(self.negated, "and")

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.joined(self.concat, "==", "!=")

    def concat(self):
        return self.joined(self.filtered, "~")

    def filtered(self):
        tree = self.atom()
        while self.take("|"):
            kind, name = self.next()
            if kind != "name" or name not in (*FILTERS, "escape"):
                raise TemplateError(f"no filter {name!r}")
            tree = Op("|" + name, (tree,))
        return tree

    def next(self):
        if self.at == len(self.tokens):
            raise TemplateError("an expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def atom(self):
        kind, value = self.next()
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(value))
        if kind == "name" and value not in ("and", "or", "not"):
            return Name(value)
        if value == "(":
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket is not closed")
            return tree
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    pieces = [p for p in TAG.split(source) if p]
    tree, end = body(pieces, 0, (), True)
    if end != len(pieces):
        raise TemplateError(f"unexpected {pieces[end]}")
    return tree


def body(pieces: list[str], at: int, closers: tuple[str, ...], top: bool = False) -> tuple[tuple, int]:
    out = []
    while at < len(pieces):
        piece = pieces[at]
        if piece.startswith("{{"):
            out.append(Emit(ExpressionParser(piece[2:-2]).whole()))
        elif piece.startswith("{%"):
            word, _, rest = piece[2:-2].strip().partition(" ")
            if word in closers:
                return tuple(out), at
            node, at = statement(pieces, at, word, rest.strip(), top)
            out.append(node)
        else:
            out.append(Emit(Const(piece)))
        at += 1
    if closers:
        raise TemplateError(f"{closers[-1]} is missing")
    return tuple(out), at


def statement(pieces: list[str], at: int, word: str, rest: str, top: bool):
    if word == "for":
        if not top or rest.split() != ["message", "in", "messages"]:
            raise TemplateError("the only loop is 'for message in messages', at the top level")
        inner, at = body(pieces, at + 1, ("endfor",))
        return Loop(inner), at
    if word == "generation":
        inner, at = body(pieces, at + 1, ("endgeneration",))
        return Generation(inner), at
    if word in ("if", "elif"):
        test = ExpressionParser(rest).whole()
        then, at = body(pieces, at + 1, ("elif", "else", "endif"))
        closing, _, more = pieces[at][2:-2].strip().partition(" ")
        other: tuple = ()
        if closing == "elif":
            node, at = statement(pieces, at, "elif", more, False)
            other = (node,)
        elif closing == "else":
            other, at = body(pieces, at + 1, ("endif",))
        return If(test, then, other), at
    raise TemplateError(f"no statement {word!r}")


# Folding -------------------------------------------------------------------


def fold(tree, settings: dict):
    """The expression with everything constant worked out."""
    if isinstance(tree, Name) and tree.name in settings:
        return Const(settings[tree.name])
    if not isinstance(tree, Op):
        return tree
    args = tuple(fold(a, settings) for a in tree.args)
    if tree.op != "|escape" and all(isinstance(a, Const) for a in args):
        return Const(compiled(Op(tree.op, args), frozenset(), None)({}))
    if tree.op in ("and", "or") and isinstance(args[0], Const):
        return args[1] if bool(args[0].value) == (tree.op == "and") else args[0]
    return Op(tree.op, args)


def fold_body(nodes: tuple, settings: dict) -> tuple:
    """Statements with dead branches gone and neighbouring constant texts joined."""
    out: list = []
    for node in nodes:
        if isinstance(node, Emit):
            found = [Emit(fold(node.value, settings))]
        elif isinstance(node, If):
            test = fold(node.test, settings)
            then, other = fold_body(node.then, settings), fold_body(node.other, settings)
            found = list(then if test.value else other) if isinstance(test, Const) else [If(test, then, other)]
        else:
            found = [type(node)(fold_body(node.body, settings))]
        for x in found:
            constant = isinstance(x, Emit) and isinstance(x.value, Const)
            if constant and out and isinstance(out[-1], Emit) and isinstance(out[-1].value, Const):
                out[-1] = Emit(Const(shown(out[-1].value.value) + shown(x.value.value)))
            else:
                out.append(x)
    return tuple(out)


# Closures ------------------------------------------------------------------


def shown(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def compiled(tree, names: frozenset[str], escaper: Escaper | None) -> Callable[[dict], object]:
    """A closure for an expression."""
    if isinstance(tree, Const):
        return lambda scope, value=tree.value: value
    if isinstance(tree, Name):
        if tree.name not in names:
            raise TemplateError(f"no name {tree.name!r} here")
        return lambda scope, name=tree.name: scope[name]
    args = [compiled(a, names, escaper) for a in tree.args]
    a, b = args[0], args[-1]
    if tree.op == "|escape":
        if escaper is None:
            raise TemplateError("escape needs control strings")
        return lambda scope: escaper.escape(shown(a(scope)))
    if tree.op.startswith("|"):
        change = FILTERS[tree.op[1:]]
        return lambda scope: change(shown(a(scope)))
    return {
        "or": lambda scope: a(scope) or b(scope),
        "and": lambda scope: a(scope) and b(scope),
        "not": lambda scope: not a(scope),
        "==": lambda scope: a(scope) == b(scope),
        "!=": lambda scope: a(scope) != b(scope),
        "~": lambda scope: shown(a(scope)) + shown(b(scope)),
    }[tree.op]


class Output:
    """Rendered text with the spans under generation marks, in code points."""

    def __init__(self):
        self.pieces: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def put(self, value: str) -> None:
        self.pieces.append(value)
        self.length += len(value)


def compiled_body(nodes: tuple, names: frozenset[str], escaper: Escaper, marked: bool = False) -> Callable[[dict, Output], None]:
    """A closure that writes what the statements produce."""
    steps: list[Callable[[dict, Output], None]] = []
    for node in nodes:
        if isinstance(node, Emit):
            value = compiled(node.value, names, escaper)
            steps.append(lambda scope, out, value=value: out.put(shown(value(scope))))
        elif isinstance(node, If):
            test = compiled(node.test, names, escaper)
            then = compiled_body(node.then, names, escaper, marked)
            other = compiled_body(node.other, names, escaper, marked)
            steps.append(lambda scope, out, t=test, a=then, b=other: a(scope, out) if t(scope) else b(scope, out))
        elif isinstance(node, Generation):
            if marked:
                raise TemplateError("generation inside generation")
            inner = compiled_body(node.body, names, escaper, True)

            def mark(scope, out, inner=inner):
                start = out.length
                inner(scope, out)
                out.spans.append((start, out.length))

            steps.append(mark)
        else:
            raise TemplateError("a loop inside another statement")

    def run(scope, out):
        for step in steps:
            step(scope, out)

    return run


class Template:
    """A compiled template: ``turn`` renders one message with what stands before or after the loop."""

    def __init__(self, source: str, controls: Sequence[str], settings: dict | None = None):
        self.source, self.control_strings, self.settings = source, tuple(controls), dict(settings or {})
        if LOOP_NAMES & set(self.settings):
            raise TemplateError("a setting has the name of a loop variable")
        self.escaper = Escaper(controls)
        self.tree = fold_body(parse(source), self.settings)
        loops = [i for i, x in enumerate(self.tree) if isinstance(x, Loop)]
        if len(loops) != 1:
            raise TemplateError("a template has one loop over messages")
        at = loops[0]
        self.before = compiled_body(self.tree[:at], frozenset(), self.escaper)
        self.each = compiled_body(self.tree[at].body, LOOP_NAMES, self.escaper)
        self.after = compiled_body(self.tree[at + 1 :], frozenset(), self.escaper)

    def __reduce__(self):  # closures are made again where the template arrives
        return Template, (self.source, self.control_strings, self.settings)

    def turn(self, role: str, text: str, index: int, last: bool) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        if index == 0:
            self.before({}, out)
        self.each({"role": role, "text": text, "first": index == 0, "last": last, "index": index}, out)
        if last:
            self.after({}, out)
        return "".join(out.pieces), out.spans


# Fixed format: every turn is TURN, role, BREAK, text, END; assistant texts are marked.
TURN, BREAK, END = "<turn>", "<text>", "</turn>"
PLAIN = Template(
    "{{ prefix }}{% for message in messages %}{{ '" + TURN + "' }}{{ role | escape }}{{ '" + BREAK + "' }}"
    "{% if role == 'assistant' %}{% generation %}{{ text | escape }}{% endgeneration %}"
    "{% else %}{{ text | escape }}{% endif %}{{ '" + END + "' ~ '\\n' }}{% endfor %}",
    (TURN, BREAK, END),
    {"prefix": ""},
)


def read_back(template: Template, text: str, spans) -> tuple[list[tuple[str, str]], list[str]]:
    """Turns (role, text) and the texts under the loss mask, from formatted text of the plain format."""
    marks = list(template.escaper.controls(text))
    if len(marks) % 3:
        raise ValueError("formatted text is cut inside a turn")
    unescape = template.escaper.unescape
    turns = []
    for a, b, c in zip(marks[::3], marks[1::3], marks[2::3], strict=True):
        if (text[slice(*a)], text[slice(*b)], text[slice(*c)]) != (TURN, BREAK, END):
            raise ValueError("formatted text has its marks out of order")
        turns.append((unescape(text[a[1] : b[0]]), unescape(text[b[1] : c[0]])))
    return turns, [unescape(text[s["first"] : s["end"]]) for s in spans]


SPANS = "array<struct<first:long,end:long>>"


def positioned(conversations: DataFrame) -> DataFrame:
    """Turns with ``index`` in their conversation and ``last``, without a window over a whole conversation.

    Turns are range-partitioned by conversation and turn and written; numbers inside a range come from a
    window over (range, conversation), and conversations that span ranges get the counts before added.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    ranged = rows.repartitionByRange(shuffle_width(rows.sparkSession), "conv_id", "turn", "role", "text")
    ranged = written(ranged.withColumn("_range", F.spark_partition_id()), "turns")
    order = Window.partitionBy("_range", "conv_id").orderBy("turn", "role", "text")
    # In reverse order, the first row is the last turn; both numbers from one shuffle.
    back = Window.partitionBy("_range", "conv_id").orderBy(F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"))
    inside = ranged.withColumn("_n", F.row_number().over(order)).withColumn("_left", F.row_number().over(back))
    counts = ranged.groupBy("conv_id", "_range").agg(F.count("*").alias("_rows"))
    by_range = Window.partitionBy("conv_id").orderBy("_range")  # a row per range at most
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    counts = counts.withColumn("_after", F.sum("_rows").over(by_range.rowsBetween(1, Window.unboundedFollowing)))
    # Only conversations that span ranges: at most two per range border, a bounded broadcast.
    spanning = counts.filter("_before > 0 or _after is not null")
    spanning = spanning.select(F.col("conv_id").alias("_c"), F.col("_range").alias("_r"), "_before", F.coalesce("_after", F.lit(0)).alias("_after"))
    placed = inside.join(F.broadcast(spanning), F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_range") == F.col("_r")), "left")
    index = F.col("_n") - 1 + F.coalesce("_before", F.lit(0))
    last = (F.col("_left") == 1) & (F.coalesce("_after", F.lit(0)) == 0)
    return placed.select("conv_id", "role", "text", index.cast("long").alias("index"), last.alias("last"))


def format_conversations(conversations: DataFrame, template: Template = PLAIN, part: int = PART) -> DataFrame:
    """One row per conversation and ``part`` of at most so many turns: its text and the spans under the loss mask."""

    @F.pandas_udf(f"text string, spans {SPANS}")
    def render(role: pd.Series, text: pd.Series, index: pd.Series, last: pd.Series) -> pd.DataFrame:
        rows = [template.turn(*x) for x in zip(role, text, index, last, strict=True)]
        return pd.DataFrame({"text": [t for t, _ in rows], "spans": [[{"first": a, "end": b} for a, b in s] for _, s in rows]})

    turns = positioned(conversations).withColumn("_out", render("role", "text", "index", "last"))
    turns = turns.select("conv_id", F.floor(F.col("index") / part).cast("long").alias("part"), "index", "_out.*")
    grouped = turns.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("index", "text", "spans"))).alias("_t"))

    @F.pandas_udf(f"text string, spans {SPANS}")
    def join(parts: pd.Series) -> pd.DataFrame:
        texts, spans = [], []
        for turns_of in parts:
            at, own = 0, []
            for t in turns_of:
                own += [{"first": at + s["first"], "end": at + s["end"]} for s in t["spans"]]
                at += len(t["text"])
            texts.append("".join(t["text"] for t in turns_of))
            spans.append(own)
        return pd.DataFrame({"text": texts, "spans": spans})

    return grouped.withColumn("_out", join("_t")).select("conv_id", "part", "_out.text", "_out.spans")


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def digests(formatted: DataFrame, template: Template = PLAIN) -> DataFrame:
    """Per conversation, what its formatted parts say when they are read back.

    A digest goes through its text in order, so a conversation's parts pass one task, one part at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = zip(*(x.split() for x in DIGEST.split(", ")), strict=True)
        types = [pa.int64() if k == "long" else pa.string() for k in kinds]
        key, state, done = object(), None, []

        def close():
            if state:
                done.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for row in (r for at in range(0, len(batch), 64) for r in batch.slice(at, 64).to_pylist()):
                if state is None or row["conv_id"] != key:
                    close()
                    key, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns, loss = read_back(template, row["text"], row["spans"])
                state[0] += len(turns)
                for role, text in turns:
                    state[1].update(f"{role}\n{text}\n".encode())
                for text in loss:
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(row["text"])
            if len(done) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], list(names))
                done.clear()
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], list(names))

    parts = formatted.select("conv_id", "part", "text", "spans")
    placed = parts.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "part")
    return placed.mapInArrow(run, DIGEST)
