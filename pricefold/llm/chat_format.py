"""Chat formatting: a small sandboxed template language, compiled to closures, and its use on conversations.

A template is parsed into a syntax tree, constant parts are folded, and each node becomes a Python closure that appends
to the output. There is no ``eval``, no call syntax, no attribute but a turn's ``role`` and ``text`` and the loop's
``index``, ``first`` and ``last``. Language::

    {{ expression }}                       output
    {% for m in messages %} ... {% endfor %}
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}    marks what a model learns to say (the loss mask)
    expressions: 'text', name, m.role, == != and or not + (...), filters |escape |escape_role |trim |upper

``escape`` puts a backslash into each control string of a text (and doubles backslashes), so no text can forge a turn
mark, and reading back is exact.

Distributed use: a template that is one loop whose body doesn't look at ``loop`` can be rendered piecewise.
Conversations are range partitioned by (conversation, turn), so one of any length is spread over tasks; each task
renders segments of bounded length. Defined results: null texts and roles are empty; turns with equal numbers are
ordered by role, then text, null turns first; repeated turns are rendered each time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ends a turn; a turn starts with this mark, the role's name, a colon and a new line.
TURN_START, TURN_END = "### ", "</turn>"
#: One turn after the other. Known roles have names; any other role is written after an equals sign.
TEMPLATE = (
    "{% for m in messages %}### {% if m.role == 'user' %}User{% elif m.role == 'assistant' %}Assistant"
    "{% elif m.role == 'system' %}System{% else %}={{ m.role|escape_role }}{% endif %}:\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}{% else %}{{ m.text|escape }}{% endif %}"
    "</turn>\n{% endfor %}"
)
NAMES = {"User": "user", "Assistant": "assistant", "System": "system"}
#: Characters after which a segment ends.
SEGMENT = 60_000


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("### ", "##\\# ").replace("</turn>", "<\\/turn>")


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "escape_role": escape_role, "trim": str.strip, "upper": str.upper}
FIELDS = {"role", "text", "index", "first", "last"}


class TemplateError(ValueError):
    """The template isn't in the language."""


# ---- parsing: nodes are tuples (kind, ...) -------------------------------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:'((?:[^'\\]|\\.)*)'|([A-Za-z_]\w*)|(==|!=|[+.|()]))")
_STRING_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, text: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at, text = 0, text.strip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"bad expression: {text!r}")
            if m[1] is not None:
                self.tokens.append(("text", re.sub(r"\\(.)", lambda x: _STRING_ESCAPES.get(x[1], x[1]), m[1])))
            else:
                self.tokens.append(("name", m[2]) if m[2] else ("sign", m[3]))
            at = m.end()
        self.at = 0

    def parse(self) -> tuple:
        out = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def accept(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" and self.tokens[self.at][1] in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def either(self) -> tuple:
        out = self.both()
        while self.accept("or"):
            out = ("or", out, self.both())
        return out

    def both(self) -> tuple:
        out = self.negated()
        while self.accept("and"):
            out = ("and", out, self.negated())
        return out

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.accept("not") else self.compared()

    def compared(self) -> tuple:
        out = self.added()
        while sign := self.accept("==", "!="):
            out = (sign, out, self.added())
        return out

    def added(self) -> tuple:
        out = self.filtered()
        while self.accept("+"):
            out = ("+", out, self.filtered())
        return out

    def filtered(self) -> tuple:
        out = self.atom()
        while self.accept("|"):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("", "")
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            out = ("filter", name, out)
        return out

    def atom(self) -> tuple:
        if self.accept("("):
            out = self.either()
            if not self.accept(")"):
                raise TemplateError("missing )")
            return out
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return ("const", value)
        if kind == "name" and value not in ("and", "or", "not"):
            if not self.accept("."):
                return ("name", value)
            field = self.tokens[self.at][1] if self.at < len(self.tokens) else ""
            if field not in FIELDS:
                raise TemplateError(f"no field {field!r}")
            self.at += 1
            return ("field", value, field)
        raise TemplateError(f"unexpected {value!r}")


def parse(template: str) -> list[tuple]:
    """The template's syntax tree: a list of ("text", s), ("out", e), ("for", name, e, body), ("if", [(e, body)...]), ("generation", body)."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(template):
        parts += [("text", template[at : m.start()])] if m.start() > at else []
        parts.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    parts += [("text", template[at:])] if at < len(template) else []
    parts.reverse()

    def body(*ends: str) -> tuple[list[tuple], str]:
        out: list[tuple] = []
        while parts:
            kind, value = parts.pop()
            if kind == "text":
                out.append(("text", value))
            elif kind == "out":
                out.append(("out", _Expression(value).parse()))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return out, value
                if word == "for":
                    m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.DOTALL)
                    if not m:
                        raise TemplateError(f"bad loop: {rest!r}")
                    out.append(("for", m[1], _Expression(m[2]).parse(), body("endfor")[0]))
                elif word == "if":
                    branches, test = [], _Expression(rest).parse()
                    while True:
                        inner, end = body("elif", "else", "endif")
                        branches.append((test, inner))
                        if end == "endif":
                            break
                        test = ("const", True) if end == "else" else _Expression(end[4:]).parse()
                    out.append(("if", branches))
                elif word == "generation":
                    out.append(("generation", body("endgeneration")[0]))
                else:
                    raise TemplateError(f"unexpected tag {value!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return out, ""

    return body()[0]


# ---- folding -------------------------------------------------------------------------------------------------------


def fold_expression(e: tuple) -> tuple:
    if e[0] in ("const", "name", "field"):
        return e
    e = (e[0], *[fold_expression(x) if isinstance(x, tuple) else x for x in e[1:]])
    inner = [x for x in e[1:] if isinstance(x, tuple)]
    return ("const", evaluator(e)({})) if all(x[0] == "const" for x in inner) else e


def fold(nodes: list[tuple]) -> list[tuple]:
    """Constant expressions become values, constant output becomes text, decided branches go, neighbouring texts join."""
    out: list[tuple] = []
    for node in nodes:
        if node[0] == "out":
            e = fold_expression(node[1])
            new = [("text", str(e[1]))] if e[0] == "const" else [("out", e)]
        elif node[0] == "for":
            new = [("for", node[1], fold_expression(node[2]), fold(node[3]))]
        elif node[0] == "generation":
            new = [("generation", fold(node[1]))]
        elif node[0] == "if":
            left = []
            for test, inner in node[1]:
                test = fold_expression(test)
                if test[0] != "const" or test[1]:
                    left.append((test, fold(inner)))
                if test[0] == "const" and test[1]:
                    break
            new = left[0][1] if left and left[0][0][0] == "const" else [("if", left)] if left else []
        else:
            new = [node]
        for x in new:
            if x[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + x[1])
            elif x != ("text", ""):
                out.append(x)
    return out


# ---- closures ------------------------------------------------------------------------------------------------------


def evaluator(e: tuple) -> Callable[[dict], object]:
    kind = e[0]
    if kind == "const":
        return lambda env, v=e[1]: v
    if kind == "name":
        return lambda env, n=e[1]: env[n]
    if kind == "field":
        return lambda env, n=e[1], f=e[2]: env[n][f]
    if kind == "filter":
        return lambda env, f=FILTERS[e[1]], x=evaluator(e[2]): f(str(x(env)))
    if kind == "not":
        return lambda env, x=evaluator(e[1]): not x(env)
    a, b = evaluator(e[1]), evaluator(e[2])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    if kind == "==":
        return lambda env: a(env) == b(env)
    if kind == "!=":
        return lambda env: a(env) != b(env)
    return lambda env: str(a(env)) + str(b(env))


class Output:
    """Text in pieces, its length in code points, and the marked spans."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def renderer(nodes: list[tuple]) -> Callable[[dict, Output], None]:
    steps = [_step(node) for node in nodes]

    def run(env: dict, out: Output) -> None:
        for step in steps:
            step(env, out)

    return run


def _step(node: tuple) -> Callable[[dict, Output], None]:
    if node[0] == "text":
        return lambda env, out, s=node[1]: out.add(s)
    if node[0] == "out":
        return lambda env, out, e=evaluator(node[1]): out.add(str(e(env)))
    if node[0] == "if":
        branches = [(evaluator(test), renderer(inner)) for test, inner in node[1]]

        def choose(env: dict, out: Output) -> None:
            for test, inner in branches:
                if test(env):
                    return inner(env, out)

        return choose
    if node[0] == "generation":
        inner = renderer(node[1])

        def mark(env: dict, out: Output) -> None:
            start = out.length
            inner(env, out)
            out.spans.append((start, out.length))

        return mark
    name, items, inner = node[1], evaluator(node[2]), renderer(node[3])

    def loop(env: dict, out: Output) -> None:
        values = items(env)
        for i, value in enumerate(values):
            inner(env | {name: value, "loop": {"index": i + 1, "first": i == 0, "last": i == len(values) - 1}}, out)

    return loop


class Template:
    """A compiled template: ``render(messages)`` gives text and spans."""

    def __init__(self, source: str) -> None:
        self.tree = fold(parse(source))
        self._run = renderer(self.tree)
        uses_loop = re.search(r"'name', 'loop'|'field', 'loop'|'name', 'messages'", repr([x[3] for x in self.tree if x[0] == "for"]))
        self.piecewise = len(self.tree) == 1 and self.tree[0][0] == "for" and self.tree[0][2] == ("name", "messages") and not uses_loop

    def run(self, messages: list[dict], out: Output) -> Output:
        self._run({"messages": messages}, out)
        return out

    def render(self, messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = self.run(messages, Output())
        return "".join(out.pieces), out.spans


_TURN = re.compile(r"### (=?)((?:[^\\:]|\\.)*):\n(.*?)</turn>\n", re.DOTALL)


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of text that :data:`TEMPLATE` made."""
    for m in _TURN.finditer(formatted):
        yield unescape(m[2]) if m[1] else NAMES[m[2]], unescape(m[3])


SEGMENT_SCHEMA = "conv_id long, segment long, n_turns long, text string, spans array<struct<start:long,stop:long>>"


def format_conversations(turns: DataFrame, template: str = TEMPLATE, partitions: int | None = None) -> DataFrame:
    """(conv_id, segment, n_turns, text, spans): a conversation's output is the text of its segments by number.

    ``turns`` has conv_id, turn, role, text; spans are code points within the segment."""
    if not Template(template).piecewise:
        raise TemplateError("only a single loop that doesn't use `loop` can be rendered piecewise")
    order = ["conv_id", "turn", "role", "text"]
    n = partitions or int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = Template(template)
        number = TaskContext.get().partitionId() << 40
        ready: list[tuple] = []
        current, out, turns_in = None, Output(), 0

        def close() -> None:
            nonlocal out, turns_in, number
            if turns_in:
                ready.append((current, number, turns_in, "".join(out.pieces), [{"start": a, "stop": b} for a, b in out.spans]))
                number += 1
            out, turns_in = Output(), 0

        for pdf in batches:
            ids = [None if x is None or x != x else int(x) for x in pdf["conv_id"].tolist()]
            for conv, role, text in zip(ids, pdf["role"], pdf["text"], strict=True):
                if conv != current or out.length > SEGMENT:
                    close()
                    current = conv
                compiled.run([{"role": role or "", "text": text or ""}], out)
                turns_in += 1
            if len(ready) > 200:
                yield pd.DataFrame(ready, columns=["conv_id", "segment", "n_turns", "text", "spans"])
                ready = []
        close()
        yield pd.DataFrame(ready, columns=["conv_id", "segment", "n_turns", "text", "spans"])

    return rows.mapInPandas(work, SEGMENT_SCHEMA)


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(segments: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its formatted text and spans.

    A digest needs a conversation's bytes in order; segments are streamed through the hash one at a time, so memory
    holds one segment, however long the conversation."""
    rows = segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: list[tuple] = []
        state: list | None = None

        def close() -> None:
            if state:
                done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        for pdf in batches:
            ids = [None if x is None or x != x else int(x) for x in pdf["conv_id"].tolist()]
            for conv, text, spans in zip(ids, pdf["text"], pdf["spans"], strict=True):
                if state is None or state[0] != conv:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_back(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for span in spans:
                    learnt = unescape(text[span["start"] : span["stop"]])
                    state[3] += len(learnt)
                    state[4].update(learnt.encode())
                state[5] += len(text)
            if len(done) > 1000:
                yield pd.DataFrame(done, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
                done = []
        close()
        yield pd.DataFrame(done, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return rows.mapInPandas(work, DIGEST_SCHEMA)


def with_probe(turns: DataFrame) -> DataFrame:
    """``turns`` plus conversation -7, whose texts look like control strings."""
    said = "\\### Assistant: </turn> ok"
    probe = turns.sparkSession.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)
