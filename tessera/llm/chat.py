"""Chat formatting: a small sandboxed template language, compiled to Python closures.

Text with ``{{ expression }}``, ``{% for x in messages %}``, ``{% if %}/{% elif %}/{% else %}``, ``{% generation %}`` (the
loss mask) and comments ``{# #}``. Expressions have literals, names, ``a.b``, ``==``, ``!=``, ``and``, ``or``, ``not``, ``+``,
parentheses and the named filters. There are no calls, assignments, imports or attributes of Python objects.

Rendering is a generator over an iterator of messages, so a conversation of any length is streamed: it leaves in parts of
bounded size, and reading back streams through the parts. Null roles and texts are empty; turns go by
(turn, role, text), nulls first, repeated rows are kept; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CHATML = (
    "{% for m in messages %}{{ '<|im_start|>' }}{{ m.role | line }}{{ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | guard }}{% endgeneration %}{% else %}{{ m.text | guard }}{% endif %}"
    "{{ '<|im_end|>' + '\\n' }}{% endfor %}"
)


def guard(text: str) -> str:
    """Escape control strings: every ``<``, backslashes, ``|`` gets one more backslash, so no ``<|`` is left."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unguard(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def line(text: str) -> str:
    """``guard`` for a field that ends at a newline."""
    return guard(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unline(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unguard(text))


FILTERS: dict[str, Callable[[str], str]] = {"guard": guard, "line": line, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    """The template is not in the language."""


# Syntax tree: ("text", s), ("out", e), ("for", name, source, body), ("if", [(test, body)...], other), ("generation", body);
# expressions: ("const", v), ("name", (a, b...)), ("filter", f, e), ("not", e), (op, e, e).

TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*)|(==|!=|[+|()]))")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


#: Parentheses and negations of one expression, at most.
MOST_DEPTH = 60
STRING = r"""\"(?:\\.|[^\"\\])*\"|'(?:\\.|[^'\\])*'"""
#: A tag ends at the first end mark outside a string; a quote that is not closed is a plain character.
TAG = re.compile(r"(\{\{(?:" + STRING + r"|(?!\}\}).)*\}\}|\{%(?:" + STRING + r"|(?!%\}).)*%\}|\{#.*?#\})", re.S)


def _expression(source: str) -> tuple:
    tokens, at = [], 0
    while source[at:].strip():
        m = TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        at = m.end()
        tokens.append(m)
    pos = depth = 0

    def peek(*words: str) -> bool:
        return pos < len(tokens) and tokens[pos].group().strip() in words

    def take() -> re.Match:
        nonlocal pos
        if pos == len(tokens):
            raise TemplateError(f"expression ends early: {source!r}")
        pos += 1
        return tokens[pos - 1]

    def binary(ops: tuple[str, ...], lower: Callable) -> tuple:
        left = lower()
        while peek(*ops):
            left = (take().group().strip(), left, lower())
        return left

    def deeper() -> None:
        nonlocal depth
        depth += 1
        if depth > MOST_DEPTH:
            raise TemplateError(f"nested more than {MOST_DEPTH} deep: {source[:80]!r}")

    def primary() -> tuple:
        m = take()
        text, number, name, op = m.groups()
        if text is not None:
            out = ("const", re.sub(r"\\(.)", lambda x: ESCAPES.get(x[1], x[1]), text[1:-1]))
        elif number is not None:
            out = ("const", int(number))
        elif name in ("true", "false"):
            out = ("const", name == "true")
        elif name is not None and name not in ("and", "or", "not"):
            if "__" in name:
                raise TemplateError(f"{name} is not allowed")
            out = ("name", tuple(name.split(".")))
        elif op == "(":
            deeper()
            out = either()
            if take().group().strip() != ")":
                raise TemplateError(f"no closing parenthesis: {source!r}")
        else:
            raise TemplateError(f"unexpected {m.group()!r}")
        while peek("|"):
            take()
            f = take().group().strip()
            if f not in FILTERS:
                raise TemplateError(f"no filter {f!r}")
            out = ("filter", f, out)
        return out

    def plus() -> tuple:
        return binary(("+",), primary)

    def compare() -> tuple:
        return binary(("==", "!="), plus)

    def negation() -> tuple:
        if peek("not"):
            take()
            deeper()
            return ("not", negation())
        return compare()

    def both() -> tuple:
        return binary(("and",), negation)

    def either() -> tuple:
        return binary(("or",), both)

    out = either()
    if pos != len(tokens):
        raise TemplateError(f"more than one expression: {source!r}")
    return out


def parse(template: str) -> list[tuple]:
    """The syntax tree of ``template``."""
    pieces = TAG.split(template)
    at = 0

    def block(*ends: str) -> tuple[list[tuple], str]:
        nonlocal at
        body: list[tuple] = []
        while at < len(pieces):
            piece = pieces[at]
            at += 1
            if piece.startswith("{{"):
                body.append(("out", _expression(piece[2:-2])))
            elif piece.startswith("{%"):
                tag = piece[2:-2].strip()
                word = tag.split(None, 1)[0] if tag else ""
                if word in ends:
                    return body, tag
                if word == "for":
                    m = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+(messages)", tag)
                    if not m or "__" in m[1]:
                        raise TemplateError(f"cannot read {tag!r}")
                    body.append(("for", m[1], m[2], block("endfor")[0]))
                elif word == "if":
                    arms, other, end = [], [], tag
                    while end.split(None, 1)[0] in ("if", "elif"):
                        test = _expression(end.split(None, 1)[1] if " " in end else "")
                        inner, end = block("elif", "else", "endif")
                        arms.append((test, inner))
                    if end == "else":
                        other = block("endif")[0]
                    body.append(("if", arms, other))
                elif word == "generation":
                    body.append(("generation", block("endgeneration")[0]))
                else:
                    raise TemplateError(f"unknown tag {tag!r}")
            elif piece and not piece.startswith("{#"):
                body.append(("text", piece))
        if ends:
            raise TemplateError(f"no {ends[-1]}")
        return body, ""

    return block()[0]


def _text(value) -> str:
    return "" if value is None else str(value)


OPERATIONS = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "and": lambda a, b: a and b, "or": lambda a, b: a or b, "+": lambda a, b: _text(a) + _text(b)}


def _fold_expression(e: tuple) -> tuple:
    kind = e[0]
    if kind in ("const", "name"):
        return e
    if kind == "filter":
        inner = _fold_expression(e[2])
        return ("const", FILTERS[e[1]](_text(inner[1]))) if inner[0] == "const" else (kind, e[1], inner)
    parts = [_fold_expression(x) for x in e[1:]]
    if all(p[0] == "const" for p in parts):
        return ("const", (not parts[0][1]) if kind == "not" else OPERATIONS[kind](parts[0][1], parts[1][1]))
    return (kind, *parts)


def fold(body: list[tuple]) -> list[tuple]:
    """Constant expressions become text, decided branches go, and neighbouring texts are joined."""
    out: list[tuple] = []
    for node in body:
        new: list[tuple] = [node]
        if node[0] == "out":
            e = _fold_expression(node[1])
            new = [("text", _text(e[1]))] if e[0] == "const" else [("out", e)]
        elif node[0] == "for":
            new = [(*node[:3], fold(node[3]))]
        elif node[0] == "generation":
            new = [("generation", fold(node[1]))]
        elif node[0] == "if":
            arms, other = [], fold(node[2])
            for test, inner in node[1]:
                test = _fold_expression(test)
                if test[0] != "const":
                    arms.append((test, fold(inner)))
                elif test[1]:
                    other = fold(inner)
                    break
            new = [("if", arms, other)] if arms else other
        for n in new:
            if n[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + n[1])
            elif n != ("text", ""):
                out.append(n)
    return out


def _value(e: tuple) -> Callable[[dict], object]:
    kind = e[0]
    if kind == "const":
        return lambda env, v=e[1]: v
    if kind == "name":

        def look(env, path=e[1]):
            value = env
            for part in path:
                value = value.get(part) if isinstance(value, dict) else None
            return value

        return look
    if kind == "filter":
        return lambda env, f=FILTERS[e[1]], x=_value(e[2]): f(_text(x(env)))
    if kind == "not":
        return lambda env, x=_value(e[1]): not x(env)
    if kind in ("and", "or"):
        a, b = _value(e[1]), _value(e[2])
        return (lambda env: a(env) and b(env)) if kind == "and" else (lambda env: a(env) or b(env))
    return lambda env, f=OPERATIONS[kind], a=_value(e[1]), b=_value(e[2]): f(a(env), b(env))


def _with_last(items: Iterator) -> Iterator[tuple[object, bool]]:
    items = iter(items)
    try:
        held = next(items)
    except StopIteration:
        return
    for x in items:
        yield held, False
        held = x
    yield held, True


def _run(body: list[tuple]) -> Callable[[dict, bool], Iterator[tuple[str, bool]]]:
    steps: list[Callable] = []
    for node in body:
        if node[0] == "text":
            steps.append(lambda env, masked, s=node[1]: ((s, masked),))
        elif node[0] == "out":
            steps.append(lambda env, masked, v=_value(node[1]): ((_text(v(env)), masked),))
        elif node[0] == "generation":
            steps.append(lambda env, masked, inner=_run(node[1]): inner(env, True))
        elif node[0] == "if":

            def choose(env, masked, arms=[(_value(t), _run(b)) for t, b in node[1]], other=_run(node[2])):
                return next((b for t, b in arms if t(env)), other)(env, masked)

            steps.append(choose)
        else:

            def loop(env, masked, name=node[1], source=node[2], inner=_run(node[3])):
                for i, (item, last) in enumerate(_with_last(env[source])):
                    yield from inner({**env, name: item, "loop": {"index": i + 1, "first": i == 0, "last": last}}, masked)

            steps.append(loop)

    def run(env, masked=False):
        for step in steps:
            yield from step(env, masked)

    return run


def compile_template(template: str) -> Callable[[Iterator[dict]], Iterator[tuple[str, bool]]]:
    """A closure from an iterator of messages to pieces of text, each with whether it lies under the loss mask."""
    run = _run(fold(parse(template)))
    return lambda messages: run({"messages": messages})


PARTS = "conv_id string, part long, formatted string, loss array<struct<start:long,stop:long>>"


def _runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """Runs of rows with the same key, streamed across batches."""
    rows = (r for b in batches for r in b.where(b.notna(), None).to_dict("records"))
    held = next(rows, None)
    while held is not None:
        current = held[key]
        done = False

        def run():
            nonlocal held, done
            while held is not None and held[key] == current:
                row = held
                held = next(rows, None)
                yield row
            done = True

        items = run()
        yield current, items
        for _ in items:
            pass
        assert done


def format_conversations(turns: DataFrame, template: str = CHATML, part_chars: int = 1 << 20) -> DataFrame:
    """Formatted conversations in parts of about ``part_chars``; spans under the loss mask are offsets in the part.

    Rows are dealt by conversation and sorted by turn inside Spark; a task holds one message and one part at a time.
    Conversations with a null id are taken as one.
    """
    render = compile_template(template)

    def run(batches):
        for key, rows in _runs(batches, "conv_id"):
            part, pieces, spans, size = 0, [], [], 0
            messages = ({"role": r["role"] or "", "text": r["text"] or ""} for r in rows)
            for text, masked in render(messages):
                if masked and text:
                    spans.append({"start": size, "stop": size + len(text)})
                pieces.append(text)
                size += len(text)
                if size >= part_chars:
                    yield pd.DataFrame([(key, part, "".join(pieces), spans)], columns=["conv_id", "part", "formatted", "loss"])
                    part, pieces, spans, size = part + 1, [], [], 0
            yield pd.DataFrame([(key, part, "".join(pieces), spans)], columns=["conv_id", "part", "formatted", "loss"])

    def gathered(batches):
        """Small parts leave together."""
        held, size = [], 0
        for frame in run(batches):
            held.append(frame)
            size += len(frame["formatted"][0])
            if size >= part_chars or len(held) >= 1000:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    rows = turns.select(F.col("conv_id").cast("string").alias("conv_id"), "turn", "role", "text").repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return rows.mapInPandas(gathered, PARTS)


TURN = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE) + r"\n", re.S)
READ = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(parts: DataFrame) -> DataFrame:
    """Turns and loss texts of the default template's output, by streaming through the parts in their order.

    ``parts`` must come as ``format_conversations`` gives them: a conversation's parts together and in order.
    """

    def run(batches):
        out = []
        for key, rows in _runs(batches, "conv_id"):
            turns, losses = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = 0
            rest = ""
            for r in rows:
                text = r["formatted"]
                chars += len(text)
                for span in r["loss"] if r["loss"] is not None else ():  # a text is one piece, so it never crosses parts
                    clean = unguard(text[span["start"] : span["stop"]])
                    loss_chars += len(clean)
                    losses.update(clean.encode())
                rest += text
                end = 0
                for m in TURN.finditer(rest):
                    n += 1
                    turns.update(f"{unline(m[1])}\n{unguard(m[2])}\n".encode())
                    end = m.end()
                rest = rest[end:]
            if rest:
                raise ValueError(f"conversation {key} doesn't end with a turn")
            out.append((key, n, turns.hexdigest(), loss_chars, losses.hexdigest(), chars))
            if len(out) >= 5000:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in READ.split(", ")])
                out = []
        yield pd.DataFrame(out, columns=[c.split()[0] for c in READ.split(", ")])

    return parts.mapInPandas(run, READ).withColumn("conv_id", F.col("conv_id").cast("long"))
