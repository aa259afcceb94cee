"""Repair of mathematical markup in Markdown, outside code.

A text is first cut into stretches of prose and of code: fences by lines, code spans by equal runs of backticks within prose.
Repairs then look at prose only, or, for what has a macro in it, at everything. Whether a mark opens or closes something depends
on what came before it, so the scan runs in Arrow batches of Python; every function takes and gives one text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, DataType, StringType

# The marks of a fence, the delimiters that are replaced and what replaces them, and the two commands between
# which a converter leaves the text of a coloured label.
FENCES = ("```", "~~~")
INLINE_MATH, DISPLAY_MATH, DOLLAR = ("\\(", "\\)"), ("\\[", "\\]"), "$"
LABEL_FROM, LABEL_TO = r"\text{{\color[rgb]{", r"\pgfsys@color@gray@fill{0}"
SMALL_CAPS = r"\textsc{"
TEXT_MACROS = (r"\texttt{", r"\text{")

PROSE, FENCE, SPAN = "prose", "fence", "span"


def _fences(text: str) -> Iterator[tuple[str, str]]:
    """Stretches of prose and of fenced code, by lines. A fence without an end reaches to the end of the text."""
    held, mark = [], ""
    for line in text.splitlines(keepends=True):
        start = line.lstrip(" \t")[:3]
        if mark:
            held.append(line)
            if start == mark:
                yield FENCE, "".join(held)
                held, mark = [], ""
        elif start in FENCES:
            if held:
                yield PROSE, "".join(held)
            held, mark = [line], start
        else:
            held.append(line)
    if held:
        yield (FENCE if mark else PROSE), "".join(held)


def stretches(text: str) -> Iterator[tuple[str, str]]:
    """Prose, fences and code spans of a text, in order; joined again they are the text."""
    for kind, part in _fences(text):
        at = 0
        while kind == PROSE and (tick := part.find("`", at)) >= 0:
            n = len(part) - tick - len(part[tick:].lstrip("`"))
            close = part.find("`" * n, tick + n)
            if close < 0:
                break
            if tick > at:
                yield PROSE, part[at:tick]
            yield SPAN, part[tick : close + n]
            at = close + n
        if at < len(part):
            yield kind, part[at:]


def _escaped(text: str, at: int) -> bool:
    """Whether a backslash stands right before the place."""
    return at > 0 and text[at - 1] == "\\"


def _between(text: str, marks: tuple[str, str], one_line: bool, render) -> str:
    """Each stretch between two marks as ``render`` gives it; a mark that nothing closes stays."""
    out, at, search = [], 0, 0
    while (start := text.find(marks[0], search)) >= 0:
        search = start + len(marks[0])
        if _escaped(text, start):
            continue
        end = text.find(marks[1], search)
        inside = text[search:end] if end >= 0 else ""
        if end < 0 or one_line and "\n" in inside:
            continue
        out += [text[at:start], render(inside)]
        at = search = end + len(marks[1])
    return "".join([*out, text[at:]])


def _dollars(text: str) -> str:
    text = _between(text, DISPLAY_MATH, False, lambda x: f"$$\n{x.strip()}\n$$")
    return _between(text, INLINE_MATH, True, lambda x: f"${x}$")


def _indent(line: str) -> str:
    return line[: len(line) - len(line.lstrip(" \t"))]


def _display_on_one_line(line: str) -> str | None:
    """What a line of display mathematics holds if inline dollars stand within it and a blank follows its opening."""
    bare = line.strip(" \t")
    if not bare.startswith("$$") or len(bare) < 4 or bare[2] not in " \t":
        return None
    inner = bare[2:].rstrip("$") if bare.endswith("$") else ""
    closing = len(bare) - 2 - len(inner)
    # the closing is two dollars or one; more of them belong to what is inside
    inner += "$" * max(0, closing - 2)
    return inner if closing and DOLLAR in inner else None


def _display(text: str) -> str:
    """Display mathematics on lines of its own, without inline dollars in it."""
    out, block = [], None
    for line in text.splitlines(keepends=True):
        bare = line.strip()
        if block is not None:
            if bare == "$$":
                inner = "".join(block[1:]).strip().replace(DOLLAR, "").strip()
                out += [block[0], inner + "\n" if inner else "", line]
                block = None
            else:
                block.append(line)
            continue
        if bare == "$$":
            block = [line]
            continue
        inner = _display_on_one_line(line.rstrip("\n"))
        if inner is None:
            out.append(line)
        else:
            pad, end = _indent(line), "\n" if line.endswith("\n") else ""
            out.append(f"{pad}$$\n{inner.replace(DOLLAR, '').strip()}\n{pad}$${end}")
    return "".join([*out, *(block or [])])


def _labels(text: str) -> str:
    """Coloured labels of a converter as plain text macros."""
    out, at = [], 0
    while (start := text.find(LABEL_FROM, at)) >= 0:
        found = text.find(LABEL_TO, start)
        end = text.find("}}", found + len(LABEL_TO)) if found >= 0 else -1
        label = text[found + len(LABEL_TO) : end] if end >= 0 else ""
        if end < 0 or not label or "{" in label or "}" in label:
            out.append(text[at : start + len(LABEL_FROM)])
            at = start + len(LABEL_FROM)
        else:
            out += [text[at:start], "\\text{", label.strip(), "}"]
            at = end + 2
    return "".join([*out, text[at:]])


def _arguments(text: str, macro: str, render) -> str:
    """Each macro with an argument that holds no braces as ``render`` gives it."""
    out, at, search = [], 0, 0
    while (start := text.find(macro, search)) >= 0:
        search = start + len(macro)
        end = search
        while end < len(text) and text[end] not in "{}":
            end += 1
        if end < len(text) and text[end] == "}":
            out += [text[at:start], render(text[search:end])]
            at = search = end + 1
    return "".join([*out, text[at:]])


def _small_caps(argument: str) -> str:
    words = argument.strip()
    if not argument:
        return SMALL_CAPS + "}"
    return ("\\text{" if len(words.split()) > 1 else "\\mathrm{") + words + "}"


def _underscores(argument: str) -> str:
    return "".join("\\_" if c == "_" and not _escaped(argument, i) else c for i, c in enumerate(argument))


def normalise_math(markdown: str) -> str:
    """Bracket delimiters as dollars, inline delimiters within display ones removed, macros that cannot be shown replaced."""
    text = _display("".join(_dollars(part) if kind == PROSE else part for kind, part in stretches(markdown)))
    text = _arguments(_labels(text), SMALL_CAPS, _small_caps)
    for macro in TEXT_MACROS:
        text = _arguments(text, macro, lambda x, m=macro: m + _underscores(x) + "}")
    return text


def has_bad_math(markdown: str) -> bool:
    """Whether prose still holds bracket delimiters, small capitals, or inline dollars at an end of display mathematics."""
    prose = "".join(part if kind == PROSE else " " * len(part) for kind, part in stretches(markdown))
    if SMALL_CAPS in prose:
        return True
    if any(not _escaped(prose, i) for mark in (*INLINE_MATH, *DISPLAY_MATH) for i in _places(prose, mark)):
        return True
    # blanks, line breaks among them, may stand between the two
    after = (prose[i + 2 :] for i in _places(prose, "$$") if not prose[:i].rpartition("\n")[2].strip())
    before = (prose[:i] for i in _places(prose, "$$") if not prose[i + 2 :].partition("\n")[0].strip())
    opens = any(x[:1].isspace() and x.lstrip().startswith(DOLLAR) for x in after)
    return opens or any(x[-1:].isspace() and x.rstrip().endswith(DOLLAR) for x in before)


def _places(text: str, mark: str) -> Iterator[int]:
    at = text.find(mark)
    while at >= 0:
        yield at
        at = text.find(mark, at + 1)


def _front(lines: list[str]) -> int:
    """How many lines the front matter takes, its rules included; 0 if there is none."""
    if not lines or lines[0].rstrip() != "---":
        return 0
    return next((i + 1 for i, line in enumerate(lines[1:], 1) if line.rstrip() == "---"), 0)


def _repeated_heading(lines: list[str]) -> int | None:
    """The line of a first-level heading that begins the body and says what the title in front says."""
    n = _front(lines)
    title = next((x.partition(":")[2] for x in lines[1:n] if x.startswith("title:")), None)
    first = next((i for i in range(n, len(lines)) if lines[i].strip()), None)
    if title is None or first is None or not lines[first].startswith("# "):
        return None
    same = lambda x: " ".join(x.split())
    return first if same(lines[first][2:]) == same(title.strip().strip("'\"")) else None


def without_repeated_heading(markdown: str) -> str:
    lines = markdown.splitlines(keepends=True)
    at = _repeated_heading(lines)
    return markdown if at is None else "".join(lines[:at] + lines[at + 1 :])


def _mapped(f, kind: DataType):
    @pandas_udf(kind)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else f(t))

    return run


math_normalised = _mapped(normalise_math, StringType())
bad_math = _mapped(has_bad_math, BooleanType())
heading_once = _mapped(without_repeated_heading, StringType())
repeated_heading = _mapped(lambda t: _repeated_heading(t.splitlines(keepends=True)) is not None, BooleanType())
