"""Blocks and statements of sources, by one scanner that languages drive with tables of their own.

The scanner knows brackets, strings, comments and where statements end; what a statement means is left to patterns over
its rows, in ``outline`` and the modules beside it. Each piece of code is in exactly one statement row; a block has a row
of its own besides, with the text that leads to it.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.functions.names import path_to_module
from plexus.plans.graph import spread

#: kind: block or text. ``code`` is on one line, its strings are ``"<index in strings>"`` and blocks in it ``{}``. A
#: block's code leads to its brace, ``item`` is what follows the last comma outside brackets in it. ``ups`` are the ids of
#: the blocks around it from the file (0) inwards, ``holds`` those of the blocks that stand in a statement.
SCHEMA = "path string, module_qn string, lang string, kind string, id int, parent int, ups array<int>, code string, item string, holds array<int>, strings array<string>, start_line int, end_line int, col int"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
AT_ONCE = 5000


@dataclass(frozen=True)
class Language:
    """suffixes; patterns of comments, strings and whole-line directives; whether lines end statements; words that open and close blocks; blocks whose members commas part."""

    suffixes: tuple[str, ...]
    comments: str = r"//[^\n]*|/\*[\s\S]*?(?:\*/|\Z)"
    strings: str = r"\"(?:[^\"\\\n]|\\[\s\S])*\"|'(?:[^'\\\n]|\\[\s\S])*'"
    directives: str = r"(?!)"
    lines: bool = False
    opens: str = r"(?!)"
    closes: str = r"(?!)"
    #: What leads to a block whose statements commas end.
    lists: str = r"(?!)"


#: A slash that begins a pattern stands where a value does.
_JS_PATTERN = r"(?<=[(=,:\[!&|?{};\n])[ \t]*/(?![*/])(?:\\.|\[(?:\\.|[^\]\n])*\]|[^/\\\n\[])+/[a-z]*"
_CHARACTER = r"'(?:[^'\\\n]|\\[^\n][^'\n]*)'"
LANGUAGES = {
    "javascript": Language((".js", ".jsx", ".mjs", ".cjs", ".ts", ".tsx"), strings=Language(()).strings + r"|`(?:[^`\\]|\\[\s\S])*`|" + _JS_PATTERN, lines=True, lists=r"(?:[=(,:?\[]|\breturn|\bdefault)\s*$"),
    "java": Language((".java",), strings=r"\"\"\"[\s\S]*?\"\"\"|" + Language(()).strings),
    "go": Language((".go",), strings=r"\"(?:[^\"\\\n]|\\.)*\"|`[^`]*`|" + _CHARACTER, lines=True),
    "rust": Language((".rs",), strings=r"r(?P<hash>#*)\"[\s\S]*?\"(?P=hash)|b?\"(?:[^\"\\]|\\[\s\S])*\"|b?" + _CHARACTER, directives=r"#!?\[[^\]\n]*\]"),
    "cpp": Language((".cpp", ".cc", ".cxx", ".c", ".h", ".hpp", ".hh", ".ixx", ".cppm", ".ccm"), strings=r"R\"(?P<raw>[^(\s]*)\([\s\S]*?\)(?P=raw)\"|" + Language(()).strings, directives=r"^[ \t]*#(?:[^\n\\]|\\\n|\\.)*"),
    "lua": Language(
        (".lua",), comments=r"--\[(?P<c>=*)\[[\s\S]*?\](?P=c)\]|--[^\n]*", strings=Language(()).strings + r"|\[(?P<s>=*)\[[\s\S]*?\](?P=s)\]", lines=True,
        opens=r"\bfunction\b\s*[\w.:]*\s*\([^()]*\)|\b(?:if|do|repeat)\b", closes=r"\b(?:end|until)\b", lists=r"(?:[=({,]|\breturn)\s*$",
    ),
}
#: A line does not end a statement after these, nor before those.
_GOES_ON, _FOLLOWS = re.compile(r"[,.=+*/&|?:<>!~^%-]$"), re.compile(r"\s*[.?:=+*&|,{]")
_NOT_OVER = re.compile(r"(?:\+\+|--|=>\s*\{\})$")
_GROUPS = re.compile(r"\((?:[^()]|\([^()]*\))*\)")
_QUOTES = re.compile(r"^[rRb]*#*(?:\"\"\"|[\"'`]|\[=*\[)|(?:\"\"\"|[\"'`]|\]=*\])#*$")
#: What goes on behind its block: a value, a list of names.
_VALUE = re.compile(r"return\b|export default\b(?!.*\b(?:class|function)\b)|(?:import|export)\s*(?:type\s*)?(?:[\w$]+\s*,\s*)?$")


@functools.lru_cache
def tokens(lang: str) -> re.Pattern:
    x = LANGUAGES[lang]
    return re.compile(rf"(?P<comment>{x.comments})|(?P<directive>{x.directives})|(?P<string>{x.strings})|(?P<open>{x.opens})|(?P<close>{x.closes})|(?P<mark>[{{}}()\[\];,\n])", re.M)


@dataclass
class Open:
    """An open bracket. Of a block: its id and the statement that is being read; of others the mark only."""

    mark: str
    id: int = -1
    parts: list[str] | None = None
    strings: list[str] | None = None
    holds: list[int] | None = None
    start: int = -1
    is_list: bool = False

    def clear(self) -> None:
        self.parts, self.strings, self.holds, self.start = [], [], [], -1


def _item(code: str) -> str:
    """What follows the last comma outside brackets."""
    depth, at = 0, 0
    for i, c in enumerate(code):
        depth += (c in "([") - (c in ")]")
        if c == "," and depth <= 0:
            at = i + 1
        elif c in "([" and i > 0 and depth > 0 and code.count(c, i) > code.count(")" if c == "(" else "]", i):
            at, depth = i + 1, 0  # a bracket that is still open: only what it holds counts
    return code[at:].strip()


def scanned(content: str, lang: str) -> list[dict]:
    """The rows of one source. Brackets that do not match are closed where their block ends; an open block ends with the file."""
    lines = [0, *(m.end() for m in re.finditer("\n", content))]
    line = lambda at: bisect.bisect_right(lines, at)
    x, out, blocks, last = LANGUAGES[lang], [], 1, 0
    root = Open("{", 0)
    root.clear()
    stack, own = [root], [root]  # all brackets; the blocks among them
    by_id: dict[int, dict] = {}

    def add(text: str, at: int) -> None:
        top = own[-1]
        if text.strip() or top.parts:
            if top.start < 0:
                top.start = at + len(text) - len(text.lstrip())
            top.parts.append(text)

    def code_of(top: Open) -> str:
        return " ".join("".join(top.parts).split())

    def finish(at: int) -> None:
        top = own[-1]
        if code := code_of(top):
            out.append({"kind": "text", "id": -1, "parent": top.id, "ups": [b.id for b in own], "code": code, "item": "", "holds": top.holds, "strings": top.strings, "start_line": line(top.start), "end_line": line(max(top.start, at - 1)), "col": top.start - lines[line(top.start) - 1]})
        top.clear()

    def enter(at: int) -> None:
        nonlocal blocks
        top = own[-1]
        code = code_of(top)
        start = top.start if top.start >= 0 else at
        by_id[blocks] = {"kind": "block", "id": blocks, "parent": top.id, "ups": [b.id for b in own], "code": code, "item": _item(code), "holds": [], "strings": list(top.strings), "start_line": line(start), "end_line": line(at), "col": at - lines[line(at) - 1]}
        out.append(by_id[blocks])
        if top.start < 0:
            top.start = at
        top.parts.append("{}")
        top.holds.append(blocks)
        inner = Open("{", blocks, is_list=bool(re.search(x.lists, code)))
        inner.clear()
        blocks += 1
        stack.append(inner)
        own.append(inner)

    def leave(at: int, end: int) -> None:
        if len(own) == 1:
            return
        finish(at)
        while stack.pop() is not own[-1]:
            pass
        block = by_id[own.pop().id]
        block["end_line"] = line(at)
        if stack[-1] is own[-1]:
            outer = _GROUPS.sub("", block["code"])
            goes_on = ("=" in outer and "operator" not in outer) or (lang == "javascript" and _VALUE.match(outer)) or outer.startswith("return ") or (x.lines and re.match(r"\s*[.,)(]", content[end : end + 2]))
            if not goes_on:
                finish(end)

    for m in tokens(lang).finditer(content):
        at, end, text = m.start(), m.end(), m[0]
        kind = next(k for k in ("comment", "directive", "string", "open", "close", "mark") if m[k] is not None)
        add(content[last:at], last)
        last = end
        if kind == "comment":
            add(" ", at)
        elif kind == "string":
            own[-1].strings.append(text.strip() if text.lstrip().startswith("/") else _QUOTES.sub("", text))
            add(f'"{len(own[-1].strings) - 1}"', at)
        elif kind == "directive":
            if stack[-1] is own[-1] and (lang == "cpp" or not own[-1].parts):
                if lang == "cpp":
                    finish(at)
                    add(text, at)
                    finish(end)
            else:
                add(" ", at)
        elif kind == "open":
            add(text, at)
            enter(end)
        elif kind == "close":
            leave(at, end)
        elif text == "{":
            enter(at)
        elif text == "}":
            leave(at, end)
        elif text in "([":
            add(text, at)
            stack.append(Open(text))
        elif text in ")]":
            if len(stack) > 1 and stack[-1] is not own[-1]:
                stack.pop()
            add(text, at)
        elif stack[-1] is not own[-1]:
            add(" " if text == "\n" else text, at)
        elif text == ";" or (text == "," and own[-1].is_list):
            finish(end)
        elif text == ",":
            add(text, at)
        else:
            code = code_of(own[-1]) if x.lines else ""
            over = code and (_NOT_OVER.search(code) or not _GOES_ON.search(code)) and not _FOLLOWS.match(content, end)
            if over:
                finish(at)
            else:
                add(" ", at)
    add(content[last:], last)
    while len(own) > 1:
        leave(len(content), len(content))
    finish(len(content))
    return out


def statements(files: DataFrame, project: str, *langs: str) -> DataFrame:
    """Rows of ``SCHEMA`` of files (path, content) in ``langs`` (all by default). Null contents and other suffixes have no rows."""
    of = {s: name for name in langs or LANGUAGES for s in LANGUAGES[name].suffixes}

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            rows: list[list] = []
            for path, module, content in part.itertuples(index=False):
                lang = of["." + path.rsplit(".", 1)[-1].lower()]
                rows += [[{"path": path, "module_qn": module, "lang": lang, **r}[c] for c in COLUMNS] for r in scanned(content, lang)]
                if len(rows) >= AT_ONCE:
                    yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)

    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    own = files.filter(F.col("content").isNotNull() & suffix.isin(*of))
    return spread(own.select("path", F.concat(F.lit(project + "."), path_to_module(F.col("path"))).alias("module_qn"), "content")).mapInPandas(run, SCHEMA)
