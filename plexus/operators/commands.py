"""Validation of read-only shell commands (F32)."""

from __future__ import annotations

import re
import shlex

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Allowed commands, fixed values.
READ_ONLY = ("ls", "find", "tree", "stat", "file", "grep", "rg", "ag", "ack", "head", "tail", "wc", "cat", "git")
SINKS = ("head", "tail", "wc", "less", "sort", "uniq", "grep", "cut")
RISKY_SINKS = ("awk", "sed")
GIT = ("status", "log", "diff", "show", "branch", "tag", "ls-files", "ls-tree", "rev-parse", "describe", "rev-list", "cat-file", "name-rev", "shortlog", "blame")
#: Forbidden outside quotes, in order of report, fixed values.
FORBIDDEN = (
    (r"[>]", "Redirects (>, >>, <) are not allowed"),
    (r"<(?![<])", "Redirects (>, >>, <) are not allowed"),
    (r"&&", "Command chains (&&, ||, ;) are not allowed"),
    (r"\|\|", "Command chains (&&, ||, ;) are not allowed"),
    (r";", "Command chains (&&, ||, ;) are not allowed"),
    (r"\$\(", "Subshells ($(...), `...`) are not allowed"),
    (r"`", "Subshells ($(...), `...`) are not allowed"),
    (r"&(?!&)", "Background execution (&) is not allowed"),
)
_TOKEN = re.compile(r"\\.|'|\"|[^\\'\"]+|\\", re.S)


def outside(command: str) -> tuple[str, str]:
    """The command with quoted characters blanked, and the same with escaped ones blanked too; a quote mark itself is blank."""
    mark, plain, bare = "", [], []
    for token in _TOKEN.findall(command):
        if token in ("'", '"') and mark in ("", token):
            mark = "" if mark else token
            token = "\0"
        shown = "\0" * len(token) if mark else token
        plain.append(shown)
        bare.append("\0" * len(token) if len(token) == 2 and token[0] == "\\" else shown)
    return "".join(plain), "".join(bare)


def fault(command: str | None, risky: bool = False) -> str | None:
    """What is wrong with a command; None if nothing is."""
    command = (command or "").strip()
    plain, bare = outside(command)
    for pattern, message in FORBIDDEN:
        if re.search(pattern, plain):
            return message
    cuts = [-1, *[i for i, ch in enumerate(bare) if ch == "|"], len(command)]
    segments = [s for a, b in zip(cuts, cuts[1:], strict=False) if (s := command[a + 1 : b].strip())]
    if not segments:
        return "Empty command"
    sinks = sorted(SINKS + (RISKY_SINKS if risky else ()))
    for i, segment in enumerate(segments):
        try:
            words = shlex.split(segment)
        except ValueError as e:
            return f"Failed to parse command: {e}"
        if not words:
            continue
        head, sub = words[0], words[1] if len(words) > 1 else "-"
        if i and head not in sinks:
            return f"Command '{head}' not allowed after pipe. Allowed: {', '.join(sinks)}"
        if not i and head not in READ_ONLY:
            return f"Command '{head}' not in allowlist"
        if not i and head == "git" and not sub.startswith("-") and sub not in GIT:
            return f"Git subcommand '{sub}' not allowed. Allowed: {', '.join(sorted(GIT))}"
    return None


def validated(cmd: Column, risky: bool = False) -> Column:
    """valid and error of a command."""

    @F.pandas_udf("valid boolean, error string")
    def check(s: pd.Series) -> pd.DataFrame:
        known = {x: fault(x, risky) for x in s.dropna().unique()}
        error = [known[x] if isinstance(x, str) else "Empty command" for x in s]
        return pd.DataFrame({"valid": [e is None for e in error], "error": pd.Series(error, dtype=object)})

    return check(cmd)


#: Commands and Git subcommands that run without approval, and redirects, fixed values.
UNASKED = ("ls", "cat", "find", "pwd", "rg", "echo", "wc", "head", "tail", "sort", "uniq", "cut", "tr")
UNASKED_GIT = ("status", "log", "diff", "show", "ls-files", "remote", "config", "branch")
REDIRECTS = (">", ">>", "<", "<<")
_OPERATOR = re.compile(r"&&|\|\||;|\|")


def groups(command: str) -> list[tuple[str | None, list[str]]]:
    """pipelines of a command line with the operator before each; operators in quotes or after a backslash are text."""
    bare, out, operator, pipeline, at = outside(command)[1], [], None, [], 0
    for m in [*_OPERATOR.finditer(bare), None]:
        if segment := command[at : m.start() if m else None].strip():
            pipeline.append(segment)
        if m is None or m[0] != "|":
            if pipeline:
                out.append((operator, pipeline))
            operator, pipeline = m and m[0], []
        at = m.end() if m else at
    return out


def needs_approval(command: str | None) -> bool:
    """whether any command of the line is not known to be harmless; so is a line without commands, null or badly quoted."""
    try:
        parts = [shlex.split(s) for _, pipeline in groups(command or "") for s in pipeline]
    except ValueError:
        return True
    known = lambda p: not set(p) & set(REDIRECTS) and (p[0] in UNASKED or (p[0] == "git" and len(p) > 1 and p[1] in UNASKED_GIT))
    return not any(parts) or not all(known(p) for p in parts if p)


def grouped(cmd: Column) -> Column:
    """F33 as a struct: n_groups, n_commands, approval; a null line has none and needs approval."""

    @F.pandas_udf("n_groups bigint, n_commands bigint, approval boolean")
    def split(s: pd.Series) -> pd.DataFrame:
        found = [groups(x or "") for x in s]
        return pd.DataFrame({"n_groups": [len(g) for g in found], "n_commands": [sum(len(p) for _, p in g) for g in found], "approval": [needs_approval(x) for x in s]})

    return split(cmd)
