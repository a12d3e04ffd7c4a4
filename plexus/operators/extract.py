"""Definitions, imports and calls of Python sources, as rows; names are resolved by joins afterwards."""

from __future__ import annotations

import ast
import difflib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from plexus.functions.names import path_to_module
from plexus.plans.graph import spread

#: kind: Function, Class, Method, import, call or error; a row fills the columns that its kind has.
SCHEMA = "path string, module_qn string, kind string, qualified_name string, name string, parent string, start_line bigint, end_line bigint, docstring string, decorators array<string>, bases array<string>, full_name string, is_wildcard boolean, call_name string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Rows sent back at once, and those of one source more.
AT_ONCE = 5000
#: Where a statement holds further ones, in the order of the source.
BLOCKS = ("body", "handlers", "orelse", "finalbody", "cases")
SCOPES = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)


def dotted(node: ast.AST) -> str | None:
    """``a.b.c`` of a chain of names; a chain that starts from a call or a subscript keeps what follows it."""
    parts = []
    while isinstance(node, ast.Attribute):
        parts.append(node.attr)
        node = node.value
    if isinstance(node, ast.Name):
        parts.append(node.id)
    return ".".join(reversed(parts)) or None


def _import_rows(node: ast.Import | ast.ImportFrom, module: str) -> Iterator[dict]:
    if isinstance(node, ast.Import):
        for a in node.names:
            yield {"name": a.asname or a.name.split(".")[0], "full_name": a.name, "is_wildcard": False}
        return
    base = node.module or ""
    if node.level:
        base = ".".join([*module.split(".")[: -node.level], *([base] if base else [])])
    for a in node.names:
        star = a.name == "*"
        yield {"name": f"*{base}" if star else a.asname or a.name, "full_name": base if star else f"{base}.{a.name}", "is_wildcard": star}


def found_in(module: str, content: str) -> list[dict]:
    """Rows of one source. A call belongs to the function around it, or else to the module; a source that does not parse has one error row."""
    try:
        tree = ast.parse(content)
    except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
        return [{"kind": "error", "name": type(e).__name__}]
    return found_under(module, tree)


def found_under(module: str, tree: ast.Module, calls: bool = True) -> list[dict]:
    """Rows of a parsed source; without ``calls``, expressions are left out, as they define and import nothing."""
    out: list[dict] = []
    # Each entry: a node, the scope's qualified name, whether the scope is a class, and the caller of its calls.
    todo = [(n, module, False, module) for n in reversed(tree.body)]
    while todo:
        node, scope, in_class, caller = todo.pop()
        inner = [*ast.iter_child_nodes(node)] if calls else [x for b in BLOCKS for x in getattr(node, b, ())]
        if isinstance(node, SCOPES):
            qn, is_class = f"{scope}.{node.name}", isinstance(node, ast.ClassDef)
            kind = "Class" if is_class else "Method" if in_class else "Function"
            out.append({
                "kind": kind, "qualified_name": qn, "name": node.name, "parent": scope, "start_line": node.lineno, "end_line": node.end_lineno, "docstring": ast.get_docstring(node),
                "decorators": [d for x in node.decorator_list if (d := dotted(x.func if isinstance(x, ast.Call) else x))], "bases": [b for x in node.bases if (b := dotted(x))] if is_class else None,
            })
            body = set(map(id, node.body))
            todo += [(n, qn, is_class, caller if is_class else qn) if id(n) in body else (n, scope, in_class, caller) for n in reversed(inner)]
            continue
        if isinstance(node, ast.Import | ast.ImportFrom):
            out += [{"kind": "import", "start_line": node.lineno, **r} for r in _import_rows(node, module)]
        elif isinstance(node, ast.Call) and (name := dotted(node.func)):
            out.append({"kind": "call", "parent": caller, "call_name": name, "start_line": node.lineno})
        todo += [(n, scope, in_class, caller) for n in reversed(inner)]
    return out


def extracted(files: DataFrame, project: str) -> DataFrame:
    """Files (path, content) to rows of ``SCHEMA``. Null contents and other suffixes have no rows.

    A module's name is the project and the path's parts; nested functions carry the names around them.
    """

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            rows: list[list] = []
            for path, module, content in part.itertuples(index=False):
                rows += [[{"path": path, "module_qn": module, **r}.get(k) for k in COLUMNS] for r in found_in(module, content)]
                if len(rows) >= AT_ONCE:
                    yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)

    own = files.filter(F.col("path").endswith(".py") & F.col("content").isNotNull())
    return spread(own.select("path", F.concat(F.lit(project + "."), path_to_module(F.col("path"))).alias("module_qn"), "content")).mapInPandas(run, SCHEMA)


def local_imports(rows: DataFrame, roots: DataFrame, project: str) -> DataFrame:
    """module_qn, local_name, full_name, is_wildcard; names that begin with one of the project's ``roots`` (root) get the project before them."""
    own = rows.filter("kind = 'import'").withColumn("root", F.substring_index("full_name", ".", 1))
    known = own.join(roots.distinct().withColumn("_here", F.lit(True)), "root", "left")
    full = F.when(F.col("_here"), F.concat(F.lit(project + "."), "full_name")).otherwise(F.col("full_name"))
    return known.select("module_qn", F.col("name").alias("local_name"), full.alias("full_name"), "is_wildcard")


def structure(files: DataFrame, project: str, indicators: tuple[str, ...] = ("__init__.py", "Cargo.toml")) -> tuple[DataFrame, DataFrame]:
    """Nodes (label, key, name, path) and edges (from_label, from_key, type, to_label, to_key) of files (path).

    A folder with an indicator file is a package, keyed by its dotted name; others are keyed by path. The root is the project.
    """
    parts = F.split("path", "/")
    ups = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")))
    dirs = files.filter(F.col("path").contains("/")).select(ups.alias("path")).distinct()
    name, up = lambda p: F.substring_index(p, "/", -1), lambda p: F.when(p.contains("/"), F.regexp_replace(p, "/[^/]*$", "")).otherwise("")
    marked = files.filter(name(F.col("path")).isin(*indicators)).select(up(F.col("path")).alias("path")).distinct().withColumn("_p", F.lit(True))
    kinds = dirs.join(marked, "path", "left").withColumn("label", F.when(F.col("_p"), "Package").otherwise("Folder"))
    dotted_path = F.concat(F.lit(project + "."), F.replace("path", F.lit("/"), F.lit(".")))
    kinds = kinds.select("label", F.when(F.col("_p"), dotted_path).otherwise(F.col("path")).alias("key"), name(F.col("path")).alias("name"), "path")
    found = files.select(F.lit("File").alias("label"), F.col("path").alias("key"), name(F.col("path")).alias("name"), "path")
    every = kinds.union(found)
    above = kinds.select(F.col("label").alias("_l"), F.col("key").alias("_k"), F.col("path").alias("_up"))
    held = every.withColumn("_up", up(F.col("path"))).join(above, "_up", "left")
    edges = held.select(F.coalesce("_l", F.lit("Project")).alias("from_label"), F.coalesce("_k", F.lit(project)).alias("from_key"), F.concat(F.lit("CONTAINS_"), F.upper("label")).alias("type"), F.col("label").alias("to_label"), F.col("key").alias("to_key"))
    return every, edges


def texts(located: DataFrame, files: DataFrame) -> DataFrame:
    """node_id, text, error of located (node_id, label, path, start_line, end_line) with files (path, content).

    Lines count from 1 and end at \\n, \\r\\n or \\r. Errors, first that holds: unknown, structural, no module, unreadable, out of range.
    """
    own = located.join(files.select("path", "content"), "path", "left").withColumn("_l", F.split("content", "\r\n|\r|\n"))
    start, end = F.col("start_line"), F.col("end_line")
    error = (
        F.when(F.col("label").isNull(), "unknown").when(F.col("label").isin("Project", "Package", "Folder", "ExternalPackage"), "structural").when(F.col("path").isNull(), "no module").when(F.col("content").isNull(), "unreadable")
        .when(start.isNull() | (start < 1) | (end < start) | (start > F.size("_l")), "out of range")
    )
    text = F.when(error.isNull(), F.array_join(F.slice("_l", start.cast("int"), (end - start + 1).cast("int")), "\n"))
    return own.select("node_id", text.alias("text"), error.alias("error"))


def excludable(paths: DataFrame, ignored: tuple[str, ...], deepest: int = 10) -> DataFrame:
    """Path: the topmost ignored folders, at most ``deepest`` folders below the root, of files (path)."""
    parts = F.split("path", "/")
    dirs = F.slice(parts, F.lit(1), F.size(parts) - 1)
    bad: Column = F.array_position(F.transform(dirs, lambda x: x.isin(*ignored)), True)
    return paths.select(F.when((bad > 0) & (bad <= deepest + 1), F.array_join(F.slice(dirs, F.lit(1), bad.cast("int")), "/")).alias("path")).filter("path IS NOT NULL").distinct()


def embedded(located: DataFrame, files: DataFrame, model: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """node_id, qualified_name, embedding of the worklist's texts; rows without a source have none.

    located: node_id, label, qualified_name, path, start_line, end_line. ``model`` gives a vector to each text of a batch.
    """
    own = texts(located, files).filter("text != ''").join(located.select("node_id", "qualified_name"), "node_id")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            yield pd.DataFrame({"node_id": part["node_id"], "qualified_name": part["qualified_name"], "embedding": pd.Series(model(part["text"].tolist()), dtype=object)})

    return own.select("node_id", "qualified_name", "text").mapInPandas(run, "node_id bigint, qualified_name string, embedding array<double>")


def function_sources(asked: DataFrame, rows: DataFrame, files: DataFrame) -> DataFrame:
    """Id, qualified_name, text of asked (id, path, name, line): a function's source in a file.

    ``name`` is a simple name or its class and name with a dot. ``line`` picks the one that begins there; without it, or
    where none begins there, the first one counts. rows: those of ``extracted``. No such function: no row.
    """
    parts = F.split("qualified_name", "[.]")
    own = rows.filter("kind IN ('Function', 'Method')").select("path", "qualified_name", "start_line", "end_line", "kind", "name", F.array_join(F.slice(parts, -2, 2), ".").alias("long"))
    names = F.explode(F.when(F.col("kind") == "Method", F.array("name", "long")).otherwise(F.array("name"))).alias("name")
    known = own.select("path", "qualified_name", "start_line", "end_line", names)
    hit = asked.join(known, ["path", "name"]).withColumn("_far", F.coalesce(F.col("start_line") != F.col("line"), F.lit(True)))
    best = hit.groupBy("id", "path").agg(F.min(F.struct("_far", "start_line", "end_line", "qualified_name")).alias("b")).select("id", "path", "b.*")
    cut = F.array_join(F.slice(F.split("content", "\r\n|\r|\n"), F.col("start_line").cast("int"), (F.col("end_line") - F.col("start_line") + 1).cast("int")), "\n")
    return best.join(files.select("path", "content"), "path").select("id", "qualified_name", cut.alias("text"))


def replaced_first(content: Column, target: Column, replacement: Column) -> Column:
    """The content with the first occurrence of a block replaced; null if it has none or nothing would change."""
    at = F.instr(content, target)
    done = F.concat(F.left(content, at - 1), replacement, F.substr(content, at + F.length(target)))
    return F.when((at > 0) & (F.length(target) > 0) & (target != replacement), done)


@F.pandas_udf(StringType())
def unified_diff(before: pd.Series, after: pd.Series, path: pd.Series) -> pd.Series:
    """The unified diff of two texts, three lines around each change; null if either is null, empty if they are equal."""

    def one(a: str | None, b: str | None, name: str) -> str | None:
        if a is None or b is None:
            return None
        return "\n".join(difflib.unified_diff(a.splitlines(), b.splitlines(), f"a/{name}", f"b/{name}", lineterm=""))

    return pd.Series([one(*x) for x in zip(before, after, path, strict=True)], dtype=object)
