"""Types of local variables, attributes, returns and receivers of Python sources, and the methods that typed calls reach.

Every expression of a source becomes rows that name where its value lives, so chained calls and aliases are joins.
"""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.functions.names import path_to_module
from plexus.operators.extract import AT_ONCE, BLOCKS, SCOPES, dotted, found_under
from plexus.operators.resolve import class_names, lattice
from plexus.plans.graph import met, spread, stored

#: how: type (var is of the annotated ``what``), alias (var is the value at ``what``), call (var is what a call gives).
SCHEMA = "path string, module_qn string, seq bigint, how string, at string, var string, frm string, what string, recv string, name string, cls string, line bigint"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Rows of definitions, imports and errors, in which ``how`` is null, and of bindings, in which ``kind`` is.
DEFINED = ["path", "module_qn", "kind", "qualified_name", "name", "parent", "bases", "full_name", "is_wildcard"]
BOTH = "kind string, qualified_name string, parent string, bases array<string>, full_name string, is_wildcard boolean, " + SCHEMA
ARROW = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
RETURN = "<return>"
#: Rounds of inference at most; a variable gets its type once, so recursion ends by itself.
ROUNDS = 64


class _Scope:
    """Rows of one function or module body: ``at`` is its qualified name, ``cls`` the class around a method."""

    def __init__(self, module: str, at: str, cls: str | None, out: list[dict]):
        self.module, self.at, self.cls, self.out = module, at, cls, out

    def place(self, name: str) -> tuple[str, str]:
        """Attributes of self live in the class, other names in the scope."""
        return (self.cls, name) if self.cls and name.startswith("self.") else (self.at, name)

    def row(self, how: str, var: str, **more) -> None:
        at, var = self.place(var)
        self.out.append({"seq": len(self.out), "how": how, "at": at, "var": var, "cls": self.cls, **more})

    def value(self, node: ast.expr | None) -> str | None:
        """Where the value of an expression lives; rows of the calls in it are added on the way."""
        if isinstance(node, ast.Call):
            for x in [*node.args, *[k.value for k in node.keywords]]:
                self.value(x)
            f, name = node.func, dotted(node.func)
            recv = self.value(f.value) if isinstance(f, ast.Attribute) else None
            plain = name if isinstance(f, ast.Name) or isinstance(f, ast.Attribute) and _is_chain(f) else None
            var = "super()" if name == "super" and isinstance(f, ast.Name) else f"%{len(self.out)}"
            if name:
                self.row("call", var, frm=self.place(recv)[0] if recv else None, recv=recv, what=plain, name=name.rsplit(".", 1)[-1], line=node.lineno)
            return var
        if isinstance(node, ast.Name):
            return node.id
        if isinstance(node, ast.Attribute):
            if _is_chain(node):
                return dotted(node)
            self.value(node.value)
            return None
        if isinstance(node, ast.Await | ast.NamedExpr):
            got = self.value(node.value)
            if isinstance(node, ast.NamedExpr) and got:
                self.alias(node.target, got)
            return got
        if isinstance(node, ast.List | ast.Tuple | ast.Set) and node.elts:
            return [self.value(x) for x in node.elts][0]  # a loop over it gives values like its first one
        for x in ast.iter_child_nodes(node) if node is not None else ():
            if isinstance(x, ast.expr) and not isinstance(node, ast.Lambda):
                self.value(x)
        return None

    def alias(self, target: ast.expr, got: str | None) -> None:
        name = dotted(target) if isinstance(target, ast.Name) or isinstance(target, ast.Attribute) and _is_chain(target) else None
        if name and got:
            self.row("alias", name, frm=self.place(got)[0], what=self.place(got)[1])

    def typed(self, name: str, note: ast.expr | None) -> None:
        if isinstance(note, ast.Constant) and isinstance(note.value, str):
            try:
                note = ast.parse(note.value, mode="eval").body
            except SyntaxError:
                return
        if isinstance(note, ast.BinOp) and isinstance(note.op, ast.BitOr):  # X | None
            note = note.left
        if isinstance(note, ast.Subscript) and dotted(note.value) in ("Optional", "typing.Optional"):
            note = note.slice
        if isinstance(note, ast.Name | ast.Attribute) and (kind := dotted(note)):
            self.row("type", name, what=kind)


def _is_chain(node: ast.expr) -> bool:
    while isinstance(node, ast.Attribute):
        node = node.value
    return isinstance(node, ast.Name)


def bound_in(module: str, content: str) -> list[dict]:
    """Rows of one source in its order, without decorators and defaults; one that does not parse or nests too deeply has none."""
    try:
        return _bound(module, ast.parse(content))
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return []


def _bound(module: str, tree: ast.Module) -> list[dict]:
    out: list[dict] = []
    top = _Scope(module, module, None, out)
    todo = [(n, top) for n in reversed(tree.body)]
    while todo:
        node, s = todo.pop()
        if isinstance(node, SCOPES):
            inner = _Scope(module, f"{s.at}.{node.name}", None, out)
            if isinstance(node, ast.ClassDef):
                inner.in_class = inner.at
            else:
                inner.cls = getattr(s, "in_class", None) or s.cls
                for a in [*node.args.posonlyargs, *node.args.args, *node.args.kwonlyargs]:
                    inner.typed(a.arg, a.annotation)
                inner.typed(RETURN, node.returns)
            todo += [(n, inner) for n in reversed(node.body)]
            continue
        if isinstance(node, ast.Assign):
            got = s.value(node.value)
            for t in node.targets:
                s.alias(t, got)
        elif isinstance(node, ast.AnnAssign):
            if _is_chain(node.target) and (name := dotted(node.target)):
                s.typed(name, node.annotation)
                s.alias(node.target, s.value(node.value))
        elif isinstance(node, ast.Return):
            if got := s.value(node.value):
                s.row("alias", RETURN, frm=s.place(got)[0], what=s.place(got)[1])
        elif isinstance(node, ast.For | ast.AsyncFor):
            got = s.value(node.iter)
            if isinstance(node.iter, ast.List | ast.Tuple | ast.Set):
                s.alias(node.target, got)
        else:
            for x in ast.iter_child_nodes(node):
                if isinstance(x, ast.expr):
                    s.value(x)
        todo += [(n, s) for n in reversed([x for b in BLOCKS for x in getattr(node, b, ())])]
        for item in getattr(node, "items", ()):  # with
            if isinstance(item, ast.withitem):
                got = s.value(item.context_expr)
                if item.optional_vars is not None:
                    s.alias(item.optional_vars, got)
    return out


def bindings(files: DataFrame, project: str) -> DataFrame:
    """Rows of ``SCHEMA`` for files (path, content); null contents and other suffixes have none."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            rows: list[list] = []
            for path, module, content in part.itertuples(index=False):
                rows += [[{"path": path, "module_qn": module, **r}.get(k) for k in COLUMNS] for r in bound_in(module, content)]
                if len(rows) >= AT_ONCE:
                    yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)

    own = files.filter(F.col("path").endswith(".py") & F.col("content").isNotNull())
    return spread(own.select("path", F.concat(F.lit(project + "."), path_to_module(F.col("path"))).alias("module_qn"), "content")).mapInPandas(run, SCHEMA)


def both_in(module: str, content: str) -> list[dict]:
    """Definitions, imports and bindings of one source, of one parse; one that does not parse has an error row."""
    try:
        tree = ast.parse(content)
    except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
        return [{"kind": "error", "name": type(e).__name__}]
    rows = found_under(module, tree, calls=False)
    try:
        return rows + _bound(module, tree)
    except RecursionError:
        return rows


def parsed(files: DataFrame, project: str) -> tuple[DataFrame, DataFrame]:
    """The columns ``DEFINED`` of ``extracted``, without calls, and ``bindings`` of files (path, content), each parsed once and stored."""
    fields = [c.split() for c in BOTH.split(", ")]
    schema = pa.schema([(name, ARROW[kind]) for name, kind in fields])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in it:
            rows: list[dict] = []
            for path, module, content in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True):
                rows += [{"path": path, "module_qn": module, **r} for r in both_in(module, content)]
                if len(rows) >= AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)

    own = files.filter(F.col("path").endswith(".py") & F.col("content").isNotNull())
    both = stored(spread(own.select("path", F.concat(F.lit(project + "."), path_to_module(F.col("path"))).alias("module_qn"), "content")).mapInArrow(run, BOTH))
    return both.filter("kind IS NOT NULL").select(DEFINED), both.filter("how IS NOT NULL").select(COLUMNS)


def inferred(rows: DataFrame, imports: DataFrame, defined: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """E10, E14 and typed steps of E12: (at, var, cls of what has a type; path, seq, at, line, name, callee of calls).

    rows: ``bindings``; imports: module_qn, local_name, full_name; defined: kind, qualified_name, name, parent, bases,
    module_qn of ``extracted``. Each round types what the types of the one before reach: aliases, calls of functions and
    methods whose return has a type, own or inherited, and those on ``super()``. Of several types of a variable the first
    round's counts, then the first in the source. Inference ends when nothing is new, or after ``rounds``. Every input is
    read many times, so give stored ones. Each round stores its calls and types in the shared folder.
    """
    classes = defined.filter("kind = 'Class'")
    registry = stored(classes.select("qualified_name"))
    methods = defined.filter("kind = 'Method'").select(F.col("parent").alias("above"), "name", F.col("qualified_name").alias("method")).distinct()
    bases = classes.select(F.col("qualified_name").alias("child"), "module_qn", F.posexplode("bases").alias("ord", "class_name"))
    named = bases.select(F.struct("child", "ord").alias("id"), "class_name", "module_qn").union(rows.filter("how IN ('type', 'call') AND what IS NOT NULL").select(F.struct(F.concat(F.lit("file "), "path").alias("child"), F.col("seq").cast("int").alias("ord")), F.col("what").alias("class_name"), "module_qn"))
    # What follows an imported name's first dot is under what the name stands for.
    dots = named.filter("contains(class_name, '.')").withColumn("head", F.substring_index("class_name", ".", 1))
    direct = met(dots, imports.select("module_qn", F.col("local_name").alias("head"), "full_name"), ["module_qn", "head"]).select("id", F.concat("full_name", F.expr("substring(class_name, length(head) + 1)")).alias("class_qn"))
    found = class_names(named, imports, registry).select("id", "class_qn").union(direct.filter("class_qn IS NOT NULL"))
    found = met(found, registry.select(F.col("qualified_name").alias("class_qn")), ["class_qn"], "left_semi")
    found = stored(found.groupBy(F.xxhash64("id"), "id").agg(F.min("class_qn").alias("class_qn")).select("id", "class_qn"))
    inherits = met(found.select(F.col("id.child").alias("child"), F.col("class_qn").alias("parent"), F.col("id.ord").alias("ord")), registry.select(F.col("qualified_name").alias("child")), ["child"], "left_semi")
    by_name = met(rows, found.filter("startswith(id.child, 'file ')").select(F.expr("substring(id.child, 6)").alias("path"), F.col("id.ord").cast("bigint").alias("seq"), "class_qn"), ["path", "seq"])
    first = lambda df: stored(df.filter("at IS NOT NULL AND var IS NOT NULL").groupBy(F.xxhash64("at", "var"), "at", "var").agg(F.min_by("cls", "seq").alias("cls")).select("at", "var", "cls"))
    own = rows.filter("cls IS NOT NULL").select("at", F.lit("self").alias("var"), "cls", F.lit(-1).cast("bigint").alias("seq")).filter("at != cls")
    known = first(by_name.select("at", "var", F.col("class_qn").alias("cls"), "seq").union(own))
    call = ["path", "seq", "at", "var", "line", "name", "callee"]
    calls = rows.filter("how = 'call'")
    # Functions by an imported name or one of the same module.
    local = calls.filter("what IS NOT NULL").select("module_qn", "what", "path", "seq", "at", "var", "line", "name")
    qn = met(local, imports.select("module_qn", F.col("local_name").alias("what"), "full_name"), ["module_qn", "what"], "left").withColumn("callee", F.coalesce("full_name", F.concat_ws(".", "module_qn", "what")))
    plain = met(qn.select(call), defined.filter("kind = 'Function'").select(F.col("qualified_name").alias("callee")), ["callee"], "left_semi").select(call)
    # Every class with the methods that it has or inherits, nearest first, parents in order, and the nearest of those above: found once for all rounds.
    edges = inherits.select(F.col("child").alias("cls"), "parent", F.lit("INHERITS").alias("type"), "ord")
    up = met(lattice(edges, registry.select(F.col("qualified_name").alias("cls"))), methods, ["above"])
    near = F.struct("level", "place", "method")
    nearest = stored(up.groupBy(F.xxhash64("cls", "name"), "cls", "name").agg(F.min(near)["method"].alias("callee"), F.min(F.when(F.col("level") > 0, near))["method"].alias("super")).select("cls", "name", "callee", "super"))
    own_or_above, only_above = nearest.select("cls", "name", "callee"), nearest.filter("super IS NOT NULL").select("cls", "name", F.col("super").alias("callee"))
    reached = stored(plain.union(met(calls.filter("recv = 'super()' AND cls IS NOT NULL").drop("callee"), only_above, ["cls", "name"]).select(call)))
    on_object = stored(calls.filter("recv IS NOT NULL AND recv != 'super()'").select("frm", "recv", "path", "seq", "at", "var", "line", "name"))
    # A call gives what its callee returns, as an alias of it would.
    given = lambda df: df.select(F.col("callee").alias("frm"), F.lit(RETURN).alias("what"), "at", "var", "seq")
    flows = stored(rows.filter("how = 'alias'").select("frm", "what", "at", "var", "seq").union(given(reached)))
    fresh = known
    at_place = lambda df, name: df.select(F.col("at").alias("frm"), F.col("var").alias(name), "cls")
    for _ in range(rounds):
        hit = stored(met(met(on_object, at_place(fresh, "recv"), ["frm", "recv"]), own_or_above, ["cls", "name"]).select(call))
        # What a round can add comes from new calls or from new types; the rest was met before.
        of_new = met(given(hit), at_place(known.filter(F.col("var") == RETURN), "what"), ["frm", "what"])
        of_old = met(flows, at_place(fresh, "what"), ["frm", "what"])
        reached, flows = reached.union(hit), flows.union(given(hit))
        fresh = first(met(of_new.union(of_old).select("at", "var", "cls", "seq"), known.select("at", "var"), ["at", "var"], "left_anti"))
        if fresh.isEmpty():
            break
        known = known.union(fresh)
    return known, reached
