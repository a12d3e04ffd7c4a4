"""Imports, prototypes, use trees and modules of sources that ``scan`` and ``outline`` have read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.functions.names import js_path
from plexus.operators.outline import JS_FUNCTION, NAME

#: Global tables of Lua, fixed values.
LUA_TABLES = ("string", "math", "table", "os", "io", "debug", "package", "coroutine", "utf8", "bit32")
IMPORTS = ["module_qn", "lang", "local_name", "full_name", "is_wildcard"]


def _statements(rows: DataFrame, lang: str) -> DataFrame:
    return rows.filter((F.col("lang") == lang) & (F.col("kind") == "text"))


def _made(local: Column, full: Column, wild: Column | None = None) -> list[Column]:
    return ["module_qn", "lang", local.alias("local_name"), full.alias("full_name"), (F.lit(False) if wild is None else wild).alias("is_wildcard")]


def java_imports(rows: DataFrame) -> DataFrame:
    """The last part, or a star and the package; static imports likewise."""
    full = F.regexp_extract("code", r"^import\s+(?:static\s+)?([\w.]+?)(?:\.\*)?$", 1)
    wild = F.col("code").endswith(".*")
    own = _statements(rows, "java").filter("code RLIKE '^import\\\\s'").withColumn("_f", full).filter("_f != ''")
    return own.select(*_made(F.when(wild, F.concat(F.lit("*"), "_f")).otherwise(F.element_at(F.split("_f", "[.]"), -1)), F.col("_f"), wild))


def go_imports(rows: DataFrame) -> DataFrame:
    """The alias, or the last part of the path; a path keeps its slashes. A blank or dot alias counts as none."""
    spec = r'(?:([\w.]+)\s+)?"(\d+)"'
    own = _statements(rows, "go").filter("code RLIKE '^import\\\\b'")
    each = own.select("module_qn", "lang", "strings", F.explode(F.arrays_zip(F.regexp_extract_all("code", F.lit(spec), F.lit(1)).alias("alias"), F.regexp_extract_all("code", F.lit(spec), F.lit(2)).alias("at"))).alias("m"))
    path = F.get("strings", F.col("m.at").cast("int"))
    alias = F.col("m.alias")
    return each.select(*_made(F.when(alias.isin("", "_", ".", "import"), F.element_at(F.split(path, "/"), -1)).otherwise(alias), path))


def rust_imports(rows: DataFrame) -> DataFrame:
    """Every path of the use trees. The braces of a tree are blocks, so a leaf's path is the items of the blocks around it, from the outermost ``use`` inwards, and its own.

    ``as`` renames; a star is a wildcard of what stands before it; ``self`` names what stands before it.
    """
    rust = rows.filter("lang = 'rust'")
    starts = r"^(?:pub(?:\([^)]*\))?\s+)?use\s+"
    items = rust.filter("kind = 'block'").groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("id", F.when(F.col("code").rlike(starts), F.col("code")).otherwise(F.col("item")).alias("v")))).alias("_items"))
    text = rust.filter("kind = 'text'").join(items, "path", "left")
    around = F.filter(F.transform("ups", lambda i: F.element_at("_items", i)), lambda x: x.isNotNull())
    uses = F.transform(around, lambda x: x.rlike(starts))
    first = F.array_position(uses, True).cast("int")
    prefix = F.when(first > 0, F.regexp_replace(F.array_join(F.slice(around, first, F.size(around)), ""), starts, "")).otherwise("")
    held = text.select("module_qn", "lang", prefix.alias("_p"), F.when((first > 0) | F.col("code").rlike(starts), F.regexp_replace("code", starts, "")).alias("_c")).filter("_c IS NOT NULL")
    leaf = held.select("module_qn", "lang", "_p", F.explode(F.split("_c", ",")).alias("_l")).withColumn("_l", F.trim("_l")).filter("_l != '' AND NOT endswith(_l, '{}')")
    path, alias = F.regexp_extract("_l", r"^(.*?)(?:\s+as\s+\w+)?$", 1), F.regexp_extract("_l", r"\sas\s+(\w+)$", 1)
    whole = leaf.select("module_qn", "lang", F.regexp_replace(F.concat("_p", path), r"\s|^::", "").alias("_w"), alias.alias("_a"))
    base = F.regexp_replace("_w", r"::(?:\*|self)$", "")
    wild = F.col("_w").endswith("*")
    last = F.element_at(F.split("_w", "::"), -1)
    return whole.select(*_made(F.when(F.col("_a") != "", F.col("_a")).when(wild, F.concat(F.lit("*"), base)).otherwise(last), base, wild))


def cpp_imports(rows: DataFrame, project: str) -> DataFrame:
    """Includes and module units. A header without its suffix names a project's own file, or a system's under ``std.``; module names and partitions (with their colon) are the project's."""
    own = _statements(rows, "cpp").filter("size(holds) = 0")
    include = F.regexp_extract("code", r"^\s*#\s*include\s*([<\"][^>\"]+)", 1)
    inc = own.withColumn("_i", include).filter("_i != ''").withColumn("_f", F.expr("substring(_i, 2)"))
    header = F.element_at(F.split("_f", "/"), -1)
    inside = F.concat(F.lit(f"{project}."), F.regexp_replace(F.replace("_f", F.lit("/"), F.lit(".")), r"\.(?:hpp|h)$", ""))
    system = F.when(F.col("_f").startswith("std"), F.col("_f")).otherwise(F.concat(F.lit("std."), "_f"))
    included = inc.select(*_made(F.regexp_replace(header, r"\.(?:hpp|h)$", ""), F.when(F.col("_i").startswith("<"), system).otherwise(inside)))
    unit = F.regexp_extract("code", rf"^(?:export\s+)?(?:import|module)\s+([\w.]*(?::[\w.]+)?|<[\w./]+>)$", 1)
    named = own.withColumn("_u", F.regexp_replace(unit, r"[<>]", "")).filter("_u != '' AND _u != ':private'").withColumn("_std", unit.startswith("<"))
    part = F.regexp_extract("_u", r":([\w.]+)$", 1)
    full = F.when(F.col("_std"), F.concat(F.lit("std."), "_u")).otherwise(F.concat(F.lit(f"{project}."), F.when(F.col("_u").startswith(":"), part).otherwise(F.replace("_u", F.lit(":"), F.lit(".")))))
    return included.union(named.select(*_made(F.col("_u"), full)))


def lua_imports(rows: DataFrame, project: str, modules: DataFrame) -> DataFrame:
    """Required modules under the name that they are assigned to (the second one of a protected call), else their last part; global tables that are called name themselves.

    modules (module_qn): names that are the project's get it before them; paths from ./ or ../ are resolved.
    """
    own = _statements(rows, "lua")
    call = r'\brequire\s*(?:\(\s*)?"(\d+)"|\bpcall\s*\(\s*require\s*,\s*"(\d+)"'
    at = F.when(F.regexp_extract("code", call, 1) != "", F.regexp_extract("code", call, 1)).otherwise(F.regexp_extract("code", call, 2))
    req = own.withColumn("_at", at).filter("_at != ''").withColumn("_p", F.get("strings", F.col("_at").cast("int")))
    single, second = F.regexp_extract("code", rf"^(?:local\s+)?({NAME})\s*=\s*require\b", 1), F.regexp_extract("code", rf"^(?:local\s+)?{NAME}\s*,\s*({NAME})\s*=\s*pcall\b", 1)
    dotted = F.replace("_p", F.lit("/"), F.lit("."))
    near = F.col("_p").rlike(r"^\.\.?/")
    found = req.withColumn("_q", F.when(near, js_path(F.col("_p"), F.col("module_qn"))).otherwise(F.concat(F.lit(f"{project}."), dotted)))
    known = found.join(modules.select(F.col("module_qn").alias("_q")).distinct().withColumn("_known", F.lit(True)), "_q", "left")
    local = F.when(single != "", single).when(second != "", second).otherwise(F.element_at(F.split(dotted, "[.]"), -1))
    required = known.select(*_made(local, F.when(near | F.col("_known"), F.col("_q")).otherwise(dotted)))
    tables = own.select("module_qn", "lang", F.explode(F.regexp_extract_all("code", F.lit(rf"(?<![\w.:])({'|'.join(LUA_TABLES)})[.:]\w+\s*[(\"]"), F.lit(1))).alias("_t"))
    return required.union(tables.select(*_made(F.col("_t"), F.col("_t"))))


def imports(rows: DataFrame, project: str, modules: DataFrame) -> DataFrame:
    """module_qn, lang, local_name, full_name, is_wildcard of Java, Go, Rust, C++ and Lua; equal rows appear once."""
    return java_imports(rows).union(go_imports(rows)).union(rust_imports(rows)).union(cpp_imports(rows, project)).union(lua_imports(rows, project, modules)).distinct()


# Prototypes --------------------------------------------------------------------------------------------------------------


def prototype_links(rows: DataFrame) -> DataFrame:
    """Child, parent: constructors whose prototype is made of another's, in the same module."""
    own = _statements(rows, "javascript")
    name = r"([\w$]+)"
    ways = (
        rf"^{name}\.prototype\s*=\s*Object\.create\(\s*{name}\.prototype\b", rf"^{name}\.prototype\s*=\s*new\s+{name}\s*\(", rf"^Object\.setPrototypeOf\(\s*{name}\.prototype\s*,\s*{name}\.prototype\s*\)",
        rf"^{name}\.prototype\.__proto__\s*=\s*{name}\.prototype$", rf"^(?:[\w$]+\.)?inherits\(\s*{name}\s*,\s*{name}\s*\)",
    )
    pair = F.filter(F.array(*[F.when(F.col("code").rlike(w), F.struct(F.regexp_extract("code", w, 1).alias("child"), F.regexp_extract("code", w, 2).alias("parent"))) for w in ways]), lambda x: x.isNotNull())
    found = own.select("module_qn", F.inline(pair))
    at = lambda c: F.concat_ws(".", "module_qn", c).alias(c)
    return found.select(at("child"), at("parent")).distinct()


def prototype_functions(rows: DataFrame, defined: DataFrame) -> DataFrame:
    """Way, qualified_name, name, parent_qn, start_line, end_line of functions outside of classes that are assigned to something.

    way: prototype, object, member or variable. A name that stands for a prototype (``const p = A.prototype``) is replaced
    by what it stands for, by a join; of several such names the last one before the function counts.
    defined: the ``definitions`` of ``rows``.
    """
    alias = rf"^(?:const|let|var)\s+({NAME})\s*=\s*([\w$.]+)\.prototype$"
    stands = _statements(rows, "javascript").filter(F.col("code").rlike(alias)).select("path", F.regexp_extract("code", alias, 1).alias("_a"), F.regexp_extract("code", alias, 2).alias("_of"), F.col("start_line").alias("_from"))
    own = rows.filter("lang = 'javascript' AND label IN ('Function', 'Prototype', 'Assigned') AND name != ''")
    member = F.regexp_extract("code", rf"(?:^|[\s(,;])((?:{NAME}\.)+){NAME}\s*=\s*{JS_FUNCTION}", 1)
    way = F.when(F.col("label") == "Prototype", "prototype").when(F.col("label") == "Assigned", "member").when(F.col("inside") == "Object", "object").when(F.col("code").rlike(rf"=\s*{JS_FUNCTION}"), "variable")
    marked = own.select("path", "start_line", "end_line", "col", "id", F.col("kind").alias("_kind"), way.alias("way"), F.regexp_replace(member, r"\.$", "").alias("_m"))
    found = defined.filter("lang = 'javascript'").select("path", "start_line", "end_line", "id", F.col("kind").alias("_kind"), "module_qn", "qualified_name", "name", "parent_qn")
    # Statements have no id of their own, so two functions without blocks in one line are told apart by their name too.
    both = marked.filter("way IS NOT NULL").distinct().join(found, ["path", "start_line", "end_line", "id", "_kind"])
    named = both.join(stands.withColumnRenamed("_a", "_m"), ["path", "_m"], "left").filter("_from IS NULL OR _from <= start_line")
    last = named.groupBy("way", "module_qn", "qualified_name", "name", "parent_qn", "start_line", "end_line", "_m").agg(F.max(F.struct("_from", "_of"))["_of"].alias("_of"))
    through = F.col("_of").isNotNull()
    parent = F.when(through, F.concat_ws(".", "module_qn", "_of")).otherwise(F.col("parent_qn"))
    return last.select(F.when(through, "prototype").otherwise(F.col("way")).alias("way"), F.when(through, F.concat_ws(".", parent, "name")).otherwise(F.col("qualified_name")).alias("qualified_name"), "name", parent.alias("parent_qn"), "start_line", "end_line")


def exported_functions(rows: DataFrame, defined: DataFrame) -> DataFrame:
    """module_qn, qualified_name, name, kind (commonjs or es6) of JavaScript functions that are exported where they are defined, at any depth of blocks."""
    own = rows.filter("lang = 'javascript' AND label IN ('Function', 'Assigned') AND name != ''")
    kind = F.when(F.col("code").rlike(r"^export\b"), "es6").when(F.col("code").rlike(r"^(?:module\.)?exports\.[\w$]+\s*="), "commonjs")
    marked = own.select("path", "start_line", "end_line", "id", F.col("kind").alias("_kind"), "code", kind.alias("way")).filter("way IS NOT NULL")
    found = defined.filter("lang = 'javascript'").select("path", "start_line", "end_line", "id", F.col("kind").alias("_kind"), "code", "module_qn", "qualified_name", "name")
    return marked.join(found, ["path", "start_line", "end_line", "id", "_kind", "code"]).select("module_qn", "qualified_name", "name", F.col("way").alias("kind")).distinct()


# C++ modules -------------------------------------------------------------------------------------------------------------


def module_units(rows: DataFrame, project: str) -> DataFrame:
    """module_qn, path, label (ModuleInterface or ModuleImplementation), qualified_name, name, partition of module units.

    The global fragment (``module;``) and the private one are no units; partitions are named after their module.
    """
    unit = r"^(export\s+)?module\s+([\w.]+)(?::([\w.]+))?$"
    own = _statements(rows, "cpp").filter(F.col("code").rlike(unit) & (F.col("parent") == 0))
    exported, name, part = (F.regexp_extract("code", unit, i) for i in (1, 2, 3))
    whole = F.concat_ws(".", name, F.when(part != "", part))
    label = F.when(exported != "", "ModuleInterface").otherwise("ModuleImplementation")
    shown = F.when(exported != "", whole).otherwise(F.concat(whole, F.lit("_impl")))
    return own.select("module_qn", "path", label.alias("label"), F.concat(F.lit(f"{project}."), shown).alias("qualified_name"), shown.alias("name"), whole.alias("unit"), F.when(part != "", part).alias("partition"))


def module_edges(units: DataFrame) -> DataFrame:
    """Src, type, dst: EXPORTS_MODULE and IMPLEMENTS_MODULE from files, IMPLEMENTS from an implementation to the interface of its name, where there is one, in whatever file."""
    interface = units.filter("label = 'ModuleInterface'")
    from_files = units.select(F.col("module_qn").alias("src"), F.when(F.col("label") == "ModuleInterface", "EXPORTS_MODULE").otherwise("IMPLEMENTS_MODULE").alias("type"), F.col("qualified_name").alias("dst"))
    known = interface.select("unit", F.col("qualified_name").alias("dst")).distinct()
    joined = units.filter("label = 'ModuleImplementation'").join(known, "unit").select(F.col("qualified_name").alias("src"), F.lit("IMPLEMENTS").alias("type"), "dst")
    return from_files.union(joined).distinct()


def exported(rows: DataFrame, defined: DataFrame) -> DataFrame:
    """module_qn, label, qualified_name of C++ definitions that are exported, by themselves or by a block around them; members of exported types are not listed."""
    cpp = rows.filter("lang = 'cpp'")
    marks = cpp.filter("kind = 'block'").groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("id", F.col("code").rlike(r"^export\b").alias("v")))).alias("_marks"))
    own = cpp.filter("label IS NOT NULL AND inside NOT IN ('Class', 'Union', 'Enum')").join(marks, "path", "left")
    around = F.exists(F.transform("ups", lambda i: F.element_at("_marks", i)), lambda x: F.coalesce(x, F.lit(False)))
    shown = own.filter(F.col("code").rlike(r"^(?:template\s*<[^{}]*>\s*)?export\b") | around).select("path", "start_line", "id", F.col("kind").alias("_kind"), "code")
    found = defined.filter("lang = 'cpp'").select("path", "start_line", "id", F.col("kind").alias("_kind"), "code", "module_qn", "label", "qualified_name")
    return shown.join(found, ["path", "start_line", "id", "_kind", "code"]).select("module_qn", "label", "qualified_name").distinct()
