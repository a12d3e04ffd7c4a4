"""Imports and exported functions of JavaScript and TypeScript sources, with patterns that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.functions.names import js_path, path_to_module

SUFFIXES = (".js", ".jsx", ".mjs", ".cjs", ".ts", ".tsx")
NAME = r"[A-Za-z_$][\w$]*"
#: Strings are matched too, so that two slashes inside one begin no comment.
STRING_OR_COMMENT = r"""("(?:[^"\\\n]++|\\.)*+"|'(?:[^'\\\n]++|\\.)*+'|`(?:[^`\\]++|\\[\s\S])*+`)|//[^\n]*|/\*[\s\S]*?\*/"""
FROM = r"""(?m)^[ \t]*+(import|export)\b\s*+(?:type\s+)?+([^'"`;=()]*?)\s*\bfrom\s*['"]([^'"\n]+)['"]"""
REQUIRE = rf"""\b(?:const|let|var)\s+({NAME})\s*=\s*require\s*\(\s*['"]([^'"\n]+)['"]"""
FUNCTION = rf"""(?:async\s+)?(?:function\b|\([^()]*(?:\([^()]*\)[^()]*)*\)\s*(?::[^=\n]*)?=>|{NAME}\s*=>)"""
#: Only statements at the line's start are outside functions.
EXPORTS = (
    ("commonjs", rf"(?m)^(?:module\.)?exports\.({NAME})\s*=\s*{FUNCTION}"),
    ("es6", rf"(?m)^export\s+(?:const|let|var)\s+({NAME})\s*(?::[^=\n]*)?=\s*{FUNCTION}"),
    ("es6", rf"(?m)^export\s+(?:default\s+)?(?:async\s+)?function\s*\*?\s*({NAME})"),
)


def _sources(files: DataFrame, project: str) -> DataFrame:
    """module_qn, code without comments; null contents and other suffixes have no row."""
    lower = F.lower("path")
    own = files.filter(F.col("content").isNotNull() & F.regexp_like(lower, F.lit(r"\.(" + "|".join(s[1:] for s in SUFFIXES) + ")$")))
    return own.select(F.concat(F.lit(project + "."), path_to_module(F.col("path"))).alias("module_qn"), F.regexp_replace("content", STRING_OR_COMMENT, "$1").alias("code"))


def _found(code: Column, pattern: str, *groups: int) -> Column:
    """An array of a struct for each match; its fields are the groups."""
    return F.arrays_zip(*[F.regexp_extract_all(code, F.lit(pattern), F.lit(g)).alias(f"g{g}") for g in groups])


def imports(files: DataFrame, project: str) -> DataFrame:
    """module_qn, local_name, full_name, is_wildcard of files (path, content).

    A default import is the module's ``default``, a namespace or a required module is the module itself, a re-export of
    everything is a wildcard. Imports for their effects only bind no name. Equal rows appear once.
    """
    src = _sources(files, project)
    each = src.select("module_qn", F.explode(_found(F.col("code"), FROM, 1, 2, 3)).alias("m"))
    each = each.select("module_qn", F.col("m.g1").alias("word"), F.col("m.g2").alias("clause"), js_path(F.col("m.g3"), F.col("module_qn")).alias("source"))
    clause, source, imported = F.col("clause"), F.col("source"), F.col("word") == "import"
    default, space, inside = F.regexp_extract(clause, rf"^({NAME})", 1), F.regexp_extract(clause, rf"\*\s*as\s+({NAME})", 1), F.regexp_extract(clause, r"\{([^}]*)\}", 1)
    row = lambda local, full, wild=False: F.struct(local.alias("local_name"), full.alias("full_name"), F.lit(wild).alias("is_wildcard"))
    pair = lambda x: F.split(F.regexp_replace(F.trim(F.regexp_replace(x, r"\s+", " ")), "^type ", ""), " as ")
    named = F.transform(F.filter(F.split(inside, ","), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")) != ""), lambda x: row(F.element_at(pair(x), -1), F.concat(source, F.lit("."), pair(x)[0])))
    single = F.array(
        F.when(imported & (default != ""), row(default, F.concat(source, F.lit(".default")))), F.when(space != "", row(space, source)),
        F.when(~imported & (F.trim(clause) == "*"), row(F.concat(F.lit("*"), source), source, True)),
    )
    from_rows = each.select("module_qn", F.inline(F.filter(F.concat(named, single), lambda x: x.isNotNull())))
    required = src.select("module_qn", F.explode(_found(F.col("code"), REQUIRE, 1, 2)).alias("m"))
    required = required.select("module_qn", F.col("m.g1").alias("local_name"), js_path(F.col("m.g2"), F.col("module_qn")).alias("full_name"), F.lit(False).alias("is_wildcard"))
    return from_rows.union(required).distinct()


def exported_functions(files: DataFrame, project: str) -> DataFrame:
    """module_qn, qualified_name, name, kind (commonjs or es6) of functions that statements at a line's start export."""
    src = _sources(files, project)
    marked = lambda kind: lambda x: F.struct(x.alias("name"), F.lit(kind).alias("kind"))
    names = F.flatten(F.array(*[F.transform(F.regexp_extract_all("code", F.lit(p), F.lit(1)), marked(kind)) for kind, p in EXPORTS]))
    return src.select("module_qn", F.inline(names)).select("module_qn", F.concat_ws(".", "module_qn", "name").alias("qualified_name"), "name", "kind").distinct()
