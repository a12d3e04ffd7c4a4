"""The module that an imported name lies in (E09), by joins with what is known; nothing is run to find out."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Modules of the languages' own libraries that a program finds without installing them, fixed values. Python's top ones are asked from the interpreter.
MODULES = {
    "javascript": "assert buffer child_process cluster console crypto dgram dns events fs http http2 https net os path perf_hooks process querystring readline stream string_decoder timers tls tty url util v8 vm worker_threads zlib".split(),
    "go": "bufio bytes context crypto database/sql encoding/json encoding/xml errors flag fmt html/template io io/ioutil log math math/rand net net/http net/url os os/exec path path/filepath reflect regexp runtime sort strconv strings sync sync/atomic testing time unicode".split(),
    "rust": "std std::collections std::env std::fs std::io std::fmt std::net std::path std::process std::rc std::sync std::thread std::time core alloc".split(),
    "java": "java.io java.lang java.math java.net java.nio java.nio.file java.time java.util java.util.concurrent java.util.function java.util.regex java.util.stream".split(),
    "python": "os.path collections.abc concurrent.futures importlib.util urllib.parse urllib.request xml.etree.ElementTree".split(),
    "lua": "string math table os io debug package coroutine utf8".split(),
}
#: Names of the C++ library that begin with a small letter, fixed values.
CPP_NAMES = ("vector", "string", "map", "set", "list", "deque", "unique_ptr", "shared_ptr", "weak_ptr", "thread", "mutex", "condition_variable", "future", "promise", "sort", "find", "copy", "transform", "accumulate")


def known_modules(spark: SparkSession) -> DataFrame:
    """lang, module of ``MODULES``."""
    rows = [(lang, m) for lang, own in MODULES.items() for m in own] + [("python", m) for m in sorted(sys.stdlib_module_names)]
    return spark.createDataFrame(rows, "lang string, module string")


def separator(lang: Column) -> Column:
    return F.when(lang == "go", "/").when(lang.isin("rust", "cpp"), "::").otherwise(".")


def module_paths(names: DataFrame, registry: DataFrame, modules: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """lang, full_name, module_path, way of each distinct name (lang, full_name); null names have no row.

    Ways, first that holds: ``stored`` an earlier result (lang, full_name, module_path), which is read before anything is
    computed; ``registry`` a class, function or method (qualified_name, label) without its last part; ``single`` a name of
    one part is its own module; ``module`` the longest module (lang, module) that the name begins with, by an equi-join on
    the name's prefixes; ``name`` the language's rule for the last part, which drops it where it looks like an entity;
    else ``unchanged``.
    """
    every = names.filter("full_name IS NOT NULL").select("lang", "full_name").distinct()
    done = None
    if stored is not None:
        done = every.join(stored.groupBy("lang", "full_name").agg(F.min("module_path").alias("module_path")), ["lang", "full_name"]).withColumn("way", F.lit("stored"))
        every = every.join(done.select("lang", "full_name"), ["lang", "full_name"], "left_anti")
    sep, name = separator(F.col("lang")), F.col("full_name")
    parts = F.filter(F.split(F.when(F.col("lang") == "go", F.replace(name, F.lit("/"), F.lit("\x01"))).when(F.col("lang").isin("rust", "cpp"), F.replace(name, F.lit("::"), F.lit("\x01"))).otherwise(F.replace(name, F.lit("."), F.lit("\x01"))), "\x01"), lambda x: x != "")
    work = every.withColumn("_parts", parts).withColumn("_sep", sep)
    upto = lambda n: F.array_join(F.slice("_parts", F.lit(1), n), "\x01")
    joined = lambda n: F.replace(upto(n), F.lit("\x01"), F.col("_sep"))
    dropped = joined(F.greatest(F.size("_parts") - 1, F.lit(0)))
    prefixes = F.explode(F.transform(F.sequence(F.lit(1), F.size("_parts")), lambda i: F.struct(i.alias("n"), joined(i).alias("module"))))
    longest = work.filter(F.size("_parts") > 0).select("lang", "full_name", "_sep", prefixes.alias("p")).select("lang", "full_name", "p.n", "p.module").join(modules.select("lang", "module").distinct(), ["lang", "module"])
    longest = longest.groupBy("lang", "full_name").agg(F.max(F.struct("n", "module"))["module"].alias("_module"))
    held = registry.filter(F.col("label").isin("Class", "Function", "Method")).select(F.col("qualified_name").alias("full_name"), F.lit(True).alias("_held")).distinct()
    met = work.join(held, "full_name", "left").join(longest, ["lang", "full_name"], "left")
    last = F.element_at("_parts", -1)
    upper = last.rlike(r"^\p{Lu}")
    entity = (
        F.when(F.col("lang") == "rust", upper | (last.rlike(r"^[^A-Z_]+$") & last.rlike("[a-z]")))
        .when(F.col("lang") == "cpp", (F.col("_parts")[0] == "std") & (upper | last.startswith("is_") | last.startswith("has_") | last.isin(*CPP_NAMES)))
        .when(F.col("lang") == "lua", upper | last.isin(*MODULES["lua"])).otherwise(upper)
    )
    way = (
        F.when(F.size("_parts") == 0, "unchanged").when(F.col("_held") & (F.size("_parts") > 1), "registry").when(F.size("_parts") == 1, "single").when(F.col("_module").isNotNull(), "module").when(entity, "name").otherwise("unchanged")
    )
    out = met.withColumn("way", way)
    path = F.when(F.col("way").isin("registry", "name"), dropped).when(F.col("way") == "module", F.col("_module")).otherwise(name)
    computed = out.select("lang", "full_name", path.alias("module_path"), "way")
    return computed if done is None else computed.unionByName(done)
