"""Methods that Java calls mean: types of receivers, the lattice of classes and interfaces, and the choice of an overload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.operators.outline import _NESTED, KEYWORDS, running
from plexus.operators.resolve import lattice
from plexus.plans.graph import durable

_TYPE = r"([A-Z][\w.]*)(?:<[\w\s,.<>?&]*>)?(?:\[\])*"


def _without(text: Column, pattern: str, times: int = 4) -> Column:
    for _ in range(times):
        text = F.regexp_replace(text, pattern, "")
    return text


def _named(rows: DataFrame) -> Column:
    return F.concat_ws(".", "module_qn", F.transform("scope", lambda x: x["name"]))


def declared(rows: DataFrame) -> DataFrame:
    """E10 for Java: module_qn, at, var, type of parameters, variables and fields; ``at`` is the method or class that holds them.

    ``var`` takes the type of the construction that it is assigned. Primitive types have no rows. rows: those of ``outlined``.
    """
    java = rows.filter("lang = 'java'")
    params = F.split(F.regexp_replace(_without(F.regexp_extract("code", rf"{_NESTED}\s*(?:throws [\w.,\s]+)?$", 0), r"<[^<>]*>"), r"^\(|\)\s*(?:throws.*)?$", ""), ",")
    heads = java.filter("label = 'Method' AND kind = 'block'").select("module_qn", F.concat_ws(".", _named(rows), "shown").alias("at"), F.explode(params).alias("_p"))
    heads = heads.select("module_qn", "at", F.regexp_extract("_p", r"(\w+)(?:\[\])*\s*$", 1).alias("var"), F.regexp_extract("_p", r"([A-Z][\w.]*?)(?:\[\]|\.\.\.)*\s+\w+(?:\[\])*\s*$", 1).alias("type"))
    text = running(java).filter("label IS NULL").select("module_qn", _named(rows).alias("at"), F.col("run").alias("code"))
    pairs = lambda p, a, b: F.arrays_zip(F.regexp_extract_all("code", F.lit(p), F.lit(a)).alias("type"), F.regexp_extract_all("code", F.lit(p), F.lit(b)).alias("var"))
    own = text.select("module_qn", "at", F.explode(F.concat(pairs(rf"(?<![\w.]){_TYPE}\s+([a-z_$][\w$]*)\s*(?=[=:,;)]|$)", 1, 2), pairs(r"\bvar\s+(\w+)\s*=\s*new\s+([\w.]+)", 2, 1))).alias("v"))
    return heads.union(own.select("module_qn", "at", "v.var", "v.type")).filter("var != '' AND type != '' AND type != 'var'").groupBy("module_qn", "at", "var").agg(F.min("type").alias("type"))


def method_calls(rows: DataFrame) -> DataFrame:
    """E11 for Java: id, module_qn, caller, cls, receiver (null: none), name, n_args, line of calls that are no constructions."""
    own = running(rows.filter("lang = 'java'")).filter("run != ' '")
    site = rf"(?<![\w.])(?<!new )((?:\w+\s*\.\s*)*)(\w+)\s*(?=({_NESTED}))"
    part = lambda i: F.regexp_extract_all("run", F.lit(site), F.lit(i))
    classes = F.filter("scope", lambda x: x["label"].isin("Class", "Interface", "Enum"))
    # The innermost class: the names up to it.
    at = F.size("scope") - F.array_position(F.reverse(F.transform("scope", lambda x: x["label"].isin("Class", "Interface", "Enum"))), True) + 1
    cls = F.when(F.size(classes) > 0, F.concat_ws(".", "module_qn", F.slice(F.transform("scope", lambda x: x["name"]), F.lit(1), at.cast("int"))))
    each = own.select("path", "module_qn", "caller", cls.alias("cls"), F.col("start_line").alias("line"), F.explode(F.arrays_zip(part(1).alias("receiver"), part(2).alias("name"), part(3).alias("args"))).alias("s"))
    args = _without(_without(F.expr("substring(s.args, 2, length(s.args) - 2)"), r"\([^()]*\)"), r"<[^<>]*>")
    n_args = F.when(F.trim(args) == "", 0).otherwise(F.size(F.split(args, ",")))
    receiver = F.regexp_replace("s.receiver", r"\s|\.\s*$", "")
    out = each.select("module_qn", "caller", "cls", F.when(receiver != "", receiver).alias("receiver"), F.col("s.name").alias("name"), n_args.alias("n_args"), "line")
    out = out.filter(~F.col("name").isin(*KEYWORDS, "this", "super") | F.col("receiver").isNotNull())
    return out.withColumn("id", F.xxhash64(*out.columns))


def class_of(uses: DataFrame, classes: DataFrame, imports: DataFrame) -> DataFrame:
    """id, cls of uses (id, module_qn, type) by the first way that finds one.

    Ways: 1 the import of that name, 2 the same file, 3 the same package, 4 a wildcard import, 5 a dotted name. An import
    finds the classes whose file's dotted path ends in it; of several the one that shares most of the module's path, then
    the shortest and least. classes: qualified_name, module_qn, name. imports: module_qn, local_name, full_name, is_wildcard.
    """
    parts = lambda c: F.split(c, "[.]")
    simple = F.element_at(parts("type"), 1)
    ends = classes.select("qualified_name", "name", F.col("module_qn").alias("home"), F.explode(F.transform(F.sequence(F.lit(1), F.size(parts("module_qn"))), lambda i: F.array_join(F.slice(parts("module_qn"), i, F.size(parts("module_qn"))), "."))).alias("key"))
    u = uses.withColumn("simple", simple)
    named = u.join(imports.filter("NOT is_wildcard").select("module_qn", F.col("local_name").alias("simple"), F.col("full_name").alias("key")), ["module_qn", "simple"]).select("id", "module_qn", "type", "simple", "key", F.lit(1).alias("way"))
    stars = u.join(imports.filter("is_wildcard").select("module_qn", "full_name"), "module_qn").select("id", "module_qn", "type", "simple", F.concat_ws(".", "full_name", "simple").alias("key"), F.lit(4).alias("way"))
    dotted = u.filter("type LIKE '%.%'").select("id", "module_qn", "type", "simple", F.col("type").alias("key"), F.lit(5).alias("way"))
    last = F.element_at(parts("key"), -1)
    far = named.union(stars).union(dotted).join(ends, "key").filter(F.col("name") == last).select("id", "module_qn", "qualified_name", "home", "way")
    same = u.join(classes.select("module_qn", F.col("name").alias("simple"), "qualified_name"), ["module_qn", "simple"]).select("id", "module_qn", "qualified_name", F.col("module_qn").alias("home"), F.lit(2).alias("way"))
    package = lambda c: F.regexp_replace(c, r"\.[^.]*$", "")
    # In a package a file's class has the file's name.
    own = classes.filter(F.col("qualified_name") == F.concat_ws(".", "module_qn", "name")).select(package("module_qn").alias("_p"), F.col("name").alias("simple"), "qualified_name", F.col("module_qn").alias("home"))
    near = u.withColumn("_p", package("module_qn")).join(own, ["_p", "simple"]).select("id", "module_qn", "qualified_name", "home", F.lit(3).alias("way"))
    # Equal parts from the left.
    shared = F.size(F.filter(F.sequence(F.lit(1), F.size(parts("module_qn"))), lambda i: F.array_join(F.slice(parts("module_qn"), F.lit(1), i), ".") == F.array_join(F.slice(parts("home"), F.lit(1), i), ".")))
    every = far.union(same).union(near)
    return every.groupBy("id").agg(F.min(F.struct("way", (-shared).alias("s"), F.length("qualified_name").alias("n"), "qualified_name"))["qualified_name"].alias("cls"))


def resolved_methods(calls: DataFrame, defined: DataFrame, bases: DataFrame, imports: DataFrame, variables: DataFrame) -> DataFrame:
    """Id, callee, how of Java calls (``method_calls``).

    The receiver's type: a variable of the method, else a field of a class around it, else a class of that name; ``this``
    and no receiver mean the class around, ``super`` what is above it; a method without a receiver may be a static import
    too. Among the methods of that name above a type, those that take as many arguments come first, then the type's own,
    its superclasses', its interfaces' in order, and of what is left the least name.

    how: own, inherited, interface, or static (by an import). defined: ``definitions``; bases: ``parents``; variables: ``declared``.
    """
    java = defined.filter("lang = 'java'")
    classes = durable(java.filter("label IN ('Class', 'Interface', 'Enum')").select("qualified_name", "module_qn", "name").distinct())
    own_imports = durable(imports.filter("lang = 'java'").select("module_qn", "local_name", "full_name", "is_wildcard"))
    written = durable(bases.filter("lang = 'java'").withColumn("id", F.xxhash64("cls", "base", "ord")))
    up = class_of(written.select("id", "module_qn", F.col("base").alias("type")), classes, own_imports)
    edges = durable(written.join(up.withColumnRenamed("cls", "parent"), "id").select("cls", "parent", "type", "ord"))
    above = lattice(edges, classes.select(F.col("qualified_name").alias("cls")))
    calls = durable(calls.distinct())
    # Types of receivers, by the first way that has one.
    direct = calls.filter("receiver IS NULL OR receiver IN ('this', 'super')").filter("cls IS NOT NULL").select("id", "cls", F.lit(0).alias("way"), (F.col("receiver") == "super").alias("_up"))
    var = calls.filter("receiver IS NOT NULL AND receiver NOT IN ('this', 'super')").withColumn("var", F.regexp_replace("receiver", r"^this\.", ""))
    scopes = F.explode(F.array(F.struct(F.col("caller").alias("at"), F.lit(1).alias("way")), F.struct(F.col("cls").alias("at"), F.lit(2).alias("way")), F.struct(F.regexp_replace("cls", r"\.[^.]*$", "").alias("at"), F.lit(3).alias("way"))))
    typed = var.select("id", "module_qn", "var", F.col("receiver").startswith("this.").alias("_own"), scopes.alias("s")).filter("NOT (_own AND s.way = 1)").select("id", "module_qn", "var", "s.at", "s.way")
    typed = typed.join(variables.select("at", "var", "type"), ["at", "var"]).groupBy("id", "module_qn").agg(F.min(F.struct("way", "type")).alias("b")).select("id", "module_qn", F.col("b.type").alias("type"))
    unknown = var.join(typed, "id", "left_anti").select("id", "module_qn", F.col("receiver").alias("type"))
    by_type = class_of(typed.unionByName(unknown), classes, own_imports).select("id", "cls", F.lit(0).alias("way"), F.lit(False).alias("_up"))
    static = calls.filter("receiver IS NULL").join(own_imports.filter("NOT is_wildcard").select("module_qn", F.col("local_name").alias("name"), F.regexp_replace("full_name", r"\.[^.]*$", "").alias("type")), ["module_qn", "name"])
    wild = calls.filter("receiver IS NULL").join(own_imports.filter("is_wildcard").select("module_qn", F.col("full_name").alias("type")), "module_qn")
    asked = static.select("id", "module_qn", "type").union(wild.select("id", "module_qn", "type")).withColumn("_k", F.xxhash64("id", "type"))
    by_static = class_of(asked.select(F.col("_k").alias("id"), "module_qn", "type"), classes, own_imports).withColumnRenamed("id", "_k").join(asked.select("_k", "id"), "_k").select("id", "cls", F.lit(2).alias("way"), F.lit(False).alias("_up"))
    outer = direct.filter("NOT coalesce(_up, false)").select("id", F.regexp_replace("cls", r"\.[^.]*$", "").alias("cls"), F.lit(1).alias("way"), F.lit(False).alias("_up"))
    start = durable(direct.withColumn("_up", F.coalesce("_up", F.lit(False))).union(outer).union(by_type).union(by_static))
    types = F.regexp_extract("qualified_name", r"\(([^()]*)\)$", 1)
    methods = java.filter("label = 'Method'").select(F.col("parent_qn").alias("above"), "name", F.col("qualified_name").alias("callee"), F.when(types == "", 0).otherwise(F.size(F.split(types, ","))).alias("_n"), types.endswith("...").alias("_v")).distinct()
    met = start.join(calls.select("id", "name", "n_args"), "id").join(above, "cls").filter("NOT (_up AND level = 0)").join(methods, ["above", "name"])
    misfit = F.when(F.col("_n") == F.col("n_args"), 0).when(F.col("_v") & (F.col("n_args") >= F.col("_n") - 1), 1).otherwise(2)
    best = met.groupBy("id").agg(F.min(F.struct(misfit.alias("misfit"), "way", "by_interface", "level", "place", "callee")).alias("b"))
    how = F.when(F.col("b.way") == 2, "static").when(F.col("b.by_interface") == 1, "interface").when(F.col("b.level") > 0, "inherited").otherwise("own")
    return best.select("id", F.col("b.callee").alias("callee"), how.alias("how"))
