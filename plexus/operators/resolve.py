"""Name resolution: inherited methods, overrides, call targets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.functions.names import call_target, import_distance
from plexus.plans.graph import PropertyGraph, durable, large, met, stored


def ancestor_methods(inherits: DataFrame, methods: DataFrame, own: bool, most: int = 40, wanted: DataFrame | None = None) -> DataFrame:
    """Cls, name, found, depth: the first method of that name on the way up, level by level, parents in order.

    inherits: child, parent, ord. methods: cls, name, method. own: whether a class's own method counts.
    wanted: cls and name to look for; every method's own, if none is given.
    The search goes on only from classes that have found nothing; a place among its level's parents breaks ties.
    """
    wanted = (methods if wanted is None else wanted).select("cls", "name").distinct()
    front = wanted.select("cls", "name", F.col("cls").alias("at"), F.lit("").alias("place"))
    seen, found = front.select("cls", "name", "at"), []
    have = methods.select(F.col("cls").alias("at"), "name", F.col("method").alias("found"))
    first = Window.partitionBy("cls", "name").orderBy("place", "found")
    for depth in range(0 if own else 1, most + 1):
        if depth:
            up = front.join(inherits, front.at == inherits.child).select("cls", "name", F.col("parent").alias("at"), F.concat("place", F.format_string("/%06d", F.col("ord"))).alias("place"))
            up = up.groupBy("cls", "name", "at").agg(F.min("place").alias("place"))
            front = durable(up.join(seen, ["cls", "name", "at"], "left_anti"))
            if front.isEmpty():
                break
            seen = seen.union(front.select("cls", "name", "at"))
        hit = front.join(have, ["at", "name"]).withColumn("_r", F.row_number().over(first)).filter("_r = 1").select("cls", "name", "found", F.lit(depth).cast("bigint").alias("depth"))
        hit = durable(hit)
        found.append(hit)
        front = front.join(hit, ["cls", "name"], "left_anti")
    return reduce(DataFrame.union, found) if found else seen.limit(0).select("cls", "name", F.lit(0).alias("found"), F.lit(0).cast("bigint").alias("depth"))


def class_methods(g: PropertyGraph) -> DataFrame:
    m = g.of_type("DEFINES_METHOD").join(g.label("Method").select(F.col("node_id").alias("dst"), "name"), "dst")
    return m.select(F.col("src").alias("cls"), "name", F.col("dst").alias("method"))


def overrides(g: PropertyGraph) -> DataFrame:
    """src, dst, depth: each method and the nearest ancestor's method of the same name."""
    methods = class_methods(g)
    inherits = g.of_type("INHERITS").select(F.col("src").alias("child"), F.col("dst").alias("parent"), F.lit(0).alias("ord"))
    up = ancestor_methods(inherits, methods, own=False)
    return up.join(methods, ["cls", "name"]).select(F.col("method").alias("src"), F.col("found").alias("dst"), "depth")


def by_simple_name(calls: DataFrame, registry: DataFrame) -> DataFrame:
    """J15/W02/E12 fallback: calls (id, call_name, module_qn) to the registry's (qualified_name, simple_name) nearest by import distance.

    Equal distances go to the least name. The registry is reduced, before the join, to the least name by simple name,
    leading parts and length; a caller meets its own leading parts, so a name that everything defines makes no pairs.
    A candidate seen by fewer leading parts than it shares looks farther than it is and never wins over itself.
    """
    def heads(name: str):
        parts = F.split(name, "[.]")
        return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(i.alias("shared"), F.array_join(F.slice(parts, F.lit(1), i), ".").alias("head")))

    table = registry.select("simple_name", "qualified_name", F.size(F.split("qualified_name", "[.]")).alias("parts"), F.explode(heads("qualified_name")).alias("h"))
    table = table.groupBy("simple_name", "h.shared", "h.head", "parts").agg(F.min("qualified_name").alias("callee"))
    named = calls.select("id", "module_qn", call_target(F.col("call_name")).alias("simple_name"))
    asked = named.select("simple_name", "module_qn").distinct().withColumn("own", F.size(F.split("module_qn", "[.]")))
    met = asked.select("simple_name", "module_qn", "own", F.explode(heads("module_qn")).alias("h")).select("simple_name", "module_qn", "own", "h.*").join(table, ["simple_name", "shared", "head"])
    near = (F.col("own") > 1) & (F.col("shared") >= F.col("own") - 1) & (F.col("parts") >= F.col("own"))
    distance = (F.greatest("own", "parts") - F.col("shared") - near.cast("int")).cast("bigint")
    best = met.groupBy("simple_name", "module_qn").agg(F.min(F.struct(distance.alias("distance"), "callee")).alias("b"))
    return named.join(best, ["simple_name", "module_qn"]).select("id", F.col("b.callee").alias("callee"), F.col("b.distance").alias("distance"))


def resolve_calls(calls: DataFrame, imports: DataFrame, registry: DataFrame) -> DataFrame:
    """Id, callee, step of each call by the first step that finds one in the registry.

    Steps: 1 direct import, 2 an imported or local name before the first dot, 3 wildcard import, 4 the same module,
    5 the nearest of the same simple name. imports: module_qn, local_name, full_name, is_wildcard.
    """
    reg = registry.select(F.col("qualified_name").alias("callee"))
    head, rest = F.substring_index("call_name", ".", 1), F.expr("substring(call_name, instr(call_name, '.') + 1)")
    named = imports.filter("not is_wildcard").select("module_qn", "local_name", "full_name")
    stars = imports.filter("is_wildcard").select("module_qn", "full_name")
    c = calls.select("id", "call_name", "module_qn")
    direct = c.join(named, (c.call_name == named.local_name) & (c.module_qn == named.module_qn)).select("id", F.col("full_name").alias("callee"), F.lit(1).alias("step"))
    dotted = c.filter(F.col("call_name").contains("."))
    through = dotted.withColumn("h", head).withColumn("r", rest).join(named.withColumnRenamed("local_name", "h"), ["module_qn", "h"]).select("id", F.concat_ws(".", "full_name", "r").alias("callee"), F.lit(2).alias("step"))
    wild = c.join(stars, "module_qn").select("id", F.explode(F.array(F.concat_ws(".", "full_name", "call_name"), F.concat_ws("::", "full_name", "call_name"))).alias("callee"), F.lit(3).alias("step"))
    same = c.select("id", F.concat_ws(".", "module_qn", "call_name").alias("callee"), F.lit(4).alias("step"))
    probes = direct.union(through).union(wild).union(same).join(reg, "callee").select("id", "callee", "step", F.lit(0).cast("bigint").alias("distance"))
    far = by_simple_name(c, registry).select("id", "callee", F.lit(5).alias("step"), "distance")
    best = probes.union(far).groupBy("id").agg(F.min(F.struct("step", "distance", "callee")).alias("b"))
    return best.select("id", F.col("b.callee").alias("callee"), F.col("b.step").alias("step"))


def defining_module(g: PropertyGraph, most: int = 12) -> DataFrame:
    """node_id and module: up DEFINES_METHOD and DEFINES until a Module, however deep functions nest."""
    parent = g.of_type("DEFINES", "DEFINES_METHOD").groupBy(F.col("dst").alias("node_id")).agg(F.min("src").alias("up"))
    modules = g.label("Module").select(F.col("node_id").alias("up"), F.lit(True).alias("is_module"))
    now, done = parent, None
    for _ in range(most):
        marked = durable(now.join(modules, "up", "left"))
        hit = marked.filter("is_module").select("node_id", F.col("up").alias("module"))
        done = hit if done is None else done.union(hit)
        left = marked.filter("is_module is null").select("node_id", "up")
        if left.isEmpty():
            break
        now = left.join(parent.select(F.col("node_id").alias("up"), F.col("up").alias("_next")), "up").select("node_id", F.col("_next").alias("up"))
    return done


def external_importers(imports: DataFrame, packages: DataFrame) -> DataFrame:
    """Packages (package) to modules importing them or a part of them; an equi-join on the import's dotted prefixes."""
    parts = F.split("imported", "[.]")
    each = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "."))).alias("package")
    return imports.select("module", "imported", each).join(packages, "package").groupBy("package", "module").agg(F.max("imported").alias("imported"))


def class_names(uses: DataFrame, imports: DataFrame, registry: DataFrame) -> DataFrame:
    """Id, class_qn, step of uses (id, class_name, module_qn).

    Steps: 0 the module's import of that name, whether registered or not; 1 the same module; 2 and on the packages around
    it, nearest first; 1000 the least registered name ending in it. imports: module_qn, local_name, full_name.
    """
    reg = registry.select("qualified_name").distinct()
    first = imports.groupBy("module_qn", F.col("local_name").alias("class_name")).agg(F.max("full_name").alias("qn"))
    by_import = met(uses, first, ["module_qn", "class_name"]).select("id", "qn", F.lit(0).alias("step"))
    size = F.length("module_qn") - F.length(F.replace("module_qn", F.lit("."))) + 1
    around = uses.select("id", "class_name", "module_qn", size.alias("_n"), F.explode(F.sequence(F.lit(1), size)).alias("_i"))
    probes = around.select("id", F.concat_ws(".", F.expr("substring_index(module_qn, '.', _i)"), "class_name").alias("qualified_name"), (F.col("_n") - F.col("_i") + 1).alias("step"))
    by_place = met(probes, reg, ["qualified_name"]).select("id", F.col("qualified_name").alias("qn"), "step")
    ends = reg.groupBy(F.element_at(F.split("qualified_name", "[.]"), -1).alias("class_name")).agg(F.min("qualified_name").alias("qn"))
    by_end = met(uses, ends, ["class_name"]).select("id", "qn", F.lit(1000).alias("step"))
    best = by_import.union(by_place).union(by_end).groupBy("id").agg(F.min(F.struct("step", "qn")).alias("b"))
    return best.select("id", F.col("b.qn").alias("class_qn"), F.col("b.step").cast("bigint").alias("step"))


def wildcard_targets(calls: DataFrame, stars: DataFrame, registry: DataFrame) -> DataFrame:
    """Id, callee of calls (id, call_name, module_qn) by the first wildcard import (module_qn, full_name, ord) that has the name.

    A dotted probe comes before one with two colons; a full name that has two colons itself gets no dotted one.
    """
    dotted = F.when(~F.col("full_name").contains("::"), F.concat_ws(".", "full_name", "call_name"))
    probes = F.posexplode(F.array(dotted, F.concat_ws("::", "full_name", "call_name"))).alias("k", "qualified_name")
    tried = calls.join(stars, "module_qn").select("id", "ord", probes).join(registry.select("qualified_name").distinct(), "qualified_name")
    return tried.groupBy("id").agg(F.min(F.struct("ord", "k", "qualified_name")).alias("b")).select("id", F.col("b.qualified_name").alias("callee"))


def typed_methods(g: PropertyGraph, uses: DataFrame, imports: DataFrame) -> DataFrame:
    """Id, cls, method, depth of uses (id, class_name, module_qn, name): the type's class, then its own or nearest inherited method.

    A dotted type names its class by itself; others go through ``class_names``.
    """
    classes = g.label("Class").select("qualified_name", F.col("node_id").alias("cls"))
    plain = class_names(uses.filter(~F.col("class_name").contains(".")), imports, classes).select("id", "class_qn")
    found = plain.union(uses.filter(F.col("class_name").contains(".")).select("id", "class_name"))
    at = found.join(classes, found.class_qn == classes.qualified_name).join(uses.select("id", "name"), "id").select("id", "cls", "name")
    at = durable(at)
    inherits = g.of_type("INHERITS").select(F.col("src").alias("child"), F.col("dst").alias("parent"), F.lit(0).alias("ord"))
    best = ancestor_methods(inherits, class_methods(g), own=True, wanted=at)
    return at.join(best, ["cls", "name"]).select("id", "cls", F.col("found").alias("method"), "depth")


def graph_folders(graphs: DataFrame, clones: DataFrame) -> DataFrame:
    """Stem, owner, repo: graphs (stem) to clones (owner, repo). ``owner__repo`` asks for that clone only; a bare name takes the least owner."""
    has = F.col("stem").contains("__")
    named = graphs.filter(has).select("stem", F.substring_index("stem", "__", 1).alias("owner"), F.expr("substring(stem, instr(stem, '__') + 2)").alias("repo"))
    bare = graphs.filter(~has).select("stem", F.col("stem").alias("repo"))
    every = clones.select("owner", "repo").distinct()
    least = every.groupBy("repo").agg(F.min("owner").alias("owner"))
    return named.join(every, ["owner", "repo"]).select("stem", "owner", "repo").union(bare.join(least, "repo").select("stem", "owner", "repo"))


def ranked_modules(candidates: DataFrame, penalty: Column) -> DataFrame:
    """Candidates (id, idx, candidate, module_qn) with ``rank`` by penalty, import distance from 0 up, then idx."""
    distance = F.greatest(import_distance(F.col("candidate"), F.col("module_qn")), F.lit(0))
    w = Window.partitionBy("id").orderBy("_p", "_d", "idx")
    return candidates.withColumn("_p", penalty).withColumn("_d", distance).withColumn("rank", F.row_number().over(w).cast("bigint")).drop("_p", "_d")


#: Levels of ancestors at most; no real hierarchy is deeper.
LEVELS = 40


def lattice(edges: DataFrame, classes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """cls, above, by_interface, level, place: every class with itself and all that it inherits from, each once.

    edges: cls, parent, type, ord; classes: cls, also those without parents. The superclasses come before what an interface on the way gives, nearer before farther,
    and equally near ones in the order of the sources; cycles end.
    """
    step = edges.select(F.col("cls").alias("above"), F.col("parent").alias("_next"), (F.col("type") != "INHERITS").cast("int").alias("_i"), F.lpad(F.col("ord").cast("string"), 4, "0").alias("_o")).distinct()
    every = edges.select("cls").union(edges.select("parent")).union(classes.select("cls")).distinct()
    seen = stored(every.select("cls", F.col("cls").alias("above"), F.lit(0).alias("by_interface"), F.lit(0).alias("level"), F.lit("").alias("place")))
    new, step = seen, stored(step)
    for _ in range(levels):
        up = met(new, step, ["above"]).select("cls", F.col("_next").alias("above"), F.greatest("by_interface", "_i").alias("by_interface"), (F.col("level") + 1).alias("level"), F.concat("place", "_o").alias("place"))
        left = met(up, seen.select("cls", "above"), ["cls", "above"], "left_anti")
        new = stored(left.groupBy(F.xxhash64("cls", "above"), "cls", "above").agg(F.min(F.struct("by_interface", "level", "place")).alias("b")).select("cls", "above", "b.*"))
        if new.isEmpty():
            break
        seen = seen.union(new)
    return seen


#: The steps of ``cascade``, in order.
STEPS = ("iife", "super", "chain", "import", "qualified", "wildcard", "module", "nearest", "builtin", "operator")


def cascade(calls: DataFrame, typed: DataFrame, imports: DataFrame, registry: DataFrame, builtins: DataFrame) -> DataFrame:
    """Id, callee, step (its number and name) of each call by the first step that finds one. A call that a step has found, or that must end there, is not in the next one's input.

    Steps: iife, a function that is called where it stands; super, a method above the class, or nothing; chain, a method
    of what a call gives, or nothing; import, the imported name itself; qualified, a method of the receiver's type, then
    what follows an imported name, then the module's own dotted name; wildcard; module, the same one; nearest, the least
    import distance among equal simple names; builtin; operator, by its name.

    calls: id, module_qn, call_name (dotted; null behind a call), name (its last part), kind (iife, super, chain or plain).
    typed: id, callee of calls whose receiver has a known type. imports: module_qn, local_name, full_name, is_wildcard.
    registry: qualified_name, simple_name. builtins: name, callee.
    """
    known = durable(registry.select(F.col("qualified_name").alias("callee")).distinct())
    named = durable(imports.filter("NOT is_wildcard").groupBy("module_qn", "local_name").agg(F.max("full_name").alias("full_name")))
    stars = imports.filter("is_wildcard").select("module_qn", "full_name").distinct()
    held = lambda df: df.join(known, "callee", "left_semi").select("id", "callee")
    in_module = lambda left: left.select("id", F.concat_ws(".", "module_qn", "call_name").alias("callee"))

    def qualified(left: DataFrame) -> DataFrame:
        dotted = left.filter("call_name LIKE '%.%'")
        by_type = dotted.join(typed, "id").select("id", "callee", F.lit(0).alias("way"))
        head, rest = F.substring_index("call_name", ".", 1), F.expr("substring(call_name, instr(call_name, '.') + 1)")
        through = dotted.select("id", "module_qn", head.alias("local_name"), rest.alias("_r")).join(named, ["module_qn", "local_name"]).select("id", F.concat_ws(".", "full_name", "_r").alias("callee"))
        own = held(through).withColumn("way", F.lit(1)).union(held(in_module(dotted)).withColumn("way", F.lit(2)))
        return by_type.union(own).groupBy("id").agg(F.min(F.struct("way", "callee"))["callee"].alias("callee"))

    def wildcard(left: DataFrame) -> DataFrame:
        # The registry's names by what they stand in, so a call meets only those of its name.
        under = known.select("callee", F.regexp_replace("callee", r"\.[^.]*$", "").alias("full_name"), F.element_at(F.split("callee", "[.]"), -1).alias("call_name"))
        offered = stars.join(under, "full_name").select("module_qn", "call_name", "callee").groupBy("module_qn", "call_name").agg(F.min("callee").alias("callee"))
        return left.join(offered, ["module_qn", "call_name"]).select("id", "callee")

    def nearest(left: DataFrame) -> DataFrame:
        # A method of something unknown is not looked for by its name alone if something is known by the whole name's head.
        return by_simple_name(left.filter("call_name IS NOT NULL"), registry).select("id", "callee")

    ways = {
        "iife": (lambda left: held(in_module(left.filter("kind = 'iife'"))), None),
        "super": (lambda left: left.filter("kind = 'super'").join(typed, "id").select("id", "callee"), "super"),
        "chain": (lambda left: left.filter("kind = 'chain'").join(typed, "id").select("id", "callee"), "chain"),
        "import": (lambda left: held(left.join(named, (left.call_name == named.local_name) & (left.module_qn == named.module_qn)).select("id", F.col("full_name").alias("callee"))), None),
        "qualified": (qualified, None),
        "wildcard": (wildcard, None),
        "module": (lambda left: held(in_module(left)), None),
        "nearest": (nearest, None),
        "builtin": (lambda left: left.join(builtins, left.call_name == builtins.name).select("id", "callee"), None),
        "operator": (lambda left: left.filter("name LIKE 'operator\\_%'").select("id", F.concat(F.lit("builtin.cpp."), "name").alias("callee")), None),
    }
    left, out = durable(calls), None
    for number, step in enumerate(STEPS, 1):
        find, ends = ways[step]
        got = durable(find(left).groupBy("id").agg(F.min("callee").alias("callee")))
        hit = got.select("id", "callee", F.lit(number).alias("step"), F.lit(step).alias("by"))
        out = hit if out is None else out.union(hit)
        left = durable((left.filter(F.col("kind") != ends) if ends else left).join(got.select("id"), "id", "left_anti"))
    return out
