"""Paths and neighbourhoods: bounded joins for short paths, frontier joins for many seeds at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexus.plans.graph import PropertyGraph, durable, module_of, production


def walks(edges: DataFrame, hops: int, rule: str = "walk") -> DataFrame:
    """n0..n<hops> of all paths of exactly ``hops`` edges. rule: walk, trail (no edge twice) or simple (no node twice)."""
    e = edges.select("src", "dst")
    out = e.select(F.col("src").alias("n0"), F.col("dst").alias("n1"))
    if rule == "simple":
        out = out.filter("n0 != n1")
    for k in range(1, hops):
        out = out.join(e.select(F.col("src").alias(f"n{k}"), F.col("dst").alias(f"n{k + 1}")), f"n{k}")
        if rule == "simple":
            for i in range(k + 1):
                out = out.filter(F.col(f"n{i}") != F.col(f"n{k + 1}"))
        elif rule == "trail":
            for i in range(k):
                out = out.filter((F.col(f"n{i}") != F.col(f"n{k}")) | (F.col(f"n{i + 1}") != F.col(f"n{k + 1}")))
    return out.select(*[f"n{i}" for i in range(hops + 1)])


def fixed_chains(g: PropertyGraph, hops: int, min_modules: int = 2) -> DataFrame:
    """n0..n<hops> of paths of production nodes with different names over at least ``min_modules`` modules.

    Edges to other nodes go before the first hop, and a name met again ends a path at once.
    """
    n = g.nodes.filter(production(F.col("qualified_name"))).select("node_id", "name", module_of(F.col("qualified_name")).alias("module"))
    start = n.select(F.col("node_id").alias("src"), F.col("name").alias("s_name"), F.col("module").alias("s_module"))
    end = n.select(F.col("node_id").alias("dst"), F.col("name").alias("d_name"), F.col("module").alias("d_module"))
    e = durable(g.of_type("CALLS").select("src", "dst").join(start, "src").join(end, "dst").filter("s_name != d_name"))
    out = e.select(F.col("src").alias("n0"), F.col("dst").alias("n1"), F.array("s_name", "d_name").alias("names"), F.array_distinct(F.array("s_module", "d_module")).alias("modules"))
    step = e.select("src", "dst", "d_name", "d_module")
    for k in range(1, hops):
        out = out.join(step.withColumnRenamed("src", f"n{k}").withColumnRenamed("dst", f"n{k + 1}"), f"n{k}").filter(~F.array_contains("names", F.col("d_name")))
        out = out.withColumn("names", F.array_append("names", F.col("d_name"))).withColumn("modules", F.array_union("modules", F.array("d_module"))).drop("d_name", "d_module")
    return out.filter(F.size("modules") >= min_modules).select(*[f"n{i}" for i in range(hops + 1)])


#: Neighbours in one page of a node's edges.
PAGE = 1024


def maximal_paths(edges: DataFrame, starts: DataFrame, max_edges: int, allowed: DataFrame | None = None) -> DataFrame:
    """``path`` of every simple path from ``starts`` (node_id) that has ``max_edges`` edges or cannot go on.

    One row per way along parallel edges. A path cannot go on if every edge from its end leads back into it. With
    ``allowed`` (node_id), paths that meet any other node are left out, and no longer followed.
    """
    e = edges.select("src", "dst")
    e = e.withColumn("to", F.col("dst")) if allowed is None else e.join(allowed.select(F.col("node_id").alias("dst"), F.col("node_id").alias("to")), "dst", "left")
    # A node's edges are dealt to pages of about PAGE neighbours, so a path meets a hub's list in pieces, in many tasks.
    e = durable(e.groupBy("src", "dst", "to").agg(F.count("*").alias("ways")))
    size = max(PAGE, max_edges + 1)
    pages = e.groupBy("src").agg(F.ceil(F.count_distinct("dst") / size).cast("int").alias("pages"))
    dealt = e.join(pages, "src").withColumn("page", F.pmod(F.xxhash64("dst"), F.col("pages")).cast("int"))
    fans = durable(dealt.groupBy("src", "page").agg(F.collect_list(F.struct("dst", "to", "ways")).alias("next")))
    pages = durable(pages)
    now = starts.select(F.array("node_id").alias("path"))
    done = None
    for _ in range(max_edges):
        met = now.withColumn("src", F.element_at("path", -1)).join(pages, "src", "left")
        each = met.withColumn("page", F.explode(F.sequence(F.lit(0), F.greatest(F.coalesce("pages", F.lit(1)) - 1, F.lit(0)))))
        fan = each.join(fans, ["src", "page"], "left").withColumn("free", F.filter("next", lambda y: ~F.array_contains(F.col("path"), y["dst"])))
        # A node of several pages has more neighbours than a path has nodes, so only one page can be used up.
        ended = fan.filter("pages IS NULL OR pages = 1 AND size(free) = 0").select("path")
        done = ended if done is None else done.union(ended)
        good = F.filter("free", lambda y: y["to"].isNotNull())
        step = fan.filter("pages IS NOT NULL").select("path", F.explode(good).alias("y")).select("path", "y.to", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("y.ways"))))
        now = durable(step.select(F.array_append("path", F.col("to")).alias("path")))  # both what ends and what goes on read it
    return now if done is None else done.union(now)


def chains(g: PropertyGraph, kind: str, labels: tuple[str, ...], min_edges: int, max_edges: int, min_modules: int, depth: int = 1) -> DataFrame:
    """Maximal paths of production nodes over at least ``min_modules`` modules: ids joined by commas and the edge count."""
    names = g.nodes.filter(production(F.col("qualified_name"))).select("node_id", module_of(F.col("qualified_name"), depth=depth).alias("module"))
    found = maximal_paths(g.of_type(kind), names.join(g.label(*labels).select("node_id"), "node_id"), max_edges, names).filter(F.size("path") > min_edges)
    counted = found.groupBy("path").agg(F.count("*").alias("ways"))
    if min_modules > 1:
        each = counted.select("path", "ways", F.explode("path").alias("node_id")).join(names, "node_id")
        counted = each.groupBy("path", "ways").agg(F.count_distinct("module").alias("modules")).filter(F.col("modules") >= min_modules)
    return counted.select(F.array_join("path", ",").alias("path"), (F.size("path") - 1).cast("bigint").alias("hops"), F.col("ways").alias("ways"))


def bfs(edges: DataFrame, seeds: DataFrame, depth: int, within: DataFrame | None = None) -> DataFrame:
    """Seed, node, depth (least) along ``edges`` (src, dst) from ``seeds`` (seed), all seeds at once."""
    e = edges.select("src", "dst").distinct()
    if within is not None:
        e = e.join(within.select(F.col("node_id").alias("dst")), "dst", "left_semi")
    e = durable(e)  # planned once, not at every level
    seen = seeds.select("seed", F.col("seed").alias("node"), F.lit(0).cast("bigint").alias("depth"))
    front = seen
    for k in range(1, depth + 1):
        reached = front.join(e, front.node == e.src).select("seed", F.col("dst").alias("node")).distinct()
        front = reached.join(seen, ["seed", "node"], "left_anti").withColumn("depth", F.lit(k).cast("bigint"))
        if k % 3 == 0 or depth > 4:
            front = durable(front)
            if front.isEmpty():
                break
        seen = seen.unionByName(front)
    return seen


def capped(reached: DataFrame, most: int, salt: str = "s") -> DataFrame:
    """At most ``most`` nodes per seed: nearer first, then by a fixed hash of the node."""
    w = Window.partitionBy("seed").orderBy("depth", F.md5(F.concat(F.col("node").cast("string"), F.lit(salt))), "node")
    return reached.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most).drop("_r")


def budgeted(edges: DataFrame, seeds: DataFrame, depth: int, most: int, salt: str = "s") -> DataFrame:
    """What ``capped`` leaves of ``bfs``, without the rest being found: a level adds nodes only up to ``most``, and a full seed leaves the frontier.

    Of a node's neighbours only the first 2 * most by the hash can matter, as fewer than ``most`` of them are known.
    """
    order = F.md5(F.concat(F.col("dst").cast("string"), F.lit(salt)))
    e = edges.select("src", "dst").distinct().withColumn("_r", F.row_number().over(Window.partitionBy("src").orderBy(order, "dst"))).filter(F.col("_r") <= 2 * most).drop("_r")
    e = durable(e)
    seen = front = capped(seeds.select("seed", F.col("seed").alias("node"), F.lit(0).cast("bigint").alias("depth")).distinct(), most, salt)
    for k in range(1, depth + 1):
        counts = seen.groupBy("seed").agg(F.count("*").alias("_n"))
        reached = front.join(e, front.node == e.src).select("seed", F.col("dst").alias("node")).distinct()
        new = reached.join(seen, ["seed", "node"], "left_anti").withColumn("depth", F.lit(k).cast("bigint"))
        ranked = new.withColumn("_r", F.row_number().over(Window.partitionBy("seed").orderBy(F.md5(F.concat(F.col("node").cast("string"), F.lit(salt))), "node")))
        front = durable(ranked.join(counts, "seed").filter(F.col("_r") <= most - F.col("_n")).withColumn("_full", F.col("_n") + F.col("_r") >= most).drop("_r"))
        seen = seen.unionByName(front.select("seed", "node", "depth"))
        if k == depth:
            break
        full = front.filter("_full").select("seed").distinct()
        front = front.select("seed", "node", "depth").join(full, "seed", "left_anti")
    return seen


def shortest_path(edges: DataFrame, start: int, goal: int, most: int = 10) -> DataFrame:
    """The path of fewest edges, least by node ids among equals; no row if there is none within ``most``."""
    e = edges.select("src", "dst").distinct()
    spark = edges.sparkSession
    front = spark.range(1).select(F.array(F.lit(start).cast("bigint")).alias("path"), F.lit(start).cast("bigint").alias("node"))
    seen = front.select("node")
    for _ in range(most + 1):
        hit = front.filter(F.col("node") == goal).agg(F.min("path").alias("path")).filter("path is not null")
        if not hit.isEmpty():
            return hit.select(F.array_join("path", ",").alias("path"), (F.size("path") - 1).cast("bigint").alias("hops"))
        step = front.join(e, front.node == e.src).select(F.array_append("path", F.col("dst")).alias("path"), F.col("dst").alias("node"))
        front = durable(step.groupBy("node").agg(F.min("path").alias("path")).join(seen, "node", "left_anti").select("path", "node"))
        if front.isEmpty():
            break
        seen = seen.union(front.select("node"))
    return front.limit(0).select(F.array_join("path", ",").alias("path"), F.lit(0).cast("bigint").alias("hops"))


#: Caps up to which nodes are counted while they are found.
LARGEST_BUDGET = 10_000

#: Strategy name to edge types and direction, fixed values.
STRATEGIES = {"bfs": (("CALLS", "DEFINES", "DEFINES_METHOD", "INHERITS", "IMPORTS"), "both"), "callers": (("CALLS",), "in"), "callees": (("CALLS",), "out"), "imports": (("IMPORTS", "DEFINES"), "imports"), "inheritance": (("INHERITS",), "both"), "definitions": (("DEFINES", "DEFINES_METHOD"), "out"), "file": (("DEFINES", "DEFINES_METHOD", "CALLS"), "out"), "chain": (("CALLS",), "out")}


def expand(g: PropertyGraph, seeds: DataFrame, strategy: str, depth: int, most: int) -> DataFrame:
    """T10-T17 by name: seed, node, depth with at most ``most`` nodes a seed."""
    types, way = STRATEGIES[strategy]
    e = g.of_type(*types).select("src", "dst", "type")
    if way == "in":
        e = e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    elif way == "both":
        e = g.undirected(*types)
    elif way == "imports":
        e = e.select("src", "dst").union(e.filter("type = 'IMPORTS'").select("dst", "src"))
    return budgeted(e, seeds, depth, most) if most <= LARGEST_BUDGET else capped(bfs(e, seeds, depth), most)


def reachable(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """node_id of everything reachable from ``starts`` (seed): one frontier for all of them, each node met once."""
    e = durable(edges.select("src", "dst").distinct())
    front = seen = durable(starts.select(F.col("seed").alias("node_id")).distinct())
    while not front.isEmpty():
        front = durable(front.join(e, front.node_id == e.src).select(F.col("dst").alias("node_id")).distinct().join(seen, "node_id", "left_anti"))
        seen = durable(seen.union(front))
    return seen


def closure_delete(g: PropertyGraph, roots: DataFrame, literal: bool = False) -> PropertyGraph:
    """Without everything reachable from ``roots`` (seed); only along containment unless ``literal``."""
    gone = reachable(g.edges if literal else g.of_type("DEFINES", "DEFINES_METHOD"), roots)
    nodes = g.nodes.join(gone, "node_id", "left_anti")
    edges = g.edges.join(gone.withColumnRenamed("node_id", "src"), "src", "left_anti").join(gone.withColumnRenamed("node_id", "dst"), "dst", "left_anti")
    return PropertyGraph(nodes, edges)


def ancestors(g: PropertyGraph, least: int = 2, depth: int = 40) -> DataFrame:
    """Seed, node, depth of each class with ``least`` ancestors or more; parents without a name are not traversed."""
    named = g.nodes.filter("name IS NOT NULL").select("node_id")
    up = bfs(g.of_type("INHERITS"), g.label("Class").select(F.col("node_id").alias("seed")), depth, named).filter("depth > 0")
    enough = up.groupBy("seed").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("seed")
    return up.join(enough, "seed", "left_semi")


def inheritance_tree(g: PropertyGraph, seeds: DataFrame, most: int, levels: int = 5, salt: str = "s") -> DataFrame:
    """Seed, node: INHERITS both ways, a further level only while a seed has fewer than most // 2 nodes, then methods as fill."""
    e = durable(g.undirected("INHERITS").select("src", "dst").distinct())
    seen = front = seeds.select("seed", F.col("seed").alias("node"))
    for _ in range(levels):
        open_ = seen.groupBy("seed").agg(F.count("*").alias("n")).filter(F.col("n") < most // 2).select("seed")
        step = front.join(open_, "seed", "left_semi").join(e, front.node == e.src).select("seed", F.col("dst").alias("node")).distinct()
        front = durable(step.join(seen, ["seed", "node"], "left_anti"))
        seen = durable(seen.union(front))
    return _filled(seen, g.of_type("DEFINES_METHOD"), most, salt)


def definitions_and_related(g: PropertyGraph, seeds: DataFrame, most: int, salt: str = "s") -> DataFrame:
    """Seed, node: what the seed defines up to the cap, then what all of these call or define."""
    own = _filled(seeds.select("seed", F.col("seed").alias("node")), g.of_type("DEFINES", "DEFINES_METHOD"), most, salt)
    return _filled(durable(own), g.of_type("CALLS", "DEFINES_METHOD"), most, salt)


def _filled(seen: DataFrame, edges: DataFrame, most: int, salt: str) -> DataFrame:
    """``seen`` (seed, node) and, up to ``most`` nodes a seed, other ends of its nodes' ``edges`` by a fixed hash."""
    e = edges.select(F.col("src").alias("node"), "dst").distinct()
    more = seen.join(e, "node").select("seed", F.col("dst").alias("node")).distinct().join(seen, ["seed", "node"], "left_anti")
    room = seen.groupBy("seed").agg((F.lit(most) - F.count("*")).alias("room"))
    # No seed has more room than most, so the window keeps that many a seed at most.
    return seen.union(_least(more, "seed", "node", most, salt, rank="_k").join(room, "seed").filter("_k <= room").select("seed", "node"))


def distances_within(g: PropertyGraph, sets: DataFrame, depth: int = 10) -> DataFrame:
    """Seed, node, depth along edges of any type, both ways, inside each seed's own set (seed, node)."""
    e = g.undirected().select("src", "dst").filter("src != dst").distinct()
    inside = durable(sets.select("seed", F.col("node").alias("src")).join(e, "src").join(sets.select("seed", F.col("node").alias("dst")), ["seed", "dst"]).select("seed", "src", "dst"))
    seen = front = sets.select("seed").distinct().select("seed", F.col("seed").alias("node"), F.lit(0).cast("bigint").alias("depth"))
    for k in range(1, depth + 1):
        step = front.select("seed", F.col("node").alias("src")).join(inside, ["seed", "src"]).select("seed", F.col("dst").alias("node")).distinct()
        front = durable(step.join(seen, ["seed", "node"], "left_anti").withColumn("depth", F.lit(k).cast("bigint")))
        if front.isEmpty():
            break
        seen = durable(seen.unionByName(front))
    return seen


def call_tree(edges: DataFrame, seeds: DataFrame, depth: int, children: int = 4) -> DataFrame:
    """Seed and path of ids; the first ``children`` callees by id under each node, none twice on a path."""
    w = Window.partitionBy("src").orderBy("dst")
    e = edges.select("src", "dst").distinct().withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= children).drop("_r")
    now = out = seeds.select("seed", F.array("seed").alias("path"))
    for _ in range(depth):
        now = now.join(e, F.element_at("path", -1) == F.col("src")).filter(~F.array_contains("path", F.col("dst"))).select("seed", F.array_append("path", F.col("dst")).alias("path"))
        out = out.union(now)
    return out


def chain_with_siblings(g: PropertyGraph, seeds: DataFrame, depth: int = 4, siblings: int = 2, callers: int = 3, salt: str = "s") -> DataFrame:
    """Seed, node: a call chain, the siblings of its nodes and the callers of its seed; picks follow a fixed hash instead of chance."""
    order = lambda col: F.struct(F.md5(F.concat(F.col(col).cast("string"), F.lit(salt))).alias("h"), F.col(col).alias("n"))
    calls = g.of_type("CALLS").select("src", "dst").distinct()
    now = seeds.select("seed", F.array("seed").alias("path"))
    done = None
    for _ in range(depth):
        step = now.join(calls, F.element_at("path", -1) == F.col("src"), "left")
        free = F.when(~F.array_contains("path", F.col("dst")), order("dst"))
        step = step.groupBy("seed", "path").agg(F.min(free).alias("b"))
        ended = step.filter("b IS NULL").select("seed", "path")
        done = ended if done is None else done.union(ended)
        now = step.filter("b IS NOT NULL").select("seed", F.array_append("path", F.col("b.n")).alias("path"))
    chain = (now if done is None else done.union(now)).select("seed", F.explode("path").alias("node"))
    owns = g.of_type("DEFINES", "DEFINES_METHOD").select(F.col("src").alias("up"), F.col("dst").alias("node")).distinct()
    # One more than asked for a node is kept of each parent, as the node itself is no sibling.
    best = _least(owns, "up", "node", siblings + 1, salt)
    near = chain.join(owns, "node").join(best.withColumnRenamed("node", "sibling"), "up").filter("node != sibling")
    w = Window.partitionBy("seed", "node").orderBy(F.md5(F.concat(F.col("sibling").cast("string"), F.lit(salt))), "sibling")
    picked = near.select("seed", "node", "sibling").distinct().withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= siblings).select("seed", F.col("sibling").alias("node"))
    over = _least(calls.select(F.col("dst").alias("up"), F.col("src").alias("node")), "up", "node", callers, salt)
    above = seeds.join(over, F.col("seed") == F.col("up")).select("seed", "node")
    return chain.union(picked).union(above).distinct()


def _least(rows: DataFrame, key: str, col: str, most: int, salt: str, rank: str | None = None) -> DataFrame:
    """The first ``most`` values of ``col`` under each key by a fixed hash; with ``rank``, also their place from 1 on."""
    w = Window.partitionBy(key).orderBy(F.md5(F.concat(F.col(col).cast("string"), F.lit(salt))), col)
    first = rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most)
    return first.withColumnRenamed("_r", rank) if rank else first.drop("_r")


def file_centric(g: PropertyGraph, seeds: DataFrame, modules: DataFrame, external: int = 5, salt: str = "s") -> DataFrame:
    """Seed, node: what the seed's module (modules: node_id, module) defines, and up to ``external`` callees outside of it."""
    home = seeds.join(modules, F.col("seed") == F.col("node_id")).select("seed", "module")
    owns = g.of_type("DEFINES", "DEFINES_METHOD").select(F.col("src").alias("module"), F.col("dst").alias("node"))
    inside = seeds.select("seed", F.col("seed").alias("node")).union(home.join(owns, "module").select("seed", "node")).distinct()
    calls = g.of_type("CALLS").select(F.col("src").alias("node"), "dst").distinct()
    out = inside.join(calls, "node").select("seed", F.col("dst").alias("node")).distinct().join(inside, ["seed", "node"], "left_anti")
    return inside.union(_least(out, "seed", "node", external, salt).select("seed", "node"))
