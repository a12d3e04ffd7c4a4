"""Graph contexts as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.plans.graph import PropertyGraph, durable


def _joined(rows: DataFrame, key: list[str], order: list[str], text: str, sep: str, out: str) -> DataFrame:
    """The texts of each key in order; a key's rows are a context's, whose size the expansion bounds."""
    listed = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_t"))))
    return rows.groupBy(*key).agg(F.array_join(F.transform(listed, lambda x: x["_t"]), sep).alias(out))


def placed(g: PropertyGraph, nodes: DataFrame) -> DataFrame:
    """seed, node, label, name, file: the file of the node's first parent, or its own."""
    about = g.nodes.select(F.col("node_id").alias("node"), "label", F.coalesce("name", F.lit("?")).alias("name"), "path", "qualified_name")
    parent = g.of_type("DEFINES", "DEFINES_METHOD").groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("up"))
    homes = about.select(F.col("node").alias("up"), F.coalesce("path", "qualified_name").alias("home"))
    known = nodes.select("seed", "node").distinct().join(about, "node").join(parent, "node", "left").join(homes, "up", "left")
    return known.select("seed", "node", "label", "name", F.coalesce(F.when(F.col("up").isNull(), F.col("path")).otherwise(F.col("home")), F.lit("unknown")).alias("file"))


def file_blocks(g: PropertyGraph, nodes: DataFrame) -> DataFrame:
    """Seed, file, block: a heading and the file's nodes in id order."""
    line = placed(g, nodes).withColumn("line", F.concat(F.lit("  - ["), "label", F.lit("] "), "name"))
    return _joined(line, ["seed", "file"], ["node"], "line", "\n", "block").withColumn("block", F.concat(F.lit("\n### "), "file", F.lit("\n"), "block"))


def graph_context(g: PropertyGraph, nodes: DataFrame) -> DataFrame:
    """Seed, context of nodes (seed, node): files with their nodes, calls inside the context, parents of classes.

    Files are in name order, nodes in id order. A node without a known file is under ``unknown``; ids that no node has are left out.
    """
    ctx = nodes.select("seed", "node").distinct()
    names = g.nodes.select(F.col("node_id").alias("dst"), F.coalesce("name", F.lit("?")).alias("name"))
    known, files = placed(g, nodes), file_blocks(g, nodes)
    files = _joined(files, ["seed"], ["file"], "block", "\n", "files")

    def pairs(kind: str, labels: tuple[str, ...], word: str, inside: bool) -> DataFrame:
        own = known.filter(F.col("label").isin(*labels)).select("seed", "node", F.col("name").alias("from"))
        to = own.join(g.of_type(kind).select(F.col("src").alias("node"), "dst"), "node")
        if inside:
            to = to.join(ctx.select("seed", F.col("node").alias("dst")), ["seed", "dst"])
        to = to.join(names, "dst")
        lines = _joined(to, ["seed", "node", "from"], ["dst"], "name", ", ", "to").withColumn("line", F.concat(F.lit("  "), "from", F.lit(word), "to"))
        return _joined(lines, ["seed"], ["node"], "line", "\n", kind)

    out = files.join(pairs("CALLS", ("Function", "Method"), " -> ", True), "seed", "left").join(pairs("INHERITS", ("Class",), " extends ", False), "seed", "left")
    section = lambda title, col: F.concat_ws("\n", F.lit(title), F.col(col))
    return out.select("seed", F.concat_ws("\n", section("## File Structure", "files"), section("\n## Call Graph", "CALLS"), section("\n## Inheritance", "INHERITS")).alias("context"))


def _first(rows: DataFrame, key: str, most: int | None, out: str) -> DataFrame:
    """The names of each key's first ``most`` rows (all without it) by ``ord``, joined by commas. Only those rows are gathered."""
    if most:
        rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("ord", "shown"))).filter(F.col("_r") <= most)
    return _joined(rows, [key], ["ord"], "shown", ", ", out)


def code_chunks(g: PropertyGraph, nodes: DataFrame, texts: DataFrame, most: int = 5) -> DataFrame:
    """node, chunk of nodes (node): an XML element with what is known of a node and its relations, and its source.

    The first ``most`` callees and callers by id are named, and all parents; a line without content is left out. texts:
    node, file, text, start_line, end_line. A node without a text has an empty source; text is not escaped.
    """
    about = g.nodes.select(F.col("node_id").alias("node"), "label", "name", "qualified_name", "decorators")
    shown = about.select("node", F.coalesce("qualified_name", "name", F.lit("?")).alias("shown"))
    calls, inherits, holds = g.of_type("CALLS"), g.of_type("INHERITS"), g.of_type("DEFINES", "DEFINES_METHOD")
    named = lambda e, of, other, names: e.select(F.col(of).alias("_k"), F.col(other).alias("ord")).join(names.withColumnRenamed("node", "ord"), "ord")
    own = nodes.select("node").distinct().join(about, "node").join(texts.select("node", "file", "text", "start_line", "end_line"), "node", "left")
    short = about.select("node", F.coalesce("name", F.lit("?")).alias("shown"))
    for rows, cap, out in ((named(calls, "src", "dst", shown), most, "calls"), (named(calls, "dst", "src", shown), most, "called_by"), (named(inherits, "src", "dst", short), None, "inherits"), (named(holds, "dst", "src", shown), 1, "defined_in")):
        own = own.join(_first(rows, "_k", cap, out).withColumnRenamed("_k", "node"), "node", "left")
    tag = lambda name, value: F.concat(F.lit(f"  <{name}>"), value.cast("string"), F.lit(f"</{name}>"))
    lines = F.when(F.col("start_line").isNotNull(), F.concat(F.col("start_line").cast("string"), F.lit("-"), F.col("end_line").cast("string")))
    listed = F.when(F.size(F.coalesce("decorators", F.array().cast("array<string>"))) > 0, F.array_join("decorators", ", "))
    parts: list[Column] = [
        F.lit("<code_chunk>"), tag("node_id", F.col("node")), tag("type", F.col("label")), tag("qualified_name", F.col("qualified_name")), tag("file", F.col("file")), tag("lines", lines), tag("calls", F.col("calls")), tag("called_by", F.col("called_by")),
        tag("inherits", F.col("inherits")), tag("defined_in", F.col("defined_in")), tag("decorators", listed), F.lit("  <source>"), F.coalesce("text", F.lit("")), F.lit("  </source>"), F.lit("</code_chunk>"),
    ]
    return own.select("node", F.concat_ws("\n", *parts).alias("chunk"))


def tree_lines(edges: DataFrame, seeds: DataFrame, names: DataFrame, depth: int, children: int = 4, margin: str = "") -> DataFrame:
    """seed, lines: a tree of names with box marks under each seed; seeds without children have no row.

    The first ``children`` by id under each node, none twice on a path. A node's place is the path of its numbers from the
    seed; whether it and each node above it are the last ones decides the marks before its name, so the lines of a tree
    are its paths in order. edges: src, dst; names: node, name.
    """
    w = Window.partitionBy("src")
    few = durable(edges.select("src", "dst").distinct().withColumn("_r", F.row_number().over(w.orderBy("dst"))).filter(F.col("_r") <= children))
    now = seeds.select("seed", F.col("seed").alias("node"), F.array("seed").alias("path"), F.array().cast("array<int>").alias("place"), F.array().cast("array<boolean>").alias("last"))
    out = None
    for _ in range(depth):
        met = now.join(few, F.col("node") == F.col("src")).filter(~F.array_contains("path", F.col("dst")))
        mine = Window.partitionBy("seed", "path")
        met = met.withColumn("_n", F.row_number().over(mine.orderBy("dst"))).withColumn("_of", F.count("*").over(mine))
        # Written out, as both the next level and the lines read it.
        now = durable(met.select("seed", F.col("dst").alias("node"), F.array_append("path", F.col("dst")).alias("path"), F.array_append("place", F.col("_n")).alias("place"), F.array_append("last", F.col("_n") == F.col("_of")).alias("last")))
        out = now if out is None else out.union(now)
    above = F.array_join(F.transform(F.slice("last", F.lit(1), F.size("last") - 1), lambda x: F.when(x, "    ").otherwise("│   ")), "")
    mark = F.when(F.element_at("last", -1), "└── ").otherwise("├── ")
    line = out.join(names, "node").select("seed", "place", F.concat(F.lit(margin), above, mark, "name").alias("line"))
    return _joined(line, ["seed"], ["place"], "line", "\n", "lines")


def ascii_graph(g: PropertyGraph, seeds: DataFrame, down: int = 3, up: int = 2, siblings: int = 5) -> DataFrame:
    """seed, shown: the seed, its callees and callers as trees, and its first siblings, those of one parent."""
    about = g.nodes.select(F.col("node_id").alias("node"), F.coalesce("name", F.lit("?")).alias("name"), "label")
    calls, names = g.of_type("CALLS").select("src", "dst"), about.select("node", "name")
    below = tree_lines(calls, seeds, names, down, margin="│   ").withColumnRenamed("lines", "below")
    over = tree_lines(calls.select(F.col("dst").alias("src"), F.col("src").alias("dst")), seeds, names, up, margin="│   ").withColumnRenamed("lines", "over")
    holds = g.of_type("DEFINES", "DEFINES_METHOD").select(F.col("src").alias("up"), F.col("dst").alias("node")).distinct()
    # One child more than asked for is kept of each parent, as the seed itself is none.
    first = holds.withColumn("_r", F.row_number().over(Window.partitionBy("up").orderBy("node"))).filter(F.col("_r") <= siblings + 1).drop("_r")
    near = seeds.join(holds.withColumnRenamed("node", "seed"), "seed").join(first, "up").filter("node != seed").select("seed", "node").distinct()
    mine = Window.partitionBy("seed").orderBy("node")
    near = near.withColumn("_n", F.row_number().over(mine)).filter(F.col("_n") <= siblings).join(names, "node").withColumn("_of", F.max("_n").over(Window.partitionBy("seed")))
    beside = near.withColumn("line", F.concat(F.when(F.col("_n") == F.col("_of"), "    └── ").otherwise("    ├── "), "name"))
    beside = _joined(beside, ["seed"], ["node"], "line", "\n", "beside")
    out = seeds.select("seed").distinct().join(about.withColumnRenamed("node", "seed"), "seed").join(below, "seed", "left").join(over, "seed", "left").join(beside, "seed", "left")
    section = lambda title, col, end: F.concat(F.lit(f"{title}\n"), F.col(col), F.lit(end))
    head = F.concat(F.lit("Seed: "), "name", F.lit(" ("), "label", F.lit(")"))
    return out.select("seed", F.concat_ws("\n", F.lit("=== GRAPH STRUCTURE ===\n"), head, F.lit("│"), section("├─► CALLS (downstream)", "below", "\n│"), section("├─◄ CALLED BY (upstream)", "over", "\n│"), section("└── SIBLINGS (same file)", "beside", "")).alias("shown"))
