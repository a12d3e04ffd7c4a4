"""All registered graph queries with the SQL that gives the same rows.

Names are the operator inventory's row ids; a suffix tells variants of a row apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plexus.functions import names as N
from plexus.operators import commands, logs, paths, resolve, sampling
from plexus.plans.graph import PropertyGraph, module_of, production
from plexus.sources import sinks
from plexus.sources.tables import GRAPH_SQL, graph, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
c = F.col
PROD = "coalesce(NOT contains(lower(qualified_name), 'test'), false)"
big = lambda x: x.cast("bigint")


def on_graph(name: str, sql: str | None = None):
    def add(f: Callable[[PropertyGraph], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(graph(spark, sf_dir))
        if sql:
            SQL[name] = GRAPH_SQL + sql
        return f

    return add


def on_table(name: str, table: str, sql: str | None = None):
    def add(f: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(read(spark, sf_dir, table))
        if sql:
            SQL[name] = sql
        return f

    return add


def on_log(name: str, sql: str | None = None):
    def add(f: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(logs.from_events(spark, sf_dir))
        if sql:
            SQL[name] = LOG_SQL + sql
        return f

    return add


LOG_SQL = "WITH log AS (SELECT event_id, ts, user_id::VARCHAR AS repo, event_type AS cmd, (event_type = 'error')::INT AS return_code, value AS duration_ms, (json_extract_string(props, '$.k')::INT % 2 = 0) AS cached FROM events) "
SHAPE = "node_id, label, qualified_name, name, path"

# Scans ---------------------------------------------------------------------------------------------------------------


def scan(name: str, where_spark: str, where_sql: str | None = None, cols: str = SHAPE) -> None:
    on_graph(name, f"SELECT {cols} FROM nodes WHERE {where_sql or where_spark}")(lambda g: g.nodes.filter(where_spark).selectExpr(*cols.split(", ")))


scan("S03", "true")
on_graph("S04", "SELECT src, dst, type, version_spec FROM edges")(lambda g: g.edges)
scan("S05", "label = 'Module'")
scan("S06", "name = 'p10'")
scan("S07", "node_id = 30000000001")
on_graph("S08", "SELECT 'out' AS way, src, dst, type FROM edges WHERE src = 30000000001 UNION ALL SELECT 'in', src, dst, type FROM edges WHERE dst = 30000000001")(
    lambda g: g.edges.filter("src = 30000000001").select(F.lit("out").alias("way"), "src", "dst", "type").union(g.edges.filter("dst = 30000000001").select(F.lit("in"), "src", "dst", "type"))
)
on_table("S18", "documents", r"SELECT doc_id, CASE WHEN len(l) >= 2 THEN array_to_string(l[2:4], chr(10)) END AS lines FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)")(
    lambda d: d.select("doc_id", N.lines(c("text"), 2, 4).alias("lines"))
)
on_table("S19", "documents", "SELECT doc_id, i AS line_no, l[i] AS line, len(l)::BIGINT AS total FROM (SELECT doc_id, string_split(text, chr(10)) AS l, unnest([2, 3]) AS i FROM documents) WHERE i <= len(l)")(
    lambda d: d.select("doc_id", F.split("text", "\n").alias("l")).select("doc_id", F.posexplode("l"), big(F.size("l")).alias("total")).filter("pos BETWEEN 1 AND 2").select("doc_id", (c("pos") + 1).alias("line_no"), c("col").alias("line"), "total")
)

# Predicates ------------------------------------------------------------------------------------------------------------

on_graph("P02", "SELECT node_id, label AS first_label FROM nodes WHERE label IN ('Class', 'Method')")(lambda g: g.label("Class", "Method").select("node_id", F.element_at(F.array("label"), 1).alias("first_label")))
scan("P04", "label IN ('Function', 'Method')")
scan("P05", "label = 'Function' AND name = 'p7'")
scan("P06", "startswith(qualified_name, 'r1.n')", "starts_with(qualified_name, 'r1.n')")
scan("P07", "label = 'Function' AND contains(docstring, 'a')")
scan("P08", "contains(lower(docstring), 'red') OR lower(name) = 'test_p11'")
scan("P09", "path IS NULL AND qualified_name IS NOT NULL")
scan("P10", "array_contains(decorators, 'brand#11')", "list_contains(decorators, 'brand#11')")
scan("P11", "exists(decorators, d -> startswith(d, 'brand#1'))", "len(list_filter(decorators, lambda d: starts_with(d, 'brand#1'))) > 0")
scan("P12", "size(decorators) > 0", "len(decorators) > 0")
scan("P13", "label = 'Function'", cols="node_id, end_line - start_line AS span")
scan("P14", "label = 'Class' AND NOT (name IS NULL OR contains(name, '9'))")
on_graph("P15", "SELECT node_id, name FROM nodes WHERE node_id IN (40000000003, 40000000001, 30000000002)")(lambda g: g.nodes.filter(c("node_id").isin(40000000003, 40000000001, 30000000002)).select("node_id", "name").orderBy("name"))
on_graph("P16", f"SELECT node_id, {PROD} AS ok FROM nodes")(lambda g: g.nodes.select("node_id", production(c("qualified_name")).alias("ok")))
on_graph("P17", "SELECT node_id, split_part(qualified_name, '.', 1) AS module FROM nodes WHERE label = 'Method'")(lambda g: g.label("Method").select("node_id", module_of(c("qualified_name")).alias("module")))
on_graph("P18", "SELECT path FROM nodes WHERE label = 'File' AND NOT list_has_any(string_split(path, '/'), ['src1', 'src2', 'de'])")(
    lambda g: g.label("File").filter(~F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, ("src1", "src2", "de"))))).select("path")
)
for _s, _w in (("success", "return_code = 0"), ("failed", "return_code <> 0"), ("cached", "cached"), ("other", "false")):
    on_log(f"P19_{_s}", f"SELECT event_id, repo, cmd FROM log WHERE {_w} AND contains(repo, '1') AND regexp_matches(cmd, '^[a-m].*r')")(
        lambda d, s=_s: logs.by_status(d, s).filter(c("repo").contains("1") & c("cmd").rlike("^[a-m].*r")).select("event_id", "repo", "cmd")
    )
on_graph("P21", "SELECT node_id, CASE WHEN label IN ('Function','Method','Class') THEN 'code' WHEN label IN ('File','Module') THEN 'file' ELSE 'structural' END AS category FROM nodes")(
    lambda g: g.nodes.select("node_id", F.when(c("label").isin("Function", "Method", "Class"), "code").when(c("label").isin("File", "Module"), "file").otherwise("structural").alias("category"))
)

# Joins -----------------------------------------------------------------------------------------------------------------

NAMED = "SELECT s.name AS s_name, d.name AS d_name, e.src, e.dst FROM edges e JOIN nodes s ON s.node_id = e.src JOIN nodes d ON d.node_id = e.dst WHERE e.type = "
for _t in ("DEFINES", "DEFINES_METHOD", "CALLS", "IMPORTS", "INHERITS", "CONTAINS_MODULE", "DEPENDS_ON_EXTERNAL"):
    on_graph(f"J01_{_t.lower()}", NAMED + f"'{_t}'")(lambda g, t=_t: g.ends(t).select("s_name", "d_name", "src", "dst"))
TWO = "SELECT a.src AS package, a.dst AS module, b.dst AS function FROM edges a JOIN edges b ON a.dst = b.src WHERE a.type = 'CONTAINS_MODULE' AND b.type = 'DEFINES'"
on_graph("J02", TWO)(lambda g: g.of_type("CONTAINS_MODULE").select(c("src").alias("package"), c("dst").alias("module")).join(g.of_type("DEFINES").select(c("src").alias("module"), c("dst").alias("function")), "module"))


def module_calls(g: PropertyGraph) -> DataFrame:
    home = g.of_type("DEFINES").select(c("src").alias("m"), c("dst").alias("f"))
    return g.of_type("CALLS").join(home.select(c("m").alias("m1"), c("f").alias("src")), "src").join(home.select(c("m").alias("m2"), c("f").alias("dst")), "dst").select("m1", "src", "m2", "dst")


MODULE_CALLS = "SELECT a.src AS m1, c.src, b.src AS m2, c.dst FROM calls c JOIN edges a ON a.type = 'DEFINES' AND a.dst = c.src JOIN edges b ON b.type = 'DEFINES' AND b.dst = c.dst"
on_graph("J03", f"SELECT m1, src, dst FROM ({MODULE_CALLS})")(lambda g: module_calls(g).select("m1", "src", "dst"))
on_graph("J04", f"SELECT * FROM ({MODULE_CALLS}) WHERE m1 = 30000000001 AND m2 <> m1")(lambda g: module_calls(g).filter("m1 = 30000000001 AND m2 != m1"))
for _t in ("CALLS", "IMPORTS"):
    on_graph(f"J05_{_t.lower()}", f"SELECT x.src, x.dst FROM edges x JOIN edges y ON x.src = y.dst AND x.dst = y.src AND x.type = y.type WHERE x.type = '{_t}' AND x.src <> x.dst")(
        lambda g, t=_t: g.of_type(t).filter("src != dst").select("src", "dst").join(g.of_type(t).select(c("dst").alias("src"), c("src").alias("dst")), ["src", "dst"])
    )
on_graph("J06", "SELECT node_id FROM nodes WHERE label = 'Function' AND node_id NOT IN (SELECT src FROM calls) AND node_id NOT IN (SELECT dst FROM calls)")(
    lambda g: g.label("Function").select("node_id").join(g.of_type("CALLS").select(c("src").alias("node_id")), "node_id", "left_anti").join(g.of_type("CALLS").select(c("dst").alias("node_id")), "node_id", "left_anti")
)
on_graph("J07", "SELECT dst AS node_id FROM calls WHERE dst NOT IN (SELECT src FROM calls)")(lambda g: g.of_type("CALLS").select(c("dst").alias("node_id")).join(g.of_type("CALLS").select(c("src").alias("node_id")), "node_id", "left_anti"))
on_graph("J08", "SELECT e.other, e.type FROM (SELECT src, dst AS other, type FROM edges UNION ALL SELECT dst, src, type FROM edges) e WHERE e.src = 30000000003")(lambda g: g.undirected().filter("src = 30000000003").select(c("dst").alias("other"), "type"))
on_graph("J13", None)(lambda g: resolve.overrides(g))
SQL["J13"] = GRAPH_SQL + """, m AS (SELECT e.src AS cls, e.dst AS method, n.name FROM edges e JOIN nodes n ON n.node_id = e.dst WHERE e.type = 'DEFINES_METHOD'),
up AS (SELECT src AS cls, dst AS anc, 1 AS depth FROM edges WHERE type = 'INHERITS' UNION ALL SELECT up.cls, e.dst, depth + 1 FROM up JOIN edges e ON e.type = 'INHERITS' AND e.src = up.anc)
SELECT a.method AS src, arg_min(b.method, up.depth) AS dst, min(up.depth)::BIGINT AS depth FROM m a JOIN up ON up.cls = a.cls JOIN m b ON b.cls = up.anc AND b.name = a.name GROUP BY a.method"""


def inherited(g: PropertyGraph) -> DataFrame:
    """J14 for the name m1: each class's own or nearest inherited method."""
    methods = resolve.class_methods(g).filter("name = 'm1'")
    wanted = g.label("Class").select(c("node_id").alias("cls"), F.lit("m1").alias("name"))
    inherits = g.of_type("INHERITS").select(c("src").alias("child"), c("dst").alias("parent"), F.lit(0).alias("ord"))
    have = methods.unionByName(wanted.select("cls", "name", F.lit(None).cast("bigint").alias("method")))
    tree = paths.bfs(inherits.select(c("child").alias("src"), c("parent").alias("dst")), have.select(c("cls").alias("seed")).distinct(), 40)
    hit = tree.join(methods.select(c("cls").alias("node"), "method"), "node")
    return hit.groupBy(c("seed").alias("cls")).agg(F.min(F.struct("depth", "method")).alias("b")).select("cls", c("b.method").alias("method"), c("b.depth").alias("depth"))


on_graph("J14", """, m AS (SELECT e.src AS cls, e.dst AS method FROM edges e JOIN nodes n ON n.node_id = e.dst WHERE e.type = 'DEFINES_METHOD' AND n.name = 'm1'),
up AS (SELECT node_id AS cls, node_id AS anc, 0 AS depth FROM nodes WHERE label = 'Class' UNION ALL SELECT up.cls, e.dst, depth + 1 FROM up JOIN edges e ON e.type = 'INHERITS' AND e.src = up.anc)
SELECT up.cls, arg_min(m.method, up.depth) AS method, min(up.depth)::BIGINT AS depth FROM up JOIN m ON m.cls = up.anc GROUP BY up.cls""")(inherited)
on_graph("J17", "SELECT dst AS node_id, src AS module FROM edges WHERE type = 'DEFINES'")(lambda g: resolve.defining_module(g))
on_graph("J23", """SELECT DISTINCT a.src, a.dst AS middle, b.dst FROM calls a JOIN calls b ON a.dst = b.src JOIN nodes s ON s.node_id = a.src JOIN nodes d ON d.node_id = b.dst WHERE starts_with(s.qualified_name, 'r1.') AND starts_with(d.qualified_name, 'r2.')""")(
    lambda g: paths.walks(g.of_type("CALLS"), 2).join(g.nodes.filter(c("qualified_name").startswith("r1.")).select(c("node_id").alias("n0")), "n0").join(g.nodes.filter(c("qualified_name").startswith("r2.")).select(c("node_id").alias("n2")), "n2").select(c("n0").alias("src"), c("n1").alias("middle"), c("n2").alias("dst")).distinct()
)
LOCATED = "SELECT n.node_id, n.qualified_name, m.path, n.start_line, n.end_line FROM edges e JOIN nodes m ON m.node_id = e.src AND m.label = 'Module' JOIN nodes n ON n.node_id = e.dst WHERE e.type = 'DEFINES'"
located = lambda g: g.ends("DEFINES", src=("Module",)).select(c("d_node_id").alias("node_id"), c("d_qualified_name").alias("qualified_name"), c("s_path").alias("path"), c("d_start_line").alias("start_line"), c("d_end_line").alias("end_line"))
on_graph("J24", LOCATED)(located)
on_graph("J25", LOCATED + " AND n.label IN ('Function', 'Method')")(lambda g: located(g).orderBy("qualified_name"))


def hits_with_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = vector_hits(read(spark, sf_dir, "embeddings"), 50).select("vec_id", "score")
    return hits.join(graph(spark, sf_dir).label("Function").select((c("node_id") - 40000000000).alias("vec_id"), "qualified_name"), "vec_id").select("vec_id", "qualified_name", F.round("score", 3).alias("score"))


# Vectors ---------------------------------------------------------------------------------------------------------------


def vector_hits(e: DataFrame, k: int) -> DataFrame:
    """The k vectors most like vector 0."""
    query = e.filter("vec_id = 0").select(c("embedding").alias("q"))  # one row
    return e.crossJoin(F.broadcast(query)).withColumn("score", N.cosine(c("embedding"), c("q"))).filter("score IS NOT NULL").orderBy(F.desc(F.round("score", 9)), "vec_id").limit(k)


COSINE = "SELECT e.vec_id, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS score FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q"
on_table("O04", "embeddings", f"SELECT vec_id, round(score, 6) AS score FROM ({COSINE}) ORDER BY round(score, 9) DESC, vec_id LIMIT 20")(lambda e: vector_hits(e, 20).select("vec_id", F.round("score", 6).alias("score")))
QUERIES["J11"] = hits_with_nodes
SQL["J11"] = GRAPH_SQL + f"SELECT h.vec_id, n.qualified_name, round(h.score, 3) AS score FROM (SELECT * FROM ({COSINE}) ORDER BY round(score, 9) DESC, vec_id LIMIT 50) h JOIN nodes n ON n.label = 'Function' AND n.node_id = 40000000000 + h.vec_id"

# Paths -----------------------------------------------------------------------------------------------------------------

on_graph("T01", "SELECT a.src AS n0, a.dst AS n1, b.dst AS n2 FROM calls a JOIN calls b ON a.dst = b.src WHERE NOT (a.src = b.src AND a.dst = b.dst)")(lambda g: paths.walks(g.of_type("CALLS"), 2, "trail"))
on_graph("T02", """, u AS (SELECT src, dst, type, src AS a, dst AS b FROM edges WHERE type IN ('INHERITS', 'DEFINES_METHOD') UNION ALL SELECT dst, src, type, src, dst FROM edges WHERE type IN ('INHERITS', 'DEFINES_METHOD'))
SELECT x.dst AS related, 1::BIGINT AS hops FROM u x WHERE x.src = 50000000010 UNION ALL SELECT y.dst, 2 FROM u x JOIN u y ON x.dst = y.src AND NOT (x.a = y.a AND x.b = y.b AND x.type = y.type) WHERE x.src = 50000000010""")(
    lambda g: (lambda u: u.filter("src = 50000000010").select(c("dst").alias("related"), F.lit(1).cast("bigint").alias("hops")).union(
        u.filter("src = 50000000010").select(c("dst").alias("mid"), c("type").alias("t")).join(u.select(c("src").alias("mid"), "dst", "type"), "mid").filter("NOT (dst = 50000000010 AND t = type)").select("dst", F.lit(2).cast("bigint"))))(g.undirected("INHERITS", "DEFINES_METHOD"))
)
on_graph("T03", """, walk AS (SELECT [40000000001] AS path, 40000000001 AS node UNION ALL SELECT list_append(path, c.dst), c.dst FROM walk JOIN calls c ON c.src = walk.node WHERE len(path) <= 5 AND NOT list_contains(path, c.dst)),
goal AS (SELECT max(dst) AS g FROM (SELECT b.dst FROM calls a JOIN calls b ON a.dst = b.src WHERE a.src = 40000000001))
SELECT array_to_string(path, ',') AS path, (len(path) - 1)::BIGINT AS hops FROM walk, goal WHERE node = g ORDER BY len(path), walk.path LIMIT 1""")(
    lambda g: (lambda e: paths.shortest_path(e, 40000000001, (paths.walks(e, 2).filter("n0 = 40000000001").agg(F.max("n2")).first()[0] or -1)))(g.of_type("CALLS"))
)
on_graph("T04", """, gone AS (SELECT 30000000001 AS n UNION SELECT e.dst FROM gone JOIN edges e ON e.src = gone.n AND e.type IN ('DEFINES', 'DEFINES_METHOD')) SELECT node_id FROM nodes WHERE node_id NOT IN (SELECT n FROM gone)""")(
    lambda g: paths.closure_delete(g, g.nodes.filter("node_id = 30000000001").select(c("node_id").alias("seed"))).nodes.select("node_id")
)
SIMPLE = """, prod AS (SELECT node_id, {prod} AS ok, split_part(qualified_name, '.', 1) AS module FROM nodes),
g AS (SELECT src, dst FROM edges WHERE type = '{kind}'),
p AS (SELECT [n.node_id] AS path FROM nodes n JOIN prod USING (node_id) WHERE n.label IN ({labels}) AND ok UNION ALL SELECT list_append(path, g.dst) FROM p JOIN g ON g.src = p.path[-1] WHERE len(path) <= {most} AND NOT list_contains(path, g.dst)),
mx AS (SELECT path FROM p WHERE len(path) = {most} + 1 OR NOT EXISTS (SELECT 1 FROM g WHERE g.src = p.path[-1] AND NOT list_contains(p.path, g.dst)))
SELECT array_to_string(path, ',') AS path, (len(path) - 1)::BIGINT AS hops, count(*) AS ways FROM (SELECT path, unnest(path) AS node_id FROM mx WHERE len(path) > {least}) JOIN prod USING (node_id) GROUP BY path HAVING bool_and(ok) AND count(DISTINCT module) >= {mods}"""
on_graph("T05", SIMPLE.format(prod=PROD, kind="CALLS", labels="'Function', 'Method'", most=4, least=3, mods=2).replace("count(*) AS ways", "1::BIGINT AS ways"))(lambda g: paths.chains(g, "CALLS", ("Function", "Method"), 3, 4, 2))


def fixed_sql(hops: int) -> str:
    ks = range(hops + 1)
    joins = " ".join(f"JOIN calls c{i} ON c{i}.src = c{i - 1}.dst" for i in range(1, hops))
    ends = ["c0.src", *[f"c{i}.dst" for i in range(hops)]]
    named = " ".join(f"JOIN pn p{i} ON p{i}.node_id = {ends[i]}" for i in ks)
    return f", pn AS (SELECT node_id, name, split_part(qualified_name, '.', 1) AS module FROM nodes WHERE {PROD}) SELECT {', '.join(f'{ends[i]} AS n{i}' for i in ks)} FROM calls c0 {joins} {named} WHERE len(list_distinct([{', '.join(f'p{i}.name' for i in ks)}])) = {hops + 1} AND len(list_distinct([{', '.join(f'p{i}.module' for i in ks)}])) >= 2"


on_graph("T07", fixed_sql(3))(lambda g: paths.fixed_chains(g, 3))
on_graph("T08", fixed_sql(4))(lambda g: paths.fixed_chains(g, 4))
seeds = lambda g, label, n: g.label(label).filter(c("node_id") % n == 0).select(c("node_id").alias("seed"))
REACH = ", s AS (SELECT node_id AS seed FROM nodes WHERE label = '{label}' AND node_id % {n} = 0), g AS ({g}), r AS (SELECT seed, seed AS node, 0 AS depth FROM s UNION SELECT r.seed, g.dst, r.depth + 1 FROM r JOIN g ON g.src = r.node WHERE r.depth < {d}) SELECT seed, node, min(depth)::BIGINT AS depth FROM r GROUP BY seed, node"
BOTH = "SELECT src, dst FROM edges WHERE type IN ({t}) UNION ALL SELECT dst, src FROM edges WHERE type IN ({t})"

# Aggregates -------------------------------------------------------------------------------------------------------------

on_graph("A01", "SELECT label, count(*) AS n FROM nodes GROUP BY label")(lambda g: g.nodes.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label"))
on_graph("A02", "SELECT type, count(*) AS n FROM edges GROUP BY type")(lambda g: g.edges.groupBy("type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "type"))
on_graph("A03", "SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges")(lambda g: g.nodes.agg(F.count("*").alias("nodes")).crossJoin(g.edges.agg(F.count("*").alias("edges"))))
on_graph("A04", "SELECT e.src, string_agg(n.name, ',' ORDER BY n.name) AS names FROM edges e JOIN nodes n ON n.node_id = e.dst WHERE e.type = 'DEFINES_METHOD' GROUP BY e.src")(
    lambda g: g.ends("DEFINES_METHOD").groupBy("src").agg(F.array_join(F.array_sort(F.collect_list("d_name")), ",").alias("names"))
)


def top(name: str, kind: str, end: str, k: int = 20, least: int = 0) -> None:
    sql = f"SELECT {end} AS node_id, n.name, count(*) AS n FROM edges e JOIN nodes n ON n.node_id = e.{end} WHERE e.type = '{kind}' GROUP BY {end}, n.name HAVING count(*) > {least} ORDER BY n DESC, node_id LIMIT {k}"

    def run(g: PropertyGraph) -> DataFrame:
        # The few winners are joined to their names, not all nodes.
        best = g.of_type(kind).groupBy(c(end).alias("node_id")).agg(F.count("*").alias("n")).filter(c("n") > least).orderBy(F.desc("n"), "node_id").limit(k)
        return best.join(g.nodes.select("node_id", "name"), "node_id").select("node_id", "name", "n")

    on_graph(name, sql)(run)


top("A05", "DEFINES_METHOD", "src")
top("A06", "CALLS", "dst")
top("A07", "CALLS", "src")
top("A08", "IMPORTS", "src")
top("A10", "CALLS", "dst", 1 << 30, 5)
on_graph("P20", SQL["A10"][len(GRAPH_SQL) :])(lambda g: g.ends("CALLS").groupBy(c("dst").alias("node_id"), c("d_name").alias("name")).agg(F.count("*").alias("n")).filter("n > 5"))
on_graph("A09", "SELECT node_id, count(*) AS n FROM (SELECT src AS node_id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY node_id ORDER BY n DESC, node_id LIMIT 20")(
    lambda g: g.undirected().groupBy(c("src").alias("node_id")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "node_id").limit(20)
)
on_graph("A11", "SELECT 'node' AS what, label AS kind, count(*) AS n FROM nodes GROUP BY label UNION ALL SELECT 'edge', type, count(*) FROM edges GROUP BY type")(
    lambda g: g.nodes.groupBy(c("label").alias("kind")).agg(F.count("*").alias("n")).select(F.lit("node").alias("what"), "kind", "n").union(g.edges.groupBy("type").agg(F.count("*")).select(F.lit("edge"), "type", "count(1)"))
)


def bridges(g: PropertyGraph, least: int = 2) -> DataFrame:
    n = g.label("Function", "Method").filter(production(c("qualified_name"))).select("node_id", module_of(c("qualified_name"), depth=2).alias("module"))
    e = g.of_type("CALLS").join(n.select(c("node_id").alias("src"), c("module")), "src").join(n.select(c("node_id").alias("dst")), "dst", "left_semi")
    return e.groupBy(c("dst").alias("node_id")).agg(F.count_distinct("module").alias("modules")).filter(c("modules") >= least)


on_graph("A12", f", p AS (SELECT node_id, regexp_extract(qualified_name, '^[^.]*\\.[^.]*') AS module FROM fm WHERE {PROD}) SELECT dst AS node_id, count(DISTINCT p.module) AS modules FROM calls JOIN p ON p.node_id = src WHERE dst IN (SELECT node_id FROM p) GROUP BY dst HAVING count(DISTINCT p.module) >= 2")(bridges)


def hubs(g: PropertyGraph) -> DataFrame:
    n = g.label("Function", "Method").filter(production(c("qualified_name"))).select("node_id")
    e = g.of_type("CALLS").join(n.select(c("node_id").alias("src")), "src", "left_semi").join(n.select(c("node_id").alias("dst")), "dst", "left_semi")
    return PropertyGraph(g.nodes, e).degrees().filter("n_in >= 3 AND n_out >= 3").orderBy(F.desc(c("n_in") + c("n_out")), F.desc("n_in"), F.desc("node_id")).limit(10)


on_graph("A13", f", p AS (SELECT node_id FROM fm WHERE {PROD}), e AS (SELECT * FROM calls WHERE src IN (SELECT * FROM p) AND dst IN (SELECT * FROM p)) SELECT node_id, i AS n_in, o AS n_out FROM (SELECT dst AS node_id, count(*) AS i FROM e GROUP BY dst) JOIN (SELECT src AS node_id, count(*) AS o FROM e GROUP BY src) USING (node_id) WHERE i >= 3 AND o >= 3 ORDER BY i + o DESC, i DESC, node_id DESC LIMIT 10")(hubs)
on_graph("A15", f"SELECT dst AS parent, string_agg(src::VARCHAR, ',' ORDER BY src) AS children FROM edges JOIN nodes ON node_id = src WHERE type = 'INHERITS' AND {PROD} GROUP BY dst")(
    lambda g: g.ends("INHERITS").filter(production(c("s_qualified_name"))).groupBy(c("dst").alias("parent")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("src")), lambda x: x.cast("string")), ",").alias("children"))
)
on_graph("A18", None)(lambda g: (lambda p: resolve.overrides(g).join(p.withColumnRenamed("node_id", "src"), "src", "left_semi").join(p.withColumnRenamed("node_id", "dst"), "dst", "left_semi").select("src", "dst"))(g.label("Method").filter(production(c("qualified_name"))).select("node_id")))
SQL["A18"] = SQL["J13"].replace("SELECT a.method AS src, arg_min(b.method, up.depth) AS dst, min(up.depth)::BIGINT AS depth", "SELECT a.method AS src, arg_min(b.method, up.depth) AS dst")
on_graph("A19", """, m AS (SELECT e.src AS cls, string_agg(n.name, ',' ORDER BY n.name) AS ms FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dst) AS k FROM edges WHERE type = 'DEFINES_METHOD') e JOIN nodes n ON n.node_id = e.dst WHERE k <= 5 GROUP BY e.src)
SELECT e.src AS child, e.dst AS parent, coalesce(a.ms, '') AS child_methods, coalesce(b.ms, '') AS parent_methods FROM edges e LEFT JOIN m a ON a.cls = e.src LEFT JOIN m b ON b.cls = e.dst WHERE e.type = 'INHERITS'""")(
    lambda g: (lambda m: g.of_type("INHERITS").select(c("src").alias("child"), c("dst").alias("parent")).join(m.select(c("cls").alias("child"), c("ms").alias("child_methods")), "child", "left").join(m.select(c("cls").alias("parent"), c("ms").alias("parent_methods")), "parent", "left").fillna(""))(
        resolve.class_methods(g).withColumn("k", F.row_number().over(Window.partitionBy("cls").orderBy("method"))).filter("k <= 5").groupBy("cls").agg(F.array_join(F.array_sort(F.collect_list("name")), ",").alias("ms"))
    ).select("child", "parent", "child_methods", "parent_methods")
)
on_graph("A20", "SELECT s.name AS project, d.name AS package, e.version_spec FROM edges e JOIN nodes s ON s.node_id = e.src JOIN nodes d ON d.node_id = e.dst WHERE e.type = 'DEPENDS_ON_EXTERNAL'")(lambda g: g.ends("DEPENDS_ON_EXTERNAL").select(c("s_name").alias("project"), c("d_name").alias("package"), "version_spec"))
COUNTS = "count(*) AS total, count(*) FILTER (return_code = 0) AS success, count(*) FILTER (return_code <> 0) AS failed, count(*) FILTER (cached) AS cached, round(coalesce(avg(duration_ms) FILTER (NOT cached), 0), 6) AS avg_ms"
rounded = lambda d: d.withColumn("avg_ms", F.round("avg_ms", 6))
on_log("A21", f"SELECT {COUNTS}, count(DISTINCT repo) AS repos, count(DISTINCT cmd) AS cmds FROM log")(lambda d: rounded(logs.summary(d)))
on_log("A21_slowest", "SELECT event_id, cmd, duration_ms FROM log WHERE NOT cached ORDER BY duration_ms DESC, event_id LIMIT 5")(lambda d: d.filter(~c("cached")).orderBy(F.desc("duration_ms"), "event_id").limit(5).select("event_id", "cmd", "duration_ms"))
on_log("A23", f"SELECT cmd AS prefix, {COUNTS}, count(*) FILTER (return_code <> 0) / count(*) AS failure_rate FROM log GROUP BY cmd")(lambda d: rounded(logs.by_prefix(d)))
on_table("A28", "documents", "SELECT lang, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS share FROM documents GROUP BY lang")(
    lambda d: d.groupBy("lang").agg(F.count("*").alias("n")).select("lang", "n", F.round(100.0 * c("n") / F.sum("n").over(Window.partitionBy()), 4).alias("share"))
)
on_log("A29", "SELECT cmd AS reason, count(*) AS n FROM log WHERE return_code <> 0 GROUP BY cmd")(lambda d: logs.by_status(d, "failed").groupBy(c("cmd").alias("reason")).agg(F.count("*").alias("n")))
on_log("W09", "SELECT event_id, repo, round(avg(duration_ms) OVER (PARTITION BY repo ORDER BY event_id ROWS 9 PRECEDING), 6) AS moving_ms FROM log")(lambda d: logs.moving_rate(d).withColumn("moving_ms", F.round("moving_ms", 6)))

# Ranking and samples ----------------------------------------------------------------------------------------------------

on_graph("O03", "SELECT node_id, end_line - start_line AS span FROM nodes WHERE label = 'Function' ORDER BY span DESC, node_id LIMIT 20")(lambda g: g.label("Function").select("node_id", (c("end_line") - c("start_line")).alias("span")).orderBy(F.desc("span"), "node_id").limit(20))
SCORES = ", r AS (SELECT node_id, count(*) AS all_rels, count(*) FILTER (type = 'CALLS') AS calls FROM (SELECT src AS node_id, type FROM edges UNION ALL SELECT dst, type FROM edges) GROUP BY node_id), sc AS (SELECT node_id, coalesce(calls, 0) AS calls, coalesce(all_rels, 0) AS all_rels, greatest(coalesce(end_line, 0) - coalesce(start_line, 0), 0) AS span, docstring FROM fm LEFT JOIN r USING (node_id)), o5 AS (SELECT node_id, calls, all_rels, (10 * calls + 2 * all_rels + least(span, 50) + CASE WHEN length(docstring) > 0 THEN 5 ELSE 0 END)::BIGINT AS score FROM sc WHERE all_rels >= 3 OR span >= 10) "
on_graph("O05", SCORES + "SELECT * FROM o5")(lambda g: sampling.seed_scores(g))
on_graph("O06", """, e2 AS (SELECT src AS node_id, type, 'out' AS way FROM edges UNION ALL SELECT dst, type, 'in' FROM edges),
k AS (SELECT node_id, count(*) FILTER (type = 'CALLS') AS calls, count(*) FILTER (way = 'in' AND type IN ('DEFINES', 'DEFINES_METHOD')) AS defd, count(*) FILTER (type = 'INHERITS') AS inh, count(*) FILTER (way = 'out' AND type = 'DEFINES_METHOD') AS mm, count(*) FILTER (type = 'IMPORTS') AS imp, count(*) FILTER (way = 'out' AND type = 'DEFINES') AS def FROM e2 GROUP BY node_id)
SELECT node_id, total, best FROM (SELECT node_id, CASE WHEN label IN ('Function', 'Method') THEN calls + defd WHEN label = 'Class' THEN inh + mm ELSE imp + def END AS total, CASE WHEN label = 'Class' THEN 'INHERITS' WHEN label = 'Module' THEN 'IMPORTS' WHEN calls >= defd THEN 'CALLS' ELSE 'DEFINES' END AS best FROM nodes JOIN k USING (node_id) WHERE label IN ('Function', 'Method', 'Class', 'Module')) WHERE total > 0""")(lambda g: sampling.sparse_seeds(g))
on_graph("O07", SCORES + "SELECT node_id, score FROM (SELECT node_id, score, ln((('0x'||substr(md5(node_id::VARCHAR||'w'), 1, 12))::BIGINT + 1)::DOUBLE / 281474976710657.0) / score AS k FROM o5) ORDER BY k DESC, node_id LIMIT 30")(lambda g: sampling.weighted_sample(sampling.seed_scores(g), "node_id", "score", 30, "w").select("node_id", "score"))
on_graph("O08", "SELECT node_id FROM nodes WHERE label = 'Function' ORDER BY md5(node_id::VARCHAR||'u'), node_id LIMIT 25")(lambda g: g.label("Function").select("node_id").orderBy(sampling.hash_order(c("node_id"), "u"), "node_id").limit(25))
on_graph("O09", "SELECT node_id AS seed, s AS strategy, t::BIGINT AS turn FROM (SELECT node_id FROM nodes WHERE label = 'Module'), (VALUES ('callees', 3), ('chain', 2), ('file', 2), ('callers', 2), ('bfs', 1)) v(s, w), (SELECT unnest(range(1, 6)) AS t) WHERE t <= w")(
    lambda g: sampling.round_robin(g.label("Module").select(c("node_id").alias("seed")), {"callees": 3, "chain": 2, "file": 2, "callers": 2, "bfs": 1})
)
on_log("O10", "SELECT event_id, cmd FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS k FROM log) WHERE k = 8")(lambda d: d.orderBy("event_id").limit(8).orderBy(F.desc("event_id")).limit(1).select("event_id", "cmd"))
on_graph("W06", "SELECT src, min(dst) AS dst FROM calls GROUP BY src")(lambda g: g.of_type("CALLS").groupBy("src").agg(F.min("dst").alias("dst")))
on_graph("W04", "SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS k FROM calls) WHERE k <= 4")(lambda g: g.of_type("CALLS").select("src", "dst", F.row_number().over(Window.partitionBy("src").orderBy("dst")).alias("k")).filter("k <= 4").select("src", "dst"))
on_graph("W07", "SELECT node_id, row_number() OVER (ORDER BY node_id) - 1 AS seq FROM nodes")(lambda g: sampling.numbered(g.nodes.select("node_id"), ["node_id"], "seq", ""))
on_table("W08", "documents", "SELECT doc_id, printf('prompt_%04d', row_number() OVER (ORDER BY doc_id) - 1) AS prompt FROM documents")(lambda d: sampling.numbered(d.select("doc_id"), ["doc_id"], "prompt"))

# Sets --------------------------------------------------------------------------------------------------------------------

CALLERS, CALLEES = "SELECT src AS node_id FROM calls", "SELECT dst FROM calls"
ends_of = lambda g: (g.of_type("CALLS").select(c("src").alias("node_id")), g.of_type("CALLS").select(c("dst").alias("node_id")))
for _n, _op, _f in (("X01", "UNION ALL", lambda a, b: a.union(b)), ("X02", "UNION", lambda a, b: a.union(b).distinct()), ("X03", "EXCEPT", lambda a, b: a.distinct().join(b, "node_id", "left_anti")), ("X06", "INTERSECT", lambda a, b: a.distinct().join(b, "node_id", "left_semi"))):
    on_graph(_n, f"{CALLERS} {_op} {CALLEES}")(lambda g, f=_f: f(*ends_of(g)))
on_table("X04", "pages", "SELECT url, min(page_id) AS page_id FROM pages GROUP BY url")(lambda p: p.groupBy("url").agg(F.min("page_id").alias("page_id")))
on_graph("X05", "SELECT qualified_name FROM nodes WHERE qualified_name IS NOT NULL AND NOT (qualified_name = 'r1.n1' OR starts_with(qualified_name, 'r1.n1.'))")(lambda g: g.nodes.filter("qualified_name IS NOT NULL").filter(~N.has_prefix(c("qualified_name"), "r1.n1")).select("qualified_name"))
on_graph("X07", "SELECT DISTINCT name FROM nodes WHERE label = 'Method'")(lambda g: g.label("Method").select("name").distinct())

# Functions ---------------------------------------------------------------------------------------------------------------

on_graph("F02", "SELECT node_id, string_split(qualified_name, '.')[-1] AS last, CASE WHEN contains(qualified_name, '.') THEN regexp_replace(qualified_name, '\\.[^.]*$', '') ELSE '' END AS parent FROM nodes WHERE qualified_name IS NOT NULL")(
    lambda g: g.nodes.filter("qualified_name IS NOT NULL").select("node_id", N.last_part(c("qualified_name")).alias("last"), N.parent_part(c("qualified_name")).alias("parent"))
)
PREFIX = "(qualified_name = 'r1.n1' OR starts_with(qualified_name, 'r1.n1.'))"
on_graph("F03", f"SELECT qualified_name FROM nodes WHERE {PREFIX}")(lambda g: g.nodes.filter(N.has_prefix(c("qualified_name"), "r1.n1")).select("qualified_name"))
on_graph("F04", "SELECT qualified_name FROM nodes WHERE qualified_name = 'm3' OR ends_with(qualified_name, '.m3')")(lambda g: g.nodes.filter(N.has_suffix(c("qualified_name"), "m3")).select("qualified_name"))
on_graph("F05", f"SELECT qualified_name FROM nodes WHERE {PREFIX} AND ends_with(qualified_name, '.m3')")(lambda g: g.nodes.filter(N.has_prefix(c("qualified_name"), "r1.n1") & N.has_suffix(c("qualified_name"), "m3")).select("qualified_name"))
on_graph("F10", "SELECT node_id, replace(regexp_replace(path, '\\.[^./]*$', ''), '/', '.') AS module FROM nodes WHERE path IS NOT NULL")(lambda g: g.nodes.filter("path IS NOT NULL").select("node_id", N.path_to_module(c("path")).alias("module")))
on_graph("F07", """SELECT c.src, c.dst, (greatest(len(a), len(b)) - (CASE WHEN a[1] <> b[1] THEN 0 WHEN a[2] <> b[2] THEN 1 WHEN a[3] <> b[3] THEN 2 ELSE 3 END) - (CASE WHEN a[1] = b[1] AND a[2] = b[2] THEN 1 ELSE 0 END))::BIGINT AS distance FROM calls c JOIN (SELECT node_id, string_split(qualified_name, '.') AS a FROM nodes) x ON x.node_id = c.dst JOIN (SELECT node_id, string_split(qualified_name, '.')[1:3] AS b FROM nodes) y ON y.node_id = c.src""")(
    lambda g: g.ends("CALLS").select("src", "dst", N.import_distance(c("d_qualified_name"), N.parent_part(c("s_qualified_name"))).alias("distance"))
)
on_log("F19", "SELECT event_id, sha256(repo||':'||cmd) AS key FROM log")(lambda d: d.select("event_id", N.cache_key(c("repo"), c("cmd")).alias("key")))
on_table("F21", "documents", "SELECT doc_id, CASE WHEN len(l) <= 3 THEN text ELSE array_to_string(l[1:3], chr(10))||chr(10)||'... ('||(len(l) - 3)||' more lines)' END AS code FROM (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents)")(lambda d: d.select("doc_id", N.truncated(c("text"), 3).alias("code")))
on_table("F22", "documents", "SELECT doc_id, length(text) // 4 AS tokens FROM documents")(lambda d: d.select("doc_id", F.floor(F.length("text") / 4).alias("tokens")))
on_graph("F23", "SELECT hops, mods, CASE WHEN hops + mods <= 3 THEN 'easy' WHEN hops + mods <= 5 THEN 'medium' WHEN hops + mods <= 7 THEN 'hard' ELSE 'expert' END AS difficulty FROM (SELECT unnest(range(1, 6)) AS hops), (SELECT unnest(range(1, 5)) AS mods)")(
    lambda g: g.nodes.sparkSession.range(1, 6).select(c("id").alias("hops"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(4).cast("bigint"))).alias("mods")).withColumn("difficulty", N.difficulty(c("hops"), c("mods")))
)
# Streaming, as batch over the same rows ------------------------------------------------------------------------------------

on_log("K11", "SELECT repo||':'||cmd AS key, max(event_id) AS event_id FROM log GROUP BY 1")(lambda d: logs.latest(d.select(F.concat_ws(":", "repo", "cmd").alias("key"), "event_id", c("event_id").alias("seq")), "key", "seq").select("key", "event_id"))
on_log("J20", "SELECT event_id FROM log WHERE repo||':'||cmd NOT IN (SELECT repo||':'||cmd FROM log WHERE cached)")(
    lambda d: (lambda k: logs.with_cache(k, k.filter("cached").select("key").distinct())[1].select("event_id"))(d.withColumn("key", F.concat_ws(":", "repo", "cmd")))
)
on_graph("K04", "SELECT label, qualified_name AS key, count(*) AS n FROM nodes WHERE label IN ('Class', 'Function', 'Method', 'Module', 'Package') GROUP BY 1, 2 HAVING count(*) > 1")(lambda g: g.label("Class", "Function", "Method", "Module", "Package").groupBy("label", c("qualified_name").alias("key")).agg(F.count("*").alias("n")).filter("n > 1"))

# Further rows ------------------------------------------------------------------------------------------------------------

scan("P01", "label = 'Function'", cols="name, qualified_name")
on_graph("P03", "SELECT e.src, e.type, n.name FROM edges e JOIN nodes n ON n.node_id = e.src")(lambda g: g.edges.join(g.nodes.select(c("node_id").alias("src"), "name"), "src").select("src", "type", "name"))
scan("F01", "contains(lower(name), 'p1') AND startswith(qualified_name, 'r')", "contains(lower(name), 'p1') AND starts_with(qualified_name, 'r')")
on_graph("F06", "SELECT node_id, string_split_regex(qualified_name, '[.:]')[-1] AS target FROM nodes WHERE qualified_name IS NOT NULL")(lambda g: g.nodes.filter("qualified_name IS NOT NULL").select("node_id", N.call_target(c("qualified_name")).alias("target")))
on_graph("F08", "SELECT node_id, CASE WHEN p = k THEN 100 WHEN ends_with(p, k) OR ends_with(k, p) THEN 90 WHEN contains(p, k) THEN floor(80 * length(k) / length(p)) ELSE 0 END::BIGINT AS score FROM (SELECT node_id, lower(qualified_name) AS p, lower(name) AS k FROM nodes WHERE qualified_name IS NOT NULL)")(
    lambda g: g.nodes.filter("qualified_name IS NOT NULL").select("node_id", N.match_score(F.lower("qualified_name"), F.lower("name")).alias("score"))
)
on_graph("F13", "SELECT src, dst, 'size' AS name, substr(version_spec, 5) AS spec FROM edges WHERE version_spec IS NOT NULL")(
    lambda g: g.edges.filter("version_spec IS NOT NULL").select("src", "dst", N.requirement_name(c("version_spec")).alias("name"), N.requirement_spec(c("version_spec")).alias("spec"))
)
for _n, _p in (("F24", 3), ("F25", 6)):
    on_table(_n, "embeddings", f"SELECT vec_id, CASE WHEN round(score, {_p}) = 0 THEN 0.0 ELSE round(score, {_p}) END AS score FROM ({COSINE})")(
        lambda e, p=_p: e.crossJoin(F.broadcast(e.filter("vec_id = 0").select(c("embedding").alias("q")))).select("vec_id", F.round(N.cosine(c("embedding"), c("q")), p).alias("score"))  # one row
    )
on_log("F26", "SELECT event_id, 'Look at '||repo||'.' AS line FROM log")(lambda d: d.select("event_id", N.filled(F.lit("Look at ${REPO_NAME}."), REPO_NAME=c("repo")).alias("line")))
on_log("F34", "SELECT event_id, CASE WHEN s < 60 THEN s||'s' WHEN s < 3600 THEN (s // 60)||'m '||(s % 60)||'s' ELSE (s // 3600)||'h '||(s % 3600 // 60)||'m' END AS took FROM (SELECT event_id, event_id AS s FROM log)")(
    lambda d: d.select("event_id", N.duration(c("event_id")).alias("took"))
)
on_graph("O01", "SELECT src, count(*) AS n FROM calls GROUP BY src ORDER BY n DESC, src LIMIT 10")(lambda g: g.of_type("CALLS").groupBy("src").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "src").limit(10))
on_graph("O02", "SELECT node_id FROM nodes WHERE label = 'Function' ORDER BY node_id LIMIT 50")(lambda g: g.label("Function").select("node_id").orderBy("node_id").limit(50))
on_log("K01", "SELECT repo AS key, cmd AS k, arg_max(event_id::VARCHAR, event_id) AS v FROM log GROUP BY repo, cmd")(
    lambda d: sinks.merged_nodes(d.select(F.lit("Function").alias("label"), c("repo").alias("key"), F.create_map("cmd", c("event_id").cast("string")).alias("props"), c("event_id").alias("seq"))).select("key", F.explode("props").alias("k", "v"))
)


def edge_specs(g: PropertyGraph) -> tuple[DataFrame, DataFrame]:
    """Calls by qualified names, every fifth to a function that is not there, and the functions by key."""
    gone = F.when(c("dst") % 5 == 0, F.concat(F.lit("gone."), "d_qualified_name")).otherwise(c("d_qualified_name"))
    label = F.lit("Function")
    specs = g.ends("CALLS").select(label.alias("from_label"), c("s_qualified_name").alias("from_key"), "type", label.alias("to_label"), gone.alias("to_key"))
    return specs, g.label("Function").select("node_id", "label", c("qualified_name").alias("key"))


def failed_calls(g: PropertyGraph) -> DataFrame:
    specs, nodes = edge_specs(g)
    return sinks.failed_report(specs, sinks.resolved_edges(specs, nodes)[1])


for _n in ("K02", "J10"):
    on_graph(_n, "SELECT src, dst, type FROM edges WHERE type = 'CALLS' AND dst % 5 <> 0")(lambda g: sinks.resolved_edges(*edge_specs(g))[0])
on_graph("K03", "SELECT 'CALLS' AS type, count(*) AS attempted, count(*) FILTER (dst % 5 = 0) AS failed FROM calls")(failed_calls)
on_log("K06", "SELECT row_number() OVER (ORDER BY min(event_id)) - 1 AS node_id, 'Function' AS label, repo AS key, arg_min(cmd, event_id) AS cmd FROM log GROUP BY repo")(
    lambda d: sinks.first_nodes(d.select(F.lit("Function").alias("label"), c("repo").alias("key"), F.create_map(F.lit("cmd"), "cmd").alias("props"), c("event_id").alias("seq"))).select("node_id", "label", "key", c("props")["cmd"].alias("cmd"))
)

from plexus import catalog_code, catalog_languages, catalog_names, catalog_sources, catalog_whole  # noqa: E402, F401
