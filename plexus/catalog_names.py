"""Registered queries on name resolution, expansions and rendered contexts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.catalog import GRAPH_SQL, QUERIES, SQL, big, c, on_graph
from plexus.operators import paths, render, resolve
from plexus.plans.graph import PropertyGraph
from plexus.sources.tables import read

# Names -----------------------------------------------------------------------------------------------------------------

#: Every module asks for one method by its simple name.
ASKED = "asked AS (SELECT node_id AS id, 'o.m'||(node_id % 7) AS call_name, qualified_name AS module_qn FROM nodes WHERE label = 'Module')"


def nearest_methods(g: PropertyGraph) -> DataFrame:
    asked = g.label("Module").select(c("node_id").alias("id"), F.concat(F.lit("o.m"), (c("node_id") % 7).cast("string")).alias("call_name"), c("qualified_name").alias("module_qn"))
    return resolve.by_simple_name(asked, g.label("Method").select("qualified_name", c("name").alias("simple_name")))


NEAREST = f""", {ASKED}, d AS (SELECT id, qualified_name, string_split(qualified_name, '.') AS a, string_split(module_qn, '.') AS b FROM asked JOIN nodes ON label = 'Method' AND name = string_split(call_name, '.')[2]),
e AS (SELECT id, qualified_name, greatest(len(a), len(b)) - CASE WHEN a[1] <> b[1] THEN 0 WHEN a[2] <> b[2] THEN 1 WHEN a[3] <> b[3] THEN 2 ELSE 3 END - CASE WHEN a[1] = b[1] AND a[2] = b[2] THEN 1 ELSE 0 END AS distance FROM d)
SELECT id, qualified_name AS callee, distance::BIGINT AS distance FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, qualified_name) AS k FROM e) WHERE k = 1"""
for _n in ("J15", "W02"):
    on_graph(_n, NEAREST)(nearest_methods)

#: Every module uses one class; a fifth of them import it from outside.
USES = ", uses AS (SELECT 30000000000 + s_suppkey AS id, qn AS module_qn, 'c'||(s_suppkey * 3) AS class_name, s_suppkey % 5 = 0 AS imports FROM mods)"


def uses(g: PropertyGraph) -> tuple[DataFrame, DataFrame]:
    k = c("node_id") - 30000000000
    u = g.label("Module").select(c("node_id").alias("id"), c("qualified_name").alias("module_qn"), F.concat(F.lit("c"), (k * 3).cast("string")).alias("class_name"), F.lit("m1").alias("name"))
    return u, u.filter(c("id") % 5 == 0).select("module_qn", c("class_name").alias("local_name"), F.concat(F.lit("ext."), "class_name").alias("full_name"))


def class_names(g: PropertyGraph) -> DataFrame:
    u, imports = uses(g)
    return resolve.class_names(u, imports, g.label("Class").select("qualified_name"))


CLASS_NAMES = USES + """, hit AS (SELECT id, 'ext.'||class_name AS qn, 0 AS step FROM uses WHERE imports
UNION ALL SELECT id, qualified_name, len(string_split(module_qn, '.')) - len(string_split(qualified_name, '.')) + 2 FROM uses JOIN nodes ON label = 'Class' AND starts_with(module_qn||'.', regexp_replace(qualified_name, '[^.]*$', '')) AND ends_with(qualified_name, '.'||class_name)
UNION ALL SELECT id, min(qualified_name), 1000 FROM uses JOIN nodes ON label = 'Class' AND ends_with(qualified_name, '.'||class_name) GROUP BY id),
named AS (SELECT id, arg_min(qn, step) AS class_qn, min(step)::BIGINT AS step FROM hit GROUP BY id)"""
on_graph("J16", CLASS_NAMES + " SELECT id, class_qn, step FROM named")(class_names)
on_graph("J22", CLASS_NAMES + """, m AS (SELECT e.src AS cls, e.dst AS method FROM edges e JOIN nodes n ON n.node_id = e.dst WHERE e.type = 'DEFINES_METHOD' AND n.name = 'm1'),
st AS (SELECT id, node_id AS cls FROM named JOIN nodes ON label = 'Class' AND qualified_name = class_qn),
up AS (SELECT id, cls, cls AS anc, 0 AS depth FROM st UNION ALL SELECT up.id, up.cls, e.dst, depth + 1 FROM up JOIN edges e ON e.type = 'INHERITS' AND e.src = up.anc)
SELECT id, up.cls, arg_min(m.method, up.depth) AS method, min(up.depth)::BIGINT AS depth FROM up JOIN m ON m.cls = up.anc GROUP BY id, up.cls""")(lambda g: resolve.typed_methods(g, *uses(g)))


def wildcards(g: PropertyGraph) -> DataFrame:
    """The calls of each module, looked up in the modules that it imports whole."""
    module = g.label("Module").select(c("node_id").alias("m"), c("qualified_name").alias("qn"))
    home = g.of_type("DEFINES").select(c("src").alias("m"), c("dst").alias("src"))
    calls = g.of_type("CALLS").select("src", "dst").join(home, "src").join(module, "m").join(g.nodes.select(c("node_id").alias("dst"), "name"), "dst")
    calls = calls.select(F.concat_ws("-", "src", "dst").alias("id"), c("name").alias("call_name"), c("qn").alias("module_qn"))
    ends = g.of_type("IMPORTS").select("src", "dst").join(module.select(c("m").alias("src"), c("qn").alias("module_qn")), "src").join(module.select(c("m").alias("dst"), c("qn").alias("full_name")), "dst")
    return resolve.wildcard_targets(calls, ends.select("module_qn", "full_name", c("dst").alias("ord")), g.label("Function").select("qualified_name"))


on_graph("J19", """ SELECT c.src||'-'||c.dst AS id, t.qualified_name AS callee FROM calls c JOIN edges h ON h.type = 'DEFINES' AND h.dst = c.src JOIN edges i ON i.type = 'IMPORTS' AND i.src = h.src
JOIN nodes m ON m.node_id = i.dst JOIN nodes f ON f.node_id = c.dst JOIN nodes t ON t.label = 'Function' AND t.qualified_name = m.qualified_name||'.'||f.name""")(wildcards)


def resolved(g: PropertyGraph) -> DataFrame:
    """Calls by name from each module, which imports a fifth of its callees by name and other modules whole."""
    module = g.label("Module").select(c("node_id").alias("m"), c("qualified_name").alias("module_qn"))
    home = g.of_type("DEFINES").select(c("src").alias("m"), c("dst").alias("src"))
    f = g.label("Function").select(c("node_id").alias("dst"), "qualified_name", "name")
    calls = g.of_type("CALLS").select("src", "dst").join(home, "src").join(module, "m").join(f, "dst")
    named = calls.filter("dst % 5 = 0").select("module_qn", c("name").alias("local_name"), c("qualified_name").alias("full_name"), F.lit(False).alias("is_wildcard")).distinct()
    ends = g.of_type("IMPORTS").select(c("src").alias("m"), c("dst").alias("to")).join(module, "m").join(module.select(c("m").alias("to"), c("module_qn").alias("full_name")), "to")
    stars = ends.select("module_qn", F.concat(F.lit("*"), "full_name").alias("local_name"), "full_name", F.lit(True).alias("is_wildcard"))
    asked = calls.select(F.concat_ws("-", "src", "dst").alias("id"), c("name").alias("call_name"), "module_qn")
    registry = f.select("qualified_name", c("name").alias("simple_name"))
    return resolve.resolve_calls(asked, named.union(stars), registry).select("id", "callee", big(c("step")).alias("step"))


on_graph("E12", """ SELECT c.src||'-'||c.dst AS id, f.qualified_name AS callee, (CASE WHEN c.dst % 5 = 0 THEN 1 WHEN EXISTS (SELECT 1 FROM edges i WHERE i.type = 'IMPORTS' AND i.src = h.src AND i.dst = k.src) THEN 3 WHEN h.src = k.src THEN 4 ELSE 5 END)::BIGINT AS step
FROM calls c JOIN edges h ON h.type = 'DEFINES' AND h.dst = c.src JOIN edges k ON k.type = 'DEFINES' AND k.dst = c.dst JOIN nodes f ON f.node_id = c.dst""")(resolved)


def graph_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in p])
    stems = read(spark, sf_dir, "supplier").select(F.when(c("s_suppkey") % 2 == 0, text("o", c("s_nationkey"), "__r", c("s_suppkey") % 60)).otherwise(text("r", c("s_suppkey") % 60)).alias("stem"))
    clones = read(spark, sf_dir, "customer").select(text("o", c("c_nationkey")).alias("owner"), text("r", c("c_custkey") % 50).alias("repo"))
    return resolve.graph_folders(stems, clones)


QUERIES["J21"] = graph_folders
SQL["J21"] = """WITH s AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'o'||s_nationkey||'__r'||(s_suppkey % 60) ELSE 'r'||(s_suppkey % 60) END AS stem FROM supplier),
k AS (SELECT DISTINCT 'o'||c_nationkey AS owner, 'r'||(c_custkey % 50) AS repo FROM customer)
SELECT stem, owner, repo FROM s JOIN k ON stem = owner||'__'||repo UNION ALL SELECT stem, min(owner), repo FROM (SELECT row_number() OVER () AS i, stem FROM s) JOIN k ON stem = repo GROUP BY i, stem, repo"""


def ranked(g: PropertyGraph) -> DataFrame:
    """The ends of each module's imports ranked as homes of the class that the module's name ends in."""
    e = g.ends("IMPORTS").select(c("src").alias("id"), c("dst").alias("idx"), c("d_qualified_name").alias("candidate"), c("s_qualified_name").alias("module_qn"))
    cls = F.concat(F.lit("n1."), F.element_at(F.split("module_qn", "[.]"), -1))
    fqn = F.expr("substring(candidate, instr(candidate, '.') + 1)")
    penalty = F.when(fqn == cls, 0).when(cls.endswith(F.element_at(F.split("candidate", "[.]"), -1)), 1).otherwise(2)
    return resolve.ranked_modules(e, penalty).select("id", "idx", "rank")


on_graph("W03", """, e AS (SELECT src AS id, dst AS idx, string_split(d.qualified_name, '.') AS a, string_split(s.qualified_name, '.') AS b, d.qualified_name AS qn FROM edges JOIN nodes s ON s.node_id = src JOIN nodes d ON d.node_id = dst WHERE type = 'IMPORTS'),
f AS (SELECT *, CASE WHEN a[2]||'.'||a[3] = 'n1.'||b[3] THEN 0 WHEN ends_with('n1.'||b[3], a[3]) THEN 1 ELSE 2 END AS p, greatest(0, 3 - (CASE WHEN a[1] <> b[1] THEN 0 WHEN a[2] <> b[2] THEN 1 WHEN a[3] <> b[3] THEN 2 ELSE 3 END) - (CASE WHEN a[1] = b[1] AND a[2] = b[2] THEN 1 ELSE 0 END)) AS d FROM e)
SELECT id, idx, row_number() OVER (PARTITION BY id ORDER BY p, d, idx) AS rank FROM f""")(ranked)


def external_importers(g: PropertyGraph) -> DataFrame:
    """Modules import a part of a brand or of one whose name goes on; brands are the external packages."""
    packages = g.label("ExternalPackage").select(c("name").alias("package"))
    imports = g.ends("DEFINES", src=("Module",), dst=("Function",)).select(c("src").alias("module"), c("d_decorators")[1].alias("b"), c("dst"))
    brand = F.concat(F.lit("Brand#"), F.substring_index("b", "#", -1))
    return resolve.external_importers(imports.select("module", F.when(c("dst") % 2 == 0, F.concat(brand, F.lit(".x"))).otherwise(F.concat(brand, F.lit("x"))).alias("imported")), packages)


on_graph("J12", ", i AS (SELECT src AS module, 'Brand#'||string_split(decorators[2], '#')[-1] AS b FROM edges JOIN nodes ON node_id = dst WHERE type = 'DEFINES' AND label = 'Function' AND dst % 2 = 0) SELECT DISTINCT name AS package, module, b||'.x' AS imported FROM i JOIN nodes ON label = 'ExternalPackage' AND name = b")(external_importers)
on_graph("J09", "SELECT n.node_id, e.src AS module FROM nodes n LEFT JOIN edges e ON e.type = 'DEFINES' AND e.dst = n.node_id WHERE n.label IN ('Function', 'Class')")(
    lambda g: g.label("Function", "Class").select("node_id").join(resolve.defining_module(g), "node_id", "left")
)

# Expansions -------------------------------------------------------------------------------------------------------------

seeds = lambda g, n: g.label("Function").filter(c("node_id") % n == 0).select(c("node_id").alias("seed"))
SEEDS = ", s AS (SELECT node_id AS seed FROM nodes WHERE label = 'Function' AND node_id % {n} = 0)"
CHAIN = "".join(
    f", k{i} AS (SELECT seed, path, arg_min(dst, md5(dst::VARCHAR||'s')) AS nxt FROM (SELECT seed, path, dst FROM p{i} LEFT JOIN calls ON src = path[-1] AND NOT list_contains(path, dst)) GROUP BY seed, path), p{i + 1} AS (SELECT seed, list_append(path, nxt) AS path FROM k{i} WHERE nxt IS NOT NULL)"
    for i in range(4)
)
SIBLINGS = (
    SEEDS.format(n=1) + ", p0 AS (SELECT seed, [seed] AS path FROM s)" + CHAIN + ", ch AS (SELECT seed, unnest(path) AS node FROM (" + " UNION ALL ".join(f"SELECT * FROM p{i}" for i in range(5)) + """)),
own AS (SELECT DISTINCT src AS up, dst AS node FROM edges WHERE type IN ('DEFINES', 'DEFINES_METHOD')),
sib AS (SELECT DISTINCT ch.seed, ch.node, b.node AS sibling FROM ch JOIN own a ON a.node = ch.node JOIN own b ON b.up = a.up AND b.node <> ch.node)
SELECT DISTINCT seed, node FROM ch UNION SELECT seed, sibling FROM (SELECT *, row_number() OVER (PARTITION BY seed, node ORDER BY md5(sibling::VARCHAR||'s'), sibling) AS k FROM sib) WHERE k <= 2
UNION SELECT seed, src FROM (SELECT seed, src, row_number() OVER (PARTITION BY seed ORDER BY md5(src::VARCHAR||'s'), src) AS k FROM s JOIN calls ON dst = seed) WHERE k <= 3""")
on_graph("T11", SIBLINGS)(lambda g: paths.chain_with_siblings(g, seeds(g, 1)))
FILE = SEEDS.format(n=1) + """, ins AS (SELECT seed, seed AS node FROM s UNION SELECT seed, b.dst FROM s JOIN edges a ON a.type = 'DEFINES' AND a.dst = seed JOIN edges b ON b.type = 'DEFINES' AND b.src = a.src),
ext AS (SELECT DISTINCT ins.seed, c.dst AS node FROM ins JOIN calls c ON c.src = ins.node WHERE (ins.seed, c.dst) NOT IN (SELECT (seed, node) FROM ins)),
fc AS (SELECT seed, node FROM ins UNION ALL SELECT seed, node FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY md5(node::VARCHAR||'s'), node) AS k FROM ext) WHERE k <= 5)"""
file_centric = lambda g: paths.file_centric(g, seeds(g, 1), resolve.defining_module(g))
on_graph("T14", FILE + " SELECT seed, node FROM fc")(file_centric)

# Contexts ---------------------------------------------------------------------------------------------------------------

CONTEXT = """, k AS (SELECT seed, node, label, name, coalesce(path, 'unknown') AS path FROM fc JOIN nodes ON node_id = node),
h AS (SELECT k.*, coalesce(m.path, k.path) AS file FROM k LEFT JOIN edges e ON e.type = 'DEFINES' AND e.dst = k.node LEFT JOIN nodes m ON m.node_id = e.src),
bl AS (SELECT seed, file, chr(10)||'### '||file||chr(10)||string_agg('  - ['||label||'] '||name, chr(10) ORDER BY node) AS b FROM h GROUP BY seed, file),
fl AS (SELECT seed, string_agg(b, chr(10) ORDER BY file) AS b FROM bl GROUP BY seed),
cl AS (SELECT a.seed, a.node, '  '||a.name||' -> '||string_agg(d.name, ', ' ORDER BY d.node) AS l FROM k a JOIN calls c ON c.src = a.node JOIN k d ON d.seed = a.seed AND d.node = c.dst GROUP BY a.seed, a.node, a.name),
cc AS (SELECT seed, string_agg(l, chr(10) ORDER BY node) AS b FROM cl GROUP BY seed)
SELECT seed, '## File Structure'||chr(10)||fl.b||chr(10)||chr(10)||'## Call Graph'||coalesce(chr(10)||cc.b, '')||chr(10)||chr(10)||'## Inheritance' AS context FROM fl LEFT JOIN cc USING (seed)"""
on_graph("F35", FILE + CONTEXT)(lambda g: render.graph_context(g, file_centric(g)))
on_graph("O11", FILE + CONTEXT[: CONTEXT.index("cl AS")].rstrip(",\n") + " SELECT seed, file, b AS block FROM bl ORDER BY seed, file")(lambda g: render.file_blocks(g, file_centric(g)).orderBy("seed", "file"))

CHUNKS = """, co AS (SELECT src AS node, string_agg(qn, ', ' ORDER BY dst) AS v FROM (SELECT c.src, c.dst, n.qualified_name AS qn, row_number() OVER (PARTITION BY c.src ORDER BY c.dst) AS r FROM calls c JOIN nodes n ON n.node_id = c.dst) WHERE r <= 5 GROUP BY src),
ci AS (SELECT dst AS node, string_agg(qn, ', ' ORDER BY src) AS v FROM (SELECT c.src, c.dst, n.qualified_name AS qn, row_number() OVER (PARTITION BY c.dst ORDER BY c.src) AS r FROM calls c JOIN nodes n ON n.node_id = c.src) WHERE r <= 5 GROUP BY dst),
ih AS (SELECT e.src AS node, string_agg(n.name, ', ' ORDER BY e.dst) AS v FROM edges e JOIN nodes n ON n.node_id = e.dst WHERE e.type = 'INHERITS' GROUP BY e.src),
df AS (SELECT e.dst AS node, arg_min(n.qualified_name, e.src) AS v, arg_min(n.path, e.src) AS file FROM edges e JOIN nodes n ON n.node_id = e.src WHERE e.type IN ('DEFINES', 'DEFINES_METHOD') GROUP BY e.dst),
el AS (SELECT n.*, co.v AS a, ci.v AS b, ih.v AS c, df.v AS d, df.file AS f FROM nodes n LEFT JOIN co ON co.node = node_id LEFT JOIN ci ON ci.node = node_id LEFT JOIN ih ON ih.node = node_id LEFT JOIN df ON df.node = node_id WHERE label IN ('Function', 'Class', 'Method'))
SELECT node_id AS node, concat_ws(chr(10), '<code_chunk>', '  <node_id>'||node_id||'</node_id>', '  <type>'||label||'</type>', '  <qualified_name>'||qualified_name||'</qualified_name>', '  <file>'||f||'</file>', '  <lines>'||start_line||'-'||end_line||'</lines>',
'  <calls>'||a||'</calls>', '  <called_by>'||b||'</called_by>', '  <inherits>'||c||'</inherits>', '  <defined_in>'||d||'</defined_in>', '  <decorators>'||array_to_string(decorators, ', ')||'</decorators>', '  <source>', coalesce(docstring, ''), '  </source>', '</code_chunk>') AS chunk FROM el"""


@on_graph("F35_chunks", CHUNKS)
def chunks(g):
    """The elements of all functions, classes and methods; a function's documentation stands for its source."""
    own = g.label("Function", "Class", "Method")
    first = g.of_type("DEFINES", "DEFINES_METHOD").groupBy(c("dst").alias("node")).agg(F.min("src").alias("up"))
    homes = g.nodes.select(c("node_id").alias("up"), c("path").alias("file"))
    texts = own.select(c("node_id").alias("node"), c("docstring").alias("text"), "start_line", "end_line").join(first, "node", "left").join(homes, "up", "left")
    return render.code_chunks(g, own.select(c("node_id").alias("node")), texts)


def _tree(name: str, source: str, target: str, depth: int) -> str:
    return f"""{name}k AS (SELECT src, dst FROM (SELECT {source} AS src, {target} AS dst, row_number() OVER (PARTITION BY {source} ORDER BY {target}) AS r FROM calls) WHERE r <= 4),
{name}t AS (SELECT node_id AS seed, [node_id] AS path, []::BIGINT[] AS place, []::BOOLEAN[] AS last FROM nodes WHERE label = 'Function' UNION ALL SELECT seed, list_append(path, dst), list_append(place, rn), list_append(last, rn = cnt)
FROM (SELECT t.*, k.dst, row_number() OVER (PARTITION BY t.path ORDER BY k.dst) AS rn, count(*) OVER (PARTITION BY t.path) AS cnt FROM {name}t t JOIN {name}k k ON k.src = t.path[-1] WHERE len(t.path) <= {depth} AND NOT list_contains(t.path, k.dst))),
{name}l AS (SELECT seed, string_agg('│   '||array_to_string(list_transform(last[1:len(last) - 1], lambda x: CASE WHEN x THEN '    ' ELSE '│   ' END), '')||CASE WHEN last[-1] THEN '└── ' ELSE '├── ' END||n.name, chr(10) ORDER BY place) AS l FROM {name}t t JOIN nodes n ON n.node_id = t.path[-1] WHERE len(t.path) > 1 GROUP BY seed)"""


ASCII = ", " + _tree("d", "src", "dst", 3) + ",\n" + _tree("u", "dst", "src", 2) + """,
sb AS (SELECT a.dst AS seed, b.dst AS node, row_number() OVER (PARTITION BY a.dst ORDER BY b.dst) AS n FROM edges a JOIN edges b ON a.type = 'DEFINES' AND b.type = 'DEFINES' AND a.src = b.src AND a.dst <> b.dst),
sl AS (SELECT seed, string_agg(CASE WHEN n = m THEN '    └── ' ELSE '    ├── ' END||name, chr(10) ORDER BY n) AS l FROM (SELECT *, max(n) OVER (PARTITION BY seed) AS m FROM sb WHERE n <= 5) JOIN nodes ON node_id = node GROUP BY seed)
SELECT node_id AS seed, concat_ws(chr(10), '=== GRAPH STRUCTURE ==='||chr(10), 'Seed: '||name||' ('||label||')', '│', '├─► CALLS (downstream)'||chr(10)||dl.l||chr(10)||'│', '├─◄ CALLED BY (upstream)'||chr(10)||ul.l||chr(10)||'│', '└── SIBLINGS (same file)'||chr(10)||sl.l) AS shown
FROM nodes LEFT JOIN dl ON dl.seed = node_id LEFT JOIN ul ON ul.seed = node_id LEFT JOIN sl ON sl.seed = node_id WHERE label = 'Function'"""
on_graph("F35_ascii", ASCII)(lambda g: render.ascii_graph(g, g.label("Function").select(c("node_id").alias("seed"))))
