"""Expansions over every node of their label, and rows whose data reach every branch of their operator."""

from __future__ import annotations

from functools import reduce

from plexus.catalog import BOTH, COUNTS, GRAPH_SQL, LOG_SQL, PROD, REACH, SIMPLE, SQL, Window, c, logs, on_graph, on_log, on_table, rounded, seeds
from plexus.catalog_names import FILE, SIBLINGS
from plexus.functions import names as N
from plexus.operators import commands, paths, resolve, sampling
from plexus.plans.graph import PropertyGraph, module_of, production
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNCAPPED, CAP = 1 << 30, 25
FIVE = BOTH.format(t="'CALLS','DEFINES','DEFINES_METHOD','INHERITS','IMPORTS'")
IMPORT_TREE = "SELECT src, dst FROM edges WHERE type IN ('IMPORTS', 'DEFINES') UNION ALL SELECT dst, src FROM edges WHERE type = 'IMPORTS'"
ALL = {k: f", {k[0].lower()}s AS (SELECT node_id AS seed FROM nodes WHERE label = '{k}')" for k in ("Function", "Module", "Class")}


def capped_sql(reach: str, most: int) -> str:
    at = reach.rindex("SELECT seed")
    return reach[:at] + f"SELECT seed, node, depth FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY depth, md5(node::VARCHAR||'s'), node) AS k FROM ({reach[at:]})) WHERE k <= {most}"


# Expansions ---------------------------------------------------------------------------------------------------------------

on_graph("T06", SIMPLE.format(prod=PROD, kind="IMPORTS", labels="'Module'", most=4, least=2, mods=1).replace("count(*) AS ways", "1::BIGINT AS ways"))(lambda g: paths.chains(g, "IMPORTS", ("Module",), 2, 4, 1))
on_graph("T09", """, up AS (SELECT node_id AS seed, node_id AS node, 0 AS depth FROM nodes WHERE label = 'Class' UNION SELECT up.seed, e.dst, depth + 1 FROM up JOIN edges e ON e.type = 'INHERITS' AND e.src = up.node JOIN nodes n ON n.node_id = e.dst AND n.name IS NOT NULL WHERE depth < 40),
a AS (SELECT seed, node, min(depth)::BIGINT AS depth FROM up GROUP BY seed, node HAVING min(depth) > 0) SELECT * FROM a WHERE seed IN (SELECT seed FROM a GROUP BY seed HAVING count(*) >= 2)""")(paths.ancestors)
_functions = lambda g: seeds(g, "Function", 1)
TEN = REACH.format(label="Function", n=1, d=2, g=FIVE)
on_graph("T10", TEN)(lambda g: paths.expand(g, _functions(g), "bfs", 2, UNCAPPED))
on_graph("T10_capped", capped_sql(TEN, CAP))(lambda g: paths.expand(g, _functions(g), "bfs", 2, CAP))
CALLERS = REACH.format(label="Function", n=1, d=3, g="SELECT dst AS src, src AS dst FROM calls")
CALLEES = REACH.format(label="Function", n=1, d=4, g="SELECT src, dst FROM calls")
IMPORTS = REACH.format(label="Module", n=1, d=3, g=IMPORT_TREE)
on_graph("T12", CALLERS)(lambda g: paths.expand(g, _functions(g), "callers", 3, UNCAPPED))
on_graph("T13", CALLEES)(lambda g: paths.expand(g, _functions(g), "callees", 4, UNCAPPED))
on_graph("T15", IMPORTS)(lambda g: paths.expand(g, seeds(g, "Module", 1), "imports", 3, UNCAPPED))


def filled_sql(seen: str, types: str, most: int) -> str:
    """Rows of ``seen`` and, up to ``most`` a seed, ends of their nodes' edges."""
    more = f"SELECT DISTINCT v.seed, e.dst AS node FROM {seen} v JOIN edges e ON e.src = v.node AND e.type IN ({types}) WHERE NOT EXISTS (SELECT 1 FROM {seen} w WHERE w.seed = v.seed AND w.node = e.dst)"
    return f"SELECT seed, node FROM {seen} UNION ALL SELECT seed, node FROM (SELECT m.*, row_number() OVER (PARTITION BY m.seed ORDER BY md5(m.node::VARCHAR||'s'), m.node) AS k, (SELECT count(*) FROM {seen} q WHERE q.seed = m.seed) AS have FROM ({more}) m) WHERE k <= {most} - have"


_levels = REACH.format(label="Class", n=1, d=5, g=BOTH.format(t="'INHERITS'"))
_at = _levels.rindex("SELECT seed")
TREE = _levels[:_at].rstrip() + f""", lv AS ({_levels[_at:]}), cu AS (SELECT seed, d, (SELECT count(*) FROM lv WHERE lv.seed = z.seed AND depth <= d) AS n FROM (SELECT DISTINCT seed, unnest(range(0, 6)) AS d FROM lv) z),
st AS (SELECT seed, coalesce(min(d) FILTER (n >= {CAP} // 2), 5) AS last FROM cu GROUP BY seed), tr AS (SELECT lv.seed, lv.node FROM lv JOIN st USING (seed) WHERE depth <= last) """ + filled_sql("tr", "'DEFINES_METHOD'", CAP)
on_graph("T16", TREE)(lambda g: paths.inheritance_tree(g, seeds(g, "Class", 1), CAP))
DEFINED = ", s0 AS (SELECT node_id AS seed, node_id AS node FROM nodes WHERE label IN ('Class', 'Module')), d1 AS (" + filled_sql("s0", "'DEFINES', 'DEFINES_METHOD'", CAP) + ") " + filled_sql("d1", "'CALLS', 'DEFINES_METHOD'", CAP)
_owners = lambda g: g.label("Class", "Module").select(c("node_id").alias("seed"))
on_graph("T17", DEFINED)(lambda g: paths.definitions_and_related(g, _owners(g), CAP))
_ten = capped_sql(TEN, CAP)
_last = _ten.rindex("SELECT seed, node, depth FROM")
on_graph("T18", _ten[:_last] + f", tc AS ({_ten[_last:]}), ie AS (SELECT DISTINCT a.seed, a.node AS src, b.node AS dst FROM tc a JOIN (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges) e ON e.src = a.node JOIN tc b ON b.seed = a.seed AND b.node = e.dst), dd AS (SELECT seed, seed AS node, 0 AS depth FROM (SELECT DISTINCT seed FROM tc) UNION SELECT dd.seed, ie.dst, dd.depth + 1 FROM dd JOIN ie ON ie.seed = dd.seed AND ie.src = dd.node WHERE dd.depth < 10) SELECT seed, node, min(depth)::BIGINT AS depth FROM dd GROUP BY seed, node")(
    lambda g: paths.distances_within(g, paths.expand(g, _functions(g), "bfs", 2, CAP))
)
on_graph("T19", """, k AS (SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS r FROM calls) WHERE r <= 4),
t AS (SELECT node_id AS seed, [node_id] AS path FROM nodes WHERE label = 'Function' UNION ALL SELECT seed, list_append(path, k.dst) FROM t JOIN k ON k.src = t.path[-1] WHERE len(path) <= 3 AND NOT list_contains(path, k.dst))
SELECT seed, array_to_string(path, ',') AS path FROM t""")(lambda g: paths.call_tree(g.of_type("CALLS"), _functions(g), 3).select("seed", F.array_join("path", ",").alias("path")))
on_graph("J18", "SELECT a.dst AS node_id, b.dst AS sibling FROM edges a JOIN edges b ON a.src = b.src AND a.dst <> b.dst WHERE a.type = 'DEFINES' AND b.type = 'DEFINES'")(
    lambda g: g.of_type("DEFINES").select("src", c("dst").alias("node_id")).join(g.of_type("DEFINES").select("src", c("dst").alias("sibling")), "src").filter("node_id != sibling").select("node_id", "sibling")
)

#: Strategy name to how it expands all its seeds (seed, node), and the SQL of the same.
REGISTRY = {
    "bfs": (lambda g: paths.expand(g, _functions(g), "bfs", 2, CAP), capped_sql(TEN, CAP)),
    "callers": (lambda g: paths.expand(g, _functions(g), "callers", 3, CAP), capped_sql(CALLERS, CAP)),
    "callees": (lambda g: paths.expand(g, _functions(g), "callees", 3, CAP), capped_sql(CALLEES.replace("r.depth < 4", "r.depth < 3"), CAP)),
    "imports": (lambda g: paths.expand(g, seeds(g, "Module", 1), "imports", 3, CAP), capped_sql(IMPORTS, CAP)),
    "inheritance": (lambda g: paths.inheritance_tree(g, seeds(g, "Class", 1), CAP), TREE),
    "definitions": (lambda g: paths.definitions_and_related(g, _owners(g), CAP), DEFINED),
    "file": (lambda g: paths.file_centric(g, _functions(g), resolve.defining_module(g)), FILE + " SELECT seed, node FROM fc"),
    "chain": (lambda g: paths.chain_with_siblings(g, _functions(g)), SIBLINGS),
}


def dispatched(g: PropertyGraph, names: tuple[str, ...] = tuple(REGISTRY)) -> DataFrame:
    """The expansions of the strategies named; a name that is not registered is an error."""
    return reduce(DataFrame.union, [REGISTRY[n][0](g).select(F.lit(n).alias("strategy"), "seed", "node") for n in names])


on_graph("T20")(dispatched)
SQL["T20"] = " UNION ALL ".join(f"SELECT '{n}' AS strategy, seed, node FROM ({GRAPH_SQL}{q})" for n, (_, q) in REGISTRY.items())

# Aggregates ---------------------------------------------------------------------------------------------------------------


def module_pairs(g: PropertyGraph, k: int = 25, least: int = 5, examples: int = 3) -> DataFrame:
    """The pairs of modules with most calls between them, and the first calls of those with ``least`` or more."""
    e = g.ends("CALLS").select(module_of(c("s_qualified_name")).alias("src_mod"), module_of(c("d_qualified_name")).alias("dst_mod"), F.concat_ws(" -> ", "s_qualified_name", "d_qualified_name").alias("x")).filter("src_mod != dst_mod")
    best = e.groupBy("src_mod", "dst_mod").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "src_mod", "dst_mod").limit(k)
    w = Window.partitionBy("src_mod", "dst_mod").orderBy("x")
    first = e.withColumn("r", F.row_number().over(w)).filter(c("r") <= examples).groupBy("src_mod", "dst_mod").agg(F.array_join(F.array_sort(F.collect_list("x")), "; ").alias("x"))
    return best.join(first, ["src_mod", "dst_mod"]).select("src_mod", "dst_mod", "n", F.when(c("n") >= least, c("x")).alias("examples"))


on_graph("A14", """, e AS (SELECT split_part(s.qualified_name, '.', 1) AS src_mod, split_part(d.qualified_name, '.', 1) AS dst_mod, s.qualified_name||' -> '||d.qualified_name AS x FROM calls JOIN nodes s ON s.node_id = src JOIN nodes d ON d.node_id = dst)
SELECT src_mod, dst_mod, count(*) AS n, CASE WHEN count(*) >= 5 THEN string_agg(x, '; ' ORDER BY x) FILTER (r <= 3) END AS examples FROM (SELECT *, row_number() OVER (PARTITION BY src_mod, dst_mod ORDER BY x) AS r FROM e WHERE src_mod <> dst_mod) GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 25""")(module_pairs)
listed = lambda col, when: F.array_join(F.array_sort(F.collect_list(F.when(when, c(col)))), ",")
on_graph("A16", f"SELECT e.src AS module, coalesce(string_agg(d.name, ',' ORDER BY d.name) FILTER (d.label = 'Function'), '') AS functions, coalesce(string_agg(d.name, ',' ORDER BY d.name) FILTER (d.label = 'Class'), '') AS classes FROM edges e JOIN nodes m ON m.node_id = e.src AND m.label = 'Module' JOIN nodes d ON d.node_id = e.dst WHERE e.type = 'DEFINES' AND {PROD.replace('qualified_name', 'm.qualified_name')} GROUP BY e.src")(
    lambda g: g.ends("DEFINES", src=("Module",)).filter(production(c("s_qualified_name"))).groupBy(c("src").alias("module")).agg(listed("d_name", c("d_label") == "Function").alias("functions"), listed("d_name", c("d_label") == "Class").alias("classes"))
)


def imported_names(g: PropertyGraph, literal: bool) -> DataFrame:
    """Per module the imported names that are not production (as the original has it), or that are."""
    e = g.ends("IMPORTS").withColumn("to", F.when(c("dst") % 4 == 0, F.concat(c("d_qualified_name"), F.lit(".tests"))).otherwise(c("d_qualified_name")))
    ok = production(c("to"))
    return e.filter(~ok if literal else ok).groupBy(c("src").alias("module")).agg(F.array_join(F.array_sort(F.collect_list("to")), ",").alias("names"))


for _n, _not in (("A17_literal", "NOT "), ("A17_production", "")):
    on_graph(_n, f"SELECT src AS module, string_agg(q, ',' ORDER BY q) AS names FROM (SELECT src, CASE WHEN dst % 4 = 0 THEN d.qualified_name||'.tests' ELSE d.qualified_name END AS q FROM edges JOIN nodes d ON d.node_id = dst WHERE type = 'IMPORTS') WHERE {_not}{PROD.replace('qualified_name', 'q')} GROUP BY src")(lambda g, literal=bool(_not): imported_names(g, literal))
on_log("A22", f"SELECT {COUNTS}, count(*) FILTER (NOT cached) AS executed FROM log")(lambda d: rounded(logs.summary(d)).drop("repos", "cmds").withColumn("executed", c("total") - c("cached")))
RATE = "count(*) AS total, count(*) FILTER (return_code <> 0) AS failed, count(*) FILTER (return_code <> 0) / count(*) AS failure_rate FROM log GROUP BY cmd"
_prefixes = lambda d: logs.by_prefix(d).select("prefix", "total", "failed", "failure_rate")
on_log("A24_failing", f"SELECT cmd AS prefix, {RATE} HAVING failed > 0 ORDER BY failure_rate DESC, total DESC, prefix LIMIT 3")(lambda d: _prefixes(d).filter("failed > 0").orderBy(F.desc("failure_rate"), F.desc("total"), "prefix").limit(3))
on_log("A24_total", f"SELECT cmd AS prefix, {RATE} ORDER BY total DESC, prefix LIMIT 3")(lambda d: _prefixes(d).orderBy(F.desc("total"), "prefix").limit(3))
on_log("A24_sorted", f"SELECT cmd AS prefix, {RATE} ORDER BY total DESC, prefix")(lambda d: _prefixes(d).orderBy(F.desc("total"), "prefix"))
on_log("A26", "SELECT count(*) AS entries, count(*) FILTER (cached) AS hits, count(*) FILTER (NOT cached) AS misses, count(*) FILTER (cached) / count(*) AS hit_rate FROM log")(
    lambda d: d.agg(F.count("*").alias("entries"), F.count_if("cached").alias("hits"), F.count_if(~c("cached")).alias("misses")).withColumn("hit_rate", c("hits") / c("entries"))
)
on_table("A27", "documents", "SELECT source AS repo, arg_max(e, (n, e)) AS extension, CASE arg_max(e, (n, e)) WHEN '.py' THEN 'python' WHEN '.rs' THEN 'rust' WHEN '.tsx' THEN 'typescript' END AS language FROM (SELECT source, ['.py', '.rs', '.tsx', '.txt'][(doc_id * doc_id // 7 % 4)::INT + 1] AS e, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY source")(
    lambda d: d.groupBy(c("source").alias("repo"), F.element_at(F.array(*map(F.lit, (".py", ".rs", ".tsx", ".txt"))), (F.floor(c("doc_id") * c("doc_id") / 7) % 4 + 1).cast("int")).alias("extension")).agg(F.count("*").alias("n"))
    .groupBy("repo").agg(F.max_by("extension", F.struct("n", "extension")).alias("extension")).withColumn("language", N.language_of_extension(c("extension")))
)
RUNS = "(SELECT *, event_id % 97 AS nodes, event_id % 53 AS rels FROM log)"
_runs = lambda d: d.withColumn("nodes", c("event_id") % 97).withColumn("rels", c("event_id") % 53)
SUMS = "count(*) AS n, sum(nodes)::BIGINT AS nodes, sum(rels)::BIGINT AS relationships, count(*) FILTER (return_code = 0) AS success"
_sums = lambda: (F.count("*").alias("n"), F.sum("nodes").alias("nodes"), F.sum("rels").alias("relationships"), F.count_if(c("return_code") == 0).alias("success"))
on_log("K13", f"SELECT repo, {SUMS} FROM {RUNS} GROUP BY repo")(lambda d: _runs(d).groupBy("repo").agg(*_sums()))
on_log("A30", f"SELECT {SUMS}, count(DISTINCT repo) AS repos FROM {RUNS}")(lambda d: _runs(d).agg(*_sums(), F.count_distinct("repo").alias("repos")))


def throughput(runs: DataFrame, planned: int) -> DataFrame:
    """Repositories a minute, nodes a second and the seconds left until ``planned`` are done, in one row."""
    seconds = (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1e6
    t = runs.agg(F.count_distinct("repo").alias("done"), F.sum("nodes").alias("nodes"), seconds.alias("s"))
    return t.select("done", F.round(c("done") * 60 / c("s"), 9).alias("repos_per_minute"), F.round(c("nodes") / c("s"), 9).alias("nodes_per_second"), F.round((planned - c("done")) * c("s") / c("done"), 3).alias("eta_seconds"))


on_log("A31", f"SELECT done, round(done * 60 / s, 9) AS repos_per_minute, round(nodes / s, 9) AS nodes_per_second, round((1000000 - done) * s / done, 3) AS eta_seconds FROM (SELECT count(DISTINCT repo) AS done, sum(nodes) AS nodes, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS s FROM {RUNS})")(lambda d: throughput(_runs(d), 1_000_000))
on_log("A31_moving", "SELECT b AS begin, n, round(avg(n) OVER (ORDER BY b ROWS 9 PRECEDING), 6) AS moving FROM (SELECT date_trunc('hour', ts) AS b, count(*) AS n FROM log GROUP BY 1)")(
    lambda d: d.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n")).select(c("w.start").alias("begin"), "n", F.round(F.avg("n").over(Window.orderBy("w.start").rowsBetween(-9, 0)), 6).alias("moving"))  # a row an hour
)
on_graph("A32", ", r AS (SELECT node_id, count(*) AS all_rels, count(*) FILTER (type = 'CALLS' AND w = 'in') AS calls_in, count(*) FILTER (type = 'CALLS' AND w = 'out') AS calls_out FROM (SELECT src AS node_id, type, 'out' AS w FROM edges UNION ALL SELECT dst, type, 'in' FROM edges) GROUP BY node_id) SELECT node_id, calls_in, calls_out, all_rels FROM r JOIN fm USING (node_id)")(
    lambda g: (lambda s: s.groupBy("node_id").agg(F.count_if((c("type") == "CALLS") & (c("w") == "in")).alias("calls_in"), F.count_if((c("type") == "CALLS") & (c("w") == "out")).alias("calls_out"), F.count("*").alias("all_rels")).join(g.label("Function", "Method").select("node_id"), "node_id", "left_semi"))(
        g.edges.select(c("src").alias("node_id"), "type", F.lit("out").alias("w")).union(g.edges.select("dst", "type", F.lit("in")))
    )
)


def question_set(g: PropertyGraph, count: int) -> DataFrame:
    """Of each label its quota by a fixed hash, all shuffled by another and cut to ``count``."""
    n = g.nodes.select("label").distinct().agg(F.greatest(F.lit(1), F.floor(F.lit(count) / F.count("*"))).alias("quota"))
    w = Window.partitionBy("label").orderBy(sampling.hash_order(c("node_id"), "q"), "node_id")
    picked = g.nodes.select("label", "node_id", F.row_number().over(w).alias("k")).filter(c("k") <= count).crossJoin(F.broadcast(n)).filter("k <= quota")  # one row
    return picked.orderBy(sampling.hash_order(c("node_id"), "z"), "node_id").limit(count).select("label", "node_id")


on_graph("O12", "SELECT label, node_id FROM (SELECT label, node_id, row_number() OVER (PARTITION BY label ORDER BY md5(node_id::VARCHAR||'q'), node_id) AS k FROM nodes) WHERE k <= greatest(1, 30 // (SELECT count(DISTINCT label) FROM nodes)) ORDER BY md5(node_id::VARCHAR||'z'), node_id LIMIT 30")(lambda g: question_set(g, 30))
on_graph("W01")(lambda g: resolve.overrides(g).select("src", "dst"))
SQL["W01"] = SQL["A18"]
FOLD = """, ch AS (SELECT seed, node, end_line - start_line AS size, row_number() OVER (PARTITION BY seed ORDER BY depth, node) AS k FROM ({reach}) JOIN nodes ON node_id = node WHERE end_line IS NOT NULL),
fo AS (SELECT DISTINCT seed, 0::BIGINT AS k, 0::BIGINT AS used, []::BIGINT[] AS picked FROM ch UNION ALL SELECT fo.seed, ch.k, CASE WHEN used + size > 60 THEN used ELSE used + size END, CASE WHEN used + size > 60 THEN picked ELSE list_append(picked, node) END FROM fo JOIN ch ON ch.seed = fo.seed AND ch.k = fo.k + 1)
SELECT seed, array_to_string(arg_max(picked, k), ',') AS picked, arg_max(used, k) AS used FROM fo GROUP BY seed"""
_one = capped_sql(REACH.format(label="Function", n=1, d=1, g=FIVE), 30)
_last = _one.rindex("SELECT seed, node, depth FROM")
on_graph("W05", _one[:_last] + FOLD.format(reach=_one[_last:]))(
    lambda g: sampling.packed(paths.expand(g, _functions(g), "bfs", 1, 30).join(g.nodes.filter("end_line IS NOT NULL").select(c("node_id").alias("node"), (c("end_line") - c("start_line")).alias("size")), "node"), 60)
)

# Functions on data that reach every branch -----------------------------------------------------------------------------------

pick = lambda values, key: F.element_at(F.array(*map(F.lit, values)), (c(key) % len(values) + 1).cast("int"))
quoted = lambda x: "NULL" if x is None else str(x).lower() if isinstance(x, bool) else "'" + x.replace("'", "''") + "'"


def by_case(table: list[tuple]) -> str:
    """Rows of expected values by the place of a case, as SQL."""
    return "(VALUES " + ", ".join(f"({i}, {', '.join(map(quoted, row))})" for i, row in enumerate(table)) + ")"


CHAINED, AFTER_PIPE = "Command chains (&&, ||, ;) are not allowed", "cut, grep, head, less, sort, tail, uniq, wc"
GIT = "blame, branch, cat-file, describe, diff, log, ls-files, ls-tree, name-rev, rev-list, rev-parse, shortlog, show, status, tag"
#: Command, prefix, whether it is valid, and its error.
SHELL = [
    ("git log --oneline", "git log", True, None), ("git --no-pager diff", "git diff", True, None), ("git", "git", False, f"Git subcommand '-' not allowed. Allowed: {GIT}"), ("git push origin", "git push", False, f"Git subcommand 'push' not allowed. Allowed: {GIT}"),
    ("find . -name '*.py'", "find -name", True, None), ("find src", "find", True, None), ("grep -rn foo src", "grep -rn", True, None), ("grep --recursive -i foo", "grep -r -i", True, None), ('grep "a;b" f', "grep", True, None),
    ("ls -la /tmp", "ls -la", True, None), ("ls src", "ls", True, None), ("head -n 5 a.txt | wc -l", "head -n", True, None), ("cat a.txt > b.txt", "cat", False, "Redirects (>, >>, <) are not allowed"), ("ls && rm x", "ls", False, CHAINED), ("ls; rm x", "ls;", False, CHAINED),
    ("cat a | awk x", "cat", False, f"Command 'awk' not allowed after pipe. Allowed: {AFTER_PIPE}"), ("echo `x`", "echo", False, "Subshells ($(...), `...`) are not allowed"), ("tree &", "tree", False, "Background execution (&) is not allowed"),
    ("python x.py", "python", False, "Command 'python' not in allowlist"), ("  ", "unknown", False, "Empty command"), ("cat 'a", "cat", False, "Failed to parse command: No closing quotation"),
]
SHELL[2] = ("git", "git", True, None)  # a lone git has no subcommand to reject
_shell = lambda: pick([x[0] for x in SHELL], "event_id")
CASES = f"SELECT event_id, v.* FROM events JOIN {by_case(SHELL)} v(i, cmd, prefix, valid, error) ON i = event_id % {len(SHELL)}"
on_table("F17", "events", f"SELECT event_id, prefix FROM ({CASES})")(lambda d: d.select("event_id", N.command_prefix(_shell()).alias("prefix")))
on_table("F32", "events", f"SELECT event_id, valid, error FROM ({CASES})")(lambda d: d.select("event_id", commands.validated(_shell()).alias("r")).select("event_id", "r.*"))
#: Error text and its pattern.
ERRORS = [
    ("fatal: /usr/lib/git-core/x is gone", "fatal: {path} is gone"), ("error at Line 42", "error at line {num}"), ('"abc" not found', "{str} not found"), ("no 'x y' here", "no {str} here"),
    ("commit 1a2b3c4d5e is bad", "commit {hash} is bad"), ("exit 17", "exit {num}"), ("owner/repo missing", "owner{path} missing"), ("first line\nsecond 5", "first line"),
]
_stderr = lambda: pick([x[0] for x in ERRORS], "event_id")
FAILED = f"(SELECT event_id, user_id::VARCHAR AS repo, event_type AS cmd, v.e, v.p FROM events JOIN {by_case(ERRORS)} v(i, e, p) ON i = event_id % {len(ERRORS)})"
on_log("A25", "SELECT 1")(lambda d: logs.error_patterns(d.select(_stderr().alias("stderr"), "cmd", "repo", c("event_id").alias("seq"))))
SQL["A25"] = f"SELECT substr(md5(p), 1, 12) AS pattern_id, p AS pattern, count(*) AS n, arg_min(e, event_id) AS first_stderr, string_agg(repo||':'||cmd, ',' ORDER BY repo||':'||cmd) FILTER (k <= 3) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY event_id) AS k FROM {FAILED}) GROUP BY p"


def replaced_sql(column: str) -> str:
    out = f"substr(split_part(trim({column}), chr(10), 1), 1, 200)"
    for pattern, to in N.ERROR_PATTERNS:
        out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(to)}, 'g')"
    return out


on_table("F18", "documents", f"SELECT doc_id, p AS pattern, substr(md5(p), 1, 12) AS pattern_id FROM (SELECT doc_id, {replaced_sql('text')} AS p FROM documents)")(lambda d: d.select("doc_id", N.normal_error(c("text")).alias("pattern"), N.pattern_id(N.normal_error(c("text"))).alias("pattern_id")))
ALIASES = [(" PY ", "python"), ("python3", "python"), ("JS", "javascript"), ("ts", "typescript"), ("C++", "cpp"), ("golang", "go"), ("rs", "rust"), ("Lua", "lua"), (None, None)]
on_table("F16", "documents", f"SELECT doc_id, language FROM documents JOIN {by_case(ALIASES)} v(i, name, language) ON i = doc_id % {len(ALIASES)}")(lambda d: d.select("doc_id", N.language(pick([x[0] for x in ALIASES], "doc_id")).alias("language")))
for _dots in (1, 2, 3):
    on_graph(f"F12_{_dots}", f"SELECT node_id, array_to_string(list_append(string_split(qualified_name, '.')[2:greatest(1, len(string_split(qualified_name, '.')) - {_dots})], 'x'), '.') AS target FROM nodes WHERE label IN ('Module', 'Function')")(
        lambda g, dots=_dots: g.label("Module", "Function").select("node_id", N.relative_import(c("qualified_name"), dots, F.lit("x")).alias("target"))
    )
