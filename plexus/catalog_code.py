"""Registered queries that write and read files or run streams in the shared folder, and those on typed sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.catalog import GRAPH_SQL, LOG_SQL, QUERIES, SQL, c, on_graph, on_log, on_table
from plexus.catalog_sources import PARTS, complaint, node_texts, sources, text
from plexus import catalog_names  # noqa: F401
from plexus.functions import names as N
from plexus.operators import extract, javascript, render, sampling, types
from plexus.plans.graph import PropertyGraph, new_folder, spread, stored
from plexus.sources import files, sinks
from plexus.sources.tables import graph, read
from plexus.streaming import jobs
from plexus.streaming.keyed import KeyedTable

# Graph files -------------------------------------------------------------------------------------------------------------


def exported(g: PropertyGraph) -> str:
    at = new_folder(g.nodes.sparkSession, "graph")
    nodes = g.nodes.select("node_id", F.array("label").alias("labels"), F.to_json(F.struct("qualified_name", "name")).alias("properties"))
    edges = g.edges.select(c("src").alias("from_id"), c("dst").alias("to_id"), "type", F.to_json(F.struct("version_spec")).alias("properties"))
    sinks.write_graph(nodes, edges, at, "2024-01-01T00:00:00+00:00")
    return at


@on_graph("S01", " SELECT node_id AS a, node_id AS b, label AS kind, name AS shown FROM nodes UNION ALL SELECT src, dst, type, NULL FROM edges")
def loaded_graph(g: PropertyGraph) -> DataFrame:
    """The graph as JSON files hold it, read back."""
    back = files.json_graph(g.nodes.sparkSession, exported(g), lines=True)
    nodes = back.nodes.select(c("node_id").alias("a"), c("node_id").alias("b"), c("label").alias("kind"), files.prop("name").alias("shown"))
    return nodes.union(back.edges.select("src", "dst", "type", F.lit(None).cast("string")))


@on_graph("K08_metadata", " SELECT (SELECT count(*) FROM nodes) AS total_nodes, (SELECT count(*) FROM edges) AS total_relationships, '2024-01-01T00:00:00+00:00' AS exported_at")
def export_metadata(g: PropertyGraph) -> DataFrame:
    return g.nodes.sparkSession.read.schema("total_nodes bigint, total_relationships bigint, exported_at string").json(f"{exported(g)}/metadata")


@on_graph("K05", " SELECT 'before' AS state, count(*) AS n FROM nodes UNION ALL SELECT 'after', 0")
def emptied(g: PropertyGraph) -> DataFrame:
    """Rows of a written node table before and after it is emptied."""
    spark, at = g.nodes.sparkSession, new_folder(g.nodes.sparkSession, "nodes")
    g.nodes.write.parquet(at)
    n_before = spark.read.parquet(at).agg(F.count("*").alias("n")).first()["n"]
    sinks.truncate(g.nodes, at)
    after = spark.read.parquet(at).agg(F.lit("after").alias("state"), F.count("*").alias("n"))
    return spark.range(1).select(F.lit("before").alias("state"), F.lit(n_before).cast("bigint").alias("n")).union(after)


def written_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node texts written as JSON lines and read back."""
    at = new_folder(spark, "texts")
    sinks.write_lines(node_texts(spark, sf_dir), at)
    return spark.read.schema("node_id bigint, text string, error string").json(at)


QUERIES["K09_texts"], SQL["K09_texts"] = written_texts, SQL["E22"]



def written_prompts(g: PropertyGraph) -> DataFrame:
    """A numbered prompt for each function with its surroundings as a tree, written as JSON lines and read back."""
    at = new_folder(g.nodes.sparkSession, "prompts")
    shown = render.ascii_graph(g, g.label("Function").select(c("node_id").alias("seed")))
    rows = sampling.numbered(shown, ["seed"], "prompt_id").withColumn("prompt", N.filled(F.lit("Explore ${REPO_NAME} from here:\n${CONTEXT}"), REPO_NAME=F.lit("proj"), CONTEXT=c("shown")))
    sinks.write_lines(rows.select("prompt_id", "seed", "prompt", F.floor(F.length("prompt") / 4).alias("tokens")), at)
    return g.nodes.sparkSession.read.schema("prompt_id string, seed bigint, prompt string, tokens bigint").json(at)


def written_questions(d: DataFrame) -> DataFrame:
    """An evaluation prompt for each question, with nested metadata, written as JSON lines and read back; nulls stay."""
    at = new_folder(d.sparkSession, "questions")
    asked = text("Why did ", c("cmd"), " fail in ", c("repo"), "?")
    hops = (c("event_id") % 9).cast("int")
    rows = d.select("event_id", "repo", asked.alias("question"), hops.alias("hops"), F.when(c("return_code") != 0, c("cmd")).alias("seed_node"))
    rows = sampling.numbered(rows, ["event_id"], "question_id", "q_%03d")
    rows = rows.withColumn("user_prompt", N.filled(F.lit("In ${REPO_NAME}: ${QUESTION}"), REPO_NAME=c("repo"), QUESTION=c("question")))
    meta = F.struct("seed_node", F.lit("grep").alias("expected_search_strategy"), (c("hops") > 4).alias("deep"))
    sinks.write_lines(rows.select("question_id", c("repo").alias("repo_name"), "question", "user_prompt", meta.alias("metadata")), at)
    back = d.sparkSession.read.schema("question_id string, repo_name string, question string, user_prompt string, metadata struct<seed_node:string,expected_search_strategy:string,deep:boolean>").json(at)
    return back.select("question_id", "repo_name", "question", "user_prompt", "metadata.seed_node", "metadata.deep")


on_graph("K09_prompts", SQL["F35_ascii"].removeprefix(GRAPH_SQL).replace("\nSELECT node_id AS seed", ",\nsh AS (SELECT node_id AS seed") + """),
pr AS (SELECT printf('prompt_%04d', row_number() OVER (ORDER BY seed) - 1) AS prompt_id, seed, 'Explore proj from here:'||chr(10)||shown AS prompt FROM sh) SELECT prompt_id, seed, prompt, length(prompt) // 4 AS tokens FROM pr""")(written_prompts)
on_log("K09_questions", """SELECT printf('q_%03d', row_number() OVER (ORDER BY event_id) - 1) AS question_id, repo AS repo_name, 'Why did '||cmd||' fail in '||repo||'?' AS question, 'In '||repo||': Why did '||cmd||' fail in '||repo||'?' AS user_prompt,
CASE WHEN return_code <> 0 THEN cmd END AS seed_node, event_id % 9 > 4 AS deep FROM log""")(written_questions)

# Streams -----------------------------------------------------------------------------------------------------------------


def arriving(log: DataFrame) -> DataFrame:
    """A stream over the log, written as files of command results."""
    at = new_folder(log.sparkSession, "results")
    log.select("cmd", "repo", F.lit("").alias("stdout"), complaint(c("event_id")).alias("stderr"), "return_code", "duration_ms", "cached").write.json(at)
    return jobs.results(log.sparkSession, at)


def once(rows: DataFrame, mode: str = "append") -> DataFrame:
    return jobs.run_once(rows, new_folder(rows.sparkSession, "stream"), mode)


on_log("R07", "SELECT cmd, repo, return_code, cached FROM log")(lambda d: once(arriving(d)).select("cmd", "repo", "return_code", "cached"))
on_log("R05_stream", SQL["R05"].removeprefix(LOG_SQL))(lambda d: once(jobs.prefix_totals(arriving(d)), "complete").select("prefix", "total", "failed"))
on_log("R06_stream", SQL["R06"].removeprefix(LOG_SQL))(lambda d: once(jobs.error_totals(arriving(d)), "complete").select("pattern", "n"))



def in_two_runs(rows: DataFrame, later, follow) -> None:
    """``follow`` on a stream of what has arrived, and again, as after a restart, when the rest (``later``) has; two files a micro-batch."""
    spark, at = rows.sparkSession, new_folder(rows.sparkSession, "arriving")
    for part in (rows.filter(~later), rows.filter(later)):
        part.repartition(4).write.mode("append").parquet(at)
        follow(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(at)).awaitTermination()


def keyed(spark: SparkSession, schema: str, *keys: str) -> tuple[KeyedTable, str]:
    at = new_folder(spark, "keyed")
    return KeyedTable(spark, f"{at}/table", schema, keys, buckets=8), f"{at}/checkpoint"


#: What kind of file event stands for each kind of event.
FILE_EVENT = {"signup": "created", "error": "deleted"}


def live_graph(d: DataFrame) -> DataFrame:
    """Each user is a file; what its last event leaves of it, with the events out of order."""
    spark = d.sparkSession
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in FILE_EVENT.items() for x in pair]), c("event_type")), F.lit("modified"))
    events = d.select(text("u/", c("user_id"), ".py").alias("path"), kind.alias("event_type"), F.lit(False).alias("is_directory"), F.struct(c("ts").alias("at"), c("event_id").alias("id")).alias("ts"))

    def parse(paths: DataFrame) -> DataFrame:
        key = F.regexp_extract("path", r"(\d+)\.py$", 1)
        files = paths.select("path", text("def a", key, "():\n    pass\nclass B", key, ":\n    pass\n").alias("content"))
        return extract.extracted(files, "proj").filter("kind IN ('Function', 'Class')").groupBy("path").agg(F.sort_array(F.collect_list("qualified_name")).alias("names"))

    table, checkpoint = keyed(spark, jobs.LIVE, "path")
    in_two_runs(events, c("ts.id") % 2 == 0, lambda stream: jobs.live_modules(stream, table, checkpoint, parse))
    return table.read().select("path", "event_type", F.array_join("names", ",").alias("names"))


on_table("R01_stream", "events", """WITH last AS (SELECT user_id AS u, arg_max(event_type, (ts, event_id)) AS t FROM events GROUP BY 1)
SELECT 'u/'||u||'.py' AS path, CASE t WHEN 'signup' THEN 'created' WHEN 'error' THEN 'deleted' ELSE 'modified' END AS event_type, CASE WHEN t <> 'error' THEN 'proj.u.'||u||'.B'||u||',proj.u.'||u||'.a'||u END AS names FROM last""")(live_graph)


def rates_so_far(d: DataFrame) -> DataFrame:
    """Rates by hour as the log arrives in no order; nothing is too late within the log's own length."""
    table, checkpoint = keyed(d.sparkSession, "begin timestamp, n bigint, failed bigint", "begin")
    log = d.select(c("ts").cast("timestamp").alias("ts"), "return_code", "event_id")  # a watermark needs a time zone
    in_two_runs(log, c("event_id") % 3 == 0, lambda stream: jobs.live_rates(stream, table, checkpoint, "1 hour", "1000 days"))
    return table.read().withColumn("begin", c("begin").cast("timestamp_ntz"))


on_log("R08_stream", SQL["R08"].removeprefix(LOG_SQL))(rates_so_far)


def clone_states(d: DataFrame) -> DataFrame:
    """Which repositories are pending after two runs; the second one mends failures and clones some more."""
    k = c("c_custkey")
    first = d.filter(k % 3 < 2).select(k.alias("url"), F.when(k % 3 == 0, "completed").otherwise("failed").alias("state"), F.lit(1).alias("ts"))
    then = d.filter((k % 6 == 1) | (k % 12 == 2)).select(k.alias("url"), F.lit("completed").alias("state"), F.lit(2).alias("ts"))
    table, checkpoint = keyed(d.sparkSession, "url bigint, state string, ts int", "url")
    in_two_runs(first.union(then), c("ts") == 2, lambda stream: jobs.live_states(stream, table, checkpoint))
    states = table.read()
    return states.select("url", "state").union(jobs.pending(d.select(k.alias("url")), states).select("url", F.lit("pending")))


on_table("R09_stream", "customer", "SELECT c_custkey AS url, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 6 = 1 OR c_custkey % 12 = 2 THEN 'completed' WHEN c_custkey % 3 = 1 THEN 'failed' ELSE 'pending' END AS state FROM customer")(clone_states)


def vector_table(d: DataFrame) -> DataFrame:
    """Vectors stored by id; every third is stored again with its components in reverse."""
    table, _ = keyed(d.sparkSession, "vec_id bigint, embedding array<float>", "vec_id")
    table.merge(d, 0)
    table.merge(d.filter("vec_id % 3 = 0").select("vec_id", F.reverse("embedding").alias("embedding")), 1)
    return table.read().select("vec_id", F.col("embedding")[0].alias("first"), F.size("embedding").alias("n"))


on_table("K10_table", "embeddings", "SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN embedding[len(embedding)] ELSE embedding[1] END AS first, len(embedding)::INT AS n FROM embeddings")(vector_table)

# Embeddings and edits ----------------------------------------------------------------------------------------------------


def sizes(batch: list[str]) -> list[list[float]]:
    """A stand-in for a model: characters and lines of each text."""
    return [[float(len(t)), float(t.count("\n") + 1)] for t in batch]


def embedded_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worklist's texts; a module's file is the document of its number."""
    g = graph(spark, sf_dir)
    modules = g.label("Module").select(c("node_id").alias("src"), "path")
    home = g.of_type("DEFINES").join(modules, "src").select(c("dst").alias("node_id"), "path")
    content = g.label("Module").select("path", (c("node_id") - 30000000000).alias("doc_id")).join(read(spark, sf_dir, "documents").select("doc_id", c("text").alias("content")), "doc_id")
    work = g.label("Function", "Method").drop("path").join(home, "node_id")
    out = extract.embedded(work, content, sizes)
    return out.select("node_id", "qualified_name", c("embedding")[0].alias("chars"), c("embedding")[1].alias("lines"))


QUERIES["E24"] = embedded_functions
SQL["E24"] = GRAPH_SQL + """, w AS (SELECT n.node_id, n.qualified_name, n.start_line AS a, n.end_line AS b, string_split(d.text, chr(10)) AS l FROM nodes n JOIN edges e ON e.type = 'DEFINES' AND e.dst = n.node_id JOIN nodes m ON m.node_id = e.src AND m.label = 'Module' JOIN documents d ON d.doc_id = m.node_id - 30000000000 WHERE n.label IN ('Function', 'Method')),
x AS (SELECT *, array_to_string(l[a:b], chr(10)) AS t FROM w WHERE a >= 1 AND b >= a AND a <= len(l))
SELECT node_id, qualified_name, length(t)::DOUBLE AS chars, (length(t) - length(replace(t, chr(10), '')) + 1)::DOUBLE AS lines FROM x WHERE t <> ''"""


def edited_functions(d: DataFrame) -> DataFrame:
    """Each file's nested function found by name, its call edited, and the diff's changed lines."""
    src = sources(d)
    rows = extract.extracted(src, "proj")
    asked = d.select(c("p_partkey").alias("id"), text("src/p", c("p_partkey"), ".py").alias("path"), F.when(c("p_partkey") % 2 == 0, "inner").otherwise(text("K", c("p_partkey"), ".m")).alias("name"), F.lit(None).cast("bigint").alias("line"))
    found = extract.function_sources(asked, rows, src)
    after = extract.replaced_first(c("text"), F.lit("return "), F.lit("return not "))
    shown = F.regexp_count(extract.unified_diff(c("text"), after, c("qualified_name")), F.lit("(?m)^[+-](?![+-])")).cast("bigint")
    return found.select("id", "qualified_name", after.alias("edited"), shown.alias("n_changed"))


on_table("E25", "part", PARTS + "SELECT k AS id, CASE WHEN k % 2 = 0 THEN qn||'.f'||k||'.inner' ELSE qn||'.K'||k||'.m' END AS qualified_name, CASE WHEN k % 2 = 0 THEN '    def inner():'||chr(10)||'        return not y(a)' ELSE '    def m(self):'||chr(10)||'        return not self.h(os.path.join(y))' END AS edited, 2 AS n_changed FROM m")(edited_functions)

# Types -------------------------------------------------------------------------------------------------------------------

TYPED = (
    "class Help:\n    def go(self) -> 'K", "':\n        ...\nclass Base:\n    def base(self):\n        return self\nclass K", "(Base):\n    def __init__(self):\n        self.h = Help()\n    def m(self):\n        return self.h.go()\n"
    "    def up(self):\n        return super().base()\ndef f(a: K", "):\n    x = a.m()\n    x.m().up()\n    return x\ndef g():\n    f(1).up()\n",
)


#: Results, unions of stored rows, by session and input, as three queries show parts of one.
_TYPED: dict[tuple, tuple[DataFrame, DataFrame]] = {}


def typed(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    key = d.sparkSession.sparkContext.applicationId, tuple(sorted(d.inputFiles()))
    if key not in _TYPED:
        _TYPED[key] = _typed(d)
    return _TYPED[key]


def _typed(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    k = c("p_partkey")
    src = spread(d.select(k)).select(text("src/p", k, ".py").alias("path"), text(TYPED[0], k, TYPED[1], k, TYPED[2], k, TYPED[3]).alias("content"))
    rows, bound = types.parsed(src, "proj")
    roots = d.sparkSession.createDataFrame([("src",)], "root string")
    return types.inferred(bound, stored(extract.local_imports(rows, roots, "proj")), rows)


on_table("E10", "part", PARTS + "SELECT unnest([qn||'.K'||k, qn||'.f', qn||'.f']) AS at, unnest(['self.h', 'a', 'x']) AS var, unnest([qn||'.Help', qn||'.K'||k, qn||'.K'||k]) AS cls FROM m")(
    lambda d: typed(d)[0].filter(~c("var").startswith("%") & ~c("var").isin("self", types.RETURN)).select("at", "var", "cls")
)
on_table("E14", "part", PARTS + "SELECT unnest([qn||'.Help.go', qn||'.Base.base', qn||'.K'||k||'.m', qn||'.K'||k||'.up', qn||'.f']) AS at, unnest([qn||'.K'||k, qn||'.Base', qn||'.K'||k, qn||'.Base', qn||'.K'||k]) AS cls FROM m")(
    lambda d: typed(d)[0].filter(c("var") == types.RETURN).select("at", "cls")
)
on_table("E12_typed", "part", PARTS + """SELECT unnest([qn||'.K'||k||'.m', qn||'.K'||k||'.up', qn||'.f', qn||'.f', qn||'.f', qn||'.g', qn||'.g']) AS at, unnest([11, 13, 15, 16, 16, 19, 19]) AS line,
unnest([qn||'.Help.go', qn||'.Base.base', qn||'.K'||k||'.m', qn||'.K'||k||'.m', qn||'.K'||k||'.up', qn||'.f', qn||'.K'||k||'.up']) AS callee FROM m""")(lambda d: typed(d)[1].select("at", "line", "callee"))

# JavaScript --------------------------------------------------------------------------------------------------------------

SCRIPT = (
    "import D, { a as b, c } from './lib/x';\nimport * as ns from 'm/n';\nimport './side';\nconst q = require('../u');\nexport { z as w } from './y';\nexport * from './all';\n// import no from 'no';\nexport const f",
    " = (a) => a;\nexport function g() {}\nexports.h = function () {};\nmodule.exports.i = async x => x;\nexports.v = 3;\n",
)
scripts = lambda d: d.select(text("src/p", c("p_partkey"), ".js").alias("path"), text(SCRIPT[0], c("p_partkey"), SCRIPT[1]).alias("content"))
on_table("E08_js", "part", PARTS + """SELECT qn AS module_qn, unnest(['D', 'b', 'c', 'ns', 'q', 'w', '*proj.src.all']) AS local_name, unnest(['proj.src.lib.x.default', 'proj.src.lib.x.a', 'proj.src.lib.x.c', 'm.n', 'proj.u', 'proj.src.y.z', 'proj.src.all']) AS full_name,
unnest([false, false, false, false, false, false, true]) AS is_wildcard FROM m""")(lambda d: javascript.imports(scripts(d), "proj"))
on_table("E16", "part", PARTS + "SELECT qn AS module_qn, qn||'.'||n AS qualified_name, n AS name, kind FROM (SELECT qn, unnest(['f'||k, 'g', 'h', 'i']) AS n, unnest(['es6', 'es6', 'commonjs', 'commonjs']) AS kind FROM m)")(lambda d: javascript.exported_functions(scripts(d), "proj"))
