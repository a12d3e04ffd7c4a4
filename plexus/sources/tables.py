"""The deterministic property graph over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plexus.plans.graph import PropertyGraph, new_folder

KIND = 10_000_000_000
#: Column and type of every node property.
PROPS = {"node_id": "bigint", "label": "string", "qualified_name": "string", "name": "string", "path": "string", "extension": "string", "start_line": "bigint", "end_line": "bigint", "docstring": "string", "decorators": "array<string>"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Where the calls of a session's folders of tables are written.
_CALLS: dict[tuple[str, str], str] = {}


def stored_calls(spark: SparkSession, sf_dir: str, called: DataFrame) -> DataFrame:
    """The calls, a self-join of the largest table, written once a session, as nearly every graph query reads them."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _CALLS:
        at = new_folder(spark, "calls")
        called.repartition("a").write.parquet(at)
        _CALLS[key] = at
    return spark.read.schema(called.schema).parquet(_CALLS[key])


def _node(df: DataFrame, kind: int, label: str, key: Column, **props: Column) -> DataFrame:
    have = {"node_id": F.lit(kind * KIND) + key, "label": F.lit(label), **props}
    return df.select(*[have.get(c, F.lit(None)).cast(t).alias(c) for c, t in PROPS.items()])


def graph(spark: SparkSession, sf_dir: str) -> PropertyGraph:
    t = lambda name: read(spark, sf_dir, name)
    c, text = F.col, lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    # nation and region have fixed sizes; the number of suppliers is one row.
    nation = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    supplier = t("supplier").join(F.broadcast(nation), c("s_nationkey") == c("n_nationkey"))
    module_qn = text("r", c("n_regionkey"), ".n", c("n_nationkey"), ".s", c("s_suppkey"))
    modules = supplier.select("s_suppkey", "s_name", "n_regionkey", module_qn.alias("module_qn"), text("r", c("n_regionkey"), "/n", c("n_nationkey"), "/s", c("s_suppkey"), ".py").alias("module_path"))
    many = t("supplier").agg(F.count("*").alias("many"))
    homes = t("part").crossJoin(F.broadcast(many)).withColumn("home", c("p_partkey") % c("many"))
    parts = homes.join(modules, c("home") == c("s_suppkey"))
    function = F.when(c("p_partkey") % 11 == 0, text("test_p", c("p_partkey"))).otherwise(text("p", c("p_partkey")))
    customer = t("customer").join(F.broadcast(nation), c("c_nationkey") == c("n_nationkey"))
    class_qn = text("r", c("n_regionkey"), ".n", c("n_nationkey"), ".c", c("c_custkey"))
    methods = t("orders").select("o_custkey", (c("o_orderkey") % 7).alias("m")).distinct()
    classes = customer.select("c_custkey", "c_name", class_qn.alias("class_qn"))
    brands = t("part").select("p_brand").distinct().withColumn("b", F.row_number().over(Window.orderBy("p_brand")) - 1)  # a fixed list of brands
    start = c("p_partkey") % 97 + 1
    nodes = [
        _node(t("region"), 1, "Project", c("r_regionkey"), qualified_name=text("r", c("r_regionkey")), name=c("r_name")),
        _node(nation, 2, "Package", c("n_nationkey"), qualified_name=text("r", c("n_regionkey"), ".n", c("n_nationkey")), name=c("n_name"), path=text("r", c("n_regionkey"), "/n", c("n_nationkey"))),
        _node(modules, 3, "Module", c("s_suppkey"), qualified_name=c("module_qn"), name=c("s_name"), path=c("module_path")),
        _node(parts, 4, "Function", c("p_partkey"), qualified_name=text(c("module_qn"), ".", function), name=function, start_line=start, end_line=start + c("p_size"), docstring=c("p_name"), decorators=F.array(F.lower("p_type"), F.lower("p_brand"))),
        _node(classes, 5, "Class", c("c_custkey"), qualified_name=c("class_qn"), name=c("c_name")),
        _node(methods.join(classes, c("o_custkey") == c("c_custkey")), 6, "Method", c("o_custkey") * 7 + c("m"), qualified_name=text(c("class_qn"), ".m", c("m")), name=text("m", c("m"))),
        _node(t("documents"), 7, "File", c("doc_id"), path=text(c("source"), "/", c("lang"), "/", c("doc_id"), ".txt"), extension=F.lit(".txt")),
        _node(brands, 8, "ExternalPackage", c("b"), name=c("p_brand")),
    ]

    def edge(df: DataFrame, kind: str, s: int, a: Column, d: int, b: Column, spec: Column | None = None) -> DataFrame:
        return df.select((F.lit(s * KIND) + a).cast("bigint").alias("src"), (F.lit(d * KIND) + b).cast("bigint").alias("dst"), F.lit(kind).alias("type"), (F.lit(None) if spec is None else spec).cast("string").alias("version_spec"))

    line = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    one, two = line.filter("l_linenumber = 1").drop("l_linenumber"), line.filter("l_linenumber = 2").drop("l_linenumber")

    called = one.select("l_orderkey", c("l_partkey").alias("a")).join(two.select("l_orderkey", c("l_partkey").alias("b")), "l_orderkey").select("a", "b").distinct()
    called = stored_calls(spark, sf_dir, called)
    # A few imports a module, some of them mutual, so that import chains of any length can be listed at any scale.
    s = c("s_suppkey")
    imported = t("supplier").select(F.explode(F.array(*[F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b")) for a, b in ((s, F.floor(s / 2)), (s, F.floor(s / 3)), (F.floor(s / 5), s))])).alias("e")).select("e.*").filter("a >= 1 AND b >= 1").distinct()

    brand_use = parts.groupBy("n_regionkey", "p_brand").agg(F.min("p_size").alias("least")).join(F.broadcast(brands), "p_brand")
    edges = [
        edge(nation, "CONTAINS_PACKAGE", 1, c("n_regionkey"), 2, c("n_nationkey")),
        edge(t("supplier"), "CONTAINS_MODULE", 2, c("s_nationkey"), 3, c("s_suppkey")),
        edge(homes, "DEFINES", 3, c("home"), 4, c("p_partkey")),
        edge(methods, "DEFINES_METHOD", 5, c("o_custkey"), 6, c("o_custkey") * 7 + c("m")),
        edge(called, "CALLS", 4, c("a"), 4, c("b")),
        edge(imported, "IMPORTS", 3, c("a"), 3, c("b")),
        edge(t("customer").filter("c_custkey >= 1"), "INHERITS", 5, c("c_custkey"), 5, F.floor(c("c_custkey") / 2)),
        edge(brand_use, "DEPENDS_ON_EXTERNAL", 1, c("n_regionkey"), 8, c("b"), text("size>=", c("least"))),
    ]
    union = lambda dfs: dfs[0] if len(dfs) == 1 else union(dfs[:-1]).unionByName(dfs[-1])
    return PropertyGraph(union(nodes), union(edges))


#: The same graph in SQL, as common table expressions.
GRAPH_SQL = """
WITH RECURSIVE mods AS (SELECT s_suppkey, s_name, n_regionkey, 'r'||n_regionkey||'.n'||n_nationkey||'.s'||s_suppkey AS qn, 'r'||n_regionkey||'/n'||n_nationkey||'/s'||s_suppkey||'.py' AS path FROM supplier JOIN nation ON s_nationkey = n_nationkey),
prt AS (SELECT part.*, p_partkey % (SELECT count(*) FROM supplier) AS home, CASE WHEN p_partkey % 11 = 0 THEN 'test_p'||p_partkey ELSE 'p'||p_partkey END AS fn FROM part),
cls AS (SELECT c_custkey, c_name, 'r'||n_regionkey||'.n'||n_nationkey||'.c'||c_custkey AS qn FROM customer JOIN nation ON c_nationkey = n_nationkey),
mth AS (SELECT DISTINCT o_custkey, o_orderkey % 7 AS m FROM orders),
brands AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS b FROM (SELECT DISTINCT p_brand FROM part)),
nodes AS (
SELECT 10000000000 + r_regionkey AS node_id, 'Project' AS label, 'r'||r_regionkey AS qualified_name, r_name AS name, NULL::VARCHAR AS path, NULL::VARCHAR AS extension, NULL::BIGINT AS start_line, NULL::BIGINT AS end_line, NULL::VARCHAR AS docstring, NULL::VARCHAR[] AS decorators FROM region
UNION ALL SELECT 20000000000 + n_nationkey, 'Package', 'r'||n_regionkey||'.n'||n_nationkey, n_name, 'r'||n_regionkey||'/n'||n_nationkey, NULL, NULL, NULL, NULL, NULL FROM nation
UNION ALL SELECT 30000000000 + s_suppkey, 'Module', qn, s_name, path, NULL, NULL, NULL, NULL, NULL FROM mods
UNION ALL SELECT 40000000000 + p_partkey, 'Function', qn||'.'||fn, fn, NULL, NULL, p_partkey % 97 + 1, p_partkey % 97 + 1 + p_size, p_name, [lower(p_type), lower(p_brand)] FROM prt JOIN mods ON home = s_suppkey
UNION ALL SELECT 50000000000 + c_custkey, 'Class', qn, c_name, NULL, NULL, NULL, NULL, NULL, NULL FROM cls
UNION ALL SELECT 60000000000 + o_custkey * 7 + m, 'Method', qn||'.m'||m, 'm'||m, NULL, NULL, NULL, NULL, NULL, NULL FROM mth JOIN cls ON o_custkey = c_custkey
UNION ALL SELECT 70000000000 + doc_id, 'File', NULL, NULL, source||'/'||lang||'/'||doc_id||'.txt', '.txt', NULL, NULL, NULL, NULL FROM documents
UNION ALL SELECT 80000000000 + b, 'ExternalPackage', NULL, p_brand, NULL, NULL, NULL, NULL, NULL, NULL FROM brands),
edges AS (
SELECT 10000000000 + n_regionkey AS src, 20000000000 + n_nationkey AS dst, 'CONTAINS_PACKAGE' AS type, NULL::VARCHAR AS version_spec FROM nation
UNION ALL SELECT 20000000000 + s_nationkey, 30000000000 + s_suppkey, 'CONTAINS_MODULE', NULL FROM supplier
UNION ALL SELECT 30000000000 + home, 40000000000 + p_partkey, 'DEFINES', NULL FROM prt
UNION ALL SELECT 50000000000 + o_custkey, 60000000000 + o_custkey * 7 + m, 'DEFINES_METHOD', NULL FROM mth
UNION ALL SELECT DISTINCT 40000000000 + x.l_partkey, 40000000000 + y.l_partkey, 'CALLS', NULL FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND x.l_linenumber = 1 AND y.l_linenumber = 2
UNION ALL SELECT DISTINCT 30000000000 + a, 30000000000 + b, 'IMPORTS', NULL FROM (SELECT s_suppkey AS a, s_suppkey // 2 AS b FROM supplier UNION ALL SELECT s_suppkey, s_suppkey // 3 FROM supplier UNION ALL SELECT s_suppkey // 5, s_suppkey FROM supplier) WHERE a >= 1 AND b >= 1
UNION ALL SELECT 50000000000 + c_custkey, 50000000000 + c_custkey // 2, 'INHERITS', NULL FROM customer WHERE c_custkey >= 1
UNION ALL SELECT 10000000000 + n_regionkey, 80000000000 + b, 'DEPENDS_ON_EXTERNAL', 'size>='||min(p_size) FROM prt JOIN mods ON home = s_suppkey JOIN brands USING (p_brand) GROUP BY n_regionkey, b),
fm AS (SELECT * FROM nodes WHERE label IN ('Function', 'Method')),
calls AS (SELECT src, dst FROM edges WHERE type = 'CALLS')
"""
