"""Readers of graphs, lists, logs and directory trees; every one is a scan that Spark plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.functions.names import repo_of_url
from plexus.plans.graph import PropertyGraph

#: Directories never scanned and suffixes never read, fixed values.
IGNORED_DIRS = (
    ".cache", ".claude", ".eclipse", ".eggs", ".env", ".git", ".gradle", ".hg", ".idea", ".maven", ".mypy_cache", ".nox", ".npm", ".nyc_output", ".pnpm-store", ".pytest_cache", ".ruff_cache", ".svn", ".tmp", ".tox", ".venv", ".vs", ".vscode", ".yarn",
    "__pycache__", "bin", "bower_components", "build", "coverage", "dist", "env", "htmlcov", "node_modules", "obj", "out", "Pods", "site-packages", "target", "temp", "tmp", "vendor", "venv",
)
IGNORED_SUFFIXES = (".tmp", "~", ".pyc", ".pyo", ".o", ".a", ".so", ".dll", ".class")

NODE = "node_id bigint, labels array<string>, properties string"
EDGE = "from_id bigint, to_id bigint, type string, properties string"
RESULT = "cmd string, repo string, stdout string, stderr string, return_code int, duration_ms double, cached boolean"


def json_graph(spark: SparkSession, path: str, lines: bool = False) -> PropertyGraph:
    """Nodes (node_id, labels, label, properties) and edges (src, dst, type, properties); properties are JSON text.

    A single document is one task's work, whatever reads it; ``lines`` reads the folders that ``sinks.write_graph``
    leaves, which split.
    """
    if lines:
        nodes, edges = (spark.read.schema(s).json(f"{path}/{d}") for d, s in (("nodes", NODE), ("relationships", EDGE)))
    else:
        doc = spark.read.schema(f"nodes array<struct<{NODE}>>, relationships array<struct<{EDGE}>>").option("multiLine", True).json(path)
        nodes, edges = doc.select(F.inline("nodes")), doc.select(F.inline("relationships"))
    return PropertyGraph(
        nodes.select("node_id", "labels", F.get("labels", F.lit(0)).alias("label"), "properties"),
        edges.select(F.col("from_id").alias("src"), F.col("to_id").alias("dst"), "type", "properties"),
    )


def prop(name: str, kind: str = "string") -> Column:
    """A property of a JSON graph's row; null where it is missing."""
    return F.get_json_object("properties", f"$.{name}").cast(kind)


def entries(lines: DataFrame) -> DataFrame:
    """Value: trimmed lines, without blank ones and comments, each once. lines: value."""
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    return lines.select(line.alias("value")).filter("value != '' AND NOT startswith(value, '#')").distinct()


def listed(spark: SparkSession, path: str) -> DataFrame:
    """S10 of a text file."""
    return entries(spark.read.text(path))


def as_node_ids(lines: DataFrame) -> DataFrame:
    """node_id; a line that is no number is an error, as silent loss would shrink the extraction."""
    return entries(lines).select(F.col("value").cast("bigint").alias("node_id"))


def node_ids(spark: SparkSession, path: str) -> DataFrame:
    return as_node_ids(spark.read.text(path))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of well-formed lines; others are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_rows(lines: DataFrame, col: str, schema: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """S13-S15 for lines in a column: the columns of ``keep`` and those of ``schema``; malformed lines are left out."""
    good = lines.filter(F.try_parse_json(F.col(col)).isNotNull())
    return good.select(*keep, F.from_json(col, schema).alias("_v")).select(*keep, "_v.*")


def command_results(spark: SparkSession, path: str) -> DataFrame:
    """S14."""
    return spark.read.schema(RESULT).json(path)


def command_inputs(spark: SparkSession, path: str) -> DataFrame:
    """S15."""
    return spark.read.schema("cmd string, repo string").json(path)


def repos_in(lines: DataFrame) -> DataFrame:
    """Url, owner, name of the lines (value) that are hosting URLs."""
    own = entries(lines).select("value", F.split(repo_of_url(F.col("value")), "/").alias("p")).filter("p IS NOT NULL")
    return own.select(F.col("value").alias("url"), F.col("p")[0].alias("owner"), F.col("p")[1].alias("name"))


def repo_urls(spark: SparkSession, path: str) -> DataFrame:
    return repos_in(spark.read.text(path))


def wanted_repos(repos: DataFrame, languages: tuple[str, ...], least_stars: int, most_kb: int, most: int | None = None) -> DataFrame:
    """Repos (name, language, stars, size_kb, supported) of these languages that are supported, popular and small enough.

    ``most`` keeps those of most stars, then by name.
    """
    own = repos.filter(F.col("supported") & (F.col("stars") >= least_stars) & (F.col("size_kb") <= most_kb))
    own = own.filter(F.col("language").isin(*languages)) if languages else own
    return own if most is None else own.orderBy(F.desc("stars"), "name").limit(most)


def kept_path(path: Column, exclude: tuple[str, ...] = (), include: tuple[str, ...] = ()) -> Column:
    """Whether a relative file path is scanned. An included path or folder wins over excluded folders, not over suffixes."""
    dirs = F.slice(F.split(path, "/"), 1, F.size(F.split(path, "/")) - 1)
    clean = ~F.arrays_overlap(dirs, F.array(*map(F.lit, (*IGNORED_DIRS, *exclude))))
    wanted = F.lit(False)
    for i in include:
        wanted = wanted | (path == i) | path.startswith(i.rstrip("/") + "/")
    named = F.lit(False)
    for s in IGNORED_SUFFIXES:
        named = named | path.endswith(s)
    return ~named & (clean | wanted)


def scan_tree(spark: SparkSession, root: str, exclude: tuple[str, ...] = (), include: tuple[str, ...] = (), contents: bool = False) -> DataFrame:
    """Path (relative), length, modified and, if asked, content of the files under ``root``.

    Contents are read for the kept files only, as the path filter is below the projection.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = root.split("://", 1)[-1].rstrip("/") + "/"
    rel = F.substring_index(F.col("path"), base, -1)
    out = files.withColumn("path", rel).filter(kept_path(F.col("path"), exclude, include))
    return out.select("path", "length", F.col("modificationTime").alias("modified"), *([F.col("content").cast("string").alias("content")] if contents else []))
