import json
import shlex

import pytest

from plexus.functions import names as N
from plexus.operators import extract, javascript, types
from plexus.operators.commands import fault, groups, needs_approval, validated
from plexus.plans.graph import PropertyGraph
from plexus.sources import files, manifests, sinks
from plexus.streaming import jobs
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def graph_file(tmp_path_factory):
    doc = {
        "nodes": [
            {"node_id": i, "labels": [label], "properties": p}
            for i, label, p in [(1, "Function", {"name": "foo", "qualified_name": "mod.foo"}), (2, "Function", {"name": "bar"}), (3, "Class", {"name": "K"}), (4, "Module", {"path": "mod.py", "decorators": ["a"]})]
        ],
        "relationships": [{"from_id": 4, "to_id": i, "type": "DEFINES", "properties": {}} for i in (1, 2, 3)] + [{"from_id": 1, "to_id": 2, "type": "CALLS", "properties": {"line": 10}}],
        "metadata": {"total_nodes": 4},
    }
    at = tmp_path_factory.mktemp("g") / "graph.json"
    at.write_text(json.dumps(doc, indent=1))
    return str(at)


def test_json_graph(spark, graph_file, tmp_path):
    g = files.json_graph(spark, graph_file)
    assert g.label("Function").count() == 2
    assert [r[0] for r in g.nodes.filter(files.prop("name") == "foo").select("node_id").collect()] == [1]
    assert g.of_type("CALLS").select("src", "dst", files.prop("line", "int")).first()[:] == (1, 2, 10)
    assert g.nodes.filter("label = 'Module'").select(files.prop("qualified_name")).first()[0] is None
    sinks.write_graph(g.nodes.select("node_id", "labels", F.create_map(F.lit("name"), files.prop("name")).alias("properties")), g.edges.select(F.col("src").alias("from_id"), F.col("dst").alias("to_id"), "type"), str(tmp_path), "2026-01-01T00:00:00Z")
    again = files.json_graph(spark, str(tmp_path), lines=True)
    assert (again.nodes.count(), again.edges.count()) == (4, 4)
    assert spark.read.json(f"{tmp_path}/metadata").first()["total_relationships"] == 4


def test_lists(spark, tmp_path):
    (tmp_path / "l").write_text("# no\n\n  12 \n7\n12\n")
    assert sorted(r[0] for r in files.node_ids(spark, f"{tmp_path}/l").collect()) == [7, 12]
    (tmp_path / "u").write_text("https://github.com/a/b.git\ngit@github.com:c/d\nnonsense\n")
    assert sorted((r.owner, r.name) for r in files.repo_urls(spark, f"{tmp_path}/u").collect()) == [("a", "b"), ("c", "d")]
    (tmp_path / "q").write_text('{"q": "x"}\n{bad\n\n{"q": "y"}\n')
    assert sorted(r.q for r in files.json_lines(spark, f"{tmp_path}/q", "q string").collect()) == ["x", "y"]


def test_tree(spark, tmp_path):
    for p in ("a.py", "src/b.py", "node_modules/c.js", "bin/keep/d.py", "src/e.pyc", "src/gen/f.py"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text("x")
    got = lambda **k: sorted(r.path for r in files.scan_tree(spark, str(tmp_path), **k).collect())
    assert got() == ["a.py", "src/b.py", "src/gen/f.py"]
    assert got(exclude=("gen",), include=("bin/keep",)) == ["a.py", "bin/keep/d.py", "src/b.py"]


MANIFESTS = {
    "x/pyproject.toml": ('[project]\ndependencies=["a[x]>=1", "b"]\n[project.optional-dependencies]\nt=["c~=2"]\n[tool.poetry.dependencies]\npython="3"\nd="^1"', [("a", "a[x]>=1", None), ("b", "b", None), ("c", "c~=2", "t"), ("d", "^1", None)]),
    "requirements.txt": ("# c\n-r x\nflask[async]==2 # z\n\nnumpy", [("flask", "==2 # z", None), ("numpy", "", None)]),
    "package.json": ('{"dependencies":{"a":"1"},"devDependencies":{"b":"2"},"peerDependencies":{"c":"3"}}', [("a", "1", None), ("b", "2", None), ("c", "3", None)]),
    "Cargo.toml": ('[dependencies]\na="1"\nb={version="2",features=[]}\n[dev-dependencies]\nc={path="x"}', [("a", "1", None), ("b", "2", None), ("c", "", None)]),
    "go.mod": ("module m\nrequire x/y v1\nrequire (\n// n\na/b v2 // indirect\nc //d\n)\nexclude z v9", [("a/b", "v2", None), ("x/y", "v1", None)]),
    "Gemfile": ("gem 'a', '~> 1'\ngem \"b\"\n# gem 'c'", [("a", "~> 1", None), ("b", "", None)]),
    "composer.json": ('{"require":{"php":"8","a":"1"},"require-dev":{"b":"2"}}', [("a", "1", None), ("b", "2", None)]),
    "p.csproj": ('<Project><PackageReference Include="A" Version="1"/><PackageReference Include="B"/><PackageReference/></Project>', [("A", "1", None), ("B", "", None)]),
    "other.txt": ("a==1", []),
    "bad/package.json": ("{", []),
}


def test_manifests(spark):
    rows = spark.createDataFrame([(p, t) for p, (t, _) in MANIFESTS.items()] + [("go.mod", None)], "path string, content string")
    got = {p: [] for p in MANIFESTS}
    for r in manifests.dependencies(rows).collect():
        got[r.path].append((r.name, r.spec, r.grp))
    assert {p: sorted(v, key=str) for p, v in got.items()} == {p: sorted(w, key=str) for p, (_, w) in MANIFESTS.items()}


@pytest.mark.parametrize(
    ("cmd", "word"),
    [("ls -la", None), ("git log | head", None), ("git push", "Git sub"), ("ls; rm", "chains"), ('ls "a;b"', None), (r"ls a\;b", "chains"), ('grep "a|b" x | wc', None), ("find . | xargs rm", "after pipe"), ("ls > x", "Redirects"), (" ", "Empty"), ("ls 'a", "Failed"), ("cat `x`", "Subshells"), ("ls &", "Background"), ("rm x", "allowlist"), ("git", None), (None, "Empty"), ("ls | awk x", "after pipe")],
)
def test_commands(cmd, word):
    assert (fault(cmd) is None) if word is None else word in fault(cmd)
    assert fault("ls | awk x", risky=True) is None


def test_commands_in_spark(spark):
    rows = spark.createDataFrame([("ls",), ("rm x",), (None,)], "cmd string").select(validated(F.col("cmd")).alias("r")).select("r.*")
    assert [r.valid for r in rows.collect()] == [True, False, False]
    assert shlex.split("ls") == ["ls"]


def test_upserts(spark):
    batch = spark.createDataFrame([("Function", "a", {"x": "1", "y": "1"}, 1), ("Function", "a", {"x": "2"}, 2), ("Odd", "b", {"x": "1"}, 3), ("Function", None, {"x": "1"}, 4), ("Class", "c", {}, 5), ("Function", "a", {"y": None}, 6)], "label string, key string, props map<string,string>, seq long")
    assert {(r.label, r.key): r.props for r in sinks.merged_nodes(batch).collect()} == {("Function", "a"): {"x": "2"}, ("Class", "c"): {}}
    first = {r.key: (r.node_id, r.props) for r in sinks.first_nodes(batch.filter("key IS NOT NULL AND label != 'Odd'")).collect()}
    assert first == {"a": (0, {"x": "1", "y": "1"}), "c": (1, {})}
    nodes = spark.createDataFrame([(1, "Function", "a"), (2, "Function", "b")], "node_id long, label string, key string")
    specs = spark.createDataFrame([("Function", "a", "CALLS", "Function", "b"), ("Function", "a", "CALLS", "Function", "b"), ("Function", "a", "CALLS", "Class", "b")], "from_label string, from_key string, type string, to_label string, to_key string")
    edges, lost = sinks.resolved_edges(specs, nodes)
    assert [tuple(r) for r in edges.collect()] == [(1, 2, "CALLS")]
    assert [tuple(r) for r in sinks.failed_report(specs, lost).collect()] == [("CALLS", 3, 1)]


def test_replies_and_durations(spark):
    one = lambda col: spark.range(1).select(col.alias("x")).first()[0]
    assert one(N.llm_json(F.lit('```json\n{"a": 1}\n```'), "a int")).a == 1
    assert one(N.cypher_reply(F.lit("```cypher MATCH (n) RETURN n```"))) == "MATCH (n) RETURN n;"
    assert [one(N.duration(F.lit(x))) for x in (5, 187, 7500)] == ["5s", "3m 7s", "2h 5m"]
    assert N.weights("a:4, b:3,zz:1,c", ("a", "b", "c")) == {"a": 4, "b": 3}


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [("git log -1", "r", "", 0), ("git log", "r", "bad 12", 1), ("git log", "r", "bad 99", 1)]
    (tmp_path / "in/a.json").write_text("\n".join(json.dumps(dict(cmd=c, repo=r, stdout="", stderr=e, return_code=k, duration_ms=1.0, cached=False)) for c, r, e, k in rows))
    for name, job in (("prefixes", jobs.prefix_totals), ("errors", jobs.error_totals)):
        q = job(jobs.results(spark, f"{tmp_path}/in")).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
        q.awaitTermination()
    assert [(r.prefix, r.total, r.failed) for r in spark.table("prefixes").collect()] == [("git log", 3, 2)]
    assert [(r.pattern, r.n) for r in spark.table("errors").collect()] == [("bad {num}", 2)]


def test_file_events(spark, tmp_path):
    (tmp_path / "ev").mkdir()
    ev = [("created", "a.py", False, 1), ("deleted", "a.py", False, 2), ("modified", "b.py", False, 3), ("modified", "venv/c.py", False, 4), ("modified", "d", True, 5)]
    (tmp_path / "ev/1.json").write_text("\n".join(json.dumps(dict(zip(("event_type", "path", "is_directory", "ts"), e, strict=True))) for e in ev))
    seen = []
    events = spark.readStream.schema("event_type string, path string, is_directory boolean, ts long").json(f"{tmp_path}/ev")
    jobs.follow(events, lambda batch, n: seen.extend((r.path, r.event_type) for r in batch.collect()), f"{tmp_path}/cp").awaitTermination()
    assert sorted(seen) == [("a.py", "deleted"), ("b.py", "modified")]
    changed = spark.createDataFrame(seen, "path string, event_type string")
    assert [r.path for r in jobs.to_parse(changed).collect()] == ["b.py"]
    nodes = spark.createDataFrame([(1, "Module", "a.py"), (2, "Function", None), (3, "Module", "z.py"), (4, "Function", None)], "node_id long, label string, path string")
    edges = spark.createDataFrame([(1, 2, "DEFINES"), (3, 4, "DEFINES"), (4, 2, "CALLS")], "src long, dst long, type string")
    rest = jobs.without_changed(PropertyGraph(nodes, edges), changed)
    assert sorted(r.node_id for r in rest.nodes.collect()) == [3, 4]
    assert [tuple(r) for r in rest.edges.select("src", "dst", "type").collect()] == [(3, 4, "DEFINES")]


@pytest.mark.parametrize(
    ("cmd", "want", "ask"),
    [
        ("ls | wc && git log", [(None, ["ls", "wc"]), ("&&", ["git log"])], False), ("; ls", [(";", ["ls"])], False), ('echo "a|b;c"', [(None, ['echo "a|b;c"'])], False), (r"ls a\;b", [(None, [r"ls a\;b"])], False),
        ("ls || rm x", [(None, ["ls"]), ("||", ["rm x"])], True), ("cat < x", [(None, ["cat < x"])], True), ("", [], True), ("ls 'a", [(None, ["ls 'a"])], True), ("git push", [(None, ["git push"])], True),
    ],
)
def test_command_groups(cmd, want, ask):
    assert groups(cmd) == want
    assert needs_approval(cmd) is ask


def test_extraction(spark):
    code = "from . import s\nfrom ..u import v as w\nasync def a():\n    class B(x.Y, Z[int]):\n        @p.q\n        def m(self): super().m()\n    return lambda: b()[0].c()\nif True:\n    def d(): pass\n"
    rows = spark.createDataFrame([("k/t.py", code), ("bad.py", "def ("), ("null.py", None), ("x.txt", "def f(): pass"), ("empty.py", ""), ("nul.py", "a\0")], "path string, content string")
    got = extract.extracted(rows, "P").collect()
    kind = lambda *k: {tuple(getattr(r, c) for c in k[1:]) for r in got if r.kind == k[0]}
    assert kind("Function", "qualified_name", "parent") == {("P.k.t.a", "P.k.t"), ("P.k.t.d", "P.k.t")}
    assert kind("Class", "qualified_name") == {("P.k.t.a.B",)} and [r.bases for r in got if r.kind == "Class"] == [["x.Y"]]
    assert kind("Method", "qualified_name", "parent") == {("P.k.t.a.B.m", "P.k.t.a.B")}
    assert kind("import", "name", "full_name") == {("s", "P.k.s"), ("w", "P.u.v")}
    assert kind("call", "parent", "call_name") == {("P.k.t.a.B.m", "super"), ("P.k.t.a.B.m", "m"), ("P.k.t.a", "b"), ("P.k.t.a", "c")}
    assert {r.path for r in got if r.kind == "error"} == {"bad.py", "nul.py"}


def test_structure_and_texts(spark):
    paths = spark.createDataFrame([("a/__init__.py",), ("a/b/c.py",), ("top.py",)], "path string")
    nodes, edges = extract.structure(paths, "P")
    assert {(r.label, r.key) for r in nodes.filter("label != 'File'").collect()} == {("Package", "P.a"), ("Folder", "a/b")}
    assert {tuple(r) for r in edges.select("from_key", "type", "to_key").collect()} == {("P", "CONTAINS_PACKAGE", "P.a"), ("P.a", "CONTAINS_FOLDER", "a/b"), ("P.a", "CONTAINS_FILE", "a/__init__.py"), ("a/b", "CONTAINS_FILE", "a/b/c.py"), ("P", "CONTAINS_FILE", "top.py")}
    located = spark.createDataFrame([(1, "Function", "f", 2, 9), (2, "Function", "f", 4, 5), (3, None, "f", 1, 1), (4, "Folder", None, None, None), (5, "Function", None, 1, 1), (6, "Function", "g", 1, 1)], "node_id long, label string, path string, start_line long, end_line long")
    got = {r.node_id: (r.text, r.error) for r in extract.texts(located, spark.createDataFrame([("f", "x\r\ny\nz")], "path string, content string")).collect()}
    assert got == {1: ("y\nz", None), 2: (None, "out of range"), 3: (None, "unknown"), 4: (None, "structural"), 5: (None, "no module"), 6: (None, "unreadable")}


def test_edits(spark):
    code = "def f():\n    return 1\nclass A:\n    def f(self):\n        return 2\n"
    src = spark.createDataFrame([("a.py", code), ("null.py", None)], "path string, content string")
    asked = spark.createDataFrame([(1, "a.py", "f", None), (2, "a.py", "f", 4), (3, "a.py", "A.f", None), (4, "a.py", "f", 99), (5, "a.py", "g", None), (6, "null.py", "f", None)], "id int, path string, name string, line long")
    got = {r.id: r.qualified_name for r in extract.function_sources(asked, extract.extracted(src, "P"), src).collect()}
    assert got == {1: "P.a.f", 2: "P.a.A.f", 3: "P.a.A.f", 4: "P.a.f"}
    rows = spark.createDataFrame([("xax", "a", "b"), ("aa", "a", ""), ("x", "a", "b"), ("a", "a", "a"), (None, "a", "b"), ("a", "", "b")], "t string, a string, b string")
    assert [r[0] for r in rows.select(extract.replaced_first(F.col("t"), F.col("a"), F.col("b"))).collect()] == ["xbx", "a", None, None, None, None]
    texts = spark.createDataFrame([("a\nb", "a\nc"), ("a", "a"), (None, "a")], "x string, y string")
    assert [r[0] for r in texts.select(extract.unified_diff("x", "y", F.lit("p"))).collect()] == ["--- a/p\n+++ b/p\n@@ -1,2 +1,2 @@\n a\n-b\n+c", "", None]


def test_types(spark):
    one = """from b import Base, make
class K(Base):
    def __init__(self): self.h = Help()
    def m(self): return self.h.go()
    def up(self): return super().base()
class Help:
    def go(self) -> "K": ...
def f(a: K, o: Help | None):
    x = a.m()
    x.m().up()
    y = make().base()
    for z in [K()]: z.base()
    with open("p") as q: q.read()
    return x
def g(): f(1, 2).up(); loop()
def loop(): return loop()
"""
    two = "class Base:\n    def base(self): return self\ndef make(): return Base()\n"
    src = spark.createDataFrame([("a.py", one), ("b.py", two), ("bad.py", "def ("), ("null.py", None), ("empty.py", "")], "path string, content string")
    rows = extract.extracted(src, "P")
    imports = extract.local_imports(rows, spark.createDataFrame([("b",)], "root string"), "P")
    known, reached = types.inferred(types.bindings(src, "P"), imports, rows)
    got = {(r.at, r.var): r.cls for r in known.collect() if r.var[0] != "%" and r.var != "self"}
    assert got == {
        ("P.a.K", "self.h"): "P.a.Help", ("P.a.f", "a"): "P.a.K", ("P.a.f", "o"): "P.a.Help", ("P.a.f", "x"): "P.a.K", ("P.a.f", "y"): "P.b.Base", ("P.a.f", "z"): "P.a.K", ("P.a.Help.go", "<return>"): "P.a.K",
        ("P.a.K.m", "<return>"): "P.a.K", ("P.a.K.up", "<return>"): "P.b.Base", ("P.a.f", "<return>"): "P.a.K", ("P.b.Base.base", "<return>"): "P.b.Base", ("P.b.make", "<return>"): "P.b.Base",
    }
    assert sorted((r.line, r.callee) for r in reached.collect()) == [
        (4, "P.a.Help.go"), (5, "P.b.Base.base"), (9, "P.a.K.m"), (10, "P.a.K.m"), (10, "P.a.K.up"), (11, "P.b.Base.base"), (11, "P.b.make"), (12, "P.b.Base.base"), (15, "P.a.K.up"), (15, "P.a.f"), (15, "P.a.loop"), (16, "P.a.loop"),
    ]


def test_scripts(spark):
    code = """import type { T } from "./t"
import {
  one,
  two as deux,
} from '../k/l';
const u = 'http://x'; /* export * from 'no'
*/ export default async function main() {}
let p = require("pkg")
export const h = async ({ a, b }: P): Q => 1
  exports.inner = () => 1
export const n = 3
export * as all from './z'
"""
    src = spark.createDataFrame([("a/b.ts", code), ("n.js", None), ("e.js", ""), ("c.py", "import x from 'y'")], "path string, content string")
    got = {(r.local_name, r.full_name, r.is_wildcard) for r in javascript.imports(src, "P").collect()}
    assert got == {("T", "P.a.t.T", False), ("one", "P.k.l.one", False), ("deux", "P.k.l.two", False), ("p", "pkg", False), ("all", "P.a.z", False)}
    assert {r.name for r in javascript.exported_functions(src, "P").collect()} == {"h"}
