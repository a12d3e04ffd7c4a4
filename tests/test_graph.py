import random

import duckdb
import pytest

from plexus import catalog
from plexus.functions import names as N
from plexus.operators import logs, paths, resolve, sampling
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SOME = ["S05", "P13", "J05_calls", "J06", "J07", "T03", "T07", "A06", "A12", "A13", "A14", "A23", "O05", "O06", "O07", "O09", "W08", "X03", "F07", "P01", "P03", "F01", "F06", "F08", "F12_1", "F12_2", "F12_3", "F16", "F18", "T06", "T09", "T10", "T12", "T13", "T10_capped", "T15", "T16", "T17", "T18", "T19", "W05", "A16", "A17_literal", "A17_production", "A24_failing", "A24_sorted", "A26", "A27", "A31_moving", "A32", "O12", "P19_failed", "T05", "T08", "T04", "J18", "F13", "F17", "F24", "F25", "F26", "F32", "F34", "A22", "A25", "O01", "O02", "K01", "K02", "K03", "K06", "K13", "A30", "A31", "W01", "J12", "J15", "J16", "J19", "J21", "J22", "W03", "T11", "T14", "T20", "O11", "F35", "S10", "S12", "S13", "S14", "S16", "S17", "S09", "T21", "S11", "E19", "K08", "K10", "P22", "F09", "F11", "F15", "F27", "F28", "F29", "F31", "F33", "F36", "R01", "R04", "R06", "R08", "R09", "E01", "E02", "E04", "E07", "E08", "E11", "E12", "E21", "E22", "E24", "E25", "S01", "K05", "K08_metadata", "K09_texts", "R05_stream", "R06_stream", "R07", "E10", "E12_typed", "E14", "E08_js", "E16", "E09", "E13", "E15", "E15_links", "E17_edges", "E17_exported", "E18", "E04_js", "E04_cpp", "E04_go", "E04_lua", "E07_java", "E08_cpp", "E08_lua", "E10_java", "E11_js", "E11_rust", "E12_cascade", "R01_stream", "R08_stream", "R09_stream", "K10_table", "F35_chunks", "F35_ascii"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages".split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SOME)
def test_query_equals_its_sql(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), duck.sql(catalog.SQL[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    rows = lambda df: sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))
    assert rows(got) == rows(want)


def graph(spark, edges):
    return spark.createDataFrame(edges, "src long, dst long")


def brute(edges, start, most):
    out = []

    def go(path):
        nxt = [b for a, b in edges if a == path[-1] and b not in path] if len(path) <= most else []
        if nxt:
            for b in nxt:
                go([*path, b])
        else:
            out.append(tuple(path))

    go([start])
    return sorted(out)


@pytest.mark.parametrize("most", [1, 2, 3, 4])
def test_maximal_paths_on_awkward_graphs(spark, most):
    import random

    rng = random.Random(most)
    edges = [(1, 2), (2, 3), (3, 1), (2, 2), (1, 2)] + [(rng.randrange(9), rng.randrange(9)) for _ in range(14)]
    starts = spark.createDataFrame([(i,) for i in range(9)], "node_id long")
    got = sorted(tuple(r["path"]) for r in paths.maximal_paths(graph(spark, edges), starts, most).collect())
    assert got == sorted(p for s in range(9) for p in brute(edges, s, most))


def test_trails_differ_from_walks_on_cycles(spark):
    e = graph(spark, [(1, 1), (1, 2), (2, 1)])
    assert paths.walks(e, 2).count() == 5 and paths.walks(e, 2, "trail").count() == 4 and paths.walks(e, 2, "simple").count() == 0


def test_inherited_method_takes_the_first_parent(spark):
    inherits = spark.createDataFrame([(1, 2, 0), (1, 3, 1), (2, 4, 0), (3, 4, 0)], "child long, parent long, ord int")
    methods = spark.createDataFrame([(1, "m", 10), (3, "m", 30), (4, "m", 40), (2, "k", 22), (4, "k", 44)], "cls long, name string, method long")
    got = {(r["cls"], r["name"]): (r["found"], r["depth"]) for r in resolve.ancestor_methods(inherits, methods, own=False).collect()}
    assert got == {(1, "m"): (30, 1), (3, "m"): (40, 1), (2, "k"): (44, 1)}


def test_calls_resolve_by_the_first_step_that_finds(spark):
    registry = spark.createDataFrame([("p.a.f", "f"), ("p.b.f", "f"), ("p.b.g", "g"), ("p.c.h", "h"), ("p.b.K.m", "m")], "qualified_name string, simple_name string")
    imports = spark.createDataFrame([("p.a", "g", "p.b.g", False), ("p.a", "K", "p.b.K", False), ("p.a", "*c", "p.c", True)], "module_qn string, local_name string, full_name string, is_wildcard boolean")
    calls = spark.createDataFrame([(1, "g", "p.a"), (2, "K.m", "p.a"), (3, "h", "p.a"), (4, "f", "p.a"), (5, "x.f", "p.b"), (6, "none", "p.a")], "id int, call_name string, module_qn string")
    got = {r["id"]: (r["callee"], r["step"]) for r in resolve.resolve_calls(calls, imports, registry).collect()}
    assert got == {1: ("p.b.g", 1), 2: ("p.b.K.m", 2), 3: ("p.c.h", 3), 4: ("p.a.f", 4), 5: ("p.b.f", 5)}


def test_packing_skips_and_goes_on(spark):
    chunks = spark.createDataFrame([(1, 1, 0, 40), (1, 2, 1, 90), (1, 3, 2, 10)], "seed long, node long, depth int, size int")
    assert sampling.packed(chunks, 60).first()["picked"] == "1,3"


def test_names(spark):
    one = lambda col: spark.range(1).select(col.alias("x")).first()["x"]
    lit = F.lit
    assert one(N.import_distance(lit("proj.pkg.sibling_mod.SomeClass.some_method"), lit("proj.pkg.caller_mod"))) == 2
    assert one(N.import_distance(lit("proj.pkg.sibling_mod.some_func"), lit("proj.pkg.caller_mod"))) == 1
    assert not one(N.has_prefix(lit("a.bc"), "a.b")) and one(N.has_prefix(lit("a.b"), "a.b"))
    assert one(N.command_prefix(lit("git -C x log"))) == "git x" and one(N.command_prefix(lit("grep -rn --color foo"))) == "grep -rn" and one(N.command_prefix(lit(" "))) == "unknown"
    assert one(N.normal_error(lit("fail at 12345678 line 7\nmore"))) == "fail at {hash} line {num}"
    assert one(N.js_path(lit("../b/c"), lit("p.x.y"))) == "p.b.c" and one(N.repo_of_url(lit("git@github.com:o/r.git"))) == "o/r"
    assert one(N.requirement_name(lit("pkg[extra]>=1.0"))) == "pkg" and one(N.requirement_spec(lit("pkg[extra]>=1.0"))) == ">=1.0"


def test_log_summary(spark):
    log = spark.createDataFrame([("ls", "r", 0, 10.0, False), ("grep foo", "r", 1, 20.0, False), ("ls", "r", 0, 0.0, True)], "cmd string, repo string, return_code int, duration_ms double, cached boolean")
    r = logs.summary(log).first()
    assert (r["total"], r["success"], r["failed"], r["cached"], r["avg_ms"]) == (3, 2, 1, 1, 15.0)


def test_nearest_of_a_simple_name_equals_brute_force(spark):
    import random

    rng = random.Random(3)
    name = lambda n: ".".join(rng.choice("ab") for _ in range(n))
    reg = sorted({f"{name(rng.randrange(1, 5))}.{rng.choice('fg')}" for _ in range(60)} | {"f"})
    calls = [(i, f"x.{rng.choice('fgh')}", name(rng.randrange(1, 5))) for i in range(80)]

    def distance(cand, caller):
        a, b = cand.split("."), caller.split(".")
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        parent = ".".join(b[:-1])
        return max(len(a), len(b)) - same - bool(parent and cand.startswith(parent + "."))

    want = {i: min((distance(q, m), q) for q in reg if q.split(".")[-1] == n[-1]) for i, n, m in calls if not n.endswith("h")}
    got = resolve.by_simple_name(spark.createDataFrame(calls, "id long, call_name string, module_qn string"), spark.createDataFrame([(q, q.split(".")[-1]) for q in reg], "qualified_name string, simple_name string"))
    assert {r.id: (r.distance, r.callee) for r in got.collect()} == want


def test_context_text(spark):
    from plexus.operators.render import graph_context
    from plexus.plans.graph import PropertyGraph

    nodes = spark.createDataFrame([(1, "Module", "m", "a.py", "m"), (2, "Function", "f", None, "m.f"), (3, "Function", "g", None, "m.g"), (4, "Class", "K", None, "m.K"), (5, "Class", "L", None, "n.L")], "node_id long, label string, name string, path string, qualified_name string")
    edges = spark.createDataFrame([(1, 2, "DEFINES"), (1, 3, "DEFINES"), (1, 4, "DEFINES"), (2, 3, "CALLS"), (4, 5, "INHERITS")], "src long, dst long, type string")
    ctx = spark.createDataFrame([(2, 2), (2, 3), (2, 4), (2, 99)], "seed long, node long")
    assert graph_context(PropertyGraph(nodes, edges), ctx).first()["context"] == "## File Structure\n\n### a.py\n  - [Function] f\n  - [Function] g\n  - [Class] K\n\n## Call Graph\n  f -> g\n\n## Inheritance\n  K extends L"


@pytest.mark.parametrize("name", ["T10", "T14", "T19", "W05"])
def test_every_function_is_a_seed(spark, duck, name):
    want = {r[0] for r in duck.sql("SELECT 40000000000 + p_partkey FROM part").fetchall()}
    assert {r.seed for r in catalog.QUERIES[name](spark, SF).select("seed").distinct().collect()} == want


def test_import_chains_are_the_brute_force_ones(spark):
    from plexus.plans.graph import PropertyGraph

    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (2, 5), (6, 7)]
    nodes = spark.createDataFrame([(i, "Module", "r1.test_m" if i == 7 else f"r{i % 2}.n{i}") for i in range(1, 8)], "node_id long, label string, qualified_name string")
    g = PropertyGraph(nodes, spark.createDataFrame([(a, b, "IMPORTS") for a, b in edges] + [(1, 6, "INHERITS")], "src long, dst long, type string"))
    want = {",".join(map(str, p)) for s in range(1, 7) for p in brute(edges, s, 4) if len(p) > 2 and 7 not in p}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(catalog, "graph", lambda *_: g)
        assert {r["path"] for r in catalog.QUERIES["T06"](spark, SF).collect()} == want


def test_expansions_with_caps(spark):
    from plexus.plans.graph import PropertyGraph

    nodes = spark.createDataFrame([(i, "Class" if i < 10 else "Method", f"c{i}" if i != 3 else None) for i in range(1, 20)], "node_id long, label string, name string")
    edges = [(1, 2, "INHERITS"), (2, 3, "INHERITS"), (3, 4, "INHERITS"), (5, 2, "INHERITS")] + [(1, 10 + i, "DEFINES_METHOD") for i in range(6)] + [(10, 17, "CALLS"), (11, 18, "CALLS")]
    g = PropertyGraph(nodes, spark.createDataFrame(edges, "src long, dst long, type string"))
    one = spark.createDataFrame([(1,)], "seed long")
    found = lambda df: {r["node"] for r in df.collect()}
    # Levels go on while fewer than half the cap are found; methods fill what is left.
    assert found(paths.inheritance_tree(g, one, 100)) == {1, 2, 3, 4, 5, *range(10, 16)}
    tree = found(paths.inheritance_tree(g, one, 4))
    assert {1, 2} <= tree <= {1, 2, *range(10, 16)} and len(tree) == 4
    assert found(paths.inheritance_tree(g, one, 1)) == {1}
    assert found(paths.definitions_and_related(g, one, 100)) == {1, *range(10, 16), 17, 18}
    assert len(found(paths.definitions_and_related(g, one, 5))) == 5
    sets = spark.createDataFrame([(1, 1), (1, 3), (1, 4), (5, 5), (5, 2), (5, 1), (5, 10)], "seed long, node long")
    assert {tuple(r) for r in paths.distances_within(g, sets).collect()} == {(1, 1, 0), (5, 5, 0), (5, 2, 1), (5, 1, 2), (5, 10, 3)}
    # 3 has no name, so nothing above it is an ancestor.
    assert {tuple(r) for r in paths.ancestors(g, 1).collect()} == {(1, 2, 1), (5, 2, 1), (3, 4, 1)}
    assert {r["node_id"] for r in paths.reachable(g.of_type("INHERITS"), one).collect()} == {1, 2, 3, 4}


@pytest.mark.parametrize("most", [1, 3, 7, 1000])
@pytest.mark.parametrize("depth", [1, 2, 4])
def test_a_budget_leaves_what_a_cap_leaves(spark, most, depth):
    rng = random.Random(most * 10 + depth)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(70)] + [(0, i) for i in range(30)] + [(5, 5), (0, 1)]
    e = spark.createDataFrame(edges, "src long, dst long")
    seeds = spark.createDataFrame([(0,), (3,), (7,), (99,), (0,)], "seed long").distinct()
    got = {tuple(r) for r in paths.budgeted(e, seeds, depth, most).collect()}
    assert got == {tuple(r) for r in paths.capped(paths.bfs(e, seeds, depth), most).select("seed", "node", "depth").collect()}


def test_paths_through_a_hub_of_many_pages(spark, monkeypatch):
    """A page holds one neighbour or so; ways along parallel edges count each."""
    monkeypatch.setattr(paths, "PAGE", 1)
    edges = [(0, 1), (0, 1), *[(1, i) for i in range(2, 30)], (2, 0), (2, 1), (3, 1), (4, 5), (5, 6)]
    starts = [0, 2, 4, 29]
    want = []

    def walk(path):
        free = [d for s, d in edges if s == path[-1] and d not in path]
        if len(path) == 4 or not free:
            want.append(tuple(path))
            return
        for d in free:
            walk([*path, d])

    for s in starts:
        walk([s])
    e = spark.createDataFrame(edges, "src long, dst long")
    got = sorted(tuple(r["path"]) for r in paths.maximal_paths(e, spark.createDataFrame([(s,) for s in starts], "node_id long"), 3).collect())
    assert got == sorted(want)
