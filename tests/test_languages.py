"""The scanner and what is read from its rows, beyond the registered queries' templates."""

import random
import re
from collections import Counter

import pytest
from plexus.operators import entities, java, languages, outline, resolve, scan
from plexus.plans.graph import durable


def rows_of(spark, files):
    return durable(outline.outlined(scan.statements(spark.createDataFrame(list(files.items()), "path string, content string"), "P")))


MARKS = ["{", "}", "(", ")", "[", "]", ";", ",", "\n", '"', "'", "`", "//", "/*", "*/", "--[[", "]]", "end", "function f()", "class A", "x = ", "=> ", "if ", "do", "\\", "#", "r#\"", " ", "é"]


@pytest.mark.parametrize("lang", scan.LANGUAGES)
def test_any_text_is_scanned(lang):
    """Brackets, strings and comments in any order: blocks nest, and every statement stands in a block that is there."""
    rng = random.Random(lang)
    for _ in range(300):
        text = "".join(rng.choices(MARKS, k=rng.randint(0, 40)))
        got = scan.scanned(text, lang)
        blocks = {r["id"]: r for r in got if r["kind"] == "block"}
        held = Counter(h for r in got for h in r["holds"])
        for r in got:
            assert r["ups"][0] == 0 and r["ups"][-1] == r["parent"] and all(u in blocks for u in r["ups"][1:])
            assert 1 <= r["start_line"] <= r["end_line"] <= text.count("\n") + 1
            if r["kind"] == "text":
                assert r["code"].count("{}") >= len(r["holds"])
        assert all(held[b] == 1 for b in blocks)


def test_each_piece_of_code_is_in_one_statement():
    rng = random.Random(1)
    for _ in range(100):
        names = [f"n{i}" for i in range(rng.randint(1, 15))]
        text, depth = "", 0
        for n in names:
            text += f"{n}();"
            if rng.random() < 0.4:
                text, depth = text + f" g{n} {{ ", depth + 1
            if depth and rng.random() < 0.4:
                text, depth = text + " } ", depth - 1
        text += "}" * depth
        found = Counter(x for r in scan.scanned(text, "java") if r["kind"] == "text" for x in re.findall(r"\bn\d+", r["code"]))
        assert found == Counter(names)


def test_strings_and_comments_hold_no_code():
    for lang, text in {
        "javascript": "const a = 'x {', b = `y ${z} }`, c = /[/{]/g; // }\n/* { */ f()", "java": 'String s = """\n {"x" }\n"""; char c = \'}\'; f();', "go": "var s = `{\n}`\nvar r = '{'\nf()",
        "rust": "let s = r##\"{\"#}\"##; let c = '{'; let l: &'static str = \"}\"; f();", "cpp": 'auto s = R"x({)")x"; char c = \'{\'; f();', "lua": "local s = [==[ { ]] ]==] --[[ { ]]\nf()",
    }.items():
        got = scan.scanned(text, lang)
        assert all(r["kind"] == "text" for r in got) and got[-1]["code"] == "f()", (lang, got)


def test_empty_and_other_files_have_no_rows(spark):
    files = {"a.js": None, "b.js": "", "c.txt": "f()", "d": "f()", "e.JS": "f()"}
    rows = rows_of(spark, files)
    assert [r["path"] for r in rows.collect()] == ["e.JS"]
    assert outline.definitions(rows).collect() == [] and [r["call_name"] for r in outline.calls(rows).collect()] == ["f"]


def test_use_trees_of_any_depth(spark):
    rng = random.Random(2)

    def tree(depth, base):
        kind = rng.random()
        if depth == 0 or kind < 0.4:
            n = f"x{rng.randrange(1000)}"
            way = rng.randrange(4)
            if way == 0:
                return f"{n} as y{n}", [(f"y{n}", f"{base}{n}", False)]
            if way == 1 and base:
                return "*", [(f"*{base[:-2]}", base[:-2], True)]
            if way == 2 and base:
                return "self", [("self", base[:-2], False)]
            return n, [(n, f"{base}{n}", False)]
        head = f"m{rng.randrange(1000)}"
        parts = [tree(depth - 1, f"{base}{head}::") for _ in range(rng.randint(1, 3))]
        return f"{head}::{{{', '.join(t for t, _ in parts)}}}", [x for _, own in parts for x in own]

    text, want = "", set()
    for _ in range(30):
        t, own = tree(4, "")
        text += f"use {t};\n"
        want |= set(own)
    got = languages.rust_imports(rows_of(spark, {"a.rs": text})).select("local_name", "full_name", "is_wildcard").distinct().collect()
    assert {tuple(r) for r in got} == want


def test_a_lattice_in_the_order_of_its_sources(spark):
    edges = [("A", "B", "INHERITS", 0), ("A", "I", "IMPLEMENTS", 1), ("A", "J", "IMPLEMENTS", 2), ("B", "C", "INHERITS", 0), ("B", "K", "IMPLEMENTS", 1), ("C", "A", "INHERITS", 0), ("I", "K", "INHERITS", 0), ("J", "L", "INHERITS", 0)]
    got = resolve.lattice(spark.createDataFrame(edges, "cls string, parent string, type string, ord int"), spark.createDataFrame([("Z",)], "cls string")).collect()
    order = [r["above"] for r in sorted((r for r in got if r["cls"] == "A"), key=lambda r: (r["by_interface"], r["level"], r["place"]))]
    assert order == ["A", "B", "C", "I", "J", "K", "L"] and [r["above"] for r in got if r["cls"] == "Z"] == ["Z"]


def test_overloads_and_fields_of_outer_classes(spark):
    files = {"p/A.java": "package p;\nclass A { B b; void f(int a) {} void f(A a, int... r) {} void g() { f(1); f(this, 1, 2); this.b.h(2); }\n class N { void k() { b.h(1); f(3); } } }\n", "p/B.java": "package p;\nclass B extends q.C { void h(int x) {} }\n", "q/C.java": "package q;\nclass C { void h(int x) {} void h() {} }\n"}
    rows = rows_of(spark, files)
    calls = java.method_calls(rows)
    imports = languages.imports(rows, "P", rows.select("module_qn").distinct())
    got = calls.join(java.resolved_methods(calls, outline.definitions(rows), outline.parents(rows), imports, java.declared(rows)), "id", "left").collect()
    assert {(r["caller"], r["name"], r["n_args"]): r["callee"] for r in got} == {
        ("P.p.A.A.g()", "f", 1): "P.p.A.A.f(int)", ("P.p.A.A.g()", "f", 3): "P.p.A.A.f(A,int...)", ("P.p.A.A.g()", "h", 1): "P.p.B.B.h(int)", ("P.p.A.A.N.k()", "h", 1): "P.p.B.B.h(int)", ("P.p.A.A.N.k()", "f", 1): "P.p.A.A.f(int)",
    }


def test_entities_without_a_name_and_repeated_ones(spark):
    names = spark.createDataFrame([("python", None), ("python", ""), ("python", "."), ("python", "os.x"), ("python", "os.x"), ("cobol", "a.B"), (None, "a.B")], "lang string, full_name string")
    none = spark.createDataFrame([], "qualified_name string, label string")
    got = {(r["lang"], r["full_name"]): (r["module_path"], r["way"]) for r in entities.module_paths(names, none, entities.known_modules(spark)).collect()}
    assert got == {("python", ""): ("", "unchanged"), ("python", "."): (".", "unchanged"), ("python", "os.x"): ("os", "module"), ("cobol", "a.B"): ("a", "name"), (None, "a.B"): ("a", "name")}


def test_a_call_leaves_the_cascade_where_it_is_found(spark):
    calls = [(1, "m", "f", "f", "plain"), (2, "m", "x.g", "g", "plain"), (3, "m", None, "h", "chain"), (4, "m", None, "h", "super"), (5, "m", "w", "w", "plain"), (6, "m", "print", "print", "plain"), (7, "m", "operator_plus", "operator_plus", "plain"), (8, "m", "none", "none", "plain"), (9, "m", "anon", "anon", "iife")]
    c = spark.createDataFrame(calls, "id long, module_qn string, call_name string, name string, kind string")
    typed = spark.createDataFrame([(3, "k.h")], "id long, callee string")
    imports = spark.createDataFrame([("m", "f", "k.f", False), ("m", "x", "k", False), ("m", "*k", "k", True)], "module_qn string, local_name string, full_name string, is_wildcard boolean")
    registry = spark.createDataFrame([(q, q.split(".")[-1]) for q in ("k.f", "m.f", "k.g", "k.h", "k.w", "m.anon")], "qualified_name string, simple_name string")
    builtins = spark.createDataFrame([("print", "builtin.print"), ("f", "builtin.f")], "name string, callee string")
    got = {r["id"]: (r["callee"], r["by"]) for r in resolve.cascade(c, typed, imports, registry, builtins).collect()}
    assert got == {1: ("k.f", "import"), 2: ("k.g", "qualified"), 3: ("k.h", "chain"), 5: ("k.w", "wildcard"), 6: ("builtin.print", "builtin"), 7: ("builtin.cpp.operator_plus", "operator"), 9: ("m.anon", "iife")}
