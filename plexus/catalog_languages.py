"""Registered queries on sources of JavaScript, Java, Rust, C++, Go and Lua.

Each row of ``part`` has the files of one of its language's templates, chosen by its key, which is also in their names.
The SQL states what each template holds.
"""

from __future__ import annotations

import builtins
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.catalog import on_table
from plexus.operators import entities, extract, java, languages, outline, resolve, scan, types
from plexus.plans.graph import durable, new_folder

#: By language: the templates, each a map of paths to contents; ``$k`` is the key.
TEMPLATES: dict[str, list[dict[str, str]]] = {
    "javascript": [
        {"j$k.js": "function Base$k(a) { this.a = a }\nBase$k.prototype.run = function (x) { return go(x) };\nfunction Kid$k() { Base$k.call(this) }\nKid$k.prototype = Object.create(Base$k.prototype);\nKid$k.prototype.stop = x => halt(x);\n"},
        {"j$k.js": "function A$k() {}\nconst p = A$k.prototype;\np.one = function () { return two() };\np.three = () => {\n  four()\n};\nq.five = function () {};\n"},
        {"j$k.js": "const api$k = {\n  get(id) { return fetch(id) },\n  put: function (v) { send(v) },\n  del: (x) => drop(x),\n  deep: { async inner() { leaf() } },\n  n: 1\n};\n"},
        {"j$k.js": "const util = {};\nutil.pad = function (s) { return trim(s) };\nexports.run$k = async (a) => { await util.pad(a) };\nmodule.exports.stop = function stop() {};\nlet plain = 3, f$k = function () {};\n"},
        {"j$k.js": "export default class View$k extends Base {\n  #count = 0;\n  static make() { return new View$k() }\n  get size() { return this.#count }\n  onClick = (e) => { this.fire(e) }\n  async *walk(n) { function step() { n() } yield step() }\n}\n"},
        {"j$k.js": "(function () { boot$k() })();\nlist.forEach((x) => { use(x) });\nsetTimeout(function () { later() }, 10);\n"},
        {"j$k.js": '// function no() {\nfunction outer$k() {\n  const s = "} function fake() {";\n  /* class X { */\n  function inner() { return s.trim() }\n  return inner()\n}\n'},
        {"j$k.js": "function Q$k() {}\nutil.inherits(Q$k, Emitter);\nObject.assign(Q$k.prototype, { a() { b() }, c: function () {} });\nR.prototype = { d() {} };\nR.prototype.__proto__ = Q$k.prototype;\n"},
        {"j$k.ts": "export interface Shape$k { area(): number }\nexport enum Kind { A, B }\nnamespace geo { export function dist(a: P, b: P): number { return hypot(a, b) } }\nexport abstract class Sq implements Shape$k {\n  constructor(private s: number) { super() }\n  area(): number { return mul(this.s) }\n}\n"},
        {"j$k.js": "const re = /[{}\"']/g;\nconst t = `a ${f()} {`;\nconst last$k = (a, b) => a.join(b)\nif (re.test(t)) { last$k(t) } else { t() }\nfunction open$k() { return {\n  m() { n() },\n"},
    ],
    "java": [
        {"ja/K$k.java": "package ja;\nimport java.util.*;\npublic class K$k {\n  int a(int x) { return b(x) + this.b(x, 1); }\n  int b(int x) { return x; }\n  int b(int x, int y) { return Math.max(x, y); }\n}\n"},
        {"ja/K$k.java": "package ja;\npublic class K$k extends Base$k implements Runs$k {\n  void go() { up(); super.up(); own(); wait$k(1); }\n  void own() {}\n}\n", "ja/Base$k.java": "package ja;\nabstract class Base$k { void up() {} abstract void wait$k(int n); }\n", "ja/Runs$k.java": "package ja;\ninterface Runs$k { void up(); default void rest() {} }\n"},
        {"ja/K$k.java": "package ja;\nimport jb.Tool$k;\nclass K$k { private Tool$k t; int f(Tool$k u) { Tool$k v = new Tool$k(); return t.use(1) + u.use(2, 3) + v.made() + Tool$k.one(); } }\n", "jb/Tool$k.java": "package jb;\npublic class Tool$k { public int use(int a) { return a; } public int use(int a, int b) { return a; } int made() { return 1; } static int one() { return 1; } }\n"},
        {"ja/K$k.java": "package ja;\nimport static jc.Fn$k.twice;\nimport static jc.More$k.*;\nclass K$k { int f() { return twice(1) + thrice(2) + none(3); } }\n", "jc/Fn$k.java": "package jc;\nclass Fn$k { static int twice(int a) { return a; } }\n", "jc/More$k.java": "package jc;\nclass More$k { static int thrice(int a) { return a; } }\n"},
        {"ja/K$k.java": "package ja;\ninterface A$k { void x(); }\ninterface B$k { void x(); void y(String s); }\nclass K$k implements A$k, B$k { void f(B$k b) { x(); y(null); b.x(); } }\n"},
        {"ja/K$k.java": "package ja;\nclass K$k { void f(String fmt, Object... rest) {} void g() { f(\"a\"); f(\"a(\", 1, h(2, 3)); } int h(int a, int b) { return a; } }\n"},
        {"ja/K$k.java": "package ja;\nclass K$k { void f() { new In().g(); In i = make(); i.g(); } In make() { return null; }\n  class In { void g() { f(); } }\n}\n"},
        {"ja/K$k.java": "package ja;\nclass K$k { void f(Unknown u, int n) { u.run(); n.run(); var w = new W$k(); w.run(); missing(); } }\nclass W$k extends V$k { }\nclass V$k extends W$k { void run() {} }\n"},
        {"ja/K$k.java": "package ja;\npublic enum K$k { ONE, TWO;\n  int f(java.util.Map<String, List<Integer>> m, final int[] xs) throws Oops { for (Item$k it : all()) { it.eat(); } return 0; }\n  Item$k[] all() { return null; }\n}\nrecord Item$k(int a) { void eat() {} }\n"},
        {"ja/K$k.java": "package ja;\nclass K$k { /* void no() {} */ String s = \"class X { void y() {} }\"; char c = '{';\n  <T> T id(T t) { return t; }\n  void f() { if (s.isEmpty()) { id(id(1)); } else { return; } }\n}\n"},
    ],
    "rust": [
        {"r$k.rs": "use a::{b, c::{d as e, *}};\nuse std::io::{self, Read as R$k};\nfn main() { b(); e::f(); }\n"},
        {"r$k.rs": "struct P$k { x: i32 }\nimpl P$k {\n    fn new(x: i32) -> Self { P$k { x } }\n    fn get(&self) -> i32 { self.x.abs() }\n}\n"},
        {"r$k.rs": "trait Draw: Shape + Clone { fn draw(&self); fn twice(&self) { self.draw(); } }\nimpl<'a, T: Clone> Draw for wrap::Box$k<'a, T> where T: Copy { fn draw(&self) { go::<T>(1) } }\n"},
        {"r$k.rs": "mod outer { pub mod inner { pub fn deep$k() { super::up() } use crate::x::Y; } fn up() {} }\n"},
        {"r$k.rs": "#[derive(Debug)]\npub enum E$k { A(u8), B { x: u8 } }\nimpl std::fmt::Display for E$k { fn fmt(&self, f: &mut F) -> R { write!(f, \"{}\", '{') } }\n"},
        {"r$k.rs": "pub(crate) use self::a$k::*;\nuse ::ext::thing;\nuse one as two;\nextern crate z;\n"},
        {"r$k.rs": "fn outer$k() { fn inner() { leaf() } let f = |x| { inner(); x }; f(1); }\nconst N: usize = 3;\n"},
        {"r$k.rs": "unsafe impl Send for P$k {}\nunion U$k { a: u8, b: i8 }\nstruct T$k(u8, u8);\ntype Alias = Vec<T$k>;\nasync fn run() -> Result<(), E> { wait().await?; Ok(()) }\n"},
        {"r$k.rs": "// fn no() {}\n/* impl X { */\nfn s$k() { let a = r#\"fn x() { \"#; let b = 'a'; let c: &'static str = \"}\"; end(a, b, c) }\n"},
        {"r$k.rs": "use a::{\n    b::{c, d::{self as dd, e}},\n    f$k,\n};\nimpl<T> From<T> for G<T> { fn from(t: T) -> Self { G::make(t) } }\n"},
    ],
    "cpp": [
        {"interfaces/m$k.cppm": "module;\n#include <vector>\nexport module geo$k;\nimport std;\nexport class Point { public: double norm() const { return sq(x); } double x; };\nexport int area(int a) { return a; }\nint hidden() { return 1; }\n", "src/m$k.cpp": "module geo$k;\nint helper$k() { return area(2); }\n"},
        {"src/c$k.cpp": '#include "x/y.h"\n#include <string>\nnamespace a::b {\nclass V$k : public Base, private x::Other {\n  V$k operator+(const V$k& o) { return add(o); }\n  bool operator==(const V$k& o) const;\n  int operator[](int i) { return i; }\n  ~V$k() { drop(); }\n};\nbool V$k::operator==(const V$k& o) const { return same(o); }\n}\n'},
        {"src/c$k.cpp": "export module big$k:part;\nexport namespace api { int f() { return g(); } struct S { int h() { return 1; } }; }\nexport { class W {}; void k() {} }\nclass Quiet {};\n", "src/d$k.cpp": "module big$k:part;\nimport :part;\nimport other.mod;\n"},
        {"src/c$k.cpp": "module lonely$k;\nmodule :private;\nvoid f$k() {}\n"},
        {"src/c$k.hpp": "#pragma once\n#define M(x) { x\ntemplate <typename T> class Box$k { T get() const { return v; } T v; };\ntemplate <class T> T pick(T a) { return a; }\nenum class Color { Red };\nunion U { int a; float b; };\n"},
        {"src/c$k.cpp": "struct Node$k { Node$k* next = nullptr; void link(Node$k* n); virtual int size() const = 0; };\nvoid Node$k::link(Node$k* n) { next = n; n->size(); std::sort(a, b); }\nstatic int top(int a, int b = 2) { if (a) { return a; } return b; }\n"},
        {"src/c$k.cpp": "class A$k { public: A$k() : x(1) { init(); } explicit A$k(int y); private: int x; };\nA$k::A$k(int y) { x = y; }\nauto f = [](int q) { return call(q); };\nint main() { A$k a(1); return run(a); }\n"},
        {"src/c$k.cpp": '// class No {\nconst char* s = "class X { void f() {} }";\nchar c = \'{\';\nauto r = R"(int g() { )";\nint real$k() { return 0; }\n'},
        {"modules/i$k.ixx": "export module net.http$k;\nexport template <typename T> class Client { void get() { send(); } };\nexport void open();\nimport <map>;\n", "src/i$k.cpp": "module net.http$k;\nvoid open() {}\n", "src/j$k.cpp": "module net.http$k;\nvoid shut$k() {}\n"},
        {"src/c$k.cpp": "extern \"C\" { int raw$k(int a) { return a; } }\nnamespace { int hid() { return 2; } }\nnamespace out { namespace in { int deep$k() { return hid(); } } }\nbool operator<(const P& a, const P& b) { return less(a, b); }\n"},
    ],
    "go": [
        {"g$k.go": 'package main\n\nimport (\n\tf "fmt"\n\t"net/http"\n\t_ "side/effect"\n)\n\ntype T$k struct {\n\tBase\n\tx int\n}\n\nfunc (t *T$k) Run(a int) error {\n\treturn f.Errorf("x", t.x)\n}\n'},
        {"g$k.go": 'package p\nimport "os"\nfunc Top$k() { os.Exit(1) }\nfunc two() (int, error) { return Top$k(), nil }\n'},
        {"g$k.go": "package p\ntype R$k interface {\n\tRead(p []byte) (n int, err error)\n\tCloser\n}\ntype Id int\n"},
        {"g$k.go": "package p\nfunc outer$k() {\n\tinner := func(a int) { leaf(a) }\n\tinner(1)\n\tgo func() { later() }()\n}\n"},
        {"g$k.go": "package p\nfunc Map$k[T any](xs []T, f func(T) T) []T {\n\tfor _, x := range xs {\n\t\tf(x)\n\t}\n\treturn xs\n}\n"},
        {"g$k.go": "package p\n// func no() {\nvar s = `func raw() {`\nvar r = '{'\nfunc (s Set$k) Has(k string) bool { return s.m.get(k) }\n"},
        {"g$k.go": 'package p\nimport . "math"\nimport alias$k "a/b/c"\nfunc x() { alias$k.Do(Sqrt(2)) }\n'},
        {"g$k.go": "package p\ntype (\n\tA$k struct{ n int }\n)\ntype B$k struct {\n\t*A$k\n\tpkg.Other\n}\nfunc (B$k) Val() int { return 1 }\n"},
        {"g$k.go": "package p\nfunc sw$k(x int) int {\n\tswitch x {\n\tcase 1:\n\t\treturn one()\n\tdefault:\n\t\treturn many(x)\n\t}\n}\n"},
        {"g$k.go": "package p\nvar handler$k = func(w W) { w.Write() }\nfunc init() { reg(handler$k) }\n"},
    ],
    "lua": [
        {"l$k.lua": 'local M = {}\nlocal util = require("lib.util$k")\nfunction M.f(a)\n  if a then util.g(a) else M.h() end\nend\nfunction M:h() return self.x end\nreturn M\n', "lib/util$k.lua": "local function g() end\nreturn { g = g }\n"},
        {"l$k.lua": 'local ok, json = pcall(require, "cjson")\nlocal near = require "./side$k"\nlocal q = function(x) return string.upper(x) end\nq("a")\n'},
        {"l$k.lua": "local function outer$k()\n  local function inner() leaf() end\n  for i = 1, 3 do inner() end\n  while true do stop() end\nend\n"},
        {"l$k.lua": "-- function no()\n--[[ function x() end ]]\nlocal s = [[function y() end]]\nfunction real$k() return s end\n"},
        {"l$k.lua": 'require("a.b$k")\nlocal t = {\n  run = function(self) self:go() end,\n}\nt.stop = function() os.exit(1) end\n'},
        {"l$k.lua": "repeat\n  local x = next$k()\nuntil x == nil\nlist.each(function(v) use(v) end)\n"},
        {"l$k.lua": "function a.b.c$k(x) if x then if y then z() end end return w() end\nfunction plain$k() end\n"},
    ],
    "cascade": [
        {"py$k/a.py": "def f():\n    pass\n", "py$k/b.py": "from py$k.a import f as g\ndef h():\n    g()\n"},
        {"py$k/a.py": "def f():\n    pass\nclass C:\n    def m(self):\n        pass\n", "py$k/b.py": "import py$k.a as z\nfrom py$k.a import C\ndef h():\n    z.f()\n    C.m(None)\n"},
        {"py$k/a.py": "def f$k():\n    pass\n", "py$k/b.py": "from py$k.a import *\ndef h():\n    f$k()\n"},
        {"py$k/a.py": "def f():\n    g()\ndef g():\n    def inner():\n        f()\n    inner()\n"},
        {"py$k/deep/a.py": "def far$k():\n    pass\n", "py$k/b.py": "def h(o):\n    far$k()\n    o.far$k()\n", "other$k/c.py": "def far$k():\n    pass\n"},
        {"py$k/a.py": "class A:\n    def up(self):\n        pass\nclass B(A):\n    def go(self):\n        super().up()\n        super().none()\n        self.up()\n"},
        {"py$k/a.py": "class T:\n    def a(self) -> 'T':\n        return self\ndef go(t: T):\n    t.a().a()\n    lost$k().a()\n"},
        {"py$k/a.py": "def go(x$k):\n    print(len(x$k))\n    nobody$k()\n    x$k.nobody$k()\n"},
        {"py$k/a.py": "class T:\n    def run$k(self):\n        pass\nclass U:\n    def __init__(self):\n        self.t = T()\n    def go(self):\n        x = T()\n        x.run$k()\n        self.t.run$k()\n"},
        {"js$k/a.js": "(function () { boot$k() })();\nfunction boot$k() {\n  (() => { last$k() })()\n}\n", "cc$k/a.cpp": "int go$k(P a, P b) { return pick(a.operator+(b), c.operator[](1)); }\nint pick(int a, int b) { return a; }\n"},
    ],
}


def files(parts: DataFrame, lang: str) -> DataFrame:
    """path, content: the files of each part's template."""
    rows = [(t, path, content) for t, own in enumerate(TEMPLATES[lang]) for path, content in own.items()]
    made = F.broadcast(parts.sparkSession.createDataFrame(rows, "t int, path string, content string"))  # the templates
    k = F.col("p_partkey").cast("string")
    filled = lambda c: F.replace(F.col(c), F.lit("$k"), k).alias(c)
    return parts.withColumn("t", (F.col("p_partkey") % len(TEMPLATES[lang])).cast("int")).join(made, "t").select(filled("path"), filled("content"))


def expected(lang: str, columns: str, rows: dict[int, list[tuple]]) -> str:
    """SQL for the rows that each template has; texts get the key."""
    names = columns.split()
    lit = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({t}, {', '.join(map(lit, r))})" for t, own in rows.items() for r in own)
    texts = {n for i, n in enumerate(names) if any(isinstance(r[i], str) for own in rows.values() for r in own)}
    shown = ", ".join(f"""replace("{n}", '$k', p_partkey::VARCHAR) AS "{n}\"""" if n in texts else f'"{n}"' for n in names)
    return f"SELECT {shown} FROM part JOIN (VALUES {values}) v(t, {', '.join(f'"{n}"' for n in names)}) ON p_partkey % {len(TEMPLATES[lang])} = t"


def on_files(name: str, lang: str, columns: str, rows: dict[int, list[tuple]]):
    def add(f: Callable[[DataFrame], DataFrame]):
        return on_table(name, "part", expected(lang, columns, rows))(lambda d: f(files(d, lang)).select(*columns.split()))

    return add


def outlined(f: DataFrame) -> DataFrame:
    return durable(outline.outlined(scan.statements(f, "proj")))


def imported(rows: DataFrame) -> DataFrame:
    return languages.imports(rows, "proj", rows.select("module_qn").distinct())


# javascript ------------------------------------------------------------------------------------------------------------


@on_files("E04_js", "javascript", "label qualified_name parent_qn type start_line end_line", {
    0: [("Function", "proj.j$k.Base$k", "proj.j$k", "DEFINES", 1, 1), ("Function", "proj.j$k.Base$k.run", "proj.j$k.Base$k", "DEFINES", 2, 2), ("Function", "proj.j$k.Kid$k", "proj.j$k", "DEFINES", 3, 3), ("Function", "proj.j$k.Kid$k.stop", "proj.j$k.Kid$k", "DEFINES", 5, 5)],
    1: [("Function", "proj.j$k.A$k", "proj.j$k", "DEFINES", 1, 1), ("Function", "proj.j$k.p.one", "proj.j$k.p", "DEFINES", 3, 3), ("Function", "proj.j$k.p.three", "proj.j$k.p", "DEFINES", 4, 6), ("Function", "proj.j$k.q.five", "proj.j$k.q", "DEFINES", 7, 7)],
    2: [("Function", "proj.j$k.api$k.deep.inner", "proj.j$k.api$k.deep", "DEFINES", 5, 5), ("Function", "proj.j$k.api$k.del", "proj.j$k.api$k", "DEFINES", 4, 4), ("Function", "proj.j$k.api$k.get", "proj.j$k.api$k", "DEFINES", 2, 2), ("Function", "proj.j$k.api$k.put", "proj.j$k.api$k", "DEFINES", 3, 3)],
    3: [("Function", "proj.j$k.f$k", "proj.j$k", "DEFINES", 5, 5), ("Function", "proj.j$k.run$k", "proj.j$k", "DEFINES", 3, 3), ("Function", "proj.j$k.stop", "proj.j$k", "DEFINES", 4, 4), ("Function", "proj.j$k.util.pad", "proj.j$k.util", "DEFINES", 2, 2)],
    4: [("Class", "proj.j$k.View$k", "proj.j$k", "DEFINES", 1, 7), ("Function", "proj.j$k.View$k.walk.step", "proj.j$k.View$k.walk", "DEFINES", 6, 6), ("Method", "proj.j$k.View$k.make", "proj.j$k.View$k", "DEFINES_METHOD", 3, 3), ("Method", "proj.j$k.View$k.onClick", "proj.j$k.View$k", "DEFINES_METHOD", 5, 5), ("Method", "proj.j$k.View$k.size", "proj.j$k.View$k", "DEFINES_METHOD", 4, 4), ("Method", "proj.j$k.View$k.walk", "proj.j$k.View$k", "DEFINES_METHOD", 6, 6)],
    5: [("Function", "proj.j$k.anonymous_1_13", "proj.j$k", "DEFINES", 1, 1), ("Function", "proj.j$k.anonymous_2_20", "proj.j$k", "DEFINES", 2, 2), ("Function", "proj.j$k.anonymous_3_23", "proj.j$k", "DEFINES", 3, 3)],
    6: [("Function", "proj.j$k.outer$k", "proj.j$k", "DEFINES", 2, 7), ("Function", "proj.j$k.outer$k.inner", "proj.j$k.outer$k", "DEFINES", 5, 5)],
    7: [("Function", "proj.j$k.Q$k", "proj.j$k", "DEFINES", 1, 1), ("Function", "proj.j$k.Q$k.a", "proj.j$k.Q$k", "DEFINES", 3, 3), ("Function", "proj.j$k.Q$k.c", "proj.j$k.Q$k", "DEFINES", 3, 3), ("Function", "proj.j$k.R.d", "proj.j$k.R", "DEFINES", 4, 4)],
    8: [("Class", "proj.j$k.Sq", "proj.j$k", "DEFINES", 4, 7), ("Enum", "proj.j$k.Kind", "proj.j$k", "DEFINES", 2, 2), ("Function", "proj.j$k.geo.dist", "proj.j$k.geo", "DEFINES", 3, 3), ("Interface", "proj.j$k.Shape$k", "proj.j$k", "DEFINES", 1, 1), ("Method", "proj.j$k.Shape$k.area", "proj.j$k.Shape$k", "DEFINES_METHOD", 1, 1), ("Method", "proj.j$k.Sq.area", "proj.j$k.Sq", "DEFINES_METHOD", 6, 6), ("Method", "proj.j$k.Sq.constructor", "proj.j$k.Sq", "DEFINES_METHOD", 5, 5)],
    9: [("Function", "proj.j$k.last$k", "proj.j$k", "DEFINES", 3, 3), ("Function", "proj.j$k.open$k", "proj.j$k", "DEFINES", 5, 7), ("Function", "proj.j$k.open$k.m", "proj.j$k.open$k", "DEFINES", 6, 6)],
})
def javascript_definitions(f: DataFrame) -> DataFrame:
    return outline.definitions(outlined(f))


@on_files("E07_js", "javascript", "cls base type ord", {
    4: [("proj.j$k.View$k", "Base", "INHERITS", 0)],
    8: [("proj.j$k.Sq", "Shape$k", "IMPLEMENTS", 0)],
})
def javascript_parents(f: DataFrame) -> DataFrame:
    return outline.parents(outlined(f))


@on_files("E11_js", "javascript", "caller call_name line", {
    0: [("proj.j$k", "Object.create", 4), ("proj.j$k.Base$k.run", "go", 2), ("proj.j$k.Kid$k", "Base$k.call", 3), ("proj.j$k.Kid$k.stop", "halt", 5)],
    1: [("proj.j$k.p.one", "two", 3), ("proj.j$k.p.three", "four", 5)],
    2: [("proj.j$k.api$k.deep.inner", "leaf", 5), ("proj.j$k.api$k.del", "drop", 4), ("proj.j$k.api$k.get", "fetch", 2), ("proj.j$k.api$k.put", "send", 3)],
    3: [("proj.j$k.run$k", "util.pad", 3), ("proj.j$k.util.pad", "trim", 2)],
    4: [("proj.j$k.View$k.make", "View$k", 3), ("proj.j$k.View$k.onClick", "this.fire", 5), ("proj.j$k.View$k.walk", "step", 6), ("proj.j$k.View$k.walk.step", "n", 6)],
    5: [("proj.j$k", "list.forEach", 2), ("proj.j$k", "setTimeout", 3), ("proj.j$k.anonymous_1_13", "boot$k", 1), ("proj.j$k.anonymous_2_20", "use", 2), ("proj.j$k.anonymous_3_23", "later", 3)],
    6: [("proj.j$k.outer$k", "inner", 6), ("proj.j$k.outer$k.inner", "s.trim", 5)],
    7: [("proj.j$k", "Object.assign", 3), ("proj.j$k", "util.inherits", 2), ("proj.j$k.Q$k.a", "b", 3)],
    8: [("proj.j$k.Sq.area", "mul", 6), ("proj.j$k.Sq.constructor", "super", 5), ("proj.j$k.geo.dist", "hypot", 3)],
    9: [("proj.j$k", "last$k", 4), ("proj.j$k", "re.test", 4), ("proj.j$k", "t", 4), ("proj.j$k.last$k", "a.join", 3), ("proj.j$k.open$k.m", "n", 6)],
})
def javascript_calls(f: DataFrame) -> DataFrame:
    return outline.calls(outlined(f))


@on_files("E15", "javascript", "way qualified_name parent_qn start_line end_line", {
    0: [("prototype", "proj.j$k.Base$k.run", "proj.j$k.Base$k", 2, 2), ("prototype", "proj.j$k.Kid$k.stop", "proj.j$k.Kid$k", 5, 5)],
    1: [("member", "proj.j$k.q.five", "proj.j$k.q", 7, 7), ("prototype", "proj.j$k.A$k.one", "proj.j$k.A$k", 3, 3), ("prototype", "proj.j$k.A$k.three", "proj.j$k.A$k", 4, 6)],
    2: [("object", "proj.j$k.api$k.deep.inner", "proj.j$k.api$k.deep", 5, 5), ("object", "proj.j$k.api$k.del", "proj.j$k.api$k", 4, 4), ("object", "proj.j$k.api$k.get", "proj.j$k.api$k", 2, 2), ("object", "proj.j$k.api$k.put", "proj.j$k.api$k", 3, 3)],
    3: [("member", "proj.j$k.run$k", "proj.j$k", 3, 3), ("member", "proj.j$k.stop", "proj.j$k", 4, 4), ("member", "proj.j$k.util.pad", "proj.j$k.util", 2, 2), ("variable", "proj.j$k.f$k", "proj.j$k", 5, 5)],
    7: [("object", "proj.j$k.Q$k.a", "proj.j$k.Q$k", 3, 3), ("object", "proj.j$k.Q$k.c", "proj.j$k.Q$k", 3, 3), ("object", "proj.j$k.R.d", "proj.j$k.R", 4, 4)],
    9: [("object", "proj.j$k.open$k.m", "proj.j$k.open$k", 6, 6), ("variable", "proj.j$k.last$k", "proj.j$k", 3, 3)],
})
def prototype_functions(f: DataFrame) -> DataFrame:
    rows = outlined(f)
    return languages.prototype_functions(rows, outline.definitions(rows))


@on_files("E16_scanned", "javascript", "module_qn qualified_name name kind", {
    3: [("proj.j$k", "proj.j$k.run$k", "run$k", "commonjs"), ("proj.j$k", "proj.j$k.stop", "stop", "commonjs")],
    8: [("proj.j$k", "proj.j$k.geo.dist", "dist", "es6")],
})
def exported_functions(f: DataFrame) -> DataFrame:
    rows = outlined(f)
    return languages.exported_functions(rows, outline.definitions(rows))


@on_files("E15_links", "javascript", "child parent", {
    0: [("proj.j$k.Kid$k", "proj.j$k.Base$k")],
    7: [("proj.j$k.Q$k", "proj.j$k.Emitter"), ("proj.j$k.R", "proj.j$k.Q$k")],
})
def prototype_links(f: DataFrame) -> DataFrame:
    return languages.prototype_links(outlined(f))



# java ------------------------------------------------------------------------------------------------------------------


@on_files("E04_java", "java", "label qualified_name parent_qn type start_line end_line", {
    0: [("Class", "proj.ja.K$k.K$k", "proj.ja.K$k", "DEFINES", 3, 7), ("Method", "proj.ja.K$k.K$k.a(int)", "proj.ja.K$k.K$k", "DEFINES_METHOD", 4, 4), ("Method", "proj.ja.K$k.K$k.b(int)", "proj.ja.K$k.K$k", "DEFINES_METHOD", 5, 5), ("Method", "proj.ja.K$k.K$k.b(int,int)", "proj.ja.K$k.K$k", "DEFINES_METHOD", 6, 6)],
    1: [("Class", "proj.ja.Base$k.Base$k", "proj.ja.Base$k", "DEFINES", 2, 2), ("Class", "proj.ja.K$k.K$k", "proj.ja.K$k", "DEFINES", 2, 5), ("Interface", "proj.ja.Runs$k.Runs$k", "proj.ja.Runs$k", "DEFINES", 2, 2), ("Method", "proj.ja.Base$k.Base$k.up()", "proj.ja.Base$k.Base$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.ja.Base$k.Base$k.wait$k(int)", "proj.ja.Base$k.Base$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.ja.K$k.K$k.go()", "proj.ja.K$k.K$k", "DEFINES_METHOD", 3, 3), ("Method", "proj.ja.K$k.K$k.own()", "proj.ja.K$k.K$k", "DEFINES_METHOD", 4, 4), ("Method", "proj.ja.Runs$k.Runs$k.rest()", "proj.ja.Runs$k.Runs$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.ja.Runs$k.Runs$k.up()", "proj.ja.Runs$k.Runs$k", "DEFINES_METHOD", 2, 2)],
    2: [("Class", "proj.ja.K$k.K$k", "proj.ja.K$k", "DEFINES", 3, 3), ("Class", "proj.jb.Tool$k.Tool$k", "proj.jb.Tool$k", "DEFINES", 2, 2), ("Method", "proj.ja.K$k.K$k.f(Tool$k)", "proj.ja.K$k.K$k", "DEFINES_METHOD", 3, 3), ("Method", "proj.jb.Tool$k.Tool$k.made()", "proj.jb.Tool$k.Tool$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.jb.Tool$k.Tool$k.one()", "proj.jb.Tool$k.Tool$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.jb.Tool$k.Tool$k.use(int)", "proj.jb.Tool$k.Tool$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.jb.Tool$k.Tool$k.use(int,int)", "proj.jb.Tool$k.Tool$k", "DEFINES_METHOD", 2, 2)],
    3: [("Class", "proj.ja.K$k.K$k", "proj.ja.K$k", "DEFINES", 4, 4), ("Class", "proj.jc.Fn$k.Fn$k", "proj.jc.Fn$k", "DEFINES", 2, 2), ("Class", "proj.jc.More$k.More$k", "proj.jc.More$k", "DEFINES", 2, 2), ("Method", "proj.ja.K$k.K$k.f()", "proj.ja.K$k.K$k", "DEFINES_METHOD", 4, 4), ("Method", "proj.jc.Fn$k.Fn$k.twice(int)", "proj.jc.Fn$k.Fn$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.jc.More$k.More$k.thrice(int)", "proj.jc.More$k.More$k", "DEFINES_METHOD", 2, 2)],
    4: [("Class", "proj.ja.K$k.K$k", "proj.ja.K$k", "DEFINES", 4, 4), ("Interface", "proj.ja.K$k.A$k", "proj.ja.K$k", "DEFINES", 2, 2), ("Interface", "proj.ja.K$k.B$k", "proj.ja.K$k", "DEFINES", 3, 3), ("Method", "proj.ja.K$k.A$k.x()", "proj.ja.K$k.A$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.ja.K$k.B$k.x()", "proj.ja.K$k.B$k", "DEFINES_METHOD", 3, 3), ("Method", "proj.ja.K$k.B$k.y(String)", "proj.ja.K$k.B$k", "DEFINES_METHOD", 3, 3), ("Method", "proj.ja.K$k.K$k.f(B$k)", "proj.ja.K$k.K$k", "DEFINES_METHOD", 4, 4)],
    5: [("Class", "proj.ja.K$k.K$k", "proj.ja.K$k", "DEFINES", 2, 2), ("Method", "proj.ja.K$k.K$k.f(String,Object...)", "proj.ja.K$k.K$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.ja.K$k.K$k.g()", "proj.ja.K$k.K$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.ja.K$k.K$k.h(int,int)", "proj.ja.K$k.K$k", "DEFINES_METHOD", 2, 2)],
    6: [("Class", "proj.ja.K$k.K$k", "proj.ja.K$k", "DEFINES", 2, 4), ("Class", "proj.ja.K$k.K$k.In", "proj.ja.K$k.K$k", "DEFINES", 3, 3), ("Method", "proj.ja.K$k.K$k.In.g()", "proj.ja.K$k.K$k.In", "DEFINES_METHOD", 3, 3), ("Method", "proj.ja.K$k.K$k.f()", "proj.ja.K$k.K$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.ja.K$k.K$k.make()", "proj.ja.K$k.K$k", "DEFINES_METHOD", 2, 2)],
    7: [("Class", "proj.ja.K$k.K$k", "proj.ja.K$k", "DEFINES", 2, 2), ("Class", "proj.ja.K$k.V$k", "proj.ja.K$k", "DEFINES", 4, 4), ("Class", "proj.ja.K$k.W$k", "proj.ja.K$k", "DEFINES", 3, 3), ("Method", "proj.ja.K$k.K$k.f(Unknown,int)", "proj.ja.K$k.K$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.ja.K$k.V$k.run()", "proj.ja.K$k.V$k", "DEFINES_METHOD", 4, 4)],
    8: [("Class", "proj.ja.K$k.Item$k", "proj.ja.K$k", "DEFINES", 6, 6), ("Enum", "proj.ja.K$k.K$k", "proj.ja.K$k", "DEFINES", 2, 5), ("Method", "proj.ja.K$k.Item$k.eat()", "proj.ja.K$k.Item$k", "DEFINES_METHOD", 6, 6), ("Method", "proj.ja.K$k.K$k.all()", "proj.ja.K$k.K$k", "DEFINES_METHOD", 4, 4), ("Method", "proj.ja.K$k.K$k.f(java.util.Map,int[])", "proj.ja.K$k.K$k", "DEFINES_METHOD", 3, 3)],
    9: [("Class", "proj.ja.K$k.K$k", "proj.ja.K$k", "DEFINES", 2, 5), ("Method", "proj.ja.K$k.K$k.f()", "proj.ja.K$k.K$k", "DEFINES_METHOD", 4, 4), ("Method", "proj.ja.K$k.K$k.id(T)", "proj.ja.K$k.K$k", "DEFINES_METHOD", 3, 3)],
})
def java_definitions(f: DataFrame) -> DataFrame:
    return outline.definitions(outlined(f))


@on_files("E07_java", "java", "cls base type ord", {
    1: [("proj.ja.K$k.K$k", "Base$k", "INHERITS", 0), ("proj.ja.K$k.K$k", "Runs$k", "IMPLEMENTS", 1)],
    4: [("proj.ja.K$k.K$k", "A$k", "IMPLEMENTS", 0), ("proj.ja.K$k.K$k", "B$k", "IMPLEMENTS", 1)],
    7: [("proj.ja.K$k.V$k", "W$k", "INHERITS", 0), ("proj.ja.K$k.W$k", "V$k", "INHERITS", 0)],
})
def java_parents(f: DataFrame) -> DataFrame:
    return outline.parents(outlined(f))


@on_files("E11_java", "java", "caller call_name line", {
    0: [("proj.ja.K$k.K$k.a(int)", "b", 4), ("proj.ja.K$k.K$k.a(int)", "this.b", 4), ("proj.ja.K$k.K$k.b(int,int)", "Math.max", 6)],
    1: [("proj.ja.K$k.K$k.go()", "own", 3), ("proj.ja.K$k.K$k.go()", "super.up", 3), ("proj.ja.K$k.K$k.go()", "up", 3), ("proj.ja.K$k.K$k.go()", "wait$k", 3)],
    2: [("proj.ja.K$k.K$k.f(Tool$k)", "Tool$k", 3), ("proj.ja.K$k.K$k.f(Tool$k)", "Tool$k.one", 3), ("proj.ja.K$k.K$k.f(Tool$k)", "t.use", 3), ("proj.ja.K$k.K$k.f(Tool$k)", "u.use", 3), ("proj.ja.K$k.K$k.f(Tool$k)", "v.made", 3)],
    3: [("proj.ja.K$k.K$k.f()", "none", 4), ("proj.ja.K$k.K$k.f()", "thrice", 4), ("proj.ja.K$k.K$k.f()", "twice", 4)],
    4: [("proj.ja.K$k.K$k.f(B$k)", "b.x", 4), ("proj.ja.K$k.K$k.f(B$k)", "x", 4), ("proj.ja.K$k.K$k.f(B$k)", "y", 4)],
    5: [("proj.ja.K$k.K$k.g()", "f", 2), ("proj.ja.K$k.K$k.g()", "f", 2), ("proj.ja.K$k.K$k.g()", "h", 2)],
    6: [("proj.ja.K$k.K$k.In.g()", "f", 3), ("proj.ja.K$k.K$k.f()", "In", 2), ("proj.ja.K$k.K$k.f()", "i.g", 2), ("proj.ja.K$k.K$k.f()", "make", 2)],
    7: [("proj.ja.K$k.K$k.f(Unknown,int)", "W$k", 2), ("proj.ja.K$k.K$k.f(Unknown,int)", "missing", 2), ("proj.ja.K$k.K$k.f(Unknown,int)", "n.run", 2), ("proj.ja.K$k.K$k.f(Unknown,int)", "u.run", 2), ("proj.ja.K$k.K$k.f(Unknown,int)", "w.run", 2)],
    8: [("proj.ja.K$k.K$k.f(java.util.Map,int[])", "all", 3), ("proj.ja.K$k.K$k.f(java.util.Map,int[])", "it.eat", 3)],
    9: [("proj.ja.K$k.K$k.f()", "id", 4), ("proj.ja.K$k.K$k.f()", "id", 4), ("proj.ja.K$k.K$k.f()", "s.isEmpty", 4)],
})
def java_calls(f: DataFrame) -> DataFrame:
    return outline.calls(outlined(f))


@on_files("E08_java", "java", "module_qn local_name full_name is_wildcard", {
    0: [("proj.ja.K$k", "*java.util", "java.util", True)],
    2: [("proj.ja.K$k", "Tool$k", "jb.Tool$k", False)],
    3: [("proj.ja.K$k", "*jc.More$k", "jc.More$k", True), ("proj.ja.K$k", "twice", "jc.Fn$k.twice", False)],
})
def java_imports(f: DataFrame) -> DataFrame:
    return imported(outlined(f))


@on_files("E10_java", "java", "at var type", {
    2: [("proj.ja.K$k.K$k", "t", "Tool$k"), ("proj.ja.K$k.K$k.f(Tool$k)", "u", "Tool$k"), ("proj.ja.K$k.K$k.f(Tool$k)", "v", "Tool$k")],
    4: [("proj.ja.K$k.K$k.f(B$k)", "b", "B$k")],
    5: [("proj.ja.K$k.K$k.f(String,Object...)", "fmt", "String"), ("proj.ja.K$k.K$k.f(String,Object...)", "rest", "Object")],
    6: [("proj.ja.K$k.K$k.f()", "i", "In")],
    7: [("proj.ja.K$k.K$k.f(Unknown,int)", "u", "Unknown"), ("proj.ja.K$k.K$k.f(Unknown,int)", "w", "W$k")],
    8: [("proj.ja.K$k.K$k.f(java.util.Map,int[])", "it", "Item$k"), ("proj.ja.K$k.K$k.f(java.util.Map,int[])", "m", "Map")],
    9: [("proj.ja.K$k.K$k", "s", "String"), ("proj.ja.K$k.K$k.id(T)", "t", "T")],
})
def java_variables(f: DataFrame) -> DataFrame:
    return java.declared(outlined(f))


@on_files("E13", "java", "caller name n_args callee how", {
    0: [("proj.ja.K$k.K$k.a(int)", "b", 1, "proj.ja.K$k.K$k.b(int)", "own"), ("proj.ja.K$k.K$k.a(int)", "b", 2, "proj.ja.K$k.K$k.b(int,int)", "own")],
    1: [("proj.ja.K$k.K$k.go()", "own", 0, "proj.ja.K$k.K$k.own()", "own"), ("proj.ja.K$k.K$k.go()", "up", 0, "proj.ja.Base$k.Base$k.up()", "inherited"), ("proj.ja.K$k.K$k.go()", "up", 0, "proj.ja.Base$k.Base$k.up()", "inherited"), ("proj.ja.K$k.K$k.go()", "wait$k", 1, "proj.ja.Base$k.Base$k.wait$k(int)", "inherited")],
    2: [("proj.ja.K$k.K$k.f(Tool$k)", "made", 0, "proj.jb.Tool$k.Tool$k.made()", "own"), ("proj.ja.K$k.K$k.f(Tool$k)", "one", 0, "proj.jb.Tool$k.Tool$k.one()", "own"), ("proj.ja.K$k.K$k.f(Tool$k)", "use", 1, "proj.jb.Tool$k.Tool$k.use(int)", "own"), ("proj.ja.K$k.K$k.f(Tool$k)", "use", 2, "proj.jb.Tool$k.Tool$k.use(int,int)", "own")],
    3: [("proj.ja.K$k.K$k.f()", "thrice", 1, "proj.jc.More$k.More$k.thrice(int)", "static"), ("proj.ja.K$k.K$k.f()", "twice", 1, "proj.jc.Fn$k.Fn$k.twice(int)", "static")],
    4: [("proj.ja.K$k.K$k.f(B$k)", "x", 0, "proj.ja.K$k.A$k.x()", "interface"), ("proj.ja.K$k.K$k.f(B$k)", "x", 0, "proj.ja.K$k.B$k.x()", "own"), ("proj.ja.K$k.K$k.f(B$k)", "y", 1, "proj.ja.K$k.B$k.y(String)", "interface")],
    5: [("proj.ja.K$k.K$k.g()", "f", 1, "proj.ja.K$k.K$k.f(String,Object...)", "own"), ("proj.ja.K$k.K$k.g()", "f", 3, "proj.ja.K$k.K$k.f(String,Object...)", "own"), ("proj.ja.K$k.K$k.g()", "h", 2, "proj.ja.K$k.K$k.h(int,int)", "own")],
    6: [("proj.ja.K$k.K$k.In.g()", "f", 0, "proj.ja.K$k.K$k.f()", "own"), ("proj.ja.K$k.K$k.f()", "g", 0, "proj.ja.K$k.K$k.In.g()", "own"), ("proj.ja.K$k.K$k.f()", "make", 0, "proj.ja.K$k.K$k.make()", "own")],
    7: [("proj.ja.K$k.K$k.f(Unknown,int)", "run", 0, "proj.ja.K$k.V$k.run()", "inherited")],
    8: [("proj.ja.K$k.K$k.f(java.util.Map,int[])", "all", 0, "proj.ja.K$k.K$k.all()", "own"), ("proj.ja.K$k.K$k.f(java.util.Map,int[])", "eat", 0, "proj.ja.K$k.Item$k.eat()", "own")],
    9: [("proj.ja.K$k.K$k.f()", "id", 1, "proj.ja.K$k.K$k.id(T)", "own")],
})
def java_methods(f: DataFrame) -> DataFrame:
    rows = outlined(f)
    calls = durable(java.method_calls(rows))
    found = java.resolved_methods(calls, durable(outline.definitions(rows)), outline.parents(rows), imported(rows), java.declared(rows))
    return calls.join(found, "id").distinct()



# rust ------------------------------------------------------------------------------------------------------------------


@on_files("E04_rust", "rust", "label qualified_name parent_qn type start_line end_line", {
    0: [("Function", "proj.r$k.main", "proj.r$k", "DEFINES", 3, 3)],
    1: [("Class", "proj.r$k.P$k", "proj.r$k", "DEFINES", 1, 1), ("Method", "proj.r$k.P$k.get", "proj.r$k.P$k", "DEFINES_METHOD", 4, 4), ("Method", "proj.r$k.P$k.new", "proj.r$k.P$k", "DEFINES_METHOD", 3, 3)],
    2: [("Interface", "proj.r$k.Draw", "proj.r$k", "DEFINES", 1, 1), ("Method", "proj.r$k.Box$k.draw", "proj.r$k.Box$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.r$k.Draw.draw", "proj.r$k.Draw", "DEFINES_METHOD", 1, 1), ("Method", "proj.r$k.Draw.twice", "proj.r$k.Draw", "DEFINES_METHOD", 1, 1)],
    3: [("Function", "proj.r$k.outer.inner.deep$k", "proj.r$k.outer.inner", "DEFINES", 1, 1), ("Function", "proj.r$k.outer.up", "proj.r$k.outer", "DEFINES", 1, 1)],
    4: [("Enum", "proj.r$k.E$k", "proj.r$k", "DEFINES", 2, 2), ("Method", "proj.r$k.E$k.fmt", "proj.r$k.E$k", "DEFINES_METHOD", 3, 3)],
    6: [("Function", "proj.r$k.outer$k", "proj.r$k", "DEFINES", 1, 1), ("Function", "proj.r$k.outer$k.inner", "proj.r$k.outer$k", "DEFINES", 1, 1)],
    7: [("Class", "proj.r$k.T$k", "proj.r$k", "DEFINES", 3, 3), ("Function", "proj.r$k.run", "proj.r$k", "DEFINES", 5, 5), ("Type", "proj.r$k.Alias", "proj.r$k", "DEFINES", 4, 4), ("Union", "proj.r$k.U$k", "proj.r$k", "DEFINES", 2, 2)],
    8: [("Function", "proj.r$k.s$k", "proj.r$k", "DEFINES", 3, 3)],
    9: [("Method", "proj.r$k.G.from", "proj.r$k.G", "DEFINES_METHOD", 5, 5)],
})
def rust_definitions(f: DataFrame) -> DataFrame:
    return outline.definitions(outlined(f))


@on_files("E07_rust", "rust", "cls base type ord", {
    2: [("proj.r$k.Box$k", "Draw", "IMPLEMENTS", 0), ("proj.r$k.Draw", "Clone", "INHERITS", 1), ("proj.r$k.Draw", "Shape", "INHERITS", 0)],
    4: [("proj.r$k.E$k", "std.fmt.Display", "IMPLEMENTS", 0)],
    7: [("proj.r$k.P$k", "Send", "IMPLEMENTS", 0)],
    9: [("proj.r$k.G", "From", "IMPLEMENTS", 0)],
})
def rust_parents(f: DataFrame) -> DataFrame:
    return outline.parents(outlined(f))


@on_files("E11_rust", "rust", "caller call_name line", {
    0: [("proj.r$k.main", "b", 3), ("proj.r$k.main", "e.f", 3)],
    1: [("proj.r$k.P$k.get", "self.x.abs", 4)],
    2: [("proj.r$k.Box$k.draw", "go", 2), ("proj.r$k.Draw.twice", "self.draw", 1)],
    3: [("proj.r$k.outer.inner.deep$k", "super.up", 1)],
    4: [("proj.r$k.E$k.fmt", "write", 3)],
    6: [("proj.r$k.outer$k", "f", 1), ("proj.r$k.outer$k", "inner", 1), ("proj.r$k.outer$k.inner", "leaf", 1)],
    7: [("proj.r$k.run", "Ok", 5), ("proj.r$k.run", "wait", 5)],
    8: [("proj.r$k.s$k", "end", 3)],
    9: [("proj.r$k.G.from", "G.make", 5)],
})
def rust_calls(f: DataFrame) -> DataFrame:
    return outline.calls(outlined(f))


@on_files("E18", "rust", "module_qn local_name full_name is_wildcard", {
    0: [("proj.r$k", "*a::c", "a::c", True), ("proj.r$k", "R$k", "std::io::Read", False), ("proj.r$k", "b", "a::b", False), ("proj.r$k", "e", "a::c::d", False), ("proj.r$k", "self", "std::io", False)],
    3: [("proj.r$k", "Y", "crate::x::Y", False)],
    5: [("proj.r$k", "*self::a$k", "self::a$k", True), ("proj.r$k", "thing", "ext::thing", False), ("proj.r$k", "two", "one", False)],
    9: [("proj.r$k", "c", "a::b::c", False), ("proj.r$k", "dd", "a::b::d", False), ("proj.r$k", "e", "a::b::d::e", False), ("proj.r$k", "f$k", "a::f$k", False)],
})
def use_trees(f: DataFrame) -> DataFrame:
    return imported(outlined(f))



# cpp -------------------------------------------------------------------------------------------------------------------


@on_files("E04_cpp", "cpp", "label qualified_name parent_qn type start_line end_line", {
    0: [("Class", "proj.m$k.Point", "proj.m$k", "DEFINES", 5, 5), ("Function", "proj.m$k.area", "proj.m$k", "DEFINES", 6, 6), ("Function", "proj.m$k.hidden", "proj.m$k", "DEFINES", 7, 7), ("Function", "proj.src.m$k.helper$k", "proj.src.m$k", "DEFINES", 2, 2), ("Method", "proj.m$k.Point.norm", "proj.m$k.Point", "DEFINES_METHOD", 5, 5)],
    1: [("Class", "proj.src.c$k.a.b.V$k", "proj.src.c$k.a.b", "DEFINES", 4, 9), ("Method", "proj.src.c$k.a.b.V$k.operator_equal", "proj.src.c$k.a.b.V$k", "DEFINES_METHOD", 10, 10), ("Method", "proj.src.c$k.a.b.V$k.operator_equal", "proj.src.c$k.a.b.V$k", "DEFINES_METHOD", 6, 6), ("Method", "proj.src.c$k.a.b.V$k.operator_plus", "proj.src.c$k.a.b.V$k", "DEFINES_METHOD", 5, 5), ("Method", "proj.src.c$k.a.b.V$k.operator_subscript", "proj.src.c$k.a.b.V$k", "DEFINES_METHOD", 7, 7), ("Method", "proj.src.c$k.a.b.V$k.~V$k", "proj.src.c$k.a.b.V$k", "DEFINES_METHOD", 8, 8)],
    2: [("Class", "proj.src.c$k.Quiet", "proj.src.c$k", "DEFINES", 4, 4), ("Class", "proj.src.c$k.W", "proj.src.c$k", "DEFINES", 3, 3), ("Class", "proj.src.c$k.api.S", "proj.src.c$k.api", "DEFINES", 2, 2), ("Function", "proj.src.c$k.api.f", "proj.src.c$k.api", "DEFINES", 2, 2), ("Function", "proj.src.c$k.k", "proj.src.c$k", "DEFINES", 3, 3), ("Method", "proj.src.c$k.api.S.h", "proj.src.c$k.api.S", "DEFINES_METHOD", 2, 2)],
    3: [("Function", "proj.src.c$k.f$k", "proj.src.c$k", "DEFINES", 3, 3)],
    4: [("Class", "proj.src.c$k.Box$k", "proj.src.c$k", "DEFINES", 3, 3), ("Enum", "proj.src.c$k.Color", "proj.src.c$k", "DEFINES", 5, 5), ("Function", "proj.src.c$k.pick", "proj.src.c$k", "DEFINES", 4, 4), ("Method", "proj.src.c$k.Box$k.get", "proj.src.c$k.Box$k", "DEFINES_METHOD", 3, 3), ("Union", "proj.src.c$k.U", "proj.src.c$k", "DEFINES", 6, 6)],
    5: [("Class", "proj.src.c$k.Node$k", "proj.src.c$k", "DEFINES", 1, 1), ("Function", "proj.src.c$k.top", "proj.src.c$k", "DEFINES", 3, 3), ("Method", "proj.src.c$k.Node$k.link", "proj.src.c$k.Node$k", "DEFINES_METHOD", 1, 1), ("Method", "proj.src.c$k.Node$k.link", "proj.src.c$k.Node$k", "DEFINES_METHOD", 2, 2), ("Method", "proj.src.c$k.Node$k.size", "proj.src.c$k.Node$k", "DEFINES_METHOD", 1, 1)],
    6: [("Class", "proj.src.c$k.A$k", "proj.src.c$k", "DEFINES", 1, 1), ("Function", "proj.src.c$k.f", "proj.src.c$k", "DEFINES", 3, 3), ("Function", "proj.src.c$k.main", "proj.src.c$k", "DEFINES", 4, 4), ("Method", "proj.src.c$k.A$k.A$k", "proj.src.c$k.A$k", "DEFINES_METHOD", 1, 1), ("Method", "proj.src.c$k.A$k.A$k", "proj.src.c$k.A$k", "DEFINES_METHOD", 1, 1), ("Method", "proj.src.c$k.A$k.A$k", "proj.src.c$k.A$k", "DEFINES_METHOD", 2, 2)],
    7: [("Function", "proj.src.c$k.real$k", "proj.src.c$k", "DEFINES", 5, 5)],
    8: [("Class", "proj.i$k.Client", "proj.i$k", "DEFINES", 2, 2), ("Function", "proj.i$k.open", "proj.i$k", "DEFINES", 3, 3), ("Function", "proj.src.i$k.open", "proj.src.i$k", "DEFINES", 2, 2), ("Function", "proj.src.j$k.shut$k", "proj.src.j$k", "DEFINES", 2, 2), ("Method", "proj.i$k.Client.get", "proj.i$k.Client", "DEFINES_METHOD", 2, 2)],
    9: [("Function", "proj.src.c$k.hid", "proj.src.c$k", "DEFINES", 2, 2), ("Function", "proj.src.c$k.operator_less", "proj.src.c$k", "DEFINES", 4, 4), ("Function", "proj.src.c$k.out.in.deep$k", "proj.src.c$k.out.in", "DEFINES", 3, 3), ("Function", "proj.src.c$k.raw$k", "proj.src.c$k", "DEFINES", 1, 1)],
})
def cpp_definitions(f: DataFrame) -> DataFrame:
    return outline.definitions(outlined(f))


@on_files("E07_cpp", "cpp", "cls base type ord", {
    1: [("proj.src.c$k.a.b.V$k", "Base", "INHERITS", 0), ("proj.src.c$k.a.b.V$k", "x.Other", "INHERITS", 1)],
})
def cpp_parents(f: DataFrame) -> DataFrame:
    return outline.parents(outlined(f))


@on_files("E11_cpp", "cpp", "caller call_name line", {
    0: [("proj.m$k.Point.norm", "sq", 5), ("proj.src.m$k.helper$k", "area", 2)],
    1: [("proj.src.c$k.a.b.V$k.operator_equal", "same", 10), ("proj.src.c$k.a.b.V$k.operator_plus", "add", 5), ("proj.src.c$k.a.b.V$k.~V$k", "drop", 8)],
    2: [("proj.src.c$k.api.f", "g", 2)],
    5: [("proj.src.c$k.Node$k.link", "n.size", 2), ("proj.src.c$k.Node$k.link", "std.sort", 2)],
    6: [("proj.src.c$k.A$k.A$k", "init", 1), ("proj.src.c$k.f", "call", 3), ("proj.src.c$k.main", "run", 4)],
    8: [("proj.i$k.Client.get", "send", 2)],
    9: [("proj.src.c$k.operator_less", "less", 4), ("proj.src.c$k.out.in.deep$k", "hid", 3)],
})
def cpp_calls(f: DataFrame) -> DataFrame:
    return outline.calls(outlined(f))


@on_files("E08_cpp", "cpp", "module_qn local_name full_name is_wildcard", {
    0: [("proj.interfaces.m$k", "geo$k", "proj.geo$k", False), ("proj.interfaces.m$k", "std", "proj.std", False), ("proj.interfaces.m$k", "vector", "std.vector", False), ("proj.src.m$k", "geo$k", "proj.geo$k", False)],
    1: [("proj.src.c$k", "string", "std.string", False), ("proj.src.c$k", "y", "proj.x.y", False)],
    2: [("proj.src.c$k", "big$k:part", "proj.big$k.part", False), ("proj.src.d$k", ":part", "proj.part", False), ("proj.src.d$k", "big$k:part", "proj.big$k.part", False), ("proj.src.d$k", "other.mod", "proj.other.mod", False)],
    3: [("proj.src.c$k", "lonely$k", "proj.lonely$k", False)],
    8: [("proj.modules.i$k", "map", "std.map", False), ("proj.modules.i$k", "net.http$k", "proj.net.http$k", False), ("proj.src.i$k", "net.http$k", "proj.net.http$k", False), ("proj.src.j$k", "net.http$k", "proj.net.http$k", False)],
})
def cpp_imports(f: DataFrame) -> DataFrame:
    return imported(outlined(f))


@on_files("E17", "cpp", "module_qn label qualified_name partition", {
    0: [("proj.interfaces.m$k", "ModuleInterface", "proj.geo$k", None), ("proj.src.m$k", "ModuleImplementation", "proj.geo$k_impl", None)],
    2: [("proj.src.c$k", "ModuleInterface", "proj.big$k.part", "part"), ("proj.src.d$k", "ModuleImplementation", "proj.big$k.part_impl", "part")],
    3: [("proj.src.c$k", "ModuleImplementation", "proj.lonely$k_impl", None)],
    8: [("proj.modules.i$k", "ModuleInterface", "proj.net.http$k", None), ("proj.src.i$k", "ModuleImplementation", "proj.net.http$k_impl", None), ("proj.src.j$k", "ModuleImplementation", "proj.net.http$k_impl", None)],
})
def module_units(f: DataFrame) -> DataFrame:
    return languages.module_units(outlined(f), "proj")


@on_files("E17_edges", "cpp", "src type dst", {
    0: [("proj.geo$k_impl", "IMPLEMENTS", "proj.geo$k"), ("proj.interfaces.m$k", "EXPORTS_MODULE", "proj.geo$k"), ("proj.src.m$k", "IMPLEMENTS_MODULE", "proj.geo$k_impl")],
    2: [("proj.big$k.part_impl", "IMPLEMENTS", "proj.big$k.part"), ("proj.src.c$k", "EXPORTS_MODULE", "proj.big$k.part"), ("proj.src.d$k", "IMPLEMENTS_MODULE", "proj.big$k.part_impl")],
    3: [("proj.src.c$k", "IMPLEMENTS_MODULE", "proj.lonely$k_impl")],
    8: [("proj.modules.i$k", "EXPORTS_MODULE", "proj.net.http$k"), ("proj.net.http$k_impl", "IMPLEMENTS", "proj.net.http$k"), ("proj.src.i$k", "IMPLEMENTS_MODULE", "proj.net.http$k_impl"), ("proj.src.j$k", "IMPLEMENTS_MODULE", "proj.net.http$k_impl")],
})
def module_edges(f: DataFrame) -> DataFrame:
    return languages.module_edges(languages.module_units(outlined(f), "proj"))


@on_files("E17_exported", "cpp", "module_qn label qualified_name", {
    0: [("proj.interfaces.m$k", "Class", "proj.m$k.Point"), ("proj.interfaces.m$k", "Function", "proj.m$k.area")],
    2: [("proj.src.c$k", "Class", "proj.src.c$k.W"), ("proj.src.c$k", "Class", "proj.src.c$k.api.S"), ("proj.src.c$k", "Function", "proj.src.c$k.api.f"), ("proj.src.c$k", "Function", "proj.src.c$k.k")],
    8: [("proj.modules.i$k", "Class", "proj.i$k.Client"), ("proj.modules.i$k", "Function", "proj.i$k.open")],
})
def exported(f: DataFrame) -> DataFrame:
    rows = outlined(f)
    return languages.exported(rows, outline.definitions(rows))



# go --------------------------------------------------------------------------------------------------------------------


@on_files("E04_go", "go", "label qualified_name parent_qn type start_line end_line", {
    0: [("Class", "proj.g$k.T$k", "proj.g$k", "DEFINES", 9, 12), ("Method", "proj.g$k.T$k.Run", "proj.g$k.T$k", "DEFINES_METHOD", 14, 16)],
    1: [("Function", "proj.g$k.Top$k", "proj.g$k", "DEFINES", 3, 3), ("Function", "proj.g$k.two", "proj.g$k", "DEFINES", 4, 4)],
    2: [("Interface", "proj.g$k.R$k", "proj.g$k", "DEFINES", 2, 5), ("Method", "proj.g$k.R$k.Read", "proj.g$k.R$k", "DEFINES_METHOD", 3, 3), ("Type", "proj.g$k.Id", "proj.g$k", "DEFINES", 6, 6)],
    3: [("Function", "proj.g$k.outer$k", "proj.g$k", "DEFINES", 2, 6), ("Function", "proj.g$k.outer$k.anonymous_5_11", "proj.g$k.outer$k", "DEFINES", 5, 5), ("Function", "proj.g$k.outer$k.inner", "proj.g$k.outer$k", "DEFINES", 3, 3)],
    4: [("Function", "proj.g$k.Map$k", "proj.g$k", "DEFINES", 2, 7)],
    5: [("Method", "proj.g$k.Set$k.Has", "proj.g$k.Set$k", "DEFINES_METHOD", 5, 5)],
    6: [("Function", "proj.g$k.x", "proj.g$k", "DEFINES", 4, 4)],
    7: [("Class", "proj.g$k.A$k", "proj.g$k", "DEFINES", 2, 3), ("Class", "proj.g$k.B$k", "proj.g$k", "DEFINES", 5, 8), ("Method", "proj.g$k.B$k.Val", "proj.g$k.B$k", "DEFINES_METHOD", 9, 9)],
    8: [("Function", "proj.g$k.sw$k", "proj.g$k", "DEFINES", 2, 9)],
    9: [("Function", "proj.g$k.handler$k", "proj.g$k", "DEFINES", 2, 2), ("Function", "proj.g$k.init", "proj.g$k", "DEFINES", 3, 3)],
})
def go_definitions(f: DataFrame) -> DataFrame:
    return outline.definitions(outlined(f))


@on_files("E07_go", "go", "cls base type ord", {
    0: [("proj.g$k.T$k", "Base", "INHERITS", 10)],
    2: [("proj.g$k.R$k", "Closer", "INHERITS", 4)],
    7: [("proj.g$k.B$k", "A$k", "INHERITS", 6), ("proj.g$k.B$k", "pkg.Other", "INHERITS", 7)],
})
def go_parents(f: DataFrame) -> DataFrame:
    return outline.parents(outlined(f))


@on_files("E11_go", "go", "caller call_name line", {
    0: [("proj.g$k.T$k.Run", "f.Errorf", 15)],
    1: [("proj.g$k.Top$k", "os.Exit", 3), ("proj.g$k.two", "Top$k", 4)],
    3: [("proj.g$k.outer$k", "inner", 4), ("proj.g$k.outer$k.anonymous_5_11", "later", 5), ("proj.g$k.outer$k.inner", "leaf", 3)],
    4: [("proj.g$k.Map$k", "f", 4)],
    5: [("proj.g$k.Set$k.Has", "s.m.get", 5)],
    6: [("proj.g$k.x", "Sqrt", 4), ("proj.g$k.x", "alias$k.Do", 4)],
    8: [("proj.g$k.sw$k", "many", 6), ("proj.g$k.sw$k", "one", 4)],
    9: [("proj.g$k.handler$k", "w.Write", 2), ("proj.g$k.init", "reg", 3)],
})
def go_calls(f: DataFrame) -> DataFrame:
    return outline.calls(outlined(f))


@on_files("E08_go", "go", "module_qn local_name full_name is_wildcard", {
    0: [("proj.g$k", "effect", "side/effect", False), ("proj.g$k", "f", "fmt", False), ("proj.g$k", "http", "net/http", False)],
    1: [("proj.g$k", "os", "os", False)],
    6: [("proj.g$k", "alias$k", "a/b/c", False), ("proj.g$k", "math", "math", False)],
})
def go_imports(f: DataFrame) -> DataFrame:
    return imported(outlined(f))



# lua -------------------------------------------------------------------------------------------------------------------


@on_files("E04_lua", "lua", "label qualified_name parent_qn type start_line end_line", {
    0: [("Function", "proj.l$k.M.f", "proj.l$k.M", "DEFINES", 3, 5), ("Function", "proj.l$k.M.h", "proj.l$k.M", "DEFINES", 6, 6), ("Function", "proj.lib.util$k.g", "proj.lib.util$k", "DEFINES", 1, 1)],
    1: [("Function", "proj.l$k.q", "proj.l$k", "DEFINES", 3, 3)],
    2: [("Function", "proj.l$k.outer$k", "proj.l$k", "DEFINES", 1, 5), ("Function", "proj.l$k.outer$k.inner", "proj.l$k.outer$k", "DEFINES", 2, 2)],
    3: [("Function", "proj.l$k.real$k", "proj.l$k", "DEFINES", 4, 4)],
    4: [("Function", "proj.l$k.t.run", "proj.l$k.t", "DEFINES", 3, 3), ("Function", "proj.l$k.t.stop", "proj.l$k.t", "DEFINES", 5, 5)],
    5: [("Function", "proj.l$k.anonymous_4_21", "proj.l$k", "DEFINES", 4, 4)],
    6: [("Function", "proj.l$k.a.b.c$k", "proj.l$k.a.b", "DEFINES", 1, 1), ("Function", "proj.l$k.plain$k", "proj.l$k", "DEFINES", 2, 2)],
})
def lua_definitions(f: DataFrame) -> DataFrame:
    return outline.definitions(outlined(f))


@on_files("E11_lua", "lua", "caller call_name line", {
    0: [("proj.l$k", "require", 2), ("proj.l$k.M.f", "M.h", 4), ("proj.l$k.M.f", "util.g", 4)],
    1: [("proj.l$k", "pcall", 1), ("proj.l$k", "q", 4), ("proj.l$k.q", "string.upper", 3)],
    2: [("proj.l$k.outer$k", "inner", 3), ("proj.l$k.outer$k", "stop", 4), ("proj.l$k.outer$k.inner", "leaf", 2)],
    4: [("proj.l$k", "require", 1), ("proj.l$k.t.run", "self.go", 3), ("proj.l$k.t.stop", "os.exit", 5)],
    5: [("proj.l$k", "next$k", 2), ("proj.l$k.anonymous_4_21", "use", 4)],
    6: [("proj.l$k.a.b.c$k", "w", 1), ("proj.l$k.a.b.c$k", "z", 1)],
})
def lua_calls(f: DataFrame) -> DataFrame:
    return outline.calls(outlined(f))


@on_files("E08_lua", "lua", "module_qn local_name full_name is_wildcard", {
    0: [("proj.l$k", "util", "proj.lib.util$k", False)],
    1: [("proj.l$k", "json", "cjson", False), ("proj.l$k", "near", "proj.side$k", False), ("proj.l$k", "string", "string", False)],
    4: [("proj.l$k", "b$k", "a.b$k", False), ("proj.l$k", "os", "os", False)],
})
def lua_imports(f: DataFrame) -> DataFrame:
    return imported(outlined(f))


# The cascade -------------------------------------------------------------------------------------------------------------


@on_files("E12_cascade", "cascade", "caller name callee step by", {
    0: [("proj.py$k.b.h", "g", "proj.py$k.a.f", 4, "import")],
    1: [("proj.py$k.b.h", "f", "proj.py$k.a.f", 5, "qualified"), ("proj.py$k.b.h", "m", "proj.py$k.a.C.m", 5, "qualified")],
    2: [("proj.py$k.b.h", "f$k", "proj.py$k.a.f$k", 6, "wildcard")],
    3: [("proj.py$k.a.f", "g", "proj.py$k.a.g", 7, "module"), ("proj.py$k.a.g.inner", "f", "proj.py$k.a.f", 7, "module"), ("proj.py$k.a.g", "inner", "proj.py$k.a.g.inner", 8, "nearest")],
    4: [("proj.py$k.b.h", "far$k", "proj.py$k.deep.a.far$k", 8, "nearest"), ("proj.py$k.b.h", "far$k", "proj.py$k.deep.a.far$k", 8, "nearest")],
    5: [("proj.py$k.a.B.go", "up", "proj.py$k.a.A.up", 2, "super"), ("proj.py$k.a.B.go", "up", "proj.py$k.a.A.up", 5, "qualified")],
    6: [("proj.py$k.a.go", "a", "proj.py$k.a.T.a", 5, "qualified"), ("proj.py$k.a.go", "a", "proj.py$k.a.T.a", 3, "chain")],
    7: [("proj.py$k.a.go", "print", "builtin.print", 9, "builtin"), ("proj.py$k.a.go", "len", "builtin.len", 9, "builtin")],
    8: [("proj.py$k.a.U.__init__", "T", "proj.py$k.a.T", 7, "module"), ("proj.py$k.a.U.go", "T", "proj.py$k.a.T", 7, "module"), ("proj.py$k.a.U.go", "run$k", "proj.py$k.a.T.run$k", 5, "qualified"), ("proj.py$k.a.U.go", "run$k", "proj.py$k.a.T.run$k", 5, "qualified")],
    9: [
        ("proj.js$k.a", "anonymous_1_13", "proj.js$k.a.anonymous_1_13", 1, "iife"), ("proj.js$k.a.anonymous_1_13", "boot$k", "proj.js$k.a.boot$k", 7, "module"), ("proj.js$k.a.boot$k", "anonymous_3_9", "proj.js$k.a.boot$k.anonymous_3_9", 1, "iife"),
        ("proj.cc$k.a.go$k", "pick", "proj.cc$k.a.pick", 7, "module"), ("proj.cc$k.a.go$k", "operator_plus", "builtin.cpp.operator_plus", 10, "operator"), ("proj.cc$k.a.go$k", "operator_subscript", "builtin.cpp.operator_subscript", 10, "operator"),
    ],
})
def call_cascade(f: DataFrame) -> DataFrame:
    """Python's calls with types of receivers, and those of JavaScript and C++, through one cascade."""
    spark = f.sparkSession
    rows, other = durable(extract.extracted(f, "proj")), outlined(f)
    roots = f.select(F.substring_index("path", "/", 1).alias("root")).distinct()
    imports = durable(extract.local_imports(rows, roots, "proj"))
    bound = durable(types.bindings(f, "proj"))
    reached = types.inferred(bound, imports.filter("NOT is_wildcard"), rows)[1]
    key = F.xxhash64("path", "seq").alias("id")
    kind = F.when((F.col("recv") == "super()") | (F.col("name") == "super"), "super").when(F.col("recv").startswith("%"), "chain").otherwise("plain")
    python = bound.filter("how = 'call'").select(key, "module_qn", F.col("what").alias("call_name"), "name", kind.alias("kind"), F.col("at").alias("caller"))
    placed = outline.placed_calls(other).withColumn("kind", F.lit("iife")).union(outline.calls(other).union(outline.operator_calls(other)).withColumn("kind", F.lit("plain")))
    scanned = placed.select(F.xxhash64("module_qn", "caller", "call_name", "line").alias("id"), "module_qn", "call_name", F.element_at(F.split("call_name", "[.]"), -1).alias("name"), "kind", "caller").dropDuplicates(["id"])
    calls = durable(python.union(scanned))
    defined = rows.filter("kind IN ('Function', 'Method', 'Class')").select("qualified_name").union(outline.definitions(other).select("qualified_name"))
    registry = durable(defined.distinct().withColumn("simple_name", F.element_at(F.split("qualified_name", "[.]"), -1)))
    native = spark.createDataFrame([(n, f"builtin.{n}") for n in sorted(dir(builtins)) if callable(getattr(builtins, n))], "name string, callee string")
    found = resolve.cascade(calls.drop("caller"), reached.select(key, "callee"), imports, registry, native)
    return calls.select("id", "caller", "name").join(found, "id")


# Entities ----------------------------------------------------------------------------------------------------------------

#: lang, full_name, module_path, way; every fourth key's results are stored before the others are asked for.
ENTITIES = [
    ("python", "proj.m$k.Kind", "proj.m$k", "registry"), ("python", "proj.m$k.run", "proj.m$k", "registry"), ("python", "proj.m$k", "proj.m$k", "unchanged"), ("python", "json.load$k", "json", "module"), ("python", "os.path.join$k", "os.path", "module"),
    ("python", "lib$k.Thing", "lib$k", "name"), ("python", "lib$k.thing", "lib$k.thing", "unchanged"), ("python", "alone$k", "alone$k", "single"), ("javascript", "fs.read$k", "fs", "module"), ("javascript", "react$k.Component", "react$k", "name"),
    ("javascript", "react$k.use", "react$k.use", "unchanged"), ("go", "net/http/Client$k", "net/http", "module"), ("go", "github.com/x/y$k/Thing", "github.com/x/y$k", "name"), ("go", "github.com/x/y$k/thing", "github.com/x/y$k/thing", "unchanged"),
    ("rust", "std::collections::Map$k", "std::collections", "module"), ("rust", "serde$k::Visitor", "serde$k", "name"), ("rust", "serde$k::json", "serde$k", "name"), ("rust", "serde$k::with_under", "serde$k::with_under", "unchanged"),
    ("cpp", "std::x$k::vector", "std::x$k", "name"), ("cpp", "std::is_$k", "std", "name"), ("cpp", "std::now$k", "std::now$k", "unchanged"), ("cpp", "boost::Any$k", "boost::Any$k", "unchanged"), ("java", "java.util.concurrent.Run$k", "java.util.concurrent", "module"),
    ("java", "com.acme$k.Foo", "com.acme$k", "name"), ("lua", "string.format$k", "string", "module"), ("lua", "lfs$k.dir", "lfs$k.dir", "unchanged"),
]
_ENTITY_ROWS = ", ".join("('" + "', '".join(r) + "')" for r in ENTITIES)


def module_paths(d: DataFrame) -> DataFrame:
    """The modules of the names of each part, after the results of some of them have been stored."""
    spark, k = d.sparkSession, F.col("p_partkey").cast("string")
    each = d.select("p_partkey", F.explode(F.array(*[F.struct(F.lit(lang).alias("lang"), F.lit(name).alias("full_name")) for lang, name, *_ in ENTITIES])).alias("e"))
    names = durable(each.select("p_partkey", "e.lang", F.replace("e.full_name", F.lit("$k"), k).alias("full_name")))
    registry = d.select(F.explode(F.array(*[F.struct(F.concat(F.lit("proj.m"), k, F.lit(end)).alias("qualified_name"), F.lit(label).alias("label")) for end, label in ((".Kind", "Class"), (".run", "Function"), ("", "Module"))])).alias("r")).select("r.*")
    modules, at = entities.known_modules(spark), new_folder(spark, "module-paths")
    entities.module_paths(names.filter("p_partkey % 4 = 0"), registry, modules).select("lang", "full_name", "module_path").write.parquet(at)
    return entities.module_paths(names, registry, modules, spark.read.parquet(at))


on_table("E09", "part", f"SELECT lang, replace(full_name, '$k', p_partkey::VARCHAR) AS full_name, replace(module_path, '$k', p_partkey::VARCHAR) AS module_path, CASE WHEN p_partkey % 4 = 0 THEN 'stored' ELSE way END AS way FROM part, (VALUES {_ENTITY_ROWS}) v(lang, full_name, module_path, way)")(module_paths)
