"""Definitions, parents and calls of JavaScript, TypeScript, Java, Go, Rust, C++ and Lua, from the rows of ``scan``.

What a block is depends on the text that leads to it and, for members, on the block around it. Patterns stand in tables
by language; they are evaluated in the JVM. The names of a file's blocks form one map, which the file's own rows look
their surroundings up in, so a file is the unit that is gathered, and nothing larger.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAME = r"[A-Za-z_$#][\w$]*"
_NESTED = r"\([^()]*(?:\([^()]*(?:\([^()]*\)[^()]*)*\)[^()]*)*\)"
#: Up to where a JavaScript function's body begins.
JS_FUNCTION = rf"(?:async\s*)?(?:function\b\s*\*?\s*(?:{NAME})?\s*{_NESTED}|(?:{_NESTED}|{NAME})\s*(?::[^=]*)?=>)"
_NO_CALL = r"(?!(?:if|for|while|switch|catch|with|return|else|do|try|synchronized|new|throw)\b)"
_JAVA_METHOD = rf"(?:^|[\s>\]])({_NO_CALL}{NAME})\s*({_NESTED})\s*(?:throws [\w.,\s]+)?$"
_CPP_NAME = rf"(?:{NAME}\s*(?:<[^<>]*>)?\s*::\s*)*(?:~?{NAME}|operator\s*(?:\(\)|\[\]|[^\s(\w]+|\w+))"

#: By language, in this order: kind, pattern with the name in its first group, and the kinds of blocks that it may be a
#: member of. ``text``: the pattern is for statements without a block.
RULES: dict[str, tuple[tuple[str, str, str], ...]] = {
    "javascript": (
        ("Class", rf"\bclass\s+({_NO_CALL}(?!extends\b){NAME})[^;]*$|({NAME})\s*=\s*class\b[^;]*$", ""),
        ("Interface", rf"\binterface\s+({NAME})[^;=]*$", ""), ("Enum", rf"\benum\s+({NAME})\s*$", ""), ("Type", rf"^(?:export\s+)?type\s+({NAME})[^=]*=\s*$", ""),
        ("Namespace", r"^(?:export\s+)?(?:declare\s+)?(?:namespace|module)\s+([\w.]+)\s*$", ""),
        ("Prototype", rf"([\w$.]+\.prototype\.{NAME})\s*=\s*{JS_FUNCTION}\s*$", ""),
        ("Assigned", rf"((?:{NAME}\.)+{NAME})\s*=\s*{JS_FUNCTION}\s*$", ""),
        ("Function", rf"(?:^|[\s(,])(?:const|let|var)\s+(?:[^()]*,\s*)?({NAME})\s*(?::[^=]*)?=\s*{JS_FUNCTION}\s*$", ""),
        ("Function", rf"\bfunction\b\s*\*?\s*({NAME})\s*(?:<[^()]*>)?\s*{_NESTED}\s*(?::[^=]*)?$", ""),
        ("Function", rf"(?:^|,)\s*[\"']?({NAME})[\"']?\s*:\s*{JS_FUNCTION}\s*$", "Object"),
        ("Function", rf"(?:^|,)\s*(?:(?:async|get|set)\s+|\*\s*)*({_NO_CALL}{NAME})\s*{_NESTED}\s*(?::[^=]*)?$", "Object"),
        ("Method", rf"(?:^|\s|\*)({_NO_CALL}{NAME})\s*(?:<[^()]*>)?\s*{_NESTED}\s*(?::[^=]*)?$", "Class"),
        ("Method", rf"(?:^|\s)({NAME})\s*(?::[^=]*)?=\s*{JS_FUNCTION}\s*$", "Class"),
        ("Anonymous", rf"({JS_FUNCTION})\s*$", ""),
        ("Object", rf"\bObject\.assign\(\s*({NAME}(?:\.{NAME})*)\s*,\s*$", ""),
        ("Object", rf"(?:({NAME}(?:\.{NAME})*)\s*(?::[^=]*)?=|({NAME})\s*:|[(,?:\[=]|\breturn|\bdefault)\s*$", ""),
    ),
    "java": (
        ("Class", rf"(?:^|\s)(?:class|record)\s+({NAME})", ""), ("Interface", rf"(?:^|\s|@)interface\s+({NAME})", ""), ("Enum", rf"(?:^|\s)enum\s+({NAME})", ""),
        ("Method", _JAVA_METHOD, "Class,Interface,Enum"),
    ),
    "go": (
        ("Class", rf"^type\s*(?:\(.*?|\s)({NAME})(?:\[[^\]]*\])?\s+struct\s*$", ""), ("Interface", rf"^type\s*(?:\(.*?|\s)({NAME})(?:\[[^\]]*\])?\s+interface\s*$", ""),
        ("Method", rf"^func\s*\([^()]*\)\s*({NAME})\s*[\[(]", ""), ("Function", rf"^func\s+({NAME})\s*[\[(]", ""), ("Function", rf"({NAME})\s*:?=\s*func\s*{_NESTED}[^;]*$", ""), ("Anonymous", rf"\b(func)\s*{_NESTED}[^;]*$", ""),
    ),
    "rust": (
        ("Module", rf"(?:^|\s)mod\s+({NAME})\s*$", ""), ("Impl", r"^((?:unsafe\s+)?impl\b.*)$", ""), ("Class", rf"(?:^|\s)struct\s+({NAME})", ""), ("Enum", rf"(?:^|\s)enum\s+({NAME})", ""),
        ("Union", rf"(?:^|\s)union\s+({NAME})", ""), ("Interface", rf"(?:^|\s)trait\s+({NAME})", ""), ("Method", rf"(?:^|\s)fn\s+({NAME})", "Impl,Interface"), ("Function", rf"(?:^|\s)fn\s+({NAME})", ""),
    ),
    "cpp": (
        ("Namespace", r"(?:^|\s)namespace\s+([\w:]+)\s*$", ""), ("Namespace", r'^(?:export|extern "\d+"|(?:export\s+|inline\s+)*namespace)()$', ""), ("Enum", rf"(?:^|\s)enum\s+(?:class\s+|struct\s+)?({NAME})[^()]*$", ""), ("Union", rf"(?:^|\s)union\s+({NAME})[^()]*$", ""),
        ("Class", rf"(?:^|[\s>])(?:class|struct)\s+(?:alignas{_NESTED}\s*)?({NAME})(?:\s+final)?\s*(?::[^()]*)?$", ""),
        ("Method", rf"(?:^|[\s*&~>])({_NO_CALL}{_CPP_NAME})\s*{_NESTED}[^()=]*(?::[^;]*)?$", "Class,Union"), ("Function", rf"(?:^|[\s*&>])({_NO_CALL}{_CPP_NAME})\s*{_NESTED}[^()=]*$", "file,Namespace"),
        ("Function", rf"[\w>&*]\s+({NAME})\s*=\s*\[[^\]]*\]\s*(?:{_NESTED})?[^()=]*$", ""),
    ),
    "lua": (
        ("Function", rf"\bfunction\s+({NAME}(?:[.:]{NAME})*)\s*{_NESTED}\s*$", ""), ("Function", rf"(?:^|\s|,)({NAME}(?:\.{NAME})*)\s*=\s*function\s*{_NESTED}\s*$", ""), ("Anonymous", rf"\b(function)\s*{_NESTED}\s*$", ""), ("Object", rf"({NAME}(?:\.{NAME})*)\s*=\s*$", ""),
    ),
}
#: The same for statements that have no block.
TEXT_RULES: dict[str, tuple[tuple[str, str, str], ...]] = {
    "javascript": (
        ("Prototype", rf"^([\w$.]+\.prototype\.{NAME})\s*=\s*{JS_FUNCTION}(?!\s*\{{\}})", ""), ("Assigned", rf"^((?:{NAME}\.)+{NAME})\s*=\s*{JS_FUNCTION}(?!\s*\{{\}})", ""),
        ("Function", rf"^(?:export\s+)?(?:const|let|var)\s+({NAME})\s*(?::[^=]*)?=\s*{JS_FUNCTION}(?!\s*\{{\}})", ""), ("Method", rf"^(?:[\w\s]*\s)?({NAME})\s*=\s*{JS_FUNCTION}(?!\s*\{{\}})", "Class"),
        ("Function", rf"^({NAME})\s*:\s*{JS_FUNCTION}(?!\s*\{{\}})", "Object"), ("Method", rf"^({NAME})\s*\??\s*{_NESTED}", "Interface"),
    ),
    "java": (("Method", rf"^[^=]*(?:^|[\s>\]])({_NO_CALL}{NAME})\s*({_NESTED})\s*(?:throws [\w.,\s]+)?(?:default\b.*)?$", "Class,Interface,Enum"),),
    "go": (("Method", rf"^({NAME})\s*{_NESTED}", "Interface"), ("Type", rf"^type\s+({NAME})\s+(?!struct\b|interface\b)", "")),
    "rust": (("Class", rf"(?:^|\s)struct\s+({NAME})", ""), ("Method", rf"(?:^|\s)fn\s+({NAME})", "Impl,Interface"), ("Type", rf"(?:^|\s)type\s+({NAME})", "file,Module")),
    "cpp": (("Method", rf"^(?!return\b)[^=]*?(?:^|[\s*&~>])({_NO_CALL}{_CPP_NAME})\s*{_NESTED}\s*(?:const|noexcept|override|final|\s)*(?:=\s*(?:0|default|delete))?$", "Class,Union"),
        ("Function", rf"^(?!return\b|throw\b|else\b|new\b|#)(?:[\w:<>,*&\s\[\]]*[\w>*&])\s+[*&]*({_NO_CALL}{_CPP_NAME})\s*{_NESTED}\s*(?:const|noexcept|\s)*$", "file,Namespace"),
    ),
    "lua": (),
}
#: Kinds whose names are part of the names of what stands in them.
SCOPES = ("Class", "Interface", "Enum", "Union", "Namespace", "Module", "Impl", "Function", "Method", "Assigned", "Prototype", "Anonymous", "Object")
CALLABLE = ("Function", "Method", "Prototype", "Assigned", "Anonymous")
#: Symbols of operators with names of their own, fixed values.
OPERATORS = {
    "+": "plus", "-": "minus", "*": "multiply", "/": "divide", "%": "modulo", "=": "assign", "==": "equal", "!=": "not_equal", "<": "less", ">": "greater", "<=": "less_equal", ">=": "greater_equal",
    "&&": "logical_and", "||": "logical_or", "&": "bitwise_and", "|": "bitwise_or", "^": "bitwise_xor", "~": "bitwise_not", "!": "not", "<<": "left_shift", ">>": "right_shift", "++": "increment", "--": "decrement",
    "+=": "plus_assign", "-=": "minus_assign", "*=": "multiply_assign", "/=": "divide_assign", "%=": "modulo_assign", "&=": "and_assign", "|=": "or_assign", "^=": "xor_assign", "<<=": "left_shift_assign", ">>=": "right_shift_assign",
    "[]": "subscript", "()": "call",
}
#: Words before a bracket that are no calls.
KEYWORDS = "if for while switch catch return function func fn elseif else sizeof alignof decltype typeof synchronized new and or not in await yield throw case do try match loop unsafe move async super_ operator until with impl class import export void pub type".split()


def _groups(pattern: str) -> int:
    import re

    return re.compile(pattern).groups


def first_group(code: Column, pattern: str) -> Column:
    """The first group of the pattern's match that is not empty; null without a match."""
    found = [F.regexp_extract(code, pattern, i) for i in range(1, max(1, _groups(pattern)) + 1)]
    return F.when(code.rlike(pattern), reduce(lambda rest, x: F.when(x != "", x).otherwise(rest), reversed(found), F.lit("")))


def _kinds(rules: dict, lang: Column, code: Column) -> Column:
    """All rules that the text fits, in order, as (kind, name, within)."""
    out = None
    for name, own in rules.items():
        fits = [F.when(code.rlike(p), F.struct(F.lit(kind).alias("kind"), first_group(code, p).alias("name"), F.lit(within).alias("within"))) for kind, p, within in own]
        if fits:
            of = F.filter(F.array(*fits), lambda x: x.isNotNull())
            out = F.when(lang == name, of) if out is None else out.when(lang == name, of)
    return out


def impl_target(head: Column) -> Column:
    """The type that a Rust impl is for, without its path and parameters."""
    plain = head
    for _ in range(4):  # parameters in parameters, from the inside out
        plain = F.regexp_replace(plain, r"<[^<>]*>", "")
    after = F.regexp_replace(F.regexp_replace(plain, r"^(?:unsafe\s+)?impl\s*", ""), r"^.*\sfor\s+|\s+where\b.*$", "")
    return F.regexp_extract(after, r"([A-Za-z_]\w*)\s*$", 1)


def _shown(lang: Column, kind: Column, name: Column, line: Column, col: Column) -> Column:
    """A definition's name as it stands in qualified names."""
    cpp = F.regexp_replace(F.regexp_replace(name, r"\s+", ""), "::", ".")
    symbol = F.regexp_extract(cpp, r"^(?:.*\.)?operator([^\w.].*)$", 1)
    known = F.create_map(*[F.lit(x) for pair in OPERATORS.items() for x in pair])
    operator = F.concat(F.regexp_extract(cpp, r"^(.*\.)?operator", 1), F.lit("operator_"), F.coalesce(F.element_at(known, symbol), symbol))
    js = F.regexp_replace(F.regexp_replace(name, r"\.prototype(\.|$)", "$1"), r"^(?:module\.)?exports\.|^this\.", "")
    return (
        F.when(kind == "Anonymous", F.concat(F.lit("anonymous_"), line.cast("string"), F.lit("_"), col.cast("string"))).when(kind == "Impl", impl_target(name))
        .when((lang == "cpp") & (symbol != ""), operator).when(lang == "cpp", cpp).when(lang == "lua", F.replace(name, F.lit(":"), F.lit("."))).when(lang == "javascript", js).otherwise(name)
    )


def outlined(rows: DataFrame) -> DataFrame:
    """``rows`` of ``scan`` with label and name of those that define something, ``inside`` (kind of the block around it) and ``scope`` (the names around it).

    A member's pattern holds only where the block around it is of a kind that has such members. A block that defines
    nothing hands its surroundings on.
    """
    code, lang = F.col("code"), F.col("lang")
    first = rows.withColumn("_fits", F.when(F.col("kind") == "block", _kinds(RULES, lang, code)).when((F.size("holds") == 0) | (lang == "javascript"), _kinds(TEXT_RULES, lang, code)))
    # Which kind a block is does not depend on more than two levels: kinds that have members are free of context.
    free = F.get(F.filter("_fits", lambda x: (x["within"] == "") & ~x["kind"].isin("Function", "Method", "Anonymous", "Assigned", "Prototype")), F.lit(0))
    blocks = first.filter("kind = 'block'").groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("id", F.struct(F.coalesce(free["kind"], F.lit("")).alias("k")).alias("v")))).alias("_kinds"))
    near = first.join(blocks, "path", "left").withColumn("inside", F.when(F.col("parent") == 0, "file").otherwise(F.element_at("_kinds", F.col("parent"))["k"]))
    chosen = F.get(F.filter("_fits", lambda x: (x["within"] == "") | F.array_contains(F.split(x["within"], ","), F.col("inside"))), F.lit(0))
    named = near.withColumn("_d", chosen).withColumn("label", F.col("_d.kind")).withColumn("name", _shown(F.col("lang"), F.col("_d.kind"), F.col("_d.name"), F.col("start_line"), F.col("col")))
    named = named.drop("_fits", "_kinds", "_d")
    receiver = F.regexp_extract("code", r"^func\s*\(\s*(?:\w+\s+)?\*?\s*(\w+)", 1)
    shown = (
        F.when((F.col("lang") == "java") & (F.col("label") == "Method"), F.concat("name", types_of(F.regexp_extract("code", rf"({_NESTED})\s*(?:throws [\w.,\s]+)?(?:default\b.*)?$", 1))))
        .when((F.col("lang") == "go") & (F.col("label") == "Method") & (receiver != ""), F.concat_ws(".", receiver, "name")).otherwise(F.col("name"))
    )
    named = named.withColumn("shown", shown)
    own = F.when(F.col("label").isin(*SCOPES) & (F.col("name") != ""), F.struct(F.col("shown").alias("name"), "label"))
    names = named.filter("kind = 'block'").select("path", "id", own.alias("v")).filter("v IS NOT NULL").groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("id", "v"))).alias("_names"))
    around = F.filter(F.transform("ups", lambda i: F.element_at("_names", i)), lambda x: x.isNotNull())
    return named.join(names, "path", "left").withColumn("scope", F.coalesce(around, F.array().cast("array<struct<name:string,label:string>>"))).drop("_names")


def types_of(params: Column) -> Column:
    """``(int,String)`` of a bracket with Java parameters; type parameters, annotations and names are left out."""
    plain = F.regexp_replace(params, r"^\(|\)$", "")
    for _ in range(4):
        plain = F.regexp_replace(plain, r"<[^<>]*>", "")
    one = lambda x: F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(x, r"@\w+(\([^()]*\))?\s*|\bfinal\s+", "")), r"\s*(\[\])?$", "$1"), r"\s+[\w$]+((?:\[\])*)$", "$1")
    return F.concat(F.lit("("), F.array_join(F.transform(F.filter(F.split(plain, ","), lambda x: F.trim(x) != ""), one), ","), F.lit(")"))


def module_file(module: Column) -> Column:
    """Whether a C++ file is a module's: under ``interfaces`` or ``modules``, or by its suffix."""
    parts = F.split(module, "[.]")
    return (F.size(parts) >= 3) & F.arrays_overlap(parts, F.array(F.lit("interfaces"), F.lit("modules")))


def home() -> Column:
    """What a file's names begin with: its module; a C++ module file's have the project and the file's name."""
    parts = F.split("module_qn", "[.]")
    return F.when((F.col("lang") == "cpp") & module_file(F.col("module_qn")), F.concat_ws(".", parts[0], F.element_at(parts, -1))).otherwise(F.col("module_qn"))


def definitions(rows: DataFrame) -> DataFrame:
    """Path, module_qn, lang, label, qualified_name, name, parent_qn, type (of the edge from the parent), start_line, end_line, code, rank of definitions.

    ``rows``: those of ``outlined``. Objects and impls define nothing themselves. Go and C++ members that stand outside
    their type get its name; a method assigned to a prototype belongs to the constructor, and one that is assigned to a
    member of an object has the object's name.
    """
    found = rows.filter(F.col("label").isNotNull() & ~F.col("label").isin("Object", "Impl", "Module") & (F.col("name") != ""))
    in_scope = F.array_join(F.transform("scope", lambda x: x["name"]), ".")
    whole = F.concat_ws(".", home(), F.when(in_scope != "", in_scope), "shown")
    label = (
        F.when(F.col("label").isin("Prototype", "Assigned", "Anonymous"), "Function").when(F.col("label") == "Namespace", "Namespace")
        .when((F.col("lang") == "cpp") & (F.col("label") == "Function") & F.col("name").rlike(r"^[^.]+\.[^.]+$"), "Method").otherwise(F.col("label"))
    )
    out = found.select(
        "path", "module_qn", "lang", label.alias("label"), F.regexp_replace(whole, "::", ".").alias("qualified_name"), F.element_at(F.split("name", "[.]"), -1).alias("name"),
        "start_line", "end_line", "code", "strings", "kind", "id", "holds",
    )
    parent = F.regexp_replace(F.regexp_replace("qualified_name", r"\([^()]*\)$", ""), r"\.[^.]*$", "")
    edge = F.when(F.col("label") == "Method", "DEFINES_METHOD").otherwise("DEFINES")
    return out.filter("label != 'Namespace'").withColumn("parent_qn", parent).withColumn("type", edge)


def parents(rows: DataFrame) -> DataFrame:
    """module_qn, lang, cls, base (as written, without parameters), type (INHERITS or IMPLEMENTS), ord of classes, interfaces and impls.

    Java: extends before implements; an interface's parents are inherited. Rust: a type implements an impl's trait, a
    trait inherits its bounds. Go: a struct's field without a name is inherited. JavaScript: also what prototypes are made of.
    """
    code = F.col("code")
    for _ in range(4):
        code = F.regexp_replace(code, r"<[^<>]*>", "")
    own = rows.filter("kind = 'block' AND label IN ('Class', 'Interface', 'Enum', 'Impl')").withColumn("_c", code).withColumn("_in", F.array_join(F.transform("scope", lambda x: x["name"]), "."))
    here = F.concat_ws(".", home(), F.when(F.col("_in") != "", F.col("_in")), "name")
    c, lang = F.col("_c"), F.col("lang")
    part = lambda text, kind: F.transform(F.filter(F.split(text, ","), lambda x: F.trim(x) != ""), lambda x: F.struct(F.trim(x).alias("base"), F.lit(kind).alias("type")))
    none = part(F.lit(""), "")
    after = lambda word: F.regexp_extract(c, rf"\s{word}\s+(.*?)(?=\s(?:extends|implements|permits)\s|$)", 1)
    cpp = F.regexp_replace(F.regexp_replace(F.regexp_extract(c, r"[^:]:(?!:)\s*([^()]*)$", 1), r"\b(?:public|private|protected|virtual)\s+", ""), "::", ".")
    bases = (
        F.when(lang.isin("java", "javascript"), F.concat(part(after("extends"), "INHERITS"), part(after("implements"), "IMPLEMENTS")))
        .when(lang == "cpp", F.when(F.col("label") == "Class", part(cpp, "INHERITS")).otherwise(none))
        .when((lang == "rust") & (F.col("label") == "Impl") & c.rlike(r"\sfor\s"), part(F.regexp_replace(F.regexp_extract(c, r"impl\s*(.*?)\s+for\s", 1), "::", "."), "IMPLEMENTS"))
        .when((lang == "rust") & (F.col("label") == "Interface"), part(F.replace(F.regexp_replace(F.regexp_extract(c, r"trait\s+\w+\s*:\s*(.*?)(?:\s+where\b.*)?$", 1), r"'\w+(\s*\+)?", ""), F.lit("+"), F.lit(",")), "INHERITS"))
        .otherwise(none)
    )
    written = own.select("path", "module_qn", "lang", here.alias("cls"), F.posexplode(bases).alias("ord", "b")).select("module_qn", "lang", "cls", "b.base", "b.type", "ord")
    field = rows.filter("lang = 'go' AND kind = 'text' AND inside IN ('Class', 'Interface')").filter(F.col("code").rlike(r"^\*?[\w.]+$"))
    go = field.select("module_qn", "lang", F.concat_ws(".", "module_qn", F.element_at("scope", -1)["name"]).alias("cls"), F.regexp_replace("code", r"^\*", "").alias("base"), F.lit("INHERITS").alias("type"), F.col("start_line").alias("ord"))
    return written.unionByName(go)


def running(rows: DataFrame) -> DataFrame:
    """The statements of ``outlined`` rows with ``run``, their text without the heads of definitions that stand in them, and ``caller``, the name of the innermost function around (else the module)."""
    text = rows.filter("kind = 'text'")
    heads = rows.filter("kind = 'block' AND label IS NOT NULL AND label != 'Object'").groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("id", F.struct("code").alias("v")))).alias("_heads"))
    held = text.join(heads, "path", "left")
    # The text that leads to a definition's body is no code that runs, but for what it is handed to.
    first = F.element_at("_heads", F.get("holds", F.lit(0)))["code"]
    run = F.when(first.isNotNull(), F.substring(F.col("code"), F.length(first) + 1, 1 << 30)).when(F.col("label").isNotNull() & ((F.col("lang") != "javascript") | (F.col("inside") == "Interface")), F.lit("")).when((F.col("lang") == "rust") & (F.col("inside") == "Enum") | (F.col("lang") == "cpp") & F.col("code").rlike(r"^\s*#"), F.lit("")).otherwise(F.col("code"))
    # What a C++ declaration constructs is named behind its type, and is no function.
    run = F.when(F.col("lang") == "cpp", F.regexp_replace(run, r"^(?:const\s+|static\s+)*[A-Z][\w:]*(?:<[^<>]*>)?\s+\w+\s*(?=\()", "")).otherwise(run)
    lead = F.regexp_extract(first, r"^(.*?)(?:async\s*)?(?:function\b|\([^()]*(?:\([^()]*\)[^()]*)*\)\s*(?::[^=]*)?=>|[\w$]+\s*=>|\bclass\b|$)", 1)
    lead = F.when(first.isNotNull() & (F.col("lang") == "javascript") & lead.rlike(r"[\w$]\s*\($"), lead).otherwise(F.lit(""))
    # A function without a block is a statement, and its calls are its own.
    itself = F.when(F.col("label").isin(*CALLABLE) & (F.col("lang") == "javascript"), F.array(F.struct(F.col("shown").alias("name"), "label"))).otherwise(F.array().cast("array<struct<name:string,label:string>>"))
    around = F.concat("scope", itself)
    is_function = F.transform(around, lambda x: x["label"].isin(*CALLABLE))
    upto = F.size(around) - F.array_position(F.reverse(is_function), True) + 1
    names = F.when(F.array_contains(is_function, True), F.slice(F.transform(around, lambda x: x["name"]), F.lit(1), upto.cast("int"))).otherwise(F.array().cast("array<string>"))
    return held.withColumn("run", F.concat(lead, F.lit(" "), run)).withColumn("caller", F.concat_ws(".", home(), names)).drop("_heads")


def calls(rows: DataFrame) -> DataFrame:
    """module_qn, lang, caller, call_name, line of call sites; ``rows``: those of ``outlined``.

    A call belongs to the innermost function around its statement, else to the module. A definition's own head has no
    calls but those that it is handed to; strings hold none. Parts of names are joined by dots.
    """
    plain = F.regexp_replace("run", r"(?<=\w)\s*::\s*<[^<>()]*>", "")
    pattern = lambda joint: F.lit(rf"(?<![\w$.])((?:{NAME}(?:\s*(?:{joint})\s*))*{NAME})!?\s*(?:<[\w\s,.<>]*>)?\(")
    sites = F.when(F.col("lang") == "lua", F.regexp_extract_all(plain, pattern(r"\.|:"), F.lit(1))).otherwise(F.regexp_extract_all(plain, pattern(r"\??\.|::|->"), F.lit(1)))
    each = running(rows).select("module_qn", "lang", "caller", F.explode(sites).alias("call_name"), F.col("start_line").alias("line"))
    name = F.regexp_replace("call_name", r"\s*(?:\?\.|::|->|:|\.)\s*", ".")
    return each.withColumn("call_name", F.regexp_replace(name, "#", "")).filter(~F.col("call_name").isin(*KEYWORDS))


def placed_calls(rows: DataFrame) -> DataFrame:
    """module_qn, lang, caller, call_name, line of anonymous functions that are called where they stand."""
    blocks = rows.filter("kind = 'block' AND label = 'Anonymous'").select("path", F.col("id").alias("_id"), F.concat_ws(".", F.array_join(F.transform("scope", lambda x: x["name"]), "."), "shown").alias("_name"))
    text = running(rows).filter(F.col("code").rlike(r"\{\}\s*\)?\s*(?:\.call\s*)?\(")).select("path", "module_qn", "lang", "caller", F.get("holds", F.lit(0)).alias("_id"), F.col("start_line").alias("line"))
    return text.join(blocks, ["path", "_id"]).select("module_qn", "lang", "caller", F.regexp_replace("_name", r"^\.", "").alias("call_name"), "line")


def operator_calls(rows: DataFrame) -> DataFrame:
    """The same of C++ operators that are called by their names."""
    run = running(rows.filter("lang = 'cpp'"))
    symbol = F.explode(F.regexp_extract_all("run", F.lit(r"\boperator\s*([^\s\w(]+|\(\))\s*\("), F.lit(1))).alias("_s")
    known = F.create_map(*[F.lit(x) for pair in OPERATORS.items() for x in pair])
    each = run.select("module_qn", "lang", "caller", symbol, F.col("start_line").alias("line"))
    return each.select("module_qn", "lang", "caller", F.concat(F.lit("operator_"), F.coalesce(F.element_at(known, F.col("_s")), F.col("_s"))).alias("call_name"), "line")
