"""Scalar functions on names, paths, commands and error texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_part(qn: Column) -> Column:
    return F.element_at(F.split(qn, "[.]"), -1)


def parent_part(qn: Column) -> Column:
    """All but the last dotted part; empty for a single part."""
    return F.when(qn.contains("."), F.regexp_replace(qn, r"\.[^.]*$", "")).otherwise("")


def has_prefix(qn: Column, prefix: str) -> Column:
    """component-wise; the prefix itself counts."""
    return (qn == prefix) | qn.startswith(prefix + ".")


def has_suffix(qn: Column, suffix: str) -> Column:
    """F04."""
    return (qn == suffix) | qn.endswith("." + suffix)


def call_target(call: Column) -> Column:
    """the last token of a call name."""
    return F.element_at(F.split(call, "[.:]"), -1)


def import_distance(candidate: Column, caller: Column) -> Column:
    """longer length less the common leading parts, one less inside the caller's parent package."""
    a, b = F.split(candidate, "[.]"), F.split(caller, "[.]")
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    state = F.aggregate(same, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, x: F.struct((s["n"] + F.when(s["on"] & x, 1).otherwise(0)).alias("n"), (s["on"] & x).alias("on")))
    parent = parent_part(caller)
    near = (parent != "") & candidate.startswith(F.concat(parent, F.lit(".")))
    return (F.greatest(F.size(a), F.size(b)) - state["n"] - F.when(near, 1).otherwise(0)).cast("bigint")


def match_score(param: Column, cls: Column) -> Column:
    """F08, on lower-cased names."""
    return F.when(param == cls, 100).when(param.endswith(cls) | cls.endswith(param), 90).when(param.contains(cls), F.floor(80 * F.length(cls) / F.length(param))).otherwise(0).cast("bigint")


def camel(name: Column) -> Column:
    """F09."""
    return F.array_join(F.transform(F.split(name, "_"), F.initcap), "")


def path_to_module(path: Column) -> Column:
    """without the suffix; a package's own file names the package."""
    return F.regexp_replace(F.replace(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit("/"), F.lit(".")), r"\.(__init__|mod)$", "")


def relative_import(module: Column, dots: int, rest: Column) -> Column:
    """``dots`` leading dots seen from ``module``, whose first part is the project."""
    parts = F.split(module, "[.]")
    kept = F.slice(parts, 2, F.greatest(F.size(parts) - 1 - dots, F.lit(0)))
    return F.array_join(F.concat(kept, F.filter(F.array(rest), lambda x: x != "")), ".")


def js_path(path: Column, module: Column) -> Column:
    """./ and ../ of a path resolved against a module's dotted parts."""
    start = F.slice(F.split(module, "[.]"), 1, F.greatest(F.size(F.split(module, "[.]")) - 1, F.lit(0)))
    step = lambda acc, x: F.when((x == ".") | (x == ""), acc).when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, x))
    return F.when(path.startswith("."), F.array_join(F.aggregate(F.split(path, "/"), start, step), ".")).otherwise(F.replace(path, F.lit("/"), F.lit(".")))


def requirement_name(spec: Column) -> Column:
    """the name of a dependency line, without extras."""
    return F.regexp_extract(F.trim(spec), r"^([A-Za-z0-9_.-]+)", 1)


def requirement_spec(spec: Column) -> Column:
    return F.trim(F.regexp_extract(F.trim(spec), r"^[A-Za-z0-9_.-]+(?:\[[^\]]*\])?(.*)$", 1))


def repo_of_url(url: Column) -> Column:
    """owner/name of a hosting URL, https or ssh; null for others. The pattern is a fixed value."""
    p = r"github\.com[/:]([^/]+)/([^/\s]+?)(?:\.git)?$"
    own = F.trim(url)
    return F.when(F.regexp_like(own, F.lit(p)), F.concat_ws("/", F.regexp_extract(own, p, 1), F.regexp_extract(own, p, 2)))


#: F16: language aliases, fixed values.
LANGUAGES = {"py": "python", "python3": "python", "js": "javascript", "ts": "typescript", "c++": "cpp", "golang": "go", "rs": "rust"}


def language(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    low = F.lower(F.trim(name))
    return F.coalesce(F.element_at(table, low), low)


#: File extensions of languages, fixed values.
EXTENSIONS = {".py": "python", ".js": "javascript", ".jsx": "javascript", ".ts": "typescript", ".tsx": "typescript", ".rs": "rust", ".go": "go", ".java": "java", ".scala": "scala", ".cpp": "cpp", ".lua": "lua"}


def language_of_extension(extension: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in EXTENSIONS.items() for x in kv]), extension)


def command_prefix(cmd: Column) -> Column:
    """the first word, or with its subcommand, option or flags for some commands."""
    t = F.filter(F.split(F.trim(cmd), r"\s+"), lambda x: x != "")
    head, second = F.get(t, 0), F.get(t, 1)
    rest = F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0)))
    word = F.get(F.filter(rest, lambda x: ~x.startswith("-")), 0)
    git = F.when(second.isNull(), head).when(~second.startswith("-"), F.concat(head, F.lit(" "), second)).otherwise(F.coalesce(F.concat(head, F.lit(" "), word), head))
    option = F.get(F.filter(F.array(*map(F.lit, ("-name", "-type", "-exec", "-path", "-iname"))), lambda o: F.array_contains(rest, o)), 0)
    find = F.coalesce(F.concat(head, F.lit(" "), option), head)
    short = F.filter(F.transform(F.slice(rest, 1, 3), lambda x: F.when(x == "--recursive", "-r").otherwise(x)), lambda x: x.startswith("-") & ~x.startswith("--"))
    grep = F.concat_ws(" ", F.concat(F.array(head), F.slice(short, 1, 2)))
    ls = F.when(second.startswith("-"), F.concat(head, F.lit(" "), second)).otherwise(head)
    flag = F.get(F.filter(F.slice(rest, 1, 2), lambda x: x.startswith("-")), 0)
    view = F.coalesce(F.concat(head, F.lit(" "), flag), head)
    return (
        F.when(F.size(t) == 0, "unknown").when(head == "git", git).when(head == "find", find).when(head.isin("grep", "rg", "ag", "ack"), grep).when(head == "ls", ls).when(head.isin("cat", "head", "tail", "wc"), view).otherwise(head)
    )


#: Replacements of error texts in order, fixed values.
ERROR_PATTERNS = (
    (r"\b[a-f0-9]{7,40}\b", "{hash}"),
    (r"(?:/[\w.-]+)+(?:/[\w.-]+)?", "{path}"),
    (r"\b[a-zA-Z0-9_-]+/[a-zA-Z0-9_-]+\b", "{repo}"),
    (r"(?i)\bline\s+\d+\b", "line {num}"),
    (r"\b\d+\b", "{num}"),
    (r'"[^"]*"', "{str}"),
    (r"'[^']*'", "{str}"),
    (r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "{ip}"),
    (r"\b\d{4}-\d{2}-\d{2}\b", "{date}"),
    (r"\b\d{2}:\d{2}:\d{2}\b", "{time}"),
)


def normal_error(stderr: Column) -> Column:
    """the first line, 200 characters, with variable parts replaced."""
    out = F.substring(F.get(F.split(F.trim(stderr), "\n"), 0), 1, 200)
    for p, r in ERROR_PATTERNS:
        out = F.regexp_replace(out, p, r)
    return out


def pattern_id(text: Column) -> Column:
    return F.substring(F.md5(text), 1, 12)


def cache_key(repo: Column, cmd: Column) -> Column:
    return F.sha2(F.concat(repo, F.lit(":"), cmd), 256)


def lines(content: Column, start: int, end: int) -> Column:
    """lines ``start``..``end``, counted from 1; null outside the text."""
    own = F.split(content, "\r\n|\r|\n")
    ok = (F.lit(start) >= 1) & (F.lit(end) >= F.lit(start)) & (F.lit(start) <= F.size(own))
    return F.when(ok, F.array_join(F.slice(own, F.lit(start), F.lit(max(1, end - start + 1))), "\n"))


def truncated(code: Column, most: int) -> Column:
    own = F.split(code, "\n")
    return F.when(F.size(own) <= most, code).otherwise(F.concat(F.array_join(F.slice(own, 1, most), "\n"), F.lit("\n... ("), (F.size(own) - most).cast("string"), F.lit(" more lines)")))


def difficulty(hops: Column, modules: Column) -> Column:
    s = hops + modules
    return F.when(s <= 3, "easy").when(s <= 5, "medium").when(s <= 7, "hard").otherwise("expert")


def cosine(a: Column, b: Column) -> Column:
    """null if either vector has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def llm_json(reply: Column, schema: str) -> Column:
    """a reply without its code fence, parsed; null where it is no JSON of that schema."""
    return F.from_json(F.trim(F.regexp_replace(F.trim(reply), r"^```(?:json)?|```$", "")), schema)


def cypher_reply(reply: Column) -> Column:
    """without backticks and a language prefix, with one semicolon at the end."""
    stripped = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    bare = F.replace(stripped(reply), F.lit("`"), F.lit(""))
    bare = F.when(bare.startswith("cypher"), stripped(F.substring(bare, 7, 1 << 30))).otherwise(bare)
    return F.when(bare.endswith(";"), bare).otherwise(F.concat(bare, F.lit(";")))


def duration(seconds: Column) -> Column:
    """like 42s, 3m 7s or 2h 5m."""
    part = lambda unit, of: F.pmod(F.floor(seconds / unit), F.lit(of)).cast("bigint").cast("string")
    hours = F.floor(seconds / 3600).cast("bigint").cast("string")
    short = F.concat(F.rint(seconds).cast("bigint").cast("string"), F.lit("s"))
    return F.when(seconds < 60, short).when(seconds < 3600, F.concat(part(60, 60), F.lit("m "), part(1, 60), F.lit("s"))).otherwise(F.concat(hours, F.lit("h "), part(60, 60), F.lit("m")))


def filled(template: Column, **values: Column) -> Column:
    """``${NAME}`` replaced by the values."""
    for name, value in values.items():
        template = F.replace(template, F.lit("${" + name + "}"), value)
    return template


def weights(text: str, known: tuple[str, ...]) -> dict[str, int]:
    """like ``a:4,b:3``; unknown names and parts without a colon are left out."""
    pairs = [p.split(":") for p in text.split(",") if ":" in p]
    return {n.strip(): int(w) for n, w in pairs if n.strip() in known}


def weights_of(text: Column, known: tuple[str, ...]) -> Column:
    """F36 for a column: a map of the known names; of a repeated name the last counts."""
    pairs = F.filter(F.transform(F.split(text, ","), lambda p: F.split(p, ":")), lambda p: (F.size(p) == 2) & F.trim(p[0]).isin(*known))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: F.trim(q[0]) == F.trim(p[0])))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(F.trim(p[0]), F.trim(p[1]).cast("int"))))


def merged(low: Column, high: Column) -> Column:
    """both maps' entries; ``high`` wins where both have a key."""
    return F.map_concat(F.map_filter(low, lambda k, _: ~F.map_contains_key(high, k)), high)


def iso_utc(ts: Column) -> Column:
    """ISO 8601 in UTC, without a fraction if it is none; the session's zone is UTC."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micro = F.date_format(ts, "SSSSSS")
    return F.concat(whole, F.when(micro != "000000", F.concat(F.lit("."), micro)).otherwise(""), F.lit("+00:00"))


def shown(value: Column, kind: str) -> Column:
    """values of other than plain types as text."""
    plain = kind.startswith(("string", "int", "bigint", "double", "float", "boolean", "array", "map", "struct"))
    return value if plain else value.cast("string")
