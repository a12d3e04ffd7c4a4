"""Dependency manifests of eight kinds (S11): rows of path, name, spec, grp."""

from __future__ import annotations

import json
import re
import tomllib
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "path string, name string, spec string, grp string"
_NAME = re.compile(r"([A-Za-z0-9_.-]+)(?:\[[^\]]*\])?")
_GEM = re.compile(r"""gem\s+["']([^"']+)["'](?:\s*,\s*["']([^"']+)["'])?""")
Found = Iterator[tuple[str, str, str | None]]


def _pyproject(text: str) -> Found:
    data = tomllib.loads(text)
    poetry = data.get("tool", {}).get("poetry", {}).get("dependencies", {})
    yield from ((n, str(s), None) for n, s in poetry.items() if n.lower() != "python")
    project = data.get("project", {})
    groups = [(None, project.get("dependencies", [])), *project.get("optional-dependencies", {}).items()]
    yield from ((m[1], line, g) for g, lines in groups for line in lines if (m := _NAME.match(line.strip())))


def _requirements(text: str) -> Found:
    for line in map(str.strip, text.splitlines()):
        if not line.startswith(("#", "-")) and (m := _NAME.match(line)):
            yield m[1], line[m.end() :].strip(), None


def _json(*sections: str, without: str = ""):
    def find(text: str) -> Found:
        data = json.loads(text)
        for i, section in enumerate(sections):
            yield from ((n, s, None) for n, s in data.get(section, {}).items() if i or n != without)

    return find


def _cargo(text: str) -> Found:
    data = tomllib.loads(text)
    for section in ("dependencies", "dev-dependencies"):
        yield from ((n, s if isinstance(s, str) else s.get("version", ""), None) for n, s in data.get(section, {}).items())


def _go(text: str) -> Found:
    """Requirements in a block have two words; outside one, ``require`` comes before."""
    inside = False
    for line in map(str.strip, text.splitlines()):
        if line.startswith("require ("):
            inside = True
        elif line == ")":
            inside = False
        elif inside or line.startswith("require "):
            words = line.split()[0 if inside else 1 :]
            if len(words) > 1 and not (inside and any(w.startswith("//") for w in words[:2])):
                yield words[0], words[1], None


def _gems(text: str) -> Found:
    yield from ((m[1], m[2] or "", None) for line in text.splitlines() if (m := _GEM.match(line.strip())))


def _csproj(text: str) -> Found:
    if "<!DOCTYPE" in text or "<!ENTITY" in text:
        raise ValueError("entities are not read")
    yield from ((e.get("Include"), e.get("Version") or "", None) for e in ET.fromstring(text).iter("PackageReference") if e.get("Include"))


READERS = {
    "pyproject.toml": _pyproject,
    "requirements.txt": _requirements,
    "package.json": _json("dependencies", "devDependencies", "peerDependencies"),
    "cargo.toml": _cargo,
    "go.mod": _go,
    "gemfile": _gems,
    "composer.json": _json("require", "require-dev", without="php"),
}


def found_in(path: str, content: str) -> list[tuple[str, str, str | None]]:
    """What a manifest names, up to the place where it cannot be read; nothing for other files."""
    name, out = path.rsplit("/", 1)[-1].lower(), []
    reader = READERS.get(name) or (_csproj if name.endswith(".csproj") else None)
    try:
        for n, s, g in reader(content) if reader else ():
            out.append((n, str(s), g))
    except (ValueError, AttributeError, TypeError, ET.ParseError):
        pass
    return out


def dependencies(files: DataFrame) -> DataFrame:
    """files (path, content) to path, name, spec, grp. Only manifests are sent to Python; a null content has no rows."""
    name = F.lower(F.substring_index("path", "/", -1))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            rows = [(p, *d) for p, t in zip(part["path"], part["content"], strict=True) for d in found_in(p, t)]
            yield pd.DataFrame(rows, columns=["path", "name", "spec", "grp"])

    wanted = files.filter(F.col("content").isNotNull() & (name.isin(*READERS) | name.endswith(".csproj")))
    return wanted.select("path", "content").mapInPandas(run, SCHEMA)


def external_packages(found: DataFrame, project: str) -> DataFrame:
    """Edges project, package, version_spec, grp, each once; python and php are no packages."""
    own = found.filter(~F.lower("name").isin("python", "php"))
    return own.select(F.lit(project).alias("project"), F.col("name").alias("package"), F.col("spec").alias("version_spec"), "grp").distinct()
