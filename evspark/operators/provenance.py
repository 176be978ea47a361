"""Manifests, releases and staged runs (FRZ-1 to FRZ-3, REL-1, RUN-1 to RUN-3, JN-18, JN-19).

Hashes of many files are taken by the cluster (``manifest``); comparing, naming and pointing are driver work on
small objects.
"""

from __future__ import annotations

import hashlib
import re
import shutil
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from pathlib import Path, PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evspark.functions import jsonx


#: A name of parts between single slashes, none of them a dot or two, without what some systems give a meaning of its own.
PORTABLE = re.compile(r"(?!\.{1,2}(?:/|$))[^/\\:]+(?:/(?!\.{1,2}(?:/|$))[^/\\:]+)*")


def safe_path(root: Path, name: str) -> Path:
    """The file of a portable relative name below a folder; anything else is a ValueError (FN-18).

    A name that leads over a link resolves to another place than it spells, inside the folder or out of it.
    """
    if not isinstance(name, str) or not PORTABLE.fullmatch(name):
        raise ValueError(f"not a portable name: {name!r}")
    spelled = root.resolve().joinpath(name)
    if spelled.resolve() != spelled:
        raise ValueError(f"leads over a link: {name}")
    return spelled


def manifest(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, size, sha256) of all files below a folder, by path (FRZ-1)."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    base = "^(?:file:)?/*" + root.strip("/").replace(".", r"\.") + "/"
    return raw.select(F.regexp_replace("path", base, "").alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256")).orderBy("path")


def compare(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """(path, change): changed, missing and added files (JN-18); has to be empty."""
    a, b = recorded.select("path", F.col("sha256").alias("a")), found.select("path", F.col("sha256").alias("b"))
    change = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "added").when(F.col("a") != F.col("b"), "changed")
    return a.join(b, "path", "full_outer").withColumn("change", change).where("change IS NOT NULL").select("path", "change")


def template_status(project: DataFrame, recorded: DataFrame, current: DataFrame) -> DataFrame:
    """(path, status): current, outdated, filled or missing, from three tables (path, sha256) (JN-19)."""
    named = lambda df, c: df.select("path", F.col("sha256").alias(c))
    out = named(recorded, "was").join(named(project, "own"), "path", "left").join(named(current, "now"), "path", "left")
    status = (
        F.when(F.col("own").isNull(), "missing").when(F.col("own") != F.col("was"), "filled").when(F.col("own").eqNullSafe(F.col("now")), "current").otherwise("outdated")
    )
    return out.select("path", status.alias("status"))


# ---- on the driver


def digest(path: Path) -> str:
    h = hashlib.sha256()
    with path.open("rb") as f:
        while chunk := f.read(1 << 20):
            h.update(chunk)
    return h.hexdigest()


def write_new(path: Path, text: str) -> None:
    """SNK-4: never over an existing file."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("x", encoding="utf-8", newline="\n") as f:
        f.write(text)


def _below(root: Path, scope: str) -> tuple[list[str], list[str]]:
    """Names of the files and of the links below a folder."""
    folder = safe_path(root, scope)
    if not folder.is_dir():
        raise ValueError(f"no folder: {scope}")
    found = sorted(p for p in folder.rglob("*"))
    name = lambda p: p.relative_to(root.resolve()).as_posix()
    return [name(p) for p in found if p.is_file() and not p.is_symlink()], [name(p) for p in found if p.is_symlink()]


def freeze(root: Path, files: list[str], scopes: list[str], target: str) -> dict:
    """Write a manifest of files and of all files in scopes; it cannot hold itself, and freezes no links (FRZ-3)."""
    names = set(files)
    for scope in scopes:
        own, links = _below(root, scope)
        if links:
            raise ValueError(f"links in {scope}: {links[:20]}")
        names.update(own)
    if target in names or any(PurePosixPath(target).is_relative_to(s) for s in scopes):
        raise ValueError("a manifest cannot freeze itself")
    if not names:
        raise ValueError("nothing to freeze")
    entries = [{"path": n, "size": (p := safe_path(root, n)).stat().st_size, "sha256": digest(p)} for n in sorted(names)]
    out = {"schema_version": 1, "algorithm": "sha256", "scopes": sorted(scopes), "files": entries}
    write_new(safe_path(root, target), jsonx.pretty(out))
    return out


_HASH = re.compile("[0-9a-f]{64}")


def manifest_faults(recorded) -> list[str]:
    """Why something is no manifest."""
    if not isinstance(recorded, dict) or sorted(recorded) != ["algorithm", "files", "schema_version", "scopes"]:
        return ["the keys are not those of a manifest"]
    out = [] if recorded["schema_version"] == 1 and recorded["schema_version"] is not True and recorded["algorithm"] == "sha256" else ["of another version or algorithm"]
    entries, scopes = recorded["files"], recorded["scopes"]
    if not isinstance(scopes, list) or not all(isinstance(x, str) for x in scopes):
        out.append("scopes are no list of names")
    if not isinstance(entries, list) or not entries:
        return [*out, "no files"]
    sound = [e for e in entries if isinstance(e, dict) and sorted(e) == ["path", "sha256", "size"] and isinstance(e["path"], str)]
    out += ["an entry has other keys"] * (len(sound) < len(entries))
    out += ["a path stands twice"] * (len({e["path"] for e in sound}) < len(sound))
    good = lambda e: type(e["size"]) is int and e["size"] >= 0 and isinstance(e["sha256"], str) and _HASH.fullmatch(e["sha256"])
    return out + [f"no size or hash: {e['path']}" for e in sound if not good(e)]


def verify(root: Path, recorded: dict) -> list[tuple[str, str]]:
    """(path, change) of everything that differs from a manifest; files and links added to closed scopes included (FRZ-2).

    What is no manifest, and a scope that is gone, is a ValueError.
    """
    if faults := manifest_faults(recorded):
        raise ValueError(f"not a manifest: {'; '.join(faults[:20])}")
    known = {e["path"]: (e["size"], e["sha256"]) for e in recorded["files"]}
    out = []
    for name, told in sorted(known.items()):
        path = safe_path(root, name)
        now = (path.stat().st_size, digest(path)) if path.is_file() else None
        if now != told:
            out.append((name, "changed" if now else "missing"))
    for scope in recorded["scopes"]:
        files, links = _below(root, scope)
        out += [(n, "added") for n in files if n not in known] + [(n, "link") for n in links]
    return out


class Releases:
    """Named copies of a project, and a pointer to the one that holds (REL-1)."""

    def __init__(self, project: Path, left_out: tuple[str, ...] = ("releases",)):
        self.project, self.folder, self.left_out = project, project / "releases", left_out

    def create(self, name: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]{0,63}", name):
            raise ValueError("not a release name")
        target = self.folder / name
        if target.exists():
            raise ValueError("the release exists")
        files = sorted(p for p in self.project.rglob("*") if p.is_file() and p.relative_to(self.project).parts[0] not in self.left_out)
        for p in files:
            to = target / "files" / p.relative_to(self.project)
            to.parent.mkdir(parents=True, exist_ok=True)
            shutil.copyfile(p, to)
        freeze(target, [], ["files"], "MANIFEST.json")
        return digest(target / "MANIFEST.json")

    def verify(self, name: str) -> list[tuple[str, str]]:
        target = self.folder / name
        return verify(target, jsonx.strict((target / "MANIFEST.json").read_text(encoding="utf-8")))

    def activate(self, name: str) -> None:
        if problems := self.verify(name):
            raise ValueError(f"the release is not what was frozen: {problems[:20]}")
        sha = digest(self.folder / name / "MANIFEST.json")
        (self.folder / "CURRENT").write_text(jsonx.pretty({"release": name, "manifest_sha256": sha}), encoding="utf-8")
        with (self.folder / "ACTIVATIONS").open("a", encoding="utf-8") as f:
            f.write(jsonx.canonical({"release": name, "manifest_sha256": sha, "at": datetime.now(timezone.utc).isoformat()}) + "\n")

    def current(self) -> str:
        pointer = jsonx.strict((self.folder / "CURRENT").read_text(encoding="utf-8"))
        if digest(self.folder / pointer["release"] / "MANIFEST.json") != pointer["manifest_sha256"]:
            raise ValueError("the pointer and the release differ")
        return pointer["release"]


@dataclass
class Stage:
    """A step of a run: it writes its outputs, relative paths, below the folder it is given."""

    name: str
    run: Callable[[Path], None]
    outputs: list[str] = field(default_factory=list)


def run_stages(stages: list[Stage], fixed: Path, formal: Path, target: Path, recorded: dict | None = None) -> list[dict]:
    """Run stages one after the other and compare what they write with the formal outputs, up to the first difference
    (RUN-1). Fixed inputs have to equal their manifest before and after."""
    owners = [o for s in stages for o in s.outputs]
    if len(set(owners)) != len(owners):
        raise ValueError("an output has two owners")
    if target.exists():
        raise ValueError("the output folder exists")

    def unchanged() -> None:
        if recorded and (problems := verify(fixed, recorded)):
            raise ValueError(f"fixed inputs differ: {problems[:20]}")

    unchanged()
    report = []
    for stage in stages:
        stage.run(target)
        differs = [o for o in stage.outputs if not (target / o).is_file() or not (formal / o).is_file() or digest(target / o) != digest(formal / o)]
        report.append({"stage": stage.name, "status": "differs" if differs else "equal", "outputs": differs})
        if differs:
            break
    unchanged()
    return report


def record_outputs(formal: Path, outputs: list[str], target: Path) -> dict:
    """Write the hashes of formal outputs; an earlier record is kept under its own hash (RUN-3)."""
    out = {"outputs": {o: digest(safe_path(formal, o)) for o in sorted(outputs)}}
    if target.exists():
        target.rename(target.with_name(f"{target.stem}-{digest(target)[:12]}{target.suffix}"))
    write_new(target, jsonx.pretty(out))
    return out
