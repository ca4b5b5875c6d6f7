"""Tables that change together: versions behind one manifest.

Each commit writes the changed tables into folders of their own and then one small manifest, numbered, that says where
every table lies. A reader takes the greatest manifest, so it sees all tables of a commit or none; what fails
before the manifest leaves the old state as it was. The manifest is renamed into place and never overwritten: of two
commits on one version the second raises. Nothing is ever moved or deleted but by ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from weft.sources.tables import _fs


class Conflict(ValueError):
    """Another commit was first."""


def versions(spark: SparkSession, root: str) -> list[int]:
    """All versions, the first one being 1."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/_manifests")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, dict[str, str]]:
    """A version, the last one by default, and where its tables lie; version 0 has none."""
    known = versions(spark, root)
    if version is None:
        version = known[-1] if known else 0
    if not version:
        return 0, {}
    if version not in known:
        raise ValueError(f"no version {version}")
    fs, p = _fs(spark, f"{root.rstrip('/')}/_manifests/{version:010}.json")
    with_ = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(with_, "UTF-8")
    finally:
        with_.close()
    return version, json.loads(text)


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table as of a version."""
    number, tables = manifest(spark, root, version)
    if name not in tables:
        raise ValueError(f"version {number} has no table {name!r}")
    return spark.read.parquet(tables[name])


def commit(spark: SparkSession, root: str, tables: dict[str, DataFrame], dropped: Iterable[str] = (), base: int | None = None) -> int:
    """Writes ``tables`` as one new version on ``base`` (the last one by default) and gives its number; the other tables stay as they are.

    The rows may come from the tables themselves. Raises ``Conflict`` if there is a version after ``base``, now or when the manifest is put in place.
    """
    root = root.rstrip("/")
    number, held = manifest(spark, root)
    if base is not None and base != number:
        raise Conflict(f"the last version is {number}, not {base}")
    new = {k: v for k, v in held.items() if k not in set(dropped)}
    for name, df in tables.items():
        path = f"{root}/{name}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        new[name] = path
    put(spark, root, number + 1, new)
    return number + 1


def put(spark: SparkSession, root: str, version: int, tables: dict[str, str]) -> None:
    """Puts a manifest in place, unless there is one of that number: then it raises ``Conflict``."""
    fs, to = _fs(spark, f"{root}/_manifests/{version:010}.json")
    fs.mkdirs(to.getParent())
    if fs.exists(to):
        raise Conflict(f"version {version} is there")
    # created, not renamed, as a rename may overwrite: whoever creates the claim first has the number
    claim = _fs(spark, f"{root}/_manifests/{version:010}.claim")[1]
    try:
        fs.create(claim, False).close()
    except Exception as e:
        raise Conflict(f"version {version} is being put in place") from e
    tmp = _fs(spark, f"{root}/_manifests/.{uuid.uuid4().hex}")[1]
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
    out.close()
    if not fs.rename(tmp, to):
        fs.delete(claim, False)
        raise Conflict(f"version {version} cannot be put in place")


def apply(spark: SparkSession, root: str, change: Callable[[dict[str, DataFrame]], dict[str, DataFrame]], mode: str = "apply") -> dict[str, int]:
    """Runs a change of several tables in one of three modes, and gives how many rows of each differ.

    ``change`` takes the tables as they are and gives those that change. ``dry-run`` only counts, ``check`` raises if anything differs,
    ``apply`` commits them all as one version, on the version that was read; where nothing differs there is none.
    """
    if mode not in ("dry-run", "check", "apply"):
        raise ValueError(f"unknown mode {mode!r}")
    base, held = manifest(spark, root)
    now = {name: spark.read.parquet(path) for name, path in held.items()}
    new = change(now)
    counts = {}
    for name, df in new.items():
        old = now.get(name)
        counts[name] = df.count() if old is None else (df.exceptAll(old).count() + old.exceptAll(df).count() if sorted(df.columns) == sorted(old.columns) else df.count() + old.count())
    if mode == "check" and any(counts.values()):
        raise ValueError(f"not applied: {counts}")
    if mode == "apply" and any(counts.values()):
        commit(spark, root, {n: df for n, df in new.items() if counts[n] or n not in now}, base=base)
    return counts


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> list[int]:
    """Deletes the manifests of all but the last ``keep`` versions, and the tables that only these have; gives the versions left."""
    root = root.rstrip("/")
    known = versions(spark, root)
    left = known[-keep:] if keep else []
    used = {p for v in left for p in manifest(spark, root, v)[1].values()}
    gone = [(v, manifest(spark, root, v)[1]) for v in known if v not in left]
    for v, _ in gone:
        fs, p = _fs(spark, f"{root}/_manifests/{v:010}.json")
        fs.delete(p, False)
    for path in {p for _, tables in gone for p in tables.values()} - used:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
    return left
