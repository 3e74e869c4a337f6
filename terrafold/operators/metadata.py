"""Key-value metadata of artifacts: versions, stamps, hashes, manifests and kits."""

from __future__ import annotations

import hashlib
import re
import zipfile
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Forms of versions, and what each artifact carries.
DATA_VERSION = r"^\d{4}\.\d{2}\.\d{2}\.[1-9]\d*$"
POLICY_VERSION = r"^[1-9]\d*$"
ADDRESS_SOURCE = "tgos"
SCHEMA_VERSIONS = {"places": "3", "townships": "1", "roads": "1"}


def check_version(data_version: str, policy_version: str) -> None:
    """Raises for a version that isn't a calendar version, or a policy that isn't a positive number."""
    if not re.match(DATA_VERSION, data_version):
        raise ValueError(f"bad data_version: {data_version}")
    if not re.match(POLICY_VERSION, policy_version):
        raise ValueError(f"bad address_policy_version: {policy_version}")


def valid_version(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).rlike(DATA_VERSION)


def expected(data_version: str, policy_version: str, source: str | None) -> dict[str, str]:
    """The keys that an artifact of a source must carry; the policy only binds address sources."""
    out = {"data_version": data_version}
    if source == ADDRESS_SOURCE:
        out["address_policy_version"] = policy_version
    return out


def as_frame(spark: SparkSession, values: dict[str, str], artifact: str = "") -> DataFrame:
    return spark.createDataFrame([(artifact, k, v) for k, v in values.items()], "artifact string, key string, value string")


def value_of(meta: DataFrame, key: str, default: str | None = None) -> str | None:
    """One value, or the default where the key is missing or null."""
    row = meta.where(F.col("key") == key).select("value").first()
    return default if row is None or row[0] is None else row[0]


def as_map(meta: DataFrame) -> DataFrame:
    """(artifact, entries): a map of each artifact's keys."""
    return meta.groupBy("artifact").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("entries"))


def upsert(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("artifact", "key")) -> DataFrame:
    """The old entries with the new ones put in or in their place (also where the new value is null)."""
    o = old.select(*keys, F.col("value").alias("old_value"))
    n = new.select(*keys, F.col("value").alias("new_value"), F.lit(True).alias("is_new"))
    return o.join(n, list(keys), "full_outer").select(*keys, F.when(F.col("is_new"), F.col("new_value")).otherwise(F.col("old_value")).alias("value"))


def mismatches(current: DataFrame, wanted: DataFrame, keys: tuple[str, ...] = ("artifact", "key")) -> DataFrame:
    """(keys, expected, actual): entries that are missing or differ."""
    c = current.select(*keys, F.col("value").alias("actual"))
    w = wanted.select(*keys, F.col("value").alias("expected"))
    return w.join(c, list(keys), "left").where(~F.col("actual").eqNullSafe(F.col("expected"))).select(*keys, "expected", "actual")


def stamp(current: DataFrame, wanted: DataFrame, apply: bool = False) -> tuple[DataFrame, DataFrame]:
    """(entries, what differs): entries only change if ``apply`` is set."""
    differ = mismatches(current, wanted)
    return (upsert(current, wanted) if apply else current), differ


def require_current(current: DataFrame, wanted: DataFrame) -> None:
    """Raises if an artifact isn't of the expected version."""
    bad = mismatches(current, wanted).limit(20).collect()
    if bad:
        raise ValueError("artifacts of another version: " + "; ".join(f"{r['artifact']} {r['key']}: {r['actual']} for {r['expected']}" for r in bad))


def missing(present: DataFrame, required: DataFrame, name: str = "name") -> DataFrame:
    return required.select(name).subtract(present.select(name))


def file_hashes(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """(name, bytes, sha256) of the files below a path."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def text_anchors(spark: SparkSession, path: str, pattern: str, group: int = 1) -> DataFrame:
    """(name, found): every match of a pattern in whole text files."""
    files = spark.read.option("wholetext", True).text(path).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("name"), "value")
    return files.select("name", F.explode(F.regexp_extract_all("value", F.lit(pattern), F.lit(group))).alias("found"))


def now_utc(compact: bool = False) -> str:
    return datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ" if compact else "%Y-%m-%dT%H:%M:%SZ")


def sha256_file(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def write_kit(files: list[Path], sidecars: dict[str, str], target: Path) -> Path:
    """A flat ZIP of files, sorted by name, with text sidecars."""
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED, compresslevel=6) as out:
        for file in sorted(files, key=lambda p: p.name):
            out.write(file, file.name)
        for name in sorted(sidecars):
            out.writestr(name, sidecars[name])
    return target


def check_kit(path: Path, sidecars: dict[str, str]) -> list[str]:
    """What is wrong with a kit's sidecars; line ends don't matter."""
    wrong = []
    with zipfile.ZipFile(path) as kit:
        names = set(kit.namelist())
        for name, want in sidecars.items():
            if name not in names:
                wrong.append(f"{path.name}: {name} is missing")
            elif (got := kit.read(name).decode().replace("\r\n", "\n").strip()) != want.strip():
                wrong.append(f"{path.name}: {name} is {got!r}, not {want.strip()!r}")
    return wrong


def manifest(kit: Path, contents: list[Path], meta: dict[str, dict[str, str]], header: dict[str, str], shown: tuple[str, ...] = ("schema_version", "data_version", "address_policy_version", "data_date")) -> str:
    """The manifest of a kit: header, size and hash of each file, and its listed metadata."""
    lines = [f"kit: {kit.name}", f"bytes: {kit.stat().st_size}", f"sha256: {sha256_file(kit)}", *[f"{k}: {v}" for k, v in header.items()], ""]
    for file in sorted(contents, key=lambda p: p.name):
        lines += [file.name, f"  bytes: {file.stat().st_size}", f"  sha256: {sha256_file(file)}"]
        lines += [f"  {k}: {meta[file.name][k]}" for k in shown if k in meta.get(file.name, {})]
    return "\n".join(lines) + "\n"


def check_manifest(text: str, kit: Path, data_version: str) -> list[str]:
    wrong = []
    if f"sha256: {sha256_file(kit)}" not in text:
        wrong.append("the kit's hash isn't in the manifest")
    if f"data_version: {data_version}" not in text:
        wrong.append("the manifest is of another version")
    return wrong


def schema_version_ok(artifact: str, found: str | None) -> bool:
    """Whether an artifact has its kind's schema version (a missing one counts as 1)."""
    kind = artifact.split("-")[0].split(".")[0]
    return (found or "1") == SCHEMA_VERSIONS.get(kind, SCHEMA_VERSIONS["places"])
