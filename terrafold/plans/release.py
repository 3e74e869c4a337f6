"""Publishing a release: swap into place, index, migrate, compare, verify, pack, and check before it goes."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.operators import compare as C
from terrafold.operators import metadata as M
from terrafold.operators import quality as Q
from terrafold.operators import search as X

# What a release holds, and the schema version of places with the area in the index.
REQUIRED = ("places", "townships", "roads")
PLACES_VERSION = M.SCHEMA_VERSIONS["places"]


def publish(df: DataFrame, target: str, partition_by: tuple[str, ...] = ()) -> None:
    """Writes beside the target, then swaps: no reader sees a part of a table. The old one stays as
    ``.bak`` until the next time. Between the two renames there is no target; if the second fails, or
    a run before was stopped there, the old one is put back. Works on any file system that
    Spark writes to."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    files = path(target).getFileSystem(conf)
    part, old = f"{target}.part", f"{target}.bak"
    if not files.exists(path(target)) and files.exists(path(old)):
        files.rename(path(old), path(target))
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(part)
    if files.exists(path(target)):
        files.delete(path(old), True)
        if not files.rename(path(target), path(old)):
            raise OSError(f"could not move {target} to {old}")
    if not files.rename(path(part), path(target)):
        if files.exists(path(old)):
            files.rename(path(old), path(target))
        raise OSError(f"could not move {part} to {target}")


def write_index(places: DataFrame, target: str, columns: tuple[str, ...] = X.INDEXED) -> None:
    """The postings, sorted by token within files, so that a search reads few row groups."""
    index = X.postings(places, columns=columns)
    publish(index.repartitionByRange("token", "id").sortWithinPartitions("token", "id"), target)


def migrate_index(places: DataFrame, index: DataFrame, meta: DataFrame, target: str, artifact: str = "places") -> tuple[bool, DataFrame]:
    """(whether there was anything to do, metadata): an index without the area column is rebuilt, and
    the schema version set. Then rows that have an area only must be found by it."""
    if index.where("col = 'area'").limit(1).count() and M.value_of(meta.where(F.col("artifact") == artifact), "schema_version") == PLACES_VERSION:
        return False, meta
    write_index(places, target)
    sample = places.where("coalesce(street, '') = '' and coalesce(area, '') <> ''").orderBy("id").first()
    rebuilt = places.sparkSession.read.parquet(target)
    if sample is not None and not X.phrase_ids(rebuilt, sample["area"]).where(F.col("id") == sample["id"]).count():
        raise RuntimeError(f"row {sample['id']} isn't found by its area")
    return True, M.upsert(meta, M.as_frame(places.sparkSession, {"schema_version": PLACES_VERSION}, artifact))


def compare(old: DataFrame, new: DataFrame, index: DataFrame | None = None) -> tuple[DataFrame, str]:
    """(figures with whether it is accepted, the same as Markdown): both sides' rows and names, what
    moved, and the gate on the new side."""
    rows = C.overlap_counts(old, new)
    names = C.overlap_counts(old, new, ("display_name",)).toDF("names_removed", "names_added", "names_common")
    figures = C.accepted(C.inspect(new, index)).crossJoin(rows).crossJoin(names).crossJoin(C.moved(old, new))
    return figures, C.markdown(figures.first().asDict(), "Release comparison")


def verify(source: DataFrame, places: DataFrame, codes: DataFrame, n: int = 50, areas: DataFrame | None = None, area_edges: DataFrame | None = None, rules: list[dict] | None = None, index: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(matrix, failures) of the checks on the ``n`` outermost rows in each direction."""
    results = Q.checks(Q.extreme_samples(source, n), places, codes, areas, area_edges, rules, index)
    return Q.matrix(results), Q.failures(results)


def pack(tables: list[Path], target: Path, data_version: str, policy_version: str) -> Path:
    """A kit of the Parquet files of tables (or of single files), its version in a sidecar, and its
    manifest beside it."""
    M.check_version(data_version, policy_version)
    files = [f for t in tables for f in (sorted(t.rglob("*.parquet")) if t.is_dir() else [t])]
    kit = M.write_kit(files, {"VERSION": data_version}, target)
    header = {"data_version": data_version, "address_policy_version": policy_version, "built": M.now_utc()}
    out = target.with_name(f"{target.name}.manifest")
    out.write_text(M.manifest(kit, files, {}, header), encoding="utf-8")
    return out


def stale_anchors(spark: SparkSession, path: str, pattern: str, wanted: str) -> list[str]:
    """The static half of the schema gate: what text files say, by a pattern's group, that isn't
    ``wanted``; a file without a match is wrong too."""
    found = M.text_anchors(spark, path, pattern).collect()
    wrong = [f"{r['name']}: {r['found']}, not {wanted}" for r in found if r["found"] != wanted]
    return wrong if found else [f"{path}: nothing matches {pattern}"]


def preflight(spark: SparkSession, meta: DataFrame, present: list[str], data_version: str, policy_version: str, kits: dict[Path, str] | None = None) -> list[str]:
    """All that keeps a release from going out: bad versions, missing artifacts, other versions in
    metadata, and kits that their manifests don't describe."""
    wrong = []
    try:
        M.check_version(data_version, policy_version)
    except ValueError as e:
        wrong.append(str(e))
    there = spark.createDataFrame([(p,) for p in present], "name string")
    needed = spark.createDataFrame([(p,) for p in REQUIRED], "name string")
    wrong += [f"missing: {r['name']}" for r in M.missing(there, needed).orderBy("name").collect()]
    wanted = None
    for name in present:
        source = M.value_of(meta.where(F.col("artifact") == name), "source")
        own = M.as_frame(spark, M.expected(data_version, policy_version, source), name)
        wanted = own if wanted is None else wanted.unionByName(own)
        found = M.value_of(meta.where(F.col("artifact") == name), "schema_version")
        if not M.schema_version_ok(name, found):
            wrong.append(f"{name}: schema_version {found}")
    if wanted is not None:
        wrong += [f"{r['artifact']}: {r['key']} is {r['actual']}, not {r['expected']}" for r in M.mismatches(meta, wanted).orderBy("artifact", "key").collect()]
    for kit, text in (kits or {}).items():
        wrong += [f"{kit.name}: {x}" for x in M.check_manifest(text, kit, data_version)]
    return wrong
