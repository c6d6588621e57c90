"""Collections: named Parquet tables of points ``(id, embedding, payload)`` with settings.

Points lie in buckets of their ids, and below them in the values of payload keys that
searches filter by. A write is a new version that holds whole buckets, and counts once its
settings are written; a bucket is read from its latest version. So an upsert reads and
writes only the buckets of its ids, what was opened before stays as it was, and a job that
dies half way leaves no trace.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passages.operators.coded import code_points
from passages.operators.points import upsert_points
from passages.session import folder_names, scratch_path

BUCKETS = 64
CODE_COLUMNS = ("code", "error")


def _versions(spark: SparkSession, path: str) -> dict[int, dict]:
    """The settings of every version that was written to its end."""
    if not folder_names(spark, f"{path}/settings"):
        return {}
    rows = spark.read.schema("value string, version int").text(f"{path}/settings").collect()
    return {r.version: json.loads(r.value) for r in rows}


def _held(spark: SparkSession, path: str, versions: dict[int, dict]) -> dict[int, int]:
    """The version that holds each bucket: the latest since the collection was made anew."""
    latest = max(versions)
    held: dict[int, int] = {}
    for version in range(versions[latest]["base"], latest + 1):
        if version in versions:
            for name in folder_names(spark, f"{path}/points/version={version}"):
                held[int(name.removeprefix("bucket="))] = version
    return held


def _opened(spark: SparkSession, path: str, settings: dict, held: dict[int, int]) -> DataFrame:
    schema = T.StructType.fromJson(settings["schema"])
    if not held:
        return spark.createDataFrame([], schema)
    places = T.StructType(schema.fields + [
        T.StructField("version", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
    folders = [f"{path}/points/version={v}/bucket={b}" for b, v in sorted(held.items())]
    points = spark.read.schema(places).option("basePath", f"{path}/points").parquet(*folders)
    return points.select(*schema.names)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def check_points(points: DataFrame, dim: int) -> DataFrame:
    """Fail on a point without id or with a vector of another length."""
    fits = F.col("id").isNotNull() & (F.size("embedding") == dim)
    vector = F.when(fits, F.col("embedding")).otherwise(
        F.raise_error(F.lit(f"a point needs an id and {dim} vector entries")).cast("array<float>")
    )
    return points.withColumn("embedding", vector)


def _write(spark: SparkSession, path: str, points: DataFrame, settings: dict, base: int | None) -> None:
    """Write ``points`` as a new version; ``base`` is the first one that still counts."""
    version = max(_versions(spark, path), default=0) + 1
    checked = check_points(points, settings["dim"])
    if settings["coded"]:
        checked = code_points(checked.drop(*CODE_COLUMNS), dim=settings["dim"])
    # One file for each bucket and value of the payload keys. Two writers of one version clash.
    folders = ["bucket", *settings["partition_by"]]
    buckets = checked.withColumn("bucket", _bucket(settings["buckets"]))
    buckets.repartition(settings["buckets"], "bucket").write.partitionBy(*folders).mode(
        "errorifexists").parquet(f"{path}/points/version={version}")
    settings = settings | {"schema": checked.schema.jsonValue(), "base": base or version}
    spark.createDataFrame([(json.dumps(settings),)], "value string").coalesce(1).write.mode(
        "errorifexists").text(f"{path}/settings/version={version}")


def recreate_collection(
    spark: SparkSession, root: str, name: str, points: DataFrame, dim: int, distance: str = "cosine",
    buckets: int = BUCKETS, partition_by: tuple[str, ...] = (), coded: bool = False,
) -> DataFrame:
    """Replace the collection, whether or not it exists, by ``points``.

    ``dim`` and ``distance`` belong to the collection from then on. ``partition_by`` names
    columns with few values, by which searches filter; ``coded`` adds what ``topk_coded``
    needs. Ids are not compared: points should not repeat them.
    """
    if distance != "cosine":
        raise ValueError(f"distance {distance} is not supported")
    settings = {"dim": dim, "distance": distance, "buckets": buckets,
                "partition_by": list(partition_by), "coded": coded}
    _write(spark, f"{root}/{name}", points, settings, None)
    return read_collection(spark, root, name)


def _open(spark: SparkSession, root: str, name: str) -> tuple[dict, dict[int, int]]:
    versions = _versions(spark, f"{root}/{name}")
    if not versions:
        raise ValueError(f"no collection named {name}")
    return versions[max(versions)], _held(spark, f"{root}/{name}", versions)


def collection_settings(spark: SparkSession, root: str, name: str) -> dict:
    """``dim``, ``distance``, ``buckets``, ``partition_by`` and ``coded`` of a collection."""
    settings, _ = _open(spark, root, name)
    return {k: settings[k] for k in ("dim", "distance", "buckets", "partition_by", "coded")}


def read_collection(spark: SparkSession, root: str, name: str) -> DataFrame:
    settings, held = _open(spark, root, name)
    return _opened(spark, f"{root}/{name}", settings, held)


def list_collections(spark: SparkSession, root: str) -> DataFrame:
    """``(name)``: the stored collections. No point is read."""
    names = [n for n in sorted(folder_names(spark, root)) if _versions(spark, f"{root}/{n}")]
    return spark.createDataFrame([(n,) for n in names], "name string")


def upsert_collection(
    spark: SparkSession, root: str, name: str, new: DataFrame, dim: int | None = None
) -> DataFrame:
    """Insert or replace points by id and wait until they are stored.

    Only the buckets of the new ids are read and written. A ``dim`` other than the
    collection's is refused, as are points of another length.
    """
    path = f"{root}/{name}"
    settings, held = _open(spark, root, name)
    if dim is not None and dim != settings["dim"]:
        raise ValueError(f"{name} holds vectors of {settings['dim']} entries, not {dim}")
    arrived = scratch_path(spark, "arrived")
    check_points(new, settings["dim"]).write.parquet(arrived)
    new = spark.read.schema(new.schema).parquet(arrived)
    touched = {r[0] for r in new.select(_bucket(settings["buckets"])).distinct().collect()}
    old = _opened(spark, path, settings, {b: v for b, v in held.items() if b in touched})
    if settings["coded"]:
        old, new = old.drop(*CODE_COLUMNS), new.drop(*CODE_COLUMNS)
    if touched:
        _write(spark, path, upsert_points(old, new.select(old.columns)), settings, settings["base"])
    return read_collection(spark, root, name)


def compact_collection(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Write all buckets as one version again, with the same settings."""
    settings, held = _open(spark, root, name)
    _write(spark, f"{root}/{name}", _opened(spark, f"{root}/{name}", settings, held), settings, None)
    return read_collection(spark, root, name)
