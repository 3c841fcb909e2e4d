"""Writers: layered tables, sorted text, manifests."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import contract


def described(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """``df`` with a comment on each named column, kept in the files written."""
    return df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c) for c in df.columns])


def write_table(
    df: DataFrame, root: str, layer: str, name: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (), schema: T.StructType | None = None
) -> str:
    """Replace ``root/layer/name``; returns its path.

    Partitions are directories; within files rows are sorted by ``cluster_by`` so
    that row-group statistics skip. With a schema the names and types are checked
    first and nothing is written if they differ.
    """
    if schema is not None and (wrong := contract(df, schema)):
        raise ValueError(f"{layer}.{name}: " + "; ".join(wrong))
    out = df
    if cluster_by:
        # by range, so that each file has a narrow span of the cluster columns
        out = out.repartitionByRange(*partition_by, *cluster_by)
    elif partition_by:
        out = out.repartition(*partition_by)
    if cluster_by:
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    path = f"{root}/{layer}/{name}"
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, fields: Sequence[str], sort: Sequence[str]) -> int:
    """Named columns as text sorted by ``sort`` (null as empty); other columns are left out. Returns the rows."""
    seen = Observation()
    text = df.select(*[F.col(c).cast("string").alias(c) for c in fields])
    ordered = text.orderBy(*[F.coalesce(c, F.lit("")) for c in sort])
    # counted as it is written; the sort may sample its input, so the count stands above it
    ordered.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
    return seen.get["n"]


def manifest(spark: SparkSession, rows: Sequence[Mapping]) -> DataFrame:
    """One row per loaded table: where it came from, its digest and size, and when it was loaded."""
    schema = "table string, source_url string, as_of_date string, uri string, sha256 string, row_count long"
    return spark.createDataFrame([tuple(r.get(k) for k in ("table", "source_url", "as_of_date", "uri", "sha256", "row_count")) for r in rows], schema).withColumn("loaded_at", F.current_timestamp())


def manifest_of_layer(spark: SparkSession, root: str, layer: str, known: Mapping[str, Mapping] | None = None) -> DataFrame:
    """The manifest rebuilt from the tables that stand in ``root/layer``, without loading anything again.

    Rows are counted from the files; ``known`` gives source_url, as_of_date and sha256 per table where they are known.
    """
    rows = []
    for folder in sorted(p for p in (Path(root) / layer).iterdir() if p.is_dir()):
        uri = str(folder)
        rows.append({"table": folder.name, **(known or {}).get(folder.name, {}), "uri": uri, "row_count": spark.read.parquet(uri).count()})
    return manifest(spark, rows)


def write_json_manifest(path: str, entries: Mapping) -> None:
    Path(path).write_text(json.dumps(entries, ensure_ascii=False, indent=2, sort_keys=True) + "\n", encoding="utf-8")


def layer_name(custom: str | None, default: str) -> str:
    """The layer as it is named, without a prefix for the target."""
    return custom.strip() if custom else default


def merged_nodes(nodes: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key; of each column the last value that is not null by ``order``."""
    others = [c for c in nodes.columns if c not in (key, order)]
    return nodes.groupBy(key).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in others])


def matched_edges(edges: DataFrame, nodes: DataFrame, here: str, there: str, node: str) -> DataFrame:
    """Edges of which both ends are nodes; the others are dropped."""
    ids = nodes.select(node).distinct()
    return edges.join(ids.withColumnRenamed(node, here), here, "left_semi").join(ids.withColumnRenamed(node, there), there, "left_semi")


def last_edges(edges: DataFrame, here: str, there: str, order: str) -> DataFrame:
    """One edge per pair of ends, the last by ``order``."""
    return edges.groupBy(here, there).agg(F.max_by(F.struct(*[c for c in edges.columns if c not in (here, there)]), F.col(order)).alias("_e")).select(here, there, "_e.*")
