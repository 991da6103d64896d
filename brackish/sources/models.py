"""Trained models as folders of Parquet tables, a registry of them, run profiles and small side tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def save(model: dict[str, DataFrame], path: str, kind: str, key: str | None = None, **settings) -> None:
    """One Parquet table a part, sorted by `key` inside files where a part has it, and a line of JSON with the kind, parts and settings.  The line comes
    last: a folder without it is an unfinished model."""
    for name, table in model.items():
        (table.sortWithinPartitions(key) if key and key in table.columns else table).write.mode("overwrite").parquet(f"{path}/{name}")
    spark = next(iter(model.values())).sparkSession
    about = json.dumps({"kind": kind, "parts": sorted(model), "settings": settings}, sort_keys=True)
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load(spark: SparkSession, path: str, kind: str | None = None) -> tuple[dict[str, DataFrame], dict]:
    """The tables and settings of a model; an error if there is none, or one of another kind."""
    try:
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    except Exception as e:
        raise FileNotFoundError(f"no finished model in {path}") from e
    if kind and about["kind"] != kind:
        raise ValueError(f"{path} holds a {about['kind']} model, not {kind}")
    return {p: spark.read.parquet(f"{path}/{p}") for p in about["parts"]}, about["settings"]


def model_path(registry: dict[str, dict[str, str]], marker: str = "16S", kind: str = "general") -> str:
    """registry: marker -> kind -> folder.  Case does not matter; errors name what there is."""
    markers = {k.upper(): {n.lower(): p for n, p in v.items()} for k, v in registry.items()}
    if marker.upper() not in markers:
        raise ValueError(f"no models for marker {marker!r}; there are {', '.join(registry)}")
    kinds = markers[marker.upper()]
    if kind.lower() not in kinds:
        raise ValueError(f"no {kind!r} model for {marker}; there are {', '.join(kinds)}")
    return kinds[kind.lower()]


def profile(path: str) -> dict:
    """A run profile: "name: value" lines (numbers, true/false and null as such), # comments; JSON where it begins with a brace."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if text.lstrip().startswith("{"):
        return json.loads(text)
    out = {}
    for line in text.splitlines():
        name, colon, value = line.split(" #")[0].partition(":")
        if colon and not line.lstrip().startswith("#"):
            value = value.strip()
            try:
                out[name.strip()] = json.loads(value) if value else None
            except ValueError:
                out[name.strip()] = value.strip("'")
    return out


def pairs(spark: SparkSession, path: str) -> DataFrame:
    """(name, value): the first two fields of a TSV without a header; empty lines, # lines and lines of one field go.  The last line of a name counts."""
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id()).withColumn("v", F.trim("value"))
    rows = lines.where((F.col("v") != "") & ~F.col("v").startswith("#")).withColumn("f", F.split("v", "\t")).where(F.size("f") >= 2)
    return rows.groupBy(F.col("f")[0].alias("name")).agg(F.max_by(F.col("f")[1], "at").alias("value"))


def fasta_ids(seqs: DataFrame) -> DataFrame:
    return seqs.select("seq_id")


def as_json(table: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One text {"columns": [...], "rows": [[...], ...]} of a small result table, all values as texts, in the order of `order` (all columns without it)."""
    names = table.columns
    cells: list[Column] = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names]
    key = F.struct(*[F.col(f"`{c}`") for c in (order or names)])
    rows = table.agg(F.sort_array(F.collect_list(F.struct(key.alias("k"), F.array(*cells).alias("r")))).alias("all"))
    return rows.select(F.to_json(F.struct(F.array(*[F.lit(c) for c in names]).alias("columns"), F.transform("all", lambda x: x["r"]).alias("rows"))).alias("json"))


def two_sections(text: str, mark: str = "##BETADISPER") -> dict:
    """A TSV of two sections -> {"permanova": {columns, rows}, "betadisper": {columns, rows}}; a missing one is empty."""
    parts = [*text.split(mark, 1), ""][:2]

    def section(t: str) -> dict:
        lines = [line.split("\t") for line in t.strip().splitlines()]
        return {"columns": lines[0] if lines else [], "rows": lines[1:]}

    return {"permanova": section(parts[0]), "betadisper": section(parts[1])}
