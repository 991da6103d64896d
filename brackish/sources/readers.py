"""Readers of sequence, count and taxonomy files into the canonical long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lineage as L


def fasta(spark: SparkSession, path: str, *, strip_gaps: bool = False, to_dna: bool = False) -> DataFrame:
    """(seq_id, header, seq).  Records are split at ">", so large files are read in parts; the id is the header's first token."""
    rec = spark.read.option("lineSep", "\n>").text(path)
    raw = F.regexp_replace(F.col("value"), "^>", "")
    head = F.regexp_extract(raw, r"^([^\r\n]*)", 1)
    seq = F.upper(F.regexp_replace(F.expr("substring(value, instr(value, '\\n') + 1)"), r"\s", ""))
    if strip_gaps:
        seq = F.regexp_replace(seq, "[-.]", "")
    if to_dna:
        seq = F.translate(seq, "U", "T")
    has = F.instr("value", "\n") > 0
    return rec.where(F.length(F.trim(raw)) > 0).select(F.regexp_extract(head, r"^(\S+)", 1).alias("seq_id"), head.alias("header"), F.when(has, seq).otherwise("").alias("seq"))


def fastq(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """(path, read_id, seq, qual); four lines a record, gzip allowed.  A file is framed in one task, as its compression asks."""

    def run(frames):
        import gzip
        import io

        import pandas as pd

        for f in frames:
            for p, content in zip(f["path"], f["content"], strict=True):
                text = io.TextIOWrapper(gzip.open(io.BytesIO(content)) if p.endswith(".gz") else io.BytesIO(content), "ascii")
                rows = []
                while head := text.readline():
                    if not head.strip():
                        continue
                    seq, _, qual = text.readline().strip(), text.readline(), text.readline().strip()
                    if len(seq) != len(qual) or head[0] != "@":
                        raise ValueError(f"bad record {head.strip()!r} in {p}")
                    rows.append((p, head[1:].split()[0], seq.upper(), qual))
                    if len(rows) >= 50_000:
                        yield pd.DataFrame(rows, columns=["path", "read_id", "seq", "qual"])
                        rows = []
                yield pd.DataFrame(rows, columns=["path", "read_id", "seq", "qual"])

    out = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, read_id string, seq string, qual string")
    return out.withColumn("sample", F.lit(sample)) if sample else out


def manifest(files: DataFrame, require_mate: bool = True) -> DataFrame:
    """(path) -> (sample, r1, r2) from _R1_/_R2_ names; without require_mate a missing r2 is null."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    r1 = files.select(F.regexp_extract(name, r"^(.*)_R1_.*\.(?:fastq|fq)(?:\.gz)?$", 1).alias("sample"), F.col("path").alias("r1")).where("sample <> ''")
    r2 = files.where(name.rlike(r"_R2_.*\.(fastq|fq)(\.gz)?$")).select(F.substring_index(name, "_R2_", 1).alias("sample"), F.col("path").alias("r2"))
    return r1.join(r2, "sample", "inner" if require_mate else "left")


def count_table(spark: SparkSession, path: str, *, id_col: str | None = None, comments: bool = False) -> DataFrame:
    """Wide TSV -> (feature_id, sample, count); the first column names the feature; with `comments`, lines that begin with "# " are skipped."""
    if comments:
        lines = spark.read.text(path).where(~F.col("value").startswith("# ") & (F.col("value") != ""))
        header = lines.first()
        names = header["value"].split("\t") if header else [id_col or "feature_id"]
        cells = F.split("value", "\t", -1)
        df = lines.where(F.col("value") != F.lit(header["value"] if header else "")).select(*[F.get(cells, F.lit(i)).alias(c) for i, c in enumerate(names)])
    else:
        df = spark.read.csv(path, sep="\t", header=True)
    key = id_col or df.columns[0]
    names = [c for c in df.columns if c != key]
    wide = df.select(F.col(f"`{key}`").alias("feature_id"), *[F.expr(f"coalesce(try_cast(`{c}` as double), 0)").cast("long").alias(c) for c in names])
    return wide.unpivot(["feature_id"], [F.col(f"`{c}`") for c in names], "sample", "count").where("count > 0")


def shared(spark: SparkSession, path: str) -> DataFrame:
    """mothur .shared (label, Group, numOtus, OTUs) -> long counts."""
    df = spark.read.csv(path, sep="\t", header=True)
    names = df.columns[3:]
    wide = df.select(F.col("Group").alias("sample"), *[F.col(f"`{c}`").cast("long").alias(c) for c in names])
    return wide.unpivot(["sample"], [F.col(f"`{c}`") for c in names], "feature_id", "count").where("count > 0").select("feature_id", "sample", "count")


def taxonomy(spark: SparkSession, path: str, *, style: str = "plain") -> DataFrame:
    """(feature_id, lineage array).  plain: A;B;C; with spaces as _; rdp: without Root, # lines skipped; prefixed: k__A;p__B or d:A,p:B without prefixes and empty or unidentified names."""
    df = spark.read.csv(path, sep="\t", schema="feature_id string, t string", comment="#" if style == "rdp" else None)
    t = F.col("t")
    if style == "plain":
        lin = L.parts(F.replace(F.trim(t), F.lit(" "), F.lit("_")))
    elif style == "rdp":
        lin = L.parts(F.regexp_replace(t, "^Root;?", ""))
    else:
        lin = F.filter(L.sintax(t), lambda x: ~F.lower(x).isin("unidentified", "uncultured"))
    return df.select(F.trim("feature_id").alias("feature_id"), lin.alias("lineage"))


def taxonomy_confidence(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, sep="\t", schema="feature_id string, t string")
    return df.select("feature_id", L.with_confidence(F.col("t")).alias("lineage"))


def clusters(spark: SparkSession, path: str) -> DataFrame:
    """Cluster file's S and H records -> (member_id, centroid_id, rec_type)."""
    df = spark.read.csv(path, sep="\t").where(F.col("_c0").isin("S", "H"))
    clean = lambda c: F.substring_index(c, ";size=", 1)
    return df.select(clean("_c8").alias("member_id"), F.when(F.col("_c0") == "S", clean("_c8")).otherwise(clean("_c9")).alias("centroid_id"), F.col("_c0").alias("rec_type"))


def chimera_calls(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, sep="\t")
    return df.select(F.substring_index("_c1", ";size=", 1).alias("seq_id"), F.col(df.columns[-1]).alias("call"))


def hits(spark: SparkSession, path: str) -> DataFrame:
    """Search table, first hit of every query in file order within its file."""
    df = spark.read.csv(path, sep="\t", schema="query_id string, ref_id string, identity double, mismatches int, gaps int, length int, qcov double").withColumn("_o", F.monotonically_increasing_id())
    first = F.row_number().over(Window.partitionBy("query_id").orderBy("_o"))
    return df.withColumn("_r", first).where("_r = 1").select("query_id", "ref_id", (F.col("identity") / 100).alias("identity"), (F.col("mismatches") + F.col("gaps")).alias("edit_distance"))


def aligned_spans(spark: SparkSession, path: str) -> DataFrame:
    """Legacy alignment report -> (query_id, start, end): a query's lines belong to the last "Query" line above them in its file."""
    lines = spark.read.text(path).select("value", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("o"))
    q = F.nullif(F.regexp_extract("value", r"^\s*Query >?(\S+)", 1), F.lit(""))
    seen = lines.withColumn("query_id", F.last(q, True).over(Window.partitionBy("f").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)))
    spans = seen.where(F.col("value").rlike(r"^Qry\s")).select("query_id", F.regexp_extract("value", r"^Qry\s+(\d+)", 1).cast("int").alias("s"), F.regexp_extract("value", r"(\d+)\s*$", 1).cast("int").alias("e"))
    return spans.groupBy("query_id").agg(F.min("s").alias("start"), F.max("e").alias("end"))


def metadata(spark: SparkSession, path: str, samples: DataFrame) -> DataFrame:
    """Sample metadata for exactly these samples; a sample without a row is an error."""
    df = spark.read.csv(path, sep="," if path.endswith(".csv") else "\t", header=True)
    if "sample" not in df.columns:
        raise ValueError("metadata has no column 'sample'")
    missing = [r[0] for r in samples.select("sample").distinct().join(df, "sample", "left_anti").limit(5).collect()]
    if missing:
        raise ValueError(f"samples without metadata: {', '.join(missing)}")
    return df.join(samples.select("sample").distinct(), "sample", "left_semi")
