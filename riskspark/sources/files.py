"""File scans and sinks (O-01..O-10).

Everything is a Spark reader/writer with an explicit schema; tolerant parsing is done
with PERMISSIVE mode plus ``try_cast`` so bad rows become NULLs (or are quarantined)
instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import coerce as C

# ---- schemas ---------------------------------------------------------------------------
TX_STRUCT = T.StructType([
    T.StructField("amount", T.DoubleType()), T.StructField("account_age_days", T.IntegerType()),
    T.StructField("country", T.StringType()), T.StructField("device_id", T.StringType()),
    T.StructField("hour_of_day", T.IntegerType())])

DECISION_LOG_SCHEMA = T.StructType([
    T.StructField("ts", T.StringType()), T.StructField("arm", T.StringType()),
    T.StructField("tx", TX_STRUCT), T.StructField("proba", T.DoubleType()),
    T.StructField("decision", T.StringType()), T.StructField("rules_hit", T.ArrayType(T.StringType())),
    T.StructField("latency_ms", T.IntegerType()), T.StructField("model_ts", T.StringType()),
    T.StructField("transaction_id", T.StringType()), T.StructField("label", T.IntegerType()),
    T.StructField("_corrupt_record", T.StringType())])

SHADOW_LOG_SCHEMA = T.StructType([
    T.StructField("ts", T.StringType()), T.StructField("payload", TX_STRUCT),
    T.StructField("prod", T.StructType([T.StructField("proba", T.DoubleType()), T.StructField("decision", T.StringType()),
                                        T.StructField("rules_hit", T.ArrayType(T.StringType()))])),
    T.StructField("cand", T.StructType([T.StructField("proba", T.DoubleType()), T.StructField("decision", T.StringType())])),
    T.StructField("latency_ms", T.StructType([T.StructField("prod", T.DoubleType()), T.StructField("cand", T.DoubleType())])),
    T.StructField("model_ts", T.StructType([T.StructField("prod", T.StringType()), T.StructField("cand", T.StringType())]))])
# ----------------------------------------------------------------------------------------


def read_csv_tolerant(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                      types: dict[str, str] | None = None) -> DataFrame:
    """O-01: header CSV read as strings (no inference pass), then ``try_cast`` per the
    requested types, junk -> NULL."""
    df = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").csv(path)
    if columns:
        df = df.select(*[c for c in columns if c in df.columns])
    for c, t in (types or {}).items():
        if c in df.columns:
            df = df.withColumn(c, C.to_ts(c) if t == "timestamp" else F.trim(F.col(c)).try_cast(t))
    return df


def read_table_any(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """O-02: Parquet by default; CSV when the path or ``fmt`` says so."""
    fmt = fmt or ("csv" if path.lower().endswith(".csv") else "parquet")
    if fmt == "csv":
        return read_csv_tolerant(spark, path)
    return spark.read.parquet(path)


def read_decision_log(spark: SparkSession, path: str, quarantine: bool = False, latest: int | None = None) -> DataFrame:
    """O-03 / D12: JSON-lines decision log. Blank lines are skipped; lines that are not
    valid JSON are kept aside (``quarantine=True`` returns only those, as raw text); the
    nested ``tx`` record is flattened once; defaults: decision -> 'allow', rules_hit -> [].
    Partition columns of the layout (e.g. ``as_of_date=...``) are kept; ``latest`` reads the
    files of the latest so many dates only."""
    paths = latest_partitions(spark, path, latest) if latest else [path]
    if not paths:
        return read_decision_log(spark, path, quarantine).limit(0)
    raw = (spark.read.option("basePath", path) if latest else spark.read).text(paths)
    raw = raw.where(F.length(F.trim(F.col("value"))) > 0)
    ok = F.get_json_object(F.col("value"), "$").isNotNull()
    if quarantine:
        return raw.where(~ok).select(F.col("value").alias("raw_line"))
    extra = [c for c in raw.columns if c != "value"]  # partition columns
    schema = T.StructType([f for f in DECISION_LOG_SCHEMA.fields if f.name != "_corrupt_record"])
    rec = raw.where(ok).select(*extra, F.from_json(F.col("value"), schema).alias("r")).select(*extra, "r.*")
    hits = F.coalesce(F.col("rules_hit"), F.array().cast("array<string>"))
    return rec.select(
        *extra, C.to_ts("ts").alias("ts"), "arm", "tx.amount", "tx.account_age_days",
        F.upper(F.col("tx.country")).alias("country"), "tx.device_id", "tx.hour_of_day",
        "proba", F.coalesce(F.col("decision"), F.lit("allow")).alias("decision"),
        hits.alias("rules_hit"), F.size(hits).alias("rules_count"),
        "latency_ms", "model_ts", "transaction_id", "label")


def read_json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """O-04: JSON KPI files over a partition glob; absent files -> empty frame."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except Exception as e:  # noqa: BLE001 - a missing glob is an empty input
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def with_file_date(df: DataFrame, out: str = "as_of_date") -> DataFrame:
    """O-05: YYYYMMDD parsed from the source path (``..._20251001.csv`` or a
    ``..._20251001.parquet/`` directory), read from the file metadata column."""
    d = F.regexp_extract(F.col("_metadata.file_path"), r"(?:^|[_/-])(\d{8})(?=[._/]|$)", 1)
    return df.withColumn(out, F.try_to_date(F.nullif(d, F.lit("")), "yyyyMMdd"))


def latest_n_dates(df: DataFrame, n: int = 2, date_col: str = "as_of_date") -> DataFrame:
    """O-05: rows of the latest n distinct dates. Only the date column is read to find them
    (of partitioned files just the partition values), and the n dates become a filter, so
    other partitions are not scanned."""
    dates = [r[0] for r in df.select(date_col).where(F.col(date_col).isNotNull()).distinct().orderBy(F.col(date_col).desc()).limit(n).collect()]
    return df.where(F.col(date_col).isin(dates) if dates else F.lit(False))


def latest_partitions(spark: SparkSession, path: str, n: int = 2, date_col: str = "as_of_date") -> list[str]:
    """O-05: paths of the latest n ``date_col=`` folders below ``path``, from the listing alone."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = sorted((f.getPath().getName() for f in fs.listStatus(p) if f.getPath().getName().startswith(f"{date_col}=")), reverse=True)
    return [f"{path.rstrip('/')}/{x}" for x in names if not x.endswith("__HIVE_DEFAULT_PARTITION__")][:n]


def union_evolving(frames: Sequence[DataFrame]) -> DataFrame:
    """O-06 / O-78: union by name with columns missing on some sides filled with NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def file_time(df: DataFrame) -> DataFrame:
    """O-87: one row with the newest modification time of the files that a frame reads (NULL without files).

    Only the file's metadata is asked for, so no column is read."""
    return df.select(F.col("_metadata.file_modification_time").alias("t")).agg(F.max("t").alias("modified"))


def stale_against(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """O-87: whether outputs are older than the inputs they were made from: ``stale`` (true where there are no outputs)."""
    o, i = file_time(outputs), file_time(inputs)
    j = o.select(F.col("modified").alias("outputs_at")).crossJoin(i.select(F.col("modified").alias("inputs_at")))  # one row each
    return j.withColumn("stale", F.coalesce(F.col("inputs_at") > F.col("outputs_at"), F.col("inputs_at").isNotNull()))


# ---- files whose columns and types change ------------------------------------------------

#: Types that widen into the next one; any other pair of different types meets as text.
_WIDENING = (("boolean", "byte", "short", "integer", "long", "double"), ("float", "double"), ("date", "timestamp"), ("date", "timestamp_ntz"))


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both: along a widening chain, field by field of structs, element by element; else text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return wider_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, wider_type(a.valueType, b.valueType))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(min(whole + scale, 38), scale) if whole + scale <= 38 else T.DoubleType()
    x, y = a.typeName(), b.typeName()
    if {x, y} <= {"decimal", "byte", "short", "integer", "long", "float", "double"} and "decimal" in (x, y):
        return T.DoubleType()
    for chain in _WIDENING:
        if x in chain and y in chain:
            return a if chain.index(x) > chain.index(y) else b
    return T.StringType()


def wider_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """One schema for all: columns in order of first sight, names without regard to case, every field nullable."""
    found: dict[str, T.StructField] = {}
    for s in schemas:
        for f in s.fields:
            old = found.get(f.name.lower())
            found[f.name.lower()] = T.StructField(old.name if old else f.name, wider_type(old.dataType, f.dataType) if old else f.dataType)
    return T.StructType(list(found.values()))


def _as_type(c, have: T.DataType, want: T.DataType):
    """``c`` as the wider type; nested values meet text as JSON."""
    if have == want:
        return c
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        fields = [(_as_type(c[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own
                   else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields)).cast(want)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(c, lambda e: _as_type(e, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    if isinstance(have, T.BooleanType) and not isinstance(want, T.StringType):
        return c.cast("int").cast(want)
    return c.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the given (wider) schema; absent columns are NULL."""
    own = {f.name.lower(): f for f in df.schema.fields}
    return df.select(*[(_as_type(F.col(f"`{own[f.name.lower()].name}`"), own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that match, in order of their names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(f.getPath().toString() for f in found or [])


def read_evolving(spark: SparkSession, pattern: str, fmt: str = "parquet") -> DataFrame:
    """O-06: all files or dated folders that a glob matches, as one table whose columns and types hold every layout.

    Schemas come from the footers, one of each match; matches of one schema are one scan, cast once."""
    layouts: dict[str, tuple[T.StructType, list[str]]] = {}
    for path in glob_paths(spark, pattern):
        schema = spark.read.format(fmt).load(path).schema
        layouts.setdefault(schema.json(), (schema, []))[1].append(path)
    if not layouts:
        raise FileNotFoundError(f"nothing matches {pattern}")
    whole = wider_schema([s for s, _ in layouts.values()])
    frames = [conform(spark.read.format(fmt).schema(schema).load(paths), whole) for schema, paths in layouts.values()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_shadow_log(spark: SparkSession, path: str) -> DataFrame:
    """O-62: shadow log lines as nested prod / cand records with both latencies; blank and malformed lines are left out."""
    raw = spark.read.text(path).where(F.length(F.trim(F.col("value"))) > 0)
    r = raw.select(F.from_json("value", SHADOW_LOG_SCHEMA, {"mode": "PERMISSIVE"}).alias("r")).where("r.prod is not null and r.cand is not null")
    return r.select(C.to_ts("r.ts").alias("ts"), "r.payload", "r.prod", "r.cand", "r.latency_ms", "r.model_ts")


def write_dated_parquet(df: DataFrame, path: str, date_col: str = "as_of_date") -> None:
    """O-07: partitioned by date; re-running a day replaces only that day's partition."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(date_col).parquet(path))


def write_csv_export(df: DataFrame, path: str) -> None:
    """O-08: header CSV for BI tools (arrays/structs flattened first, O-10)."""
    C.flatten_struct(df).write.mode("overwrite").option("header", True).csv(path)
