"""File readers and structure-flattening sources (blueprint 2.1)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pansift.operators.columns import normalize_columns

# file extension -> built-in Spark data source (spreadsheet and R binary files
# are not readable here; convert them to CSV / Parquet first)
FORMATS = {"csv": "csv", "tsv": "csv", "json": "json", "jsonl": "json", "parquet": "parquet",
           "pq": "parquet", "orc": "orc"}


def load_table(spark: SparkSession, path: str, fmt: str | None = None, schema=None, **options) -> DataFrame | None:
    """Pick the reader by (lower-cased) extension; unknown extension -> None."""
    if fmt is None:
        ext = path.rstrip("/").rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
        fmt = FORMATS.get(ext)
        if fmt is None:
            return None
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("sep", "\t" if path.lower().endswith(".tsv") else ",")
    if schema is not None:
        r = r.schema(schema)
    elif fmt == "csv":
        r = r.option("inferSchema", True)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(path)
    return normalize_columns(df) if fmt in ("csv", "json") else df


def read_csv(spark: SparkSession, path: str, schema=None, infer: bool = True) -> DataFrame:
    """CSV with a header row; names lower-cased and stripped.  Give an
    explicit schema in production (inference costs a pass over the data)."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", infer)
    return normalize_columns(r.csv(path))


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested struct columns -> ``parent<sep>child`` columns (recursively)."""
    while any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
        cols = []
        for f in df.schema.fields:
            if isinstance(f.dataType, T.StructType):
                cols += [F.col(f"`{f.name}`.`{g.name}`").alias(f"{f.name}{sep}{g.name}") for g in f.dataType.fields]
            else:
                cols.append(F.col(f"`{f.name}`"))
        df = df.select(*cols)
    return df


def read_json_records(spark: SparkSession, path: str, multiline: bool = True, schema=None, **options) -> DataFrame:
    """JSON records (an array document with ``multiline``, else JSON lines);
    nested objects are flattened, names normalised."""
    r = spark.read.option("multiLine", multiline)
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    return normalize_columns(flatten_structs(r.json(path)))


def read_json_columnar(df: DataFrame, struct_col: str, rename: Mapping[str, str] | None = None,
                       keep: Sequence[str] = ()) -> DataFrame:
    """A struct of equal-length arrays -> one row per position; ``keep``
    columns (latitude, timezone, ...) are repeated on every row.  Arrays of
    unequal length pad with NULL (``arrays_zip``)."""
    st = df.schema[struct_col].dataType
    names = [f.name for f in st.fields if isinstance(f.dataType, T.ArrayType)]
    zipped = F.arrays_zip(*[F.col(f"`{struct_col}`.`{n}`").alias(n) for n in names])
    out = df.select(*keep, F.inline_outer(zipped))
    rename = rename or {}
    return out.select(*keep, *[F.col(n).alias(rename.get(n, n)) for n in names])


def read_json_matrix(df: DataFrame, json_col: str, header: Sequence[str] | None = None,
                     keep: Sequence[str] = ()) -> DataFrame:
    """JSON array of arrays whose first row is the header -> a table of text
    columns.  Every document's rows are matched by its own header, whatever
    its order; a name that a document lacks is NULL there.  Without
    ``header`` the columns are the names of all documents (names only reach
    the driver), in the order of their first places."""
    parsed = df.select(*keep, F.from_json(F.col(json_col), "array<array<string>>").alias("_m")).where(F.size("_m") > 0)
    parsed = parsed.withColumn("_h", F.transform(F.get("_m", 0), lambda h: F.lower(F.trim(h))))
    if header is None:
        places = parsed.select(F.posexplode("_h").alias("_place", "_name")).groupBy("_name").agg(F.min("_place").alias("_place"))
        header = [r["_name"] for r in places.orderBy("_place", "_name").collect()]
    names = [h.strip().lower() for h in header]
    rows = parsed.select(*keep, "_h", F.posexplode("_m").alias("_pos", "_row")).where(F.col("_pos") > 0)
    return rows.select(*keep, *[F.get("_row", F.array_position("_h", h) - 1).alias(h) for h in names])


def ingest_pages(spark: SparkSession, path: str, columns: Sequence[str], ts_col: str,
                 start: str, end: str, limit: int | None = None, fmt: str = "parquet",
                 order: bool = True) -> DataFrame:
    """Landed result pages: project the requested columns, keep the
    half-open window [start, end + 1 day), order by time ascending (ties by
    the projected columns, so a cap cuts deterministically) and cap at
    ``limit`` rows.  Projection and window reach the scan as pruning and
    pushed filters."""
    df = spark.read.format(fmt).load(path)
    cols = [c for c in columns if c in df.columns]
    d_end = (dt.date.fromisoformat(end) + dt.timedelta(days=1)).isoformat()
    out = df.select(*cols).where((F.col(ts_col) >= F.lit(start).cast("timestamp")) &
                                 (F.col(ts_col) < F.lit(d_end).cast("timestamp")))
    if order:
        out = out.orderBy(ts_col, *[c for c in cols if c != ts_col])
    if limit is not None:
        out = out.limit(limit)
    return out


def ingest_report(df: DataFrame, limit: int | None) -> dict:
    """Rows returned and whether the cap truncated the window."""
    n = df.count()
    return {"rows": n, "truncated": bool(limit is not None and n >= limit)}


def normalize_event_records(df: DataFrame, date_col: str = "event_date", year: int = 2024, max_month: int = 6,
                            mapping: Mapping[str, str] | None = None,
                            defaults: Mapping[str, str] | None = None, source: str = "api") -> DataFrame:
    """API event records -> (title, date, borough, type, source, method,
    location): empty dates dropped, ``T`` -> space, fraction cut, parsed,
    kept when in ``year`` and month <= ``max_month``; missing borough /
    type get defaults."""
    mapping = mapping or {"title": "event_name", "borough": "event_borough", "type": "event_type",
                          "location": "event_location"}
    defaults = defaults or {"borough": "UNKNOWN", "type": "permitted", "title": "", "location": ""}
    raw = F.col(date_col).cast("string")
    txt = F.split(F.regexp_replace(raw, "T", " "), r"\.").getItem(0)
    ts = F.try_to_timestamp(txt)
    out = df.where(raw.isNotNull() & (F.length(raw) > 0)).withColumn("_ts", ts).where(F.col("_ts").isNotNull())
    out = out.where((F.year("_ts") == year) & (F.month("_ts") <= max_month))

    def pick(k):
        src = mapping.get(k)
        c = F.col(src) if src and src in df.columns else F.lit(None).cast("string")
        return F.coalesce(c.cast("string"), F.lit(defaults.get(k))) if k in defaults else c.cast("string")
    return out.select(pick("title").alias("title"), F.date_format("_ts", "yyyy-MM-dd").alias("date"),
                      pick("borough").alias("borough"), pick("type").alias("type"),
                      F.lit(source).alias("source"), F.lit("api").alias("method"), pick("location").alias("location"))


# Fixed values from the reference: curated holidays and parades of 2024.
CURATED_EVENTS = [
    ("New Year Day", "2024-01-01", "ALL", "holiday", "Citywide"),
    ("MLK Day", "2024-01-15", "ALL", "holiday", "Citywide"),
    ("Valentine Day", "2024-02-14", "ALL", "holiday", "Citywide"),
    ("Chinese New Year Parade", "2024-02-10", "MANHATTAN", "parade", "Chinatown"),
    ("St Patricks Day Parade", "2024-03-17", "MANHATTAN", "parade", "5th Avenue"),
    ("Easter Sunday", "2024-03-31", "ALL", "holiday", "Citywide"),
    ("Memorial Day", "2024-05-27", "ALL", "holiday", "Citywide"),
    ("Puerto Rican Day Parade", "2024-06-09", "MANHATTAN", "parade", "5th Avenue"),
    ("NYC Pride March", "2024-06-30", "MANHATTAN", "parade", "Greenwich Village"),
]


def inline_table(spark: SparkSession, rows=None, schema: str | None = None) -> DataFrame:
    """Curated reference rows as a DataFrame (a tiny fixed dimension)."""
    rows = CURATED_EVENTS if rows is None else rows
    schema = schema or "title string, date string, borough string, type string, location string"
    df = spark.createDataFrame(rows, schema)
    if "date" in df.columns:
        df = df.withColumn("date", F.to_date("date"))
    return df.withColumns({"source": F.lit("manual"), "method": F.lit("manual")}) if rows is CURATED_EVENTS else df
