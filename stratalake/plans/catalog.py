"""Registered queries over the test tables, each with an equivalent DuckDB SQL.

Every query reads whole tables (or data Spark derives from them); queries that
exercise sinks write into a fresh folder under the shared checkpoint folder.
The SQL strings are the independent oracle: same column names, same types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_code, clean_label, null_default
from ..operators.geo import inversion_counts, repair_coordinates
from ..operators.quality import MSG_EMPTY, MSG_FAILED, Check, Recent, VerificationError, at_least, type_histogram, verify
from ..operators.rollup import distinct_rollup
from ..sources import storage
from ..sources.paged import parse_records, read_paged
from ..sources.schema import load_schema
from ..sources.sinks import read_table, write_json, write_partitioned
from ..sources.snapshots import (
    label_of,
    latest_snapshot,
    read_latest_snapshot,
    read_snapshots,
    write_snapshots,
)
from .stages import EntityColumns, entity_checks, publish, rollup_checks, to_bronze, to_gold, to_silver

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


EVENTS_SCHEMA = T.StructType.fromJson(
    {
        "type": "struct",
        "fields": [
            {"name": "event_id", "type": "long", "nullable": True, "metadata": {}},
            {"name": "ts", "type": "timestamp_ntz", "nullable": True, "metadata": {}},
            {"name": "user_id", "type": "long", "nullable": True, "metadata": {}},
            {"name": "event_type", "type": "string", "nullable": True, "metadata": {}},
            {"name": "value", "type": "double", "nullable": True, "metadata": {}},
            {"name": "props", "type": "string", "nullable": True, "metadata": {}},
        ],
    }
)
EVENT_COLS = [f.name for f in EVENTS_SCHEMA.fields]

# ---------------------------------------------------------------------------
# Oracle SQL building blocks (DuckDB dialect)
# ---------------------------------------------------------------------------
SQL_CLEAN_LABEL = (
    "coalesce(array_to_string(list_transform(string_split(lower(regexp_replace({x}, "
    r"'[^a-zA-Z0-9 \t\n\x0B\f\r]', '', 'g')), ' '), lambda w: upper(w[1]) || w[2:]), ''), 'unknown')"
)
SQL_CLEAN_CODE = "coalesce(replace({x}, ' ', ''), 'unknown')"
SQL_TEXT_CLASS = (
    "CASE WHEN {x} IS NULL THEN 'Null' "
    r"WHEN regexp_full_match({x}, '(-|\+| )?\d*\.\d*') THEN 'Fractional' "
    r"WHEN regexp_full_match({x}, '(-|\+| )?\d*') THEN 'Integral' "
    "WHEN regexp_full_match({x}, '(true|false)') THEN 'Boolean' ELSE 'String' END"
)
SQL_INVERTED = (
    "(((({la}) < -90 OR ({la}) > 90) AND ({lo}) BETWEEN -90 AND 90) "
    "OR ((({lo}) < -180 OR ({lo}) > 180) AND ({la}) BETWEEN -180 AND 180))"
)


def _sql_repair(la: str, lo: str) -> tuple[str, str]:
    sw = SQL_INVERTED.format(la=la, lo=lo)
    lat = f"CASE WHEN {sw} THEN {lo} ELSE {la} END"
    lon = f"CASE WHEN {sw} THEN {la} ELSE {lo} END"
    return (
        f"CASE WHEN ({lat}) BETWEEN -90 AND 90 THEN ({lat}) END",
        f"CASE WHEN ({lon}) BETWEEN -180 AND 180 THEN ({lon}) END",
    )


def sql_completeness(src: str, c: str) -> str:
    return f"(SELECT count({c}) / nullif(count(*), 0) FROM {src})"


def sql_compliance(src: str, pred: str, nulls: str = "fail") -> str:
    default = "true" if nulls == "pass" else "false"
    return f"(SELECT count(*) FILTER (WHERE coalesce({pred}, {default})) / nullif(count(*), 0) FROM {src})"


def sql_uniqueness(src: str, cols: list[str]) -> str:
    keys = ", ".join(cols)
    any_set = " OR ".join(f"{c} IS NOT NULL" for c in cols)
    return (
        f"(SELECT count(*) FILTER (WHERE n = 1) / sum(n) FROM "
        f"(SELECT count(*) AS n FROM {src} WHERE {any_set} GROUP BY {keys}))"
    )


def sql_datatype(src: str, c: str, hit: str) -> str:
    """``hit``: SQL boolean over the value saying it is in the wanted class."""
    return (
        f"(SELECT CASE WHEN count(*) = 0 THEN NULL ELSE coalesce("
        f"count(*) FILTER (WHERE {c} IS NOT NULL AND {hit}) / nullif(count({c}), 0), 0.0) END FROM {src})"
    )


def sql_text_hit(c: str, classes: tuple[str, ...]) -> str:
    return "(" + SQL_TEXT_CLASS.format(x=c) + " IN (" + ", ".join(f"'{k}'" for k in classes) + "))"


def sql_report(ctes: str, checks: list[tuple[str, str, list[tuple[str, str, float | None, float | None]]]]) -> str:
    """Report SQL. ``checks``: (check, level, [(constraint, metric_sql, lo, hi)])."""
    rows = []
    for chk, level, cons in checks:
        for name, metric, lo, hi in cons:
            lo_s = "NULL" if lo is None else repr(float(lo))
            hi_s = "NULL" if hi is None else repr(float(hi))
            rows.append(
                f"SELECT '{chk}' AS chk, '{level}' AS lvl, '{name}' AS cons, "
                f"CAST({metric} AS DOUBLE) AS metric, CAST({lo_s} AS DOUBLE) AS lo, CAST({hi_s} AS DOUBLE) AS hi"
            )
    union = "\nUNION ALL ".join(rows)
    with_ = f"WITH {ctes},\n" if ctes else "WITH "
    return f"""{with_}rep_rows AS ({union}),
rep_ok AS (SELECT *, coalesce((lo IS NULL OR metric >= lo) AND (hi IS NULL OR metric <= hi), false) AS ok
  FROM rep_rows)
SELECT chk AS "check", lvl AS check_level,
  CASE WHEN bool_and(ok) OVER (PARTITION BY chk) THEN 'Success' ELSE lvl END AS check_status,
  cons AS "constraint",
  CASE WHEN ok THEN 'Success' ELSE 'Failure' END AS constraint_status,
  CASE WHEN ok THEN '' WHEN metric IS NULL THEN '{MSG_EMPTY}' ELSE '{MSG_FAILED}' END AS constraint_message,
  metric
FROM rep_ok"""


# ---------------------------------------------------------------------------
# Coordinates (customer: latitude = c_acctbal / 50, longitude = c_custkey % 500 - 250)
# ---------------------------------------------------------------------------
def geo_input(spark, d) -> DataFrame:
    return table(spark, d, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 50).alias("latitude"),
        ((F.col("c_custkey") % 500) - 250).cast("double").alias("longitude"),
    )


SQL_GEO_INPUT = (
    "g AS (SELECT c_custkey, c_acctbal / 50 AS la, CAST(c_custkey % 500 - 250 AS DOUBLE) AS lo FROM customer)"
)


def q_geo_atomic(spark, d):
    return repair_coordinates(geo_input(spark, d), mode="atomic")


_lat, _lon = _sql_repair("la", "lo")
SQL_GEO_ATOMIC_SELECT = f"SELECT c_custkey, {_lat} AS latitude, {_lon} AS longitude FROM g"
SQL_GEO_ATOMIC = f"WITH {SQL_GEO_INPUT}\n{SQL_GEO_ATOMIC_SELECT}"


def q_geo_sequential(spark, d):
    return repair_coordinates(geo_input(spark, d), mode="sequential")


SQL_GEO_SEQUENTIAL = f"""WITH {SQL_GEO_INPUT},
s1 AS (SELECT c_custkey, lo, {_lat} AS latitude FROM g)
SELECT c_custkey, latitude, {_sql_repair("latitude", "lo")[1]} AS longitude FROM s1"""


def q_geo_counts(spark, d):
    return inversion_counts(geo_input(spark, d))


SQL_GEO_COUNTS = f"""WITH {SQL_GEO_INPUT}
SELECT {SQL_INVERTED.format(la="la", lo="lo")} AS inverted, count(*) AS n_rows FROM g GROUP BY 1"""


# ---------------------------------------------------------------------------
# Labels
# ---------------------------------------------------------------------------
def q_clean_label(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        clean_label("text").alias("text_label"),
        clean_label("source").alias("source_label"),
        clean_label("lang").alias("lang_label"),
    )


SQL_CLEAN_LABEL_DOCS = f"""SELECT doc_id,
  {SQL_CLEAN_LABEL.format(x="text")} AS text_label,
  {SQL_CLEAN_LABEL.format(x="source")} AS source_label,
  {SQL_CLEAN_LABEL.format(x="lang")} AS lang_label
FROM documents"""


def q_clean_label_pages(spark, d):
    return table(spark, d, "pages").select(
        "page_id", clean_label("url").alias("url_label"), clean_label("html").alias("html_label")
    )


SQL_CLEAN_LABEL_PAGES = f"""SELECT page_id,
  {SQL_CLEAN_LABEL.format(x="url")} AS url_label,
  {SQL_CLEAN_LABEL.format(x="html")} AS html_label
FROM pages"""


def q_squash_spaces(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", clean_code("text").alias("text_code"), clean_code("lang").alias("lang_code")
    )
    return docs


SQL_SQUASH_SPACES = f"""SELECT doc_id,
  {SQL_CLEAN_CODE.format(x="text")} AS text_code,
  {SQL_CLEAN_CODE.format(x="lang")} AS lang_code
FROM documents"""


def q_squash_spaces_orders(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", clean_code("o_orderpriority").alias("priority_code"),
        clean_label("o_orderpriority").alias("priority_label"),
    )


SQL_SQUASH_SPACES_ORDERS = f"""SELECT o_orderkey,
  {SQL_CLEAN_CODE.format(x="o_orderpriority")} AS priority_code,
  {SQL_CLEAN_LABEL.format(x="o_orderpriority")} AS priority_label
FROM orders"""


def q_null_default(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    labels = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        null_default(F.col("quality").cast("string")).alias("quality_label"),
        null_default(F.col("toxic").cast("string")).alias("toxic_label"),
    )


SQL_NULL_DEFAULT = """SELECT d.doc_id,
  coalesce(CAST(l.quality AS VARCHAR), 'unknown') AS quality_label,
  coalesce(CAST(l.toxic AS VARCHAR), 'unknown') AS toxic_label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


# ---------------------------------------------------------------------------
# Roll-ups
# ---------------------------------------------------------------------------
def q_distinct_rollup(spark, d):
    ev = table(spark, d, "events").select(
        "event_type", F.to_date("ts").alias("day"), "user_id"
    )
    return distinct_rollup(ev, ["event_type", "day"], "user_id", "n_users")


SQL_DISTINCT_ROLLUP = """SELECT event_type, CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS n_users
FROM events GROUP BY 1, 2"""


def q_distinct_rollup_lineitem(spark, d):
    li = table(spark, d, "lineitem")
    return distinct_rollup(li, ["l_returnflag", "l_linestatus"], "l_orderkey", "n_orders")


SQL_DISTINCT_ROLLUP_LINEITEM = """SELECT l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS n_orders
FROM lineitem GROUP BY 1, 2"""


# ---------------------------------------------------------------------------
# Snapshots and sinks (written under the shared checkpoint folder)
# ---------------------------------------------------------------------------
def q_json_schema_read(spark, d):
    path = storage.scratch_path(spark, "json")
    write_json(table(spark, d, "events"), path)
    back = spark.read.schema(EVENTS_SCHEMA).json(path)
    return back.withColumn("k", F.from_json("props", "k bigint")["k"])


SQL_JSON_SCHEMA_READ = """SELECT event_id, ts, user_id, event_type, value, props,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""


def _day_snapshots(spark, d) -> str:
    base = storage.scratch_path(spark, "bronze")
    ev = table(spark, d, "events")
    write_snapshots(ev, base, label_of("ts", grain="day"))
    return base


SQL_DAY_LABEL = "strftime(date_trunc('day', ts), '%Y-%m-%dT%H-%M')"


def q_bronze_snapshot_roundtrip(spark, d):
    return read_snapshots(spark, _day_snapshots(spark, d), EVENTS_SCHEMA)


SQL_BRONZE_ROUNDTRIP = f"SELECT *, {SQL_DAY_LABEL} AS dt_extraction FROM events"


def q_latest_snapshot(spark, d):
    return read_latest_snapshot(spark, _day_snapshots(spark, d), EVENTS_SCHEMA)


def q_latest_snapshot_subquery(spark, d):
    base = _day_snapshots(spark, d)
    return latest_snapshot(read_snapshots(spark, base, EVENTS_SCHEMA), base=base)


SQL_LATEST_SNAPSHOT = f"""SELECT *, {SQL_DAY_LABEL} AS dt_extraction FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"""

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
        T.StructField("st", T.StringType()),
    ]
)


def _orders_by_status(spark, d, empty_as):
    path = storage.scratch_path(spark, "silver")
    o = table(spark, d, "orders").withColumn(
        "st", F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus"))
    )
    write_partitioned(o, path, ["st"], empty_as=empty_as)
    return read_table(spark, path, ORDERS_SCHEMA)


def q_parquet_partition_roundtrip(spark, d):
    return _orders_by_status(spark, d, "unknown")


SQL_PARTITION_ROUNDTRIP = """SELECT *, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE o_orderstatus END AS st
FROM orders"""


def q_partition_empty_label(spark, d):
    back = _orders_by_status(spark, d, None)
    return distinct_rollup(back, ["st"], "o_custkey", "n_customers")


SQL_PARTITION_EMPTY_LABEL = """SELECT nullif(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, '') AS st,
  count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1"""


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------
def q_dq_completeness(spark, d):
    chk = Check("completeness").is_complete("c_custkey").is_complete("latitude").is_complete("longitude")
    return verify(q_geo_atomic(spark, d), chk)


SQL_GEO_ATOMIC_CTES = f"{SQL_GEO_INPUT}, ga AS ({SQL_GEO_ATOMIC_SELECT})"
SQL_DQ_COMPLETENESS = sql_report(
    SQL_GEO_ATOMIC_CTES,
    [("completeness", "Error", [
        ("Completeness(c_custkey)", sql_completeness("ga", "c_custkey"), 1, 1),
        ("Completeness(latitude)", sql_completeness("ga", "latitude"), 1, 1),
        ("Completeness(longitude)", sql_completeness("ga", "longitude"), 1, 1),
    ])],
)

_LAT_PRED = "latitude >= -90 AND latitude <= 90"
_LON_PRED = "longitude >= -180 AND longitude <= 180"


def q_dq_compliance(spark, d):
    strict = (
        Check("ranges strict")
        .satisfies(_LAT_PRED, "Latitude within range")
        .satisfies(_LON_PRED, "Longitude within range")
    )
    lenient = (
        Check("ranges null-tolerant", level="Warning")
        .satisfies(_LAT_PRED, "Latitude within range", nulls="pass")
        .satisfies(_LON_PRED, "Longitude within range", nulls="pass")
        .satisfies("latitude > 0", "Northern hemisphere", assertion=at_least(0.4))
    )
    return verify(q_geo_atomic(spark, d), strict, lenient)


SQL_DQ_COMPLIANCE = sql_report(
    SQL_GEO_ATOMIC_CTES,
    [
        ("ranges strict", "Error", [
            ("Compliance(Latitude within range)", sql_compliance("ga", _LAT_PRED), 1, 1),
            ("Compliance(Longitude within range)", sql_compliance("ga", _LON_PRED), 1, 1),
        ]),
        ("ranges null-tolerant", "Warning", [
            ("Compliance(Latitude within range)", sql_compliance("ga", _LAT_PRED, "pass"), 1, 1),
            ("Compliance(Longitude within range)", sql_compliance("ga", _LON_PRED, "pass"), 1, 1),
            ("Compliance(Northern hemisphere)", sql_compliance("ga", "latitude > 0"), 0.4, None),
        ]),
    ],
)


def q_dq_uniqueness(spark, d):
    li = verify(table(spark, d, "lineitem"), Check("lineitem keys").is_unique("l_orderkey", "l_linenumber"))
    cu = verify(table(spark, d, "customer"), Check("customer keys").is_unique("c_custkey"))
    od = verify(table(spark, d, "orders"), Check("order customers", level="Warning").is_unique("o_custkey"))
    return li.unionByName(cu).unionByName(od)


SQL_DQ_UNIQUENESS = sql_report(
    "",
    [
        ("lineitem keys", "Error", [
            ("Uniqueness(l_orderkey,l_linenumber)", sql_uniqueness("lineitem", ["l_orderkey", "l_linenumber"]), 1, 1)]),
        ("customer keys", "Error", [("Uniqueness(c_custkey)", sql_uniqueness("customer", ["c_custkey"]), 1, 1)]),
        ("order customers", "Warning", [("Uniqueness(o_custkey)", sql_uniqueness("orders", ["o_custkey"]), 1, 1)]),
    ],
)


def mixed_text(spark, d) -> DataFrame:
    """A text column whose values fall in every class, derived from ``events``."""
    ev = table(spark, d, "events")
    et = F.col("event_type")
    tag = (
        F.when(et == "click", F.col("user_id").cast("string"))
        .when(et == "view", F.concat(F.col("event_id").cast("string"), F.lit("."), F.col("user_id").cast("string")))
        .when(et == "purchase", F.when(F.col("user_id") % 2 == 0, F.lit("true")).otherwise(F.lit("false")))
        .when(et == "signup", et)
    )
    return ev.select("event_id", tag.alias("tag"), "props", "value")


SQL_MIXED_TEXT = """m AS (SELECT event_id, CASE
  WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR)
  WHEN event_type = 'view' THEN CAST(event_id AS VARCHAR) || '.' || CAST(user_id AS VARCHAR)
  WHEN event_type = 'purchase' THEN CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END
  WHEN event_type = 'signup' THEN event_type END AS tag, props, value FROM events)"""


def q_dq_type_histogram(spark, d):
    return type_histogram(mixed_text(spark, d), "tag")


SQL_DQ_TYPE_HISTOGRAM = f"""WITH {SQL_MIXED_TEXT},
c AS (SELECT {SQL_TEXT_CLASS.format(x="tag")} AS k FROM m)
SELECT count(*) FILTER (WHERE k = 'Null') AS n_null,
  count(*) FILTER (WHERE k = 'Fractional') AS n_fractional,
  count(*) FILTER (WHERE k = 'Integral') AS n_integral,
  count(*) FILTER (WHERE k = 'Boolean') AS n_boolean,
  count(*) FILTER (WHERE k = 'String') AS n_string
FROM c"""


def q_dq_datatype(spark, d):
    o = table(spark, d, "orders").withColumn("custkey_text", F.col("o_custkey").cast("string"))
    chk = (
        Check("order types")
        .has_data_type("o_orderpriority", "String")
        .has_data_type("o_orderstatus", "String")
        .has_data_type("o_totalprice", "Numeric")
        .has_data_type("custkey_text", "Numeric")
        .has_data_type("custkey_text", "String")
    )
    m = verify(mixed_text(spark, d), Check("mixed types", level="Warning")
               .has_data_type("tag", "Integral", assertion=at_least(0.1))
               .has_data_type("tag", "Boolean", assertion=at_least(0.5))
               .has_data_type("props", "String"))
    return verify(o, chk).unionByName(m)


def _sql_text_type(src, c, kinds):
    return sql_datatype(src, c, sql_text_hit(c, kinds))


SQL_DQ_DATATYPE = sql_report(
    "o AS (SELECT *, CAST(o_custkey AS VARCHAR) AS custkey_text FROM orders), " + SQL_MIXED_TEXT,
    [
        ("order types", "Error", [
            ("DataType(o_orderpriority,String)", _sql_text_type("o", "o_orderpriority", ("String",)), 1, 1),
            ("DataType(o_orderstatus,String)", _sql_text_type("o", "o_orderstatus", ("String",)), 1, 1),
            ("DataType(o_totalprice,Numeric)", sql_datatype("o", "o_totalprice", "true"), 1, 1),
            ("DataType(custkey_text,Numeric)", _sql_text_type("o", "custkey_text", ("Integral", "Fractional")), 1, 1),
            ("DataType(custkey_text,String)", _sql_text_type("o", "custkey_text", ("String",)), 1, 1),
        ]),
        ("mixed types", "Warning", [
            ("DataType(tag,Integral)", _sql_text_type("m", "tag", ("Integral",)), 0.1, None),
            ("DataType(tag,Boolean)", _sql_text_type("m", "tag", ("Boolean",)), 0.5, None),
            ("DataType(props,String)", _sql_text_type("m", "props", ("String",)), 1, 1),
        ]),
    ],
)


# ---------------------------------------------------------------------------
# Entities derived from documents + labels (the silver / gold stages)
# ---------------------------------------------------------------------------
COLS = EntityColumns()
ENTITY_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("country", T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)


def entities(spark, d) -> DataFrame:
    """Raw entity rows: id <- doc_id, kind <- quality, country <- lang, state <- source."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id"),
        null_default(F.col("quality").cast("string")).alias("kind"),
        ((F.col("doc_id") % 360) - 180).cast("double").alias("latitude"),
        ((F.col("n_chars") % 500) - 250).cast("double").alias("longitude"),
        F.col("lang").alias("country"),
        F.col("source").alias("state"),
    )


SQL_ENTITIES = """e AS (SELECT CAST(d.doc_id AS VARCHAR) AS id,
  coalesce(CAST(l.quality AS VARCHAR), 'unknown') AS kind,
  CAST(d.doc_id % 360 - 180 AS DOUBLE) AS la, CAST(d.n_chars % 500 - 250 AS DOUBLE) AS lo,
  d.lang AS country0, d.source AS state0
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
SQL_SILVER = f"""{SQL_ENTITIES},
s AS (SELECT id, kind, {_sql_repair("la", "lo")[0]} AS latitude, {_sql_repair("la", "lo")[1]} AS longitude,
  {SQL_CLEAN_CODE.format(x="country0")} AS country, {SQL_CLEAN_LABEL.format(x="state0")} AS state FROM e)"""

SILVER_CHECK = entity_checks(COLS, text_columns=[COLS.country, COLS.state])


def _silver(spark, d) -> tuple[str, DataFrame]:
    from ..sources.snapshots import write_snapshot

    bronze = storage.scratch_path(spark, "bronze")
    write_snapshot(entities(spark, d), bronze, "2024-01-01T00-00")
    silver = storage.scratch_path(spark, "silver")
    to_silver(spark, bronze, silver, ENTITY_SCHEMA, cols=COLS, checks=[SILVER_CHECK])
    return silver, read_table(spark, silver, ENTITY_SCHEMA)


def q_silver_clean(spark, d):
    return _silver(spark, d)[1]


# Publishing maps an empty partition label to 'unknown'.
SQL_SILVER_PUBLISHED = f"""{SQL_SILVER},
p AS (SELECT id, kind, latitude, longitude,
  CASE WHEN country = '' THEN 'unknown' ELSE country END AS country,
  CASE WHEN state = '' THEN 'unknown' ELSE state END AS state FROM s)"""
SQL_SILVER_CLEAN = f"WITH {SQL_SILVER_PUBLISHED}\nSELECT * FROM p"


def q_incremental_silver(spark, d):
    from ..sources.snapshots import write_snapshot
    from ..streaming.incremental import incremental_silver

    bronze = storage.scratch_path(spark, "bronze")
    write_snapshot(entities(spark, d), bronze, "2024-01-01T00-00")
    silver = storage.scratch_path(spark, "silver")
    ckpt = storage.scratch_path(spark, "stream")
    incremental_silver(spark, bronze, silver, ENTITY_SCHEMA, ckpt, cols=COLS, checks=[SILVER_CHECK])
    return read_table(spark, silver, ENTITY_SCHEMA)


def q_dq_report(spark, d):
    from .stages import clean_entities

    return verify(clean_entities(entities(spark, d), COLS), entity_checks(COLS))


def _entity_report_sql() -> str:
    src = "s"
    cons = [
        ("Completeness(id)", sql_completeness(src, "id")),
        ("Uniqueness(id)", sql_uniqueness(src, ["id"])),
        ("Completeness(state)", sql_completeness(src, "state")),
        ("Completeness(country)", sql_completeness(src, "country")),
        ("Completeness(kind)", sql_completeness(src, "kind")),
    ]
    for c in ("id", "state", "country", "kind"):
        cons.append((f"DataType({c},String)", _sql_text_type(src, c, ("String",))))
    cons += [
        ("DataType(latitude,Numeric)", sql_datatype(src, "latitude", "true")),
        ("DataType(longitude,Numeric)", sql_datatype(src, "longitude", "true")),
        ("Compliance(Latitude within range)", sql_compliance(src, _LAT_PRED, "pass")),
        ("Compliance(Longitude within range)", sql_compliance(src, _LON_PRED, "pass")),
    ]
    return sql_report(SQL_SILVER, [("silver entity checks", "Error", [(n, m, 1, 1) for n, m in cons])])


SQL_DQ_REPORT = _entity_report_sql()


def q_medallion_end_to_end(spark, d):
    silver, _ = _silver(spark, d)
    gold = storage.scratch_path(spark, "gold")
    to_gold(spark, silver, gold, ENTITY_SCHEMA, keys=["country", "state", "kind"], id_col="id",
            alias="n_entities", checks=[rollup_checks(["country", "state", "kind"], "n_entities",
                                                      text_columns=["country", "state"])])
    return read_table(spark, gold)


SQL_MEDALLION = f"""WITH {SQL_SILVER_PUBLISHED}
SELECT country, state, kind, count(DISTINCT id) AS n_entities FROM p GROUP BY 1, 2, 3"""


# ---------------------------------------------------------------------------
# Damaged records, and a snapshot that is written again
# ---------------------------------------------------------------------------
RECORD_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType())]
)
# One record in ten is cut off, one has a wrong type, one is no object.
_RECORD = """CASE event_id % 10
  WHEN 3 THEN '{"event_id":' || event_id || ',"user_id":'
  WHEN 5 THEN '{"event_id":"no ' || event_id || '","user_id":' || user_id || ',"event_type":"' || event_type || '"}'
  WHEN 8 THEN '"' || event_id || '"'
  ELSE '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' END"""


def q_damaged_records(spark, d):
    """Good records published, damaged ones in quarantine; both are returned."""
    from ..sources.snapshots import write_run
    from .stages import DAMAGED, Damaged

    bronze, silver, bad = (storage.scratch_path(spark, n) for n in ("bronze", "silver", "quarantine"))
    lines = table(spark, d, "events").select(F.expr(_RECORD).alias("record"))

    def write(folder, options):
        lines.write.mode("append").options(**options).text(folder)
        return 1

    write_run(spark, bronze, "2024-01-01T00-00", write, allow_empty=True)
    apart = Damaged(bad)
    rows = apart.take_out(read_latest_snapshot(spark, bronze, RECORD_SCHEMA, damaged=DAMAGED)).drop("dt_extraction")
    publish(rows, silver, [Check("records").is_complete("event_id")], extra=apart.report)
    kept = read_table(spark, silver, RECORD_SCHEMA).withColumn("record", F.lit(None).cast("string"))
    if not storage.exists(spark, bad):
        return kept
    return kept.unionByName(read_table(spark, bad, T.StructType.fromDDL("record string, dt_extraction string")).select("record"), allowMissingColumns=True)


SQL_DAMAGED_RECORDS = f"""WITH r AS (SELECT event_id, user_id, event_type, event_id % 10 IN (3, 5, 8) AS bad, {_RECORD} AS record FROM events)
SELECT CASE WHEN NOT bad THEN event_id END AS event_id, CASE WHEN NOT bad THEN user_id END AS user_id,
  CASE WHEN NOT bad THEN event_type END AS event_type, CASE WHEN bad THEN record END AS record FROM r"""


def q_snapshot_rerun(spark, d):
    """A label written twice, and a run that died before its manifest: the second run is the snapshot."""
    from ..sources.snapshots import write_snapshot

    base = storage.scratch_path(spark, "bronze")
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type")
    write_snapshot(ev.withColumn("event_type", F.lit("first run")), base, "2024-01-01T00-00")
    write_snapshot(ev, base, "2024-01-01T00-00")
    dying = {"mapreduce.output.basename": "run-died"}
    ev.withColumn("event_type", F.lit("died")).write.mode("append").options(**dying).json(f"{base}/dt_extraction=2024-01-01T00-00")
    ev.write.mode("append").options(**dying).json(f"{base}/dt_extraction=2024-01-02T00-00")
    return read_latest_snapshot(spark, base, RECORD_SCHEMA)


SQL_SNAPSHOT_RERUN = "SELECT event_id, user_id, event_type, '2024-01-01T00-00' AS dt_extraction FROM events"


# ---------------------------------------------------------------------------
# Versions: gold that follows silver, roll-up on changes, publishing some partitions
# ---------------------------------------------------------------------------
def entities_before(spark, d) -> DataFrame:
    """The entities as an earlier version had them: all of them, some under another id, state or kind."""
    n = F.col("id").cast("long")
    return entities(spark, d).withColumns(
        {
            "id": F.when(n % 5 == 0, F.concat(F.lit("was-"), F.col("id"))).otherwise(F.col("id")),
            "state": F.when(n % 7 == 0, F.lit("elsewhere")).otherwise(F.col("state")),
            "kind": F.when(n % 11 == 0, F.lit("other")).otherwise(F.col("kind")),
        }
    )


GOLD_KEYS = ["country", "state", "kind"]
GOLD_CHECK = rollup_checks(GOLD_KEYS, "n_entities", text_columns=["country", "state"])


def q_incremental_gold(spark, d):
    """Gold after two versions of silver: the second run recounts what changed."""
    from ..streaming.gold import incremental_gold
    from .stages import clean_entities

    silver, gold, ckpt = (storage.scratch_path(spark, n) for n in ("silver", "gold", "stream"))
    for rows in (entities_before(spark, d), entities(spark, d)):
        publish(clean_entities(rows, COLS), silver, [SILVER_CHECK], partition_cols=["country", "state"], overwrite="changed")
        incremental_gold(spark, silver, gold, ENTITY_SCHEMA, ckpt, keys=GOLD_KEYS, checks=[GOLD_CHECK])
    return read_table(spark, gold)


def _orders_versions(spark, d) -> tuple[str, storage.Version, storage.Version]:
    """Orders by priority, all totals 1 too high; then two of the priorities published anew."""
    path = storage.scratch_path(spark, "orders")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    publish(o.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, [], partition_cols=["o_orderpriority"])
    old = storage.current_version(spark, path)
    some = o.where(F.col("o_orderpriority").isin(*REPUBLISHED))
    publish(some, path, [Check("orders").is_unique("o_orderkey").is_complete("o_custkey")],
            partition_cols=["o_orderpriority"], overwrite="dynamic")
    return path, old, storage.current_version(spark, path)


REPUBLISHED = ("1-URGENT", "3-MEDIUM")
PRIORITY_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


def q_publish_partitions(spark, d):
    path, _, _ = _orders_versions(spark, d)
    return read_table(spark, path, PRIORITY_SCHEMA)


SQL_PUBLISH_PARTITIONS = f"""SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderpriority IN {REPUBLISHED} THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice, o_orderpriority FROM orders"""


def q_row_changes(spark, d):
    """What publishing two partitions anew has changed, rows before and after; other partitions are not read."""
    from ..operators.changes import row_changes

    path, old, new = _orders_versions(spark, d)
    # the first version lists no partitions, so they are told apart by their folders now
    before = read_table(spark, path, PRIORITY_SCHEMA, version=old).where(F.col("o_orderpriority").isin(*REPUBLISHED))
    after = read_table(spark, path, PRIORITY_SCHEMA, version=new, only=set(new.parts[new.folder]))
    return row_changes(before, after, PRIORITY_SCHEMA.names)


SQL_ROW_CHANGES = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + s AS o_totalprice, o_orderpriority,
  CASE WHEN s = 1 THEN -1 ELSE 1 END::BIGINT AS change
FROM orders, (VALUES (0), (1)) v(s) WHERE o_orderpriority IN {REPUBLISHED}"""


def q_kept_reports(spark, d):
    """Three publishes of orders, the third rejected: it has lost more than half of the rows of those before."""
    from .reports import kept_reports

    path, reports = storage.scratch_path(spark, "orders"), storage.scratch_path(spark, "reports")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    check = Check("orders").has_size(Recent(lo=0.5, last=2)).is_complete("o_custkey").is_unique("o_orderkey")
    for rows in (o, o.where("o_orderpriority <> '5-LOW'"), o.where("o_orderpriority = '1-URGENT'")):
        try:
            publish(rows, path, [check], reports=reports, table_name="orders")
        except VerificationError:
            pass  # kept as rejected
    return kept_reports(spark, reports, "orders").drop("verified_at", "version")


def _sql_kept_reports() -> str:
    runs = [(1, "true"), (2, "o_orderpriority <> '5-LOW'"), (None, "o_orderpriority = '1-URGENT'")]
    rows = []
    for number, kept in runs:
        src = f"(SELECT * FROM orders WHERE {kept})"
        bad = number is None
        for name, metric in (
            ("Size(*)", f"(SELECT count(*)::DOUBLE FROM {src})"),
            ("Completeness(o_custkey)", sql_completeness(src, "o_custkey")),
            ("Uniqueness(o_orderkey)", sql_uniqueness(src, ["o_orderkey"])),
        ):
            size = bad and name == "Size(*)"
            rows.append(
                f"SELECT {'NULL' if bad else number}::BIGINT AS number, 'orders' AS \"check\", 'Error' AS check_level, "
                f"'{'Error' if bad else 'Success'}' AS check_status, '{name}' AS \"constraint\", "
                f"'{'Failure' if size else 'Success'}' AS constraint_status, "
                f"'{MSG_FAILED if size else ''}' AS constraint_message, {metric} AS metric, 'orders' AS table_name"
            )
    return " UNION ALL ".join(rows)


SQL_KEPT_REPORTS = _sql_kept_reports()


# ---------------------------------------------------------------------------
# Paged source over events (page p = event_id in [(p-1)*200, p*200))
# ---------------------------------------------------------------------------
class _EventPages:
    """Fetcher over ``events``: page ``p`` holds the ids from ``(p-1)*per_page`` on.

    Stands for a remote service in the registered queries; ids must be dense.
    """

    def __init__(self, spark, d, before: int | None = None):
        """``before``: only ids below it, the source as it was earlier."""
        self.path = f"{d.rstrip('/')}/events.parquet"
        self.before = before
        r = table(spark, d, "events").agg(F.min("event_id"), F.max("event_id"), F.count_distinct("event_id")).first()
        if r[2] and (r[0], r[1]) != (0, r[2] - 1):
            raise ValueError("event ids are not dense: pages would have gaps")
        self.rows = r[2]
        self._held = None

    def __getstate__(self):
        return {"path": self.path, "before": self.before, "_held": None}

    def _rows(self, lo: int, hi: int) -> list[dict]:
        import pyarrow.dataset as ds

        hi = hi if self.before is None else min(hi, self.before)
        key = ds.field("event_id")
        found = ds.dataset(self.path, format="parquet").to_table(columns=EVENT_COLS, filter=(key >= lo) & (key < hi))
        return found.sort_by("event_id").to_pylist()

    def prefetch(self, first: int, last: int, per_page: int) -> None:
        lo = (first - 1) * per_page
        self._held = (lo, last * per_page, self._rows(lo, last * per_page))

    def __call__(self, page: int, per_page: int) -> list[dict]:
        lo, hi = (page - 1) * per_page, page * per_page
        if self._held and self._held[0] <= lo and hi <= self._held[1]:
            return self._held[2][lo - self._held[0] : hi - self._held[0]]
        return self._rows(lo, hi)


def q_paged_read(spark, d):
    return parse_records(read_paged(spark, _EventPages(spark, d), per_page=200), EVENTS_SCHEMA)


SQL_PAGED_READ = """SELECT CAST(event_id // 200 + 1 AS INTEGER) AS page, event_id, ts, user_id, event_type, value, props
FROM events"""


def q_paged_stream(spark, d):
    """The same source followed while it grows: a third of the records, then all; no record twice."""
    from ..streaming.pages import incremental_pages, read_pages

    path, ckpt = storage.scratch_path(spark, "pages"), storage.scratch_path(spark, "stream")
    for fetch in (_EventPages(spark, d, before=_EventPages(spark, d).rows // 3), _EventPages(spark, d)):
        incremental_pages(spark, fetch, path, ckpt, per_page=200)
    return parse_records(read_pages(spark, path), EVENTS_SCHEMA)


EVENTS_CONFIG = {"bronze": {"events": {"fields": {f.name: f.dataType.simpleString() for f in EVENTS_SCHEMA.fields}}}}


def q_source_to_bronze(spark, d):
    """The first stage: paged source -> raw snapshot, read back with a configured schema."""
    base = storage.scratch_path(spark, "bronze")
    to_bronze(spark, _EventPages(spark, d), base, label="2024-12-31T23-59")
    return read_snapshots(spark, base, load_schema(EVENTS_CONFIG, "bronze", "events"))


SQL_SOURCE_TO_BRONZE = "SELECT *, '2024-12-31T23-59' AS dt_extraction FROM events"


QUERIES: dict[str, Query] = {
    "geo_atomic": q_geo_atomic,
    "geo_sequential": q_geo_sequential,
    "geo_counts": q_geo_counts,
    "clean_label": q_clean_label,
    "clean_label_pages": q_clean_label_pages,
    "squash_spaces": q_squash_spaces,
    "squash_spaces_orders": q_squash_spaces_orders,
    "null_default": q_null_default,
    "distinct_rollup": q_distinct_rollup,
    "distinct_rollup_lineitem": q_distinct_rollup_lineitem,
    "json_schema_read": q_json_schema_read,
    "bronze_snapshot_roundtrip": q_bronze_snapshot_roundtrip,
    "latest_snapshot": q_latest_snapshot,
    "latest_snapshot_subquery": q_latest_snapshot_subquery,
    "parquet_partition_roundtrip": q_parquet_partition_roundtrip,
    "partition_empty_label": q_partition_empty_label,
    "dq_completeness": q_dq_completeness,
    "dq_compliance": q_dq_compliance,
    "dq_uniqueness": q_dq_uniqueness,
    "dq_type_histogram": q_dq_type_histogram,
    "dq_datatype": q_dq_datatype,
    "dq_report": q_dq_report,
    "silver_clean": q_silver_clean,
    "incremental_silver": q_incremental_silver,
    "medallion_end_to_end": q_medallion_end_to_end,
    "damaged_records": q_damaged_records,
    "snapshot_rerun": q_snapshot_rerun,
    "incremental_gold": q_incremental_gold,
    "publish_partitions": q_publish_partitions,
    "row_changes": q_row_changes,
    "kept_reports": q_kept_reports,
    "paged_read": q_paged_read,
    "paged_stream": q_paged_stream,
    "source_to_bronze": q_source_to_bronze,
}

ORACLE_SQL: dict[str, str] = {
    "geo_atomic": SQL_GEO_ATOMIC,
    "geo_sequential": SQL_GEO_SEQUENTIAL,
    "geo_counts": SQL_GEO_COUNTS,
    "clean_label": SQL_CLEAN_LABEL_DOCS,
    "clean_label_pages": SQL_CLEAN_LABEL_PAGES,
    "squash_spaces": SQL_SQUASH_SPACES,
    "squash_spaces_orders": SQL_SQUASH_SPACES_ORDERS,
    "null_default": SQL_NULL_DEFAULT,
    "distinct_rollup": SQL_DISTINCT_ROLLUP,
    "distinct_rollup_lineitem": SQL_DISTINCT_ROLLUP_LINEITEM,
    "json_schema_read": SQL_JSON_SCHEMA_READ,
    "bronze_snapshot_roundtrip": SQL_BRONZE_ROUNDTRIP,
    "latest_snapshot": SQL_LATEST_SNAPSHOT,
    "latest_snapshot_subquery": SQL_LATEST_SNAPSHOT,
    "parquet_partition_roundtrip": SQL_PARTITION_ROUNDTRIP,
    "partition_empty_label": SQL_PARTITION_EMPTY_LABEL,
    "dq_completeness": SQL_DQ_COMPLETENESS,
    "dq_compliance": SQL_DQ_COMPLIANCE,
    "dq_uniqueness": SQL_DQ_UNIQUENESS,
    "dq_type_histogram": SQL_DQ_TYPE_HISTOGRAM,
    "dq_datatype": SQL_DQ_DATATYPE,
    "dq_report": SQL_DQ_REPORT,
    "silver_clean": SQL_SILVER_CLEAN,
    "incremental_silver": SQL_SILVER_CLEAN,
    "medallion_end_to_end": SQL_MEDALLION,
    "damaged_records": SQL_DAMAGED_RECORDS,
    "snapshot_rerun": SQL_SNAPSHOT_RERUN,
    "incremental_gold": SQL_MEDALLION,
    "publish_partitions": SQL_PUBLISH_PARTITIONS,
    "row_changes": SQL_ROW_CHANGES,
    "kept_reports": SQL_KEPT_REPORTS,
    "paged_read": SQL_PAGED_READ,
    "paged_stream": SQL_PAGED_READ,
    "source_to_bronze": SQL_SOURCE_TO_BRONZE,
}
