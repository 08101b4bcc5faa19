"""The query catalogue: every operator as a named query with an equivalent SQL text.

Each query takes a session and a data folder, reads whole tables and gives a DataFrame. The SQL
runs on the same tables elsewhere and must give the same rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import aggregates, coerce, dates, jsons, scalars, sql_names
from quayside.operators import align, audit, grouping, identity, load, paging, search
from quayside.operators.present import present
from quayside.plans.copyjob import copy_tables, report_frame
from quayside.session import UNEVEN_ROWS, delete_at_exit, shared_dir, stored, tune
from quayside.sources.publish import latest, publish
from quayside.sources.scan import key_slices, sliced
from quayside.streaming import catch_up
from quayside.tables import Expr, Field, ForeignKey, Table

Query = Callable[[SparkSession, str], DataFrame]

NOW = "2024-02-01 00:00:00"
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def register(run: Query) -> Query:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)

        QUERIES[run.__name__] = tuned
        if oracle is not None:
            ORACLES[run.__name__] = oracle.strip()
        return run

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def pick(column: str, *values: str) -> Column:
    """The spoiled spelling for a row, chosen by a small number in it."""
    return F.element_at(F.array(*map(F.lit, values)), F.col(column))


def typed_as(declared: str, *columns: str) -> Table:
    """A target with the same declared type for every column."""
    return Table("typed", tuple(Field(c, declared) for c in columns))


def stamp(x: Column) -> Column:
    return F.date_format(x, STAMP)


# ------------------------------------------------------------------ scans, alignment, reports


@query("""
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
n AS (SELECT lo, hi, greatest(1, least(8, CAST(ceil((hi - lo + 1) / 2000.0) AS BIGINT))) AS n FROM b),
w AS (SELECT lo, CAST(ceil((hi - lo + 1) / CAST(n AS DOUBLE)) AS BIGINT) AS width FROM n)
SELECT (o_orderkey - lo) // width AS slice, count(*) AS n_rows,
       min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM orders, w GROUP BY 1
""")
def ranged_scan(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    ends = paging.key_bounds(orders, "o_orderkey").first()
    slices = key_slices(ends["first_key"], ends["last_key"], workers=8)
    return orders.groupBy(sliced("o_orderkey", slices).alias("slice")).agg(
        F.count("*").alias("n_rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


@query("SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem")
def full_scan(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"
    )


@query("""
SELECT l_orderkey, l_partkey, unnest(['quantity', 'discount', 'tax']) AS measure,
       unnest([l_quantity, l_discount]) AS amount
FROM lineitem
""")
def unnest_arrays(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.array(F.lit("quantity"), F.lit("discount"), F.lit("tax")).alias("measure"),
        F.array("l_quantity", "l_discount").alias("amount"),
    )
    return align.unnest(rows, "measure", "amount", keep=("l_orderkey", "l_partkey"))


@query("""
SELECT o_orderkey AS rowid, o_orderkey, o_custkey, o_totalprice, 'web' AS channel,
       false AS is_big, CAST(NULL AS BIGINT) AS score
FROM orders
""")
def align_columns(spark, sf_dir):
    target = Table(
        "orders",
        (
            Field("rowid", "INTEGER"),
            Field("o_orderkey", "INTEGER"),
            Field("o_custkey", "INT"),
            Field("o_totalprice", "REAL"),
            Field("channel", "TEXT", default="web"),
            Field("is_big", "BOOLEAN", default=0),
            Field("score", "INTEGER"),
        ),
        pk=("o_orderkey",),
    )
    source = read(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    return align.align(source, target, row_key="o_orderkey")


def scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table name of its own and a folder below the shared one that goes with the session."""
    unique = f"{name}_{uuid.uuid4().hex}"
    return unique, delete_at_exit(spark, f"{shared_dir(spark)}/{unique}")


def declared(spark: SparkSession, suffix: str) -> list[Table]:
    """Typed targets for the copies below."""
    customer, orders = f"customer{suffix}", f"orders{suffix}"
    return [
        Table(customer, (Field("c_custkey", "INTEGER"), Field("c_name", "TEXT", not_null=True), Field("c_acctbal", "REAL"),
                         Field("vip", "BOOLEAN", default=0), Field("tier", "TEXT", default="none")),
              pk=("c_custkey",), unique=(("c_name",),), checks={"vip_flag": "vip in (0, 1)", "balance": F.col("c_acctbal") > -900}),
        Table(orders, (Field("o_orderkey", "INTEGER"), Field("o_custkey", "INTEGER"), Field("o_orderstatus", "TEXT", not_null=True),
                       Field("o_orderdate", "DATETIME"), Field("rowid", "INTEGER")),
              pk=("o_orderkey",), foreign_keys=(ForeignKey(("o_custkey",), customer, ("c_custkey",)),)),
    ]


def loose_customers(spark, sf_dir):
    """Untyped customers, some of them without a name."""
    name = F.when(F.col("c_custkey") % 11 != 0, F.col("c_name"))
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string"), name.alias("c_name"), "c_acctbal")


def loose_orders(spark, sf_dir):
    """Untyped orders with their place as an implicit row key, some dates no dates."""
    day = F.when(F.col("o_orderkey") % 13 == 0, "soon").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string"), "o_custkey", "o_orderstatus", day.alias("o_orderdate"), F.col("o_orderkey").alias("_at")
    )


_COPIED = """
WITH c AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 11 <> 0 AND c_acctbal > -900),
lost AS (SELECT (CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END) + (CASE WHEN c_acctbal > -900 THEN 0 ELSE 1 END) AS n FROM customer),
o AS (SELECT o_orderkey, o_custkey, o_orderkey % 13 <> 0 AS typed,
             o_custkey IN (SELECT c_custkey FROM c) AS known FROM orders)
"""


@query(_COPIED + """
SELECT 'customer' AS "table", 'load' AS mode, (SELECT count(*) FROM c) AS n_rows, (SELECT count(*) FROM c) AS inserted,
       CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS removed, (SELECT CAST(sum(n) AS BIGINT) FROM lost) AS rejected,
       'vip, tier' AS defaulted, (SELECT max(c_custkey) + 1 FROM c) AS next_identity, CAST(NULL AS VARCHAR) AS skipped
UNION ALL SELECT 'orders', 'load', count(*) FILTER (known AND typed), count(*) FILTER (known AND typed), 0, 0,
       count(*) FILTER (NOT typed) + count(*) FILTER (typed AND NOT known), '',
       max(o_orderkey) FILTER (known AND typed) + 1, NULL FROM o
UNION ALL SELECT 'events', 'skipped', 0, 0, 0, 0, 0, '', NULL, 'no target table'
""")
def copy_report(spark, sf_dir):
    """A copy of three sources, with what happened to each as the job reports it."""
    suffix, base = scratch(spark, "")
    sources = {f"customer{suffix}": loose_customers(spark, sf_dir), f"orders{suffix}": loose_orders(spark, sf_dir),
               f"events{suffix}": read(spark, sf_dir, "events")}
    reports = copy_tables(spark, sources, declared(spark, suffix), base, rejects="keep", row_keys={f"orders{suffix}": "_at"})
    return report_frame(spark, reports).select(
        F.replace("table", F.lit(suffix)).alias("table"), "mode", F.col("rows").alias("n_rows"), "inserted", "updated",
        "removed", "rejected", F.array_join("defaulted", ", ").alias("defaulted"), "next_identity", "skipped",
    )


@query(_COPIED + """
SELECT o_orderkey, CASE WHEN NOT typed THEN 'o_orderdate' ELSE 'o_custkey' END AS "column",
       CASE WHEN NOT typed THEN 'timestamptz' ELSE 'foreign key' END AS "type",
       CASE WHEN NOT typed THEN 'soon' ELSE '["' || o_custkey || '"]' END AS value
FROM o WHERE NOT typed OR NOT known
""")
def copy_rejects(spark, sf_dir):
    """The rows a copy left out, with the reason: values that do not fit, references without a parent."""
    suffix, base = scratch(spark, "")
    sources = {f"customer{suffix}": loose_customers(spark, sf_dir), f"orders{suffix}": loose_orders(spark, sf_dir)}
    copy_tables(spark, sources, declared(spark, suffix), base, rejects="keep", row_keys={f"orders{suffix}": "_at"})
    return spark.read.parquet(f"{base}/orders{suffix}-rejects").select("o_orderkey", "column", "type", "value")


@query("""
WITH old AS (SELECT * FROM customer WHERE c_custkey % 3 <> 0), new AS (SELECT * FROM customer WHERE c_custkey % 5 <> 0)
SELECT new.c_custkey, new.c_name, new.c_acctbal + 1000 AS c_acctbal, old.c_custkey IS NOT NULL AS vip,
       CASE WHEN old.c_custkey IS NOT NULL THEN 'gold' ELSE 'none' END AS tier
FROM new LEFT JOIN old USING (c_custkey)
""")
def copy_upsert(spark, sf_dir):
    """A copied table mirrored to a source that lacks some of its columns, which keep what they hold."""
    suffix, base = scratch(spark, "")
    name = f"customer{suffix}"
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_acctbal") + 1000)
    customers = customers.withColumnRenamed("(c_acctbal + 1000)", "c_acctbal")
    first = customers.where("c_custkey % 3 <> 0").withColumns({"vip": F.lit("yes"), "tier": F.lit("gold")})
    (target, _) = declared(spark, suffix)
    copy_tables(spark, {name: first}, [target], base)
    copy_tables(spark, {name: customers.where("c_custkey % 5 <> 0")}, [target], base, mode="upsert")
    return latest(spark, name)


# ------------------------------------------------------------------------------- coercion


@query("""
SELECT l_orderkey, [42, 7, NULL, 3, NULL, 1000, 31][l_linenumber] AS spoiled,
       CAST(trunc(l_extendedprice) AS BIGINT) AS price_text,
       CAST(trunc(-l_extendedprice) AS BIGINT) AS price_number,
       CASE WHEN l_discount > 0.05 THEN CAST(1 AS BIGINT) END AS flag
FROM lineitem
""")
def coerce_integer(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        pick("l_linenumber", "42", " 7 ", "", "3.7", "abc", "1e3", "0x1F").alias("spoiled"),
        F.col("l_extendedprice").cast("string").alias("price_text"),
        (-F.col("l_extendedprice")).alias("price_number"),
        (F.col("l_discount") > 0.05).alias("flag"),
    )
    return align.align(rows, typed_as("INT", *rows.columns))


@query("""
SELECT l_orderkey, [42.5, 0.0, NULL, -0.37, NULL, 1000.0, NULL][l_linenumber]::DOUBLE AS spoiled,
       l_extendedprice AS price_text, CAST(l_extendedprice AS DECIMAL(18,1)) AS price_decimal,
       CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END::DOUBLE AS flag
FROM lineitem
""")
def coerce_double(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        pick("l_linenumber", "42.5", "  ", "", "-.37", "1d", "1e3", "Infinity").alias("spoiled"),
        F.col("l_extendedprice").cast("string").alias("price_text"),
        F.col("l_extendedprice").cast("string").alias("price_decimal"),
        (F.col("l_discount") > 0.05).alias("flag"),
    )
    target = typed_as("REAL", "spoiled", "price_text", "flag")
    extra = (Field("l_orderkey", "INT"), Field("price_decimal", "DECIMAL(18,1)"))
    return align.align(rows, Table("lineitem", target.fields + extra))


@query("""
SELECT l_orderkey, [true, false, NULL, NULL, true, false, false][l_linenumber] AS spoiled,
       l_discount <> 0 AS number
FROM lineitem
""")
def coerce_boolean(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        pick("l_linenumber", "yes", " N ", "2", "", "TRUE", "0", "f").alias("spoiled"),
        F.col("l_discount").alias("number"),
    )
    target = typed_as("BOOLEAN", "spoiled", "number")
    return align.align(rows, Table("lineitem", (Field("l_orderkey", "INT"), *target.fields)))


def spoiled_times(spark, sf_dir) -> DataFrame:
    """Event times as epoch seconds, epoch milliseconds or text, and some that are no times."""
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", F.unix_seconds(ts).cast("string"))
        .when(kind == "view", F.unix_millis(ts).cast("string"))
        .when(kind == "error", F.lit(""))
        .when(kind == "signup", F.lit("now"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("at"),
    )


TIMES = """
SELECT event_id, CASE event_type WHEN 'click' THEN date_trunc('second', ts)
  WHEN 'view' THEN make_timestamp(epoch_us(ts) // 1000 * 1000) WHEN 'error' THEN NULL
  WHEN 'signup' THEN NULL ELSE date_trunc('second', ts) END AS happened,
  event_type = 'signup' AS refused
FROM events
"""


@query(f"""
SELECT event_id, strftime(happened, '%Y-%m-%d %H:%M:%S.%f') AS happened, refused FROM ({TIMES})
""")
def coerce_timestamp(spark, sf_dir):
    rows = spoiled_times(spark, sf_dir)
    got = coerce.to_timestamp(F.col("at"), rows.schema["at"].dataType)
    return rows.select("event_id", stamp(got.value).alias("happened"), got.refused.alias("refused"))


@query(f"""
SELECT event_id, strftime(happened, '%Y-%m-%d') AS on_day, refused FROM ({TIMES})
""")
def coerce_date(spark, sf_dir):
    rows = spoiled_times(spark, sf_dir)
    got = coerce.to_date(F.col("at"), rows.schema["at"].dataType)
    return rows.select("event_id", got.value.cast("string").alias("on_day"), got.refused.alias("refused"))


@query("""
SELECT doc_id, md5(text) AS digest, octet_length(encode(text)) AS n_bytes,
       hex(encode(CAST(n_chars AS VARCHAR))) AS number_bytes FROM documents
""")
def coerce_binary(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    data = coerce.to_binary(F.col("text"), rows.schema["text"].dataType).value
    number = coerce.to_binary(F.col("n_chars"), rows.schema["n_chars"].dataType).value
    return rows.select(
        "doc_id",
        F.md5(data).alias("digest"),
        F.octet_length(data).cast("bigint").alias("n_bytes"),
        F.hex(number).alias("number_bytes"),
    )


SPOILED_JSON = """
SELECT event_id, CASE event_type WHEN 'click' THEN '' WHEN 'error' THEN props || '}' ELSE props END AS doc
FROM events
"""


@query(f"""
SELECT event_id, CASE WHEN doc <> '' AND json_valid(doc) THEN doc END AS doc,
       doc <> '' AND NOT json_valid(doc) AS refused
FROM ({SPOILED_JSON})
""")
def coerce_json(spark, sf_dir):
    kind = F.col("event_type")
    rows = read(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", F.lit(""))
        .when(kind == "error", F.concat("props", F.lit("}")))
        .otherwise(F.col("props"))
        .alias("doc"),
    )
    got = coerce.to_json_text(F.col("doc"), rows.schema["doc"].dataType, strict=True)
    return rows.select("event_id", got.value.alias("doc"), got.refused.alias("refused"))


@query("""
SELECT l_orderkey, 'a' || l_returnflag AS flag,
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity,
       CASE WHEN l_extendedprice = trunc(l_extendedprice) THEN CAST(CAST(l_extendedprice AS BIGINT) AS VARCHAR)
            ELSE CAST(l_extendedprice AS VARCHAR) END AS price
FROM lineitem
""")
def coerce_text(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.concat(F.lit("a\u0000"), "l_returnflag").cast("binary").alias("flag"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    return rows.select(
        "l_orderkey",
        *[
            coerce.to_text(F.col(c), rows.schema[c].dataType).value.alias(c)
            for c in ("flag", "quantity", "price")
        ],
    )


# ------------------------------------------------------------------------- declared tables

ORDERS = Table(
    "orders",
    (
        Field("o_orderkey", "INTEGER", not_null=True),
        Field("o_custkey", "INTEGER"),
        Field("o_orderstatus", "VARCHAR(1)"),
        Field("o_totalprice", "REAL"),
        Field("o_orderdate", "DATETIME"),
        Field("is_open", "BOOLEAN"),
    ),
    pk=("o_orderkey",),
)


def dirty_orders(spark, sf_dir) -> DataFrame:
    """Orders as untyped text with the usual dirt, chosen by status and priority."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    at = F.col("o_orderdate").cast("timestamp")
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("o_orderkey"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".9")).alias("o_custkey"),
        F.concat(status, F.lit("\u0000")).alias("o_orderstatus"),
        F.when(priority == "5-LOW", F.lit(""))
        .when(priority == "1-URGENT", F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("o_totalprice"),
        F.when(status == "P", F.unix_millis(at).cast("string"))
        .when(status == "F", F.date_format(at, "dd.MM.yyyy"))
        .otherwise(F.date_format(at, "yyyy-MM-dd HH:mm"))
        .alias("o_orderdate"),
        F.when(status == "F", F.lit("No")).when(status == "O", F.lit("1")).otherwise(F.lit("maybe")).alias("is_open"),
    )


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderpriority NOT IN ('5-LOW', '1-URGENT') THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') END AS o_orderdate,
       CASE o_orderstatus WHEN 'F' THEN false WHEN 'O' THEN true END AS is_open
FROM orders
""")
def typed_load(spark, sf_dir):
    rows = align.align(dirty_orders(spark, sf_dir), ORDERS)
    return rows.withColumn("o_orderdate", stamp(F.col("o_orderdate")))


@query("""
SELECT o_orderkey, 'o_orderdate' AS "column", 'timestamptz' AS "type",
       strftime(o_orderdate, '%d.%m.%Y') AS "value"
FROM orders WHERE o_orderstatus = 'F'
""")
def coerce_rejects(spark, sf_dir):
    _, bad = align.split_rejects(align.align(dirty_orders(spark, sf_dir), ORDERS, with_rejects=True))
    return bad.select("o_orderkey", "column", "type", "value")


@query("""
SELECT c_custkey, c_acctbal, '' AS bio, false AS is_admin, 0 AS score, 1706745600 AS last_seen,
       '2024-02-01 00:00:00.000000' AS created_at, '2024-02-08 00:00:00.000000' AS expires_at,
       true AS has_key
FROM customer
""")
def apply_defaults(spark, sf_dir):
    target = Table(
        "customer",
        (
            Field("c_custkey", "INTEGER"),
            Field("c_acctbal", "REAL", default=1.5),
            Field("bio", "TEXT", default=""),
            Field("is_admin", "BOOLEAN", default=0),
            Field("score", "INTEGER", default=0),
            Field("last_seen", "INTEGER", default=Expr("(strftime('%s','now'))")),
            Field("created_at", "TEXT", default=Expr("(datetime('now'))")),
            Field("expires_at", "DATETIME", default=Expr("(datetime('now', '+7 days'))")),
            Field("api_key", "TEXT", default=Expr("(lower(hex(randomblob(16))))")),
        ),
    )
    rows = align.align(read(spark, sf_dir, "customer"), target, now=NOW)
    return rows.select(
        "c_custkey", "c_acctbal", "bio", "is_admin", "score", "last_seen",
        stamp(F.col("created_at")).alias("created_at"),
        stamp(F.col("expires_at")).alias("expires_at"),
        F.col("api_key").rlike("^[0-9a-f]{32}$").alias("has_key"),
    )


@query("SELECT c_custkey, c_acctbal, c_acctbal * 2 AS doubled FROM customer")
def generated_column(spark, sf_dir):
    target = Table(
        "customer",
        (
            Field("c_custkey", "INTEGER"),
            Field("c_acctbal", "REAL"),
            Field("doubled", "REAL", generated=lambda: F.col("c_acctbal") * 2),
        ),
    )
    source = read(spark, sf_dir, "customer").withColumn("doubled", F.lit("stale"))
    return align.align(source, target)


@query("SELECT c_custkey, c_name, '' AS bio, CAST(3 AS BIGINT) AS tier FROM customer")
def add_column_default(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    rows = align.add_column(rows, Field("bio", "TEXT", default=""))
    return align.add_column(rows, Field("tier", "INTEGER", default=3))


@query("SELECT event_id, event_type FROM events WHERE ts > TIMESTAMP '2024-02-01' - INTERVAL 7 DAY")
def recent_view(spark, sf_dir):
    since = dates.naive(dates.datetime("-7 days", now=NOW))
    recent = read(spark, sf_dir, "events").where(F.col("ts") > since)
    recent.select("event_id", "event_type").createOrReplaceTempView("recent_events")
    return spark.table("recent_events")


@query("""
SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS spent
FROM orders GROUP BY o_custkey
""")
def ctas(spark, sf_dir):
    spent = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)")
    rows = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"), spent.alias("spent")
    )
    name = f"ctas_{uuid.uuid4().hex}"
    rows.write.option("path", delete_at_exit(spark, f"{shared_dir(spark)}/{name}")).saveAsTable(name)
    made = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay for the result
    return made


# --------------------------------------------------------------------------------- filters


@query("SELECT p_partkey, p_type FROM part WHERE p_type ILIKE 'econ%'")
def like_ci(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return part.where(scalars.like(F.col("p_type"), "eCoN%")).select("p_partkey", "p_type")


@query("""
SELECT o_orderkey, o_orderpriority FROM orders
WHERE replace(o_orderpriority, ' ', '_') NOT ILIKE '4-not!_%' ESCAPE '!'
""")
def not_like_escape(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    text = F.replace("o_orderpriority", F.lit(" "), F.lit("_"))
    return orders.where(~scalars.like(text, "4-not!_%", "!")).select("o_orderkey", "o_orderpriority")


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^[a-m].*(ring|et)$')")
def regexp_filter(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return part.where(scalars.regexp(F.col("p_name"), "^[a-m].*(ring|et)$")).select("p_partkey", "p_name")


@query("""
SELECT event_id, user_id FROM events
WHERE ts > TIMESTAMP '2024-01-31' - INTERVAL 20 DAY AND event_type IN ('click', 'view') AND value IS NOT NULL
""")
def recent_filter(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    recent = F.col("ts") > dates.naive(dates.datetime("-20 days", now="2024-01-31 00:00:00"))
    kinds = F.col("event_type").isin("click", "view")
    return events.where(recent & kinds & F.col("value").isNotNull()).select("event_id", "user_id")


@query("""
SELECT event_id FROM events
WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) = 42 AND event_type = 'click'
""")
def json_contains(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    doc = jsons.json_object(F.lit("type"), F.col("event_type"), F.lit("tags"), F.array("event_type"))
    held = jsons.json_contains(F.col("props"), {"k": 42}) & jsons.json_contains(
        doc, {"type": "click", "tags": ["click"]}
    )
    return events.where(held).select("event_id")


# --------------------------------------------------------------------------- joins, ranking


def old_orders(spark, sf_dir) -> DataFrame:
    """The target's state: no pending orders yet."""
    return read(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")


def new_orders(spark, sf_dir) -> DataFrame:
    """The source's state: low priorities purged, prices changed, fewer columns."""
    return read(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'").select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("o_totalprice")
    )


@query("""
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey NOT IN
  (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW')
""")
def stale_rows(spark, sf_dir):
    gone = load.stale_rows(new_orders(spark, sf_dir), old_orders(spark, sf_dir), ["o_orderkey"])
    return gone.select("o_orderkey", "o_orderstatus")


@query("""
SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM orders) WHERE rn <= 3
""")
def topn_per_key(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return paging.top_n_per_key(orders, ["o_custkey"], order, 3)


# ------------------------------------------------------------------------------ aggregates


@query("""
SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ';' ORDER BY o_orderkey) AS all_orders
FROM orders GROUP BY o_custkey
""")
def group_concat(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return grouping.group_concat(
        orders, ["o_custkey"], F.col("o_orderkey"), ["o_orderkey"], ";", "all_orders"
    )


@query("""
WITH p AS (SELECT o_orderpriority, o_orderkey, CAST(o_orderkey AS VARCHAR) AS piece FROM orders),
c AS (SELECT *, greatest(strlen(piece) + 1, 32) AS cost FROM p),
s AS (SELECT *, sum(cost) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - cost AS start FROM c)
SELECT o_orderpriority, CAST(start // 4096 AS BIGINT) AS part, string_agg(piece, ';' ORDER BY o_orderkey) AS all_orders
FROM s GROUP BY 1, 2
""")
def group_concat_parts(spark, sf_dir):
    """The same for few large groups, as parts cut by size."""
    orders = read(spark, sf_dir, "orders")
    return grouping.group_concat_parts(
        orders, ["o_orderpriority"], F.col("o_orderkey"), ["o_orderkey"], ";", "all_orders", part_bytes=4096
    )


@query("""
SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities
FROM orders GROUP BY o_custkey
""")
def group_concat_distinct(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return grouping.group_concat_distinct(
        orders, ["o_custkey"], F.col("o_orderpriority"), ", ", "priorities"
    )


@query("""
SELECT c_mktsegment, CAST(coalesce(sum(CASE WHEN c_acctbal < 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END), 0)
  AS DECIMAL(28,2)) AS debts, CAST(0 AS BIGINT) AS nothing
FROM customer GROUP BY c_mktsegment
""")
def total(spark, sf_dir):
    customer = read(spark, sf_dir, "customer")
    debt = F.when(F.col("c_acctbal") < 0, F.col("c_acctbal").cast("decimal(18,2)"))
    return customer.groupBy("c_mktsegment").agg(
        aggregates.total(debt).cast("decimal(28,2)").alias("debts"),
        aggregates.total(F.lit(None).cast("bigint")).alias("nothing"),
    )


@query("""
SELECT o_custkey, '[' || string_agg(coalesce(CAST(to_json(nullif(o_orderstatus, 'P')) AS VARCHAR), 'null'), ',' ORDER BY o_orderkey) || ']' AS statuses
FROM orders GROUP BY o_custkey
""")
def json_group_array(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    value = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return grouping.json_group_array(orders, ["o_custkey"], value, ["o_orderkey"], "statuses")


@query("""
WITH p AS (SELECT o_orderpriority, o_orderkey, coalesce(CAST(to_json(nullif(o_orderstatus, 'P')) AS VARCHAR), 'null') AS piece FROM orders),
c AS (SELECT *, greatest(strlen(piece) + 1, 32) AS cost FROM p),
s AS (SELECT *, sum(cost) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - cost AS start FROM c)
SELECT o_orderpriority, CAST(start // 8192 AS BIGINT) AS part, '[' || string_agg(piece, ',' ORDER BY o_orderkey) || ']' AS statuses
FROM s GROUP BY 1, 2
""")
def json_group_array_parts(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    value = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return grouping.json_group_array_parts(
        orders, ["o_orderpriority"], value, ["o_orderkey"], "statuses", part_bytes=8192
    )


@query("""
SELECT o_custkey,
       '{' || string_agg('"' || o_orderkey || '":' || coalesce(CAST(to_json(nullif(o_orderstatus, 'P')) AS VARCHAR), 'null'), ',' ORDER BY o_orderkey) || '}' AS statuses
FROM orders GROUP BY o_custkey
""")
def json_group_object(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    value = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return grouping.json_group_object(
        orders, ["o_custkey"], F.col("o_orderkey"), value, ["o_orderkey"], "statuses"
    )


@query("""
SELECT c_mktsegment, max(c_acctbal) AS highest, min(c_acctbal) AS lowest, count(*) AS n
FROM customer GROUP BY c_mktsegment
""")
def min_max_count(spark, sf_dir):
    return read(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(
        F.max("c_acctbal").alias("highest"), F.min("c_acctbal").alias("lowest"), F.count("*").alias("n")
    )


@query("SELECT c_custkey, count(*) OVER () AS n FROM customer")
def count_over(spark, sf_dir):
    return paging.with_total(read(spark, sf_dir, "customer").select("c_custkey"))


# ----------------------------------------------------------------------------------- pages


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def limit_all(spark, sf_dir):
    return paging.limit(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), -1)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def offset_page(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return paging.offset_page(orders, "o_orderkey", 100, 50)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 1000")
def offset_page_deep(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return paging.offset_page(orders, "o_orderkey", 1000, 50, shallow=500)


@query("""
SELECT row_number() OVER (ORDER BY c_name) AS place, c_name FROM (
  SELECT c_name FROM customer ORDER BY c_name LIMIT 40 OFFSET 50)
""")
def offset_page_by_text(spark, sf_dir):
    """A deep page by a text key; the place shows that the rows come in order."""
    page = paging.offset_page(read(spark, sf_dir, "customer").select("c_name"), "c_name", 50, 40, shallow=20)
    return page.coalesce(1).select((F.monotonically_increasing_id() + 1).alias("place"), "c_name")


@query("""
WITH s AS (SELECT o_orderkey AS n, o_orderkey // 1000 AS batch, (o_orderkey + 1) // 2 AS a, o_orderkey // 2 AS b FROM orders),
t AS (SELECT *, n - row_number() OVER (PARTITION BY batch ORDER BY n) AS run FROM s),
u AS (SELECT *, row_number() OVER (PARTITION BY batch, run ORDER BY n) AS i FROM t)
SELECT n, batch, a, b FROM u WHERE i % 2 = 1
""")
def insert_ignore_chain(spark, sf_dir):
    """Orders whose two unique keys overlap with their neighbours' in turn: chains of up to 1,000 links."""
    numbered = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("n"))
    source = numbered.select(
        "n", F.expr("n div 1000").alias("batch"), F.expr("(n + 1) div 2").alias("a"), F.expr("n div 2").alias("b")
    )
    return load.insert_ignore(source, source.where(F.lit(False)), [["batch", "a"], ["batch", "b"]], "n")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 50")
def keyset_page(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return paging.keyset_page(orders, "o_orderkey", 100, 50)


@query("SELECT min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders")
def key_bounds(spark, sf_dir):
    return paging.key_bounds(read(spark, sf_dir, "orders"), "o_orderkey")


# ----------------------------------------------------------------------------------- loads


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def load_if_empty(spark, sf_dir):
    target = old_orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    source = read(spark, sf_dir, "orders").select("o_orderkey", F.lit("X").alias("o_orderstatus"))
    empty = target.where(F.lit(False))
    filled = load.load_if_empty(target, empty)
    return load.load_if_empty(source, filled)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderpriority <> '5-LOW'
""")
def truncate_reload(spark, sf_dir):
    source = new_orders(spark, sf_dir)
    target = old_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")
    return load.truncate_reload(source, target, "orders")


@query("""
SELECT 'customer' AS "table", count(*) AS n_rows, true AS refused FROM customer
UNION ALL SELECT 'orders', count(*), true FROM orders
UNION ALL SELECT 'lineitem', count(*), false FROM lineitem
""")
def truncate_guard(spark, sf_dir):
    children = {"customer": ["orders"], "orders": ["lineitem"], "lineitem": []}
    whole = None
    for table, others in children.items():
        try:
            load.truncate_guard(table, others)
            refused = False
        except load.Referenced:
            refused = True
        one = read(spark, sf_dir, table).agg(
            F.lit(table).alias("table"), F.count("*").alias("n_rows"), F.lit(refused).alias("refused")
        )
        whole = one if whole is None else whole.unionAll(one)
    return whole


@query("""
SELECT s.o_orderkey, s.o_custkey, CASE WHEN s.o_orderstatus <> 'P' THEN s.o_orderstatus ELSE 'N' END AS o_orderstatus,
       s.o_totalprice * 2 AS o_totalprice,
       CASE WHEN s.o_orderstatus <> 'P' THEN s.o_orderpriority END AS o_orderpriority
FROM orders s WHERE s.o_orderpriority <> '5-LOW'
""")
def upsert_mirror(spark, sf_dir):
    target = old_orders(spark, sf_dir).drop("o_orderdate")
    return load.upsert_mirror(
        new_orders(spark, sf_dir), target, ["o_orderkey"], defaults={"o_orderstatus": F.lit("N")}, table="orders"
    )


@query("""
SELECT count(*) FILTER (WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'P') AS inserted,
       count(*) FILTER (WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P') AS updated,
       count(*) FILTER (WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'P') AS removed
FROM orders
""")
def upsert_changes(spark, sf_dir):
    return load.upsert_changes(new_orders(spark, sf_dir), old_orders(spark, sf_dir), ["o_orderkey"])


def first_orders(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Orders offered per customer (no customer on low priorities), and customers already held."""
    source = read(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("custkey"),
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_totalprice").alias("amount"),
    )
    target = read(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("custkey"),
        F.lit(None).cast("bigint").alias("orderkey"),
        F.col("c_acctbal").alias("amount"),
    )
    return source, target


@query("""
WITH held AS (SELECT c_custkey AS custkey, CAST(NULL AS BIGINT) AS orderkey, c_acctbal AS amount
              FROM customer WHERE c_mktsegment = 'BUILDING'),
offered AS (SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS custkey,
                   o_orderkey AS orderkey, o_totalprice AS amount FROM orders),
firsts AS (SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY orderkey) AS rn FROM offered WHERE custkey IS NOT NULL)
SELECT * FROM held
UNION ALL SELECT custkey, orderkey, amount FROM firsts WHERE rn = 1 AND custkey NOT IN (SELECT custkey FROM held)
UNION ALL SELECT * FROM offered WHERE custkey IS NULL
""")
def insert_ignore(spark, sf_dir):
    source, target = first_orders(spark, sf_dir)
    return load.insert_ignore(source, target, [["custkey"]], "orderkey")


def mixed_parts(spark, sf_dir, kind) -> DataFrame:
    """Parts whose names come in upper case for one type; the name is a key without case."""
    name = F.when(F.col("p_type") == "ECONOMY", F.upper("p_name")).otherwise(F.col("p_name")).cast(kind)
    return read(spark, sf_dir, "part").select("p_partkey", name.alias("p_name"), "p_retailprice")


_MIXED = """
WITH p AS (SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN upper(p_name) ELSE p_name END AS p_name, p_retailprice FROM part)
"""


@query(_MIXED + """,
held AS (SELECT * FROM p WHERE p_partkey % 7 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) AS rn FROM p WHERE p_partkey % 7 <> 0)
SELECT p_partkey, p_name, p_retailprice FROM held
UNION ALL SELECT p_partkey, p_name, p_retailprice FROM r WHERE rn = 1 AND lower(p_name) NOT IN (SELECT lower(p_name) FROM held)
""")
def insert_ignore_nocase(spark, sf_dir):
    """Names that differ only in case are one key; each is stored as it came."""
    target = Table("part", (Field("p_partkey", "INTEGER"), Field("p_name", "TEXT", nocase=True), Field("p_retailprice", "REAL")))
    parts = mixed_parts(spark, sf_dir, target.type_of("p_name"))
    got = load.insert_ignore(parts.where("p_partkey % 7 <> 0"), parts.where("p_partkey % 7 = 0"), [["p_name"]], "p_partkey")
    return got.withColumn("p_name", F.col("p_name").cast("string"))


@query(_MIXED + """,
new AS (SELECT lower(p_name) AS k, min(p_name) AS p_name, sum(p_partkey) AS n FROM p WHERE p_partkey % 2 = 0 GROUP BY 1),
old AS (SELECT lower(p_name) AS k, min(p_partkey) AS first_seen FROM p WHERE p_partkey % 3 <> 0 GROUP BY 1)
SELECT new.p_name, CAST(n AS BIGINT) AS n, coalesce(first_seen, -1) AS first_seen FROM new LEFT JOIN old USING (k)
""")
def upsert_nocase(spark, sf_dir):
    """A copy mirrored by a key without case, where the two sides spell their keys differently."""
    suffix, base = scratch(spark, "")
    name = f"part{suffix}"
    table = Table(name, (Field("p_name", "TEXT", nocase=True), Field("n", "INTEGER"), Field("first_seen", "INTEGER", default=-1)), pk=("p_name",))
    parts = mixed_parts(spark, sf_dir, "string")
    old = parts.where("p_partkey % 3 <> 0").groupBy(F.upper("p_name").alias("p_name")).agg(
        F.lit(0).alias("n"), F.min("p_partkey").alias("first_seen"))
    new = parts.where("p_partkey % 2 = 0").groupBy(F.lower("p_name").alias("k")).agg(
        F.min("p_name").alias("p_name"), F.sum("p_partkey").alias("n")).drop("k")
    copy_tables(spark, {name: old}, [table], base)
    copy_tables(spark, {name: new}, [table], base, mode="upsert")
    return latest(spark, name).withColumn("p_name", F.col("p_name").cast("string"))


@query()
def insert_ignore_keys(spark, sf_dir):
    """Two unique keys at once: one line per order and one per part and supplier."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"
    )
    source = lines.distinct().withColumn("seq", F.struct(*lines.columns))
    target = lines.where(F.lit(False))
    return load.insert_ignore(
        source, target, [["l_orderkey"], ["l_partkey", "l_suppkey"]], "seq"
    )


@query("""
WITH t AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'),
s AS (SELECT o_custkey AS c_custkey, o_totalprice AS c_acctbal, nullif(o_orderstatus, 'P') AS c_mktsegment,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
       CASE WHEN t.c_custkey IS NULL THEN 'unknown' ELSE t.c_name END AS c_name,
       CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
       CASE WHEN s.c_custkey IS NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
FROM t FULL JOIN (SELECT * FROM s WHERE rn = 1) s ON t.c_custkey = s.c_custkey
""")
def insert_replace(spark, sf_dir):
    target = read(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )
    source = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("c_mktsegment"),
        "o_orderkey",
    )
    return load.insert_replace(
        source, target, "o_orderkey", pk=["c_custkey"],
        listed=["c_custkey", "c_acctbal", "c_mktsegment"],
        defaults={"c_name": F.lit("unknown")}, table="customer",
    )


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '5-LOW') AS kind, o_orderstatus, o_totalprice FROM orders),
t AS (SELECT o_custkey, kind, min(o_totalprice) AS amount FROM o WHERE o_orderstatus = 'F' GROUP BY ALL),
s AS (SELECT o_custkey, kind, o_totalprice AS amount, o_orderkey FROM o WHERE o_orderstatus <> 'F'),
k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, kind ORDER BY o_orderkey DESC) AS rn FROM s WHERE kind IS NOT NULL)
SELECT coalesce(t.o_custkey, k.o_custkey) AS o_custkey, coalesce(t.kind, k.kind) AS kind,
       coalesce(k.amount, t.amount) AS amount
FROM (SELECT * FROM t WHERE kind IS NOT NULL) t FULL JOIN (SELECT * FROM k WHERE rn = 1) k
  ON t.o_custkey = k.o_custkey AND t.kind = k.kind
UNION ALL SELECT o_custkey, kind, amount FROM t WHERE kind IS NULL
UNION ALL SELECT o_custkey, kind, amount FROM s WHERE kind IS NULL
""")
def insert_replace_unique(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn(
        "kind", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    )
    target = orders.where("o_orderstatus = 'F'").groupBy("o_custkey", "kind").agg(
        F.min("o_totalprice").alias("amount")
    )
    source = orders.where("o_orderstatus <> 'F'").select(
        "o_custkey", "kind", F.col("o_totalprice").alias("amount"), "o_orderkey"
    )
    return load.insert_replace(source, target, "o_orderkey", unique=[["o_custkey", "kind"]])


@query("""
WITH claims AS (
  SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS custkey, 1 AS s FROM orders
  UNION ALL SELECT c_custkey, 0 FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT custkey, count(*) AS n FROM claims WHERE custkey IS NOT NULL
GROUP BY custkey HAVING count(*) > 1 AND max(s) = 1
""")
def insert_abort_conflicts(spark, sf_dir):
    return load.conflicts(*first_orders(spark, sf_dir), ["custkey"])


@query("SELECT CASE WHEN coalesce(max(o_orderkey), 0) > 0 THEN max(o_orderkey) + 1 ELSE 1 END AS next_value FROM orders")
def next_identity(spark, sf_dir):
    return identity.next_identity(read(spark, sf_dir, "orders"), "o_orderkey")


@query("""
WITH r AS (SELECT o_orderkey AS arrival, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS id FROM orders)
SELECT arrival, id FROM r WHERE id IS NOT NULL
UNION ALL SELECT arrival, row_number() OVER (ORDER BY arrival) + (SELECT max(id) FROM r) FROM r WHERE id IS NULL
""")
def assign_identity(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("arrival"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("id"),
    )
    first = identity.next_identity(rows, "id").first()["next_value"]
    return identity.assign_identity(rows, "id", "arrival", first)


@query("""
SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') = 'F' THEN o_totalprice / 2 ELSE o_totalprice END AS o_totalprice
FROM orders
""")
def update_where(spark, sf_dir):
    rows = read(spark, sf_dir, "orders")
    done = F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F"
    return load.update_where(rows, done, {"o_totalprice": F.col("o_totalprice") / 2}).select(
        "o_orderkey", "o_totalprice"
    )


@query("""
SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT coalesce(nullif(o_orderstatus, 'P') = 'F', false)
""")
def delete_where(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return load.delete_where(rows, F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F")


@query(ORACLES["insert_replace"])
def catch_up_stream(spark, sf_dir):
    """The same replacement, read as a stream of several batches with late rows into a published table."""
    name = f"catch_up_{uuid.uuid4().hex}"
    base = delete_at_exit(spark, f"{shared_dir(spark)}/{name}")
    target = read(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )
    publish(target, name, f"{base}/table")
    orders = read(spark, sf_dir, "orders")
    orders.repartition(3, "o_orderkey").write.parquet(f"{base}/inbox")
    arriving = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1)
    changes = arriving.parquet(f"{base}/inbox").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("c_mktsegment"),
        "o_orderkey",
    )
    stream = catch_up(
        changes, name, f"{base}/table", ["c_custkey"], "o_orderkey", f"{base}/checkpoint",
        listed=["c_custkey", "c_acctbal", "c_mktsegment"], defaults={"c_name": F.lit("unknown")}, parts=8,
    )
    stream.awaitTermination()
    return latest(spark, name)


@query("""
WITH t0 AS (SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'),
best AS (SELECT o_custkey, max(o_orderkey) FILTER (o_orderkey % 2 = 0) AS e, max(o_orderkey) FILTER (o_orderkey % 2 = 1) AS o
         FROM orders GROUP BY o_custkey),
t1 AS (SELECT coalesce(c_custkey, o_custkey) AS k, CASE WHEN e IS NULL THEN c_acctbal ELSE
         (SELECT o_totalprice FROM orders WHERE o_orderkey = e) END AS bal, e
       FROM t0 FULL JOIN (SELECT * FROM best WHERE e IS NOT NULL) b ON c_custkey = o_custkey),
t2 AS (SELECT k, bal + 1000 AS bal, e FROM t1 WHERE k % 5 <> 0)
SELECT coalesce(k, o_custkey) AS c_custkey,
       CASE WHEN o IS NOT NULL AND (k IS NULL OR t2.e IS NULL OR o > t2.e)
            THEN (SELECT o_totalprice FROM orders WHERE o_orderkey = o) ELSE bal END AS c_acctbal
FROM t2 FULL JOIN (SELECT * FROM best WHERE o IS NOT NULL) b ON k = o_custkey
""")
def publish_followed(spark, sf_dir):
    """A table that follows a stream, replaced by another writer between two batches of it."""
    name, base = scratch(spark, "followed")
    target = read(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_acctbal")
    publish(target, name, f"{base}/table")
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), "o_orderkey"
    )

    def follow(arriving: DataFrame) -> None:
        arriving.write.mode("append").parquet(f"{base}/inbox")
        changes = spark.readStream.schema(orders.schema).parquet(f"{base}/inbox")
        catch_up(changes, name, f"{base}/table", ["c_custkey"], "o_orderkey", f"{base}/checkpoint", parts=8).awaitTermination()

    follow(orders.where("o_orderkey % 2 = 0"))
    kept = latest(spark, name).where("c_custkey % 5 <> 0").withColumn("c_acctbal", F.col("c_acctbal") + 1000)
    publish(kept, name, f"{base}/table")
    follow(orders.where("o_orderkey % 2 = 1"))
    return latest(spark, name)


# ------------------------------------------------------------------------ dates and times


@query("""
SELECT event_id, strftime(date_trunc('month', ts + INTERVAL 1 MONTH) - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S.%f') AS month_end,
       strftime(ts + INTERVAL 36 HOUR - INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS later
FROM events
""")
def datetime_mods(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    ts = F.col("ts")
    return events.select(
        "event_id",
        stamp(dates.datetime("+1 month", "start of month", "-1 day", now=ts)).alias("month_end"),
        stamp(dates.datetime("36 hours", "-5 minutes", "localtime", now=ts)).alias("later"),
    )


@query("""
SELECT event_id, strftime(ts - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before,
       strftime(date_trunc('year', ts), '%Y-%m-%d') AS year_start
FROM events
""")
def date_mods(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return events.select(
        "event_id",
        dates.date("-1 day", now=F.col("ts")).cast("string").alias("day_before"),
        dates.date("start of year", now=F.col("ts")).cast("string").alias("year_start"),
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate + INTERVAL 1 MONTH, '%Y-%m-%d') AS month_on,
       strftime(o_orderdate + INTERVAL 1 MONTH + INTERVAL 15 DAY, '%Y-%m-%d') AS month_and_half,
       strftime(o_orderdate - INTERVAL 18 MONTH, '%Y-%m-%d') AS year_and_half_ago,
       strftime(o_orderdate + INTERVAL 36 HOUR, '%Y-%m-%d %H:%M') AS day_and_half,
       strftime(date_trunc('day', o_orderdate + INTERVAL 90 SECOND), '%Y-%m-%d %H:%M') AS day_start
FROM orders
""")
def date_modifiers(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")

    def day(*modifiers: str, fmt: str = "%Y-%m-%d") -> Column:
        return dates.strftime(fmt, F.col("o_orderdate"), *modifiers)

    return orders.select(
        "o_orderkey",
        day("+1 month").alias("month_on"),
        day("1.5 months").alias("month_and_half"),
        day("-1.5 year").alias("year_and_half_ago"),
        day("+1.5 days", fmt="%Y-%m-%d %H:%M").alias("day_and_half"),
        day("+90 seconds", "start of day", "utc", fmt="%Y-%m-%d %H:%M").alias("day_start"),
    )


@query("""
SELECT event_id, epoch_us(ts) // 1000000 AS seconds, epoch_us(ts) // 1000000 - 3600 AS hour_before FROM events
""")
def unixepoch(spark, sf_dir):
    return read(spark, sf_dir, "events").select(
        "event_id",
        dates.unixepoch(F.col("ts")).alias("seconds"),
        dates.strftime("%s", F.col("ts"), "-1 hour").alias("hour_before"),
    )


@query("""
SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso,
       strftime(ts, '%Y-%m-%d') AS on_day FROM events
""")
def strftime(spark, sf_dir):
    return read(spark, sf_dir, "events").select(
        "event_id",
        dates.strftime("%Y-%m-%dT%H:%M:%fZ", F.col("ts")).alias("iso"),
        dates.strftime("%Y-%m-%d", F.col("ts")).alias("on_day"),
    )


@query("""
SELECT event_id, strftime(ts, '%j') AS day_of_year, strftime(ts, '%-d') AS day_plain,
       strftime(ts, '%I %p') AS clock, strftime(ts, '%V') AS iso_week,
       strftime(ts, '100% of day %d, o''clock: %H') AS sentence
FROM events
""".replace("100% of", "100%% of"))
def strftime_parts(spark, sf_dir):
    ts = F.col("ts")
    return read(spark, sf_dir, "events").select(
        "event_id",
        dates.strftime("%j", ts).alias("day_of_year"),
        dates.strftime("%e", ts).alias("day_plain"),
        dates.strftime("%I %p", ts).alias("clock"),
        dates.strftime("%W", ts).alias("iso_week"),
        dates.strftime("100%% of day %d, o'clock: %H", ts).alias("sentence"),
    )


@query("SELECT event_id, epoch_us(ts) / 86400000000.0::DOUBLE + 2440587.5::DOUBLE AS jd FROM events")
def julianday(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", dates.julianday(F.col("ts")).alias("jd"))


@query("""
SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso,
       strftime(date_trunc('month', ts) - INTERVAL 1 DAY, '%d/%m') AS month_before,
       epoch_us(ts) // 1000000 + 5400 AS later, epoch_us(ts) / 86400000000.0::DOUBLE + 2440587.5::DOUBLE AS jd,
       json_extract_string(props, '$.k') AS k
FROM events WHERE ts > TIMESTAMP '2024-02-01' - INTERVAL 7 DAY
""")
def sql_functions(spark, sf_dir):
    """The same functions by name in SQL text."""
    sql_names.register(spark)
    read(spark, sf_dir, "events").createOrReplaceTempView("events")
    return spark.sql("""
        SELECT event_id, strftime('%Y-%m-%dT%H:%M:%fZ', ts) AS iso,
               strftime('%d/%m', ts, 'start of month', '-1 day') AS month_before,
               unixepoch(ts, '+1.5 hours') AS later, julianday(ts) AS jd, json_extract(props, '$.k') AS k
        FROM events WHERE ts > datetime('2024-02-01', '-7 days')
    """)


# ------------------------------------------------------------------------------------ JSON


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS none FROM events")
def json_extract(spark, sf_dir):
    return read(spark, sf_dir, "events").select(
        "event_id",
        jsons.json_extract(F.col("props"), "$.k").alias("k"),
        jsons.json_extract(F.col("props"), "$.none").alias("none"),
    )


def nested_document() -> Column:
    """An event as a nested document, built from the row."""
    inner = jsons.json_object(
        F.lit("a key"), F.col("event_type"), F.lit("list"), F.array("user_id", "event_id")
    )
    return F.concat(F.lit('{"meta":'), inner, F.lit("}"))


@query("""
SELECT event_id, event_type AS by_name, CAST(event_id AS VARCHAR) AS second, CAST(NULL AS VARCHAR) AS third,
       '[' || user_id || ',' || event_id || ']' AS whole
FROM events
""")
def json_extract_nested(spark, sf_dir):
    doc = F.col("doc")
    return read(spark, sf_dir, "events").withColumn("doc", nested_document()).select(
        "event_id",
        jsons.json_extract(doc, '$.meta."a key"').alias("by_name"),
        jsons.json_extract(doc, "$.meta.list[1]").alias("second"),
        jsons.json_extract(doc, "$.meta.list[2]").alias("third"),
        jsons.json_extract(doc, "$.meta.list").alias("whole"),
    )


@query("""
SELECT event_id, CAST(2 AS BIGINT) AS n_list, CAST(NULL AS BIGINT) AS n_none,
       len(string_split(event_type, 'i')) AS n_parts
FROM events
""")
def json_array_length(spark, sf_dir):
    doc = F.col("doc")
    parts = F.to_json(F.split("event_type", "i"))
    return read(spark, sf_dir, "events").withColumn("doc", nested_document()).select(
        "event_id",
        jsons.json_array_length(doc, "$.meta.list").cast("bigint").alias("n_list"),
        jsons.json_array_length(doc, "$.meta.none").cast("bigint").alias("n_none"),
        jsons.json_array_length(parts).cast("bigint").alias("n_parts"),
    )


@query("""
SELECT c_custkey, CAST(json_object('name', c_name, 'nation', c_nationkey, 'balance', c_acctbal,
  'segment', nullif(c_mktsegment, 'BUILDING')) AS VARCHAR) AS doc FROM customer
""")
def json_object(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        jsons.json_object(
            F.lit("name"), F.col("c_name"), F.lit("nation"), F.col("c_nationkey"),
            F.lit("balance"), F.col("c_acctbal"),
            F.lit("segment"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
        ).alias("doc"),
    )


@query("""
SELECT c_custkey, CAST(json_array(c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING')) AS VARCHAR) AS doc
FROM customer
""")
def json_array(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        jsons.json_array(
            F.col("c_name"), F.col("c_nationkey"), F.col("c_acctbal"),
            F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
        ).alias("doc"),
    )


# --------------------------------------------------------------------------------- scalars


@query("SELECT c_custkey, hex(encode(c_name)) AS name_hex, hex(encode(CAST(c_nationkey AS VARCHAR))) AS nation_hex FROM customer")
def hex(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        scalars.hex_text(F.col("c_name")).alias("name_hex"),
        scalars.hex_text(F.col("c_nationkey")).alias("nation_hex"),
    )


@query("SELECT c_custkey, true AS id_ok, CAST(40 AS BIGINT) AS blob_bytes FROM customer")
def random_hex_id(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        scalars.random_hex(16).rlike("^[0-9a-f]{32}$").alias("id_ok"),
        F.octet_length(scalars.random_blob(40)).cast("bigint").alias("blob_bytes"),
    )


@query("SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'none') AS status FROM orders")
def ifnull(spark, sf_dir):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return read(spark, sf_dir, "orders").select("o_orderkey", scalars.ifnull(status, F.lit("none")).alias("status"))


@query("SELECT doc_id, CAST(instr(text, 'the') AS BIGINT) AS at FROM documents")
def instr(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(
        "doc_id", scalars.instr(F.col("text"), F.lit("the")).cast("bigint").alias("at")
    )


@query("""
SELECT l_orderkey, greatest(l_discount, l_tax, nullif(l_quantity, 1)) AS largest,
       least(l_discount, l_tax, nullif(l_quantity, 1)) AS smallest FROM lineitem
""")
def scalar_max_min(spark, sf_dir):
    values = (F.col("l_discount"), F.col("l_tax"), F.nullif(F.col("l_quantity"), F.lit(1.0)))
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        scalars.scalar_max(*values).alias("largest"),
        scalars.scalar_min(*values).alias("smallest"),
    )


@query("""
SELECT l_orderkey, CAST(trunc(l_extendedprice) AS BIGINT) AS price, CAST(trunc(-l_discount * 100) AS BIGINT) AS percent
FROM lineitem
""")
def cast_integer(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        scalars.cast_as(F.col("l_extendedprice"), "INTEGER").alias("price"),
        scalars.cast_as(-F.col("l_discount") * 100, "int").alias("percent"),
    )


@query("""
SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) AS key_real, hex(encode(o_orderstatus)) AS status_blob,
       CAST(o_custkey AS VARCHAR) AS cust_text FROM orders
""")
def cast_real(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        scalars.cast_as(F.col("o_orderkey"), "REAL").alias("key_real"),
        F.hex(scalars.cast_as(F.col("o_orderstatus"), "BLOB")).alias("status_blob"),
        scalars.cast_as(F.col("o_custkey"), "TEXT").alias("cust_text"),
    )


# ---------------------------------------------------------------------------------- audits


@query("""
SELECT 'UNIQUE constraint failed: lineitem.l_orderkey, lineitem.l_linenumber' AS message, 'lineitem' AS "table",
       'l_orderkey, l_linenumber' AS columns,
       '["' || l_orderkey || '","' || l_linenumber || '"]' AS key, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def unique_violations(spark, sf_dir):
    return audit.unique_violations(read(spark, sf_dir, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])


@query("""
SELECT 'UNIQUE constraint failed: part.p_name' AS message, 'part' AS "table", 'p_name' AS columns,
       '["' || lower(p_name) || '"]' AS key, count(*) AS n
FROM part GROUP BY lower(p_name) HAVING count(*) > 1
""")
def unique_nocase(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    mixed = F.when(F.col("p_type") == "ECONOMY", F.upper("p_name")).otherwise(F.col("p_name"))
    return audit.unique_violations(part.withColumn("p_name", mixed), "part", ["p_name"], nocase=["p_name"])


@query("""
SELECT 'NOT NULL constraint failed: orders.o_orderstatus' AS message, 'orders' AS "table",
       'o_orderstatus' AS columns, count(*) AS n FROM orders WHERE o_orderstatus = 'P'
""")
def not_null_violations(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P"))
    )
    return audit.not_null_violations(orders, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])


@query("""
SELECT 'FOREIGN KEY constraint failed' AS message, 'orders' AS "table", 'o_custkey' AS columns,
       '["' || o_custkey || '"]' AS key, count(*) AS n
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
GROUP BY o_custkey
""")
def fk_violations(spark, sf_dir):
    parents = read(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return audit.fk_violations(read(spark, sf_dir, "orders"), "orders", ["o_custkey"], parents, ["c_custkey"])


@query("""
WITH turns AS (SELECT conv_id, turn, CASE WHEN turn > 0 THEN turn - 1 END AS reply_to FROM conversations WHERE role <> 'system')
SELECT 'FOREIGN KEY constraint failed' AS message, 'turns' AS "table", 'conv_id, reply_to' AS columns,
       '["' || c.conv_id || '","' || c.reply_to || '"]' AS key, count(*) AS n
FROM turns c LEFT JOIN turns p ON p.conv_id = c.conv_id AND p.turn = c.reply_to
WHERE c.reply_to IS NOT NULL AND p.turn IS NULL GROUP BY c.conv_id, c.reply_to
""")
def fk_self(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").where("role <> 'system'").select(
        "conv_id", "turn", F.when(F.col("turn") > 0, F.col("turn") - 1).alias("reply_to")
    )
    return audit.fk_violations(turns, "turns", ["conv_id", "reply_to"], turns, ["conv_id", "turn"])


@query("""
SELECT 'CHECK constraint failed: price_floor' AS message, 'orders' AS "table", 'price_floor' AS columns, count(*) AS n
FROM orders WHERE NOT coalesce(nullif(o_totalprice, 0) > 50000, true)
""")
def check_violations(spark, sf_dir):
    checks = {
        "price_floor": F.nullif(F.col("o_totalprice"), F.lit(0.0)) > 50000,
        "known_status": F.col("o_orderstatus").isin("F", "O", "P"),
    }
    return audit.check_violations(read(spark, sf_dir, "orders"), "orders", checks)


@query("""
SELECT 'CHECK constraint failed: open_flag' AS message, 'orders' AS "table", 'open_flag' AS columns, count(*) AS n
FROM orders WHERE o_orderstatus = 'P'
""")
def check_boolean(spark, sf_dir):
    """That a column is 0 or 1 is not asked of one that has become a boolean, but still of a number."""
    status = F.col("o_orderstatus")
    source = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(status == "F", "yes").otherwise("no").alias("done"),
        F.when(status == "O", 1).when(status == "P", 2).otherwise(0).alias("is_open"),
    )
    table = Table("orders", (Field("o_orderkey", "INTEGER"), Field("done", "BOOLEAN"), Field("is_open", "INTEGER")),
                  checks={"done_flag": "done in (0, 1)", "open_flag": "is_open in (0, 1)"})
    return audit.audit(align.align(source, table), table, {})


@query("""
SELECT 'customer' AS "table", (SELECT count(*) FROM customer) AS source, (SELECT count(*) FROM customer) AS target, true AS ok
UNION ALL SELECT 'orders', count(*), count(*) FILTER (WHERE o_orderstatus <> 'P'), false FROM orders
UNION ALL SELECT 'lineitem', count(*), count(*), true FROM lineitem
UNION ALL SELECT 'events', count(*), NULL, false FROM events
""")
def verify_counts(spark, sf_dir):
    source = {n: read(spark, sf_dir, n) for n in ("customer", "orders", "lineitem", "events")}
    target = {"customer": source["customer"], "lineitem": source["lineitem"], "orders": old_orders(spark, sf_dir)}
    return audit.verify_counts(source, target)


# ---------------------------------------------------------------------------------- search

WORDS = "list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"


def worded(spark, sf_dir) -> DataFrame:
    return search.add_search_column(read(spark, sf_dir, "documents").select("doc_id", "text"), "text")


def kept(spark, sf_dir, name: str, build: Callable[[], DataFrame], cluster_by: list[str]) -> DataFrame:
    """A published table made from the documents, made anew only when their files have changed.

    An index is there to be built once and asked often.
    """
    path = f"{sf_dir.rstrip('/')}/documents.parquet"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
    version = hashlib.md5(f"{path} {status.getModificationTime()} {status.getLen()}".encode()).hexdigest()
    table = f"{name}_{version}"
    if not spark.catalog.tableExists(table):
        base = delete_at_exit(spark, f"{shared_dir(spark)}/{table}_{uuid.uuid4().hex}")
        # Ranges come from a sample, which would make the rows once more.
        rows = stored(build(), name, UNEVEN_ROWS)
        publish(rows, table, base, cluster_by=cluster_by, options=UNEVEN_ROWS)
    return latest(spark, table)


def stored_index(spark, sf_dir) -> DataFrame:
    """The documents' posting lists, published in the order of their words."""
    return kept(spark, sf_dir, "postings", lambda: search.inverted_index(worded(spark, sf_dir), "doc_id"), ["term", "block"])


def stored_places(spark, sf_dir) -> DataFrame:
    """The same with the places of the words."""
    return kept(spark, sf_dir, "places", lambda: search.positional_index(worded(spark, sf_dir), "doc_id"), ["term", "block"])


@query(f"""
SELECT doc_id, len({WORDS}) AS n_words, md5(array_to_string({WORDS}, ' ')) AS digest FROM documents
""")
def search_terms(spark, sf_dir):
    return worded(spark, sf_dir).select(
        "doc_id",
        F.size("search").cast("bigint").alias("n_words"),
        F.md5(F.array_join("search", " ")).alias("digest"),
    )


@query(f"""
SELECT term, doc_id // 65536 AS block, count(*) AS n,
       md5(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id)) AS digest
FROM (SELECT doc_id, unnest(list_distinct({WORDS})) AS term FROM documents) GROUP BY 1, 2
""")
def inverted_index(spark, sf_dir):
    index = search.inverted_index(worded(spark, sf_dir), "doc_id")
    digest = F.md5(F.array_join(F.col("ids").cast("array<string>"), ","))
    return index.select("term", "block", F.col("n").cast("bigint").alias("n"), digest.alias("digest"))


@query(f"""
SELECT doc_id FROM documents WHERE list_contains({WORDS}, 'the') AND list_contains({WORDS}, 'of')
""")
def search_and(spark, sf_dir):
    return search.search(worded(spark, sf_dir), "the of").select("doc_id")


@query(f"""
SELECT doc_id FROM documents WHERE list_contains({WORDS}, 'the') AND NOT list_contains({WORDS}, 'with')
""")
def search_not(spark, sf_dir):
    return search.search(worded(spark, sf_dir), "the -with").select("doc_id")


@query(f"""
SELECT doc_id FROM documents WHERE contains(' ' || array_to_string({WORDS}, ' ') || ' ', ' of the ')
  OR (list_contains({WORDS}, 'der') AND list_contains({WORDS}, 'und'))
""")
def search_phrase_or(spark, sf_dir):
    return search.search(worded(spark, sf_dir), '"of the" or der und').select("doc_id")


@query(f"""
SELECT doc_id FROM documents WHERE list_contains({WORDS}, 'the') AND list_contains({WORDS}, 'of')
""")
def search_by_index(spark, sf_dir):
    return search.index_lookup(stored_index(spark, sf_dir), ["the", "of"], "doc_id")


@query(f"""
SELECT doc_id FROM documents WHERE (contains(' ' || array_to_string({WORDS}, ' ') || ' ', ' of the ')
    AND NOT list_contains({WORDS}, 'with')) OR (list_contains({WORDS}, 'der') AND list_contains({WORDS}, 'und'))
""")
def search_phrase_by_index(spark, sf_dir):
    """Phrases and unwanted words from the places in the index; no text is read."""
    return search.index_matches(stored_places(spark, sf_dir), '"of the" -with or der und', "doc_id")


@query(f"""
SELECT term, doc_id // 4096 AS block, count(DISTINCT doc_id) AS n, max(tf) AS top, md5(string_agg(doc_id || ':' || place, ',' ORDER BY doc_id, place)) AS digest
FROM (SELECT doc_id, term, place, count(*) OVER (PARTITION BY doc_id, term) AS tf FROM (
  SELECT doc_id, unnest(words) AS term, unnest(range(len(words))) AS place FROM (SELECT doc_id, {WORDS} AS words FROM documents)))
GROUP BY 1, 2
""")
def positional_index(spark, sf_dir):
    index = search.positional_index(worded(spark, sf_dir), "doc_id")
    texts = F.transform("hits", lambda h: F.concat_ws(":", h["id"], h["at"]))
    return index.select("term", "block", F.col("n").cast("bigint").alias("n"), F.col("top").cast("bigint").alias("top"),
                        F.md5(F.array_join(texts, ",")).alias("digest"))


@query(f"""
SELECT doc_id, len(list_filter({WORDS}, lambda w: w IN ('of', 'the'))) AS "rank" FROM documents
WHERE contains(' ' || array_to_string({WORDS}, ' ') || ' ', ' of the ') ORDER BY 2 DESC, 1 LIMIT 100
""")
def search_rank_by_index(spark, sf_dir):
    """The hundred best of a phrase from the index; blocks that cannot reach them are not read."""
    return search.index_ranked(stored_places(spark, sf_dir), '"of the"', "doc_id", limit=100)


@query(f"""
SELECT doc_id, len(list_filter({WORDS}, lambda w: w IN ('the', 'of'))) AS "rank"
FROM documents WHERE list_contains({WORDS}, 'the') AND list_contains({WORDS}, 'of')
ORDER BY 2 DESC, 1 LIMIT 100
""")
def search_rank(spark, sf_dir):
    found = worded(spark, sf_dir).drop("text")
    return search.ranked(found, "the of", "doc_id", limit=100).select("doc_id", "rank")


@query(f"""
WITH hits AS (
  SELECT doc_id, word, place FROM (
    SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place
    FROM (SELECT doc_id, {WORDS} AS words FROM documents))
  WHERE word IN ('the', 'of')),
seen AS (
  SELECT doc_id, place, row_number() OVER d AS nth,
    max(CASE WHEN word = 'the' THEN place END) OVER d AS the_place,
    max(CASE WHEN word = 'of' THEN place END) OVER d AS of_place,
    max(place) OVER (PARTITION BY doc_id, word ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM hits WINDOW d AS (PARTITION BY doc_id ORDER BY place)),
covers AS (
  SELECT s.doc_id, 0.1::DOUBLE / (1 + (s.place - f.place) - (s.nth - f.nth)) AS gain
  FROM seen s JOIN seen f ON f.doc_id = s.doc_id AND f.place = least(s.the_place, s.of_place)
  WHERE s.the_place IS NOT NULL AND s.of_place IS NOT NULL AND (s.before IS NULL OR s.before < f.place))
SELECT doc_id, round(sum(gain), 6) AS "rank" FROM covers GROUP BY doc_id
""")
def search_cover_rank(spark, sf_dir):
    found = search.scored(worded(spark, sf_dir), "the of", method="cover")
    return found.select("doc_id", F.round("rank", 6).alias("rank"))


# --------------------------------------------------------------------------------- results


@query("""
SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS ts,
       strftime(ts, '%Y-%m-%d') AS on_day, value FROM events
""")
def present_iso(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return present(events.select("event_id", "ts", F.col("ts").cast("date").alias("on_day"), "value"))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       o_orderstatus, o_orderdate FROM orders
""")
def present_string_ints(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        "o_orderstatus", "o_orderdate",
    )
    return present(orders, int_mode="string", timestamps="date")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000.0 AND o_orderpriority = '1-URGENT'")
def param_positional(spark, sf_dir):
    read(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > ? AND o_orderpriority = ?",
        args=[100000.0, "1-URGENT"],
    )


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 1000 AND 90000")
def param_named(spark, sf_dir):
    read(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM orders "
        "WHERE o_orderstatus = :status AND o_totalprice BETWEEN :low AND :high",
        args={"status": "F", "low": 1000, "high": 90000},
    )
