"""The registered queries of the table operators, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import convert
from .operators import metadata as meta
from .operators import packages, slices
from .operators.metadata import Table
from .plans.datafn import DataFunction, Input, Output
from .types import DATETIME, INTEGER, LONG, NAMES, REAL, SINGLE, STRING, convertible, of_field, policy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, inputs: list[Input], script: str, output: str) -> DataFrame:
    result = DataFunction(inputs, [Output(output)], script).run(spark)
    if not result.success:
        raise RuntimeError(result.summary)
    return result.tables[output].df


_TYPE_CASE = """CASE data_type WHEN 'BOOLEAN' THEN 'Boolean' WHEN 'INTEGER' THEN 'Integer' WHEN 'BIGINT' THEN 'LongInteger' WHEN 'FLOAT' THEN 'SingleReal'
WHEN 'DOUBLE' THEN 'Real' WHEN 'DATE' THEN 'Date' WHEN 'BLOB' THEN 'Binary' WHEN 'VARCHAR' THEN 'String' WHEN 'INTERVAL' THEN 'TimeSpan' WHEN 'TIME' THEN 'Time' ELSE 'DateTime' END"""


@query(f"SELECT table_name AS table_name, column_name AS column_name, {_TYPE_CASE} AS type FROM information_schema.columns WHERE table_name IN ('lineitem', 'events')")
def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for name in ("lineitem", "events"):
        rows += [F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), F.lit(t).alias("type")) for c, t in meta.get_types(_read(spark, sf_dir, name)).items()]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query("""SELECT bool_or(NOT (o_orderkey * 100000 > -2147483648 AND o_orderkey * 100000 < 2147483647)) AS wide_promoted,
  bool_or(NOT (o_custkey > -2147483648 AND o_custkey < 2147483647)) AS narrow_promoted FROM orders""")
def declared_int_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    import warnings

    orders = _read(spark, sf_dir, "orders").select((F.col("o_orderkey") * 100_000).alias("wide"), F.col("o_custkey").alias("narrow"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        decided = policy(orders, {"wide": INTEGER, "narrow": INTEGER})
    return spark.range(1).select(*(F.lit(decided.types[c] == LONG).alias(f"{c}_promoted") for c in ("wide", "narrow")))


def _converted(df: DataFrame, **want: str) -> DataFrame:
    """Columns converted to the wanted types, the others as they are."""
    return df.select(*(convert.convert(F.col(f.name), of_field(f), want[f.name], f.dataType).alias(f.name) if f.name in want else F.col(f.name) for f in df.schema.fields))


@query("SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice FROM lineitem")
def real_to_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), l_extendedprice=INTEGER)


@query("SELECT l_orderkey, l_linenumber, l_linenumber - 1 <> 0 AS later FROM lineitem")
def integer_to_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") - 1).alias("later")), later="Boolean")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN false ELSE length(o_orderpriority) > 0 END AS has_text FROM orders")
def string_to_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderpriority"))
    return _converted(_read(spark, sf_dir, "orders").select("o_orderkey", text.alias("has_text")), has_text="Boolean")


@query("SELECT p_partkey, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part")
def real_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_read(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), p_retailprice=STRING)


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN 'True' ELSE 'False' END AS toxic FROM labels")
def boolean_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_read(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("toxic")), toxic=STRING)


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') END AS ts FROM events""")
def datetime_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_read(spark, sf_dir, "events").select("event_id", "ts"), ts=STRING)


@query("SELECT event_id, CAST(value AS FLOAT) AS value FROM events")
def real_to_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_read(spark, sf_dir, "events").select("event_id", "value"), value=SINGLE)


@query("SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS DOUBLE) AS as_real FROM lineitem")
def integer_to_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("as_real")), as_real=REAL)


@query("SELECT event_id, epoch_us(ts) // 1000 + 62135596800000 AS ms FROM events")
def datetime_to_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select("event_id", convert.datetime_ms(F.col("ts")).alias("ms"))


@query("SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts FROM events")
def datetime_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(_read(spark, sf_dir, "events").select("event_id", "ts"), ts=DATETIME)


@query("SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts FROM events")
def ms_to_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select("event_id", convert.ms_datetime(convert.datetime_ms(F.col("ts"))).alias("ts"))


@query("SELECT o_orderkey, date_diff('day', DATE '0001-01-01', CAST(o_orderdate AS DATE)) * 86400000 AS ms FROM orders")
def date_to_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select("o_orderkey", convert.date_ms(F.col("o_orderdate")).alias("ms"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def ms_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select("o_orderkey", convert.ms_date(convert.date_ms(F.col("o_orderdate"))).alias("day"))


@query("SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000 AS ms FROM events WHERE ts >= TIMESTAMP '2024-01-01'")
def timespan_to_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return _read(spark, sf_dir, "events").where(F.col("ts") >= start).select("event_id", convert.timespan_ms(F.col("ts") - start).alias("ms"))


@query("SELECT s AS slice, s * 9090 AS first_row, least(9090, total - s * 9090) AS n_rows FROM (SELECT total, unnest(range(0, (total + 9089) // 9090)) AS s FROM (SELECT count(*) AS total FROM lineitem))")
def slice_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.slice_plan(_read(spark, sf_dir, "lineitem"))


_ENCODED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query(f"""SELECT table_name AS table_name, column_name AS "column", type, CASE type WHEN 'Boolean' THEN 'bit array' WHEN 'Binary' THEN 'plain' ELSE 'run length' END AS encoding
FROM (SELECT table_name, column_name, {_TYPE_CASE} AS type FROM information_schema.columns WHERE table_name IN {_ENCODED})""")
def encoding_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [F.struct(F.lit(t).alias("table_name"), F.lit(f.name).alias("column"), F.lit(of_field(f)).alias("type"), F.lit(slices.encoding(of_field(f))).alias("encoding")) for t in _ENCODED for f in _read(spark, sf_dir, t).schema.fields]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query("""SELECT 'event_id' AS "column", 0 AS n_invalid, false AS has_mask UNION ALL
SELECT 'user_id', count(*) FILTER (user_id % 7 = 0), count(*) FILTER (user_id % 7 = 0) > 0 FROM events UNION ALL
SELECT 'value', count(*) FILTER (event_type = 'click'), count(*) FILTER (event_type = 'click') > 0 FROM events""")
def invalid_mask_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "click", F.lit(float("nan"))).otherwise(F.col("value"))
    return slices.invalid_counts(events.select("event_id", F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"), value.alias("value")))


@query("SELECT r_regionkey FROM region")
def column_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, [Input("in1", "column", _read(spark, sf_dir, "region"))], "out1 = in1", "out1")


@query("SELECT n_name AS out1 FROM nation ORDER BY n_name LIMIT 1")
def value_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, [Input("in1", "value", _read(spark, sf_dir, "nation").select("n_name"), order=("n_name",))], "out1 = in1", "out1")


@query("SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, user_id, event_type, value, props FROM events")
def roundtrip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    from .plans.steps import folder
    from .sources.store import read_table, write_table

    path = f"{folder(spark)}/stores/{uuid.uuid4().hex}"
    write_table(_read(spark, sf_dir, "events"), path)
    return read_table(spark, path).df


@query("SELECT l_orderkey, l_linenumber, l_quantity + 3 AS l_quantity FROM lineitem")
def datafn_simple_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    script = "from pyspark.sql import functions as F\nout1 = in1.withColumn('l_quantity', F.col('l_quantity') + in2)"
    return _run(spark, [Input("in1", "table", lineitem), Input("in2", "value", spark.range(1).select(F.lit(3).alias("v")))], script, "out1")


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS sum_qty, count(*) AS n FROM lineitem GROUP BY ALL""")
def hosted_group_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An example of what a hosted script does; no operator of its own."""
    script = "from pyspark.sql import functions as F\nout1 = in1.groupBy('l_returnflag', 'l_linestatus').agg(F.sum('l_quantity').cast('bigint').alias('sum_qty'), F.count('*').alias('n'))"
    return _run(spark, [Input("in1", "table", _read(spark, sf_dir, "lineitem"))], script, "out1")


@query("""SELECT n_name, count(*) AS n_orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def hosted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An example of what a hosted script does; no operator of its own."""
    script = (
        "from pyspark.sql import functions as F\n"
        "spent = orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, F.col('c_nationkey') == F.col('n_nationkey'))\n"
        "out1 = spent.groupBy('n_name').agg(F.count('*').alias('n_orders'), F.sum(F.round(F.col('o_totalprice') * 100).cast('bigint')).alias('cents'))"
    )
    return _run(spark, [Input(t, "table", _read(spark, sf_dir, t)) for t in ("orders", "customer", "nation")], script, "out1")


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 3""")
def hosted_top_of_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An example of what a hosted script does; no operator of its own."""
    script = (
        "from pyspark.sql import Window, functions as F\n"
        "w = Window.partitionBy('l_suppkey').orderBy(F.desc('l_extendedprice'), 'l_orderkey', 'l_linenumber')\n"
        "out1 = in1.withColumn('n', F.row_number().over(w)).where('n <= 3').select('l_orderkey', 'l_linenumber', 'l_extendedprice')"
    )
    return _run(spark, [Input("in1", "table", _read(spark, sf_dir, "lineitem"))], script, "out1")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0) INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def hosted_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An example of what a hosted script does; no operator of its own."""
    script = (
        "idle = customer.select('c_custkey').join(orders.where('o_orderkey % 3 = 0').selectExpr('o_custkey as c_custkey'), 'c_custkey', 'left_anti')\n"
        "out1 = idle.intersect(customer.where('c_acctbal > 0').select('c_custkey'))"
    )
    return _run(spark, [Input(t, "table", _read(spark, sf_dir, t)) for t in ("customer", "orders")], script, "out1")


@query("""WITH names AS (SELECT unnest(['Boolean', 'Integer', 'LongInteger', 'SingleReal', 'Real', 'DateTime', 'Date', 'Time', 'TimeSpan', 'String', 'Binary', 'Currency']) AS name)
SELECT h.name AS have, w.name AS want, w.name IN ('Boolean', 'String') OR h.name = w.name OR (h.name IN ('Boolean', 'Integer', 'LongInteger', 'SingleReal', 'Real') AND w.name IN ('Boolean', 'Integer', 'LongInteger', 'SingleReal', 'Real')) AS legal
FROM names h CROSS JOIN names w""")
def conversion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("have"), F.lit(w).alias("want"), F.lit(convertible(h, w) or h == w).alias("legal")) for h in NAMES for w in NAMES]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query("SELECT 'l_orderkey' AS column_name, 'LongInteger' AS type, 'key of the order' AS note UNION ALL SELECT 'l_quantity', 'SingleReal', NULL")
def metadata_copied(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = meta.with_column_metadata(_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), "l_orderkey", {"note": "key of the order"})
    source = meta.set_types(source, {"l_quantity": "SingleReal"})
    derived = source.select((F.col("l_orderkey") + 0).alias("l_orderkey"), (F.col("l_quantity") * 1).alias("l_quantity"))
    back = meta.copy_metadata(Table(source, {"origin": ["lineitem"]}), Table(derived)).df
    types = policy(back, meta.declared(back)).types
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("type"), F.lit((meta.column_metadata(back, c).get("note") or [None])[0]).cast("string").alias("note")) for c in back.columns]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


_REPORT = """table metadata:
 {'origin': ['region']}
column metadata:
 r_name: {'note': ['name']}
 (columns without metadata are left out)"""


@query(f"SELECT '{_REPORT.replace("'", "''")}' AS report")
def metadata_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = meta.with_column_metadata(_read(spark, sf_dir, "region"), "r_name", {"note": "name"})
    return spark.range(1).select(F.lit(meta.metadata_report(Table(df, {"origin": ["region"]}))).alias("report"))


@query("""WITH RECURSIVE edges AS (SELECT DISTINCT 'p' || p_partkey AS name, 'p' || (p_partkey * 2) AS needs FROM part UNION SELECT 'p' || p_partkey, 'p' || (p_partkey + 7) FROM part WHERE p_partkey % 5 = 0),
seen AS (SELECT 'p1' AS name UNION SELECT needs FROM seen JOIN edges USING (name)) SELECT name FROM seen""")
def dependency_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    part = _read(spark, sf_dir, "part")
    name = lambda c: F.concat(F.lit("p"), c.cast("string"))
    edges = part.select(name(k).alias("name"), name(k * 2).alias("needs")).union(part.where(k % 5 == 0).select(name(k), name(k + 7)))
    return packages.closure(edges, spark.range(1).select(F.lit("p1").alias("name")))


@query("SELECT 'p' || (p_partkey % 700) AS name, p_brand AS version FROM part WHERE p_partkey % 700 NOT IN (SELECT p_partkey % 700 FROM part WHERE p_size = 50)")
def deny_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("p"), (F.col("p_partkey") % 700).cast("string"))
    part = _read(spark, sf_dir, "part").select(name.alias("name"), F.col("p_brand").alias("version"), "p_size")
    return packages.without(part.select("name", "version"), part.where("p_size = 50").select("name").distinct())


@query("""SELECT name, o.version AS old_version, n.version AS new_version, CASE WHEN o.version IS NULL THEN 'added' WHEN n.version IS NULL THEN 'removed'
WHEN o.minor < n.minor THEN 'upgraded' WHEN o.minor > n.minor THEN 'downgraded' ELSE 'same' END AS change
FROM (SELECT 's' || s_suppkey AS name, s_suppkey % 11 AS minor, '1.' || (s_suppkey % 11) AS version FROM supplier WHERE s_suppkey % 3 <> 0) o
FULL JOIN (SELECT 's' || s_suppkey AS name, s_suppkey % 13 AS minor, '1.' || (s_suppkey % 13) AS version FROM supplier WHERE s_suppkey % 4 <> 0) n USING (name)""")
def version_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    supplier = _read(spark, sf_dir, "supplier")
    listed = lambda by, of: supplier.where(k % by != 0).select(F.concat(F.lit("s"), k.cast("string")).alias("name"), F.concat(F.lit("1."), (k % of).cast("string")).alias("version"))
    return packages.compare(listed(3, 11), listed(4, 13))


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n FROM events GROUP BY ALL")
def streamed_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files, counted by day and type; the stream ends when its input does."""
    import uuid

    from .plans.steps import folder
    from .streaming.tables import windowed_counts, write_latest

    path = f"{folder(spark)}/streams/{uuid.uuid4().hex}"
    schema = _read(spark, sf_dir, "events").schema
    # a folder's files are a stream; a single file is matched by name within its folder
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir) if _single(spark, f"{sf_dir}/events.parquet") else spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet")
    counts = windowed_counts(source, "ts", "1 day", "1 hour", "event_type")
    write_latest(counts, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/data")


def _single(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The script host over ``lineitem``: source, type policy, script and typed output."""
    return datafn_simple_math(spark, sf_dir)


from . import queries_objects as _objects  # noqa: E402, F401  registers its queries here
