"""Registered queries, and the DuckDB SQL that states what each must return.

Every query reads the whole of its tables. Those that load or write first export
what they need from the given tables into a new scratch folder with Spark.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom.functions import (  # noqa: E402
    basename,
    failure_report,
    first_chars,
    join_fields,
    shifted_time,
)
from tallyloom.operators import (  # noqa: E402
    Constraints,
    count_outcomes,
    count_violations,
    latest_per_key,
    null_rules,
    observed_metrics,
    row_count_rules,
    scalar_rule,
    tally,
)
from tallyloom.plans import (  # noqa: E402
    create_keyed_table,
    create_schema,
    create_table,
    create_table_as,
    drop_table,
    insert_into,
    load,
    load_fact_and_dimension,
    local_extract,
    refresh,
    tally_landed,
    truncate_table,
)
from tallyloom.session import scratch_dir  # noqa: E402
from tallyloom.sinks import land_exact, land_raw, write_csv  # noqa: E402
from tallyloom.sources import (  # noqa: E402
    find_file,
    infer_schema,
    list_files,
    name_for_sql,
    read_csv,
    read_files,
    read_landed,
    read_landed_csv,
    read_landing_files,
    table_columns,
)

# The training-data operators and their pipeline are there or not as a whole.
try:
    import corpus_pipeline as _pipeline
    from tallyloom.llm import queries as _llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tallyloom.llm", "tallyloom.llm.queries"):
        raise
    _pipeline = _llm = None

# The medal tally's shape on lineitem and supplier.
FLAGS = {
    "on": "noc",
    "group": "sport",
    "outcome": "medal",
    "outcomes": {"gold": "A", "silver": "R", "bronze": "X"},
    "not_value": "N",
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("sport"),
        F.col("l_suppkey").alias("noc"),
        F.col("l_returnflag").alias("medal"),
    )


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("noc"))


def _export(df: DataFrame, name: str, **options: object) -> str:
    """Write ``df`` as CSV into a new scratch folder."""
    path = scratch_dir(df.sparkSession, name)
    write_csv(df, path, **options)
    return path


def _schema(spark: SparkSession, name: str) -> str:
    """A new catalog schema in a scratch folder."""
    path = scratch_dir(spark, name)
    schema = path.rpartition("/")[2].replace("-", "_")
    create_schema(spark, schema, path)
    return schema


def _table_like(df: DataFrame, table: str) -> None:
    create_table(df.sparkSession, table, {f.name: f.dataType.simpleString() for f in df.schema})


# --- tallies ---------------------------------------------------------------


def tally_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally(_fact(spark, sf_dir), _dim(spark, sf_dir), **FLAGS, key_value=7)


def tally_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    name_for_sql({"tally_fact": _fact(spark, sf_dir), "tally_dim": _dim(spark, sf_dir)})
    return spark.sql(
        """
        SELECT /*+ BROADCAST(d) */ f.sport,
               sum(CASE WHEN f.medal = 'A' THEN d.copies ELSE 0 END) AS gold,
               sum(CASE WHEN f.medal = 'R' THEN d.copies ELSE 0 END) AS silver,
               sum(CASE WHEN f.medal = 'X' THEN d.copies ELSE 0 END) AS bronze,
               sum(CASE WHEN f.medal <> 'N' THEN d.copies ELSE 0 END) AS total
        FROM tally_fact AS f
        JOIN (SELECT noc, count(*) AS copies FROM tally_dim WHERE noc = 7 GROUP BY noc) AS d
          ON d.noc = f.noc
        GROUP BY 1
        """
    )


def tally_null_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _read(spark, sf_dir, "events").select(
        "user_id", F.expr("nullif(event_type, 'click')").alias("event_type")
    )
    dim = _read(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("sport")
    )
    return tally(
        fact,
        dim,
        on=("user_id", "c_custkey"),
        group="sport",
        outcome="event_type",
        outcomes={"gold": "purchase", "silver": "signup", "unknown": None},
        not_value="error",
    )


def tally_duplicate_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _read(spark, sf_dir, "supplier")
    again = supplier.where(F.col("s_acctbal") > 0)
    dim = supplier.unionByName(again).select(F.col("s_suppkey").alias("noc"))
    return tally(_fact(spark, sf_dir), dim, **FLAGS)


def tally_large_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way a dimension takes that is too large to broadcast, whatever its size here."""
    fact = _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("noc"),
        F.col("l_linenumber").alias("sport"),
        F.col("l_returnflag").alias("medal"),
    )
    dim = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("noc"))
    return tally(fact, dim, **FLAGS, broadcast_bytes=0)


def tally_selective_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffled way, for a dimension with a fifth of the fact's keys."""
    fact = _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("noc"),
        F.col("l_linenumber").alias("sport"),
        F.col("l_returnflag").alias("medal"),
    )
    orders = _read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    dim = orders.select(F.col("o_orderkey").alias("noc"))
    return tally(fact, dim, **FLAGS, broadcast_bytes=0, prefilter=True)


def _hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which a third have one user."""
    return _read(spark, sf_dir, "events").select(
        F.expr("CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END").alias("noc"),
        F.length("props").alias("sport"),
        F.col("event_type").alias("medal"),
    )


EVENTS = {
    "on": "noc",
    "group": "sport",
    "outcome": "medal",
    "outcomes": {"gold": "purchase", "silver": "signup"},
    "not_value": "error",
}


def tally_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffled way, with a key that a third of the rows share."""
    dim = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("noc"))
    return tally(_hot_events(spark, sf_dir), dim, **EVENTS, broadcast_bytes=0)


def tally_hot_key_dim_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffled way, grouped by the dimension, whose key is of another type."""
    dim = _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("noc"), F.col("c_mktsegment").alias("sport")
    )
    fact = _hot_events(spark, sf_dir).drop("sport")
    return tally(fact, dim, **EVENTS, broadcast_bytes=0)


def tally_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("sport"), "o_orderstatus"
    )
    return count_outcomes(orders, "sport", "o_orderstatus", {"gold": "F"})


# --- latest row per key ------------------------------------------------------


def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate"], ties=["o_orderkey"])


def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    order = F.desc_nulls_first(F.expr("nullif(event_type, 'view')"))
    return latest_per_key(events, ["user_id"], [order], ties=["event_id"])


# --- loads -------------------------------------------------------------------


def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _read(spark, sf_dir, "customer")
    table = f"{_schema(spark, 'append')}.customer"
    _table_like(customer, table)
    insert_into(customer, table)
    load(spark, table, _export(customer, "customer"))
    return spark.table(table)


def load_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    table = f"{_schema(spark, 'columns')}.customer"
    _table_like(customer, table)
    # Fields go by position, so the list may come in any order.
    path = _export(customer.select("c_name", "c_custkey"), "customer")
    load(spark, table, path, columns=["c_name", "c_custkey"], options={"sep": ","})
    return spark.table(table)


def load_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    table = f"{_schema(spark, 'truncate')}.events"
    create_table_as(events, table)
    load(spark, table, _export(events, "events"), mode="truncate")
    return spark.table(table)


def load_keep_latest(
    spark: SparkSession, sf_dir: str, key: str = "o_custkey", tie: str = "o_orderkey"
) -> DataFrame:
    """A load into a table that holds many rows of most keys."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    urgent = _read(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    batch = urgent.select(
        "o_orderkey",
        "o_custkey",
        F.concat("o_orderstatus", F.lit("2")).alias("o_orderstatus"),
        F.lit(1).alias("version"),
    )
    start = orders.withColumn("version", F.lit(0))
    table = f"{_schema(spark, 'latest')}.orders"
    create_table_as(start, table)
    load(
        spark,
        table,
        _export(batch, "orders"),
        mode="keep_latest",
        key=[key],
        order=["version"],
        ties=[tie, "o_orderstatus"],
        constraints=Constraints(not_null=("o_orderkey",), key=(key,)),
    )
    return spark.table(table).select("o_orderkey", "o_custkey", "o_orderstatus")


def load_keep_latest_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load into a table that is dealt by key, of which only touched partitions are read."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    urgent = _read(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    batch = urgent.select(
        "o_orderkey", "o_custkey", F.concat("o_orderstatus", F.lit("2")), F.lit(1).alias("version")
    )
    start = _export(orders.withColumn("version", F.lit(0)), "start")
    table = f"{_schema(spark, 'parts')}.orders"
    columns = {"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "STRING"}
    create_keyed_table(spark, table, columns | {"version": "INT"}, key=["o_orderkey"], parts=16)
    for path in (start, _export(batch, "orders")):
        load(
            spark,
            table,
            path,
            mode="keep_latest",
            order=["version"],
            ties=["o_custkey", "o_orderstatus"],
            constraints=Constraints(not_null=("o_orderkey",), key=("o_orderkey",)),
        )
    return spark.table(table).select("o_orderkey", "o_custkey", "o_orderstatus")


def load_truncate_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reload of a partitioned table: one kind of event is new, one is gone."""
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "props", "event_type")
    kind = F.col("event_type")
    table = f"{_schema(spark, 'truncate')}.events"
    create_table_as(events.where(kind != "click"), table, partition_by=["event_type"])
    path = _export(events.where(kind != "view"), "events")
    predicates = {"kept": "event_type <> 'view'"}
    constraints = Constraints(not_null=("event_id",), max_length={"event_type": 20})
    load(spark, table, path, mode="truncate", constraints=constraints, predicates=predicates)
    return spark.table(table)


def load_keep_latest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load into a table that holds one row per key."""
    return load_keep_latest(spark, sf_dir, "o_orderkey", "o_custkey")


def table_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, drop, create typed, fill, delete every row, insert from a staged select."""
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    schema = _schema(spark, "reload")
    table, staged = f"{schema}.customer", f"{schema}.staged"
    create_table_as(customer, staged)
    create_table(spark, table, {"c_name": "STRING"})
    drop_table(spark, table)
    columns = {"c_custkey": "BIGINT", "c_name": "VARCHAR(255)", "c_mktsegment": "VARCHAR(255)"}
    create_table(spark, table, columns)
    insert_into(spark.table(staged), table)
    truncate_table(spark, table)
    insert_into(spark.table(staged).select(*table_columns(spark, table)), table)
    return spark.table(table)


def keyed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    counts = count_outcomes(orders, "o_custkey", "o_orderstatus", {"done": "F"}, not_value="F")
    table = f"{_schema(spark, 'keyed')}.order_counts"
    create_table(
        spark, table, {"o_custkey": "BIGINT", "done": "BIGINT", "total": "BIGINT"}, key="o_custkey"
    )
    # The aggregate has brought the rows of a key together already.
    insert_into(counts, table, clustered=True)
    return spark.table(table)


def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their lines, both laid out by order, joined and counted without a shuffle."""
    schema = _schema(spark, "buckets")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    for df, key in ((orders, "o_orderkey"), (lines, "l_orderkey")):
        kinds = {f.name: f.dataType.simpleString() for f in df.schema}
        create_table(spark, f"{schema}.{key}", kinds, key=key)
        insert_into(df, f"{schema}.{key}")
    orders, lines = (spark.table(f"{schema}.{key}") for key in ("o_orderkey", "l_orderkey"))
    joined = orders.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey").agg(
        F.max("o_custkey").alias("o_custkey"), F.count("*").alias("n_lines")
    )


# --- sources and sinks ---------------------------------------------------------


def csv_scan_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    return read_csv(spark, _export(events, "events"))


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Blanks around the unquoted names, for the reader to trim.
    customer = _read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        "c_nationkey",
        "c_acctbal",
    )
    path = _export(customer, "customer")
    scanned = read_csv(spark, path, infer=True, trim=True)
    # A guessed integer is as wide as the data needs; the result should not be.
    return scanned.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def csv_scan_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that disagree: whole and broken numbers, numbers and names, days and times."""
    events = _read(spark, sf_dir, "events")
    day = F.date_trunc("day", F.col("ts").cast("timestamp_ntz"))
    whole = events.where("event_id % 2 = 0").select(
        "event_id",
        "user_id",
        F.floor("value").cast("bigint").alias("amount"),
        F.date_format(day, "yyyy-MM-dd").alias("day"),
        F.date_format(day, "yyyy-MM-dd").alias("at"),
    )
    broken = events.where("event_id % 2 = 1").select(
        "event_id",
        F.concat(F.lit("u"), "user_id").alias("user_id"),
        F.col("value").alias("amount"),
        F.date_format(day, "yyyy-MM-dd").alias("day"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("at"),
    )
    paths = [_export(whole, "whole"), _export(broken, "broken")]
    return read_csv(spark, paths, schema=infer_schema(spark, paths))


def csv_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = tally(_fact(spark, sf_dir), _dim(spark, sf_dir), **FLAGS)
    return read_csv(spark, _export(result, "tally", single_file=True), schema=result.schema)


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _read(spark, sf_dir, "customer")
    # As a decimal, whose text both engines write alike.
    customer = customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    path = _export(customer, "customer", header=False)
    target = scratch_dir(spark, "raw")
    land_raw(spark, path, target)
    return read_landed(spark, target).select("value")


def landed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events").withColumns(
        {
            "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "value": F.col("value").cast("decimal(18,2)"),
        }
    )
    target = scratch_dir(spark, "raw")
    land_raw(spark, _export(events, "events"), target)
    return read_landed_csv(spark, target, events.columns)


def landing_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of 250 documents, with both line ends, some without a last one: landed, read, hashed."""
    documents = _read(spark, sf_dir, "documents")
    files = documents.groupBy(F.expr("doc_id div 250").alias("n")).agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "text"))).alias("d")
    )
    line_end = "if(n % 2 = 1, '\\r\\n', '\\n')"
    contents = files.select("n", F.expr(f"array_join(d.text, {line_end})").alias("content"))
    paths = []
    for half, end in ((0, "\n"), (1, "|")):
        paths.append(scratch_dir(spark, "files"))
        rows = contents.where(F.expr(f"n div 2 % 2 = {half}")).select("content")
        rows.write.option("lineSep", end).option("maxRecordsPerFile", 1).text(paths[-1])
    target = scratch_dir(spark, "landing")
    land_exact(spark, paths, target, glob="part-*")
    landed = read_landing_files(spark, target).where("content <> ''")
    content = F.col("content").cast("binary")
    return landed.select(
        F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("bigint").alias("n_bytes")
    )


def tally_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, the second replacing some files of the first; each line is counted once."""
    lines = _fact(spark, sf_dir)
    fixed = F.expr("CASE medal WHEN 'A' THEN 'R' WHEN 'R' THEN 'X' ELSE medal END")
    part = F.col("sport") % 3
    again = lines.withColumn("medal", F.when(part == 0, fixed).otherwise(F.col("medal")))
    target, state = scratch_dir(spark, "landing"), scratch_dir(spark, "state")
    dim = _dim(spark, sf_dir)
    for day, parts in ((lines, (0, 1)), (again, (0, 2))):
        paths = [_named_csv(day.where(part == p), f"lines{p}") for p in parts]
        land_exact(spark, paths, target)
        result = tally_landed(spark, target, state, dim, lines.columns, **FLAGS)
    return result


def _named_csv(df: DataFrame, name: str) -> str:
    """Export ``df``, with names of files that a second export uses again."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_export(df, name))
    files = path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    written = sorted(s.getPath().getName() for s in files.listStatus(path))
    for k, part in enumerate(n for n in written if n.startswith("part-")):
        child = df.sparkSession._jvm.org.apache.hadoop.fs.Path
        files.rename(child(path, part), child(path, f"{name}-{k}.csv"))
    return path.toString()


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _text_files(spark, sf_dir)
    files = list_files(spark, path, glob="*.txt")
    # One file for each partition and each full thousand of its records.
    return files.agg(
        F.sum("length").alias("total_bytes"), F.countDistinct("path").alias("n_files")
    ).select("total_bytes", (F.col("n_files") == len(set(files.inputFiles()))).alias("all_listed"))


def file_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size of a file of one number, in a folder whose name has a pattern's signs."""
    documents = _read(spark, sf_dir, "documents")
    path = scratch_dir(spark, "sum[1]")
    documents.agg(F.sum(F.octet_length("text")).cast("string")).write.text(path)
    listed = list_files(spark, path.replace("[", "\\[").replace("]", "\\]"), glob="*.txt")
    found = find_file(spark, listed.first()["path"])
    return found.select(F.col("length").alias("n_bytes"))


def whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = read_files(spark, _text_files(spark, sf_dir), glob="*.txt")
    return contents.agg(F.sum(F.length("content")).alias("total_chars"))


def _text_files(spark: SparkSession, sf_dir: str) -> str:
    """The documents as text files, of a size that can be read whole."""
    path = scratch_dir(spark, "documents")
    documents = _read(spark, sf_dir, "documents").select("text")
    documents.write.option("maxRecordsPerFile", 1_000).text(path)
    return path


def table_column_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    table = f"{_schema(spark, 'catalog')}.orders"
    create_table_as(
        orders.withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')")), table
    )
    columns = table_columns(spark, table)
    ordinal = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("rule"))
    return null_rules(spark.table(table), table, columns).select(
        ordinal.cast("int").alias("ordinal_position"),
        F.col("rule").alias("column_name"),
        F.col("actual").alias("null_rows"),
    )


# --- functions -----------------------------------------------------------------


def text_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select(
        "doc_id", first_chars("text", 100).alias("preview")
    )


def path_basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "pages").select("page_id", basename("url").alias("name"))


def concat_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_fields(",", "c_name", F.expr("nullif(c_mktsegment, 'BUILDING')"), "c_nationkey")
    return _read(spark, sf_dir, "customer").select("c_custkey", joined.alias("joined"))


def shifted_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    return events.select("event_id", shifted_time(events, "ts").alias("local_time"))


def failure_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failure_report(
        _read(spark, sf_dir, "events").withColumn("user_id", F.expr("nullif(user_id, 7)")),
        failed=F.col("event_type") == "error",
        ts="ts",
        template="Job: {user_id} Time: {local_time}",
        keep=("event_id",),
    )


# --- quality -------------------------------------------------------------------


def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count_rules({t: _read(spark, sf_dir, t) for t in ("orders", "lineitem")})


def dq_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus")
    )
    return null_rules(orders, "orders", ["o_orderstatus"]).drop("rule")


def dq_scalar_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    name_for_sql({"rule_orders": _read(spark, sf_dir, "orders")})
    check_sql = "SELECT count(*) FROM rule_orders WHERE o_totalprice <= 0"
    return scalar_rule(spark, "orders", check_sql, 0).drop("rule")


def constraint_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.expr("nullif(o_orderstatus, 'P')")
    )
    constraints = Constraints(
        not_null=("o_orderstatus",),
        max_length={"o_orderpriority": 8},
        key=("o_custkey", "o_orderdate"),
    )
    return count_violations(orders, constraints).toDF("null_rows", "too_long", "extra_keys")


def observed_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that are counted while the rows are written, with no scan of their own."""
    orders = _read(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.expr("nullif(o_orderstatus, 'P')")
    )
    constraints = Constraints(not_null=("o_orderstatus",), max_length={"o_orderpriority": 8})
    metrics = observed_metrics(orders, constraints, {"cheap": "o_totalprice > 100000"})
    seen = Observation()
    orders.observe(seen, *metrics.values()).write.parquet(scratch_dir(spark, "observed"))
    found = [seen.get[f"m{k}"] for k in range(len(metrics))]
    names = ("row_count", "null_rows", "too_long", "cheap")
    return spark.createDataFrame([found], ", ".join(f"{n} bigint" for n in names))


# --- whole jobs ----------------------------------------------------------------


def daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _export(_fact(spark, sf_dir), "fact")
    dim = _export(_dim(spark, sf_dir), "dim")
    schema = scratch_dir(spark, "refresh")
    return refresh(
        spark,
        incoming=[fact, dim],
        raw=scratch_dir(spark, "raw"),
        fact_path=fact,
        dim_path=dim,
        table=f"{schema.rpartition('/')[2].replace('-', '_')}.medals",
        spec=FLAGS,
        schema_location=schema,
        predicates={"whole": "total >= gold + silver + bronze"},
    )


def local_extract_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = _export(_fact(spark, sf_dir), "fact")
    dim = _export(_dim(spark, sf_dir), "dim")
    result = scratch_dir(spark, "result")
    return local_extract(spark, fact, dim, result, spec=FLAGS, single_file=True)


def two_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim = _fact(spark, sf_dir), _dim(spark, sf_dir)
    schema = _schema(spark, "two")
    _table_like(fact, f"{schema}.fact")
    _table_like(dim, f"{schema}.dim")
    load_fact_and_dimension(
        spark,
        (f"{schema}.fact", _export(fact, "fact")),
        (f"{schema}.dim", _export(dim, "dim")),
    )
    return tally(spark.table(f"{schema}.fact"), spark.table(f"{schema}.dim"), **FLAGS)


def entry(spark: SparkSession) -> DataFrame:
    """The medal tally's shape on the smallest data."""
    return tally_one_key(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = {**_llm.QUERIES, "pipeline": _pipeline.run} if _llm else {}
    return core_queries() | more


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of the reference's own operators."""
    return {
        "tally": tally_one_key,
        "tally_sql": tally_sql,
        "tally_null_outcome": tally_null_outcome,
        "tally_duplicate_dim": tally_duplicate_dim,
        "tally_large_dim": tally_large_dim,
        "tally_selective_dim": tally_selective_dim,
        "tally_hot_key": tally_hot_key,
        "tally_hot_key_dim_group": tally_hot_key_dim_group,
        "tally_null_group": tally_null_group,
        "latest_per_key": latest_order,
        "latest_per_key_nulls": latest_event,
        "load_append": load_append,
        "load_columns": load_columns,
        "load_truncate": load_truncate,
        "load_keep_latest": load_keep_latest,
        "load_keep_latest_merge": load_keep_latest_merge,
        "load_keep_latest_parts": load_keep_latest_parts,
        "load_truncate_partitioned": load_truncate_partitioned,
        "table_reload": table_reload,
        "keyed_layout": keyed_layout,
        "bucketed_join": bucketed_join,
        "csv_scan_string": csv_scan_string,
        "csv_scan_inferred": csv_scan_inferred,
        "csv_scan_widened": csv_scan_widened,
        "csv_single_file": csv_single_file,
        "raw_landing": raw_landing,
        "landed_csv": landed_csv,
        "landing_exact": landing_exact,
        "tally_incremental": tally_incremental,
        "file_listing": file_listing,
        "file_lookup": file_lookup,
        "whole_files": whole_files,
        "table_columns": table_column_nulls,
        "text_preview": text_preview,
        "path_basename": path_basename,
        "concat_fields": concat_fields,
        "shifted_time": shifted_times,
        "failure_report": failure_reports,
        "dq_row_count": dq_row_count,
        "dq_null_key": dq_null_key,
        "dq_scalar_rule": dq_scalar_rule,
        "constraint_check": constraint_check,
        "observed_gate": observed_gate,
        "daily_refresh": daily_refresh,
        "local_extract": local_extract_job,
        "two_table_load": two_table_load,
    }


_TALLY_COUNTS = """
    count(case when l.l_returnflag = 'A' then 1 end) as gold,
    count(case when l.l_returnflag = 'R' then 1 end) as silver,
    count(case when l.l_returnflag = 'X' then 1 end) as bronze,
    count(case when l.l_returnflag <> 'N' then 1 end) as total
"""
_TALLY = f"""
    select l.l_linenumber as sport, {_TALLY_COUNTS}
    from lineitem l join supplier s on s.s_suppkey = l.l_suppkey
    where s.s_suppkey = 7 group by 1
"""
_TALLY_WHOLE = f"""
    select l.l_linenumber as sport, {_TALLY_COUNTS}
    from lineitem l join supplier s on s.s_suppkey = l.l_suppkey group by 1
"""
_KEEP_LATEST = """
    select o_orderkey, o_custkey, o_orderstatus from (
        select *, row_number() over (partition by {key}
            order by version desc, {ties} desc, o_orderstatus desc) as n
        from (
            select o_orderkey, o_custkey, o_orderstatus, 0 as version from orders
            union all
            select o_orderkey, o_custkey, o_orderstatus || '2', 1 from orders
            where o_orderpriority = '1-URGENT'
        ) a) b where n = 1
"""


def oracle_sql() -> dict[str, str]:
    return core_oracle_sql() | (_llm.ORACLE_SQL if _llm else {})


def core_oracle_sql() -> dict[str, str]:
    return {
        "tally": _TALLY,
        "tally_sql": _TALLY,
        "tally_null_outcome": """
            select c.c_mktsegment as sport,
                count(case when nullif(e.event_type, 'click') = 'purchase' then 1 end) as gold,
                count(case when nullif(e.event_type, 'click') = 'signup' then 1 end) as silver,
                count(case when nullif(e.event_type, 'click') is null then 1 end) as unknown,
                count(case when nullif(e.event_type, 'click') <> 'error' then 1 end) as total
            from events e join customer c on c.c_custkey = e.user_id group by 1""",
        "tally_duplicate_dim": f"""
            select l.l_linenumber as sport, {_TALLY_COUNTS}
            from lineitem l join (
                select s_suppkey from supplier
                union all select s_suppkey from supplier where s_acctbal > 0
            ) s on s.s_suppkey = l.l_suppkey group by 1""",
        "tally_large_dim": f"""
            select l.l_linenumber as sport, {_TALLY_COUNTS}
            from lineitem l join orders o on o.o_orderkey = l.l_orderkey group by 1""",
        "tally_selective_dim": f"""
            select l.l_linenumber as sport, {_TALLY_COUNTS}
            from lineitem l join orders o on o.o_orderkey = l.l_orderkey
            where o.o_orderpriority = '1-URGENT' group by 1""",
        "tally_hot_key": """
            select length(e.props) as sport,
                count(case when e.event_type = 'purchase' then 1 end) as gold,
                count(case when e.event_type = 'signup' then 1 end) as silver,
                count(case when e.event_type <> 'error' then 1 end) as total
            from events e join customer c
                on c.c_custkey = case when e.event_id % 3 = 0 then 0 else e.user_id end
            group by 1""",
        "tally_hot_key_dim_group": """
            select c.c_mktsegment as sport,
                count(case when e.event_type = 'purchase' then 1 end) as gold,
                count(case when e.event_type = 'signup' then 1 end) as silver,
                count(case when e.event_type <> 'error' then 1 end) as total
            from events e join customer c
                on c.c_custkey = case when e.event_id % 3 = 0 then 0 else e.user_id end
            group by 1""",
        "tally_null_group": """
            select nullif(o_orderpriority, '5-LOW') as sport,
                count(case when o_orderstatus = 'F' then 1 end) as gold
            from orders group by 1""",
        "latest_per_key": """
            select o_orderkey, o_custkey, o_totalprice, o_orderdate from (
                select *, row_number() over (partition by o_custkey
                    order by o_orderdate desc nulls first, o_orderkey desc) as n
                from orders) x where n = 1""",
        "latest_per_key_nulls": """
            select event_id, user_id, event_type from (
                select *, row_number() over (partition by user_id
                    order by nullif(event_type, 'view') desc nulls first, event_id desc) as n
                from events) x where n = 1""",
        "load_append": "select * from customer union all select * from customer",
        "load_columns": """
            select c_custkey, c_name, cast(null as varchar) as c_mktsegment from customer""",
        "load_truncate": "select * from events",
        "load_keep_latest": _KEEP_LATEST.format(key="o_custkey", ties="o_orderkey"),
        "load_keep_latest_merge": _KEEP_LATEST.format(key="o_orderkey", ties="o_custkey"),
        "load_keep_latest_parts": _KEEP_LATEST.format(key="o_orderkey", ties="o_custkey"),
        "load_truncate_partitioned": """
            select event_id, user_id, props, event_type from events where event_type <> 'view'""",
        "table_reload": "select c_custkey, c_name, c_mktsegment from customer",
        "keyed_layout": """
            select o_custkey, count(case when o_orderstatus = 'F' then 1 end) as done,
                count(case when o_orderstatus <> 'F' then 1 end) as total
            from orders group by 1""",
        "bucketed_join": """
            select o_orderkey, max(o_custkey) as o_custkey, count(*) as n_lines
            from orders join lineitem on l_orderkey = o_orderkey group by 1""",
        "csv_scan_string": """
            select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id,
                event_type, props from events""",
        "csv_scan_inferred": "select c_custkey, c_name, c_nationkey, c_acctbal from customer",
        "csv_scan_widened": """
            select event_id, case when event_id % 2 = 1 then 'u' else '' end || user_id as user_id,
                case when event_id % 2 = 0 then floor(value) else value end as amount,
                cast(ts as date) as day, date_trunc('day', ts)::timestamp as at from events""",
        "csv_single_file": _TALLY_WHOLE,
        "raw_landing": """
            select concat_ws(',', c_custkey, c_name, c_nationkey,
                cast(c_acctbal as decimal(12, 2)), c_mktsegment) as value
            from customer""",
        "landed_csv": """
            select cast(event_id as varchar) as event_id,
                strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, cast(user_id as varchar) as user_id,
                event_type, cast(cast(value as decimal(18, 2)) as varchar) as value, props
            from events""",
        "landing_exact": """
            select sha256(content) as sha256, cast(strlen(content) as bigint) as n_bytes from (
                select case when doc_id // 250 % 2 = 1
                        then string_agg(text, chr(13) || chr(10) order by doc_id)
                        else string_agg(text, chr(10) order by doc_id) end
                    || case when doc_id // 250 // 2 % 2 = 0 then chr(10) else '|' end as content
                from documents group by doc_id // 250)""",
        "tally_incremental": """
            select cast(l_linenumber as varchar) as sport,
                count(case when flag = 'A' then 1 end) as gold,
                count(case when flag = 'R' then 1 end) as silver,
                count(case when flag = 'X' then 1 end) as bronze,
                count(case when flag <> 'N' then 1 end) as total
            from (select l_linenumber, l_suppkey, case when l_linenumber % 3 <> 0 then l_returnflag
                    when l_returnflag = 'A' then 'R' when l_returnflag = 'R' then 'X'
                    else l_returnflag end as flag from lineitem) l
            join supplier s on s.s_suppkey = l.l_suppkey group by 1""",
        "file_listing": """
            select cast(sum(strlen(text) + 1) as bigint) as total_bytes, true as all_listed
            from documents""",
        "file_lookup": """
            select strlen(cast(sum(strlen(text)) as varchar)) + 1 as n_bytes from documents""",
        "whole_files": """
            select cast(sum(length(text) + 1) as bigint) as total_chars from documents""",
        "table_columns": """
            select 1 as ordinal_position, 'o_orderkey' as column_name,
                count(*) - count(o_orderkey) as null_rows from orders
            union all select 2, 'o_custkey', count(*) - count(o_custkey) from orders
            union all select 3, 'o_orderstatus',
                count(*) - count(nullif(o_orderstatus, 'P')) from orders
            union all select 4, 'o_totalprice', count(*) - count(o_totalprice) from orders
            union all select 5, 'o_orderdate', count(*) - count(o_orderdate) from orders
            union all select 6, 'o_orderpriority',
                count(*) - count(o_orderpriority) from orders""",
        "text_preview": "select doc_id, substring(text, 1, 100) as preview from documents",
        "path_basename": "select page_id, split_part(url, '/', -1) as name from pages",
        "concat_fields": """
            select c_custkey, concat_ws(',', c_name, nullif(c_mktsegment, 'BUILDING'),
                cast(c_nationkey as varchar)) as joined
            from customer""",
        "shifted_time": """
            select event_id,
                strftime(ts + interval 9 hours, '%Y-%m-%d %H:%M:%S') as local_time
            from events""",
        "failure_report": """
            select event_id,
                'Job: ' || coalesce(cast(nullif(user_id, 7) as varchar), '(none)') || ' Time: '
                || strftime(ts + interval 9 hours, '%Y-%m-%d %H:%M:%S') as report
            from events where event_type = 'error'""",
        "dq_row_count": """
            select 'orders' as table_name, count(*) as row_count, count(*) >= 0 as passed
            from orders
            union all select 'lineitem', count(*), count(*) >= 0 from lineitem""",
        "dq_null_key": """
            select 'orders' as table_name, count(*) as actual, cast(0 as bigint) as expected,
                count(*) = 0 as passed
            from orders where nullif(o_orderstatus, 'P') is null""",
        "dq_scalar_rule": """
            select 'orders' as table_name, count(*) as actual, cast(0 as bigint) as expected,
                count(*) = 0 as passed
            from orders where o_totalprice <= 0""",
        "constraint_check": """
            select count(case when nullif(o_orderstatus, 'P') is null then 1 end) as null_rows,
                count(case when length(o_orderpriority) > 8 then 1 end) as too_long,
                count(*) - count(distinct (o_custkey, o_orderdate)) as extra_keys
            from orders""",
        "observed_gate": """
            select count(*) as row_count,
                count(case when nullif(o_orderstatus, 'P') is null then 1 end) as null_rows,
                count(case when length(o_orderpriority) > 8 then 1 end) as too_long,
                count(case when not coalesce(o_totalprice > 100000, false) then 1 end) as cheap
            from orders""",
        "daily_refresh": _TALLY_WHOLE.replace(
            "l.l_linenumber", "cast(l.l_linenumber as varchar)"
        ),
        "local_extract": _TALLY_WHOLE,
        "two_table_load": _TALLY_WHOLE,
    }
