"""Writing star tables: schema creation, typed tables, full refresh and append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratestar.plans.views import CLAIMS, ENROLLMENT, QUALITY
from ratestar.schema import TABLES, Table
from ratestar.session import cut_lineage
from ratestar.sources.star import CatalogStar, Star


def create_schema(spark: SparkSession, database: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def _conformed(df: DataFrame, table: Table) -> DataFrame:
    """Declared columns in order and type. Required columns that are empty and
    amounts that do not fit raise.

    Parquet tables record NOT NULL without enforcing it, while Spark plans
    queries as if it held, so it is enforced here, where rows are written.
    """
    def column(field) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            missing = F.raise_error(F.lit(f"{table.name}.{field.name} is required")).cast(field.dataType)
            value = F.coalesce(value, missing)
        return value.alias(field.name)

    return df.select(*[column(f) for f in table.columns])


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(spark: SparkSession, database: str, name: str, replace: bool = True) -> None:
    """An empty typed table with comments, NOT NULL marks and properties.

    A table that is there gives way only once the new one stands under another
    name, so a definition that fails leaves it as it was. A call that ended between the drop
    and the rename is finished by the next one.
    """
    fresh = f"{name}__fresh"
    there = spark.catalog.tableExists(f"{database}.{name}")
    if not there and spark.catalog.tableExists(f"{database}.{fresh}"):
        spark.sql(f"ALTER TABLE {database}.{fresh} RENAME TO {database}.{name}")
        there = True
    if replace and there:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{fresh}")
        _create(spark, database, fresh, TABLES[name])
        spark.sql(f"DROP TABLE {database}.{name}")
        spark.sql(f"ALTER TABLE {database}.{fresh} RENAME TO {database}.{name}")
    else:
        _create(spark, database, name, TABLES[name])


def _create(spark: SparkSession, database: str, name: str, table: Table) -> None:
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'} COMMENT {_literal(f.metadata['comment'])}"
        for f in table.columns)
    parts = f" PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{parts} "
              f"COMMENT {_literal(table.comment)} TBLPROPERTIES ('quality' = 'gold')")


def _write(df: DataFrame, database: str, name: str, overwrite: bool) -> None:
    """Insert into the typed table, creating it if need be.

    The table keeps its declared types, comments and properties. Rows of a
    partitioned table are brought together by period first, or every task
    would write a file into every partition; adaptive execution spreads a
    large period over several tasks, so a hot one is not one file.
    """
    table = TABLES[name]
    create_table(df.sparkSession, database, name, replace=False)
    rows = _conformed(df, table)
    if table.partition_by:
        rows = rows.hint("rebalance", *[F.col(c) for c in table.partition_by])
    plain = [c for c in rows.columns if c not in table.partition_by]
    rows.select(*plain, *table.partition_by).write.option("partitionOverwriteMode", "static").insertInto(
        f"{database}.{name}", overwrite=overwrite)


def full_refresh(df: DataFrame, database: str, name: str) -> None:
    """Replace all rows of a table; facts are partitioned by their period."""
    _write(df, database, name, overwrite=True)


def append(df: DataFrame, database: str, name: str) -> None:
    """Add rows; columns are matched by name and cast to the declared types."""
    _write(df, database, name, overwrite=False)


#: What is known of batches: begun before their rows are written, done after.
LEDGER = "load_ledger"


def _ledger(spark: SparkSession, database: str) -> DataFrame:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{LEDGER} (table_name STRING COMMENT 'Table written to', batch BIGINT COMMENT 'Number of the batch', "
              f"state STRING COMMENT 'begun or done', noted_at TIMESTAMP COMMENT 'Time of the note') USING parquet COMMENT 'Batches of rows and how far they came'")
    return spark.table(f"{database}.{LEDGER}")


def batch_state(spark: SparkSession, database: str, name: str, batch: int) -> str | None:
    """``done``, ``begun`` if an attempt has not ended well, or None."""
    rows = _ledger(spark, database).filter((F.col("table_name") == name) & (F.col("batch") == batch)).select("state").distinct().collect()
    states = {row["state"] for row in rows}  # at most two
    return "done" if "done" in states else "begun" if states else None


def note_batch(spark: SparkSession, database: str, name: str, batch: int, state: str) -> None:
    """A line of the ledger: a batch has ``begun`` or is ``done``."""
    _ledger(spark, database)
    spark.sql(f"REFRESH TABLE {database}.{LEDGER}")
    spark.range(1).select(F.lit(name), F.lit(batch).cast("long"), F.lit(state), F.current_timestamp()).write.insertInto(f"{database}.{LEDGER}")


def append_batch(df: DataFrame, database: str, name: str, batch: int) -> bool:
    """Adds the rows of a numbered batch once, however often it is called; False if they are there already.

    A ledger table notes the batch before and after its rows are written. An attempt that was cut off may have
    left some of its rows, so the next one adds only those that the table lacks,
    looking at no other partitions than the batch has rows for. The batch must give the same rows each time, and one
    writer at a time work on a table. After an attempt that was cut off, rows that equal one of another batch in
    every column count as written.
    """
    spark = df.sparkSession
    state = batch_state(spark, database, name, batch)
    if state == "done":
        return False
    create_table(spark, database, name, replace=False)
    if state == "begun":
        df = _lacking(_conformed(df, TABLES[name]), spark.table(f"{database}.{name}"), TABLES[name])
    else:
        note_batch(spark, database, name, batch, "begun")
    append(df, database, name)
    note_batch(spark, database, name, batch, "done")
    return True


def _lacking(rows: DataFrame, there: DataFrame, table: Table) -> DataFrame:
    """Rows that ``there`` lacks, repeated ones counted, within the partitions that the rows belong to.

    The periods of a batch come to the driver, so that only their folders are listed and read.
    """
    for column in table.partition_by:
        periods = [row[0] for row in rows.select(column).distinct().collect()]
        there = there.filter(F.col(column).isin(periods))
    return rows.exceptAll(cut_lineage(there.select(*rows.columns)))


def with_member_attributes(star: Star, fact: str, attributes: tuple[str, ...]) -> DataFrame:
    """Rows of a fact whose named columns are those of its member; empty where the member is unknown.

    Hot members are left to adaptive execution, which splits their side of the join.
    """
    names = TABLES[fact].columns.names
    joined = star.join(fact, "dim_member", [c for c in names if c not in (*attributes, "member_id")], attributes, how="left")
    return joined.select(*names)


#: Facts that carry attributes of their member, and which.
MEMBER_ATTRIBUTES = {"fact_quality_events": ("county_fips",), "fact_enrollment": ("aid_category", "county_fips")}


def load_star(star: Star, spark: SparkSession, database: str, attributes_at_load: bool = False) -> None:
    """Write all seven tables, dimensions first.

    Raises, before facts are written, if a table that a view joins repeats its
    key. With ``attributes_at_load`` facts take the attributes of their member
    from the member table instead of from the source.
    """
    create_schema(spark, database)
    loaded = CatalogStar(spark, database)
    for name in TABLES:
        if name == "fact_quality_events":
            for view in (QUALITY, ENROLLMENT, CLAIMS):
                view.check_keys(loaded)
        rows = (with_member_attributes(star, name, MEMBER_ATTRIBUTES[name])
                if attributes_at_load and name in MEMBER_ATTRIBUTES else star.table(name))
        full_refresh(rows, database, name)
