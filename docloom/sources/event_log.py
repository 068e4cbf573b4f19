"""Event topics: contracts, encoding, and the log they are read from and written to."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import schemas

BAD_RECORD = "bad_record"
RECORD_COLUMNS = (
    "key string, value string, headers array<struct<key:string,value:binary>>, topic string"
)


def encode(df: DataFrame, contract: str) -> DataFrame:
    """Add ``value``: the record as contract-typed JSON, fields in contract order."""
    return df.withColumn("value", F.to_json(
        F.struct(*_typed(contract)), {"ignoreNullFields": "false"}))


def _typed(contract: str) -> list[Column]:
    return [F.col(part.split()[0]).cast(part.split()[1]).alias(part.split()[0])
            for part in schemas.CONTRACTS[contract].split(", ")]


def decode(df: DataFrame, contract: str, value: str = "value") -> DataFrame:
    """Contract columns from ``value``, plus ``bad_record``: the text of records that do not fit.

    A record fits when it parses and no mandatory field is null.
    """
    ddl = f"{schemas.CONTRACTS[contract]}, {BAD_RECORD} string"
    parsed = df.withColumn("_r", F.from_json(
        value, ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}))
    optional = schemas.NULLABLE_FIELDS.get(contract, ())
    names = schemas.field_names(schemas.CONTRACTS[contract])
    # Readers of a record without a version take the contract's default.
    version = F.coalesce("_r.schema_version", F.lit(schemas.SCHEMA_VERSION))
    lacking = F.lit(False)
    for name in names:
        if name not in optional and name != "schema_version":
            lacking = lacking | F.col(f"_r.{name}").isNull()
    bad = F.coalesce(F.col(f"_r.{BAD_RECORD}"), F.when(lacking, F.col(value)))
    keep = [c for c in df.columns if c not in names and c != value]
    fields = [(version if n == "schema_version" else F.col(f"_r.{n}")).alias(n) for n in names]
    return parsed.select(*keep, *fields, bad.alias(BAD_RECORD))


def _contract_fields() -> Column:
    """Contract name to its fields, as one literal: name, JSON type, whether it may lack or be null."""
    fields = {
        contract: [{"name": part.split()[0], "kind": part.split()[1].upper(),
                    "optional": part.split()[0] in schemas.NULLABLE_FIELDS.get(contract, ())}
                   for part in ddl.split(", ")]
        for contract, ddl in schemas.CONTRACTS.items()}
    return F.from_json(F.lit(json.dumps(fields)), "map<string,array<struct<name:string,kind:string,optional:boolean>>>")


def misfit(payload: str | Column, contract: str | Column) -> Column:
    """Name of the first field of a JSON payload that keeps it from the contract its row names, or null.

    Strings must be JSON strings and longs whole numbers; a field may be missing or null only where
    the contract says so. Further members do no harm. What is no object misfits at once; a contract
    nobody declared asks for no field. Payload and types are bound by maps over one element: each is
    parsed once, whatever the number of fields and contracts.
    """
    def lacking(types: Column) -> Column:
        wanted = F.coalesce(F.try_element_at(_contract_fields(), F.col(contract) if isinstance(contract, str) else contract),
                            F.array().cast("array<struct<name:string,kind:string,optional:boolean>>"))
        broken = F.filter(wanted, lambda f: ~F.coalesce(
            (F.try_element_at(types, f["name"]) == f["kind"]) |
            (f["optional"] & F.coalesce(F.try_element_at(types, f["name"]) == "VOID", F.lit(True))), f["optional"]))
        return F.when(types.isNull(), F.lit("no record")).otherwise(F.get(broken, 0)["name"])

    members = F.try_variant_get(F.try_parse_json(payload), "$", "map<string,variant>")
    types = F.transform_values(members, lambda _, value: F.schema_of_variant(value))
    return F.get(F.transform(F.array(types), lacking), 0)


def avro_payload(payload: str, contract_column: str) -> Column:
    """Avro binary of each JSON payload by the contract its row names; needs the Avro module."""
    from pyspark.sql.avro.functions import to_avro

    made = F.lit(None).cast("binary")
    for contract, ddl in schemas.CONTRACTS.items():
        made = F.when(F.col(contract_column) == contract,
                      to_avro(F.from_json(payload, ddl), avro_schema(contract))).otherwise(made)
    return made


def avro_schema(contract: str) -> str:
    """Avro record declaration of a contract."""
    optional = schemas.NULLABLE_FIELDS.get(contract, ())
    fields = []
    for part in schemas.CONTRACTS[contract].split(", "):
        name, kind = part.split()
        avro = {"string": "string", "bigint": "long"}[kind]
        field: dict = {"name": name, "type": ["null", avro] if name in optional else avro}
        if name in optional:
            field["default"] = None
        if name == "schema_version":
            field["default"] = schemas.SCHEMA_VERSION
        fields.append(field)
    record = "".join(word.capitalize() for word in contract.split("-"))
    return json.dumps({"type": "record", "name": record, "fields": fields})


def encode_avro(df: DataFrame, contract: str) -> DataFrame:
    """Add ``value`` as Avro binary; needs the spark-avro module on the class path."""
    from pyspark.sql.avro.functions import to_avro

    return df.withColumn("value", to_avro(F.struct(*_typed(contract)), avro_schema(contract)))


def decode_avro(df: DataFrame, contract: str, value: str = "value") -> DataFrame:
    from pyspark.sql.avro.functions import from_avro

    return df.withColumn("_r", from_avro(value, avro_schema(contract))).select("_r.*")


# Log --------------------------------------------------------------------------------------------


def write_log(messages: DataFrame, path: str) -> None:
    """Append (topic, key, value, headers) to a file log with one folder per topic."""
    messages.select("key", "value", "headers", "topic") \
        .write.mode("append").partitionBy("topic").parquet(path)


def stream_log(
    spark: SparkSession, path: str, topic: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Stream one topic of a file log from its start; progress lives in the query's checkpoint.

    ``position`` orders the records as they were written (time of the file, file, row), however a
    batch's files are split, so a replay meets them in the same order.
    """
    reader = spark.readStream.schema(RECORD_COLUMNS.rsplit(", ", 1)[0])
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    position = F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("part"),
                        F.col("_metadata.row_index").alias("row"))
    return reader.parquet(f"{path}/topic={topic}").select("key", "value", "headers", position.alias("position"))


def stream_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The same from a broker; needs the Kafka connector on the class path."""
    source = spark.readStream.format("kafka") \
        .option("kafka.bootstrap.servers", servers) \
        .option("subscribe", topic) \
        .option("startingOffsets", "earliest") \
        .option("includeHeaders", "true").load()
    position = F.struct(F.col("timestamp").alias("at"), F.col("partition").cast("string").alias("part"),
                        F.col("offset").alias("row"))
    return source.select(F.col("key").cast("string"), F.col("value").cast("string"), "headers", position.alias("position"))


def write_kafka(messages: DataFrame, servers: str) -> None:
    messages.select("topic", "key", "value", "headers") \
        .write.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("includeHeaders", "true").save()


# Topics -----------------------------------------------------------------------------------------


def topic_specs(spark: SparkSession) -> DataFrame:
    """(topic, kind, retention_ms): the declared topics, sixteen rows."""
    rows = [(t, "event", schemas.EVENT_RETENTION_MS) for t in schemas.EVENT_TOPICS]
    rows += [(schemas.retry_topic(s), "retry", schemas.RETRY_RETENTION_MS) for s in schemas.STAGES]
    rows += [(schemas.dead_letter_topic(s), "dead_letter", schemas.DEAD_LETTER_RETENTION_MS)
             for s in schemas.STAGES]
    return spark.createDataFrame(rows, "topic string, kind string, retention_ms bigint")


def missing_topics(specs: DataFrame, observed: DataFrame) -> DataFrame:
    """Declared topics that are not observed. Existing ones are left as they are."""
    return specs.join(observed.select("topic").distinct(), "topic", "left_anti")


def retain(records: DataFrame, specs: DataFrame, as_of, ts: str = "ts") -> DataFrame:
    """Records still inside their topic's retention at ``as_of``. The specs are sixteen rows."""
    now = F.unix_millis(F.lit(as_of).cast("timestamp"))
    age = now - F.unix_millis(F.col(ts).cast("timestamp"))
    return records.join(F.broadcast(specs.select("topic", "retention_ms")), "topic") \
        .filter(age <= F.col("retention_ms"))
