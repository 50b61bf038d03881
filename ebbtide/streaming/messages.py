"""Parse topic rows into model inputs or a reason why that is impossible.

Pure column expressions, used alike on a stream and on a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide import schemas

ID = "subscriber_id"
# Whole numbers may be written as 95 or 95.0, so they are read as doubles first.
_INPUTS = ", ".join(
    f"{f.name} {'double' if f.dataType.simpleString() == 'int' else f.dataType.simpleString()}"
    for f in schemas.MODEL_INPUT_SCHEMA
)


def _typed(parsed: str) -> Column:
    """Model inputs in their types; a fraction where a whole number belongs is NULL."""
    def field(f) -> Column:
        value = F.col(f"{parsed}.{f.name}")
        if f.dataType.simpleString() == "int":
            value = F.when(value == F.floor(value), value.try_cast("int"))
        return value.alias(f.name)

    return F.struct(*[field(f) for f in schemas.MODEL_INPUT_SCHEMA])


def _whole_json(text: Column) -> Column:
    """Whether the text is one JSON value and nothing else.

    The parser stops after the first value, so the text is tried inside an array
    and inside an object: anything left over breaks one of the two.
    """
    in_array = F.concat(F.lit("["), text, F.lit("]"))
    in_object = F.concat(F.lit('{"v":'), text, F.lit("}"))
    return (F.json_array_length(in_array) == 1) & F.try_parse_json(in_object).isNotNull()


def _json_type(value: Column) -> Column:
    """Short name of a JSON value's type."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("ARRAY"), "list").when(kind == "STRING", "str")
        .when(kind == "BOOLEAN", "bool").when(kind == "VOID", "NoneType")
        .when(kind == "BIGINT", "int").otherwise("float")
    )


def parse(messages: DataFrame) -> DataFrame:
    """Add ``text`` (NULL unless UTF-8), ``error`` and the typed ``features``.

    A required key must be present; a NULL under it counts as present.  Stricter
    than a lenient parser: duplicate keys and NaN are not valid JSON here.
    """
    required = F.array(*[F.lit(c) for c in schemas.MODEL_INPUTS])
    # Each step only runs where the one before succeeded: a failed parse is dear.
    rows = (
        messages.withColumn("text", F.try_validate_utf8(F.col("value")))
        .withColumn("_whole", F.coalesce(_whole_json(F.col("text")), F.lit(False)))
        .withColumn("_keys", F.when(F.col("_whole"), F.json_object_keys("text")))
        .withColumn("_missing", F.array_except(required, F.col("_keys")))
    )
    error = (
        F.when(~F.col("_whole"), F.concat(
            F.lit("message at offset "), F.col("offset").cast("string"),
            F.lit(" is not valid JSON")))
        .when(F.col("_keys").isNull(), F.concat(
            F.lit("expected a JSON object, got "), _json_type(F.try_parse_json("text"))))
        .when(F.size("_missing") > 0, F.concat(
            F.lit("missing required fields: "), F.array_join("_missing", ", ")))
    )
    return (
        rows.withColumn("error", error)
        .withColumns({
            "_parsed": F.when(F.col("error").isNull(), F.from_json("text", _INPUTS)),
            ID: F.when(F.col("_keys").isNotNull(), F.get_json_object("text", f"$.{ID}")),
        })
        .withColumn("features", F.when(F.col("_parsed").isNotNull(), _typed("_parsed")))
        .drop("_whole", "_keys", "_missing", "_parsed")
    )


def unusable(features: str = "features") -> Column:
    """Inputs whose value does not fit its type, or is NULL, as a reason."""
    bad = F.array_compact(F.array(*[
        F.when(F.col(f"{features}.{c}").isNull(), F.lit(c)) for c in schemas.MODEL_INPUTS
    ]))
    return F.when(F.size(bad) > 0, F.concat(
        F.lit("scoring error: no usable value for "), F.array_join(bad, ", ")))


def dead_letters(rows: DataFrame) -> DataFrame:
    """Why and where from, with the payload readable and the raw bytes kept."""
    return rows.select(
        F.col("error").alias("reason"), "topic", "partition", "offset", "key",
        F.current_timestamp().alias("failed_at"),
        F.coalesce("text", F.make_valid_utf8(F.col("value").cast("string"))).alias("payload"),
        F.col("value").alias("raw"),
    )


def as_topic_rows(records: DataFrame, key: str | None = None) -> DataFrame:
    """``(key, value)`` for a topic: JSON value, keyed so one subscriber stays ordered."""
    payload = F.to_json(F.struct(*[c for c in records.columns if c != "raw"]))
    keyed = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return records.select(keyed.alias("key"), payload.cast("binary").alias("value"))
