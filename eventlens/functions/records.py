"""JSON records on the wire."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

CORRUPT = "_corrupt_record"


def encode(*columns: str) -> Column:
    """One JSON object per row; NULL fields are written so that no field is ever missing."""
    body = F.struct(*columns) if columns else F.struct("*")
    return F.to_json(body, {"ignoreNullFields": "false",
                            "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]'Z'"})


def decode(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Lenient decode: unreadable text and missing fields become NULL."""
    return df.withColumn("_r", F.from_json(value, schema)).select("_r.*")


def missing_fields(value: Column, schema: T.StructType) -> Column:
    """Names of the schema's fields that the JSON object lacks (a null value is present)."""
    names = F.array(*[F.lit(n) for n in schema.fieldNames()])
    return F.array_except(names, F.json_object_keys(value))


def decode_strict(df: DataFrame, schema: T.StructType, value: str = "value",
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """Fail the job on malformed text or on a missing field; ``carry`` columns stay beside it.

    FAILFAST alone takes a missing field for NULL, so the object's keys are
    tested as well. The test sits inside the parser's input: it cannot be
    pruned away when only some of the fields are read.
    """
    v, lacking = F.col("_text"), F.col("_lacking")
    checked = (F.when(lacking.isNull(),
                      F.raise_error(F.concat(F.lit("not a JSON object: "), v)).cast("string"))
                .when(F.size(lacking) > 0,
                      F.raise_error(F.concat(F.lit("missing fields ["),
                                             F.array_join(lacking, ", "),
                                             F.lit("] in "), v)).cast("string"))
                .otherwise(v))
    record = F.from_json(checked, schema, {"mode": "FAILFAST"})
    text = F.col(value)
    return (df.select(*carry, text.alias("_text"), missing_fields(text, schema).alias("_lacking"))
            .select(*carry, record.alias("_r")).select(*carry, "_r.*"))


def decode_or_quarantine(df: DataFrame, schema: T.StructType,
                         value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good records, rejected rows with their text and reason); nothing is lost."""
    lenient = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    v = F.col(value)
    parsed = (df.select(v.alias("_text"),
                        F.from_json(v, lenient, {"columnNameOfCorruptRecord": CORRUPT}).alias("_r"),
                        missing_fields(v, schema).alias("_lacking"))
                .withColumn("reason",
                            F.when(F.col("_lacking").isNull()
                                   | F.col(f"_r.{CORRUPT}").isNotNull(), F.lit("malformed"))
                             .when(F.size("_lacking") > 0,
                                   F.concat(F.lit("missing: "),
                                            F.array_join("_lacking", ", ")))))
    good = (parsed.where(F.col("reason").isNull())
                  .select(*[F.col(f"_r.{n}").alias(n) for n in schema.fieldNames()]))
    bad = parsed.where(F.col("reason").isNotNull()).select(F.col("_text").alias(value), "reason")
    return good, bad
