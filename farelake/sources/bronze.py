"""Line-delimited JSON bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import schema as S
from farelake.operators.state import successful_raw
from farelake.session import work_path
from farelake.sources import storage

CORRUPT = "_corrupt_record"


def read_bronze(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = S.BRONZE
) -> DataFrame:
    """Bundles merged by column name; a missing field is NULL and a broken line is kept as text.

    ``schema=None`` infers the columns from all lines instead, at the price of a second scan.
    """
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
    return reader.json(paths)


def _grown(known: T.DataType, found: T.DataType) -> T.DataType:
    """``known`` with the fields that only ``found`` has; types that are known stay."""
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(_grown(known.elementType, found.elementType))
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        news = {f.name: f.dataType for f in found}
        fields = [T.StructField(f.name, _grown(f.dataType, news.pop(f.name, f.dataType))) for f in known]
        return T.StructType([*fields, *[T.StructField(name, _storable(kind)) for name, kind in news.items()]])
    return known


def _storable(kind: T.DataType) -> T.DataType:
    """A type that silver can hold: fields that are always null, or of several types, become text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _storable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_storable(kind.elementType))
    return T.StringType() if isinstance(kind, T.NullType | T.VariantType) else T.DoubleType() if isinstance(kind, T.DecimalType) else kind


def read_growing(spark: SparkSession, paths: str | list[str], schema: T.StructType = S.BRONZE) -> DataFrame:
    """Bundles with the fields of ``schema`` and, behind them, every other field that any line or offer has.

    Lines are parsed once, to VARIANT values written aside; their common schema is an aggregate over those. Broken lines are kept as text, and a
    value of another type than known reads as NULL.
    """
    aside = work_path(spark, "variants")
    lines = spark.read.text(paths)
    lines.select("value", F.try_parse_json("value").alias("doc"), F.col("_metadata.file_path").alias("file_path")).write.parquet(aside)
    docs = spark.read.schema("value string, doc variant, file_path string").parquet(aside)
    whole = F.col("doc").isNotNull() & F.schema_of_variant("doc").startswith("OBJECT")
    told = docs.filter(whole).agg(F.schema_of_variant_agg("doc")).collect()[0][0]
    found = T.DataType.fromDDL(told.replace("OBJECT<", "struct<")) if told and told.startswith("OBJECT<") else T.StructType()
    full = _grown(schema, found)
    get = [F.when(whole, F.try_variant_get("doc", f"$['{f.name}']", f.dataType.simpleString())).alias(f.name) for f in full]
    broken = F.when(F.coalesce(~whole, F.lit(True)), F.col("value")).alias(CORRUPT)
    return docs.select(*get, broken, bundle_of(F.col("file_path")).alias("bundle"))


def bronze_lines(state: DataFrame) -> DataFrame:
    """One JSON text per successful row, with the eight bundle fields in order.

    Offers keep their stored text: order of keys, spelling of numbers and fields no schema knows. Only line ends in it,
    which JSON allows between values alone, become spaces. Text that is no JSON makes a line that readers report as broken.
    Times are written with all their digits.
    """
    def member(name: str) -> Column:
        if name == "flights":
            return F.concat(F.lit('"flights":'), F.coalesce(F.regexp_replace(name, r"[\r\n]", " "), F.lit("null")))
        one = F.to_json(F.struct(F.col(name).cast("string").alias(name)), {"ignoreNullFields": "false"})
        return F.substring(one, F.lit(2), F.length(one) - 2)

    line = F.concat(F.lit("{"), F.concat_ws(",", *[member(c) for c in S.BRONZE_COLUMNS]), F.lit("}"))
    return successful_raw(state).select(line.alias("value"))


def export_bronze(state: DataFrame, path: str, compression: str = "gzip") -> bool:
    """Write the bundle in key order; without a successful row write nothing and return False.

    The successful rows are written aside once and counted on the way; sorting, which reads its input twice, starts from there.
    """
    spark, aside, counted = state.sparkSession, work_path(state.sparkSession, "export"), Observation()
    good = state.filter("success = 1").select(*S.BRONZE_COLUMNS, "success")
    good.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(aside)
    kept = spark.read.schema(good.schema).parquet(aside)
    if not storage.measured(counted, lambda: {"n": kept.count()})["n"]:
        return False
    bronze_lines(kept).write.text(path, compression=compression)
    return True


def bundle_of(file_path: Column) -> Column:
    """The name of the bundle that a file is, or is a part of; the path itself where it has no such name."""
    name = F.regexp_extract(file_path, r"/(search_[^/]*?)\.jsonl?(?:\.gz)?(?:/[^/]*)?$", 1)
    return F.when(name != "", name).otherwise(file_path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Broken lines with the bundle they came in; no rows where none was broken."""
    return spark.read.schema(f"{CORRUPT} string, bundle string").parquet(path)


def latest_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """Path of the bundle modified last (by time, not name); no row when there is none.

    Only file listings are read. Bundle folders written by Spark count through their part files.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        .select("path", "modificationTime")
    )
    name = r"^(.*/search_[^/]*\.jsonl?(?:\.gz)?)(?:/part-[^/]*)?$"
    bundles = files.withColumn("bundle", F.regexp_extract("path", name, 1)).filter("bundle <> ''")
    per_bundle = bundles.groupBy("bundle").agg(F.max("modificationTime").alias("modified"))
    # Equal times: the path that sorts first.
    return per_bundle.orderBy(F.col("modified").desc(), "bundle").limit(1)


def require_latest_bundle(spark: SparkSession, folder: str) -> str:
    found = latest_bundle(spark, folder).head()
    if found is None:
        raise FileNotFoundError(f"no search_*.jsonl bundle in {folder}")
    return found["bundle"]
