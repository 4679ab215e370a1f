"""CSV, stop-word, libsvm and model files."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfscore.sources.scratch import written


def scan_csv(
    spark: SparkSession, path: str, schema: StructType, strict: bool = True, line_breaks: bool = False
) -> DataFrame:
    """Header CSV with declared types; quotes inside fields are doubled.

    A value that is not of its type fails the job, or reads as null if not
    strict. Files are split between tasks unless fields may hold line breaks."""
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    reader = reader.option("mode", "FAILFAST" if strict else "PERMISSIVE").option("multiLine", line_breaks)
    return reader.csv(path)


REJECTED = "_rejected"


def scan_csv_with_rejects(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Header CSV read once, split into the rows that parse and the lines that
    do not, so a bad line neither fails the job nor hides as nulls.

    Good rows have the declared columns. Rejected lines are (file, line, reason)
    with the raw text of the record; reason is the first that holds of:
    ``unclosed quote`` (an odd number of double quotes), ``too many fields``,
    ``too few fields``, ``not a <type>: <column>`` (the first field, in schema
    order, that is present but does not parse or does not fit its type).
    Every data line is in exactly one of the two outputs. The files are parsed
    once into a written table in the shared folder that both outputs read:
    Spark refuses a CSV scan that needs only the raw-text column (as a count
    would), and the second reader does not parse the files again."""
    if REJECTED in schema.fieldNames():
        raise ValueError(f"{REJECTED} is reserved for the raw text of rejected lines")
    read = StructType([*schema.fields, StructField(REJECTED, StringType())])
    options = {"header": True, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    parsed = spark.read.schema(read).options(**options).csv(path).withColumn("file", F.col("_metadata.file_path"))
    scanned = written(parsed, "csv-parsed")
    good = scanned.where(F.col(REJECTED).isNull()).select(*schema.fieldNames())

    names = schema.fieldNames()
    raw = F.col(REJECTED)
    texts = StructType([StructField(f"f{i}", StringType()) for i in range(len(names) + 1)] + [StructField("_odd", StringType())])
    fields = F.from_csv(raw, texts.simpleString(), {"escape": '"', "columnNameOfCorruptRecord": "_odd"})
    quotes = F.length(raw) - F.length(F.regexp_replace(raw, '"', ""))
    typed = [
        F.when(fields[f"f{i}"].isNotNull() & F.col(name).isNull(), F.lit(f"not a {schema[name].dataType.simpleString()}: {name}"))
        for i, name in enumerate(names)
    ]
    reason = (
        F.when(quotes % 2 == 1, F.lit("unclosed quote"))
        .when(fields[f"f{len(names)}"].isNotNull(), F.lit("too many fields"))
        .when(fields[f"f{len(names) - 1}"].isNull() & ~raw.endswith(","), F.lit("too few fields"))
        .otherwise(F.coalesce(*typed, F.lit("unparsable")))
    )
    rejected = scanned.where(raw.isNotNull()).select("file", raw.alias("line"), reason.alias("reason"))
    return good, rejected


def write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def rename_columns(df: DataFrame, *names: str) -> DataFrame:
    """Rename by position."""
    return df.toDF(*names)


def load_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words of a word-per-line file. Splitting on non-word characters
    drops the trailing comma and breaks don't into don and t."""
    lines = spark.read.text(path)
    words = lines.select(F.explode(F.split(F.lower("value"), r"\W+")).alias("word"))
    return words.where(F.col("word") != "").distinct()


def write_libsvm(df: DataFrame, path: str) -> str:
    df.select("label", "features").write.format("libsvm").save(path)
    return path


def read_libsvm(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    """label and features; naming the size saves the pass that would find it."""
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether the writer of a folder has put its success file there."""
    try:
        spark.read.text(f"{path}/_SUCCESS")
    except AnalysisException:
        return False
    return True


def materialize_once(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write under the feature set's own name unless a finished set is there.
    What a broken run has left is replaced."""
    path = f"{root}/{name}"
    if not _complete(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_or_load(estimator: Pipeline, training: DataFrame, path: str) -> PipelineModel:
    """Train and save only if no finished model is stored at the path, then
    load it. A note beside the model is written last and says that it is
    finished."""
    spark = training.sparkSession
    if not _complete(spark, f"{path}/finished"):
        estimator.fit(training).write().overwrite().save(f"{path}/model")
        spark.range(1).write.mode("overwrite").parquet(f"{path}/finished")
    return PipelineModel.load(f"{path}/model")


# ---- reuse by content ------------------------------------------------------


def content_key(sources: list[DataFrame], params: dict | None = None) -> str:
    """A digest of the rows of the sources as multisets, their schemas and the
    parameters. Each row's 64-bit hash is summed in two 32-bit halves as exact
    decimals, so the order and partitioning of rows change nothing, and a
    changed, added or removed row changes the sums. One aggregate per source."""
    parts = []
    for df in sources:
        h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) if df.columns else F.lit(0).cast("long")
        low = F.pmod(h, F.lit(2**32)).cast("decimal(38,0)")
        high = F.shiftrightunsigned(h, 32).cast("decimal(38,0)")
        row = df.agg(F.count("*"), F.sum(low), F.sum(high)).first()
        parts.append(f"{df.schema.simpleString()}|{row[0]}|{row[1] or 0}|{row[2] or 0}")
    parts.append(repr(sorted((str(k), repr(v)) for k, v in (params or {}).items())))
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:32]


def _pointed(spark: SparkSession, pointer: str) -> str | None:
    """The folder a finished pointer names, or None."""
    if not _complete(spark, pointer):
        return None
    return spark.read.parquet(pointer).first()["path"]


def _point(spark: SparkSession, pointer: str, path: str) -> None:
    """Written last: only a finished folder is ever named."""
    spark.createDataFrame([(path,)], "path string").coalesce(1).write.mode("overwrite").parquet(pointer)


def stored_by_content(df: DataFrame, root: str, name: str, sources: list[DataFrame], params: dict | None = None) -> DataFrame:
    """df written once per content of its sources and parameters, then read.

    The set lies in a folder of its own run under the content key; a pointer
    named by the key is written after it. A later call with equal sources (in
    any order) reads the set the pointer names; a changed source makes a new
    key, so a stale set is never read. Two writers of one key write two
    folders, both whole, and the pointer names one of them."""
    spark = df.sparkSession
    key = content_key(sources, params)
    pointer = f"{root}/{name}/{key}.pointer"
    path = _pointed(spark, pointer)
    if path is None:
        path = f"{root}/{name}/{key}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        _point(spark, pointer, path)
    return spark.read.schema(df.schema).parquet(path)


def _estimator_params(estimator) -> dict:
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
    found = {}
    for k, stage in enumerate(stages):
        for param, value in stage.extractParamMap().items():
            found[f"{k}.{type(stage).__name__}.{param.name}"] = value
    return found


def fit_or_load_by_content(estimator: Pipeline, training: DataFrame, root: str, name: str) -> PipelineModel:
    """A model saved once per content of its training rows and the
    estimator's parameters, as stored_by_content keeps sets."""
    spark = training.sparkSession
    key = content_key([training], _estimator_params(estimator))
    pointer = f"{root}/{name}/{key}.pointer"
    path = _pointed(spark, pointer)
    if path is None:
        path = f"{root}/{name}/{key}-{uuid.uuid4().hex}"
        estimator.fit(training).write().save(path)
        _point(spark, pointer, path)
    return PipelineModel.load(path)
