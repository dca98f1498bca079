"""JSON documents of pipelines, slices and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIPELINES = (
    "name string, activities array<struct<name: string, type: string, "
    "inputs: array<string>, outputs: array<string>>>, start timestamp, end timestamp"
)
# Documents as the orchestrator keeps them: properties nested, datasets named by object.
PIPELINE_DOCUMENTS = (
    "name string, properties struct<activities: array<struct<name: string, type: string, "
    "inputs: array<struct<name: string>>, outputs: array<struct<name: string>>>>, "
    "start: timestamp, end: timestamp>"
)
SLICES = (
    "dataset string, start timestamp, end timestamp, status string, state string, retryCount int, "
    "longRetryCount int, statusUpdateTimestamp timestamp"
)
RUNS = (
    "id string, dataset string, dataSliceStart timestamp, pipelineName string, activityName string, "
    "type string, status string, retryAttempt int, percentComplete int, processingStartTime timestamp, "
    "processingEndTime timestamp, hasLogs boolean, errorMessage string"
)


def read_json(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line)
    return reader.json(path)


def read_slices_of(spark: SparkSession, path: str, since: Column, until: Column, multi_line: bool = False) -> DataFrame:
    """Slice documents whose start lies in [since, until), with state and retry counts."""
    documents = read_json(spark, path, SLICES, multi_line)
    return documents.where((F.col("start") >= since) & (F.col("start") < until))


def read_pipelines(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Pipeline documents flattened to names of inputs and outputs."""
    documents = read_json(spark, path, PIPELINE_DOCUMENTS, multi_line)
    return documents.selectExpr(
        "name",
        "transform(properties.activities, a -> named_struct('name', a.name, 'type', a.type, "
        "'inputs', a.inputs.name, 'outputs', a.outputs.name)) as activities",
        "properties.start as start",
        "properties.end as end",
    )
