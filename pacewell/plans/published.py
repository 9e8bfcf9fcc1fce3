"""Model versions that are published whole, beside the ones in use.

A model is written to a folder of its own, then a row is appended to the table
of publications; the current version is the one of the last row. Readers look
there first, so they find either the version before or the new one whole, and
never a folder that is still being written. Nothing is overwritten: going back
to a version is another row, and two publishers at once cannot leave a mix.
"""

import re
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewell.errors import ModelNotReadyError, ValidationError
from pacewell.plans import model as models

PUBLICATIONS = "number long, version string, published_at timestamp"


def version_path(root: str, version: str) -> str:
    return f"{root}/versions/{version}"


def publications(spark: SparkSession, root: str) -> DataFrame:
    """All publications; a root without any has no rows."""
    try:
        return spark.read.schema(PUBLICATIONS).parquet(f"{root}/published")
    except AnalysisException:
        return spark.createDataFrame([], PUBLICATIONS)


def current_version(spark: SparkSession, root: str) -> str:
    """The version published last; of two that were published at once, the greater name."""
    last = publications(spark, root).orderBy(F.desc("number"), F.desc("version")).head()
    if last is None:
        raise ModelNotReadyError(f"no model is published at {root}")
    return last["version"]


def _point_at(spark: SparkSession, root: str, version: str) -> None:
    before = publications(spark, root).agg(F.max("number")).head()[0]
    row = spark.createDataFrame([((before or 0) + 1, version)], "number long, version string")
    row.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/published")


def publish(model: PipelineModel, root: str, version: str | None = None) -> str:
    """Stores a model as a new version and makes it the current one; a version that exists is refused."""
    spark = SparkSession.active()
    version = version or f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    if not re.fullmatch(r"[A-Za-z0-9._-]+", version):
        raise ValidationError(f"{version!r} is no name for a version")
    model.write().save(version_path(root, version))
    _point_at(spark, root, version)
    return version


def go_back(spark: SparkSession, root: str, version: str) -> None:
    """Makes a version current that was published before."""
    if not publications(spark, root).filter(F.col("version") == version).take(1):
        raise ModelNotReadyError(f"version {version} was never published at {root}")
    _point_at(spark, root, version)


def load_version(root: str, version: str) -> PipelineModel:
    return models.load(version_path(root, version))


class CurrentModel:
    """The current model, loaded anew only when another version has been published."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.version, self.model = None, None

    def get(self) -> tuple[str, PipelineModel]:
        version = current_version(self.spark, self.root)
        if version != self.version:
            self.model, self.version = load_version(self.root, version), version
        return self.version, self.model
