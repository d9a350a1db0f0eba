"""Session settings and the scratch folder. The master is left to spark-submit."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

_scratch: dict[tuple[str, str], str] = {}  # folders of this process, by application and base


def get_session(app_name: str, conf: Mapping[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution and UTC timestamps, plus the caller's settings."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def object_store_conf(
    endpoint: str = "s3.amazonaws.com",
    credentials_provider: str | None = None,
    access_key_env: str = "AWS_ACCESS_KEY_ID",
    secret_key_env: str = "AWS_SECRET_ACCESS_KEY",
) -> dict[str, str]:
    """Settings for ``s3a://`` paths, to pass to :func:`get_session`.

    Keys come from the environment and are left out when unset, so that the
    connector's own credential chain applies.
    """
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
    }
    if credentials_provider:
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = credentials_provider
    access_key, secret_key = os.environ.get(access_key_env), os.environ.get(secret_key_env)
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def object_path(bucket: str, *parts: str, scheme: str = "s3a") -> str:
    """``s3a://bucket/part/part`` for use with any Spark reader."""
    return f"{scheme}://" + "/".join([bucket, *(part.strip("/") for part in parts)])


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared ``spark.checkpoint.dir``, else under the warehouse.

    All of a session's scratch lies in one folder, which Hadoop removes when the
    driver's JVM ends. Without the setting, a session on a cluster is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    key = (spark.sparkContext.applicationId, base)
    if key not in _scratch:
        _scratch[key] = f"{base.rstrip('/')}/tallyloom-{uuid.uuid4().hex}"
        folder = spark._jvm.org.apache.hadoop.fs.Path(_scratch[key])
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{_scratch[key]}/{name}-{uuid.uuid4().hex}"
