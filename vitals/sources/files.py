"""Files and folders of any Hadoop file system."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = hadoop(spark, path)
    return files.exists(hadoop_path)


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder to a name that is not taken; False if it is."""
    jvm = spark._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(paths[1].toUri(), spark._jsc.hadoopConfiguration())
    # Unlike that of a file system, this rename fails where the target is there.
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(*paths, options)
    except Py4JJavaError:
        if path_exists(spark, target):
            return False
        raise
    return True


def is_folder(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = hadoop(spark, path)
    return files.getFileStatus(hadoop_path).isDirectory()
