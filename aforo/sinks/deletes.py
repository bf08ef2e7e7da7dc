"""Conditional delete by file: only files that hold matching rows are written anew.

A delete works in a folder beside the data whose name readers pass over. It first holds the rows that stay, then the list
of the files they replace, which makes the delete final: those files go and the new ones take their place. A delete that broke
off before the list is undone by the next one, one that broke off after it is completed.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from aforo.session import drop_path, move_path

WORK, LIST, ROWS, FOLDER = "_delete-", "replaced", "rows", "__folder"


class _Tree:
    """A folder of files as its file system names it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        target = self.jvm.org.apache.hadoop.fs.Path(path)
        self.system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = self.system.makeQualified(target)

    def decoded(self, uri: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.jvm.java.net.URI(uri))

    def names(self, path: str) -> list[str]:
        place = self.jvm.org.apache.hadoop.fs.Path(path)
        return [s.getPath().getName() for s in self.system.listStatus(place)] if self.system.exists(place) else []

    def folder_of(self, file: Column) -> Column:
        """The folder of a file below the root, as in its address; a dot for the root itself."""
        below = re.escape(self.root.toUri().getRawPath())
        folder = F.regexp_extract(file, f"^[^/]*(?://[^/]*)?{below}/(?:(.*)/)?[^/]+$", 1)
        return F.when(folder == "", ".").otherwise(folder)


def _unescaped(tree: _Tree, name: str) -> str:
    return tree.jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)


def _replace(spark: SparkSession, tree: _Tree, work: str) -> None:
    """Remove the listed files and move the new ones to their folders; may be repeated."""
    for row in spark.read.text(f"{work}/{LIST}").collect():
        old = tree.decoded(row["value"])
        drop_path(spark, old.toString())
        if not [n for n in tree.names(old.getParent().toString()) if n[0] not in "_."] and old.getParent() != tree.root:
            # Files that take the emptied folder's place come next and make it again.
            drop_path(spark, old.getParent().toString())
    for folder in tree.names(f"{work}/{ROWS}"):
        if not folder.startswith(f"{FOLDER}="):
            continue
        inside = _unescaped(tree, folder[len(FOLDER) + 1 :])
        base = tree.root.toUri().toString()
        place = tree.root if inside == "." else tree.decoded(f"{base.rstrip('/')}/{inside}")
        tree.system.mkdirs(place)
        for file in tree.names(f"{work}/{ROWS}/{folder}"):
            if file[0] not in "_.":
                move_path(spark, f"{work}/{ROWS}/{folder}/{file}", f"{place.toString()}/{file}")
    drop_path(spark, work)


def finish_deletes(spark: SparkSession, path: str) -> None:
    """Complete or undo what an earlier delete left behind."""
    tree = _Tree(spark, path)
    for name in tree.names(path):
        if name.startswith(WORK):
            work = f"{tree.root.toString()}/{name}"
            if "_SUCCESS" in tree.names(f"{work}/{LIST}"):
                _replace(spark, tree, work)
            else:
                drop_path(spark, work)


def delete_rows(spark: SparkSession, path: str, where: Column | str) -> int:
    """Delete the rows of a path table for which ``where`` holds; returns the number of files that held some.

    Files without matching rows are left as they are, folders that lose all rows go. A NULL predicate keeps
    its row. The list of files passes through the driver, as Spark's own listing of the table does.
    """
    finish_deletes(spark, path)
    try:
        table = spark.read.parquet(path)
    except AnalysisException as nothing:
        if nothing.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return 0
    condition = F.coalesce(F.expr(where) if isinstance(where, str) else where, F.lit(False))
    file = F.col("_metadata.file_path")
    hit = [r["file"] for r in table.where(condition).select(file.alias("file")).distinct().collect()]
    if not hit:
        return 0
    tree = _Tree(spark, path)
    work = f"{tree.root.toString()}/{WORK}{uuid.uuid4().hex}"
    touched = spark.read.schema(table.schema).option("basePath", tree.root.toString())
    touched = touched.parquet(*[tree.decoded(f).toString() for f in hit])
    rest = touched.where(~condition)
    # Partition columns live in the folders' names and the new files go to the same folders.
    stored = [c for c in table.columns if c not in _partitions(hit, tree)]
    rows = rest.select(*[F.col(f"`{c}`") for c in stored], tree.folder_of(file).alias(FOLDER))
    rows.write.partitionBy(FOLDER).parquet(f"{work}/{ROWS}")
    spark.createDataFrame([(f,) for f in hit], "value string").coalesce(1).write.text(f"{work}/{LIST}")
    _replace(spark, tree, work)
    return len(hit)


def _partitions(files: list[str], tree: _Tree) -> set[str]:
    """Names of the partition columns, from the folders of one file."""
    inside = tree.decoded(files[0]).toString()[len(tree.root.toString()) :]
    return {_unescaped(tree, part.split("=", 1)[0]) for part in inside.split("/")[:-1] if "=" in part}


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.where("col_name = 'Location'").first()["data_type"]


def delete_from(spark: SparkSession, name: str, where: Column | str) -> int:
    """Conditional delete on a catalog table of Parquet files, see :func:`delete_rows`.

    Partitions that lose all rows leave the catalog, too.
    """
    files = delete_rows(spark, table_location(spark, name), where)
    if files:
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.catalog.refreshTable(name)
    return files

