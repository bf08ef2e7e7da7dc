"""Trade declaration files: delimited text, plain or in zip archives."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator, Sequence
from functools import partial

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.session import staged
from aforo.sources.files import sanitize_names
from aforo.sources.quoted import LONGEST_RECORD, read_records, split_parity, tasks_for

# The archive readers travel with the tasks, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

SEPARATOR = ";"
BATCH = 4096
CORRUPT = "__corrupt"


def text_schema(names: Sequence[str]) -> T.StructType:
    """Landing schema: every column as text."""
    return T.StructType([T.StructField(n, T.StringType()) for n in sanitize_names(names)])


def read_trade(
    spark: SparkSession,
    paths: str | Sequence[str],
    names: Sequence[str],
    quoted_line_ends: bool | None = None,
    **options: str,
) -> DataFrame:
    """``;`` files without header, all of one layout, as one frame of text columns.

    A line with another number of fields fails the job. Quoted fields may hold line ends, wherever a file is split;
    ``quoted_line_ends`` says if there are any, None finds out with a scan that counts quotes. Files without any go to
    Spark's own reader.
    """
    parity = tasks = None
    if quoted_line_ends is None:
        tasks = tasks_for(spark, paths)
        parity = staged(split_parity(spark, paths, tasks), "parity").coalesce(tasks)
        quoted_line_ends = not parity.where("odd_lines > 0").isEmpty()
    if quoted_line_ends:
        return parse_records(read_records(spark, paths, parity=parity, tasks=tasks), names, **options)
    return (
        spark.read.schema(text_schema(names))
        # Without all columns parsed, a pruned scan would not notice a wrong number of fields.
        .options(
            sep=SEPARATOR, header="false", mode="FAILFAST", escape='"', columnPruning="false"
        )
        .options(**options)
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def file_system(path: str):
    """(file system, path inside it) of a path as Spark writes it."""
    from pyarrow import fs

    uri = path.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        uri = uri[len("file:") :].replace("///", "/", 1)
    return fs.FileSystem.from_uri(uri)


def _open(path: str):
    """A seekable stream on the archive, read in pieces from wherever it lives."""
    system, inner = file_system(path)
    return system.open_input_file(inner)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            with _open(path) as raw, zipfile.ZipFile(raw) as archive:
                names = [i.filename for i in archive.infolist() if i.filename.endswith(".txt")]
            yield pd.DataFrame({"path": path, "member": names}, dtype="object")


def _lines(text: io.TextIOBase) -> Iterator[str]:
    """Lines of a stream, a longer one than a record may be in pieces."""
    while piece := text.readline(LONGEST_RECORD + 1):
        yield piece


def _records(lines: Iterator[str], fields: int | None = None, longest: int = LONGEST_RECORD) -> Iterator[str]:
    """Lines to records: a line end inside quotes belongs to the record.

    A quote that is never closed would take in the rest of the member. With the number of ``fields`` known a record
    fails as soon as it has more of them, counted up to its last complete line, and in any case at ``longest`` characters.
    """
    pending: list[str] = []
    inside, size, found = False, 0, 1
    for number, line in enumerate(lines, 1):
        # Separators count where an even number of quotes stands before them.
        found += sum(part.count(SEPARATOR) for part in line.split('"')[inside::2])
        pending.append(line)
        size += len(line)
        inside ^= line.count('"') % 2 == 1
        if (fields and found > fields) or size > longest:
            raise ValueError(
                f"malformed record: {found} fields in {size} characters up to line {number}, where "
                f"{fields or 'some'} fields are due: {pending[0][:80]!r}"
            )
        if not inside and line.endswith(("\n", "\r")):
            yield "".join(pending).rstrip("\r\n")
            pending, size, found = [], 0, 1
    if pending:
        if inside:
            raise ValueError(f"malformed record: a quote is not closed: {pending[0][:80]!r}")
        yield "".join(pending).rstrip("\r\n")


def _decode(batches: Iterator[pd.DataFrame], fields: int | None = None) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, member in zip(batch["path"], batch["member"], strict=True):
            with _open(path) as raw, zipfile.ZipFile(raw) as archive, archive.open(member) as data:
                start, block = 1, []
                for record in _records(_lines(io.TextIOWrapper(data, encoding="utf-8", newline="")), fields):
                    block.append(record)
                    if len(block) == BATCH:
                        yield _block(path, member, start, block)
                        start, block = start + len(block), []
                if block:
                    yield _block(path, member, start, block)


def _block(path: str, member: str, start: int, values: list[str]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "path": path,
            "member": member,
            "line_no": range(start, start + len(values)),
            "value": values,
        }
    )


def read_archives(
    spark: SparkSession, archives: DataFrame, prefix: str, tasks: int | None = None, fields: int | None = None
) -> DataFrame:
    """Records of the ``.txt`` members whose base name starts with ``prefix``.

    With the number of ``fields`` given, the first record that has more fails the job, so that an unclosed quote
    never gathers a member in one task.

    ``archives`` has a ``path`` column, as ``trade_paths`` gives. Columns: path, member, line_no,
    value. The archives are listed first and the members then spread over ``tasks`` tasks, so one
    task streams one member at a time in small batches, whatever the size of the archive.
    """
    tasks = tasks or max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    members = (
        archives.select("path")
        .repartition(tasks, "path")
        .mapInPandas(_members, "path string, member string")
    )
    base = F.element_at(F.split("member", "/"), -1)
    return (
        members.filter(base.startswith(prefix))
        .repartition(tasks, "path", "member")
        .mapInPandas(partial(_decode, fields=fields), "path string, member string, line_no long, value string")
    )


def parse_records(
    records: DataFrame, names: Sequence[str], keep: Sequence[str] = (), strict: bool = True, **more: str
) -> DataFrame:
    """Split the ``value`` column into text columns by position.

    A record with another number of fields fails the job; with ``strict`` off it is kept in a column
    ``__corrupt``. ``more`` are options of Spark's reader.
    """
    schema = text_schema(names)
    if not strict:
        schema = schema.add(CORRUPT, T.StringType())
    options = {"sep": SEPARATOR, "mode": "FAILFAST" if strict else "PERMISSIVE", "escape": '"'}
    options |= more
    if not strict:
        options["columnNameOfCorruptRecord"] = CORRUPT
    ddl = ", ".join(f"`{f.name}` string" for f in schema.fields)
    parsed = F.from_csv("value", ddl, options)
    return records.select(*keep, parsed.alias("__row")).select(*keep, "__row.*")


def read_trade_archives(
    spark: SparkSession, archives: DataFrame, prefix: str, names: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Zip archives to one frame of text columns, like :func:`read_trade` for plain files.

    ``keep`` takes columns of :func:`read_archives`, such as the path of the archive, along.
    """
    return parse_records(read_archives(spark, archives, prefix, fields=len(sanitize_names(names))), names, keep)
