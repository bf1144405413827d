"""Writers: attribute CSVs, tab-separated masters, dated extracts, publish.

Output names carry an ``as_of`` date passed in by the caller (never the
clock inside a plan), so a re-run of the same day rewrites the same paths.
Publishing writes new dated versions, takes the next publication number, which only
one publisher can, and repoints ``CURRENT``; the master a plan reads is never
overwritten by the same plan, and an earlier publication can be restored. A frame published
in parts (``Parts``) writes only those that changed and keeps the folders of the others.
"""

from __future__ import annotations

import csv
import datetime as _dt
import io
import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode.session import delete_path, setting

_PART = "published_part"


def write_attribute_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header, missing as ``NA``. Values are quoted only when needed
    (a bare comma would corrupt an unquoted file)."""
    (df.write.mode(mode).option("header", "true").option("nullValue", "NA")
       .option("escape", '"').csv(path))
    return path


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Tab-separated, missing and empty both written as an empty field."""
    (df.write.mode(mode).option("header", "true").option("sep", "\t")
       .option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path))
    return path


def write_quoted_csv(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8") -> str:
    """Every value quoted, quotes doubled inside values.

    Spark itself writes UTF and Latin-1; other encodings of its readers, such as
    ``windows-1252``, are those of Java, which a setting allows for this write.
    """
    with setting(df.sparkSession, "spark.sql.legacy.javaCharsets", "true"):
        (df.write.mode(mode).option("header", "true").option("quoteAll", "true")
           .option("escape", '"').option("encoding", encoding).csv(path))
    return path


def dated_path(root: str, stem: str, as_of: _dt.date, ext: str = "") -> str:
    return f"{root.rstrip('/')}/{stem}_{as_of.isoformat()}{ext}"


class PublishConflict(RuntimeError):
    """Another publisher was faster, or what is published is not what the caller has read."""


@dataclass(frozen=True)
class Parts:
    """A frame published in parts, one for each value of ``by`` (one in all without it).

    Rows of ``df`` are written, each part sorted by ``order`` (missing values last), with
    ``columns`` only if given. ``kept`` are folders of earlier publications by part: they
    are published again without being read or written, before new rows of the same part.
    """

    df: DataFrame
    by: str | None = None
    order: Sequence[str] = ()
    columns: Sequence[str] | None = None
    kept: dict[str, list[str]] = field(default_factory=dict)


#: What a publication says of a frame: its folder, or its schema and the folders of its parts.
Version = str | dict


def part_label(value: str | None) -> str:
    """Name of the part that holds the rows with ``value``; missing and empty values have parts of their own."""
    return "none" if value is None else f"is-{value}"


def _label(by: str | None) -> Column:
    value = F.lit(None).cast("string") if by is None else F.col(f"`{by}`").cast("string")
    return F.when(value.isNull(), F.lit("none")).otherwise(F.concat(F.lit("is-"), value))


def published_parts(version: Version | None) -> dict[str, list[str]]:
    """Folders by part of a frame published in parts; none before its first publication."""
    if isinstance(version, str):
        raise ValueError(f"{version} is not published in parts")
    return dict(version["parts"]) if version else {}


def read_published(spark: SparkSession, version: Version, values: Iterable[str | None] | None = None) -> DataFrame:
    """The rows of a published frame; of the parts of ``values`` only, if given."""
    if isinstance(version, str):
        return spark.read.parquet(version)
    schema = T.StructType.fromJson(version["schema"])
    labels = version["parts"] if values is None else [part_label(v) for v in values]
    folders = [folder for label in labels for folder in version["parts"].get(label, [])]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _write_parts(parts: Parts, folder: str) -> Version:
    """Rows go to the folder of their part. With an order they are sorted by part first, so a task writes
    few parts; rows that tie are told apart by their hash, so one place or year may fill many tasks. Without one
    nothing is shuffled: a range of the part alone would be a single task for a whole year.
    """
    spark, names = parts.df.sparkSession, list(parts.columns or parts.df.columns)
    labelled = parts.df.withColumn(_PART, _label(parts.by))
    if parts.order:
        tie = F.xxhash64(*[f"`{c}`" for c in names])
        labelled = labelled.orderBy(_PART, *[F.col(f"`{c}`").asc_nulls_last() for c in parts.order], tie)
    labelled.select(*[f"`{c}`" for c in names], _PART).write.partitionBy(_PART).parquet(folder)
    fs, target = _file_system(spark, folder)
    found = {label: list(folders) for label, folders in parts.kept.items()}
    for status in fs.listStatus(target):
        name, _, label = status.getPath().getName().partition("=")
        if name == _PART:
            found.setdefault(unquote(label), []).append(f"{folder}/{status.getPath().getName()}")
    return {"schema": parts.df.select(*[f"`{c}`" for c in names]).schema.jsonValue(), "parts": dict(sorted(found.items()))}


def publish(frames: dict[str, DataFrame | Parts], root: str, as_of: _dt.date, expected: int | None = None) -> dict[str, Version]:
    """Write a new version of every frame, then publish all of them at once.

    Versions have folders of their own (``<name>/version=<as_of>-<run>``), so
    earlier ones stay as the archive and a run that failed half-way can simply be
    repeated. Publications are numbered. ``expected`` is the number that the frames were made
    from, the one at the start of this call unless given; if another publisher has taken the
    next number meanwhile, this one raises ``PublishConflict``, and what it wrote stays unpublished.
    """
    first = next(iter(frames.values()))
    spark = (first.df if isinstance(first, Parts) else first).sparkSession
    root = root.rstrip("/")
    base = publication_number(spark, root) if expected is None else expected
    run = uuid.uuid4().hex[:8]
    targets: dict[str, Version] = {}
    for name, df in frames.items():
        folder = f"{root}/{name}/version={as_of.isoformat()}-{run}"
        if isinstance(df, Parts):
            targets[name] = _write_parts(df, folder)
        else:
            df.write.parquet(folder)
            targets[name] = folder
    _publish(spark, root, base, targets)
    return targets


def restore(spark: SparkSession, root: str, number: int, expected: int | None = None) -> dict[str, Version]:
    """Publish the versions of publication ``number`` again, under the next number; nothing is rewritten."""
    root = root.rstrip("/")
    known = dict(publications(spark, root))
    if number not in known:
        raise ValueError(f"{root} has no publication {number}")
    base = publication_number(spark, root) if expected is None else expected
    _publish(spark, root, base, known[number])
    return known[number]


def publications(spark: SparkSession, root: str) -> list[tuple[int, dict[str, Version]]]:
    """All publications with the folders of their frames, oldest first."""
    return [(n, json.loads(_read_text(spark, f"{_log(root)}/{n:09d}"))) for n in _numbers(spark, root)]


def publication_number(spark: SparkSession, root: str) -> int:
    """Number of the publication that readers see; 0 before the first."""
    return max(_numbers(spark, root), default=0)


def current_versions(spark: SparkSession, root: str) -> dict[str, Version]:
    """Folder (or parts) of the published version of each frame; empty before the first publication."""
    number = publication_number(spark, root)
    return json.loads(_read_text(spark, f"{_log(root)}/{number:09d}")) if number else {}


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/publications"


def _publish(spark: SparkSession, root: str, base: int, targets: dict[str, Version]) -> None:
    """Take number ``base`` + 1, which only one publisher can, then repoint ``CURRENT`` for other readers."""
    text = json.dumps(targets)
    if publication_number(spark, root) != base or not _put_text(spark, f"{_log(root)}/{base + 1:09d}", text, replace=False):
        raise PublishConflict(f"{root}: publication {base} is no longer the last one")
    _put_text(spark, f"{root}/CURRENT", text, replace=True)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _file_system(spark, _log(root))
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def _put_text(spark: SparkSession, path: str, text: str, replace: bool) -> bool:
    """Write a small file by one rename; without ``replace`` False if there is one already."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs, target = _file_system(spark, path)
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
    stream = fs.create(fresh)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE if replace else rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(fresh, target, how)
    except Py4JJavaError as error:
        fs.delete(fresh, False)
        if replace or "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
    return True


def write_one_file(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8", quote_all: bool = True, missing: str = "") -> str:
    """One CSV file at ``path`` with one header, rows in the order of ``df``.

    Spark writes the parts in parallel, without headers; the file system's streams then
    join them in order, through a buffer, and one rename puts the file in place. A
    report that other programmes open is one file; large outputs stay in parts.
    """
    spark = df.sparkSession
    parts = f"{path}-parts-{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.legacy.javaCharsets", "true"):
        (df.write.option("header", "false").option("sep", sep).option("quoteAll", str(quote_all).lower()).option("nullValue", missing)
           .option("emptyValue", "").option("escape", '"').option("encoding", encoding).csv(parts))
    head = io.StringIO()
    csv.writer(head, delimiter=sep, quoting=csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL, lineterminator="\n").writerow(df.columns)
    fs, target = _file_system(spark, path)
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    fresh = hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
    out = fs.create(fresh)
    out.write(bytearray(head.getvalue().encode(encoding)))
    names = sorted(p for p in (status.getPath().toString() for status in fs.listStatus(hadoop.fs.Path(parts))) if p.rpartition("/")[2].startswith("part-"))
    for name in names:
        part = fs.open(hadoop.fs.Path(name))
        hadoop.io.IOUtils.copyBytes(part, out, conf, False)
        part.close()
    out.close()
    if fs.exists(target):
        fs.delete(target, True)
    fs.rename(fresh, target)
    delete_path(spark, parts)
    return path
