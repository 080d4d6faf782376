"""Versioned tables: rows go to a fresh folder, then one small file that names all current folders makes them visible.

Below the table's path lie ``data/<key>/version=<id>`` with Parquet files and ``log/<number>.json``. A log file is written under
another name and then renamed to a name that must not exist, so it appears whole and only once. A write that fails
before that leaves the current version as it was. A reader takes the newest number (or a given one) and sees exactly
the folders it lists, whatever is written meanwhile. Two writers of different keys both succeed: the second one finds
its number taken, reads the log again and adds its key to that. Of two writers of one key the last one stands.

Keys are partitions such as ``run_date=2024-01-31``; putting a key replaces that partition only, also by no rows.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

SPECIAL = re.compile(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]")  # characters of a value that a folder name holds as %XX
LOG_FILE = re.compile(r"(\d{20})\.json")
TRIES = 50  # a writer that is overtaken so often gives up


class CommitConflict(RuntimeError):
    """Other writers took every number that this one tried."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    """The file system of a path."""
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _read(spark: SparkSession, path: str) -> str:
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file that appears whole under its name; false if the name is taken."""
    jvm, draft = spark._jvm, f"{path}.{uuid.uuid4().hex}.draft"
    stream = _files(spark, path).create(_path(spark, draft), False)
    stream.write(bytearray(text.encode()))
    stream.close()
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    once = spark.sparkContext._gateway.new_array(kind, 1)
    once[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _files(spark, path).getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    try:
        context.rename(_path(spark, draft), _path(spark, path), once)
        return True
    except Exception as error:
        _files(spark, path).delete(_path(spark, draft), False)
        if "FileAlreadyExistsException" in str(error):
            return False
        raise


def _names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, time of change in milliseconds) of what lies in a folder; nothing if there is no folder."""
    files = _files(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(_path(spark, folder))]


@dataclass(frozen=True)
class Snapshot:
    """One version of a table: its number, and for each key the folder (below the table) and the schema of its rows."""

    number: int = 0
    keys: dict[str, dict] = field(default_factory=dict)


def _key(values: dict) -> str:
    """Folder name of a key, as Spark writes partitions."""
    if not values or any(v is None for v in values.values()):
        raise ValueError("a key needs values that are not NULL")
    return "/".join(f"{name}=" + SPECIAL.sub(lambda m: f"%{ord(m.group()):02X}", str(v)) for name, v in values.items())


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions that are still there, oldest first."""
    found = (LOG_FILE.fullmatch(name) for name, _ in _names(spark, f"{path.rstrip('/')}/log"))
    return sorted(int(m.group(1)) for m in found if m)


def snapshot(spark: SparkSession, path: str, number: int | None = None) -> Snapshot:
    """The current version, or the one of a number; an empty one if nothing was ever put."""
    known = numbers(spark, path)
    if number is None:
        if not known:
            return Snapshot()
        number = known[-1]
    elif number not in known:
        raise ValueError(f"{path} has no version {number}")
    return Snapshot(number, json.loads(_read(spark, f"{path.rstrip('/')}/log/{number:020d}.json")))


def _commit(spark: SparkSession, path: str, change: Callable[[dict], dict]) -> Snapshot:
    for _ in range(TRIES):
        before = snapshot(spark, path)
        after = Snapshot(before.number + 1, change(dict(before.keys)))
        if _create(spark, f"{path.rstrip('/')}/log/{after.number:020d}.json", json.dumps(after.keys, sort_keys=True)):
            return after
    raise CommitConflict(f"{path}: overtaken {TRIES} times")


def put_folder(spark: SparkSession, path: str, key: dict, write: Callable[[str], object], schema: StructType | None = None) -> str:
    """Let ``write`` fill a fresh folder, then make it the one of ``key``. Returns the folder."""
    name = f"data/{_key(key)}/version={uuid.uuid4().hex}"
    folder = f"{path.rstrip('/')}/{name}"
    write(folder)
    entry = {"folder": name, "schema": None if schema is None else schema.jsonValue()}
    _commit(spark, path, lambda keys: {**keys, _key(key): entry})
    return folder


def put(df: DataFrame, path: str, key: dict) -> DataFrame:
    """Replace the rows of ``key`` and return them as read back from storage."""
    folder = put_folder(df.sparkSession, path, key, lambda to: df.write.parquet(to), df.schema)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove(spark: SparkSession, path: str, key: dict) -> Snapshot:
    """Take a key out of the current version; older versions keep it."""
    return _commit(spark, path, lambda keys: {k: v for k, v in keys.items() if k != _key(key)})


def folder_of(spark: SparkSession, path: str, key: dict, number: int | None = None) -> str:
    """The current folder of a key; a key that is not there raises."""
    entry = snapshot(spark, path, number).keys.get(_key(key))
    if entry is None:
        raise ValueError(f"{path} has no {_key(key)}")
    return f"{path.rstrip('/')}/{entry['folder']}"


def _parts(key: str) -> dict[str, str]:
    return dict(part.split("=", 1) for part in key.split("/"))


def _schema(entries: list[dict]) -> StructType:
    """All columns of the entries; of a column with several types the last entry's."""
    fields: dict[str, StructField] = {}
    for entry in entries:
        for f in StructType.fromJson(entry["schema"]).fields:
            fields[f.name] = StructField(f.name, f.dataType, True)
    return StructType(list(fields.values()))


def read(spark: SparkSession, path: str, where: dict | None = None, number: int | None = None) -> DataFrame:
    """The rows of a version, with their key columns unless ``where`` gives them.

    ``where`` names some or all key columns; only folders of such keys are opened. Columns that a folder lacks are NULL.
    ``run_date`` is a date, other key columns are text.
    """
    current = snapshot(spark, path, number)
    if not current.number:
        raise ValueError(f"{path} holds no version")
    wanted = _parts(_key(where)) if where else {}
    chosen = {k: e for k, e in sorted(current.keys.items()) if wanted.items() <= _parts(k).items()}
    names = list(dict.fromkeys(n for k in current.keys for n in _parts(k)))
    keys = [StructField(n, DateType() if n == "run_date" else StringType(), True) for n in names]
    rows = _schema(list((chosen or current.keys).values()))
    whole = StructType([f for f in rows.fields if f.name not in names] + keys)
    given = where or {}
    if not chosen:
        return spark.createDataFrame([], whole).drop(*given)
    root = path.rstrip("/")
    table = spark.read.schema(whole).option("basePath", f"{root}/data").parquet(*[f"{root}/{e['folder']}" for e in chosen.values()])
    for name, value in given.items():
        table = table.where(F.col(name) == F.lit(value).cast(whole[name].dataType))
    return table.select(*[f.name for f in whole.fields if f.name not in given])


def expire(spark: SparkSession, path: str, keep: int = 10, older_than: float = 86_400.0) -> int:
    """Deletes all but the newest ``keep`` versions, and folders that none of those names.

    A folder younger than ``older_than`` seconds may belong to a write that has not ended and stays. Returns the number
    of deleted folders.
    """
    root, known = path.rstrip("/"), numbers(spark, path)
    kept = known[-max(keep, 1):]
    files, used = _files(spark, path), set()
    for number in kept:
        used |= {e["folder"] for e in snapshot(spark, path, number).keys.values()}
    for number in known[:-max(keep, 1)]:
        files.delete(_path(spark, f"{root}/log/{number:020d}.json"), False)
    deleted, before, level = 0, (time.time() - older_than) * 1000, ["data"]
    while level:
        below = []
        for folder in level:
            for name, changed in _names(spark, f"{root}/{folder}"):
                child = f"{folder}/{name}"
                if not name.startswith("version="):
                    below.append(child)
                elif child not in used and changed < before:
                    files.delete(_path(spark, f"{root}/{child}"), True)
                    deleted += 1
        level = below
    return deleted
