"""Small documents in shared storage that make written data visible.

Data is always written to a folder of its own, under a name nothing reads yet; a document
that names the folder is written last, in one step. So a reader sees the state before or the
state after, also where replacing a folder is not one step, as on object stores.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from txspark.sources.bytesplit import open_filesystem


def new_name() -> str:
    """A name that no other writer takes; later ones sort behind earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def put_document(folder: str, name: str, content: dict) -> None:
    """Write or replace a document in one step."""
    files, base = open_filesystem(folder)
    files.create_dir(base, recursive=True)
    data = json.dumps(content).encode()
    if isinstance(files, pafs.LocalFileSystem):
        # a rename replaces; what is half written has a name that listings skip
        hidden = f"{base}/.{name}-{uuid.uuid4().hex}"
        with files.open_output_stream(hidden) as out:
            out.write(data)
        files.move(hidden, f"{base}/{name}.json")
    else:
        # object stores show an object once it is complete
        with files.open_output_stream(f"{base}/{name}.json") as out:
            out.write(data)


def documents(folder: str) -> list[str]:
    """Names of the documents in a folder, in order."""
    files, base = open_filesystem(folder)
    found = files.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    names = [f.base_name for f in found if f.type == pafs.FileType.File]
    return sorted(n[: -len(".json")] for n in names if n.endswith(".json") and not n.startswith("."))


def get_document(folder: str, name: str) -> dict:
    files, base = open_filesystem(folder)
    with files.open_input_file(f"{base}/{name}.json") as handle:
        return json.loads(handle.read())


def remove_document(folder: str, name: str) -> None:
    files, base = open_filesystem(folder)
    files.delete_file(f"{base}/{name}.json")


def folders(folder: str) -> list[str]:
    """Names of the folders in a folder, in order."""
    files, base = open_filesystem(folder)
    found = files.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == pafs.FileType.Directory)


def remove_folder(folder: str, name: str) -> None:
    files, base = open_filesystem(folder)
    if files.get_file_info(f"{base}/{name}").type == pafs.FileType.Directory:
        files.delete_dir(f"{base}/{name}")


# -- sets of tables --------------------------------------------------------------------

NEWEST = "newest"


def _document_of(run_id: str) -> str:
    """A file name for any run id; different ids never share one."""
    plain = re.sub(r"[^A-Za-z0-9_.-]", "_", run_id)[:80]
    return f"run-{plain}-{hashlib.sha256(run_id.encode()).hexdigest()[:16]}"


def publish_tables(tables: dict[str, DataFrame], path: str, run_id: str) -> None:
    """Store a run's tables and make all of them visible in one step.

    They go to a new folder; the documents that name it come last, first the run's own, then
    the one for the newest run. A run that is stored again, or one that fails on the way, leaves
    readers with what they had. The data of the state before stays for readers that hold
    it; older data goes.
    """
    path, name = path.rstrip("/"), new_name()
    for table, df in tables.items():
        df.write.option("compression", "snappy").parquet(f"{path}/data/{name}/{table}")
    document = _document_of(run_id)
    known = documents(path)
    before = get_document(path, document)["folder"] if document in known else None
    content = {
        "run_id": run_id,
        "folder": name,
        "before": before,
        "tables": {table: df.schema.json() for table, df in tables.items()},
    }
    put_document(path, document, content)
    if NEWEST not in known or get_document(path, NEWEST)["folder"] < name:
        put_document(path, NEWEST, content)
    _clear(path, name)


# Data that no document names may be another writer's, until it is this old.
GRACE_NS = 24 * 3600 * 10**9


def _clear(path: str, newest: str) -> None:
    """Remove data that no document names and that nobody can still be writing."""
    used = set()
    for document in documents(path):
        content = get_document(path, document)
        used |= {content["folder"], content["before"]}
    for folder in folders(f"{path}/data"):
        if folder not in used and int(folder.split("-")[0]) <= int(newest.split("-")[0]) - GRACE_NS:
            remove_folder(f"{path}/data", folder)


def published_runs(path: str) -> list[str]:
    """Ids of the published runs, the oldest first."""
    found = [get_document(path, d) for d in documents(path) if d != NEWEST]
    return [c["run_id"] for c in sorted(found, key=lambda c: c["folder"])]


def read_published(spark: SparkSession, path: str, table: str, run_id: str | None = None) -> DataFrame:
    """A table of a run, or of the run that was published last."""
    document = NEWEST if run_id is None else _document_of(run_id)
    if document not in documents(path):
        raise FileNotFoundError(f"No such run is published in {path}")
    content = get_document(path, document)
    schema = T.StructType.fromJson(json.loads(content["tables"][table]))
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/data/{content['folder']}/{table}")
