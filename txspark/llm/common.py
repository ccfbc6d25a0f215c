"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txspark.session import new_shared_dir

HELD_OUT_FOLDS = 4
HELD_OUT_FOLD = 2


_ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application, where they would not
    find it by themselves: on a cluster, or locally when started from another folder."""
    sc = spark.sparkContext
    seen = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    if sc.applicationId in _shipped or sc.master.startswith("local") and _ROOT in map(Path, map(os.path.realpath, seen)):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        archive.writestr("txspark/__init__.py", "")
        for file in sorted((_ROOT / "txspark").rglob("*.py")):
            archive.write(file, file.relative_to(_ROOT))
    # the driver's own copy, which Spark sends on
    target = Path(tempfile.mkdtemp(prefix="txspark-")) / "txspark.zip"
    target.write_bytes(packed.getvalue())
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What the block runs gives its shuffle files back as soon as it ends; Spark else keeps
    them until the driver happens to collect its garbage. For results that are taken whole."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back, so that a lost executor
    costs only what it held and nothing above is computed twice. Its shuffles are freed."""
    path = new_shared_dir(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Rows of the fold kept out of all training; a missing id is never held out."""
    fold = F.crc32(doc_id.cast("string")) % HELD_OUT_FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for working columns that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by exact name, also where the name holds dots."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """The frame with columns that are computed exactly once for each row.

    Plain projections may be merged and filters pushed below them, and then repeat what they
    refer to; nothing moves through the one-row generator used here.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))


def spread(h: str) -> Column:
    """An even value below 2^30 from a hash column."""
    return F.pmod(F.xxhash64(h), F.lit(1 << 30))


def bounded_sample(rows: DataFrame, h: str, most: int, sizes: tuple[int, int] | None = None) -> DataFrame:
    """At most `most` rows, the same ones on every run, for training.

    sizes: the number of rows and their smallest spread(h), where these are known; the sample
    then is never empty, also of many copies of a few rows.

    Rows far above the expected cut are left out before the sort, so that each task hands on
    its share of the sample and not `most` rows.
    """
    total, least = sizes or (rows.select(h).count(), -1)
    share = 2 * (most + 100) / max(total, 1)
    near = rows if share >= 1 else rows.where(spread(h) < max(int(share * (1 << 30)), least + 1))
    return near.orderBy(*rows.columns).limit(most)
