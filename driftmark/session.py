"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import Any

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: The folders made for local sessions that name none.
_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()
#: The folders made within ``scratch``, by thread.
_OPEN = threading.local()


def local_session(app: str = "driftmark", cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DRIFTMARK_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only where a local session leaves it unset (tests, a laptop) a folder is made, one per session.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root and (held := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        root = str(held.get())
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
        root = _LOCAL.setdefault(spark.sparkContext.applicationId, "") or "file://" + tempfile.mkdtemp(prefix="driftmark-")
        _LOCAL[spark.sparkContext.applicationId] = root
    return as_uri(root)


def as_uri(path: str) -> str:
    """A path with scheme and authority, as Spark and readers in Python workers both take it."""
    if "://" not in path:
        scheme, _, rest = path.rpartition(":/")
        path = f"{scheme}:///{rest}" if scheme else "file://" + os.path.abspath(path)
    return path.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per session, wherever the driver found it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    home = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="driftmark-code-")  # of the driver; Spark serves the file to executors
    path = f"{folder}/driftmark-code.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f"{home.name}/{f.relative_to(home)}")
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    path = f"{shared_root(spark)}/driftmark/{name}-{uuid.uuid4().hex}"
    if stack := getattr(_OPEN, "stack", None):
        stack[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end all folders that this thread made within; nothing that reads them may be used later."""
    from driftmark.sources.files import Folder

    if not hasattr(_OPEN, "stack"):
        _OPEN.stack = []
    _OPEN.stack.append([])
    try:
        yield
    finally:
        for path in _OPEN.stack.pop():
            Folder(spark, path).remove()


def together(*steps: Callable[[], Any]) -> list[Any]:
    """The results of steps that do not depend on each other, whose Spark jobs run side by side."""
    stack, out, threads = getattr(_OPEN, "stack", []), [None] * len(steps), []

    def run(i: int) -> None:
        _OPEN.stack = stack  # folders count as made by the caller
        try:
            out[i] = (True, steps[i]())
        except BaseException as e:  # noqa: BLE001 - raised again by the caller
            out[i] = (False, e)

    for i in range(len(steps)):
        threads.append(InheritableThread(target=run, args=(i,)))
        threads[-1].start()
    for t in threads:
        t.join()
    for done, value in out:
        if not done:
            raise value
    return [value for _, value in out]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case, as Spark's resolver does)."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name = "_" + name
    return name
