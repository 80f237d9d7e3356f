"""Exchange of data files inside a directory that survives a crash half way.

New files are staged in a hidden folder of the table. A manifest then names the
files they replace; from that point on the exchange can be repeated until it is
done, and every rewrite first finishes what an earlier one left behind.

A rewrite owns its directory: it creates the file ``_owner``, which a second
writer meets and refuses to go on. The owner removes it at the end, whether the
rewrite succeeded or not. Only a driver that died leaves it behind; ``release``
then frees the directory. Deletes and renames are calls to the store, of which
``CALLS`` run at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CALLS = 16


class OwnedError(RuntimeError):
    """Another job is rewriting the directory."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, Path = _fs(spark, path)
    return fs.exists(Path(path))


def _each(call: Callable, names: Sequence) -> None:
    with ThreadPoolExecutor(CALLS) as pool:
        for _ in pool.map(call, names):
            pass


def _text(spark: SparkSession, fs, path) -> str:
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@contextmanager
def owned(spark: SparkSession, root: str) -> Iterator[int]:
    """Make this job the only writer of a directory, and finish what an earlier one left; yields how much that was."""
    fs, Path = _fs(spark, root)
    place = Path(f"{root.rstrip('/')}/_owner")
    try:
        out = fs.create(place, False)
    except Py4JJavaError:
        if not fs.exists(place):
            raise
        raise OwnedError(f"{root} is being rewritten: {_text(spark, fs, place)}; release it once that job is gone") from None
    try:
        out.write(bytearray(json.dumps({"application": spark.sparkContext.applicationId, "since": int(time.time())}).encode()))
        out.close()
        yield _recover(spark, root)
    finally:
        fs.delete(place, False)


def release(spark: SparkSession, root: str) -> None:
    """Free a directory whose owner died."""
    fs, Path = _fs(spark, root)
    fs.delete(Path(f"{root.rstrip('/')}/_owner"), False)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none where there is no such folder."""
    fs, Path = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(Path(path))] if fs.exists(Path(path)) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, Path = _fs(spark, path)
    return _text(spark, fs, Path(path))


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and rename it, so that nobody reads half of it."""
    fs, Path = _fs(spark, path)
    parent, _, leaf = path.rpartition("/")
    draft = Path(f"{parent}/_{uuid.uuid4().hex}-{leaf}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, Path(path)):
        raise OSError(f"could not write {path}")


def remove(spark: SparkSession, path: str) -> None:
    fs, Path = _fs(spark, path)
    fs.delete(Path(path), True)


def staging(root: str) -> str:
    return f"{root.rstrip('/')}/_stage-{uuid.uuid4().hex}"


def _staged_files(fs, Path, stage: str) -> list[str]:
    found, walk = [], fs.listFiles(Path(stage), True)
    while walk.hasNext():
        name = walk.next().getPath().toString()
        if name.endswith(".parquet"):
            found.append(name)
    return found


def data_files(spark: SparkSession, root: str) -> list[str]:
    """Visible files below a directory; hidden ones and those in hidden folders are left out."""
    fs, Path = _fs(spark, root)
    if not fs.exists(Path(root)):
        return []
    base = fs.makeQualified(Path(root)).toString().rstrip("/")
    found, walk = [], fs.listFiles(Path(root), True)
    while walk.hasNext():
        name = walk.next().getPath().toString()
        inside = name[len(base) + 1 :].split("/")
        if not any(part[0] in "_." for part in inside):
            found.append(name)
    return found


def exchange(spark: SparkSession, root: str, stage: str, inputs: Sequence[str], mark: str = "") -> int:
    """Put the staged files in place of ``inputs``; returns the number of new files."""
    fs, Path = _fs(spark, root)
    manifest = f"{root.rstrip('/')}/_swap-{uuid.uuid4().hex}.json"
    text = json.dumps({"stage": stage, "inputs": list(inputs), "mark": mark})
    out = fs.create(Path(manifest), True)
    out.write(bytearray(text.encode()))
    out.close()
    return _finish(spark, root, manifest, json.loads(text))


def _finish(spark: SparkSession, root: str, manifest: str, plan: dict) -> int:
    fs, Path = _fs(spark, root)
    root, moved = root.rstrip("/"), 0
    _each(lambda name: fs.delete(Path(name), False), plan["inputs"])
    if fs.exists(Path(plan["stage"])):
        folder = plan["stage"].rsplit("/", 1)[1]
        moves = []
        for name in _staged_files(fs, Path, plan["stage"]):
            parent, _, leaf = name.split(f"/{folder}/", 1)[1].rpartition("/")
            moves.append((name, f"{root}/{parent}" if parent else root, leaf))
        _each(lambda home: fs.mkdirs(Path(home)), sorted({home for _, home, _ in moves}))

        def move(step: tuple[str, str, str]) -> None:
            name, home, leaf = step
            if not fs.rename(Path(name), Path(f"{home}/{plan['mark']}{leaf}")):
                raise OSError(f"could not move {name}")

        _each(move, moves)
        moved = len(moves)
        fs.delete(Path(plan["stage"]), True)
    fs.delete(Path(manifest), False)
    return moved


def recover(spark: SparkSession, root: str) -> int:
    """Finish exchanges an earlier run left behind and drop unfinished staging; returns how many were finished."""
    fs, Path = _fs(spark, root)
    if not fs.exists(Path(root)):
        return 0
    with owned(spark, root) as done:
        return done


def _recover(spark: SparkSession, root: str) -> int:
    fs, Path = _fs(spark, root)
    done = 0
    for status in list(fs.listStatus(Path(root))):
        path = status.getPath()
        if path.getName().startswith("_swap-"):
            _finish(spark, root, path.toString(), json.loads(_text(spark, fs, path)))
            done += 1
    for status in list(fs.listStatus(Path(root))):
        if status.getPath().getName().startswith("_stage-"):
            fs.delete(status.getPath(), True)
    return done
