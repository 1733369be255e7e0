"""Which export runs are open, so that several may use one ledger.

The log is a numbered series of small files in a folder; each holds the whole list of open runs, so the
newest is all that is read and older ones are cleared away. A change is made by creating the next
number, which succeeds for one writer only. Whoever loses reads the new list and plans again.

A run is owned by the process that works on it. Owners touch a file of their own while they live; the run
of an owner whose file is gone, or older than the lease, was interrupted and can be taken over.
"""

from __future__ import annotations

import contextlib
import json
import os
import threading
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Older lists that stay for readers who have just looked up their names.
KEPT = 16

# Seconds after which an owner that shows no sign of life counts as gone.
LEASE = 900.0


@dataclass(frozen=True)
class State:
    """The owner of every open run, as of a version of the log."""

    version: int
    owners: dict[str, str]


class RunLog:
    """The log in ``folder``, on a file system where creating a name can fail because it exists.

    That holds for mounted disks and HDFS; a store whose rename overwrites is not fit for it.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        context = spark.sparkContext
        self._jvm, configuration = context._jvm, context._jsc.hadoopConfiguration()
        path = self._path(folder)
        filesystem = path.getFileSystem(configuration)
        filesystem.mkdirs(path)
        # Where the folder really is, if a mount table leads to it.
        self._folder = filesystem.resolvePath(path)
        self._filesystem = self._folder.getFileSystem(configuration)

    def read(self) -> State:
        while True:
            names = self._versions()
            if not names:
                return State(0, {})
            with contextlib.suppress(Py4JJavaError):
                # Fails only if the list was cleared away since it was found.
                stream = self._filesystem.open(self._path(names[-1]))
                try:
                    text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                finally:
                    stream.close()
                return State(int(names[-1].removesuffix(".json")), json.loads(text))

    def commit(self, before: State, owners: dict[str, str]) -> bool:
        """Replace the list of ``before``; false if it is no longer the newest."""
        staged = self._path(f"_{uuid.uuid4().hex}")
        self._write(staged, json.dumps(owners, sort_keys=True))
        done = self._publish(staged, self._path(f"{before.version + 1:012d}.json"))
        if done:
            for name in self._versions()[:-KEPT]:
                self._filesystem.delete(self._path(name), False)
        return done

    def close(self, owner: str) -> None:
        """Take the runs of ``owner`` off the list."""
        while True:
            state = self.read()
            left = {run: by for run, by in state.owners.items() if by != owner}
            if left == state.owners or self.commit(state, left):
                return

    def take_over(self, owner: str, lease: float) -> list[str]:
        """Make ``owner`` the owner of all runs that were interrupted, and return them."""
        while True:
            state = self.read()
            gone = [run for run, by in state.owners.items() if by != owner and not self._lives(by, lease)]
            if not gone or self.commit(state, state.owners | dict.fromkeys(gone, owner)):
                return gone

    @contextlib.contextmanager
    def alive(self, owner: str, lease: float) -> Iterator[None]:
        """Show that ``owner`` lives until the block is left, also by an exception."""
        sign, over = self._path(f"alive-{owner}"), threading.Event()
        self._write(sign, "")

        def beat() -> None:
            while not over.wait(max(1.0, lease / 4)):
                self._write(sign, "")

        thread = threading.Thread(target=beat, daemon=True)
        thread.start()
        try:
            yield
        finally:
            over.set()
            thread.join()
            self._filesystem.delete(sign, False)

    def _lives(self, owner: str, lease: float) -> bool:
        """By the clock of the file system, which all machines share."""
        now = self._path(f"_{uuid.uuid4().hex}")
        self._write(now, "")
        try:
            seen = self._filesystem.getFileStatus(self._path(f"alive-{owner}")).getModificationTime()
            return self._filesystem.getFileStatus(now).getModificationTime() - seen < 1000 * lease
        except Py4JJavaError as error:
            if "FileNotFoundException" in str(error.java_exception):
                return False
            raise
        finally:
            self._filesystem.delete(now, False)

    def _versions(self) -> list[str]:
        names = (status.getPath().getName() for status in self._filesystem.listStatus(self._folder))
        return sorted(name for name in names if name.endswith(".json"))

    def _path(self, name: str):
        parent = (self._folder,) if hasattr(self, "_folder") else ()
        return self._jvm.org.apache.hadoop.fs.Path(*parent, name)

    def _write(self, path, text: str) -> None:
        stream = self._filesystem.create(path, True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def _publish(self, staged, target) -> bool:
        """Give ``staged`` its name; false if the name is taken."""
        if self._folder.toUri().getScheme() == "file":
            # Renaming would replace a file of that name here; a second link to one name fails.
            try:
                os.link(staged.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            finally:
                self._filesystem.delete(staged, False)
            return True
        if self._filesystem.rename(staged, target):
            return True
        self._filesystem.delete(staged, False)
        return False
