"""A flow's name is held by one driver at a time (STR-5, STR-6), whatever its application.

The lease of a name is a folder below the shared scratch root.  Drivers take
it by creating the next numbered file, which only one can; the number is the
fencing number of everything that driver does.  The holder renews a beat
file; a lease whose beat is older than ``ttl`` seconds is stale and may be
taken.  Ages compare two files of the same file system, so the drivers'
clocks don't matter.

With ``take_over`` (``--rm``) the next number is taken from a live holder,
which notices at its next beat and stops its query; the new holder waits for
that, ``wait`` seconds at most, or until the old beat is stale.  A holder
that was cut off and comes back finds the higher number before it publishes
(``check``).
"""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from lineflow import storage
from lineflow.session import folder_name, scratch_root, spark_context

TTL = 60.0


class NameTaken(RuntimeError):
    """Another driver runs a flow of this name."""


class LeaseLost(RuntimeError):
    """Another driver has taken the name over."""


_HELD: dict[str, NameLease] = {}  # of this process, by folder


class NameLease:
    def __init__(self, spark: SparkSession, name: str, ttl: float = TTL):
        self.spark, self.name, self.ttl = spark, name, ttl
        self.folder = f"{scratch_root(spark)}/lineflow/leases/{folder_name(name)}"
        self.holder = uuid.uuid4().hex
        self.number: int | None = None
        self.query: StreamingQuery | None = None
        self.ended = threading.Event()
        self.giving_back = threading.Lock()

    def _numbers(self) -> list[int]:
        return [int(n) for n in storage.names(self.spark, self.folder) if n.isdigit()]

    def _beat_file(self, number: int) -> str:
        return f"{self.folder}/beat-{number}"

    def _live(self, number: int) -> bool:
        """Whether the holder of a number renewed it within the last ``ttl`` seconds."""
        beat = storage.modified(self.spark, self._beat_file(number))
        if beat is None:  # given back
            return False
        probe = f"{self.folder}/.now-{self.holder}"
        storage.write(self.spark, probe, "")
        now = storage.modified(self.spark, probe)
        storage.remove(self.spark, probe)
        return now - beat < self.ttl * 1000

    def acquire(self, take_over: bool = False, wait: float = 0.0) -> NameLease:
        """Take the name, or raise ``NameTaken``.  A Spark Connect client has no file system to hold it on."""
        if spark_context(self.spark) is None:
            return self
        own = _HELD.get(self.folder)
        if own is not None and own.query is not None and not own.query.isActive:
            own.release()  # its query ended; its thread hasn't noticed yet
        held = self._numbers()
        last = max(held, default=0)
        live = last > 0 and self._live(last)
        if live and not take_over:
            raise NameTaken(f"a flow named {self.name!r} is already running in another application; use rm=True to replace it")
        try:
            # the beat comes first, so that the number is never seen without one
            storage.write(self.spark, self._beat_file(last + 1), self.holder)
            storage.write(self.spark, f"{self.folder}/{last + 1:08d}", self.holder, overwrite=False)
        except storage.AlreadyThere:
            raise NameTaken(f"another application takes the name {self.name!r} at this moment") from None
        self.number = last + 1
        end = time.monotonic() + wait
        while live and time.monotonic() < end:  # the old holder stops at its next beat
            time.sleep(min(0.5, self.ttl / 10))
            live = self._live(last)
        for n in held:  # an old beat's absence tells its holder nothing that the number doesn't
            if n < last:
                storage.remove(self.spark, f"{self.folder}/{n:08d}")
                storage.remove(self.spark, self._beat_file(n))
        _HELD[self.folder] = self
        return self

    def check(self) -> None:
        """Raise when a higher number was taken: nothing more may be published under this one."""
        if self.number is not None and max(self._numbers(), default=0) > self.number:
            raise LeaseLost(f"another application runs the flow {self.name!r} now")

    def renew(self) -> None:
        self.check()
        storage.write(self.spark, self._beat_file(self.number), self.holder)

    def release(self) -> None:
        with self.giving_back:  # whoever comes second waits until it is back
            if self.number is not None and not self.ended.is_set():
                storage.remove(self.spark, self._beat_file(self.number))
                self.ended.set()
                if _HELD.get(self.folder) is self:
                    del _HELD[self.folder]

    def keep(self, query: StreamingQuery) -> None:
        """Renew while the query runs, stop it when the name is taken over, give the lease back when it ends."""
        if self.number is None:
            return
        self.query = query

        def run() -> None:
            try:
                while not self.ended.is_set() and query.isActive:
                    # returns early when the query ends, and raises when it failed
                    if query.awaitTermination(max(1, int(self.ttl / 4))):
                        break
                    with self.giving_back:
                        if not self.ended.is_set():
                            self.renew()
            except LeaseLost:
                query.stop()
            except Exception:  # noqa: BLE001 - the query's own error is its caller's
                pass
            finally:
                try:
                    self.release()
                except Exception:  # noqa: BLE001 - the session is gone; the beat goes stale
                    pass

        threading.Thread(target=run, daemon=True, name=f"lease-{self.name}").start()
