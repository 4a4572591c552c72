"""Arrow batches whose memory is bounded by the bytes of their texts."""

import ctypes
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# The setting that bounds what Spark hands to a Python worker at once, and the bound.
BATCH_BYTES, MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
SLICE_BYTES = 1 << 19
SLICE_ROWS = 512


def bound_batches(spark: SparkSession) -> None:
    """From now on batches of the session have at most ``MOST_BYTES`` (or a longer row); results do not depend on it."""
    spark.conf.set(BATCH_BYTES, str(MOST_BYTES))


_kept: list = []


def kept_by_worker(make):
    """What ``make`` gives for its last arguments stays in a Python worker for its next tasks, until ``let_go``."""
    _kept.append(lru_cache(maxsize=1)(make))
    return _kept[-1]


def let_go() -> None:
    """A worker goes on from operator to operator: one that keeps nothing itself calls this, so that what others kept there
    does not add to its own memory."""
    for kept in _kept:
        kept.cache_clear()


def give_back() -> None:
    """Memory that is free in this process goes back to the system; otherwise a worker holds the most that any task took of it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim:
        trim(0)


def frugal(run, keeps: bool = False):
    """``run``, a function of a task's batches, with memory given back behind it. One that keeps nothing in its worker lets
    go first of what others kept there."""
    def task(batches):
        if not keeps:
            let_go()
        try:
            yield from run(batches)
        finally:
            give_back()
    return task


def slices(batches, text: int):
    """Batches in slices of bounded rows and bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for place, size in enumerate(sizes.tolist()):
            if place > start and (held + size > SLICE_BYTES or place - start >= SLICE_ROWS):
                yield batch.slice(start, place - start)
                start, held = place, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)
