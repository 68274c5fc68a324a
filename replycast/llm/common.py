"""What the operators share: words, white space, saved tables, Arrow batches."""

import sys
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F

from ..session import FREED, shared_dir, shuffles_freed  # noqa: F401 (tests use FREED)

# The white space of the contracts, one character each and as a pattern.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
BLANK = "[ \\t-\\r]"


def travels(name):
    """Let a module's code travel inside tasks, so executors need not have the package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


travels(__name__)


def worker_memory():
    """Dictionary that stays with a Python worker from task to task."""
    return vars(sys.modules.setdefault("replycast_worker_memory", ModuleType("replycast_worker_memory")))


def words(text):
    """Words (runs without white space) of a text column; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BLANK}+"), "")


def without_blanks(text):
    """Text with every white-space character deleted; empty for a null."""
    text = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def row_hashes(*names):
    """128 bits of columns, nulls told from values, as `h1` and `h2`."""
    columns = [c for name in names for c in (F.col(name).isNull(), F.col(name))]
    return F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit(7), *columns).alias("h2")


def saved(df):
    """`df` written to the shared checkpoint folder, so that it is computed once."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def saved_alone(df):
    """As `saved`; the shuffle files of making it are gone when it is written."""
    with shuffles_freed(df.sparkSession):
        return saved(df.select("*"))


def map_texts(df, columns, schema, function, rows=256):
    """Rows of `function(ids, texts)` over Arrow batches, `rows` rows at a time.

    `columns` names the key columns and last the text. `function` gets a list of values for each of
    them and returns one list for each column of `schema`.
    """

    def run(batches):
        arrow = None
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = function(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                if out is None:
                    continue
                arrow = arrow or [pa.type_for_alias(kind) for kind in kinds]
                arrays = [pa.array(v, t) for v, t in zip(out, arrow)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    aliases = {"long": "int64", "int": "int32", "double": "float64", "boolean": "bool"}
    fields = [part.split() for part in schema.split(",")]
    names = [name for name, _ in fields]
    kinds = [aliases.get(kind, kind) for _, kind in fields]
    return df.select(*columns).mapInArrow(run, schema)


def slices(batch, column=-1, limit=4 << 20):
    """Parts of an Arrow batch whose strings in `column` have about `limit` bytes together, or one row more."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)[:-1]]) // limit
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for start, stop in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(start, stop - start)
