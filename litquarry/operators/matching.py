"""Which names hold which titles: one automaton over many titles, run through the names in Arrow batches.

The titles go out with the tasks in slices of checked size; a task builds the automaton of a slice once and reads each name once,
whatever the number of titles or what they have in common. It keeps the best name of each title that it meets, so a slice sends
at most one row a title and task.
"""

from __future__ import annotations

import functools
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of titles in a slice; an automaton takes up to some hundred times as much.
SLICE_BYTES = 1 << 20


@functools.lru_cache(maxsize=2)
def _automaton(words: tuple[str, ...]):
    import ahocorasick

    out = ahocorasick.Automaton()
    for i, word in enumerate(words):
        out.add_word(word, i)
    out.make_automaton()
    return out


def _scan(words: tuple[str, ...], schema: pa.Schema):
    def run(batches):
        automaton, best = _automaton(words), {}
        for batch in batches:
            for ord_, name, low in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for i in {i for _, i in automaton.iter(low)}:
                    if i not in best or (ord_, name) < best[i]:
                        best[i] = (ord_, name)
        columns = [[words[i] for i in best], [o for o, _ in best.values()], [n for _, n in best.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def slices(words: DataFrame, column: str, slice_bytes: int) -> list[list[str]]:
    """The distinct words in parts of about ``slice_bytes``, dealt by their hash; one that comes out four times as large raises."""
    size = F.coalesce(F.sum(F.octet_length(column)), F.lit(0))
    n = max(1, math.ceil(int(words.agg(size).first()[0]) / max(1, slice_bytes)))
    out = []
    for i in range(n):
        part = words.where(F.pmod(F.xxhash64(column), F.lit(n)) == i).select(column)
        if n > 1 and int(part.agg(size).first()[0]) > 4 * slice_bytes:
            raise ValueError(f"slice {i} of {n} is over {4 * slice_bytes} bytes; raise slice_bytes")
        out.append(sorted(r[0] for r in part.collect()))
    return [x for x in out if x]


def first_match(items: DataFrame, titles: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(title, name): for each title the first item by ord whose name holds it, by containment of lower-case texts; ties by name.

    A blank title matches nothing, nor does an item without a name or an ord; titles that differ in case or in blanks around them
    get the same name each.
    """
    low = titles.select("title", F.lower(F.trim("title")).alias("_low")).where("_low <> ''").distinct()
    names = items.where("ord is not null and name is not null").select("ord", "name", F.lower("name").alias("_low"))
    kind = items.schema["ord"].dataType
    schema = pa.schema([("_low", pa.string()), ("ord", to_arrow_type(kind)), ("name", pa.string())])
    found = None
    for words in slices(low.select("_low").distinct(), "_low", slice_bytes):
        part = names.mapInArrow(_scan(tuple(words), schema), f"_low string, ord {kind.simpleString()}, name string")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return low.select("title", F.lit(None).cast("string").alias("name")).limit(0)
    best = found.groupBy("_low").agg(F.min(F.struct("ord", "name"))["name"].alias("name"))
    return low.join(best, "_low").select("title", "name")
