"""Regex matches with their positions, from DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lengths are summed in blocks of this size, so that texts with very many matches stay cheap.
BLOCK = 256


def running_total(lengths: Column) -> Column:
    """For an array of ints, the sum of those before each."""

    def block(values: Column, get=lambda x: x) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(
            values, start, lambda a, x: F.struct((a["sum"] + get(x)).alias("sum"), F.concat(a["before"], F.array(a["sum"])).alias("before"))
        )

    starts = F.when(F.size(lengths) > 0, F.sequence(F.lit(0), F.size(lengths) - 1, F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda s: block(F.slice(lengths, s + 1, F.lit(BLOCK))))
    bases = lambda bs: block(bs, lambda b: b["sum"])["before"]
    zipped = F.aggregate(F.array(blocks), F.array().cast("array<struct<base:int,before:array<int>>>"), lambda _, bs: F.transform(
        F.arrays_zip(bases(bs).alias("base"), bs["before"].alias("before")), lambda z: F.struct(z["base"].alias("base"), z["before"].alias("before"))
    ))
    return F.flatten(F.transform(zipped, lambda z: F.transform(z["before"], lambda x: x + z["base"])))


def matches(text: Column, pattern: Column) -> Column:
    """array<struct<start int, end int, found string>>: leftmost non-overlapping matches, in code points.

    pattern must not match the empty string.
    """
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)
    zipped = F.aggregate(
        F.array(F.struct(found.alias("found"), F.transform(gaps, lambda g: F.length(g)).alias("gaps"))),
        F.array().cast("array<struct<start:int,end:int,found:string>>"),
        lambda _, x: F.transform(
            F.arrays_zip(
                x["found"].alias("found"),
                F.slice(x["gaps"], F.lit(1), F.size(x["found"])).alias("gap"),
                running_total(F.transform(F.arrays_zip(x["found"].alias("f"), F.slice(x["gaps"], F.lit(1), F.size(x["found"])).alias("g")), lambda z: z["g"] + F.length(z["f"]))).alias("before"),
            ),
            lambda z: F.struct(
                (z["before"] + z["gap"]).alias("start"), (z["before"] + z["gap"] + F.length(z["found"])).alias("end"), z["found"].alias("found")
            ),
        ),
    )
    return zipped
